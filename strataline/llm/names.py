"""Variant spellings of the names of persons and organisations, linked by suffix blocking.

A name is parsed into what identifies it: the distinctive words and the line of business of an
organisation, or the surname, given name and initials of a person. Names of one parse are one
*class* and compared once.

Blocks are suffixes of the words, from a least length up to the whole word. A suffix that is too
common is refined by other fields: the line of business and the number of words, or how the other
word of a person begins. What is too common even then is left to keys that two names must share if
the rules link them: of both words of a person, or of a word and the line of business, what is left
when a slip is taken out; of words run together, their pieces. These bring together pairs without a
common suffix too, and are joined in blocks of any size. In the blocks of suffixes a pair is
compared for its longest common suffix only. Words are compared by the ratio of their longest
common subsequence, words of two names paired by assignment.

Initials alone ("Funevisa W") fit several persons. They are linked last, and only where all
persons that they fit are one.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, combinations, product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataline.llm.components import components
from strataline.llm.skeleton import plain
from strataline.session import checkpoint_dir, merging

#: Suffixes shorter than this aren't indexed.
LEAST_SUFFIX = 3
#: A suffix of more classes than this is refined, and then left to the keys of ``_candidates``.
MOST_PLAIN = 40
#: Least ratios of the longest common subsequence: of a word, of a person's word, of words run together.
LEAST_WORD, LEAST_PERSON, LEAST_GIVEN, LEAST_JOINED = 0.75, 0.84, 0.75, 0.88

# How lines of business are written, and words that say nothing.
BUSINESS = """biosciences=biosci bioscience=biosci biosci=biosci sciences=biosci science=biosci
biotechnology=biotech biotechnologies=biotech biotech=biotech biotechnol=biotech
therapeutics=ther therapeutic=ther therap=ther ther=ther
pharmaceuticals=pharm pharmaceutical=pharm pharmaceutica=pharm pharma=pharm pharm=pharm pharms=pharm
laboratories=lab laboratory=lab labs=lab lab=lab laboratoires=lab laboratorios=lab
medicines=med medicine=med medical=med med=med medizinische=med
genetics=gen genetic=gen gen=gen genomics=genom
nucleic=nucl nucl=nucl acids=acid acid=acid
technologies=tech technology=tech technol=tech tech=tech
research=res res=res forschung=res
institute=inst institut=inst institution=inst inst=inst instituto=inst istituto=inst
university=univ universitat=univ universite=univ universidad=univ universidade=univ universita=univ univ=univ
hospital=hosp hospitals=hosp hosp=hosp childrens=child child=child children=child
biologics=biol biologic=biol biol=biol biologicals=biol
college=coll coll=coll foundation=found trust=trust center=centre centre=centre ctr=centre holdings=hold group=group"""
LEGAL = "ltd limited inc incorporated llc gmbh ag sa bv nv plc co company corp corporation as ab oy spa srl kk kg lp llp sarl pty"
SILENT = "the of and for de der die das la le du del di et und dr prof mr mrs ms"
# Short forms of given names.
SHORT = """bill=william billy=william will=william willy=william wally=walter walt=walter bob=robert bobby=robert rob=robert rick=richard
dick=richard rich=richard rico=ricardo lalo=eduardo ed=edward eddie=edward ted=edward ned=edward betty=elizabeth liz=elizabeth beth=elizabeth
lizzie=elizabeth nell=eleanor nellie=eleanor ellie=eleanor nora=eleanor becky=rebecca becca=rebecca freddie=winifred winnie=winifred
paco=francisco pancho=francisco curro=francisco bobbie=roberta robbie=roberta thea=dorothea,theodora dora=dorothea,theodora dolly=dorothea
dot=dorothea dottie=dorothea mina=wilhelmina minnie=wilhelmina willa=wilhelmina billie=wilhelmina sasha=alexander alex=alexander sandy=alexander
alec=alexander xander=alexander peggy=margaret maggie=margaret meg=margaret madge=margaret greta=margaret josie=josephine jo=josephine
posy=josephine kate=katherine kitty=katherine kathy=katherine katie=katherine kay=katherine sue=susannah susie=susannah sukey=susannah
suki=susannah hans=johannes hannes=johannes jan=johannes jo=josephine jim=james jimmy=james jack=john johnny=john joe=joseph tom=thomas
tommy=thomas mike=michael mick=michael tony=anthony dave=david dan=daniel sam=samuel ben=benjamin charlie=charles chuck=charles harry=henry
hank=henry steve=stephen chris=christopher nick=nicholas pete=peter andy=andrew matt=matthew greg=gregory jeff=jeffrey jerry=gerald
larry=lawrence pepe=jose nacho=ignacio manolo=manuel lola=dolores pilar=pilar fritz=friedrich heinz=heinrich gretchen=margaret lisa=elizabeth zanna=susannah fifi=josephine sanna=susannah"""
_BUSINESS = dict(x.split("=") for x in BUSINESS.split())
_LEGAL, _SILENT = set(LEGAL.split()), set(SILENT.split())
_SHORT: dict[str, tuple[str, ...]] = {}
for _x in SHORT.split():
    _k, _v = _x.split("=")
    _SHORT[_k] = tuple(dict.fromkeys((*_SHORT.get(_k, ()), *_v.split(","))))
_GIVEN = {v for forms in _SHORT.values() for v in forms}
_TAG = re.compile(r"\s*\[[A-Za-z]{2}\]\s*$")
_DOTTED = re.compile(r"\b(?:[a-z]\.){2,}|\b(?:[a-z]/)+[a-z]\b")
_WORDS = re.compile(r"[a-z0-9]+\.?|[^\W_]+")


def fold(text: str) -> str:
    """Plain form in lower case without accents."""
    text = unicodedata.normalize("NFD", plain(text).lower())
    return "".join(c for c in text if not unicodedata.combining(c)).replace("’", "").replace("'", "")


def parse(name: str) -> tuple[str, list[str], str, str]:
    """``(kind, words, business, initials)`` of a name.

    ``kind`` is ``o`` for an organisation and ``p`` for a person. ``words`` are distinctive, an
    abbreviated one ends in a dot. ``business`` has the stems of the line of business in
    alphabetical order. Blank names and names without letters have no words.
    """
    tag_free = name
    while (m := _TAG.search(tag_free)) and m.start() > 0:
        tag_free = tag_free[: m.start()]
    text = fold(tag_free).replace("bio-", "bio").replace("bio sci", "biosci").replace("bio tech", "biotech")
    # Dotted legal forms (l.l.c., g.m.b.h., b.v., a/s) are words, dotted initials are not.
    legal = False

    def dotted(m: re.Match) -> str:
        nonlocal legal
        word = m.group().replace(".", "").replace("/", "")
        if word in _LEGAL:
            legal = True
            return " "
        return " " + " ".join(word) + " "

    comma = text.find(",")
    text = _DOTTED.sub(dotted, text)
    words, business, initials = [], set(), []
    for token in _WORDS.findall(text):
        bare = token.rstrip(".")
        if bare in _BUSINESS:
            business.add(_BUSINESS[bare])
        elif bare in _SILENT and (len(bare) > 1 or not token.endswith(".")):
            continue
        elif bare in _LEGAL and (len(bare) > 2 or legal or business):
            legal = True
        elif len(bare) == 1:
            initials.append(bare)
        elif bare in _LEGAL and len(words) >= 2:
            legal = True
        else:
            words.append(token if token.endswith(".") and len(bare) <= 5 else bare)
    if business or legal or len(words) > 3:
        return "o", words, " ".join(sorted(business)), ""
    if not words:
        return "p", [], "", "".join(initials)
    return "p", [w.rstrip(".") for w in words], "", "".join(initials)


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, by bit vectors."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    """Twice the longest common subsequence over both lengths."""
    if a == b:
        return 1.0
    return 2 * lcs(a, b) / (len(a) + len(b)) if a or b else 1.0


def _word_fits(a: str, b: str, least: float) -> bool:
    if a == b:
        return True
    if a.endswith(".") or b.endswith("."):
        x, y = a.rstrip("."), b.rstrip(".")
        return (x if len(x) < len(y) else y) == (y if len(x) < len(y) else x)[: min(len(x), len(y))]
    return 2 * min(len(a), len(b)) / (len(a) + len(b)) >= least and ratio(a, b) >= least


def one_slip(a: str, b: str) -> bool:
    """Whether one letter left out, added, changed or swapped with its neighbour makes ``b`` of ``a``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    if len(a) < len(b):
        return a[n:] == b[n + 1 :]
    return a[n + 1 :] == b[n + 1 :] or (a[n : n + 2] == b[n : n + 2][::-1] and a[n + 2 :] == b[n + 2 :])


def _person_word_fits(a: str, b: str, least: float) -> bool:
    """By the ratio; then exactly: names two slips apart, and known given names that differ, are different names."""
    return a == b or not (a in _GIVEN and b in _GIVEN) and _word_fits(a, b, least) and one_slip(a, b)


def given_forms(word: str) -> tuple[str, ...]:
    """A given name and the ones it may be short for."""
    return (word, *_SHORT.get(word, ()))


def _given_fits(a: str, b: str) -> bool:
    """Equal up to a short form or a slip of the pen; two known names that differ never fit."""
    return any(_person_word_fits(x, y, LEAST_GIVEN) for x in given_forms(a) for y in given_forms(b))


def _paired(a: list[str], b: list[str], taken: tuple[int, int] | None = None) -> bool:
    """Whether the words of ``a`` can be paired with those of ``b``, as many, so that all fit; ``taken`` are paired already.

    Augmenting paths: polynomial in the number of words.
    """
    fits: dict[int, list[int]] = {}
    free = [j for j in range(len(b)) if taken is None or j != taken[1]]
    for i in range(len(a)):
        if taken is None or i != taken[0]:
            # Equal words first: as a rule they are the pairing.
            fits[i] = sorted((j for j in free if _word_fits(a[i], b[j], LEAST_WORD)), key=lambda j: a[i] != b[j])
            if not fits[i]:
                return False
    of: dict[int, int] = {}

    def place(i: int, seen: set[int]) -> bool:
        for j in fits[i]:
            if j not in seen:
                seen.add(j)
                if j not in of or place(of[j], seen):
                    of[j] = i
                    return True
        return False

    return all(place(i, set()) for i in fits)


def same_organisation(a: tuple, b: tuple) -> bool:
    """Whether two parses of kind ``o`` name one organisation.

    As many words: all can be paired, one pair closely. A word less: one word is two of the others
    run together, and the rest can be paired.
    """
    words_a, words_b = a[0], b[0]
    if a[1] != b[1] or not words_a or not words_b:
        return False
    if len(words_a) == len(words_b):
        if len(words_a) == 1:
            return _word_fits(words_a[0], words_b[0], LEAST_PERSON)
        close = sorted(((i, j) for i, x in enumerate(words_a) for j, y in enumerate(words_b) if _close(x, y)), key=lambda p: words_a[p[0]] != words_b[p[1]])
        return any(_paired(words_a, words_b, p) for p in close)
    few, many = (words_a, words_b) if len(words_a) < len(words_b) else (words_b, words_a)
    if len(many) - len(few) != 1 or any(w.endswith(".") for w in many):
        return False
    for i, word in enumerate(few):
        for j, x in enumerate(many):
            for k, y in enumerate(many):
                if j != k and 2 * min(len(word), len(x) + len(y)) >= LEAST_JOINED * (len(word) + len(x) + len(y)) and ratio(word, x + y) >= LEAST_JOINED:
                    if _paired(few[:i] + few[i + 1 :], [w for n, w in enumerate(many) if n not in (j, k)]):
                        return True
    return False


def _close(a: str, b: str) -> bool:
    """Whether two words fit and are alike beyond doubt."""
    return a == b or 2 * min(len(a), len(b)) / (len(a) + len(b)) >= LEAST_PERSON and ratio(a, b) >= LEAST_PERSON and _word_fits(a, b, LEAST_WORD)


def same_person(a: tuple, b: tuple) -> str:
    """``strong``, ``weak`` (initials only) or empty for two parses of kind ``p``."""
    (words_a, initials_a, country_a), (words_b, initials_b, country_b) = (a[0], a[2], a[3]), (b[0], b[2], b[3])
    if country_a and country_b and country_a != country_b:
        return ""
    if len(words_a) == 2 and len(words_b) == 2:
        if initials_a and initials_b and initials_a[0] != initials_b[0]:
            return ""
        for x, y in (words_b, words_b[::-1]):
            if (_person_word_fits(words_a[0], x, LEAST_PERSON) and _given_fits(words_a[1], y)) or (_given_fits(words_a[0], x) and _person_word_fits(words_a[1], y, LEAST_PERSON)):
                return "strong"
        return ""
    if len(words_a) == 1 and len(words_b) == 1:
        if not initials_a or not initials_b or not _person_word_fits(words_a[0], words_b[0], LEAST_PERSON) or initials_a[0] != initials_b[0]:
            return ""
        if len(initials_a) > 1 and len(initials_b) > 1:
            return "strong" if initials_a == initials_b else ""
        return "strong" if initials_a == initials_b and len(initials_a) > 1 else "weak"
    if {len(words_a), len(words_b)} == {1, 2}:
        (short, short_initials), (full, full_initials) = ((words_a[0], initials_a), (words_b, initials_b)) if len(words_a) == 1 else ((words_b[0], initials_b), (words_a, initials_a))
        if not short_initials:
            return ""
        if len(short_initials) > 1 and full_initials and short_initials[1] != full_initials[0]:
            return ""
        for surname, given in (full, full[::-1]):
            if _person_word_fits(short, surname, LEAST_PERSON) and any(g[0] == short_initials[0] for g in given_forms(given)):
                return "weak"
    return ""


def suffixes(kind: str, words: list[str], business: str = "", initials: str = "") -> list[tuple[str, str]]:
    """Every indexed suffix, with the fields that refine it if it is too common."""
    out = []
    for i, word in enumerate(words):
        if word.endswith("."):
            continue
        if kind == "o":
            fields = [f"{business}|{len(words)}"]
        else:
            others = [f[0] for n, w in enumerate(words) if n != i for f in given_forms(w)] or [initials[:1]]
            fields = list(dict.fromkeys(others))
        for form in given_forms(word) if kind == "p" else (word,):
            out += [(form[-n:], f) for n in range(min(LEAST_SUFFIX, len(form)), min(len(form), 12) + 1) for f in fields]
    return out


PARSED = "name_id long, kind string, words array<string>, business string, initials string, country string"


def parsed(df: DataFrame, key: str, name: str, country: str) -> DataFrame:
    """``name_id``, ``kind``, ``words``, ``business``, ``initials``, ``country`` of every name with words."""
    source = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{name}`").alias("name"), F.upper(F.trim(F.col(f"`{country}`"))).alias("country")).where("name IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(i, *parse(n), c or "") for i, n, c in zip(*(x.to_pylist() for x in batch.columns))]
            rows = [r for r in rows if r[2]]
            columns = list(zip(*rows)) if rows else [[]] * 6
            types = [pa.int64(), pa.string(), pa.list_(pa.string()), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[x.split()[0] for x in PARSED.split(", ")])

    return source.mapInArrow(run, PARSED)


def classes_of(names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Names of one parse as a class: ``(members, classes)``.

    ``members``: ``name_id``, ``class_id``; ``classes``: ``class_id`` and the parse. Persons of one
    parse from different countries are different classes, those of unknown country too.
    """
    signature = F.concat_ws("\x1f", "kind", F.array_join(F.array_sort("words"), " "), "business", "initials", F.when(F.col("kind") == "p", F.col("country")).otherwise(""))
    rows = names.withColumn("signature", signature)
    classes = rows.groupBy("signature").agg(
        F.min("name_id").alias("class_id"), *[F.min(c).alias(c) for c in ("kind", "words", "business", "initials")], F.max("country").alias("country")
    )
    members = rows.select("name_id", "signature").join(merging(classes.select("signature", "class_id")), "signature").select("name_id", "class_id")
    return members, classes.drop("signature")


def _blocked(classes: DataFrame) -> DataFrame:
    """Rows of ``key`` (the block), ``suffix`` and the class, for blocks of two to MOST_PLAIN classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, made = [], []
            d = batch.to_pydict()
            for i, own in enumerate(zip(d["kind"], d["words"], d["business"], d["initials"])):
                fields: dict[str, list[str]] = {}
                for suffix, f in dict.fromkeys(suffixes(*own)):
                    fields.setdefault(suffix, []).append(f)
                at += [i] * len(fields)
                made += fields.items()
            columns = list(zip(*made)) if made else [[], []]
            types = (pa.string(), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([d["class_id"][i] for i in at], pa.int64()), pa.array([d["kind"][i] for i in at], pa.string()), *(pa.array(c, t) for c, t in zip(columns, types))], names=["class_id", "kind", "suffix", "fields"]
            )

    own = classes.select("class_id", "kind", "words", "business", "initials")
    # A class has a suffix once, whatever the number of its fields.
    rows = own.mapInArrow(run, "class_id long, kind string, suffix string, fields array<string>")
    sizes = rows.groupBy("kind", "suffix").agg(F.count("*").alias("n")).where("n > 1")
    plain = F.concat_ws("|", "kind", "suffix")
    keys = F.when(F.col("n") <= MOST_PLAIN, F.array(plain)).otherwise(F.transform("fields", lambda f: F.concat_ws("|", plain, F.lit("+"), f)))
    keyed = rows.join(merging(sizes), ["kind", "suffix"]).select(F.explode(keys).alias("key"), "suffix", "class_id")
    kept = keyed.groupBy("key").agg(F.count("*").alias("n")).where((F.col("n") > 1) & (F.col("n") <= MOST_PLAIN)).select("key")
    parses = classes.select("class_id", "kind", "words", "business", "initials", "country")
    return keyed.join(merging(kept), "key").join(merging(parses), "class_id")


def _links(blocked: DataFrame) -> DataFrame:
    """``a``, ``b``, ``how`` of the classes that name one entity."""

    def compare(suffix: str, group: list[tuple]) -> Iterator[tuple[int, int, str]]:
        n = len(suffix)
        # The letters before the suffix: equal ones mean a longer suffix in common, whose block has this pair.
        before = []
        for _, kind, words, _, _, _ in group:
            forms = [f for w in words if not w.endswith(".") for f in (given_forms(w) if kind == "p" else (w,)) if f.endswith(suffix)]
            before.append({f[-n - 1] if len(f) > n and n < 12 else "" for f in forms})
        for i, (a, kind, words_a, business_a, initials_a, country_a) in enumerate(group):
            left = (words_a, business_a, initials_a, country_a)
            for j in range(i):
                b, kind_b, words_b, business_b, initials_b, country_b = group[j]
                if kind != kind_b or business_a != business_b or a == b:
                    continue
                if before[i] == before[j] and len(before[i]) == 1 and "" not in before[i]:
                    continue
                right = (words_b, business_b, initials_b, country_b)
                how = ("strong" if same_organisation(left, right) else "") if kind == "o" else same_person(left, right)
                if how:
                    yield (min(a, b), max(a, b), how)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        suffix, group = "", []
        for batch in batches:
            out: list[tuple[int, int, str]] = []
            for place, s, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if place == 1:
                    if len(group) > 1:
                        out.extend(compare(suffix, group))
                    suffix, group = s, []
                group.append(tuple(row))
            yield _link_batch(out)
        if len(group) > 1:
            yield _link_batch(list(compare(suffix, group)))

    # The window is what guarantees that a block is in one partition, in order: a mere repartition
    # below a Python stage may be planned away. Its first row of a block is at place 1.
    place = F.row_number().over(W.partitionBy("key").orderBy("class_id", "suffix"))
    rows = blocked.select(place.alias("place"), "suffix", "class_id", "kind", "words", "business", "initials", "country")
    return rows.mapInArrow(run, "a long, b long, how string").distinct()


#: ``rest`` is the only other word of an anchor, in full; ``own`` marks the key that is the whole word.
KEYS = "class_id long, key string, anchor string, rest string, own boolean, active boolean"
#: A longer word is found by one of its pieces instead of by its subsequences.
MOST_SUBSEQUENCES = 14

@lru_cache(maxsize=10_000)
def _least_common(a: int, b: int, least: float) -> int:
    """Least length of the common subsequence that gives words of these lengths the ratio ``least``."""
    return next(n for n in range(min(a, b) + 2) if n > min(a, b) or 2 * n / (a + b) >= least)


@lru_cache(maxsize=50_000)
def shortened(word: str, most: int) -> tuple[str, ...]:
    """The word and what is left of it when up to ``most`` letters are left out."""
    return tuple(dict.fromkeys("".join(c) for n in range(most + 1) if n < len(word) or not word for c in combinations(word, len(word) - n)))


@lru_cache(maxsize=50_000)
def subsequences(word: str, sizes: tuple[int, ...]) -> tuple[str, ...]:
    """What a word has in common, at least, with any word of ratio LEAST_PERSON whose length is one of ``sizes``."""
    size = len(word)
    lengths = {n for m in sizes if m <= MOST_SUBSEQUENCES and (n := _least_common(size, m, LEAST_PERSON)) <= min(size, m)}
    return tuple(dict.fromkeys(["".join(c) for n in sorted(lengths | {size}, reverse=True) for c in combinations(word, n)]))


@lru_cache(maxsize=1_000)
def pieces(size: int, least: float, most: int | None = None) -> list[tuple[int, int]]:
    """``(start, end)`` of the pieces of a word of this size, one more than letters may be missing or added.

    So any word of ratio ``least``, of up to ``most`` letters, holds at least one piece whole.
    """
    partners = [m for m in range(1, (most or 3 * size) + 1) if _least_common(size, m, least) <= min(size, m)]
    n = 1 + max((size + m - 2 * _least_common(size, m, least) for m in partners), default=0)
    return [(size * i // n, size * (i + 1) // n) for i in range(n)]


def probes(word: str, size: int, least: float, most: int | None = None) -> Iterator[tuple[int, str]]:
    """``(number, letters)`` where ``word`` may hold a piece of a word of ``size`` letters."""
    common = _least_common(len(word), size, least)
    if common > min(len(word), size):
        return
    for i, (start, end) in enumerate(pieces(size, least, most)):
        for at in range(max(0, start - (size - common)), min(len(word) - (end - start), start + len(word) - common) + 1):
            yield i, word[at : at + end - start]


def person_keys(words: list[str], initials: str) -> Iterator[tuple[str, str, str | None, bool, bool]]:
    """``(key, anchor, rest, own, active)``: two persons that ``same_person`` links have a key in common.

    Words one slip apart are equal once a letter of each is left out. Full names have keys of both
    words; a surname with initials has keys of the surname and the first initial, which full names
    have too, but passive: two full names aren't compared for these.
    """
    if len(words) == 1:
        for v in shortened(words[0], 1) if initials else ():
            yield f"i|{v}|{initials[0]}", words[0], None, v == words[0], True
    elif len(words) == 2:
        for surname, given in (words, words[::-1]):
            for initial in sorted({f[0] for f in given_forms(given)}):
                for v in shortened(surname, 1):
                    yield f"i|{v}|{initial}", surname, None, v == surname, False
        for x, y in {tuple(sorted(p)) for p in product(given_forms(words[0]), given_forms(words[1]))}:
            for v in shortened(x, 1):
                for w in shortened(y, 1):
                    yield "p|" + "|".join(sorted((v, w))), f"{x} {y}", None, (v, w) == (x, y), True


def _may_join(word: int, run: int) -> bool:
    """Whether a word and two others run together, of these lengths, can have the ratio LEAST_JOINED."""
    return _least_common(word, run, LEAST_JOINED) <= min(word, run)


def joined_keys(words: list[str], business: str, many: dict[int, list[int]], few: dict[int, list[int]]) -> Iterator[tuple[str, str, str | None, bool, bool]]:
    """Like ``organisation_keys`` for names of which one has a word more than the other.

    A name has the pieces of every two of its words run together, for names of a word less; ``many``
    has the lengths of these by the number of words, ``few`` those of single words: keys that no
    other name can have aren't made.
    """
    n = len(words)
    if n > 1 and not any(w.endswith(".") for w in words):
        for run in sorted({x + y for i, x in enumerate(words) for j, y in enumerate(words) if i != j}):
            if not any(_may_join(m, len(run)) for m in few.get(n - 1, ())):
                continue
            for i, (start, end) in enumerate(pieces(len(run), LEAST_JOINED)):
                yield f"j|{business}|{n}|{len(run)}|{i}|{run[start:end]}", "many", None, False, False
    for size in many.get(n + 1, ()):
        for i, v in sorted({x for word in words for x in probes(word, size, LEAST_JOINED)}):
            yield f"j|{business}|{n + 1}|{size}|{i}|{v}", "few", None, False, True


def organisation_keys(words: list[str], business: str, sizes: tuple[int, ...]) -> Iterator[tuple[str, str, str | None, bool, bool]]:
    """Like ``person_keys`` for ``same_organisation`` of as many words.

    One word of the two names has the ratio LEAST_PERSON (the *anchor*), so both hold one
    subsequence of the length that this takes. ``sizes`` has the lengths of words that occur.
    """
    for i, word in enumerate(words):
        rest = words[1 - i] if len(words) == 2 and not words[1 - i].endswith(".") else None
        tag = f"{len(words)}|{business}"
        for v in subsequences(word, sizes) if len(word) <= MOST_SUBSEQUENCES else (word,):
            yield f"o|{tag}|{v}", word, rest, v == word, True
        if len(word) > MOST_SUBSEQUENCES:
            for n, (start, end) in enumerate(pieces(len(word), LEAST_PERSON, len(word))):
                yield f"l|{tag}|{len(word)}|{n}|{word[start:end]}", word, rest, False, False
        for size in sizes:
            if size > MOST_SUBSEQUENCES and size >= len(word):
                for n, v in set(probes(word, size, LEAST_PERSON, size)):
                    yield f"l|{tag}|{size}|{n}|{v}", word, rest, False, True


def _candidates(classes: DataFrame) -> DataFrame:
    """``a`` < ``b``: every two classes that ``same_organisation`` or ``same_person`` may link, whatever the size of a block.

    A join of keys, without Python, in which large blocks may be split and spill.
    """
    # Bounded: lengths of words, and of two words, by the number of words.
    organisations = classes.where("kind = 'o'")
    sizes = tuple(sorted(r[0] for r in organisations.select(F.explode("words").alias("word")).select(F.length("word")).distinct().collect()))
    many: dict[int, list[int]] = {}
    long = F.transform("words", lambda w: F.length(w))
    pairs = F.explode(F.flatten(F.transform(long, lambda x, i: F.transform(F.filter(long, lambda y, j: i != j), lambda y: x + y)))).alias("length")
    for n, length in sorted(tuple(r) for r in organisations.where(F.size("words") > 1).select(F.size("words"), pairs).distinct().collect()):
        many.setdefault(n, []).append(length)
    few: dict[int, list[int]] = {}
    for n, length in sorted(tuple(r) for r in organisations.select(F.size("words"), F.explode(long)).distinct().collect()):
        few.setdefault(n, []).append(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.bool_(), pa.bool_()]
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = []
                for i, kind, words, business, initials in zip(*(c.to_pylist() for c in batch.slice(at, 500).columns)):
                    made = person_keys(words, initials) if kind == "p" else chain(organisation_keys(words, business, sizes), joined_keys(words, business, many, few))
                    rows += [(i, *k) for k in dict.fromkeys(made)]
                columns = list(zip(*rows)) if rows else [[]] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=[x.split()[0] for x in KEYS.split(", ")])

    made = classes.select("class_id", "kind", "words", "business", "initials").mapInArrow(run, KEYS)
    # Equal hashes of different keys only add a pair to compare.
    rows = made.select(F.xxhash64("key").alias("key"), "class_id", F.xxhash64("anchor").alias("anchor"), "rest", "own", "active")
    a, b = (rows.select("key", *[F.col(c).alias(f"{c}_{side}") for c in rows.columns if c != "key"]) for side in "ab")
    # Equal anchors are compared for the whole word only. The distance is never above that by the common subsequence.
    near = F.levenshtein("rest_a", "rest_b") <= (1 - LEAST_WORD) * (F.length("rest_a") + F.length("rest_b"))
    met = a.join(merging(b), "key").where("class_id_a < class_id_b AND (active_a OR active_b) AND (anchor_a <> anchor_b OR own_a AND own_b)").where(F.coalesce(near, F.lit(True)))
    return met.select(F.col("class_id_a").alias("a"), F.col("class_id_b").alias("b")).distinct()


def _exact_links(classes: DataFrame) -> DataFrame:
    """``a``, ``b``, ``how`` of all classes that name one entity."""
    own = ["kind", "words", "business", "initials", "country"]
    sides = [classes.select(F.col("class_id").alias(s), *[F.col(c).alias(f"{c}_{s}") for c in own]) for s in "ab"]
    pairs = _candidates(classes).join(merging(sides[0]), "a").join(merging(sides[1]), "b").where("kind_a = kind_b AND business_a = business_b")
    rest = [f"{c}_{s}" for s in "ab" for c in own[1:]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for a, b, kind, *parses in zip(*(c.to_pylist() for c in batch.columns)):
                left, right = parses[:4], parses[4:]
                how = ("strong" if same_organisation(left, right) else "") if kind == "o" else same_person(left, right)
                if how:
                    out.append((a, b, how))
            yield _link_batch(out)

    return pairs.select("a", "b", "kind_a", *rest).mapInArrow(run, "a long, b long, how string")


def _link_batch(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())], names=["a", "b", "how"])


def entities(df: DataFrame, key: str, name: str, country: str) -> DataFrame:
    """``name_id`` and ``entity_id`` (its smallest class) of every name.

    Null names, and names without a word, have no row. Names that nothing is linked to are
    entities of their own. Repeated names under other ids are one class.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    members, classes = classes_of(parsed(df, key, name, country))
    classes, members = classes.checkpoint(), members.checkpoint()
    links = _links(_blocked(classes)).unionByName(_exact_links(classes)).distinct().checkpoint()
    strong = components(links.where("how = 'strong'"))
    everyone = classes.join(merging(strong), F.col("class_id") == F.col("node"), "left").select(
        "class_id", F.coalesce("component", "class_id").alias("entity"), ((F.col("kind") == "p") & (F.size("words") == 1)).alias("initials_only")
    )
    # Initials: linked where all full names that they fit are one entity; failing any full name, to each other.
    both = links.where("how = 'weak'").select("a", "b").unionByName(links.where("how = 'weak'").select(F.col("b").alias("a"), F.col("a").alias("b")))
    of = everyone.select(F.col("class_id").alias("b"), F.col("entity").alias("entity_b"), F.col("initials_only").alias("bare_b"))
    bare_a = everyone.select(F.col("class_id").alias("a"), F.col("entity").alias("entity_a"), "initials_only").where("initials_only")
    fits = both.join(merging(bare_a), "a").join(merging(of), "b")
    full = fits.where("NOT bare_b").groupBy("entity_a").agg(F.min("entity_b").alias("low"), F.max("entity_b").alias("high"))
    sure = full.where("low = high").select(F.col("entity_a").alias("a"), F.col("low").alias("b"))
    fitting = [merging(full.select(F.col("entity_a").alias(e))) for e in ("entity_a", "entity_b")]
    bare = fits.where("bare_b").join(fitting[0], "entity_a", "left_anti").join(fitting[1], "entity_b", "left_anti")
    alone = bare.groupBy("entity_a").agg(F.min("entity_b").alias("low"), F.max("entity_b").alias("high")).where("low = high").select(F.col("entity_a").alias("a"), F.col("low").alias("b"))
    joined = components(sure.unionByName(alone))
    final = everyone.join(merging(joined), F.col("entity") == F.col("node"), "left").select("class_id", F.coalesce("component", "entity").alias("entity_id"))
    return members.join(merging(final), "class_id").select("name_id", "entity_id")


def entity_pairs(named: DataFrame) -> DataFrame:
    """Each pair of names of one entity: ``name_a`` < ``name_b``."""
    left = named.select(F.col("name_id").alias("name_a"), "entity_id")
    right = named.select(F.col("name_id").alias("name_b"), "entity_id")
    return left.join(merging(right), "entity_id").where("name_a < name_b").select("name_a", "name_b")
