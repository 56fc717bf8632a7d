"""Visually identical text with different characters: confusables skeletons and plain forms.

The *skeleton* decides which texts count as look-alikes: decompose, replace every character by its
prototype from the look-alike table, decompose again. Originals are grouped by equal skeletons.
The table holds the look-alikes of Latin letters and digits in the scripts that have many; what it
doesn't hold (most of some 6,000 pairs that are published) isn't recognised.

The *plain form* is the consistent form of a text: what an ordinary typist would have entered
for the same look. It differs from the skeleton in that letters stay in the script they are
meant in, which an exact check of each word and its neighbours decides; where these leave it open,
the originals of the same skeleton do.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Letters of one script that look like a letter of another, in pairs.
CYRILLIC_LATIN = "АA ВB ЕE ЅS ІI ЈJ КK МM НH ОO РP СC ТT УY ХX ԚQ ԜW аa еe ѕs іi јj оo рp сc уy хx ԁd һh ԛq ԝw"
GREEK_LATIN = "ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX οo νv"
#: Letters that look like Latin ones only at a glance; they count for the skeleton, never for the plain form.
ROUGH = "αa γy ιi κk ρp υu χx σo ωw ϲc ϳj ΙI ӏl Ӏl гr ѵv ѡw ıi ɪi ɩi ʏy ᴄc ᴏo ᴠv ᴡw ᴢz ꜱs ᴜu Ɩl ℮e"
#: Letters of other scripts, and phonetic ones, that have no place in a Latin word.
PHONETIC = "ɑa ɡg ⍺a ⍳i ⍴p"
ARMENIAN = "օo ոn սu հh զq ցg յj ՏS ՍU ՕO ԼL"
CHEROKEE = "ᎠD ᎡR ᎢT ᎥI ᎩY ᎪA ᎫJ ᎬE ᎳW ᎷM ᎻH ᏀG ᏂH ᏃZ ᏏB ᏒR ᏔW ᏕS ᏙV ᏚS ᏞL ᏟC ᏢP ᏦK ᏳG ᏴB"
COPTIC = "ⲟo ⲞO ⲥc ⲤC ⲣp ⲢP ⲭx ⲬX ⲨY ⲘM ⲚN ⲔK ⲎH ⲂB ⲦT ⲒI"
LISU = "ꓐB ꓑP ꓓD ꓔT ꓖG ꓗK ꓙJ ꓚC ꓜZ ꓝF ꓟM ꓠN ꓡL ꓢS ꓣR ꓦV ꓧH ꓪW ꓫX ꓬY ꓮA ꓰE ꓲI ꓳO ꓴU"
SYLLABICS = "ᑕC ᑌU ᗅA ᗞD ᕼH ᒍJ ᐯV ᖇR ᗷB ᑭP ᗰM ᙭X ᛕK"
#: Scripts whose digit zero is a ring.
RINGS = "DEVANAGARI BENGALI GURMUKHI GUJARATI ORIYA TAMIL TELUGU KANNADA MALAYALAM THAI LAO MYANMAR".split()
#: ASCII characters that look like others, and a letter that looks like two.
ASCII_ALIKE = "0O 1l Il |l `'"
WIDE_ALIKE = ("m", "rn")
#: Marks that look like an ASCII one.
HYPHENS = "‐- ‑- ‒- −- ﹣-"
PUNCTUATION = "’' ‘' ʼ' ′' “\" ”\" ″\" –- —- ․. ‚, ⁄/ ∕/ ∣| ǀ| ∶:"


def _pairs(text: str) -> dict[str, str]:
    return {pair[0]: pair[1] for pair in text.split(" ")}


_TO_LATIN = _pairs(CYRILLIC_LATIN) | _pairs(GREEK_LATIN)
_TO_CYRILLIC = {b: a for a, b in _pairs(CYRILLIC_LATIN).items() if "А" <= a <= "я"}
_HYPHEN = _pairs(HYPHENS)
#: Letters that a Latin word can't hold, with the Latin ones.
_FOREIGN = _pairs(" ".join((PHONETIC, ARMENIAN, CHEROKEE, COPTIC, LISU, SYLLABICS)))


def _prototype_table() -> dict[str, str]:
    """Every character of the tables with its prototype, which is one itself."""
    direct = _TO_LATIN | _FOREIGN | _pairs(ROUGH) | _HYPHEN | _pairs(PUNCTUATION) | _pairs(ASCII_ALIKE) | dict([WIDE_ALIKE])
    direct |= {unicodedata.lookup(f"{script} DIGIT ZERO"): "O" for script in RINGS}

    def last(c: str) -> str:
        to = direct.get(c, c)
        return c if to == c else "".join(map(last, to))

    return {c: last(c) for c in direct}


PROTOTYPES = _prototype_table()
_BLANKS_KEPT = "\t\n\r"


def _ignorable(c: str) -> bool:
    """Characters without a look of their own: format characters, joiners and variation selectors."""
    return unicodedata.category(c) == "Cf" or c == "͏" or "︀" <= c <= "️" or "᠋" <= c <= "᠍" or c in "ᅟᅠㅤﾠ"


@functools.lru_cache(maxsize=1 << 16)
def _decomposed(c: str) -> str:
    if _ignorable(c):
        return ""
    if c.isspace() and c not in _BLANKS_KEPT:
        return " "
    return unicodedata.normalize("NFKD", c)


def _prototypes(text: str) -> str:
    return "".join(PROTOTYPES.get(c, c) for c in text)


def skeleton(text: str) -> str:
    """The skeleton of ``text``: equal for texts that look alike by the table, idempotent.

    Case is kept, runs of blanks aren't merged. The skeleton is for comparison, not for reading:
    ``1``, ``I`` and ``l`` are one, and so are ``0`` and ``O``, ``m`` and ``rn``.
    """
    if text.isascii():
        return _prototypes(text)
    once = unicodedata.normalize("NFD", "".join(map(_decomposed, text)))
    return unicodedata.normalize("NFD", "".join(map(_decomposed, _prototypes(once))))


def _script(c: str) -> str:
    """L, C or G for Latin, Cyrillic and Greek letters, J for East Asian ones, else empty."""
    o = ord(c)
    if o < 0x250:
        return "L" if c.isalpha() else ""
    if 0x400 <= o < 0x530:
        return "C"
    if 0x370 <= o < 0x400:
        return "G" if c.isalpha() else ""
    if 0x3040 <= o < 0x3100 or 0x3400 <= o < 0xA000 or 0xAC00 <= o < 0xD7A4:
        return "J"
    return ""


@functools.lru_cache(maxsize=1 << 16)
def _unwidened(c: str) -> str:
    """The usual form of a full-width, half-width, ligated or styled character."""
    if _ignorable(c):
        return ""
    if c.isspace() and c not in _BLANKS_KEPT:
        return " "
    how = unicodedata.decomposition(c)
    if how.startswith(("<wide>", "<narrow>", "<font>")) or "ﬀ" <= c <= "ﬆ":
        return unicodedata.normalize("NFKC", c)
    return _HYPHEN.get(c, c)


_CJK_MARKS = "，；：！？（）．～"
_WORD = re.compile(r"[^\W_]+")


def _unspoofed(text: str, open_script: str = "") -> tuple[str, bool]:
    """``text`` with letters of the wrong script replaced word by word, and whether it says itself which script is meant.

    ``open_script`` (L or C) is that of the words of a text that doesn't.
    """
    certain = True
    words = list(_WORD.finditer(text))
    sure: list[str] = []
    for w in words:
        scripts = {_script(c) for c in w.group()} - {""}
        firm = {_script(c) for c in w.group() if c not in _TO_LATIN and (_script(c) != "L" or c not in _TO_CYRILLIC)} - {""}
        if "C" in firm and not firm & {"L"}:
            sure.append("C")
        elif "L" in firm or scripts == {"L"}:
            sure.append("L")
        elif "C" in scripts and "L" in scripts:
            sure.append("L" if any(c in "ѕіјЅІЈ" for c in w.group()) else "?")
        elif scripts & {"C", "G"}:
            sure.append("G" if firm == {"G"} or (len(w.group()) == 1 and w.group() == "ν") else "?")
        else:
            sure.append("")
    out, at = [], 0
    for i, w in enumerate(words):
        word, kind = w.group(), sure[i]
        if word.isascii() and kind != "C":
            continue
        if kind == "?":
            # The nearest word whose script is certain decides; an earlier one of two as near.
            near = next((sure[j] for step in range(1, len(words)) for j in (i - step, i + step) if 0 <= j < len(words) and sure[j] in ("L", "C", "G")), "")
            certain = certain and near != ""
            kind = near or open_script or ("L" if _script(word[0]) != "C" else "C")
        if kind == "C":
            new = "".join(_TO_CYRILLIC.get(c, c) if _script(c) == "L" else c for c in word)
        elif kind == "L":
            new = "".join(_TO_LATIN.get(c, c) if _script(c) in ("C", "G") else _FOREIGN.get(c, c) for c in word)
        else:
            continue
        if new != word:
            out += [text[at : w.start()], new]
            at = w.end()
    return ("".join(out) + text[at:] if out else text), certain


def plain(text: str) -> str:
    """The plain form of ``text``.

    Full-width, half-width and ligated forms become ordinary ones, unusual blanks a space,
    invisible characters vanish, accents are composed, and letters of another script inside a
    word become those of the word. Full-width marks next to East Asian letters, tabs, line
    breaks and words in any script of their own stay. Idempotent; an empty text is plain.
    """
    return plain_forms(text)[0]


def plain_forms(text: str) -> tuple[str, ...]:
    """The plain form of ``text``; where the text leaves open whether it is Latin or Cyrillic, the likelier one and the other."""
    if text.isascii():
        return (text,)
    wide = any(c in _CJK_MARKS for c in text)
    if wide and any(_script(c) == "J" for c in text):
        kept = []
        for i, c in enumerate(text):
            beside = text[max(0, i - 1)] + text[min(len(text) - 1, i + 1)]
            kept.append(c if c in _CJK_MARKS and any(_script(b) == "J" for b in beside) else _unwidened(c))
        form = "".join(kept)
    else:
        form = "".join(map(_unwidened, text))
    form = unicodedata.normalize("NFC", form)
    made, certain = _unspoofed(form)
    return (made,) if certain else tuple(dict.fromkeys((made, _unspoofed(form, "L")[0], _unspoofed(form, "C")[0])))


def is_disguised(text: str) -> bool:
    """Whether ``text`` differs from the plain form that has its skeleton."""
    if text.isascii():
        return False
    form = plain(text)
    return form != text and skeleton(form) == skeleton(text)


def _values(df: DataFrame, fields: list[str]) -> DataFrame:
    """``field``, ``value``, ``n``: every different value with its number of rows, counted before anything is shuffled."""
    cells = df.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"`{f}`").alias("value")) for f in fields])).alias("c")).select("c.*")
    return cells.where("value IS NOT NULL").groupBy("field", "value").agg(F.count("*").alias("n"))


_BEYOND_ASCII = r"[^\x00-\x7f]"


def _ascii_skeleton(value: Column) -> Column:
    """The skeleton of an ASCII value, in the JVM."""
    pairs = _pairs(ASCII_ALIKE)
    return F.replace(F.translate(value, "".join(pairs), "".join(pairs.values())), F.lit(WIDE_ALIKE[0]), F.lit(WIDE_ALIKE[1]))


def _grouped(counted: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Originals with their skeletons: those beyond ASCII, with ``forms`` (possible plain forms), and the ASCII ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column(1).to_pylist()
            skeletons = [skeleton(v) for v in values]
            # A form that doesn't look the same is none.
            forms = [tuple(f for f in plain_forms(v) if f == v or skeleton(f) == s) or (v,) for v, s in zip(values, skeletons)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(skeletons, pa.string()), pa.array(forms, pa.list_(pa.string()))], names=["field", "value", "n", "skeleton", "forms"])

    beyond = counted.where(F.col("value").rlike(_BEYOND_ASCII)).mapInArrow(run, "field string, value string, n long, skeleton string, forms array<string>")
    ascii_only = counted.where(~F.col("value").rlike(_BEYOND_ASCII)).select("field", "value", "n", _ascii_skeleton(F.col("value")).alias("skeleton"))
    return beyond, ascii_only


def _settled(counted: DataFrame) -> DataFrame:
    """``field``, ``value``, ``skeleton``, ``plain_form`` of every original beyond ASCII.

    Where a value leaves its script open, the possible form that most rows of its group (originals
    of equal skeleton) have, certain ones and ASCII, decides; failing any, the likelier form.
    """
    beyond, ascii_only = _grouped(counted)
    is_open = F.size("forms") > 1
    certain = beyond.where(~is_open).select("field", "skeleton", F.get("forms", F.lit(0)).alias("form"), "n").unionByName(ascii_only.select("field", "skeleton", F.col("value").alias("form"), "n"))
    # One row per possible form of an open value asks; groups without open values drop out in the join.
    asking = beyond.where(is_open).select("field", "value", "skeleton", F.posexplode("forms").alias("at", "form"))
    votes = certain.join(asking.select("field", "skeleton").distinct(), ["field", "skeleton"], "left_semi").groupBy("field", "skeleton", "form").agg(F.sum("n").alias("votes"))
    decided = asking.join(votes, ["field", "skeleton", "form"], "left").groupBy("field", "value", "skeleton").agg(
        F.max_by("form", F.struct(F.coalesce("votes", F.lit(0)).alias("v"), (-F.col("at")).alias("at"))).alias("plain_form")
    )
    return beyond.where(~is_open).select("field", "value", "skeleton", F.get("forms", F.lit(0)).alias("plain_form")).unionByName(decided)


def disguised(df: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """``keys``, ``field``, ``plain_form``, ``skeleton`` of every value that isn't in its plain form.

    Different values are grouped by skeleton and settled once, then brought back to their rows. Null,
    empty and ASCII values are plain. Repeated rows each have their own row; other columns are
    ignored. A value that differs from its plain form in more than its look is no case.
    """
    cases = _settled(_values(df, fields)).where("plain_form <> value")
    cells = F.explode(F.array_compact(F.array(*[F.when(F.col(f"`{f}`").rlike(_BEYOND_ASCII), F.struct(F.lit(f).alias("field"), F.col(f"`{f}`").alias("value"))) for f in fields])))
    rows = df.select(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)], cells.alias("c")).select(*[f"k{i}" for i in range(len(keys))], "c.field", "c.value")
    return rows.join(cases, ["field", "value"]).select(*[F.col(f"k{i}").alias(k) for i, k in enumerate(keys)], "field", "plain_form", "skeleton")


def look_alikes(df: DataFrame, fields: list[str]) -> DataFrame:
    """The values of ``fields`` grouped by equal skeleton, groups of two or more originals only.

    One row per group: ``field``, ``skeleton``, ``n_forms`` (different originals), ``n_rows`` and
    ``plain_form``, the plain form of the most frequent original (of the smallest among those as
    frequent). Values are counted before anything is shuffled, so a value in a third of all rows
    is one partial count per partition; skeletons are made of distinct values only.
    """
    counted = _values(df, fields)
    beyond, ascii_only = _settled(counted), _grouped(counted)[1]
    forms = beyond.join(counted, ["field", "value"]).unionByName(ascii_only.select("field", "value", "skeleton", F.col("value").alias("plain_form"), "n"))
    grouped = forms.groupBy("field", "skeleton").agg(
        F.count("*").alias("n_forms"),
        F.sum("n").alias("n_rows"),
        F.min_by("plain_form", F.struct((-F.col("n")).alias("n"), F.col("value"))).alias("plain_form"),
    )
    return grouped.where("n_forms > 1")
