import random
import time
from itertools import combinations, permutations, product

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataline.llm import bpe, langid, names, packing, pii, pii_examples, queries, skeleton, survivors
from strataline.llm.components import components

# ---------------------------------------------------------------- skeletons


@pytest.mark.parametrize(
    "text,plain",
    [
        ("Ｆｕｌｌ ｗｉｄｔｈ", "Full width"), ("soft­hyphen", "softhyphen"), ("a b", "a b"), ("a　b", "a b"), ("café", "café"), ("ﬁne", "fine"),
        ("ｻｲﾚﾝｼﾝグ", "サイレンシング"), ("ﾊﾞﾗ", "バラ"), ("Mеdicаl", "Medical"), ("Βοkkatkat", "Bokkatkat"), ("лeчeния", "лечения"), ("a‐b", "a-b"), ("x͏​y", "xy"),
        ("A；B｜C", "A;B|C"), ("与с with с siRNА", None),
    ],
)
def test_plain_form(text, plain):
    assert skeleton.is_disguised(text)
    form = skeleton.plain(text)
    assert plain is None or form == plain
    assert skeleton.plain(form) == form and skeleton.skeleton(form) == skeleton.skeleton(text)
    assert skeleton.skeleton(skeleton.skeleton(text)) == skeleton.skeleton(text)


@pytest.mark.parametrize("text", ["", "plain", "TNF-α and β-Globin with ΔG", "лечение с помощью", "用于抑制角膜中基因，方法", "がサイレンシング、", "Größe é", "a\tb\nc", "Способ с ΔG"])
def test_no_case(text):
    assert not skeleton.is_disguised(text) and skeleton.plain(text) == text


@pytest.mark.parametrize(
    "a,b",
    [
        ("paypal", "paypa1"), ("Illinois", "lllinois"), ("0xford", "Oxford"), ("ɡene", "gene"), ("ɑ-", "a-"), ("Ꭰ", "D"), ("օ", "o"), ("modern", "modem"), ("ı", "i"), ("ꓢꓔꓐ", "STB"), ("Ⲟⲥ", "Oc"),
        ("௦", "0"), ("Ｉ", "1"), ("𝐀𝟎", "AO"), ("Α|", "Al"),
    ],
)
def test_look_alikes_have_equal_skeletons(a, b):
    assert skeleton.skeleton(a) == skeleton.skeleton(b) and skeleton.skeleton(skeleton.skeleton(a)) == skeleton.skeleton(a)


def test_different_texts_have_different_skeletons():
    for a, b in [("Medical", "Magical"), ("TNF-α", "TNF-β"), ("лес", "лис"), ("cat", "cut"), ("A", "a"), ("o", "O"), ("é", "è")]:
        assert skeleton.skeleton(a) != skeleton.skeleton(b)


def test_foreign_letters_in_latin_words():
    assert skeleton.plain("ɡene оf Ꭰrosophila") == "gene of Drosophila" and skeleton.plain("Yıldız") == "Yıldız" and skeleton.plain("հայոց") == "հայոց"


def test_open_scripts_are_settled_by_the_group(spark):
    # All letters of these words look like letters of both scripts; the rest of the group says which are meant.
    rows = [(1, "ОАО"), (2, "ОAО"), (3, "OAO"), (4, "OAO"), (5, "СОХА"), (6, "COXА"), (7, "СОХА​"), (8, "СОХА")]
    df = spark.createDataFrame(rows, "seq long, title string")
    got = {r.seq: r.plain_form for r in skeleton.disguised(df, ["seq"], ["title"]).collect()}
    assert got[1] == "OAO" and got[2] == "OAO" and got[7] == "СОХА" and 5 not in got and 3 not in got
    assert got[6] in ("COXA", "СОХА")


def test_disguised_frames(spark):
    rows = [(1, "Mеd", "ok", "a"), (1, "Mеd", "ok", "b"), (None, None, "a b", "c"), (3, "", None, "d"), (4, "é" * 60_000 + "​", None, "e")]
    df = spark.createDataFrame(rows, "seq long, title string, applicant string, value string")
    got = sorted((r.seq or 0, r.field) for r in skeleton.disguised(df, ["seq"], ["title", "applicant"]).collect())
    assert got == [(0, "applicant"), (1, "title"), (1, "title"), (4, "title")]
    assert skeleton.disguised(df.limit(0), ["seq"], ["title"]).count() == 0
    groups = skeleton.look_alikes(spark.createDataFrame([("Mеd",), ("Med",), ("Med",), ("x",), (None,)], "title string"), ["title"]).collect()
    assert [(g.skeleton, g.n_forms, g.n_rows, g.plain_form) for g in groups] == [("Med", 2, 3, "Med")]


# ---------------------------------------------------------------- encoding


@pytest.fixture(scope="module")
def encoder():
    with open(bpe.tokenizer_path(), "rb") as f:
        return bpe.Encoder(f.read())


def test_ids_equal_the_reference_tokenizer(encoder):
    tokenizers = pytest.importorskip("tokenizers")
    reference = tokenizers.Tokenizer.from_file(bpe.tokenizer_path())
    reference.encode_special_tokens = True
    r = random.Random(5)
    letters = "ab cdeéßñ 日本語 1234 \n\t<|endoftext|> thethingstion--==  😀ЖЮ​\x00"
    texts = ["".join(r.choice(letters) for _ in range(r.randrange(90))) for _ in range(3000)]
    texts += ["".join(r.choice("aeinotsrhl") for _ in range(r.randrange(70))) for _ in range(3000)] + ["a" * 4000, "-" * 3000, "ab" * 3000, "<|endoftext|>"]
    for text, want in zip(texts, reference.encode_batch(texts, add_special_tokens=False)):
        ids = encoder.encode(text)
        assert ids == want.ids, text
        assert encoder.decode(ids) == text


def test_border_table_against_merging(encoder):
    def merged(data):
        parts = [encoder.single[b] for b in data]
        while len(parts) > 1:
            rule = min(((encoder.order.get((a, b), 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))))
            if rule[0] == 1 << 60:
                break
            i = rule[1]
            parts[i : i + 2] = [encoder.ids[b"".join(encoder.bytes[encoder.offsets[p] : encoder.offsets[p + 1]] for p in parts[i : i + 2])]]
        return parts

    r = random.Random(3)
    pool = [i for e, i in encoder.ids.items() if 0 < len(e) < 9]
    for _ in range(1500):
        a, b = r.choice(pool), r.choice(pool)
        data = b"".join(encoder.bytes[encoder.offsets[p] : encoder.offsets[p + 1]] for p in (a, b))
        assert encoder.fits(a, b) == (merged(data) == [a, b])


def test_encoded_frames(spark, encoder):
    df = spark.createDataFrame([(1, "Hello there", 0), (2, None, 0), (3, "", 0), (None, "Hello there", 0), (5, "é" * 50_000, 0)], "doc_id long, text string, ids int")
    got = {r.doc_id: r.ids for r in bpe.encoded(df, "doc_id", "text").collect()}
    assert got[2] == [] and got[3] == [] and got[1] == got[None] == encoder.encode("Hello there") and encoder.decode(got[5]) == "é" * 50_000
    assert bpe.encoded(df.limit(0), "doc_id", "text").count() == 0


# ---------------------------------------------------------------- packing


def check_packing(rows, items, capacity, segments, loss_share=packing.LOSS_SHARE):
    per, seen = {}, {}
    for r in rows:
        per.setdefault(r.container_id, []).append(r)
        seen.setdefault(r.doc_id, []).append((r.part, r.first_token, r.n_tokens, r.loss_tokens))
    for own in per.values():
        assert sum(r.n_tokens for r in own) <= capacity and len(own) <= segments
        assert sum(r.loss_tokens for r in own) <= int(capacity * loss_share) or sum(r.loss_tokens > 0 for r in own) == 1
        assert sorted(r.slot for r in own) == list(range(len(own)))
    assert set(seen) == {d for d, _, _ in items}
    for doc, n, head in items:
        parts = sorted(seen[doc])
        assert sum(p[2] for p in parts) == (n or 0) and (len(parts) == 1 or (n or 0) > capacity)
        assert [p[1] for p in parts] == list(np.cumsum([0, *[p[2] for p in parts]])[:-1])
        assert sum(p[3] for p in parts) == max(0, (n or 0) - (head or 0))
    return len(per)


def test_packing(spark):
    r = random.Random(1)
    items = [(i, r.choice([r.randint(0, 90), r.randint(1, 300)]), r.randint(0, 5)) for i in range(2000)] + [(5000, None, None), (5001, 0, 0), (5002, 100, 0), (5003, 200, 150)]
    items = [(d, n, min(n or 0, h or 0)) for d, n, h in items]
    df = spark.createDataFrame(items, "doc_id long, n_tokens int, n_head int")
    limits = spark.createDataFrame([(1, 100), (2, 64), (3, None), (4, 0)], "limit_id int, capacity_tokens int")
    rows = packing.packed(df, limits, items_per_shard=700).collect()
    assert {x.limit_id for x in rows} == {1, 2}
    for limit, capacity in ((1, 100), (2, 64)):
        n = check_packing([x for x in rows if x.limit_id == limit], items, capacity, 16)
        assert sum(n or 0 for _, n, _ in items) / (n * capacity) > 0.97
    assert packing.packed(df.limit(0), limits).count() == 0


def test_the_limit_of_loss_binds(spark):
    # Texts without a head, and prompts that bear no loss: with half the capacity for loss each container needs both.
    items = [(i, 10, 0) for i in range(400)] + [(1000 + i, 10, 10) for i in range(400)] + [(2000, 90, 0)]
    df = spark.createDataFrame(items, "doc_id long, n_tokens int, n_head int")
    limits = spark.createDataFrame([(1, 100)], "limit_id int, capacity_tokens int")
    rows = packing.packed(df, limits, loss_share=0.5).collect()
    n = check_packing(rows, items, 100, 16, 0.5)
    free = packing.packed(df.where("n_head = 0"), limits, loss_share=1.0).select("container_id").distinct().count()
    bound = packing.packed(df.where("n_head = 0"), limits, loss_share=0.5).select("container_id").distinct().count()
    assert bound == 81 and free == 41 and n <= 83


def test_fill_small_cases():
    assert packing.fill(np.array([[5, 1, 5], [5, 1, 0]]), np.array([10, 2, 5])) == [[0, 1]]
    assert len(packing.fill(np.array([[5, 1, 5], [5, 1, 5]]), np.array([10, 2, 9]))) == 2
    assert len(packing.fill(np.array([[0, 1, 0]] * 5), np.array([10, 2, 10]))) == 3


# ---------------------------------------------------------------- survivors


def brute_unbeaten(rows):
    out = {}
    for f in {r[1] for r in rows if r[1] is not None}:
        own = [r for r in rows if r[1] == f]
        if len(own) > 1:
            best = [r for r in own if all(o[2] <= r[2] and o[3] <= r[3] for o in own)]
            if best:
                out[f] = min(r[0] for r in best)
    return out


def test_unbeaten_against_brute_force(spark):
    r = random.Random(2)
    rows = [(i, r.choice(["a", "b", "c", "d", "e", None, "hot", "hot"]), r.randint(0, 4), r.randint(0, 3)) for i in range(80)]
    df = spark.createDataFrame(rows, "seq long, f string, x int, y int")
    got = survivors.unbeaten(df, F.col("f"), {"x": F.col("x"), "y": F.col("y")}, "seq").where("at_root").collect()
    assert {g.group: g.seq for g in got} == brute_unbeaten(rows)
    assert survivors.unbeaten(df.limit(0), F.col("f"), {"x": F.col("x")}, "seq").count() == 0


def test_branch_and_bound_against_all_choices():
    r = random.Random(4)
    visited = every_node = 0
    for _ in range(400):
        ties = [tuple(sorted(r.sample(range(3), r.randint(0, 2)))) for _ in range(r.randint(1, 5))]
        bundles = [
            [(float(r.randint(1, 9)), r.randint(1, 99), tuple(r.choice(["x", "y", None]) if d in own else None for d in range(3))) for _ in range(r.randint(0, 4))] for own in ties
        ]
        for may_be_empty in (True, False) if all(bundles) else (True,):
            won, trust, root, nodes = survivors.branch_and_bound(bundles, ties, may_be_empty)
            best = float("-inf")
            for choice in product(*[[None, *own] for own in bundles]):
                held = {}
                ok = all(held.setdefault(d, c[2][d]) == c[2][d] for c, own in zip(choice, ties) if c for d in own)
                # Without leave, a bundle is empty only if the ones before it exclude all of its candidates.
                if ok and not may_be_empty:
                    seen = {}
                    for c, own, pool in zip(choice, ties, bundles):
                        if c is None and any(all(seen.get(d, x[2][d]) == x[2][d] for d in own) for x in pool):
                            ok = False
                        if c:
                            seen.update({d: c[2][d] for d in own})
                if ok:
                    best = max(best, sum(c[0] for c in choice if c))
            assert trust == best <= root, (bundles, ties)
            kept = {}
            assert all(kept.setdefault(d, c[2][d]) == c[2][d] for c, own in zip(won, ties) if c[1] is not None for d in own)
            visited += nodes
            every_node += int(np.prod([len(b) + 1 for b in bundles]))
    assert visited < every_node / 4


def test_bound_cuts_the_search():
    # Twelve bundles of six values of one dependency: a full enumeration has 7 ** 12 leaves.
    bundles = [[(float(10 + (v == "c") + k % 3), k * 10 + i, (v,)) for i, v in enumerate("abcdef")] for k in range(12)]
    won, trust, root, nodes = survivors.branch_and_bound(bundles, [(0,)] * 12)
    assert {c[2] for c in won} == {("c",)} and trust == root and nodes < 50


def _bundles(lang, **more):
    lang = lang if isinstance(lang, dict) else {"abstract": lang, "title": lang}
    return {"abstract": survivors.Bundle(F.col("a"), (), {"lang": lang["abstract"]}), "title": survivors.Bundle(F.col("t"), (), {"lang": lang["title"]}), **more}


def test_survivors_take_whole_bundles(spark):
    rows = [(1, "f", "en", 5.0, 1.0, 9.0, "A1"), (2, "f", "de", 6.0, None, 1.0, "A2"), (3, "f", "en", 4.0, 7.0, 2.0, "A3"), (3, "f", "en", 4.0, 7.0, 2.0, "A3"), (4, None, "en", 1.0, 1.0, 1.0, "A4"), (5, "g", None, None, None, None, None)]
    df = spark.createDataFrame(rows, "seq long, fam string, lang string, a double, t double, o double, name string")
    more = {"office": survivors.Bundle(F.col("o"), ("name",)), "codes": survivors.Bundle(F.col("o"), ("lang",)), "applicant": survivors.Bundle(F.lit(None), ("o",))}
    bundles = _bundles(F.col("lang"), **more)
    chosen = survivors.choose_rows(df, F.col("fam"), bundles, [])
    got = {r.group: r for r in chosen.collect()}
    f = got["f"]
    assert (f.n_rows, f.lang, f.abstract_row, f.title_row, f.office_row, f.applicant_row, f.trust, f.root_bound) == (4, "en", 1, 3, 1, None, 30.0, 31.0)
    assert got["g"].abstract_row is None and got["g"].lang is None and None not in got
    whole = {r.group: r for r in survivors.survivors(df, F.col("fam"), chosen.drop("nodes", "lang"), {k: bundles[k] for k in more}).collect()}
    assert (whole["f"].name, whole["f"].lang, whole["f"].o) == ("A1", "en", None) and whole["g"].name is None and len(whole) == 2
    assert survivors.choose_rows(df.limit(0), F.col("fam"), bundles, []).count() == 0


def test_preferred_rows_win_among_equal_trust(spark):
    df = spark.createDataFrame([(1, "f", 5.0, 1), (2, "f", 5.0, 3), (3, "f", 5.0, 3), (4, "f", 4.0, 9), (5, "f", 5.0, None)], "seq long, fam string, a double, p int")
    got = survivors.choose_rows(df, F.col("fam"), {"b": survivors.Bundle(F.col("a"))}, [F.col("p")]).first()
    assert (got.b_row, got.n_rows, got.trust) == (2, 5, 5.0)


def test_title_and_abstract_have_labels_of_their_own(spark):
    # Row 1 has an abstract of another language than its title; row 4's title label is unknown.
    rows = [(1, "f", "en", "de", 9.0, 5.0), (2, "f", "en", "en", 3.0, 4.0), (3, "g", "de", "de", 2.0, 2.0), (4, "g", "", "de", 5.0, 9.0)]
    df = spark.createDataFrame(rows, "seq long, fam string, tl string, al string, a double, t double")
    bundles = _bundles({"abstract": F.col("al"), "title": F.col("tl")}, office=survivors.Bundle(F.lit(1.0)))
    got = {r.group: r for r in survivors.choose_rows(df, F.col("fam"), bundles, []).collect()}
    assert [(g.n_rows, g.lang, g.abstract_row, g.title_row, g.trust, g.root_bound) for g in (got["f"], got["g"])] == [(2, "de", 1, None, 10.0, 15.0), (2, "", None, 4, 10.0, 15.0)]


# ---------------------------------------------------------------- names


@pytest.mark.parametrize(
    "a,b,same",
    [
        ("Dorbalgan Kixfaxner Laboratories Ltd.", "Dorbalgan Kixf. Lab. LTD", True), ("Foobarkin Dolmatex Biosciences", "DOLMATEX FOBARKIN BIOSCI. GMBH", True),
        ("Foobarkindolmatex Biotechnology", "Foobarkin-Dolmatex Bio-Tech A/S", True), ("Foobarkin Dolmatex Biosciences", "Foobarkin Ruvelnos Biosciences", False),
        ("Foobarkin Dolmatex Biosciences", "Foobarkin Dolmatex University", False), ("The Zanthir Institute [CH]", "Institut Zanthir", True),
    ],
)
def test_organisations(a, b, same):
    (ka, wa, ba, _), (kb, wb, bb, _) = names.parse(a), names.parse(b)
    assert ka == kb == "o" and names.same_organisation((wa, ba), (wb, bb)) is same


@pytest.mark.parametrize(
    "a,b,how",
    [
        ("Barorefi, William", "William A. Barorefi", "strong"), ("BAROREFI WILLIAM", "Bill Barorefi", "strong"), ("Dr. William Barorefi", "Barroefi William", "strong"),
        ("Barorefi W", "William A. Barorefi", "weak"), ("BAROREFI, W.B.", "William A. Barorefi", ""), ("Robert Barorefi", "Roberta Barorefi", ""), ("Barorefi W", "W. A. Barorefi", "weak"),
        ("BAROREFI, W.A.", "W. A. Barorefi", "strong"), ("William Barorefi", "William Barodifi", ""), ("Thea Barorefi", "Dorothea Barorefi", "strong"),
    ],
)
def test_persons(a, b, how):
    (ka, wa, _, ia), (kb, wb, _, ib) = names.parse(a), names.parse(b)
    assert ka == kb == "p" and names.same_person((wa, "", ia, ""), (wb, "", ib, "")) == how


def test_lcs_against_table():
    r = random.Random(6)
    for _ in range(300):
        a, b = ("".join(r.choice("abc") for _ in range(r.randrange(12))) for _ in range(2))
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert names.lcs(a, b) == t[-1][-1]


def test_entities_against_all_pairs(spark):
    r = random.Random(8)
    syllables = "bal dor fim gax kel lum mir not pex ruv sol tan vek wis zod".split()
    word = lambda: "".join(r.choice(syllables) for _ in range(3)).capitalize()
    rows, n = [], 0
    for _ in range(60):
        a, b, kind = word(), word(), r.choice(["Biosciences", "University", "Laboratories"])
        for form in r.sample([f"{a} {b} {kind}", f"{a} {b} {kind} Ltd.", f"The {b} {a} {kind}", f"{a[:4] + a[5:]} {b} {kind}", f"{a}-{b} {kind}", f"{(a + ' ' + b).upper()} {kind.upper()} GMBH"], 3):
            rows.append((n, form, r.choice(["US", None])))
            n += 1
    rows += [(n, None, "US"), (n + 1, "", None), (n + 2, "  ", None), (n + 3, "株式会社", None)]
    df = spark.createDataFrame([(*x, "w", 1) for x in rows], "name_id long, applicant_name string, country string, words string, entity_id int")
    found = names.entities(df, "name_id", "applicant_name", "country")
    got = {(p.name_a, p.name_b) for p in names.entity_pairs(found).collect()}
    parsed = [(i, names.parse(t)) for i, t, _ in rows if t]
    links = [(i, j) for (i, p), (j, q) in combinations(parsed, 2) if p[1] and q[1] and p[0] == q[0] == "o" and names.same_organisation((p[1], p[2]), (q[1], q[2]))]
    root = {i: i for i, _, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in links:
        root[max(find(i), find(j))] = min(find(i), find(j))
    assert got == {(i, j) for i, j in combinations(range(n), 2) if find(i) == find(j)}
    assert names.entities(df.limit(0), "name_id", "applicant_name", "country").count() == 0


def test_persons_against_all_pairs(spark):
    r = random.Random(18)
    surnames, given = ["Li", "Xu", "Kim", "Bo", "Lee", "Wendovic", "Wendowic", "Kessurana", "Tolderlo"], ["Wei", "William", "Bill", "Hannah", "Hanna", "An", "Robert", "Bob", "Jo"]
    texts = sorted({f for s in surnames for g in given for f in r.sample([f"{g} {s}", f"{s}, {g}", f"{s.upper()} {g}", f"{s[:-1]}k {g}", f"{g[1:]}x {s}", f"{s} {g[0]}", f"{g[0]}. {s}"], 2)})
    parsed = [names.parse(t) for t in texts]
    assert all(p[0] == "p" for p in parsed)
    df = spark.createDataFrame(list(enumerate(texts)), "name_id long, applicant_name string").selectExpr("*", "CAST(NULL AS string) AS country")
    members, classes = names.classes_of(names.parsed(df, "name_id", "applicant_name", "country"))
    links = names._links(names._blocked(classes)).unionByName(names._exact_links(classes)).distinct()
    of = {m.name_id: m.class_id for m in members.collect()}
    got = {(x.a, x.b) for x in links.collect()}
    want = set()
    for (i, p), (j, q) in combinations(enumerate(parsed), 2):
        if of[i] != of[j] and names.same_person((p[1], "", p[3], ""), (q[1], "", q[3], "")):
            want.add((min(of[i], of[j]), max(of[i], of[j])))
    assert got == want and len(want) > 60


def test_short_surnames_and_long_names(spark):
    texts = ["Li Wei", "Wei Li", "Kim An", "An Kim"]
    assert linked_names(spark, texts) == {(0, 1), (2, 3)}
    r = random.Random(4)
    words = ["".join(r.choice("abcdefghij") for _ in range(8)) for _ in range(12)]
    other = [w[:3] + "x" + w[4:] for w in reversed(words)]
    began = time.perf_counter()
    for _ in range(100):
        assert names.same_organisation((words, ""), (other, ""))
        assert not names.same_organisation((words, ""), (words[:11] + ["zzzzzzzz"], ""))
    assert time.perf_counter() - began < 2.0


def test_assignment_against_permutations():
    r = random.Random(6)
    yes = 0
    for _ in range(3000):
        n = r.randint(1, 4)
        a = ["".join(r.choice("ab") for _ in range(r.randint(4, 6))) for _ in range(n)]
        b = ["".join(r.choice("ab") for _ in range(r.randint(4, 6))) for _ in range(n)]
        fits = lambda x, y: names._word_fits(x, y, names.LEAST_WORD)
        want = any(all(map(fits, a, p)) and any(names.ratio(x, y) >= names.LEAST_PERSON for x, y in zip(a, p)) for p in permutations(b))
        if n > 1:
            assert names.same_organisation((a, ""), (b, "")) == want
            yes += want
    assert yes > 100


def linked_names(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "name_id long, applicant_name string").selectExpr("*", "CAST(NULL AS string) AS country")
    return {(p.name_a, p.name_b) for p in names.entity_pairs(names.entities(df, "name_id", "applicant_name", "country")).collect()}


def test_names_of_the_largest_blocks_are_compared(spark):
    r = random.Random(12)
    syllables = "ba do fi ga ke lu mi no pe ru so ta ve wi zo".split()
    surnames = {"Fo" + "".join(r.choice(syllables) for _ in range(5)) for _ in range(700)}
    assert len(surnames) > 400
    texts = ["Funevisa William", "Funevise William", "Funevisa W", *[f"{s} William" for s in sorted(surnames)]]
    assert {(0, 1)} <= linked_names(spark, texts)


def test_common_suffixes_do_not_part_run_together_words_and_slips_of_initials(spark):
    r = random.Random(13)
    word = lambda: "".join(r.choice("bdfgklmnprstvz") + r.choice("aeiou") for _ in range(4)).capitalize()
    texts = ["Notbokmek Fomgankix Biosciences", "Notbokmekfomgankix Biosciences", "Notbokmek Fomganpix Genetics", "Notbokmekfomgankiz Genetics", "Smith John", "Gmith John"]
    texts += [f"{word()} Fomgankix Biosciences" for _ in range(60)] + [f"{word()} John" for _ in range(60)] + [f"{word()} Smith" for _ in range(60)]
    assert {(0, 1), (2, 3), (4, 5)} <= linked_names(spark, texts)


def test_names_that_are_linked_share_a_key():
    r = random.Random(14)
    sizes = tuple(range(1, 40))
    many = {n: list(range(1, 60)) for n in range(1, 7)}

    def slipped(w):
        for _ in range(r.randint(0, max(1, len(w) // 5))):
            i = r.randrange(len(w))
            w = r.choice([w[:i] + w[i + 1 :], w[:i] + r.choice("abc") + w[i:], w[:i] + r.choice("abc") + w[i + 1 :]]) or w
        return w

    n = 0
    for _ in range(1500):
        words = ["".join(r.choice("abcdef") for _ in range(r.choice([2, 5, 8, 9, 12, 15, 18]))) for _ in range(r.randint(1, 3))]
        other = [slipped(w) for w in words]
        r.shuffle(other)
        if len(other) > 1 and r.random() < 0.5:
            other = [other[0] + other[1], *other[2:]]
        if names.same_organisation((words, ""), (other, "")):
            n += 1
            left, right = ({k[0]: k[4] for k in [*names.organisation_keys(w, "", sizes), *names.joined_keys(w, "", many, many)]} for w in (words, other))
            assert any(left[k] or right[k] for k in left.keys() & right.keys()), (words, other)
    assert n > 300


def test_components(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (101, 101), (None, 5), (200, 201), (200, 201)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_names_do_not_pass_through_the_driver(spark, tmp_path):
    # A few KB of names, of which the planner expects that all that is made of them is as small.
    texts = ["Notbokmek Fomgankix Biosciences", "Notbokmekfomgankix Biosciences", "Funevisa William", "Funevisa W", "Smith John", "Gmith John"]
    spark.createDataFrame(list(enumerate(texts)), "name_id long, applicant_name string").selectExpr("*", "CAST(NULL AS string) AS country").coalesce(1).write.parquet(str(tmp_path / "applicant_names.parquet"))
    store, bus = spark._jsparkSession.sharedState().statusStore(), spark.sparkContext._jsc.sc().listenerBus()

    def executions():
        bus.waitUntilEmpty(60_000)
        rows = store.executionsList()
        return {(x := rows.apply(i)).executionId(): x.physicalPlanDescription() for i in range(rows.size())}

    before = max(executions())
    assert {(p.name_a, p.name_b) for p in queries.p2_found(spark, str(tmp_path)).collect()} == {(0, 1), (2, 3), (4, 5)}
    plans = [plan for i, plan in executions().items() if i > before]
    assert len(plans) > 10 and any("SortMergeJoin" in plan for plan in plans)
    assert not any("Broadcast" in plan for plan in plans)


# ---------------------------------------------------------------- languages

EN = "The formulation may be combined with other agents that are known to act on the liver and the treatment was repeated after some days"
DE = "Die Proben wurden gereinigt und gekühlt gelagert und erst nach einigen Tagen verwendet weil der Wirkstoff wiederholt verabreicht wird"
FR = "Les échantillons ont été purifiés puis conservés au froid pendant quelques jours et le composé est administré toutes les semaines"
ZH = "样品经过纯化并在低温下保存还描述了通过重复给药来治疗的方法反义链与转录本的一个区域互补"


@pytest.fixture(scope="module")
def model():
    r = random.Random(1)
    sample = []
    for lang, text in (("en", EN), ("de", DE), ("fr", FR)):
        words = text.split()
        sample += [(lang, " ".join(r.choice(words) for _ in range(30)), i) for i in range(1, 41)]
    sample += [("zh", "".join(r.sample(ZH, 30)), i) for i in range(1, 41)]
    return langid.fit(sample)


def test_distribution_sums_to_one():
    m = langid.train({"x": {"abc": 3, "abd": 2, "ac": 1}, "y": {"bca": 2, "ab": 1}})
    contexts = ["", "a", "ab"]
    for context in contexts:
        rows = [m.score([context + c])[0] - 0 for c in "abcd"]
        assert np.isfinite(rows).all()
    seen = np.exp(m.probs[1])
    assert (seen.sum(axis=0) <= 1.001).all() and (seen > 0).all()


def test_languages_and_segments(model):
    who = langid.Identifier(model)
    assert [x[0][0] for x in who.identify([EN, DE, FR, ZH])] == ["en", "de", "fr", "zh"]
    mixed = f"{EN}. {DE} / {FR}"
    got = who.identify([langid.readable(mixed)])[0]
    assert [g[0] for g in got] == ["en", "de", "fr"] and got[0][2] == 0 and got[-1][3] == len(mixed)
    assert [a[3] for a in got[:-1]] == [b[2] for b in got[1:]] and mixed[got[1][2] :].startswith("Die Proben")
    assert [g[0] for g in who.identify([f"{EN} {DE}"])[0]] == ["en", "de"]
    assert who.identify(["", "  ", "12 34", "TNF"]) == [[("und", 0.0, 0, n)] for n in (0, 2, 5, 3)]
    assert who.identify(["qqqq xxxx zzkq wwvv jjqx kkzw vvqq " * 4])[0][0][0] == "und"
    assert who.identify([langid.readable(EN.upper())])[0][0][0] == "en"
    assert all(0 <= c <= 1 for x in who.identify([EN, mixed]) for _, c, _, _ in x)


def test_segments_index_the_stored_text(spark, model):
    wide = EN.replace("e", "e​")
    text = f"ﬁ ﬀ {wide}. {DE}​ / {FR.replace('é', 'e' + chr(0x301))}"
    assert len(langid.readable(text)) != len(text)
    df = spark.createDataFrame([(1, text, None)], "seq long, title string, title_lang string")
    segments = langid.identified(df, ["seq"], {"title": "title_lang"}, model).first().segments
    assert [s.lang for s in segments] == ["en", "de", "fr"] and segments[0].start_pos == 0 and segments[-1].end_pos == len(text)
    assert text[segments[1].start_pos :].lstrip("​").startswith(DE[:10]) and text[segments[2].start_pos :].startswith(FR[:4])
    assert [a.end_pos for a in segments[:-1]] == [b.start_pos for b in segments[1:]]


def test_identified_frames(spark, model):
    rows = [(1, EN, "de", "x"), (1, EN, "de", "x"), (2, None, None, "x"), (3, "", "en", "x"), (4, (DE + ". ") * 300, None, "x")]
    df = spark.createDataFrame(rows, "seq long, title string, title_lang string, segments string")
    got = langid.identified(df, ["seq"], {"title": "title_lang"}, model)
    langs = sorted((r.seq, r.label, r.langs) for r in got.select("seq", F.coalesce("label", F.lit("")).alias("label"), langid.languages(F.col("segments")).alias("langs")).collect())
    assert langs == [(1, "de", ["en"]), (1, "de", ["en"]), (3, "en", []), (4, "", ["de"])]
    assert langid.identified(df.limit(0), ["seq"], {"title": "title_lang"}, model).count() == 0
    many = spark.createDataFrame([(i, "en" if i % 3 else None, "word " * 20) for i in range(50)], "id long, lang string, text string")
    assert langid.training_sample(many, "text", "lang", "id", texts=7).count() == 7


# ---------------------------------------------------------------- personal information


@pytest.fixture(scope="module")
def trained():
    return pii_examples.trained()


def test_held_out_accuracy(trained):
    trees, thresholds = trained
    writer = pii_examples._Writer(4321)
    texts = [writer.text() for _ in range(500)]
    finder = pii.Finder(trees, list(thresholds), pii.Lexicon(writer.rates))
    hit = miss = wrong = 0
    for (text, spans), got in zip(texts, finder.find([t for t, _ in texts])):
        want = {(s, e, pii.KINDS[k]) for s, e, k in spans}
        hit, miss, wrong = hit + len(want & set(got)), miss + len(want - set(got)), wrong + len(set(got) - want)
    assert hit / (hit + wrong) > 0.95 and hit / (hit + miss) > 0.94


def test_redacted_frames(spark, trained):
    text = "cc: Wendy Karlowick <w.karlowick@mail.example>\nCall +44 (0)20 7946 0320 or visit 12 Mill Orchard Road, Kelmora 03677. Lot 7741-20-3312 was used. As Mr Karlowick said."
    long = "The duplex was purified. " * 4000 + "Mail x.y@z.example now."
    df = spark.createDataFrame([(1, text, 0), (2, None, 0), (3, "", 0), (4, long, 0), (1, text, 0)], "doc_id long, text string, spans int")
    got = pii.found(df, "doc_id", "text", *trained)
    rows = got.collect()
    one = [r for r in rows if r.doc_id == 1]
    assert len(rows) == 5 and len(one) == 2 and one[0] == one[1]
    kinds = [(text[s.start_pos : s.end_pos], s.pii_kind) for s in one[0].spans]
    assert ("w.karlowick@mail.example", "email") in kinds and ("+44 (0)20 7946 0320", "phone") in kinds and ("12 Mill Orchard Road, Kelmora 03677", "address") in kinds and ("Karlowick", "person") in kinds
    assert not any("7741" in t for t, _ in kinds) and "[EMAIL]" in one[0].redacted and "Lot 7741-20-3312 was used." in one[0].redacted
    by = {r.doc_id: r for r in rows}
    assert by[2].redacted is None and by[2].spans is None and by[3].spans == [] and by[4].redacted.endswith("Mail [EMAIL] now.")
    assert pii.found(df.limit(0), "doc_id", "text", *trained).count() == 0
    # How many words the workers hold changes nothing: with 3 of them nearly all evidence comes by the join.
    assert sorted(map(str, pii.found(df, "doc_id", "text", *trained, cached=3).collect())) == sorted(map(str, rows))


def test_evidence_beyond_the_cache(spark, trained):
    # More names than the workers hold, each told to be one by a title somewhere else.
    r = random.Random(9)
    names = sorted({"".join(r.choice("bdfgklmnprstvz") + r.choice("aeiou") for _ in range(4)).capitalize() for _ in range(3000)})
    rows = [(i, f"As Mr. {n} said. Then Dr. {n} left.") for i, n in enumerate(names)] + [(10_000 + i, f"We met Mrs. {n} again.") for i, n in enumerate(names)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    whole, joined = ({(r.doc_id, str(r.spans)) for r in pii.found(df, "doc_id", "text", *trained, cached=n).collect()} for n in (60_000, 100))
    assert whole == joined and sum("person" in s for _, s in joined) > 0.98 * len(rows)


def test_addresses_of_any_length_and_other_scripts(trained):
    lexicon = pii.Lexicon({})
    long = "Flat 12, 7 " + "Verylongnamedplaceofoldtimes" * 4 + " " + "Otherlongnameofaplace" * 4 + " Road, " + "Kelmoraunderthehills" * 6 + " 03677"
    assert (5, 5 + len(long), 3) in pii.candidates(f"Lab: {long}. Then", lexicon)
    for text, item, kind in [("手机13912345678。", "13912345678", 1), ("住在江苏省苏州市工业园区星湖街218号。", "江苏省苏州市工业园区星湖街218号", 3), ("王小明先生来了", "王小明", 4), ("ул. Тверина, д. 5, кв. 3, г. Омск", None, 3), ("Via della Rosa 12, 00100 Kelmora", None, 3), ("Rozenstraat 12a, 1234 AB Kelmora", None, 3), ("Rua do Sol, 12, 1000-001 Kelmora", None, 3)]:
        assert any(text[s:e] == (item or text) and k == kind for s, e, k in pii.candidates(text, lexicon)), text


def test_all_queries_on_the_smallest_tables(spark):
    import os

    import __spark_entry__ as entry

    folder = "/root/testdata/sf0.001"
    if not os.path.exists(folder):
        pytest.skip("no test tables")
    made = {k: f for k, f in entry.queries().items() if k.startswith("p")}
    assert {k.split("_")[0] for k in made} >= {f"p{i}" for i in range(1, 10)}
    for name in ("p1_found", "p2_found", "p5_found", "p6_found", "p6_survivors", "p7_ids", "p8_fill", "p9_found"):
        assert made[name](spark, folder).count() > 0, name
