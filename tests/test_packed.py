import pytest
from pyspark.sql import functions as F

from strataline.operators.packed import explode_packed

NAMES = [
    ("A One | B Two", ["A One", "B Two"]),
    ("A One|B Two; C Three|", ["A One", "B Two", "C Three"]),
    ("Foo Bar Labs, Co., Ltd.", None),
    ("Smith, John", None),
    ("Foo Bar Labs,\u200b Ltd. | Baz Qux", ["Foo Bar Labs,\u200b Ltd.", "Baz Qux"]),
    ("Smith, John | Foo Bar, Inc. [US]", ["Smith, John", "Foo Bar, Inc. [US]"]),
    ("Foo Bar AG, Baz Qux GmbH", ["Foo Bar AG", "Baz Qux GmbH"]),
    ('Foo Bar AG, "Qux Labs, Ltd.", Baz Inc', ["Foo Bar AG", "Qux Labs, Ltd.", "Baz Inc"]),
    ('["Foo Bar [JP]", "The \\"Baz\\" Trust"]', ["Foo Bar [JP]", 'The "Baz" Trust']),
    ('"A One"; "The ""Baz"" Trust"', ["A One", 'The "Baz" Trust']),
    ('Foo Bar | The "Baz; Qux" Trust', ["Foo Bar", 'The "Baz; Qux" Trust']),
    ("(1) A One (2) B Two, LLC (3) C Three", ["A One", "B Two, LLC", "C Three"]),
    ("Foo Bar | Baz Qux", ["Foo Bar", "Baz Qux"]),
    ("Foo Bar；Baz Qux", ["Foo Bar", "Baz Qux"]),
    ("Foo A/S / Bar A/S/", ["Foo A/S", "Bar A/S"]),
    ("Foo Bar;; ;Baz Qux", ["Foo Bar", "Baz Qux"]),
    ("Foo Bar | Baz1 Qux", ["Foo Bar", "Baz1 Qux"]),
    ("Nationwide Children's Hospital | O'Brien's Labs", ["Nationwide Children's Hospital", "O'Brien's Labs"]),
    ("- A One\n- B Two\r\n", ["A One", "B Two"]),
]
CODES = [
    ("A61K31/713, C12N15/113", ["A61K31/713", "C12N15/113"]),
    ("A61K 31/713 C12N 15/113", ["A61K 31/713", "C12N 15/113"]),
    ("{A61K31/713,C12N15/113}", ["A61K31/713", "C12N15/113"]),
    ("A61K31/713 / C12N15/113", ["A61K31/713", "C12N15/113"]),
    ("A61K31/713,,C12N15/113; ;G01N33/10", ["A61K31/713", "C12N15/113", "G01N33/10"]),
    ("A61K 31/71 (2006.01),C12N15/11(2018.05)", ["A61K 31/71 (2006.01)", "C12N15/11(2018.05)"]),
    ("'A61K31/713'; C12N15/113; 'G01N33/10'", ["A61K31/713", "C12N15/113", "G01N33/10"]),
    ("A61K31/713", None),
    ("A61K31/713;", None),
]


@pytest.mark.parametrize("kind,cases", [("names", NAMES), ("codes", CODES)])
def test_values(spark, kind, cases):
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "seq long, cell string")
    got = {}
    for r in explode_packed(df, ["seq"], {"cell": kind}).orderBy("seq", "pos").collect():
        got.setdefault(r.seq, []).append((r.pos, r.val))
    for i, (cell, want) in enumerate(cases):
        assert got.get(i) == (None if want is None else list(enumerate(want, 1))), cell


def test_nulls_repeats_clashes_and_empty(spark):
    schema = "seq long, applicant string, val string, pos int, __p int, field string, kind string, __text string"
    rows = [(1, "A One | B Two", "x", 9, 9, "y", "z", "t"), (1, "A One | B Two", "x", 9, 9, "y", "z", "t"), (None, "A One | A One", *[None] * 6), (3, None, *[None] * 6), (4, "", *[None] * 6), (5, " 　", *[None] * 6)]
    df = spark.createDataFrame(rows, schema)
    got = explode_packed(df, ["seq"], {"applicant": "names"})
    assert got.columns == ["seq", "field", "pos", "val"]
    assert sorted((r.seq or 0, r.pos, r.val) for r in got.collect()) == [(0, 1, "A One"), (0, 2, "A One"), (1, 1, "A One"), (1, 1, "A One"), (1, 2, "B Two"), (1, 2, "B Two")]
    assert explode_packed(df.limit(0), ["seq"], {"applicant": "names"}).count() == 0
    with pytest.raises(ValueError):
        explode_packed(df, ["seq"], {"applicant": "words"})


def test_long_cell_and_single_values(spark):
    df = spark.createDataFrame([(1, " | ".join(f"Name Number{i}" for i in range(3000)))], "seq long, c string")
    assert explode_packed(df, ["seq"], {"c": "names"}).count() == 3000
    one = spark.createDataFrame([(1, ' "Foo Bar" '), (2, None)], "seq long, c string")
    assert [(r.seq, r.val) for r in explode_packed(one, ["seq"], {"c": "names"}, least=1).collect()] == [(1, "Foo Bar")]


def test_working_characters_are_kept(spark):
    own = "".join(map(chr, [*range(0xE000, 0xE006), *range(0xE010, 0xE016)]))
    cells = [f'A{own} One | "B; {own[::-1]}Two" | \ue0000\ue002 C', f"\ue000\ue011 A; {own} B", "A61K31/713\ue003; \ue0001\ue002"]
    want = [[f"A{own} One", f"B; {own[::-1]}Two", "\ue0000\ue002 C"], ["\ue000\ue011 A", f"{own} B"], ["A61K31/713\ue003", "\ue0001\ue002"]]
    df = spark.createDataFrame(list(enumerate(cells)), "seq long, c string")
    got = explode_packed(df.where("seq < 2"), ["seq"], {"c": "names"}).unionByName(explode_packed(df.where("seq = 2"), ["seq"], {"c": "codes"}))
    assert [[r.val for r in got.where(F.col("seq") == i).orderBy("pos").collect()] for i in range(3)] == want
