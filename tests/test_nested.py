import json

import pytest

from strataline.operators.biblio import flattened, quota, with_second_chance
from strataline.operators.nested import BIBLIO, NodeKind, label, link, node_tables, parse


def wrap(doc, p=""):
    return json.dumps({f"{p}world-patent-data": {f"{p}exchange-documents": {f"{p}exchange-document": doc}}})


FULL = {
    "@family-id": "77",
    "abstract": [{"@lang": "de", "p": {"$": "Hallo"}}, {"@lang": "EN", "p": [{"$": "<p>Hello"}, {"$": "[0001] there</p>"}]}],
    "bibliographic-data": {
        "invention-title": [{"@lang": "de", "$": "Titel"}, None, {"@lang": "en", "$": "Title"}, {}],
        "parties": {"applicants": {"applicant": [{"applicant-name": {"name": "Bare Name"}}, {"applicant-name": {}}, {"applicant-name": {"name": [{"$": "X"}, {"@lang": "en", "$": "Y"}]}}]}},
        "publication-reference": {"document-id": [{"@document-id-type": "docdb", "country": {"$": "US"}, "doc-number": {"$": "1"}, "kind": {"$": "A"}, "date": {"$": "20200101"}}, {"@document-id-type": "docdb", "country": {"$": "EP"}, "doc-number": {"$": "20.12"}, "kind": {"$": "B1"}, "date": {"$": "20210101"}}]},
        "priority-claims": {"priority-claim": [{"document-id": {"@document-id-type": "docdb", "date": {"$": "20200102"}}}, {"document-id": [{"@document-id-type": "docdb", "date": {"$": "20190303"}}, {"@document-id-type": "original", "date": {"$": "2018"}}]}]},
        "patent-classifications": {"patent-classification": [{"section": {"$": "A"}, "class": {"$": "61"}, "subclass": {"$": "K"}, "main-group": {"$": "31"}, "subgroup": {"$": "713"}, "classification-scheme": {"@scheme": "CPCI"}}, {"section": {"$": "C"}, "class": {"$": "12"}, "subclass": {"$": "N"}, "classification-scheme": {"@scheme": "IPCR"}}, {"section": {"$": "G"}, "class": {"$": "01"}}, {}]},
    },
}


def test_flatten(spark):
    rows = [(1, wrap(FULL)), (2, wrap([{"@family-id": "5"}, FULL], "ops:")), (3, None), (4, " "), (5, "{broken"), (6, wrap([])), (7, wrap(None))]
    got = {(r.rec_id, r.doc_no): r for r in flattened(spark.createDataFrame(rows, "rec_id long, body string")).collect()}
    assert set(got) == {(1, 1), (2, 1), (2, 2)}
    r = got[1, 1]
    assert (r.patent_id, r.family_id, r.priority_date, r.publication_date) == ("EP2012B1", "77", "20190303", "20210101")
    assert (r.title, r.abstract, r.applicant) == ("Title", "Hello there", "Bare Name | Y")
    assert (r.cpcs, r.ipcs) == ("A61K31/713, G01", "C12N, G01")
    empty = got[2, 1]
    assert (empty.title, empty.abstract, empty.applicant, empty.patent_id, empty.priority_date) == ("No title", "No abstract available in EPO database", "", "", "")
    # Both keys: an empty prefixed one falls through to the other, a filled one counts.
    both = json.dumps({"ops:world-patent-data": {}, "world-patent-data": {"exchange-documents": {"ops:exchange-document": [], "exchange-document": [dict(FULL, **{"ops:abstract": {}})]}}})
    one = json.dumps({"world-patent-data": {"exchange-documents": {"ops:exchange-document": FULL, "exchange-document": [{}, {}]}}})
    twice = flattened(spark.createDataFrame([(1, both), (2, one)], "rec_id long, body string")).collect()
    assert [(x.rec_id, x.doc_no, x.title, x.abstract) for x in sorted(twice)] == [(1, 1, "Title", "Hello there"), (2, 1, "Title", "Hello there")]
    first = flattened(spark.createDataFrame([(1, wrap(FULL))], "rec_id long, body string"), first_form=True).first()
    assert (first.cpcs, first.ipcs) == ("A61K31/713, C12N/, G01/", "")
    other = spark.createDataFrame([("", "Found"), ("", "Later"), (None, None)], "patent_id string, abstract string")
    assert {x.abstract for x in with_second_chance(spark.createDataFrame([empty]), other).collect()} == {"Found"}


def test_labels_are_intervals():
    nodes = label(json.loads(wrap([FULL, FULL])), BIBLIO)
    by = lambda k: [n for n in nodes if n[0] == k]
    assert [n[1] for n in by("document")] == [1, 2]
    assert [n[1] for n in by("title")] == [1, 2, 3, 1, 2, 3]
    assert [n[5] for n in by("name")] == ["Bare Name", "X", "Y"] * 2
    for name in by("name"):
        assert sum(a[2] < name[2] and name[3] < a[3] for a in by("applicant")) == 1
    marks = [x for n in nodes for x in n[2:4]]
    assert len(set(marks)) == len(marks)


def test_link_and_edge_cases(spark):
    rows = [(1, wrap([FULL, FULL])), (2, None), (3, ""), (4, "null"), (5, "[1, 2]"), (6, '"text"'), (7, '{"a": {"ops:exchange-document": [[{"bibliographic-data": {"invention-title": "T"}}]]}}')]
    df = spark.createDataFrame([(*r, "k", 3) for r in rows], "rec_id long, body string, kind string, pre int")
    linked = link(node_tables(df, "rec_id", "body"), "rec_id", {"document": "", "applicant": "document"})
    names = sorted((r.rec_id, r.document_no, r.applicant_no, r.no, r.text) for r in linked.where("kind = 'name'").collect())
    assert names == [(1, d, a, n, t) for d in (1, 2) for a, n, t in ((1, 1, "Bare Name"), (3, 1, "X"), (3, 2, "Y"))]
    assert [r.text for r in linked.where("rec_id = 7 AND kind = 'title'").collect()] == ["T"]
    assert linked.where("kind <> 'name' AND applicant_no IS NOT NULL AND kind <> 'applicant'").count() == 0
    assert node_tables(df.limit(0), "rec_id", "body").count() == 0


def test_deep_record(spark):
    inner = '{"exchange-document": {"bibliographic-data": {"invention-title": "deep"}}}'
    deep = '{"x": ' * 200_000 + inner + "}" * 200_000
    lists = "[" * 100_000 + inner + "]" * 100_000
    broken = '{"x": ' * 100_000 + inner
    df = spark.createDataFrame([(1, deep), (2, lists), (3, broken)], "rec_id long, body string")
    got = sorted((r.rec_id, r.kind, r.text) for r in node_tables(df, "rec_id", "body").collect())
    assert got == [(1, "document", None), (1, "title", "deep"), (2, "document", None), (2, "title", "deep")]


def test_own_parser_against_the_library():
    texts = ['{"a": [1, -2.5e3, "x\\u00e9\\n", true, null, {}, [], {"b": {"c": [[]]}}]}', " [] ", "7", '"s"', '{"a": 1, "a": 2}', "", "{", "[1,]", '{"a"}', "[1] 2", "nul", '{"a": 1,}', "[", '{1: 2}', "-", "[1 2]"]
    pad = 30_000
    for text in texts:
        try:
            want = json.loads(text)
        except ValueError:
            with pytest.raises(ValueError):
                parse("[" * pad + text + "]" * pad) if text.strip() else parse(text)
            continue
        got = parse("[" * pad + text + "]" * pad)
        for _ in range(pad):
            (got,) = got
        assert got == want, text


def test_recursive_kinds(spark):
    kinds = (NodeKind("part", ("part",), None, True), NodeKind("label", ("name",), "part"))
    body = json.dumps({"part": {"name": "a", "part": [{"name": "b", "part": {"name": "c"}}, {"name": "d"}], "name2": 0, "z": {"part": {"name": "e"}}}, "part2": 1})
    body = body.replace('"name2": 0', '"name2": 0, "name3": {}')
    late = '{"part": {"part": {"part": {}}, "name": "late"}}'
    df = spark.createDataFrame([(1, body), (2, late)], "rec_id long, body string")
    linked = link(node_tables(df, "rec_id", "body", kinds), "rec_id", {"part": ""}, kinds)
    parts = {(r.rec_id, r.pre): (r.no, r.pre, r.post) for r in linked.where("kind = 'part'").collect()}
    assert sorted(p[0] for k, p in parts.items() if k[0] == 1) == [1, 2, 3, 4, 5]
    for r in linked.where("kind = 'label'").collect():
        around = [p for (rec, _), p in parts.items() if rec == r.rec_id and p[1] < r.pre and r.post < p[2]]
        assert (r.part_no, r.part_pre) == max(around, key=lambda p: p[1])[:2]
    assert {r.text: r.part_no for r in linked.where("kind = 'label'").collect()} == {"a": 1, "b": 2, "c": 3, "d": 4, "e": 5, "late": 1}


def test_quota(spark):
    r = quota(spark.createDataFrame([("search=green:30", "x", "y")], "traffic string, week_used string, hour_used string")).first()
    assert (r.used_mb, r.left_pct, r.search_rpm, r.status) == (0.0, 100.0, 30, "OK")
