import json
import urllib.parse
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from strataline.functions import text as T
from strataline.plans import pipelines
from strataline.sources import charts, delimited, remote


def test_file_to_sections(spark, tmp_path):
    rows = [
        ("US1A", "US", "1", "A", "f1", "20200101", "20210101", "Foo Inc", "siRNA for the liver", "A text; with \"quotes\"", "", "C12N15/113"),
        ("JP2A", "JP", "2", "A", "f1", None, "20190101", "Foo Inc | Bar Ltd", "日本", "No abstract available in EPO database", "", ""),
        ("EP3A", "EP", "3", "A", None, "20180101", None, None, "Corn seeds", "maize", "", ""),
    ]
    raw = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in pipelines.RAW_COLUMNS))
    delimited.write(raw.coalesce(1), str(tmp_path / "raw"))
    back = pipelines.read_raw(spark, str(tmp_path / "raw"))
    assert back.count() == 3 and [r.priority_date for r in back.orderBy("seq").collect()] == ["20200101", None, "20180101"]
    pipelines.write_classified(back, str(tmp_path / "sections"))
    folders = sorted(p.name for p in (tmp_path / "sections").iterdir() if p.name.startswith("section"))
    assert folders == ["section=0", "section=5", "section=7"] or len(folders) == 3
    for folder in folders:
        head, body = (delimited.read(spark, str(tmp_path / "sections" / folder / f"is_row={i}"), ["patent_id", "tier"]) for i in (0, 1))
        assert head.count() == 1 and head.first().patent_id.startswith("--- TIER") and head.first().patent_id.endswith(f"({body.count()} patents) ---")
    pipelines.write_classified(back.limit(0), str(tmp_path / "none"))
    pipelines.write_classified(back, str(tmp_path / "out"), single_file=True)
    text = next(p for p in (tmp_path / "out").iterdir() if p.name.startswith("part")).read_text(encoding="utf-8-sig").splitlines()
    assert text[0].startswith("patent_id;") and text[1].startswith("--- TIER 1") and text[2].startswith("US1A") and sum(x.startswith("--- ") for x in text) == 3
    assert [(r.year, r.n) for r in pipelines.timeline(back).collect()] == [(2018, 1), (2020, 1)]
    assert [(r.company, r.n_families) for r in pipelines.top_applicants(back).collect()] == [("BAR", 1), ("FOO", 1)]
    assert {r.patent_id for r in pipelines.curate(back).collect()} == {"US1A", "EP3A"}
    assert pipelines.classify(back.limit(0)).count() == 0


def _record(ident, abstract=None, family="", title="siRNA"):
    country, number, kind = ident.split(".")
    own = {"@document-id-type": "docdb", "country": {"$": country}, "doc-number": {"$": number}, "kind": {"$": kind}, "date": {"$": "20200101"}}
    doc = {"@family-id": family, "bibliographic-data": {"publication-reference": {"document-id": own}, "invention-title": {"@lang": "en", "$": title}}}
    if abstract:
        doc["abstract"] = {"@lang": "en", "p": {"$": abstract}}
    return doc


def _wrapped(*docs):
    return json.dumps({"ops:world-patent-data": {"exchange-documents": {"exchange-document": list(docs)}}})


def test_fetch_batches_fallback_and_second_chance(spark, tmp_path):
    folder = tmp_path / "answers"
    folder.mkdir()

    def save(kind, ids, body):
        (folder / f"{kind}.{urllib.parse.quote(','.join(ids), safe='')}.json").write_text(body)

    ids = [f"US.{i}.A" for i in range(1, 6)]
    save("biblio", ids[:2], _wrapped(_record(ids[0], "One", "f1"), _record(ids[1], None, "f2")))
    # The second batch holds an id that the service refuses: its neighbour is asked for by itself.
    save("biblio", ids[2:3], _wrapped(_record(ids[2], "Three", "f1")))
    save("biblio", ids[4:], _wrapped(_record(ids[4], "Five", "", "Corn")))
    save("abstract", ids[1:2], _wrapped({"abstract": {"@lang": "en", "p": [{"$": "Second"}, {"$": "chance"}]}}))
    asked = spark.createDataFrame([(i,) for i in [*ids, ids[0], None]], "id string")
    raw = remote.records(asked, "id", {"transport": "recorded", "path": str(folder)}, batch=2)
    assert sorted((r.first_id, r.n_ids, r.body is None) for r in raw.collect()) == [(ids[0], 2, False), (ids[2], 1, False), (ids[3], 1, True), (ids[4], 1, False)]
    flat = pipelines.fetch(asked, str(tmp_path / "work"), 2, transport="recorded", path=str(folder))
    got = {r.patent_id: r.abstract for r in flat.collect()}
    assert got == {"US1A": "One", "US2A": "Second chance", "US3A": "Three", "US5A": "Five"}
    assert remote.records(asked.limit(0), "id", {"transport": "echo"}).count() == 0
    first = pipelines.first_run(flat)
    assert {r.patent_id for r in first.collect()} == {"US1A", "US2A"} or {r.patent_id for r in first.collect()} == {"US3A", "US2A"}
    assert set(first.columns) == set(pipelines.FIRST_COLUMNS)


def test_second_run_from_recordings(spark, tmp_path):
    folder = tmp_path / "answers"
    folder.mkdir()
    hit = lambda n, family: {"@family-id": family, "document-id": {"@document-id-type": "docdb", "country": {"$": "US"}, "doc-number": {"$": str(n)}, "kind": {"$": "A"}}}
    body = {"ops:world-patent-data": {"ops:biblio-search": {"@total-result-count": "3", "ops:search-result": {"ops:publication-reference": [hit(1, "f"), hit(2, "f"), hit(3, "")]}}}}
    (folder / f"{urllib.parse.quote('q AND pa=' + chr(34) + 'Foo' + chr(34) + ' AND pd=2020', safe='')}.1.json").write_text(json.dumps(body))
    ids = ["US.1.A", "US.3.A"]
    (folder / f"biblio.{urllib.parse.quote(','.join(ids), safe='')}.json").write_text(_wrapped(*[_record(i, "Text", "f" if i == ids[0] else "") for i in ids]))
    made = pipelines.second_run(spark, ["q"], 2020, 2020, str(tmp_path / "work"), transport="recorded", path=str(folder), applicant="Foo")
    assert sorted((r.patent_id, r.family_id) for r in made.collect()) == [("US1A", "f"), ("US3A", "US3A")]
    assert spark.read.parquet(str(tmp_path / "work" / "years")).count() == 2
    assert [r.patent_id for r in pipelines.preview(made, 1).collect()] == [min(made.collect(), key=lambda r: r.seq).patent_id]


def test_charts_and_guards(spark, tmp_path):
    df = spark.createDataFrame([("2001", 3), ("2002 & <x>", 6), (None, None)], "year string, n long")
    for draw in (charts.columns, charts.bars):
        draw(df, "year", "n", str(tmp_path / "c.svg"), "A & B")
        tree = ElementTree.parse(tmp_path / "c.svg")
        assert len([x for x in tree.iter() if x.tag.endswith("rect")]) == 3
        draw(df.limit(0), "year", "n", str(tmp_path / "c.svg"))
    with pytest.raises(ValueError):
        charts.bars(spark.range(charts.MOST_BARS + 1).select("id", F.col("id").alias("n")), "id", "n", str(tmp_path / "c.svg"))
    with pytest.raises(FileNotFoundError):
        delimited.read(spark, str(tmp_path / "absent.csv"), ["a"])
    got = spark.createDataFrame([(0,), (187,), (None,)], "s int").select(T.elapsed(F.col("s")).alias("e"), T.url_quote(F.lit('a b+"ü')).alias("u")).collect()
    assert [r.e for r in got] == ["0m 0s", "3m 7s", None] and got[0].u == "a%20b%2B%22%C3%BC"
