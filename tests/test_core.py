import json
import os

import pytest
from pyspark.sql import functions as F

from strataline import lexicons as L
from strataline.functions import text as T
from strataline.functions.keys import is_missing, plain_family
from strataline.operators import families, organisations, rules
from strataline.plans import slices, terms
from strataline.sources import delimited, remote
from strataline.streaming import arrivals

COMPANIES = [
    ("Alnylam Pharmaceuticals, Inc. [US]", "ALNYLAM PHARMACEUTICALS"), ("ALNYLAM PHARMACEUTICALS INC", "ALNYLAM PHARMACEUTICALS"), ("Novo Nordisk A/S", "NOVO NORDISK"),
    ("Univ Texas", "UNIVERSITY OF TEXAS"), ("The Medical College of Wisconsin, Inc.", "MEDICAL COLLEGE OF WISCONSIN"), ("Université de Liège", "UNIVERSITY OF LIEGE"),
    ("Merck & Co., Inc.", "MERCK"), ("A&B Labs", "AANDB LABS"), ("LIU WEI [CN]", None), ("Nationwide Children's Hospital", "NATIONWIDE CHILDRENS HOSPITAL"), ("株式会社", None),
    ("Ørsted-Bio GmbH", "RSTED BIO"), ("[US] The X Corp", "THE X"), ("Straße AG", "STRASSE"), ("123", None), ("A. L.L.C.", "A"), ("Bisirna Therapeutics", "BISIRNA THERAPEUTICS"),
]


def test_companies(spark):
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(COMPANIES)], "i int, a string")
    name = organisations.normalised(F.col("a"))
    got = {r.i: r.c for r in df.select("i", F.when(organisations.acceptable(name), organisations.unified(name)).alias("c")).collect()}
    assert got == {i: c for i, (_, c) in enumerate(COMPANIES)}


def test_facts_count_once_and_skip_nulls(spark):
    rows = [(1, "f1", "20200101", "Foo Inc|FOO, INC."), (2, None, "20190101", "Foo"), (3, None, None, "Foo"), (4, "f2", "", None)]
    made = organisations.facts(spark.createDataFrame(rows * 2, "seq long, family_id string, priority_date string, applicant string"))
    assert made.count() == 6 and "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
    top = organisations.top(organisations.facts(spark.createDataFrame(rows, "seq long, family_id string, priority_date string, applicant string")), 5).collect()
    assert [(r.company, r.n_families, r.earliest) for r in top] == [("FOO", 2, "20190101")]


def test_tier_truth_table(spark):
    rows = [tuple(bool(i >> b & 1) for b in range(5)) for i in range(32)]
    df = spark.createDataFrame(rows, "s boolean, a boolean, f boolean, g boolean, d boolean")
    got = df.groupBy(rules.tier(*[F.col(c) for c in "safgd"]).alias("t")).count().collect()
    counts = {r.t.split(" —")[0]: r["count"] for r in got}
    assert counts == {"TIER 1": 1, "TIER 2": 1, "TIER 3": 1, "TIER 4A": 4, "TIER 4B": 16, "TIER 5": 3, "TIER 6": 2, "TIER 7": 3, "UNCLASSIFIED": 1}


def test_signal_traps(spark):
    texts = [("siRNAs", False), ("an siRNA", True), ("βsiRNA", False), ("miRNA interference", True), ("RNA interference", True), ("post-transcriptional silencing", True), (None, False)]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "i int, title string")
    made = rules.signals(F.col("title"), F.lit(None).cast("string"), F.lit(""), F.lit(None).cast("string"))
    assert {r.i: r.x for r in df.select("i", made["text"].alias("x")).collect()} == {i: w for i, (_, w) in enumerate(texts)}
    agri = spark.createDataFrame([("cornea",), ("corn",), ("tomato cell",), ("tomato plants",)], "t string").select(rules.matches(F.col("t"), rules.any_word(L.AGRI)).alias("x"))
    assert [r.x for r in agri.collect()] == [False, True, False, True]


def test_text(spark):
    rows = [("<p>a\n[0012]  b</p> ", "é Ø ß ｆ", "000123.0"), (None, None, "  "), ("", "x" * 100_000, "0000")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    got = df.select(T.clean(F.col("a")).alias("a"), T.fold(F.col("b")).alias("b"), plain_family(F.col("c")).alias("c")).collect()
    assert [(r.a, len(r.b), r.c) for r in got] == [("a b", 4, "123"), (None, 0, None), ("", 100_000, "0")]
    marks = spark.createDataFrame([(None,), ("",), (" - ",), ("N/A",), ("no abstract available in epo database.",), ("A real one.",)], "t string")
    assert [r.m for r in marks.select(is_missing(F.col("t")).alias("m")).collect()] == [True] * 5 + [False]


def test_families(spark):
    ids = spark.createDataFrame([("a", "1", "EP", 1), ("b", " 1", "US", 2), ("c", "1", "US", 3), ("d", "", "US", 4), ("d", None, "US", 5), ("e", "2", None, 6)], "id string, family_id string, country string, seq long")
    got = {(r.id, r.has_family, r.seq) for r in families.by_office(ids).collect()}
    assert got == {("b", True, 2), ("d", False, 4), ("e", True, 6)}
    rows = [(1, "p", "", "2020"), (2, "", "", "2020"), (3, None, None, "2020"), (4, None, None, None), (5, "q", "7", None), (300_001, "", "", "2020"), (300_002, None, None, "2020")]
    fixed = families.repaired_family(spark.createDataFrame(rows, "seq long, patent_id string, family_id string, publication_date string"))
    assert {r.seq: r.family_id for r in fixed.collect()} == {1: "p", 2: "UNKNOWN_FAM_0_2020", 3: "UNKNOWN_FAM_1_2020", 4: "UNKNOWN_FAM_0_0000", 5: "7", 300_001: "UNKNOWN_FAM_2_2020", 300_002: "UNKNOWN_FAM_3_2020"}
    dup = spark.createDataFrame([(1, "f", "x"), (1, "f", "x"), (2, None, "y"), (3, None, "z")], "seq long, fam string, `__key` string")
    assert sorted((r.seq, r.fam) for r in families.first_per_key(dup, F.col("fam"), [F.col("seq")]).collect()) == [(1, "f"), (2, None)]
    assert families.first_per_key(dup.limit(0), F.col("fam"), [F.col("seq")]).count() == 0


def test_slices_and_pages(spark):
    days = ["2020-01-01"] * 5 + ["2020-02-01"] * 30 + ["2020-02-02"] * 3 + ["2021-07-01"] * 4
    df = spark.createDataFrame([(d,) for d in days] + [(None,)], "d string")
    made = slices.time_slices(df, F.col("d").cast("date"), 10)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and plan.count("Scan ") == 1
    assert sorted((r.level, str(r.first_day), r.n, r.truncated) for r in made.collect()) == [("day", "2020-02-01", 30, True), ("day", "2020-02-02", 3, False), ("month", "2020-01-01", 5, False), ("year", "2021-01-01", 4, False)]
    pages = sorted((str(r.first_day), r.range_begin, r.range_end) for r in slices.pages(made, page=8, cap=20).collect())
    assert [p for p in pages if p[0] == "2020-02-01"] == [("2020-02-01", 1, 8), ("2020-02-01", 9, 16), ("2020-02-01", 17, 20)]


def test_terms(spark):
    assert terms.single_queries(spark).count() == 33
    q = terms.block_queries(spark, 2020, 2020, applicant="Foo").orderBy("block").collect()
    assert len(q) == 18 and q[0].query == '(ta=siRNA* OR ta=RNAi*) AND (cpc=C12N15/113 OR cpc=A61K31/713) AND pa="Foo" AND pd=2020'


def test_delimited_round_trip(spark, tmp_path):
    rows = [("001", 'a "b"; c', "x\ny"), ("002", None, ""), ("ü", "--- é ---", ";")]
    df = spark.createDataFrame(rows, "id string, title string, note string")
    delimited.write(df, str(tmp_path / "out"))
    part = next(p for p in (tmp_path / "out").iterdir() if p.name.startswith("part") and p.stat().st_size)
    assert part.read_bytes().startswith(b"\xef\xbb\xbfid;")
    back = delimited.read(spark, str(tmp_path / "out"), ["id", "title", "note"])
    assert sorted(map(tuple, back.collect())) == sorted((a, b, c or None) for a, b, c in rows)
    with pytest.raises(ValueError, match="missing columns: nope"):
        delimited.require(df, ["id", "nope"])
    assert delimited.output_name("a/b.csv", "top5_") == "a/top5_b.csv"
    dated = spark.createDataFrame([("1", "20200101"), ("2", None)], "id string, publication_date string")
    delimited.write_by_year(dated, str(tmp_path / "years"))
    delimited.write_by_year(dated.where("id = '2'"), str(tmp_path / "years"))
    assert spark.read.parquet(str(tmp_path / "years")).count() == 2


def test_remote_source_from_recordings(spark, tmp_path):
    def hit(i):
        return {"@family-id": str(i // 2), "document-id": [{"@document-id-type": "epodoc"}, {"@document-id-type": "docdb", "country": {"$": "US"}, "doc-number": {"$": f"{i} .0"}, "kind": {"$": "A"}}]}

    def save(query, begin, n, found):
        import urllib.parse

        body = {"ops:world-patent-data": {"ops:biblio-search": {"@total-result-count": str(n), "ops:search-result": {"ops:publication-reference": found}}}}
        (tmp_path / f"{urllib.parse.quote(query, safe='')}.{begin}.json").write_text(json.dumps(body))

    save("q AND pd=2020", 1, 150, [hit(i) for i in range(100)])
    save("q AND pd=2020", 101, 150, [hit(i) for i in range(90, 150)])
    save("q AND pd=2021", 1, 1, hit(7))
    remote.register(spark)
    df = spark.read.format("patent_search").options(queries=json.dumps(["q"]), firstyear="2019", lastyear="2021", transport="recorded", path=str(tmp_path)).load()
    rows = df.collect()
    assert len(rows) == 151 and rows[0].id == "US.00.A" and len({r.seq for r in rows}) == 151
    counted = {"q AND pd=2020": 5000, 'q AND pd within "20200101 20200131"': 3000, 'q AND pd within "20200105 20200105"': 2500, 'q AND pd within "20200201 20200229"': 10}
    assert [n for _, n in remote.slices_of("q", 2020, lambda q: counted.get(q, 0))] == [2500, 10]


def test_stream(spark, tmp_path):
    rows = [("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:01:00"), ("b", "2024-01-01 00:02:00")]
    df = spark.createDataFrame(rows, "id string, t string").select("id", F.col("t").cast("timestamp").alias("t"))
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = arrivals.first_arrivals(stream, "id", "t").writeStream.format("memory").queryName("firsts").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.id for r in spark.table("firsts").collect()) == ["a", "b"]


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.001"), reason="no test tables")
def test_queries_against_sql(spark):
    import duckdb

    import strataline.queries as core
    from strataline.sql import oracle_sql

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for f in os.listdir(folder):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{folder}/{f}')")
    queries = core.queries()
    for name, sql in oracle_sql().items():
        want = con.execute(sql)
        columns = [c[0] for c in want.description]
        got = queries[name](spark, folder)
        assert sorted(got.columns) == sorted(columns), name
        plain = lambda v: round(float(v), 6) if isinstance(v, float) else str(v)[:19] if hasattr(v, "year") else v
        a = sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=repr)
        b = sorted((tuple(map(plain, r)) for r in want.fetchall()), key=repr)
        assert a == b, name
