"""Flows, readers, writers and commands; queries against their SQL on the smallest tables."""

import json

import duckdb
import pytest
from pyspark.sql import functions as F

from tessera import cli
from tessera.operators import detect, leads
from tessera.operators.dedupe import greedy, numbered_names
from tessera.operators.run import parse_sources
from tessera.plans import cases, flows, registry, report
from tessera.sources import landed, workday
from tessera.streaming.incremental import merge_stream

SMALL = "/root/testdata/sf0.001"
CHOSEN = [*cases.CASES, "connector_rippling", "connector_icims", "workday_postings", "jibe_facets", "top_pages", "platform_evidence", "detected_candidates", "discovered_pages", "archived_sources", "compiled_catalog", "cleaned_sources", "promotion_review", "daily_run", "greedy_keys", "merged_archive"]


def check_query(spark, name):
    con = duckdb.connect()
    for table in ("orders", "customer", "nation", "supplier", "events", "pages"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    df, want = registry.QUERIES[name](spark, SMALL), con.sql(registry.ORACLE_SQL[name])
    columns = sorted(df.columns)
    assert columns == sorted(want.columns)
    rows = lambda x: sorted((tuple(r) for r in x), key=str)
    assert rows(df.select(*columns).collect()) == rows(want.select(*(f'"{c}"' for c in columns)).fetchall())


@pytest.mark.parametrize("name", CHOSEN)
def test_query_against_sql(spark, name):
    check_query(spark, name)


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.ORACLE_SQL)
    assert set(flows.QUERIES) <= set(registry.QUERIES)


def test_unique_names(spark):
    rows = spark.createDataFrame([(0, "A", "x", "s"), (1, "a", "y", "s"), (2, "B", "z", "s"), (3, "C", "z", "s"), (4, "D", "q", "s"), (5, "d", "q", "s"), (6, "D", "q", "t")], "ord int, name string, label string, source string")
    used = spark.createDataFrame([("b", "s"), ("B - Z", "s"), ("b - z 3", "s"), ("E", "s")], "name string, source string")
    got = {r.ord: r.name for r in numbered_names(rows, "name", "label", "source", ["ord"], used).collect()}
    assert got == {0: "A - x", 1: "a - y", 2: "B - z 2", 3: "C", 4: "D - q", 5: "d - q 2", 6: "D"}


def test_a_chain_of_conflicts_is_followed_to_its_end(spark):
    rows = spark.createDataFrame([(i, f"k{i}", f"k{i + 1}") for i in range(9)], "ord int, a string, b string").selectExpr("ord", "a", "b")
    both = rows.select("ord", F.col("a").alias("x"), F.lit("").alias("y")).unionByName(rows.select("ord", F.col("b").alias("x"), F.lit("").alias("y")))
    assert both.count() == 18
    chain = spark.createDataFrame([(i, f"p{i // 2}", f"q{(i + 1) // 2}") for i in range(9)], "ord int, a string, b string")
    assert sorted(r.ord for r in greedy(chain, ["a", "b"], "ord").collect()) == [0, 2, 4, 6, 8]


def test_readers(spark, tmp_path):
    assert landed.read_json_list(spark, f"{tmp_path}/none.json", "a string").columns == ["ord", "a"]
    (tmp_path / "o.json").write_text('{"a": 1}')
    (tmp_path / "l.json").write_text('[{"a": "x"}, 3, {"a": "y"}]')
    assert landed.read_json_list(spark, f"{tmp_path}/o.json", "a string").count() == 0
    assert [(r.ord, r.a) for r in landed.read_json_list(spark, f"{tmp_path}/l.json", "a string").collect()] == [(0, "x"), (2, "y")]
    with pytest.raises(Exception, match="not a JSON list"):
        landed.read_json_list(spark, f"{tmp_path}/o.json", "a string", mode="list").collect()
    deep = {"company": "deepest"}
    for i in range(11):
        deep = {"level": i, "inner": [deep] if i % 2 else deep}
    root = tmp_path / "root"
    (root / "data" / "sub").mkdir(parents=True)
    (root / "data" / "sub" / "deep.json").write_text(json.dumps(deep))
    (root / "data" / "custom_ats_candidates.csv").write_text("company\nno\n")
    (root / "data" / "custom_companies.csv").write_text("company,url,enabled\n Acme ,https://acme.com/careers,true\n")
    (root / "data" / "t.md").write_text("| Globex | [a](https://globex.com/jobs/1) | [b](https://globex.com/jobs/2) |\nno\n")
    (root / "other").mkdir()
    (root / "other" / "x.json").write_text("[]")
    records = landed.read_json_records(spark, f"{root}/data/sub/deep.json")
    assert records.count() == 12 and records.filter("record LIKE '{\"company\"%'").count() == 1
    assert [r.path.rsplit("/", 1)[-1] for r in landed.find_files(spark, str(root)).collect()] == ["custom_companies.csv", "deep.json", "t.md"]
    assert sorted(map(tuple, landed.read_records(spark, f"{root}/data/t.md").collect())) == [("Globex", "https://globex.com/jobs/1"), ("Globex", "https://globex.com/jobs/2")]
    cli.main(["discover", "--root", str(root), "--out", f"{tmp_path}/found", "--report", f"{tmp_path}/gone"], spark)
    found = spark.read.option("header", True).csv(f"{tmp_path}/found")
    assert sorted((r.company, r.career_url, r.discovered_from) for r in found.collect()) == [("Acme", "https://acme.com/careers", "manual_custom_companies"), ("Globex", "https://globex.com/jobs", "existing_data")]


def test_company_inputs(spark):
    one = spark.createDataFrame([(0, "Acme", "https://a.com/x/", "true"), (1, "acme", "https://A.com/x", "yes"), (2, "B", "https://b.com", "no"), (3, "C", "https://c.com", "maybe"), (4, "D", "https://d.com", None)], "ord int, company string, url string, enabled string")
    two = spark.createDataFrame([(0, "E", "https://e.com", "simplify"), (1, "Acme", "https://a.com/x", "late")], "ord int, company string, career_url string, discovered_from string")
    got = sorted(map(tuple, landed.company_inputs(one, two).collect()))
    assert got == [("Acme", "https://a.com/x", "manual"), ("D", "https://d.com/", "manual"), ("E", "https://e.com/", "simplify")]


def test_commands(spark, tmp_path):
    page = '<a href="https://boards.greenhouse.io/acme/jobs/1">x</a>'
    (tmp_path / "pages.json").write_text("\n".join(json.dumps(r) for r in [{"fetch_url": "https://acme.com/", "final_url": "https://acme.com/", "html": page, "status_code": 200}, {"fetch_url": "https://b.com/", "final_url": "https://b.com/", "html": page, "status_code": 404}]))
    (tmp_path / "in.csv").write_text("company,url,enabled\nAcme,https://acme.com,true\nB,https://b.com,true\n")
    cli.main(["detect", "--input", f"{tmp_path}/in.csv", "--pages", f"{tmp_path}/pages.json", "--out", f"{tmp_path}/out", "--checkpoint-every", "1"], spark)
    rows = spark.read.option("header", True).csv(f"{tmp_path}/out/*")
    assert sorted((r.company, r.detected_source, r.recommended_action) for r in rows.collect()) == [("Acme", "greenhouse", "validate_with_existing_ats_scraper"), ("B", None, "manual_review")]
    (tmp_path / "sources.csv").write_text("company,url,enabled\nOld,https://jobs.lever.co/old,true\n")
    (tmp_path / "cand.csv").write_text("company,detected_source,source_key,canonical_source_url,best_evidence_url,route_ready\nAcme,greenhouse,acme,,https://boards.greenhouse.io/acme,true\nX,lever,old,https://jobs.lever.co/old/,,true\n")
    cli.main(["promote", "--candidates", f"{tmp_path}/cand.csv", "--sources", f"{tmp_path}/sources.csv", "--review", f"{tmp_path}/review", "--apply", f"{tmp_path}/new"], spark)
    assert sorted((r.company, r.status) for r in spark.read.option("header", True).csv(f"{tmp_path}/review").collect()) == [("Acme", "accepted"), ("X", "skipped")]
    assert sorted(r.url for r in spark.read.option("header", True).csv(f"{tmp_path}/new").collect()) == ["https://boards.greenhouse.io/acme", "https://jobs.lever.co/old"]
    assert parse_sources(["A, b", "c"]) == {"a", "b", "c"} and parse_sources(None) is None and parse_sources([","]) is None


def test_writers(spark, tmp_path):
    rows = spark.createDataFrame([(1, "é"), (2, None)], "a int, b string")
    report.save_json_list(rows.coalesce(1), f"{tmp_path}/x.json")
    assert json.loads((tmp_path / "x.json").read_text()) == [{"a": 1, "b": "é"}, {"a": 2, "b": None}] and "é" in (tmp_path / "x.json").read_text()
    listing = spark.createDataFrame([(0, "Acme", "https://jobs.lever.co/acme/1")], "ord int, company string, url string")
    report.save_csv(leads.leads_in_order(leads.roll_up(listing)), f"{tmp_path}/leads", ["company", "url", "source", "job_count", "example_job_url", "identity"])
    assert spark.read.option("header", True).csv(f"{tmp_path}/leads").first().identity == "lever :: acme"


def test_workday_plan_and_listings(spark):
    assert workday.term_plan(["intern", " Internship", "student", "Co-Op", "coop", "co-op", "data", "DATA", "", "intern"]) == [("intern", ["Internship", "intern"]), ("student", []), ("Co-Op", ["coop", "co-op"]), ("data", [])]
    job = lambda n, title="Intern": {"title": title, "externalPath": f"/job/{n}"}
    page = lambda *jobs, total=2: json.dumps({"jobPostings": list(jobs), "total": total})
    rows = [
        ("Full", "", 0, page(job(1), job(2)), 0), ("Full", "intern", 0, page(job(3)), 1),
        ("Big", "", 0, page(job(4), total=900), 2), ("Big", "intern", 0, page(job(5), job(5)), 3),
        ("Broken", "intern", 0, page(job(6)), 4), ("Broken", "intern", 1, None, 5), ("Broken", "student", 0, page(job(7, "Student helper")), 6),
        ("Empty", "", 0, page(), 7), ("Empty", "intern", 0, page(job(8, "Engineer"), job(9)), 8),
    ]
    df = spark.createDataFrame([(c, "u", t, p, x, o) for c, t, p, x, o in rows], "company string, career_url string, term string, page int, payload string, ord int")
    got = sorted((r.company, r.raw.externalPath) for r in workday.postings(spark, df, ["intern", "student"]).collect())
    assert got == [("Big", "/job/5"), ("Broken", "/job/7"), ("Empty", "/job/9"), ("Full", "/job/1"), ("Full", "/job/2")]


def test_payload_shapes(spark):
    c = spark.createDataFrame([("A", "greenhouse", "a", "u1", True), ("B", "lever", "b", "u2", True), ("C", "greenhouse", "c", "u3", True), ("D", "ashby", "d", "u4", True), ("E", "lever", "e", "u5", True)], "company string, detected_source string, source_key string, canonical_source_url string, route_ready boolean")
    p = spark.createDataFrame([("u1", '{"jobs":[]}'), ("u2", "[]"), ("u3", "[1]")], "canonical_source_url string, payload string")
    status = lambda on: {r.company: r.validation_status for r in detect.shape_checked(c, p, enabled=on).collect()}
    assert status(True) == {"A": "valid", "B": "valid", "C": "invalid_shape", "D": "not_run", "E": "error"}
    assert set(status(False).values()) == {"not_run"}


def test_merge_stream(spark, tmp_path):
    names = "ord int, id string, company string, title string, location string, source string, url string, date_added string, active boolean"
    make = lambda *rows: spark.createDataFrame([(i, r, "A", "t", "l", "s", "u", "d", True) for i, r in enumerate(rows)], names)
    make("1", "2").write.parquet(f"{tmp_path}/a0")
    make().withColumn("date_archived", F.lit("x")).write.parquet(f"{tmp_path}/s0")
    make("2", "3").write.parquet(f"{tmp_path}/in/1")
    stream = spark.readStream.schema(names).parquet(f"{tmp_path}/in/*")
    merge_stream(stream, f"{tmp_path}/state", f"{tmp_path}/cp", lambda n: f"day{n}", (f"{tmp_path}/a0", f"{tmp_path}/s0")).awaitTermination()
    folder = spark.read.text(f"{tmp_path}/state/current").first()[0]
    assert sorted(r.id for r in spark.read.parquet(f"{folder}/active").collect()) == ["2", "3"]
    assert [(r.id, r.date_archived) for r in spark.read.parquet(f"{folder}/archived").collect()] == [("1", "day0")]
