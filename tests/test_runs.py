"""Locations and seasons of a run's records."""

from pyspark.sql import functions as F

from tessera.functions.text import MISSING, season
from tessera.sources import connectors


def test_stored_rows_have_each_location_read_once(spark):
    places = ["Toronto, ON, Canada", None, "Paris, France; London, UK", "", "Remote, Canada"]
    rows = spark.createDataFrame([("a", f"t{i % 3}", f'{{"jobs": [{{"id": "{i}", "title": "Intern {i}", "location": {{"name": "{places[i % 5]}"}}}}]}}' if places[i % 5] is not None else f'{{"jobs": [{{"id": "{i}", "title": "Intern {i}"}}]}}', i) for i in range(40)], "company string, career_url string, payload string, ord int")
    for source in ("greenhouse", "lever"):
        landed = rows.withColumn("payload", F.regexp_replace(F.regexp_replace("payload", r'^\{"jobs": |\}$', ""), '"title"', '"text"')) if source == "lever" else rows
        raw = connectors.REGISTRY[source].envelope(landed)
        plain, stored = connectors.normalise(raw, source, "2025-01-01"), connectors.REGISTRY[source].normalise_stored(raw, "2025-01-01")
        assert stored.columns == plain.columns and plain.count() == 40
        assert sorted(map(str, stored.collect())) == sorted(map(str, plain.collect()))
        # The lookup reads places below a grouping, so the plan asks for distinct texts.
        plan = stored._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate" in plan and "Aggregate" not in plain._jdf.queryExecution().optimizedPlan().toString()


def test_seasons(spark):
    titles = {"Intern": MISSING, None: MISSING, "Intern, summer 2026": "2026", "2027 Fall co-op": "2027", "Winterize": MISSING, "Intern 2025": "2025", "Class of 1999": MISSING, "WINTER student": "", "12026": MISSING}
    got = {r.t: r.s for r in spark.createDataFrame([(t,) for t in titles], "t string").select("t", season(F.col("t")).alias("s")).collect()}
    for title, part in titles.items():
        assert got[title] == part if part in (MISSING, "2025") else part in got[title] and got[title] != MISSING, title
