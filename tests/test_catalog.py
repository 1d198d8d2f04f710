import random

import pytest
from pyspark.sql import functions as F

from tessera.functions import dates, locations, text, urls
from tessera.operators import leads, merge
from tessera.operators.dedupe import chained, first_wins, greedy, last_wins
from tessera.plans import report
from tessera.sources import connectors


def values(spark, items, column):
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(items)], "i int, x string")
    return [r[0] for r in rows.orderBy("i").select(column(F.col("x")).alias("y")).collect()]


def test_titles(spark):
    titles = ["Senior Manager, Student Programs", "Lead Engineer, New Grad", "Students Wanted", "co\u00a0op term", "Entry-level Clerk", "", None, "Early stage startup"]
    assert values(spark, titles, text.job_type) == ["internship", None, None, "internship", "new_grad", None, None, "internship"]
    assert values(spark, ["Analyst 2026 Summer", "Fall 2027 Co-op", "Winter help", "Class of 2026", "x"], text.season) == ["Summer 2026", "Fall 2027", "Winter", "2026", "Not specified"]
    assert values(spark, [" A&B Co. ", "", "--"], text.slug) == ["a-b-co", "unknown", "unknown"]


def test_places(spark):
    given = ["San Diego, CA", "Warren, Michigan, United States", "US-TN-Tullahoma", "Remote - United States", "remote", "4 locations", "HQ: Toronto, Ontario, Canada", "Paris, France; paris, FRANCE / London, UK", "", "usa", "12 Main St, Ottawa, ON"]
    want = ["San Diego, Canada", "Michigan, United States", "US-Tn-Tullahoma", "United States Remote", "Remote", "4 Locations", "Toronto, ON, Canada", "Paris, France / London, United Kingdom", "Not specified", "United States", "Ottawa, ON"]
    assert values(spark, given, locations.places) == want
    assert values(spark, ["US-NY-New-York | CA-ON-Toronto", "CA-QC", "us"], locations.coded_places) == ["New York, NY, United States / Toronto, ON, Canada", "QC, Canada", "United States"]


def test_dates(spark):
    assert values(spark, ["1767225600000", "1767225600", "x", None], dates.epoch_date) == ["2026-01-01", "2026-01-01", None, None]
    assert values(spark, ["2026-01-02T23:30:00-05:00", "2026-13-01", "2026-01-02"], dates.iso_date) == ["2026-01-02", None, "2026-01-02"]
    assert values(spark, ["1/5/2026 3:04 PM", "12/31/2025", "soon"], dates.posted_date) == ["2026-01-05", "2025-12-31", None]


def test_urls(spark):
    given = ["https://acme.wd5.myworkdayjobs.com/en-US/Careers/job/x/y", "https://jobs.lever.co/Acme/123", "https://boards-api.greenhouse.io/v1/boards/acme/jobs", "https://jobs.ashbyhq.com/Ac%20me/1", "https://x.icims.com/jobs/1", "https://a.fa.oraclecloud.com/hcmUI/CandidateExperience/en/sites/CX_1/job/2", "https://ats.rippling.com/en-US/acme/jobs/1", "https://apply.workable.com/acme/j/1", "https://example.com/x", "https://jobs.lever.co/"]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(given)], "i int, u string").withColumn("p", urls.source_parts(F.col("u")))
    got = [tuple(r) for r in rows.orderBy("i").select("p.source", "p.canonical", urls.identity_text(urls.identity(F.col("p")))).collect()]
    assert got == [
        ("workday", "https://acme.wd5.myworkdayjobs.com/en-US/Careers", "workday :: acme :: careers"),
        ("lever", "https://jobs.lever.co/acme", "lever :: acme"),
        ("greenhouse", "https://boards.greenhouse.io/acme", "greenhouse :: acme"),
        ("ashby", "https://jobs.ashbyhq.com/Ac%20me", "ashby :: ac me"),
        ("icims", "https://x.icims.com/jobs/search", "icims :: classic :: x.icims.com"),
        ("oracle_hcm", "https://a.fa.oraclecloud.com/hcmUI/CandidateExperience/en/sites/CX_1", "oracle_hcm :: a.fa.oraclecloud.com :: en :: cx_1"),
        ("rippling", "https://ats.rippling.com/acme/jobs", "rippling :: acme"),
        ("workable", "https://apply.workable.com/acme", "workable :: acme"),
        (None, None, None),
        ("lever", None, None),
    ]
    assert values(spark, ["HTTPS://Ex.com/a//b/?q=1#f", "ftp://x"], urls.page_url) == ["https://ex.com/a/b?q=1", ""]


def test_greedy_against_a_plain_loop(spark):
    rng = random.Random(1)
    for _ in range(2):
        rows = [(i, rng.choice(["", *"abcdefgh"]), rng.choice("pqrstuvw")) for i in range(40)]
        seen, want = set(), []
        for i, a, b in rows:
            keys = {("a", a)} - {("a", "")} | {("b", b)}
            if not keys & seen:
                seen |= keys
                want.append(i)
        df = spark.createDataFrame(rows, "ord int, a string, b string")
        assert sorted(r.ord for r in greedy(df, ["a", "b"], "ord").collect()) == want


def test_keep_first_last_and_chained(spark):
    df = spark.createDataFrame([(0, "a", "x"), (1, "a", "y"), (2, "b", "y"), (3, "", "z"), (4, "", "w")], "ord int, a string, b string")
    assert [r.ord for r in first_wins(df, ["a"], ["ord"]).orderBy("ord").collect()] == [0, 2, 3]
    assert [(r.ord, r.b) for r in last_wins(df, ["a"], ["ord"]).orderBy("ord").collect()] == [(0, "y"), (2, "y"), (3, "w")]
    assert [r.ord for r in chained(df, ["a", "b"], ["ord"]).orderBy("ord").collect()] == [0, 2, 3, 4]


def test_merge(spark):
    names = "ord int, id string, company string, title string, location string, source string, url string, date_added string, active boolean"
    make = lambda *rows: spark.createDataFrame([(i, r[0], r[1], "t", "l", "s", "u", r[2], True) for i, r in enumerate(rows)], names)
    active, fetched = make(("1", "A", "d1"), ("2", "A", "d2"), ("3", "B", "d3")), make(("1", "A", "now"), ("4", "A", "now"), ("5", "A", "now"))
    archived = make(("5", "A", "d5"), ("6", "A", "d6")).withColumn("date_archived", F.lit("old"))
    touched = spark.createDataFrame([("s", "A")], "source string, company string")
    live, shelf = merge.merge_snapshots(active, fetched, archived, touched, "today")
    assert sorted((r.id, r.date_added) for r in live.collect()) == [("1", "d1"), ("3", "d3"), ("4", "now"), ("5", "d5")]
    assert sorted((r.id, r.date_archived) for r in shelf.collect()) == [("2", "today"), ("6", "old")]


def test_board(spark, tmp_path):
    jobs = spark.createDataFrame([(0, "A|B", "Intern", "Toronto, ON", "internship", "", "2026-01-02", True), (1, "C", "Intern", "", "internship", "http://x", "2026-02-02", True), (2, "D", "Intern", "", "internship", "", "2026-03-02", False)], "ord int, company string, title string, location string, type string, url string, date_added string, active boolean")
    lines = report.render(jobs, "internship")
    assert lines[2:] == ["| C | Intern | Not specified | [Apply](http://x) | 2026-02-02 |", "| A\\|B | Intern | Toronto, ON | [Apply](#) | 2026-01-02 |"]
    assert report.render(jobs, "new_grad")[2:] == ["| No jobs found | | | | |"]
    file = tmp_path / "r.md"
    file.write_bytes(b"a\r\n<!--s-->old<!--e-->\r\n")
    report.splice(str(file), "<!--s-->", "<!--e-->", ["x"])
    assert file.read_bytes() == b"a\r\n<!--s-->\r\nx\r\n<!--e-->\r\n"
    with pytest.raises(ValueError):
        report.splice(str(file), "<!--q-->", "<!--e-->", [])


def test_connectors(spark):
    payloads = {
        "greenhouse": '{"jobs":[{"id":7,"title":"Intern","absolute_url":"u","updated_at":"2026-01-02T00:00:00-05:00","location":{"name":"Toronto, Ontario"}}]}',
        "lever": '[{"id":"a","text":"New Grad Dev","hostedUrl":"h","createdAt":1767225600000,"categories":{"location":"San Diego, CA"}}]',
        "ashby": '{"jobs":[{"id":"b","title":"Dev","employmentType":"Intern","jobUrl":"j","isRemote":true,"address":{"postalAddress":{"addressCountry":"Canada"}}},{"id":"c","title":"Intern","isListed":false}]}',
        "workday": '{"jobPostings":[{"title":"Intern","externalPath":"/job/1","locationsText":"2 Locations","primaryLocation":"Ottawa, ON","postedOn":"Posted Today"},{"title":"Intern","externalPath":"/job/1"}]}',
        "rippling": '{"items":[{"id":"r","name":"Intern","url":"w","locations":[{"name":"A"}]},{"id":"r","name":"Intern","url":"v","locations":[{"name":"B"},{"name":"a"}]}]}',
        "workable": '{"results":[{"shortcode":"k","title":"Intern","remote":true,"locations":[{"city":"Paris","country":"France"}],"published":"2026-01-01"}]}',
        "smartrecruiters": '{"content":[{"id":"s","name":"Intern","releasedDate":"2026-01-03","location":{"city":"London","country":"uk","remote":false}}]}',
        "oracle_hcm": '{"items":[{"requisitionList":[{"Id":"9","Title":"Intern","PrimaryLocation":"Canada"}]}]}',
        "icims": '{"jobs":[{"data":{"slug":"11","title":"Intern","full_location":"CA-ON-Toronto","posted_date":"1/2/2026"}}]}',
    }
    got = {}
    for source, payload in payloads.items():
        landed = spark.createDataFrame([("Acme", "https://c", payload, 0)], "company string, career_url string, payload string, ord int")
        got[source] = [(r.id, r.type, r.location, r.url, r.date_posted) for r in connectors.records(landed, source, "2026-02-01").collect()]
    assert got == {
        "greenhouse": [("greenhouse-acme-7", "internship", "Toronto, ON", "u", "2026-01-02")],
        "lever": [("lever-acme-a", "new_grad", "San Diego, CA", "h", "2026-01-01")],
        "ashby": [("ashby-acme-b", "internship", "Canada / Canada Remote", "j", None)],
        "workday": [("workday-acme-job-1", "internship", "Ottawa, ON", "https://c/job/1", "Posted Today")],
        "rippling": [("rippling-acme-r", "internship", "A / B", "w", None)],
        "workable": [("workable-acme-k", "internship", "Remote, Paris, France", "https://c/j/k/", "2026-01-01")],
        "smartrecruiters": [("smartrecruiters-acme-s", "internship", "London, United Kingdom", "https://c/s", "2026-01-03")],
        "oracle_hcm": [("oracle_hcm-acme-9", "internship", "Canada", "https://c/job/9", None)],
        "icims": [("icims-acme-11", "internship", "Toronto, ON, Canada", "https://c/jobs/11?lang=en-us&icims=1", "2026-01-02")],
    }


def test_leads(spark):
    rows = spark.createDataFrame([(0, "acme", "https://jobs.lever.co/acme/1"), (1, "Acme", "https://jobs.lever.co/acme/2"), (2, "Acme", "https://jobs.lever.co/ACME/3"), (3, "B", "https://x.com/1")], "ord int, company string, url string")
    assert [tuple(r) for r in leads.roll_up(rows).collect()] == [("Acme", "https://jobs.lever.co/acme", "lever", "3", "https://jobs.lever.co/acme/1", "lever :: acme")]
    sources = spark.createDataFrame([(0, "A", "https://jobs.lever.co/a", "true"), (1, "B", "https://jobs.lever.co/a/", "yes"), (2, "a", "https://jobs.lever.co/z", "1"), (3, "C", "https://jobs.lever.co/c", "maybe"), (4, "D", "https://jobs.lever.co/d", "no")], "ord int, company string, url string, enabled string")
    owners = spark.createDataFrame([("E", "lever", "https://jobs.lever.co/d")], "company string, source string, url string")
    configs, cleaned = leads.compile_catalog(sources, owners)
    assert [(r.company, r.url, r.enabled, r.change) for r in configs.collect()] == [("A", "https://jobs.lever.co/a", True, "added")]
    assert [r.ord for r in cleaned.collect()] == [0, 3]


def test_classic_icims_pages(spark):
    card = '<li class="row iCIMS_JobCardItem x">\n<span title="{posted}" >2 days<span class="sr-only">posted</span></span><a class="y" href="https://x.icims.com/jobs/{n}/dev/job?in_iframe=1&amp;mode=a">\n<h3>{title}</h3></a><dl><dt><span>{label}</span></dt> <dd><span>{place}</span></dd></dl></li>'
    first = card.format(n=11, posted="1/2/2026 9:30 AM", title="Old", label="Location", place="CA-ON-Toronto")
    pages = [
        " <html>" + first + '<li class="iCIMS_JobCardItem"><a href="/about"><h3>Intern</h3></a></li>' + card.format(n=12, posted="", title="Caf&eacute;&#8211;R&amp;D <b>Intern</b>", label="Category", place="Ottawa"),
        "<html>" + first.replace("Old", "Software Intern") + "</html>",
        '{"jobs":[{"data":{"slug":"13","title":"Intern","full_location":"CA-ON-Toronto"}}]}',
        "<html>none</html>",
        None,
    ]
    landed = spark.createDataFrame([("Acme", "https://c", p, i) for i, p in enumerate(pages)], "company string, career_url string, payload string, ord int")
    got = sorted((r.id, r.title, r.location, r.url, r.date_posted) for r in connectors.records(landed, "icims", "2026-02-01").collect())
    assert [x[:2] for x in got] == [("icims-acme-11", "Software Intern"), ("icims-acme-12", "Café–R&D Intern"), ("icims-acme-13", "Intern")]
    assert got[0][2:] == ("Toronto, ON, Canada", "https://x.icims.com/jobs/11/dev/job?mode=a", "2026-01-02")
    assert got[1][3:] == ("https://x.icims.com/jobs/12/dev/job?mode=a", None) and got[2][3] == "https://c/jobs/13?lang=en-us&icims=1"
