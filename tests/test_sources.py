"""Fetching, markup, bad input, paging, chains of conflicts, resumed detection and case folding."""

import json
import random
import threading
from datetime import datetime
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from tessera import cli
from tessera.functions import dates, locations, text
from tessera.operators import detect
from tessera.operators.dedupe import greedy, numbered_names
from tessera.operators.graph import components
from tessera.plans import sites
from tessera.sources import connectors, fetching, landed, markup, workday
from tests.test_flows import SMALL, check_query

RNG = random.Random(3)


@pytest.mark.parametrize("name", [*sites.QUERIES, "page_links", "connector_ashby"])
def test_site_queries_against_sql(spark, name):
    check_query(spark, name)


class _Site(BaseHTTPRequestHandler):
    def do_GET(self):
        if self.path == "/moved":
            self.send_response(302)
            self.send_header("Location", "/latin")
            self.end_headers()
            return
        body, kind = {"/latin": ("caf\xe9".encode("latin-1"), "text/html; charset=latin-1"), "/list": (b'[{"a": 1}, 2]', "application/json"), "/bad": (b"\xff\xfeok", "text/html")}.get(self.path, (None, None))
        self.send_response(200 if body is not None else 404)
        self.send_header("Content-Type", kind or "text/plain")
        self.end_headers()
        self.wfile.write(body or b"no")

    def log_message(self, *_):
        pass


@pytest.fixture(scope="module")
def site():
    server = ThreadingHTTPServer(("127.0.0.1", 0), _Site)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_fetching_over_http(spark, site):
    urls = [f"{site}/{x}" for x in ("moved", "list", "bad", "gone")] + ["", "nonsense://x"]
    rows = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)] + [(9, None, 1)], "k int, url string, tries int")
    got = {r.k: r for r in fetching.fetched(rows, timeout=5, tries=2).collect()}
    assert (got[0].final_url, got[0].body, got[0].error, got[0].tries) == (f"{site}/latin", "café", None, 1)
    assert got[2].body == "��ok" and got[1].status_code == 200
    assert (got[3].status_code, got[3].body, got[3].tries) == (404, None, 2) and got[3].error.startswith("HTTPError")
    assert got[4].error == got[9].error == "no URL" and got[5].error.startswith("URLError")
    through = {r.url: r for r in fetching.fetched_urls(spark, urls[:4], timeout="5", itemsPerPartition="1").collect()}
    assert through[urls[0]].body == "café" and through[urls[3]].status_code == 404 and len(through) == 4
    lists = sorted(((r.url.rsplit("/", 1)[-1], r.ord, r.a, r.error) for r in fetching.json_lists(fetching.fetched(rows.filter("k < 3"), timeout=5), "a int").collect()), key=str)
    assert lists == [("bad", None, None, "not JSON"), ("list", 0, 1, None), ("moved", None, None, "not JSON")]
    pages = fetching.pages(fetching.fetched(rows.filter("k in (0, 3)"), timeout=5))
    assert sorted((r.html is None, r.error is None) for r in pages.collect()) == [(False, True), (True, False)]


def test_a_folder_as_a_source(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.html").write_bytes(b"one")
    (tmp_path / "y.html").write_bytes(b"tw\xff")
    spark.dataSource.register(fetching.source(fetching.store_get, "files"))
    rows = spark.read.format("files").option("folder", f"file://{tmp_path}").option("itemsPerPartition", "1").load()
    assert sorted((r.url.rsplit("/", 1)[-1], r.body, r.error) for r in rows.collect()) == [("x.html", "one", None), ("y.html", "tw�", None)]
    spark.dataSource.register(fetching.source())
    named = spark.read.format("fetched").option("fetcher", "tessera.sources.fetching:store_get").option("urls", json.dumps([f"file://{tmp_path}/y.html", f"file://{tmp_path}/no"])).load()
    assert sorted((r.body, r.error is None) for r in named.collect() if r.body) == [("tw�", True)] and named.count() == 2


def _fetcher(log):
    def get(url, timeout):
        with open(log, "a") as f:
            f.write(url + "\n")
        if "broken" in url:
            raise ConnectionError("refused")
        if url.endswith("/jobs/all"):
            return fetching.Answer(url, 200, '<a href="https://jobs.lever.co/deep/1">x</a>')
        return fetching.Answer(url, 200, '<a href="/jobs/all">Jobs</a>' if "deep" in url else '<a href="https://boards.greenhouse.io/acme/jobs/1">x</a>')

    return get


def test_detection_through_a_fetcher_goes_on_where_it_stopped(spark, tmp_path):
    names = ["acme", "deep", "broken", "other"]
    companies = spark.createDataFrame([(i, n.title(), f"https://{n}.com", "t") for i, n in enumerate(names)], "ord int, company string, url string, discovered_from string")
    log, out = str(tmp_path / "log"), f"{tmp_path}/out"
    pages = detect.fetched_pages(_fetcher(log))
    whole = {r.company: r for r in detect.detect(companies, pages).collect()}
    assert whole["Deep"].detected_source == "lever" and whole["Acme"].source_key == "acme"
    assert whole["Broken"].route_block_reason == "ConnectionError: refused" and whole["Broken"].recommended_action == "manual_review"
    asked = open(log).read().split()
    assert sorted(asked) == sorted([f"https://{n}.com/" for n in names] + ["https://deep.com/jobs/all"])

    class Stop(Exception):
        pass

    def stop(k, parts):
        if k == 2:
            raise Stop

    with pytest.raises(Stop):
        detect.detect_in_parts(companies, pages, out, every=1, progress=stop)
    before = len(open(log).read().split())
    seen = []
    assert detect.detect_in_parts(companies, pages, out, every=1, progress=lambda k, n: seen.append((k, n))) == 2
    again = open(log).read().split()[before:]
    done = {r.company for k in (0, 1) for r in spark.read.option("header", True).schema("company string").csv(f"{out}/part-{k}").collect()}
    assert seen[-1] == (4, 4) and not any(f"https://{n.lower()}.com/" in again for n in done)
    rows = spark.read.option("header", True).csv(f"{out}/part-*").collect()
    assert sorted(r.company for r in rows) == sorted(n.title() for n in names)
    assert detect.detect_in_parts(companies, pages, out, every=1) == 0


def test_the_first_inputs_are_taken(spark, tmp_path):
    (tmp_path / "pages.json").write_text(json.dumps({"fetch_url": "https://x.com/", "final_url": "https://x.com/", "html": "", "status_code": 200}))
    (tmp_path / "in.csv").write_text("company,url,enabled\nZeta,https://z.com,true\nBeta,https://b.com,true\nAlpha,https://a.com,true\n")
    cli.main(["detect", "--input", f"{tmp_path}/in.csv", "--pages", f"{tmp_path}/pages.json", "--out", f"{tmp_path}/out", "--limit", "2"], spark)
    assert sorted(r.company for r in spark.read.option("header", True).csv(f"{tmp_path}/out").collect()) == ["Beta", "Zeta"]


def test_markup_is_read_as_a_browser_does(spark):
    page = """<!-- <a href="/hidden">x</a> --><a href="/o'neil jobs?gh_jid=1">Jobs &amp; <b>more</b></a><a href=/x&#47;y&eacute;>z<a href='q"r'>in</a>
<script src="s.js">var u="https:\\/\\/jobs.ashbyhq.com\\/z"; <a href="/no">no</a></script><iframe src=" /i\n f "></iframe><form action="?a=1">t</form><A HREF="HTTP://[bad">b</a><a>none</a><img src=x><br/>"""
    got = [r[:3] for r in markup.page_links("https://acme.com/dir/page", page) if r[4] is not None]
    assert got == [("a", "/o'neil jobs?gh_jid=1", "https://acme.com/o'neil jobs?gh_jid=1"), ("a", "/x/yé", "https://acme.com/x/yé"), ("a", 'q"r', 'https://acme.com/dir/q"r'), ("script", "s.js", "https://acme.com/dir/s.js"), ("iframe", "/i f", "https://acme.com/i f"), ("form", "?a=1", "https://acme.com/dir/page?a=1"), ("a", "HTTP://[bad", "")]
    assert ("inline", "https://jobs.ashbyhq.com/z") in [r[:2] for r in markup.page_links("https://acme.com/", page)]
    rows = spark.createDataFrame([(1, "https://a.com", page, 7), (2, None, None, 8), (3, "https://b.com", "", 9)], "k int, url string, html string, pos_of int")
    assert {r.k for r in markup.read_links(rows).collect()} == {1} and markup.read_links(rows.limit(0)).count() == 0


def test_links_of_all_pages_are_those_of_a_plain_parser(spark):
    from html.parser import HTMLParser
    from urllib.parse import urljoin

    class Plain(HTMLParser):
        def __init__(self):
            super().__init__()
            self.found = []

        def handle_starttag(self, tag, attrs):
            name = {"a": "href", "script": "src", "iframe": "src", "form": "action"}.get(tag)
            self.found += [(tag, " ".join((v or "").split())) for k, v in attrs if k == name]

    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    want = []
    for r in pages.collect():
        plain = Plain()
        plain.feed(r.html or "")
        plain.close()
        want += [(r.page_id, t, x, urljoin(r.url, x)) for t, x in plain.found]
    got = markup.read_links(pages).filter("pos IS NOT NULL").select("page_id", "kind", "link", "url").collect()
    assert sorted(map(tuple, got)) == sorted(want) and len(want) > 100


def test_classic_cards(spark):
    card = '<li class="row iCIMS_JobCardItem">{}</li>'
    first = '<span class="sr-only field-label">Job Locations</span><span> Toronto,&nbsp;ON </span><span title="1/2/2026 3:00 PM">2 days <span class="sr-only">(1/2)</span></span><a href="https://x.icims.com/jobs/123/dev/job?in_iframe=1&amp;mode=a"><h3>Dev &#8211; Intern</h3></a>'
    second = '<a href="/jobs/5/job?in_iframe=1"><h3 class="t"> Student <b>Helper</b></h3></a><dl><dt><span>Location</span></dt><dd>CA-ON-Ottawa</dd><dt>Job Location</dt><dd></dd></dl>'
    page = "<ul>" + card.format(first) + "<li>no card</li>" + card.format(second) + card.format('<a href="/other"><h3>x</h3></a>') + "</ul>"
    assert list(markup.listing_cards(page)) == [("123", "Dev – Intern", "https://x.icims.com/jobs/123/dev/job?mode=a", "Toronto, ON", "1/2/2026 3:00 PM", 0), ("5", "Student Helper", "/jobs/5/job", "CA-ON-Ottawa", "", 1)]
    landed_ = spark.createDataFrame([("Acme", "https://c.com", page, 0), ("B", "https://b.com", "{}", 0), ("C", "u", None, 0)], "company string, career_url string, payload string, ord int")
    got = connectors.records(landed_, "icims", "2026-01-31").collect()
    assert sorted((r.title, r.location, r.url, r.date_posted) for r in got) == [("Dev – Intern", "Toronto, ON", "https://x.icims.com/jobs/123/dev/job?mode=a", "2026-01-02"), ("Student Helper", "Ottawa, ON, Canada", "/jobs/5/job", None)]


def test_bad_input(spark, tmp_path):
    for name, data in {"ok": b'[{"a": "x"}, 3, {"a": "caf\xe9"}]', "broken": b'[{"a": ', "object": b'{"a": "y"}', "blank": b" \n", "marked": b'\xef\xbb\xbf[{"a": "z"}]'}.items():
        (tmp_path / f"{name}.json").write_bytes(data)
    read = lambda name, **k: sorted(((r.a, r._bad) for r in landed.read_json_list(spark, f"{tmp_path}/{name}.json", "a string", corrupt="_bad", **k).collect()), key=str)
    assert read("ok") == [("caf�", None), ("x", None), (None, "3")] or read("ok") == sorted([("caf�", None), ("x", None), (None, "3")], key=str)
    assert read("broken") == [(None, '[{"a": ')] and read("object") == [(None, '{"a": "y"}')] and read("blank") == [] and read("marked") == [("z", None)] and read("none") == []
    assert read("broken", mode="list") == [(None, '[{"a": ')] and read("blank", mode="list") == []
    for name in ("broken", "object", "blank"):
        with pytest.raises(Exception, match="not a JSON list"):
            landed.read_json_list(spark, f"{tmp_path}/{name}.json", "a string", mode="strict").collect()
    with pytest.raises(Exception, match="not a JSON list"):
        landed.read_json_list(spark, f"{tmp_path}/object.json", "a string", mode="list").collect()
    with pytest.raises(Exception):
        landed.read_json_list(spark, f"{tmp_path}/none.json", "a string", mode="strict").collect()
    raw = 'company,url\n"Caf\xe9, ""Bar""",https://a.com\n\xe9\xe8t\xe9,\xff\n'.encode("latin-1")
    (tmp_path / "l.csv").write_bytes(raw)
    assert sorted(map(tuple, landed.read_csv(spark, f"{tmp_path}/l.csv", "company string", exact=False).collect())) == sorted([('Caf�, "Bar"', "https://a.com"), ("��t�", "�")])


def _walk(value):
    if isinstance(value, dict):
        yield value
        for x in value.values():
            yield from _walk(x)
    elif isinstance(value, list):
        for x in value:
            yield from _walk(x)


def test_nested_records_come_in_the_order_of_a_walk(spark, tmp_path):
    def tree(depth):
        return {k: RNG.choice([tree(depth - 1), [tree(depth - 1), 1, [tree(depth - 1)]], "é"]) if depth else k for k in RNG.sample("zyxabc", 3)}

    value = tree(4)
    (tmp_path / "t.json").write_text(json.dumps(value))
    (tmp_path / "bad.json").write_text("{")
    got = landed.read_json_records(spark, f"{tmp_path}/t.json").orderBy("ord").collect()
    assert [json.loads(r.record) for r in got] == list(_walk(value)) and landed.read_json_records(spark, f"{tmp_path}/bad.json").count() == 0


def test_pages_of_a_listing_must_be_whole(spark):
    page = lambda n, total=None: json.dumps({"jobPostings": [{"title": "Intern", "externalPath": f"/{n}/{i}"} for i in range(n)]} | ({} if total is None else {"total": total}))
    queries = {
        "hole": [(0, page(20, 60)), (2, page(20, 60))], "late": [(1, page(3))], "open": [(0, page(20))], "whole": [(0, page(20)), (1, page(0))], "short": [(0, page(20)), (1, page(4))],
        "told": [(0, page(20, 40)), (1, page(20, 40))], "more": [(0, page(20, 60)), (1, page(20, 60))], "most": [(i, page(20)) for i in range(25)], "null": [(0, None)],
    }
    rows = spark.createDataFrame([(c, "u", "intern", p, x) for c, pages in queries.items() for p, x in pages], "company string, career_url string, term string, page int, payload string")
    assert {r.company for r in workday.listings(rows).collect()} == {"whole", "short", "told", "most"}


def _loop(rows, keys):
    taken, kept = [set() for _ in keys], []
    for row in rows:
        values = [row[k] for k in keys]
        if not any(v and v in t for v, t in zip(values, taken)):
            kept.append(row["ord"])
            for v, t in zip(values, taken):
                t.add(v)
    return kept


@pytest.mark.parametrize("in_one", [500_000, 300])
def test_conflicts_are_settled_as_a_loop_does(spark, in_one):
    rows = [{"ord": i, "a": RNG.choice(["", None, f"a{RNG.randrange(60)}", f"b{i}"]), "b": RNG.choice(["", f"x{RNG.randrange(90)}", f"y{i}"])} for i in range(400)]
    rows += [{"ord": 1000 + i, "a": f"p{(i + 1) // 2}", "b": f"q{i // 2}"} for i in range(250)]  # one chain
    rows += [{"ord": 2000 + i, "a": f"r{i // 3}", "b": f"s{i // 7}"} for i in range(200)]
    df = spark.createDataFrame([(r["ord"], r["a"], r["b"]) for r in rows], "ord int, a string, b string").repartition(3)
    assert sorted(r.ord for r in greedy(df, ["a", "b"], "ord", rounds=1, in_one=in_one).collect()) == sorted(_loop(rows, ["a", "b"]))


def test_a_long_chain_takes_few_jobs(spark):
    n = 10_000
    df = spark.range(n).selectExpr("id AS ord", "concat('p', (id + 1) div 2) AS a", "concat('q', id div 2) AS b")
    tracker, group = spark.sparkContext.statusTracker(), "chain"
    spark.sparkContext.setJobGroup(group, group)
    got = sorted(r.ord for r in greedy(df, ["a", "b"], "ord").collect())
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert got == _loop([{"ord": i, "a": f"p{(i + 1) // 2}", "b": f"q{i // 2}"} for i in range(n)], ["a", "b"])
    assert len(tracker.getJobIdsForGroup(group)) < 150


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(200 + RNG.randrange(40), 200 + RNG.randrange(40)) for _ in range(30)] + [(500, 500), (7, 600)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    assert sorted((r.node, r.component) for r in got) == sorted((x, find(x)) for x in root)


def test_many_rows_of_one_name(spark):
    rows = [(i, "Acme", "x", "s") for i in range(300)]
    used = [(f"acme - X {k}", "s") for k in (*range(2, 60), 70, 301)] + [("Acme - x", "s"), ("Acme - x 5", "t")]
    got = numbered_names(spark.createDataFrame(rows, "ord int, name string, label string, source string"), "name", "label", "source", ["ord"], spark.createDataFrame(used, "name string, source string")).collect()
    free = [k for k in range(1, 500) if k not in {1, *range(2, 60), 70, 301}]
    assert {r.ord: r.name for r in got} == {i: f"Acme - x {free[i]}" for i in range(300)}


def test_case_folding_is_unicode_s(spark):
    words = ["STRASSE", "Straße", "ﬁn", "İstanbul", "ΣΊΣΥΦΟΣ", "Σίσυφος", "ŉ", "ǰ", "K", "", None, "ẞ"]
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(words)], "k int, x string").select("k", text.fold(F.col("x")).alias("y"), text.alphanumeric(F.col("x")).alias("z"))
    for r in rows.collect():
        x = words[r.k]
        assert r.y == (None if x is None else x.casefold()) and r.z == "".join(c for c in (x or "").casefold() if c in "abcdefghijklmnopqrstuvwxyz0123456789")


def test_iso_dates_are_python_s(spark):
    days = ["2026-01-02", "20260102", "2026-W01-5", "2026W015", "2026-W01", "2026W01", "2026-02-30", "2026-W54-1", "2020-W53-7", "2021-W53-1", "2026-W00-1", "2026-W10-8", "0000-01-01", "2026-1-2", "26-01-02", "2024-02-29"]
    times = ["", "T10", " 10:20", "T10:20:30", "T102030", "x10:20:30.5", "T10:20:30,123", "T24:10", "T10:60", "T99:99", "T10:20:61", "T", "T1", "T10:2"]
    zones = ["", "Z", "+05:00", "-0530", "+23", "+24:00", "+05:60", "Zulu", "+1"]
    cases = [d + t + z for d in days for t in times for z in zones if t or not z]

    def want(x):
        try:
            return datetime.fromisoformat(x.replace("Z", "+00:00")).date().isoformat()
        except ValueError:
            return None

    got = spark.createDataFrame([(x,) for x in cases], "x string").select("x", dates.iso_date(F.col("x")).alias("y")).collect()
    wrong = [(r.x, r.y, want(r.x)) for r in got if r.y != want(r.x)]
    assert not wrong, wrong[:20]


def _day(spark, day):
    """Configs, payloads of two connectors that overlap from day to day, and the day's date."""
    configs = spark.createDataFrame([(i, f"C{i}", "lever" if i % 2 else "greenhouse", "https://c.com", i != 5) for i in range(8)], "ord int, company string, source string, url string, enabled boolean")
    landed_ = []
    for i in range(8):
        if (i + day) % 4 == 3:
            landed_.append((f"C{i}", "lever" if i % 2 else "greenhouse", None, 0, False))
            continue
        ids = [k for k in range(12) if (k * 7 + i + day) % 3]
        jobs = [{"id": f"{k if k < 9 else f'{k}-{day}'}", "title": f"Intern {k % 7}", "text": f"Intern {k % 7}", "hostedUrl": "u", "absolute_url": "u", "location": {"name": f"Town{k % 5}"}, "categories": {"location": f"Town{k % 5}"}} for k in ids]
        landed_.append((f"C{i}", "lever" if i % 2 else "greenhouse", json.dumps(jobs if i % 2 else {"jobs": jobs}), 0, True))
    return configs, spark.createDataFrame(landed_, "company string, source string, payload string, ord bigint, ok boolean"), f"2026-02-{day + 1:02d}"


def test_snapshots_in_buckets_are_merged_as_plain_ones(spark, tmp_path):
    from tessera.operators import run
    from tessera.operators.snapshots import Snapshots

    active = run.empty_snapshot(spark)
    archived = active.withColumn("date_archived", F.lit(None).cast("string"))
    store = Snapshots(spark, f"file://{tmp_path}/store", name="days", buckets=4)
    store.save(active, archived)
    rows = lambda df: sorted(map(str, df.select(*sorted(df.columns)).collect()))
    for day in range(4):
        configs, landed_, date = _day(spark, day)
        want = run.daily_run(configs, landed_, active, archived, date, strict_touch=day % 2 == 0)
        got = store.run(configs, landed_, date, strict_touch=day % 2 == 0)
        assert rows(got.active) == rows(want.active) and rows(got.archived) == rows(want.archived) and rows(got.counts) == rows(want.counts)
        assert want.archived.count() > 0 or day == 0
        active, archived = (t.withColumn("ord", F.monotonically_increasing_id()) for t in (want.active, want.archived))
        active, archived = spark.createDataFrame(active.collect(), active.schema), spark.createDataFrame(archived.collect(), archived.schema)
    assert store.version == 5
    again = Snapshots(spark, f"file://{tmp_path}/store", name="again", buckets=4)
    assert rows(again.active().drop("_key", "ord")) == rows(store.active().drop("_key", "ord"))


def test_snapshots_stay_in_their_buckets(spark, tmp_path):
    from tessera.operators import run
    from tessera.operators.merge import merge_snapshots
    from tessera.operators.snapshots import Snapshots

    base = run.empty_snapshot(spark)
    many = spark.range(2000).select(F.col("id").alias("ord"), *(F.concat(F.lit(f"{c}-"), F.col("id") % 900).alias(c) if base.schema[c].dataType.typeName() == "string" else F.lit(True).alias(c) for c in base.columns if c != "ord"))
    store = Snapshots(spark, f"file://{tmp_path}/store", name="plans", buckets=4)
    store.save(many, many.withColumn("date_archived", F.lit("2026-01-01")))
    day = run.placed(many.filter("ord < 50"))
    live, shelf = merge_snapshots(run.placed(store.active()), day, run.placed(store.archived()), day.select("source", "company"), "2026-02-01", keyed=True)
    for df in (live, shelf):
        path, bucketed = [], 0
        for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
            depth = len(line) - len(line.lstrip(" :+-"))
            path = [x for x in path if x[0] < depth] + [(depth, line.strip(" :+-"))]
            if "FileScan parquet" in line and "plans_" in line:
                bucketed += "Bucketed: true" in line
                assert not [x for _, x in path if x.startswith("Exchange")], line
        assert bucketed


def test_places_and_details_spell_each_step_out_a_few_times(spark):
    def times(column, name):
        plan = spark.range(1).select(F.lit("x").alias("t")).select(column)._jdf.queryExecution().analyzed().toString()
        return plan.count(name)

    assert times(workday.detail_locations(F.col("t")), "get_json_object") == 0 and times(workday.detail_locations(F.col("t")), "from_json") < 40
    assert times(locations.coded_places(F.col("t")), "regexp_replace") <= 4
    white = "".join(chr(i) for i in range(0x3001) if chr(i).isspace() and not 0x1C <= i <= 0x1F)
    rows = spark.createDataFrame([(white + "a" + white + "b" + white,), ("​ a\x1c",), (white,), (None,)], "t string")
    assert [r[0] for r in rows.select(text.strip(F.col("t"))).collect()] == ["a" + white + "b", "​ a\x1c", "", ""]
    lists = spark.createDataFrame([(["A", "b", "a", "B", "c"],), (["x"],), ([],)], "l array<string>")
    assert [r[0] for r in lists.select(locations.distinct_text(F.col("l"))).collect()] == [["A", "b", "c"], ["x"], []]


def test_both_forms_of_icims_are_read_in_one_pass(spark):
    card = '<li class="iCIMS_JobCardItem"><a href="https://x.icims.com/jobs/7/dev/job"><h3>Dev Intern</h3></a></li>'
    rows = [("a", "u", '{"jobs": [{"data": {"slug": "s", "title": "Intern"}}, {"data": null}]}', 0), ("b", "u", "  " + card, 1), ("c", "u", None, 2), ("d", "u", "no", 3)]
    landed = spark.createDataFrame(rows, "company string, career_url string, payload string, ord int")
    found = connectors.envelope(landed, "icims").select("company", "key", "raw.title", "raw.classic_url")
    assert sorted(map(tuple, found.collect())) == [("a", "s", "Intern", None), ("b", "7", "Dev Intern", "https://x.icims.com/jobs/7/dev/job")]
    assert "Union" not in found._jdf.queryExecution().optimizedPlan().toString()
