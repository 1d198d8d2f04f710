"""Whole flows over landed payloads made of the driver's tables: connectors, runs, detection, discovery, catalogs."""

from __future__ import annotations

from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import detect, discover, leads, pages, promote, run
from tessera.plans.catalog import _CITY, _JOBS, _KIND, AS_OF, _listings, _EVENT_LISTINGS, jobs, table
from tessera.sources import connectors, workday
from tessera.sources.markup import read_links

CAREERS = "https://careers.example.com"


def _payloads(rows: DataFrame, source: str) -> DataFrame:
    """(company, payload): one payload of a source per company of records (ord, company, title, location, url, date_added)."""
    raw = F.concat(F.lit("r"), F.col("ord").cast("string"))
    day = F.concat("date_added", F.lit("T08:00:00Z"))
    place = F.col("location")
    item = {
        "ashby": F.struct(raw.alias("id"), "title", F.col("url").alias("jobUrl"), day.alias("publishedAt"), "location", (F.col("ord") % 5 != 0).alias("isListed")),
        "greenhouse": F.struct(raw.alias("id"), "title", F.col("url").alias("absolute_url"), day.alias("updated_at"), F.struct(place.alias("name")).alias("location")),
        "lever": F.struct(raw.alias("id"), F.col("title").alias("text"), F.col("url").alias("hostedUrl"), (F.unix_date(F.to_date("date_added")).cast("long") * 86_400_000).alias("createdAt"), F.struct("location").alias("categories")),
        "icims": F.struct(F.struct(raw.alias("slug"), "title", day.alias("posted_date"), place.alias("full_location")).alias("data")),
        "oracle_hcm": F.struct(raw.alias("Id"), F.col("title").alias("Title"), place.alias("PrimaryLocation"), F.col("date_added").alias("PostedDate")),
        "smartrecruiters": F.struct(raw.alias("id"), F.col("title").alias("name"), day.alias("releasedDate"), F.struct(place.alias("fullLocation")).alias("location")),
        "rippling": F.struct(raw.alias("id"), F.col("title").alias("name"), "url", F.array(F.struct(place.alias("name"))).alias("locations")),
        "workable": F.struct(raw.alias("id"), "title", F.col("date_added").alias("published"), F.array(F.struct(place.alias("city"))).alias("locations")),
        "workday": F.struct("title", F.concat(F.lit("/job/"), raw).alias("externalPath"), F.col("date_added").alias("postedOn"), place.alias("locationsText")),
    }[source]
    listed = rows.groupBy("company").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", item.alias("item")))), lambda x: x["item"]).alias("items"))
    items = F.col("items")
    if source == "rippling":  # the same posting again, with one more place
        items = F.concat(items, F.transform(items, lambda x: x.withField("locations", F.array(F.struct(F.lit("Lyon").alias("name")), F.struct(F.lit("").alias("name"))))))
    if source == "lever":
        return listed.select("company", F.to_json(items).alias("payload"))
    if source == "oracle_hcm":
        return listed.select("company", F.to_json(F.struct(F.array(F.struct(items.alias("requisitionList"))).alias("items"))).alias("payload"))
    name = {"smartrecruiters": "content", "rippling": "items", "workable": "results", "workday": "jobPostings"}.get(source, "jobs")
    told = [F.size(items).alias("total")] if source == "workday" else []  # one page holds them all
    return listed.select("company", F.to_json(F.struct(items.alias(name), *told)).alias("payload"))


def connector(source: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of a source from one landed payload per customer."""
    landed = _payloads(jobs(spark, sf_dir), source).select("company", F.lit(CAREERS).alias("career_url"), "payload", F.lit(0).alias("ord"))
    return connectors.records(landed, source, AS_OF).select("id", "company", "title", "location", "type", "source", "url", "date_posted", "date_added")


_SLUG = "trim(regexp_replace(lower(company), '[^a-z0-9]+', '-', 'g'), '-')"
_CODED = f"CASE WHEN location = 'US-TN-Tullahoma' THEN 'Tullahoma, TN, United States' ELSE {_CITY} END"
_LEVER = f"CASE WHEN location = 'San Diego, CA' THEN location ELSE {_CITY} END"


def _connector_sql(source: str, place: str, url: str, posted: str = "date_added", token: str = "'r' || ord", only: str = "true") -> str:
    return f"""WITH {_JOBS}, k AS (SELECT *, {_KIND} AS kind FROM jobs)
SELECT '{source}-' || {_SLUG} || '-' || {token} AS id, company, title, {place} AS location, kind AS type, '{source}' AS source, {url} AS url, CAST({posted} AS VARCHAR) AS date_posted, '{AS_OF}' AS date_added FROM k WHERE kind IS NOT NULL AND {only}"""


# ---- workday's plan -------------------------------------------------------------------------------------------------


def workday_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the plan of "co-op" and its equivalent "co op" reads; a company's second page is skipped where a title covers it."""
    rows = jobs(spark, sf_dir)
    parts = [_payloads(rows.filter(half), "workday").select("company", F.lit(CAREERS).alias("career_url"), F.lit(term).alias("term"), F.lit(0).alias("page"), "payload", F.lit(i).alias("ord")) for i, (term, half) in enumerate((("co-op", F.col("ord") % 12 < 6), ("co op", F.col("ord") % 12 >= 6)))]
    kept = workday.postings(spark, parts[0].unionByName(parts[1]), ["co-op", "co op", "Co-Op"])
    return kept.select("company", "term", F.col("raw.externalPath").alias("path"))


def jibe_facets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facet terms of one probe per customer."""
    probes = ('{"filter":{"facetList":{"tags1":[{"term":"Internship"},{"term":"Sales"},{"term":" Internship "}],"city":[{"term":"Campus"}]}}}', '{"filter":{"facetList":{"tags9":[{"term":"Entry Level"}],"tags2":[{"term":"New Grad"}]}}}', "{}")
    rows = table(spark, sf_dir, "customer").select(F.col("c_name").alias("company"), F.element_at(F.array(*map(F.lit, probes)), (F.col("c_custkey") % 3 + 1).cast("int")).alias("payload"))
    return connectors.facet_terms(rows)


# ---- a whole run ----------------------------------------------------------------------------------------------------


def _run(spark: SparkSession, sf_dir: str) -> run.Run:
    """A run over customers of two sources with a connector and one without, every fifth of them off."""
    names = F.element_at(F.array(F.lit("greenhouse"), F.lit("lever"), F.lit("unknown")), (F.col("c_custkey") % 3 + 1).cast("int"))
    configs = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ord"), F.col("c_name").alias("company"), names.alias("source"), F.lit(CAREERS).alias("url"), (F.col("c_custkey") % 5 != 0).alias("enabled"))
    rows = jobs(spark, sf_dir).drop("source").join(configs.select("company", "source", F.col("ord").alias("place")), "company")
    landed = None
    for source in ("greenhouse", "lever"):
        part = _payloads(rows.filter((F.col("source") == source) & (F.col("ord") % 4 != 0)), source).withColumn("source", F.lit(source))
        landed = part if landed is None else landed.unionByName(part)
    landed = landed.withColumns({"ord": F.lit(0).cast("long"), "ok": F.lit(True)})
    made = F.concat_ws("-", "source", F.regexp_replace(F.lower("company"), "[^a-z0-9]+", "-"), F.concat(F.lit("r"), F.col("ord").cast("string")))
    kind = F.coalesce("type", F.lit("internship"))
    state = rows.filter("source <> 'unknown'").select("ord", made.alias("id"), "company", "title", "location", kind.alias("type"), F.lit("").alias("season"), "source", "url", F.lit(None).cast("string").alias("date_posted"), F.lit("2025-01-01").alias("date_added"), F.lit(True).alias("active"))
    active = state.filter("ord % 3 = 0")
    archived = state.filter("ord % 7 = 0").withColumns({"date_added": F.lit("2024-06-01"), "date_archived": F.lit("2024-12-31"), "active": F.lit(False)})
    return run.daily_run(run.with_search_workers(configs, 4), landed, active, archived, AS_OF, sources=run.parse_sources(["Greenhouse,unknown", "lever"]))


def daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir).active.select("id", "date_added", "active")


def daily_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir).archived.select("id", "date_added", "date_archived")


def daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir).counts


_RUN = f"""WITH {_JOBS}, c AS (SELECT c_custkey AS place, c_name AS company, ['greenhouse', 'lever', 'unknown'][c_custkey % 3 + 1] AS source, c_custkey % 5 <> 0 AS enabled FROM customer),
k AS (SELECT j.* EXCLUDE (source, id), c.source, c.enabled, c.place, {_KIND} AS kind, c.source || '-' || {_SLUG.replace('company', 'j.company')} || '-r' || j.ord AS id,
  CASE WHEN c.source = 'lever' THEN {_LEVER} ELSE {_CITY} END AS shown FROM jobs j JOIN c ON j.company = c.company WHERE c.source <> 'unknown'),
raw AS (SELECT * FROM k WHERE enabled AND ord % 4 <> 0),
f AS (SELECT * FROM raw WHERE kind IS NOT NULL QUALIFY row_number() OVER (PARTITION BY company, title, shown ORDER BY ord) = 1),
old AS (SELECT * FROM k WHERE ord % 3 = 0),
gone AS (SELECT * FROM k WHERE ord % 7 = 0),
live AS (SELECT f.id, CASE WHEN f.ord % 3 = 0 THEN '2025-01-01' WHEN f.ord % 7 = 0 THEN '2024-06-01' ELSE '{AS_OF}' END AS date_added, true AS active, kind FROM f
  UNION ALL SELECT id, '2025-01-01', true, coalesce(kind, 'internship') FROM (SELECT * FROM old WHERE NOT enabled QUALIFY row_number() OVER (PARTITION BY company, title, location ORDER BY ord) = 1)),
v AS (SELECT id FROM old WHERE enabled AND id NOT IN (SELECT id FROM f)),
shelf AS (SELECT id, '2025-01-01' AS date_added, '{AS_OF}' AS date_archived FROM v
  UNION ALL SELECT id, '2024-06-01', '2024-12-31' FROM gone WHERE id NOT IN (SELECT id FROM f) AND id NOT IN (SELECT id FROM v))"""


# ---- pages ----------------------------------------------------------------------------------------------------------


def _linked(spark: SparkSession, sf_dir: str, prefix) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "url", F.concat(prefix, F.coalesce("html", F.lit(""))).alias("html"))


def top_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three best links of every page, with five links put before it."""
    prefix = '<a href="/careers/jobs#openings">Jobs</a><a href="/en/team">our team</a><a href="/jobs/12345">Job</a><a class="x" href=\'../careers\'>Our <b>Careers</b></a><a href="https://www.linkedin.com/jobs">jobs</a>'
    return pages.top_pages(_linked(spark, sf_dir, F.lit(prefix)), 3)


def platform_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evidence in the pages with a link to a platform, and one in a script, put before them."""
    hosts = ("https://boards.greenhouse.io/a", "https://jobs.lever.co/b", "https://x.icims.com/jobs", "https://apply.workable.com/c")
    link = F.element_at(F.array(*map(F.lit, hosts)), (F.col("page_id") % 4 + 1).cast("int"))
    marked = _linked(spark, sf_dir, F.concat(F.lit('<a href="'), link, F.lit('">x</a><script>u="https:\\/\\/jobs.ashbyhq.com\\/z";</script><img src="https://cdn.lever.co/logo.png">')))
    return pages.evidence(read_links(marked)).select("page_id", "source", "url", "method", "confidence")


def detected_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of one company per page: two links to a platform, one a page further, none, and a page not landed."""
    p = table(spark, sf_dir, "pages").select("page_id", "html", F.col("page_id").cast("string").alias("n"))
    site = F.concat(F.lit("https://www.c"), "n", F.lit(".example.com"))
    companies = p.select(F.col("page_id").alias("ord"), F.concat(F.lit("Company "), "n").alias("company"), site.alias("url"), F.lit("test").alias("discovered_from"))
    k = F.col("page_id") % 4
    two = F.concat(F.lit('<a href="https://boards.greenhouse.io/acme'), "n", F.lit('/jobs/1">x</a><script src="https://boards.greenhouse.io/embed/job_board/js?for=acme'), "n", F.lit('"></script>'))
    first = p.filter(k != 3).select(site.alias("fetch_url"), F.concat(site, F.lit("/")).alias("final_url"), F.concat(F.when(k == 0, two).when(k == 1, '<a href="/careers/openings">Jobs</a>').otherwise(""), F.coalesce("html", F.lit(""))).alias("html"))
    second = p.filter(k == 1).select(F.concat(site, F.lit("/careers/openings")).alias("fetch_url"), F.concat(site, F.lit("/careers/openings")).alias("final_url"), F.concat(F.lit('<a href="https://jobs.lever.co/co'), "n", F.lit('/9">y</a>')).alias("html"))
    return detect.detect(companies, first.unionByName(second)).select(*(F.col(c).cast("bigint") if c == "evidence_count" else F.col(c) for c in detect.CANDIDATES))


# ---- discovery ------------------------------------------------------------------------------------------------------


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", F.col("s_suppkey").cast("string").alias("n"))
    record = lambda **fields: F.to_json(F.struct(*(v.alias(k) for k, v in fields.items())))
    text = lambda *parts: F.concat(*(F.col("n") if x is None else F.lit(x) for x in parts))
    k = F.col("s_suppkey") % 5
    made = (
        F.when(k == 0, record(Company=F.col("s_name"), career_url=text("https://www.s", None, ".com/careers/search/1?x=1")))
        .when(k == 1, record(company_name=F.col("s_name"), url=text("see https://s", None, ".com/jobs/a, https://s", None, ".com/jobs/b/x")))
        .when(k == 2, record(employer=F.col("s_name"), apply_url=text("https://jobs.lever.co/s", None)))
        .when(k == 3, record(name=F.col("s_name"), url=text("https://s", None, ".breezy.hr/jobs/1")))
        .otherwise(record(organization=F.col("s_name"), jobs_url=text("https://h", None, ".com/careers"), job_url=text("https://h", None, ".com/x/openings/all?y=1"), source=F.lit("Workday")))
    )
    file = F.when(k == 0, "data/custom_companies.csv").when(k == 4, "archive/old.json").otherwise("data/x.json")
    return s.select(F.col("s_suppkey").alias("ord"), file.alias("file"), made.alias("record"))


def discovered_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = discover.record_links(_records(spark, sf_dir))
    return discover.deduplicated(discover.candidates(links, links.filter("ord % 5 <> 4")))[0]


def discovered_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = discover.record_links(_records(spark, sf_dir))
    return discover.deduplicated(discover.candidates(links, links.filter("ord % 5 <> 4")))[1]


# ---- catalogs -------------------------------------------------------------------------------------------------------


def archived_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New source rows from the listings, their names made unique."""
    found = leads.archived_candidates(_listings(spark, sf_dir))
    known = found.filter(F.col("identity").rlike("[05]$")).select("company", "url")
    return leads.new_source_rows(found, known)


def _catalog(spark: SparkSession, sf_dir: str):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.col("c_custkey").cast("string").alias("n"), (F.col("c_custkey") - 1).cast("string").alias("m"))
    k = F.col("c_custkey") % 5
    url = (
        F.when(k == 0, F.concat(F.lit("https://jobs.lever.co/c"), "n", F.lit("/x")))
        .when(k == 1, F.concat(F.lit("HTTPS://jobs.lever.co/c"), "m", F.lit("/x/")))
        .when(k == 2, F.concat(F.lit("https://jobs.lever.co/c"), "n"))
        .when(k == 3, F.concat(F.lit("https://example.com/c"), "n", F.lit("/")))
        .otherwise(F.concat(F.lit("https://boards.greenhouse.io/c"), "n"))
    )
    rows = c.select(F.col("c_custkey").alias("ord"), F.concat(F.lit(" "), "c_name").alias("company"), url.alias("url"), F.when(k == 2, "maybe").otherwise("Yes").alias("enabled"))
    own = c.filter("c_custkey % 10 = 0").select(F.col("c_name").alias("company"), F.lit("lever").alias("source"), F.concat(F.lit("https://jobs.lever.co/c"), "n").alias("url"))
    other = c.filter("c_custkey % 5 = 4").select(F.lit("Other").alias("company"), F.lit("greenhouse").alias("source"), F.concat(F.lit("https://boards.greenhouse.io/c"), "n").alias("url"))
    return leads.compile_catalog(rows, own.unionByName(other))


def compiled_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _catalog(spark, sf_dir)[0].select("company", "source", "url", "slug", "enabled", "change")


def cleaned_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _catalog(spark, sf_dir)[1].select("ord", "company", "url", "enabled")


def promotion_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates of one kind per customer: good, not ready, unsupported, internal, templated, double, and a board."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.col("c_custkey").cast("string").alias("n"), (F.col("c_custkey") - 5).cast("string").alias("m"))
    pick = lambda *values: F.element_at(F.array(*(v if isinstance(v, Column) else F.lit(v) for v in values)), (F.col("c_custkey") % 7 + 1).cast("int"))
    text = lambda before, key, after="": F.concat(F.lit(before), F.col(key), F.lit(after))
    rows = c.select(
        F.col("c_custkey").alias("ord"),
        F.col("c_name").alias("company"),
        pick("lever", "lever", "phenom", "icims", "greenhouse", "lever", "workday").alias("detected_source"),
        pick("p", "p", "", "", "x", "p", text("acme", "n", ":careers")).alias("source_key"),
        pick("", "https://jobs.lever.co/q", "https://x.phenompeople.com/jobs", text("https://employees-x", "n", ".icims.com/jobs"), "https://boards.greenhouse.io/{{x}}", text("https://jobs.lever.co/p", "m", "/9"), text("https://acme", "n", ".wd5.myworkdayjobs.com/en-US/Careers/job/1")).alias("best_evidence_url"),
        pick(text("https://jobs.lever.co/p", "n"), "", "", "", "", "", text("https://acme", "n", ".wd5.myworkdayjobs.com/wday/cxs/jobs")).alias("canonical_source_url"),
        pick("true", "false", "true", "True", "yes", "1", "true").alias("route_ready"),
    )
    existing = c.filter("c_custkey % 14 = 0").select(F.col("c_name").alias("company"), F.concat(F.lit("https://jobs.lever.co/p"), "n", F.lit("/")).alias("url"))
    return promote.promotion(rows, existing)[1].select("ord", "detected_source", "candidate_url", "canonical_source_url", "status", "reason")


_PLATFORM_LINKS = "['https://boards.greenhouse.io/a', 'https://jobs.lever.co/b', 'https://x.icims.com/jobs', 'https://apply.workable.com/c'][page_id % 4 + 1]"

_SIMPLE = (workday_postings, jibe_facets, daily_run, daily_archive, daily_counts, top_pages, platform_evidence, detected_candidates, discovered_pages, discovered_duplicates, archived_sources, compiled_catalog, cleaned_sources, promotion_review)
QUERIES = {f"connector_{s}": partial(connector, s) for s in connectors.SCHEMAS} | {f.__name__: f for f in _SIMPLE}

ORACLE_SQL = {
    "connector_ashby": _connector_sql("ashby", _CITY, "url", only="ord % 5 <> 0"),
    "connector_greenhouse": _connector_sql("greenhouse", _CITY, "url"),
    "connector_lever": _connector_sql("lever", _LEVER, "url"),
    "connector_icims": _connector_sql("icims", _CODED, f"'{CAREERS}/jobs/r' || ord || '?lang=en-us&icims=1'"),
    "connector_oracle_hcm": _connector_sql("oracle_hcm", _CITY, f"'{CAREERS}/job/r' || ord"),
    "connector_smartrecruiters": _connector_sql("smartrecruiters", _CITY, f"'{CAREERS}/r' || ord"),
    "connector_rippling": _connector_sql("rippling", "location || ' / Lyon'", "url", posted="NULL"),
    "connector_workable": _connector_sql("workable", "location", f"'{CAREERS}/j/r' || ord || '/'"),
    "connector_workday": _connector_sql("workday", _CITY, f"'{CAREERS}/job/r' || ord", token="'job-r' || ord"),
    "workday_postings": f"""WITH {_JOBS}, k AS (SELECT *, {_KIND} AS kind FROM jobs)
SELECT company, CASE WHEN ord % 12 < 6 THEN 'co-op' ELSE 'co op' END AS term, '/job/r' || ord AS path FROM k WHERE kind IS NOT NULL AND (ord % 12 < 6 OR company NOT IN (SELECT company FROM jobs WHERE ord % 12 = 3))""",
    "jibe_facets": """WITH t(r, facet, term) AS (VALUES (0, 'tags1', 'Internship'), (1, 'tags9', 'Entry Level'), (1, 'tags2', 'New Grad'), (2, 'tags1', 'Intern'), (2, 'tags2', 'Intern'), (2, 'tags3', 'Intern'), (2, 'tags4', 'Intern'))
SELECT c_name AS company, facet, term FROM customer JOIN t ON c_custkey % 3 = r""",
    "daily_run": _RUN + " SELECT id, date_added, active FROM live",
    "daily_archive": _RUN + " SELECT id, date_added, date_archived FROM shelf",
    "daily_counts": _RUN + """, n AS (SELECT (SELECT count(*) FROM c WHERE enabled AND source <> 'unknown') AS companies, (SELECT count(*) FROM raw) AS raw_rows, 0 AS errors, (SELECT count(*) FROM live) AS active,
  (SELECT count(*) FROM live WHERE kind = 'internship') AS internships, (SELECT count(*) FROM live WHERE kind = 'new_grad') AS new_grads, (SELECT count(*) FROM shelf) AS archived)
SELECT name, CAST(n AS BIGINT) AS n FROM (SELECT unnest(['companies', 'raw_rows', 'errors', 'active', 'internships', 'new_grads', 'archived']) AS name, unnest([companies, raw_rows, errors, active, internships, new_grads, archived]) AS n FROM n)""",
    "top_pages": """WITH h AS (SELECT page_id, regexp_extract(lower(url), '^(https?://[^/?#]+)', 1) AS root, regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1) AS path FROM pages),
l AS (SELECT page_id, root || '/careers/jobs' AS url, 20 AS score FROM h UNION ALL
  SELECT page_id, root || list_aggregate(list_slice(string_split(path, '/'), 1, greatest(len(string_split(path, '/')) - 2, 1)), 'string_agg', '/') || '/careers', 2 FROM h)
SELECT page_id, url, score FROM l""",
    "platform_evidence": f"""SELECT page_id, ['greenhouse', 'lever', 'icims', 'workable'][page_id % 4 + 1] AS source, {_PLATFORM_LINKS} AS url, 'link' AS method, 'high' AS confidence FROM pages
UNION ALL SELECT page_id, 'ashby', 'https://jobs.ashbyhq.com/z', 'inline_script', 'medium' FROM pages""",
    "detected_candidates": """SELECT 'Company ' || page_id AS company, 'https://www.c' || page_id || '.example.com/' AS original_url, 'greenhouse' AS detected_source, 'acme' || page_id AS source_key, 'https://boards-api.greenhouse.io/v1/boards/acme' || page_id || '/jobs' AS canonical_source_url,
  CAST(3 AS BIGINT) AS evidence_count, 'https://boards.greenhouse.io/embed/job_board/js?for=acme' || page_id AS best_evidence_url, 'high' AS confidence, true AS route_ready, '' AS route_block_reason, 'validate_with_existing_ats_scraper' AS recommended_action, 'test' AS discovered_from, 'Compatible source candidate; extraction not run' AS notes FROM pages WHERE page_id % 4 = 0
UNION ALL SELECT 'Company ' || page_id, 'https://www.c' || page_id || '.example.com/', 'lever', 'co' || page_id, 'https://api.lever.co/v0/postings/co' || page_id || '?mode=json', 2, 'https://jobs.lever.co/co' || page_id || '/9', 'high', true, '', 'validate_with_existing_ats_scraper', 'test', 'Compatible source candidate; extraction not run' FROM pages WHERE page_id % 4 = 1
UNION ALL SELECT 'Company ' || page_id, 'https://www.c' || page_id || '.example.com/', '', '', '', 0, '', '', false, 'page was not landed', 'manual_review', 'test', 'Career page fetch or passive detection failed' FROM pages WHERE page_id % 4 = 3""",
    "discovered_pages": """SELECT s_name AS company, CASE s_suppkey % 5 WHEN 0 THEN 'https://www.s' || s_suppkey || '.com/careers/search' WHEN 1 THEN 'https://s' || s_suppkey || '.com/jobs' WHEN 3 THEN 'https://s' || s_suppkey || '.breezy.hr/jobs' ELSE 'https://h' || s_suppkey || '.com/careers' END AS career_url,
  CASE s_suppkey % 5 WHEN 0 THEN 'manual_custom_companies' WHEN 4 THEN 'archive' ELSE 'existing_data' END AS discovered_from, CASE s_suppkey % 5 WHEN 3 THEN 'unsupported_url' ELSE 'custom_career_page' END AS source_type, '' AS existing_known_source,
  CASE s_suppkey % 5 WHEN 0 THEN 'not_in_existing_ats_sources' WHEN 1 THEN 'likely_custom_or_branded_ats' WHEN 3 THEN 'unsupported_breezyhr_url' ELSE 'collapsed_1_duplicate_urls;found_in_archive' END AS reason, 'true' AS enabled FROM supplier WHERE s_suppkey % 5 <> 2""",
    "discovered_duplicates": "SELECT s_name AS company, 'h' || s_suppkey || '.com' AS host, 'https://h' || s_suppkey || '.com/careers' AS kept_url, 'https://h' || s_suppkey || '.com/x/openings/all' AS duplicate_url, 'same_normalized_company_and_career_host' AS duplicate_reason, 'archive' AS discovered_from FROM supplier WHERE s_suppkey % 5 = 4",
    "archived_sources": f"""WITH {_EVENT_LISTINGS}, a AS (SELECT company, url, source, split_part(identity, ' :: ', 2) AS label, identity FROM leads JOIN named USING (identity)),
o AS (SELECT *, count(*) OVER (PARTITION BY company, source) AS same FROM a WHERE NOT regexp_matches(identity, '[05]$')),
u AS (SELECT DISTINCT company, source FROM a WHERE regexp_matches(identity, '[05]$'))
SELECT CASE WHEN same = 1 AND u.company IS NULL THEN o.company ELSE o.company || ' - ' || label END AS company, url, 'true' AS enabled FROM o LEFT JOIN u ON o.company = u.company AND o.source = u.source""",
    "compiled_catalog": "SELECT c_name AS company, 'lever' AS source, 'https://jobs.lever.co/c' || c_custkey AS url, 'c' || c_custkey AS slug, true AS enabled, CASE WHEN c_custkey % 10 = 0 THEN 'current' ELSE 'added' END AS change FROM customer WHERE c_custkey % 5 = 0",
    "cleaned_sources": """SELECT c_custkey AS ord, c_name AS company, CASE WHEN c_custkey % 5 = 3 THEN 'https://example.com/c' || c_custkey ELSE 'https://jobs.lever.co/c' || c_custkey END AS url, CASE WHEN c_custkey % 5 = 2 THEN 'maybe' ELSE 'Yes' END AS enabled FROM customer WHERE c_custkey % 5 IN (0, 2, 3)""",
    "promotion_review": """WITH k AS (SELECT c_custkey AS ord, c_custkey % 7 AS k, c_custkey AS n, c_custkey - 5 AS m FROM customer)
SELECT ord, ['lever', 'lever', 'phenom', 'icims', 'greenhouse', 'lever', 'workday'][k + 1] AS detected_source,
  CASE k WHEN 0 THEN 'https://jobs.lever.co/p' || n WHEN 5 THEN 'https://jobs.lever.co/p' || m || '/9' WHEN 6 THEN 'https://acme' || n || '.wd5.myworkdayjobs.com/en-US/Careers' ELSE '' END AS candidate_url,
  CASE k WHEN 0 THEN 'https://jobs.lever.co/p' || n WHEN 5 THEN 'https://jobs.lever.co/p' || m WHEN 6 THEN 'https://acme' || n || '.wd5.myworkdayjobs.com/en-US/Careers' ELSE '' END AS canonical_source_url,
  CASE WHEN k = 6 OR (k = 0 AND n % 14 <> 0) THEN 'accepted' WHEN k IN (0, 5) THEN 'skipped' ELSE 'rejected' END AS status,
  CASE k WHEN 0 THEN CASE WHEN n % 14 = 0 THEN 'existing_url' ELSE '' END WHEN 1 THEN 'candidate_is_not_route_ready' WHEN 2 THEN 'not_a_supported_production_source' WHEN 3 THEN 'non_public_icims_url' WHEN 4 THEN 'templated_url' WHEN 5 THEN 'existing_url' ELSE '' END AS reason FROM k""",
}
