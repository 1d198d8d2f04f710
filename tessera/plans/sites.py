"""Queries over sites made of the driver's tables: fetching, keys of platforms, details, places, plug-ins, leads."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import detect, leads, pages, run
from tessera.plans.catalog import _CITY, _EVENT_LISTINGS, _JOBS, _KIND, AS_OF, _listings, jobs, table
from tessera.plans.flows import CAREERS, _payloads
from tessera.sources import connectors, fetching, workday
from tessera.sources.markup import read_links

# ---- fetching -------------------------------------------------------------------------------------------------------


def _site(url: str, timeout: float) -> fetching.Answer:
    """A site that answers with one link, and hangs or is gone for some addresses."""
    size = len(url)
    if size % 5 == 0:
        raise TimeoutError(f"no answer in {timeout:g} s")
    if size % 7 == 0:
        raise LookupError(url)
    return fetching.Answer(f"{url}?seen", 200, f'<a href="https://jobs.lever.co/s{size}/1?x=&eacute;">Jobs</a><!-- <a href="https://jobs.lever.co/hidden">x</a> -->')


def _items(url: str, timeout: float) -> fetching.Answer:
    """Lists of JSON, an object and broken text, by the address."""
    size = len(url)
    body = {0: "{}", 1: "[{"}.get(size % 6, json.dumps([{"n": size, "url": url}, 7, {"url": None}]))
    return fetching.Answer(url, 200, body)


def fetched_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL asked from a site; links of the answers, and the errors."""
    answers = fetching.fetched(table(spark, sf_dir, "pages").select("page_id", "url"), _site, timeout=2.5, tries=2)
    got = answers.select("page_id", F.col("final_url").alias("url"), F.col("body").alias("html"), "status_code", "error", "tries")
    links = read_links(got.filter("error IS NULL").select("page_id", "url", "html")).filter("kind = 'a'")
    return got.join(links.select("page_id", "link", F.col("url").alias("target"), "text"), "page_id", "left").select("page_id", F.col("url").alias("final_url"), "status_code", "error", "tries", "link", "target", "text")


def fetched_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lists of every page's URL, with a row for each answer that is none."""
    found = fetching.json_lists(fetching.fetched(table(spark, sf_dir, "pages").select("url"), _items), "n int, url_of string")
    return found.select("url", "ord", "n", "error")


def page_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of the pages behind a comment, odd quoting and character references."""
    p = table(spark, sf_dir, "pages").withColumn("n", F.col("page_id").cast("string"))
    odd = F.concat(F.lit('<!-- <a href="/hidden">x</a> --><a class=b href="/o\'neil jobs/'), "n", F.lit('?gh_jid=1">Caf&eacute; <b>&amp; bar</b></a><a href=/x&#47;'), "n", F.lit(">y</a><A HREF='q\"r'>z</A>"))
    links = read_links(p.select("page_id", F.concat(F.lit("https://p.example.com/d/"), "n").alias("url"), odd.alias("html")))
    return links.filter("kind = 'a'").select("page_id", "pos", "link", "url", "text")


# ---- keys of platforms ----------------------------------------------------------------------------------------------


def _evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few URLs of platforms for every customer, of one of eight kinds."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_custkey").cast("string").alias("n"))
    host = F.concat(F.lit("https://www.brand"), "n", F.lit(".com"))
    text = lambda *parts: F.concat(*(F.col("n") if x is None else F.lit(x) for x in parts))
    row = lambda source, url, confidence="medium": F.struct(F.lit(source).alias("source"), url.alias("url"), F.lit(confidence).alias("confidence"))
    posting = row("greenhouse", F.concat(host, F.lit("/jobs?gh_jid="), "n"))
    kinds = [
        F.array(row("greenhouse", text("https://boards.greenhouse.io/one", None), "high"), posting),
        F.array(row("greenhouse", text("https://boards.greenhouse.io/one", None), "high"), row("greenhouse", text("https://boards.greenhouse.io/two", None), "high"), posting),
        F.array(posting, row("greenhouse", F.concat(host, F.lit("/careers/all?gh_jid=7")))),
        F.array(posting, row("greenhouse", F.concat(F.lit("https://jobs.other"), "n", F.lit(".com/jobs?gh_jid=7")))),
        F.array(row("breezyhr", text("https://b", None, ".breezy.hr/json"), "high")),
        F.array(row("breezyhr", text("http://b", None, ".breezy.hr/json"), "high")),
        F.array(row("breezyhr", text("https://b", None, ".breezy.hr/p/x"), "high")),
        F.array(row("phenom", text("https://p", None, ".phenompeople.com/api/jobs?q=", None), "high")),
        F.array(row("phenom", text("https://p", None, ".phenompeople.com/search-results"), "high")),
    ]
    found = F.element_at(F.array(*kinds), (F.col("c_custkey") % len(kinds) + 1).cast("int"))
    rows = c.select("c_custkey", F.concat(F.lit("Brand "), "n").alias("company"), F.concat(host, F.lit("/careers")).alias("original_url"), F.posexplode(found).alias("nth", "x"))
    return rows.select("company", "original_url", "nth", "x.*")


def settled_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that evidence takes over or that follow from the company's name, and the last word on two platforms' routes."""
    found = detect.settled_candidates(pages.source_candidates(_evidence(spark, sf_dir)))
    return found.select("company", "detected_source", "source_key", "canonical_source_url", "evidence_count", "best_evidence_url", "confidence", "route_ready", "route_block_reason", "recommended_action")


# ---- details, places, kinds ------------------------------------------------------------------------------------------


def detailed_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workday records with the places of their details, for the first two vague ones of a company."""
    rows = jobs(spark, sf_dir)
    landed = _payloads(rows, "workday").select("company", F.lit(CAREERS).alias("career_url"), F.lit("intern").alias("term"), F.lit(0).alias("page"), "payload", F.lit(0).alias("ord"))
    town = F.concat(F.lit("Town"), F.translate(F.col("ord").cast("string"), "0123456789", "abcdefghij"), F.lit(", ON"))
    details = rows.select("company", F.concat(F.lit("/job/r"), F.col("ord").cast("string")).alias("path"), F.to_json(F.struct(F.struct(town.alias("location")).alias("jobPostingInfo"))).alias("payload"))
    kept = workday.postings(spark, landed, ["intern"], details, most_details=2)
    return connectors.normalise(kept, "workday", AS_OF).select("company", "id", "location")


def ashby_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings with postal addresses, other places and remote ones."""
    rows = jobs(spark, sf_dir)
    town = F.concat(F.lit("Town"), F.translate(F.col("ord").cast("string"), "0123456789", "abcdefghij"))
    postal = F.struct(F.struct(town.alias("addressLocality"), F.lit("Ontario").alias("addressRegion"), F.lit("Canada").alias("addressCountry")).alias("postalAddress"))
    k = F.col("ord") % 4
    item = F.struct(
        F.concat(F.lit("r"), F.col("ord").cast("string")).alias("id"), "title", F.col("url").alias("jobUrl"), F.when(k == 3, "Intern").alias("employmentType"), F.lit("Paris, France").alias("location"),
        F.when(k != 1, postal).alias("address"), F.when(k == 2, F.array(F.struct(F.lit("Lyon, France").alias("location")))).alias("secondaryLocations"), (k == 3).alias("isRemote"),
    )
    listed = rows.groupBy("company").agg(F.collect_list(item).alias("jobs")).select("company", F.lit(CAREERS).alias("career_url"), F.to_json(F.struct("jobs")).alias("payload"), F.lit(0).alias("ord"))
    return connectors.records(listed, "ashby", AS_OF).select("id", "type", "location")


def labelled_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings that are told by the labels of their employment and experience, in label or id."""
    rows = jobs(spark, sf_dir)
    k = F.col("ord") % 4
    label = lambda i, text, field: F.when(k == i, F.struct(F.lit(text if field == "id" else None).cast("string").alias("id"), F.lit(text if field == "label" else None).cast("string").alias("label")))
    place = F.struct(F.lit("Ottawa").alias("city"), F.lit("ON").alias("region"), F.lit("Canada").alias("country"), (k == 1).alias("remote"))
    item = F.struct(
        F.concat(F.lit("r"), F.col("ord").cast("string")).alias("id"), F.concat(F.lit("Role "), F.col("ord").cast("string"), F.lit(" for a student")).alias("refNumber"), F.concat(F.lit("Analyst "), F.col("ord").cast("string")).alias("name"),
        F.coalesce(label(0, "Internal intern", "label"), label(2, "permanent", "label")).alias("typeOfEmployment"), F.coalesce(label(1, "internship", "id"), label(2, "associate", "id")).alias("experienceLevel"), place.alias("location"),
    )
    listed = rows.groupBy("company").agg(F.collect_list(item).alias("content")).select("company", F.lit(CAREERS).alias("career_url"), F.to_json(F.struct("content")).alias("payload"), F.lit(0).alias("ord"))
    return connectors.records(listed, "smartrecruiters", AS_OF).select("id", "company", "title", "type", "location")


# ---- a plug-in in a run -----------------------------------------------------------------------------------------------


def _plugged_rows(landed: DataFrame) -> DataFrame:
    items = landed.select("company", "career_url", "ord", F.posexplode(F.split("payload", "\n")).alias("pos", "line"))
    return items.select("company", "career_url", "ord", "pos", F.struct(F.split("line", "\t")[0].alias("id"), F.split("line", "\t")[1].alias("title")).alias("raw"))


def _plugged_records(rows: DataFrame, as_of: str) -> DataFrame:
    kind = F.when(F.contains(F.lower("raw.title"), F.lit("intern")), "internship")
    rows = rows.withColumn("type", kind).filter("type IS NOT NULL")
    empty = F.lit("")
    return rows.select(
        F.concat(F.lit("plugged-"), "raw.id").alias("id"), "company", F.col("raw.title").alias("title"), F.lit("Here").alias("location"), "type", empty.alias("season"), F.lit("plugged").alias("source"),
        F.col("career_url").alias("url"), F.lit(None).cast("string").alias("date_posted"), F.lit(as_of).alias("date_added"), F.lit(True).alias("active"), F.struct("ord", "pos").alias("at"),
    )


def plugged_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over a registered connector of another form of payload; its counts beside its rows."""
    connectors.register("plugged", connectors.Handler(_plugged_rows, _plugged_records))
    configs = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ord"), F.col("c_name").alias("company"), F.lit(" Plugged").alias("source"), F.lit(CAREERS).alias("url"), (F.col("c_custkey") % 3 != 0).alias("enabled"))
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "title"))), lambda x: F.concat(x["ord"].cast("string"), F.lit("\t"), x["title"], F.lit(" "), x["ord"].cast("string"))), "\n")
    landed = jobs(spark, sf_dir).groupBy("company").agg(lines.alias("payload")).select("company", "payload", F.lit("plugged").alias("source"), F.lit(0).cast("long").alias("ord"), F.lit(True).alias("ok"))
    state = run.empty_snapshot(spark)
    out = run.daily_run(configs, landed, state, state.withColumn("date_archived", F.lit(None).cast("string")), AS_OF)
    rows = out.active.select("id", "title", F.lit(None).cast("bigint").alias("n"))
    return rows.unionByName(out.counts.select(F.col("name").alias("id"), F.lit("").alias("title"), "n"))


# ---- leads ----------------------------------------------------------------------------------------------------------


def promoted_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leads of the listings that share neither identity nor URL with what is known or with an earlier lead."""
    found = leads.roll_up(_listings(spark, sf_dir))
    # Each lead twice: the second time under another identity and the same URL, or the other way round.
    number = F.regexp_extract("identity", r"(\d+)$", 1).cast("int")
    first = found.withColumn("ord", number * 2)
    changed = lambda c, rest: F.when(number % 2 == rest, F.concat(c, F.lit("x"))).otherwise(F.col(c))
    again = first.withColumns({"ord": F.col("ord") + 1, "identity": changed("identity", 0), "url": changed("url", 1)})
    known = first.filter(F.col("identity").rlike("[05]$")).select("url")
    return leads.promote(first.unionByName(again), known).select("ord", "identity", "url")


QUERIES = {f.__name__: f for f in (fetched_pages, fetched_lists, page_tokens, settled_keys, detailed_postings, ashby_places, labelled_kinds, plugged_run, promoted_leads)}

_TOWN = "'Town' || translate(CAST(ord AS VARCHAR), '0123456789', 'abcdefghij')"
_BRAND = "'https://www.brand' || n || '.com"

ORACLE_SQL = {
    "fetched_pages": """WITH p AS (SELECT page_id, url, length(url) AS n FROM pages)
SELECT page_id, CASE WHEN n % 5 <> 0 AND n % 7 <> 0 THEN url || '?seen' END AS final_url, CASE WHEN n % 5 <> 0 AND n % 7 <> 0 THEN 200 END AS status_code,
  CASE WHEN n % 5 = 0 THEN 'TimeoutError: no answer in 2.5 s' WHEN n % 7 = 0 THEN 'LookupError: ' || url END AS error, CASE WHEN n % 5 = 0 OR n % 7 = 0 THEN 2 ELSE 1 END AS tries,
  CASE WHEN n % 5 <> 0 AND n % 7 <> 0 THEN 'https://jobs.lever.co/s' || n || '/1?x=é' END AS link, CASE WHEN n % 5 <> 0 AND n % 7 <> 0 THEN 'https://jobs.lever.co/s' || n || '/1?x=é' END AS target, CASE WHEN n % 5 <> 0 AND n % 7 <> 0 THEN 'Jobs' END AS text FROM p""",
    "fetched_lists": """WITH p AS (SELECT url, length(url) AS size FROM pages)
SELECT url, ord, CASE WHEN ord = 0 THEN size END AS n, NULL AS error FROM p, (VALUES (0), (2)) t(ord) WHERE size % 6 > 1
UNION ALL SELECT url, NULL, NULL, CASE WHEN size % 6 = 0 THEN 'not a JSON list' ELSE 'not JSON' END FROM p WHERE size % 6 < 2""",
    "page_tokens": """SELECT page_id, 0 AS pos, '/o''neil jobs/' || page_id || '?gh_jid=1' AS link, 'https://p.example.com/o''neil jobs/' || page_id || '?gh_jid=1' AS url, 'Café & bar' AS text FROM pages
UNION ALL SELECT page_id, 1, '/x/' || page_id, 'https://p.example.com/x/' || page_id, 'y' FROM pages UNION ALL SELECT page_id, 2, 'q"r', 'https://p.example.com/d/q"r', 'z' FROM pages""",
    "settled_keys": f"""WITH c AS (SELECT c_custkey AS n, c_custkey % 9 AS k FROM customer),
r(k, n, source, key, canonical, many, best, confidence, ready, reason, act) AS (
  SELECT k, n, 'greenhouse', 'one' || n, 'https://boards-api.greenhouse.io/v1/boards/one' || n || '/jobs', CASE k WHEN 0 THEN 2 ELSE 1 END, 'https://boards.greenhouse.io/one' || n, 'high', true, '', 'validate_with_existing_ats_scraper' FROM c WHERE k IN (0, 1)
  UNION ALL SELECT k, n, 'greenhouse', 'two' || n, 'https://boards-api.greenhouse.io/v1/boards/two' || n || '/jobs', 1, 'https://boards.greenhouse.io/two' || n, 'high', true, '', 'validate_with_existing_ats_scraper' FROM c WHERE k = 1
  UNION ALL SELECT k, n, 'greenhouse', 'brand' || n, 'https://boards-api.greenhouse.io/v1/boards/brand' || n || '/jobs', 2, CASE WHEN length(CAST(n AS VARCHAR)) > 5 THEN {_BRAND}/careers/all?gh_jid=7' ELSE {_BRAND}/jobs?gh_jid=' || n END, 'medium', true, '', 'validate_with_existing_ats_scraper' FROM c WHERE k = 2
  UNION ALL SELECT k, n, 'breezyhr', 'b' || n, CASE k WHEN 4 THEN 'https://b' || n || '.breezy.hr/json' WHEN 5 THEN 'http://b' || n || '.breezy.hr/json' ELSE 'https://b' || n || '.breezy.hr/json' END, 1, CASE k WHEN 4 THEN 'https://b' || n || '.breezy.hr/json' WHEN 5 THEN 'http://b' || n || '.breezy.hr/json' ELSE 'https://b' || n || '.breezy.hr/p/x' END, 'high', k = 4,
    CASE k WHEN 4 THEN '' WHEN 5 THEN 'BreezyHR JSON endpoint is not HTTPS' ELSE 'A public BreezyHR /json endpoint was not directly observed' END, CASE k WHEN 4 THEN 'custom_ats_adapter_needed' ELSE 'manual_review' END FROM c WHERE k IN (4, 5, 6)
  UNION ALL SELECT k, n, 'phenom', 'brand-' || n, CASE k WHEN 7 THEN 'https://p' || n || '.phenompeople.com/api/jobs?q=' || n ELSE 'https://p' || n || '.phenompeople.com/search-results' END, 1, CASE k WHEN 7 THEN 'https://p' || n || '.phenompeople.com/api/jobs?q=' || n ELSE 'https://p' || n || '.phenompeople.com/search-results' END, 'high', k = 7,
    CASE k WHEN 7 THEN '' ELSE 'No clear public Phenom job-search API endpoint was identified' END, 'future_phenom_adapter' FROM c WHERE k IN (7, 8))
SELECT 'Brand ' || n AS company, source AS detected_source, key AS source_key, canonical AS canonical_source_url, CAST(many AS BIGINT) AS evidence_count, best AS best_evidence_url, confidence, ready AS route_ready, reason AS route_block_reason, act AS recommended_action FROM r""",
    "detailed_postings": f"""WITH {_JOBS}, k AS (SELECT *, {_KIND} AS kind, title || '::' || location AS loose FROM jobs),
r AS (SELECT *, row_number() OVER (PARTITION BY company, location = '3 Locations' ORDER BY ord) AS nth FROM k WHERE kind IS NOT NULL)
SELECT company, 'workday-' || trim(regexp_replace(lower(company), '[^a-z0-9]+', '-', 'g'), '-') || '-job-r' || ord AS id, CASE WHEN location = '3 Locations' AND nth <= 2 THEN {_TOWN} || ', ON' ELSE {_CITY} END AS location FROM r""",
    "ashby_places": f"""WITH {_JOBS}, k AS (SELECT *, {_KIND} AS kind FROM jobs)
SELECT 'ashby-' || trim(regexp_replace(lower(company), '[^a-z0-9]+', '-', 'g'), '-') || '-r' || ord AS id, coalesce(kind, 'internship') AS type,
  CASE ord % 4 WHEN 0 THEN {_TOWN} || ', ON, Canada' WHEN 1 THEN 'Paris, France' WHEN 2 THEN {_TOWN} || ', ON, Canada / Lyon, France' ELSE {_TOWN} || ', ON, Canada / Canada Remote' END AS location FROM k WHERE kind IS NOT NULL OR ord % 4 = 3""",
    "labelled_kinds": f"""WITH {_JOBS} SELECT 'smartrecruiters-' || trim(regexp_replace(lower(company), '[^a-z0-9]+', '-', 'g'), '-') || '-r' || ord AS id, company, 'Analyst ' || ord AS title, 'internship' AS type,
  CASE WHEN ord % 4 = 1 THEN 'Canada Remote' ELSE 'Ottawa, ON, Canada' END AS location FROM jobs WHERE ord % 4 IN (0, 1)""",
    "plugged_run": f"""WITH {_JOBS}, k AS (SELECT j.ord, j.title || ' ' || j.ord AS title, c_custkey FROM jobs j JOIN customer ON company = c_name WHERE c_custkey % 3 <> 0),
f AS (SELECT * FROM k WHERE lower(title) LIKE '%intern%')
SELECT 'plugged-' || ord AS id, title, CAST(NULL AS BIGINT) AS n FROM f
UNION ALL SELECT unnest(['companies', 'raw_rows', 'errors', 'active', 'internships', 'new_grads', 'archived']), '', CAST(unnest([(SELECT count(*) FROM customer WHERE c_custkey % 3 <> 0), (SELECT count(*) FROM k), 0, (SELECT count(*) FROM f), (SELECT count(*) FROM f), 0, 0]) AS BIGINT)""",
    "promoted_leads": f"""WITH {_EVENT_LISTINGS}, m AS (SELECT identity, url, CAST(regexp_extract(identity, '(\\d+)$', 1) AS INT) AS n FROM leads)
SELECT 2 * n AS ord, identity, url FROM m WHERE n % 5 <> 0""",
}
