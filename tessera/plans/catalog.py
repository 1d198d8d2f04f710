"""The library's queries over the driver's tables, and the SQL they are held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import dates, locations, text, urls
from tessera.operators import leads, merge, pages
from tessera.operators.dedupe import chained, checkpointed, first_wins, greedy, last_wins, merge_traces, survivors
from tessera.plans import report

AS_OF = "2026-01-31"
_TITLES = ("Software Engineering Intern - Summer 2026", "Senior Data Engineer", "New Grad Analyst", "Co-op Developer Fall 2027", "Staff Engineer, New Grad", "Entry Level Designer", "Student Researcher 2026 Winter", "Early Career Program", "Lead Architect", "Senior Manager, Student Programs", "Data Engineer", "Recent Graduate Tester")
_PLACES = ("Toronto, ON, Canada", "San Diego, CA", "Warren, Michigan, United States", "Remote, Canada", "3 Locations", "Paris, France; London, UK", "US-TN-Tullahoma")
_CASE = lambda column, values: f"CASE {column} % {len(values)} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"

#: Records made of the driver's tables, in SQL that both engines run.
JOBS_SQL = f"""
SELECT o_orderkey AS ord, CASE WHEN o_orderkey % 10 = 0 THEN '' ELSE concat('job-', CAST(o_orderkey % 9000 AS string)) END AS id, c_name AS company,
  {_CASE('o_orderkey', _TITLES)} AS title, {_CASE('o_orderkey', _PLACES)} AS location, lower(n_name) AS source,
  concat('https://example.com/', CAST(o_custkey AS string), '/', CAST(o_orderkey AS string)) AS url,
  CAST(CAST(o_orderdate AS date) AS string) AS date_added, o_orderstatus <> 'P' AS active
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""

_KIND = """CASE WHEN regexp_matches(lower(title), '\\bintern(ship)?s?\\b|\\bco[\\s-]?op\\b|\\bstudent\\b|\\bstagiaire\\b|\\bstage\\b') THEN 'internship'
  WHEN regexp_matches(lower(title), '\\b(senior|sr|manager|director|principal|staff|lead|head of|experienced)\\b') THEN NULL
  WHEN regexp_matches(lower(title), '\\bnew grad(uate)?s?\\b|\\bgraduate program\\b|\\bearly career\\b|\\bentry[\\s-]?level\\b|\\b(university|recent) graduate\\b') THEN 'new_grad' END"""
_SHOWN = {"Toronto, ON, Canada": "Toronto, ON, Canada", "San Diego, CA": "San Diego, Canada", "Warren, Michigan, United States": "Michigan, United States", "Remote, Canada": "Canada Remote", "3 Locations": "3 Locations", "Paris, France; London, UK": "Paris, France / London, United Kingdom", "US-TN-Tullahoma": "US-Tn-Tullahoma"}
_CITY = "CASE location " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _SHOWN.items()) + " END"
_JOBS = f"jobs AS ({JOBS_SQL.replace('AS string', 'AS VARCHAR')})"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = {n: table(spark, sf_dir, n) for n in ("orders", "customer", "nation")}
    found = spark.sql(JOBS_SQL.replace("FROM orders", "FROM {orders}").replace("JOIN customer", "JOIN {customer}").replace("JOIN nation", "JOIN {nation}"), **views)
    return found.withColumn("type", text.job_type(F.col("title")))


def job_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First row of each company, title and location that is active and of a kind, as shown on the board."""
    rows = jobs(spark, sf_dir).filter("type IS NOT NULL")
    rows = locations.with_places(first_wins(rows, ["company", "title", "location"], ["ord"]), "location", "place")
    return report.cells(report.board(rows, "internship"))


def classify_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = jobs(spark, sf_dir)
    return rows.select("ord", "title", F.coalesce("type", F.lit("none")).alias("kind"), text.season(F.col("title")).alias("season"))


def type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.type_counts(jobs(spark, sf_dir).withColumn("type", F.coalesce("type", F.lit("none"))))


def format_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return locations.with_places(jobs(spark, sf_dir), "location", "place").select("ord", "place")


def job_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit("")
    return jobs(spark, sf_dir).select("ord", text.job_id(F.col("source"), F.col("company"), none, F.col("id"), F.col("title"), F.col("location"), F.col("url")).alias("job_id"))


def event_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    millis = (F.unix_timestamp("ts") * 1000).cast("string")
    return e.select("event_id", dates.epoch_date(millis).alias("from_epoch"), dates.iso_date(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")).alias("from_iso"))


def first_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_wins(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), ["text"], ["doc_id"]).select("doc_id", "source")


def last_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value")
    return last_wins(e, ["user_id", "event_type"], ["event_id"]).withColumnRenamed("event_id", "first_id")


def fallback_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = jobs(spark, sf_dir).withColumn("key", F.coalesce(F.nullif("id", F.lit("")), F.concat_ws("::", F.lower("company"), F.lower("title"))))
    return first_wins(rows, ["key"], ["ord"]).select("ord", "key")


def chained_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", F.concat(F.col("user_id"), F.lit("-"), "event_type").alias("a"), F.pmod(F.hash("value") * 0 + F.floor("value").cast("long"), F.lit(5_000)).cast("string").alias("b"))
    return chained(e, ["a", "b"], ["event_id"]).select("event_id")


def greedy_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = jobs(spark, sf_dir).withColumn("loose", F.concat_ws("::", F.lower("company"), F.lower("title")))
    return greedy(rows, ["id", "loose"], "ord").select("ord")


def traced_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", F.length("text").alias("n"), "source")
    return merge_traces(d, ["n"], ["source"], ["doc_id"])


def best_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal", F.col("s_name").alias("url"))
    return survivors(s, ["s_nationkey"], [F.desc("s_acctbal")], ["s_suppkey"])[0]


def rejected_suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal", F.col("s_name").alias("url"))
    return survivors(s, ["s_nationkey"], [F.desc("s_acctbal")], ["s_suppkey"])[1]


def _snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All orders dealt to the three inputs; ids that two neighbours share lie in two of them."""
    rows = jobs(spark, sf_dir).withColumn("id", F.concat(F.lit("j"), F.floor(F.col("ord") / 2).cast("string"))).drop("type")
    part = lambda k: rows.filter(F.col("ord") % 3 == k)
    return merge.merge_snapshots(part(0), part(1), part(2).withColumn("date_archived", F.lit("2025-12-31")), part(1).select("source", "company").distinct(), AS_OF)


def merged_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snapshots(spark, sf_dir)[0].select("id", "date_added", "active")


def merged_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snapshots(spark, sf_dir)[1].select("id", "date_archived", "active")


def page_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return table(spark, sf_dir, "pages").select("page_id", urls.bare_host(u).alias("host"), urls.page_url(u).alias("page_url"), F.size(urls.segments(u)).alias("n_segments"))


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = pages.tag_links(table(spark, sf_dir, "pages")).filter("tag = 'a'")
    return links.groupBy("page_id").agg(F.count(F.lit(1)).alias("n_links"), F.countDistinct("link").alias("n_distinct"))


def _listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("k", F.col("user_id") % 40)
    hosts = F.when(F.col("k") % 4 == 0, "https://jobs.lever.co/co").when(F.col("k") % 4 == 1, "https://boards.greenhouse.io/co").when(F.col("k") % 4 == 2, "https://jobs.ashbyhq.com/co").otherwise("https://example.com/co")
    return e.select(F.col("event_id").alias("ord"), F.initcap("event_type").alias("company"), F.concat(hosts, F.col("k").cast("string"), F.lit("/job/"), F.col("event_id").cast("string")).alias("url"))


def lead_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leads.roll_up(_listings(spark, sf_dir))


def listing_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leads.listing_stats(_listings(spark, sf_dir))


def new_leads(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = checkpointed(leads.roll_up(_listings(spark, sf_dir)))
    known = found.filter(F.col("identity").rlike("[05]$")).select("url", "identity")
    return leads.new_leads(found, known).select("identity", "url", "job_count")


def review_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _listings(spark, sf_dir)
    known = rows.select(F.regexp_replace("url", "/job/.*$", "").alias("url")).distinct().filter(F.col("url").rlike("[05]$") & ~F.col("url").startswith("https://example"))
    first = first_wins(rows.withColumn("stem", F.regexp_replace("url", "/job/.*$", "")), ["company", "stem"], ["ord"])
    return leads.review(first, known).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


QUERIES = {
    f.__name__: f
    for f in (job_board, classify_titles, type_counts, format_places, job_ids, event_dates, first_texts, last_events, fallback_keys, chained_keys, greedy_keys, traced_sources, best_suppliers, rejected_suppliers, merged_active, merged_archive, page_urls, page_links, lead_rollup, listing_stats, new_leads, review_counts)
}

_EVENT_LISTINGS = """l AS (SELECT event_id AS ord, concat(upper(event_type[1]), event_type[2:]) AS company, user_id % 40 AS k FROM events),
r AS (SELECT ord, company, k, CASE k % 4 WHEN 0 THEN 'lever' WHEN 1 THEN 'greenhouse' WHEN 2 THEN 'ashby' END AS source,
  CASE k % 4 WHEN 0 THEN 'https://jobs.lever.co/co' WHEN 1 THEN 'https://boards.greenhouse.io/co' WHEN 2 THEN 'https://jobs.ashbyhq.com/co' ELSE 'https://example.com/co' END || k AS url FROM l),
leads AS (SELECT source || ' :: co' || k AS identity, any_value(source) AS source, any_value(url) AS url, CAST(count(*) AS VARCHAR) AS job_count, arg_min(url || '/job/' || ord, ord) AS example_job_url FROM r WHERE source IS NOT NULL GROUP BY source, k),
c AS (SELECT source || ' :: co' || k AS identity, company, count(*) AS n FROM r WHERE source IS NOT NULL GROUP BY ALL),
named AS (SELECT identity, company FROM c QUALIFY row_number() OVER (PARTITION BY identity ORDER BY n DESC, lower(company), company) = 1)"""

_MERGE = f"""WITH {_JOBS}, j AS (SELECT * REPLACE ('j' || (ord // 2) AS id) FROM jobs),
old AS (SELECT * FROM j WHERE ord % 3 = 0),
new AS (SELECT * FROM j WHERE ord % 3 = 1 QUALIFY row_number() OVER (PARTITION BY id ORDER BY ord DESC) = 1),
gone AS (SELECT * FROM j WHERE ord % 3 = 2 QUALIFY row_number() OVER (PARTITION BY id ORDER BY ord DESC) = 1),
touched AS (SELECT DISTINCT lower(source || '::' || company) AS t FROM j WHERE ord % 3 = 1)"""


def _greedy_sql(rounds: int) -> str:
    """The greedy dedupe in rounds: as many as the longest chain of conflicts has links are enough."""
    steps = [f"""WITH {_JOBS}, a0 AS MATERIALIZED (SELECT ord, 'i' || id AS k FROM jobs WHERE id <> '' UNION SELECT ord, 'l' || lower(company) || '::' || lower(title) FROM jobs)"""]
    for i in range(rounds):
        steps.append(f"f{i} AS MATERIALIZED (SELECT k, min(ord) AS m FROM a{i} GROUP BY k), w{i} AS MATERIALIZED (SELECT ord FROM a{i} JOIN f{i} USING (k) GROUP BY ord HAVING bool_and(m = ord))")
        steps.append(f"t{i} AS MATERIALIZED (SELECT DISTINCT k FROM a{i} WHERE ord IN (SELECT ord FROM w{i})), x{i} AS MATERIALIZED (SELECT DISTINCT ord FROM a{i} WHERE k IN (SELECT k FROM t{i}))")
        steps.append(f"a{i + 1} AS MATERIALIZED (SELECT * FROM a{i} WHERE ord NOT IN (SELECT ord FROM x{i}))")
    return ", ".join(steps) + " " + " UNION ALL ".join(f"SELECT ord FROM w{i}" for i in range(rounds))


ORACLE_SQL = {
    "job_board": f"""WITH {_JOBS}, k AS (SELECT *, {_KIND} AS type FROM jobs),
f AS (SELECT * FROM k WHERE type IS NOT NULL QUALIFY row_number() OVER (PARTITION BY company, title, location ORDER BY ord) = 1)
SELECT company, title AS role, {_CITY} AS city, '[Apply](' || url || ')' AS apply, date_added FROM f WHERE active AND type = 'internship'""",
    "classify_titles": f"""WITH {_JOBS} SELECT ord, title, coalesce({_KIND}, 'none') AS kind, CASE WHEN title LIKE '%Summer 2026%' THEN 'Summer 2026' WHEN title LIKE '%Fall 2027%' THEN 'Fall 2027' WHEN title LIKE '%2026 Winter%' THEN 'Winter 2026' ELSE 'Not specified' END AS season FROM jobs""",
    "type_counts": f"WITH {_JOBS} SELECT coalesce({_KIND}, 'none') AS type, count(*) AS n, count_if(active) AS n_active FROM jobs GROUP BY 1",
    "format_places": f"WITH {_JOBS} SELECT ord, {_CITY} AS place FROM jobs",
    "job_ids": f"""WITH {_JOBS} SELECT ord, source || '-' || trim(regexp_replace(lower(company), '[^a-z0-9]+', '-', 'g'), '-') || '-' || CASE WHEN id <> '' THEN id ELSE substr(sha1(title || '::' || location || '::' || url), 1, 12) END AS job_id
FROM (SELECT * REPLACE (lower(source) AS source) FROM jobs)""",
    "event_dates": "SELECT event_id, strftime(ts, '%Y-%m-%d') AS from_epoch, strftime(ts, '%Y-%m-%d') AS from_iso FROM events",
    "first_texts": "SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1",
    "last_events": "SELECT user_id, event_type, min(event_id) AS first_id, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2",
    "fallback_keys": f"WITH {_JOBS}, k AS (SELECT ord, coalesce(nullif(id, ''), lower(company) || '::' || lower(title)) AS key FROM jobs) SELECT ord, key FROM k QUALIFY row_number() OVER (PARTITION BY key ORDER BY ord) = 1",
    "chained_keys": """WITH a AS (SELECT event_id, CAST(floor(value) AS BIGINT) % 5000 AS b FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1)
SELECT event_id FROM a QUALIFY row_number() OVER (PARTITION BY b ORDER BY event_id) = 1""",
    "greedy_keys": _greedy_sql(12),
    "traced_sources": "SELECT length(text) AS n, min(doc_id) AS doc_id, array_to_string(list_sort(list(DISTINCT source)), ';') AS source FROM documents GROUP BY 1",
    "best_suppliers": "SELECT s_suppkey, s_nationkey, s_acctbal, s_name AS url, count(*) OVER (PARTITION BY s_nationkey) - 1 AS n_collapsed FROM supplier QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) = 1",
    "rejected_suppliers": """SELECT s_suppkey, s_nationkey, s_acctbal, s_name AS url, first_value(s_name) OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS kept_url FROM supplier
QUALIFY row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) > 1""",
    "merged_active": _MERGE + """ SELECT id, date_added, true AS active FROM old WHERE lower(source || '::' || company) NOT IN (SELECT t FROM touched)
UNION ALL SELECT n.id, coalesce(o.date_added, g.date_added, n.date_added), true FROM new n LEFT JOIN (SELECT id, arg_max(date_added, ord) AS date_added FROM old GROUP BY id) o USING (id) LEFT JOIN gone g USING (id)""",
    "merged_archive": _MERGE + f""", v AS (SELECT id, '{AS_OF}' AS date_archived FROM old WHERE lower(source || '::' || company) IN (SELECT t FROM touched) AND id NOT IN (SELECT id FROM new))
SELECT id, date_archived, false AS active FROM v UNION ALL SELECT id, '2025-12-31', false FROM gone WHERE id NOT IN (SELECT id FROM new) AND id NOT IN (SELECT id FROM v)""",
    "page_urls": """SELECT page_id, regexp_replace(regexp_extract(lower(url), '^https?://([^/?#:]*)', 1), '^www\\.', '') AS host,
CASE WHEN regexp_matches(url, '^https?://[^/?#]+$') THEN url || '/' WHEN regexp_matches(url, '^https?://[^/?#]+/$') THEN url ELSE regexp_replace(regexp_replace(url, '#.*$', ''), '/+(\\?|$)', '\\1') END AS page_url,
len(list_filter(string_split(regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1), '/'), lambda x: x <> '')) AS n_segments FROM pages""",
    "page_links": """WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '<a\\b[^>]*?\\shref\\s*=\\s*["'']?([^"''\\s>]+)', 1, 'is')) AS link FROM pages)
SELECT page_id, count(*) AS n_links, count(DISTINCT replace(link, '&amp;', '&')) AS n_distinct FROM l GROUP BY 1""",
    "lead_rollup": f"WITH {_EVENT_LISTINGS} SELECT company, url, source, job_count, example_job_url, identity FROM leads JOIN named USING (identity)",
    "listing_stats": f"WITH {_EVENT_LISTINGS} SELECT CASE WHEN source IS NULL THEN 'unsupported' ELSE 'supported' END AS status, count(*) AS n FROM r GROUP BY 1",
    "new_leads": f"WITH {_EVENT_LISTINGS} SELECT identity, url, job_count FROM leads WHERE NOT regexp_matches(identity, '[05]$')",
    "review_counts": f"""WITH {_EVENT_LISTINGS}, f AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY company, url ORDER BY ord) = 1),
s AS (SELECT CASE WHEN source IS NULL THEN 'rejected' WHEN regexp_matches(url, '[05]$') THEN 'skipped' WHEN row_number() OVER (PARTITION BY url ORDER BY ord) = 1 THEN 'accepted' ELSE 'skipped' END AS status FROM f)
SELECT status, count(*) AS n FROM s GROUP BY 1""",
}
