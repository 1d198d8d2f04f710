"""Discovery of career pages in records of any shape: candidates, what is known of them, and their dedupe."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import platforms as p
from tessera.functions.text import alphanumeric, clean, fold
from tessera.functions.urls import page_url
from tessera.operators.dedupe import checkpointed, merge_traces

# Fields that name the company and that hold URLs, in order.
COMPANY_FIELDS = ("company", "company_name", "employer", "organization", "name")
URL_FIELDS = ("career_url", "careers_url", "jobs_url", "job_url", "apply_url", "example_job_url", "url")
DISCOVERED = ("company", "career_url", "discovered_from", "source_type", "existing_known_source", "reason", "enabled")
DUPLICATES = ("company", "host", "kept_url", "duplicate_url", "duplicate_reason", "discovered_from")
# Fixed value: a URL anywhere in a text.
_URL = r"(?i)(https?://[^\s\"'<>|\])]+)"


def _field(name: str) -> Column:
    """A field of ``fields``, an array of (key, value); the last of equal keys."""
    return F.try_element_at(F.filter("fields", lambda e: F.lower(clean(e["key"])) == name), F.lit(-1))["value"]


def source_label(file: Column, record: Column) -> Column:
    """Where a record comes from, by its file's name and its own text; an archive's label is this library's own."""
    text = F.lower(F.concat_ws(" ", file, record))
    return F.when(F.lower(F.element_at(F.split(file, "/"), -1)) == "custom_companies.csv", "manual_custom_companies").when(F.contains(text, F.lit("simplify")), "simplify").when(F.contains(text, F.lit("archive")), "archive").otherwise("existing_data")


def record_links(records: DataFrame) -> DataFrame:
    """(ord, nth, company, declared, origin, url) of records (ord, file, record): JSON objects as text.

    The company is the first of its fields that isn't blank; URLs come from seven fields, in order,
    each once.
    """
    rows = records.withColumn("fields", F.map_entries(F.from_json("record", "map<string,string>")))
    company = F.coalesce(*(F.nullif(clean(_field(n)), F.lit("")) for n in COMPANY_FIELDS), F.lit(""))
    texts = F.concat(*(F.concat(F.when(_field(n).rlike("^https?://"), F.array(_field(n))).otherwise(F.array().cast("array<string>")), F.regexp_extract_all(F.coalesce(_field(n), F.lit("")), F.lit(_URL), 1)) for n in URL_FIELDS))
    urls = F.filter(F.array_distinct(F.transform(texts, lambda u: page_url(F.regexp_replace(clean(u), "[.,;]+$", "")))), lambda u: u != "")
    rows = rows.select("ord", company.alias("company"), F.lower(clean(_field("source"))).alias("declared"), source_label(F.col("file"), F.col("record")).alias("origin"), F.posexplode(urls).alias("nth", "url"))
    return rows


def known_sources(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(urls, (company_key, sources)): what :func:`record_links` say of platforms with a connector or a list."""
    rows, x = p.with_parts(links, "url")
    rows = rows.withColumn("source", F.coalesce(F.nullif(p.platform(x, p.LISTED), F.lit("")), "declared")).filter(F.col("source").isin(*p.LISTED))
    rows = rows.select("url", "source", alphanumeric(clean(F.col("company"))).alias("company_key"))
    return rows.select("url").distinct(), rows.filter("company_key <> ''").groupBy("company_key").agg(F.array_join(F.array_sort(F.collect_set("source")), ";").alias("sources"))


def candidates(links: DataFrame, known: DataFrame) -> DataFrame:
    """DISCOVERED rows with (ord, nth): career pages in :func:`record_links` that ``known`` links don't have."""
    urls, sources = known_sources(known)
    rows, x = p.with_parts(links.filter("company <> ''"), "url")
    rows = rows.filter(p.platform(x, p.LISTED) == "").withColumns({"career_url": p.career_page(x), "source_type": p.source_type(x), "_unsupported": p.platform(x, p.UNSUPPORTED)})
    rows, y = p.with_parts(p.without_parts(rows).join(urls, "url", "left_anti"), "career_url")
    rows = p.without_parts(rows.filter((F.col("career_url") != "") & p.looks_like_careers(y)))
    rows = rows.withColumn("company_key", alphanumeric(clean(F.col("company")))).join(sources, "company_key", "left")
    origin = F.col("origin")
    plain = F.when(origin == "manual_custom_companies", "not_in_existing_ats_sources").when(origin == "simplify", "company_career_url_from_simplify").when(origin == "archive", "found_in_archive").otherwise("likely_custom_or_branded_ats")
    reason = F.when(F.col("source_type") == "unsupported_url", F.concat(F.lit("unsupported_"), "_unsupported", F.lit("_url"))).otherwise(plain)
    return rows.select("ord", "nth", "company", "career_url", origin.alias("discovered_from"), "source_type", F.coalesce("sources", F.lit("")).alias("existing_known_source"), reason.alias("reason"), F.lit("true").alias("enabled"))


def _joined_set(column: str) -> Column:
    """The parts of a ;-joined column over a group, sorted; there are a few different ones."""
    return F.array_join(F.array_sort(F.filter(F.array_distinct(F.flatten(F.collect_set(F.split(column, ";")))), lambda s: s != "")), ";").alias(column)


def deduplicated(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(DISCOVERED rows, DUPLICATES rows): first equal company and page, then one page of each company and host.

    Of a host's pages (on four platforms: of a board's) one stays: a manual one before others, one
    without a query, the one with the shortest path, the first.  It takes the origins, reasons and
    sources of all, and says how many it stands for.
    """
    rows = rows.withColumns({"_company": alphanumeric(clean(F.col("company"))), "_page": page_url(F.col("career_url"))}).filter("_company <> '' AND _page <> ''")
    rows = merge_traces(rows, ["_company", "_page"], ["discovered_from", "reason", "existing_known_source"], ["ord", "nth"])
    rows, x = p.with_parts(rows, "career_url")
    rows = rows.withColumns({"_group": p.group_key(x), "_canonical": p.group_url(x), "_host": x("host"), "_plain": x("query") == "", "_depth": F.size(x("low"))})
    manual = F.array_contains(F.split("discovered_from", ";"), "manual_custom_companies")
    group, traces = ["_company", "_group"], ("discovered_from", "reason", "existing_known_source")
    rows = checkpointed(p.without_parts(rows).withColumn("_place", F.struct((~manual).alias("m"), (~F.col("_plain")).alias("q"), "_depth", "ord", "nth")))
    own = [c for c in rows.columns if c not in (*group, *traces, "_place")]
    groups = rows.groupBy(*group).agg(F.min_by(F.struct(*own), "_place").alias("_best"), F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_size"), *map(_joined_set, traces))
    collapsed = F.array_join(F.array_sort(F.array_union(F.filter(F.split("reason", ";"), lambda s: s != ""), F.array(F.concat(F.lit("collapsed_"), (F.col("_size") - 1).cast("string"), F.lit("_duplicate_urls"))))), ";")
    kept = groups.select(*group, "_best.*", "_size", *traces).withColumns({"career_url": F.col("_canonical"), "reason": F.when(F.col("_size") > 1, collapsed).otherwise(F.col("reason"))})
    several = groups.filter("_size > 1").select(*group, "_first", F.col("_best._canonical").alias("_kept"))
    others = rows.join(several, group).filter(F.col("_place") != F.col("_first"))
    gone = others.select("company", F.col("_host").alias("host"), F.col("_kept").alias("kept_url"), F.col("career_url").alias("duplicate_url"), F.lit("same_normalized_company_and_career_host").alias("duplicate_reason"), "discovered_from")
    return kept.select(*DISCOVERED).orderBy(fold(F.col("company")), "career_url"), gone.orderBy(fold(F.col("company")), "host", "duplicate_url")


def discover(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(DISCOVERED rows, DUPLICATES rows) of records (ord, file, record), which are also what is known."""
    links = record_links(records)
    return deduplicated(candidates(links, links))
