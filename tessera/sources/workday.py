"""Workday's search plan, endpoints, listings and detail locations, over landed payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.locations import distinct_text
from tessera.functions.text import job_type, let, search_term, strip
from tessera.functions.urls import netloc, scheme, segments
from tessera.operators.dedupe import first_wins
from tessera.sources.connectors import SCHEMAS, raw_key, with_details

# Search terms that mean the same.
EQUIVALENT = (("intern", "internship"), ("co-op", "coop", "co op"), ("student", "summer student"), ("new grad", "new graduate"))
_DETAIL_KEYS = ("locations", "location", "primaryLocation", "primaryLocationDescriptor", "locationsText", "additionalLocations")
_TEXT_KEYS = ("displayName", "descriptor", "location", "primaryLocation", "primaryLocationDescriptor", "locationsText")
_OBJECT_KEYS = (*_TEXT_KEYS, "city", "region", "state", "province", "country", "countryName", "countryDescriptor")


def _plain(term: str) -> str:
    return " ".join(term.strip().lower().replace("-", " ").split())


def term_plan(terms: list) -> list[tuple[str, list[str]]]:
    """(primary, alternates) of search terms, in order: of equivalent terms the first is searched for,
    the others only where its results don't cover them."""
    groups = {_plain(t): i for i, group in enumerate(EQUIVALENT) for t in group}
    plan: list[tuple[str, list[str]]] = []
    place: dict[int | str, int] = {}
    for term in (str(t).strip() for t in terms):
        if not term:
            continue
        key = groups.get(_plain(term), _plain(term))
        if key not in place:
            place[key] = len(plan)
            plan.append((term, []))
        elif isinstance(key, int) and term not in plan[place[key]][1]:
            plan[place[key]][1].append(term)
    return plan


def config_int(value: Column, default: int, least: int = 1, most: int | None = None) -> Column:
    """A whole number of a config within bounds; ``default`` where it is missing or none."""
    bounded = F.greatest(F.coalesce(F.try_element_at(F.array(value.cast("string").try_cast("int")), F.lit(1)), F.lit(default)), F.lit(least))
    return F.least(bounded, F.lit(most)) if most is not None else bounded


def site_of(url: Column) -> Column:
    """The board's name in a URL's path: the last segment before a posting."""
    low = F.transform(segments(url), F.lower)
    cut = F.array_min(F.filter(F.transform(low, lambda s, i: F.when(s.isin("job", "details"), i)), lambda i: i.isNotNull()))
    return F.coalesce(F.try_element_at(F.slice(segments(url), F.lit(1), F.coalesce(cut, F.size(low))), F.lit(-1)), F.lit(""))


def _endpoint(url: Column, tenant: Column, site: Column) -> Column:
    who = F.coalesce(F.nullif(strip(tenant), F.lit("")), F.nullif(F.substring_index(netloc(url), ".", 1), F.lit("")))
    board = F.coalesce(F.nullif(strip(site), F.lit("")), F.nullif(site_of(url), F.lit("")))
    return F.when(strip(url) != "", F.concat(scheme(url), F.lit("://"), netloc(url), F.lit("/wday/cxs/"), who, F.lit("/"), board, F.lit("/")))


def jobs_url(url: Column, tenant: Column, site: Column) -> Column:
    """The listing's endpoint; null where tenant or site can't be told."""
    return F.concat(_endpoint(url, tenant, site), F.lit("jobs"))


def detail_url(url: Column, tenant: Column, site: Column, external_path: Column) -> Column:
    return F.concat(_endpoint(url, tenant, site), F.nullif(F.regexp_replace(strip(external_path), "^/+", ""), F.lit("")))


def listings(landed: DataFrame, *, most_total: int = 400, limit: int = 20, most_pages: int = 25) -> DataFrame:
    """Landed pages (company, term, page, payload, ...) of queries that went through.

    A query is a company's pages of one term; ``term`` '' is the full listing.  A page that is missing
    or no JSON fails its query, and so does a full listing of more than ``most_total`` postings.  Page k
    begins at posting k * ``limit``: a query whose pages have a hole, or whose last page is full although
    neither ``total`` nor ``most_pages`` ends there, is not complete and fails too.
    """
    rows = landed.withColumn("x", F.from_json("payload", SCHEMAS["workday"])).withColumn("_total", F.get_json_object("payload", "$.total").try_cast("int"))
    bad = F.col("x").isNull() | F.col("x.jobPostings").isNull() | ((F.col("term") == "") & (F.coalesce("_total", F.lit(0)) > most_total))
    size = F.coalesce(F.size("x.jobPostings"), F.lit(0))
    queries = rows.select("company", "term", "page", bad.alias("bad"), size.alias("size"), "_total").groupBy("company", "term").agg(
        F.max("bad").alias("bad"), F.sum("size").alias("n"), F.countDistinct("page").alias("pages"), F.min("page").alias("first"), F.max("page").alias("last"), F.max_by("size", "page").alias("rest"), F.max("_total").alias("total")
    )
    hole = (F.col("first") != 0) | (F.col("pages") != F.col("last") + 1)
    ends = (F.col("rest") != limit) | (F.col("pages") >= most_pages) | F.coalesce(F.col("total") <= F.col("pages") * limit, F.lit(False))
    failed = queries.filter(F.col("bad") | hole | ~ends | ((F.col("term") == "") & (F.col("n") == 0)))
    return landed.join(failed.select("company", "term"), ["company", "term"], "left_anti")


def covered(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """Terms (company, term) that no title of the company's ``rows`` (company, title) holds."""
    titles = rows.select(F.col("company").alias("_company"), search_term(F.col("title")).alias("_title")).distinct()
    named = terms.withColumn("_term", search_term(F.col("term")))
    return named.join(titles, (F.col("company") == F.col("_company")) & F.contains(F.col("_title"), F.col("_term")), "left_anti").drop("_term")


def postings(spark: SparkSession, landed: DataFrame, terms: list[str], details: DataFrame | None = None, *, most_details: int = 50) -> DataFrame:
    """Raw rows (company, career_url, term, ord, pos, raw, key) that a company's plan reads, each once.

    The full listing where it went through; else the primary terms in order, and alternates whose
    term no title found so far holds.  Only postings of a kind stay.  With ``details`` (company, path,
    payload) rows also have ``detail_locations``, looked up for those whose own location is vague.
    """
    plan = term_plan(terms)
    order = [primary for primary, _ in plan] + [a for _, alternates in plan for a in alternates]
    primary = [x for x, _ in plan]
    numbers = spark.createDataFrame([("", -1), *((t, i) for i, t in enumerate(order))], "term string, nth int")
    good = listings(landed).join(F.broadcast(numbers), "term")
    rows = good.select("company", "career_url", "term", "nth", "ord", F.posexplode(F.from_json("payload", SCHEMAS["workday"])["jobPostings"]).alias("pos", "raw")).filter("raw IS NOT NULL")
    full = rows.filter("term = ''").select("company").distinct()
    searched = rows.filter("term <> ''").join(full, "company", "left_anti")
    first = searched.filter(F.col("term").isin(*primary))
    others = searched.filter(~F.col("term").isin(*primary))
    open_ = covered(first.select("company", F.col("raw.title").alias("title")), others.select("company", "term").distinct())
    kept = rows.filter("term = ''").unionByName(first).unionByName(others.join(open_, ["company", "term"], "left_semi"))
    kept = first_wins(kept.withColumn("key", raw_key(F.col("raw"))), ["company", "key"], ["nth", "ord", "pos"])
    kept = kept.filter(job_type(F.col("raw.title")).isNotNull()).select("company", "career_url", "term", "nth", "ord", "pos", "raw", "key")
    if details is not None:
        found = details.select("company", "path", detail_locations(F.col("payload")).alias("detail_locations"))
        kept = with_details(kept, found, order=["nth", "ord", "pos"], most=most_details)
    return kept.drop("nth")


def _texts_of(value: Column) -> Column:
    """Texts of a JSON value: a string as it is, an object's named texts and its city, region and country."""

    def named(x: Column) -> Column:
        region, country = F.coalesce(x["region"], x["state"], x["province"]), F.coalesce(x["country"], x["countryName"], x["countryDescriptor"])
        place = F.when(x["city"].isNotNull(), F.concat_ws(", ", x["city"], region, country))
        return F.filter(F.array(*(x[k] for k in _TEXT_KEYS), place), lambda t: t.isNotNull())

    plain = lambda c: F.nullif(strip(F.when(~F.coalesce(c.rlike(r"^[\[{]"), F.lit(False)), c)), F.lit(""))
    # The object is parsed once.
    parsed = F.from_json(value, ", ".join(f"{k} string" for k in _OBJECT_KEYS))
    told = let(parsed, lambda x: let(F.struct(*(plain(x[k]).alias(k) for k in _OBJECT_KEYS)), named))
    return F.when(F.startswith(value, F.lit("{")), told).when(strip(value) != "", F.array(strip(value))).otherwise(F.array().cast("array<string>"))


def _found(text: Column) -> Column:
    items = F.when(F.startswith(text, F.lit("[")), F.from_json(text, "array<string>")).otherwise(F.array(text))
    return F.flatten(F.transform(F.filter(items, lambda v: v.isNotNull()), _texts_of))


def detail_locations(payload: Column) -> Column:
    """Location texts of a posting's detail payload, without later ones that differ in case only.

    The posting's own fields; where they say nothing, the requisition's and the organisation's.
    """
    empty = F.array().cast("array<string>")
    # The payload is parsed once; what a field holds stays JSON text.
    parsed = F.from_json(payload, "jobPostingInfo struct<" + ", ".join(f"{k}: string" for k in (*_DETAIL_KEYS, "jobRequisitionLocation")) + ">, hiringOrganization string")
    texts = lambda c: F.coalesce(_found(c), empty)

    def first(x: Column) -> Column:
        info = x["jobPostingInfo"]
        own = F.concat(*(texts(info[k]) for k in _DETAIL_KEYS))
        return let(own, lambda o: F.when(F.size(o) > 0, o).otherwise(F.concat(texts(info["jobRequisitionLocation"]), texts(x["hiringOrganization"]))))

    return let(let(parsed, first), distinct_text)
