"""Detection of platforms behind companies' career pages, over pages that were landed before."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import platforms as p
from tessera.functions.text import fold
from tessera.functions.urls import page_url
from tessera.operators.dedupe import checkpointed, first_wins
from tessera.operators.pages import anchors, evidence, platform_links, ranked_links, source_candidates, url_evidence
from tessera.sources.fetching import Fetcher, fetched
from tessera.sources.landed import exists
from tessera.sources.markup import read_links

CANDIDATES = ("company", "original_url", "detected_source", "source_key", "canonical_source_url", "evidence_count", "best_evidence_url", "confidence", "route_ready", "route_block_reason", "recommended_action", "discovered_from", "notes")


def settled_candidates(candidates: DataFrame) -> DataFrame:
    """Candidates with the last word on two platforms' routes, and what to do with them."""
    source, url, key = F.col("detected_source"), F.col("best_evidence_url"), F.col("source_key")
    low = F.lower(url)
    feed = F.endswith(low, F.lit("/json"))
    api = F.startswith(url, F.lit("https://")) & F.contains(low, F.lit("/api/")) & p.has_any(low, ("jobsearch", "search-jobs", "/jobs"))
    secure = F.startswith(low, F.lit("https://"))
    # The texts and the form of a feed's address.
    ready = F.when(source == "breezyhr", feed & secure).when(source == "phenom", api).otherwise(F.col("route_ready"))
    reason = (
        F.when((source == "breezyhr") & feed, F.when(secure, "").otherwise("BreezyHR JSON endpoint is not HTTPS"))
        .when(source == "breezyhr", "A public BreezyHR /json endpoint was not directly observed")
        .when(source == "phenom", F.when(api, "").otherwise("No clear public Phenom job-search API endpoint was identified"))
        .otherwise(F.col("route_block_reason"))
    )
    canonical = F.when((source == "breezyhr") & feed, url).when(source == "breezyhr", F.when(key != "", F.concat(F.lit("https://"), key, F.lit(".breezy.hr/json"))).otherwise(url)).otherwise(F.col("canonical_ats_url"))
    rows = candidates.withColumns({"canonical_source_url": canonical, "route_block_reason": reason, "route_ready": ready}).drop("canonical_ats_url")
    return rows.withColumn("recommended_action", p.action(source, F.col("route_ready")))


#: Given (fetch_url), the pages (fetch_url, final_url, html, error) that were had.
Pages = Callable[[DataFrame], DataFrame]


def landed_pages(landed: DataFrame) -> Pages:
    """Pages (fetch_url, final_url, html and, if it is there, error) that were landed before; of several one, without an error if there is one."""
    error = F.col("error") if "error" in landed.columns else F.lit(None).cast("string")
    rows = landed.select(page_url(F.col("fetch_url")).alias("fetch_url"), "final_url", "html", error.alias("error"))
    body = F.struct("final_url", "html", "error")
    one = rows.groupBy("fetch_url").agg(F.min_by(body, F.struct(F.col("error").isNotNull(), "final_url", F.xxhash64("html"), "error")).alias("b")).select("fetch_url", "b.*")
    return lambda asked: one.join(asked.distinct(), "fetch_url", "left_semi")


def fetched_pages(fetcher: Fetcher, *, timeout: float = 30.0, tries: int = 1, workers: int = 8) -> Pages:
    """Pages that ``fetcher`` is asked for, each URL once; answers are written, so they are asked for once."""

    def get(asked: DataFrame) -> DataFrame:
        answers = fetched(asked.distinct().repartition("fetch_url"), fetcher, url="fetch_url", timeout=timeout, tries=tries, workers=workers)
        return checkpointed(answers.select("fetch_url", "final_url", F.col("body").alias("html"), "error"))

    return get


def detect(companies: DataFrame, pages: DataFrame | Pages, *, max_pages: int = 2) -> DataFrame:
    """CANDIDATES rows of companies (ord, company, url, discovered_from) over pages, landed or from a fetcher.

    A company's own page and up to ``max_pages`` - 1 pages of its host that it links to are read; the
    final URLs, links to platforms and everything in the pages are evidence.  A company whose page
    could not be had gives one row that says so, with the error if there is one.  Of equal (company, source,
    key) the first stays.
    """
    get = landed_pages(pages) if isinstance(pages, DataFrame) else pages
    who = ["company", "original_url"]
    named = companies.select("ord", "company", page_url(F.col("url")).alias("original_url"), F.coalesce("discovered_from", F.lit("")).alias("discovered_from"))
    had = get(named.select(F.col("original_url").alias("fetch_url")))
    pages = had.filter("error IS NULL").drop("error")
    asked = named.select(*who).distinct()
    first = asked.join(pages, F.col("original_url") == F.col("fetch_url")).select(*who, F.col("final_url").alias("url"), "html")
    # Each page is tokenised once: what follows reads its links several times.
    links = checkpointed(read_links(first))
    ends = first.select(*who, F.col("original_url").alias("page"), "url", F.lit(0).alias("nth"))
    outward, read = anchors(links).withColumn("nth", F.lit(1)), links.withColumn("hop", F.lit(4))
    if max_pages > 1:
        best = ranked_links(anchors(links).withColumnRenamed("original_url", "career_url"), max_pages - 1).filter(F.col("fetch_url") != page_url(F.col("page")))
        best = checkpointed(best)
        linked = get(best.select("fetch_url")).filter("error IS NULL").drop("error")
        more = checkpointed(best.join(linked, "fetch_url").select("company", F.col("career_url").alias("original_url"), F.col("original_url").alias("linked"), F.col("final_url").alias("url"), "html"))
        second = checkpointed(read_links(more.select(*who, "url", "html")))
        ends = ends.unionByName(more.select(*who, F.col("linked").alias("page"), "url", F.lit(2).alias("nth")))
        outward = outward.unionByName(anchors(second).withColumn("nth", F.lit(3)))
        read = read.unionByName(second.withColumn("hop", F.lit(5)))
    leads = ends.unionByName(platform_links(outward))
    method = F.when(F.col("nth") % 2 == 0, "final_url").otherwise("discovered_external_link")
    rows = url_evidence(leads, method).unionByName(evidence(read).withColumnRenamed("hop", "nth"))
    candidates = named.join(settled_candidates(source_candidates(rows)), who).select("ord", *CANDIDATES)
    unread = named.join(had.select(F.col("fetch_url").alias("original_url"), F.lit(True).alias("had"), "error"), "original_url", "left").filter("had IS NULL OR error IS NOT NULL")
    blank = {c: F.lit("") for c in CANDIDATES} | {"company": F.col("company"), "original_url": F.col("original_url"), "discovered_from": F.col("discovered_from"), "evidence_count": F.lit(0).cast("long"), "route_ready": F.lit(False), "route_block_reason": F.coalesce("error", F.lit("page was not landed")), "recommended_action": F.lit("manual_review"), "notes": F.lit("Career page fetch or passive detection failed")}
    failed = unread.select("ord", *(blank[c].alias(c) for c in CANDIDATES))
    every = candidates.unionByName(failed).withColumn("_company", fold(F.col("company")))
    return first_wins(every, ["_company", "detected_source", "source_key"], ["ord", "original_url"]).drop("_company", "ord").select(*CANDIDATES)


def detect_in_parts(companies: DataFrame, pages: DataFrame | Pages, folder: str, *, every: int, max_pages: int = 2, progress: Callable[[int, int], None] | None = None) -> int:
    """Detect so many companies at a time and write each part's candidates as CSV under ``folder`` when it is done.

    A company belongs to one part for good, by its name.  Parts that are there whole are passed over, so
    a run that was stopped goes on where it was; how many parts there are is written first and kept.
    ``progress`` is told (parts done, parts).  Returns the number of parts detected by this call.
    """
    spark = companies.sparkSession
    plan = f"{folder}/_parts"
    if not exists(spark, f"{plan}/_SUCCESS"):
        names = companies.select(fold(F.col("company"))).distinct().count()
        spark.range(1).select(F.lit(str(max(1, -(-names // max(1, every)))))).coalesce(1).write.mode("overwrite").text(plan)
    parts = int(spark.read.text(plan).first()[0])
    dealt = companies.withColumn("_part", F.pmod(F.xxhash64(fold(F.col("company"))), F.lit(parts)))
    done = 0
    for k in range(parts):
        if not exists(spark, f"{folder}/part-{k}/_SUCCESS"):
            rows = detect(dealt.filter(F.col("_part") == k).drop("_part"), pages, max_pages=max_pages)
            in_order(rows).write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{folder}/part-{k}")
            done += 1
        if progress:
            progress(k + 1, parts)
    return done


def in_order(candidates: DataFrame) -> DataFrame:
    return candidates.orderBy(fold(F.col("company")), "detected_source", "source_key", "original_url")


def shape_checked(candidates: DataFrame, payloads: DataFrame, *, enabled: bool = False) -> DataFrame:
    """(company, detected_source, source_key, canonical_source_url, validation_status, validation_error).

    ``payloads``: (canonical_source_url, payload).  Off by default; two platforms' payloads are checked.
    """
    rows = candidates.join(payloads, "canonical_source_url", "left")
    kind: Column = F.expr("schema_of_variant(try_parse_json(payload))")
    listed = F.when(F.col("detected_source") == "lever", F.startswith(kind, F.lit("ARRAY"))).otherwise(F.startswith(kind, F.lit("OBJECT")) & F.expr("try_variant_get(try_parse_json(payload), '$.jobs', 'array<variant>')").isNotNull())
    run = F.lit(enabled) & F.col("route_ready") & F.col("detected_source").isin("greenhouse", "lever")
    status = F.when(~run, "not_run").when(F.col("payload").isNull(), "error").when(F.coalesce(listed, F.lit(False)), "valid").otherwise("invalid_shape")
    error = F.when(status == "invalid_shape", "Response did not match the expected jobs/postings shape").when(status == "error", "no payload was landed").otherwise("")
    return rows.select("company", "detected_source", "source_key", "canonical_source_url", status.alias("validation_status"), error.alias("validation_error"))
