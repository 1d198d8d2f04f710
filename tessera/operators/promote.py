"""Review of detected candidates: each candidate's URLs are tried in turn, and the first good one counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions import platforms as p
from tessera.functions.text import enabled_flag, once, strip
from tessera.functions.urls import identity, identity_text, normal_url, source_parts
from tessera.operators.dedupe import checkpointed, greedy

# Sources whose canonical URL is tried before the evidence.
CANONICAL_FIRST = ("greenhouse", "lever", "ashby", "smartrecruiters")


def validated(candidates: DataFrame) -> DataFrame:
    """``candidates`` (ord, company, detected_source, source_key, best_evidence_url, canonical_source_url, route_ready)
    with candidate_url, config (source_parts of the URL) and reason, '' where a URL is good.

    A candidate's two URLs are tried in the order its source wants; reasons are joined, each once.
    """
    rows = candidates.withColumn("_source", F.lower(strip(F.col("detected_source"))))
    given = F.when(F.col("_source").isin(*CANONICAL_FIRST), F.array("canonical_source_url", "best_evidence_url")).otherwise(F.array("best_evidence_url", "canonical_source_url"))
    urls = F.array_distinct(F.filter(F.transform(given, normal_url), lambda u: u != ""))
    rows = once(rows, "_urls", urls)
    block = (
        F.when((strip(F.col("company")) == "") | ~F.col("_source").isin(*p.ROUTED), "not_a_supported_production_source")
        .when(~F.coalesce(enabled_flag(F.col("route_ready").cast("string")), F.lit(False)), "candidate_is_not_route_ready")
        .when(F.size("_urls") == 0, "no_candidate_url")
    )
    rows = rows.withColumn("_block", block)
    tried = rows.filter("_block IS NULL").select("ord", "_source", "source_key", F.posexplode("_urls").alias("_nth", "_given"))
    tried, x = p.with_parts(tried, "_given")
    source = F.col("_source")
    tried = once(tried, "_url", F.when(source == "workday", p.workday_board(F.col("source_key"), x)).otherwise(F.col("_given")))
    tried = once(tried, "config", source_parts(F.col("_url")))
    error = (
        F.when(F.col("_url") == "", "invalid_workday_site_url")
        .when(~p.is_public(source, x), F.concat(F.lit("non_public_"), source, F.lit("_url")))
        .when(p.has_template(F.col("_url")), "templated_url")
        .when(F.col("config.source").isNull(), "unsupported_url_shape")
        .when(F.col("config.error").isNotNull(), F.col("config.error"))
        .when(F.col("config.source") != source, F.concat(F.lit("source_mismatch:"), F.col("config.source")))
        .otherwise("")
    )
    tried = tried.withColumn("_error", error).select("ord", "_nth", "_url", "config", "_error")
    good = F.when(F.col("_error") == "", F.struct("_nth", "_url", "config"))
    judged = tried.groupBy("ord").agg(F.min_by(good, F.when(F.col("_error") == "", F.col("_nth"))).alias("good"), F.array_sort(F.collect_list(F.struct("_nth", "_error"))).alias("errors"))
    reasons = F.array_join(F.array_distinct(F.transform("errors", lambda e: e["_error"])), "; ")
    rows = rows.join(judged, "ord", "left")
    return rows.withColumns({"candidate_url": F.coalesce("good._url", F.lit("")), "config": F.col("good.config"), "reason": F.coalesce("_block", F.when(F.col("good").isNull(), reasons), F.lit(""))}).drop("_source", "_urls", "_block", "good", "errors")


def promotion(candidates: DataFrame, existing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(additions (ord, company, url, enabled), review) of :func:`validated` candidates against ``existing`` (company, url).

    Review: (ord, company, detected_source, candidate_url, canonical_source_url, status, reason), a row
    per candidate; of good ones that share a URL or an identity the first is accepted.
    """
    rows = checkpointed(validated(candidates).withColumns({"canonical": normal_url(F.col("config.canonical")), "identity": identity_text(identity(F.col("config"), with_language=False))}))
    known = once(existing.filter((strip(F.col("company")) != "") & (strip(F.col("url")) != "")).select(normal_url(F.col("url")).alias("canonical")), "_p", source_parts(F.col("canonical")))
    known = checkpointed(known.select("canonical", identity_text(identity(F.col("_p"), with_language=False)).alias("identity")))
    rows = rows.join(known.select("canonical").distinct().withColumn("_url_known", F.lit(True)), "canonical", "left")
    rows = rows.join(known.select("identity").dropna().distinct().withColumn("_id_known", F.lit(True)), "identity", "left")
    reason = F.when(F.col("reason") != "", F.col("reason")).when(F.col("_url_known"), "existing_url").when(F.col("_id_known"), "existing_source_identity").otherwise("")
    rows = checkpointed(rows.withColumn("reason", reason))
    open_ = rows.filter("reason = ''").select("ord", "canonical", "identity")
    kept = checkpointed(greedy(open_, ["canonical", "identity"], "ord").select("ord", "canonical"))
    first_url = kept.select("canonical", F.lit(True).alias("_same_url"))
    rows = rows.join(kept.select("ord", F.lit(True).alias("_ok")), "ord", "left").join(first_url, "canonical", "left")
    late = F.when((F.col("reason") == "") & F.col("_ok").isNull(), F.when(F.col("_same_url"), "existing_url").otherwise("existing_source_identity"))
    rows = rows.withColumn("reason", F.coalesce(late, "reason"))
    status = F.when(F.col("reason") == "", "accepted").when(F.col("reason").isin("existing_url", "existing_source_identity"), "skipped").otherwise("rejected")
    review = rows.select("ord", "company", "detected_source", "candidate_url", F.coalesce("canonical", F.lit("")).alias("canonical_source_url"), status.alias("status"), "reason")
    return review.filter("status = 'accepted'").select("ord", "company", F.col("canonical_source_url").alias("url"), F.lit("true").alias("enabled")), review
