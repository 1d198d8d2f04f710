"""Lead rollup, promotion of candidates, and catalog compilation."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import enabled_flag, fold, once, strip
from tessera.functions.urls import identity, identity_text, normal_url, path, source_of, source_parts
from tessera.operators.dedupe import chained, checkpointed, first_wins, greedy, numbered_names


def _parsed(listings: DataFrame, with_language: bool = True) -> DataFrame:
    """(ord, company, raw, source, canonical, identity, label) of listings of a supported source."""
    parts = once(once(listings, "_u", normal_url(F.col("url"))), "p", source_parts(F.col("_u"))).filter("p.canonical IS NOT NULL")
    label = F.coalesce(F.when(F.col("p.source").isin("workday", "oracle_hcm"), F.col("p.site")).when(F.col("p.source") == "icims", F.col("p.host")).otherwise(F.col("p.slug")), "p.source")
    rows = parts.select("ord", strip(F.col("company")).alias("company"), F.col("url").alias("raw"), F.col("p.source").alias("source"), F.col("p.canonical").alias("canonical"), identity_text(identity(F.col("p"), with_language=with_language)).alias("identity"), label.alias("label"))
    return rows.filter("identity IS NOT NULL")


def _per_identity(rows: DataFrame) -> DataFrame:
    """One row per identity: count, first row's texts, modal company and modal URL.

    Listings are counted by (identity, company, URL) first, so each is parsed once and only counts are
    grouped again.  Ties: the company that sorts first; the longest path, then the URL that sorts first.
    """
    first = F.struct("raw", "source", "label")
    counts = rows.groupBy("identity", "company", "canonical").agg(F.count(F.lit(1)).alias("n"), F.min("ord").alias("ord"), F.min_by(first, "ord").alias("first"))
    counts = counts.withColumns({"named": F.sum("n").over(Window.partitionBy("identity", "company")), "linked": F.sum("n").over(Window.partitionBy("identity", "canonical"))})
    return counts.groupBy("identity").agg(
        F.sum("n").alias("n"),
        F.min("ord").alias("ord"),
        F.min_by("first", "ord").alias("first"),
        F.min_by("company", F.struct(-F.col("named"), fold(F.col("company")), "company")).alias("company"),
        F.min_by("canonical", F.struct(-F.col("linked"), -F.length(path(F.col("canonical"))), "canonical")).alias("url"),
    )


def roll_up(listings: DataFrame) -> DataFrame:
    """One lead per identity of (ord, company, url) rows: count, modal company and URL, first raw URL."""
    return _per_identity(_parsed(listings)).select("company", "url", F.col("first.source").alias("source"), F.col("n").cast("string").alias("job_count"), F.col("first.raw").alias("example_job_url"), "identity")


def leads_in_order(leads: DataFrame) -> DataFrame:
    return leads.orderBy(fold(F.col("company")), "source", "url")


def archived_candidates(listings: DataFrame) -> DataFrame:
    """(ord, identity, company, url, source, label): one source per identity of archived listings, first seen first."""
    return _per_identity(_parsed(listings, with_language=False)).select("ord", "identity", "company", "url", F.col("first.source").alias("source"), F.col("first.label").alias("label"))


def new_source_rows(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """(company, url, enabled): candidates whose identity and URL neither ``existing`` (company, url) nor an earlier one has.

    Companies that would share a name in one source are told apart by the candidate's label.
    """
    old = existing.select(F.col("company"), normal_url(F.col("url")).alias("url")).withColumn("p", source_parts(F.col("url")))
    old = checkpointed(old.select("company", F.col("p.source").alias("source"), F.coalesce("p.canonical", "url").alias("url"), identity_text(identity(F.col("p"), with_language=False)).alias("identity")))
    fresh = candidates.join(old.select("identity").dropna().distinct(), "identity", "left_anti").join(old.select("url").distinct(), "url", "left_anti")
    kept = greedy(checkpointed(fresh), ["identity", "url"], "ord").withColumn("_order", fold(F.col("company")))
    named = numbered_names(kept, "company", "label", "source", ["_order", "source", "url"], old.filter("source IS NOT NULL").select("company", "source"))
    return named.orderBy("_order", "source", "url").select("company", "url", F.lit("true").alias("enabled"))


def with_additions(sources: DataFrame, additions: DataFrame) -> DataFrame:
    """Catalog rows (ord, company, url, enabled) followed by new ones."""
    first = sources.withColumn("_late", F.lit(0))
    more = additions if "ord" in additions.columns else additions.orderBy("company", "url").withColumn("ord", F.monotonically_increasing_id())
    both = first.unionByName(more.withColumn("_late", F.lit(1)).withColumn("ord", F.col("ord").cast(sources.schema["ord"].dataType)))
    return both.withColumn("ord", F.struct("_late", "ord")).drop("_late")


def listing_stats(listings: DataFrame) -> DataFrame:
    """(status, n): supported, unsupported and invalid listings."""
    listings = once(once(listings, "_u", normal_url(F.col("url"))), "p", source_parts(F.col("_u")))
    p = F.col("p")
    status = F.when(p["source"].isNull(), "unsupported").when(p["canonical"].isNull(), "invalid").otherwise("supported")
    return listings.select(status.alias("status")).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def new_leads(leads: DataFrame, known: DataFrame) -> DataFrame:
    """Leads whose identity and URL are both unknown; ``known``: (url) or (url, identity)."""
    if "identity" in known.columns:
        p = known.select(normal_url(F.col("url")).alias("url"), "identity")
    else:
        p = known.select(normal_url(F.col("url")).alias("url")).withColumn("p", source_parts(F.col("url"))).select("url", identity_text(identity(F.col("p"))).alias("identity"))
    fresh = leads.withColumn("_u", normal_url(F.col("url")))
    return fresh.join(p.select("identity").dropna().distinct(), "identity", "left_anti").join(p.select(F.col("url").alias("_u")).distinct(), "_u", "left_anti").drop("_u")


def promote(leads: DataFrame, known: DataFrame) -> DataFrame:
    """New leads of which none shares an identity or a URL with an earlier accepted one (needs ``ord``)."""
    return greedy(new_leads(leads, known), ["identity", "url"], "ord")


def review(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """``candidates`` (ord, company, url) with status accepted, skipped or rejected, and the reason."""
    rows = once(once(candidates, "_u", normal_url(F.col("url"))), "p", source_parts(F.col("_u"))).drop("_u")
    rows = rows.withColumn("identity", identity_text(identity(F.col("p"))))
    rows = checkpointed(rows)  # the rounds below read the parsed rows again and again
    k = known.select(normal_url(F.col("url")).alias("_url")).withColumn("p", source_parts(F.col("_url"))).select("_url", identity_text(identity(F.col("p"))).alias("_id"))
    k = checkpointed(k)
    rows = rows.withColumn("_url", F.col("p.canonical")).join(k.select("_url").distinct().withColumn("_hit_url", F.lit(True)), "_url", "left")
    rows = rows.join(k.select(F.col("_id").alias("identity")).dropna().distinct().withColumn("_hit_id", F.lit(True)), "identity", "left")
    template = F.col("url").rlike(r"[{}]|%7[BbDd]|<[^>]*>")
    rows = rows.withColumn("reason", F.when(F.col("p.source").isNull(), "unsupported_source").when(template, "template_url").when(F.col("p.error").isNotNull(), F.col("p.error")).when(F.col("_hit_url"), "existing_url").when(F.col("_hit_id"), "existing_source_identity"))
    first = greedy(rows.filter("reason IS NULL").select("ord", "identity", "_url"), ["identity", "_url"], "ord").select("ord", F.lit(True).alias("_ok"))
    rows = rows.join(first, "ord", "left").withColumn("reason", F.coalesce("reason", F.when(F.col("_ok").isNull(), "existing_source_identity"), F.lit("")))
    status = F.when(F.col("reason") == "", "accepted").when(F.col("reason").isin("existing_url", "existing_source_identity"), "skipped").otherwise("rejected")
    return rows.select("ord", "company", F.col("p.source").alias("detected_source"), F.col("url").alias("candidate_url"), F.col("p.canonical").alias("canonical_source_url"), status.alias("status"), "reason")


def compile_catalog(rows: DataFrame, owners: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(configs, cleaned rows) of source rows (ord, company, url, enabled).

    Rows are dropped if an earlier one has their URL, or their company and source, or if ``owners``
    (company, source, url) give the URL to another company.  Blank rows, rows with a bad ``enabled``,
    unsupported and malformed ones stay in the cleaned rows but give no config.  ``change`` says what
    the config is against the owners: added, updated or current.
    """
    r = rows.select("ord", strip(F.col("company")).alias("company"), strip(F.col("url")).alias("url"), strip(F.col("enabled")).alias("enabled")).withColumn("flag", enabled_flag(F.col("enabled")))
    r = r.withColumn("norm", F.when((F.col("company") != "") & (F.col("url") != ""), normal_url(F.col("url"))))
    r = chained(r, ["norm"], ["ord"])
    good = F.col("norm").isNotNull() & F.col("flag").isNotNull()
    r = r.withColumn("source", F.when(good, source_of(F.col("norm")))).withColumn("_pair", F.when(F.col("source").isNotNull(), F.concat_ws("::", fold(F.col("company")), "source")))
    r = chained(r, ["_pair"], ["ord"]).withColumn("p", source_parts(F.col("norm")))
    own = first_wins(owners.select(normal_url(F.col("url")).alias("_u"), F.concat_ws("::", fold(strip(F.col("company"))), "source").alias("_owner")).withColumn("_one", F.lit(1)), ["_u"], ["_owner"]).drop("_one")
    r = r.withColumn("_u", F.coalesce(F.col("p.canonical"), "norm")).join(own, "_u", "left")
    r = r.filter(F.col("source").isNull() | F.col("_owner").isNull() | (F.col("_owner") == F.col("_pair")))
    # A config is current if all that the owners say of it (URL, flag, parts) is what the row gives.
    configs = r.filter("source IS NOT NULL AND p.canonical IS NOT NULL").select("_pair", "ord", "company", "source", F.col("p.canonical").alias("url"), F.col("flag").alias("enabled"), "p.tenant", "p.site", "p.slug", "p.host", "p.mode", "p.language")
    told = [c for c in ("enabled", "tenant", "site", "slug", "host", "mode", "language") if c in owners.columns]
    now = owners.select(F.concat_ws("::", fold(strip(F.col("company"))), "source").alias("_pair"), F.struct(normal_url(F.col("url")).alias("url"), *told).alias("_old")).groupBy("_pair").agg(F.min("_old").alias("_old"))
    configs = configs.join(now, "_pair", "left")
    same = F.struct(normal_url(F.col("url")).alias("url"), *told).eqNullSafe(F.col("_old"))
    change = F.when(F.col("_old").isNull(), "added").when(same, "current").otherwise("updated")
    configs = configs.withColumn("change", change).drop("_pair", "_old").orderBy(fold(F.col("company")), "source", "url")
    return configs, r.select("ord", "company", F.coalesce("p.canonical", "norm", "url").alias("url"), "enabled").orderBy("ord")
