"""Merge of a run into the active and the archived snapshot."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.dedupe import last_wins


def job_key(prefix: str = "") -> Column:
    """The id, or company, title, location and URL in lower case where it is blank."""
    c = lambda n: F.trim(F.coalesce(F.col(prefix + n), F.lit("")))
    return F.when(c("id") != "", F.concat(F.lit("id::"), c("id"))).otherwise(F.lower(F.concat_ws("::", c("company"), c("title"), c("location"), c("url"))))


def target_key() -> Column:
    return F.lower(F.concat_ws("::", F.trim("source"), F.trim("company")))


def merge_snapshots(active: DataFrame, fetched: DataFrame, archived: DataFrame, touched: DataFrame, as_of: str, *, keyed: bool = False) -> tuple[DataFrame, DataFrame]:
    """(active, archived) after a run.

    ``fetched`` are the run's rows, ``touched`` the (source, company) it looked at.  A fetched row
    keeps the date it was first added, from the active or the archived snapshot.  Active rows of
    targets that weren't touched stay; those of touched targets that weren't fetched are archived as
    of ``as_of``.  Archived rows that were fetched again leave the archive.  All tables have the record
    columns and ``ord``; archived ones also ``date_archived``.

    With ``keyed`` both snapshots have their :func:`job_key` as ``_key``, by which they are stored, and the results
    keep it; the archive is then joined and not grouped again, so neither snapshot leaves its buckets.
    """
    blank = lambda c: F.nullif(F.trim(F.col(c).cast("string")), F.lit(""))
    old, new, gone = (t if "_key" in t.columns else t.withColumn("_key", job_key()) for t in (active, fetched, archived))
    targets = touched.select(target_key().alias("_target")).distinct()
    new, gone = last_wins(new, ["_key"], ["ord"]), last_wins(gone, ["_key"], ["ord"])
    was = last_wins(old.select("_key", "ord", blank("date_added").alias("_was")), ["_key"], ["ord"]).drop("ord")
    had = gone.select("_key", blank("date_added").alias("_had"))
    kept_date = F.coalesce("_was", "_had", F.col("date_added").cast("string"))
    fresh = new.join(was, "_key", "left").join(had, "_key", "left").withColumn("date_added", kept_date).withColumn("active", F.lit(True)).drop("_was", "_had")
    placed = old.withColumn("_target", target_key())
    carried = placed.join(targets, "_target", "left_anti").withColumn("active", F.lit(True)).drop("_target")
    ids = new.select("_key")
    vanished = placed.join(targets, "_target", "left_semi").drop("_target").join(ids, "_key", "left_anti").withColumn("active", F.lit(False)).withColumn("date_archived", F.lit(as_of))
    stay = gone.join(ids, "_key", "left_anti").withColumn("active", F.lit(False))
    live = carried.withColumn("_from", F.lit(0)).unionByName(fresh.withColumn("_from", F.lit(1)))
    if keyed:
        later = last_wins(vanished, ["_key"], ["ord"])
        names = [c for c in stay.columns if c not in ("_key", "ord")]
        now = later.select("_key", F.col("ord").alias("_ord"), F.struct(*(F.col(c) if c in later.columns else F.lit(None).alias(c) for c in names)).alias("_now"))
        picked = [F.when(F.col("_now").isNotNull(), F.col("_now")[c]).otherwise(F.col(c)).alias(c) for c in names]
        return live, stay.join(now, "_key", "full").select("_key", F.coalesce("ord", "_ord").alias("ord"), *picked)
    both = stay.withColumn("_from", F.lit(0)).unionByName(vanished.withColumn("_from", F.lit(1)), allowMissingColumns=True)
    shelf = last_wins(both, ["_key"], ["_from", "ord"]).drop("_from", "_key")
    return live.drop("_key"), shelf
