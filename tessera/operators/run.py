"""A whole run: enabled companies, their records over all sources, dedupe, merge, and the counts."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import clean, strip
from tessera.operators.dedupe import checkpointed, greedy
from tessera.operators.merge import merge_snapshots
from tessera.sources import connectors


def parse_sources(given: list[str] | None) -> set[str] | None:
    """Names in repeated and comma-separated arguments, in lower case; None for no restriction."""
    names = {part.strip().lower() for item in given or [] for part in str(item).split(",")} - {""}
    return names or None


def enabled_companies(configs: DataFrame, sources: set[str] | None = None) -> DataFrame:
    """Configs whose ``enabled`` is true, of the given sources."""
    rows = configs.filter(F.col("enabled").eqNullSafe(F.lit(True))).withColumn("source", F.lower(strip(F.col("source"))))
    return rows.filter(F.col("source").isin(*sorted(sources))) if sources else rows


def with_search_workers(configs: DataFrame, workers: int | None) -> DataFrame:
    """``max_concurrent_searches`` of one source set to ``workers``; nothing changes for None."""
    if workers is None:
        return configs
    old = F.col("max_concurrent_searches") if "max_concurrent_searches" in configs.columns else F.lit(None).cast("int")
    return configs.withColumn("max_concurrent_searches", F.when(F.col("source") == "workday", F.lit(workers)).otherwise(old))


def job_keys(rows: DataFrame) -> DataFrame:
    """``rows`` with what two records must not share: ``_id``, and company, title and location as ``_loose``."""
    key = lambda c: F.lower(clean(F.col(c)))
    return rows.withColumns({"_id": key("id"), "_loose": F.concat_ws("::", key("company"), key("title"), key("location"))})


def dedupe_jobs(rows: DataFrame, order: str = "ord") -> DataFrame:
    """Records of which no earlier kept one has the id, or the company, title and location."""
    return greedy(job_keys(rows), ["_id", "_loose"], order).drop("_id", "_loose")


@dataclass
class Run:
    active: DataFrame
    archived: DataFrame
    #: (name, n): companies, raw and normalised rows, active rows by kind, archived rows, errors
    counts: DataFrame


def empty_snapshot(spark: SparkSession) -> DataFrame:
    """The snapshot before the first run."""
    kinds = {"active": "boolean"}
    return spark.createDataFrame([], "ord bigint, " + ", ".join(f"{c} {kinds.get(c, 'string')}" for c in connectors.RECORD))


#: The order of a run's rows: carried ones first, then by config, payload and place in it.
_ORDER = "struct<late:int,ord:struct<_place:bigint,ord:bigint>,pos:int,source:string>"


def placed(snapshot: DataFrame) -> DataFrame:
    """Rows of a snapshot before all that are fetched."""
    own = F.struct(F.lit(0).cast("long").alias("_place"), F.col("ord").cast("long").alias("ord"))
    return snapshot.withColumn("ord", F.struct(F.lit(0).alias("late"), own.alias("ord"), F.lit(0).alias("pos"), F.lit("").alias("source")))


@dataclass
class Fetched:
    #: Records with ``ord``; the (source, company) asked for and whether that ``failed``; what was counted on the way.
    records: DataFrame
    companies: DataFrame
    counts: dict[str, int]

    def touched(self, strict: bool) -> DataFrame:
        """(source, company) looked at: all that were asked for, or only those that answered."""
        return (self.companies.filter("NOT failed") if strict else self.companies).select("source", "company")

    def report(self, **observed: Observation) -> DataFrame:
        """(name, n) of the run, given what was counted while its tables were written."""
        counts = self.counts | {k: v for x in observed.values() for k, v in x.get.items()}
        return self.companies.sparkSession.createDataFrame([(k, int(n)) for k, n in counts.items()], "name string, n bigint")


def observed(rows: DataFrame, kind: str) -> tuple[DataFrame, Observation]:
    """A snapshot that counts itself while it is written."""
    seen = Observation()
    kinds = [F.count_if(F.col("type") == k).alias(name) for name, k in (("internships", "internship"), ("new_grads", "new_grad"))]
    return rows.observe(seen, F.count(F.lit(1)).alias(kind), *(kinds if kind == "active" else [])), seen


def fetch(configs: DataFrame, landed: DataFrame, as_of: str) -> Fetched:
    """The enabled configs' landed payloads as records, all sources.

    ``landed``: (source, company, payload, ord, ok), ``ord`` unique; a company's payloads follow its
    place among the configs.  A company whose source has no registered connector is passed over.
    """
    handled = configs.filter(F.col("source").isin(*connectors.REGISTRY))
    mine = landed.join(handled.select("source", "company", F.col("url").alias("career_url"), F.col("ord").alias("_place")), ["source", "company"])
    parts, raws = [], []
    present = {r["source"] for r in handled.select("source").distinct().collect()}  # at most one row per connector
    for source in sorted(present) or list(connectors.REGISTRY)[:1]:
        handler = connectors.REGISTRY[source]
        payloads = mine.filter(F.col("source") == source).withColumn("ord", F.struct("_place", "ord")).select("company", "career_url", "payload", "ord")
        raws.append(Observation())
        # Payloads are parsed once: what comes out is counted while it is written.
        rows = checkpointed(handler.envelope(payloads).observe(raws[-1], F.count(F.lit(1)).alias("n")))
        parts.append((handler.normalise_stored or handler.normalise)(rows, as_of))
    order = F.struct(F.lit(1).alias("late"), F.col("at.ord").alias("ord"), F.col("at.pos").alias("pos"), "source").cast(_ORDER)
    records = reduce(DataFrame.unionByName, parts).withColumn("ord", order).drop("at")
    failed = landed.filter(~F.coalesce("ok", F.lit(True))).select("source", "company").distinct().withColumn("failed", F.lit(True))
    companies = handled.select("source", "company").join(failed, ["source", "company"], "left").select("source", "company", F.coalesce("failed", F.lit(False)).alias("failed"))
    ran = Observation()
    companies = checkpointed(companies.observe(ran, F.count(F.lit(1)).alias("companies"), F.count_if("failed").alias("errors")))
    return Fetched(records, companies, {"companies": ran.get["companies"], "raw_rows": sum(x.get["n"] for x in raws), "errors": ran.get["errors"]})


def daily_run(configs: DataFrame, landed: DataFrame, active: DataFrame, archived: DataFrame, as_of: str, *, sources: set[str] | None = None, strict_touch: bool = False) -> Run:
    """Fetch, dedupe, merge into both snapshots and dedupe the active one again.

    A company whose fetch failed counts as touched, as an empty answer would, unless
    ``strict_touch``.  Carried rows come before fetched ones, so they win over them.  What the run reports
    is counted while its tables are written.  :mod:`tessera.operators.snapshots` does the same over
    snapshots that are kept by job key.
    """
    fetched = fetch(enabled_companies(configs, sources), landed, as_of)
    fresh = checkpointed(dedupe_jobs(checkpointed(fetched.records)))
    live, shelf = merge_snapshots(placed(active), fresh, placed(archived), fetched.touched(strict_touch), as_of)
    live, lived = observed(dedupe_jobs(checkpointed(live.drop("_from"))), "active")
    shelf, shelved = observed(shelf, "archived")
    live, shelf = checkpointed(live), checkpointed(shelf)
    return Run(live.drop("ord"), shelf.drop("ord"), fetched.report(live=lived, shelf=shelved))
