"""Both snapshots kept by job key: a day's run moves the day's rows to them, and not them to the day's rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.dedupe import checkpointed
from tessera.operators.merge import job_key, merge_snapshots
from tessera.operators.run import Run, dedupe_jobs, enabled_companies, fetch, job_keys, observed, placed
from tessera.sources.landed import exists


class Snapshots:
    """The active and the archived snapshot as tables of ``buckets`` buckets by job key, sorted within each.

    Every run writes a new version under ``folder``, and what the version is called is written last, so a
    run that is lost leaves the former one in place.  Tables are registered in the session's catalog
    by name and version; a new session finds the files again through ``folder``.
    """

    def __init__(self, spark: SparkSession, folder: str, *, name: str = "snapshot", buckets: int | None = None) -> None:
        self.spark, self.folder, self.name = spark, folder.rstrip("/"), name
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    @property
    def version(self) -> int:
        """The last whole version; 0 before the first."""
        if not exists(self.spark, f"{self.folder}/versions/v=*"):
            return 0
        return self.spark.read.text(f"{self.folder}/versions").agg(F.max("v")).first()[0]

    def _save(self, active: DataFrame, archived: DataFrame) -> None:
        version = self.version + 1
        for kind, rows in (("active", active), ("archived", archived)):
            writer = rows.withColumn("ord", F.monotonically_increasing_id()).write.mode("overwrite").option("path", f"{self.folder}/{kind}-{version}")
            writer.bucketBy(self.buckets, "_key").sortBy("_key").saveAsTable(f"{self.name}_{kind}_{version}")
        self.spark.range(1).select(F.lit(self.name)).coalesce(1).write.mode("overwrite").text(f"{self.folder}/versions/v={version}")

    def save(self, active: DataFrame, archived: DataFrame) -> None:
        """A new version of both; ``active`` must hold no two rows of which :func:`dedupe_jobs` would drop one."""
        self._save(*(t.withColumn("_key", job_key()) for t in (active, archived)))

    def _table(self, kind: str) -> DataFrame:
        name, path = f"{self.name}_{kind}_{self.version}", f"{self.folder}/{kind}-{self.version}"
        if not self.spark.catalog.tableExists(name):
            fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.spark.read.parquet(path).schema.fields)
            self.spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet CLUSTERED BY (_key) SORTED BY (_key) INTO {self.buckets} BUCKETS LOCATION '{path}'")
        return self.spark.table(name)

    def active(self) -> DataFrame:
        """Rows with their ``_key``."""
        return self._table("active")

    def archived(self) -> DataFrame:
        return self._table("archived")

    def run(self, configs: DataFrame, landed: DataFrame, as_of: str, *, sources: set[str] | None = None, strict_touch: bool = False) -> Run:
        """As :func:`tessera.operators.run.daily_run` over the last version, whose result becomes the next.

        Carried rows do not conflict among themselves, nor do the day's after their own dedupe; so of the day's
        rows those go that share a key with a carried one, and the carried rows' keys are looked up where they are.
        """
        fetched = fetch(enabled_companies(configs, sources), landed, as_of)
        fresh = checkpointed(dedupe_jobs(checkpointed(fetched.records)))
        live, shelf = merge_snapshots(placed(self.active()), fresh, placed(self.archived()), fetched.touched(strict_touch), as_of, keyed=True)
        carried, new = live.filter("_from = 0"), checkpointed(live.filter("_from = 1"))
        for key in ("_id", "_loose"):
            mine = job_keys(new)
            hit = job_keys(carried).select(key).filter(f"{key} <> ''").join(mine.select(key).distinct(), key, "left_semi").distinct()
            new = checkpointed(mine.join(hit, key, "left_anti").drop("_id", "_loose"))
        live, lived = observed(carried.unionByName(new).drop("_from"), "active")
        shelf, shelved = observed(shelf, "archived")
        self._save(live, shelf)
        return Run(self.active().drop("ord", "_key"), self.archived().drop("ord", "_key"), fetched.report(live=lived, shelf=shelved))
