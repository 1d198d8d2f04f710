"""Operator 9: line dedup over levelled sorted runs of line hashes."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import words as w
from tessera.llm.shared import delete_folder, keyed, shared_folder, written

#: With it a scan of a bucket that is one file counts as sorted, so runs meet without another sort.
_SORTED = "spark.sql.legacy.bucketedTableScan.outputOrdering"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SPACE = " \\t\\n\\u000b\\u000c\\r"
#: A line's key: white space off both ends, A-Z in lower case.
KEY = f"translate(btrim(l, '{SPACE}'), '{UPPER}', '{LOWER}')"
_HASH = f"struct(xxhash64({KEY}) AS h, hash({KEY}) AS g)"
#: The same of a key k: a lambda evaluates its text as often as it stands there, and the key is dear.
_KEY_HASH = "struct(xxhash64(k) AS h, hash(k) AS g)"


def line_hashes(docs: DataFrame, least_chars: int) -> DataFrame:
    """(rid, h, g): the 96-bit hash of every distinct key of every row; shorter keys are left out."""
    lines = keyed(docs).select("rid", F.split(F.coalesce("text", F.lit("")), "\n", -1).alias("lines"))
    # Distinct as texts, for which Spark has a hash set; structs it would compare each with each.
    hashes = F.expr(f"transform(array_distinct(filter(transform(lines, l -> {KEY}), k -> char_length(k) >= {int(least_chars)})), k -> {_KEY_HASH})")
    return lines.select("rid", F.explode(hashes).alias("x")).select("rid", "x.h", "x.g")


class LineRuns:
    """How many documents each line key was found in, as levelled sorted runs in the shared folder.

    A run holds (h, g, n) sorted by hash.  A batch is merge-joined with every run, loses the keys that
    the runs already settle (found in ``least_docs`` documents), and what is left becomes a run of level 0.
    When a level has ``fanout`` runs, they are merged into one run of the next level, so a key lies
    in at most fanout * log(batches) runs.  A run is written once and never changed; only the list of
    runs is held here.

    All runs are partitions of one external table of ``buckets`` buckets (as many as the session's
    shuffle partitions), sorted within each, so batches meet runs, runs merge and are summed bucket
    by bucket without a shuffle.  Several runs are always one scan of that table: a union of bucketed
    scans claims their partitioning but does not keep it (Spark 4.1).  :meth:`delete` drops the table.
    """

    def __init__(self, spark: SparkSession, least_docs: int, *, fanout: int = 4, folder: str | None = None) -> None:
        self.spark, self.least_docs, self.fanout = spark, least_docs, fanout
        self.name = f"lines_{uuid.uuid4().hex}"
        self.folder = folder or f"{shared_folder(spark)}/{self.name}"
        self.buckets = min(100_000, int(spark.conf.get("spark.sql.shuffle.partitions")))  # Spark has no more
        self.levels: list[list[int]] = []
        self._saved = 0

    def save(self, rows: DataFrame, name: str, part: str) -> None:
        """Append (h, g, n, ``part``) to a table of the runs' buckets, in folders by ``part``, sorted by hash."""
        before = self.spark.conf.get(_SORTED)
        self.spark.conf.set(_SORTED, "true")
        try:
            rows.write.format("parquet").mode("append").option("path", f"{self.folder}/{name}").partitionBy(part).bucketBy(self.buckets, "h", "g").sortBy("h", "g").saveAsTable(name)
        finally:
            self.spark.conf.set(_SORTED, before)

    def _push(self, counts: DataFrame, level: int) -> None:
        self._saved += 1
        self.save(counts.withColumn("run", F.lit(self._saved)), self.name, "run")
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(self._saved)

    def _sum(self, runs: list[int]) -> DataFrame:
        return self.spark.table(self.name).filter(F.col("run").isin(runs)).groupBy("h", "g").agg(F.sum("n").alias("n"))

    def counts(self) -> DataFrame:
        """(h, g, n) over all runs."""
        runs = [x for level in self.levels for x in level]
        return self._sum(runs) if runs else self.spark.createDataFrame([], "h bigint, g int, n bigint")

    def settled(self) -> DataFrame:
        """Keys found in ``least_docs`` documents or more."""
        return self.counts().filter(F.col("n") >= self.least_docs).select("h", "g")

    def delete(self) -> None:
        """Delete the runs; tables already written from them stay."""
        for name in (self.name, f"{self.name}_batches"):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        delete_folder(self.spark, self.folder)
        self.levels = []

    def unsettled(self, counts: DataFrame) -> DataFrame:
        """Rows (h, g, n), one per key, that the runs do not settle."""
        found = F.lit(0)
        for k in (x for level in self.levels for x in level):
            run = self.spark.table(self.name).filter(F.col("run") == k).select("h", "g", F.col("n").alias(f"n{k}"))
            counts = counts.join(run.hint("merge"), ["h", "g"], "left")
            found = found + F.coalesce(f"n{k}", F.lit(0))
        return counts.filter(found < self.least_docs).select("h", "g", "n") if self.levels else counts

    def add(self, hashes: DataFrame) -> None:
        """Add a batch of (h, g) rows, one for each document that has the key, or counted (h, g, n)."""
        one = F.col("n") if "n" in hashes.columns else F.lit(1)
        self._push(self.unsettled(hashes.groupBy("h", "g").agg(F.sum(one).cast("long").alias("n"))), 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            merged, self.levels[level] = self._sum(self.levels[level]), []
            self._push(merged, level + 1)
            level += 1


def count_lines(docs: DataFrame, least_docs: int, least_chars: int, batches: int = 4, runs: LineRuns | None = None) -> LineRuns:
    """Feed a table to ``runs``, new ones by default, in ``batches`` dealt by a hash of the row; the texts are read once.

    One shuffle counts the keys of all batches and puts them into the runs' buckets.
    """
    spark = docs.sparkSession
    runs = runs or LineRuns(spark, least_docs)
    batch = F.pmod("rid", F.lit(batches))
    dealt = line_hashes(docs, least_chars).groupBy("h", "g").agg(*(F.count(F.when(batch == k, 1)).alias(f"n{k}") for k in range(batches)))
    counts = F.array(*(F.struct(F.lit(k).alias("batch"), F.col(f"n{k}").alias("n")) for k in range(batches)))
    dealt = dealt.select("h", "g", F.explode(F.filter(counts, lambda x: x["n"] > 0)).alias("x")).select("h", "g", "x.n", "x.batch")
    runs.save(dealt, f"{runs.name}_batches", "batch")
    table = spark.table(f"{runs.name}_batches")
    for k in range(batches):
        runs.add(table.filter(F.col("batch") == k).select("h", "g", "n"))
    return runs


def _without(lines: list[str], hashes: list[dict], gone: set[tuple[int, int]]) -> list[str]:
    return [line for line, x in zip(lines, hashes, strict=True) if (x["h"], x["g"]) not in gone]


def drop_lines(docs: DataFrame, runs: LineRuns, *, least_chars: int = 1) -> DataFrame:
    """Every row of ``docs`` with (n_lines, n_dropped, kept): settled lines go, the others stay joined.

    The hashes, not the texts, meet the runs; what is to go comes back as one short array per row.  Rows
    that lose something look their lines up in it as a set, so a row costs as much as it has lines.
    """
    # Written first: both sides of the join are plain shuffles then, and a very common line can be split.
    settled = written(runs.settled(), "settled")
    gone = line_hashes(docs, least_chars).join(settled, ["h", "g"]).groupBy("rid").agg(F.collect_set(F.struct("h", "g")).alias("gone"))
    names = [c for c in docs.columns if c != "text"]
    rows = docs.select(F.struct(*names).alias("_row"), F.xxhash64(F.col("doc_id").cast("long"), "text").alias("rid"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.join(gone, "rid", "left").select("_row", "text", "gone")
    hashes = F.when(F.col("gone").isNotNull(), F.expr(f"transform(split(text, '\n', -1), l -> {_HASH})"))
    rows = rows.select("_row", "text", "gone", hashes.alias("hashes"))

    def run(batches):
        for batch in w.chunks(batches):
            text, gone, hashes = (batch.column(x) for x in ("text", "gone", "hashes"))
            kept, before, dropped = [], [], []
            for i in range(batch.num_rows):
                lines = text[i].as_py().split("\n")
                stay = lines
                if gone[i].is_valid:
                    stay = _without(lines, hashes[i].as_py(), {(x["h"], x["g"]) for x in gone[i].as_py()})
                kept.append("\n".join(stay))
                before.append(len(lines))
                dropped.append(len(lines) - len(stay))
            yield pa.RecordBatch.from_arrays([batch.column("_row"), pa.array(before, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())], names=["_row", "n_lines", "n_dropped", "kept"])

    schema = T.StructType([rows.schema["_row"], *T.StructType.fromDDL("n_lines bigint, n_dropped bigint, kept string").fields])
    return rows.mapInArrow(w.releasing(run), schema)


def _cleaned(docs: DataFrame, least_docs: int, least_chars: int, batches: int) -> DataFrame:
    runs = LineRuns(docs.sparkSession, least_docs)
    try:
        count_lines(docs, least_docs, least_chars, batches, runs)
        return drop_lines(docs, runs, least_chars=least_chars)
    finally:
        runs.delete()


def dedup_lines(docs: DataFrame, *, least_docs: int = 10, least_chars: int = 1, batches: int = 4) -> DataFrame:
    """One row per document: doc_id, n_lines, n_dropped, kept_sha256 and ``kept``.

    A text is split at newlines; a line's key is the line without white space at its ends, A-Z in
    lower case.  Keys of at least ``least_chars`` characters found in at least ``least_docs`` rows lose
    all their lines everywhere.  A row is a document: a repeated row counts again.  A null or empty
    text is one empty line, which has no key and stays.  Keys are compared by 96-bit hashes.  A very long
    text is read whole, at a cost in proportion to its lines; an empty table gives no row; a null doc_id
    is passed through, and columns of any other name are not read.
    """
    rows = _cleaned(docs.select("doc_id", "text"), least_docs, least_chars, batches)
    return rows.select(F.col("_row.doc_id").cast("long").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"), "kept")


def clean_lines(docs: DataFrame, *, least_docs: int = 10, least_chars: int = 1, batches: int = 4) -> DataFrame:
    """``docs`` with the kept lines as text, all other columns as they are (see :func:`dedup_lines`)."""
    rows = _cleaned(docs, least_docs, least_chars, batches)
    return rows.select(*(F.col("kept").alias("text") if c == "text" else F.col("_row").getField(c).alias(c) for c in docs.columns))
