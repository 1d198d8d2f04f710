"""The folder that driver and executors share, packed texts and connected components."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import words as w


#: Paths written so far inside the open calls of :func:`staged`, innermost last.
_OPEN: list[list[str]] = []


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset, a local folder, but only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = f"file://{tempfile.gettempdir()}/checkpoints"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; the innermost open :func:`staged` deletes it when it is done."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if _OPEN:
        _OPEN[-1].append(path)
    return path


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Cut the lineage: write the rows as Parquet to the shared folder and read them back."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> DataFrame:
    """The rows of ``make()``, written; whatever else was written on the way is deleted then."""
    path = scratch_path(spark, name)
    _OPEN.append([])
    try:
        rows = make()
        rows.write.parquet(path)
    finally:
        for left in _OPEN.pop():
            delete_folder(spark, left)
    return spark.read.schema(rows.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables of :func:`written` that nothing reads any more, and let shuffle files of finished jobs go.

    Spark drops shuffle files once the driver's JVM has collected what refers to them.
    """
    for df in tables:
        files = df.inputFiles()
        if files:
            delete_folder(df.sparkSession, files[0].rsplit("/", 1)[0])
    if tables:
        tables[0].sparkSession._jvm.System.gc()


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, rid, text): rows of equal id and text share ``rid``, and so every result."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", "text").alias("rid"), "text")


def packed_texts(rows: DataFrame) -> DataFrame:
    """(doc_id, rid, packed): texts compressed for a shuffle, each once per ``rid``-equal row."""

    def run(batches):
        for batch in w.chunks(batches):
            packed = [pa.compress(x.as_py().encode(), codec="zstd", asbytes=True) for x in w.texts_of(batch)]
            sizes = [len(x.as_py().encode()) for x in w.texts_of(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("rid"), pa.array(packed, pa.binary()), pa.array(sizes, pa.int64())], names=["doc_id", "rid", "packed", "size"])

    return rows.mapInArrow(w.releasing(run), "doc_id bigint, rid bigint, packed binary, size bigint")


def unpacked(packed: pa.Array, sizes: pa.Array) -> pa.Array:
    """The texts of :func:`packed_texts`."""
    return pa.array([pa.decompress(p, decompressed_size=n, codec="zstd", asbytes=True).decode() if n else "" for p, n in zip(packed.to_pylist(), sizes.to_pylist(), strict=True)], pa.string())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a, b); a component's name is its least node.

    Alternating large-star and small-star contraction.  Each round is a grouped minimum, which is
    summed before it is shuffled, and a join back, which adaptive execution splits at a hub; the
    edges of a round are written to the shared folder.  It ends when a round changes nothing.
    """
    edges = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()
        last, edges = edges, written(small, "edges")
        discard(last)
        now = tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())
        if now == mark:
            roots = edges.select(F.col("b").alias("node")).distinct()
            return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
        mark = now
