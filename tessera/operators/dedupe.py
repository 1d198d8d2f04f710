"""Keep-first, keep-last, greedy and chained dedupe, and group survivors; order is always a column."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from functools import partial, reduce

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def first_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_n", rank).filter("_n = 1").drop("_n")


def last_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key, at the place (``order``) where the key was first seen."""
    names = [c for c in rows.columns if c not in keys]
    picked = rows.groupBy(*keys).agg(F.max_by(F.struct(*names), F.struct(*order)).alias("_last"), F.min(F.struct(*order)).alias("_first"))
    return picked.select(*keys, *((F.col("_first") if c in order else F.col("_last"))[c].alias(c) for c in names)).select(*rows.columns)


def chained(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First row of each value of the first key, then of the second among those left, and so on.

    A key is taken up even by a row that a later key drops; rows with a blank key pass that step.
    """
    for key in keys:
        blank = F.coalesce(F.col(key), F.lit("")) == ""
        rank = F.row_number().over(Window.partitionBy(key, blank).orderBy(*order))
        rows = rows.withColumn("_n", rank).filter(blank | (F.col("_n") == 1)).drop("_n")
    return rows


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows from the shared checkpoint folder, their lineage cut."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(folder or tempfile.gettempdir() + "/checkpoints")
    return df.checkpoint()


def _one_by_one(batches: Iterator[pa.RecordBatch], order: str) -> Iterator[pa.RecordBatch]:
    """The rows that lose, of rows (group, order, keys) sorted by group and order: the greedy rule as it is told."""
    group, taken = None, set()
    for batch in batches:
        lost = []
        for i, (now, keys) in enumerate(zip(batch.column("group").to_pylist(), batch.column("keys").to_pylist(), strict=True)):
            if now != group:
                group, taken = now, set()
            if taken.isdisjoint(keys):
                taken.update(keys)
            else:
                lost.append(i)
        yield batch.select([order]).take(pa.array(lost, pa.int64()))


def greedy(rows: DataFrame, keys: list[str], order: str, *, rounds: int = 3, in_one: int = 500_000) -> DataFrame:
    """Keep a row iff none of its keys belongs to an earlier row that was kept; blank keys don't count.

    ``order`` must be unique.  Rows whose keys are all their own are settled first.  Of those in conflict up to
    ``in_one`` go through one task in order.  More take ``rounds`` rounds: rows that come first in all their keys
    are kept, rows that share a key with a kept row go, the others wait.  If conflicts form long chains and
    too many rows still wait, each connected component of shared keys goes through a task in order, and only
    components of more than ``in_one`` rows take further rounds, until they are small enough.
    """
    pairs = rows.select(order, F.explode(F.array(*(F.struct(F.lit(i).alias("i"), F.col(k).cast("string").alias("v")) for i, k in enumerate(keys)))).alias("k"))
    pairs = pairs.filter(F.coalesce(F.col("k.v"), F.lit("")) != "")
    firsts = pairs.groupBy("k").agg(F.min(order).alias("_first"), F.max(order).alias("_last"))
    alive = checkpointed(pairs.join(firsts.filter(F.col("_first") != F.col("_last")).select("k"), "k"))
    lost, chained_now = [], False
    while waiting := alive.select(order).distinct().count():
        if waiting <= in_one:
            line = _whole(alive, order).withColumn("group", F.lit(0).cast("long")).coalesce(1).sortWithinPartitions(order)
            lost.append(_solved(line, order))
            break
        if chained_now:
            out, alive = _chains(alive, order, in_one)
            lost.append(out)
        for _ in range(0 if chained_now else rounds):
            first = alive.groupBy("k").agg(F.min(order).alias("_first"))
            state = alive.join(first, "k").groupBy(order).agg(F.bool_and(F.col("_first") == F.col(order)).alias("_keep"))
            marked = checkpointed(alive.join(state, order))
            taken = marked.filter("_keep").select("k").distinct()
            out = marked.filter("NOT _keep").join(taken, "k", "left_semi").select(order).distinct()
            lost.append(out)
            alive = checkpointed(marked.filter("NOT _keep").drop("_keep").join(out, order, "left_anti"))
        chained_now = not chained_now
    return rows.join(reduce(DataFrame.unionByName, lost), order, "left_anti") if lost else rows


def _whole(alive: DataFrame, order: str) -> DataFrame:
    """(order, keys) of pairs (order, k): a row of a table's with all its keys."""
    return alive.groupBy(order).agg(F.array_sort(F.collect_set(F.concat(F.col("k.i"), F.lit(":"), F.col("k.v")))).alias("keys"))


def _solved(line: DataFrame, order: str) -> DataFrame:
    """The rows that lose of (group, order, keys), each group in one task and sorted."""
    return checkpointed(line.select(order, "group", "keys").mapInArrow(partial(_one_by_one, order=order), T.StructType([line.schema[order]])))


def _chains(alive: DataFrame, order: str, in_one: int) -> tuple[DataFrame, DataFrame]:
    """(rows that lose, pairs of components that are too large) of pairs (order, k) still in conflict."""
    from tessera.operators.graph import components

    # Keys that one row holds lie in one component; keys of equal hash only make components larger.
    whole = _whole(alive, order)
    ties = whole.select(F.transform("keys", lambda x: F.xxhash64(x)).alias("h")).select(F.col("h")[0].alias("a"), F.explode("h").alias("b"))
    dealt = checkpointed(whole.withColumn("node", F.xxhash64(F.col("keys")[0])).join(components(ties).withColumnRenamed("component", "group"), "node").drop("node"))
    large = checkpointed(dealt.groupBy("group").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > in_one).select("group"))
    small = dealt.join(large, "group", "left_anti").repartition("group").sortWithinPartitions("group", order)
    rest = dealt.join(large, "group", "left_semi").select(order)
    return _solved(small, order), checkpointed(alive.join(rest, order, "left_semi"))


def merge_traces(rows: DataFrame, keys: list[str], traces: list[str], order: list[str]) -> DataFrame:
    """First row of each key, with the ;-joined sets of ``traces`` of all its rows, sorted."""
    names = [c for c in rows.columns if c not in keys and c not in traces]
    sets = [F.array_join(F.array_sort(F.array_distinct(F.filter(F.flatten(F.collect_set(F.split(F.coalesce(F.col(c), F.lit("")), ";"))), lambda x: x != ""))), ";").alias(c) for c in traces]
    merged = rows.groupBy(*keys).agg(F.min_by(F.struct(*names), F.struct(*order)).alias("_first"), *sets)
    return merged.select(*keys, *(F.col("_first")[c].alias(c) for c in names), *traces).select(*rows.columns)


def survivors(rows: DataFrame, keys: list[str], quality: list, order: list[str], url: str = "url") -> tuple[DataFrame, DataFrame]:
    """(best row of each group with ``n_collapsed``, rejects with ``kept_url``); quality: best first."""
    by = Window.partitionBy(*keys).orderBy(*quality, *order)
    whole = Window.partitionBy(*keys)
    ranked = rows.withColumns({"_n": F.row_number().over(by), "_kept": F.first(url).over(by), "n_collapsed": F.count(F.lit(1)).over(whole) - 1})
    return ranked.filter("_n = 1").drop("_n", "_kept"), ranked.filter("_n > 1").withColumn("kept_url", F.col("_kept")).drop("_n", "_kept", "n_collapsed")


def numbered_names(rows: DataFrame, name: str, label: str, source: str, order: list[str], used: DataFrame) -> DataFrame:
    """``name`` made unique per ``source`` against ``used`` (name, source) and the rows themselves, whatever the case.

    A name that one row has and that is not used stays.  Others, all rows of a shared name included,
    become "name - label", and "name - label 2", 3, ... in ``order`` where that is taken.
    """
    low = lambda c: F.lower(c)
    rows = rows.withColumns({"_low": low(F.col(name)), "_same": F.count(F.lit(1)).over(Window.partitionBy(low(F.col(name)), source))})
    taken = used.select(low(F.col(name)).alias("_low"), source).distinct()
    rows = rows.join(taken.withColumn("_used", F.lit(True)), ["_low", source], "left")
    plain = (F.col("_same") == 1) & F.col("_used").isNull()
    rows = rows.withColumns({"_plain": plain, "_stem": F.concat_ws(" - ", name, label)}).withColumn("_stem_low", low(F.col("_stem")))
    # What is taken of a stem: the bare stem counts as number 1.
    every = taken.unionByName(rows.filter("_plain").select("_low", source))
    numbered = every.select(source, F.regexp_extract("_low", r"^(.*) (\d{1,9})$", 1).alias("_stem_low"), F.regexp_extract("_low", r"^(.*) (\d{1,9})$", 2).try_cast("int").alias("_no")).filter("_no >= 2")
    numbers = every.select(source, F.col("_low").alias("_stem_low"), F.lit(1).alias("_no")).unionByName(numbered).distinct()
    stem = Window.partitionBy(source, "_stem_low")
    # Of the sorted taken numbers the i-th is t(i); up to t(i) there are t(i) - i free ones, so the n-th free number is
    # n and as many as have t(i) - i < n.
    gaps = numbers.select(source, "_stem_low", (F.col("_no") - F.row_number().over(stem.orderBy("_no")) + 1).alias("_at"), F.lit(1).alias("_taken"))
    wanted = rows.filter("NOT _plain").withColumns({"_at": F.row_number().over(stem.orderBy(*order)), "_taken": F.lit(0)})
    both = wanted.unionByName(gaps, allowMissingColumns=True)
    passed = F.sum("_taken").over(stem.orderBy("_at", F.desc("_taken")).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    wanted = both.withColumn("_no", F.col("_at") + passed).filter("_taken = 0").drop("_at", "_taken")
    rows = wanted.unionByName(rows.filter("_plain").withColumn("_no", F.lit(0).cast("long")))
    made = F.when(F.col("_plain"), F.col(name)).when(F.col("_no") == 1, F.col("_stem")).otherwise(F.concat_ws(" ", "_stem", F.col("_no").cast("string")))
    return rows.withColumn(name, made).drop(*(c for c in ("_low", "_same", "_used", "_plain", "_stem", "_stem_low", "_no")))
