"""Snapshot merge run by run, as a stream of landed records (beyond batch parity)."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tessera.operators.merge import merge_snapshots


def merge_stream(landed: DataFrame, state: str, checkpoint: str, as_of: Callable[[int], str], start: tuple[str, str]) -> StreamingQuery:
    """Merge every micro-batch of records into the snapshots; ``start``: folders of (active, archived).

    Each batch writes both snapshots to a folder of its own under ``state`` and then names it in
    ``state``/current, so a reader never sees half a run; a batch that is run again writes anew.
    """
    spark = landed.sparkSession

    def merge(batch: DataFrame, number: int) -> None:
        pointer = f"{state}/current"
        try:
            folder = spark.read.text(pointer).first()[0]
            active, archived = f"{folder}/active", f"{folder}/archived"
        except Exception as error:  # the first batch finds no pointer
            if "PATH_NOT_FOUND" not in str(error):
                raise
            active, archived = start
        touched = batch.select("source", "company").distinct()
        live, shelf = merge_snapshots(spark.read.parquet(active), batch, spark.read.parquet(archived), touched, as_of(number))
        target = f"{state}/run-{number}-{uuid.uuid4().hex}"
        live.write.parquet(f"{target}/active")
        shelf.write.parquet(f"{target}/archived")
        spark.createDataFrame([(target,)], "value string").coalesce(1).write.mode("overwrite").text(pointer)

    return landed.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
