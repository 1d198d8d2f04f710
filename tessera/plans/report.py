"""The job board: filter, sort and render records, and splice the table into a file."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.dates import sort_date
from tessera.functions.locations import places, with_places
from tessera.functions.text import blank_to, escape_cell
from tessera.operators import detect, discover

#: Fixed value: the head of the table.
HEADER = ("| Company | Role | City | Apply | Date Added |", "| --- | --- | --- | --- | --- |")


def board(jobs: DataFrame, kind: str) -> DataFrame:
    """Active records of a kind, newest first, then by company and title; ``ord`` breaks ties."""
    return jobs.filter(F.col("active").eqNullSafe(True) & (F.col("type") == kind)).orderBy(sort_date(F.col("date_added")).desc_nulls_last(), F.lower("company"), F.lower("title"), "ord")


def cells(jobs: DataFrame) -> DataFrame:
    """The board's five columns as shown; ``place``, where it is there, is the location as shown."""
    shown = F.col("place") if "place" in jobs.columns else places(F.col("location"))
    return jobs.select(
        escape_cell(F.col("company")).alias("company"),
        escape_cell(F.col("title")).alias("role"),
        escape_cell(shown).alias("city"),
        F.concat(F.lit("[Apply]("), blank_to(F.col("url"), "#"), F.lit(")")).alias("apply"),
        F.coalesce(F.date_format(sort_date(F.col("date_added")), "yyyy-MM-dd"), F.col("date_added").cast("string"), F.lit("")).alias("date_added"),
    )


def render(jobs: DataFrame, kind: str) -> list[str]:
    """Lines of the Markdown table; rows stream to the driver, which writes the one file."""
    line = F.concat(F.lit("| "), F.concat_ws(" | ", "company", "role", "city", "apply", "date_added"), F.lit(" |"))
    rows = board(with_places(jobs, "location", "place"), kind)
    lines = [r[0] for r in cells(rows).select(line).toLocalIterator()]
    return [*HEADER, *(lines or ["| No jobs found | | | | |"])]


def splice(path: str, start: str, end: str, lines: list[str]) -> None:
    """Replace what stands between the first pair of markers; line ends stay; raises without markers."""
    with open(path, encoding="utf-8", newline="") as f:
        text = f.read()
    a = text.find(start)
    b = text.find(end, a + len(start)) if a >= 0 else -1
    if b < 0:
        raise ValueError(f"{path} has no markers {start} and {end}")
    eol = "\r\n" if "\r\n" in text else "\n"
    with open(path, "w", encoding="utf-8", newline="") as f:
        f.write(text[: a + len(start)] + eol + eol.join(lines) + eol + text[b:])


def save_json_list(rows: DataFrame, path: str) -> None:
    """One indented JSON list in a file of the driver; rows stream to it one by one."""
    with open(path, "w", encoding="utf-8") as f:
        f.write("[")
        for i, row in enumerate(rows.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).toLocalIterator()):
            f.write(",\n" if i else "\n")
            f.write("  " + json.dumps(json.loads(row[0]), ensure_ascii=False, indent=2).replace("\n", "\n  "))
        f.write("\n]\n")


def save_csv(rows: DataFrame, folder: str, columns: list[str]) -> None:
    rows.select(*columns).write.mode("overwrite").option("header", True).option("escape", '"').csv(folder)


def save_candidates(rows: DataFrame, folder: str) -> None:
    save_csv(rows, folder, list(detect.CANDIDATES))


def save_review(rows: DataFrame, folder: str) -> None:
    save_csv(rows, folder, ["company", "detected_source", "candidate_url", "canonical_source_url", "status", "reason"])


def save_discovered(kept: DataFrame, gone: DataFrame, folder: str, report_folder: str) -> None:
    """Discovered pages, and beside them the report of those that others stand for."""
    save_csv(kept, folder, list(discover.DISCOVERED))
    save_csv(gone, report_folder, list(discover.DUPLICATES))


def type_counts(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("type").agg(F.count(F.lit(1)).alias("n"), F.count_if("active").alias("n_active"))
