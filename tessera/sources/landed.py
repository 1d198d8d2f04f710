"""Readers of landed files and catalog tables; nothing is fetched over a network."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.text import enabled_flag, first_text, fold, strip
from tessera.functions.urls import page_url
from tessera.operators.dedupe import first_wins
from tessera.sources.markup import exploded

SOURCES = "company string, url string, enabled string"
LEADS = "company string, url string, source string, job_count string, example_job_url string, lead_source string, identity string"
# Where records lie, and files made from them.
FOLDERS = ("data", "scripts", "archive", "generated")
GENERATED = ("custom_ats_candidates.csv", "custom_ats_promotion_review.csv", "custom_company_duplicates.csv", "custom_companies_discovered.csv")
_LINK = r"\[[^\]]*\]\(([^)\s]+)\)"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or pattern names a file that Spark's readers can open."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def texts(spark: SparkSession, path: str) -> DataFrame:
    """(file, text) of whole files; bytes that are no UTF-8 become replacement characters, a byte-order mark goes."""
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("file"), F.expr("make_valid_utf8(cast(content AS string))").alias("text"))
    return files.withColumn("text", F.regexp_replace("text", "^\ufeff", ""))


def read_json_list(spark: SparkSession, path: str, schema: str, mode: str = "lenient", *, corrupt: str | None = None) -> DataFrame:
    """Rows of files that hold a JSON list of objects, with ``ord``, their place in it.

    ``lenient`` takes anything else for an empty list, a missing path included; ``list`` raises if the
    top is no list, and ``strict`` also if the text is no JSON or the path is missing.  Items that
    aren't objects are dropped.  With ``corrupt`` a column of that name holds the text of a file that is
    neither blank nor a list, and of an item that is no object, each in a row of its own without fields.
    """
    fields = [T.StructField("ord", T.IntegerType()), *T.StructType.fromDDL(schema).fields]
    if mode != "strict" and not exists(spark, path):
        return spark.createDataFrame([], T.StructType(fields + ([T.StructField(corrupt, T.StringType())] if corrupt else [])))
    files = texts(spark, path)
    kind = F.expr("schema_of_variant(try_parse_json(text))")
    parsed = files.select("file", "text", kind.alias("kind"), (strip(F.col("text")) == "").alias("blank"))
    listed = F.coalesce(F.startswith("kind", F.lit("ARRAY")), F.lit(False))
    if mode != "lenient":
        allowed = listed | F.col("kind").isNull() if mode == "list" else listed
        parsed = parsed.withColumn("text", F.when(~allowed, F.raise_error(F.concat(F.lit("not a JSON list: "), "file"))).otherwise(F.col("text")))
    items = F.when(listed, F.from_json(F.expr("to_json(try_parse_json(text))"), "array<string>"))
    rows = parsed.select(F.when(~listed & ~F.col("blank"), F.col("text")).alias("whole"), F.posexplode_outer(items).alias("ord", "item"))
    whole = F.startswith("item", F.lit("{"))
    if corrupt is None:
        return rows.filter(whole).select("ord", F.from_json("item", schema).alias("row")).select("ord", "row.*")
    rows = rows.withColumn("bad", F.coalesce("whole", F.when(~whole, F.col("item")))).filter(F.col("bad").isNotNull() | whole)
    return rows.select("ord", F.from_json(F.when(whole, F.col("item")), schema).alias("row"), "bad").select("ord", "row.*", F.col("bad").alias(corrupt))


def read_csv(spark: SparkSession, path: str, schema: str, *, exact: bool = True) -> DataFrame:
    """Rows of a CSV file with a header, all cells stripped, nulls as ''.

    ``exact``: the header must be the schema's names in their order, a byte-order mark aside.  Bytes that
    are no UTF-8 become replacement characters.
    """
    names = [x.split()[0] for x in schema.split(",")]
    if exact:
        head = spark.read.text(path).first()
        found = [x.strip().strip('"') for x in (head[0] if head else "").lstrip("﻿").split(",")]
        if found != names:
            raise ValueError(f"header of {path} is {found}, not {names}")
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    rows = (reader.schema(schema) if exact else reader).csv(path)
    rows = rows.toDF(*(c.lstrip("﻿") for c in rows.columns))
    return rows.select(*(strip(F.col(c)).alias(c) for c in rows.columns))


def read_markdown_links(spark: SparkSession, path: str) -> DataFrame:
    """(company, url) of the table rows of Markdown files: the first cell, and every link in the row."""
    rows = spark.read.text(path).filter(F.instr("value", "|") > 0)
    company = strip(F.split(F.regexp_replace(strip(F.col("value")), r"^\||\|$", ""), r"\|")[0])
    return rows.select(company.alias("company"), F.explode(F.regexp_extract_all("value", F.lit(_LINK), 1)).alias("url"))


def _objects(text: str | None) -> Iterator[tuple]:
    """(ord, record) of the objects of a JSON text in the order of a walk: an object before those inside it."""
    try:
        waiting = [json.loads(text or "")]
    except (ValueError, RecursionError):
        return
    n = 0
    while waiting:
        value = waiting.pop()
        if isinstance(value, dict):
            yield n, json.dumps(value, ensure_ascii=False)
            n += 1
        if isinstance(value, (dict, list)):
            waiting += reversed(list(value.values() if isinstance(value, dict) else value))


def read_json_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, ord, record) of every object at any level of JSON files, as JSON text, numbered in pre-order.

    Files that are no JSON give nothing.  A record holds the objects inside it, which come after it.
    """
    return exploded(texts(spark, path), _objects, ("text",), "ord int, record string")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Reader by the suffix: csv, json, md or markdown."""
    suffix = path.rsplit(".", 1)[-1].lower()
    if suffix == "csv":
        return read_csv(spark, path, "any string", exact=False)
    if suffix == "json":
        return read_json_records(spark, path)
    if suffix in ("md", "markdown"):
        return read_markdown_links(spark, path)
    raise ValueError(f"no reader for {path}")


def find_files(spark: SparkSession, root: str, exclude: tuple[str, ...] = GENERATED, folders: tuple[str, ...] = FOLDERS) -> DataFrame:
    """(path) of the csv, json, md and markdown files under some folders of a root, without the excluded names, sorted."""
    there = [f"{root}/{x}" for x in folders if exists(spark, f"{root}/{x}")]
    if not there:
        return spark.createDataFrame([], "path string")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{csv,json,md,markdown}").load(there).select("path")
    return files.filter(~F.lower(F.element_at(F.split("path", "/"), -1)).isin(*exclude)).orderBy("path")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Landed pages (fetch_url, final_url, html, status_code) of JSON lines; pages that were not served are left out."""
    return spark.read.schema("fetch_url string, final_url string, html string, status_code int").json(path).filter("status_code BETWEEN 200 AND 299")


def company_inputs(*tables: DataFrame, default_lineage: str = "manual", placed: bool = False) -> DataFrame:
    """Union of input tables: enabled rows, first of each company and page URL, lineage filled in.

    A table's rows come in the order of its ``ord`` column, which it must have; tables in the order given.
    With ``placed`` the result has that order as ``ord``.
    """
    rows = [t.withColumn("_table", F.lit(i)) for i, t in enumerate(tables)]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    for name in ("career_url", "url", "enabled", "discovered_from"):
        if name not in both.columns:
            both = both.withColumn(name, F.lit(None).cast("string"))
    both = both.withColumn("career_url", page_url(first_text(F.col("career_url"), F.col("url"), default="")))
    flag = enabled_flag(first_text(F.col("enabled"), default="true"))
    both = both.filter(flag.eqNullSafe(F.lit(True)) & (F.col("career_url") != "") & (strip(F.col("company")) != ""))
    both = both.withColumn("discovered_from", first_text(F.col("discovered_from"), default=default_lineage)).withColumn("_key", fold(strip(F.col("company"))))
    rows = first_wins(both, ["_key", "career_url"], ["_table", "ord"])
    place = [(F.col("_table").cast("long") * (1 << 48) + F.col("ord")).alias("ord")] if placed else []
    return rows.select("company", "career_url", "discovered_from", *place)
