"""Fetching behind an interface: whoever calls hands in the fetcher; answers and errors come out as rows.

A fetcher takes a URL and a time limit in seconds and returns an :class:`Answer` or raises.  ``fetched`` asks
it for every row of a table, where Spark has put the rows; :func:`source` makes a Spark data source of it for
lists that fit an option, or a folder.  One item that fails gives a row with its error and stops nothing.
"""

from __future__ import annotations

import json
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from importlib import import_module

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

ANSWER = "final_url string, status_code int, body string, error string, tries int"
_TYPES = {"final_url": pa.string(), "status_code": pa.int32(), "body": pa.string(), "error": pa.string(), "tries": pa.int32()}
AGENT = "tessera"


@dataclass(frozen=True)
class Answer:
    final_url: str
    status_code: int
    body: str


Fetcher = Callable[[str, float], Answer]


def http_get(url: str, timeout: float) -> Answer:
    """A GET that follows redirects; statuses from 400 raise, bytes that the charset doesn't know are replaced."""
    request = urllib.request.Request(url, headers={"User-Agent": AGENT, "Accept": "text/html,application/json;q=0.9,*/*;q=0.8"})
    with urllib.request.urlopen(request, timeout=timeout) as reply:
        charset = reply.headers.get_content_charset() or "utf-8"
        return Answer(reply.geturl(), reply.status, reply.read().decode(charset, "replace"))


def store_get(url: str, timeout: float) -> Answer:
    """A file of any store that Arrow reads, by its URI."""
    store, path = pyarrow.fs.FileSystem.from_uri(url)
    with store.open_input_stream(path) as file:
        return Answer(url, 200, file.read().decode("utf-8", "replace"))


def attempt(fetcher: Fetcher, url: str | None, timeout: float, tries: int) -> tuple:
    """ANSWER of one URL: the first of ``tries`` that succeeds, else the last one's error.  It never raises."""
    error, status = "no URL", None
    if not url:
        return None, None, None, error, 0
    for n in range(1, tries + 1):
        try:
            answer = fetcher(url, timeout)
            return answer.final_url, answer.status_code, answer.body, None, n
        except Exception as problem:  # noqa: BLE001 whatever a fetcher raises is this item's error
            error, status = f"{type(problem).__name__}: {problem}", getattr(problem, "code", None)
    return None, status if isinstance(status, int) else None, None, error, tries


def fetched(requests: DataFrame, fetcher: Fetcher = http_get, *, url: str = "url", timeout: float = 30.0, tries: int = 1, workers: int = 8) -> DataFrame:
    """``requests`` with ANSWER beside each row: ``error`` is null where the fetch succeeded.

    A task has ``workers`` fetches under way at a time; how many tasks there are is up to the table's
    partitions.  A null or empty URL is an error; repeated URLs are fetched again.
    """
    made = T.StructType.fromDDL(ANSWER)
    keep = [f for f in requests.schema.fields if f.name not in made.names]

    def run(batches):
        with ThreadPoolExecutor(workers) as pool:
            for batch in batches:
                for first in range(0, batch.num_rows, 4 * workers):
                    part = batch.slice(first, 4 * workers)
                    answers = list(pool.map(lambda x: attempt(fetcher, x, timeout, tries), part.column(url).to_pylist()))
                    columns = [pa.array(c, t) for c, t in zip(zip(*answers, strict=True), _TYPES.values(), strict=True)]
                    yield pa.RecordBatch.from_arrays([*(part.column(f.name) for f in keep), *columns], names=[*(f.name for f in keep), *_TYPES])

    return requests.mapInArrow(run, T.StructType([*keep, *made.fields]))


# ---------------------------------------------------------------- as a data source


@dataclass
class _Items(InputPartition):
    urls: tuple[str, ...]


class _Reader(DataSourceReader):
    def __init__(self, fetcher: Fetcher, options: dict[str, str]) -> None:
        self.fetcher, self.options = fetcher, {k.lower(): v for k, v in options.items()}

    def partitions(self) -> list[InputPartition]:
        if "folder" in self.options:
            store, path = pyarrow.fs.FileSystem.from_uri(self.options["folder"])
            found = store.get_file_info(pyarrow.fs.FileSelector(path, recursive=True))
            head = self.options["folder"].split(path, 1)[0]
            urls = sorted(head + x.path for x in found if x.is_file)
        else:
            urls = json.loads(self.options.get("urls", "[]"))
        size = int(self.options.get("itemsperpartition", "64"))
        return [_Items(tuple(urls[i : i + size])) for i in range(0, len(urls), size)] or [_Items(())]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        timeout, tries = float(self.options.get("timeout", "30")), int(self.options.get("tries", "1"))
        for url in partition.urls:
            yield (url, *attempt(self.fetcher, url, timeout, tries))


def source(fetcher: Fetcher | None = None, name: str = "fetched") -> type[DataSource]:
    """A data source that asks ``fetcher``, or the one that its option ``fetcher`` names as ``module:function``.

    ``spark.dataSource.register(source(my_fetcher))``, then ``spark.read.format("fetched")`` with the option
    ``urls``, a JSON list, or ``folder``, the URI of one; ``timeout`` in seconds, ``tries`` and ``itemsPerPartition``.
    Rows are ``url`` and ANSWER.
    """

    class Fetched(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> str:
            return f"url string, {ANSWER}"

        def reader(self, schema) -> DataSourceReader:
            asked = fetcher
            if asked is None:
                module, _, function = self.options.get("fetcher", f"{__name__}:http_get").partition(":")
                asked = getattr(import_module(module), function)
            return _Reader(asked, dict(self.options))

    return Fetched


def fetched_urls(spark: SparkSession, urls: list[str], fetcher: Fetcher = http_get, **options: str) -> DataFrame:
    """``url`` and ANSWER of a few URLs, through the data source."""
    spark.dataSource.register(source(fetcher))
    return spark.read.format("fetched").options(urls=json.dumps(urls), **options).load()


# ---------------------------------------------------------------- what answers hold


def json_lists(answers: DataFrame, schema: str) -> DataFrame:
    """(url, ord, the fields of ``schema``, error) of the items of answers that are JSON lists.

    An answer with an error, or with a body that isn't a JSON list, is one row with that error and no
    item; items that aren't objects are dropped.
    """
    kind = F.expr("schema_of_variant(try_parse_json(body))")
    problem = F.when(F.col("error").isNotNull(), F.col("error")).when(kind.isNull(), "not JSON").when(~F.startswith(kind, F.lit("ARRAY")), "not a JSON list")
    rows = answers.select("url", "body", problem.alias("error"))
    items = F.when(F.col("error").isNull(), F.from_json(F.expr("to_json(try_parse_json(body))"), "array<string>"))
    rows = rows.select("url", "error", F.posexplode_outer(items).alias("ord", "item")).filter(F.col("error").isNotNull() | F.startswith("item", F.lit("{")))
    return rows.select("url", "ord", F.from_json("item", schema).alias("row"), "error").select("url", "ord", "row.*", "error")


def pages(answers: DataFrame) -> DataFrame:
    """Answers as landed pages (fetch_url, final_url, html, status_code, error); those with an error have no text."""
    return answers.select(F.col("url").alias("fetch_url"), "final_url", F.col("body").alias("html"), "status_code", "error")
