"""Operator 8: WARC archives with a two-level capture index."""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left
from dataclasses import dataclass
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm import words as w
from tessera.llm.shared import discard, scratch_path, written

#: Index lines in a compressed block, and bytes of an archive before the next begins.
BLOCK_LINES, ARCHIVE_BYTES = 512, 1 << 30
DATE = "1970-01-01T00:00:00Z"
_PLACE = "page_id bigint, url string, file string, at bigint, length bigint"
_RECORD = "page_id bigint, url string, record_type string, refers_to bigint, payload_digest string, payload_bytes bigint, payload binary"


def url_key(url: str | None) -> str:
    """The URL with its host reversed ("com,example)/a?b"), lower-case host, without scheme and fragment.

    Spaces and control characters, which would part an index line or sort before its parts, are escaped.
    """
    return re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", _plain_key((url or "").strip()))


def _plain_key(url: str) -> str:
    try:
        parts = urlsplit(url)
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:
        return f"-){url}"
    if not host:
        return f"-){url}"
    default = {"http": 80, "https": 443}.get(parts.scheme)
    return ",".join(reversed(host.split("."))) + (f":{port}" if port and port != default else "") + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str | None, payload: bytes, name: str, size: int, refers_to, is_revisit: bool) -> bytes:
    """One WARC/1.1 record; a revisit has the HTTP header only, its digest and size are the payload's."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if is_revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if is_revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {(url or '').strip()}".replace("\n", "%0A").replace("\r", "%0D"), f"WARC-Payload-Digest: sha1:{name}", f"X-Payload-Length: {size}"]
    head += [f"X-Page-ID: {page_id}"] if page_id is not None else []
    if is_revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", *([f"X-Refers-To-Page-ID: {refers_to}"] if refers_to is not None else [])]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """The record in an uncompressed member; a response's payload is checked against its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:] if ": " in line)
    block = rest[: int(fields["Content-Length"])]
    response = fields["WARC-Type"] == "response"
    payload = block.partition(b"\r\n\r\n")[2] if response else None
    name = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if response and digest(payload) != name:
        raise ValueError(f"payload of page {fields.get('X-Page-ID')} does not match its digest")
    number = lambda k: int(fields[k]) if k in fields else None
    return {"page_id": number("X-Page-ID"), "url": fields.get("WARC-Target-URI", ""), "record_type": fields["WARC-Type"], "refers_to": number("X-Refers-To-Page-ID"), "payload_digest": name, "payload_bytes": len(payload) if response else number("X-Payload-Length"), "payload": payload}


def _stage(pages: DataFrame) -> DataFrame:
    """The pages with their digests and compressed payloads, and a number for every row."""

    def run(batches):
        base, i = TaskContext.get().partitionId() << 33, 0
        for batch in w.chunks(batches, "html"):
            payloads = [(x or "").encode() for x in batch.column("html").to_pylist()]
            uid = pa.array(np.arange(base + i, base + i + len(payloads)))
            i += len(payloads)
            yield pa.RecordBatch.from_arrays([uid, batch.column("page_id"), batch.column("url"), pa.array([len(x) for x in payloads], pa.int64()), pa.array([digest(x) for x in payloads], pa.string()), pa.array([zlib.compress(x, 1) for x in payloads], pa.binary())], names=["uid", "page_id", "url", "size", "digest", "packed"])

    return pages.selectExpr("cast(page_id AS bigint) AS page_id", "url", "html").mapInArrow(w.releasing(run), "uid bigint, page_id bigint, url string, size bigint, digest string, packed binary")


def write_archives(pages: DataFrame, folder: str, *, least_bytes: int = 0) -> DataFrame:
    """Write a WARC record per row of ``pages`` (page_id, url, html) and return its place.

    Of the rows of equal payloads of at least ``least_bytes`` bytes the one of the smallest page_id
    (null ids last, then in the order they are read) is a response, the others are revisits of it.
    Every record is a gzip member.  A task writes files of names of its own, and only the places it
    returns count, so a task that is lost and run again leaves at most a file that nothing names.

    (page_id, url, file, at, length), written to the shared folder.
    """
    staged = written(_stage(pages), "pages")
    order = F.struct(F.col("page_id").isNull().alias("no"), "page_id", "uid")
    same = staged.filter(F.col("size") >= least_bytes).groupBy("digest", "size").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    same = written(same, "same")  # a plain side, so that adaptive execution can split a hot payload
    repeats = staged.select("uid", "digest", "size").join(same, ["digest", "size"]).filter("uid <> first.uid").select("uid", F.col("first.page_id").alias("refers_to"), F.lit(True).alias("revisit"))
    rows = staged.join(repeats, "uid", "left")

    def run(batches):
        context = TaskContext.get()
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        file, at, out = 0, 0, None
        try:
            for batch in w.chunks(batches, "size"):
                places = []
                for row in batch.to_pylist():
                    if out is None or at >= ARCHIVE_BYTES:
                        if out:
                            out.close()
                        name = f"pages-{context.partitionId():06d}-{context.taskAttemptId()}-{file:04d}.warc.gz"
                        out, at, file = system.open_output_stream(f"{root}/{name}", compression=None), 0, file + 1
                    member = gzip.compress(record(row["page_id"], row["url"], b"" if row["revisit"] else zlib.decompress(row["packed"]), row["digest"], row["size"], row["refers_to"], bool(row["revisit"])), 6, mtime=0)
                    out.write(member)
                    places.append((row["page_id"], row["url"], name, at, len(member)))
                    at += len(member)
                columns = list(zip(*places, strict=True)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)], names=["page_id", "url", "file", "at", "length"])
        finally:
            if out:
                out.close()

    places = written(rows.select("page_id", "url", "digest", "size", "packed", "refers_to", "revisit").mapInArrow(w.releasing(run), _PLACE), "places")
    discard(staged, same)
    return places


_ENTRY = "key string, page_id bigint, file string, at bigint, length bigint"
_ENTRY_SCHEMA = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("at", pa.int64()), ("length", pa.int64())])


def _lines(f, at: int, length: int) -> list[str]:
    """The lines of a gzip member, by a range read."""
    return gzip.decompress(f.read_at(length, at)).decode().split("\n")[:-1]


def _entry(line: str) -> dict:
    key, _, place = line.partition(" ")
    return {"key": key, **json.loads(place)}


@dataclass
class CaptureIndex:
    """Sorted key lines in compressed blocks, and a sparse directory of the blocks at the end of every shard.

    ``shards``: (first_key, last_key, shard, at, length, lines), a row for each shard with the place
    of its directory.  There are at most as many shards as the index has partitions.
    """

    folder: str
    shards: DataFrame

    def entries(self) -> DataFrame:
        """(key, page_id, file, at, length) of every capture, block by block."""
        folder = self.folder

        def run(batches):
            system, root = fs.FileSystem.from_uri(folder)
            for batch in batches:
                for row in batch.to_pylist():
                    with system.open_input_file(f"{root}/{row['shard']}") as f:
                        for place in _lines(f, row["at"], row["length"]):
                            at, length, _ = place.split(" ", 2)
                            yield pa.RecordBatch.from_pylist([_entry(x) for x in _lines(f, int(at), int(length))], schema=_ENTRY_SCHEMA)

        spread = self.shards.repartition(self.shards.sparkSession.sparkContext.defaultParallelism * 2)
        return spread.select("shard", "at", "length").mapInArrow(w.releasing(run), _ENTRY)

    def find(self, urls: DataFrame) -> DataFrame:
        """(key, page_id, file, at, length) of all captures of the URLs (url); a URL given twice counts once.

        Every different key is looked up in the bounds of the shards, the keys of a shard in its
        directory, by binary searches, and each block that may hold one is read once, by a range
        read.  A key with very many captures lies in several shards, which are read apart.
        """
        folder = self.folder
        bounds = sorted((r["first_key"], r["last_key"], r["shard"], r["at"], r["length"]) for r in self.shards.collect())
        known = urls.sparkSession.sparkContext.broadcast(bounds)
        keys = keyed_urls(urls.select("url").distinct()).select("key").distinct()

        def shards_of(batches):
            lasts = [x[1] for x in known.value]
            for batch in batches:
                found = []
                for key in batch.column("key").to_pylist():
                    i = bisect_left(lasts, key)
                    while i < len(lasts) and known.value[i][0] <= key:
                        found.append((i, key))
                        i += 1
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int32()), pa.array([x[1] for x in found], pa.string())], names=["shard", "key"])

        def look_up(batches):
            system, root = fs.FileSystem.from_uri(folder)
            number, f, places, lasts, seen, lines = -1, None, [], [], -1, []
            for batch in batches:
                out = []
                for shard, key in zip(batch.column("shard").to_pylist(), batch.column("key").to_pylist(), strict=True):
                    if shard != number:
                        if f:
                            f.close()
                        _, _, name, at, length = known.value[shard]
                        number, f, seen = shard, system.open_input_file(f"{root}/{name}"), -1
                        places = [x.split(" ") for x in _lines(f, at, length)]
                        lasts = [x[3] for x in places]
                    i = bisect_left(lasts, key)
                    while i < len(places) and places[i][2] <= key:
                        if i != seen:
                            seen, lines = i, _lines(f, int(places[i][0]), int(places[i][1]))
                        j = bisect_left(lines, f"{key} ")
                        while j < len(lines) and lines[j].startswith(f"{key} "):
                            out.append(_entry(lines[j]))
                            j += 1
                        if len(out) >= 4096:
                            yield pa.RecordBatch.from_pylist(out, schema=_ENTRY_SCHEMA)
                            out = []
                        i += 1
                yield pa.RecordBatch.from_pylist(out, schema=_ENTRY_SCHEMA)
            if f:
                f.close()

        spread = keys.mapInArrow(shards_of, "shard int, key string").repartition("shard").sortWithinPartitions("shard", "key")
        return spread.mapInArrow(w.releasing(look_up), _ENTRY)

    def read(self, entries: DataFrame) -> DataFrame:
        """The records of entries (file, at, length), by range reads in the order of each file."""
        folder = self.folder

        def run(batches):
            system, root = fs.FileSystem.from_uri(folder)
            for batch in w.chunks(batches, "length", 2 << 20):
                rows, name, f = [], None, None
                for row in sorted(batch.to_pylist(), key=lambda x: (x["file"], x["at"])):
                    if row["file"] != name:
                        if f:
                            f.close()
                        name, f = row["file"], system.open_input_file(f"{root}/{row['file']}")
                    rows.append(parse(gzip.decompress(f.read_at(row["length"], row["at"]))))
                if f:
                    f.close()
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())]))

        spread = entries.select("file", "at", "length").repartition(2 * entries.sparkSession.sparkContext.defaultParallelism)
        return spread.mapInArrow(w.releasing(run), _RECORD)


def keyed_urls(rows: DataFrame) -> DataFrame:
    """``rows`` with the ``key`` of their ``url`` (:func:`url_key`)."""

    def run(batches):
        for batch in batches:
            yield batch.append_column("key", pa.array([url_key(x) for x in batch.column("url").to_pylist()], pa.string()))

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("key", T.StringType())]))


def build_index(places: DataFrame, folder: str) -> CaptureIndex:
    """Sort the places by URL key over the cluster and write one shard of blocks per partition.

    A shard ends with its directory, one line per block: place, length, first and last key.  Rows of
    one key may fall into several shards: the range partitioning also looks at the place.
    """

    def blocks(batches):
        context = TaskContext.get()
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        name = f"index-{context.partitionId():06d}-{context.taskAttemptId()}.gz"
        out, at, held, listed, total = None, 0, [], [], 0

        def member(lines: list[str]) -> int:
            nonlocal out, at
            out = out or system.open_output_stream(f"{root}/{name}", compression=None)
            packed = gzip.compress("".join(f"{x}\n" for x in lines).encode(), 6, mtime=0)
            out.write(packed)
            at += len(packed)
            return len(packed)

        def block(lines: list[str]) -> None:
            start, first, last = at, lines[0].split(" ", 1)[0], lines[-1].split(" ", 1)[0]
            listed.append(f"{start} {member(lines)} {first} {last}")

        for batch in batches:
            held += [f"{row.pop('key')} {json.dumps(row)}" for row in batch.select(["key", "page_id", "file", "at", "length"]).to_pylist()]
            total += batch.num_rows
            while len(held) >= BLOCK_LINES:
                block(held[:BLOCK_LINES])
                held = held[BLOCK_LINES:]
        if held:
            block(held)
        if listed:
            start = at
            size = member(listed)
            out.close()
            yield pa.RecordBatch.from_pylist([{"first_key": listed[0].split(" ")[2], "last_key": listed[-1].split(" ")[3], "shard": name, "at": start, "length": size, "lines": total}], schema=pa.schema([("first_key", pa.string()), ("last_key", pa.string()), ("shard", pa.string()), ("at", pa.int64()), ("length", pa.int64()), ("lines", pa.int64())]))

    ordered = keyed_urls(places).repartitionByRange("key", "file", "at").sortWithinPartitions("key", "file", "at")
    shards = ordered.mapInArrow(w.releasing(blocks), "first_key string, last_key string, shard string, at bigint, length bigint, lines bigint")
    return CaptureIndex(folder, written(shards, "shards"))


def archive_pages(pages: DataFrame, *, folder: str | None = None, least_bytes: int = 0) -> CaptureIndex:
    """Write the archives and their index to ``folder`` (a new one in the shared folder).

    Null html is an empty payload; a null or odd URL is filed under "-)"; repeated rows are records of
    their own; an empty table gives an index without shards; very long pages are handled one by one.
    """
    folder = folder or scratch_path(pages.sparkSession, "warc")
    places = write_archives(pages, folder, least_bytes=least_bytes)
    index = build_index(places, folder)
    discard(places)
    return index
