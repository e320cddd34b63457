"""A deterministic sharded WARC archive of pages, and its reader.

Equal payloads of at least `least` bytes are stored once: the record with the largest id is the response,
the others are revisits that refer to it. Shards are spans of the id order, cut wherever the running sum of
payload bytes passes a multiple of `shard_bytes`, so they depend on the rows alone and not on how Spark
dealt them. Pages and the small rows that mark revisits go through one shuffle by shard; each shard is
written in id order into gzip-per-record files that roll at `roll_bytes` compressed. Files appear under
their final names only when whole, the manifest is a table of the files, and readers follow the manifest.

Defined results: NULL html is an empty payload; a page without id is always a response; all copies of one
payload that share the largest id are responses; repeated pages are repeated records; an empty table gives
an archive without files.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import keep, new_path, read_file, running_start, write_file

DATE = "2024-01-01T00:00:00Z"  # a fixed capture date: the pages have none, and equal input gives equal files


def _record(kind: str, page: int | None, url: str, digest: bytes, size: int, payload: bytes, refers_to: int | None, number: int) -> bytes:
    """One record, compressed on its own so that readers can start at it."""
    status = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = status + payload
    name = "none" if page is None else str(page)
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{name}:{number}>", f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{base64.b32encode(digest).decode()}",
        f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}", f"X-Payload-Length: {size}",
    ]
    if kind == "revisit":
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return gzip.compress("\r\n".join(lines).encode() + block + b"\r\n\r\n", 6, mtime=0)


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and payload of each record of a file, digests checked."""
    with gzip.GzipFile(fileobj=io.BytesIO(data)) as f:
        while line := f.readline():
            if line != b"WARC/1.1\r\n":
                raise ValueError("not a record")
            headers = {}
            while (line := f.readline()) != b"\r\n":
                key, _, value = line.decode().rstrip("\r\n").partition(": ")
                headers[key] = value
            block = f.read(int(headers["Content-Length"]))
            if f.read(4) != b"\r\n\r\n" or "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode() != headers["WARC-Block-Digest"]:
                raise ValueError(f"damaged record {headers['WARC-Record-ID']}")
            yield headers, block.partition(b"\r\n\r\n")[2]


def write(pages: DataFrame, folder: str, least: int = 1000, shard_bytes: int = 32 << 20, roll_bytes: int = 16 << 20) -> DataFrame:
    """Write the archive; the kept manifest: shard, file, records, payload_bytes, bytes, sha1 of the file."""
    size = F.octet_length(F.coalesce("html", F.lit(""))).cast("long")
    narrow = keep(pages.select(F.col("page_id").cast("long").alias("page_id"), size.alias("size"),
                               F.sha1(F.coalesce("html", F.lit(""))).alias("digest")))
    shards = (running_start(narrow.select("page_id", "size"), ["page_id"], {"start": F.col("size")})
              .groupBy(F.expr(f"start div {shard_bytes}").alias("shard")).agg(F.min("page_id").alias("first")))
    bounds = np.unique(np.array([r["first"] for r in shards.where("first is not null").collect()], np.int64))  # one for each shard

    @F.pandas_udf("int")
    def shard_of(page: pd.Series) -> pd.Series:
        known = page.notna().to_numpy()
        out = np.zeros(len(page), np.int32)
        out[known] = np.maximum(np.searchsorted(bounds, page[known].to_numpy().astype(np.int64), "right") - 1, 0)
        return pd.Series(out)

    # of equal payloads, the largest id; only groups with another id in them
    newest = (narrow.where((F.col("size") >= least) & F.col("page_id").isNotNull()).groupBy("digest", "size")
              .agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("other")).where("other < refers_to"))
    marks = (narrow.join(newest, ["digest", "size"]).where("page_id < refers_to").select("page_id", "digest", "refers_to").distinct())
    both = (pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.lit(None).cast("string").alias("digest"),
                         F.lit(None).cast("long").alias("refers_to"))
            .unionByName(marks.select("page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"), "digest", "refers_to")))
    dealt = (both.withColumn("shard", shard_of("page_id")).repartition(max(len(bounds), 1), "shard")
             .sortWithinPartitions("shard", "page_id", F.col("refers_to").isNull(), "url", "html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, files, marked, page, number = None, [], 0, {}, None, 0

        def roll() -> pa.RecordBatch:
            nonlocal held, files
            data = b"".join(r for r, _ in held)
            name = f"{folder}/shard-{at:06d}-{files:05d}.warc.gz"
            write_file(name, data)
            row = {"shard": at, "file": name, "records": len(held), "payload_bytes": sum(n for _, n in held), "bytes": len(data),
                   "sha1": hashlib.sha1(data).hexdigest()}
            held, files = [], files + 1
            return pa.RecordBatch.from_pylist([row], schema=manifest)

        filled = 0
        for batch in batches:
            for i in range(batch.num_rows):
                shard, this, url, html, digest, refers_to = (batch.column(c)[i].as_py() for c in ("shard", "page_id", "url", "html", "digest", "refers_to"))
                if shard != at:
                    if held:
                        yield roll()
                    at, files, filled, page = shard, 0, 0, None
                if this != page or this is None:
                    page, marked, number = this, {}, 0 if this is not None else number + 1
                if refers_to is not None:
                    marked[digest] = refers_to
                    continue
                payload = (html or "").encode()
                sha = hashlib.sha1(payload)
                target = marked.get(sha.hexdigest()) if len(payload) >= least else None
                record = _record("response" if target is None else "revisit", this, "".join((url or "").split()), sha.digest(), len(payload),
                                 payload if target is None else b"", target, number)
                number += 1
                if held and filled + len(record) > roll_bytes:
                    yield roll()
                    filled = 0
                held.append((record, len(payload)))
                filled += len(record)
        if held:
            yield roll()

    manifest = pa.schema([("shard", pa.int32()), ("file", pa.string()), ("records", pa.int64()), ("payload_bytes", pa.int64()),
                          ("bytes", pa.int64()), ("sha1", pa.string())])
    return keep(dealt.mapInArrow(run, "shard int, file string, records long, payload_bytes long, bytes long, sha1 string"))


def read(manifest: DataFrame) -> DataFrame:
    """The records of the files in the manifest; a payload is checked against its digest."""
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()), ("file", pa.string())])

    def rows(name: str, sha1: str) -> Iterator[dict]:
        data = read_file(name)
        if hashlib.sha1(data).hexdigest() != sha1:
            raise ValueError(f"{name} is not the file of the manifest")
        for h, payload in records(data):
            page = h["WARC-Record-ID"].split(":")[2]
            digest = base64.b32decode(h["WARC-Payload-Digest"].removeprefix("sha1:"))
            revisit = h["WARC-Type"] == "revisit"
            if not revisit and hashlib.sha1(payload).digest() != digest:
                raise ValueError(f"damaged payload of page {page}")
            yield {"page_id": None if page == "none" else int(page), "url": h["WARC-Target-URI"], "record_type": h["WARC-Type"],
                   "payload_bytes": int(h["X-Payload-Length"]), "payload_digest": digest.hex(),
                   "refers_to": int(h["WARC-Refers-To"][len("<urn:page:"):-1]) if revisit else None,
                   "payload": None if revisit else payload, "file": name}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, sha1 in zip(batch.column("file").to_pylist(), batch.column("sha1").to_pylist(), strict=True):
                some: list[dict] = []
                for row in rows(name, sha1):
                    some.append(row)
                    if len(some) == 256:
                        yield pa.RecordBatch.from_pylist(some, schema=schema)
                        some = []
                if some:
                    yield pa.RecordBatch.from_pylist(some, schema=schema)

    n = max(1, manifest.count())  # a file is a task: reading one takes far longer than starting it
    return manifest.select("file", "sha1").repartition(n, "file").mapInArrow(
        run, "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, payload binary, file string")


def archive(spark: SparkSession, pages: DataFrame, **limits: int) -> DataFrame:
    """Write to a new shared folder and read back."""
    return read(write(pages, new_path(spark, "warc"), **limits))
