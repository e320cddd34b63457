"""Helpers the corpus operators share: table access, global numbering, files in the shared folder."""

from __future__ import annotations

import ctypes
import os
import sys
import uuid
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from contextlib import suppress
from pathlib import Path

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import shared_folder

WORD = r"[^\x20\x09-\x0D]+"  # fixed value: what the contracts call a word


ARROW_ROWS, ARROW_BYTES = 1000, 4 << 20


def ship(spark: SparkSession) -> None:
    """Lets Python workers import this package wherever the session was started (a cluster gets it by --py-files).

    Rows go to them in small batches, as texts are long: the session's Arrow batches become at most these.
    """
    rows = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(min(rows, ARROW_ROWS) if rows > 0 else ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    root, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(p for p in (root, env.get("PYTHONPATH")) if p)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_path(spark: SparkSession, kind: str) -> str:
    """A folder name nobody has used, in the folder all executors share."""
    return f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"


#: For rows of some megabytes: sizes are looked at after every row, so that a reader holds one short group of rows and not the whole file.
LARGE_ROWS = {"parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1", "parquet.block.size": str(8 << 20), "parquet.enable.dictionary": "false"}


def keep(df: DataFrame, options: Mapping[str, str] | None = None) -> DataFrame:
    """The rows as a written, compressed table in the shared folder; `options` of the writer come on top.

    Cuts the lineage: a lost executor costs nothing that was kept, and every reader sees the same rows.
    """
    path = new_path(df.sparkSession, "kept")
    df.write.options(**{"compression": "zstd", **(options or {})}).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def running_start(df: DataFrame, order: Sequence[str], sizes: Mapping[str, Column]) -> DataFrame:
    """Adds for each name the sum of its size over all rows that come before in `order` (0 for the first).

    Rows are dealt into sorted ranges and kept; each range's sums are one row, and the running sums over
    those rows (as many as ranges, whatever the table's size) are where each range starts. Ties in `order`
    are numbered in any order, so give a full one where it matters. NULLs come first.
    """
    columns = df.columns
    ranged = keep(df.withColumns({f"__size_{n}": c for n, c in sizes.items()})
                  .repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))
    whole = ranged.groupBy("__part").agg(*[F.sum(f"__size_{n}").alias(f"__sum_{n}") for n in sizes])
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = whole.select("__part", *[F.coalesce(F.sum(f"__sum_{n}").over(before), F.lit(0)).alias(f"__first_{n}") for n in sizes])
    inside = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (ranged.join(F.broadcast(starts), "__part")  # one row for each range
            .select(*columns, *[(F.col(f"__first_{n}") + F.sum(f"__size_{n}").over(inside) - F.col(f"__size_{n}")).alias(n) for n in sizes]))


def give_back() -> None:
    """Memory that is free in this worker goes back to the system: it goes on to other tasks, beside others of its executor."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        with suppress(AttributeError, OSError):  # another C library
            ctypes.CDLL(None).malloc_trim(0)


def arrow_rows(df: DataFrame, work: Callable[[pa.RecordBatch], Iterable[dict]], schema: str, batch: int = 2048) -> DataFrame:
    """Apply `work` to each Arrow batch; it yields dicts of equally long columns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    target = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, batch):
                for columns in work(whole.slice(at, batch)):
                    yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in target], schema=target)
        give_back()

    return df.mapInArrow(run, schema)


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system a shared path lives in, and the path inside it."""
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


def write_file(path: str, data: bytes) -> None:
    """Write under a temporary name, then rename: no reader ever sees half a file, and a repeated task replaces it whole."""
    fs, at = filesystem(path)
    fs.create_dir(at.rsplit("/", 1)[0], recursive=True)
    temporary = f"{at}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(temporary) as out:
        out.write(data)
    fs.move(temporary, at)


def read_file(path: str) -> bytes:
    fs, at = filesystem(path)
    with fs.open_input_file(at) as f:
        return f.read()
