"""Shared pieces of the training-data operators: shared folder, cut of lineage, Arrow helpers."""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailforge.shared import give_back, new_path, shared_dir, written  # noqa: F401 (used by the operators)

#: Rows of one Arrow batch sent to Python. Texts may be long, so batches are kept short.
ARROW_ROWS = 512


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one, for files that tasks write."""
    path = new_path(spark, name)
    fs, at = files_at(path)
    fs.create_dir(at, recursive=True)
    return path


def small_batches(spark: SparkSession) -> None:
    """Bound the memory of an Arrow batch by rows; a lower setting of the user stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def crc_mod(col: str, n: int) -> Column:
    """crc32 of the id's decimal text, modulo n. Null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")) % n


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """Texts of a batch, null as empty."""
    return [t or "" for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def ints_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


Batches = Iterator[pa.RecordBatch]


def files_at(path: str):
    """A file system and the path in it, for a shared folder's URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if ":/" in path else f"file://{path}")


def put_file(folder: str, name: str, data: bytes, attempt: int) -> None:
    """Write a whole file under a temporary name, then rename it. A task that runs again puts the same bytes there."""
    fs, at = files_at(folder)
    with fs.open_output_stream(f"{at}/_tmp-{attempt}-{name}", compression=None) as out:
        out.write(data)
    fs.move(f"{at}/_tmp-{attempt}-{name}", f"{at}/{name}")


def map_file(folder: str, name: str):
    """A file of the shared folder as mapped bytes; from a store that can't be mapped, by way of a local copy."""
    import mmap
    import os

    fs, at = files_at(folder)
    if fs.type_name == "local":
        local = f"{at}/{name}"
    else:
        # A worker's own cache of a file that is whole in the store; every host makes its own, a lost one is made anew.
        local = f"{tempfile.gettempdir()}/{name}-{hashlib.sha256(folder.encode()).hexdigest()[:16]}"
        if not os.path.exists(local):
            with fs.open_input_stream(f"{at}/{name}", compression=None) as f, open(f"{local}.{os.getpid()}", "wb") as out:
                while part := f.read(1 << 20):
                    out.write(part)
            os.replace(f"{local}.{os.getpid()}", local)
    with open(local, "rb") as f:
        return mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
