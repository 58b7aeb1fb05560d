"""Small files beside the data: schemas, reports, texts, through Hadoop's file systems (so any shared folder will do)."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _at(spark, path)
    return fs.exists(p)


def first_existing(spark: SparkSession, paths: list[str]) -> str | None:
    return next((p for p in paths if exists(spark, p)), None)


def put(spark: SparkSession, path: str, data: bytes) -> None:
    """A small file, with its folders."""
    p, fs = _at(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(data))
    out.close()


def get(spark: SparkSession, path: str) -> bytes:
    p, fs = _at(spark, path)
    f = fs.open(p)
    try:
        return bytes(f.readAllBytes())
    finally:
        f.close()


def copy(spark: SparkSession, source: str, target: str) -> None:
    put(spark, target, get(spark, source))


def json_schema(spark: SparkSession, path: str | None) -> dict | None:
    """A schema, or None where it isn't given, doesn't exist or can't be read."""
    if not path or not exists(spark, path):
        return None
    try:
        return json.loads(get(spark, path))
    except ValueError:
        return None


def save(rows: DataFrame, write: Callable[[DataFrame], None], dry_run: bool = False) -> int | None:
    """Writes rows; in a dry run only counts them."""
    if dry_run:
        return rows.count()
    write(rows)
    return None
