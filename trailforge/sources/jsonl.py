"""JSON Lines: readers that keep the raw line (to tell absent from null), and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of an enriched event, all optional.
EVENT_SCHEMA = (
    "browser string, profile string, url string, domain string, title string, visited_at_iso string, "
    "content_meta struct<videoId:string,title:string,channel:string,channelId:string,publishDate:string,duration:bigint,views:bigint,keywords:array<string>,is_shorts:boolean,caption_language:string>, "
    "transcript_excerpt string, session_id string, time_of_day string, day_of_week string, duration_hint bigint, labels struct<reason:string,topics:array<string>>"
)


def lines(spark: SparkSession, path: str) -> DataFrame:
    """_raw of every line that isn't blank."""
    return spark.read.text(path).select(F.trim("value").alias("_raw")).where("_raw <> ''")


def parse(rows: DataFrame, schema: str = EVENT_SCHEMA, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """Good rows (_raw and the columns) and bad lines (_raw). strict: a bad line fails the query instead.

    Any JSON object is a good row: a value of another type than its column's is null there, and still in _raw.
    """
    mode = {"mode": "FAILFAST"} if strict else {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    full = schema if strict else f"{schema}, _bad string"
    parsed = rows.withColumn("_e", F.from_json("_raw", full, mode))
    if strict:
        return parsed.select("_raw", "_e.*"), rows.limit(0)
    object_ = F.col("_raw").startswith("{") & F.expr("try_parse_json(_raw)").isNotNull() & F.col("_e").isNotNull()
    return parsed.where(object_).select("_raw", "_e.*").drop("_bad"), parsed.where(~F.coalesce(object_, F.lit(False))).select("_raw")


def read_events(spark: SparkSession, path: str, require: tuple[str, ...] = ()) -> DataFrame:
    """Lenient reader; rows without one of the required keys are left out."""
    good, _ = parse(lines(spark, path))
    for key in require:
        good = good.where(F.array_contains(F.json_object_keys("_raw"), key))
    return good


def write(rows: DataFrame, path: str, by: str | None = None) -> None:
    """JSON Lines with nulls kept; by: one folder for each value of a column (which stays in the rows)."""
    if by:
        rows.withColumn("_part", F.col(by)).write.mode("overwrite").partitionBy("_part").option("ignoreNullFields", "false").json(path)
    else:
        rows.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_split_files(rows: DataFrame, path: str, split: str = "split_hint") -> None:
    """A folder dataset_<split> for each split, in one pass over each."""
    for name in ("train", "val", "test"):
        rows.where(F.col(split) == name).write.mode("overwrite").option("ignoreNullFields", "false").json(f"{path}/dataset_{name}")


def write_report(row: DataFrame, path: str) -> None:
    """A report of one row as a JSON document."""
    row.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
