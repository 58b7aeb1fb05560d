"""CSV with log lines around the data, and CSV sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of a raw visit, in order.
VISIT_COLUMNS = ("browser", "profile", "url", "title", "visited_at_iso", "visit_count", "source_path", "snapshot_path")


def read_visits(spark: SparkSession, path: str) -> DataFrame:
    """Visits of a CSV file that may have log lines before and after the rows. Rows without a url are left out.

    A record is a line: cells with line breaks in them aren't read (the writer of such files gives none).
    """
    header = ",".join(VISIT_COLUMNS)
    schema = ", ".join(f"{c} {'int' if c == 'visit_count' else 'string'}" for c in VISIT_COLUMNS)
    rows = spark.read.text(path).where(~F.col("value").startswith("[") & (F.trim("value") != "") & (F.col("value") != header))
    return rows.select(F.from_csv("value", schema, {"escape": '"', "mode": "PERMISSIVE"}).alias("v")).select("v.*").where("url is not null and url <> ''")


def write(rows: DataFrame, path: str, quote_all: bool = False) -> None:
    rows.write.mode("overwrite").option("header", True).option("escape", '"').option("quoteAll", quote_all).csv(path)


#: Columns of the golden table, in order.
GOLDEN_COLUMNS = (
    "url", "title", "browser", "profile", "domain", "visited_at_iso", "time_of_day", "day_of_week", "session_id", "duration_hint", "label_reason", "label_topics",
    "content_meta_videoId", "content_meta_title", "content_meta_channel", "content_meta_duration", "content_meta_views", "content_meta_is_shorts",
)


def _cell(c: Column) -> Column:
    """A value as a CSV writer of Python prints it: null as '', booleans with a capital."""
    return F.coalesce(c.cast("string"), F.lit(""))


def _flag(c: Column) -> Column:
    return F.when(c, "True").when(~c, "False").otherwise("")


def golden_rows(events: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Events as flat rows of 18 columns: nested data by path, topics joined, nulls as ''."""
    m = F.col("content_meta")
    cells = {c: _cell(F.col(c)) for c in GOLDEN_COLUMNS[:10]}
    cells |= {"label_reason": _cell(F.col("labels.reason")), "label_topics": F.coalesce(F.array_join("labels.topics", ", "), F.lit(""))}
    cells |= {f"content_meta_{c}": _cell(m[c]) for c in ("videoId", "title", "channel", "duration", "views")}
    cells["content_meta_is_shorts"] = _flag(m["is_shorts"])
    return events.select(*keep, *(cells[c].alias(c) for c in GOLDEN_COLUMNS))


def two_digits(x: Column) -> Column:
    """A share from 0 to 1 with two digits, rounded by its binary value, as Python prints it.

    Only odd multiples of 1/200 lie (nearly) half way; for these the text is looked up, others are formatted.
    """
    half_way = F.array(*[F.lit(f"{j / 200:.2f}") for j in range(1, 201, 2)])
    j = F.rint(x * 200).cast("int")
    tie = (F.pmod(j, F.lit(2)) == 1) & (x == j / F.lit(200.0))
    return F.when(tie, F.get(half_way, F.floor(j / 2).cast("int"))).otherwise(F.format_string("%.2f", x))


def validation_rows(examples: DataFrame) -> DataFrame:
    """chunk_id, length_ok, groundedness_score, dedup_flag, split of examples."""
    from trailforge.functions.constants import MIN_CONTEXT
    from trailforge.functions.text import groundedness

    return examples.select(
        F.col("meta.chunk_id").alias("chunk_id"),
        (F.length("context") >= MIN_CONTEXT).cast("int").alias("length_ok"),
        two_digits(groundedness(F.col("context"), F.col("response"))).alias("groundedness_score"),
        F.lit(0).alias("dedup_flag"),
        F.col("meta.split_hint").alias("split"),
    )


def raw_rows(events: DataFrame) -> DataFrame:
    """Events as one flat row each: nested columns as JSON, all others as text."""
    nested = ("struct", "array", "map")
    return events.select(*[(F.to_json(c) if f.dataType.typeName() in nested else F.col(c).cast("string")).alias(c) for c, f in ((f.name, f) for f in events.schema.fields) if not c.startswith("_")])


def export_rows(visits: DataFrame) -> DataFrame:
    """URL, Title, VisitDate of visits; to be written with every cell quoted."""
    return visits.select(F.col("url").alias("URL"), F.coalesce("title", F.lit("Untitled")).alias("Title"), F.col("visited_at_iso").alias("VisitDate"))


def read_any(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Rows of a CSV (by its suffix, any header) or JSON Lines file that have a url, and one row: warnings (lines left out).

    JSON lines give all their keys as text, nested values as JSON; the keys are those of the first pass over the lines.
    """
    if path.lower().endswith(".csv"):
        rows = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
        bad = spark.createDataFrame([], "n long")
    else:
        from trailforge.sources import jsonl

        lines = jsonl.lines(spark, path)
        fine = F.col("_m").isNotNull()
        parsed = lines.withColumn("_m", F.from_json("_raw", "map<string,string>"))
        bad = parsed.where(~fine).select(F.lit(1).cast("long").alias("n"))
        keys = [r["k"] for r in parsed.where(fine).select(F.explode(F.map_keys("_m")).alias("k")).distinct().orderBy("k").collect()]  # column names
        rows = parsed.where(fine).select(*[F.col("_m")[k].alias(k) for k in keys])
    if "url" not in rows.columns:
        rows = rows.withColumn("url", F.lit(None).cast("string"))
    has = F.col("url").isNotNull() & (F.col("url") != "")
    warnings = rows.where(~has).select(F.lit(1).cast("long").alias("n")).unionByName(bad).agg(F.count("*").alias("warnings"))
    return rows.where(has), warnings
