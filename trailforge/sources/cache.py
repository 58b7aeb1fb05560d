"""Page texts by hashed url, browser caches, suffix rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Cache files larger than this aren't searched.
MAX_CACHE_BYTES = 10 * 1024 * 1024
_PLAYER = (
    r"(?s)var ytInitialPlayerResponse\s*=\s*(\{.*?\});",
    r"(?s)ytInitialPlayerResponse\s*=\s*(\{.*?\});",
    r'(?s)window\["ytInitialPlayerResponse"\]\s*=\s*(\{.*?\});',
)


def page_texts(spark: SparkSession, folder: str) -> DataFrame:
    """cache_key, text of the files <sha256 of the canonical url>.txt."""
    rows = spark.read.text(f"{folder}/*.txt", wholetext=True)
    return rows.select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.txt$", 1).alias("cache_key"), F.col("value").alias("text"))


def player_response(html: Column) -> Column:
    """content_meta of a video page; null without a video's id. The first pattern whose JSON has an id counts."""

    def of(pattern: str) -> Column:
        j = F.regexp_extract(html, pattern, 1)
        d = lambda p: F.get_json_object(j, f"$.{p}")
        length = d("videoDetails.lengthSeconds").try_cast("bigint")
        short = F.coalesce(F.lower(d("videoDetails.shortDescription")).contains("shorts"), F.lit(False)) | F.coalesce(length < 60, F.lit(False))
        return F.when(
            d("videoDetails.videoId").isNotNull(),
            F.struct(
                d("videoDetails.videoId").alias("videoId"),
                d("videoDetails.title").alias("title"),
                d("videoDetails.author").alias("channel"),
                d("videoDetails.channelId").alias("channelId"),
                d("microformat.playerMicroformatRenderer.publishDate").alias("publishDate"),
                length.alias("duration"),
                d("videoDetails.viewCount").try_cast("bigint").alias("views"),
                F.from_json(d("videoDetails.keywords"), "array<string>").alias("keywords"),
                short.alias("is_shorts"),
                d("captions.playerCaptionsTracklistRenderer.captionTracks[0].languageCode").alias("caption_language"),
            ),
        )

    return F.coalesce(*map(of, _PLAYER))


def cached_pages(spark: SparkSession, folder: str) -> DataFrame:
    """profile, path, html of the video pages in browser caches, at any depth below a folder of profiles."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    small = files.where((F.col("length") <= MAX_CACHE_BYTES) & F.col("path").rlike("/[^/]+/Cache/.+$"))
    html = small.select(F.regexp_extract("path", r"/([^/]+)/Cache/.+$", 1).alias("profile"), "path", F.decode("content", "UTF-8").alias("html"))
    return html.where(F.col("html").contains("ytInitialPlayerResponse"))


def video_pages(spark: SparkSession, folder: str) -> DataFrame:
    """profile, path, video_id, content_meta of the video pages that name their video."""
    found = cached_pages(spark, folder).withColumn("content_meta", player_response(F.col("html")))
    return found.where("content_meta is not null").select("profile", "path", F.col("content_meta.videoId").alias("video_id"), "content_meta")


def suffix_rules(spark: SparkSession, path: str) -> tuple[list[str], list[str]]:
    """Rules and exceptions of a suffix file: a list of some ten thousand lines, whatever the data's size."""
    rows = spark.read.text(path).select(F.trim("value").alias("v")).where("v <> '' and not startswith(v, '//')").collect()
    return [r["v"] for r in rows if not r["v"].startswith("!")], [r["v"][1:] for r in rows if r["v"].startswith("!")]
