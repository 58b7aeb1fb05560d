"""SQLite as a Spark data source (``spark.read.format("sqlite")``), and the browsers' histories in it.

The source reads one query or table. With ``parts`` above 1 the rows are dealt by an integer column, ``by`` (of a table, its
rowid, unless another is named), so that each task reads its own. Files are read where they lie by the workers, read-only
and immutable: on a cluster they must be in a folder that all hosts see.
"""

from __future__ import annotations

import sqlite3
import tempfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from trailforge.functions import time as T
from trailforge.functions.constants import SESSION_STREAMS


class SqliteSource(DataSource):
    """Options: path, query (or dbtable), parts, by. The schema has to be given or is read off the query's first rows."""

    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def query(self) -> str:
        return self.options.get("query") or f'SELECT * FROM "{self.options["dbtable"]}"'

    def schema(self) -> str:
        with _open(self.options["path"]) as db:
            cur = db.execute(f"SELECT * FROM ({self.query()}) LIMIT 100")
            rows = cur.fetchall()
            kinds = {int: "bigint", float: "double", str: "string", bytes: "binary"}
            out = []
            for i, d in enumerate(cur.description):
                found = {kinds[type(r[i])] for r in rows if r[i] is not None} or {"string"}
                kind = found.pop() if len(found) == 1 else "double" if found <= {"bigint", "double"} else "string"
                out.append(f"`{d[0]}` {kind}")
        return ", ".join(out)

    def reader(self, schema) -> DataSourceReader:
        parts, by = int(self.options.get("parts", "1")), self.options.get("by") or ("rowid" if "query" not in self.options else None)
        if parts > 1 and by is None:
            raise ValueError("a query that is read in parts needs the option by")
        return SqliteReader(self.options["path"], self.query(), parts, by, schema)


class SqliteReader(DataSourceReader):
    def __init__(self, path: str, query: str, parts: int, by: str | None, schema):
        self.path, self.query, self.parts, self.by, self.kinds = path, query, parts, by, [f.dataType.simpleString() for f in schema]

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(i) for i in range(self.parts)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        casts = {"string": str, "bigint": int, "int": int, "double": float}
        query = self.query
        if self.parts > 1:
            own = f'coalesce(abs("{self.by}") % {self.parts}, 0) = {partition.value}'
            query = f"{query} WHERE {own}" if self.by == "rowid" else f"SELECT * FROM ({query}) WHERE {own}"
        with _open(self.path) as db:
            for row in db.execute(query):
                yield tuple(None if v is None else casts.get(k, lambda x: x)(v) for v, k in zip(row, self.kinds, strict=True))


def _open(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro&immutable=1", uri=True)


def snapshot(source: str, strict: bool = True, folder: str | None = None) -> str | None:
    """A checked copy of a database that may be in use; None (or an error, if strict) where that can't be made.

    Copied by the backup interface, or where that fails by VACUUM INTO. folder: where workers are to find it.
    """
    target = str(Path(tempfile.mkdtemp(prefix="snapshot-", dir=folder)) / Path(source).name)
    try:
        with sqlite3.connect(f"file:{source}?mode=ro", uri=True) as a:
            try:
                with sqlite3.connect(target) as b:
                    a.backup(b)
            except sqlite3.Error:
                Path(target).unlink(missing_ok=True)
                a.execute("VACUUM INTO ?", (target,))
        with sqlite3.connect(target) as b:
            for check in ("quick_check", "integrity_check"):
                if (found := b.execute(f"PRAGMA {check}").fetchone()[0]) != "ok":
                    raise sqlite3.DatabaseError(f"{source} is damaged: {found}")
        return target
    except sqlite3.Error:
        if strict:
            raise
        return None


def safari_history(path: str | None = None, home: str | None = None) -> str | None:
    """The named history, or the one below the home folder; None where it doesn't exist."""
    found = Path(path) if path else Path(home or Path.home()) / "Library" / "Safari" / "History.db"
    return str(found) if found.exists() else None


def tables(path: str) -> set[str]:
    with _open(path) as db:
        return {r[0] for r in db.execute("SELECT name FROM sqlite_master WHERE type = 'table'")}


def read(spark: SparkSession, path: str, query: str, schema: str | None = None) -> DataFrame:
    spark.dataSource.register(SqliteSource)
    reader = spark.read.format("sqlite").option("path", path).option("query", query)
    return (reader.schema(schema) if schema else reader).load()


#: How each engine keeps its visits: tables that tell it, its query, and its column of the time.
_ENGINES = {
    "chrome": ({"urls", "visits"}, "SELECT u.url, u.title, v.visit_time AS t, u.visit_count FROM urls u JOIN visits v ON u.id = v.url"),
    "firefox": ({"moz_places", "moz_historyvisits"}, "SELECT p.url, p.title, v.visit_date AS t, NULL AS visit_count FROM moz_places p JOIN moz_historyvisits v ON p.id = v.place_id"),
    "safari": ({"history_items", "history_visits"}, "SELECT i.url, COALESCE(v.title, '') AS title, v.visit_time AS t, NULL AS visit_count FROM history_items i JOIN history_visits v ON i.id = v.history_item"),
}
_TIMES = {"chrome": T.from_chromium, "firefox": T.from_firefox, "safari": T.from_safari}


def engine(path: str) -> str:
    t = tables(path)
    for kind, (own, _) in _ENGINES.items():
        if own <= t:
            return kind
    raise ValueError(f"no known history in {path}: {sorted(t)}")


def _visits(spark: SparkSession, path: str, kind: str, query: str, limit: int | None, profile: str | None) -> DataFrame:
    if limit:
        query = f"SELECT * FROM ({query}) ORDER BY t DESC, url LIMIT {int(limit)}"
    rows = read(spark, path, query, f"url string, title string, t {'double' if kind == 'safari' else 'bigint'}, visit_count int")
    iso = _TIMES[kind](F.col("t"))
    return rows.select(F.lit(kind).alias("browser"), F.lit(profile).cast("string").alias("profile"), "url", "title", iso.alias("visited_at_iso"), "visit_count", F.lit(path).alias("source_path"))


def history(spark: SparkSession, path: str, limit: int | None = None, profile: str | None = "Default") -> DataFrame:
    """browser, profile, url, title, visited_at_iso, visit_count, source_path of a history's visits; the engine is told by its tables."""
    kind = engine(path)
    return _visits(spark, path, kind, _ENGINES[kind][1], limit, profile)


def chrome_urls(spark: SparkSession, path: str, limit: int = 1000, profile: str | None = None) -> DataFrame:
    """The same columns, one row for each url, at the time it was last visited (whole seconds)."""
    rows = _visits(spark, path, "chrome", "SELECT url, title, last_visit_time AS t, visit_count FROM urls", limit, profile)
    return rows.withColumn("visited_at_iso", F.regexp_replace("visited_at_iso", r"[.][0-9]+Z$", "Z"))


def safari_recent(spark: SparkSession, path: str, most: int = 50, tried: int = 100) -> DataFrame:
    """url, title of the latest visits that have a url; of a history without visits, of its most visited items."""
    visits = "SELECT i.url, v.title, v.visit_time AS t FROM history_visits v JOIN history_items i ON v.history_item = i.id"
    items = "SELECT url, NULL AS title, visit_count AS t FROM history_items"
    query = f"SELECT * FROM ({visits if 'history_visits' in tables(path) else items}) ORDER BY t DESC, url LIMIT {int(tried)}"
    rows = read(spark, path, f"SELECT * FROM ({query}) WHERE url <> '' LIMIT {int(most)}", "url string, title string, t double")
    return rows.select("url", F.coalesce("title", F.lit("Untitled")).alias("title"))


def sessions(spark: SparkSession, path: str) -> DataFrame:
    """stream, value, start, end of activity sessions, times in UTC."""
    names = ", ".join(f"'{s}'" for s in SESSION_STREAMS)
    query = f"SELECT ZSTREAMNAME AS stream, ZVALUESTRING AS value, ZSTARTDATE AS s, ZENDDATE AS e FROM ZOBJECT WHERE ZSTREAMNAME IN ({names}) AND ZSTARTDATE IS NOT NULL AND ZENDDATE IS NOT NULL"
    rows = read(spark, path, query, "stream string, value string, s double, e double")
    at = lambda c: F.timestamp_micros(F.rint(F.col(c) * 1e6).cast("long") + T.EPOCH_2001)
    return rows.select("stream", "value", at("s").alias("start"), at("e").alias("end"))


def profiles(base: str) -> list[str]:
    """Histories of the profiles under a browser's folder."""
    found = [p / "History" for p in Path(base).iterdir() if p.name == "Default" or p.name.startswith("Profile ")] if Path(base).is_dir() else []
    return sorted(str(p) for p in found if p.exists())
