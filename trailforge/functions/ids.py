"""Ids and splits by hash."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def source_id(url: Column, title: Column) -> Column:
    return F.sha2(F.concat(url, F.coalesce(title, F.lit(""))), 256)


def event_id_v1(browser: Column, profile: Column, url: Column, ts: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws(":", *(_text(c) for c in (browser, profile, url, ts))), 256), 1, 16)


def event_id_v2(browser: Column, profile: Column, url: Column, ts: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws("|", *(_text(c) for c in (url, ts, browser, profile))), 256), 1, 16)


def _text(c: Column) -> Column:
    """A key that is there and null prints as None."""
    return F.coalesce(c, F.lit("None"))


def chunk_id(source: Column, n: Column) -> Column:
    return F.format_string("%s#c%03d", source, n.cast("int"))


def md5_mod100(c: Column) -> Column:
    """The md5 as a number of 128 bits, modulo 100, by its two halves (2 ** 64 is 16 modulo 100)."""
    half = lambda i: F.conv(F.substring(F.md5(c), i, 16), 16, 10).cast("decimal(20,0)") % 100
    return ((half(1) * 16 + half(17)) % 100).cast("int")


def hash_split(c: Column) -> Column:
    m = md5_mod100(c)
    return F.when(m < 80, "train").when(m < 90, "val").otherwise("test")
