"""URLs as columns. Split by the RFC 3986 appendix expression, which takes any string, not by a strict parser."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trailforge.functions.constants import DEV_HOSTS, HIGH_RISK_WORDS, TRACKING_PARAMS

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"
_AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"
_PATH = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)"
_QUERY = r"^[^?#]*\?([^#]*)"


def authority(url: Column) -> Column:
    """The authority in lower case, '' without one."""
    return F.lower(F.regexp_extract(url, _AUTHORITY, 1))


def normal_domain(url: Column) -> Column:
    """Authority, lower case, without one leading www."""
    return F.regexp_replace(authority(url), r"^www\.", "")


def last_two_labels(url: Column) -> Column:
    """Last two labels of the host without port."""
    host = F.substring_index(authority(url), ":", 1)
    labels = F.split(host, r"\.")
    return F.when(F.size(labels) >= 2, F.array_join(F.slice(labels, -2, 2), ".")).otherwise(host)


def _decoded(part: Column) -> Column:
    return F.coalesce(F.try_url_decode(part), F.regexp_replace(part, r"\+", " "))


def _encoded(part: Column) -> Column:
    return F.replace(F.replace(F.url_encode(part), F.lit("%7E"), F.lit("~")), F.lit("*"), F.lit("%2A"))


def canonical(url: Column) -> Column:
    """Lower scheme (https if none) and authority, no www., no tracking or blank parameters, no trailing slashes, no fragment."""
    scheme = F.lower(F.regexp_extract(url, _SCHEME, 1))
    scheme = F.when(scheme == "", F.lit("https")).otherwise(scheme)
    path = F.regexp_extract(url, _PATH, 1)
    path = F.regexp_replace(F.regexp_replace(path, r";[^/]*$", ""), r"/+$", "")
    pairs = F.split(F.regexp_extract(url, _QUERY, 1), "&")

    def pair(p: Column) -> Column:
        return F.struct(_decoded(F.substring_index(p, "=", 1)).alias("k"), _decoded(F.regexp_replace(p, "^[^=]*=", "")).alias("v"))

    fine = F.filter(pairs, lambda p: p.rlike("=."))
    kept = F.filter(F.transform(fine, pair), lambda x: ~x["k"].isin(*TRACKING_PARAMS))
    query = F.array_join(F.transform(kept, lambda x: F.concat(_encoded(x["k"]), F.lit("="), _encoded(x["v"]))), "&")
    query = F.when(query == "", "").otherwise(F.concat(F.lit("?"), query))
    rooted = url.rlike(_AUTHORITY) | path.startswith("/")
    host = F.when(url.rlike(_AUTHORITY), F.concat(F.lit("//"), normal_domain(url))).otherwise(F.when(rooted, F.lit("//")).otherwise(""))
    return F.when(url.isNotNull(), F.concat(scheme, F.lit(":"), host, path, query))


def etld1(domain: Column, rules: list[str], exceptions: list[str]) -> Column:
    """Registrable domain by suffix rules: the longest suffix that a rule names, and one label more."""
    d = F.regexp_replace(F.lower(domain), r"^\.+|\.+$", "")
    labels = F.split(d, r"\.")
    plain = F.array(*map(F.lit, [r for r in rules if not r.startswith("*.")] + exceptions)) if rules or exceptions else F.array().cast("array<string>")
    wild = [r[2:] for r in rules if r.startswith("*.")]

    def hit(i: Column) -> Column:
        suffix = F.array_join(F.slice(labels, i, F.size(labels)), ".")
        found = F.array_contains(plain, suffix)
        for w in wild:
            found = found | (suffix.endswith("." + w) & (F.size(labels) - i + 1 > w.count(".") + 1))
        return found

    at = F.get(F.filter(F.sequence(F.lit(1), F.size(labels)), hit), F.lit(0))
    by_rule = F.when(at > 1, F.array_join(F.slice(labels, at - 1, F.size(labels)), ".")).when(at == 1, d)
    two = F.when(F.size(labels) >= 2, F.array_join(F.slice(labels, -2, 2), ".")).otherwise(d)
    return F.coalesce(by_rule, two)


def has_any(c: Column, words: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | c.contains(w)
    return out


def high_risk(domain: Column) -> Column:
    return has_any(F.lower(domain), HIGH_RISK_WORDS)


def dev_host(domain: Column) -> Column:
    return has_any(domain, DEV_HOSTS)


def is_youtube(url: Column) -> Column:
    return url.contains("youtube.com") | url.contains("youtu.be")


def video_id(url: Column) -> Column:
    """Id of a watch or short link; null for others."""
    watch = F.regexp_extract(url, r"[?&]v=([^&#]+)", 1)
    short = F.regexp_extract(url, r"youtu\.be/([^?&]*)", 1)
    return F.when(url.contains("youtube.com/watch"), F.nullif(watch, F.lit(""))).when(url.contains("youtu.be/"), F.nullif(short, F.lit("")))
