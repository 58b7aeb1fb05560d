"""Text: redaction, cleaning, chunks, topics, similarity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailforge.functions.constants import CHUNK_SIZE, CHUNK_STEP, ERROR_TEXT, MIN_CONTEXT, NEWS_HOSTS, PII_PATTERNS, REDACTED, RESEARCH_HOSTS, RESEARCH_TEXT, TEMPLATES
from trailforge.functions.url import dev_host, has_any


def _java(p: str) -> str:
    return "(?U)" + p


def redact(text: Column) -> Column:
    for _, p in PII_PATTERNS:
        text = F.regexp_replace(text, _java(p), REDACTED)
    return text


def with_redaction(rows: DataFrame, col: str, out: str, flags: str) -> DataFrame:
    """Adds the redacted text, and the names of the patterns that matched the text as redacted so far.

    Each step is a column of its own: as one nested expression, every flag would redact anew.
    """
    kept = rows.columns
    rows = rows.withColumn("_r0", F.col(col))
    for i, (_, p) in enumerate(PII_PATTERNS):
        rows = rows.withColumn(f"_r{i + 1}", F.regexp_replace(f"_r{i}", _java(p), REDACTED))
    # No pattern matches what a replacement leaves as it was, so a change is a match.
    found = F.array_compact(F.array(*[F.when(F.col(f"_r{i}") != F.col(f"_r{i + 1}"), F.lit(n)) for i, (n, _) in enumerate(PII_PATTERNS)]))
    return rows.select(*[c for c in kept if c not in (out, flags)], F.col(f"_r{len(PII_PATTERNS)}").alias(out), F.when(F.col("_r0").isNotNull(), found).alias(flags))


def has_pii(text: Column) -> Column:
    out = F.lit(False)
    for _, p in PII_PATTERNS:
        out = out | text.rlike(_java(p))
    return out


def clean(text: Column) -> Column:
    text = F.regexp_replace(text, r"(?is)<script.*?</script>", "")
    text = F.regexp_replace(text, r"(?is)cookie(s)?( banner| notice)?.{0,100}", "")
    text = F.regexp_replace(text, r"(?is)menu.{0,100}", "")
    text = F.regexp_replace(text, r"(?U)\s+", " ")
    return F.regexp_replace(redact(text), r"(?U)^\s+|\s+$", "")


def chunks(text: Column, size: int = CHUNK_SIZE, step: int = CHUNK_STEP, least: int = MIN_CONTEXT) -> Column:
    """array<struct<idx, chunk>>: overlapping chunks that are long enough."""
    last = F.greatest(F.lit(0), F.ceil((F.length(text) - size) / step)).cast("int")
    parts = F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(i.alias("idx"), F.substring(text, i * step + 1, F.lit(size)).alias("chunk")))
    return F.filter(parts, lambda x: F.length(x["chunk"]) >= least)


def topic(domain: Column, text: Column) -> Column:
    d = F.lower(domain)
    return (
        F.when(dev_host(d), "dev")
        .when(has_any(d, NEWS_HOSTS), "news")
        .when(has_any(d, RESEARCH_HOSTS), "research")
        .when(text.rlike("(?iU)" + RESEARCH_TEXT), "research")
        .otherwise("other")
    )


def templates(topic_: Column, domain: Column, text: Column) -> Column:
    """The instructions for a page, in order."""
    qa = F.when(topic_.isin("news", "research"), F.lit(TEMPLATES[2]))
    fix = F.when(dev_host(domain) | (topic_ == "dev") | text.rlike("(?i)" + ERROR_TEXT), F.lit(TEMPLATES[3]))
    return F.array_compact(F.array(F.lit(TEMPLATES[0]), F.lit(TEMPLATES[1]), qa, fix))


def tokens(text: Column) -> Column:
    """Distinct words between white space."""
    return F.array_remove(F.array_distinct(F.split(text, r"(?U)\s+")), "")


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays of distinct words; 0 if either is empty."""
    common = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), common / (F.size(a) + F.size(b) - common)).otherwise(0.0)


def groundedness(context: Column, response: Column) -> Column:
    """Share of the response's distinct lower-case words that the context has."""
    r = tokens(F.lower(response))
    return F.when(F.size(r) > 0, F.size(F.array_intersect(tokens(F.lower(context)), r)) / F.size(r)).otherwise(0.0)
