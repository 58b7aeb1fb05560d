"""Instruction examples: instructions, contexts, prompts. A value that is null, empty or zero counts as missing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trailforge.functions.constants import INSTRUCTION_REASONS, REASON_TOPIC, WORDINGS


def truthy(c: Column, kind: str) -> Column:
    """Whether a value is there and not empty: kind is string, number, boolean or array."""
    full = {"string": c != "", "number": c != 0, "boolean": c, "array": F.size(c) > 0}[kind]
    return c.isNotNull() & F.coalesce(full, F.lit(False))


def reason_topic(reason: Column) -> Column:
    pairs = F.create_map(*[F.lit(x) for kv in REASON_TOPIC.items() for x in kv])
    return F.coalesce(F.try_element_at(pairs, F.coalesce(reason, F.lit("general"))), F.lit("general"))


def instruction(reason: Column, shorts: Column, duration: Column, layout: str) -> Column:
    words = WORDINGS[layout]
    out = F.when(truthy(shorts, "boolean") | (truthy(duration, "number") & (duration < 60)), words[0])
    for r, w in zip(INSTRUCTION_REASONS, words[1:], strict=False):
        out = out.when(reason == r, w)
    return out.otherwise(words[-1])


def _part(c: Column, kind: str, show: Column) -> Column:
    return F.when(truthy(c, kind), show)


def _label(name: str, c: Column) -> Column:
    return F.concat(F.lit(name + ": "), c)


def context(layout: str, transcript: Column, event_title: Column, url: Column, meta: dict[str, Column]) -> Column:
    """meta: title, channel, publishDate, duration, views, keywords as columns."""
    title = meta["title"] if layout == "v3" else F.when(truthy(meta["title"], "string"), meta["title"]).otherwise(event_title)
    channel = _part(meta["channel"], "string", meta["channel"] if layout == "v3" else _label("Channel", meta["channel"]))
    published = _part(meta["publishDate"], "string", _label("Published", meta["publishDate"]))
    grouped = _label("Views", F.format_number(meta["views"], 0))
    views = _part(meta["views"], "number", _label("Views", meta["views"].cast("string")) if layout == "v3" else grouped)
    most = {"v1": 5, "v2": 10}.get(layout)
    words = F.slice(meta["keywords"], 1, most) if most else meta["keywords"]
    keywords = _part(meta["keywords"], "array", _label("Keywords", F.array_join(words, ", ")))
    d = meta["duration"]
    if layout == "v1":
        duration = _part(d, "number", F.format_string("Duration: %dm %ds", F.floor(d / 60), F.pmod(d, F.lit(60))))
        parts = [_part(title, "string", _label("Title", title)), channel, published, duration, views, keywords]
    else:
        duration = _part(d, "number", F.concat(F.lit("Duration: "), d.cast("string"), F.lit("s")))
        parts = [_part(title, "string", title), channel, published, keywords, duration, views]
    made = F.concat_ws(" | ", *parts)
    if layout == "v1":
        made = F.when(made == "", F.concat(F.lit("URL: "), F.coalesce(url, F.lit("")))).otherwise(made)
    elif layout == "v2":
        made = F.when(made != "", made).when(truthy(url, "string"), F.concat(F.lit("URL: "), url)).otherwise("No context available")
    return F.when(truthy(transcript, "string"), transcript).otherwise(made)


def prompt(instruction_: Column, context_: Column) -> Column:
    return F.concat(F.lit("[INST] "), instruction_, F.lit("\n\nContext: "), context_, F.lit(" [/INST]"))


def response_of(text: Column) -> Column:
    """What follows the last end of an instruction."""
    return F.regexp_replace(F.substring_index(text, "[/INST]", -1), r"(?U)^\s+|\s+$", "")


def preview(text: Column, n: int = 200) -> Column:
    return F.when(F.length(text) > n, F.concat(F.left(text, F.lit(n)), F.lit("..."))).otherwise(text)


def masked(labels: Column, prompt_len: Column) -> Column:
    """Labels whose first prompt_len are -100."""
    return F.transform(labels, lambda x, i: F.when(i < prompt_len, F.lit(-100)).otherwise(x))
