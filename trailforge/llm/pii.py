"""Personal data: high-recall generators, boosted trees over format and context, calibrated thresholds. DataFrame only.

Generators are regular expressions. A text's matches and the gaps between them (``regexp_extract_all`` and ``split`` by
the same expression) give every match's place in code points without leaving the JVM, and the gaps' ends are the
context. The four base kinds (e-mail, IP, card, phone) are checked by rule and always kept. The other generators
propose spans, which may overlap, by format alone: e-mails in disguise, secrets behind a name, and any number written
in groups. Boosted trees, fitted in numpy on generated sentences that run through the same expressions, become one SQL
expression; each generator has a threshold of its own, set on sentences of other patterns than those that were fitted.
Chosen spans that overlap a base span or an earlier generator's chosen span are left out.

All is computed row by row: no shuffle, no state, no Python on the executors.

Defined results: null text counts as empty and has no span; repeated rows give one row each; a null id stays null; an
empty table gives no rows; extra columns are ignored. Quantifiers are possessive where that can't change a match, so
very long runs are read once and don't recurse.
"""

from __future__ import annotations

import re
from functools import lru_cache, reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A match may begin inside a run of its characters only where the match before ended: hence \G.
_RUN = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{_RUN})){_RUN}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
PROPOSED = {
    "email2": rf"(?i)(?<!{_RUN}){_RUN}++ ?[\[(]at[\])] ?[A-Za-z0-9-]++(?: ?(?:[\[(]dot[\])]|\.) ?[A-Za-z0-9-]++)++",
    "secret": r"(?i)(?:token|key|secret|password|passwd|bearer)[\"']?\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9_/+=-]{8,}+",
    "number": r"(?<![0-9A-Za-z])[(]?[0-9](?:[ ().-]{0,2}[0-9])++",
}
#: Kind under which a generator's chosen spans are reported.
KIND = {"email2": "email", "secret": "secret", "number": "phone"}
KINDS = ("email", "ip", "card", "phone", "secret")
#: Anything that any generator can match has one of these; other texts skip the work.
_MAYBE = r"(?i)[0-9@]|[\[(]at[\])]|(?:token|key|secret|password|passwd|bearer)[\"']?\s{0,3}[=:]"
_OCTET = "(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2}))"
_BLOCK = 256
BEFORE, AFTER = 24, 8


def matches(text: Column, pattern: str) -> Column:
    """array<struct<s, e, m, before, after>>: matches from left to right, places in code points.

    Places are running sums, taken inside blocks of matches; then blocks are moved by the sums of those before them. So
    the arrays copied on the way stay short, and the work grows with the number of matches.
    """
    p = F.lit(pattern)
    found = F.struct(F.regexp_extract_all(text, p, 0).alias("ms"), F.split(text, pattern, -1).alias("gs"))
    zero = F.lit(0)
    span = "struct<s:int,e:int,m:string,before:string,after:string>"
    block = f"struct<n:int,out:array<{span}>>"

    def one(v: Column) -> Column:
        ms, gs = v["ms"], v["gs"]

        def add(acc: Column, i: Column) -> Column:
            gap, m = F.get(gs, i), F.get(ms, i)
            s = acc["n"] + F.length(gap)
            e = s + F.length(m)
            item = F.struct(s.cast("int").alias("s"), e.cast("int").alias("e"), m.alias("m"), F.lower(F.right(gap, F.lit(BEFORE))).alias("before"), F.left(F.get(gs, i + 1), F.lit(AFTER)).alias("after"))
            return F.struct(e.cast("int").alias("n"), F.concat(acc["out"], F.array(item)).alias("out"))

        def inside(b: Column) -> Column:
            at = F.sequence(b * _BLOCK, F.least(b * _BLOCK + _BLOCK, F.size(ms)) - 1)
            return F.aggregate(at, F.struct(zero.alias("n"), F.array().cast(f"array<{span}>").alias("out")).cast(block), add)

        def moved(bs: Column) -> Column:
            # Where each block begins; one number a block.
            begins = F.aggregate(bs, F.array(zero), lambda acc, b: F.concat(acc, F.array((F.element_at(acc, -1) + b["n"]).cast("int"))))

            def move(at: Column) -> Column:
                def by(b: Column, i: Column) -> Column:
                    n = F.get(at, i)
                    return F.transform(b["out"], lambda x: F.struct((x["s"] + n).alias("s"), (x["e"] + n).alias("e"), x["m"].alias("m"), x["before"].alias("before"), x["after"].alias("after")))

                return F.flatten(F.transform(bs, by))

            return F.get(F.transform(F.array(begins), move), zero)

        blocks = F.transform(F.sequence(zero, F.floor((F.size(ms) - 1) / _BLOCK).cast("int")), inside)
        found_ = F.get(F.transform(F.array(blocks), moved), zero)
        return F.when(F.size(ms) > 0, found_).otherwise(F.array().cast(f"array<{span}>"))

    return F.get(F.transform(F.array(found), one), zero)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(d: Column) -> Column:
    """luhn_check takes digits only, and any number of them."""
    return F.call_function("luhn_check", d)


def _valid(kind: str) -> Column | None:
    def check(x: Column) -> Column:
        m = x["m"]
        if kind == "ip":
            return m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
        n = F.length(_digits(m))
        if kind == "card":
            return n.between(13, 19) & _luhn(_digits(m))
        return n.between(9, 15) if kind == "phone" else F.lit(True)

    return check


#: Format and context of a candidate. All are numbers.
FEATURES: dict[str, callable] = {
    "length": lambda x: F.length(x["m"]),
    "digits": lambda x: F.length(_digits(x["m"])),
    "letters": lambda x: F.length(F.regexp_replace(x["m"], "[^A-Za-z]", "")),
    "groups": lambda x: F.size(F.split(x["m"], "[^A-Za-z0-9]+", -1)),
    "kinds": lambda x: F.size(F.array_distinct(F.split(x["m"], "", -1))),
    "bracket": lambda x: x["m"].rlike(r"^\(").cast("int"),
    "tail4": lambda x: x["m"].rlike("[ .-][0-9]{4}$").cast("int"),
    "date": lambda x: x["m"].rlike(r"^(?:[0-9]{4}[-. ][0-9]{1,2}[-. ][0-9]{1,2}|[0-9]{1,2}[-. ][0-9]{1,2}[-. ][0-9]{4})").cast("int"),
    "dots": lambda x: F.length(F.regexp_replace(x["m"], "[^.]", "")),
    "hex": lambda x: x["m"].rlike("[0-9a-fA-F]{32,}").cast("int"),
    "mixed": lambda x: (x["m"].rlike("[0-9].*[A-Za-z]|[A-Za-z].*[0-9]")).cast("int"),
    "luhn": lambda x: F.when(F.length(_digits(x["m"])).between(13, 19), _luhn(_digits(x["m"])).cast("int")).otherwise(0),
    "says_phone": lambda x: x["before"].rlike("tel|phone|call|mobile|cell|fax|sms").cast("int"),
    "says_other": lambda x: x["before"].rlike("order|isbn|version|page|no\\.|#|\\$|id|date|commit|section").cast("int"),
    "says_mail": lambda x: x["before"].rlike("mail|contact|write|reach").cast("int"),
    "ends_word": lambda x: x["after"].rlike("^(?:$|[\\s,.;:!?)\"'])").cast("int"),
}


def _featured(c: Column) -> Column:
    return F.transform(c, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), *(f(x).cast("double").alias(k) for k, f in FEATURES.items())))


# --- the model -------------------------------------------------------------------------------------------------------


def _digits_of(k: int, n: int) -> str:
    return f"lpad(cast(pmod(xxhash64(id, {k}), {10**n}) as string), {n}, '0')"


def _one_of(k: int, values: tuple[str, ...]) -> str:
    return f"element_at(array({', '.join(repr(v) for v in values)}), cast(pmod(xxhash64(id, {k}), {len(values)}) + 1 as int))"


def sentence(pattern: str) -> str:
    """SQL of a generated sentence: {d3:1} stands for three digits, {w:4} for a word, {h:9} for hexadecimal digits; the last number tells equal ones apart."""
    words = ("north", "maria", "jo.w", "list", "quiet", "river", "stan", "k9", "olive", "paul", "the", "team", "and", "report", "then", "garden")
    out = []
    for part in re.split(r"(\{[^}]*\})", pattern):
        if m := re.fullmatch(r"\{d(\d+):(\d+)\}", part):
            out.append(_digits_of(int(m[2]), int(m[1])))
        elif m := re.fullmatch(r"\{w:(\d+)\}", part):
            out.append(_one_of(int(m[1]), words))
        elif m := re.fullmatch(r"\{h:(\d+)\}", part):
            out.append(f"substring(sha2(concat(id, '{m[1]}'), 256), 1, 20 + cast(pmod(xxhash64(id, {m[1]}), 21) as int))")
        elif part:
            out.append("'" + part.replace("\\", "\\\\").replace("'", "\\'") + "'")
    return " || ".join(out)


#: Patterns of sentences, and the generator whose candidate in them is personal data ("": none is).
FIT = (
    ("number", "please call ({d3:1}) {d3:2}-{d4:3} today"),
    ("number", "tel: {d3:1}-{d3:2}-{d4:3}"),
    ("number", "{w:4} mobile {d4:1} {d6:2}, {w:5}"),
    ("number", "{w:4} ({d3:1}) {d3:2}-{d4:3} {w:5}"),
    ("number", "{w:4} {w:6} {d3:1}-{d3:2}-{d4:3}, {w:5}"),
    ("number", "fax {d3:1}.{d3:2}.{d4:3} or {w:4}"),
    ("", "built on 20{d2:1}-0{d1:2}-1{d1:3} by {w:4}"),
    ("", "order {d8:1} for {w:4}"),
    ("", "isbn 978-{d1:1}-{d4:2}-{d4:3}-{d1:6}"),
    ("", "{w:4} {d8:1}{d8:2} {w:5}"),
    ("", "{w:4} version {d1:1}.{d1:2}.{d2:3} {w:5}"),
    ("", "{w:4} in 19{d2:1}-{d2:2} {w:5}"),
    ("", "{w:4} {d3:1} {d2:2} {w:5}"),
    ("", "{w:4} costs ${d3:1}.{d2:2} {w:5}"),
    ("", "{w:4} {w:5} {d2:1} {w:6}"),
    ("", "{w:4} {d4:1}-{d4:2} {w:5}"),
    ("", "{w:4} {d4:1} {w:5} {d1:2}.{d1:3}"),
    ("", "in {d4:1}, {w:4} {d2:2}.{d2:3} {w:5}"),
    ("email2", "write to {w:4}{d2:1} (at) {w:5} (dot) example (dot) com"),
    ("email2", "{w:4}[at]{w:5}.example.org {w:6}"),
    ("", "look {w:4} (at) noon. {w:5}"),
    ("", "meet (at) {w:4}. {w:5}"),
    ("secret", "token = \"{h:9}\" {w:4}"),
    ("secret", "api_key: {h:8}{d3:1}"),
    ("secret", "password={w:4}{d6:1}Xq"),
    ("secret", "secret: {h:7} {w:4}"),
    ("", "key: {w:4}ingly {w:5}"),
    ("", "the key: important-{w:4}"),
    ("", "token: understanding of it"),
    ("", "password: forgotten/{w:4}"),
)
CALIBRATE = (
    ("number", "reach {w:4} at {d3:1} {d3:2} {d4:3}"),
    ("number", "phone number: ({d3:1}) {d3:2} {d4:3}."),
    ("number", "sms to {d3:1}-{d3:2}-{d4:3} {w:4}"),
    ("number", "{w:4}, ({d3:1}) {d3:2}-{d4:3}, {w:5}"),
    ("", "from {d2:1}.{d2:2}.20{d2:3} on"),
    ("", "page {d4:1}-{d3:2} of {w:4}"),
    ("", "id {d10:1} {w:4}"),
    ("", "{w:4} {d2:1}-{d2:2} {w:5}"),
    ("", "{w:4} #{d6:1} {w:5}"),
    ("", "{w:4} at {d1:1}.{d3:2} {w:5}"),
    ("", "{w:4} {d12:1}{d8:2} {w:5}"),
    ("email2", "contact {w:4} [at] {w:5}.org please"),
    ("email2", "{w:4}.{w:6}(at){w:5}(dot)net"),
    ("", "we look (at) it. {w:5}"),
    ("", "be there [at] {w:4}. {w:5} {w:6}"),
    ("secret", "bearer: {h:9}{h:3}"),
    ("secret", "'password' : '{w:4}{d4:1}{w:5}Z'"),
    ("secret", "access token={h:5}, {w:4}"),
    ("", "key = something-{w:4}"),
    ("", "secret: nobody_knows"),
    ("", "bearer: {w:4}-{w:5}-standing"),
)


def sentences(spark: SparkSession, rows: int, patterns: tuple[tuple[str, str], ...]) -> DataFrame:
    """id, text, label (a generator's name or "") of generated sentences; all of it from hashes of the row number."""
    n = len(patterns)
    pick = lambda values: f"case pmod(id, {n}) {' '.join(f'when {i} then {v}' for i, v in enumerate(values))} end"
    return spark.range(rows).selectExpr("id", f"{pick([sentence(p) for _, p in patterns])} as text", f"{pick([repr(y) for y, _ in patterns])} as label")


def candidates(made: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Features and labels of the candidates of each generator in generated sentences."""
    rows = made.select("label", *(_featured(matches(F.col("text"), p)).alias(k) for k, p in PROPOSED.items())).collect()
    out = {}
    for k in PROPOSED:
        found = [([c[f] for f in FEATURES], r["label"] == k) for r in rows for c in r[k]]
        out[k] = np.array([x for x, _ in found], float).reshape(-1, len(FEATURES)), np.array([y for _, y in found], float)
    return out


def boosted(x: np.ndarray, y: np.ndarray, trees: int = 24, depth: int = 3, rate: float = 0.3, least: int = 8) -> tuple[float, list]:
    """Gradient boosting of the logistic loss. A tree is a leaf's value or (feature, cut, tree below, tree above)."""
    prior = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
    score, out = np.full(len(y), prior), []

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, left: int):
        value = rate * g[rows].sum() / (h[rows].sum() + 1.0)
        best, cut = 1e-6, None
        if left and len(rows) >= 2 * least:
            total, weight = g[rows].sum(), h[rows].sum()
            for f in range(x.shape[1]):
                for c in np.unique(np.quantile(x[rows, f], np.linspace(0, 1, 17)))[:-1]:
                    low = rows[x[rows, f] <= c]
                    if least <= len(low) <= len(rows) - least:
                        a, b = g[low].sum(), h[low].sum()
                        gain = a * a / (b + 1) + (total - a) ** 2 / (weight - b + 1) - total * total / (weight + 1)
                        if gain > best:
                            best, cut = gain, (f, float(c))
        if cut is None:
            return float(value)
        low = x[rows, cut[0]] <= cut[1]
        return (*cut, grow(rows[low], g, h, left - 1), grow(rows[~low], g, h, left - 1))

    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        tree = grow(np.arange(len(y)), y - p, p * (1 - p), depth)
        out.append(tree)
        score += np.array([leaf(tree, r) for r in x])
    return prior, out


def leaf(tree, row) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def _as_column(tree, x: Column) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(tree)
    return F.when(x[list(FEATURES)[tree[0]]] <= tree[1], _as_column(tree[2], x)).otherwise(_as_column(tree[3], x))


#: Generated sentences that a model is fitted on, and half as many that set its thresholds.
SENTENCES = 2800


@lru_cache(maxsize=4)
def _fitted(app: str, rows: int) -> dict[str, tuple[float, list, float]]:
    """prior, trees and threshold of each generator: the one of the best F1 on patterns that weren't fitted."""
    spark = SparkSession.getActiveSession()
    fit, held = candidates(sentences(spark, rows, FIT)), candidates(sentences(spark, rows // 2, CALIBRATE))
    out = {}
    for k in PROPOSED:
        prior, trees = boosted(*fit[k])
        x, truth = held[k]
        z = np.array([prior + sum(leaf(t, r) for t in trees) for r in x])
        cuts = np.unique(z)
        f1 = np.array([2 * (truth[z >= c]).sum() / ((z >= c).sum() + truth.sum()) for c in cuts])
        best = int(np.argmax(f1))
        out[k] = (prior, trees, float((cuts[best] + cuts[best - 1]) / 2 if best else cuts[best]))
    return out


def model(spark: SparkSession, rows: int = SENTENCES) -> dict[str, tuple[float, list, float]]:
    return _fitted(spark.sparkContext.applicationId, rows)


# --- the operator ----------------------------------------------------------------------------------------------------


def score(prior: float, trees: list):
    """The boosted trees as one SQL expression over a candidate's features."""
    return lambda x: sum((_as_column(t, x) for t in trees), F.lit(prior))


def _over(prior: float, trees: list, cut: float):
    return lambda x: score(prior, trees)(x) >= cut


#: So few spans are compared one by one.
_FEW = 16


def _apart(spans: Column, others: list[Column]) -> Column:
    """Spans that overlap none of the others. Each of the others is in order and without overlaps, so of many, only the
    last that begins before the span's end is looked at, and it is found by halves."""

    def meets(o: Column, x: Column) -> Column:
        few = F.exists(o, lambda y: (x["s"] < y["e"]) & (y["s"] < x["e"]))
        steps = F.array(*[F.lit(1 << k) for k in range(22, -1, -1)])
        before = F.aggregate(steps, F.lit(0), lambda at, step: F.when((at + step <= F.size(o)) & (F.get(o, at + step - 1)["s"] < x["e"]), at + step).otherwise(at))
        many = F.aggregate(F.array(before), F.lit(False), lambda acc, n: acc | ((n > 0) & (F.get(o, n - 1)["e"] > x["s"])))
        return F.when(F.size(o) <= _FEW, few).otherwise(F.coalesce(many, F.lit(False)))

    return F.filter(spans, lambda x: ~reduce(lambda a, b: a | b, [meets(o, x) for o in others]))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """row (a struct of id and kept columns), text, an array of (s, e) of checked base spans for each base kind, and all:
    every span with its kind, in the order of kinds, then starts.
    """
    fitted = model(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    none = F.array().cast("array<struct<s:int,e:int,m:string,before:string,after:string>>")
    at = docs.select(F.struct(id_col, *keep).alias("row"), text.alias("_text"), text.rlike(_MAYBE).alias("_maybe"))
    at = at.withColumns({f"_{k}": F.when(F.col("_maybe"), matches(F.col("_text"), p)).otherwise(none) for k, p in (BASE | PROPOSED).items()})
    pair = lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))
    chosen = {f"_{k}": F.transform(F.filter(F.col(f"_{k}"), _valid(k)), pair) for k in BASE}
    for k, (prior, trees, cut) in fitted.items():
        chosen[f"_{k}"] = F.transform(F.filter(_featured(F.col(f"_{k}")), _over(prior, trees, cut)), pair)
    at = at.withColumns(chosen)
    base = [F.col(f"_{k}") for k in BASE]
    taken = list(base)
    for k in PROPOSED:
        at = at.withColumn(f"_{k}", F.when(F.size(f"_{k}") > 0, _apart(F.col(f"_{k}"), taken)).otherwise(F.col(f"_{k}")))
        taken.append(F.col(f"_{k}"))

    def named(kind: str) -> Column:
        own = [F.col(f"_{kind}")] * (kind in BASE) + [F.col(f"_{k}") for k in PROPOSED if KIND[k] == kind]
        every = F.concat(*own) if len(own) > 1 else own[0]
        return F.transform(F.array_sort(every), lambda x: F.struct(F.lit(kind).alias("kind"), x["s"].alias("s"), x["e"].alias("e")))

    return at.select("row", F.col("_text").alias("text"), *(F.col(f"_{k}").alias(k) for k in BASE), F.concat(*map(named, KINDS)).alias("all"))


def _line(spans: Column, kind: str | None = None) -> Column:
    return F.transform(spans, lambda x: F.concat_ws(":", F.lit(kind) if kind else x["kind"], x["s"].cast("string"), x["e"].cast("string")))


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_email, n_ip, n_card, n_phone, base_sha256, spans of every row."""
    found = find(docs, id_col, text_col)
    base = F.array_join(F.concat(*(_line(F.col(k), k) for k in BASE)), ",")
    return found.select(F.col("row")[id_col].alias(id_col), *(F.size(k).cast("long").alias(f"n_{k}") for k in BASE), F.sha2(base, 256).alias("base_sha256"), F.array_join(_line(F.col("all")), ",").alias("spans"))


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs with every span of the text replaced by its kind in brackets. Null text stays null."""
    found = find(docs, id_col, text_col, tuple(c for c in docs.columns if c != id_col))
    order = F.array_sort(F.transform("all", lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind"))))

    def cut(acc: Column, x: Column) -> Column:
        part = F.substring(F.col("text"), acc["at"] + 1, F.greatest(x["s"] - acc["at"], F.lit(0)))
        fresh = x["s"] >= acc["at"]
        return F.struct(F.greatest(acc["at"], x["e"]).alias("at"), F.concat(acc["out"], F.when(fresh, F.concat(part, F.lit("["), F.upper(x["kind"]), F.lit("]"))).otherwise("")).alias("out"))

    done = F.aggregate(order, F.struct(F.lit(0).alias("at"), F.lit("").alias("out")).cast("struct<at:int,out:string>"), cut, lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    new = F.when(F.col("row")[text_col].isNull(), F.lit(None)).when(F.size("all") > 0, done).otherwise(F.col("text"))
    return found.select(*[new.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
