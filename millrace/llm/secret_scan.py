"""Secrets in texts, by Spark's own functions alone.

Three fixed patterns come first. Strings that none of them covers wholly are judged by two
character Markov models, one of random strings and one of ordinary identifiers: the
log-likelihood ratio of a string per character pair decides. Both are trained from a
bounded sample of documents, labelled by the fixed patterns: what they match is random,
the other strings of the same alphabet are ordinary.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.runtime import id_and_text

# The patterns, the shortest match (assign: the shortest value), in rank order.
# Runs of access and hex below the least length are no matches and touch no other, so the
# least length stands in the pattern; a short assign uses up its text and goes afterwards.
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
PATTERNS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX}
SHORTEST = {"assign": 12, "access": 18, "hex": 16}

#: What has to be somewhere in a text before the full pattern is worth its time.
HINTS = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]""",
    "access": r"AKIA[A-Z0-9]{14}",
    "hex": r"[0-9a-f]{16}",
}

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
STRING = r"[A-Za-z0-9+/_=-]"
#: Shortest string that the models judge, and that the models learn from.
LENGTH, LEARN_LENGTH = 20, 6
#: Least mean log-likelihood ratio (nats per character pair) of a secret.
RATIO = 1.0
#: Documents the models are trained from, about this many at most.
SAMPLE = 20_000
#: Added to every pair count, so that unseen pairs of random strings are alike.
SMOOTH_RANDOM, SMOOTH_ORDINARY = 2.0, 0.5
REDACTED = "[SECRET]"

_SPANS = "array<struct<start:bigint,rank:int,end:bigint>>"
_BLOCK = 256
_PIECE = 1024


def _let(value: Column, use) -> Column:
    """``use(value)``, with ``value`` computed once however often it occurs there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running_short(values: Column, base: Column, add) -> Column:
    """What precedes each value, added up from ``base`` on."""
    start = F.struct(base.cast("bigint").alias("at"), F.array().cast("array<bigint>").alias("out"))
    step = lambda a, x: F.struct(add(a["at"], x).alias("at"), F.array_append(a["out"], a["at"]).alias("out"))
    return F.aggregate(values, start, step, lambda a: a["out"])


def _running(values: Column, add=lambda a, x: a + x) -> Column:
    """The sum (or ``add``) of what precedes each value, from 0 on; in blocks, as appending copies an array."""
    zero = F.lit(0).cast("bigint")

    def in_blocks(values: Column) -> Column:
        last = F.floor((F.size(values) - 1) / _BLOCK).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(values, b * _BLOCK + 1, F.lit(_BLOCK)))

    def joined(blocks: Column) -> Column:
        bases = _running_short(F.transform(blocks, lambda b: F.aggregate(b, zero, add)), zero, add)
        return F.flatten(F.zip_with(blocks, bases, lambda b, base: _running_short(b, base, add)))

    return _let(
        values,
        lambda v: F.when(F.size(v) <= _BLOCK, _running_short(v, zero, add)).otherwise(_let(in_blocks(v), joined)),
    )


def _located(text: Column, pattern: str, rank: int) -> Column:
    """Spans of all matches, leftmost and non-overlapping, in code points."""
    matches = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.length(m).cast("bigint"))
    gaps = F.transform(F.split(text, pattern, -1), lambda g: F.length(g).cast("bigint"))

    # gap, match, gap, match, ...: a match starts after the gaps and matches ahead of it
    def spans(x: Column) -> Column:
        both = F.zip_with(F.slice(x["gaps"], F.lit(1), F.size(x["matches"])), x["matches"], _gap_and_match)
        ahead = _running(F.transform(both, lambda y: y["gap"] + y["match"]))
        return F.zip_with(both, ahead, lambda y, ahead: _span(ahead + y["gap"], rank, ahead + y["gap"] + y["match"]))

    return _let(F.struct(matches.alias("matches"), gaps.alias("gaps")), spans)


def _gap_and_match(gap: Column, match: Column) -> Column:
    return F.struct(gap.alias("gap"), match.alias("match"))


def _span(start: Column, rank: int, end: Column) -> Column:
    return F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"))


def _ends_before(spans: Column, end) -> Column:
    """The greatest end of what precedes each of the sorted ``spans``, 0 without any."""
    return _running(F.transform(spans, end), lambda a, x: F.greatest(a, x))


def _base(text: Column, kind: str) -> Column:
    rank = KINDS.index(kind)
    pattern = PATTERNS[kind]
    if kind == "assign":
        spans = _located(text, pattern, rank)
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2))
        both = F.arrays_zip(spans.alias("span"), values.alias("value"))
        long = F.filter(both, lambda x: F.length(x["value"]) >= SHORTEST[kind])
        found = F.transform(long, lambda x: x["span"])
    else:
        found = _located(text, pattern, rank)
    return F.when(F.rlike(text, F.lit(HINTS[kind])), found).otherwise(F.array().cast(_SPANS)).cast(_SPANS)


def _digits(string: Column) -> Column:
    """Places of the characters in the alphabet."""
    return F.transform(F.split(string, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)


def _pairs(string: Column) -> Column:
    """The numbers of the character pairs of a string of at least two characters."""
    digits = F.filter(_digits(string), lambda d: d >= 0)
    n = F.size(digits)
    return F.zip_with(
        F.slice(digits, F.lit(1), n - 1), F.slice(digits, F.lit(2), n - 1), lambda a, b: a * len(ALPHABET) + b
    )


def fit_models(
    docs: DataFrame, sample: int = SAMPLE, id_col: str = "doc_id", text_col: str = "text"
) -> list[float]:
    """The log-likelihood ratio of every character pair, random against ordinary.

    Pairs are counted in Spark over about ``sample`` documents at most, chosen by a hash of
    id and text; the driver gets one row per pair that occurs. Without any labelled string
    on one side, that side is uniform.
    """
    own = id_and_text(docs, id_col, text_col).where(F.col("text").isNotNull())
    share = min(1.0, sample / max(1, own.count()))
    picked = own.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < int(share * (1 << 30)))
    text = F.col("text")
    rest = text
    for kind, pattern in PATTERNS.items():
        rest = F.when(F.rlike(text, F.lit(HINTS[kind])), F.regexp_replace(rest, pattern, " ")).otherwise(rest)
    hit = F.rlike(text, F.lit("|".join(HINTS.values())))
    random = F.when(
        hit,
        F.concat(
            F.regexp_extract_all(text, F.lit(ASSIGN), F.lit(2)),
            F.regexp_extract_all(text, F.lit(ACCESS), F.lit(0)),
            F.regexp_extract_all(text, F.lit(HEX), F.lit(0)),
        ),
    ).otherwise(F.array().cast("array<string>"))
    random = F.filter(random, lambda s: F.length(s) >= min(SHORTEST.values()))
    ordinary = F.regexp_extract_all(rest, F.lit(f"{STRING}{{{LEARN_LENGTH},}}"), F.lit(0))

    def labelled(strings: Column, is_random: bool) -> Column:
        return F.transform(strings, lambda s: F.struct(s.alias("string"), F.lit(is_random).alias("random")))

    strings = picked.select(F.explode(F.concat(labelled(random, True), labelled(ordinary, False)))).select("col.*")
    counted = (
        strings.groupBy("string", "random")  # the same words come again and again
        .agg(F.count(F.lit(1)).alias("n"))
        .select("random", "n", F.explode(_pairs(F.col("string"))).alias("pair"))
        .groupBy("random", "pair")
        .agg(F.sum("n").alias("n"))
    )
    size = len(ALPHABET)
    tables = {True: [SMOOTH_RANDOM] * size**2, False: [SMOOTH_ORDINARY] * size**2}
    for row in counted.collect():
        tables[row.random][row.pair] += row.n

    def logs(table: list[float]) -> list[float]:
        sums = [sum(table[k * size : (k + 1) * size]) for k in range(size)]
        return [math.log(v / sums[k // size]) for k, v in enumerate(table)]

    return [round(a - b, 6) for a, b in zip(logs(tables[True]), logs(tables[False]))]


def _ratio(string: Column, ratios: Column) -> Column:
    """Mean log-likelihood ratio per pair."""
    pairs = _pairs(string)
    total = F.aggregate(pairs, F.lit(0.0), lambda a, p: a + F.get(ratios, p))
    return total / F.greatest(F.size(pairs), F.lit(1))


def _unused(name: str, columns: list[str]) -> str:
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


def find_secrets(
    docs: DataFrame, ratios: list[float], least_ratio: float = RATIO, text_col: str = "text"
) -> tuple[DataFrame, str, str]:
    """``docs`` with two more columns, and their names: the spans of the fixed patterns, all spans.

    Spans are start, rank of the kind, end; sorted; ends are exclusive; in code points. A
    string that a span of the fixed patterns covers wholly is not judged by the models; one
    that reaches beyond is, so spans may overlap.
    """
    base, spans = _unused("_base", docs.columns), _unused("_spans", docs.columns)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    table = F.split(F.lit(",".join(map(str, ratios))), ",").cast("array<double>")
    found = docs.withColumn(base, F.array_sort(F.concat(*(_base(text, k) for k in PATTERNS))))
    pattern = f"{STRING}{{{LENGTH},}}"
    strings = F.zip_with(
        _located(text, pattern, len(PATTERNS)),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda s, value: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), value.alias("value")),
    )
    # fixed spans and strings in one order, a span ahead of a string that starts with it: a
    # string is covered if the furthest of the fixed spans ahead of it reaches its end
    known = F.transform(F.col(base), lambda b: F.struct(b["start"], b["rank"], b["end"], F.lit("").alias("value")))
    judged = F.lit(len(PATTERNS))

    def likely(merged: Column) -> Column:
        furthest = _ends_before(merged, lambda x: F.when(x["rank"] < judged, x["end"]).otherwise(F.lit(0)))
        both = F.zip_with(merged, furthest, lambda x, reach: F.struct(x.alias("x"), reach.alias("reach")))
        free = F.filter(both, lambda y: (y["x"]["rank"] == judged) & (y["reach"] < y["x"]["end"]))
        found = F.filter(free, lambda y: _ratio(y["x"]["value"], table) >= least_ratio)
        return F.transform(found, lambda y: _span(y["x"]["start"], len(PATTERNS), y["x"]["end"]))

    more = F.when(F.rlike(text, F.lit(pattern)), _let(F.array_sort(F.concat(known, strings)), likely))
    more = more.otherwise(F.array().cast(_SPANS)).cast(_SPANS)
    return found.withColumn(spans, F.array_sort(F.concat(F.col(base), more))), base, spans


def _listed(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"], s["end"])), ","
    )


def secret_report(
    docs: DataFrame, ratios: list[float], least_ratio: float = RATIO, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: counts per fixed kind, the digest of their spans, all spans.

    A null text counts as empty; repeated rows and null ids come back as they are; an empty
    table gives no rows.
    """
    found, base, spans = find_secrets(id_and_text(docs, id_col, text_col), ratios, least_ratio)

    def count(rank: int) -> Column:
        return F.size(F.filter(base, lambda s: s["rank"] == rank)).cast("bigint")

    counts = [count(r).alias(f"n_{k}") for r, k in enumerate(PATTERNS)]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(_listed(F.col(base)), 256).alias("base_sha256"),
        _listed(F.col(spans)).alias("spans"),
    )


def _without(text: Column, spans: Column) -> Column:
    """``text`` with the sorted ``spans`` replaced, in time linear in both.

    What lies between spans is cut from pieces of the text of ``_PIECE`` code points each, as
    taking a part of a text counts its characters from the start.
    """

    def gap(start: Column, end: Column) -> Column:
        return F.struct(start.cast("bigint").alias("start"), end.cast("bigint").alias("end"))

    kept = F.zip_with(spans, _ends_before(spans, lambda s: s["end"]), lambda s, reach: gap(reach, s["start"]))
    rest = gap(F.array_max(F.transform(spans, lambda s: s["end"])), F.length(text))
    gaps = F.concat(F.filter(kept, lambda g: g["start"] <= g["end"]), F.array(rest))
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_PIECE}}}"), F.lit(0))

    def cut(pieces: Column, g: Column) -> Column:
        first, last = F.floor(g["start"] / _PIECE).cast("int"), F.floor(g["end"] / _PIECE).cast("int")
        skip, upto = (g["start"] % _PIECE).cast("int"), (g["end"] % _PIECE).cast("int")
        piece = lambda k: F.coalesce(F.get(pieces, k), F.lit(""))
        between = F.transform(F.sequence(first, last), lambda k: F.when(k == first, F.substring(piece(k), skip + 1, F.lit(_PIECE)))
            .when(k == last, F.substring(piece(k), F.lit(1), upto)).otherwise(piece(k)))
        return F.when(first == last, F.substring(piece(first), skip + 1, upto - skip)).otherwise(F.array_join(between, ""))

    return _let(pieces, lambda p: F.array_join(F.transform(gaps, lambda g: cut(p, g)), REDACTED))


def redact(docs: DataFrame, ratios: list[float], least_ratio: float = RATIO, text_col: str = "text") -> DataFrame:
    """``docs`` with every secret of the texts replaced; overlapping spans become one.

    A column ``n_chars`` follows the new text where it has changed. Rows without a secret are
    unchanged, null texts too.
    """
    columns = docs.columns
    text = F.col(f"`{text_col}`")
    found, _, spans = find_secrets(docs, ratios, least_ratio, text_col)
    hit = F.size(spans) > 0
    found = found.withColumn(text_col, F.when(hit, _without(text, F.col(spans))).otherwise(text))
    if "n_chars" in columns:
        kind = docs.schema["n_chars"].dataType
        found = found.withColumn("n_chars", F.when(hit, F.length(text).cast(kind)).otherwise(F.col("n_chars")))
    return found.select(*[f"`{c}`" for c in columns])
