"""Quality rules whose limits come from the data, per language and source.

Fixed cut-offs fit no two languages. Here each measure of a document (mean word length,
symbols, repeated lines and repeated words per word) is summarised in one quantile sketch
per language and source, and a document fails if it lies far outside of the middle half
of its own group.

A sketch holds how often each value occurs after the value has been cut to its first six
binary digits: at most 32 entries per power of two, whatever the number of documents, and
values within 1/32. Sketches are merged by adding counts, in any order and with the same
result: by Spark's map-side aggregation, and from sources to a language and from languages
to all documents where a group is too small for limits of its own.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import small_batches, stage

# Documents a group needs for limits of its own.
ENOUGH = 200
# How many times the spread of the middle half a value may lie outside of it.
REACH = 3
# The characters that count as symbols, and blanks between words.
SYMBOLS, BLANKS = b"#*$%&|<>", b" \t\n\x0b\x0c\r"
RUN = 8

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# Measure: numerator, scale per word, least width on each side of the middle half.
RULES = {
    "word_length": ("word_chars", 1000, 500),
    "symbols": ("n_symbols", 10_000, 1000),
    "repeated_lines": ("n_dup_lines", 10_000, 500),
    "repeated_words": ("n_repeat_words", 10_000, 2000),
}


def repeated_words(words: list[bytes], width: int = RUN) -> int:
    """How many words lie in a run of ``width`` words that the text holds twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    runs = np.zeros(n, np.uint64)
    for k in range(width):
        runs = runs * np.uint64(0x9E3779B97F4A7C15) + h[k : k + n]
    order = np.argsort(runs)
    same = np.flatnonzero(runs[order[1:]] == runs[order[:-1]])
    if not len(same):
        return 0
    # Equal hashes only point at runs; the words decide.
    seen: dict[tuple, list[int]] = {}
    for k in np.unique(np.concatenate([order[same], order[same + 1]])).tolist():
        seen.setdefault(tuple(words[k : k + width]), []).append(k)
    covered = np.zeros(len(words) + 1, np.int64)
    for places in seen.values():
        if len(places) > 1:
            covered[places] += 1
            covered[np.array(places) + width] -= 1
    return int(np.count_nonzero(np.cumsum(covered)))


def base_measures(text: str | None) -> tuple[int, ...]:
    """The counts of ``BASE`` for a whole text; a null text has none."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    chars = len((text or "")) - (len(data) - len(data.translate(None, BLANKS)))
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    lines = [line for line in data.split(b"\n") if line.strip(BLANKS)]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def measures(text: Column) -> Column:
    """``base_measures`` as a struct column."""

    def run(parts):
        for texts in parts:
            rows = [base_measures(t) for t in texts]
            yield pd.DataFrame(rows, columns=BASE, dtype="int64")

    fields = ", ".join(f"{c} long" for c in BASE)
    return F.pandas_udf(run, fields, F.PandasUDFType.SCALAR_ITER)(text)


def base_failed(at: str = "") -> Column:
    """Too short, or more than three tenths of the words repeated."""
    n, again = F.col(f"{at}n_words"), F.col(f"{at}n_repeat_words")
    return (n < 20) | (100 * again > 30 * n)


def rule_value(rule: str, at: str = "") -> Column:
    """A measure as a whole number; only for documents with words."""
    top, scale, _ = RULES[rule]
    return F.floor(F.expr(f"{scale} * {at}{top} div {at}n_words"))


def rounded(value: Column) -> Column:
    """The first six binary digits of a whole number, the others 0."""
    spare = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    unit = F.pow(F.lit(2), spare).cast("long")
    return value - F.pmod(value, unit)


def sketches(measured: DataFrame) -> DataFrame:
    """lang, source, rule, value, n: one quantile sketch per group and rule, of all
    documents that pass the base rules."""
    entries = F.array(*[
        F.struct(F.lit(rule).alias("rule"), rounded(rule_value(rule)).alias("value")) for rule in RULES
    ])
    return (
        measured.filter(~base_failed())
        .select("lang", "source", F.inline(entries))
        .groupBy("lang", "source", "rule", "value")
        .agg(F.count("*").alias("n"))
    )


def merged(sketch: DataFrame, keys: list[str]) -> DataFrame:
    return sketch.groupBy(*keys, "rule", "value").agg(F.sum("n").alias("n"))


def fences(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """keys, size, and the limits ``<rule>_low`` and ``<rule>_high`` of each group.

    A quartile is the least value that a quarter, or three quarters, of the documents do
    not exceed. The windows go over one sketch each, which has a few hundred entries.
    """
    group = Window.partitionBy(*keys, "rule")
    below = F.sum("n").over(group.orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
    steps = sketch.withColumn("size", F.sum("n").over(group)).withColumn("below", below)
    q1 = F.min(F.when(4 * F.col("below") >= F.col("size"), F.col("value")))
    q3 = F.min(F.when(4 * F.col("below") >= 3 * F.col("size"), F.col("value")))
    quartiles = steps.groupBy(*keys, "rule").agg(F.max("size").alias("size"), q1.alias("q1"), q3.alias("q3"))
    out = []
    for rule, (_, _, least) in RULES.items():
        spread = F.greatest(REACH * (F.col("q3") - F.col("q1")), F.lit(least))
        mine = F.col("rule") == rule
        out += [
            F.max(F.when(mine, F.col("q1") - spread)).alias(f"{rule}_low"),
            F.max(F.when(mine, F.col("q3") + spread)).alias(f"{rule}_high"),
        ]
    return quartiles.groupBy(*keys).agg(F.max("size").alias("size"), *out)


def limits(sketch: DataFrame, enough: int = ENOUGH) -> DataFrame:
    """lang, source and the limits that hold there: the group's own if it has ``enough``
    documents, else those of the merged sketch of its language, else of all documents."""
    names = [f"{rule}_{side}" for rule in RULES for side in ("low", "high")]
    own, by_lang = fences(sketch, ["lang", "source"]), fences(merged(sketch, ["lang"]), ["lang"])
    total = fences(merged(sketch, []).withColumn("one", F.lit(1)), ["one"]).drop("one", "size")
    own = own.alias("o")
    by_lang = by_lang.alias("l")
    joined = own.join(by_lang, F.col("o.lang").eqNullSafe(F.col("l.lang"))).crossJoin(F.broadcast(total.alias("t")))
    chosen = [
        F.when(F.col("o.size") >= enough, F.col(f"o.{c}"))
        .when(F.col("l.size") >= enough, F.col(f"l.{c}"))
        .otherwise(F.col(f"t.{c}"))
        .alias(c)
        for c in names
    ]
    return joined.select("o.lang", "o.source", *chosen)


def verdict(measured: DataFrame, found: DataFrame) -> DataFrame:
    """``measured`` with base_failed and kept. A group that has limits is met by language
    and source; documents of a group without any have failed the base rules."""
    m, t = measured.alias("m"), found.alias("t")
    same = F.col("m.lang").eqNullSafe(F.col("t.lang")) & F.col("m.source").eqNullSafe(F.col("t.source"))
    inside = F.lit(True)
    for rule in RULES:
        inside = inside & rule_value(rule, "m.").between(F.col(f"t.{rule}_low"), F.col(f"t.{rule}_high"))
    failed = base_failed("m.")
    return m.join(t, same, "left").select(
        "m.*", failed.alias("base_failed"), F.when(failed, False).otherwise(inside).alias("kept")
    )


def measure(df: DataFrame, carry: list[str]) -> DataFrame:
    """The columns ``carry``, lang and source of all rows, and their base measures."""
    small_batches(df.sparkSession)
    names = list(dict.fromkeys([*carry, "lang", "source"]))
    return df.select(*names, measures(F.col("text")).alias("_found")).select(*names, "_found.*")


def judge(df: DataFrame, enough: int = ENOUGH) -> DataFrame:
    """One row per row of ``df`` (doc_id, text, lang, source): doc_id, n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, base_failed, kept.

    Null texts count as empty: no words, base_failed. Null languages and sources are groups
    like any other, and whole texts of any length are measured. Values on a limit are kept,
    and sketches do not depend on the order of rows. Repeated rows count and are judged each
    time. An empty table gives no rows. Columns other than the four, such as one named
    kept, are not read.
    """
    measured = stage(measure(df, ["doc_id"]), "measured")
    return verdict(measured, limits(sketches(measured), enough)).drop("lang", "source")


def keep(df: DataFrame, enough: int = ENOUGH) -> DataFrame:
    """The rows of ``df`` that ``judge`` keeps, with all their columns. Texts are read twice
    and meet the limits in a join on language and source."""
    found = limits(stage(sketches(measure(df, [])), "sketches"), enough)
    whole = df.select(F.struct("*").alias("row"), "lang", "source", "text")
    return verdict(measure(whole, ["row"]), found).filter("kept").select("row.*")
