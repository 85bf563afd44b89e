"""Mix sources to target weights by Poisson replication.

A source's rate is its share of the target weights over its share of the corpus. Each
document draws a number in [0, 1) from its id and the seed; the inverse of the Poisson
distribution of that rate turns it into a number of copies, so the expected repetition
is the rate, and a run with the same seed makes the same copies. The copies are then
dealt out and ordered by a second draw, which shuffles the whole corpus.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from .common import share_of, stage

# Sources up to which the table of rates is broadcast; with more, Spark decides by its size.
BROADCAST = 10_000
# Standard deviations around a rate between which the distribution is tabulated.
SPREAD = 12
# Copies of one document that a row stands for at most before the last step.
BLOCK = 10_000
# Rates from which a table is computed from its own range only, relative to its mode.
WIDE = 1_000_000


def poisson_table(rate: float) -> tuple[int, list[float]]:
    """The first count tabulated, and the cumulative probability of each count from there.

    The table has about 24 times the square root of the rate entries; what lies outside
    it has a probability below 1e-30.
    """
    reach = SPREAD * np.sqrt(rate) + 40
    first = max(0, int(rate - reach))
    if rate >= WIDE:
        counts = np.arange(first, int(rate + reach) + 1)
        logs = np.cumsum(np.log1p((rate - counts) / counts))
        below = np.cumsum(np.exp(logs - logs.max()))
        return first, (below / below[-1]).tolist()
    counts = np.arange(0, int(rate + reach) + 1)
    steps = np.log(rate) - np.log(np.maximum(counts, 1))
    logs = np.cumsum(np.where(counts == 0, -rate, steps))
    return first, np.cumsum(np.exp(logs))[first:].tolist()


def tabulate(rates: pd.Series) -> pd.DataFrame:
    found = [poisson_table(r) for r in rates]
    return pd.DataFrame({"first": [f for f, _ in found], "below": [b for _, b in found]})


def rates(df: DataFrame, weights: dict[str, float] | None = None, total: float | None = None) -> DataFrame:
    """Per source: size in characters, and the rate that gives it its share of ``total``
    (the corpus's own size by default). ``weights`` None weighs all sources alike;
    otherwise a source without a weight gets none, and null is the source named None."""
    sizes = df.groupBy("source").agg(
        F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("size"), F.count("*").alias("n_docs")
    )
    if weights is None:
        weight = F.lit(1.0)
    else:
        weight = F.lit(0.0)
        for name, value in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(weight)
    sizes = sizes.withColumn("weight", weight)
    sums = sizes.agg(
        (F.lit(float(total)) if total is not None else F.sum("size").cast("double")).alias("goal"),
        F.sum("weight").alias("all_weights"),
    )
    goal, all_weights = sums.first()
    rate = F.when(
        F.col("size") > 0,
        F.lit(goal) * (F.col("weight") / F.lit(all_weights or 1.0)) / F.col("size"),
    ).otherwise(F.lit(1.0))
    return sizes.withColumn("rate", rate)


def named(df: DataFrame) -> DataFrame:
    """row (all columns) and name, what a row draws by: its doc_id, or its number among the
    rows without one. The numbers are stored, so a lost task cannot number anew."""
    known = df.filter(F.col("doc_id").isNotNull())
    known = known.select(F.struct("*").alias("row"), F.col("doc_id").cast("string").alias("name"))
    number = F.concat(F.lit("-|"), F.monotonically_increasing_id().cast("string"))
    lost = df.filter(F.col("doc_id").isNull()).select(F.struct("*").alias("row"), number.alias("name"))
    return known.unionByName(stage(lost, "no-id"))


def mix(
    df: DataFrame,
    weights: dict[str, float] | None = None,
    total: float | None = None,
    seed: int = 0,
) -> DataFrame:
    """The columns of ``df`` (doc_id, text, source, ...) and copy (from 1) and shuffle_key,
    which replace columns of those names.

    Null sources are one source, null texts have no characters; a source without
    characters keeps each document once, one of weight zero none. Rows that repeat a
    doc_id draw alike. Rows without one are numbered, stored, and draw by their number,
    each for itself; another partitioning numbers them in another order. An empty table
    gives no rows. Partitions and the rows in them follow shuffle_key.

    Only the table of rates meets the documents. It has one row per source; a counted
    table of up to BROADCAST sources is broadcast, so that texts pass one shuffle, and
    with more of them the join is a plain one, in which Spark splits the hot source.
    Documents of sources with rates near ``BLOCK`` and above are dealt out in blocks of
    copies, so no row or task holds all copies of one.
    copy is an int, or a long where a document may have 2^31 copies or more.
    """
    found = rates(df, weights, total).filter("rate > 0")
    table = F.pandas_udf(tabulate, "first long, below array<double>")
    found = stage(found.select(F.col("source").alias("of"), table("rate").alias("table")), "rates")
    most = F.col("table.first") + F.size("table.below")
    n_sources, highest = found.agg(F.count("*"), F.max(most)).first()
    draw = share_of(F.lit(seed), F.col("name"))
    below = F.size(F.filter("table.below", lambda p: p <= F.col("draw"))).cast("long")
    copies = F.col("table.first") + below
    key = share_of(F.lit(seed), F.lit("order"), F.col("name"), F.col("copy"))
    told = named(df)

    def counted(table: DataFrame) -> DataFrame:
        if n_sources <= BROADCAST:
            table = F.broadcast(table)
        return (
            told.join(table, F.col("row.source").eqNullSafe(F.col("of")))
            .withColumn("draw", draw)
            .select("row", "name", copies.alias("copies"))
            .filter("copies > 0")
        )

    def numbered(rows: DataFrame, low: Column, high: Column) -> DataFrame:
        return rows.select("row", "name", F.explode(F.sequence(low.cast("long"), high.cast("long"))).alias("copy"))

    if (highest or 0) <= BLOCK:
        each = numbered(counted(found), F.lit(1), F.col("copies"))
    else:
        few = numbered(counted(found.filter(most <= BLOCK)), F.lit(1), F.col("copies"))
        # A given number of partitions: blocks are small, and AQE would merge theirs.
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        blocks = (
            counted(found.filter(most > BLOCK))
            .withColumn("low", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"), F.lit(BLOCK).cast("long"))))
            .repartition(parts, F.col("name"), F.col("low"))
        )
        each = few.unionByName(numbered(blocks, F.col("low"), F.least("copies", F.col("low") + (BLOCK - 1))))
    mixed = (
        each
        .withColumn("shuffle_key", key)
        .repartition("shuffle_key")
        .sortWithinPartitions("shuffle_key")
    )
    if (highest or 0) < 1 << 31:
        mixed = mixed.withColumn("copy", F.col("copy").cast("int"))
    kept = [c for c in df.columns if c.lower() not in ("copy", "shuffle_key")]
    return mixed.select(*[F.col("row").getField(c).alias(c) for c in kept], "copy", "shuffle_key")
