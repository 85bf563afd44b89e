"""Anomalous orders: isolation forest (Liu, Ting & Zhou, 2008).

Growing a tree needs 256 rows, so the trees are grown from a small random pool,
one group per tree. Scoring every order is a scan without any shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.keys import unit_draw
from ..functions.numeric import round_half_even
from ..functions.quantile import exact_quantile
from ..sources.tables import stage

# Model inputs and settings.
FEATURES = ["lead_days", "sales_amount", "profit", "discount_rate", "quantity"]
TREES = 100
TREE_ROWS = 256
CONTAMINATION = 0.05
SEED = 42

# Rows the trees draw from.
POOL_ROWS = 4 * TREES * TREE_ROWS
# Times as many rows as the pool holds that are drawn from a table, so that the pool is
# full though some of them lack a feature.
SPARE = 4


def anomaly_features(fact: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    return fact.select(*features).dropna()


def smallest_draws(df: DataFrame, features: list[str], pool_rows: int, seed: int, key: list[str]) -> DataFrame:
    """The ``pool_rows`` rows of the smallest draws, as features and their number of copies.

    A row draws by its key and features. Tasks keep draws below a limit that some ``SPARE``
    times the wanted number pass; of these, stored, the smallest are taken, so the limit
    itself has no influence on the pool. The number of all rows, from which the limit comes,
    is in the files' footers where ``df`` is a stored table: its columns are read once.
    Only where most rows lack a feature are too few below the limit, and a higher one
    takes another scan. Rows equal in key and features are counted before they meet.
    """
    numbers = [F.col(c).cast("double").alias(c) for c in features]
    known = df.dropna(subset=features)
    draw = unit_draw(F.lit(seed), *key, *[F.col(c) for c in features if c not in key])
    drawn = known.select(draw.alias("draw"), *numbers)
    limit = min(1.0, SPARE * pool_rows / max(1, df.count()))
    while True:
        below = drawn.filter(F.col("draw") < limit).groupBy("draw", *features).agg(F.count("*").alias("copies"))
        below = stage(below, "draws")
        found = below.agg(F.sum("copies")).first()[0] or 0
        if found >= pool_rows or limit >= 1.0:
            break
        limit = min(1.0, limit * SPARE * pool_rows / max(1, found))
    # One task orders some SPARE x pool_rows short rows, whatever the size of the table.
    before = Window.orderBy("draw", *features).rowsBetween(Window.unboundedPreceding, -1)
    room = F.lit(pool_rows) - F.coalesce(F.sum("copies").over(before), F.lit(0))
    return (
        below.withColumn("copies", F.least("copies", room))
        .filter("copies > 0")
        .groupBy(*features)
        .agg(F.sum("copies").alias("copies"))
    )


def sample_pool(
    df: DataFrame,
    features: list[str],
    pool_rows: int = POOL_ROWS,
    seed: int = SEED,
    key: list[str] | None = None,
) -> tuple[DataFrame, int]:
    """A random pool of feature rows with their number of copies; and the number of rows it
    was drawn from, or of the pool if ``key`` is given and there are more.

    With ``key``, columns that tell rows apart, the pool is the rows of the smallest draws:
    one scan. Without one, rows are told apart by their features alone, so their copies are
    counted first and each gets its share of the pool. Either way the pool is the same
    under any partitioning, and the rule the same at any size.
    """
    if key:
        pool = stage(smallest_draws(df, features, pool_rows, seed, key), "pool")
        return pool, pool.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    rows = df.dropna(subset=features).select(*[F.col(c).cast("double").alias(c) for c in features])
    total = rows.count()
    share = min(1.0, pool_rows / total) if total else 1.0
    counted = rows.groupBy(*features).agg(F.count("*").alias("copies"))
    part = F.floor(F.col("copies") * share + unit_draw(F.lit(seed), *features))
    counted = counted.withColumn("copies", part).filter("copies > 0")
    return stage(counted, "pool"), total


def sample_for_trees(
    pool: DataFrame,
    features: list[str],
    trees: int = TREES,
    tree_rows: int = TREE_ROWS,
    pool_rows: int = POOL_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """``tree_rows`` random rows of the pool for each tree.

    The pool is small but draws for every tree, so it is dealt out to a given number of
    tasks; Spark would put it into one.
    """
    tasks = int(pool.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = pool.repartition(tasks, *features).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    # Three times as many as needed; the smallest draws among them are taken. Only the
    # trees a row is drawn for become rows.
    enough = min(1.0, 3.0 * tree_rows / pool_rows)
    draws = F.transform(
        F.sequence(F.lit(0), F.lit(trees - 1)),
        lambda tree: F.struct(
            tree.alias("tree"), unit_draw(F.lit(seed + 1), tree, "copy", *features).alias("draw")
        ),
    )
    offered = each.select(
        "copy", *features, F.explode(F.filter(draws, lambda d: d["draw"] < enough)).alias("hit")
    ).select("copy", *features, "hit.tree", "hit.draw")
    order = Window.partitionBy("tree").orderBy("draw", *features, "copy")
    return (
        offered.withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= tree_rows)
        .select("tree", "place", *features)
    )


def _tree_grower(features: list[str], tree_rows: int, seed: int):
    """A function growing one tree from one pandas group.

    Trees are complete binary trees in array form: node i has the children 2i+1
    and 2i+2. Below an early leaf every row turns left.
    """

    def grow(group):
        group = group.sort_values("place")
        tree = int(group["tree"].iloc[0])
        x = group[features].to_numpy(dtype=float)
        depth_limit = max(1, int(np.ceil(np.log2(tree_rows))))
        inner = 2**depth_limit - 1
        feature = np.zeros(inner, dtype=np.int32)
        threshold = np.full(inner, np.inf)
        path = np.zeros(inner + 1)
        rng = np.random.default_rng([seed, tree])

        def average_path(n):
            if n <= 2:
                return float(n == 2)
            return 2.0 * (np.log(n - 1.0) + 0.5772156649) - 2.0 * (n - 1.0) / n

        pending = [(0, 0, np.arange(len(x)))]
        while pending:
            node, depth, members = pending.pop()
            spread = np.ptp(x[members], axis=0) if len(members) > 1 else np.zeros(x.shape[1])
            varying = np.flatnonzero(spread > 0)
            if depth == depth_limit or len(varying) == 0:
                for _ in range(depth_limit - depth):
                    node = 2 * node + 1
                path[node - inner] = depth + average_path(len(members))
                continue
            chosen = int(rng.choice(varying))
            values = x[members, chosen]
            cut = rng.uniform(values.min(), values.max())
            feature[node], threshold[node] = chosen, cut
            left = values <= cut
            pending.append((2 * node + 2, depth + 1, members[~left]))
            pending.append((2 * node + 1, depth + 1, members[left]))
        return pd.DataFrame(
            {"tree": [tree], "feature": [feature], "threshold": [threshold], "path": [path]}
        )

    return grow


@dataclass(frozen=True)
class IsolationForest:
    """Grown trees: a few hundred numbers per tree, whatever the size of the data."""

    features: list[str]
    feature: list[list[int]]
    threshold: list[list[float]]
    path: list[list[float]]
    rows_per_tree: int


def isolation_forest_trees(
    fact: DataFrame,
    features: list[str] = FEATURES,
    trees: int = TREES,
    tree_rows: int = TREE_ROWS,
    seed: int = SEED,
    key: list[str] | None = None,
) -> tuple[DataFrame, int]:
    """One row per tree, and the number of rows each tree was grown from."""
    pool_rows = 4 * trees * tree_rows
    pool, total = sample_pool(fact, features, pool_rows, seed, key)
    samples = sample_for_trees(pool, features, trees, tree_rows, min(pool_rows, max(total, 1)), seed)
    grown = samples.groupBy("tree").applyInPandas(
        _tree_grower(features, tree_rows, seed),
        "tree int, feature array<int>, threshold array<double>, path array<double>",
    )
    return grown, min(tree_rows, total)


def isolation_forest_fit(
    fact: DataFrame,
    features: list[str] = FEATURES,
    trees: int = TREES,
    tree_rows: int = TREE_ROWS,
    seed: int = SEED,
    key: list[str] | None = None,
) -> IsolationForest:
    grown, rows_per_tree = isolation_forest_trees(fact, features, trees, tree_rows, seed, key)
    rows = grown.orderBy("tree").collect()
    return IsolationForest(
        list(features),
        [r["feature"] for r in rows],
        [r["threshold"] for r in rows],
        [r["path"] for r in rows],
        rows_per_tree,
    )


def isolation_forest_score(fact: DataFrame, forest: IsolationForest) -> DataFrame:
    """Add ``anomaly_score`` in (0, 1], null where a feature is null.

    Rows are scored where they are read; pass a stored table.
    """
    n = forest.rows_per_tree
    if n > 2:
        typical = 2.0 * (np.log(n - 1.0) + 0.5772156649) - 2.0 * (n - 1.0) / n
    else:
        typical = 1.0
    shipped = fact.sparkSession.sparkContext.broadcast(
        (
            np.array(forest.feature, dtype=np.int32),
            np.array(forest.threshold, dtype=float),
            np.array(forest.path, dtype=float),
            float(typical),
        )
    )

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        feature, threshold, path, typical_path = shipped.value
        inner = feature.shape[1]
        for columns in batches:
            # A single column comes as a Series and not as a tuple of one.
            columns = (columns,) if isinstance(columns, pd.Series) else columns
            # Feature-major, so that feature f of row i sits at f * rows + i.
            values = np.concatenate([c.to_numpy(dtype=float) for c in columns])
            rows = len(columns[0])
            position = np.arange(rows, dtype=np.int32)
            total = np.zeros(rows)
            for t in range(feature.shape[0]):
                node_offset, cut = feature[t] * np.int32(rows), threshold[t]
                # All rows start at the root: its feature is one slice, not a gather.
                node = 1 + (values[node_offset[0] : node_offset[0] + rows] > cut[0]).astype(np.int32)
                for _ in range(inner.bit_length() - 1):
                    right = values[node_offset[node] + position] > cut[node]
                    node += node
                    node += 1
                    node += right
                total += path[t][node - inner]
            yield pd.Series(np.exp2(-total / (feature.shape[0] * typical_path)))

    inputs = [F.col(c).cast("double") for c in forest.features]
    known = inputs[0].isNotNull()
    for c in inputs[1:]:
        known = known & c.isNotNull()
    return fact.withColumn("anomaly_score", F.when(known, score(*inputs)))


def flag_above(scored: DataFrame, threshold: float | Column | None, score: str) -> DataFrame:
    limit = threshold if isinstance(threshold, Column) else F.lit(threshold).cast("double")
    known = ~F.isnan(F.col(score).cast("double"))
    return scored.withColumn("is_anomaly", F.when(known, (F.col(score) > limit).cast("int")))


def flag_anomalies(
    scored: DataFrame, contamination: float = CONTAMINATION, score: str = "anomaly_score"
) -> DataFrame:
    """Flag scores strictly above the exact (1 - contamination) quantile.

    Scores are read twice; pass a stored table when scoring is costly.
    """
    return flag_above(scored, exact_quantile(scored, score, 1.0 - contamination), score)


def attach_anomaly_flag(
    fact: DataFrame, forest: IsolationForest, threshold: float | None
) -> DataFrame:
    """Score and flag each order where it is; null flag where a feature is missing."""
    return flag_above(isolation_forest_score(fact, forest), threshold, "anomaly_score")


def anomaly_summary(flagged: DataFrame) -> DataFrame:
    """Flagged orders, in number and percent of the orders that have a score."""
    return flagged.agg(
        F.coalesce(F.sum("is_anomaly"), F.lit(0)).alias("anomalies"),
        (F.avg("is_anomaly") * 100).alias("anomaly_pct"),
    )


def monthly_anomaly_rate(flagged: DataFrame) -> DataFrame:
    """Flagged share of the orders of each month and region; null keys are left out."""
    return (
        flagged.dropna(subset=["year_month", "region_name"])
        .groupBy("year_month", "region_name")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.coalesce(F.sum("is_anomaly"), F.lit(0)).alias("anomaly_count"),
        )
        .withColumn(
            "anomaly_rate_pct",
            round_half_even(F.try_divide(F.col("anomaly_count"), F.col("total_orders")) * 100, 2),
        )
    )
