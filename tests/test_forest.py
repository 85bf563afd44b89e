import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parcelwise.operators import classify, forest
from parcelwise.sources import models

COLUMNS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    def noise(name):
        return F.pmod(F.xxhash64("id", F.lit(name)), F.lit(1000)) / 1000

    df = spark.range(8000).select("id", *[noise(c).alias(c) for c in COLUMNS], noise("fold").alias("u"))
    late = (F.col("a") + F.col("b") + F.col("u") > 1.5).cast("int")
    return df.withColumn("late_risk_flag", late).persist()


def grown(df, **settings):
    settings = {"trees": 6, "depth": 4, "min_rows": 20, "seed": 5} | settings
    return forest.grow(df, COLUMNS, "late_risk_flag", ["id"], **settings)


def same(x, y):
    return all(
        np.array_equal(getattr(x, part), getattr(y, part)) for part in ("feature", "cut", "late", "importance")
    )


def test_the_forest_does_not_depend_on_the_partitioning(rows):
    assert same(grown(rows.repartition(4, "id"))[0], grown(rows.repartition(6, "u"))[0])


def test_trees_in_several_scans_of_a_level_are_the_same(rows, monkeypatch):
    whole = grown(rows)[0]
    monkeypatch.setattr(forest, "LEVEL_BYTES", 1)
    assert same(whole, grown(rows)[0])


def test_draws_are_poisson():
    times = forest.draws_per_row()
    assert times.mean() == pytest.approx(1, abs=1e-3) and times.var() == pytest.approx(1, abs=1e-2)
    bits = forest.mixed_bits(np.arange(1 << 16, dtype=np.uint64)) & np.uint64(0xFFFF)
    assert times[bits].mean() == pytest.approx(1, abs=0.02)


def test_leaves_hold_the_shares_of_their_rows(spark, rows):
    """One tree against numpy: every row walks to a leaf, draws are counted there."""
    tree = grown(rows, trees=1, depth=3)[0]
    table = rows.withColumn("draw", F.xxhash64(F.lit(5), "id")).toPandas()
    key = forest.mixed_bits(np.full(1, (5 << 32) + 1, np.uint64))
    bits = forest.mixed_bits(table["draw"].to_numpy().view(np.uint64) ^ key) & np.uint64(0xFFFF)
    weight = forest.draws_per_row()[bits]
    leaf = []
    for values in table[COLUMNS].to_numpy():
        node = 0
        for _ in range(3):
            node = 2 * node + (1 if values[tree.feature[0][node]] <= tree.cut[0][node] else 2)
        leaf.append(node - 7)
    leaf = np.array(leaf)
    for n in set(leaf):
        of = leaf == n
        assert weight[of].sum() >= 20
        assert tree.late[0][n] == pytest.approx(np.average(table["late_risk_flag"][of], weights=weight[of]))
    model_share = classify.score_late_risk(tree, rows).orderBy("id").toPandas()["late_probability"]
    by_id = dict(zip(table["id"], leaf))
    assert [tree.late[0][by_id[i]] for i in range(8000)] == pytest.approx(model_share.to_list())


def test_the_root_cut_is_the_best_of_its_features():
    rng = np.random.default_rng(1)
    sums = rng.integers(0, 9, (3, forest.BINS, 2))
    sums[1:] = [rng.permutation(sums[0]), rng.permutation(sums[0])]

    def gini(n):
        return 2 * n[0] * n[1] / n.sum() if n.sum() else 0.0

    found = {
        (f, b): gini(sums[0].sum(0)) - gini(sums[f, : b + 1].sum(0)) - gini(sums[f, b + 1 :].sum(0))
        for f in range(3)
        for b in range(forest.BINS - 1)
        if min(sums[f, : b + 1].sum(), sums[f, b + 1 :].sum()) >= 30
    }
    f, b, gain, sides = forest.best_cuts(sums, 30)
    assert gain == pytest.approx(max(found.values())) == found[f, b]
    assert sides.tolist() == [*sums[f, : b + 1].sum(0), *sums[f, b + 1 :].sum(0)]


def test_fold_forests_have_not_seen_their_fold(rows):
    fold = (F.col("id") % 3).cast("int")
    together = grown(rows, fold=fold, folds=3)
    turned = F.when(fold == 1, 1 - F.col("late_risk_flag")).otherwise(F.col("late_risk_flag"))
    other = grown(rows.withColumn("late_risk_flag", turned), fold=fold, folds=3)
    assert [same(x, y) for x, y in zip(together, other)] == [False, True, False]


def test_few_values_constants_and_no_rows(spark, rows):
    assert forest.bin_edges(np.array([3.0, 3.0])).tolist() == []
    assert forest.bin_edges(np.array([1.0, 2.0, 4.0])).tolist() == [1.5, 3.0]
    assert len(forest.bin_edges(np.arange(1000.0))) == forest.BINS - 1
    hot = forest.bin_edges(np.concatenate([np.zeros(9000), np.arange(1000.0)]))
    assert len(hot) < forest.BINS and (np.diff(hot) > 0).all()
    flat = grown(rows.withColumn("late_risk_flag", F.lit(1)))[0]
    assert np.isinf(flat.cut).all() and flat.importance.sum() == 0
    assert {r[0] for r in classify.score_late_risk(flat, rows).select("late_probability").distinct().collect()} == {1.0}
    none = grown(rows.filter("id < 0"))[0]
    assert {r[0] for r in classify.score_late_risk(none, rows).select("late_probability").distinct().collect()} == {0.0}


def test_missing_features_have_no_score_and_models_survive_saving(rows, tmp_path):
    model = grown(rows)[0]
    holed = rows.withColumn("b", F.when(F.col("id") >= 10, F.col("b")))
    models.save_model(model, str(tmp_path / "m"))
    models.save_model(model, str(tmp_path / "m"))
    again = models.load_model(str(tmp_path / "m"))
    assert same(model, again) and again.features == COLUMNS
    scored = classify.score_late_risk(again, holed)
    assert scored.filter("late_probability is null and predicted_late is null").count() == 10


@pytest.mark.parametrize("levels", [0, 1, 5, 6, 7, 8])
def test_leaves_looked_up_are_those_walked_to(levels):
    """Also below more levels than a word of leaves covers, and where nodes are not divided."""
    rng = np.random.default_rng(levels)
    sizes, n, inner = [7, 32, 5], 3000, (1 << levels) - 1
    bins = np.stack([rng.integers(0, size, n) for size in sizes])
    feature = rng.integers(0, 3, inner)
    cut = np.where(rng.random(inner) < 0.2, 32, rng.integers(0, 32, inner) % np.array(sizes)[feature])
    found = forest.leaves(
        feature, cut, *forest.leaf_tables(feature, cut, sizes, levels), bins, forest.pair_places(bins, sizes), forest.Room()
    )
    node = np.zeros(n, int)
    for _ in range(levels):
        node = 2 * node + 1 + (bins[feature[node], np.arange(n)] > cut[node])
    assert (found == node - inner).all()


def test_scores_of_values_on_cuts_and_of_no_number(spark):
    model = forest.Forest(
        ["a", "b"], np.array([[0, 1, 1]], np.int32), np.array([[1.5, np.inf, -2.0]]), np.array([[0.1, 0.2, 0.3, 0.4]]), np.zeros(2)
    )
    rows = [(1.5, 9.0, 0.1), (1.6, -2.0, 0.3), (1.6, -1.9, 0.4), (float("nan"), 0.0, 0.1), (float("inf"), float("nan"), 0.3)]
    df = spark.createDataFrame(rows, "a double, b double, expected double")
    scored = classify.score_late_risk(model, df).collect()
    assert [r["late_probability"] for r in scored] == [r["expected"] for r in scored]


@pytest.mark.parametrize("held", [[-1] * 6, [0, 0, 0, 1, 1, 1]])
def test_runs_of_alike_rows_have_the_sum_of_their_draws(held):
    """Also runs that are longer than what 16 bits hold, and trees of two folds in one word."""
    rng = np.random.default_rng(3)
    n, trees = 60_000, [0, 1, 3, 4, 5]
    alike = np.sort(np.concatenate([np.zeros(40_000, int), rng.integers(1, 6, n - 40_000)]))
    rows = pd.DataFrame({"b0": alike // 2, "label": alike % 2}).astype("int8")
    rows["draw"], rows["fold"] = rng.integers(-(2**62), 2**62, n), rng.integers(0, 2, n).astype("int32")
    state = {"columns": ["b0"], "seed": 9, "trees": trees, "held": np.array(held)}
    batches = [pa.RecordBatch.from_pandas(rows[i : i + 7000], preserve_index=False) for i in range(0, n, 7000)]
    found = list(forest.runs(iter(batches), state))
    assert sum(len(label) for _, label, _ in found) < 60
    for i, t in enumerate(trees):
        key = forest.mixed_bits(np.full(1, (9 << 32) + t // 4 + 1, np.uint64))
        bits = forest.mixed_bits(rows["draw"].to_numpy().view(np.uint64) ^ key) >> np.uint64(16 * (t % 4)) & np.uint64(0xFFFF)
        weight = forest.draws_per_row()[bits] * (rows["fold"] != held[t])
        sums = sum(np.bincount(bins[0] * 2 + label, draws[i].astype(float), minlength=6) for bins, label, draws in found)
        assert sums.tolist() == np.bincount(alike, weight, minlength=6).tolist()


def test_alike_rows_are_stored_next_to_each_other(spark):
    df = spark.range(20_000).selectExpr("id", "id % 5 AS a", "id % 7 AS b", "int(id % 2) AS late_risk_flag")
    binned, _ = forest.binned_rows(df.repartition(6), ["a", "b"], "late_risk_flag", ["id"], 5, None)
    stored = binned.toPandas()
    assert len(stored) == 20_000
    starts = forest.run_starts([stored[c].to_numpy() for c in ("b0", "b1", "label")])
    assert len(starts) <= 70 + binned.rdd.getNumPartitions() + 20_000 // forest.RUN + 1
