"""Late-delivery classifier.

``lead_days`` is known only once an order has shipped, and it carries nearly all
of the signal. It stays in the default features; pass ``features`` without it to
predict before shipment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.keys import draw, key_text, unit_draw
from ..functions.numeric import ratio_or_zero
from ..sources.tables import stage
from . import forest
from .forest import Forest

LABEL = "late_risk_flag"

# Model inputs and settings.
FEATURES = [
    "lead_days",
    "quantity",
    "sales_amount",
    "discount_rate",
    "profit",
    "region_encoded",
]
UNKNOWN_REGION = "Unknown"
TREES = 100
DEPTH = 8
MIN_ROWS_PER_LEAF = 50
SEED = 42
TEST_PERCENT = 20
FOLDS = 5
# Values of the draw that orders the rows of a label.
DRAWS = 4096


def region_codes(df: DataFrame) -> DataFrame:
    """Region names and their codes 0..k-1 in name order, one row per region.

    Distinct names are dealt out by ranges and numbered in each; a code is the place in the
    range behind the names of earlier ranges, which are counted by range. The ranges are
    stored, as another run of the plan may cut others.
    """
    name = F.coalesce(F.col("region_name"), F.lit(UNKNOWN_REGION))
    names = df.select(name.alias("region_label")).distinct()
    ranged = names.repartitionByRange("region_label").withColumn("range", F.spark_partition_id())
    place = F.row_number().over(Window.partitionBy("range").orderBy("region_label"))
    placed = stage(ranged.withColumn("place", place), "region-names")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("range").agg(F.count("*").alias("n"))
    starts = starts.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    code = (F.col("start") + F.col("place") - 1).cast("int")
    return placed.join(starts, "range").select(code.alias("region_encoded"), "region_label")


def encode_region(df: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """Add ``region_encoded``. ``codes`` are those of ``df`` unless given; the first reading
    of ``df`` finds them, so pass a stored table. Spark broadcasts them by measured size."""
    codes = region_codes(df) if codes is None else codes
    label = F.coalesce(F.col("region_name"), F.lit(UNKNOWN_REGION))
    return df.join(codes, label == F.col("region_label")).drop("region_label")


def classifier_features(
    encoded: DataFrame, features: list[str] = FEATURES, keep: tuple[str, ...] = ()
) -> DataFrame:
    wanted = [*features, LABEL]
    return encoded.dropna(subset=wanted).select(*keep, *wanted)


def label_place(df: DataFrame, key: list[str], seed: int, label: str = LABEL) -> DataFrame:
    """Add ``_place``: how many rows of its label come before a row in the order of a draw.

    Draws have ``DRAWS`` values and rows with one draw share a place, so the counts per
    label and draw are a small table whatever the number of rows. A label of few rows has
    about one row per place: its places run through 0, 1, 2, ... and every share and fold
    gets its part of it. The counts are stored, so that Spark knows their size and need not
    shuffle the rows to meet them. ``df`` is read twice; pass a stored table or a scan of one.
    """
    drawn = df.withColumn("_draw", draw(key_text(key), DRAWS, seed))
    before = Window.partitionBy(label).orderBy("_draw").rowsBetween(Window.unboundedPreceding, -1)
    places = (
        drawn.groupBy(label, "_draw")
        .agg(F.count("*").alias("_n"))
        .select(
            F.col(label).alias("_label"),
            F.col("_draw").alias("_at"),
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_place"),
        )
    )
    same = F.col(label).eqNullSafe(F.col("_label")) & (F.col("_draw") == F.col("_at"))
    # Every row has its place. An inner join would test the draw for null, and so take it twice.
    return drawn.join(stage(places, "places"), same, "left").drop("_draw", "_label", "_at")


def stratified_split(
    df: DataFrame, key: list[str], seed: int = SEED, percent: int = TEST_PERCENT, label: str = LABEL
) -> DataFrame:
    """Add ``is_test``: every label is held out at the same rate, a rare one too."""
    placed = label_place(df, key, seed, label)
    return placed.withColumn("is_test", F.col("_place") * percent % 100 < percent).drop("_place")


def train_late_risk_forest(
    train: DataFrame,
    features: list[str] = FEATURES,
    trees: int = TREES,
    depth: int = DEPTH,
    min_rows: int = MIN_ROWS_PER_LEAF,
    seed: int = SEED,
    max_rows: int | None = None,
    key: list[str] | None = None,
) -> Forest:
    """Random forest; the region code is used as a number, not as a category.

    Each level of all trees is one scan of the binned rows. ``key`` are columns that tell
    rows apart; a tree draws rows by their hash, so the forest does not depend on the
    partitioning. Without a key all columns are it, and equal rows are drawn together.
    ``max_rows`` bounds the rows fitted on by a draw from their content; the default fits
    on all of them. ``train`` is read three times; pass a stored table.
    """
    if max_rows is not None and (total := train.count()) > max_rows:
        train = train.filter(unit_draw(F.lit(seed), *train.columns) < max_rows / total)
    return forest.grow(train, features, LABEL, key or train.columns, trees, depth, min_rows, seed)[0]


def _with_prediction(df: DataFrame, late: Column) -> DataFrame:
    guess = (F.col("late_probability") > 0.5).cast("int")
    return df.withColumn("late_probability", late).withColumn("predicted_late", guess)


def score_late_risk(model: Forest, df: DataFrame) -> DataFrame:
    """Add ``late_probability`` and ``predicted_late``, null where a feature is null."""
    return _with_prediction(df, forest.probability(df, [model]))


def auc_roc(df: DataFrame, score: str, label: str = LABEL, by: tuple[str, ...] = ()) -> DataFrame:
    """Exact area under the ROC curve; tied scores count half. One row, or one per value of ``by``.

    Rows are first added up per score. The scores are then range-partitioned, so
    each range orders its own scores, and only the totals of the ranges, one row per
    shuffle partition, are added up in sequence: no task sees all scores.
    """
    whole = "decimal(38,0)"
    per_score = df.groupBy(*by, F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    ranged = per_score.repartitionByRange(*by, F.desc("score")).withColumn(
        "range", F.spark_partition_id()
    )
    above = Window.partitionBy(*by, "range").orderBy(F.desc("score"))
    before = above.rowsBetween(Window.unboundedPreceding, -1)
    pos_before = F.coalesce(F.sum("pos").over(before), F.lit(0)).cast("decimal(20,0)")
    # Twice the pairs won inside the range: positives above count 2, ties count 1.
    won = F.col("neg").cast("decimal(18,0)") * (pos_before * 2 + F.col("pos"))
    per_range = (
        ranged.withColumn("won", won.cast(whole))
        .groupBy(*by, "range")
        .agg(F.sum("won").alias("won"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    earlier = Window.partitionBy(*by).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    pos_above = F.coalesce(F.sum("pos").over(earlier), F.lit(0)).cast("decimal(18,0)")
    across = (F.col("neg").cast("decimal(18,0)") * pos_above * 2).cast(whole)
    totals = per_range.withColumn("won", (F.col("won") + across).cast(whole)).groupBy(*by).agg(
        F.sum("won").cast("double").alias("won"),
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
    )
    pairs = F.col("positives").cast("double") * F.col("negatives").cast("double")
    return totals.select(
        *by, "positives", "negatives", F.try_divide(F.col("won"), pairs * 2).alias("auc")
    )


def classification_report(
    df: DataFrame, predicted: str = "predicted_late", label: str = LABEL
) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy and the two averages.

    The rows are read once, into a confusion table with one row per pair of
    classes; everything else is arithmetic on that table.
    """
    pairs = (
        df.groupBy(F.col(label).alias("actual"), F.col(predicted).alias("guess"))
        .agg(F.count("*").alias("n"))
    )
    sides = pairs.select(
        "n",
        F.inline(
            F.array(
                F.struct(F.col("actual").alias("class"), F.lit(True).alias("is_actual")),
                F.struct(F.col("guess").alias("class"), F.lit(False).alias("is_actual")),
            )
        ),
        (F.col("actual") == F.col("guess")).alias("hit"),
    )

    def counted(condition):
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    per_class = sides.groupBy("class").agg(
        counted(F.col("is_actual") & F.col("hit")).alias("hits"),
        counted(F.col("is_actual")).alias("support"),
        counted(~F.col("is_actual")).alias("guessed"),
    )
    scored = per_class.select(
        F.col("class").cast("string").alias("class"),
        ratio_or_zero(F.col("hits"), F.col("guessed")).alias("precision"),
        ratio_or_zero(F.col("hits"), F.col("support")).alias("recall"),
        ratio_or_zero(F.col("hits") * 2, F.col("guessed") + F.col("support")).alias("f1_score"),
        "support",
        "hits",
    )
    measures = ["precision", "recall", "f1_score"]
    lines = F.array(
        F.struct(
            F.lit("accuracy").alias("class"),
            *[ratio_or_zero(F.sum("hits"), F.sum("support")).alias(m) for m in measures],
            F.sum("support").alias("support"),
        ),
        F.struct(
            F.lit("macro avg").alias("class"),
            *[F.avg(m).alias(m) for m in measures],
            F.sum("support").alias("support"),
        ),
        F.struct(
            F.lit("weighted avg").alias("class"),
            *[
                ratio_or_zero(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(m)
                for m in measures
            ],
            F.sum("support").alias("support"),
        ),
    )
    return scored.drop("hits").unionByName(scored.agg(lines.alias("lines")).select(F.inline("lines")))


def cross_validated_auc(
    df: DataFrame,
    key: list[str],
    folds: int = FOLDS,
    features: list[str] = FEATURES,
    seed: int = SEED,
    trees: int = TREES,
    depth: int = DEPTH,
    min_rows: int = MIN_ROWS_PER_LEAF,
) -> DataFrame:
    """AUC of each fold's held-out rows, for a forest trained on the other folds.

    All folds' forests grow in the same scans, and one more scan scores every row by the
    forest that has not seen it.
    """
    placed = label_place(df, key, seed)
    folded = stage(placed.withColumn("fold", (F.col("_place") % folds).cast("int")).drop("_place"), "folds")
    fold = F.col("fold")
    forests = forest.grow(folded, features, LABEL, key, trees, depth, min_rows, seed, fold, folds)
    scored = _with_prediction(folded, forest.probability(folded, forests, fold))
    every = df.sparkSession.range(folds).select(F.col("id").cast("int").alias("fold"))
    return every.join(auc_roc(scored, "late_probability", by=("fold",)), "fold", "left").select("fold", "auc")


def feature_importance(df: DataFrame, model: Forest) -> DataFrame:
    """Share of the impurity decrease each feature brings, largest first."""
    return df.sparkSession.createDataFrame(
        [(name, float(weight)) for name, weight in zip(model.features, model.importance)],
        "feature string, importance double",
    ).orderBy(F.desc("importance"), "feature")
