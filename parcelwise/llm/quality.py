"""Quality of whole texts by a byte-level convolutional network in numpy.

Every byte has a learned vector of ``DEPTH`` numbers and one more number, the share of
the last ``LAGS`` places that hold the same byte, by which runs of repeated words stand
out. Chunks of ``WIDTH`` bytes start every ``STEP`` bytes, so they overlap and cover the
whole text. A learned filter gives one number per chunk, the largest over all chunks
stays, and the ``FILTERS`` largest ones are combined by a logistic unit. The network is
fitted by Adam; only the chunk that holds a filter's maximum passes a gradient back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .common import held_out, share_of, small_batches, stage
from .sampling import per_class

DEPTH, LAGS = 7, 20
WIDTH, STEP, FILTERS = 24, 12, 32
# Bounds of the fitting sample: rows, and bytes of the texts of a class.
FIT_ROWS = 6000
FIT_BYTES = 16 << 20
STEPS, BATCH, RATE = 1000, 64, 0.004
# Bytes convolved at once; bounds memory for long texts.
PART = 96 * 1024


def repeats(byte: np.ndarray) -> np.ndarray:
    """Of the LAGS earlier places of each byte, the share that hold the same byte."""
    same = np.zeros(len(byte), np.uint8)
    for lag in range(2, min(LAGS + 2, len(byte))):
        same[lag:] += byte[lag:] == byte[:-lag]
    return same.astype(np.float32) * np.float32(4 / LAGS)


def padded(data: bytes) -> np.ndarray:
    """Bytes of a text, filled with zeros to whole chunks."""
    n = max(WIDTH, len(data))
    n = WIDTH + -(-(n - WIDTH) // STEP) * STEP
    return np.frombuffer(data.ljust(n, b"\0"), np.uint8)


class Network:
    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        channels = DEPTH + 1
        self.params = {
            "vectors": rng.normal(0, 0.5, (256, DEPTH)),
            "filters": rng.normal(0, 1 / np.sqrt(WIDTH * channels), (WIDTH * channels, FILTERS)),
            "bias": np.zeros(FILTERS),
            "out": rng.normal(0, 0.1, FILTERS),
            "base": np.zeros(1),
        }
        self.params = {k: v.astype(np.float32) for k, v in self.params.items()}

    def chunks(self, byte: np.ndarray, same: np.ndarray) -> np.ndarray:
        """One row of WIDTH x (DEPTH + 1) numbers per chunk."""
        channels = np.empty((len(byte), DEPTH + 1), np.float32)
        channels[:, :DEPTH] = self.params["vectors"][byte]
        channels[:, DEPTH] = same
        flat = np.lib.stride_tricks.sliding_window_view(channels.ravel(), WIDTH * (DEPTH + 1))
        return flat[:: STEP * (DEPTH + 1)]

    def pooled(self, data: bytes) -> np.ndarray:
        """The largest answer of each filter over the whole text."""
        byte = padded(data)
        best = np.full(FILTERS, -np.inf, np.float32)
        for at in range(0, len(byte) - WIDTH + 1, PART):
            before = min(at, LAGS + 1)
            part = byte[at - before : at + PART + WIDTH - STEP]
            same = repeats(part)[before:]
            best = np.maximum(best, (self.chunks(part[before:], same) @ self.params["filters"]).max(0))
        return best

    def score(self, texts) -> np.ndarray:
        if not len(texts):
            return np.zeros(0)
        pooled = np.stack([self.pooled((t or "").encode("utf-8", "replace")) for t in texts])
        hidden = np.tanh(pooled + self.params["bias"])
        return 1 / (1 + np.exp(-(hidden @ self.params["out"] + self.params["base"]).astype(np.float64)))

    def tops(self, byte: np.ndarray, same: np.ndarray) -> tuple[np.ndarray, ...]:
        """Per filter: its largest answer over the whole text, the first chunk that gives
        it, and the numbers of that chunk."""
        best = place = held = None
        for at in range(0, len(byte) - WIDTH + 1, PART):
            end = at + PART + WIDTH - STEP
            part = self.chunks(byte[at:end], same[at:end])
            answers = part @ self.params["filters"]
            top = answers.argmax(0)
            value = answers[top, np.arange(FILTERS)]
            if best is None:
                best, place, held = value, top, part[top]
                continue
            better = value > best
            best, place = np.where(better, value, best), np.where(better, top + at // STEP, place)
            held[better] = part[top[better]]
        return best, place, held

    def gradients(self, rows: list[tuple], goals: np.ndarray, weights: np.ndarray) -> dict:
        """Of the weighted log loss over rows of (bytes, repeats)."""
        p = self.params
        grads = {k: np.zeros_like(v) for k, v in p.items()}
        tops = [self.tops(byte, same) for byte, same in rows]
        hidden = np.tanh(np.stack([best for best, _, _ in tops]) + p["bias"])
        score = 1 / (1 + np.exp(-(hidden @ p["out"] + p["base"])))
        error = ((score - goals) * weights / len(rows)).astype(np.float32)
        grads["out"] = hidden.T @ error
        grads["base"] = error.sum(keepdims=True)
        back = error[:, None] * p["out"] * (1 - hidden**2)
        grads["bias"] = back.sum(0)
        wide = p["filters"].T.reshape(FILTERS, WIDTH, DEPTH + 1)
        for (byte, _), (_, place, held), b in zip(rows, tops, back):
            grads["filters"] += held.T * b
            places = place[:, None] * STEP + np.arange(WIDTH)
            np.add.at(grads["vectors"], byte[places], wide[:, :, :DEPTH] * b[:, None, None])
        return grads

    def fit(self, texts: list[str], goals: list[int], weights: list[float], seed: int = 0) -> Network:
        rng = np.random.default_rng(seed)
        rows = [padded(t.encode("utf-8", "replace")) for t in texts]
        rows = [(b, repeats(b)) for b in rows]
        goals, weights = np.array(goals, np.float32), np.array(weights, np.float32)
        first = {k: np.zeros_like(v) for k, v in self.params.items()}
        second = {k: np.zeros_like(v) for k, v in self.params.items()}
        order = np.concatenate(
            [rng.permutation(len(rows)) for _ in range(-(-STEPS * BATCH // len(rows)))]
        )
        for step in range(1, STEPS + 1):
            part = order[(step - 1) * BATCH : step * BATCH]
            grads = self.gradients([rows[k] for k in part], goals[part], weights[part])
            rate = RATE * (1 - step / (STEPS + 1))
            for k, g in grads.items():
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.999 * second[k] + 0.001 * g * g
                grown = first[k] / (1 - 0.9**step)
                self.params[k] -= rate * grown / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
        return self


def fit(documents: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, most: int = FIT_BYTES) -> Network | None:
    """A network fitted to ``labels`` (doc_id, quality 0 or 1), at most about ``rows`` texts of
    them, half of each class, weighted back to the classes' shares. Held-out documents are not
    fitted on; of contradicting labels the lower counts, labels other than 0 and 1 none. None
    without any such text; null texts and rows without an id have no label.

    Texts are drawn by id and content: of rows that repeat an id each text is drawn for
    itself, equal ones are one, and the length has no part in it. Of a class, texts stay in
    the order of the draw until they have ``most`` bytes, so the driver gets at most twice
    that and one text a class. They are fitted on whole.
    """
    known = (
        labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    texts = documents.filter("text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    sized = texts.select("doc_id", "text_hash", F.octet_length("text").cast("long").alias("bytes"))
    key = ["doc_id", "text_hash"]
    sample, classes = per_class(stage(sized.join(known, "doc_id"), "labelled"), "quality", key, rows)
    sizes = {r.quality: r.n for r in classes.collect()}  # at most two
    drawn = share_of(F.lit("order"), F.col("doc_id"), F.col("text_hash"))
    before = Window.partitionBy("quality").orderBy(drawn, *key).rowsBetween(Window.unboundedPreceding, -1)
    sample = sample.withColumn("before", F.coalesce(F.sum("bytes").over(before), F.lit(0)))
    sample = sample.filter(F.col("before") < most).select(*key, "quality")
    found = (
        texts.join(F.broadcast(sample), key)  # about ``rows`` ids
        .dropDuplicates(key)
        .select("doc_id", "quality", "text")
        .collect()
    )
    if not found:
        return None
    found.sort(key=lambda r: (r.doc_id, r.text))
    drawn = {q: sum(r.quality == q for r in found) for q in sizes}
    share = {q: sizes[q] / sum(sizes.values()) / (drawn[q] / len(found)) if drawn[q] else 0.0 for q in sizes}
    return Network().fit(
        [r.text for r in found], [r.quality for r in found], [share[r.quality] for r in found]
    )


def scorer(spark: SparkSession, network: Network | None):
    """A function from a column of texts to their scores, from 0 to 1, higher: label 1 likelier.

    A null text counts as empty, and an empty one as a chunk of zeros; without a network
    every score is 0.5.
    """
    small_batches(spark)
    shared = spark.sparkContext.broadcast(network)

    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        found = shared.value
        for part in texts:
            yield pd.Series([0.5] * len(part) if found is None else found.score(part), dtype="float64")

    return F.pandas_udf(run, "double", F.PandasUDFType.SCALAR_ITER)


def score(df: DataFrame, network: Network | None) -> DataFrame:
    """doc_id and score of every row of ``df`` (doc_id, text); other columns are not read. Rows
    that are repeated each have their score, an empty table has none."""
    return df.select("doc_id", scorer(df.sparkSession, network)("text").alias("score"))


def keep(df: DataFrame, network: Network | None, least: float) -> DataFrame:
    """The rows of ``df`` that score at least ``least``, with their columns as they are."""
    scored = df.select(F.struct("*").alias("row"), scorer(df.sparkSession, network)("text").alias("score"))
    return scored.filter(F.col("score") >= least).select("row.*")
