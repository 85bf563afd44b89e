"""Language of whole texts by a string kernel.

A text is the set of its byte n-grams of one to four bytes (the blended spectrum, after
lower-casing), hashed to 2^20 places. The kernel of two texts is the number of n-grams
both have, over the root of the product of their numbers, counted over the n-grams that
any landmark has. Landmarks are texts of the fitting sample; with K their kernel matrix
U L U', a text's Nystroem features are its kernels with the landmarks times U L^-1/2, and
one ridge regression per language is fitted on them. A batch of texts is scored by two
matrix products: presence by landmarks, kernels by languages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import batches_of, held_out, rows_of, small_batches
from .sampling import per_class

ORDERS = 4
PLACES = 1 << 20
PART = 1 << 20
# Bounds of the fitting sample and the model.
FIT_ROWS = 3000
LANDMARKS = 128
RIDGE = 1e-3
UNKNOWN = "und"

PREDICTED = "doc_id long, lang_pred string, score double"
GRAMS = "doc_id long, lang string, grams binary"


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def gram_places(text: str) -> Iterator[np.ndarray]:
    """The places of all n-grams of a text, part by part; parts overlap, so none is missed."""
    data = text.lower().encode("utf-8", "replace")
    for start in range(0, max(1, len(data) - ORDERS + 1), PART):
        byte = np.frombuffer(data, np.uint8, min(PART + ORDERS - 1, len(data) - start), start)
        byte = byte.astype(np.uint32)
        code = byte
        for order in range(1, ORDERS + 1):
            if order > 1:
                code = (code[:-1] << np.uint32(8)) | byte[order - 1 :]
            yield ((code ^ np.uint32(order * 0x9E3779B9 & 0xFFFFFFFF)) * np.uint32(2654435761)) >> np.uint32(12)


def gram_set(text: str) -> np.ndarray:
    flags = np.zeros(PLACES, bool)
    for places in gram_places(text):
        flags[places] = True
    return np.flatnonzero(flags).astype(np.uint32)


class Model:
    """``columns`` maps a place to a landmark n-gram's column, the last one for all others."""

    def __init__(self, sets: list[np.ndarray], labels: list[str]):
        self.labels = sorted(set(labels))
        by_label = {l: [s for s, m in zip(sets, labels) if m == l] for l in self.labels}
        each = max(1, LANDMARKS // max(1, len(self.labels)))
        landmarks = [s for l in self.labels for s in by_label[l][:each]]
        grams = np.unique(np.concatenate(landmarks))
        self.width = len(grams)
        self.columns = np.full(PLACES, self.width, np.int32)
        self.columns[grams] = np.arange(self.width)
        self.landmarks = np.zeros((self.width + 1, len(landmarks)), np.float32)
        for k, s in enumerate(landmarks):
            self.landmarks[self.columns[s], k] = 1
        self.landmarks[self.width] = 0
        self.landmarks /= np.sqrt(np.maximum(self.landmarks.sum(0), 1))
        values, vectors = np.linalg.eigh(self.kernels(landmarks).astype(np.float64))
        sound = values > 1e-6 * values.max()
        features = vectors[:, sound] / np.sqrt(values[sound])
        points = np.concatenate(
            [self.kernels(sets[k : k + 256]) for k in range(0, len(sets), 256)]
        ) @ features
        goal = np.where(np.array(labels)[:, None] == np.array(self.labels)[None, :], 1.0, -1.0)
        # Classes weigh alike, whatever their share of the sample.
        weight = 1 / np.array([len(by_label[l]) for l in labels])
        left = points.T @ (points * weight[:, None]) + RIDGE * np.eye(points.shape[1])
        self.weights = (features @ np.linalg.solve(left, points.T @ (goal * weight[:, None]))).astype(np.float32)

    def kernels(self, sets: list[np.ndarray]) -> np.ndarray:
        present = np.zeros((len(sets), self.width + 1), np.float32)
        for k, s in enumerate(sets):
            present[k, self.columns[s]] = 1
        return self._kernels(present)

    def _kernels(self, present: np.ndarray) -> np.ndarray:
        present[:, self.width] = 0
        return (present @ self.landmarks) / np.sqrt(np.maximum(present.sum(1), 1))[:, None]

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        present = np.zeros((len(texts), self.width + 1), np.float32)
        for k, text in enumerate(texts):
            row = present[k]
            for places in gram_places(text):
                row[self.columns[places]] = 1
        scores = self._kernels(present) @ self.weights
        best = scores.argmax(1)
        sure = np.clip((scores.max(1) + 1) / 2, 0, 1)
        return [(self.labels[b], float(s)) for b, s in zip(best, sure)]


def fit(df: DataFrame, rows: int = FIT_ROWS) -> Model | None:
    """A model of the languages of ``df`` (doc_id, text, lang), learnt from at most about
    ``rows`` rows; what reaches the driver are their n-gram sets. Rows are drawn by id and
    text, and equal ones are one row. None without such rows."""
    known = df.select("doc_id", "lang", "text", F.xxhash64("text").alias("content")).filter(
        ~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    )
    sample, _ = per_class(known, "lang", ["doc_id", "content"], rows)

    def grams(batches):
        for doc_id, lang, text in rows_of(batches, ["doc_id", "lang", "text"]):
            yield doc_id, lang, gram_set(text).tobytes()

    found = sample.mapInArrow(lambda b: batches_of(grams(b), GRAMS, 64), GRAMS)
    found = sorted(found.collect(), key=lambda r: (r.lang, -1 if r.doc_id is None else r.doc_id, r.grams))
    if not found:
        return None
    order = np.random.default_rng(0).permutation(len(found))
    return Model(
        [np.frombuffer(found[k].grams, np.uint32) for k in order], [found[k].lang for k in order]
    )


def predict(df: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, lang_pred and score of every row of ``df`` (doc_id, text).

    A text that is null or has no letter is ``und`` with score 0, and so is every text
    when there is no model. Repeated rows are predicted once each; other columns are not
    read.
    """
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        found = shared.value
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            clear = [k for k, t in enumerate(texts) if found is not None and has_letter(t)]
            answers = [(UNKNOWN, 0.0)] * len(ids)
            for at in range(0, len(clear), 128):
                part = clear[at : at + 128]
                for k, answer in zip(part, found.predict([texts[k] for k in part])):
                    answers[k] = answer
            yield from ((d, *a) for d, a in zip(ids, answers))

    return df.select("doc_id", "text").mapInArrow(
        lambda b: batches_of(run(b), PREDICTED), PREDICTED
    )
