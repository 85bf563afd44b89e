"""Documents with very many copies are dealt out in blocks."""

import tracemalloc

import numpy as np
import pytest

from parcelwise.llm import mixing


def test_blocks_hold_the_same_copies(spark, monkeypatch):
    values = [(k, "ten chars." * 50, "big") for k in range(20)] + [(100, "tiny", "small"), (101, "tiny", None)]
    df = spark.createDataFrame(values, "doc_id long, text string, source string")
    whole = sorted((r.doc_id, r.copy, r.shuffle_key) for r in mixing.mix(df).collect())
    monkeypatch.setattr(mixing, "BLOCK", 100)
    cut = mixing.mix(df)
    assert sorted((r.doc_id, r.copy, r.shuffle_key) for r in cut.collect()) == whole
    assert sum(d == 100 for d, _, _ in whole) > 500 and dict(cut.dtypes)["copy"] == "int"


@pytest.mark.parametrize("rate", [2e7, 3e9])
def test_tables_of_high_rates_are_small(rate):
    tracemalloc.start()
    first, below = mixing.poisson_table(rate)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200_000_000
    counts = first + np.searchsorted(below, (np.arange(20_000) + 0.5) / 20_000, "right")
    assert counts.mean() == pytest.approx(rate, rel=1e-6) and counts.var() == pytest.approx(rate, rel=0.05)
