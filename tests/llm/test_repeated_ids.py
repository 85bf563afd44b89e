"""Rows that repeat a doc_id, or have none, are told apart by their text."""

import pytest

from parcelwise.llm import jaccard

from .test_joins import documents


def words(name):
    return " ".join(f"{name}{k}" for k in range(80))


A, B, C, D, E = map(words, "abcde")
NEAR_B = B.replace("b79", "edited")


@pytest.mark.parametrize("parts", [1, 7])
def test_each_text_of_a_repeated_id_is_a_row_of_its_own(spark, parts):
    values = [
        (0, A), (7, A), (7, B), (9, NEAR_B),  # the copy of 0 goes, B stays for NEAR_B
        (1, C), (1, D), (1, D), (2, C),
        (42, E), (None, None), (None, None), (None, ""), (42, None), (0, ""), (None, E), (None, "z z"),
    ]
    df = documents(spark, values).repartition(parts)
    found = sorted(((r.doc_id, r.text) for r in jaccard.one_of_each(df).collect()), key=repr)
    expected = [
        (0, A), (7, B), (1, C), (1, D), (42, E),
        (None, None), (None, ""), (42, None), (0, ""), (None, "z z"),
    ]
    assert found == sorted(expected, key=repr)


def test_near_texts_of_one_id_are_one_group(spark):
    (row,) = jaccard.one_of_each(documents(spark, [(7, B), (7, NEAR_B), (7, B)])).collect()
    assert row.doc_id == 7 and row.text in (B, NEAR_B)
