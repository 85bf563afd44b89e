"""Texts that hold a vocabulary's added tokens: ids are those of the library's plain call."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from parcelwise.llm import packing, queries, tokens
from parcelwise.llm.tokens import vocabulary

from .test_packing_and_id_files import ODD

END = "<|endoftext|>"
TOLD = [
    f"{END} a", f"a {END} b", f"a{END}b", f"word{END}. c", f"a\n{END}\nb", f"a {END}\nb", f"a\n{END} b", END, END * 3,
    f"a  {END}  \n b", f"{END}\n\n{END}", f"a. {END}, b", "x <|startoftext|> y", "x<|startoftext|>\ny", "A <|ENDOFTEXT|> b",
    f"ΑΣ{END}Σ É{END}", f"a\t{END}\tb", f"<|{END}|>", "<|endof text|>", f"it's{END}'s",
]


@pytest.mark.parametrize("name, encoder", [("byte_bpe_50k.json", queries.byte_words), ("word_bpe_49k.json", queries.folded_words)])
def test_added_tokens_get_their_ids(spark, tiny, name, encoder):
    library = Tokenizer.from_file(vocabulary(name))
    made = encoder()
    texts = ODD + TOLD + [r.text for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()]
    for text in [*texts, *texts]:
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(made.encode(text), "<u4").tolist() == expected, text[:80]


# What random texts are put together from: white space of all kinds, controls, NUL, marks.
PARTS = [
    "a", "ab", "Word", "the", " ", " ", "  ", "\n", " \n", "\n\n", "\t", "\0", "\0ab", "\0?", "?", ".", ",", "'s", "é", "É",
    "ß", "Σ", "İ", "ŉ", "1", "23", END, "<|startoftext|>", "\x1c", "\x85", "\u3000", "\xa0", "\u0301", "漢字", "\r\n", "\x01",
    "-", "##", "...", "$%", "_", "'", '"', "(", "<|", "\ufeff", "🙂",
]


@pytest.mark.parametrize("name, folds", [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
@pytest.mark.parametrize("backwards", [False, True])
def test_random_texts_get_the_ids_of_the_library(monkeypatch, name, folds, backwards):
    """Ids do not depend on the texts met before, nor on what the caches still hold."""
    monkeypatch.setattr(tokens, "PIECES", 400)
    library, made = Tokenizer.from_file(vocabulary(name)), tokens.Encoder(vocabulary(name), folds, added=True)
    draw = random.Random(11)
    texts = ["".join(draw.choice(PARTS) for _ in range(draw.randrange(14))) for _ in range(6000)]
    texts += ["x \0ab", "ab", "ab cd", "x \0?", "?"]
    texts += ["".join(map(chr, range(b, b + 16))) for b in range(0, 0x600, 16)]
    for text in reversed(texts) if backwards else texts:
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(made.encode(text), "<u4").tolist() == expected, repr(text)
    assert len(made._new) <= 2 * tokens.PIECES
    made.forget()
    assert made.encode("ab cd") == np.array(library.encode("ab cd", add_special_tokens=False).ids, "<u4").tobytes()


def test_results_carry_the_ids_of_the_library(spark, tiny):
    """Queries 2 and 4 against the library's plain call, document by document."""
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()}
    ids = lambda library, t, end: np.array([*library.encode(t, add_special_tokens=False).ids, end], "<u4")
    library = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    start = 0
    for r in sorted(queries.op4_simple8b_id_files(spark, tiny).collect()):
        expected = ids(library, texts[r.doc_id], 1)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(expected), zlib.crc32(expected.tobytes()))
        start += len(expected)
    library = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    expected = {d: ids(library, t, 0) for d, t in texts.items()}
    for r in queries.op2_sum_of_squares_packing(spark, tiny).collect():
        mine = expected[r.doc_id]
        assert r.doc_tokens == len(mine)
        assert r.ids_crc32 == zlib.crc32(mine[r.start : r.start + r.length].tobytes())


def test_packing_counts_an_added_token_once(spark):
    df = spark.createDataFrame([(1, f"a {END} b")], "doc_id long, text string")
    (piece,) = packing.pack(df, queries.byte_words, 64).collect()
    assert piece.doc_tokens == 5  # a, space, <|endoftext|>, b and the end
