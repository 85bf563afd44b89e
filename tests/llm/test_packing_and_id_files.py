"""Packing and id files against the texts' own ids."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from parcelwise.llm import id_files, packing, queries
from parcelwise.llm.tokens import Encoder, vocabulary

ODD = [
    "", " ", "  a", "a  ", "a   b", "a \n b", "\n\nx\ny z\n", "it's  we'll\t\tgo", "　x y\xa0z w",
    "a\x1cb \x1c c", "É é ́x", "<b> 12 345  \r\n x", "x\n", "\nx", "a b\n\nc d", "a.\nB c.\nD\nE f",
    "ΑΣ Σ. ΣΑΣ!", "x.) y! z?)", "İI ǅ ß ſ.", "<|endoftext|> a", "word " * 3000, "\n" * 50, "x" * 2000,
]


def rows(spark, values):
    return spark.createDataFrame(values, "doc_id long, text string, start long, sequence_id string")


@pytest.mark.parametrize("name, folds", [("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)])
def test_ids_equal_the_library_run_over_whole_texts(spark, tiny, name, folds):
    library = Tokenizer.from_file(vocabulary(name))
    library.encode_special_tokens = True
    encoder = Encoder(vocabulary(name), folds)
    texts = ODD + [r.text for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()]
    for text in [*texts, *texts]:
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == expected


def check_pieces(pieces, documents, window):
    """Each id of each document in exactly one piece, sequences gapless."""
    encoder = queries.byte_words()
    whole = defaultdict(list)
    for doc_id, text in documents:
        whole[doc_id].append(np.frombuffer(encoder.encode(text) + bytes(4), "<u4"))
    sequences, covered = defaultdict(list), defaultdict(int)
    for p in pieces:
        ids = whole[p.doc_id][0]
        assert p.doc_tokens == len(ids)
        assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())
        sequences[p.sequence_id].append((p.offset, p.length))
        covered[p.doc_id, p.start] += 1
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end and length > 0
            end += length
        assert end <= window
    for doc_id, copies in whole.items():
        mine = sorted((p.start, p.length) for p in pieces if p.doc_id == doc_id)
        assert sum(n for _, n in mine) == sum(len(c) for c in copies)
        if len(copies) == 1:
            assert [s for s, _ in mine] == [0, *np.cumsum([n for _, n in mine])[:-1].tolist()]
    return sequences


def test_packing_covers_every_id_with_little_padding(spark, tiny):
    documents = [(r.doc_id, r.text) for r in spark.read.parquet(f"{tiny}/documents.parquet").collect()]
    pieces = queries.op2_sum_of_squares_packing(spark, tiny).collect()
    sequences = check_pieces(pieces, documents, 1024)
    total = sum(p.length for p in pieces)
    tasks = len({s >> 33 for s in sequences})
    assert len(sequences) * 1024 - total < tasks * 1024


def test_packing_of_odd_rows(spark):
    values = [(k, text) for k, text in enumerate(ODD)] + [(None, "a"), (7_000_000_000_000_000_001, None), (3, ODD[3])]
    df = rows(spark, [(*v, 0, "x") for v in values]).repartition(3)
    pieces = packing.pack(df, queries.byte_words, 64).collect()
    check_pieces(pieces, values, 64)
    assert packing.pack(df.limit(0), queries.byte_words).count() == 0


def test_the_level_with_the_least_sum_of_squares_is_chosen():
    rng = np.random.default_rng(1)
    for _ in range(300):
        packer = packing.Packer(12)
        packer.level[1:12] = rng.integers(0, 4, 11)
        size = int(rng.integers(1, 12))
        sums = {}
        for fill in range(0, 12 - size + 1):
            if fill == 0 or packer.level[fill]:
                after = packer.level.copy()
                after[fill] -= fill > 0
                after[fill + size] += 1
                sums[fill] = int((after[1:12] ** 2).sum())
        best = min(sums.values())
        assert packer.choose(size) == max(f for f, s in sums.items() if s == best)


def test_blocks_round_trip_with_escapes():
    rng = np.random.default_rng(2)
    for n in [0, 1, 2, 59, 60, 61, 5000]:
        for top in [0, 1, 16, 30, 59, 60, 63]:
            ids = rng.integers(0, 2**top, n, dtype=np.uint64, endpoint=True)
            ids = ids >> rng.integers(0, top + 1, n).astype(np.uint64)
            words = id_files.encode_block(ids)
            assert id_files.decode_block(words, n).tolist() == ids.tolist()
    full = np.full(100, 2**64 - 1, np.uint64)
    assert id_files.decode_block(id_files.encode_block(full), 100).tolist() == full.tolist()
    assert len(id_files.encode_block(np.zeros(600, np.uint64))) == 10


def test_files_hold_all_documents_in_order(spark):
    values = [(k * 3, text) for k, text in enumerate(ODD)] + [(None, "z"), (None, "y"), (6, "again"), (5, None)]
    df = rows(spark, [(*v, 0, "x") for v in values]).repartition(3)
    found = sorted(id_files.encode_and_read(df, queries.folded_words, 1).collect(), key=lambda r: r.start)
    encoder = queries.folded_words()
    assert [r.doc_id for r in found] == sorted((v[0] for v in values), key=lambda d: (d is not None, d))
    start, left = 0, [(d, encoder.encode(t) + b"\1\0\0\0") for d, t in values]
    for r in found:
        assert r.start == start
        start += r.n_tokens
        match = [x for x in left if x[0] == r.doc_id and zlib.crc32(x[1]) == r.ids_crc32 and len(x[1]) == 4 * r.n_tokens]
        left.remove(match[0])
    assert left == []
    assert id_files.encode_and_read(df.limit(0), queries.folded_words, 1).count() == 0
