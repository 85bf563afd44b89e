"""Phrase collocations, adaptive quality rules and ranked search against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelwise.llm import phrases, ranked, thresholds

DOCUMENT = "doc_id long, text string, lang string, source string, rank string, kept double, n long, score string"
ODD = [
    (None, "the word of the day", None), (1, None, "en"), (2, "", None), (3, " \t\n", "en"), (4, "#$% 12 !?", "und"),
    (5, "A a a a. a a", "en"), (5, "A a a a. a a", "en"), (6, "ab " * 40_000, "en"), (7, "é É ß", "de"), (8, "x" * 200_000, "de"),
]


def documents(spark, rows):
    return spark.createDataFrame([(d, t, l, "s", "x", 0.0, 1, "y") for d, t, l in rows], DOCUMENT)


def some_rows(seed=1, n=120):
    draw = random.Random(seed)
    words = ["the", "of", "And", "red", "green", "blue", "fox", "ran", "far", "ça", "zoë"]
    out = []
    for k in range(n):
        text = "".join(
            draw.choice(["New York city ", "a b a b a ", "of the ", *[w + " " for w in words], ". ", ",", "\n", "!\t", "\r\n"])
            for _ in range(draw.randrange(80))
        )
        out.append((k, text, draw.choice(["en", "de", None])))
    return out


def counted(rows, longest):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang in rows:
        lang = lang or "und"
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    return f, n


def brute_collocations(rows, longest, least, first):
    f, n = counted(rows, longest)
    out = []
    for lang, found in f.items():
        often = {p: a for p, a in found.items() if len(p) > 1 and a >= least}
        scored = []
        for p, a in often.items():
            if any(
                len(q) > len(p) and b >= a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in often.items()
            ):
                continue
            score, k = min((1000 * a * n[lang] // (found[p[:k]] * found[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), found[p[:k]], found[p[k:]]))
        for rank, (score, a, p, l, r) in enumerate(sorted(scored)[:first], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("longest, least, first", [(5, 5, 2000), (3, 8, 7), (4, 1, 10_000)])
def test_collocations_equal_brute_force(spark, longest, least, first):
    rows = some_rows() + [r for r in ODD if len(r[1] or "") < 1000]
    found = phrases.collocations(documents(spark, rows).repartition(5), longest, least, first)
    assert sorted(map(tuple, found.collect())) == brute_collocations(rows, longest, least, first)


def test_collocations_of_odd_texts(spark):
    found = phrases.collocations(documents(spark, ODD), least=100)
    assert sorted(map(tuple, found.collect())) == brute_collocations(ODD, 5, 100, 2000)
    assert phrases.collocations(documents(spark, ODD).limit(0)).count() == 0


def test_maps_let_all_frequent_hashes_through(spark):
    h = np.arange(5000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    rows = spark.createDataFrame([(int(x),) for x in h.view(np.int64)], "h long")
    assert phrases.bits_of(rows)[h].all()
    small = phrases.bits_of(rows, most=1 << 16)
    assert small.size == 1 << 16 and small[h].all()
    others = h + np.uint64(12345)
    assert phrases.bits_of(rows)[others].mean() < 0.1


def test_a_full_map_changes_no_count(spark, monkeypatch):
    """Where the map lets everything through, windows are longer and counts are the same."""
    rows = some_rows(2, 60)
    monkeypatch.setattr(phrases.Bits, "__getitem__", lambda self, h: np.ones(len(h), bool))
    found = phrases.collocations(documents(spark, rows), 5, 4, 500)
    assert sorted(map(tuple, found.collect())) == brute_collocations(rows, 5, 4, 500)


def test_long_texts_are_split_between_words(monkeypatch):
    codes = phrases.Codes()
    text = ("some words, and more\tof them. " * 50).encode()
    whole = np.concatenate(phrases.encode(text, codes))
    monkeypatch.setattr(phrases, "PART", 16)
    assert np.array_equal(np.concatenate(phrases.encode(text, codes)), whole)


def test_products_beyond_64_bits_are_exact(spark):
    n, a = 9 * 10**17, 10**14 + 1
    one = spark.createDataFrame([("en", [b"a", b"b"], "a b", a)], "lang string, words array<binary>, phrase string, f long")
    parts = spark.createDataFrame([("en", "a", 3 * 10**14), ("en", "b", 7 * 10**14)], "lang string, phrase string, f long")
    got = phrases.lowest_cuts(one, parts, spark.createDataFrame([("en", n)], "lang string, n long")).first()
    assert got["score"] == 1000 * a * n // (3 * 10**14 * 7 * 10**14)


def brute_measures(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    places = defaultdict(list)
    for k in range(len(w) - 7):
        places[tuple(w[k : k + 8])].append(k)
    covered = {k + j for at in places.values() if len(at) > 1 for k in at for j in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_base_measures_equal_brute_force():
    draw = random.Random(3)
    for k in range(300):
        text = "".join(draw.choice(["a b c d ", "e ", "é", "#", "|\n", "\x0b", "\x1c", " ", " x", "\n", "$ <>"]) for _ in range(k))
        assert thresholds.base_measures(text) == brute_measures(text)
    for _, text, _ in ODD:
        assert thresholds.base_measures(text) == brute_measures(text)


def cut(v):
    spare = max(v.bit_length() - 6, 0)
    return v >> spare << spare


def brute_verdicts(rows, enough):
    """rows: (doc_id, text, lang, source)."""
    out, groups = [], defaultdict(lambda: defaultdict(list))
    for d, text, lang, source in rows:
        m = brute_measures(text)
        failed = m[0] < 20 or 100 * m[4] > 30 * m[0]
        values = {}
        if not failed:
            for rule, (top, scale, _) in thresholds.RULES.items():
                values[rule] = scale * m[thresholds.BASE.index(top)] // m[0]
                for key in ((lang, source), (lang,), ()):
                    groups[key][rule].append(cut(values[rule]))
        out.append((d, lang, source, m, failed, values))

    def inside(lang, source, values):
        key = next((k for k in ((lang, source), (lang,)) if len(groups[k]["symbols"]) >= enough), ())
        for rule, v in values.items():
            held = sorted(groups[key][rule])
            q1, q3 = (held[math.ceil(part * len(held) / 4) - 1] for part in (1, 3))
            spread = max(thresholds.REACH * (q3 - q1), thresholds.RULES[rule][2])
            if not q1 - spread <= v <= q3 + spread:
                return False
        return True

    return [(d, *m, failed, not failed and inside(lang, source, values)) for d, lang, source, m, failed, values in out]


def rated(seed=5):
    draw = random.Random(seed)
    rows = []
    for k in range(400):
        lang, source = draw.choice([("en", "a"), ("en", "b"), ("de", "a"), (None, None), ("fr", "rare" if k % 40 else None)])
        size = 4 if lang == "en" else 9
        words = ["".join(draw.choice("abcdefgh") for _ in range(draw.randrange(1, 2 * size))) for _ in range(draw.randrange(5, 90))]
        if k % 17 == 0:
            words = [w + "###" for w in words]
        if k % 23 == 0:
            words = ["z"] * 30 + words
        rows.append((k % 350, " ".join(words) + "\nsame\n" * (k % 3), lang, source))
    return rows + [(None, None, "en", "a"), (None, "", None, "b"), (900, "w" * 100_000, "en", "a")]


@pytest.mark.parametrize("enough", [1, 50, 10_000])
def test_verdicts_equal_brute_force(spark, enough):
    rows = rated()
    df = spark.createDataFrame([(*r, "x", True) for r in rows], "doc_id long, text string, lang string, source string, n_words string, kept boolean")
    got = thresholds.judge(df.repartition(7), enough)
    assert got.columns == ["doc_id", *thresholds.BASE, "base_failed", "kept"]
    key = lambda r: tuple((x is not None, x) for x in r)
    expected = brute_verdicts(rows, enough)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(expected, key=key)
    # keep() returns the rows themselves, with clashing columns unchanged.
    kept = thresholds.keep(df, enough)
    assert kept.columns == df.columns and kept.filter("n_words <> 'x' or not kept").count() == 0
    assert kept.count() == sum(r[-1] for r in expected)
    assert thresholds.judge(df.limit(0), enough).count() == 0 == thresholds.keep(df.limit(0), enough).count()


def test_sketches_merge_in_any_order(spark):
    rows = spark.createDataFrame([(*r,) for r in rated()], "doc_id long, text string, lang string, source string")
    measured = thresholds.measure(rows, ["doc_id"]).cache()
    whole = thresholds.merged(thresholds.sketches(measured), ["lang"])
    halves = [thresholds.sketches(measured.filter(F.pmod("n_words", F.lit(2)) == k)) for k in (0, 1)]
    again = thresholds.merged(halves[0].union(halves[1]), ["lang"])
    assert sorted(map(str, whole.collect())) == sorted(map(str, again.collect()))


def lexical(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def brute_search(rows, items, k):
    bags = [(d, Counter(lexical(t))) for d, t, _ in rows]
    bags = [(d, b) for d, b in bags if b]
    total, length = len(bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = defaultdict(set)
    for item, text in items:
        asked[item] |= set(lexical(text))
    out = []
    for item, wanted in asked.items():
        scored = []
        for d, b in bags:
            m = 10 + 90 * b.total() * total // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m))
                for t in wanted if b[t]
            )
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(item, rank, None if no else d, -s) for rank, (s, no, d) in enumerate(sorted(scored)[:k], 1)]
    return out


def searched(n=1500):
    draw = random.Random(9)
    common = [f"w{j}" for j in range(12)]
    rows = []
    for d in range(n):
        words = [draw.choice(common) for _ in range(draw.randrange(25))] + [f"r{draw.randrange(200)}" for _ in range(draw.randrange(6))]
        rows.append((draw.randrange(3 * n) if d % 50 else None, " ".join(words), "en"))
    # Many copies of one text: ties beyond any block.
    return rows + [(5000 + j, "W1-w2 copied", "en") for j in range(400)] + ODD


ITEMS = [(1, "w1 w2 r3 r17 copied"), (2, "W5"), (3, None), (4, "..."), (5, "nowhere"), (6, "w1 " * 500 + "é"), (1, "r9"), (None, "w3 r5"), (7, "w0 w1 w2 w3 w4 w5 w6")]


@pytest.mark.parametrize("shard, block", [(2048, 128), (300, 8), (64, 3)])
def test_ranked_search_equals_brute_force(spark, monkeypatch, shard, block):
    rows = searched()
    df = documents(spark, rows).repartition(6)
    items = spark.createDataFrame([(*i, "x") for i in ITEMS], "item_id long, text string, doc_id string")
    vocabulary = {t: c for c, t in enumerate(sorted({t.encode() for _, x in ITEMS for t in lexical(x)}))}
    vectors = ranked.count_vectors(df, vocabulary).collect()
    live = [r for r in vectors if r["n"]]
    documents_n, length = len(live), sum(r["n"] for r in live)
    weight = ranked.weights(ranked.document_frequencies(ranked.count_vectors(df, vocabulary), len(vocabulary)), documents_n)
    expected = brute_search(rows, ITEMS, 10)
    skipped = 0
    held = [(r["doc_id"], np.frombuffer(r["terms"], "<i4"), ranked.impacts(r["n"], r["counts"], documents_n, length)) for r in live]
    for item in {i for i, _ in ITEMS}:
        codes = np.array(sorted({vocabulary[t.encode()] for i, x in ITEMS if i == item for t in lexical(x)}), np.int64)
        best = ranked.Best(10)
        for start in range(0, len(held), shard):
            part = held[start : start + shard]
            shape = ranked.Shard([d for d, _, _ in part], [(t, v) for _, t, v in part], len(weight), block)
            mine = np.zeros(len(weight), np.int64)
            mine[codes] = weight[codes]
            skipped += shape.search(codes, mine, best)
        scores, missing, ids = [c.tolist() for c in best.rows]
        got = [(item, k, None if no else d, s) for k, (s, no, d) in enumerate(zip(scores, missing, ids), 1)]
        assert got == [r for r in expected if r[0] == item]
    assert skipped > 0 or block > 100
    if block > 100:
        found = ranked.top_k(df, items, 10)
        key = lambda r: (r[0] is None, r[0] or 0, r[1])
        assert sorted(map(tuple, found.collect()), key=key) == sorted(expected, key=key)


def test_items_beyond_one_block_are_searched_too(spark, monkeypatch):
    monkeypatch.setattr(ranked, "PAIRS", 5)
    rows = searched(200)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = ranked.top_k(documents(spark, rows), items, 3)
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, found.collect()), key=key) == sorted(brute_search(rows, ITEMS, 3), key=key)


def test_search_of_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert ranked.top_k(documents(spark, ODD).limit(0), items).count() == 0
    assert ranked.top_k(documents(spark, ODD), items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
    assert ranked.top_k(documents(spark, [(1, None, "en"), (2, "..", "en")]), items).count() == 0
