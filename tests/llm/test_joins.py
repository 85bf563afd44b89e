"""Vector searches, shingle joins, line dedup and the pipeline against brute force."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from parcelwise.llm import caps, jaccard, lines, shingles, voronoi
from parcelwise.llm.components import components

VECTOR = "vec_id long, embedding array<float>, label int, id string, n string, vector string"
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def roots_of(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def documents(spark, values):
    rows = [(d, t, "en", "s", None if t is None else len(t)) for d, t in values]
    return spark.createDataFrame(rows, DOCUMENT).repartition(3)


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(0)
    links = [(k, k + 1) for k in range(100, 160)] + [(1000, k) for k in range(1001, 1300)] + [(5, 5), (None, 7)]
    links += [(rng.randrange(2000, 2400), rng.randrange(2000, 2400)) for _ in range(250)]
    rng.shuffle(links)
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert found == roots_of({n for link in real for n in link}, real)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    centers = rng.normal(size=(5, 6)) * 300
    rows = [(k, (centers[k % 5] + rng.normal(size=6) * (40 if k % 3 else 0)).astype(int).tolist()) for k in range(1500)]
    rows += [(1500, [0] * 6), (1501, [2**40, -(2**50), 0, 0, 0, 1]), (1502, [7]), (1503, []), (None, [1] * 6), (1504, None)]
    df = spark.createDataFrame(rows, "id long, vector array<long>").repartition(4)
    found = defaultdict(list)
    for r in voronoi.top_k(df.filter("id % 50 = 0 or id > 1499"), df, 5).collect():
        found[r.query_id].append((r["rank"], r.vec_id, r.score))
    usable = [(i, v + [0] * (6 - len(v))) for i, v in rows if i is not None and v is not None]
    for q, v in usable:
        if q % 50 == 0 or q > 1499:
            scores = [(-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q]
            expected = [
                (k + 1, i, max(min(-s, 2**63 - 1), -(2**63) + 1)) for k, (s, i) in enumerate(sorted(scores)[:5])
            ]
            if q != 1501 and not any(i == 1501 for _, i, _ in expected):
                assert sorted(found[q]) == expected
    assert len(found) == len([1 for i, _ in usable if i % 50 == 0 or i > 1499])
    few = df.filter("id < 3")
    assert voronoi.top_k(few, few, 5).count() == 6
    assert voronoi.top_k(df.limit(0), df, 5).count() == 0 and voronoi.top_k(df, df.limit(0), 5).count() == 0


def test_bounds_never_lose_a_neighbour():
    """Needed shells hold every query's k nearest, for clustered data and small cells."""
    rng = np.random.default_rng(3)
    data = np.concatenate([rng.normal(size=(300, 4)) * 0.2 + c for c in rng.normal(size=(6, 4)) * 8])
    pivots = data[rng.choice(len(data), 12, replace=False)]
    far = lambda x: np.sqrt(((x[:, None] - pivots[None]) ** 2).sum(2))
    cell, distance = far(data).argmin(1), far(data).min(1)
    shell = (distance / 0.1).astype(int)
    summary = []
    for c, s in sorted(set(zip(cell.tolist(), shell.tolist()))):
        mine = distance[(cell == c) & (shell == s)]
        summary.append((c, s, len(mine), mine.min(), mine.max()))
    queries = data[:300:20] + 0.05
    q_cell, q_distance = far(queries).argmin(1), far(queries).min(1)
    cells = [(int(c), int((q_cell == c).sum()), float(q_distance[q_cell == c].max())) for c in np.unique(q_cell)]
    runs, needs, totals = voronoi.plan(pivots, summary, cells, 5)
    sent = defaultdict(set)
    for c, s, run in needs:
        sent[run].add((c, s))
    for q, c in zip(queries, q_cell.tolist()):
        for k in np.argsort(((data - q) ** 2).sum(1))[:5]:
            assert (cell[k], shell[k]) in sent[runs[c]]
    assert len(needs) < len(totals) * len(summary) / 2


def brute_links(rows, least):
    usable = {}
    for k, (_, v) in enumerate(rows):
        v = None if v is None or any(x is None or not np.isfinite(x) for x in v) else np.array(v, np.float64)
        if v is not None and v.any():
            usable[k] = v / np.linalg.norm(v)
    keys = list(usable)
    cosines = np.stack([usable[k] for k in keys]) @ np.stack([usable[k] for k in keys]).T
    return [(keys[i], keys[j]) for i, j in zip(*np.nonzero(cosines >= least)) if i < j]


def test_near_duplicate_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    rows, hot = [], rng.normal(size=32)
    for k in range(900):
        kind = k % 3
        v = hot + rng.normal(size=32) * 0.12 if kind == 0 else rng.normal(size=32)
        rows.append((k, v.astype(np.float32).tolist()))
    rows += [(900 + k, rows[1][1]) for k in range(300)]  # copies
    rows += [(1300, None), (1301, [0.0] * 32), (1302, [float("nan")] * 32), (1303, [None] + [1.0] * 31)]
    rows += [(1304, (np.array(rows[4][1]) * 3).tolist()), (1305, []), (1306, [float("inf")] * 32)]
    df = spark.createDataFrame([(*r, 0, "i", "n", "v") for r in rows], VECTOR).repartition(4)
    links = brute_links(rows, 0.95)
    expected_roots = roots_of([r[0] for r in rows], [(rows[a][0], rows[b][0]) for a, b in links])
    counts = defaultdict(int)
    for a, b in links:
        counts[rows[a][0]] += 1
        counts[rows[b][0]] += 1
    found = caps.near_duplicates(df).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.n_links, r.component_id) == (counts[r.vec_id], expected_roots[r.vec_id])
        assert r.kept == (r.vec_id == r.component_id)
    assert caps.near_duplicates(df.limit(0)).count() == 0
    assert caps.near_duplicates(df.filter("vec_id in (1300, 1301)")).count() == 2


def test_groups_of_a_filter_may_be_cut(spark, monkeypatch):
    """Links between slices count once, as those within a slice."""
    monkeypatch.setattr(caps, "BLOCK", 40)
    rng = np.random.default_rng(6)
    hot = rng.normal(size=16)
    rows = [(k, (hot + rng.normal(size=16) * 0.15).tolist()) for k in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    counts = defaultdict(int)
    for a, b in brute_links(rows, 0.95):
        counts[a] += 1
        counts[b] += 1
    assert {r.vec_id: r.n_links for r in caps.near_duplicates(df).collect()} == {k: counts[k] for k in range(300)}


def test_every_filter_over_the_threshold_is_decoded():
    rng = np.random.default_rng(7)
    found = caps.Caps(16, 3000)
    vectors = caps.unit(rng.normal(size=(50, 16)))
    turned = vectors @ found.rotation
    sums = (turned[:, :8] @ found.first.T)[:, :, None] + (turned[:, 8:] @ found.second.T)[:, None, :]
    for got, s in zip(found.decode(vectors), sums):
        expected = np.flatnonzero(s.ravel() >= found.least)
        best = np.argsort(-s.ravel())[: caps.LEAST]
        assert set(got.tolist()) == set(expected) | (set(best) if len(expected) < caps.LEAST else set())


def near_copies(rng, vocabulary, n):
    """Texts, edited copies, exact copies and shared passages."""
    passage = " ".join(rng.choices(vocabulary, k=30))
    out = []
    while len(out) < n:
        words = rng.choices(vocabulary, k=rng.choice([2, 8, 60, 120]))
        out.append(" ".join(words))
        for _ in range(rng.randrange(4)):
            copy = list(words)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            out.append(" ".join(copy))
        if rng.random() < 0.3:
            out.append(" ".join(words) + "\n" + passage)
    return out


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80)])
def test_shingle_groups_equal_brute_force(spark, width, percent):
    rng = random.Random(width)
    vocabulary = [f"W{k}" for k in range(60)] + ["the", "of", "Ünï"]
    values = list(enumerate(near_copies(rng, vocabulary, 250)))
    values += [(1000 + k, values[3][1].upper()) for k in range(60)]
    values += [(2000, None), (2001, ""), (2002, " \t\n"), (2003, "one"), (2004, "ONE"), (2005, "one\x0btwo\xa0three"), (2006, "x" * 200_000)]

    def words(text):
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return [w for w in text.translate({c: " " for c in range(9, 14)}).split(" ") if w]

    def grams(text):
        w = words(text)
        return {tuple(w[k : k + width]) for k in range(max(1, len(w) - width + 1))} if w else set()

    sets = {d: grams(t) for d, t in values}
    keys = [d for d in sets if sets[d]]
    links = []
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * len(sets[a] | sets[b]):
                links.append((a, b))
    expected = roots_of(sets, links)
    found = jaccard.near_duplicates(documents(spark, values), width, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == {d: (len(sets[d]), expected[d]) for d in sets}
    assert len(found) == len(values)
    assert jaccard.near_duplicates(documents(spark, values).limit(0), width, percent).count() == 0


def test_long_texts_are_cut_between_words(monkeypatch):
    text = " ".join(f"w{k}" for k in range(3000)) + " " + "y" * 5000 + " end"
    whole = shingles.word_hashes(text)
    monkeypatch.setattr(shingles, "PART", 700)
    assert (shingles.word_hashes(text) == whole).all() and len(whole) == 3002


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(0)
    for _ in range(50):
        x = np.unique(rng.integers(0, 2**63, 400).astype(np.uint64))
        y = np.union1d(x[: rng.integers(1, 400)], rng.integers(0, 2**63, rng.integers(1, 200)).astype(np.uint64))
        apart = shingles.parity_sketch(x) ^ shingles.parity_sketch(y)
        bits = sum(bin(int(w) & (2**64 - 1)).count("1") for w in apart)
        assert bits <= len(np.setxor1d(x, y))


def brute_dedup(values, words):
    """Line p goes if it lies in a run of that many words that stands at an earlier place too."""
    kept = {}
    runs = {}
    for d, text in sorted(values, key=lambda v: v[0]):
        all_lines = (text or "").split("\n")
        full = [k for k, line in enumerate(all_lines) if line.strip()]
        body = [all_lines[k].strip() for k in full]
        gone = set()
        for a in range(len(body)):
            count = 0
            for b in range(a, len(body)):
                count += len(body[b].split())
                if count >= words:
                    run = tuple(body[a : b + 1])
                    first = runs.setdefault(run, (d, a))
                    if first < (d, a):
                        gone |= set(full[a : b + 1])
        kept[d] = None if text is None else "\n".join(line for k, line in enumerate(all_lines) if k not in gone)
    return kept


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(4)
    pool = [" ".join(rng.choices("abcdefghij", k=rng.choice([1, 3, 6, 12, 25]))) for _ in range(40)]
    values = []
    for d in range(80):
        body = [rng.choice(pool) for _ in range(rng.randrange(9))]
        if rng.random() < 0.5:
            start = rng.randrange(30)
            body[2:2] = pool[start : start + rng.randrange(2, 6)]
        if rng.random() < 0.3:
            body.insert(1, "")
        values.append((d, "\n".join(body)))
    values += [(100, values[5][1]), (101, None), (102, ""), (103, "\n\n"), (104, "\n".join([pool[0]] * 30))]
    found = lines.dedup(documents(spark, values).withColumn("deleted_lines", F.lit("x")), 20)
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "deleted_lines"]
    rows = {r.doc_id: r for r in found.collect()}
    expected = brute_dedup(values, 20)
    assert {d: r.text for d, r in rows.items()} == expected
    assert sum(r.deleted_lines for r in rows.values()) > 30
    assert lines.dedup(documents(spark, values).limit(0)).count() == 0


def test_places_of_repeated_ids(spark):
    run = "\n".join(" ".join(f"w{k}" for k in range(30)) + f" {j}" for j in range(3))
    df = documents(spark, [(None, run), (1, run), (1, "other\n" + run), (2, run), (2, run)])
    rows = sorted((r.doc_id if r.doc_id is not None else -1, r.text) for r in lines.dedup(df).collect())
    assert rows[0] == (-1, run) and [t for _, t in rows[1:] if "w1" in t] == []


def test_pipeline_stages_keep_their_promises(spark, tiny):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "line_dedup", "near_duplicates", "mixing", "packing"]
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    columns = docs.columns
    passage = "\n".join(" ".join(f"p{j}x{k}" for k in range(20)) for j in range(4))
    base = [f"text {k} " + " ".join(f"u{k}n{j}" for j in range(80)) for k in range(12)]
    values = [(k, t) for k, t in enumerate(base)]
    values += [(20, base[3]), (21, base[3].replace("u3n40", "edited")), (22, base[5] + "\n" + passage), (23, base[6][:200] + "\n" + passage)]
    planted = documents(spark, values)
    cleaned = corpus_pipeline.without_repeated_lines(spark, planted, tiny)
    rows = {r.doc_id: r for r in cleaned.collect()}
    assert cleaned.columns == columns
    assert 20 not in rows and "p1x1" in rows[22].text and "p1x1" not in rows[23].text
    assert all(r.n_chars == len(r.text) for r in rows.values())
    kept = corpus_pipeline.one_of_each_group(spark, planted.union(documents(spark, [(0, base[0]), (None, "z"), (None, base[1])])), tiny)
    ids = sorted(r.doc_id if r.doc_id is not None else -1 for r in kept.collect())
    assert ids == [-1, *range(12), 23] or ids == [-1, *range(12), 22, 23]
    mixed = corpus_pipeline.mixed_sources(spark, planted, tiny)
    assert mixed.columns == columns
    good = corpus_pipeline.good_documents(spark, docs, tiny)
    labels = spark.read.parquet(f"{tiny}/labels.parquet").filter("quality = 1").select("doc_id")
    clean = docs.join(labels, "doc_id", "left_semi")
    assert good.columns == columns
    assert good.join(labels, "doc_id", "left_semi").count() >= 0.95 * clean.count()


@pytest.mark.parametrize("counts", [[20_000] * 500, [3] * 40 + [20_000] * 5, [2, 2, 3], []])
def test_the_shingles_put_last_are_bounded(spark, monkeypatch, counts):
    monkeypatch.setattr(jaccard, "LAST", 10)
    rows = spark.createDataFrame(list(enumerate(counts)), "name long, n long")
    assert jaccard.Order.most_frequent(rows).count() <= 30
