"""Components against all-pairs brute force on near copies, chains, boilerplate and edge rows."""

import random

import numpy as np
import pytest

from millrace.llm import ngram_join


def brute(rows, width, num, den):
    sets = []
    for _, t in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
    ids = [i for i, _ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        low[find(i)] = min(low.get(find(i), d), d)
    return sorted((d, len(sets[i]), low[find(i)]) for i, d in enumerate(ids))


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["the", "of", "and"] * 8
    line = " ".join(rng.choices(words, k=25))
    rows, base = [], []
    for _ in range(12):
        base.append(rng.choices(words, k=rng.choice([4, 30, 80, 150])))
    n = 0
    for b in base:
        for _ in range(rng.choice([1, 3, 25])):
            w = list(b)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                w[rng.randrange(len(w))] = rng.choice(words)
            if rng.random() < 0.2:
                w.append(line)
            rows.append((n, rng.choice([" ", "\n", "  "]).join(w)))
            n += 1
    rows += [(n, ""), (n + 1, None), (n + 2, "one"), (n + 3, "ONE"), (n + 4, "one two"), (n + 5, line), (n + 6, line), (n + 7, "x " * 5000), (n + 8, " \t")]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, "clash", 3) for i, t in rows], "doc_id long, text string, fp string, n int").repartition(5)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.ngram_components(df).collect())
    assert got == brute(rows, 3, 90, 100)


def test_other_threshold_and_width(spark):
    rows = corpus(3)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.ngram_components(df, width=5, num=80, fragments=4).collect())
    assert got == brute(rows, 5, 80, 100)


@pytest.mark.parametrize(("num", "sizes"), [(60, (20, 30)), (50, (30, 50))])
def test_low_threshold(spark, num, sizes):
    rows = [(i, " ".join(f"w{k}" for k in range(n))) for i, n in enumerate(sizes)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.ngram_components(df, width=1, num=num).collect())
    assert got == brute(rows, 1, num, 100) == [(0, sizes[0], 0), (1, sizes[1], 0)]


def test_missing_and_repeated_ids(spark):
    rows = [(None, "a b c d"), (4, "a b c d"), (2, "a b c d"), (2, "a b c d"), (7, "e f g h")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.ngram_components(df).collect()), key=str)
    assert got == sorted([(None, 2, None), (4, 2, 2), (2, 2, 2), (2, 2, 2), (7, 2, 7)], key=str)
    kept = sorted(((r.doc_id, r.text) for r in ngram_join.keep_one(df).collect()), key=str)
    assert kept == sorted([(None, "a b c d"), (2, "a b c d"), (7, "e f g h")], key=str)


def test_empty_table(spark):
    assert ngram_join.ngram_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_pivots_come_from_counts_per_rank():
    """The driver needs 256 counts, not a sorted copy of every rank."""
    ranks = np.random.default_rng(2).integers(1, 40, 50_000).astype(np.uint8)
    got = ngram_join.cut_points(np.bincount(ranks, minlength=256), 4)
    keys = np.sort((ranks.astype(np.uint64) << np.uint64(56)))
    mass = np.cumsum((keys >> np.uint64(56)).astype(float))
    for f, pivot in enumerate(got, 1):
        below = mass[np.searchsorted(keys, (pivot >> np.uint64(56)) << np.uint64(56)) - 1]
        assert abs(below / mass[-1] - f / 4) < 0.06
    assert len(ngram_join.cut_points(np.bincount([0] * 8, minlength=256), 4)) == 3
