"""Scores equal a word-by-word computation, at several orders and block sizes."""

import math
from collections import Counter

import pytest

from millrace.llm import lm_score


def brute(docs, order, alpha):
    words = [(t or "").lower().split() for _, t in docs]
    own = [[Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) for k in range(order + 1)] for w in words]
    total = [sum((o[k] for o in own), Counter()) for k in range(order + 1)]
    n = sum(map(len, words))
    out = []
    for w, mine in zip(words, own, strict=True):
        log = 0.0
        for i in range(len(w)):
            for k in range(min(order, i + 1), 0, -1):
                gram = tuple(w[i - k + 1 : i + 1])
                left = total[k][gram] - mine[k][gram]
                if k == 1:
                    log += math.log(left if left > 0 else alpha) - math.log(max(1, n - len(w)))
                elif left > 0:
                    log += math.log(left) - math.log(total[k - 1][gram[:-1]] - mine[k - 1][gram[:-1]])
                    break
                else:
                    log += math.log(alpha)
        out.append((len(w), round(log, 4)))
    return out


DOCS = [
    (1, "the cat sat on the mat"), (2, "The cat  sat on\tthe hat"), (3, "a cat"), (4, ""), (5, None), (6, " \n "),
    (1, "the cat sat on the mat"), (None, "on the mat the cat sat"), (9, "unseen words only here"), (10, "on the mat " * 400),
]


@pytest.mark.parametrize("order", [1, 2, 3])
@pytest.mark.parametrize("block", [16, 1 << 20])
def test_equals_brute_force(spark, monkeypatch, order, block):
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", block)
    rows = [(i, t, "x", 0) for i, t in DOCS]
    df = spark.createDataFrame(rows, "doc_id long, text string, gram string, n int").repartition(3)
    got = sorted((r.doc_id or -1, r.n_words, r.log_score) for r in lm_score.score(df, order).collect())
    want = sorted((i or -1, *v) for (i, _), v in zip(DOCS, brute(DOCS, order, 0.4), strict=True))
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert all(abs(g[2] - w[2]) < 1e-3 for g, w in zip(got, want, strict=True))


def test_empty_table(spark):
    assert lm_score.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0
