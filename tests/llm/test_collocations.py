"""Phrases equal a plain count, whatever the sample proposes; scores equal whole-number arithmetic."""

import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from millrace.llm import collocations
from millrace.llm.common import REGISTRY, table


def plain(rows, least, longest, top=2000, cover=50):
    """The contract by plain counting: (lang, rank, phrase, a, l, r, n, score)."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, *words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    cand, out = {g: a for g, a in f.items() if len(g) > 2 and a >= least}, []
    inside = Counter()
    for g, a in cand.items():
        for s in range(2, len(g) - 1):
            for i in range(1, len(g) - s + 1):
                part = (g[0], *g[i : i + s])
                inside[part] = max(inside[part], a)
    for g, a in cand.items():
        if g in inside and 100 * inside[g] >= cover * a:
            continue
        cuts = [(1000000 * a * a // (f[g[: k + 1]] * f[(g[0], *g[k + 1 :])]), k) for k in range(1, len(g) - 1)]
        score, k = min(cuts)
        out.append((g[0], " ".join(g[1:]), a, f[g[: k + 1]], f[(g[0], *g[k + 1 :])], n[g[0]], score))
    found = set()
    for lang in n:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))[:top]
        found |= {(r[0], i, *r[1:]) for i, r in enumerate(own, 1)}
    return found


def messy(seed, size):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "city", "é", "a\x00b", "x y", "ÀB"]
    gaps = [" ", " ", " ", "\t", "  ", ", ", ".", "\n", "\x0b", "!? "]
    texts = ["".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randint(0, 40))) for _ in range(size)]
    return [(rng.choice(["en", "fr", None, "und"]), t) for t in texts] + [("en", None), ("en", ""), ("xx", " . "), ("long", "New York city " * 3000)]


def got(df):
    return {(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect()}


@pytest.mark.parametrize("sample_bytes", [1, 2000, 1 << 20])
def test_any_sample_gives_the_same(spark, sample_bytes, monkeypatch):
    monkeypatch.setattr(collocations, "LOT_BYTES", 500)
    rows = messy(5, 150)
    docs = spark.createDataFrame([(lang, t, "other", 1) for lang, t in rows], "lang string, text string, phrase string, n int").repartition(3)
    assert got(collocations.collocations(docs, sample_bytes=sample_bytes, bits=10)) == plain(rows, 10, 3)


def test_longer_phrases_and_short_report(spark):
    rows = messy(6, 120)
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert got(collocations.collocations(docs, least=4, longest=5, top=7, cover=80, sample_bytes=1)) == plain(rows, 4, 5, 7, 80)


def test_failures_of_the_border_are_counted_later(spark, monkeypatch):
    seen, ask = [], collocations._failures
    monkeypatch.setattr(collocations, "_failures", lambda *a: seen.append(ask(*a).count()) or ask(*a))
    docs = spark.createDataFrame(messy(7, 100), "lang string, text string")
    collocations.frequent_phrases(docs, sample_bytes=1)
    assert len(seen) == 3 and seen[0] > 0 and seen[1] > 0 and seen[2] == 0


def test_scores_beyond_64_bits(spark):
    a, l, r = 4 * 10**14 + 7, 9 * 10**14 + 1, 4 * 10**14 + 9
    (row,) = spark.sql(f"SELECT {a}L a, {l}L l, {r}L r").selectExpr("CAST(a AS DECIMAL(15,0)) * CAST(a AS DECIMAL(15,0)) * CAST(1000000 AS DECIMAL(7,0)) DIV (CAST(l AS DECIMAL(15,0)) * CAST(r AS DECIMAL(15,0))) s").collect()
    assert row.s == 1000000 * a * a // (l * r)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(docs).count() == 0
    assert collocations.collocations(spark.createDataFrame([("en", None), (None, "")], docs.schema)).count() == 0


def test_words_of_pieces():
    text, piece, code, words = collocations.split_pieces(pa.array(["", "A b.C\tb", None, "d", "", "e,f"]))
    assert words.to_pylist() == ["a", "b", "c", "d", "e", "f"] and code.tolist() == [0, 1, 2, 1, 3, 4, 5]
    assert text.tolist() == [1, 1, 1, 1, 3, 5, 5] and [piece[i] == piece[i + 1] for i in range(6)] == [True, False, True, False, False, False]


def test_sql_takes_the_same_tables(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.lang, r.text) for r in table(spark, folder, "documents", "lang", "text").collect()]
    assert got(REGISTRY["op11_collocations"].build(spark, folder)) == plain(rows, 10, 3)
