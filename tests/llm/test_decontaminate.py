"""Hits against a scan of all windows, with short items, ASCII-only folding and spans at the ends."""

import hashlib
import re

from millrace.llm.decontaminate import Decontaminator

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return _WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items):
    out = []
    for i, t in docs:
        w, hit, who = words(t), set(), set()
        for item, text in items:
            v = words(text)
            n = min(10, len(v))
            windows = {tuple(v[j : j + n]) for j in range(len(v) - n + 1)} if n else set()
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in windows:
                    hit |= set(range(j, j + n))
                    if item is not None:
                        who.add(str(item))
        out.append((i, len(w), len(hit), len(who), hashlib.sha256(",".join(sorted(who)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


LONG = " ".join(f"tok{i}" for i in range(14))
ITEMS = [(1, LONG), (2, "Élan vital, RARE words"), (10, "single"), (3, None), (4, "!!"), (None, "nameless item here"), (5, LONG), (1, LONG)]
DOCS = [
    (1, "before " + LONG.upper() + " after"), (2, "tok3 tok4 tok5 tok6 tok7 tok8 tok9 tok10 tok11 tok12"), (3, "tok0 tok1"), (4, None), (5, ""),
    (6, "Élan-vital. rare/words single"), (7, "élan vital rare words"), (8, "x" * 50_000 + " single"), (9, "nameless item here"), (1, "other text single"),
    (None, "single"), (6, "Élan-vital. rare/words single"), (11, LONG + " gap " + LONG),
]


def frames(spark):
    docs = spark.createDataFrame([(i, t, "clash", 1) for i, t in DOCS], "doc_id long, text string, words string, h int").repartition(4)
    return docs, spark.createDataFrame(ITEMS, "item_id long, text string")


def test_equals_brute_force(spark):
    docs, items = frames(spark)
    names = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    for limit in (1_000_000, 0):  # with and without broadcasts
        got = Decontaminator(items, broadcast_rows=limit).report(docs).collect()
        assert sorted((tuple(r[n] for n in names) for r in got), key=str) == brute(DOCS, ITEMS)


def test_clean(spark):
    docs, items = frames(spark)
    cleaner = Decontaminator(items)
    dirty = {r[0] for r in brute(DOCS, ITEMS) if r[5]}
    kept = cleaner.clean(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 7] and dirty >= {1, 2, 6, 8, 9, 11}
    spans = {(r.doc_id, r.text) for r in cleaner.clean(docs, spans=True).collect()}
    assert (1, "before after") in spans and (11, "gap ") in spans and (7, "élan vital rare words") in spans and (4, None) in spans


def test_nothing_to_find(spark):
    docs, _ = frames(spark)
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.n_hit for r in Decontaminator(none).report(docs).collect()} == {0}
    assert Decontaminator(none).clean(docs).count() == len(DOCS)
    _, items = frames(spark)
    assert Decontaminator(items).report(spark.createDataFrame([], "doc_id long, text string")).count() == 0
