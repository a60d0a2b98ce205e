"""Gradients against finite differences, window cover, and quality on documents held out of training."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from millrace.llm import common, toxicity


def test_gradients():
    rng = np.random.default_rng(1)
    net = toxicity.Network.new(rows=8, embed=2, hidden=3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x = rng.normal(0, 1, (6, 4, 9))
    mask = np.arange(6)[:, None] < np.array([6, 4, 1, 5])
    target, weight = np.array([1.0, 0.0, 1.0, 0.0]), np.array([1.0, 2.0, 1.0, 0.5])

    def loss():
        p = 1 / (1 + np.exp(-net.forward(x, mask).astype(np.float64)))
        return -((target * np.log(p) + (1 - target) * np.log(1 - p)) * weight).sum() / weight.sum()

    grads, _ = net.gradients(x, mask, target, weight)
    for name in ("Wf", "Ub", "bf", "Wa", "va", "wo"):
        flat, step = net.p[name].reshape(-1), 1e-2
        for i in rng.choice(len(flat), min(4, len(flat)), replace=False):
            old = flat[i]
            flat[i] = old + step
            up = loss()
            flat[i] = old - step
            down = loss()
            flat[i] = old
            assert abs((up - down) / (2 * step) - grads[name].reshape(-1)[i]) < 2e-3, name


def test_windows_cover_all_words():
    offsets = np.array([0, 0, 5, 37, 37 + 200])
    start, text = toxicity.windows_of(offsets)
    seen = {i for s, t in zip(start, text, strict=True) for i in range(s, min(s + toxicity.WINDOW, offsets[t + 1]))}
    assert seen == set(range(237)) and set(text) == {1, 2, 3}


def test_held_out_quality(spark):
    from millrace.llm.common import REGISTRY

    folder = "/root/testdata/sf0.01"
    found = REGISTRY["op9_toxicity"].build(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    rows = found.where("held_out").groupBy("toxic", "predicted").count().collect()
    n = {(r["toxic"], r["predicted"]): r["count"] for r in rows}
    assert n.get((0, 1), 0) <= 2 and n.get((1, 1), 0) >= 0.6 * (n.get((1, 1), 0) + n.get((1, 0), 0))


def test_edge_rows(spark):
    texts = ["good plain words " * 20, "you are an idiot my friend"] * 30
    with np.errstate(over="ignore"):
        model = toxicity.train([t + f" n{i}" for i, t in enumerate(texts)], [0, 1] * 30)
    rows = [(1, texts[0]), (2, "so what, idiot. bye"), (3, None), (4, ""), (5, " \n"), (None, texts[1]), (1, texts[0]), (6, "unheard filler " * 20_000 + "you are an idiot my friend")]
    df = spark.createDataFrame([(i, t, 0.5, "x") for i, t in rows], "doc_id long, text string, score double, word string").repartition(3)
    got = {(r.doc_id, i): r for i, r in enumerate(toxicity.score(df, model).collect())}
    by_id = {k[0]: r.predicted for k, r in got.items()}
    assert by_id == {1: 0, 2: 1, 3: 0, 4: 0, 5: 0, None: 1, 6: 1} and len(got) == len(rows)
    assert all(0 <= r.score <= 1 for r in got.values())
    kept = toxicity.reject(df, model)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [1, 1, 3, 4, 5]


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None)], "doc_id long, toxic int")
    assert toxicity.fit(docs, labels) is None
    assert [r.score for r in toxicity.score(docs, None).collect()] == [0.0]
    assert toxicity.score(docs.where(F.lit(False)), None).count() == 0


def test_character_grams_mark_word_ends():
    a, owner = toxicity.char_grams(pa.array(["ab", "abab"]))
    b, _ = toxicity.char_grams(pa.array(["xab"]))
    assert len(set(a[owner == 0]) & set(a[owner == 1])) == 2  # the head and the tail
    assert len(set(a[owner == 0]) & set(b)) == 1  # the tail only


def test_fit_gives_its_memory_back(spark):
    """Training on the driver ends with what it began with and the model, not with its peak."""

    def held():
        with open("/proc/self/status") as f:
            return next(int(line.split()[1]) for line in f if line.startswith("RssAnon")) / 1024

    rng = np.random.default_rng(3)
    vocabulary = np.array([f"{a}{b:x}" for b in range(4000) for a in ("lorem", "ipsum", "dolor")])
    rows = [(i, " ".join(rng.choice(vocabulary, 400)) + " idiot" * (i % 3 == 0), int(i % 3 == 0)) for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int").cache()
    docs, labels = df.select("doc_id", "text"), df.select("doc_id", "toxic")
    docs.count()
    common.give_back()
    before = held()
    model = toxicity.fit(docs, labels, epochs=1, rounds=1, clean_windows=1)
    assert model is not None and held() - before < 30
