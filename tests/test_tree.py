"""The metric tree: bounds that lose nothing, bounded copies, repeated ids and equal points, trees saved and loaded."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.operators import density, nearest, tree


def frame(spark, x, ids=None, payload=None):
    ids = range(len(x)) if ids is None else ids
    rows = [(int(i), [float(c) for c in v], float(0 if payload is None else payload[n])) for n, (i, v) in enumerate(zip(ids, x))]
    return spark.createDataFrame(rows, "id bigint, x array<double>, p double").repartition(5).cache()


def places(df):
    return df.select("x").distinct().withColumn("place", F.monotonically_increasing_id())


@pytest.fixture(scope="module")
def points():
    rng = np.random.default_rng(9)
    return np.concatenate([rng.normal(0, 1, (500, 3)), rng.normal(8, 0.01, (200, 3)), np.tile([[3.0, 3.0, 3.0]], (150, 1)), rng.uniform(-50, 50, (50, 3))])


@pytest.mark.parametrize(("p", "chunk_bytes"), [(1, tree.CHUNK_BYTES), (2, 15_000)])
def test_walks_lose_no_point(spark, points, p, chunk_bytes):
    made = tree.grow_tree(places(frame(spark, points)), p, leaf_rows=9, fanout=3, chunk_bytes=chunk_bytes)
    nodes = {r.node: r for r in made.nodes.collect()}
    if chunk_bytes < tree.CHUNK_BYTES:
        assert 2 <= len(made._children()) <= 5
    rows = made.rows.collect()
    inner = {r.parent for r in nodes.values() if r.parent is not None}
    depth = lambda n: 0 if n == 0 else 1 + depth(nodes[n].parent)
    assert max(map(depth, nodes)) >= 3 and all(r.node not in inner for r in rows)
    assert sum(nodes[n].n for n in nodes if n not in inner) == len(rows) == nodes[0].n
    assert all(nodes[n].n <= 9 for n in nodes if n not in inner)
    norm = lambda v: np.abs(v).sum() if p == 1 else np.sqrt((v**2).sum())
    for r in rows:
        x, node = np.array(r.x), r.node
        while node:
            n = nodes[node]
            assert norm(x - np.array(n.centre)) <= n.radius * (1 + 1e-12) + 1e-12 or node != r.node
            assert (np.array(n.low) <= x).all() and (x <= np.array(n.high)).all()
            node = n.parent
    asked = spark.createDataFrame([(i, [float(c) for c in v], r) for i, (v, r) in enumerate([(points[0], 0.7), (points[600], 0.02), (points[899], 30.0), (points[3] + 100, 1.0)])], "q bigint, x array<double>, r double")
    got = {(r.q, r.node) for r in made.within(asked).collect()}
    for q in asked.collect():
        assert {(q.q, r.node) for r in rows if norm(np.array(r.x) - np.array(q.x)) <= q.r} <= got


def test_radii_hold_at_every_level(spark, points):
    made = tree.grow_tree(places(frame(spark, points)), 2, leaf_rows=9, fanout=3)
    nodes = {r.node: r for r in made.nodes.collect()}
    for r in made.rows.collect():
        node = r.node
        while node:
            n = nodes[node]
            assert np.linalg.norm(np.array(r.x) - np.array(n.centre)) <= n.radius * (1 + 1e-12) + 1e-12
            node = n.parent


def brute(x, ids, k, own):
    gap = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    out = []
    for i in range(len(x)):
        order = sorted((gap[i, j], ids[j]) for j in range(len(x)) if own or j != i)[:k]
        out += [(ids[i], tuple(np.round(x[i], 9)), n + 1, r, round(d, 9)) for n, (d, r) in enumerate(order)]
    return sorted(out)


@pytest.mark.parametrize("layout", [{"leaf_rows": 7, "fanout": 2, "block_rows": 5}, {}])
@pytest.mark.parametrize("own", [True, False])
def test_rows_that_share_an_id_stay_apart(spark, points, layout, own):
    x = points[::9]
    ids = np.arange(len(x)) // 3  # three rows an id
    df = frame(spark, x, ids)
    found = nearest.nearest_neighbours(df, df, 4, exclude_self=not own, **layout)
    where = nearest.numbered(df, "test-rows").select("row", "x")
    got = sorted((r.id, tuple(np.round(r.x, 9)), r.position, r.ref_id, round(r.distance, 9)) for r in found.join(where, "row").collect())
    assert got == brute(x, ids, 4, own)


def test_more_neighbours_than_points(spark, points):
    x = points[:6]
    df = frame(spark, x)
    got = nearest.nearest_neighbours(df, df, 20, exclude_self=True, leaf_rows=2, fanout=2)
    assert got.count() == 30
    other = frame(spark, x[:2], [0, 99])
    apart = nearest.nearest_neighbours(other, df, 20, exclude_self=True, leaf_rows=2, fanout=2)
    assert sorted((r.id, r.ref_id) for r in apart.collect()) == [(0, i) for i in range(1, 6)] + [(99, i) for i in range(6)]


def test_hot_place_is_one_point_of_the_search(spark):
    x = np.concatenate([np.zeros((4000, 2)), [[0.5, 0.0], [3.0, 0.0]]])
    df = frame(spark, x)
    assert {r.n for r in density.neighbour_counts(df, 0.6, leaf_rows=2, fanout=2).where("id < 4000").collect()} == {4001}
    got = nearest.nearest_neighbours(df, df, 3, exclude_self=True, leaf_rows=2, fanout=2)
    assert sorted(r.ref_id for r in got.where("id = 4001").collect()) == [0, 1, 4000]
    assert sorted(r.ref_id for r in got.where("id = 1").collect()) == [0, 2, 3]


def test_dbscan_with_shared_ids(spark):
    df = frame(spark, np.array([[0.0], [0.1], [5.0], [5.1], [9.0]]), [1, 1, 1, 2, 2])
    got = sorted((r.id, r.cluster) for r in density.dbscan(df, 0.5, 2).collect())
    # both clusters have 1 as their least id, so either may be the first
    assert got in ([(1, 0), (1, 0), (1, 1), (2, -1), (2, 1)], [(1, 0), (1, 1), (1, 1), (2, -1), (2, 0)])
    assert density.dbscan(df.limit(0), 0.5, 2).count() == 0


def test_points_of_several_lengths_and_none(spark):
    with pytest.raises(ValueError, match="length"):
        tree.grow_tree(spark.createDataFrame([(0, [1.0]), (1, [1.0, 2.0])], "place bigint, x array<double>"))
    with pytest.raises(ValueError, match="no reference"):
        tree.grow_tree(spark.createDataFrame([], "place bigint, x array<double>"))


def test_saved_tree_answers_alike(spark, points, tmp_path):
    df = frame(spark, points[:200])
    made = nearest.known_points(nearest.numbered(df, "test-refs"), 3, 2, leaf_rows=9, fanout=3)
    made.save(str(tmp_path))
    again = tree.MetricTree.load(spark, str(tmp_path), 2)
    rows = [sorted((r.id, r.position, r.ref_id) for r in nearest.nearest_neighbours(df, df, 3, tree=t).collect()) for t in (made, again)]
    assert rows[0] == rows[1] and len(rows[0]) == 600


def test_copies_of_a_million_points_stay_few(spark):
    rows = spark.range(1_000_000).select(F.col("id").alias("place"), F.array(*[(F.pmod(F.xxhash64("id", F.lit(i)), F.lit(1 << 20)) / F.lit(1 << 20)).alias("v") for i in range(3)]).alias("x"))
    made = tree.grow_tree(rows, leaf_rows=2000)
    asked = made.rows.where("place % 100 = 0").select("x", F.col("place").alias("q"), F.lit(0.01).alias("r"))
    walked = made.within(asked)
    assert walked.count() / 10_000 < 2.5 and made.nodes.agg(F.max("n")).first()[0] == 1_000_000


def clouds(n, d):
    return np.random.default_rng(4).normal(0, 1, (n, d))


def test_rows_are_copied_to_groups_not_to_leaves(spark):
    x = clouds(600, 24)
    df = frame(spark, x)
    made = tree.grow_tree(df.select("x", F.col("id").alias("place")), leaf_rows=8, fanout=3)
    leaves = made.rows.select("node").distinct().count()
    asked = made.rows.select("x", F.col("place").alias("q"), F.lit(7.0).alias("r"))
    copies = made.groups_within(asked)
    assert copies.count() == copies.select("q", "group").distinct().count() <= 600 * 3 * tree.GROUPS
    assert leaves > 3 * tree.GROUPS and made.nodes.where("group is null").count() < 3 * tree.GROUPS
    gap = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
    got = {r.id: r.n for r in density.neighbour_counts(df, 7.0, leaf_rows=8, fanout=3, block_rows=3).collect()}
    assert got == dict(enumerate((gap <= 7.0).sum(1).tolist()))


def test_groups_of_a_tree_that_needs_several_chunks(spark, points):
    df = frame(spark, points)
    made = tree.grow_tree(places(df), 2, leaf_rows=9, fanout=3, chunk_bytes=1500)
    asked = made.rows.select("x", F.col("place").alias("q"), F.lit(2.0).alias("r"))
    got = made.groups_within(asked)
    assert len(made._coarse) > 1 and got.where("group < 0").isEmpty()
    assert got.count() == got.select("q", "group").distinct().count()
    here = {(r.q, r.group) for r in got.collect()}
    rows = made.rows.collect()
    x = np.array([r.x for r in rows])
    near = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1)) <= 2.0
    assert {(rows[i].place, rows[j].group) for i, j in zip(*np.nonzero(near))} <= here
