import math
import random

import duckdb
import numpy as np
import pytest

from adlake.llm import negatives as N
from adlake.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int, score double, query long, cell string, vec string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 0.5, 1, "c", "v") for r in rows], SCHEMA)


def made(n=400, seed=2, width=6):
    """Clusters with many copies and ties, short and empty vectors, and rows that take no part."""
    r = random.Random(seed)
    centers = [[r.choice([-1.0, -0.25, 0.0, 0.5, 1.0]) for _ in range(width)] for _ in range(12)]
    out = []
    for i in range(n):
        v = list(r.choice(centers))
        if i % 3 == 0:
            v[r.randrange(width)] += r.choice([0.01, 0.004, -0.3])
        if i % 41 == 0:
            v = v[: r.randrange(width)]
        out.append((i, v, r.randrange(4)))
    out += [(None, [1.0] * width, 1), (n + 100, None, 1), (n + 200, [float("nan")] * width, 1), (n + 300, [1.0, None], 2), (n + 400, [float("inf")], 2), (n + 1, [1.0], None)]
    return [*out, out[5], out[5], out[100 % n], (200, [0.5] * width, 3)]


def plain(rows, every, positives=5, negatives=5):
    taken = set()
    for i, v, label in rows:
        if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v):
            taken.add((i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * float(np.float32(x))) for x in v)))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for i, label, q in (x for x in taken if x[0] % every == 0):
        same = sorted((-dot(q, v), j) for j, k, v in taken if k == label and j != i)[:positives]
        other = sorted((-dot(q, v), j) for j, k, v in taken if k != label)
        for s, j in same:
            fit = [(t, m) for t, m in other if 80 * -s <= 100 * -t <= 100 * -s][:negatives]
            out += [(i, j, rank, m, -s, -t) for rank, (t, m) in enumerate(fit, 1)]
    return sorted(out)


@pytest.mark.parametrize(("shard", "cells", "sample", "positives", "negatives"), [(8192, 256, 4096, 5, 5), (7, 9, 50, 5, 5), (40, 3, 3, 2, 7), (1, 256, 4096, 1, 1)])
def test_equals_every_product(spark, shard, cells, sample, positives, negatives):
    rows = made()
    got = sorted(tuple(x) for x in N.mine(table(spark, rows), 20, positives, negatives, shard, cells, sample).collect())
    assert got == plain(rows, 20, positives, negatives) and got


def test_large_numbers_stay_exact(spark):
    r = random.Random(9)
    rows = [(i, [r.randrange(1 << 20) * 4.0 + 1, float(r.randrange(3))], i % 3) for i in range(120)]
    assert sorted(tuple(x) for x in N.mine(table(spark, rows), 10, shard=16).collect()) == plain(rows, 10)


def test_tree_is_a_cover_and_skips():
    r = np.random.default_rng(1)
    x = np.concatenate([r.integers(-40, 40, (300, 8)) + c for c in r.integers(-3000, 3000, (12, 8))])
    x = np.concatenate([x, np.repeat(x[:1], 200, 0)])
    most = float((x.astype(float) ** 2).sum(1).max())
    tree, wide = N.CoverTree(x, most), N._augmented(x, most)
    assert sorted(tree.order) == list(range(len(x)))
    for (begin, end, center, first, last), radius in zip(tree.nodes.tolist(), tree.radius.tolist(), strict=True):
        d = np.sqrt(((wide[tree.order[begin:end]] - wide[center]) ** 2).sum(1))
        assert d.max() <= radius and center in tree.order[begin:end]
        if first:
            own = tree.nodes[first:last]
            assert own[0][2] == center and own[0][0] == begin and own[-1][1] == end and len(own) <= N.FAN
            assert (own[1:, 0] == own[:-1, 1]).all()
            gaps = [np.sqrt(((wide[a] - wide[b]) ** 2).sum()) for k, a in enumerate(own[:, 2]) for b in own[:k, 2]]
            assert min(gaps) >= tree.radius[first:last].max() * 0.999  # farther apart than what they cover
    label = np.arange(len(x)) % 3
    low, high = np.array([-N._WIDE, 0, -5000]), np.array([N._WIDE, 10**6, -100])
    seen = 0
    for q in x[::97]:
        tree.seen = 0
        got = tree.search(q, label == 1, np.arange(len(x)), low, high, 5)
        product = x @ q
        for (s, i), a, b in zip(got, low, high, strict=True):
            want = sorted((-product[k], k) for k in range(len(x)) if label[k] == 1 and a <= product[k] <= b)[:5]
            assert list(zip((-s).tolist(), i.tolist(), strict=True)) == want
        tree.seen = 0
        tree.search(q, label == 1, np.arange(len(x)), low[:1], high[:1], 5)
        seen += tree.seen / len(x)
    assert seen / len(x[::97]) < 0.4  # most rows' products were not computed


def test_whole_small_table_equals_sql(spark):
    d = "/root/testdata/sf0.01"
    c = duckdb.connect()
    c.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{d}/embeddings.parquet'")
    got, want = QUERIES["op12_cover_tree_negatives"](spark, d), c.sql(N.oracle())
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall())


def test_empty_and_lonely(spark):
    assert N.mine(table(spark, [(0, [1.0], 1)]).limit(0)).count() == 0
    assert N.mine(table(spark, [(0, [1.0], 1)])).count() == 0
    assert N.mine(table(spark, [(100, None, 1), (0, [], 1), (1, [], 1), (2, [], 2)])).count() == 1
