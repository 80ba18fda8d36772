import math
import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from adlake.llm import minhash as M
from adlake.llm import sets as S
from adlake.llm.common import texts as texts_of
from adlake.llm.queries import QUERIES

from .fixtures import EDGES, frame


def brute_set(text, k=5):
    w = re.findall("[^\x20\x09-\x0d]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute(rows, least=85):
    """rows: (key, doc_id, text). key -> (doc_id, n_shingles, component_id, kept)."""
    sets = {key: brute_set(t) for key, _, t in rows}
    root = {key: key for key in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    keys = list(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]):
                root[top(a)] = top(b)
    lowest = {}
    for key, i, _ in rows:
        if sets[key] and i is not None:
            lowest[top(key)] = min(i, lowest.get(top(key), i))
    out = []
    for key, i, _ in rows:
        c = lowest.get(top(key)) if sets[key] else i
        out.append((i, len(sets[key]), c, i == c))
    return sorted(out, key=str)


def edited(r, words, k):
    w = list(words)
    for x in range(k):
        w[r.randrange(len(w) * x // k, len(w) * (x + 1) // k)] = f"new{r.random()}"
    return " ".join(w)


def family(r, n, words, edits):
    """Near copies of one text, about the bound from each other and from it; some are copies of copies."""
    base = [f"w{r.randrange(10**6)}" for _ in range(words)]
    made = [" ".join(base)]
    for _ in range(n):
        made.append(edited(r, made[r.randrange(len(made))].split() if r.random() < 0.3 else base, r.randrange(edits + 1)))
    return made


@pytest.fixture(scope="module")
def texts():
    r = random.Random(6)
    made = [*EDGES]
    for n, words, edits in ((60, 150, 8), (40, 80, 5), (12, 60, 4), (30, 200, 12), (5, 20, 1)):
        made += family(r, n, words, edits)
    made += [made[-1].upper(), made[-1].replace(" ", "\n\t "), made[-1] + " "]
    r.shuffle(made)
    return made


@pytest.mark.parametrize("block", [512, 16, 3])
def test_equals_brute_force(spark, texts, block):
    got = M.near_duplicates(frame(spark, texts, clashing=True), block=block)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted((tuple(x) for x in got.collect()), key=str) == brute([(i, i, t) for i, t in enumerate(texts)])


def test_null_and_repeated_ids(spark, texts):
    r = random.Random(7)
    rows = [(k, r.choice([None, k % 40, k, k]), t) for k, t in enumerate([*texts[:70], *texts[:30], None, None])]
    docs = spark.createDataFrame([(i, t, None, None, 0) for _, i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted((tuple(x) for x in M.near_duplicates(docs).collect()), key=str) == brute(rows)


def test_empty_table(spark):
    assert M.near_duplicates(frame(spark, ["x"]).limit(0)).count() == 0
    assert [tuple(x) for x in M.near_duplicates(frame(spark, [None])).collect()] == [(0, 0, 0, True)]


def test_posterior_bounds():
    """The table of least matches against the posterior, integrated plainly; and the chance that a pair at the bound is pruned at all."""
    need, p = S.needs(85, 1e-6), 0.85 + 0.15 / 256
    assert len(need) == S.PLACES // S.BATCH and need == sorted(need)
    x = (np.arange(200_000) + 0.5) / 200_000
    for n, m in zip(range(S.BATCH, S.PLACES + 1, S.BATCH), need, strict=True):
        for k, above in ((m, True), (m - 1, False)):
            density = np.exp(k * np.log(x) + (n - k) * np.log1p(-x) + math.lgamma(n + 2) - math.lgamma(k + 1) - math.lgamma(n - k + 1))
            assert (density[x >= p].mean() * (x >= p).mean() >= 1e-6 * S.BATCH / S.PLACES) == above
    chance = {0: 1.0}  # of so many matches, not pruned yet
    for k, m in enumerate(need):
        each = [math.comb(S.BATCH, i) * p**i * (1 - p) ** (S.BATCH - i) for i in range(S.BATCH + 1)]
        step = {}
        for have, c in chance.items():
            for i, e in enumerate(each):
                step[have + i] = step.get(have + i, 0) + c * e
        chance = {have: c for have, c in step.items() if have >= need[k]}
    assert 1 - sum(chance.values()) < 1e-6
    assert (1 - 0.85**M.ROWS) ** M.BANDS < 1e-6


def test_signatures_are_fair():
    r = random.Random(1)
    for share in (0.3, 0.6, 0.85, 0.95):
        agree = []
        for _ in range(30):
            words = [f"{r.random()}" for _ in range(400)]
            a, b = S.shingles(" ".join(words), 5), S.shingles(edited(r, words, round((1 - share) / (1 + share) * 80)), 5)
            ids = lambda h: set(zip(h[0].tolist(), h[1].tolist(), strict=True))
            s = len(ids(a) & ids(b)) / len(ids(a) | ids(b))
            x, y = (np.frombuffer(S.signature(h), np.uint8) for h in (a, b))
            agree.append((x == y).mean() - (s + (1 - s) / 256))
        assert abs(np.mean(agree)) < 0.02


def test_sets_are_whole():
    r = random.Random(2)
    text = " ".join(r.choice(["a", "b", "c"]) for _ in range(40_000))
    assert len(S.shingles(text, 5)[0]) == len(brute_set(text)) == 243
    long = " ".join(str(k) for k in range(40_000))
    assert len(S.shingles(long, 5)[0]) == 39_996


def test_large_group_sends_few_rows(spark):
    """A group of near copies: what is proposed and what crosses grows with its nodes, not with its pairs."""
    r = random.Random(3)
    made = sorted(set(family(r, 1500, 120, 2)))
    prints = S.prints_of(texts_of(frame(spark, made)), 5).where("n_shingles > 0").withColumn("node", F.monotonically_increasing_id()).cache()
    groups = S._groups(prints.select(F.lit(1).cast("long").alias("key"), "node"), 64)
    assert groups.count() == len(made)
    found = S._proposed(groups, prints, S.needs(85), 85)
    assert found.count() < 2.2 * len(made)
    families = found.where("kind = 1").select(F.col("x").alias("family"), "block", F.col("y").alias("node"))
    tree = prints.select("node", F.lit(0).cast("long").alias("root"))
    assert S._meetings(families, tree, 32).count() == 0
    # with a few nodes outside, each block meets them once
    apart = prints.select("node", F.when(F.col("doc_id") < 10, F.col("node")).otherwise(-1).alias("root"))
    meetings = S._meetings(families, apart, 32)
    assert meetings.count() <= len(made) + 10 * (len(made) // 64 + 1) + 10
    assert S._crossing(meetings, prints, S.needs(85), 85).count() <= meetings.count()
    prints.unpersist()


def test_one_group_under_many_keys_meets_once(spark):
    """Families that hold mostly the same nodes send them once, not under each key; families that share only their largest component stay apart. No pair is lost."""
    overlapping = [(k, 0, n) for k in range(30) for n in range(200) if (n + k) % 10]
    apart = [(100 + k, 0, 1000 + 10 * k + n) for k in range(40) for n in range(10)]
    parts = {n: n if n >= 180 else 1 for n in range(200)} | {1000 + n: 1000 + n if n % 10 == 9 else 1000 for n in range(400)}
    families = spark.createDataFrame(overlapping + apart, "family long, block long, node long")
    got = S._meetings(families, spark.createDataFrame(list(parts.items()), "node long, root long"), 32).collect()
    assert len(got) <= 200 + 20 + 400 + 40
    met = {}
    for x in got:
        assert x.part == parts[x.node]
        met.setdefault((x.family, x.block, x.chunk), ([], []))[x.out].append(x.node)
    pairs = {frozenset((a, b)) for inner, outer in met.values() for a in inner for b in outer if parts[a] != parts[b]}
    held = {}
    for f, _, n in overlapping + apart:
        held.setdefault(f, []).append(n)
    assert {frozenset((a, b)) for nodes in held.values() for a in nodes for b in nodes if parts[a] != parts[b]} <= pairs


def test_whole_small_table_equals_sql(spark):
    d = "/root/testdata/sf0.01"
    c = duckdb.connect()
    c.sql(f"CREATE VIEW documents AS SELECT * FROM '{d}/documents.parquet'")
    got, want = QUERIES["op11_bayesian_minhash"](spark, d), c.sql(M.oracle())
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == sorted(want.fetchall())
