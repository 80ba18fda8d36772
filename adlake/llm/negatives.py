"""Operator 12: hard-negative mining by cover trees over norm-augmented candidates.

A candidate x gets one more component, sqrt(M^2 - |x|^2) with M the largest norm, and a query q a zero there; then |q - x|^2 = |q|^2 + M^2 - 2 q.x, so the
largest inner products are the smallest distances, and a ball of radius r around a center c holds inner products from q.c - b to q.c + b only, where b is
the lesser of |q| r and what the distance's bounds give. Each level of a tree is a net: its centers are farther apart than the level's radius, which is at
most half of the one above (or as far as `FAN` centers go), and a parent's center is its first child's. Descent takes the nodes of the largest bounds first,
twice as many at each step, leaves out those whose products all lie outside of every window or below the rows found, and computes leaves' products exactly.

For scale: the top level's centers come from a bounded sample and cut the candidates into cells (counted, with radii and cut again by a hash where they are large),
so a task builds trees of some `SHARD` rows, one at a time, and streams the queries that come to it. A query first visits its nearest shard, which gives
it bounds, and then only the shards that may hold something better. Of candidates alike in vector and label only as many are indexed as one answer can name
(those of the smallest vec_id, chosen by a ranked window with partial limits), so no vector is hot. The driver holds the sample, the
centers and one line a cell.

Cases: rows with a null vec_id, label or vector, or a null or non-finite component, take no part; shorter vectors count as ending in zeros, an empty one too; rows alike in
vec_id, label and vector are one row; rows with the anchor's vec_id are no `other` rows; unlike anchors under one vec_id are answered each; a positive with a negative
score has an empty window; an empty table gives no rows; other columns are ignored. Products have to fit 64 bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpointed, map_batches

#: Fixed values of the contract: factor of the components; positives of an anchor, negatives of a positive; the window's least share of the positive's score.
SCALE, POSITIVES, NEGATIVES, SHARE = 256, 5, 5, (80, 100)
#: Rows of a tree, cells at most, rows of the sample that their centers come from; children of a node and rows of a leaf at most.
SHARD, CELLS, SAMPLE, FAN, LEAF = 8192, 256, 4096, 32, 32
_WIDE = 1 << 62


def _matrix(b: pa.RecordBatch, width: int) -> np.ndarray:
    """A batch's vectors as whole numbers, filled up with zeros."""
    v = b.column("vec")
    size = np.diff(np.asarray(v.offsets).astype(np.int64))
    out = np.zeros((len(b), width), np.int64)
    out[np.arange(width) < size[:, None]] = np.asarray(v.flatten())
    return out


def _augmented(x: np.ndarray, most: float) -> np.ndarray:
    f = x.astype(np.float64)
    return np.hstack([f, np.sqrt(np.maximum(0, most - (f * f).sum(1)))[:, None]])


def _net(x: np.ndarray, first: int, least: float, most: int) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Centers by farthest-first traversal, from `first` on until all rows are within `least` of one or there are `most`; each row's center and distance."""
    centers, own = [first], np.zeros(len(x), np.int64)
    far = np.sqrt(((x - x[first]) ** 2).sum(1))
    while len(centers) < most and far[k := int(far.argmax())] > least:
        d = np.sqrt(((x - x[k]) ** 2).sum(1))
        near = d < far
        far[near], own[near] = d[near], len(centers)
        centers.append(k)
    return centers, own, far


def _bounds(product: np.ndarray, distance: np.ndarray, norm: float, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest inner product that rows within `radius` of centers can have; a little wider than that, for rounding."""
    slack = 1e-6 + 1e-9 * (distance * distance + norm * norm)
    above = np.where(radius < distance, np.minimum(norm * radius, distance * radius - radius * radius / 2), norm * radius)
    below = np.minimum(norm * radius, distance * radius + radius * radius / 2)
    return product - below - slack, product + above + slack


class CoverTree:
    """Rows in the tree's order; a node is a range of them with a center, a radius and a range of children."""

    def __init__(self, x: np.ndarray, most: float):
        wide = _augmented(x, most)
        self.order, self.most = np.arange(len(x)), most
        nodes: list[list] = [[0, len(x), 0, 0, 0]]  # begin, end, center, first child, end of children
        radius, k = [0.0], 0
        while k < len(nodes):
            begin, end, center, _, _ = nodes[k]
            own = self.order[begin:end].copy()
            d = np.sqrt(((wide[own] - wide[center]) ** 2).sum(1))
            radius[k] = float(d.max()) * (1 + 1e-12)
            if end - begin > LEAF and radius[k] > 0:
                at = int(np.flatnonzero(own == center)[0])
                centers, part, _ = _net(wide[own], at, radius[k] / 2, FAN)
                ends = begin + np.cumsum(np.bincount(part, minlength=len(centers)))
                self.order[begin:end] = own[np.argsort(part, kind="stable")]
                nodes[k][3:] = len(nodes), len(nodes) + len(centers)
                for c, b, e in zip(centers, [begin, *ends[:-1].tolist()], ends.tolist(), strict=True):
                    nodes.append([b, e, int(own[c]), 0, 0])
                    radius.append(0.0)
            k += 1
        self.nodes, self.radius = np.array(nodes), np.array(radius)
        self.centers = x[self.nodes[:, 2]].astype(np.float64)
        self.exact = (x if most >= 2**53 else x.astype(np.float64))[self.order]  # no product is larger than the largest norm's square
        self.seen = 0  # rows whose products were computed

    def search(self, q: np.ndarray, wanted: np.ndarray, keys: np.ndarray, low: np.ndarray, high: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window low..high its first k wanted rows, by falling product and rising key: (products, keys). wanted and keys are in the rows' own order."""
        wanted, keys = wanted[self.order], keys[self.order]
        whole, norm2 = q.astype(np.float64), float((q.astype(np.float64) ** 2).sum())
        need = low.copy()  # no product below it is among the first k
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in low]
        nodes, uppers = np.array([0]), np.array([np.inf])
        lowers, step = np.array([-np.inf]), 1
        while len(nodes):
            alive = ((uppers[:, None] >= need) & (lowers[:, None] <= high)).any(1)
            nodes, lowers, uppers = nodes[alive], lowers[alive], uppers[alive]
            best = np.argsort(-uppers, kind="stable")
            take, rest = nodes[best[:step]], best[step:]
            nodes, lowers, uppers, step = nodes[rest], lowers[rest], uppers[rest], step * 2
            begin, end, first, last = self.nodes[take][:, [0, 1, 3, 4]].T
            if (leaf := first == 0).any():
                rows = np.concatenate([np.arange(b, e) for b, e in zip(begin[leaf].tolist(), end[leaf].tolist(), strict=True)])
                self.seen += len(rows)
                rows = rows[wanted[rows]]
                product = (self.exact[rows] @ q).astype(np.int64) if self.exact.dtype == np.int64 else (self.exact[rows] @ whole).astype(np.int64)
                for w in range(len(low)):
                    fit = (product >= need[w]) & (product <= high[w])
                    if fit.any():
                        s, i = np.concatenate([found[w][0], product[fit]]), np.concatenate([found[w][1], keys[rows[fit]]])
                        top = np.lexsort((i, -s))[:k]
                        found[w] = s[top], i[top]
                        if len(top) == k:
                            need[w] = max(need[w], s[top[-1]])
            if (~leaf).any():
                children = np.concatenate([np.arange(b, e) for b, e in zip(first[~leaf].tolist(), last[~leaf].tolist(), strict=True)])
                product = self.centers[children] @ whole
                distance = np.sqrt(np.maximum(0, norm2 + self.most - 2 * product))
                lo, up = _bounds(product, distance, norm2**0.5, self.radius[children])
                nodes, lowers, uppers = np.concatenate([nodes, children]), np.concatenate([lowers, lo]), np.concatenate([uppers, up])
        return found


def rows(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, vec) of the rows that take part, vec in whole numbers."""
    x, i = F.col("embedding").cast("array<double>"), F.col("vec_id").cast("long")
    taken = embeddings.select(i.alias("vec_id"), F.col("label").cast("long").alias("given"), x.alias("x")).where("vec_id IS NOT NULL AND given IS NOT NULL AND x IS NOT NULL")
    taken = taken.where(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("given") + 1) % 10).otherwise(F.col("given"))
    return taken.select("vec_id", label.alias("label"), F.transform("x", lambda v: F.floor(v * SCALE)).alias("vec"))


class Index:
    """The candidates in shards: (shard, vec_id, label, vec), and for each cell its center, radius and shards."""

    def __init__(self, candidates: DataFrame, same: int, shard: int = SHARD, cells: int = CELLS, sample: int = SAMPLE):
        alike = Window.partitionBy("label", "vec").orderBy("vec_id")
        few = candidates.withColumn("k", F.dense_rank().over(alike)).where(F.col("k") <= same).dropDuplicates(["label", "vec", "vec_id"]).drop("k")
        few = checkpointed(few)
        norm2 = F.aggregate("vec", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double"))
        n, width, most = few.agg(F.count("*"), F.max(F.size("vec")), F.max(norm2)).first()
        self.width, self.most = max(width or 0, 1), most or 0.0
        part = few.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vec").collect()
        x = np.array([[*v, *[0] * (self.width - len(v))] for (v,) in part], np.int64).reshape(-1, self.width)
        wide = _augmented(x, self.most)
        picked = _net(wide, 0, 0.0, max(1, min(cells, -(-n // shard))))[0] if n else []
        self.centers = x[picked]
        centers, width_, most_ = wide[picked], self.width, self.most

        def assign(b):
            y = _augmented(_matrix(b, width_), most_)
            d = np.sqrt(np.maximum(0, np.stack([((y - c) ** 2).sum(1) for c in centers])))
            yield {c: b.column(c) for c in ("vec_id", "label", "vec")} | {"cell": pa.array(d.argmin(0)), "far": pa.array(d.min(0))}

        placed = checkpointed(map_batches(few, assign, "vec_id long, label long, vec array<long>, cell long, far double")) if n else few.limit(0).selectExpr("*", "0L AS cell", "0D AS far")
        stats = {c: (m, far) for c, m, far in placed.groupBy("cell").agg(F.count("*"), F.max("far")).collect()}
        self.radius = np.array([stats.get(c, (0, 0.0))[1] * (1 + 1e-12) for c in range(len(picked))])
        self.salts = np.array([-(-stats.get(c, (0, 0.0))[0] // shard) for c in range(len(picked))], np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.salts)]).astype(np.int64)
        at = F.array(*[F.lit(int(v)) for v in self.starts.tolist()])
        salts = F.array(*[F.lit(int(v)) for v in [*self.salts.tolist(), 1]])
        cell = F.col("cell").cast("int")
        self.table = placed.select((F.get(at, cell) + F.pmod(F.xxhash64("vec_id"), F.get(salts, cell))).cast("long").alias("shard"), "vec_id", "label", "vec")

    def _near(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each cell, the bounds of its products with q."""
        whole = q.astype(np.float64)
        product, norm2 = self.centers.astype(np.float64) @ whole, float((whole**2).sum())
        return _bounds(product, np.sqrt(np.maximum(0, norm2 + self.most - 2 * product)), norm2**0.5, self.radius)

    def _visits(self, queries: DataFrame, others: bool) -> DataFrame:
        """queries, each once for every shard that it visits: its nearest one, or (others) those besides that its windows may be answered from."""
        centers, radius, salts, starts, width = self.centers, self.radius, self.salts, self.starts, self.width
        near = lambda q, self=_Cells(centers, radius, self.most): Index._near(self, q)

        def run(b):
            at, shard = [], []
            for k, (q, query, low, high) in enumerate(zip(_matrix(b, width), b.column("query").to_pylist(), b.column("low").to_pylist(), b.column("high").to_pylist(), strict=True)):
                lower, upper = near(q)
                upper = np.where(salts > 0, upper, -np.inf)
                home = int(upper.argmax())
                home_shard = starts[home] + query % salts[home]
                if others:
                    hit = (salts > 0) & ((upper[:, None] >= np.array(low)) & (lower[:, None] <= np.array(high))).any(1)
                    go = np.concatenate([np.arange(starts[c], starts[c + 1]) for c in np.flatnonzero(hit)] or [np.zeros(0, np.int64)])
                    go = go[go != home_shard]
                else:
                    go = np.array([home_shard])
                at += [k] * len(go)
                shard += go.tolist()
            for k in range(0, len(at), 4096):  # a batch's visits are sent on in parts
                part = b.take(pa.array(at[k : k + 4096], pa.int64()))
                yield {c: part.column(c) for c in ("query", "vec_id", "label", "vec", "low", "high")} | {"shard": pa.array(shard[k : k + 4096], pa.int64())}

        return map_batches(queries, run, "query long, vec_id long, label long, vec array<long>, low array<long>, high array<long>, shard long")

    def _answers(self, queries: DataFrame, same_label: bool, k: int, others: bool) -> DataFrame:
        """(query, w, score, vec_id): the first k rows of each window w in each shard visited."""
        width, most = self.width, self.most
        none = F.lit(None)
        held = self.table.select("shard", F.lit(0).alias("kind"), none.cast("long").alias("query"), "vec_id", "label", "vec", none.cast("array<long>").alias("low"), none.cast("array<long>").alias("high"))
        asked = self._visits(queries, others).select("shard", F.lit(1).alias("kind"), "query", "vec_id", "label", "vec", "low", "high")

        def run(batches):
            shard, parts, tree, ids, labels = None, [], None, None, None
            for batch in batches:
                here, kind = batch.column("shard").to_numpy(), batch.column("kind").to_numpy()
                x = _matrix(batch, width)
                i, label = batch.column("vec_id").to_numpy(), batch.column("label").to_numpy()
                query, low, high = batch.column("query"), batch.column("low"), batch.column("high")
                out: list[list] = [[], [], [], []]
                edges = np.flatnonzero(np.concatenate([[True], (here[1:] != here[:-1]) | (kind[1:] != kind[:-1]), [True]]))
                for b, e in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                    if here[b] != shard:
                        shard, parts, tree = here[b], [], None
                    if not kind[b]:
                        parts.append((x[b:e], i[b:e], label[b:e]))
                        continue
                    if tree is None and not parts:  # the hash left the shard empty
                        continue
                    if tree is None:
                        rows_, ids, labels = (np.concatenate(p) for p in zip(*parts, strict=True))
                        tree, parts = CoverTree(rows_, most), []
                    for r in range(b, e):
                        wanted = (labels == label[r]) & (ids != i[r]) if same_label else labels != label[r]
                        for w, (s, found) in enumerate(tree.search(x[r], wanted, ids, np.array(low[r].as_py(), np.int64), np.array(high[r].as_py(), np.int64), k)):
                            for o, v in zip(out, ([query[r].as_py()] * len(s), [w] * len(s), s.tolist(), found.tolist()), strict=True):
                                o.extend(v)
                if out[0]:
                    yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.int64())], names=["query", "w", "score", "vec_id"])

        both = held.union(asked).repartition("shard").sortWithinPartitions("shard", "kind")
        return both.mapInArrow(run, "query long, w int, score long, vec_id long")

    def search(self, queries: DataFrame, same_label: bool, k: int) -> DataFrame:
        """queries (query, vec_id, label, vec, low, high: windows of the inner product) -> (query, w, n, score, vec_id): each window's first k rows, n from 1.

        The candidates have the query's label and not its vec_id, or (same_label false) another label."""
        if not len(self.centers):
            return queries.select("query", F.lit(0).alias("w"), F.lit(1).alias("n"), F.lit(0).cast("long").alias("score"), "vec_id").limit(0)
        order = Window.partitionBy("query", "w").orderBy(F.desc("score"), "vec_id")
        first = checkpointed(self._answers(queries, same_label, k, False).withColumn("n", F.row_number().over(order)))
        full = first.where(F.col("n") == k).groupBy("query").agg(F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("least"))
        raised = F.transform("low", lambda v, w: F.coalesce(F.try_element_at("least", w.cast("int")), v))  # below the k-th found nothing counts
        better = self._answers(queries.join(full, "query", "left").withColumn("low", F.when(F.col("least").isNull(), F.col("low")).otherwise(raised)).drop("least"), same_label, k, True)
        return first.drop("n").union(better).withColumn("n", F.row_number().over(order)).where(F.col("n") <= k)


class _Cells:
    """What Index._near needs, for the workers."""

    def __init__(self, centers: np.ndarray, radius: np.ndarray, most: float):
        self.centers, self.radius, self.most = centers, radius, most


def mine(embeddings: DataFrame, anchor_every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES, shard: int = SHARD, cells: int = CELLS, sample: int = SAMPLE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the anchors, whose vec_id is divisible by anchor_every."""
    taken = rows(embeddings)
    index = Index(taken, max(positives + 1, negatives), shard, cells, sample)
    anchors = checkpointed(taken.where(F.col("vec_id") % anchor_every == 0).distinct().withColumn("query", F.monotonically_increasing_id()))
    whole = lambda v: F.array(F.lit(v).cast("long"))
    near = index.search(anchors.select("query", "vec_id", "label", "vec", whole(-_WIDE).alias("low"), whole(_WIDE).alias("high")), True, positives)
    near = checkpointed(near.where("score >= 0").select("query", "n", "score", F.col("vec_id").alias("positive_id")))
    ordered = near.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("n", "score"))).alias("p"))
    share = F.transform("p", lambda p: F.ceil(p["score"].cast("decimal(19,0)") * SHARE[0] / SHARE[1]).cast("long"))
    windows = anchors.join(ordered, "query").select("query", "vec_id", "label", "vec", share.alias("low"), F.transform("p", lambda p: p["score"]).alias("high"))
    far = index.search(windows, False, negatives)
    named = anchors.select("query", F.col("vec_id").alias("anchor_id"))
    out = far.select("query", (F.col("w") + 1).alias("at"), F.col("n").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    out = out.join(near.withColumnRenamed("n", "at").withColumnRenamed("score", "positive_score"), ["query", "at"]).join(named, "query")
    return out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def oracle(anchor_every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES) -> str:
    """mine() in DuckDB's SQL: every product."""
    return f"""WITH given AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
taken AS (SELECT DISTINCT vec_id, label, list_transform(x, lambda v: CAST(floor({SCALE} * v) AS BIGINT)) AS vec FROM given),
scored AS (SELECT a.vec_id AS anchor_id, b.vec_id, b.label = a.label AS same, CAST(coalesce(list_sum(list_transform(list_zip(a.vec, b.vec), lambda z: coalesce(z[1] * z[2], 0))), 0) AS BIGINT) AS score
  FROM taken a JOIN taken b ON a.vec_id % {anchor_every} = 0 WHERE a.label <> b.label OR a.vec_id <> b.vec_id),
positive AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {positives})
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positive p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT same AND {SHARE[0]} * positive_score <= {SHARE[1]} * score AND score <= positive_score QUALIFY rank <= {negatives}"""
