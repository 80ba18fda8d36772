"""Operator 11: near-duplicates by banded MinHash with sequential Bayesian verification.

A text's set of five-word shingles gets a signature of 256 minima; 24 bands of five places bring candidates together (of pairs at the bound, one in 1.3 million
shares no band). How candidates are pruned by the posterior of their signatures, batch by batch, how survivors are verified on the full sets, and how large groups
are kept apart is in sets.py; components come from contraction (graph.py), copies and hubs are salted.

Cases: null texts and texts without words have an empty set and are linked with nothing; fewer words than a shingle are one shingle; equal rows share a
component; rows without a doc_id take part, but name no component unless all of it lacks one, and are kept in that case only; different texts under one doc_id are nodes
of their own; very long texts are one set; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, skew_joined, texts
from .sets import BLOCK, MISS, joined_sets, prints_of

#: Fixed values of the contract: words in a shingle, and the similarity (per cent) that links.
SHINGLE, LEAST = 5, 85
#: Bands, and places in one.
BANDS, ROWS = 24, 5


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, least: int = LEAST, miss: float = MISS, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): the smallest doc_id that links reach, and whether it is the row's own."""
    prints = checkpointed(prints_of(texts(docs), shingle))
    sets = prints.where("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"), F.first("n_shingles").alias("n_shingles"), F.first("places").alias("places"))
    # written once, so a node keeps its number
    nodes = checkpointed(sets.withColumn("node", F.monotonically_increasing_id()).withColumn("id", F.coalesce("first", F.lit(-1).cast("long"))))
    keys = [F.xxhash64(F.lit(j), F.substring("places", ROWS * j + 1, ROWS)) for j in range(BANDS)]
    tree = joined_sets(docs, nodes, keys, shingle, least, miss, block)
    linked = tree.join(nodes.select("node", "first"), "node")
    lowest = linked.groupBy("root").agg(F.min("first").alias("lowest"), F.count("*").alias("n"))
    moved = skew_joined(linked.select("root", "node"), checkpointed(lowest), "root").select("node", F.col("lowest"), F.lit(True).alias("moved"))
    named = checkpointed(nodes.join(moved, "node", "left").select("digest", F.when(F.col("moved"), F.col("lowest")).otherwise(F.col("first")).alias("component_id"), "n"))
    rows = prints.select("doc_id", "n_shingles", "digest")
    out = skew_joined(rows.where("n_shingles > 0"), named, "digest").select("doc_id", "n_shingles", "component_id")
    out = out.union(rows.where("n_shingles = 0").select("doc_id", "n_shingles", "doc_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def oracle(shingle: int = SHINGLE, least: int = LEAST) -> str:
    """near_duplicates() in DuckDB's SQL: every two sets with a common shingle, and all that links reach."""
    return f"""WITH RECURSIVE words AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
grams AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + {shingle - 1}), ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {shingle - 1}, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY 1),
links AS (SELECT x.a, x.b FROM (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS shared FROM grams p JOIN grams q ON p.g = q.g AND p.doc_id <> q.doc_id GROUP BY ALL) x
  JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b WHERE 100 * shared >= {least} * (s.n + t.n - shared)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT doc_id, least(doc_id, coalesce(min(b), doc_id)) AS component_id FROM words LEFT JOIN reach ON a = doc_id GROUP BY doc_id)
SELECT l.doc_id, coalesce(n, 0) AS n_shingles, component_id, l.doc_id = component_id AS kept FROM least l LEFT JOIN sizes s ON s.doc_id = l.doc_id"""
