"""Operator 2 [native]: quality rules judged with their hosts.

Every document is measured by built-in functions in one pass. Its rule failures are summed by host; each rule's failure rate of a host is
shrunk towards the corpus with a beta prior whose two parameters come from the hosts themselves (method of moments over the
raw rates), and the host verdicts are joined back: a host is refused when a shrunk rate passes `host_limit`; in other hosts a
document that fails a rule goes when its host's shrunk rate of that rule is `doc_limit` or more, so a lone failure in a clean host
is forgiven. Host sums are partially aggregated, so one host may hold any share of the rows; the hosts are broadcast only while
their counted number is `broadcast_hosts` or less, and beyond that the join is salted by `salt`.

Repeated three-word windows are told by their words; hashes only bring them together.

Cases: null and empty texts have no words and fail the base rules; a null host is a host of its own (the empty name); equal rows are
judged alike; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed

#: Fixed values of the contract: words are runs without blanks, and the symbols that count.
WORD, SYMBOL = r"[^\x20\x09-\x0D]+", r"[#*$%&|<>]"
#: The rules whose failures are summed by host.
RULES = {
    "symbols": "n_symbols * 100 > n_words * 30",
    "lines": "n_dup_lines * 100 > n_lines * 50",
    "repeats": "n_repeat_words * 100 > n_words * 50",
    "word_length": "word_chars * 10 < n_words * 25 OR word_chars > n_words * 12",
}
BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


def measured(docs: DataFrame, *carried: str) -> DataFrame:
    """doc_id, the carried columns, and the counts of each document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *carried, text.alias("t"), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("w"))
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(WORD))
    at = lambda i: F.get("w", i)
    grams = F.when(F.size("w") >= 3, F.transform(F.sequence(F.lit(0), F.size("w") - 3), lambda i: F.xxhash64(at(i), at(i + 1), at(i + 2)))).otherwise(F.array().cast("array<long>"))
    hashed = words.select("doc_id", *carried, F.size("w").alias("n_words"), F.length(F.array_join("w", "")).alias("word_chars"), F.regexp_count("t", F.lit(SYMBOL)).alias("n_symbols"), lines.alias("lines"), grams.alias("g"), "w")
    # windows of one hash lie together by their words, so only equal words count as a repeat
    placed = F.sort_array(F.transform("g", lambda h, i: F.struct(F.struct(h.alias("h"), at(i).alias("a"), at(i + 1).alias("b"), at(i + 2).alias("c")).alias("k"), i.alias("i"))))
    again = hashed.select("doc_id", *carried, "n_words", "word_chars", "n_symbols", F.size("lines").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"), F.when(F.size(F.array_distinct("g")) < F.size("g"), placed).alias("p"))
    twin = lambda x, k: (x["k"] == F.get("p", k - 1)["k"]) | (x["k"] == F.get("p", k + 1)["k"])
    places = F.sort_array(F.transform(F.filter("p", twin), lambda x: x["i"]))
    covered = F.aggregate(
        places,
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda a, i: F.struct((a["n"] + F.least(F.lit(3), i - a["last"])).alias("n"), i.alias("last")),
        lambda a: a["n"],
    )
    out = again.withColumn("n_repeat_words", F.when(F.col("p").isNotNull(), covered).otherwise(0))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return out.select("doc_id", *carried, *[F.col(c).cast("long").alias(c) for c in counts], F.col("n_lines").cast("long").alias("n_lines"))


def host_rates(found: DataFrame) -> DataFrame:
    """host, n and for each rule its shrunk failure rate."""
    fails = [F.count_if(F.expr(r)).alias(f"f_{k}") for k, r in RULES.items()]
    hosts = checkpointed(found.groupBy("host").agg(F.count("*").alias("n"), *fails))
    rates = {k: F.col(f"f_{k}") / F.col("n") for k in RULES}
    moments = hosts.agg(*[x for k, r in rates.items() for x in (F.avg(r).alias(f"m_{k}"), F.var_pop(r).alias(f"v_{k}"))]).first()
    out = [F.col("host"), F.col("n")]
    for k in RULES:
        mean, var = moments[f"m_{k}"] or 0.0, moments[f"v_{k}"] or 0.0
        strength = min(1e6, max(1.0, mean * (1 - mean) / var - 1)) if var > 0 else 1e6
        out.append(((F.col(f"f_{k}") + mean * strength) / (F.col("n") + strength)).alias(f"rate_{k}"))
    return hosts.select(*out)


def judge(docs: DataFrame, host_column: str = "source", host_limit: float = 0.6, doc_limit: float = 0.02, broadcast_hosts: int = 200_000, salt: int = 64) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept."""
    host = F.coalesce(F.col(host_column).cast("string"), F.lit("")).alias("host")
    found = checkpointed(measured(docs.select("doc_id", "text", host), "host"))
    rates = host_rates(found)
    refused = F.greatest(*[F.col(f"rate_{k}") for k in RULES]) > host_limit
    verdicts = rates.select("host", refused.alias("host_refused"), *[(F.col(f"rate_{k}") >= doc_limit).alias(f"strict_{k}") for k in RULES])
    if verdicts.count() <= broadcast_hosts:
        joined = found.join(F.broadcast(verdicts), "host")
    else:
        spread = verdicts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
        joined = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salt)).cast("int")).join(spread, ["host", "salt"])
    own = F.lit(False)
    for k, r in RULES.items():
        own = own | (F.col(f"strict_{k}") & F.expr(r))
    base = F.expr(BASE_FAILED)
    kept = ~base & ~F.col("host_refused") & ~own
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), kept.alias("kept"))


def oracle(host_limit: float = 0.6, doc_limit: float = 0.02) -> str:
    """The same in DuckDB SQL."""
    each = lambda f, sep=", ": sep.join(f(k, r) for k, r in RULES.items())
    return f"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, host, t, regexp_extract_all(t, '{WORD}') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l FROM t),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
twice AS (SELECT doc_id, g FROM g GROUP BY ALL HAVING count(*) > 1),
cov AS (SELECT doc_id, count(DISTINCT i + d) AS n FROM g JOIN twice USING (doc_id, g), (SELECT unnest([0, 1, 2]) AS d) GROUP BY doc_id),
m AS (SELECT doc_id, host, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
  length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(cov.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN cov USING (doc_id)),
h AS (SELECT host, count(*) AS n, {each(lambda k, r: f"count(*) FILTER ({r}) AS f_{k}")} FROM m GROUP BY host),
p AS (SELECT {each(lambda k, r: f"avg(f_{k} / n) AS m_{k}, var_pop(f_{k} / n) AS v_{k}")} FROM h),
s AS (SELECT {each(lambda k, r: f"m_{k}, CASE WHEN v_{k} > 0 THEN least(1e6, greatest(1.0, m_{k} * (1 - m_{k}) / v_{k} - 1)) ELSE 1e6 END AS s_{k}")} FROM p),
r AS (SELECT host, {each(lambda k, r: f"(f_{k} + m_{k} * s_{k}) / (n + s_{k}) AS rate_{k}")} FROM h, s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ({BASE_FAILED}) AS base_failed,
  NOT ({BASE_FAILED}) AND NOT (greatest({each(lambda k, r: f"rate_{k}")}) > {host_limit}) AND NOT ({each(lambda k, r: f"(rate_{k} >= {doc_limit} AND ({r}))", " OR ")}) AS kept
FROM m JOIN r USING (host)"""
