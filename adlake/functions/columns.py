"""Column expressions the operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Upper bounds (exclusive) and labels of the price histogram.
PRICE_BUCKETS = [(5000, "0-5K"), (10000, "5K-10K"), (20000, "10K-20K"), (30000, "20K-30K"), (50000, "30K-50K"), (100000, "50K-100K")]
PRICE_REST = "100K+"


def slug(name: Column) -> Column:
    """Lower case, every space a dash."""
    return F.replace(F.lower(name), F.lit(" "), F.lit("-"))


def model_slug(make: Column, model: Column) -> Column:
    return F.concat(slug(make), F.lit("-"), slug(model))


def catalogue_slug(name: Column) -> Column:
    """For catalogue entries without a canonical name: blanks and dashes collapse, other signs go."""
    return F.regexp_replace(F.regexp_replace(F.lower(F.trim(name)), r"[\s-]+", "-"), r"[^\w-]", "")


def guarded_int(text: Column) -> Column:
    """The integer of an all-digit text (ASCII digits, nothing around them), else NULL."""
    return F.when(text.rlike(r"\A[0-9]+\z"), text.try_cast("int"))


def price_bucket(price: Column) -> Column:
    out = None
    for top, label in PRICE_BUCKETS:
        out = F.when(price < top, label) if out is None else out.when(price < top, label)
    return out.otherwise(PRICE_REST)


def rounded(x: Column) -> Column:
    """Two digits, half to even; NULL counts as 0."""
    return F.coalesce(F.bround(x.cast("double"), 2), F.lit(0.0))


def like_pattern(term: str) -> str:
    """%term%, wildcards in it kept; a backslash before an ordinary character is dropped, as it only escapes."""
    out, k = "", 0
    while k < len(term):
        if term[k] == "\\":
            if k + 1 < len(term) and term[k + 1] in "%_\\":
                out += term[k : k + 2]
                k += 2
                continue
            k += 1
            continue
        out += term[k]
        k += 1
    return f"%{out}%"


def contains(column: Column, term: str) -> Column:
    return column.ilike(like_pattern(term))

