"""Hand-made documents for the corner cases every operator must stand."""

from pyspark.sql import types as T

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names clash with names the operators use inside.
CLASHING = SCHEMA + ", score double, key string, kind string, fingerprint string, n_words long"


def frame(spark, texts, clashing=False):
    rows = [(i, t, None if i % 7 == 3 else "en", None if i % 5 == 4 else f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    if clashing:
        return spark.createDataFrame([(*r, 0.5, "k", "email", "f", 3) for r in rows], T._parse_datatype_string(CLASHING))
    return spark.createDataFrame(rows, T._parse_datatype_string(SCHEMA))


EDGES = [None, "", " \n\t", "a", "word", "two words", "Same text twice, said again.", "Same text twice, said again.", "é" * 50, "x " * 3000, "🙂 smile wide \x00 nul", "1" * 400, "A\nA\n\nB\nA"]
