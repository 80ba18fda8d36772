"""Quality, toxicity and language: held-out accuracy on the small tables, and the corner cases."""

import random

import numpy as np
import pytest

from adlake.llm import language, quality, toxicity
from adlake.llm.common import table

from .fixtures import EDGES, frame

SF = "/root/testdata/sf0.01"


def accuracy(rows, labels, held_only=True):
    pairs = [(r.predicted, labels[r.doc_id]) for r in rows if r.doc_id in labels and (r.held_out or not held_only)]
    return sum(a == b for a, b in pairs) / len(pairs)


def test_quality_held_out(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    rows = quality.classify(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert accuracy(rows, {r.doc_id: r.quality for r in labels.collect()}) > 0.97


def test_toxicity_held_out_by_language(spark):
    """At sf0.1: recall of toxic documents outside the training folds, by language, and hardly a clean document hit."""
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    rows = toxicity.classify(docs, labels).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    held = [r for r in rows if r.held_out and r.doc_id in toxic]
    for lang, least in (("en", 0.9), ("de", 0.6), ("fr", 0.6), ("es", 0.6)):
        bad = [r.predicted for r in held if r.lang == lang and toxic[r.doc_id]]
        assert sum(bad) >= least * len(bad), (lang, sum(bad), len(bad))
    clean = [r.predicted for r in held if not toxic[r.doc_id]]
    assert sum(clean) <= 0.01 * len(clean)


def test_language_held_out(spark):
    docs = table(spark, SF, "documents")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    rows = [r for r in language.identify(docs).collect() if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in rows) / len(rows) > 0.97


@pytest.mark.parametrize("f", [quality.classify, toxicity.classify])
def test_corner_cases(spark, f):
    docs = frame(spark, EDGES, clashing=True)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    mixed = spark.createDataFrame([(k, k % 2, k % 2) for k in range(len(EDGES))] + [(1, None, None), (None, 1, 1), (2, 1, 1)], "doc_id long, quality int, toxic int")
    for labels in (none, mixed):
        rows = f(docs, labels).collect()
        assert sorted(r.doc_id for r in rows) == list(range(len(EDGES))) and all(0 <= r.score <= 1 for r in rows)
        by = {r.doc_id: r.score for r in rows}
        assert by[6] == by[7]  # equal texts
    assert f(frame(spark, []), mixed).count() == 0


def test_labels_are_learnt_outside_the_held_out_fold_only(spark):
    import zlib

    r = random.Random(1)
    texts = [" ".join(r.choices(["good", "plain", "words", "here"], k=40)) if k % 2 else "## $$ ".join("x" for _ in range(30)) for k in range(80)]
    docs = frame(spark, texts)
    true = [(k, k % 2, 0) for k in range(80)]
    wrong = [(k, 1 - k % 2, 0) if zlib.crc32(str(k).encode()) % 5 == 0 else (k, k % 2, 0) for k in range(80)]
    schema = "doc_id long, quality int, toxic int"
    a, b = ({x.doc_id: x.score for x in quality.classify(docs, spark.createDataFrame(y, schema)).collect()} for y in (true, wrong))
    assert a == b


def test_kernel_equals_a_triple_loop():
    r = random.Random(2)
    weights = np.array([r.uniform(-1, 1) for _ in range(toxicity.LETTERS**3)], np.float32)
    n = toxicity.LETTERS

    def phi(w):
        out = {}
        for i in range(len(w)):
            for k in range(i + 2, min(i + toxicity.SPAN, len(w) - 1) + 1):
                for j in range(i + 1, k):
                    t = (w[i] * n + w[j]) * n + w[k]
                    out[t] = out.get(t, 0.0) + toxicity.DECAY ** (k - i - 2)
        return out

    for text in ("one", "A few words. And a verylongwordindeedhere, yes!\nок, Слово 日本語の文字列です", "x y z", "i d i o t!", "n1tw1t 123"):
        c, token, sentence = toxicity.stream(text)
        want, sums, count = [], {}, {}
        for t in sorted(set(token.tolist())):
            w = c[token == t].tolist()
            for q in range(max(1, len(w) - toxicity.WINDOW + 1)):
                part = w[q : q + toxicity.WINDOW]
                norm = toxicity._NORMS[len(part)]
                want.append(sum(v * float(weights[x]) for x, v in phi(part).items()) / norm)
                s = int(sentence[token == t][0])
                count[s] = count.get(s, 0) + 1
                for x, v in phi(part).items():
                    sums[s, x] = sums.get((s, x), 0.0) + v / norm
        assert np.allclose(toxicity.margins(text, weights), want, atol=1e-3)
        table = weights[:, None]
        per = [sum(v * float(weights[x]) for (k, x), v in sums.items() if k == s) / count[s] ** 0.5 for s in sorted(count)]
        assert np.allclose(toxicity.images(text, table, step=7)[:, 0], per, atol=1e-4)


def insulting(r, words, bad, n):
    """n documents of five sentences; the odd ones hold a bad word in two of them."""
    texts = []
    for k in range(n):
        sentences = [r.choices(words, k=10) for _ in range(5)]
        if k % 2:
            for s in r.sample(sentences, 2):
                s[r.randrange(10)] = r.choice(bad)
        texts.append(". ".join(" ".join(s) for s in sentences) + ".")
    return texts


@pytest.mark.parametrize(
    "syllables,bad,padded",
    [
        (["ther", "stan", "lomi", "purg", "ing", "ed", "on", "ly", "er", "al"], ["blockhead", "nitwit"], ["n i t w i t", "nit-wit!", "nitxwit", "bl0ckhead", "blockkhead"]),
        (["ста", "ро", "ве", "лом", "ный", "ка", "при", "дор"], ["дурак", "болван"], ["д у р а к", "дурхак", "болвван"]),
    ],
)
def test_padded_insults_in_any_script(spark, syllables, bad, padded):
    r = random.Random(6)
    words = ["".join(r.choices(syllables, k=r.choice((1, 2, 2, 3)))) for _ in range(300)]
    texts = insulting(r, words, bad, 160)
    clean = [" ".join(r.choices(words, k=50)) for _ in range(20)]
    twice = [" ".join([*r.choices(words, k=24), w, *r.choices(words, k=24), w]) for w in padded]
    short = spark.createDataFrame([(k, 0, k % 2) for k in range(160)], "doc_id long, quality int, toxic int")
    got = {x.doc_id: x for x in toxicity.classify(frame(spark, texts + clean + twice), short).collect()}
    assert sum(got[k].predicted == k % 2 for k in range(160)) >= 158
    assert not any(got[k].predicted for k in range(160, 180))
    worst = max(got[k].score for k in range(160, 180))
    assert all(got[180 + k].score > worst for k in range(len(padded))), [(w, got[180 + k].score) for k, w in enumerate(padded)]


def test_short_insults_count(spark):
    r = random.Random(7)
    words = [f"{a}{b}" for a in ("tor", "mel", "san", "dri") for b in ("ka", "lo", "ne", "ti")]
    texts = insulting(r, words, ["bo", "zug"], 120)
    got = toxicity.classify(frame(spark, texts), spark.createDataFrame([(k, 0, k % 2) for k in range(120)], "doc_id long, quality int, toxic int")).collect()
    assert sum(x.predicted == x.doc_id % 2 for x in got if x.held_out) >= 0.9 * sum(x.held_out for x in got)


def test_mixture_takes_the_larger_part(spark):
    rows = [(k, "the of and that is this with" if k % 2 else "ñandú está señor mañana años", "en" if k % 2 else "es") for k in range(40)]
    mixed = ("the of and that is this with " * 6 + "ñandú está señor mañana años", None)
    rows += [(100, *mixed), (101, None, "en"), (102, "123 ...", "en"), (103, "", None)]
    got = {r.doc_id: r for r in language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got[100].lang_pred == "en" and 0.5 < got[100].score < 1
    assert [got[k].lang_pred for k in (101, 102, 103)] == ["und"] * 3
    assert all(got[k].lang_pred == ("en" if k % 2 else "es") for k in range(40))


def slow_mixture(text, model, least_share=0.1):
    """EM and the penalised choice of the set in plain loops."""
    g = language.trigrams(text).tolist()
    n = model.shape[1]

    def em(share, steps):
        for _ in range(steps):
            got = [0.0] * n
            for t in g:
                w = [share[k] * float(model[t, k]) for k in range(n)]
                for k in range(n):
                    got[k] += w[k] / sum(w)
            share = [x / len(g) for x in got]
        return share, sum(np.log(sum(share[k] * float(model[t, k]) for k in range(n))) for t in g)

    share, _ = em([1 / n] * n, 8)
    own = [sum(np.log(float(model[t, k])) for t in g) for k in range(n)]
    k = int(np.argmax(own))
    best, chosen = own[k], {k: share[k]}
    kept = [k for k in range(n) if share[k] >= min(least_share, max(share))]
    while len(kept) > 1:
        whole = sum(share[k] for k in kept)
        share, like = em([share[k] / whole if k in kept else 0.0 for k in range(n)], 4)
        if like - (len(kept) - 1) * np.log(len(g)) > best:
            best, chosen = like - (len(kept) - 1) * np.log(len(g)), {k: share[k] for k in kept}
        kept.remove(min(kept, key=lambda k: share[k]))
    return chosen


def test_mixture_equals_plain_loops():
    r = random.Random(3)
    letters = ["abcde", "defgh", "hijka", "lmnoa"]
    say = lambda k, n: " ".join("".join(r.choices(letters[k], k=r.randint(2, 6))) for _ in range(n))
    counts = np.stack([np.bincount(language.trigrams(say(k, 400)), minlength=language.BINS) for k in range(4)], 1) + 0.01
    model = (counts / counts.sum(0)).astype(np.float32)
    texts = [say(0, 20), f"{say(0, 30)} {say(1, 30)}", f"{say(0, 40)} {say(2, 30)} {say(3, 30)}", f"{say(1, 50)} {say(2, 4)}", "a", None, "..", " ".join(say(k, 25) for k in range(4))]
    got = language.infer(texts, model)
    for t, row in zip(texts, got, strict=True):
        want = slow_mixture(t, model) if len(language.trigrams(t)) else {}
        assert {k for k in range(4) if row[k] > 0} == set(want) and all(abs(row[k] - v) < 1e-3 for k, v in want.items()), (t, row, want)
    assert (got[2] > 0).sum() == 3  # three languages, found beside the sets of four and two


def test_language_corner_cases(spark):
    assert {r.lang_pred for r in language.identify(frame(spark, EDGES, clashing=True)).collect()} == {"en", "und"}
    assert language.identify(frame(spark, [])).count() == 0
    nothing = spark.createDataFrame([(1, "words", None)], "doc_id long, text string, lang string")
    assert [r.lang_pred for r in language.identify(nothing).collect()] == ["und"]
    high = spark.createDataFrame([(1, "\U00030001\U00030002", "zh"), (2, "words", "en"), (None, "words", "en"), (2, "words", "en")], "doc_id long, text string, lang string")
    assert sorted(r.lang_pred for r in language.identify(high).collect()) == ["en", "en", "en", "zh"]


def test_very_long_texts(spark):
    long = "some ordinary words in a row, said again and again. " * 40_000
    docs = frame(spark, [long, long + "end", "short one"], clashing=True)
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(3)], "doc_id long, quality int, toxic int")
    for rows in (quality.classify(docs, labels), toxicity.classify(docs, labels), language.identify(docs)):
        assert rows.count() == 3


def test_votes_equal_brute_force(spark):
    """Cosines and votes of every document against all labelled vectors in plain loops."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = quality.fit(docs, labels, sample=200)
    few = docs.where("doc_id % 40 = 0").select("doc_id", "text").toArrow().combine_chunks().to_batches()[0]
    got = quality.votes(few, model, 25)
    for k in range(few.num_rows):
        _, bins, weights = quality.features(few.slice(k, 1))
        x = sum((float(w) * model["basis"][int(b)].astype(float) for b, w in zip(bins, weights, strict=True)), np.zeros(model["basis"].shape[1]))
        size = np.sqrt((x * x).sum())
        cos = [float(x @ v) / size if size else 0.0 for v in model["vectors"].astype(float)]
        near = sorted(range(len(cos)), key=lambda j: -cos[j])[:25]
        w = [max(0.0, cos[j]) ** 2 for j in near]
        want = (sum(a * float(model["label"][j]) for a, j in zip(w, near, strict=True)) + model["base"]) / (sum(w) + 1)
        assert abs(got[k] - want) < 1e-3
