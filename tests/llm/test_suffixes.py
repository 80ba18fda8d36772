import hashlib
import random

import numpy as np

from adlake.llm import suffixes as X

from .fixtures import EDGES, frame


def brute(texts):
    seen, out = set(), []
    for d, t in enumerate(texts):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - 99):
            w = b[s : s + 100]
            if w in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (not k or not gone[k - 1]))
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choices("abcdé", k=r.randint(1, 7)))
    shared = [" ".join(word() for _ in range(n)) for n in (14, 16, 20, 30, 60, 150)]
    texts = list(EDGES) + ["a" * 400, "ab" * 200, "abc " * 100, "a" * 99, "a" * 100]
    for _ in range(70):
        parts = []
        for _ in range(r.randint(1, 6)):
            if r.random() < 0.5:
                s = r.choice(shared)
                a = r.randrange(len(s) // 2)
                parts.append(s[a : a + r.randint(40, 400)])
            else:
                parts.append(" ".join(word() for _ in range(r.randint(1, 30))))
        texts.append("".join(parts))
    return texts + texts[-5:]


def test_equals_brute_force(spark):
    for seed, hot in ((1, 50_000), (2, 6), (3, 1)):
        texts = corpus(seed)
        got = X.deduplicate(frame(spark, texts, clashing=seed == 1).repartition(3), block_bytes=3000, hot=hot)
        assert sorted(map(tuple, got.collect())) == brute(texts)


def test_spans(spark):
    line = "".join(random.Random(1).choices("abcdefgh ", k=150))
    got = X.spans(frame(spark, ["x" + line + "y", "zz" + line + "w", None])).collect()
    assert [tuple(r) for r in got] == [(1, 2, 152)]


def test_loser_tree_merges():
    r = random.Random(4)
    for k in (1, 2, 3, 7, 16):
        runs = [sorted({bytes(r.choices(b"ab", k=X.WIDTH)) if r.random() < 0.5 else b"a" * 100 + bytes(r.choices(b"ab", k=X.WIDTH - 100)) for _ in range(r.randint(0, 40))}) for _ in range(k)]
        coded = [X.front_coded(np.frombuffer(b"".join(x), np.uint8).reshape(-1, X.WIDTH)) for x in runs]
        out = list(X.LoserTree([X._decoded(*c) for c in coded]))
        assert [x[1] for x in out] == sorted(k for x in runs for k in x)
        for (_, a, _), (_, b, n) in zip(out, out[1:], strict=False):
            assert n == X._shared(a, b, 0, X.WIDTH)


def test_empty_table(spark):
    assert X.deduplicate(frame(spark, [])).count() == 0
