import hashlib
import random
import re

from pyspark.sql import functions as F

from adlake.llm import pii as P
from adlake.llm.common import table

from .fixtures import EDGES, frame

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(d))) % 10 == 0


def brute(t):
    out = []
    for k, p in PATTERNS.items():
        for m in re.finditer(p, t or ""):
            d = re.sub("[^0-9]", "", m[0])
            if k == "ip" and max(map(int, m[0].split("."))) > 255 or k == "card" and not (14 <= len(d) <= 19 and luhn(d)) or k == "phone" and not 10 <= len(d) <= 15:
                continue
            out.append((m.start(), list(PATTERNS).index(k), f"{k}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(out)]


def corpus(seed, n=150):
    r = random.Random(seed)
    bits = ["a.b@c.de", "x@y.z_foo@bar.com", "@", ".", "+1 (555) 123-4567", "1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8", "4111 1111 1111 1111", "4111111111111112", "é", "🙂", " ", "-", "+", "12345678901234", "me [at] host [dot] org", "call 555-123-4567", "a@b", "9" * 30, "word"]
    return list(EDGES) + ["".join(r.choice(bits) + r.choice(["", " ", "\n"]) for _ in range(r.randint(1, 12))) for _ in range(n)]


def test_base_equals_brute_force(spark):
    texts = corpus(1)
    got = {x.doc_id: x for x in P.detect(frame(spark, texts, clashing=True)).collect()}
    assert len(got) == len(texts)
    for k, t in enumerate(texts):
        want = brute(t)
        assert got[k].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (t, want, got[k])
        assert set(want) <= set(got[k].spans.split(","))
        assert [got[k][f"n_{x}"] for x in P.KINDS] == [sum(w.startswith(x) for w in want) for x in P.KINDS]


def test_written_out_emails_are_found_and_prose_is_not(spark):
    written = ["john@example[dot]com", "john at example.com", "john @ example.com", "john [at] example [dot] com"]
    ended = "john at example.com. Then left"
    prose = ["The dot is here. He sat at home. Then left.", "look at readme.txt 2024-01-15 10", "he came at noon. Then he left 3/12/1999, 1990-2004"]
    texts = written + prose + ["so bob@firm.com is up", "write to a.b@c.de now", "we met at index.html", "seen at ten. Later they left"] * 30 + [ended]
    spans = {x.doc_id: x.spans for x in P.detect(frame(spark, texts)).collect()}
    assert [spans[k] for k in range(4)] == [f"email:0:{len(t)}" for t in written]
    assert spans[len(texts) - 1] == "email:0:19"
    assert [spans[k] for k in range(4, 7)] == [""] * 3


def test_long_runs_are_linear(spark):
    texts = ["a" * 300_000, "1" * 300_000, "1 " * 100_000, "a." * 100_000, "1." * 10_000, "+1" * 10_000]
    assert P.detect(frame(spark, texts)).count() == len(texts)


def test_redact(spark):
    docs = frame(spark, ["mail a.b@c.de now", "🙂 +1 (555) 123-4567!", None, "clean"], clashing=True)
    got = P.redact(docs).orderBy("doc_id").collect()
    assert [x.text for x in got] == ["mail [EMAIL] now", "🙂 [PHONE]!", None, "clean"]
    assert P.redact(docs).columns == docs.columns and got[0].n_chars == len(got[0].text)


def test_empty_table(spark):
    assert P.detect(frame(spark, [])).count() == 0


def test_many_spans_in_one_text(spark):
    """Sweeps over 20,000 spans: offsets, overlaps and redaction equal the plain loops."""
    r = random.Random(4)
    parts = [r.choice(["a{}@b.de", "+1 555 123 {:04d}", "10.0.0.{}", "x{} [at] h [dot] org", "é🙂"]).format(r.randrange(200)) for _ in range(20_000)]
    docs = frame(spark, [" , ".join(parts), "so a [at] b [dot] zz or 300.1.1.1"])
    got = {x.doc_id: x for x in P.detect(docs).collect()}
    want = brute(" , ".join(parts))
    assert got[0].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest() and set(want) <= set(got[0].spans.split(","))
    text, spans, out, at = " , ".join(parts), sorted((int(s), -int(e), k) for k, s, e in (x.split(":") for x in got[0].spans.split(","))), [], 0
    for s, e, k in spans:
        if s >= at:
            out.append(f"{text[at:s]}[{k.upper()}]")
        at = max(at, -e)
    assert {x.doc_id: x.text for x in P.redact(docs).collect()}[0] == "".join(out) + text[at:]


def test_null_and_repeated_ids(spark):
    docs = frame(spark, ["a@b.de", "a@b.de", None]).withColumn("doc_id", F.lit(None).cast("long"))
    assert sorted(x.n_email for x in P.detect(docs).collect()) == [0, 1, 1] and P.redact(docs).count() == 3


LOOSE = {
    "email": ["{n} [at] {h} [dot] com", "{n}(at){h}.org", "{n} at {h}.net", "{n} @ {h}.com", "{n}@{h}[dot]de"],
    "phone": ["({a}) {b}-{c}", "{a}-{b}-{c}", "tel {a}.{b}.{c}", "{a} {b} {c}"],
    "ip": ["10[.]{b}[.]{d}[.]7", "10. {d}. 3. {d}", "10 . {d} . 5 . {d}"],
    "card": ["4111.1111.1111.1111", "4111/1111/1111/1111"],
}


def test_added_spans_of_planted_forms(spark):
    """Forms that the base patterns don't know, put into every third document of the small table: recall by kind, and no span added elsewhere."""
    r = random.Random(1)
    texts = {x.doc_id: x.text for x in table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text").collect()}
    planted = {}
    for k in sorted(texts):
        if k % 3 == 0:
            kind = r.choice(sorted(LOOSE))
            form = r.choice(LOOSE[kind]).format(n=r.choice(["bob", "jane.doe", "k7"]), h=r.choice(["acme", "example", "site"]), a=r.randrange(200, 999), b=r.randrange(100, 255), c=r.randrange(1000, 9999), d=r.randrange(255))
            w = (texts[k] or "").split(" ")
            at = r.randrange(len(w) + 1)
            start = len(" ".join(w[:at])) + (at > 0)
            texts[k], planted[k] = " ".join([*w[:at], form, *w[at:]]), (kind, start, start + len(form))
    got = {x.doc_id: x for x in P.detect(spark.createDataFrame(sorted(texts.items()), "doc_id long, text string")).collect()}
    for kind in LOOSE:
        own = [(k, a, b) for k, (x, a, b) in planted.items() if x == kind]
        found = sum(any(int(s) < b and a < int(e) for _, s, e in (x.split(":") for x in got[k].spans.split(",") if x)) for k, a, b in own)
        assert found >= 0.95 * len(own), (kind, found, len(own))
    clean = [got[k].n_added for k in got if k not in planted]
    assert sum(clean) <= 0.01 * len(clean)
