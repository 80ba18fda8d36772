"""Operator 1 [native]: personal data by candidate gradient boosting, in built-in functions only.

Generators propose spans in every whole text: the base patterns (e-mail, ip, card, phone; their valid matches always stay), and looser
ones with high recall (written-out e-mails, spaced or bracketed ips, digit runs with separators), which overlap each other and the
base. Each candidate gets format features (digits, groups, letters, separators, checksum, octets) and context ones (cue words before
it, what touches its edges). Of each kind, boosted trees of depth two are fitted to counts of feature combinations: base spans are the
positive rows; candidates that no form of their kind allows (failed checksum of an undivided run, octets over 255, too few digits, an e-mail's unknown last label, prose around ' at ')
the negative ones, and the rest is unlabelled. Every feature is binned, so the combinations are bounded (some hundred thousand for each kind, half of
the documents and label), whatever the corpus; the trees become a CASE expression. On the half of the documents that the trees don't see, each kind's
threshold is the lowest score whose precision is `precision` (half-way to the next lower score seen); a phone's leading plus, which the base
pattern demands, is no feature, so that numbers without it can pass. Candidates above it that don't overlap a base span are added. Of those that
overlap each other, a sweep from the left keeps the one of the higher score (ties: the earlier, then the longer).

No exchange: spans live in arrays beside their document. Offsets, overlaps and redaction are sweeps over sorted arrays in blocks of the root of
their length (an array grows by copying), so n spans of a document cost n^1.5 small steps (32,000 take some ten seconds). Offsets are code points.

Cases: null and empty texts have no spans; texts of one long run of digits or letters cost linear time; equal rows are judged alike;
a kind without base spans in both halves adds nothing, one without negative rows all its possible candidates; an empty table gives no rows; other columns are ignored (`redact` keeps them).
"""

from __future__ import annotations

from functools import partial

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed

#: The kinds in the contract's order, and its patterns; possessive and anchored, so that no text takes quadratic time.
KINDS = ["email", "ip", "card", "phone"]
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for the pattern to be tried.
GATES = {"email": "instr(t, '@') > 0", "ip": r"t RLIKE '[0-9]\\.[0-9]++\\.[0-9]++\\.[0-9]'", "card": r"t RLIKE '[0-9](?:[\\x20-]?[0-9]){13}'", "phone": "instr(t, '+') > 0"}
#: What an e-mail's written-out form holds after its name; the generator's pattern ends so, and the gate is just this part.
_HOST = r"(?:@|\[at\]|\(at\)|\{at\}| at ) ?[a-z0-9-]{1,63}+(?: ?(?:\.|\[dot\]|\(dot\)|\{dot\}| dot ) ?[a-z0-9-]{1,63}+)"
#: Further labels; a plain dot with a space only after it ends a sentence there.
_MORE = r"(?:(?:\.| \. ?| ?(?:\[dot\]|\(dot\)|\{dot\}) ?| dot )[a-z0-9-]{1,63}+){0,7}+"
#: The last labels in use (countries, common generic ones, those reserved for examples), and words before ' at ' that make it prose.
LABELS = (
    "com|org|net|edu|gov|mil|int|info|biz|name|pro|mobi|aero|coop|museum|jobs|travel|tel|cat|asia|post|arpa|io|app|dev|xyz|online|site|shop|store|tech|cloud|blog|email|live|"
    "agency|digital|group|company|solutions|systems|world|today|news|media|web|page|space|website|club|top|vip|work|life|design|studio|art|bank|wiki|academy|university|berlin|"
    "london|paris|example|test|invalid|localhost|local|"
    "ac|ad|ae|af|ag|ai|al|am|ao|aq|ar|as|at|au|aw|ax|az|ba|bb|bd|be|bf|bg|bh|bi|bj|bm|bn|bo|br|bs|bt|bv|bw|by|bz|ca|cc|cd|cf|cg|ch|ci|ck|cl|cm|cn|co|cr|cu|cv|cw|cx|cy|cz|"
    "de|dj|dk|dm|do|dz|ec|ee|eg|er|es|et|eu|fi|fj|fk|fm|fo|fr|ga|gb|gd|ge|gf|gg|gh|gi|gl|gm|gn|gp|gq|gr|gs|gt|gu|gw|gy|hk|hm|hn|hr|ht|hu|id|ie|il|im|in|iq|ir|is|it|je|jm|jo|"
    "jp|ke|kg|kh|ki|km|kn|kp|kr|kw|ky|kz|la|lb|lc|li|lk|lr|ls|lt|lu|lv|ly|ma|mc|md|me|mg|mh|mk|ml|mm|mn|mo|mp|mq|mr|ms|mt|mu|mv|mw|mx|my|mz|na|nc|ne|nf|ng|ni|nl|no|np|nr|nu|"
    "nz|om|pa|pe|pf|pg|ph|pk|pl|pm|pn|pr|ps|pt|pw|py|qa|re|ro|rs|ru|rw|sa|sb|sc|sd|se|sg|sh|si|sj|sk|sl|sm|sn|so|sr|ss|st|su|sv|sx|sy|sz|tc|td|tf|tg|th|tj|tk|tl|tm|tn|to|tr|"
    "tt|tv|tw|tz|ua|ug|uk|us|uy|uz|va|vc|ve|vg|vi|vn|vu|wf|ws|ye|yt|za|zm|zw"
)
_PROSE = "look|looks|looked|looking|see|visit|visited|available|found|find|hosted|live|lives|lived|work|works|worked|working|sat|sit|sits|stay|stayed|met|meet|arrive|arrived|me|us|it|is|was|are|were|be|you|them|him|her|here|there|that|this|online|and|or|not|more|page|site|website|shop"
#: The looser generators, by the kind they propose (digit runs propose a card from 13 digits on, else a phone).
LOOSE = {
    "email": (r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]{1,64}+ ?" + _HOST + _MORE, f"t RLIKE '(?i)[a-z0-9._%+-] ?{_HOST}'".replace("\\", "\\\\")),
    "ip": (r"(?<![0-9])[0-9]{1,3}+(?:(?:\[\.\]|\(\.\)|\[dot\]| \. ?|\. )[0-9]{1,3}+){3}", r"t RLIKE '[0-9](?:\\[|\\(| ?\\. ?)'"),
    "digits": (r"(?<![0-9])[(+]{0,2}[0-9](?:[\x20().\-/]{0,2}[0-9]){6,24}+", r"t RLIKE '[0-9](?:[\\x20().\\-/]{0,2}[0-9]){6}'"),
}
#: Dates (year first or last), with a time or a second date behind, and spans of years.
_DATE = r"^(?:19|20)[0-9]{2}[-/. ]{1,2}[0-9]{1,2}[-/. ]{1,2}[0-9]{1,2}(?:[^0-9].*)?$|^[0-9]{1,2}[-/. ]{1,2}[0-9]{1,2}[-/. ]{1,2}(?:19|20)[0-9]{2}(?:[^0-9].*)?$|^(?:19|20)[0-9]{2}[-/ ]{1,2}(?:19|20)[0-9]{2}$"
CUES = {"1": "tel|phone|call|mobile|fax|whatsapp", "2": "mail|contact|write", "3": "card|visa|credit|payment|master", "4": r"\bip\b|host|server|addr"}
SPAN = "array<struct<kind:string,s:int,e:int,v:string,pre:string,post:string,base:boolean>>"
#: Of features that part the sample equally well, trees take the first: what a form demands goes before what a corpus happens to share.
FEATURES = ["form", "luhn", "octets", "cue", "edge", "digits", "groups", "letters", "dots", "seps"]


def _luhn(v: Column) -> Column:
    d = F.reverse(F.regexp_replace(v, "[^0-9]", ""))
    digit = lambda i: F.substring(d, i, F.lit(1)).cast("int")
    twice = lambda x: F.when(x > 4, x * 2 - 9).otherwise(x * 2)
    total = F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), lambda a, i: a + F.when(i % 2 == 0, twice(digit(i))).otherwise(digit(i)))
    return F.when(F.length(d).between(12, 19), total % 10 == 0).otherwise(False)


def _digits(v: Column) -> Column:
    return F.length(F.regexp_replace(v, "[^0-9]", ""))


def _octets(v: Column) -> Column:
    parts = F.regexp_extract_all(v, F.lit("[0-9]+"), F.lit(0))
    return (F.size(parts) == 4) & F.forall(parts, lambda x: x.try_cast("double") <= 255)


def _valid(kind: str, v: Column) -> Column:
    return {"email": lambda: F.lit(True), "ip": lambda: _octets(v), "card": lambda: _digits(v).between(14, 19) & _luhn(v), "phone": lambda: _digits(v).between(10, 15)}[kind]()


def _scan(items: Column, state: Column, step, kind: str) -> Column:
    """step(state, x) -> (next state, y) over the items in order; the array of the ys (of type `kind`). In blocks, as appending copies an array."""
    none, nested = F.array().cast(f"array<{kind}>"), F.array().cast(f"array<array<{kind}>>")
    once = lambda value, f: F.get(F.transform(F.array(value), f), F.lit(0))  # noqa: E731  (an expression named in a lambda is computed once)

    def one(a: Column, x: Column) -> Column:
        next_, y = step(a["state"], x)
        return F.struct(next_.alias("state"), F.array_append(a["out"], y).alias("out"))

    def whole(it: Column) -> Column:
        n = F.size(it)
        block = F.greatest(F.ceil(F.sqrt(n.cast("double"))).cast("int"), F.lit(1))
        begins = F.when(n > 0, F.sequence(F.lit(1), n, block)).otherwise(F.array().cast("array<int>"))

        def many(a: Column, at: Column) -> Column:
            done = F.aggregate(F.slice(it, at, block), F.struct(a["state"].alias("state"), none.alias("out")), one)
            return once(done, lambda d: F.struct(d["state"].alias("state"), F.array_append(a["out"], d["out"]).alias("out")))

        return F.aggregate(begins, F.struct(state.alias("state"), nested.alias("out")), many, lambda a: F.flatten(a["out"]))

    return once(items, whole)


def _starts(found: str, gaps: str) -> Column:
    """Where each match begins: what lies between matches and the matches themselves, added up."""
    steps = F.transform(found, lambda v, i: F.length(F.get(gaps, i)) + F.when(i > 0, F.length(F.get(found, i - 1))).otherwise(0))
    return _scan(steps, F.lit(0), lambda a, x: (a + x, a + x), "int")


def _spans(kind: str, found: str, gaps: str, starts: str, base: bool) -> Column:
    def one(v: Column, i: Column) -> Column:
        s = F.get(starts, i)
        return F.struct(F.lit(kind).alias("kind"), s.alias("s"), (s + F.length(v)).alias("e"), v.alias("v"), F.right(F.get(gaps, i), F.lit(20)).alias("pre"), F.left(F.get(gaps, i + 1), F.lit(1)).alias("post"), F.lit(base).alias("base"))

    return F.transform(found, one).cast(SPAN)


def candidates(docs: DataFrame, *carried: str) -> DataFrame:
    """doc_id, carried columns, base (valid base spans) and loose (other candidates), both arrays of SPAN."""
    patterns = {f"b_{k}": (BASE[k], GATES[k]) for k in KINDS} | {f"l_{k}": v for k, v in LOOSE.items()}
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *carried, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    keep = ["doc_id", *carried]
    found = text.select(*keep, "t", *[F.when(F.expr(gate), F.regexp_extract_all("t", F.lit(p), F.lit(0))).otherwise(F.array().cast("array<string>")).alias(k) for k, (p, gate) in patterns.items()])
    gaps = found.select(*keep, *patterns, *[F.when(F.size(k) > 0, F.split("t", p, -1)).alias(f"g_{k}") for k, (p, _) in patterns.items()])
    placed = gaps.select("*", *[_starts(k, f"g_{k}").alias(f"s_{k}") for k in patterns])
    spans = placed.select(*keep, *[_spans(k.split("_")[1], k, f"g_{k}", f"s_{k}", k[0] == "b").alias(k) for k in patterns])
    valid = [F.filter(f"b_{k}", partial(lambda kind, x: _valid(kind, x["v"]), k)) for k in KINDS]
    split = F.transform("l_digits", lambda x: x.withField("kind", F.when(_digits(x["v"]) >= 13, "card").otherwise("phone")))
    both = spans.select(*keep, F.concat(*valid).alias("base"), F.concat("l_email", "l_ip", split, *[f"b_{k}" for k in KINDS]).alias("l"))
    return both.select(*keep, "base", F.when((F.size("l") > 0) & (F.size("base") > 0), _apart("l", "base")).otherwise(F.col("l")).alias("loose"))


def _apart(loose: str, base: str) -> Column:
    """The loose spans that overlap no base span: by the furthest end of base spans that begin before them (or with them), and, from the right, the next one's beginning."""
    item = lambda own: lambda x: F.struct(x["s"].alias("s"), F.lit(own).alias("own"), x["e"].alias("e"), x.alias("x"), F.lit(False).alias("hit"))
    kind = f"struct<s:int,own:int,e:int,x:{SPAN[6:-1]},hit:boolean>"
    by_start = F.array_sort(F.concat(F.transform(base, item(0)), F.transform(loose, item(1))).cast(f"array<{kind}>"))
    marked = lambda x, hit: x.withField("hit", x["hit"] | hit)
    left = _scan(by_start, F.lit(-1), lambda end, x: (F.when(x["own"] == 0, F.greatest(end, x["e"])).otherwise(end), marked(x, (x["own"] == 1) & (end > x["s"]))), kind)
    right = _scan(F.reverse(left), F.lit(2**31 - 1), lambda start, x: (F.when(x["own"] == 0, x["s"]).otherwise(start), marked(x, (x["own"] == 1) & (start < x["e"]))), kind)
    return F.transform(F.filter(right, lambda x: (x["own"] == 1) & ~x["hit"]), lambda x: x["x"]).cast(SPAN)


def _form(x: Column) -> Column:
    """What speaks against a candidate's form, else 0. An e-mail: 1 with an unknown last label, 2 as prose (a word of _PROSE before ' at ', or a sentence's
    end among the labels); a phone: 1 as a bare run of digits, a date or a span of years, 2 with too few or too many."""
    v, n = x["v"], _digits(x["v"])
    phone = F.when(~n.between(7, 15), 2).when(v.rlike(f"^[0-9]+$|{_DATE}"), 1).otherwise(0)
    prose = v.rlike(f"(?i)^(?:{_PROSE}) at ") | v.rlike(r"[^ ]\. ")
    return F.when(x["kind"] == "phone", phone).when(x["kind"] != "email", 0).when(prose, 2).when(~v.rlike(f"(?i)[^a-z0-9-](?:{LABELS}|xn--[a-z0-9-]+)$"), 1).otherwise(0)


def _features(x: Column) -> dict[str, Column]:
    v = x["v"]
    cue = F.lit(0)
    for k, words in CUES.items():
        cue = F.when(F.lower(x["pre"]).rlike(words), int(k)).otherwise(cue)
    letters = F.regexp_count(v, F.lit("[A-Za-z]"))
    number = lambda c: F.when(x["kind"] == "email", 0).otherwise(c)  # noqa: E731  (an e-mail's digits and blanks say nothing)
    found = {
        "digits": number(F.least(_digits(v), F.lit(20))),
        "groups": number(F.least(F.regexp_count(v, F.lit("[0-9]+")), F.lit(6))),
        "letters": F.when(letters == 0, 0).when(letters < 6, 1).otherwise(2),
        "luhn": _luhn(v).cast("int"),
        "octets": _octets(v).cast("int"),
        "dots": F.least(F.regexp_count(v, F.lit(r"\.|dot")), F.lit(3)),
        "seps": number(F.least(F.regexp_count(v, F.lit(r"[\x20()/-]+")), F.lit(4))),
        "cue": cue,
        "edge": x["pre"].rlike("[A-Za-z0-9]$").cast("int") + 2 * x["post"].rlike("^[A-Za-z0-9]").cast("int"),
        "form": _form(x),
    }
    return {k: found[k] for k in FEATURES}


def _impossible(x: Column) -> Column:
    """Candidates that no form of their kind allows."""
    v = x["v"]
    return (
        ((x["kind"] == "card") & ~_luhn(v))
        | ((x["kind"] == "ip") & ~_octets(v))
        | (_form(x) > 0)
    )


def _tree(f: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int) -> tuple:
    """A regression tree over gradient and curvature sums: (feature, limit, left, right), or a leaf's value."""
    if depth and len(f) > 1:
        best, total = (1e-6, None), g.sum() ** 2 / (h.sum() + 1)
        for k in range(f.shape[1]):
            values = np.unique(f[:, k])[:-1]
            for limit in values:
                low = f[:, k] <= limit
                gain = g[low].sum() ** 2 / (h[low].sum() + 1) + g[~low].sum() ** 2 / (h[~low].sum() + 1) - total
                if gain > best[0]:
                    best = (gain, (k, int(limit), low))
        if best[1]:
            k, limit, low = best[1]
            return k, limit, _tree(f[low], g[low], h[low], depth - 1), _tree(f[~low], g[~low], h[~low], depth - 1)
    return (float(g.sum() / (h.sum() + 1)),)


def _apply(tree: tuple, f: np.ndarray) -> np.ndarray:
    if len(tree) == 1:
        return np.full(len(f), tree[0])
    return np.where(f[:, tree[0]] <= tree[1], _apply(tree[2], f), _apply(tree[3], f))


def _expression(tree: tuple, feature: list[Column]) -> Column:
    if len(tree) == 1:
        return F.lit(tree[0])
    return F.when(feature[tree[0]] <= tree[1], _expression(tree[2], feature)).otherwise(_expression(tree[3], feature))


def fit(found: DataFrame, trees: int = 24, rate: float = 0.3, precision: float = 0.98) -> dict:
    """Boosted trees and thresholds from the candidates of the whole corpus, as counts of their feature combinations."""
    row = F.explode(F.concat(F.transform("base", lambda x: F.struct(x.alias("x"), F.lit(1).alias("y"))), F.transform(F.filter("loose", _impossible), lambda x: F.struct(x.alias("x"), F.lit(0).alias("y")))))
    rows = found.select(F.pmod(F.xxhash64("doc_id"), F.lit(2)).alias("fold"), row.alias("r"))
    kind = F.array_position(F.array(*map(F.lit, KINDS)), F.col("r.x.kind")).cast("int") - 1
    counts = rows.select("fold", kind.alias("kind"), F.col("r.y").alias("y"), *[c.alias(k) for k, c in _features(F.col("r.x")).items()]).groupBy("fold", "kind", "y", *FEATURES).agg(F.count("*").alias("n"))
    got = np.array([tuple(r) for r in counts.collect()], np.int64).reshape(-1, 4 + len(FEATURES))
    model: dict = {}
    for number, name in enumerate(KINDS):
        own = got[got[:, 1] == number]
        fold, y, n, f = own[:, 0], own[:, 2], own[:, -1].astype(float), own[:, 3:-1]
        seen = fold == 0
        good, bad = n[seen & (y == 1)].sum(), n[seen & (y == 0)].sum()
        if not good or not n[~seen & (y == 1)].sum():
            continue
        start = float(np.log((good + 1) / (bad + 1)))
        margin, grown = np.full(len(f), start), []
        for _ in range(trees if bad else 0):
            p = 1 / (1 + np.exp(-margin))
            tree = _tree(f[seen], ((y - p) * n)[seen], (p * (1 - p) * n)[seen], 2)
            margin += rate * _apply(tree, f)
            grown.append(tree)
        order = np.flatnonzero(~seen)[np.argsort(-margin[~seen], kind="stable")]
        m, right, all_ = margin[order], (y * n)[order].cumsum(), n[order].cumsum()
        ok = np.flatnonzero((right / all_ >= precision) & np.append(m[1:] < m[:-1], True))
        if len(ok) and right[ok[-1]]:
            # any limit down to the next lower score has that precision: the middle, so that forms near the known ones pass
            last, below = m[ok[-1]], m[m < m[ok[-1]]]
            limit = float((last + below[0]) / 2 if len(below) else last - 1)
            model[name] = {"start": start, "rate": rate, "trees": grown, "limit": max(0.0, limit)}
    return model


def added(model: dict) -> Column:
    """The loose candidates that pass; of those that overlap, the sweep's survivor."""
    if not model:
        return F.array().cast(SPAN)

    def margin(x: Column) -> Column:
        """How far the candidate's score is over its kind's limit."""
        feature, out = list(_features(x).values()), F.lit(-1.0)
        for name, own in model.items():
            total = F.lit(own["start"] - own["limit"])
            for t in own["trees"]:
                total = total + F.lit(own["rate"]) * _expression(t, feature)
            out = F.when(x["kind"] == name, total).otherwise(out)
        return out

    kind = f"struct<s:int,e:int,m:double,x:{SPAN[6:-1]}>"
    scored = F.transform(F.filter("loose", lambda x: ~_impossible(x)), lambda x: F.struct(x["s"].alias("s"), (-x["e"]).alias("e"), margin(x).alias("m"), x.alias("x"))).cast(f"array<{kind}>")
    passing = F.array_sort(F.filter(scored, lambda c: c["m"] >= 0))
    nothing = F.lit(None).cast(kind)

    def step(best: Column, c: Column) -> tuple[Column, Column]:
        """best: the survivor so far. It goes out when a candidate begins at its end or later."""
        over = best.isNotNull() & (c["s"] < -best["e"])
        return F.when(over & (best["m"] >= c["m"]), best).otherwise(c), F.when(~over, best).otherwise(nothing)

    # a last item, beyond all, sends the last survivor out
    beyond = F.struct(F.lit(2**31 - 1).alias("s"), F.lit(0).alias("e"), F.lit(0.0).alias("m"), F.lit(None).cast(SPAN[6:-1]).alias("x")).cast(kind)
    kept = _scan(F.concat(passing, F.array(beyond)), nothing, step, kind)
    return F.transform(F.filter(kept, lambda c: c.isNotNull()), lambda c: c["x"]).cast(SPAN)


def _joined(spans: Column) -> Column:
    number = lambda x: F.array_position(F.array(*map(F.lit, KINDS)), x["kind"])
    order = F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), number(x).alias("k"), x["e"].alias("e"), x["kind"].alias("kind"))))
    return F.array_join(F.transform(order, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def detect(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_added."""
    found = checkpointed(candidates(docs))
    out = found.select("doc_id", "base", added(fit(found)).alias("more"))
    n = [F.size(F.filter("base", partial(lambda kind, x: x["kind"] == kind, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return out.select("doc_id", *n, F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.concat("base", "more")).alias("spans"), F.size("more").cast("long").alias("n_added"))


def redact(docs: DataFrame) -> DataFrame:
    """docs with every span, merged where they overlap, written as [KIND] of its first part; n_chars, if there, follows."""
    quoted = {c: "`" + c.replace("`", "``") + "`" for c in docs.columns}
    named = docs.select("doc_id", F.struct(*quoted.values()).alias("row__"), "text")
    found = checkpointed(candidates(named, "row__"))
    kind = "struct<s:int,e:int,kind:string>"
    spans = F.array_sort(F.transform(F.concat("base", added(fit(found))), lambda x: F.struct(x["s"].alias("s"), (-x["e"]).alias("e"), x["kind"].alias("kind"))).cast(f"array<{kind}>"))
    # where spans overlap, what follows is written to the furthest end so far: a span's own piece begins there, and a span within another has no sign
    piece = "struct<from:int,s:int,e:int,kind:string>"

    def step(end: Column, x: Column) -> tuple[Column, Column]:
        far = F.greatest(end, -x["e"])
        return far, F.struct(end.alias("from"), F.greatest(end, x["s"]).alias("s"), far.alias("e"), F.when(x["s"] >= end, x["kind"]).alias("kind"))

    out = found.select("row__", spans.alias("spans")).select("row__", F.when(F.size("spans") > 0, _scan(F.col("spans"), F.lit(0), step, piece)).alias("p"))
    text, n = F.col("row__.text"), F.size("p")
    block = F.greatest(F.ceil(F.sqrt(n.cast("double"))).cast("int"), F.lit(1))

    def written(at: Column) -> Column:
        """A block of pieces: cut out of the text once, and each then out of the block."""
        part = F.slice("p", at, block)
        bounds = F.struct(F.get(part, F.lit(0))["from"].alias("lo"), F.get(part, F.size(part) - 1)["e"].alias("hi"), part.alias("part"))
        cut = lambda b: F.struct(F.substring(text, b["lo"] + 1, b["hi"] - b["lo"]).alias("t"), b["lo"].alias("lo"), b["part"].alias("part"))
        sign = lambda x: F.when(x["kind"].isNotNull(), F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]"))).otherwise("")
        line = lambda c: F.array_join(F.transform(c["part"], lambda x: F.concat(F.substring(c["t"], x["from"] - c["lo"] + 1, x["s"] - x["from"]), sign(x))), "")
        return F.get(F.transform(F.transform(F.array(bounds), cut), line), F.lit(0))

    begins = F.sequence(F.lit(1), n, block)
    tail = F.get("p", n - 1)["e"]
    clean = F.when(n > 0, F.concat(F.array_join(F.transform(begins, written), ""), F.substring(text, tail + 1, F.length(text)))).otherwise(text)
    done = out.select(F.col("row__").alias("row__"), clean.alias("clean__"))
    number = lambda c: F.length("clean__").cast("long").alias(c) if c == "n_chars" else F.col(f"row__.{quoted[c]}")
    return done.select(*[F.col("clean__").alias("text") if c == "text" else number(c) for c in docs.columns])
