import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from adlake.llm import packing as P
from adlake.llm.common import table

from .fixtures import EDGES, frame


def test_pieces_rebuild_the_ids(spark):
    texts = EDGES + ["end <|endoftext|> of text", "  many   spaces\n\n\n", "it's we'll I'd", "long " * 9000]
    rows = P.pack(frame(spark, texts, clashing=True).repartition(3)).collect()
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        bins[r.sequence_id].append(r)
    assert set(pieces) == set(range(len(texts)))
    for k, t in enumerate(texts):
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(pieces[k], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for b in bins.values():
        at = 0
        for r in sorted(b, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= P.CAPACITY


def test_little_padding(spark):
    r = P.padding(P.pack(table(spark, "/root/testdata/sf0.01", "documents"))).first()
    assert r.padded < 0.01 * r.ids


def test_full_classes_hold_a_fixed_count(spark):
    rows = P.pack(table(spark, "/root/testdata/sf0.01", "documents")).collect()
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append(r.length)
    uniform = [b for b in bins.values() if len({P.CAPACITY // x for x in b}) == 1 and P.CAPACITY // b[0] <= 128]
    assert sum(len(b) == P.CAPACITY // b[0] for b in uniform) > 0.9 * len(uniform)


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 20_000), st.integers(1, 6))
def test_cut_adds_up(n, cuts):
    out = P.cut(n, cuts=cuts)
    assert sum(out) == n and all(0 < x <= P.CAPACITY for x in out) and len(out) <= n // P.CAPACITY + cuts + 1


def test_empty_table(spark):
    assert P.pack(frame(spark, [])).count() == 0


def test_ids_of_the_whole_table_equal_the_json_tokenizers():
    import pyarrow.parquet as pq

    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column("text").to_pylist()
    tok, fast = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), P.encoder()
    for t in texts:
        assert tok.encode(t or "", add_special_tokens=False).ids == fast.encode(t or "", allowed_special={P.SPECIAL}), t
