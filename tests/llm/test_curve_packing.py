import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from riskspark.llm import curve_packing as cp
from riskspark.llm import registry
from riskspark.llm.tokens import WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


def check_pieces(pieces, texts, capacity=4096):
    """Exact round trip: pieces tile every document and every sequence."""
    tok = Tokenizer.from_file(PATH)
    want = {d: tok.encode(t or "", add_special_tokens=False).ids + [2] for d, t in texts}
    by_doc, by_seq = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_seq.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(want)
    for d, ps in by_doc.items():
        at = 0
        for p in sorted(ps, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(want[d])
            ids = np.array(want[d][at:at + p.length], "<u4").tobytes()
            assert p.ids_crc32 == zlib.crc32(ids)
            at += p.length
        assert at == len(want[d])
    sizes = []
    for s in sorted(by_seq):
        at = 0
        for p in sorted(by_seq[s], key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        sizes.append(at)
    assert sorted(by_seq) == list(range(len(sizes)))
    assert all(n == capacity for n in sizes[:-1]) and 0 < sizes[-1] <= capacity


def test_query_round_trip(spark):
    texts = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    check_pieces(registry.QUERIES["op1_curve_packing"](spark, SF).collect(), texts)


def test_word_encoder_equals_the_tokenizer():
    rnd = random.Random(7)
    tok, enc = Tokenizer.from_file(PATH), WordEncoder(PATH, "<u2")
    tok.encode_special_tokens = True
    chars = "aZß'sé́Σς \t\n\x1c\x1f  　\u0085᠎﻿12.,!中İ😀가"
    texts = ["", " ", "it's I'LL", "a <|endoftext|> x<|startoftext|>y", *("".join(rnd.choice(chars) for _ in range(rnd.randint(1, 40))) for _ in range(2000))]
    assert enc.plain
    plain = [chr(c) for r in (range(33, 127), range(0xC0, 0x100)) for c in r]
    texts += [" ".join("".join(rnd.choice(plain) for _ in range(rnd.randint(1, 8))) for _ in range(9)) for _ in range(3000)]
    texts += [" ".join("".join(rnd.choice("ab.,'é!1") for _ in range(rnd.randint(1, 6))) for _ in range(9)) for _ in range(3000)]
    texts += [w + p for w in plain for p in ("", ",", "'s", "a!", "\u0301")]
    for t, got in zip(texts, enc.encode(texts)):
        assert np.frombuffer(got, "<u2").tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_keys_are_a_curve(dims, bits):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = cp.hilbert_keys(grid, bits)
    assert sorted(keys) == list(range(len(grid)))
    path = grid[np.argsort(keys)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_edge_cases(spark):
    rows = [(1, None, "x"), (2, "", "y"), (3, "word " * 9000, "z"), (4, "same text", "a"), (5, "same text", "b"), (6, "\x1c odd\x1dblank", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key string")
    out = cp.pack(docs, PATH)
    from pyspark.sql import functions as F
    check_pieces(out.withColumn("ids_crc32", F.crc32("ids")).collect(), [(d, t) for d, t, _ in rows])
    assert cp.pack(docs.limit(0), PATH).count() == 0
    twice = cp.pack(docs.union(docs), PATH, capacity=64)
    assert twice.agg(F.sum("length")).first()[0] == 2 * out.agg(F.sum("length")).first()[0]
    nulls = spark.createDataFrame([(None, "a b"), (None, None)], "doc_id long, text string")
    assert [r.length for r in cp.pack(nulls, PATH).orderBy("offset").collect()] in ([3, 1], [1, 3])


def test_like_documents_share_sequences(spark):
    rnd = random.Random(3)
    topics = [[f"{a}{b}ing" for b in "bcdfghjklm" for _ in (0,)] for a in ("ka", "zo", "mi", "pu")]
    rows = [(i, " ".join(rnd.choice(topics[i % 4]) for _ in range(60))) for i in range(200)]
    out = cp.pack(spark.createDataFrame(rows, "doc_id long, text string"), PATH, capacity=1024).collect()
    mixed = {}
    for p in out:
        mixed.setdefault(p.sequence_id, set()).add(p.doc_id % 4)
    assert sum(map(len, mixed.values())) / len(mixed) < 2.5      # dealt at random, all four topics would meet in each
