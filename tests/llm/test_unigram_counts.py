import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer, models

from riskspark.llm import registry
from riskspark.llm import unigram_counts as uc

PATH = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


def library_tokenizer(vocabulary, unk="<unk>"):
    """The tokenizers library's own unigram model over the same pieces."""
    pieces = [(unk, 0.0), *vocabulary.pieces]
    if vocabulary.byte_fallback:
        pieces += [(f"<0x{b:02X}>", min(s for _, s in vocabulary.pieces)) for b in range(256)]
    return Tokenizer(models.Unigram([(p, float(s)) for p, s in pieces], unk_id=0, byte_fallback=vocabulary.byte_fallback))


def lengths(tok, texts):
    return [len(tok.encode(uc.MARK + t.replace(" ", uc.MARK), add_special_tokens=False).ids) if t else 0 for t in texts]


def test_counts_equal_the_library_on_documents(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r.n_tokens for r in registry.QUERIES["op7_unigram_counts"](spark, SF).collect()}
    want = lengths(library_tokenizer(uc.load_vocabulary(PATH)), [r.text or "" for r in rows])
    assert [got[r.doc_id] for r in rows] == want


def test_odd_texts():
    rnd = random.Random(4)
    vocabulary = uc.load_vocabulary(PATH)
    tok, counter = library_tokenizer(vocabulary), uc.Counter(vocabulary)
    assert counter.apart
    texts = ["", " ", "  a  b", "\n\n", "x́가😀", "▁▁ ▁a", "a" * 500,
             *("".join(rnd.choice("abe th\n▁éß가😀0.,") for _ in range(rnd.randint(1, 60))) for _ in range(1500))]
    assert [counter.count(t)[0] for t in texts] == lengths(tok, texts)


@pytest.mark.parametrize("byte_fallback", [True, False])
def test_ties_and_unknown_runs_in_small_vocabularies(byte_fallback):
    rnd = random.Random(6)
    for trial in range(150):
        pieces = {"".join(rnd.choice("ab▁") for _ in range(rnd.randint(1, 4))) for _ in range(8)} | {uc.MARK} - {""}
        vocabulary = uc.Vocabulary(tuple((p, float(-rnd.randint(1, 4))) for p in sorted(pieces)), byte_fallback)
        tok, counter = library_tokenizer(vocabulary), uc.Counter(vocabulary)
        texts = ["".join(rnd.choice("abcc é") for _ in range(rnd.randint(1, 14))) for _ in range(20)]
        assert [counter.count(t)[0] for t in texts] == lengths(tok, texts), (trial, vocabulary)


def test_whole_text_equals_words_apart():
    counter = uc.Counter(uc.load_vocabulary(PATH))
    rnd = random.Random(5)
    for _ in range(200):
        t = "".join(rnd.choice("abcdefgh the  \n.é") for _ in range(80))
        assert counter.count(t) == counter.best(uc.MARK + t.replace(" ", uc.MARK))


def test_edge_cases(spark):
    rows = [(1, None, 5), (2, "", 6), (2, "", 6), (3, "to the " * 50_000, 7), (None, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = uc.count_tokens(docs, PATH).collect()
    assert sorted(r.n_tokens for r in got if r.row.doc_id in (1, 2)) == [0, 0, 0]
    assert [r.n_tokens for r in got if r.row.doc_id == 3][0] >= 100_000
    assert uc.count_tokens(docs.limit(0), PATH).count() == 0
