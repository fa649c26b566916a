import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as pb

from riskspark.llm import registry
from riskspark.llm import sentence_pieces as sp

PATH = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


def ids_of(model, text):
    return np.frombuffer(model.encode([text])[0], "<i4").tolist()


def written(folder, pieces, fallback, name):
    """A hand-made merge-type model: (piece, score, kind)."""
    proto = pb.ModelProto()
    proto.trainer_spec.model_type, proto.trainer_spec.byte_fallback = 2, fallback
    proto.normalizer_spec.name, proto.normalizer_spec.add_dummy_prefix = "identity", True
    proto.normalizer_spec.remove_extra_whitespaces, proto.normalizer_spec.escape_whitespaces = False, True
    proto.denormalizer_spec.SetInParent()
    all_pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    all_pieces += [(f"<0x{b:02X}>", 0.0, 6) for b in range(256)] if fallback else []
    for piece, score, kind in all_pieces + pieces:
        proto.pieces.add(piece=piece, score=score, type=kind)
    path = f"{folder}/{name}.model"
    with open(path, "wb") as f:
        f.write(proto.SerializeToString())
    return path


def test_query_equals_the_library(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PATH)
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in registry.QUERIES["op13_sentence_pieces"](spark, SF).collect()}
    assert len(got) == len(rows)
    for r in rows:
        ids, g = library.encode(r.text or ""), got[r.doc_id]
        assert (g.n_tokens, g.ids_sha256, g.decoded_sha256, g.agrees) == (
            len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)), True)


def test_odd_texts_and_any_ids():
    m, rnd = sp.PieceModel(PATH), random.Random(3)
    assert m.apart
    texts = ["", " ", "  a  b", "\n\n", "x́가😀", "▁▁ ▁a", "a" * 700, "<s> </s> <0x41>", "\x00\x1c",
             *("".join(rnd.choice("abe th\n▁éß가😀0.,<s>") for _ in range(rnd.randint(1, 60))) for _ in range(2000))]
    want = m.library.encode(texts)
    assert [ids_of(m, t) for t in texts] == want
    assert [np.frombuffer(x, "<i4").tolist() for x in sp.PieceModel(PATH).encode(texts)] == want
    heap = [np.frombuffer(m._merged(m.prefix + t.replace(" ", "▁")) if t else b"", "<i4").tolist() for t in texts]
    assert heap == want
    lists = [[rnd.choice([rnd.randrange(32000), rnd.randrange(3, 259), 0, 1, 2, 29871, 259]) for _ in range(rnd.randint(0, 12))] for _ in range(2000)]
    assert [m.decode(x) for x in lists] == m.library.decode(lists)
    long_run = [rnd.randrange(3, 259) for _ in range(2000)]
    assert m.decode(long_run) == m.library.decode(long_run)


def test_words_end_where_no_piece_goes_on():
    m = sp.PieceModel(PATH)
    texts = ["the.\nAnd (so) on\n\n", "the, and-so...  on", "  даthe\tx 数据1 a"]
    assert [np.frombuffer(x, "<i4").tolist() for x in m.encode(texts)] == m.library.encode(texts)
    assert {f"{sp.MARK}the", "\n", "And", "...", f"{sp.MARK}(", "so"} <= set(m.words)
    assert not any("the" in w and w.strip(sp.MARK) != "the" for w in m.words)


def test_many_texts_decode_as_the_library_does():
    m, rng = sp.PieceModel(PATH), random.Random(5)
    lists = [[], [1], [1, 300], [m.unknown, 500], m.library.encode("  two spaces \n é"), [m.kinds.index(sp.BYTE) + 200, 400]]
    lists += [[rng.randrange(len(m.kinds)) for _ in range(rng.randrange(12))] for _ in range(400)]
    expected = m.library.decode(lists)
    assert m.decode_all([np.array(x, "<i4").tobytes() for x in lists]) == expected == [m.decode(x) for x in lists]
    assert m.decode_all([]) == [] and m.decode_all([b""]) == [""]


@pytest.mark.parametrize("fallback", [True, False])
def test_small_vocabularies_with_ties_unused_and_user_defined(fallback, tmp_path):
    rnd, split = random.Random(9), 0
    for trial in range(160):
        kinds = [1] if trial % 4 else [1, 1, 1, 1, 5] + [4] * (trial % 3 == 0)
        found = {"".join(rnd.choice("abc") for _ in range(rnd.randint(2, 5))) for _ in range(14)} | {"▁a", "▁ab"[:trial % 3 + 1], "b▁c"[:1 + 2 * (trial % 5 == 0)]} - {"b", "▁"}
        pieces = [(p, float(-rnd.randint(1, 4)), rnd.choice(kinds)) for p in sorted(found)] + [(c, -9.0, 1) for c in "ab▁"]
        if any(kind == 4 and "▁" in p for p, _, kind in pieces):
            continue
        path = written(tmp_path, pieces, fallback, f"m{fallback}{trial}")
        m = sp.PieceModel(path)
        texts = ["".join(rnd.choice("aabbc é") for _ in range(rnd.randint(1, 18))) for _ in range(40)]
        assert [np.frombuffer(x, "<i4").tolist() for x in m.encode(texts)] == m.library.encode(texts), (trial, pieces)
        split += m.apart
    assert split > 20 or not fallback


def test_other_models_are_refused(tmp_path):
    path = written(tmp_path, [("a", -1.0, 1)], True, "other")
    proto = pb.ModelProto.FromString(open(path, "rb").read())
    proto.trainer_spec.model_type = 1
    with open(path, "wb") as f:
        f.write(proto.SerializeToString())
    with pytest.raises(ValueError):
        sp.PieceModel(path)


def test_edge_cases(spark):
    rows = [(1, None, 5), (2, "", 6), (2, "", 6), (3, "to the " * 50_000, 7), (None, "x" * 300_000, None), (4, "ab퟿", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    out = sp.encode(docs, PATH)
    got = out.collect()
    assert sorted(len(r.ids) for r in got if r.row.doc_id in (1, 2)) == [0, 0, 0]
    assert all(r.agrees for r in got) and {r.row["ids"] for r in got if r.row.doc_id == 3} == {7}
    back = sp.decode(out.select("row.doc_id", "ids"), PATH).select("row.doc_id", "text", "agrees").collect()
    assert all(r.agrees for r in back)
    assert {r.doc_id: r.text for r in back} == {1: "", 2: "", 3: rows[3][1], None: rows[4][1], 4: rows[5][1]}
    assert sp.decode(out.select(F.lit(None).cast("array<int>").alias("ids")), PATH, check=False).select("text", "agrees").distinct().collect() == [("", None)]
    assert sp.encode(docs.limit(0), PATH).count() == 0
    assert sp.encode(docs.select("text"), PATH).count() == len(rows)
