"""Unknown pre-tokens of a batch go through their segment trees together."""

import base64
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioscope.llm import bpe, registry


@pytest.fixture(scope="module")
def known():
    return bpe.Vocabulary(*bpe.default_files())


def one_by_one(pieces, ranks):
    return [np.array(bpe.merge_piece(p, ranks), "<u4").tobytes() for p in pieces]


def words(seed, n, letters="etaoinsrhldcumfpgwybvk", most=14):
    rng = random.Random(seed)
    return list(dict.fromkeys("".join(rng.choices(letters, k=rng.randrange(2, most))) for _ in range(n)))


def test_few_unknown_pieces_are_merged_one_by_one(monkeypatch):
    calls = []
    monkeypatch.setattr(bpe, "merge_piece", lambda piece, ranks, f=bpe.merge_piece: calls.append(piece) or f(piece, ranks))
    v = bpe.Vocabulary(*bpe.default_files())
    texts = [" ".join(words(k, 500)) for k in range(8)]
    coded = [v.encode(t) for t in texts]
    assert [v.decode(c) for c in coded] == [t.encode() for t in texts]
    assert len(calls) < 200


def test_trees_of_many_pieces_equal_single_ones(known):
    rng = random.Random(7)
    pieces = [w.encode() for w in words(1, 3000)] + [w.encode() for w in words(2, 300, "ab", 90)] + [w.encode() for w in words(3, 300, "aé中😀 ", 50)]
    pieces += [bytes(rng.choices(range(256), k=n)) for n in [*range(1, 70), 127, 128, 129] for _ in range(20)] + [b"a" * n for n in range(1, 300)]
    assert known.merge_all(pieces) == one_by_one(pieces, known.ranks)
    unknown = [p for p in pieces if p not in known.ranks and len(p) <= 64]
    assert known.merges.merge(unknown, 64) == one_by_one(unknown, known.ranks)
    assert known.merge_all([]) == []


def test_a_text_is_encoded_once(spark):
    plan = registry.queries()["op5_bpe"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert len(set(re.findall(r"pythonUDF\d+#", plan))) == 1
    docs = spark.createDataFrame([("a b  don't",), (None,), ("",), ("Größe",)], "text string")
    coded = docs.select("text", bpe.encode_decoded(F.col("text"), *bpe.default_files()).alias("c"), bpe.encode(F.col("text"), *bpe.default_files()).alias("ids"))
    for r in coded.collect():
        assert (r.c.ids, r.c.decoded) == (r.ids, (r.text or "").encode())


def vocabulary(tmp_path, names):
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(name) + b" %d\n" % rank for name, rank in names))
    return bpe.Vocabulary(str(path), r"\S+|\s+", 50)


def test_any_vocabulary(tmp_path):
    # gaps between ranks, single letters after pairs, a token that no two others form, no token for the byte c, which always finds a b
    names = [(b"ab", 3), (b"ba", 7), (b"aa", 8), (b"bc", 1), (b"abab", 21), (b"b", 40), (b"a", 90), (b"bcab", 91), (b"aaa", 92), (b"babbab", 2)]
    v = vocabulary(tmp_path, names)
    pieces = [w.encode() for w in words(5, 400, "ab", 20)]
    assert v.merge_all(pieces) == one_by_one(pieces, v.ranks)
    with_c = [p[:k] + b"bc" + p[k:] for k, p in enumerate(pieces[:200])]
    assert v.merge_all(with_c) == one_by_one(with_c, v.ranks)
    with pytest.raises(KeyError):
        v.merge_all([b"ac" + p for p in pieces])


def test_remembered_pieces_are_bounded_and_come_back(tmp_path, monkeypatch):
    monkeypatch.setattr(bpe, "GROUP", 20)
    v = vocabulary(tmp_path, [(bytes([b]), b) for b in range(256)] + [(b"ab", 256), (b"ba", 257)])
    texts = ["", None, "a" * 100, *(" ".join(words(k, 9, "ab", 12)) for k in range(60)), "b" * 200, ""]
    for got in (v.encode_all(texts), v.encode_all(texts[::-1])[::-1]):
        for text, ids in zip(texts, got):
            assert ids == b"".join(one_by_one([p.encode() for p in v.split(text or "")], v.ranks))
        assert len(v.younger) <= 50 and len(v.older) <= 50
        assert all(len(p) <= bpe.REMEMBERED_CHARS for p in [*v.younger, *v.older])
    assert v.encode_all([]) == []
