"""Manifest, phrases and MinHash against plain versions, and faults that earlier rounds had."""

import hashlib
import random
import re
import struct
import time
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from folioscope.llm import jaccard, manifest, media, near, phrases, registry, secrets, stars, toxicity
from folioscope.llm.common import Scratch
from tests.llm.test_kernels import prose
from tests.llm.test_operators import SCHEMA, rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(seed=5, n=60), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in row))


def plain_tree(leaves, fanout):
    """The root, and of every leaf its (before, after) siblings."""
    level, proofs, place = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        for i, p in enumerate(place):
            run = p // fanout * fanout
            proofs[i].append(("".join(level[run:p]), "".join(level[p + 1 : run + fanout])))
        level, place = [h("".join(level[i : i + fanout])) for i in range(0, len(level), fanout)], [p // fanout for p in place]
    return level[0], proofs


@pytest.mark.parametrize("fanout", [2, 3, 5])
def test_manifest(docs, empty, fanout):
    table = [(r.doc_id, r.source, r.lang, r.n_chars, r.text) for r in docs.collect()]
    by_source = {}
    for r in table:
        by_source.setdefault(r[1], []).append((r[0] is not None, r[0] or 0, leaf(r)))
    order = sorted(by_source, key=lambda s: b"" if s is None else b"s" + s.encode())
    trees = {s: plain_tree([x[2] for x in sorted(by_source[s])], fanout) for s in order}
    root, above = plain_tree([trees[s][0] for s in order], fanout)
    expected = Counter()
    for s, top in zip(order, above):
        for (_, _, own), proof in zip(sorted(by_source[s]), trees[s][1]):
            expected[own, trees[s][0], root, h("".join(a + b for a, b in [*proof, *top]))] += 1
    found = manifest.checked(manifest.merkle_manifest(docs, fanout=fanout), "leaf")
    got = found.select("leaf", "subroot", "root", manifest.proof_hash(found["proof"]).alias("p"), "verified").collect()
    assert Counter((r.leaf, r.subroot, r.root, r.p) for r in got) == expected and all(r.verified for r in got)
    assert manifest.merkle_manifest(empty).count() == 0


def test_manifest_finds_changed_rows(spark, tmp_path):
    lines = [(i, f"a\nb {i}" if i % 3 else f"c {i}", "xx", "s", 1) for i in range(30)] + [(30, None, None, None, None), (-7, "x\n", "xx", "t", 2)]
    spark.createDataFrame(lines, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in registry.queries()["op11_manifest"](spark, str(tmp_path)).collect()}
    for d, text, *_ in lines:
        changed = zlib.crc32(str(d).encode()) % 2 == 0 and "\n" in (text or "")
        assert got[d].verified != changed and (got[d].folded_root == got[d].root) == got[d].verified
    assert {r.verified for r in got.values()} == {True, False} and len({r.root for r in got.values()}) == 1


def test_one_row_is_leaf_and_root(spark):
    one = manifest.merkle_manifest(spark.createDataFrame([(1, "t", "xx", None, 1)], SCHEMA)).first()
    assert one.leaf == one.subroot == one.root == leaf((1, None, "xx", 1, "t")) and one.proof == []


def plain_phrases(table, least=4, top=40):
    words, f, n = {}, {}, Counter()
    for lang, text in table:
        lang = lang or "und"
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for m in range(1, 5):
                for i in range(len(ws) - m + 1):
                    f[lang, tuple(ws[i : i + m])] = f.get((lang, tuple(ws[i : i + m])), 0) + 1
    out = []
    cands = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    for (lang, g), a in cands.items():
        if any(l == lang and len(y) > len(g) and 100 * b >= 80 * a and any(y[i : i + len(g)] == g for i in range(len(y))) for (l, y), b in cands.items()):
            continue
        cuts = [(2_000_000 * a // (f[lang, g[:k]] + f[lang, g[k:]]), k) for k in range(1, len(g))]
        score, k = min(cuts)
        out.append((lang, " ".join(g), a, f[lang, g[:k]], f[lang, g[k:]], n[lang], score))
    ranked = []
    for lang in {o[0] for o in out}:
        best = sorted((o for o in out if o[0] == lang), key=lambda o: (-o[6], -o[2], o[1].encode()))[:top]
        ranked += [(o[0], i + 1, *o[1:]) for i, o in enumerate(best)]
    return sorted(ranked)


@pytest.mark.parametrize("share", [1 << 19, 5])
def test_phrases(spark, empty, monkeypatch, share):
    rng = random.Random(4)
    texts = [("xx" if i % 3 else None, prose(rng, rng.randrange(1, 60)).replace(" gamma", rng.choice([" Gamma,", "\n gamma", "\tgamma"]))) for i in range(80)]
    texts += [("xx", "the the the the THE. the the the"), ("yy", None), ("yy", ""), ("yy", " .,; "), ("xx", "é à é à é à"), *[("zz", "one two")] * 7]
    monkeypatch.setattr(phrases, "SHARE", share)
    monkeypatch.setattr(phrases, "BATCH_TEXT", 300)
    monkeypatch.setattr(phrases, "HELD_TEXT", 500)
    df = spark.createDataFrame([(t, lang, 1) for lang, t in texts], "text string, lang string, rank long").repartition(3)
    got = sorted(tuple(r) for r in phrases.collocations(df, least=4, top=40).collect())
    assert got == plain_phrases(texts) and len(got) > 30
    assert phrases.collocations(empty).count() == 0


def test_fragments_hold_every_gram_once():
    rng = np.random.default_rng(3)
    for n in (0, 1, 5, 400):
        ranks = rng.integers(0, 6, n).astype(np.int32)
        found = Counter()
        for grams, counts in phrases.mine(*phrases.distinct_rows(phrases.fragments(ranks, 3), np.ones(len(phrases.fragments(ranks, 3)), np.int64)), 4, 1):
            found.update({tuple(g): c for g, c in zip(grams.tolist(), counts.tolist())})
        plain = Counter(tuple(w) for m in (2, 3, 4) for i in range(n - m + 1) if min(w := ranks[i : i + m].tolist()) > 0)
        assert found == plain


def test_near_duplicates(spark, empty, docs, monkeypatch):
    """A chain of texts that drift apart, copies, and a passage that many texts share, against SQL."""
    rng = random.Random(6)
    base = prose(rng, 150).split()
    table = []
    for i in range(40):
        base[rng.randrange(len(base))] = f"w{i}"
        table.append((i, " ".join(base)))
    passage = prose(rng, 40)
    table += [(100 + i, passage + " " + " ".join(f"u{i}x{j}" for j in range(rng.randrange(5, 40)))) for i in range(30)]
    table += [(200, table[3][1]), (201, None), (202, ""), (203, "two words"), (204, "Two  words"), (205, table[9][1].upper())]
    expected = duckdb.connect()
    expected.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    expected.executemany("INSERT INTO documents VALUES (?, ?)", table)
    want = {r[0]: r[1:] for r in expected.execute(near.OP13_SQL).fetchall()}
    df = spark.createDataFrame(table, "doc_id long, text string").repartition(4)
    for block in (512, 7):
        monkeypatch.setattr(near, "BLOCK", block)
        monkeypatch.setattr(near, "BLOCK_SETS", 600 if block > 7 else 5)
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near.near_duplicates(df).collect()}
        assert got == want
    assert len({r[1] for r in want.values()}) < len(want) - 30
    assert near.near_duplicates(empty).count() == 0
    mixed = near.near_duplicates(docs).collect()
    plain = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs, size=5).collect()}
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in mixed} == plain and len(mixed) == docs.count()
    with pytest.raises(ValueError):
        near.near_duplicates(df, percent=80)


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    pool = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
    for n in (1, 63, 128, 1000):
        a, b = pool[:n], pool[: max(1, n * 9 // 10)]
        share = (near.signature(a) == near.signature(b)).mean()
        assert abs(share - len(b) / len(a)) < 0.1
        assert (near.signature(a) == near.signature(rng.permutation(a))).all()


def test_stars(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(200)] + [(5000, 5000)] + [(rng.randrange(6000, 6100), rng.randrange(6000, 6100)) for _ in range(60)]
    parent = {x: x for p in links for x in p}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    scratch = Scratch(spark, "stars")
    got = {r.node: r.component for r in stars.star_components(spark.createDataFrame(links, "u long, v long"), scratch, "c").collect()}
    assert got == {x: find(x) for x in parent}
    assert stars.star_components(spark.createDataFrame([], "u long, v long"), scratch, "d").count() == 0


@pytest.mark.parametrize("size", [8, 4])
def test_media_with_an_unknown_duration(size):
    data = media.write_container(b"x" * 1920)
    at = data.index(b"mdhd") + 4
    assert data[at] == 1
    if size == 8:
        known, broken = at + 4 + 8 + 8 + 4, b"\xff" * 8
        changed = data[:known] + broken + data[known + 8 :]
        found = media._probe(changed)
        assert found["error"] is None and found["tracks"][0]["duration"] == media._probe(data)["tracks"][0]["duration"]
        odd = media._probe(data[:known] + struct.pack(">Q", (1 << 64) - 2) + data[known + 8 :])
        assert odd["tracks"] is None and odd["error"]
    else:
        assert media.UNKNOWN_32 == 0xFFFFFFFF


def test_sensitive_names_count_without_other_words():
    text = 'private_signing_cert = "Xk29vLq8Zt4Bw7Rm"'
    assert secrets.lexed_spans(text) == [(24, 40)] == secrets.lexed_spans(text + "\nkeyboard") == secrets.lexed_spans("words before\n" + text)[:0] + [(24, 40)]
    assert secrets.lexed_spans('client_access_private = "Xk29vLq8Zt4Bw7Rm"') != []


@pytest.mark.parametrize("line", ["password = <<EOF{i}\n", 'password = "a{i}" +\n', 'password = """x\n', "key: |\n", "secret = [{i},\n", "token = a{i} \\\n"])
def test_scan_is_linear(line):
    def cost(n):
        text = "".join(line.replace("{i}", str(i)) for i in range(n))
        began = time.process_time()
        secrets.lexed_spans(text)
        return time.process_time() - began

    cost(500)
    assert cost(16_000) < 8 * cost(4_000) + 0.2


def test_counted_votes_are_the_rows_themselves():
    rng = np.random.default_rng(4)
    votes = (rng.random((400, 4)) < 0.3).astype(float)
    gold = np.where(rng.random(400) < 0.5, np.nan, rng.integers(0, 2, 400).astype(float))
    rows = np.column_stack([votes, np.nan_to_num(gold, nan=-1)])
    kinds, counts = np.unique(rows, axis=0, return_counts=True)
    few, labels = kinds[:, :4], np.where(kinds[:, 4] < 0, np.nan, kinds[:, 4])
    whole = toxicity.estimate(lambda m: toxicity.class_masses(votes, gold, np.ones(400), 0.3, m))
    counted = toxicity.estimate(lambda m: toxicity.class_masses(few, labels, counts.astype(float), 0.3, m))
    assert (whole[0] == counted[0]).all() and all(np.allclose(a, b) for i in (1, 2) for a, b in zip(whole[i], counted[i]))
    x, target, w = rng.random((400, 4)), rng.random(400), rng.random(5)
    plain = sum((1 / (1 + np.exp(-(w[:4] @ r + w[4]))) - t) * np.append(r, 1) for r, t in zip(x, target))
    assert np.allclose(toxicity.slopes(x, target, np.ones(400), w)[:5], plain)


def test_every_row_without_a_label_takes_part(spark, monkeypatch):
    """All rows outside the sample are in the fit, in total as heavy as the sample."""
    monkeypatch.setattr(toxicity, "SAMPLE", 100)
    texts = [f"you are a rotten{'est' * (i % 2)} knave number{i % 7}" if i % 3 == 0 else f"a calm remark about subject{i % 11}" for i in range(600)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (7, "again"), (8, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(200)], "doc_id long, toxic int")
    seen, sums, summed = [], [], toxicity._summed
    monkeypatch.setattr(toxicity, "fit_logistic", lambda measure, size: seen.append(measure(np.zeros(size))) or np.zeros(size))
    monkeypatch.setattr(toxicity, "_summed", lambda df, work: sums.append([df.agg(F.sum("n")).first()[0], df.where("toxic IS NOT NULL").agg(F.sum("n")).first()[0]]) or summed(df, work))
    toxicity.fit(docs, labels)
    total, labelled = sums[-1]
    assert total == 603 and labelled in (100, 101, 102) and abs(seen[-1][-1] - 2 * labelled) < 1e-6
