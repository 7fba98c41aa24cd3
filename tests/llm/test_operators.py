"""Operators on small tables with nulls, empty and repeated rows, and clashing names."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from folioscope.llm import bpe, components, decontamination, jaccard, language, media, pii, repeats, secrets, sharding, toxicity
from folioscope.llm.common import Scratch
from tests.llm.test_kernels import brute_windows, prose

KEY = b"a key of these tests"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows(seed=1, n=40):
    rng = random.Random(seed)
    texts = [prose(rng, rng.randrange(1, 90)) for _ in range(n)]
    passage = prose(rng, 30)
    for i in range(0, n, 4):
        texts[i] = f"{texts[i]} {passage} {texts[i + 1]}"
    texts[5], texts[9] = texts[3], texts[3]
    texts[11] = texts[10] + " omega"
    out = [(i, t, "xx", "s", len(t)) for i, t in enumerate(texts)]
    return [*out, (n, None, None, None, None), (n + 1, "", "xx", None, 0), (n + 2, "\n \t", "yy", "s", 3), (n + 3, prose(rng, 12000), "xx", "s", 1), (7, texts[7], "xx", "s", 1), (None, "lost id " + passage, "xx", "s", 1)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_media(docs, empty):
    stored = docs.select("doc_id", "text", media.store_samples(F.col("text")).alias("media"))
    got = media.media_columns(stored, "media", "i").collect()
    for r in got:
        raw = (r.text or "").encode()
        padded = raw + b" " * (max(192, -(-len(raw) // 192) * 192) - len(raw))
        assert r.i.error is None and r.i.tracks[0].payload_sha256 == hashlib.sha256(padded).hexdigest() and r.i.tracks[0].payload_bytes == len(padded)
    nothing = docs.select(F.lit(None).cast("binary").alias("media"))
    assert media.media_columns(nothing, "media").where("media_info IS NOT NULL").count() == 0
    assert media.media_columns(empty.select(F.col("text").cast("binary").alias("media")), "media").count() == 0


def test_pii(docs, empty, spark):
    df = spark.createDataFrame([(1, "card 4539148803436467", "x"), (2, "4539148803436467 twice", "y"), (3, None, "z")], "doc_id long, text string, extra string")
    got = {r.doc_id: r for r in pii.pseudonym_columns(df, KEY).collect()}
    assert got[1].text[5:] == got[2].text[:16] and got[1].n_values == 1 and got[3].text is None and got[1].extra == "x"
    back = pii.restore(pii.pseudonym_columns(df, KEY).select("doc_id", "text"), KEY).where("doc_id = 1").first().text
    assert back == "card 4539148803436467"
    assert pii.pseudonym_columns(empty, KEY).count() == 0 and pii.pseudonym_columns(docs, KEY).count() == docs.count()
    clash = pii.pseudonym_columns(docs.withColumn("Spans", F.lit(1)).withColumn("pii_found", F.lit(2)), KEY)
    assert clash.schema["spans"].dataType.simpleString() == "string" and clash.count() == docs.count()


def test_decontamination(docs, empty, spark, monkeypatch):
    rng = random.Random(9)
    some = [r[1] for r in rows() if r[1] and 20 < len(r[1].split()) < 200]
    items = [(i, " ".join(t.split()[2:25])) for i, t in enumerate(some[:6])] + [(90, "zz yy"), (91, None), (92, ""), (93, prose(rng, 40))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    plain = [(str(i), decontamination.words_of(t)) for i, t in items]
    for block in (40_000, 20):  # one automaton, then many
        monkeypatch.setattr(decontamination, "BLOCK_WORDS", block)
        for r in decontamination.find_contamination(docs, bench).collect():
            hit, found = brute_windows(decontamination.words_of(r.text), plain)
            assert {i for s in r.spans or () for i in range(s.start, s.end)} == hit and set(r["items"] or ()) == found
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 40_000)
    assert decontamination.find_contamination(docs, empty.select(F.col("doc_id").alias("item_id"), "text")).where("size(spans) > 0").count() == 0
    assert decontamination.find_contamination(empty, bench).count() == 0
    clean = decontamination.decontaminate(docs, bench)
    assert clean.columns == docs.columns and clean.count() < docs.count()


def test_benchmark_items_without_an_id_and_repeated_ones(docs, spark, monkeypatch):
    some = [r[1] for r in rows() if r[1] and 20 < len(r[1].split()) < 200]
    items = [(None, " ".join(some[0].split()[2:25])), (None, "zz yy"), (1, " ".join(some[1].split()[2:25])), *[(2, " ".join(some[2].split()[:30]))] * 200]
    bench = spark.createDataFrame(items, "item_id long, text string")
    plain = [(None if i is None else str(i), decontamination.words_of(t)) for i, t in items[:4]]
    assert decontamination._pieces(bench, "item_id", "text", 13).count() == len(plain)
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 100)
    hits = 0
    for r in decontamination.find_contamination(docs, bench).collect():
        hit, found = brute_windows(decontamination.words_of(r.text), plain)
        assert {i for s in r.spans or () for i in range(s.start, s.end)} == hit and set(r["items"] or ()) == found - {None}
        hits += None in found
    assert hits


def test_language(docs, empty, spark):
    data = [(i, ("der die das und nicht " if i % 2 else "the of and is not ") * 5, "de" if i % 2 else "en") for i in range(40)] + [(90, None, "en"), (91, "12", None), (92, "", "de")]
    got = language.identify(spark.createDataFrame(data, "doc_id long, text string, lang string")).collect()
    for r in got:
        assert r.lang_pred == ("und" if r.doc_id >= 90 else "de" if r.doc_id % 2 else "en") and 0 <= r.score <= 1
    assert language.identify(empty).count() == 0
    assert language.identify(docs).count() == docs.count()


def test_bpe(docs, empty):
    path, pattern = bpe.default_files()
    coded = docs.select("text", bpe.encode(F.col("text"), path, pattern).alias("ids"))
    for r in coded.select("text", bpe.decode(F.col("ids"), path, pattern).alias("back")).collect():
        assert bytes(r.back) == (r.text or "").encode()
    assert empty.select(bpe.encode(F.col("text"), path, pattern)).count() == 0


def brute_repeats(data, least):
    first = {}
    for i, t in data:
        for p in range(len(t) - least + 1):
            w = t[p : p + least]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, t in data:
        gone = bytearray(len(t))
        for p in range(len(t) - least + 1):
            if first[t[p : p + least]] < i:
                gone[p : p + least] = b"\1" * least
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((i, len(t), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("block", [2_000_000, 400])
def test_repeats(docs, empty, monkeypatch, block):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", block)
    big = 1 << 62
    data = [(big if r[0] is None else r[0], (r[1] or "").encode()) for r in rows()]
    got = [(big if r.doc_id is None else r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.removed), r.kept_sha256) for r in repeats.remove_repeats(docs).collect()]
    assert sorted(got) == brute_repeats(data, 50)
    if block > 400:
        assert repeats.remove_repeats(empty).count() == 0


def test_secrets(docs, empty, spark):
    df = spark.createDataFrame([(1, 'é token = "abcdef12"', "x"), (2, None, "y")], "doc_id long, text string, extra string")
    got = {r.doc_id: r for r in secrets.find_secrets(df).collect()}
    assert got[1].n_assign == 1 and got[1].base_spans == "assign:2:19" and got[2].spans == "" and got[1].extra == "x"
    assert secrets.find_secrets(empty).count() == 0 and secrets.find_secrets(docs).count() == docs.count()


def test_toxicity(spark, empty, docs):
    rng = random.Random(4)
    data = [(i, prose(rng, 40) + (" vile rotten" if i % 5 == 0 else "") + f" w{i % 17}") for i in range(600)] + [(1000, None), (1001, "")]
    labels = [(i, 1 if i % 5 == 0 else 0) for i in range(0, 600, 2)] + [(1, None), (2, 0)]
    df, marks = spark.createDataFrame(data, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    scored = toxicity.score_toxicity(df, toxicity.fit(df, marks)).toPandas()
    assert ((scored.score >= 0.5) == (scored.doc_id.lt(600) & (scored.doc_id % 5 == 0))).all() and scored.score.between(0, 1).all()
    none = marks.where("toxic > 5")
    assert toxicity.score_toxicity(docs, toxicity.fit(docs, none)).agg(F.max("score")).first()[0] < 1e-6
    assert toxicity.score_toxicity(empty, toxicity.fit(empty, none)).count() == 0


def test_sharding(spark, docs, empty):
    for shards, n in ((24, 1000), (24, 5), (3, 100), (1, 10)):
        got = sharding.shuffle_into_shards(spark.range(n).repartition(5), shards).toPandas()
        sizes = got.groupby("shard").slot.agg(["count", "max"]).reindex(range(shards), fill_value=0)
        assert len(got) == n and got.id.nunique() == n and sizes["count"].max() - sizes["count"].min() <= 1
        assert (sizes["max"] == (sizes["count"] - 1).clip(lower=0)).all()
    assert sharding.shuffle_into_shards(docs).count() == docs.count() and sharding.shuffle_into_shards(empty).count() == 0
    assert sharding.shuffle_into_shards(docs.withColumn("Shard", F.lit(99))).where("shard = 99").count() == 0


def test_matrix_has_the_hypergeometric_mean_and_variance(spark):
    draws = sharding._hypergeometric("total", "marked", "drawn", "(pmod(xxhash64(id), 9007199254740992L) + 0.5D) / 9007199254740992D")
    got = spark.range(4000).selectExpr("id", "1000L AS total", "300L AS marked", "200L AS drawn").selectExpr(f"{draws} AS h").agg(F.avg("h"), F.var_samp("h"), F.min("h"), F.max("h")).first()
    variance = 200 * 0.3 * 0.7 * 800 / 999
    assert abs(got[0] - 60) < 0.5 and abs(got[1] / variance - 1) < 0.1 and got[2] >= 0 and got[3] <= 200


def brute_components(data, percent=85):
    sets = {}
    for i, t in data:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        w = [x for x in "".join("\n" if c in " \t\n\x0b\x0c\r" else c for c in low).split("\n") if x]
        sets[i] = frozenset(tuple(w[k : k + 4]) for k in range(max(1, len(w) - 3))) if w else frozenset()
    group = {i: i for i in sets}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                group[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in sets}


@pytest.mark.parametrize("sets_in_block, held", [(1200, 600_000), (3, 500)])
def test_jaccard(spark, empty, monkeypatch, sets_in_block, held):
    monkeypatch.setattr(jaccard, "BLOCK_SETS", sets_in_block)
    monkeypatch.setattr(jaccard, "HELD", held)  # one batch a task, then many
    rng = random.Random(6)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    data = [(r[0], r[1]) for r in rows()[:-2]]
    for i in range(100, 130):  # a chain of near copies
        at = rng.randrange(120)
        base = [*base[:at], f"n{i}", *base[at + 1 :]]
        data.append((i, " ".join(base)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(spark.createDataFrame(data, "doc_id long, text string").repartition(4)).collect()}
    assert got == brute_components(data)
    if sets_in_block > 3:
        assert jaccard.jaccard_components(empty).count() == 0
        kept = jaccard.keep_one_of_each(spark.createDataFrame([(i, t, i) for i, t in data], "doc_id long, text string, n long"))
        assert {r.doc_id for r in kept.collect()} == {c for _, c in got.values()}


def test_an_n_gram_in_all_documents_and_rows_of_one_id(spark):
    rng = random.Random(3)
    common = "these four words recur"
    data = [(i, f"{common} " + " ".join(f"v{rng.randrange(10**6)}" for _ in range(30))) for i in range(300)]
    data += [(400, data[7][1]), (401, data[7][1] + " more"), (500, data[9][1]), (500, "something else that nobody has")]
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.n_links) for r in jaccard.jaccard_components(df).collect()}
    assert got[(7, 31)] == (7, 1) and got[(400, 31)] == (7, 1) and got[(401, 32)] == (7, 1) and got[(500, 2)] == (500, 0) and got[(8, 31)] == (8, 0)
    kept = sorted((r.doc_id, r.text) for r in jaccard.keep_one_of_each(df).collect())
    assert kept == sorted([*data[:300], (500, "something else that nobody has")])


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (103, 101), (7, 7)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long"), Scratch(spark, "test"), "a").collect()}
    assert all(got[i] == 0 for i in range(61)) and got[103] == got[101] == 100 and 7 in got
    assert components.components(spark.createDataFrame([], "u long, v long"), Scratch(spark, "test"), "b").count() == 0


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    data = [(i, *r[1:]) for i, r in enumerate(rows()) if r[1] is not None]
    extra = [F.lit(i).alias(c) for i, c in enumerate(["score", "lang_pred", "spans", "n_words", "items", "held_out", "n_values", "ids", "document", "set_key", "cell", "row"])]
    spark.createDataFrame(data, SCHEMA).select("*", *extra).write.parquet(f"{tmp_path}/documents.parquet")
    bench = " ".join(data[2][1].split()[:40])
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    texts = {i: t for i, t, *_ in data}
    named = {i: t for i, t in texts.items() if any(c.isalpha() for c in t)}
    unique = {i for i, (_, c) in brute_components(named.items()).items() if i == c}
    plain = [("1", decontamination.words_of(bench))]
    expected = set()
    for i in unique:
        words = decontamination.words_of(texts[i])
        hit, _ = brute_windows(words, plain)
        if not hit or 20 * len(hit) < len(words):
            expected.add(i)
    assert set(out.doc_id) == expected and out.round_trip.all() and (out.n_tokens > 0).all()
    nothing = tmp_path / "nothing"
    spark.createDataFrame([], SCHEMA).write.parquet(f"{nothing}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{nothing}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(nothing)).count() == 0


def test_pipeline_with_nulls_repeats_and_a_long_text(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(8)

    def some(n: int) -> str:
        return " ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(n))

    one, other, passage, long = some(80), some(90), some(60), some(400_000)
    data = [
        (1, one, "en", "s"), (1, one, "en", "s"), (5, one, "en", None), (2, None, "en", "s"), (3, "", "en", "s"), (4, "12 34", "en", "s"),
        (None, other, "en", "s"), (None, None, None, None), (6, some(70), None, None), (7, long, "en", "s"), (8, long + " more", "en", "s"),
        (9, passage, "en", "s"), (10, f"{some(400)} {passage[:100]} card 4539 1488 0343 6467", "en", "s"), *((i, some(30), "en", "s") for i in range(20, 40)),
    ]
    spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in data], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([("b", passage), (None, "zz yy"), ("c", None)], "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id for r in out), key=str) == sorted([1, 1, None, 6, 7, 10, *range(20, 40)], key=str)
    assert all(r.round_trip and r.n_tokens > 0 for r in out) and max(r.n_tokens for r in out) > 400_000


def test_near_copies_of_the_pipeline_share_four_fifths_of_five_word_shingles(spark, tmp_path):
    import corpus_pipeline

    words = [f"w{i}" for i in range(400)]
    texts = {1: " ".join(words), 2: " ".join(words + [f"x{i}" for i in range(86)]), 3: " ".join(words + [f"y{i}" for i in range(110)])}
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t in texts.items())}
    similar = {(i, j): len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for i in sets for j in sets if i < j}
    assert 0.81 < similar[1, 2] < 0.83 and similar[1, 3] < 0.8 and similar[2, 3] < 0.8
    docs = spark.createDataFrame([(i, t, "xx", "s", len(t)) for i, t in texts.items()], SCHEMA)
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, str(tmp_path)).collect()) == [1, 3]


def test_clashing_columns_are_replaced(docs, spark):
    wide = docs.select("*", *[F.lit("x").alias(c) for c in ("score", "lang_pred", "held_out", "spans", "items", "n_words", "n_assign", "secrets_found", "base_spans", "document")])
    bench = spark.createDataFrame([(1, "zz yy")], "item_id long, text string")
    assert language.identify(wide).schema["score"].dataType.simpleString() == "double"
    assert decontamination.decontaminate(wide, bench).columns == wide.columns
    assert secrets.find_secrets(wide).schema["n_assign"].dataType.simpleString() == "bigint"
    for df in (language.identify(wide), decontamination.find_contamination(wide, bench), secrets.find_secrets(wide)):
        assert df.count() == docs.count()
