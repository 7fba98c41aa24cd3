"""Every query with SQL against DuckDB on the smallest tables."""

import glob
import hashlib
import itertools
import os

import duckdb
import pytest

from folioscope.functions import minhash
from folioscope.plans import catalogue

DATA = "/root/testdata/sf0.001"
QUERIES, ORACLES = catalogue.queries(), catalogue.oracle_sql()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def normal(columns: list[str], rows) -> list:
    def cell(x):
        return "NULL" if x is None else repr(round(x, 6)) if isinstance(x, float) else str(x)

    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    got = QUERIES[name](spark, DATA)
    rows = got.collect()
    assert len(got.columns)
    if name in ORACLES:
        expected = sql.execute(ORACLES[name])
        names = [d[0] for d in expected.description]
        assert sorted(got.columns) == sorted(names)
        assert normal(got.columns, rows) == normal(names, expected.fetchall())


def test_records_become_text_once_per_article(spark, capsys):
    """lists are joined below the explosion into categories."""
    QUERIES["q05b_category_article_records"](spark, DATA).explain()
    plan = capsys.readouterr().out
    assert 0 <= plan.index("Generate explode(category") < plan.index("array_join(")


def test_minhash_pairs_are_those_of_a_hundred_hashes(spark):
    """q21c against all pairs, with signatures computed in plain Python."""
    spelling = {0: str.upper, 1: lambda v: v + " x"}
    parts = spark.read.parquet(f"{DATA}/part.parquet").select("p_partkey", "p_brand", "p_name").collect()
    values = {(r.p_brand, spelling.get(r.p_partkey % 5, str)(r.p_name)) for r in parts}

    def signature(value):
        xs = [int(hashlib.md5(value[i : i + 3].encode()).hexdigest()[:8], 16) % minhash.PRIME for i in range(len(value) - 2)]
        return [min((x * a + b) % minhash.PRIME for x in xs) for a, b in minhash.coefficients(100)]

    signed = {v: signature(v[1]) for v in values}
    expected = set()
    for a, b in itertools.product(values, values):
        if a[0] == b[0] and a[1] < b[1] and (same := sum(x == y for x, y in zip(signed[a], signed[b]))) > 50:
            expected.add((a[0], a[1], b[1], same))
    got = {(r.category, r.v1, r.v2, round(100 * r.similarity)) for r in QUERIES["q21c_minhash_pairs"](spark, DATA).collect()}
    assert expected and got == expected


def test_texts_that_differ_behind_their_opening_are_different(spark, tmp_path):
    opening = "The same opening of sixty characters and more, word for word " * 2
    docs = [(1, opening + "Ends SO.", "src1"), (2, opening + "Ends otherwise.", "src2"), (3, opening + "ends so", "src3"), (4, opening + "left", "src10"), (5, "...", "src2"), (6, opening + "none", None)]
    spark.createDataFrame(docs, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    whole = {i: "".join(c for c in t.lower() if c.isalnum()) for i, t, _ in docs}
    assert {r.doc_id: r.title for r in QUERIES["q23b_regularise_whole"](spark, str(tmp_path)).collect()} == whole
    got = {r.title: r.side for r in QUERIES["q24b_compare_sources"](spark, str(tmp_path)).collect()}
    assert got == {whole[1]: "both", whole[2]: "right", whole[4]: "left", whole[6]: "right"}
    assert {r.doc_id: r.title for r in QUERIES["q23_regularise"](spark, str(tmp_path)).collect()} == whole
    assert QUERIES["q26b_recall_sources"](spark, str(tmp_path)).first()[:3] == (1, 1, 2)


def test_candidates_markdown_and_ascii_of_small_tables(spark, tmp_path):
    """q42, q44, q62 and q75, which SQL can't express, against tables worked out by hand."""
    pages = [
        (1, '<meta name="description" content="D"><p>An abstract.</p><article>A</article>', "D\nAn abstract.\nA", "An abstract."),
        (2, "<jats:sec><jats:title>Aim</jats:title><jats:p>P <i>q</i></jats:p></jats:sec>", "", "## Aim:\nP q"),
        (3, None, "", None),
        (4, "", "", None),
    ]
    spark.createDataFrame([p[:2] for p in pages], "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert {r.page_id: r.candidates for r in QUERIES["q42_meta_candidates"](spark, str(tmp_path)).collect()} == {p[0]: p[2] for p in pages}
    assert {r.page_id: r.markdown for r in QUERIES["q44_jats_markdown"](spark, str(tmp_path)).collect()} == {p[0]: p[3] for p in pages}
    records = {r.page_id: (r.page_content, r.extra_context) for r in QUERIES["q75_page_records"](spark, str(tmp_path)).collect()}
    assert records[1] == ("D\n\nAn abstract.\n\nA", '{"description":"D"}') and records[3] == ("", '{"title":""}')
    texts = [(1, "Naïve Åse, São Tomé"), (2, None), (3, ""), (4, "Жук — ß")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert {r.doc_id: r.folded for r in QUERIES["q62_ascii_fold"](spark, str(tmp_path)).collect()} == {1: "Naive Ase, Sao Tome", 2: None, 3: "", 4: "Zhuk -- ss"}


def test_refused_choices_are_asked_for_again(spark, tmp_path):
    texts = [(1, "the river"), (2, "is it"), (3, "zebra der die"), (4, None)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in QUERIES["q51_validate_retry"](spark, str(tmp_path)).collect()}
    assert got[1].error is None and got[1].low == "the and of" and got[3].error is None
    assert got[2].error == "no valid top label below None" and got[4].error == "no text"


def test_recall_of_signature_pairs(spark):
    """Exact pairs with a similarity of 0.6 or more, of which signatures find nine in ten at least."""
    exact = {(r.category, r.v1, r.v2) for r in QUERIES["q19_exact_jaccard_pairs"](spark, DATA).collect() if r.similarity >= 0.6}
    found = {(r.category, r.v1, r.v2) for r in QUERIES["q21c_minhash_pairs"](spark, DATA).collect()}
    assert exact and len(exact & found) >= 0.9 * len(exact)


@pytest.mark.parametrize("name", ["q18_signature_similarity", "q18b_signature_similarity_full"])
def test_neighbours_meet_without_a_broadcast_of_signatures(spark, name):
    plan = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan and "ArrowEvalPython" not in plan[plan.index("SortMergeJoin") :]
