"""Complete records against plain Python: nulls, several affiliations, repeated rows, empty tables and clashing names."""

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from folioscope.operators import records

SCHEMA = (
    "doi string, title string, tc long, journal string, abstract string, license_url string, date_published_print string, date_published_online string, "
    "download_url string, themes array<string>, author string, affiliation string, top string, mid string, low string"
)


def row(doi, tc, themes, author, affiliation, top, mid, low):
    return (doi, None if doi is None else f"T{doi}", tc, "J", None, "l", "2020-01", None, "d", themes, author, affiliation, top, mid, low)


ROWS = [
    row("1/a", 5, ["x", None, "y"], "Ann", "Math", "A", "B b", "C"),
    row("1/a", 5, ["x", None, "y"], "Ann", "Math", "A", "B b", "C"),
    row("1/a", 5, ["x", None, "y"], "Ann", "Physics", "A", "B b", None),
    row("1/a", 5, ["x", None, "y"], "Bo", None, "A", "A", "C"),
    row("2", 7, None, "Ann", "Math", "A", None, "Z"),
    row("2", 7, None, None, "Math Club", None, None, None),
    row("3", None, [], "Cy", "", "Q", "Q", "Q"),
    row(None, 9, ["x"], "Bo", "Math", "A", None, None),
]


@pytest.fixture(scope="module")
def works(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


def plain(keys):
    """Sets and citations of ``keys(row)``, which yields the keys that a row counts under."""
    sets, cited = defaultdict(set), defaultdict(dict)
    for r in ROWS:
        doi, title, tc, journal, *_, themes, author, affiliation, top, mid, low = r
        for key in keys(author, top, mid, low):
            kinds = {"titles": [title], "dois": [doi], "journals": [journal], "faculty": [author], "affiliations": [affiliation], "themes": themes or [], "categories": [top, mid, low]}
            for kind, items in kinds.items():
                sets[key, kind] |= {x for x in items if x is not None}
            if doi is not None:
                cited[key][doi] = tc
    return sets, cited


def test_author_records_and_sets(works):
    sets, cited = plain(lambda author, *_: [author] if author else [])
    got = defaultdict(set)
    for r in records.author_sets(works).collect():
        assert r.item not in got[r.author, r.kind]
        got[r.author, r.kind].add(r.item)
    for author in ("Ann", "Bo", "Cy"):
        for kind in ("titles", "dois", "journals", "themes", "categories"):
            assert got[author, kind] == sets[author, kind]
        assert got[author, "department_affiliations"] == sets[author, "affiliations"]
    assert got["Ann", "mid_category_urls"] == {"B%20b"} and got["Ann", "low_level_categories"] == {"C", "Z"} and got["Bo", "top_level_categories"] == {"A"}
    for r in records.author_records(works).collect():
        known = [tc for tc in cited[r.author].values() if tc is not None]
        assert (r.total_citations, r.article_count) == (sum(known) if known else None, len(cited[r.author]))
        assert r.themes_count == len(sets[r.author, "themes"]) and r.categories_count == len(sets[r.author, "categories"])
        assert r.average_citations == (round(sum(known) / len(cited[r.author]), 6) if known else None)


def test_category_records_at_each_level(works):
    for at, level in enumerate(("top", "mid", "low")):
        sets, cited = plain(lambda author, *labels, at=at: [labels[at]] if labels[at] is not None else [])
        got = {r.category: r for r in records.category_records(works).where(F.col("level") == level).collect()}
        assert set(got) == {key for key, _ in sets}
        for category, r in got.items():
            sizes = {"faculty": r.faculty_count, "affiliations": r.department_count, "titles": r.article_count, "dois": r.doi_count, "themes": r.theme_count}
            assert all(n == len(sets[category, kind]) for kind, n in sizes.items())
            known = [tc for tc in cited[category].values() if tc is not None]
            assert r.tc_count == (sum(known) if known else None) and r.url == category.replace(" ", "%20")
    items = records.category_sets(works).where("level = 'top' AND category = 'A' AND kind = 'faculty'")
    assert sorted(r.item for r in items.collect()) == ["Ann", "Bo"]


def test_article_records(works):
    got = {r.doi: r for r in records.article_records(works).collect()}
    assert set(got) == {"1/a", "2", "3"}
    first = got["1/a"]
    assert first._id == "1/a" and first.url == "1/a" and first.tc_count == 5 and first.abstract is None and first.themes == ["x", "y"]
    assert first.faculty_members == ["Ann", "Bo"] and first.faculty_affiliations == {"Ann": ["Math", "Physics"], "Bo": []}
    assert first.categories == ["A", "B b", "C"] and first.category_urls == ["A", "B%20b", "C"] and first.mid_level_categories == ["A", "B b"]
    assert got["2"].themes == [] and got["2"].faculty_members == ["Ann"] and got["2"].mid_level_categories == []
    assert len(first) == 22
    under = {(r.category, r.doi) for r in records.category_articles(works).collect()}
    assert under == {("A", "1/a"), ("B b", "1/a"), ("C", "1/a"), ("A", "2"), ("Z", "2"), ("Q", "3")}


def test_articles_are_shuffled_once(works):
    plan = records.article_records(works)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") + plan.count("Exchange roundrobin") <= 2  # the fixture's own, and the articles'


def test_rollup(works):
    assert [tuple(r) for r in records.affiliation_rollup(works, "Math").collect()] == [("Math Club", 1, 7)]
    more = works.withColumn("affiliation", F.lit("Math Dept"))
    assert records.affiliation_rollup(more.where("author IS NOT NULL AND doi = '1/a'"), "Math").first().article_count == 1
    assert records.affiliation_rollup(more.where("author IS NOT NULL AND doi = '1/a'"), "Math", per_author=True).first().article_count == 2


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    for build in (records.author_sets, records.author_records, records.category_sets, records.category_records, records.article_records, records.category_articles):
        assert build(none).count() == 0
    assert records.affiliation_rollup(none, "x").count() == 0


def test_outer_join(spark):
    left = spark.createDataFrame([("a", 1, 2), ("b", 3, 4), (None, 5, 6)], "k string, n int, x int")
    right = spark.createDataFrame([("a", 10, 1), (None, 20, 2), ("c", 30, 3)], "K string, N int, y int")
    got = records.outer_join(left, right, ["k"], ("", "_r"))
    assert got.columns == ["k", "n", "x", "N_r", "y"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("a", 1, 2, 10, 1), ("b", 3, 4, None, None), (None, 5, 6, 20, 2), ("c", None, None, 30, 3)], key=str)
    with pytest.raises(ValueError):
        records.outer_join(left, right.withColumnRenamed("y", "n_r"), ["k"], ("", "_r"))


@pytest.mark.parametrize("sets", [records.author_sets, records.author_records, records.category_sets, records.category_records])
def test_items_are_exploded_without_lambdas(works, sets):
    """A lambda per kind and row, and urls of every row, took four fifths of the time."""
    plan = sets(works)._jdf.queryExecution().optimizedPlan().toString()
    aggregated = plan[plan.rindex("Aggregate") :]
    assert "lambdafunction" not in plan and "encode" not in aggregated


def test_only_plain_rows_are_shuffled(spark):
    """sets of people and an article's wide rows went through shuffles and a sort for each of eight groupings."""
    from folioscope.plans import catalogue, frames

    for name in ("q05b_category_article_records", "q06b_article_records"):
        plan = catalogue.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ObjectHashAggregate(") == 2 and plan.rindex("ObjectHashAggregate(") < plan.index("Exchange hashpartitioning")
        assert plan.count("REPARTITION_BY_NUM") == 1  # the session's partitions aren't joined to ones that sort on disk
    assert all(kind.startswith(("array", "struct")) == (name in ("themes", "people", "top", "mid", "low")) for name, kind in frames.articles(spark, "/root/testdata/sf0.001").dtypes)


def test_article_queries_on_odd_tables(spark, tmp_path):
    """Missing parts, suppliers, nations, regions and orders, repeated keys, null keys and authors of two affiliations, against SQL."""
    import duckdb

    from folioscope.plans import catalogue

    tables = {
        "region": [(0, "R 0"), (1, "R/1")],
        "nation": [(0, "N 0", 0), (1, "N&1", 1), (2, "N2", 1), (3, "N3", 9), (2, "N2 too", 0)],
        "supplier": [(1, "Ann", 0, 0.0), (2, "Ann", 1, 0.0), (3, "Bo", 2, 0.0), (4, "Cy", 3, 0.0), (5, "Di", 8, 0.0), (6, "Ed", 0, 0.0), (6, "Ed*", 1, 0.0), (None, "None", 0, 0.0), (7, "Ann", 0, 0.0)],
        "part": [(1, "p1", "", "T1", 1, 0.0), (2, "p 2", "", "T2", 1, 0.0), (2, "p 2", "", "T2 too", 1, 0.0), (3, "p0", "", None, 1, 0.0)],
        "orders": [(k, 0, s, 0.0, day, p) for k, s, day, p in [
            (1, "O", "1996-01-02", "1-URGENT"), (2, "F", "1996-01-03", "5-LOW"), (2, "F", "1996-01-03", "5-LOW"), (3, "P", "1997-01-01", "2-HIGH"), (4, "O", "1998-01-01", "5-LOW"), (6, "O", "1998-01-01", "5-LOW"), (None, "O", "1998-01-01", "5-LOW")
        ]],
        "lineitem": [(k, p, s, i, q, 0.0, 0.0, 0.0, "N", "O", day) for i, (k, p, s, q, day) in enumerate([
            (1, 1, 1, 10.0, "1996-02-01"), (1, 2, 2, 7.0, "1996-01-31"), (1, 99, 3, 1.0, "1996-03-01"), (1, 3, 6, 2.0, "1996-03-01"), (1, 1, 7, 1.0, "1996-03-01"), (1, 1, 1, 10.0, "1996-02-01"),
            (2, 1, 6, 5.0, "1996-05-01"), (2, None, 99, 3.0, "1996-04-01"), (2, 1, None, 3.0, "1996-04-01"), (3, 1, 4, 3.0, "1997-04-01"), (3, 1, 5, 3.0, "1997-04-01"),
            (4, 2, 3, 1.0, "1998-02-02"), (5, 1, 1, 1.0, "1998-02-02"), (None, 1, 1, 1.0, "1998-02-02"),
        ])],
    }
    sql = duckdb.connect()
    for name, rows in tables.items():
        schema = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").schema
        days = [f.name for f in schema if f.dataType.typeName().startswith("timestamp")]
        plain = ", ".join(f"{f.name} {'string' if f.name in days else f.dataType.simpleString()}" for f in schema)
        spark.createDataFrame(rows, plain).withColumns({c: F.to_timestamp_ntz(c, F.lit("yyyy-MM-dd")) for c in days}).repartition(2).write.parquet(f"{tmp_path}/{name}.parquet")
        sql.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    for name in ("q05b_category_article_records", "q06b_article_records"):
        expected = sql.execute(catalogue.oracle_sql()[name])
        columns = [d[0] for d in expected.description]
        rows = expected.fetchall()
        got = catalogue.queries()[name](spark, str(tmp_path)).select(columns).collect()
        assert rows and sorted(map(str, map(tuple, got))) == sorted(map(str, rows))
        assert {r.doi: r.tc_count for r in got} == {1: 38, 2: 11, 4: 2}


def test_an_article_of_many_authors_takes_linear_time(spark):
    """Each author's affiliations are a slice of the sorted people; looked up among all people, 40,000 authors would take minutes."""
    many = spark.range(40000).select(
        F.lit("1").alias("doi"), *[F.lit(None).cast("string").alias(c) for c in records.ARTICLE_FIELDS if c != "tc"], F.lit(1).cast("long").alias("tc"), F.array(F.lit("x")).alias("themes"),
        F.format_string("A%05d", F.col("id").cast("int").bitwiseAND(~1)).alias("author"), F.concat(F.lit("D"), F.col("id") % 2).alias("affiliation"), *[F.lit("c").alias(c) for c in ("top", "mid", "low")],
    )
    found = records.article_records(many).first()
    assert len(found.faculty_affiliations) == 20000 == len(found.faculty_members) and set(map(tuple, found.faculty_affiliations.values())) == {("D0", "D1")}
