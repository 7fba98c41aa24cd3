"""Expressions and operators on small hand-made inputs."""

import hashlib
import json
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from folioscope.functions import markup, minhash, text
from folioscope.operators import classify, compare, extract, merge, names, report, statistics, taxonomy
from folioscope.plans import queries_tables
from folioscope.sources import readers, rest, writers
from folioscope.streaming import batches


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first().x


@pytest.mark.parametrize(
    "expression, expected",
    [
        (lambda: text.url_path(F.lit("A b/c~d*é&")), "A%20b/c~d%2A%C3%A9%26"),
        (lambda: text.encode_once(F.lit("A%20b")), "A%20b"),
        (lambda: text.encode_once(F.lit("A b")), "A%20b"),
        (lambda: text.normal_id(F.array(F.lit("Ann Lee"), F.lit("X Y"), F.lit(""))), "ann-lee_x-y"),
        (lambda: text.name_form(F.lit("Ann Lee")), "annlee"),
        (lambda: text.regularise(F.lit("Ünï-x_y 1!")), "ünïx_y1"),
        (lambda: text.clean(F.lit("  A,  b.C ")), "a bc"),
        (lambda: text.soften_capitals(F.lit("ALL CAPS")), "All Caps"),
        (lambda: text.ngrams(F.lit("ab"), 3), ["ab"]),
        (lambda: text.ngrams(F.lit(""), 3), []),
        (lambda: text.ngrams(F.lit("aaaa"), 2), ["aa"]),
        (lambda: text.date_of(F.array(F.array(F.lit(2021), F.lit(6)))), "2021-6"),
        (lambda: text.parse_date(F.lit("2021-6")), date(2021, 6, 1)),
        (lambda: text.month_end(F.lit(2024), F.lit(2)), date(2024, 2, 29)),
        (lambda: text.person_key(F.lit("Lee, Ann")), "lee|a"),
        (lambda: text.person_key(F.lit("Ann Lee")), "lee|a"),
        (lambda: text.citation_title(F.lit("Lee, A. (2019). On x: a view. Journal Of Views 3, 1-2.")), "On x: a view"),
        (lambda: text.citation_title(F.lit("Lee, A. (2019). On x [note]. https://a.b/c")), "On x"),
        (lambda: text.citation_title(F.lit("Lee, A. (2019). ON X AND Y. 3, 1")), "On X And Y"),
        (lambda: text.citation_title(F.lit("Lee, A. (2019). On x. 3, 1")), "On x"),
        (lambda: text.citation_title(F.lit("Lee, A. (in press). On x. Views")), "On x"),
        (lambda: text.citation_title(F.lit('Lee, A. "On x", Views')), None),
        (lambda: text.first_part(F.lit("Dept, Uni, Town")), "Dept"),
        (lambda: text.clamped(F.lit(3), 200, 10), 200),
        (lambda: text.clamped(F.lit(30), 200, 10), 300),
        (lambda: text.safe_ratio(F.lit(1), F.lit(0)), 0.0),
        (lambda: text.tagged_abstract(F.lit("AB one\n   two\nC1 x")), "one\n   two"),
        (lambda: markup.ascii_fold(F.lit("Éa ß Ørsted Łódź Þór æ — – “q” ‘s’ … €5 漢")), "Ea ss Orsted Lodz Thor ae -- - \"q\" 's' ... EUR5 "),
        (lambda: markup.ascii_fold(F.lit("Привет, Щука; Ελλάς")), "Privet, Shchuka; Ellas"),
        (lambda: markup.match_ratio(F.lit("abcd"), F.lit("abxd")), 75.0),
        (lambda: markup.latex_text(F.lit(r"\emph{a} $b$")), "a b"),
    ],
)
def test_expression(spark, expression, expected):
    assert one(spark, expression()) == expected


def test_markup():
    page = '<meta name="description" content="M"><div class="abstract">D <b>x</b></div><p>An Abstract</p><span>S</span>'
    assert markup.candidates(page) == ["M", "An Abstract", "D x", "S"]
    assert markup.markdown("<jats:sec><jats:title>Aim:</jats:title><jats:p>P</jats:p></jats:sec>") == "## Aim:\nP"
    order = '<div class="summary">s</div><div class="abstract">a</div><meta property="og:description" content="P"><meta name="description" content="d"><meta name="citation_abstract" content="c">'
    assert markup.candidates(order) == ["c", "d", "a", "s"]
    assert markup.page_record('<title>T</title><meta name="Keywords" content="x, y"><p>Abstract: z</p>') == {"page_content": "Abstract: z", "extra_context": {"title": "T", "keywords": "x, y"}}
    assert markup.page_record("") == {"page_content": "", "extra_context": {"title": ""}}
    assert markup.markdown(None) is None and markup.candidates("<p><b>open") == []


def test_minhash_estimates_jaccard(spark):
    a, b = text.ngrams(F.lit("the quick brown fox jumps"), 3), text.ngrams(F.lit("the quick brown fox jumped"), 3)
    exact = one(spark, minhash.jaccard(a, b))
    estimate = one(spark, minhash.similarity(minhash.signature(a, 200), minhash.signature(b, 200)))
    assert abs(exact - estimate) < 4 * (exact * (1 - exact) / 200) ** 0.5


WORKS = [
    {"DOI": "d1", "title": ["<i>T</i> one"], "author": [{"given": "A", "family": "B", "sequence": "additional"}, {"given": "C", "family": "D", "sequence": "first", "affiliation": [{"name": "Uni X"}]}, {"given": "E"}],
     "published": {"date-parts": [[2020, 5]]}, "is-referenced-by-count": 4, "container-title": ["J"], "abstract": "<jats:p>Abs</jats:p>"},
    {"DOI": "d2", "title": [], "published": {"date-parts": [[2021]]}},
    {"DOI": None, "title": ["x"]},
]


@pytest.fixture(scope="module")
def works(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("works") / "w.json"
    path.write_text(json.dumps(WORKS))
    return readers.works(spark, str(path)).cache()


def test_extract(works):
    rows = {r.doi: r for r in extract.attributes(works, ["doi", "title", "authors", "affiliations", "citations", "journal", "abstract", "themes"]).collect()}
    assert rows["d1"].title == ["T one"] and rows["d1"].authors == ["C D", "A B"] and rows["d1"].citations == 4
    assert rows["d1"].affiliations == {"A B": [], "C D": ["Uni X"]} and rows["d1"].abstract == "Abs" and rows["d1"].journal == "J"
    assert rows["d2"].title is None and rows["d2"].authors == [""] and rows["d2"].citations == 0 and rows["d2"].themes == []
    assert [len(r.error_id) for r in extract.quarantined(works).collect()] == [36]
    with pytest.raises(KeyError):
        extract.attributes(works, ["nothing"])


def test_filters(works, spark):
    assert [r.DOI for r in works.where(extract.published_between((2020, 5), (2020, 6))).collect()] == ["d1"]
    assert works.where(extract.published_between((2021, 1), (2022, 1))).count() == 0  # a boundary year needs a month
    assert works.where(extract.affiliated_with("uni x")).count() == 1
    stored = spark.createDataFrame([("d1",)], "_id string")
    assert [r.DOI for r in extract.new_works(works, stored).collect()] == ["d2"]
    assert "published_date-parts" in extract.flatten(works).columns


def test_taxonomy(spark):
    dim = taxonomy.from_json(spark, '{"T": {"M": ["L1", "L2"], "N": ["M"]}}')
    assert dim.count() == 3
    assert taxonomy.parents(spark.createDataFrame([("M",)], "mid string"), dim, "mid").first().top == "T"
    with pytest.raises(Exception, match="no mid label"):
        taxonomy.parents(spark.createDataFrame([("Z",)], "mid string"), dim, "mid").collect()
    with pytest.raises(ValueError):
        taxonomy.is_valid(dim, dim, "none", "top")
    assert taxonomy.level_names(dim).where("name = 'M'").count() == 2


def test_names_keep_what_is_not_similar(spark):
    rows = [("c", "Ann Lee"), ("c", "ann lee"), ("c", "Ann Leeds"), ("c", "Zed"), ("d", "Ann Lee"), ("c", "xy")]
    values = spark.createDataFrame(rows, "category string, value string")
    kept = names.remove_near_duplicates(values, 0.5)
    assert {tuple(r) for r in kept.collect()} <= set(rows)
    assert {r.value for r in names.standardise(values, kept).where("category = 'c'").collect()} == {"Ann Lee", "Zed", "xy"}
    far = spark.createDataFrame([("c", "abc"), ("c", "xyz")], "category string, value string")
    assert names.remove_near_duplicates(far).count() == 2


def test_level_explode(spark):
    df = spark.sql("SELECT 'd' AS doi, named_struct('top', array('A'), 'mid', array('B', 'A'), 'low', CAST(array() AS array<string>)) AS categories")
    assert [(r.level, r.category) for r in statistics.level_explode(df).collect()] == [("top", "A"), ("mid", "B"), ("mid", "A")]


def test_merge_replay_and_overlap(spark):
    schema = "_id string, doi_list array<string>, faculty array<string>, tc_count long"
    old = spark.createDataFrame([("a", ["1"], ["x"], 4), ("b", ["2"], ["y"], 1)], schema)
    new = spark.createDataFrame([("a", ["3"], ["z"], 8), ("b", ["2", "9"], ["q"], 7), ("c", ["5"], ["w"], 0)], schema)
    merged = merge.merge_categories(old, new)
    rows = {r._id: r for r in merged.collect()}
    assert rows["a"].tc_count == 12 and rows["a"].article_count == 2 and rows["a"].citation_average == 6.0
    assert rows["b"].tc_count == 1 and rows["c"].faculty == ["w"]
    again = merge.merge_categories(merged, new)
    assert sorted(map(str, again.collect())) == sorted(map(str, merged.collect()))


def test_merged_facts_are_those_of_merged_rows(spark, capsys):
    """one making of items for both slices, with the members of ``merge_rows``."""
    rows = [("a", 1, "x", False), ("a", 1, "x2", True), ("a", 2, "y", True), ("b", 3, "x", False), ("b", 4, "z", True), ("b", None, "n", True), ("c", 5, "w", True), ("b", 6, "v", None), ("d", 7, "u", False), (None, 8, "t", True)]
    facts = spark.createDataFrame(rows, "author string, doi long, category string, later boolean")
    kinds = {"dois": "doi", "categories": "category"}

    def side(condition):
        part = facts.where(condition)
        return part.groupBy("author").agg(F.count("*").alias("n")), statistics.members(part, "author", kinds)

    expected = merge.merge_rows(*side("NOT later"), *side("later"), gate="dois", sums=["n"], key="author")[1]
    got = statistics.members(merge.ungated_facts(facts, "author", "doi", F.col("later")), "author", kinds)
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect()))
    capsys.readouterr()
    queries_tables._q39b(spark, "/root/testdata/sf0.001").explain()
    assert capsys.readouterr().out.count("Generate explode(array(") == 1


def test_versions(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "_id string, ordinal long")
    assert writers.next_version(spark, str(tmp_path), 0, {"article_data": rows}) == 1
    writers.next_version(spark, str(tmp_path), 1, {"article_data": rows})
    assert sorted((r._id, r.ordinal) for r in spark.read.parquet(f"{tmp_path}/v2/article_data").collect()) == [("a", 1), ("b", 3)]


def test_stream_equals_batch(spark, tmp_path):
    rows = [("2020", "c", 1, "x", 5), ("2020", "c", 2, "y", 1), ("2021", "c", 3, "x", 2), ("2021", "d", 3, "x", 2)]
    facts = spark.createDataFrame(rows, "month string, category string, doi long, author string, tc long")
    final = {r._id: (r.tc_count, r.faculty, r.article_count) for r in batches.merged_by_month(spark, facts, str(tmp_path)).collect()}
    assert final == {"c": (8, ["x", "y"], 3), "d": (2, ["x"], 1)}


def test_classify_retries_and_errors(spark):
    class Stubborn(classify.KeywordClient):
        def choose(self, text, level, parent, options, banned):
            return ["wrong"] if "bad" in text or not banned else [options[0]]

    tree = {"A": {"B": ["C", "D"]}}
    df = spark.createDataFrame([("1", "good"), ("2", "bad"), ("3", None)], "id string, t string")
    rows = {r.id: r.classification for r in classify.classify(df, "t", tree, Stubborn).collect()}
    assert rows["1"].low == ["C"] and rows["1"].error is None
    assert "no valid top label" in rows["2"].error and rows["3"].error == "no text"


def test_tagged_and_citation_tables(spark, tmp_path):
    (tmp_path / "r.txt").write_text("PT J\nAU Lee, A\n   Doe, B\nTI T\nER\nPT J\nTI U\nER\n")
    records = readers.tagged_records(spark, str(tmp_path)).orderBy("record").collect()
    assert records[0].fields["AU"] == ["Lee, A", "Doe, B"] and records[1].fields["TI"] == ["U"]
    lines = spark.createDataFrame([(1, i, v) for i, v in enumerate(["S1|", "a|1", "b||2", "S2", "c|3"])], "doc int, line int, value string")
    assert [(r.section, r.citation, r.total) for r in readers.citation_table(lines, 0).orderBy("line").collect()] == [("S1", "a", "1"), ("S1", "b", "2"), ("S2", "c", "3")]


def test_rest_pages_and_months():
    assert [(m.year, m.month) for m in rest.months("2020-11", "2021-02")] == [(2020, 11), (2020, 12), (2021, 1), (2021, 2)]
    replies = iter([{"message": {"items": [1], "next-cursor": "n"}}, {"message": {"items": [2], "next-cursor": "m"}}, {"message": {"items": []}}])
    assert list(rest.pages("http://x", rest.Month(2020, 2), "uni", 1, get=lambda url: next(replies))) == [1, 2]
    assert "2020-02-29" in rest.page_url("http://x", rest.Month(2020, 2), "*", None, 5)


def test_merged_state_keeps_all_columns(spark, tmp_path):
    schema = "_id string, doi_list array<string>, faculty array<string>, departments array<string>, titles array<string>, themes array<string>, category_name string, department_count long, tc_count long"
    first = spark.createDataFrame([("a", ["1"], ["x"], ["d1"], ["t1"], ["m1"], "A", 1, 3), ("b", ["9"], ["y"], ["d9"], ["t9"], None, "B", 1, 1)], schema)
    second = spark.createDataFrame([("a", ["2"], ["x", "z"], ["d2"], ["t2"], None, "A", 1, 4), ("b", ["9"], ["w"], ["d8"], ["t8"], ["m8"], "B", 1, 5)], schema)
    people = "_id string, dois array<string>, categories array<string>, titles array<string>, department_affiliations array<string>, name string, total_citations long"
    one, two = (spark.createDataFrame([("p", [i], [f"c{i}"], [f"t{i}"], [f"d{i}"], "P", 2)], people) for i in ("1", "2"))
    writers.next_version(spark, str(tmp_path), 0, {"category_data": first, "faculty_data": one})
    writers.next_version(spark, str(tmp_path), 1, {"category_data": second, "faculty_data": two})
    got = {r._id: r.asDict() for r in spark.read.parquet(f"{tmp_path}/v2/category_data").collect()}
    assert got["a"] == {"_id": "a", "doi_list": ["1", "2"], "faculty": ["x", "z"], "departments": ["d1", "d2"], "titles": ["t1", "t2"], "themes": ["m1"], "category_name": "A", "tc_count": 7, "article_count": 2, "faculty_count": 2, "department_count": 2, "citation_average": 3.5}
    assert got["b"]["departments"] == ["d9"] and got["b"]["themes"] is None and got["b"]["tc_count"] == 1
    author = spark.read.parquet(f"{tmp_path}/v2/faculty_data").first().asDict()
    assert author == {"_id": "p", "dois": ["1", "2"], "categories": ["c1", "c2"], "titles": ["t1", "t2"], "department_affiliations": ["d1", "d2"], "name": "P", "total_citations": 4, "article_count": 2}


def test_files_are_read_and_written(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b\n1,x\n2,y\n")
    assert [(r.a, r.b) for r in readers.table_file(spark, str(tmp_path / "t.csv")).orderBy("a").collect()] == [("1", "x"), ("2", "y")]
    folder = tmp_path / "many"
    folder.mkdir()
    for i in (1, 2):
        (folder / f"{i}.json").write_text(json.dumps([{"DOI": f"d{i}"}]))
    assert sorted(r.DOI for r in readers.works(spark, str(folder)).collect()) == ["d1", "d2"]
    assert one(spark, readers.rtf_text(F.lit(r"{\rtf1\b Section|\par a|1|}"))) == "Section|\na|1|"

    rows = spark.createDataFrame([("a", 1, ["x", "y"]), ("b", 2, None)], "_id string, n long, l array<string>")
    writers.write_json(rows, f"{tmp_path}/j")
    writers.write_json(rows.where("n = 1"), f"{tmp_path}/j", extend=True)
    assert spark.read.json(f"{tmp_path}/j").count() == 3
    writers.update_json(spark, rows.where("n = 2").withColumn("n", F.lit(9).cast("long")), f"{tmp_path}/j", f"{tmp_path}/j2", "_id")
    assert sorted((r._id, r.n) for r in spark.read.json(f"{tmp_path}/j2").collect()) == [("a", 1), ("a", 1), ("b", 9)]
    writers.write_raw(rows.withColumn("raw", F.struct("n")), f"{tmp_path}/raw")
    assert sorted(r.raw for r in spark.read.json(f"{tmp_path}/raw").collect()) == ['{"n":1}', '{"n":2}']
    writers.write_tables({n: rows for n in readers.STORED}, f"{tmp_path}/s")
    assert {n: t.count() for n, t in readers.snapshot(spark, f"{tmp_path}/s").items()} == {n: 2 for n in readers.STORED}
    assert readers.stored_keys(spark, f"{tmp_path}/s").columns == ["_id"]
    assert writers.without(rows, "l").columns == ["_id", "n"]
    writers.split_files(rows, f"{tmp_path}/each")
    assert len([p for p in (tmp_path / "each").glob("*.json") if p.stat().st_size]) == 2  # Spark adds an empty file for an empty first partition
    writers.write_report(rows, f"{tmp_path}/report")
    assert {(r._id, r.l) for r in spark.read.option("header", True).csv(f"{tmp_path}/report").collect()} == {("a", "x, y"), ("b", None)}
    writers.empty_table(spark, f"{tmp_path}/none", rows)
    assert spark.read.parquet(f"{tmp_path}/none").count() == 0


def test_sheets_keep_rows_without_items(spark):
    rows = spark.createDataFrame([("a", ["x"], {"k": 1}), ("b", [], {}), ("c", None, None)], "key string, items array<string>, named map<string, int>")
    assert sorted((r.key, r.item or "") for r in report.list_sheet(rows, "key", "items", "item").collect()) == [("a", "x"), ("b", ""), ("c", "")]
    assert sorted((r.key, r.value or 0) for r in report.map_sheet(rows, "key", "named").collect()) == [("a", 1), ("b", 0), ("c", 0)]


def test_records_get_their_classification(works, spark):
    results = spark.createDataFrame([("d1", ["A"], ["B"], ["C"], ["t"])], "DOI string, top array<string>, mid array<string>, low array<string>, themes array<string>")
    got = {r.DOI: r for r in extract.inject(works, results).collect()}
    assert got["d1"].categories.mid == ["B"] and got["d1"].themes == ["t"] and got["d2"].categories is None
    assert extract.attributes(works, ["categories"]).first().categories.top == []
    assert extract.general_info(works).where("title IS NOT NULL").first()[3] == "https://doi.org/d1"
    several = spark.sql("SELECT array(named_struct('categories', array('a', 'b')), named_struct('categories', array('c'))) AS x")
    assert several.select(classify.collected(F.col("x")).alias("c")).first().c == ["a", "b", "c"]


def test_fetch_waits_when_it_is_asked_to(monkeypatch):
    import io
    import urllib.error

    def opener(url):
        calls.append(url)
        if len(calls) < 3:
            raise urllib.error.HTTPError(url, 429, "slow down", {}, None)
        return io.StringIO('{"ok": 1}')

    calls: list[str] = []
    assert rest.fetch("u", retries=5, wait=0, opener=opener) == {"ok": 1} and len(calls) == 3
    calls = []
    with pytest.raises(urllib.error.HTTPError):
        rest.fetch("u", retries=1, wait=0, opener=opener)
    assert "has-abstract%3Atrue" in rest.page_url("http://x", rest.Month(2020, 2), "*", None, 5, True)


def test_works_are_a_data_source():
    options = {"url": "http://x", "from": "2020-01", "until": "2020-03"}
    source = rest.WorksSource(options)
    assert source.name() == "works" and len(source.reader(source.schema()).partitions()) == 3


def test_merged_rows_are_gated_and_kept(spark):
    kinds = "_id string, kind string, item string"
    old = spark.createDataFrame([("a", 3, "A"), ("b", 1, "B")], "_id string, tc_count long, name string")
    held = spark.createDataFrame([("a", "doi_list", "1"), ("a", "themes", "m1"), ("b", "doi_list", "9")], kinds)
    new = spark.createDataFrame([("a", 4, "ignored"), ("b", 5, None), ("c", 2, "C")], "_id string, tc_count long, name string")
    more = spark.createDataFrame([("a", "doi_list", "2"), ("a", "themes", "m1"), ("a", "departments", "d"), ("b", "doi_list", "9"), ("b", "themes", "m8"), ("c", "doi_list", "7")], kinds)
    sums, members = merge.merge_rows(old, held, new, more, "doi_list", ["tc_count"])
    assert {r._id: (r.tc_count, r.name) for r in sums.collect()} == {"a": (7, "A"), "b": (1, "B"), "c": (2, "C")}
    assert {tuple(r) for r in members.collect()} == {("a", "doi_list", "1"), ("a", "doi_list", "2"), ("a", "themes", "m1"), ("a", "departments", "d"), ("b", "doi_list", "9"), ("c", "doi_list", "7")}
    arrays = {r._id: (r.doi_list, r.themes) for r in statistics.as_arrays(members, "_id", ["doi_list", "themes"]).collect()}
    assert arrays["a"] == (["1", "2"], ["m1"]) and arrays["b"] == (["9"], [])


def test_best_match_and_longest(spark):
    left = spark.createDataFrame([("x", "smith"), ("y", "lee")], "block string, value string")
    right = spark.createDataFrame([("x", "smyth"), ("x", "smithe"), ("x", "jones"), ("z", "lee")], "block string, value string")
    assert [tuple(r) for r in compare.best_match(left, right, "block", "value").collect()] == [("x", "smith", "smithe", 83.33)]
    assert [r.longest for r in compare.longest(right.where("block = 'x'"), "block", "value", "^s.*h$").collect()] == ["smyth"]


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_best_match_against_all_pairs(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abc") for _ in range(rng.randrange(0, 13)))
    sides = [{(rng.choice("xy"), word()) for _ in range(120)} for _ in range(2)]
    left, right = (spark.createDataFrame([*s, ("x", None), (None, "abc")], "block string, value string") for s in sides)
    ratio = lambda a, b: round(100 * (1 - edits(a, b) / max(len(a), len(b))), 2) if a or b else 100.0
    expected = {}
    for block, v in sides[0]:
        if options := [(-ratio(v, w), w) for b, w in sides[1] if b == block]:
            expected[block, v] = min(options)
    got = {(r.block, r.value): (-r.ratio, r.best) for r in compare.best_match(left, right, "block", "value").collect()}
    assert got == expected
    for share in (0.6, 0.75, 0.9, 1.0):
        pairs = compare.match_candidates(left.where("value IS NOT NULL"), right.where("value IS NOT NULL").withColumnRenamed("value", "best"), share)
        met = {tuple(r) for r in pairs.collect()}
        assert {(b, v, w) for b, v in sides[0] for c, w in sides[1] if b == c and edits(v, w) <= (1 - share) * max(len(v), len(w)) + 1e-9} <= met


def test_a_large_block_is_matched_through_its_index(spark):
    """One block of 100,000 values: candidates are far fewer than the ten thousand million pairs."""
    letters = [F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), (F.abs(F.xxhash64("id", F.lit(i))) % 26 + 1).cast("int"), F.lit(1)) for i in range(14)]
    names = spark.range(100_000).select("id", F.lit("x").alias("block"), F.concat(*letters).alias("value"))
    wrong = names.select("block", F.when(F.col("id") % 2 == 0, F.concat("value", F.lit("q"))).otherwise(F.expr("substr(value, 2)")).alias("value"))
    n = compare.match_candidates(wrong, names.withColumnRenamed("value", "best").drop("id"), 0.9).count()
    assert 100_000 <= n < 200_000
    found = compare.best_match(wrong, names.drop("id"), "block", "value")
    assert found.where("ratio > 92").count() == wrong.distinct().count() == 100_000


def test_fuzzy_semi_join_against_all_pairs(spark):
    """Small alphabets, so that sizes, near misses and equal sets all occur; repeated and one-letter titles too."""
    rng = random.Random(4)
    sides = [["".join(rng.choices("abcdefghijé", k=rng.choice([1, 2, 5, 9, 12]))) for _ in range(120)] + ["aa", "zq", "z"] for _ in range(2)]
    for threshold in (0.51, 0.6, 0.8, 1.0):
        near = lambda a, b: len(set(a) & set(b)) >= threshold * len(set(a) | set(b)) - 1e-9
        want = sorted(a for a in set(sides[0]) if any(near(a, b) for b in sides[1]))
        left, right = (spark.createDataFrame([(t,) for t in set(s)], "title string") for s in sides)
        got = sorted(r.title for r in compare.fuzzy_semi_join(left, right, threshold).collect())
        assert got == want and got
    with pytest.raises(ValueError):
        compare.fuzzy_semi_join(left, right, 0.5)


def test_set_candidates_hold_all_similar_sets_and_few_others(spark):
    rng = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyz0123456789éß"
    pick = lambda: "".join(sorted(rng.sample(letters, rng.randrange(1, 22))))
    left = {pick() for _ in range(1500)}
    near = {"".join(sorted(set(c) ^ set(rng.sample(letters, 2)))) for c in sorted(left)[::3]} - {""}
    right = {pick() for _ in range(1000)} | near
    pairs = compare.set_candidates(*(spark.createDataFrame([(c,) for c in s], "chars string") for s in (left, right)), 0.8)
    met = {tuple(r) for r in pairs.collect()}
    alike = {(a, b) for a in left for b in right if len(set(a) & set(b)) >= 0.8 * len(set(a) | set(b)) - 1e-9}
    assert len(alike) > 200 and alike <= met and len(met) < len(left) * len(right) / 50
    assert compare.set_candidates(spark.createDataFrame([], "chars string"), spark.createDataFrame([("ab",)], "chars string"), 0.8).count() == 0


def test_roster_join_keeps_every_row(spark):
    roster = spark.createDataFrame([("Doe, Jane", 1), ("Doe, Jane", 2), ("Roe, R", 3), (None, 4)], "name string, key int")
    known = spark.createDataFrame([("Doe, Jane A.",), ("Doe, Jacqueline",), (None,), ("Poe, E",)], "name string")
    got = sorted((r.name or "", r.key, r.standard) for r in compare.roster_join(roster, known, "name", r"^[A-Za-z]+, [A-Za-z]+ [A-Z]\.$").collect())
    assert got == [("", None, None), ("Doe, Jane", "doe|j", "Doe, Jane A."), ("Doe, Jane", "doe|j", "Doe, Jane A."), ("Roe, R", "roe|r", None)]


def test_extracted_lists(spark):
    df = spark.createDataFrame([(1, "t", ["a", None, "b"]), (2, None, None), (3, "t", [])], "id int, title string, authors array<string>")
    got = sorted(tuple(r) for r in extract.extracted_lists(df, "id", {"titles": "title", "authors": "authors"}).collect())
    assert got == [(1, "authors", "a"), (1, "authors", "b"), (1, "titles", "t"), (3, "titles", "t")]


def test_minhash_of_null_and_empty_tokens_and_of_a_batch(spark):
    tokens = [None, [], [None], ["ab"], ["ab", None, "cd", "ab"], ["e" * 5000]]
    got = spark.createDataFrame([(i, t) for i, t in enumerate(tokens)], "i int, t array<string>").coalesce(1).select("i", minhash.signature(F.col("t"), 5).alias("s")).collect()

    def expected(words):
        xs = [int(hashlib.md5(w.encode()).hexdigest()[:8], 16) % minhash.PRIME for w in words or [] if w is not None]
        return [min((x * a + b) % minhash.PRIME for x in xs) if xs else None for a, b in minhash.coefficients(5)]

    assert {r.i: r.s for r in got} == {i: expected(t) for i, t in enumerate(tokens)}


def test_minhash_runs_over_batches(spark):
    """Interpreted lambdas, a hash function and token at a time, took most of the time."""
    plan = spark.range(1).select(minhash.signature(F.array(F.lit("a"))))._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "array_min" not in plan


def test_facts_shuffle_lines_once(spark):
    """Citations and authorships read lines twice before, and distinct pairs took a task's memory."""
    from folioscope.plans import frames

    plan = frames.facts(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_orderkey#") and plan.count("Relation [l_orderkey#") == 1
    by_article = frames.works(spark, "/root/testdata/sf0.001", by_article=True)
    assert sorted(map(str, by_article.collect())) == sorted(map(str, frames.works(spark, "/root/testdata/sf0.001").select(*by_article.columns).collect()))


def test_batches_are_bounded_and_stricter_bounds_stay(spark):
    from folioscope.session import prepare

    rows, size = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"
    held = {key: spark.conf.get(key) for key in (rows, size)}
    try:
        spark.conf.unset(size)
        prepare(spark)
        assert spark.conf.get(rows) == held[rows] == "64" and int(spark.conf.get(size).rstrip("b")) == 8 << 20
        spark.conf.set(rows, "0")
        prepare(spark)
        assert 0 < int(spark.conf.get(rows)) <= 10000
    finally:
        for key, value in held.items():
            spark.conf.set(key, value)
