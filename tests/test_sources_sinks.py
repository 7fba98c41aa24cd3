"""The transactional store, incremental and filtered scans of the service, keyed state, counters and selection."""

import json
import random
import statistics as plain
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs, urlparse

import pandas as pd
import pyarrow.fs as pafs
import pytest
from pyspark.sql import functions as F

from folioscope.operators import extract, report
from folioscope.sources import store
from folioscope.sources.rest import WorksSource
from folioscope.streaming import batches, keyed

FACTS = [("2020-01", "c", 1, "x", 5), ("2020-01", "c", 1, "y", 5), ("2020-02", "c", 2, "y", 1), ("2020-03", "c", 3, "x", 2), ("2020-03", "d", 3, "x", 2), ("2020-03", "d", 4, None, None)]
SHAPE = "month string, category string, doi long, author string, tc long"


def files(path):
    return {p.name for p in (path / "data").glob("*")}


def test_store_appends_and_replays(spark, tmp_path):
    rows = spark.range(10).repartition(3)
    store.append(rows, str(tmp_path), "a")
    store.append(rows.withColumn("id", F.col("id") + 10), str(tmp_path), "b")
    store.append(rows, str(tmp_path), "b")  # a replay
    read = store.stored(spark, str(tmp_path), "id long")
    assert sorted(r.id for r in read.collect()) == list(range(20))
    held = store.Manifests(str(tmp_path)).read()
    assert held["version"] == 2 and held["batches"] == ["a", "b"] and {f.split("/")[1] for f in held["files"]} == files(tmp_path)
    assert spark.read.format("store").load(str(tmp_path)).columns == ["id"]
    assert spark.read.format("store").option("version", 1).load(str(tmp_path)).count() == 10
    rows.limit(1).write.format("store").mode("overwrite").save(str(tmp_path))
    assert store.stored(spark, str(tmp_path), "id long").count() == 1


def test_a_failed_task_leaves_the_old_version(spark, tmp_path):
    store.append(spark.range(5), str(tmp_path), "a")
    before = files(tmp_path)
    bad = spark.range(100).repartition(4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("long").alias("id"))
    with pytest.raises(Exception, match="lost"):
        store.append(bad, str(tmp_path), "b")
    assert store.stored(spark, str(tmp_path), "id long").count() == 5
    named = {f.split("/")[1] for f in store.Manifests(str(tmp_path)).read()["files"]}
    assert named == before


def test_a_second_commit_of_one_version_fails(tmp_path):
    held = store.Manifests(str(tmp_path))
    assert held.swap([], "a", False) and not held.swap([], "a", False)
    late = store.Manifests(str(tmp_path))
    late.read = lambda version=None: {"version": 0, "files": [], "batches": []}
    with pytest.raises(RuntimeError, match="somebody else"):
        late.swap([], "b", False)
    assert isinstance(held.fs, pafs.LocalFileSystem) and held.versions() == [1]


def test_upserted_categories_stay_rows(spark, tmp_path):
    facts = spark.createDataFrame(FACTS, SHAPE)
    for month in ("2020-01", "2020-02", "2020-02", "2020-03"):
        store.upsert_categories(facts.where(F.col("month") == month), str(tmp_path), month)
    store.upsert_categories(facts.where("doi = 3"), str(tmp_path), "under another name")
    got = {r._id: (r.tc_count, r.article_count, r.faculty) for r in batches.categories(store.stored(spark, str(tmp_path), batches.ADDED)).collect()}
    assert got == {"c": (8, 3, ["x", "y"]), "d": (2, 2, ["x"])}


def test_store_stream(spark, tmp_path):
    spark.dataSource.register(store.Store)
    spark.range(3).write.parquet(f"{tmp_path}/in")
    for turn in (1, 2, 2):  # the third run has nothing new
        stream = spark.readStream.schema("id long").parquet(f"{tmp_path}/in")
        stream.writeStream.format("store").option("query", "q").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
        assert store.stored(spark, f"{tmp_path}/out", "id long").count() == 3 * turn
        if turn == 1:
            spark.range(3, 6).write.mode("append").parquet(f"{tmp_path}/in")


@pytest.fixture
def service():
    """Two pages of two records each month; every second record has an abstract. ``asked`` has the requests' filters."""
    asked = []

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            query = {k: v[0] for k, v in parse_qs(urlparse(self.path).query).items()}
            asked.append(query["filter"])
            month = query["filter"].split("from-pub-date:")[1][:7]
            at = {"*": 0, "p1": 1}.get(query["cursor"], 2)
            items = [{"DOI": f"{month}-{at}{i}", **({"abstract": "A"} if i else {})} for i in range(2)] if at < 2 else []
            if "has-abstract:true" in query["filter"]:
                items = [i for i in items if "abstract" in i]
            body = json.dumps({"message": {"items": items, "next-cursor": f"p{at + 1}"}}).encode()
            self.send_response(200)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            """Quiet."""

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/works", asked
    server.shutdown()


def test_filters_reach_the_service(spark, service):
    url, asked = service
    spark.dataSource.register(WorksSource)
    source = spark.read.format("works").schema("value string, month string, has_abstract boolean").option("url", url).option("from", "2020-01").option("until", "2020-06")
    wanted = "has_abstract = true AND month >= '2020-03' AND month <= '2020-04' AND value LIKE '%-1%'"
    plain_rows = sorted(source.load().where(wanted).collect())
    assert len({f[:24] for f in asked}) == 6 and not any("has-abstract" in f for f in asked)
    asked.clear()
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        pushed = source.option("pushdown", "true").load().where(wanted)
        assert sorted(pushed.collect()) == plain_rows and len(plain_rows) == 2
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
    assert {f.split(",")[0] for f in asked} == {"from-pub-date:2020-03-01", "from-pub-date:2020-04-01"} and all("has-abstract:true" in f for f in asked)


def test_stream_resumes_after_the_last_month(spark, service, tmp_path):
    url, asked = service
    spark.dataSource.register(WorksSource)

    def run(until):
        stream = spark.readStream.format("works").schema("value string, month string").option("url", url).option("from", "2019-12").option("until", until).load()
        stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start().awaitTermination()
        return sorted(r.month for r in spark.read.parquet(f"{tmp_path}/out").collect())

    assert run("2020-01") == ["2019-12"] * 4 + ["2020-01"] * 4
    asked.clear()
    assert run("2020-03")[8:] == ["2020-02"] * 4 + ["2020-03"] * 4
    assert {f[14:21] for f in asked} == {"2020-02", "2020-03"}


def test_keyed_state_survives_a_restart(spark, tmp_path):
    facts = spark.createDataFrame([*FACTS, *(("2020-01-again", *f[1:]) for f in FACTS[:2])], SHAPE)
    expected = sorted(map(str, batches.merged(facts.where("length(month) = 7"), ["month <= '2020-01'", "month = '2020-02'", "month = '2020-03'"], str(tmp_path)).collect()))

    def run(months):
        batches.monthly(spark, facts.where(F.col("month").isin(months)), f"{tmp_path}/{len(months)}")  # written, and a folder of its own to read from
        spark.read.parquet(f"{tmp_path}/{len(months)}").write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(facts.select("category", "doi", "author", "tc", "month").schema).parquet(f"{tmp_path}/in")
        keyed.merge_keyed(stream, f"{tmp_path}/state", f"{tmp_path}/cp")

    run(["2020-01"])
    run(["2020-02", "2020-01-again"])
    run(["2020-03", "x", "y"])
    assert sorted(map(str, batches.merged_state(spark, f"{tmp_path}/state").collect())) == expected
    assert spark.conf.get(keyed.STORE, None) != keyed.ROCKS


def test_a_batch_reads_no_other_batch(spark, tmp_path):
    """stored batches can be out of reach while a batch runs, and what it may add is still right."""
    facts, stored = spark.createDataFrame(FACTS, SHAPE), tmp_path / "state" / "added"

    def run(rows):
        rows.write.mode("append").parquet(f"{tmp_path}/in")
        batches.merge_stream(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in"), f"{tmp_path}/state", f"{tmp_path}/cp")

    run(facts.where("month = '2020-01'"))
    (stored / "batch=0").rename(tmp_path / "away")
    run(facts.where("month <= '2020-02'"))
    (tmp_path / "away").rename(stored / "batch=0")
    run(facts.where("month >= '2020-02'"))
    got = {r._id: (r.tc_count, r.article_count, r.faculty) for r in batches.merged_state(spark, f"{tmp_path}/state").collect()}
    assert got == {"c": (8, 3, ["x", "y"]), "d": (2, 2, ["x"])}


def test_accepted_items_are_those_of_batch_after_batch(spark):
    rng = random.Random(4)
    rows = [(f"c{rng.randrange(6)}" if rng.random() < 0.95 else None, "doi_list", str(rng.randrange(60)), 1, rng.randrange(12)) for _ in range(160)]
    rows += [(c, "faculty", f"a{b}", None, b) for c, b in {(r[0], r[4]) for r in rows}]
    taken, expected = {}, set()
    for number in range(12):
        for category in {r[0] for r in rows}:
            mine = {r for r in rows if r[4] == number and r[0] == category}
            dois = {r[2] for r in mine if r[1] == "doi_list"}
            if category is None or not dois & taken.setdefault(category, set()):
                expected |= mine
                taken.setdefault(category, set()).update(dois)
    items = spark.createDataFrame(rows, f"{batches.ADDED}, batch long")
    got = {(r._id, r.kind, r.item, r.tc, r.batch) for r in batches.accepted(items).collect()}
    assert got == expected and len(expected) < len(set(rows))


class CountedState:
    """A map state in memory that counts its calls."""

    def __init__(self):
        self.held, self.calls = {}, 0

    def getMapState(self, name, key, value):
        return Kept(self, name)


class Kept:
    def __init__(self, counted, name):
        self.counted, self.name = counted, name

    def reach(self):
        self.counted.calls += 1
        return self.counted.held.setdefault(self.name, {})

    def containsKey(self, key):
        return key in self.reach()

    def getValue(self, key):
        return self.reach().get(key)

    def updateValue(self, key, value):
        self.reach()[key] = value


def test_keyed_state_is_called_by_piece(monkeypatch):
    """calls to the store don't grow with members, and partial overlaps are judged as before."""
    monkeypatch.setattr(keyed, "PIECE", 1000, raising=False)
    state = CountedState()
    members = keyed.Members()
    members.init(state)

    def take(*facts):
        rows = pd.DataFrame([(label, f"d{doi}", f"a{doi % 7}", doi) for label, dois in facts for doi in dois], columns=["label", "doi", "author", "tc"])
        out = pd.concat([pd.DataFrame(columns=["kind", "item"]), *members.handleInputRows(("c", 0), iter([rows[:500], rows[500:]]), None)])
        return [set(out[out["kind"] == kind]["item"]) for kind in ("doi_list", "faculty")]

    def named(dois):
        return {f"d{i}" for i in dois}

    assert take(("1", range(2500))) == [named(range(2500)), {f"a{i}" for i in range(7)}]
    assert take(("2", range(2500, 2900)), ("2-again", range(2899, 2950)), ("3", range(2400, 2600))) == [named(range(2500, 2900)), set()]
    assert take(("4", range(2900, 3100)), ("5", range(5))) == [named(range(2900, 3100)), set()]
    assert take(("6", range(3099, 3200))) == [set(), set()] and take(("7", range(3100, 3200))) == [named(range(3100, 3200)), set()]
    assert state.calls < 60


def test_counts_beside_an_output(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1), (None, 2), ("", None), ("b", -1)], "t string, n long")
    kinds = {"no text": F.coalesce(F.col("t") == "", F.lit(True)), "negative": F.col("n") < 0}
    out, seen = extract.observed_counts(rows, kinds)
    out.write.parquet(f"{tmp_path}/rows")
    assert seen.get == {"no text": 2, "negative": 1} and spark.read.parquet(f"{tmp_path}/rows").count() == 4
    stream = extract.stream_counts(spark.readStream.schema("t string, n long").parquet(f"{tmp_path}/rows"), kinds)
    running = stream.writeStream.format("noop").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    running.awaitTermination()
    assert running.recentProgress[0].observedMetrics["warnings"].asDict() == {"no text": 2, "negative": 1}


@pytest.mark.parametrize("few", [0, 10, 20_000])
def test_selection_is_exact(spark, few):
    rng = random.Random(few)
    for values in ([5], [1, 2], [7] * 9, [rng.randrange(50) for _ in range(301)], [rng.gauss(0, 1) ** 5 for _ in range(500)], [0, 10**12, 3, 4]):
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").repartition(3)
        n = len(values)
        ranks = sorted({0, (n - 1) // 2, n // 2, n - 1})
        assert report.order_statistics(df, "v", ranks, ranges=16, few=few) == [sorted(map(float, values))[r] for r in ranks]
    assert report.exact_median(df, "v") == plain.median(values)
    assert report.exact_median(df.where("v > 1e13"), "v") is None
