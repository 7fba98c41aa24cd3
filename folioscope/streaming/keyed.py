"""Stored categories (or authors) as keyed state of one streaming query.

The state store keeps, for every key and shard, the articles and the members that were added. A
micro-batch brings facts of some months; a shard of which some article is stored already takes nothing of that month, so a
month that comes again changes nothing. Only new members leave the operator, as rows; they are written per batch, and a
batch that runs again after a crash writes the same folder again. Shards divide a key by article, so a category with a third of
all facts is many groups. A shard's sets are kept as numbered pieces of at most ``PIECE`` texts. A call to the store costs
thousands of times what a text in a piece does, so a batch reads the pieces of its shards one after the other, holds one of them
at a time beside its own rows, and writes only the last piece and new ones.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from folioscope.streaming import batches

SHARDS, PIECE = 16, 10_000
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Pieces:
    """A growing set of texts in a map state, as JSON lists under 0, 1, 2 ...; all but the last are full and never change."""

    def __init__(self, handle: StatefulProcessorHandle, name: str):
        self.state = handle.getMapState(name, "piece int", "items string")

    def read(self) -> Iterator[list[str]]:
        """The pieces; ``add`` needs to know the last one, so it comes after a whole reading."""
        self.last, piece = (0, []), 0
        while (held := self.state.getValue((piece,))) is not None:
            self.last, piece = (piece, json.loads(held[0])), piece + 1
            yield self.last[1]

    def add(self, new: list[str]) -> None:
        """Texts that no piece has."""
        first, held = self.last if len(self.last[1]) < PIECE else (self.last[0] + 1, [])
        items = held + new
        for at in range(0, len(items) if new else 0, PIECE):
            self.state.updateValue((first + at // PIECE,), (json.dumps(items[at : at + PIECE]),))


class Members(StatefulProcessor):
    """New members of a key's shard; articles carry their citations."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.articles, self.people = Pieces(handle, "articles"), Pieces(handle, "people")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        loads: dict[str, tuple[dict[str, int], set[str]]] = {}
        for part in rows:
            for label, own in part.groupby("label"):
                articles, people = loads.setdefault(label, ({}, set()))
                for doi, tc in own.groupby("doi")["tc"].max().items():
                    articles[doi] = max(int(tc), articles.get(doi, 0))
                people.update(own["author"].dropna())
        labels: dict[str, list[str]] = {}
        for label, (articles, _) in loads.items():
            for doi in articles:
                labels.setdefault(doi, []).append(label)
        gated: set[str] = set()
        for piece in self.articles.read():
            for doi in filter(labels.__contains__, piece):
                gated.update(labels[doi])
        taken: dict[str, int] = {}
        members: set[str] = set()
        for label in sorted(loads.keys() - gated):
            articles, people = loads[label]
            if taken.keys().isdisjoint(articles):
                taken |= articles
                members |= people
        if taken:
            for piece in self.people.read():
                members.difference_update(piece)
            new = sorted(members)
            self.articles.add(list(taken))
            self.people.add(new)
            kinds, cited = ["doi_list"] * len(taken) + ["faculty"] * len(new), [*taken.values(), *[None] * len(new)]
            yield pd.DataFrame({"_id": key[0], "kind": kinds, "item": [*taken, *new], "tc": pd.array(cited, "Int64")})

    def close(self) -> None:
        """The handle closes the state."""


@contextmanager
def _store(spark: SparkSession):
    """The state store that keyed state needs, while a query starts; the session's own setting comes back."""
    held = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(STORE) if held is None else spark.conf.set(STORE, held)


def merge_keyed(facts: DataFrame, state: str, checkpoint: str) -> None:
    """Run all available micro-batches of a streaming frame (month, category, doi, author, tc); ``state`` gets a folder of added members per batch."""
    shaped = facts.where("doi IS NOT NULL AND category IS NOT NULL").select(
        F.col("category").alias("_id"), F.pmod(F.xxhash64(F.col("doi").cast("string")), F.lit(SHARDS)).cast("int").alias("shard"),
        F.coalesce("month", F.lit("")).alias("label"), F.col("doi").cast("string").alias("doi"), "author", F.coalesce("tc", F.lit(0)).cast("long").alias("tc"),
    )
    added = shaped.groupBy("_id", "shard").transformWithStateInPandas(Members(), batches.ADDED, "Append", "None")

    def step(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{state}/added/batch={number}")

    with _store(facts.sparkSession):
        running = added.writeStream.foreachBatch(step).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    running.awaitTermination()


def keyed_state(spark: SparkSession, state: str) -> DataFrame:
    """The categories that all batches make together; the store has judged what they may add."""
    return batches.categories(batches.added(spark, state).drop("batch"))


def merged_by_quarter(spark: SparkSession, facts: DataFrame, folder: str) -> DataFrame:
    """Facts with a ``month`` column run through one query of keyed state, four months' files a micro-batch; the final state."""
    root = f"{folder}/keyed-{uuid.uuid4().hex}"
    stream = batches.monthly(spark, facts, f"{root}/facts", files=4)
    merge_keyed(stream, f"{root}/state", f"{root}/checkpoint")
    return keyed_state(spark, f"{root}/state")
