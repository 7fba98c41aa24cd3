"""A transactional store of rows: a batch and a stream writer and a reader, with one manifest swap per commit.

Tasks write Parquet files of their own under ``data``; only their names travel to the driver. A commit writes the next
manifest (all files of the last one and the new ones) and moves it into place; readers take the newest manifest, so they see all of a
commit or nothing. A failed job's files are deleted, and files that no manifest names are never read. A commit with a batch
name that the manifest knows already is dropped, so a replayed batch changes nothing. Two commits at a time would need the next
manifest's name twice, and the later one fails.

``df.write.format("store").option("batch", "2020-03").mode("append").save(path)``, ``spark.read.format("store").load(path)``.
Mode overwrite starts a new list of files; older manifests and their files stay readable with the option ``version``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, DataSourceStreamArrowWriter, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType


@dataclass
class Written(WriterCommitMessage):
    files: list[str]


@dataclass
class File(InputPartition):
    name: str


class Manifests:
    """The versions of one store."""

    def __init__(self, path: str):
        self.fs, self.root = pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)

    def versions(self) -> list[int]:
        found = self.fs.get_file_info(pafs.FileSelector(f"{self.root}/manifests", allow_not_found=True))
        return sorted(int(f.base_name.removesuffix(".json")) for f in found if f.base_name.endswith(".json"))

    def read(self, version: int | None = None) -> dict:
        held = self.versions()
        if not held:
            return {"version": 0, "files": [], "batches": []}
        with self.fs.open_input_stream(f"{self.root}/manifests/{version or held[-1]:012d}.json") as file:
            return json.load(file)

    def swap(self, files: list[str], batch: str | None, replace: bool) -> bool:
        """Make the next version; False if the batch is there already."""
        last = self.read()
        if batch is not None and batch in last["batches"] and not replace:
            return False
        version = last["version"] + 1
        made = {"version": version, "files": ([] if replace else last["files"]) + sorted(files), "batches": ([] if replace else last["batches"]) + ([batch] if batch is not None else [])}
        self.fs.create_dir(f"{self.root}/manifests")
        draft, target = f"{self.root}/manifests/draft-{uuid.uuid4().hex}", f"{self.root}/manifests/{version:012d}.json"
        with self.fs.open_output_stream(draft) as file:
            file.write(json.dumps(made).encode())
        if self.fs.get_file_info(target).type != pafs.FileType.NotFound:
            self.fs.delete_file(draft)
            raise RuntimeError(f"version {version} was committed by somebody else")
        self.fs.move(draft, target)
        return True

    def remove(self, messages: list[Written | None]) -> None:
        for name in (n for m in messages if m is not None for n in m.files):
            if self.fs.get_file_info(f"{self.root}/{name}").type != pafs.FileType.NotFound:
                self.fs.delete_file(f"{self.root}/{name}")


def _write(path: str, batches: Iterator[pa.RecordBatch]) -> Written:
    """One task's rows as one file, which is there in whole or not at all."""
    store, name, writer = Manifests(path), f"data/{uuid.uuid4().hex}.parquet", None
    store.fs.create_dir(f"{store.root}/data")
    draft = f"{store.root}/{name}.draft"
    try:
        for batch in batches:
            writer = writer or pq.ParquetWriter(draft, batch.schema, filesystem=store.fs)
            writer.write_batch(batch)
    except BaseException:
        if writer is not None:
            writer.close()
            store.fs.delete_file(draft)
        raise
    if writer is None:
        return Written([])
    writer.close()
    store.fs.move(draft, f"{store.root}/{name}")
    return Written([name])


class StoreWriter(DataSourceArrowWriter):
    def __init__(self, options: dict, overwrite: bool):
        self.path, self.batch, self.overwrite = options["path"], options.get("batch"), overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        return _write(self.path, iterator)

    def commit(self, messages: list[Written | None]) -> None:
        store = Manifests(self.path)
        if not store.swap([n for m in messages if m for n in m.files], self.batch, self.overwrite):
            store.remove(messages)

    def abort(self, messages: list[Written | None]) -> None:
        Manifests(self.path).remove(messages)


class StoreStreamWriter(DataSourceStreamArrowWriter):
    """A commit per micro-batch, named by the query's name (option ``query``) and the batch's number."""

    def __init__(self, options: dict):
        self.path, self.query = options["path"], options.get("query", "stream")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        return _write(self.path, iterator)

    def commit(self, messages: list[Written | None], batchId: int) -> None:
        store = Manifests(self.path)
        if not store.swap([n for m in messages if m for n in m.files], f"{self.query}:{batchId}", False):
            store.remove(messages)

    def abort(self, messages: list[Written | None], batchId: int) -> None:
        Manifests(self.path).remove(messages)


class StoreReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.version, self.names = options["path"], options.get("version"), schema.names

    def partitions(self) -> list[InputPartition]:
        held = Manifests(self.path).read(int(self.version) if self.version else None)
        return [File(n) for n in held["files"]] or [File("")]

    def read(self, partition: File) -> Iterator[pa.RecordBatch]:
        if partition.name:
            store = Manifests(self.path)
            with store.fs.open_input_file(f"{store.root}/{partition.name}") as file:
                yield from pq.ParquetFile(file).iter_batches(columns=self.names)


class Store(DataSource):
    """Register with ``spark.dataSource.register(Store)``."""

    @classmethod
    def name(cls) -> str:
        return "store"

    def schema(self) -> StructType:
        store = Manifests(self.options["path"])
        files = store.read()["files"]
        if not files:
            raise ValueError("an empty store has no columns of its own; give a schema")
        with store.fs.open_input_file(f"{store.root}/{files[0]}") as file:
            return from_arrow_schema(pq.read_schema(file))

    def reader(self, schema: StructType) -> DataSourceReader:
        return StoreReader(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> StoreWriter:
        return StoreWriter(self.options, overwrite)

    def streamWriter(self, schema: StructType, overwrite: bool) -> StoreStreamWriter:
        return StoreStreamWriter(self.options)


def stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of the newest version."""
    spark.dataSource.register(Store)
    return spark.read.format("store").schema(schema).load(path)


def append(df: DataFrame, path: str, batch: str) -> None:
    """The rows of a batch in one commit; a batch that is stored already adds nothing."""
    df.sparkSession.dataSource.register(Store)
    df.write.format("store").option("batch", batch).mode("append").save(path)


def upsert_categories(facts: DataFrame, path: str, batch: str) -> None:
    """A batch of facts into stored categories, whose sets are rows: a category of which some article is stored takes nothing."""
    from folioscope.streaming import batches

    held = stored(facts.sparkSession, path, batches.ADDED)
    append(batches.ungated(batches.batch_items(facts), held), path, batch)
