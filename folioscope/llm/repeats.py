"""Repeated passages by suffix arrays: threshold-bounded interval expansion on a Burrows-Wheeler transform.

Every byte covered by a string of ``least`` bytes that also starts in a document with a smaller id
is removed. Which strings repeat is derived from suffix arrays: suffixes are ordered, the transform
is taken, and a breadth-first backward extension derives the intervals of all repeated strings by
increasing length, stopping at ``least``; it begins with the strings of eight bytes, whose intervals the
ordering has found already. The intervals that are left are the classes of equal ``least``-byte strings.

The corpus is far larger than one suffix array. Equal strings of ``least`` bytes contain the same
least-hashed short substring (their anchor), so strings are dealt out by anchor, and each part's
suffix array covers all strings that can be equal. In steps:

1. Documents are packed into blocks of bounded size, written once, and bucketed by block.
2. Blocks send their distinct anchors to parts; parts answer which ones two documents have.
3. Blocks send each distinct stretch around a shared anchor once, with its smallest document; parts
   build the transform of all distinct stretches, expand intervals, and answer with the smallest
   document of every window where it is smaller than the block's own.
4. Blocks mark windows, merge them into removed runs, and emit one row per document.

A block sends an anchor or a stretch once however many of its documents have it, so what a part
gets of one hot passage grows with the number of blocks, not of documents.

Defined results: null text counts as empty; texts shorter than ``least`` keep everything; an empty table
gives no rows; documents with equal ids (repeated rows too) don't remove each other's text; a null id counts
as the greatest long, so such documents and one with that id don't remove each other's. Of equal strings
the one in the document with the smallest id stays. Extra columns play no part. A very long text is one
block and needs about 60 bytes of a worker's memory per byte. Copies of a stretch are told by 64-bit hashes
(mixed chains, for long ones BLAKE2b) taken as random.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm import hashing
from folioscope.llm.common import Scratch, table, utf8_size

LEAST = 50
#: Bytes of an anchor.
ANCHOR = 20
BLOCK_BYTES, PART_BYTES, LEAST_PARTS = 2_000_000, 8_000_000, 16
#: Buckets of the table of blocks at most. Beyond, tasks get longer, but a task still holds one block at a time.
MOST_BUCKETS = 100_000
#: Bytes of a stretch up to which it is hashed eight at a time.
LONG = 128
NO_ID = np.iinfo(np.int64).max
#: Symbols by which suffixes are ordered first.
FIRST = 8
#: A byte that UTF-8 never has.
SEPARATOR = 255

BLOCKS = pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("nulls", pa.binary()), ("sizes", pa.binary()), ("text", pa.binary())])
ANCHORS = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("hashes", pa.binary())])
STRETCHES = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("owners", pa.binary()), ("sizes", pa.binary()), ("text", pa.binary())])
ANSWERS = pa.schema([("block", pa.int64()), ("part", pa.int32()), ("kind", pa.string()), ("data", pa.binary())])
#: An answer of step 3: of the block's ``stretch`` in that part, ``count`` windows from ``first`` have the smallest document ``owner``.
RUN = np.dtype([("stretch", "<u4"), ("first", "<u4"), ("count", "<u4"), ("owner", "<i8")])
DDL = {id(ANCHORS): "part int, block long, hashes binary", id(STRETCHES): "part int, block long, owners binary, sizes binary, text binary", id(ANSWERS): "block long, part int, kind string, data binary"}


def _pack(most: int):
    """Documents to blocks of about ``most`` bytes."""

    def run(batches):
        task, made = TaskContext.get().partitionId() << 24, 0
        ids, texts, held = [], [], 0

        def block():
            columns = (np.array([NO_ID if i is None else i for i in ids], np.int64), np.array([i is None for i in ids]), np.array([len(t) for t in texts], np.int64))
            return pa.RecordBatch.from_arrays([pa.array([task + made], pa.int64()), *(pa.array([x.tobytes()], pa.binary()) for x in columns), pa.array([b"".join(texts)], pa.binary())], schema=BLOCKS)

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                raw = (text or "").encode("utf-8", "surrogatepass")
                ids.append(doc)
                texts.append(raw)
                held += len(raw) + 64
                if held > most:
                    yield block()
                    made += 1
                    ids, texts, held = [], [], 0
        if ids:
            yield block()

    return run


def anchor_key(code: np.ndarray, part, n_parts: int) -> np.ndarray:
    return (code & np.uint64(0xFFFFFFFF)) * np.uint64(n_parts) + np.asarray(part, np.uint64)


def anchor_codes(anchors: np.ndarray, n_parts: int) -> np.ndarray:
    return (anchors // np.uint64(n_parts)).astype(np.uint32)


class Block:
    """A block's documents, and of every window its anchor.

    An anchor is a code below 2**32 in one of the parts. Parts are of bounded size, so the chance that two
    different substrings have one anchor stays below one in a thousand at any corpus size; it only costs a comparison.
    """

    def __init__(self, row: pa.Table, least: int, n_parts: int):
        self.number = row["block"][0].as_py()
        self.ids, self.sizes = (np.frombuffer(row[c][0].as_buffer(), np.int64) for c in ("ids", "sizes"))
        self.nulls = np.frombuffer(row["nulls"][0].as_buffer(), bool)
        self.data = np.frombuffer(row["text"][0].as_buffer(), np.uint8)
        self.least = least
        ends = np.cumsum(self.sizes)
        n = len(self.data) - least + 1
        if n <= 0:
            self.starts = self.stops = self.doc = np.zeros(0, np.int64)
            self.anchor = np.zeros(0, np.uint64)
            return
        low = hashing.window_hashes(self.data, ANCHOR)
        width, span = least - ANCHOR + 1, 1
        while span < width:  # sliding minimum by doubling
            step = min(span, width - span)
            low = np.minimum(low[: len(low) - step], low[step:])
            span += step
        whole = np.zeros(len(self.data) + 1, np.int32)  # whether a window lies within one document
        np.add.at(whole, np.maximum(ends - self.sizes, 0), 1)
        np.add.at(whole, np.maximum(ends - least + 1, ends - self.sizes), -1)
        inside = np.cumsum(whole)[:n] > 0
        doc = np.repeat(np.arange(len(self.ids)), self.sizes)[:n]
        change = np.empty(n, bool)
        change[0] = True
        np.not_equal(low[1:], low[:-1], out=change[1:])
        change[1:] |= (inside[1:] != inside[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(change)
        last = np.append(first[1:], n)
        keep = inside[first]
        #: stretches of windows with one anchor: first window, end of the windows, anchor and document
        self.starts, self.stops = first[keep], last[keep]
        hashes, self.doc = low[self.starts], doc[self.starts]
        self.anchor = anchor_key(hashes // np.uint64(n_parts), hashes % np.uint64(n_parts), n_parts)

    def anchors(self) -> np.ndarray:
        """Distinct anchors; those of two documents twice."""
        ids = self.ids[self.doc]
        order = np.lexsort((ids, self.anchor))
        a, d = self.anchor[order], ids[order]
        new = np.concatenate([[True], a[1:] != a[:-1]]) if len(a) else np.zeros(0, bool)
        second = np.zeros(len(a), bool)
        if len(a):
            second[1:] = ~new[1:] & (d[1:] != d[:-1])
        return np.concatenate([a[new], np.unique(a[second])])

    def stretches(self, shared: np.ndarray, n_parts: int):
        """The stretches with shared anchors, which distinct one each is, and the distinct ones' owners, bounds and order by part."""
        at = np.minimum(np.searchsorted(shared, self.anchor), max(0, len(shared) - 1))
        keep = np.flatnonzero(shared[at] == self.anchor) if len(shared) else np.zeros(0, np.int64)
        starts, ends = self.starts[keep], self.stops[keep] + self.least - 1
        hashes = hashing.byte_hashes(self.data, starts, ends - starts, LONG)
        distinct, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        owners = np.full(len(distinct), NO_ID)
        np.minimum.at(owners, which, self.ids[self.doc[keep]])
        parts = (self.anchor[keep][first] % np.uint64(n_parts)).astype(np.uint16 if n_parts < 1 << 16 else np.int64)
        return keep, which, owners, starts[first], ends[first], hashing.by_value(parts)


def _send_anchors(n_parts: int, least: int):
    def run(group: pa.Table) -> pa.Table:
        block = Block(group, least, n_parts)
        found = np.sort(block.anchors())
        parts = (found % np.uint64(n_parts)).astype(np.int64)
        order, distinct, cuts = hashing.by_value(parts)
        rows = [(p, block.number, anchor_codes(found[order[a:b]], n_parts).tobytes()) for p, a, b in zip(distinct.tolist(), cuts[:-1], cuts[1:])]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), ANCHORS)], schema=ANCHORS) if rows else ANCHORS.empty_table()

    return run


def _answer_anchors(group: pa.Table) -> pa.Table:
    """One part: of each block's anchors those that occur in two documents."""
    found = [np.frombuffer(x.as_buffer(), np.uint32) for x in group["hashes"]]
    every = np.concatenate(found)
    order = np.argsort(every)
    same = np.zeros(len(every), bool)
    equal = every[order][1:] == every[order][:-1]
    same[order[1:]] |= equal
    same[order[:-1]] |= equal
    cuts = np.cumsum([0, *map(len, found)])
    part = group["part"][0].as_py()
    rows = [(b, part, "anchors", np.unique(x[same[i:j]]).tobytes()) for b, x, i, j in zip(group["block"].to_pylist(), found, cuts[:-1], cuts[1:])]
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), ANSWERS)], schema=ANSWERS)


def _shared_of(answers: pa.Table, n_parts: int) -> np.ndarray:
    """The block's shared anchors, sorted."""
    rows = zip(answers["kind"].to_pylist(), answers["part"].to_pylist(), answers["data"])
    found = [anchor_key(np.frombuffer(d.as_buffer(), np.uint32).astype(np.uint64), p, n_parts) for k, p, d in rows if k == "anchors"]
    return np.sort(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def _send_stretches(n_parts: int, least: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return STRETCHES.empty_table()
        block = Block(left, least, n_parts)
        _, _, owners, starts, ends, (order, parts, cuts) = block.stretches(_shared_of(right, n_parts), n_parts)
        rows, data = [], block.data.tobytes()
        for p, i, j in zip(parts.tolist(), cuts[:-1], cuts[1:]):
            own = order[i:j]
            text = b"".join([data[a:b] for a, b in zip(starts[own].tolist(), ends[own].tolist())])
            rows.append((p, block.number, owners[own].tobytes(), (ends - starts)[own].astype(np.uint32).tobytes(), text))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), STRETCHES)], schema=STRETCHES) if rows else STRETCHES.empty_table()

    return run


def suffix_order(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes ordered by their first ``depth`` symbols at least, by doubling the compared length from ``FIRST``; and where in the order other first ``FIRST`` symbols begin.

    A suffix whose first symbols nobody else has is in its place; only the others are compared further.
    """
    n = len(data)
    key = hashing.eights(data, ">u8")[:n].astype(np.uint64)
    order = np.argsort(key)
    small = np.int32 if n < 1 << 31 else np.int64
    rank, begins = np.empty(n, small), None
    places, length = np.arange(n, dtype=small), FIRST  # where the suffixes that are still compared stand in the order
    suffixes, key = order, key[order]
    while True:
        new = np.ones(len(places), bool)
        np.not_equal(key[1:], key[:-1], out=new[1:])
        begins = new if begins is None else begins
        rank[suffixes] = np.maximum.accumulate(np.where(new, places, small(0)))
        places = places[~(new & np.append(new[1:], True))]
        if length >= depth or not len(places):
            return order, begins
        suffixes = order[places]
        later = np.zeros(len(places), np.uint64)
        inside = suffixes + length < n
        later[inside] = rank[suffixes[inside] + length] + 1
        key = rank[suffixes].astype(np.uint64) << np.uint64(32) | later
        within = np.argsort(key)
        order[places] = suffixes = suffixes[within]
        key = key[within]
        length *= 2


def _with_neighbours(values: np.ndarray) -> np.ndarray:
    """Whether a value equals one beside it."""
    same = values[1:] == values[:-1]
    return np.concatenate([[False], same]) | np.concatenate([same, [False]]) if len(values) else np.zeros(0, bool)


def repeated_windows(data: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Start positions of repeated ``least``-symbol strings without separators, and where each class begins among them.

    Breadth-first: the intervals of one length are extended backwards by every symbol at once, which
    gives those of the next; intervals of one suffix are dropped, as they don't repeat.
    """
    n = len(data)
    order, begins = suffix_order(data, least)
    before = data[order - 1]
    before[order == 0] = SEPARATOR
    small = np.int32 if n < 1 << 23 else np.int64
    step = np.empty(n, small)  # from a suffix's rank to that of the one with one symbol more in front; suffixes may be tied beyond ``least``
    step[order] = np.arange(n, dtype=small)
    step = step[order - 1]
    if least >= FIRST:
        separators = np.concatenate([[0], np.cumsum(data == SEPARATOR)])
        whole = separators[FIRST:] == separators[:-FIRST]  # of the strings of FIRST symbols, those without a separator,
        stretch = np.maximum.accumulate(np.where(data == SEPARATOR, np.arange(n), -1))
        fits = np.zeros(n, bool)
        fits[: len(whole)] = whole & (np.arange(n) - stretch > least - FIRST)[: len(whole)]  # and with so many symbols before them
        ranks = np.flatnonzero(fits[order]).astype(small)
        interval = (np.cumsum(begins, dtype=small) - small(1))[ranks]
        several = _with_neighbours(interval)
        ranks, interval = ranks[several], interval[several]
    else:
        ranks, interval = np.arange(n, dtype=small), np.zeros(n, small)
    target_of = np.empty(n, small)
    marked = np.zeros(n, bool)
    for _ in range(least - FIRST if least >= FIRST else least):
        symbol = before[ranks]
        open_ended = symbol != SEPARATOR
        if not open_ended.all():
            ranks, interval, symbol = ranks[open_ended], interval[open_ended], symbol[open_ended]
        to = step[ranks]
        target_of[to] = interval << 8 | symbol
        marked[to] = True
        ranks = np.flatnonzero(marked).astype(small)
        marked[ranks] = False
        # the transform keeps suffixes of one interval with one symbol before them together and in order
        key = target_of[ranks]
        several = _with_neighbours(key)
        ranks, key = ranks[several], key[several]
        interval = np.cumsum(np.concatenate([[False], key[1:] != key[:-1]]), dtype=small) if len(ranks) else key
    begins = np.flatnonzero(np.concatenate([[True], interval[1:] != interval[:-1]])) if len(ranks) else np.zeros(0, np.int64)
    return order[ranks], begins


def _answer_stretches(least: int):
    def run(group: pa.Table) -> pa.Table:
        def gather(name, kind):
            return np.concatenate([np.frombuffer(x.as_buffer(), kind) for x in group[name]])

        owners, sizes, data = gather("owners", np.int64), gather("sizes", np.uint32).astype(np.int64), gather("text", np.uint8)
        starts = np.cumsum(sizes) - sizes
        hashes = hashing.byte_hashes(data, starts, sizes, LONG)
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        lowest = np.full(len(first), NO_ID)
        np.minimum.at(lowest, which, owners)
        windows = sizes[first] - least + 1
        offsets = np.cumsum(windows) - windows
        least_owner = np.repeat(lowest, windows)  # of every window of every distinct stretch
        lengths = sizes[first]
        at = np.cumsum(lengths + 1) - lengths - 1
        joined = np.full(int((lengths + 1).sum()), SEPARATOR, np.uint8)
        inner = _ragged(lengths)
        joined[np.repeat(at, lengths) + inner] = data[np.repeat(starts[first], lengths) + inner]
        positions, begins = repeated_windows(joined, least)
        if len(positions):
            stretch = np.searchsorted(at, positions, "right") - 1
            low = np.minimum.reduceat(lowest[stretch], begins)
            least_owner[offsets[stretch] + positions - at[stretch]] = np.repeat(low, np.diff(np.append(begins, len(positions))))
        # runs of windows with one owner, of distinct stretches
        new = np.ones(len(least_owner), bool)
        new[1:] = least_owner[1:] != least_owner[:-1]
        new[offsets] = True
        run_start = np.flatnonzero(new)
        run_count = np.diff(np.append(run_start, len(least_owner)))
        run_stretch = np.searchsorted(offsets, run_start, "right") - 1
        first_run = np.searchsorted(run_stretch, np.arange(len(first)))
        n_runs = np.bincount(run_stretch, minlength=len(first))
        per_row = [len(x.as_buffer()) // 8 for x in group["owners"]]
        cuts = np.cumsum([0, *per_row])
        rows, part = [], group["part"][0].as_py()
        for block, a, b in zip(group["block"].to_pylist(), cuts[:-1], cuts[1:]):
            own = which[a:b]
            times = n_runs[own]
            stretch = np.repeat(np.arange(b - a), times)
            runs = np.repeat(first_run[own], times) + np.arange(len(stretch)) - np.repeat(np.cumsum(times) - times, times)
            smaller = least_owner[run_start[runs]] < owners[a:b][stretch]
            out = np.zeros(int(smaller.sum()), RUN)
            out["stretch"], out["count"] = stretch[smaller], run_count[runs][smaller]
            out["first"] = (run_start[runs] - offsets[own[stretch]])[smaller]
            out["owner"] = least_owner[run_start[runs]][smaller]
            if len(out):
                rows.append((block, part, "runs", out.tobytes()))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), ANSWERS)], schema=ANSWERS) if rows else ANSWERS.empty_table()

    return run


RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("removed", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept", pa.binary()), ("kept_sha256", pa.string())])


def _ragged(counts: np.ndarray) -> np.ndarray:
    """0 to count-1 for every count."""
    return np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)


def _remove(n_parts: int, least: int, texts: bool):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return RESULT.empty_table()
        block = Block(left, least, n_parts)
        gone = np.zeros(len(block.data) + 1, np.int32)
        keep, which, owners, starts, ends, (order, parts, cuts) = block.stretches(_shared_of(right, n_parts), n_parts)
        if len(keep):
            windows = ends - starts - least + 1
            offsets = np.cumsum(windows) - windows
            owner = np.repeat(owners, windows)
            base = dict(zip(parts.tolist(), cuts.tolist()))
            for part, kind, raw in zip(right["part"].to_pylist(), right["kind"].to_pylist(), right["data"]):
                if kind == "runs":
                    runs = np.frombuffer(raw.as_buffer(), RUN)
                    own = order[base[part] + runs["stretch"].astype(np.int64)]
                    counts = runs["count"].astype(np.int64)
                    at = np.repeat(offsets[own] + runs["first"], counts) + _ragged(counts)
                    owner[at] = np.minimum(owner[at], np.repeat(runs["owner"], counts))
            first, counts = block.starts[keep], windows[which]
            inner = _ragged(counts)
            marked = np.repeat(block.ids[block.doc[keep]], counts) > owner[np.repeat(offsets[which], counts) + inner]
            at = (np.repeat(first, counts) + inner)[marked]
            np.add.at(gone, at, 1)
            np.add.at(gone, at + least, -1)
        covered = np.cumsum(gone[:-1]) > 0
        doc_ends = np.cumsum(block.sizes)
        edge = np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8))
        begins, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        # a run that goes over a document's end is one run in each document
        inner_ends = doc_ends[:-1][(doc_ends[:-1] > 0) & (doc_ends[:-1] < len(covered))]
        split = np.unique(inner_ends[covered[inner_ends - 1] & covered[inner_ends]]) if len(inner_ends) else inner_ends
        begins, stops = np.sort(np.append(begins, split)), np.sort(np.append(stops, split))
        out, data = [], block.data
        for doc, null, size, end in zip(block.ids.tolist(), block.nulls.tolist(), block.sizes.tolist(), doc_ends.tolist()):
            a, b = np.searchsorted(begins, [end - size, end])
            text = data[end - size : end]
            left_over = text[~covered[end - size : end]].tobytes() if b > a else text.tobytes()
            spans = [{"start": x - end + size, "end": y - end + size} for x, y in zip(begins[a:b].tolist(), stops[a:b].tolist())]
            out.append((None if null else doc, size, spans, left_over if texts else None, hashlib.sha256(left_over).hexdigest()))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*out), RESULT)], schema=RESULT)

    return run


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST, texts: bool = True) -> DataFrame:
    """(doc_id, n_bytes, removed, kept, kept_sha256) for every document.

    ``removed`` holds the maximal removed runs (start, end) in bytes; ``kept`` the remaining bytes unless ``texts`` is false.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    total = docs.agg(F.coalesce(F.sum(utf8_size("text")), F.lit(0))).first()[0]
    n_parts = max(LEAST_PARTS, -(-total // PART_BYTES))
    buckets = max(1, min(MOST_BUCKETS, -(-total // (2 * BLOCK_BYTES))))
    scratch, name = Scratch(spark, "repeats"), f"repeat_blocks_{uuid.uuid4().hex}"
    packed = docs.mapInArrow(_pack(BLOCK_BYTES), "block long, ids binary, nulls binary, sizes binary, text binary")
    packed.write.option("compression", "zstd").option("path", f"{scratch.folder}/blocks").bucketBy(buckets, "block").saveAsTable(name)
    try:
        blocks = spark.table(name)
        # parts have nearly one size; in twice as many tasks, few tasks get two of them
        anchors = blocks.groupBy("block").applyInArrow(_send_anchors(n_parts, least), DDL[id(ANCHORS)]).repartition(2 * n_parts, "part")
        answers = scratch.settle(anchors.groupBy("part").applyInArrow(_answer_anchors, DDL[id(ANSWERS)]), "answers")
        sent = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_send_stretches(n_parts, least), DDL[id(STRETCHES)]).repartition(2 * n_parts, "part")
        runs = scratch.settle(sent.groupBy("part").applyInArrow(_answer_stretches(least), DDL[id(ANSWERS)]), "runs")
        every = answers.union(runs)
        done = blocks.groupBy("block").cogroup(every.groupBy("block")).applyInArrow(_remove(n_parts, least, texts), "doc_id long, n_bytes long, removed array<struct<start: long, end: long>>, kept binary, kept_sha256 string")
        done = scratch.settle(done, "done")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        scratch.drop("blocks", "answers", "runs")
    return done


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that a 50-byte string of an earlier one covers."""
    done = remove_repeats(table(spark, sf_dir, "documents"), texts=False)
    return done.select(
        "doc_id",
        "n_bytes",
        F.aggregate("removed", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"]).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        "kept_sha256",
    )


OP6_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM d, unnest(range(0, greatest(len(h) // 2 - 49, 0))) AS t(i)),
f AS (SELECT s, min(doc_id) AS m FROM w GROUP BY s),
b AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM w JOIN f USING (s) WHERE doc_id > m),
r AS (SELECT doc_id, count(*) AS n_removed, count_if(new) AS n_spans FROM (SELECT doc_id, coalesce(p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) > 1, true) AS new FROM b) GROUP BY 1),
k AS (SELECT doc_id, string_agg(substr(h, 2 * p + 1, 2), '' ORDER BY p) AS kept
  FROM (SELECT doc_id, h, unnest(range(0, len(h) // 2)) AS p FROM d SEMI JOIN r USING (doc_id)) ANTI JOIN b USING (doc_id, p) GROUP BY 1)
SELECT d.doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN r.doc_id IS NULL THEN h ELSE coalesce(kept, '') END)) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id) LEFT JOIN k USING (doc_id)
"""
