"""Benchmark decontamination with a generalised suffix automaton over words.

Normalised benchmark items are dealt into blocks of bounded size, and a block's items are inserted into
one automaton. The words of training documents are streamed through it while the length of the longest
match that ends at each word is tracked; every match of at least ``window`` words marks its words as hit,
and the automaton's state tells the items.

Documents aren't streamed through every block. A first scan hashes their windows and keeps the stretches
of words whose hashes are in a bit table of the benchmark's windows. The table's size is fixed, so what
is broadcast never grows with the benchmark; it lets through every true window and few others. Stretches
go to the blocks that have one of their windows, in groups of bounded size, whatever the number of
documents with one passage. A second scan joins what was found to the documents by a digest of the text,
so equal texts are streamed once.

Defined results: null or wordless texts have no words and no hits; items without words are ignored;
items shorter than the window count as one window of their own length; equal items all count;
the words of items without an id are hit like others', but no item is named for them;
an empty benchmark hits nothing, and an empty table gives no rows. A very long text is hashed in one
worker, at about 40 bytes of memory for each of its bytes. Texts are told apart by MD5. Extra columns
are carried along; an output (or ``text_key``) replaces a column of its name.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.llm import hashing
from folioscope.llm.common import Scratch, make_room, packed, table, unpacked

WINDOW = 13
#: Words of one automaton, on average; about 30 MB in a worker.
BLOCK_WORDS = 40_000
#: Bits of the table of windows (8 MB), in so many slices while it is built; a window sets two bits.
BITS, SLICES = 1 << 26, 64
#: Bytes of stretches that one group of a block has, on average.
GROUP_BYTES = 16_000_000
#: Characters that are hashed in one go.
AT_ONCE = 500_000

#: Word characters: ASCII letters and digits and everything beyond ASCII.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: The same before capitals become small letters, for positions in the text as it is.
RAW_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
#: The same on UTF-8 bytes: capitals become small letters, other characters below 128 become spaces.
NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

SPANS = "array<struct<start: long, end: long>>"


def words_of(text: str | None) -> list[bytes]:
    """Normalised words in UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(NORMAL).split() if text else []


class Automaton:
    """Generalised suffix automaton of word sequences, with the windows' items at its states."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.go: list[dict[bytes, int]] = [{}]
        self.link, self.length = [-1], [0]
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        self.alphabet = set(self.go[0])
        self.shortest = min([window, *(len(w) for _, w in items if w)])
        self._mark(items)

    def _state(self, length: int, link: int, go: dict) -> int:
        self.length.append(length)
        self.link.append(link)
        self.go.append(go)
        return len(self.go) - 1

    def _split(self, p: int, word: bytes, q: int) -> int:
        """The part of state ``q`` that ``p`` reaches by ``word``, as a state of its own."""
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.go[q]))
        self.link[q] = clone
        while p >= 0 and self.go[p].get(word) == q:
            self.go[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: bytes) -> int:
        q = self.go[last].get(word)
        if q is not None:  # an earlier item has this prefix's extension already
            return q if self.length[q] == self.length[last] + 1 else self._split(last, word, q)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and word not in self.go[p]:
            self.go[p][word] = new
            p = self.link[p]
        if p >= 0:
            q = self.go[p][word]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, word, q)
        return new

    def _mark(self, items) -> None:
        order = sorted(range(1, len(self.go)), key=self.length.__getitem__)
        #: of each state, the suffix state that holds its last ``window`` words, or -1
        self.window_state = [-1] * len(self.go)
        for v in order:
            up = self.link[v]
            self.window_state[v] = self.window_state[up] if self.length[up] >= self.window else v if self.length[v] >= self.window else -1
        self.items_at: dict[int, set[str | None]] = {}
        short: dict[int, dict[int, set[str | None]]] = {}
        for item, words in items:
            v = 0
            for word in words:
                v = self.go[v][word]
                if (w := self.window_state[v]) >= 0:
                    self.items_at.setdefault(w, set()).add(item)
            if 0 < len(words) < self.window:
                while self.length[self.link[v]] >= len(words):
                    v = self.link[v]
                short.setdefault(v, {}).setdefault(len(words), set()).add(item)
        self.short = short
        #: of each state, the nearest state on its suffix path (itself included) where a short item ends
        self.short_state = [-1] * len(self.go)
        for v in order if short else ():
            self.short_state[v] = v if v in short else self.short_state[self.link[v]]

    def _runs(self, words: list[bytes]):
        """Maximal ranges of words of the alphabet that can hold a window."""
        known, start = self.alphabet, 0
        flags = bytes(map(known.__contains__, words))
        while (start := flags.find(1, start)) >= 0:
            end = flags.find(0, start)
            end = len(flags) if end < 0 else end
            if end - start >= self.shortest:
                yield start, end
            start = end

    def stream(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Maximal hit ranges of word positions (end exclusive), and the items whose windows occur, those without an id left out."""
        go, link, length, window = self.go, self.link, self.length, self.window
        spans: list[tuple[int, int]] = []
        items: set[str | None] = set()
        for start, end in self._runs(words):
            v = matched = 0
            for i in range(start, end):
                word = words[i]
                while v and word not in go[v]:
                    v = link[v]
                    matched = length[v]
                v = go[v][word]
                matched += 1
                cover = 0
                if matched >= window:
                    cover = matched
                    # the window's state holds it as a suffix of the match; a longer match has it too
                    items |= self.items_at.get(self.window_state[v], ())
                u = self.short_state[v]
                while u > 0:
                    for size, found in self.short[u].items():
                        if size <= matched:
                            items |= found
                            cover = max(cover, size)
                    u = self.short_state[link[u]]
                if cover:
                    first = i + 1 - cover
                    while spans and spans[-1][1] >= first:
                        first = min(first, spans.pop()[0])
                    spans.append((first, i + 1))
        return spans, items - {None}


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _pieces(benchmark: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """Distinct (item, words): items as texts of words; very long ones as overlapping pieces, so that blocks stay bounded."""

    def cut(batches):
        for batch in batches:
            out = []
            for item, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(raw)
                for at in range(0, max(1, len(words) - window + 1), BLOCK_WORDS // 4):
                    piece = words[at : at + BLOCK_WORDS // 4 + window - 1]
                    if piece:
                        out.append((item, len(piece), b" ".join(piece)))
            items, sizes, texts = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(sizes, pa.int64()), pa.array(texts, pa.binary())], ["item", "n", "words"])

    return benchmark.select(F.col(f"`{item_id}`").cast("string"), F.col(f"`{text}`")).mapInArrow(cut, "item string, n long, words binary").distinct()


def _windows(words: np.ndarray, sizes: list[int]):
    """(size, hashes of all runs of so many words), by a chain that each size takes a step further."""
    grams = np.zeros(len(words), np.uint64)
    for i in range(max(sizes, default=0)):
        if i >= len(words):
            return
        grams = hashing.mix(grams[: len(words) - i] * hashing.STEP + words[i:])
        if i + 1 in sizes:
            yield i + 1, grams


def _item_windows(window: int):
    """Pieces to the distinct (size, hash, block) of their windows."""

    def run(batches):
        for batch in batches:
            out = []
            for block, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words, _ = hashing.text_words([raw])
                for size, grams in _windows(words, [min(window, len(words))]):
                    out += [(size, g, block) for g in np.unique(grams).view(np.int64).tolist()]
            sizes, grams, blocks = zip(*out) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int32()), pa.array(grams, pa.int64()), pa.array(blocks, pa.int32())], ["size", "gram", "block"])

    return run


def _bits_of(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(BITS - 1)
    return (grams & mask).astype(np.int64), (grams >> np.uint64(32) & mask).astype(np.int64)


def _bit_slices(batches):
    """The task's windows as slices of the bit table."""
    bits = np.zeros(BITS // 8, np.uint8)
    for batch in batches:
        for at in _bits_of(batch.column(0).to_numpy().view(np.uint64)):
            np.bitwise_or.at(bits, at >> 3, np.uint8(128) >> (at & 7).astype(np.uint8))
    rows = [(i, part.tobytes()) for i, part in enumerate(bits.reshape(SLICES, -1)) if part.any()]
    numbers, parts = zip(*rows) if rows else ((), ())
    yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array(parts, pa.binary())], ["slice", "bits"])


def _union(group: pa.Table) -> pa.Table:
    merged = np.bitwise_or.reduce([np.frombuffer(x.as_buffer(), np.uint8) for x in group["bits"]])
    return pa.table([group["slice"].slice(0, 1), pa.array([merged.tobytes()], pa.binary())], ["slice", "bits"])


class Screen:
    """The bit table and the sizes of the benchmark's windows."""

    def __init__(self, slices: list[tuple[int, bytes]], sizes: list[int]):
        self.sizes, self.table = sizes, np.zeros((SLICES, BITS // 8 // SLICES), np.uint8)
        for i, part in slices:
            self.table[i] = np.frombuffer(part, np.uint8)
        self.table = self.table.ravel()

    def passes(self, grams: np.ndarray) -> np.ndarray:
        """Positions of hashes that may be a window's."""
        one, two = _bits_of(grams)
        left = np.flatnonzero(self.table[one >> 3] >> (7 - (one & 7)).astype(np.uint8) & 1)
        two = two[left]
        return left[(self.table[two >> 3] >> (7 - (two & 7)).astype(np.uint8) & 1) > 0]

    def stretches(self, texts: list[bytes]):
        """For each text with such windows: its index, the stretches (start, words) that they cover, and their hashes."""
        words, bounds = hashing.text_words(texts)
        ends = np.repeat(bounds[1:], np.diff(bounds))
        at, size, gram = [], [], []
        for s, grams in _windows(words, self.sizes):
            found = self.passes(grams)
            found = found[found + s <= ends[found]]
            at.append(found)
            size.append(np.full(len(found), s))
            gram.append(grams[found])
        if not at or not sum(map(len, at)):
            return
        at, size, gram = map(np.concatenate, (at, size, gram))
        which = np.searchsorted(bounds, at, "right") - 1
        order, texts_found, cuts = hashing.by_value(which)
        for i, a, b in zip(texts_found.tolist(), cuts[:-1], cuts[1:]):
            own = order[a:b]
            spans = merge_spans(list(zip((at[own] - bounds[i]).tolist(), (at[own] + size[own] - bounds[i]).tolist())))
            split = texts[i].split()
            yield i, [(s, b" ".join(split[s:e])) for s, e in spans], np.unique(gram[own]).view(np.int64).tolist()


CANDIDATES = pa.schema([("text_key", pa.string()), ("starts", pa.list_(pa.int64())), ("words", pa.list_(pa.binary())), ("grams", pa.list_(pa.int64()))])


def _screened(screen):
    """Texts to the stretches that may hold a window."""

    def run(batches):
        for batch in batches:
            held, chars, rows = [], 0, []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.append((key, text.encode("utf-8", "surrogatepass").translate(NORMAL)))
                chars += len(text)
                if chars > AT_ONCE:
                    rows += _candidates_of(screen.value, held)
                    held, chars = [], 0
            rows += _candidates_of(screen.value, held)
            columns = list(zip(*rows)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, CANDIDATES)], schema=CANDIDATES)

    return run


def _candidates_of(screen: Screen, held: list[tuple[str, bytes]]) -> list[tuple]:
    found = screen.stretches([raw for _, raw in held])
    return [(held[i][0], [s for s, _ in stretches], [w for _, w in stretches], grams) for i, stretches, grams in found]


HITS = pa.schema([("text_key", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("items", pa.list_(pa.string()))])


def _streamed(window: int):
    """One group of stretches through the automaton of its block."""

    def run(stretches: pa.Table, pieces: pa.Table) -> pa.Table:
        if not stretches.num_rows or not pieces.num_rows:
            return HITS.empty_table()
        automaton = Automaton([(i, w.split(b" ")) for i, w in zip(pieces["item"].to_pylist(), pieces["words"].to_pylist())], window)
        rows = []
        for key, starts, texts in zip(*(stretches[c].to_pylist() for c in ("text_key", "starts", "words"))):
            spans, items = [], set()
            for start, text in zip(starts, texts):
                hit, found = automaton.stream(text.split(b" "))
                spans += [{"start": start + a, "end": start + b} for a, b in hit]
                items |= found
            if spans:
                rows.append((key, spans, sorted(items)))
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), HITS)], schema=HITS) if rows else HITS.empty_table()

    return run


def _merged(batches):
    """All blocks' spans of a text as maximal ones, and its items in order."""
    for batch in batches:
        spans = [[{"start": a, "end": b} for a, b in merge_spans([(s["start"], s["end"]) for part in parts for s in part])] for parts in batch.column(1).to_pylist()]
        items = [sorted({i for part in parts for i in part}) for parts in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, HITS.field(1).type), pa.array(items, HITS.field(2).type)], schema=HITS)


def contamination_of_texts(texts: DataFrame, benchmark: DataFrame, scratch: Scratch, item_id: str, item_text: str, window: int) -> DataFrame:
    """(text_key, spans, items) of the texts with hits; ``texts`` has text_key and text."""
    spark = texts.sparkSession
    pieces = _pieces(benchmark, item_id, item_text, window)
    pieces = scratch.settle(pieces, "pieces")
    blocks = max(1, -(-pieces.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] // BLOCK_WORDS))
    pieces = pieces.select("item", "words", F.pmod(F.xxhash64("item", "words"), F.lit(blocks)).cast("int").alias("block"))
    windows = scratch.settle(pieces.select("block", "words").mapInArrow(_item_windows(window), "size int, gram long, block int").distinct(), "windows")
    sizes = sorted(r.size for r in windows.select("size").distinct().collect())  # at most ``window`` numbers
    slices = windows.select("gram").mapInArrow(_bit_slices, "slice int, bits binary").groupBy("slice").applyInArrow(_union, "slice int, bits binary")
    screen = spark.sparkContext.broadcast(Screen([(r.slice, bytes(r.bits)) for r in slices.collect()], sizes))  # BITS bits, whatever the benchmark
    screened = texts.where("text IS NOT NULL").mapInArrow(_screened(screen), "text_key string, starts array<long>, words array<binary>, grams array<long>")
    candidates = scratch.settle(screened.dropDuplicates(["text_key"]), "candidates")
    at = candidates.select("text_key", F.explode("grams").alias("gram")).join(windows.select("gram", "block").distinct(), "gram").select("text_key", "block").distinct()
    size = F.aggregate("words", F.lit(0).cast("long"), lambda s, w: s + F.octet_length(w))
    placed = at.join(candidates.select("text_key", "starts", "words", size.alias("bytes")), "text_key")
    groups = scratch.settle(placed.groupBy("block").agg(F.ceil(F.sum("bytes") / GROUP_BYTES).cast("int").alias("groups")).withColumn("groups", F.greatest("groups", F.lit(1))), "groups")
    dealt = placed.join(groups, "block").select("block", F.pmod(F.xxhash64("text_key"), F.col("groups")).cast("int").alias("turn"), "text_key", "starts", "words")
    every = pieces.join(groups, "block").select("block", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("turn"), "item", "words")
    hits = dealt.groupBy("block", "turn").cogroup(every.groupBy("block", "turn")).applyInArrow(_streamed(window), f"text_key string, spans {SPANS}, items array<string>")
    gathered = hits.groupBy("text_key").agg(F.collect_list("spans").alias("spans"), F.collect_list("items").alias("items"))
    found = scratch.settle(gathered.mapInArrow(_merged, f"text_key string, spans {SPANS}, items array<string>"), "found")
    scratch.drop("pieces", "windows", "candidates", "groups")
    return found


@F.pandas_udf(T.LongType())
def _count_words(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: len(words_of(t))).astype(np.int64)


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with n_words, ``spans`` of hit words (array of start, end) and the distinct ``items`` found, sorted."""
    docs = make_room(docs, "n_words", "spans", "items", "text_key")
    key = F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")).alias("text_key")
    scratch = Scratch(docs.sparkSession, "decontamination")
    found = contamination_of_texts(docs.select(key, F.col(f"`{text}`").alias("text")), benchmark, scratch, item_id, item_text, window)
    return docs.select("*", key, _count_words(F.col(f"`{text}`")).alias("n_words")).join(found, "text_key", "left").select(
        *[F.col(f"`{c}`") for c in docs.columns], "n_words",
        F.coalesce("spans", F.array().cast(SPANS)).alias("spans"), F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def hit_words() -> F.Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["end"] - x["start"])


def contaminated() -> F.Column:
    """Coverage limit: a twentieth of the words are hit."""
    return (hit_words() > 0) & (20 * hit_words() >= F.col("n_words"))


def cut_spans(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """``text`` without the words of ``spans`` and what stands between them."""
    if not spans:
        return text
    at = [m.span() for m in RAW_WORD.finditer(text)]
    out, last = [], 0
    for start, end in spans:
        out.append(text[last : at[start][0]])
        last = at[end - 1][1]
    return "".join([*out, text[last:]])


@F.pandas_udf(T.StringType())
def _cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([None if t is None else cut_spans(t, [(s["start"], s["end"]) for s in found]) for t, found in zip(texts, spans)], dtype=object)


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", min_span: int = WINDOW) -> DataFrame:
    """Drop documents beyond the coverage limit; cut hit spans of ``min_span`` words or more from the others."""
    found = find_contamination(packed(docs, text), benchmark, text).where(~contaminated())
    long = F.filter("spans", lambda s: s["end"] - s["start"] >= min_span)
    hit = F.size(long) > 0
    cut = F.when(hit, _cut(F.when(hit, F.col(f"`{text}`")), long)).otherwise(F.col(f"`{text}`"))
    return unpacked(found, docs.columns, **{text: cut})


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and contamination of every document against the whole benchmark."""
    found = find_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        hit_words().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        contaminated().alias("contaminated"),
    )


OP3_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark),
bw AS (
  SELECT DISTINCT item, least(len(ws), 13) AS size, array_to_string(ws[i : i + least(len(ws), 13) - 1], ' ') AS win
  FROM b, unnest(generate_series(1, greatest(len(ws) - 12, 1))) AS g(i) WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (
  SELECT doc_id, i, size, array_to_string(ws[i : i + size - 1], ' ') AS win
  FROM w, sizes, unnest(generate_series(1, greatest(len(ws) - size + 1, 0))) AS g(i)),
m AS (SELECT doc_id, i, dw.size, item FROM dw JOIN bw USING (size, win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + size - 1)) AS p FROM m) GROUP BY doc_id),
its AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM m GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""
