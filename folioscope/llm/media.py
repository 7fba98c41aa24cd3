"""ISO media containers as columns: box walk, sample tables, codec, duration and keyframe byte ranges of every track.

``media_columns`` reads containers (MP4, MOV, M4A ...) held in a binary column without decoding a
payload: sample tables of ``moov`` and fragments (``moof``) of all tracks, with decoding and composition
times. ``store_samples`` writes bytes losslessly as 8-bit samples of one track, so that the reader can be
exercised on any table.

Defined results: a null container gives a null struct; a damaged or empty one gives a struct whose
``error`` is set and whose tracks are null; repeated rows get equal values; an empty table gives no rows.
Tracks come in the file's order, keyframes in that of their samples. Null text is stored as the empty text. A table
that claims more samples than the file can hold is an error before memory is taken; a container is held in
memory a few times, so a very long one bounds what a worker needs. Extra columns are carried along; the
output replaces a column of its name.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.llm.common import fields, table

#: Bytes of one media sample that ``store_samples`` writes; payloads are padded to a multiple of it.
FRAME = 192
#: Every so many samples one is marked as a sync sample, and so many samples make a chunk.
SYNC_EVERY, PER_CHUNK, TIMESCALE = 16, 64, 8000
# Boxes whose content is boxes.
CONTAINERS = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"edts", b"dinf", b"udta", b"mvex", b"moof", b"traf"}

TRACK = T.StructType(
    [
        *fields("track_id long, handler string, codec string, timescale long, duration long, n_samples long").fields,
        T.StructField("keyframes", T.ArrayType(fields("offset long, size long, time long"))),
        *fields("payload_bytes long, payload_sha256 string, tail_crc32 long").fields,
    ]
)
PROBE = T.StructType([T.StructField("error", T.StringType()), T.StructField("tracks", T.ArrayType(TRACK))])


def _box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    if len(body) + 8 < 1 << 32:
        return struct.pack(">I4s", len(body) + 8, kind) + body
    return struct.pack(">I4sQ", 1, kind, len(body) + 16) + body


#: Durations that stand for an unknown one, by the width of the field.
UNKNOWN_32, UNKNOWN_64 = (1 << 32) - 1, (1 << 64) - 1


def _full(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return _box(kind, struct.pack(">I", version << 24 | flags), *parts)


def write_container(payload: bytes) -> bytes:
    """A container with one track of unsigned 8-bit samples; ``payload`` is a positive multiple of ``FRAME`` bytes."""
    n = len(payload) // FRAME
    ftyp = _box(b"ftyp", b"isom", struct.pack(">I", 512), b"isommp42")
    start = len(ftyp) + (8 if len(payload) + 8 < 1 << 32 else 16)
    firsts = np.arange(0, n, PER_CHUNK, dtype=np.uint64) * FRAME + start
    chunks = len(firsts)
    runs = [(1, min(n, PER_CHUNK))] + ([(chunks, n - (chunks - 1) * PER_CHUNK)] if chunks > 1 and n % PER_CHUNK else [])
    stsc = b"".join(struct.pack(">III", first, per, 1) for first, per in runs)
    wide = int(firsts[-1]) >= 1 << 32
    offsets = firsts.astype(">u8" if wide else ">u4").tobytes()
    sync = np.arange(1, n + 1, SYNC_EVERY, dtype=np.uint32)
    entry = _box(b"raw ", bytes(6), struct.pack(">H", 1), bytes(8), struct.pack(">HHHHI", 1, 8, 0, 0, TIMESCALE << 16))
    stbl = _box(
        b"stbl",
        _full(b"stsd", struct.pack(">I", 1), entry),
        _full(b"stts", struct.pack(">III", 1, n, FRAME)),
        _full(b"stss", struct.pack(">I", len(sync)), sync.astype(">u4").tobytes()),
        _full(b"stsc", struct.pack(">I", len(runs)), stsc),
        _full(b"stsz", struct.pack(">II", FRAME, n)),
        _full(b"co64" if wide else b"stco", struct.pack(">I", chunks), offsets),
    )
    length = n * FRAME
    mdhd = _full(b"mdhd", struct.pack(">QQIQHH", 0, 0, TIMESCALE, length, 0x55C4, 0), version=1)
    hdlr = _full(b"hdlr", bytes(4), b"soun", bytes(12), b"samples\0")
    dinf = _box(b"dinf", _full(b"dref", struct.pack(">I", 1), _full(b"url ", flags=1)))
    minf = _box(b"minf", _full(b"smhd", bytes(4)), dinf, stbl)
    matrix = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)
    tkhd = _full(b"tkhd", struct.pack(">QQIIQ", 0, 0, 1, 0, length), bytes(8), struct.pack(">HHHH", 0, 0, 0x100, 0), matrix, bytes(8), version=1, flags=7)
    mvhd = _full(b"mvhd", struct.pack(">QQIQIH", 0, 0, TIMESCALE, length, 0x10000, 0x100), bytes(10), matrix, bytes(24), struct.pack(">I", 2), version=1)
    moov = _box(b"moov", mvhd, _box(b"trak", tkhd, _box(b"mdia", mdhd, hdlr, minf)))
    return ftyp + _box(b"mdat", payload) + moov


def walk_boxes(data: memoryview):
    """(path, start of the box, start and end of its content) of every box, depth first."""
    open_ranges = [((), 0, len(data))]
    while open_ranges:
        path, at, end = open_ranges.pop()
        if at == end or path[-1:] == (b"udta",) and end - at == 4 and not any(data[at:end]):  # user data may end with a zero
            continue
        if end - at < 8:
            raise ValueError("a box header is cut off")
        size, kind = struct.unpack_from(">I4s", data, at)
        head = 8
        if size == 1:
            if end - at < 16:
                raise ValueError("a large box header is cut off")
            size, head = struct.unpack_from(">Q", data, at + 8)[0], 16
        elif size == 0:
            size = end - at
        if size < head or at + size > end:
            raise ValueError(f"box {kind!r} has a size outside its parent")
        yield (*path, kind), at, at + head, at + size
        open_ranges.append((path, at + size, end))
        if kind in CONTAINERS:
            open_ranges.append(((*path, kind), at + head, at + size))


class _Box:
    """Reads a box's content in order; beyond its end is an error."""

    def __init__(self, data: memoryview, kind: bytes, at: int, end: int):
        self.data, self.kind, self.at, self.end = data, kind, at, end

    def take(self, spec: str) -> tuple:
        size = struct.calcsize(spec)
        if self.at + size > self.end:
            raise ValueError(f"box {self.kind!r} is cut off")
        self.at += size
        return struct.unpack_from(spec, self.data, self.at - size)

    def head(self) -> tuple[int, int]:
        """Version and flags of a full box."""
        (both,) = self.take(">I")
        return both >> 24, both & 0xFFFFFF

    def numbers(self, count: int, width: int = 1, kind: str = ">u4") -> np.ndarray:
        size = count * width * np.dtype(kind).itemsize
        if self.at + size > self.end:
            raise ValueError(f"a table in {self.kind!r} is cut off")
        self.at += size
        return np.frombuffer(self.data, kind, count * width, self.at - size).astype(np.int64).reshape(count, width)


class Track:
    """One track's description, sample tables and, once placed, samples."""

    def __init__(self):
        self.id = self.timescale = self.duration = self.codec = self.handler = self.sizes = None
        self.tables: dict[bytes, np.ndarray] = {}
        self.samples: list[np.ndarray] = []  # columns: offset, size, composition time, duration, whether a keyframe
        self.next_time = 0

    def read(self, box: _Box, limit: int) -> None:
        kind = box.kind
        if kind == b"tkhd":
            version, _ = box.head()
            self.id = box.take(">QQI" if version == 1 else ">III")[2]
        elif kind == b"mdhd":
            version, _ = box.head()
            _, _, self.timescale, self.duration = box.take(">QQIQ" if version == 1 else ">IIII")
            if self.duration == (UNKNOWN_64 if version == 1 else UNKNOWN_32):
                self.duration = None  # not stated: the sum of the samples' durations counts
        elif kind == b"hdlr":
            self.handler = box.take(">8s4s")[1].decode("latin-1")
        elif kind == b"stsd":
            self.codec = box.take(">8sI4s")[2].decode("latin-1")
        elif kind in (b"stts", b"ctts", b"stsc", b"stss", b"stco", b"co64"):
            version, _ = box.head()
            (count,) = box.take(">I")
            found = box.numbers(count, {b"stts": 2, b"ctts": 2, b"stsc": 3}.get(kind, 1), ">u8" if kind == b"co64" else ">u4")
            if kind == b"ctts" and version == 1:  # signed offsets
                found[:, 1] = found[:, 1].astype(np.uint32).view(np.int32)
            self.tables[kind] = found
        elif kind == b"stsz":
            _, same, count = box.take(">III")
            if same and same * count > limit:
                raise ValueError("the samples are larger than the file")
            self.sizes = np.full(count, same, np.int64) if same else box.numbers(count)[:, 0]
        elif kind == b"stz2":
            _, bits, count = box.take(">III")
            if bits not in (4, 8, 16):
                raise ValueError(f"samples sizes of {bits} bits")
            if bits == 4:
                pairs = box.numbers((count + 1) // 2, 1, "u1")[:, 0]
                self.sizes = np.column_stack([pairs >> 4, pairs & 15]).ravel()[:count]
            else:
                self.sizes = box.numbers(count, 1, "u1" if bits == 8 else ">u2")[:, 0]

    def place(self, fragmented: bool) -> None:
        """Samples of the sample tables."""
        if missing := [n for n in ("timescale", "codec", "sizes") if getattr(self, n) is None]:
            raise ValueError(f"a track lacks {missing}")
        sizes = self.sizes
        runs, chunks = self.tables.get(b"stsc"), self.tables.get(b"co64", self.tables.get(b"stco"))
        if runs is None or chunks is None:
            if fragmented and not len(sizes):
                return
            raise ValueError("a track lacks its chunk tables")
        chunks = chunks[:, 0]
        ends = np.append(runs[1:, 0] - 1, len(chunks)) if len(runs) else np.zeros(0, np.int64)
        repeats = ends - (runs[:, 0] - 1)
        if (repeats < 0).any() or (len(runs) and runs[0, 0] != 1) or repeats.sum() > len(chunks):
            raise ValueError("the sample-to-chunk table isn't in order")
        in_chunk = np.repeat(runs[:, 1], repeats)
        if in_chunk.sum() != len(sizes):
            raise ValueError("the sample tables disagree on the number of samples")
        before = np.concatenate([[0], np.cumsum(sizes)])
        first = np.cumsum(in_chunk) - in_chunk
        offsets = before[:-1] - np.repeat(before[first], in_chunk) + np.repeat(chunks, in_chunk)
        duration = self._spread(b"stts", len(sizes), fragmented or not len(sizes))
        late = self._spread(b"ctts", len(sizes), True)
        sync = self.tables.get(b"stss")
        key = np.full(len(sizes), sync is None)
        if sync is not None and len(sync):
            if not 1 <= sync.min() <= sync.max() <= len(sizes):
                raise ValueError("a sync sample doesn't exist")
            key[sync[:, 0] - 1] = True
        start = np.cumsum(duration) - duration
        self.samples.append(np.column_stack([offsets, sizes, start + late, duration, key]))
        self.next_time = int(duration.sum())

    def _spread(self, kind: bytes, n: int, optional: bool) -> np.ndarray:
        """A run-length table's value for each sample."""
        table = self.tables.get(kind)
        if table is None:
            if optional:
                return np.zeros(n, np.int64)
            raise ValueError("a track lacks its times")
        if table[:, 0].sum() != n:
            raise ValueError("the time tables disagree on the number of samples")
        return np.repeat(table[:, 1], table[:, 0])


class _Fragment:
    """What a track fragment's boxes say until its runs are read."""

    def __init__(self, moof: int, base: int):
        self.moof, self.base, self.at, self.track, self.time = moof, base, base, None, None
        self.duration = self.size = self.flags = 0

    def read_header(self, box: _Box, tracks: dict, defaults: dict) -> None:
        _, flags = box.head()
        (number,) = box.take(">I")
        if number not in tracks:
            raise ValueError(f"a fragment of track {number}, which doesn't exist")
        self.track = tracks[number]
        self.duration, self.size, self.flags = defaults.get(number, (0, 0, 0))
        if flags & 0x1:
            (self.base,) = box.take(">Q")
        elif flags & 0x20000:
            self.base = self.moof
        self.at = self.base
        if flags & 0x2:
            box.take(">I")
        if flags & 0x8:
            (self.duration,) = box.take(">I")
        if flags & 0x10:
            (self.size,) = box.take(">I")
        if flags & 0x20:
            (self.flags,) = box.take(">I")

    def read_run(self, box: _Box, limit: int) -> None:
        if self.track is None:
            raise ValueError("a run without a fragment's header")
        version, flags = box.head()
        (count,) = box.take(">I")
        at = self.base + box.take(">i")[0] if flags & 0x1 else self.at  # without an offset, behind the run before
        first = box.take(">I")[0] if flags & 0x4 else None
        columns = [bit for bit in (0x100, 0x200, 0x400, 0x800) if flags & bit]
        if not columns and count * max(1, self.size) > limit:
            raise ValueError("a run's samples are larger than the file")
        table = box.numbers(count, len(columns)) if columns else np.zeros((count, 0), np.int64)
        given = dict(zip(columns, table.T))
        size, duration, flag = (given[b] if b in given else np.full(count, d, np.int64) for b, d in ((0x200, self.size), (0x100, self.duration), (0x400, self.flags)))
        late = given.get(0x800, np.zeros(count, np.int64))
        late = late.astype(np.uint32).view(np.int32).astype(np.int64) if version else late
        key = flag & 0x10000 == 0
        if first is not None and count:
            key[0] = first & 0x10000 == 0
        start = (self.track.next_time if self.time is None else self.time) + np.cumsum(duration) - duration
        self.track.samples.append(np.column_stack([at + np.cumsum(size) - size, size, start + late, duration, key]))
        self.time = self.track.next_time = int(start[-1] + duration[-1]) if count else self.time or self.track.next_time
        self.at = at + int(size.sum())


def read_tracks(data: bytes) -> list[Track]:
    """All tracks with their samples, those of the sample tables first, then those of fragments."""
    view, tracks, defaults = memoryview(data), [], {}
    boxes = list(walk_boxes(view))
    for path, _, at, end in boxes:
        if path[-1] == b"trak":
            tracks.append(Track())
        elif b"trak" in path[:-1] and path[-1] not in CONTAINERS:
            tracks[-1].read(_Box(view, path[-1], at, end), len(data))
        elif path[-1] == b"trex":
            _, number, _, duration, size, flags = _Box(view, b"trex", at, end).take(">6I")
            defaults[number] = duration, size, flags
    fragmented = any(path[-1] == b"mvex" for path, *_ in boxes)
    for track in tracks:
        track.place(fragmented)
    known, moof, fragment = {t.id: t for t in tracks}, 0, None
    for path, start, at, end in boxes:
        kind = path[-1]
        if kind == b"moof":
            moof, fragment = start, None
        elif kind == b"traf":
            fragment = _Fragment(moof, fragment.at if fragment else moof)
        elif b"traf" in path and fragment:
            box = _Box(view, kind, at, end)
            if kind == b"tfhd":
                fragment.read_header(box, known, defaults)
            elif kind == b"tfdt":
                fragment.time = box.take(">Q" if box.head()[0] else ">I")[0]
            elif kind == b"trun":
                fragment.read_run(box, len(data))
    for track in tracks:
        every = np.concatenate(track.samples) if track.samples else np.zeros((0, 5), np.int64)
        if len(every) and (every[:, 0].min() < 0 or (every[:, 0] + every[:, 1]).max() > len(data)):
            raise ValueError("a sample lies outside the file")
        track.samples = every
    return tracks


def _read_samples(data: bytes, offsets: np.ndarray, sizes: np.ndarray) -> bytes:
    """The samples' bytes in order; neighbours are read as one range."""
    if not len(sizes):
        return b""
    if sizes.sum() > len(data):
        raise ValueError("the samples are larger than the file")
    breaks = np.flatnonzero(offsets[1:] != offsets[:-1] + sizes[:-1]) + 1
    starts = np.concatenate([[0], breaks])
    lasts = np.concatenate([breaks, [len(sizes)]]) - 1
    view = memoryview(data)
    return b"".join(view[a:b] for a, b in zip(offsets[starts].tolist(), (offsets[lasts] + sizes[lasts]).tolist()))


def _described(data: bytes, track: Track) -> dict:
    offsets, sizes, times, durations, key = track.samples.T
    key = key.astype(bool)
    payload = _read_samples(data, offsets, sizes)
    return {
        "track_id": track.id,
        "handler": track.handler,
        "codec": track.codec,
        "timescale": track.timescale,
        "duration": track.duration or int(durations.sum()),
        "n_samples": len(sizes),
        "keyframes": [{"offset": a, "size": b, "time": t} for a, b, t in zip(offsets[key].tolist(), sizes[key].tolist(), times[key].tolist())],
        "payload_bytes": len(payload),
        "payload_sha256": hashlib.sha256(payload).hexdigest(),
        "tail_crc32": zlib.crc32(payload[-16:]),
    }


def _probe(data: bytes | None) -> dict | None:
    if data is None:
        return None
    try:
        tracks = [_described(data, t) for t in read_tracks(data)]
        if not tracks:
            raise ValueError("no track")
        if any(not 0 <= t[k] < 1 << 63 for t in tracks for k in ("duration", "track_id", "timescale") if t[k] is not None):
            raise ValueError("a number is out of range")
    except (ValueError, OverflowError) as damaged:
        return {"error": str(damaged), "tracks": None}
    return {"error": None, "tracks": tracks}


@F.pandas_udf(PROBE)
def _probe_all(media: pd.Series) -> pd.DataFrame:
    rows = [_probe(x) or {} for x in media]
    return pd.DataFrame({n: pd.Series([r.get(n) for r in rows], dtype=object) for n in PROBE.names})


@F.pandas_udf(T.BinaryType())
def _store_all(text: pd.Series) -> pd.Series:
    def one(x: str | None) -> bytes:
        raw = (x or "").encode()
        return write_container(raw + b" " * (max(FRAME, -(-len(raw) // FRAME) * FRAME) - len(raw)))

    return text.map(one)


def store_samples(text: Column) -> Column:
    """The container that holds a text's UTF-8 bytes, padded with spaces to a positive multiple of ``FRAME``."""
    return _store_all(F.coalesce(text, F.lit("")))


def media_columns(df: DataFrame, media: str, name: str = "media_info") -> DataFrame:
    """``df`` with a struct ``name`` of an error and the tracks' properties; null where ``media`` is null."""
    info = F.when(F.col(f"`{media}`").isNotNull(), _probe_all(F.col(f"`{media}`")))
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() != name.lower()], info.alias(name))


def op1_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document stored in a container and read back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    stored = docs.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), store_samples(F.col("text")).alias("media"))
    ranges = F.array_join(F.transform("t.keyframes", lambda k: F.concat_ws("+", k["offset"].cast("string"), k["size"].cast("string"))), ",")
    return media_columns(stored, "media", "i").withColumn("t", F.get("i.tracks", 0)).select(
        "doc_id",
        "n_bytes",
        "t.payload_bytes",
        "t.payload_sha256",
        "t.tail_crc32",
        F.octet_length("media").cast("long").alias("media_bytes"),
        F.sha2("media", 256).alias("media_sha256"),
        F.concat_ws(
            ";",
            F.concat(F.lit("codec="), F.trim("t.codec")),
            F.concat(F.lit("duration="), (F.col("t.duration") / F.col("t.timescale")).cast("decimal(20,6)").cast("string")),
            F.concat(F.lit("samples="), F.col("t.n_samples").cast("string")),
            F.concat(F.lit("keyframes="), ranges),
        ).alias("feature"),
    )
