"""N-gram Jaccard join by vertical partitioning.

Every document is a set of word n-grams; documents with equal sets form a class, and only one set
per class takes part. The global order of n-grams (their 64-bit hashes) is cut into fragments.
Counts are partial within a fragment and summed afterwards:

1. Frequencies. A task holds some texts' sets at a time (a batch) and sends every distinct n-gram of
   the batch once to its fragment, with a short number for its owner; an n-gram that several sets of
   the batch have goes as one entry with its count, so what a fragment gets of a hot n-gram grows
   with the batches and not with the sets. The fragment answers with the frequency of those that two
   sets or more have. Summed per set over the fragments, a set with too few shared n-grams to reach
   the threshold with anybody goes no further.
2. Cells. A set's rarest shared n-grams, as many as its allowed misses and one more, must include
   one of each partner; sets with such an n-gram in common whose sizes allow the threshold are
   chained, and chained sets lie in one cell. Cells only tell which sets are compared at all.
3. Overlaps. The n-grams of a cell's sets are cut by strips of the global fragments. A task takes one
   strip of some cells (or of two blocks of a large cell) and counts the partial overlap of every
   pair of sets there; partial overlaps are summed per pair over the strips and compared with the
   threshold in integers. Pairs travel as positions in an array of counts, not as rows.

Nothing is capped. A cell that grows with the corpus costs the square of its size, in counts of four
bytes, spread over units of two blocks.

The documents are read twice, in any order and split: first for the sets, then for the classes.

Defined results: null, empty and wordless texts have the empty set and are linked with nothing;
fewer words than the n-gram size make one n-gram of the whole; repeated rows are copies of each
other; rows with a null id get the smallest id of their component, null where all its ids are null;
an empty table gives no rows; extra columns play no part. A very long text is one set of any size, its n-grams spread over the
fragments; a worker holds about 60 bytes per word of it. Words and n-grams are compared by 64-bit
hashes (a mixed chain over words' bytes, over long words BLAKE2b, and over n-grams' words), taken as
random: two different ones then agree with probability 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioscope.llm import hashing
from folioscope.llm.common import Scratch, fields, table, utf8_size
from folioscope.llm.components import components

SIZE, PERCENT = 4, 85
#: Text bytes of one fragment (an n-gram comes from about seven bytes).
FRAGMENT_BYTES = 4_000_000
LEAST_FRAGMENTS = 16
#: n-grams of one batch of sets.
HELD = 300_000
#: Keys of sets that a task remembers to have passed on; copies of them aren't sent again.
REMEMBERED = 100_000
#: Characters that are hashed in one go, about 40 bytes of memory each.
AT_ONCE = 500_000
#: n-grams and sets of one block of a cell, and columns of one product of counts.
BLOCK_TOKENS, BLOCK_SETS, COLUMNS = 300_000, 600, 2_048
#: Strips of the global order in which overlaps are counted.
STRIPS = 8

#: ASCII capitals become small letters.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
LAST = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(texts: list[str | None], size: int = SIZE) -> list[np.ndarray]:
    """The sorted distinct n-gram hashes of each text; a few texts are hashed at once, by their length."""
    out, held, chars = [], [], 0
    for text in texts:
        held.append(text)
        chars += len(text or "")
        if chars > AT_ONCE:
            out += _sets_of(held, size)
            held, chars = [], 0
    return out + _sets_of(held, size)


def _sets_of(texts: list[str | None], size: int) -> list[np.ndarray]:
    words, bounds = hashing.text_words([(t or "").encode("utf-8", "surrogatepass").translate(LOWER) for t in texts])
    grams = hashing.chain(words, size) if len(words) >= size else words[:0]
    return [np.unique(grams[a : b - size + 1] if b - a >= size else hashing.chain(words[a:b], b - a)[: b - a]) for a, b in zip(bounds[:-1], bounds[1:])]


def class_key(grams: np.ndarray) -> int:
    """A key of the set as a whole."""
    if not len(grams):
        return 0
    total = hashing.mix(grams ^ LAST).sum(dtype=np.uint64, keepdims=True) + np.array([len(grams)], np.uint64) * hashing.STEP
    return int(hashing.mix(total)[0].astype(np.int64))


def set_columns(docs: DataFrame, size: int = SIZE, text: str = "text") -> DataFrame:
    """``docs`` without its text, with n_shingles and ``set_key``, equal for equal sets."""

    @F.pandas_udf(fields("n_shingles long, set_key long"))
    def keys(texts: pd.Series) -> pd.DataFrame:
        rows = [(len(s), class_key(s)) for s in shingle_sets(list(texts), size)]
        return pd.DataFrame(rows, columns=["n_shingles", "set_key"], dtype=np.int64)

    kept = [F.col(f"`{c}`") for c in docs.columns if c != text and c.lower() not in ("n_shingles", "set_key", "_set")]
    return docs.select(*kept, keys(F.col(f"`{text}`")).alias("_set")).select(*kept, "_set.*")


def _rows(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema) if rows else schema.empty_table()


def _read(cells, kind: str) -> np.ndarray:
    """All values of binary cells, one after another."""
    found = [np.frombuffer(x.as_buffer(), kind) for x in cells if x.is_valid]
    return np.concatenate(found) if found else np.zeros(0, kind)


SENT = pa.schema([("part", pa.int32()), ("batch", pa.int64()), ("owners", pa.binary()), ("counts", pa.binary()), ("tokens", pa.binary())])
SENT_DDL = "part int, batch long, owners binary, counts binary, tokens binary"
#: Of a batch's sets: key and size. An owner number from ``SLOTS`` on is that of an n-gram with several owners in the batch.
SET = np.dtype([("key", "<i8"), ("n", "<i8")])
SLOTS = np.uint32(1 << 31)


def _sent_of(batch: int, held: dict[int, np.ndarray], n_fragments: int) -> pa.RecordBatch:
    """Rows of one batch: the distinct n-grams by fragment, and one row without tokens that holds the sets and who owns the repeated n-grams."""
    sets = np.zeros(len(held), SET)
    sets["key"], sets["n"] = list(held), [len(s) for s in held.values()]
    tokens = np.concatenate(list(held.values()))
    owners = np.repeat(np.arange(len(held), dtype=np.uint32), sets["n"])
    order, distinct, cuts = hashing.by_value(tokens)
    owners, counts = owners[order], np.diff(cuts).astype(np.uint32)
    several = counts > 1
    sender = np.where(several, SLOTS + np.cumsum(several, dtype=np.uint32) - np.uint32(1), owners[cuts[:-1]])
    parts = (distinct >> np.uint64(40)) * np.uint64(n_fragments) >> np.uint64(24)
    edges = np.searchsorted(parts, np.arange(n_fragments + 1, dtype=np.uint64))  # tokens are in order, and so are their parts
    rows = [(p, batch, sender[a:b].tobytes(), counts[a:b].tobytes(), distinct[a:b].tobytes()) for p, (a, b) in enumerate(zip(edges[:-1], edges[1:])) if a < b]
    repeated = np.repeat(several, counts)
    rows.append((batch % n_fragments, batch, owners[repeated].tobytes() + counts[several].tobytes(), sets.tobytes(), None))
    return _rows(SENT, rows).combine_chunks().to_batches()[0]


def _batches(n_fragments: int, size: int, most: int):
    """Texts to fragments."""

    def run(batches: Iterator[pa.RecordBatch]):
        number = TaskContext.get().partitionId() << 24
        held: dict[int, np.ndarray] = {}
        sent: set[int] = set()
        total = 0
        for batch in batches:
            for s in shingle_sets(batch.column(0).to_pylist(), size):
                if len(s) and (key := class_key(s)) not in sent:
                    sent.add(key)
                    held[key] = s
                    total += len(s)
                if total > most:
                    yield _sent_of(number, held, n_fragments)
                    number, held, total = number + 1, {}, 0
                    if len(sent) > REMEMBERED:
                        sent.clear()
        if held:
            yield _sent_of(number, held, n_fragments)

    return run


ANSWER = pa.schema([("batch", pa.int64()), ("fragment", pa.int32()), ("owners", pa.binary()), ("numbers", pa.binary()), ("scale", pa.binary())])
ANSWER_DDL = "batch long, fragment int, owners binary, numbers binary, scale binary"


def _shared(key: tuple[pa.Scalar, ...], group: pa.Table) -> pa.Table:
    """One fragment: which n-grams two sets or more have, numbered, with their frequency, back to the batches; rows of sets pass through."""
    is_batch = group["tokens"].is_valid().to_numpy()
    rows = [(b, -1, o, None, c) for b, o, c in zip(*(group[n].filter(~is_batch).to_pylist() for n in ("batch", "owners", "counts")))]
    group = group.filter(is_batch)
    tokens, owners, counts = _read(group["tokens"], "<u8"), _read(group["owners"], "<u4"), _read(group["counts"], "<u4")
    order, _, cuts = hashing.by_value(tokens)
    frequency = np.add.reduceat(counts[order], cuts[:-1], dtype=np.int64) if len(tokens) else np.zeros(0, np.int64)
    run_of = np.empty(len(tokens), np.int64)
    run_of[order] = np.repeat(np.arange(len(frequency)), np.diff(cuts))
    shared = frequency > 1
    number = (np.cumsum(shared) - 1).astype(np.uint32)
    scale = np.minimum(255, np.ceil(8 * np.log2(np.maximum(frequency, 1)))).astype(np.uint8)
    ends = np.cumsum([0, *(len(x.as_buffer()) // 8 for x in group["tokens"])])
    for batch, a, b in zip(group["batch"].to_pylist(), ends[:-1], ends[1:]):
        own = run_of[a:b]
        keep = shared[own]
        if keep.any():
            rows.append((batch, key[0].as_py(), owners[a:b][keep].tobytes(), number[own[keep]].tobytes(), scale[own[keep]].tobytes()))
    return _rows(ANSWER, rows)


ALIVE = pa.schema([("set_key", pa.int64()), ("n", pa.int64()), ("prefix", pa.int64()), ("tokens", pa.binary())])
ALIVE_DDL = "set_key long, n long, prefix long, tokens binary"


def _alive(percent: int):
    """One batch: its sets that can have a partner, with their shared n-grams, rarest first."""

    def run(group: pa.Table) -> pa.Table:
        is_sets = (group["fragment"].to_numpy() == -1)
        home = group.filter(is_sets)
        group = group.filter(~is_sets)
        sets = np.frombuffer(home["scale"][0].as_buffer(), SET)
        known = np.frombuffer(home["owners"][0].as_buffer(), "<u4")
        owners, numbers, scale = _read(group["owners"], "<u4"), _read(group["numbers"], "<u4"), _read(group["scale"], "u1")
        per_row = [len(x.as_buffer()) for x in group["scale"]]
        ids = np.repeat(group["fragment"].to_numpy().astype(np.uint64), per_row) << np.uint64(32) | numbers
        # n-grams with several owners: every slot was sent and is shared, so its owners' number is known from the end of the list
        slots = owners >= SLOTS
        n_slots = int(slots.sum())
        counts = known[len(known) - n_slots :].astype(np.int64)
        begins = np.cumsum(counts) - counts
        slot = (owners[slots] - SLOTS).astype(np.int64)
        times = counts[slot]
        inner = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        owner = np.concatenate([owners[~slots], known[np.repeat(begins[slot], times) + inner]]).astype(np.int64)
        ids = np.concatenate([ids[~slots], np.repeat(ids[slots], times)])
        scale = np.concatenate([scale[~slots], np.repeat(scale[slots], times)])
        n = sets["n"]
        total = np.bincount(owner, minlength=len(sets))
        alive = 100 * total >= percent * n
        keep = alive[owner]
        order = np.lexsort((ids[keep], scale[keep], owner[keep]))
        ids = ids[keep][order]
        ends = np.cumsum(total[alive])
        misses = n - -(-percent * n // 100)
        prefix = misses - (n - total) + 1
        tokens = [ids[e - t : e].tobytes() for e, t in zip(ends.tolist(), total[alive].tolist())]
        return pa.table([pa.array(sets["key"][alive]), pa.array(n[alive]), pa.array(prefix[alive]), pa.array(tokens, pa.binary())], schema=ALIVE)

    return run


#: Chained sets of a task: the n-gram, one set's key, and the least and greatest size.
CHAIN = np.dtype([("token", "<u8"), ("key", "<i8"), ("low", "<i8"), ("high", "<i8")])
LINKS = pa.schema([("u", pa.int64()), ("v", pa.int64())])
CHAINS = pa.schema([("part", pa.int32()), ("chains", pa.binary()), ("links", pa.binary())])


def chained(found: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Chains of one n-gram whose sizes are near enough become one; and the links (u, v) that say so.

    Sets of sizes a <= b can reach the threshold only if 100 * a >= percent * b. All sizes between those
    of two such sets are near each other too, so linking neighbours in the order of sizes loses nobody.
    """
    found = found[np.lexsort((found["key"], found["low"], found["token"]))]
    if not len(found):
        return found, np.zeros((0, 2), np.int64)
    first = np.flatnonzero(np.concatenate([[True], found["token"][1:] != found["token"][:-1]]))
    # running greatest size within each n-gram: n-grams are raised above each other
    rank = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(found))))
    lift = rank * (int(found["high"].max()) + 1)
    reach = np.maximum.accumulate(found["high"] + lift) - lift
    joins = np.zeros(len(found), bool)
    joins[1:] = (rank[1:] == rank[:-1]) & (100 * reach[:-1] >= percent * found["low"][1:])
    begins = np.flatnonzero(~joins)
    out = found[begins]
    out["high"] = np.maximum.reduceat(found["high"], begins)
    links = np.column_stack([found["key"], np.repeat(out["key"], np.diff(np.append(begins, len(found))))])
    return out, links[links[:, 0] != links[:, 1]]


def _prefixes(n_parts: int, percent: int):
    """Sets to the parts of their prefix n-grams, chained within the task first."""

    def run(batches):
        for batch in batches:
            sizes = batch.column(1).to_numpy()
            found = [np.frombuffer(x.as_buffer(), "<u8")[:k] for x, k in zip(batch.column(3), batch.column(2).to_pylist())]
            if not found:
                continue
            lengths = [len(f) for f in found]
            chains = np.zeros(sum(lengths), CHAIN)
            chains["token"], chains["key"] = np.concatenate(found), np.repeat(batch.column(0).to_numpy(), lengths)
            chains["low"] = chains["high"] = np.repeat(sizes, lengths)
            chains, links = chained(chains, percent)
            parts = (hashing.mix(chains["token"]) % np.uint64(n_parts)).astype(np.int32)
            order, distinct, cuts = hashing.by_value(parts)
            links = np.unique(links, axis=0).tobytes()
            rows = [(p, chains[order[a:b]].tobytes(), links if not i else None) for i, (p, a, b) in enumerate(zip(distinct.tolist(), cuts[:-1], cuts[1:]))]
            if rows:
                yield from _rows(CHAINS, rows).to_batches()

    return run


def _candidates(percent: int):
    """One part of the prefix n-grams: links between sets that have one in common."""

    def run(group: pa.Table) -> pa.Table:
        _, links = chained(_read(group["chains"], CHAIN), percent)
        links = np.unique(np.concatenate([links, _read(group["links"], "<i8").reshape(-1, 2)]), axis=0)
        return pa.table([links[:, 0].copy(), links[:, 1].copy()], schema=LINKS)

    return run


STRIP = pa.schema([("unit", pa.int64()), ("strip", pa.int32()), ("block", pa.int32()), ("cell", pa.int64()), ("set_key", pa.int64()), ("n", pa.int64()), ("tokens", pa.binary())])
STRIP_DDL = "unit long, strip int, block int, cell long, set_key long, n long, tokens binary"


def _strips(n_fragments: int):
    """A set's n-grams cut by strips of the global fragments; a set has a row in every strip, so that all strips count the same pairs."""

    def run(batches):
        for batch in batches:
            rows = []
            for *own, tokens in zip(*(batch.column(i).to_pylist() for i in range(5)), batch.column(5)):
                ids = np.frombuffer(tokens.as_buffer(), "<u8")
                strip = (ids >> np.uint64(32)) * np.uint64(STRIPS) // np.uint64(n_fragments)
                rows += [(own[0], s, *own[1:], ids[strip == s].tobytes()) for s in range(STRIPS)]
            yield from _rows(STRIP, rows).to_batches()

    return run


#: A set's place in a unit.
PLACE = np.dtype([("cell", "<i8"), ("block", "<i4"), ("key", "<i8"), ("n", "<i8")])


def _pair_blocks(places: np.ndarray):
    """(left, right) index arrays of the sets of each cell that are paired: of two blocks one with the other, of one all with all."""
    _, _, cuts = hashing.by_value(places["cell"])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        own = np.arange(a, b)
        low, high = places["block"][a:b].min(), places["block"][a:b].max()
        yield (own, own) if low == high else (own[places["block"][a:b] == low], own[places["block"][a:b] == high])


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many n-grams each left and each right set have in common."""
    total = np.zeros((len(left), len(right)), np.int64)
    owner = np.repeat(np.arange(len(left) + len(right)), [len(t) for t in (*left, *right)])
    distinct, column = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    for start in range(0, len(distinct), COLUMNS):  # a product's counts are below 2**24, so they are exact
        inside = (column >= start) & (column < start + COLUMNS) if len(distinct) > COLUMNS else slice(None)
        part = np.zeros((len(left) + len(right), min(COLUMNS, len(distinct) - start)), np.float32)
        part[owner[inside], column[inside] - start] = 1
        total += (part[: len(left)] @ part[len(left) :].T).astype(np.int64)
    return total


PARTIAL = pa.schema([("unit", pa.int64()), ("sets", pa.binary()), ("counts", pa.binary())])


def _partial(group: pa.Table) -> pa.Table:
    """One strip of one unit: the partial overlaps of all its pairs, in the order of ``_pair_blocks``."""
    group = group.sort_by([("cell", "ascending"), ("block", "ascending"), ("set_key", "ascending")])
    places = np.zeros(group.num_rows, PLACE)
    for name, column in (("cell", "cell"), ("block", "block"), ("key", "set_key"), ("n", "n")):
        places[name] = group[column].to_numpy()
    tokens = [np.frombuffer(x.as_buffer(), "<u8") for x in group["tokens"]]
    counts = [overlaps([tokens[i] for i in a], [tokens[i] for i in b]).astype("<u4").tobytes() for a, b in _pair_blocks(places)]
    return _rows(PARTIAL, [(group["unit"][0].as_py(), places.tobytes() if group["strip"][0].as_py() == 0 else None, b"".join(counts))])


def smallest_reachable(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of each of n nodes the smallest node that links (a, b) reach."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = np.minimum(new, new[label])
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


FOUND = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("links", pa.int64())])


def linked(inter: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of sizes a and b with these overlaps reach the threshold, in integers."""
    inter = inter.astype(np.int64)
    return 100 * inter >= percent * (a[:, None] + b[None, :] - inter)


def _summed(percent: int):
    """One unit: partial overlaps summed per pair; of every set the smallest one that its links reach here, and how many links it has here."""

    def run(group: pa.Table) -> pa.Table:
        places = np.frombuffer(next(x for x in group["sets"] if x.is_valid).as_buffer(), PLACE)
        total = sum(np.frombuffer(x.as_buffer(), "<u4").astype(np.int64) for x in group["counts"])
        us, vs, at = [], [], 0
        for a, b in _pair_blocks(places):
            inter = total[at : at + len(a) * len(b)].reshape(len(a), len(b))
            at += inter.size
            hit = linked(inter, places["n"][a], places["n"][b], percent)
            if a is b:
                hit = np.triu(hit, 1)
            i, j = np.nonzero(hit)
            us.append(a[i])
            vs.append(b[j])
        u, v = np.concatenate(us), np.concatenate(vs)
        label = smallest_reachable(len(places), u, v)
        degree = np.bincount(u, minlength=len(places)) + np.bincount(v, minlength=len(places))
        own = degree > 0
        return pa.table([places["key"][own], places["key"][label[own]], degree[own]], schema=FOUND)

    return run


def linked_sets(docs: DataFrame, scratch: Scratch, text: str = "text", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """(set_key, component, links): sets that are linked with a different one, their component's smallest key, and their number of links."""
    total = docs.agg(F.coalesce(F.sum(utf8_size(text)), F.lit(0))).first()[0]
    fragments = max(LEAST_FRAGMENTS, -(-total // FRAGMENT_BYTES))
    sent = docs.select(F.col(f"`{text}`")).mapInArrow(_batches(fragments, size, HELD), SENT_DDL)
    # fragments have nearly one size; in twice as many tasks, few tasks get two of them
    answers = sent.repartition(2 * fragments, "part").groupBy("part").applyInArrow(_shared, ANSWER_DDL)
    # a set that several tasks have sent comes back from each of them
    alive = scratch.settle(answers.groupBy("batch").applyInArrow(_alive(percent), ALIVE_DDL).dropDuplicates(["set_key"]), "alive")
    chains = alive.mapInArrow(_prefixes(fragments, percent), "part int, chains binary, links binary")
    cells = components(chains.groupBy("part").applyInArrow(_candidates(percent), "u long, v long"), scratch, "cells")
    placed = scratch.settle(alive.join(cells.toDF("set_key", "cell"), "set_key").select("cell", "set_key", "n", "tokens"), "placed")
    scratch.drop("alive", "cells")
    sizes = placed.groupBy("cell").agg((F.sum(F.octet_length("tokens")) / 8).alias("grams"), F.count("*").alias("sets"))
    blocks = F.greatest(F.ceil(F.col("grams") / BLOCK_TOKENS), F.ceil(F.col("sets") / BLOCK_SETS)).cast("int")
    sizes = scratch.settle(sizes.select("cell", "grams", blocks.alias("blocks")), "sizes")
    units = max(1, -(-int(sizes.agg(F.coalesce(F.sum("grams"), F.lit(0))).first()[0]) // BLOCK_TOKENS))
    # a set of a large cell goes to the units of its block and each block
    dealt = (
        placed.join(sizes, "cell")
        .withColumn("block", F.pmod(F.xxhash64("set_key"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("unit", F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("cell"), F.lit(units))).otherwise(F.xxhash64("cell", F.least("block", "other"), F.greatest("block", "other"))))
        .select("unit", "block", "cell", "set_key", "n", "tokens")
    )
    partial = dealt.mapInArrow(_strips(fragments), STRIP_DDL).groupBy("unit", "strip").applyInArrow(_partial, "unit long, sets binary, counts binary")
    found = scratch.settle(partial.groupBy("unit").applyInArrow(_summed(percent), "u long, v long, links long"), "found")
    scratch.drop("placed", "sizes")
    parts = components(found.select("u", "v"), scratch, "linked")
    degrees = found.groupBy(F.col("u").alias("set_key")).agg(F.sum("links").alias("links"))
    return parts.toDF("set_key", "component").join(degrees, "set_key")


def keyed_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, set_key, n_shingles, component_id, n_links) of every row; see ``jaccard_components``."""
    scratch = Scratch(docs.sparkSession, "jaccard")
    links = scratch.settle(linked_sets(docs, scratch, text, size, percent), "links")
    scratch.drop("linked", "found")
    keyed = scratch.settle(set_columns(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")), size), "keyed")
    own = keyed.where("n_shingles > 0").groupBy("set_key").agg(F.min("doc_id").alias("first"))
    classes = own.join(links, "set_key", "left").withColumn("component", F.coalesce("component", "set_key"))
    classes = scratch.settle(classes, "classes")
    groups = classes.groupBy("component").agg(F.min("first").alias("component_id"))
    named = scratch.settle(classes.join(groups, "component").select("set_key", "component_id", F.coalesce("links", F.lit(0)).alias("n_links")), "named")
    scratch.drop("classes", "links")
    return keyed.join(named, "set_key", "left").select(
        "doc_id", "set_key", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) of every row.

    ``component_id`` is the smallest id that a document reaches by links, itself included; ``n_links`` is the
    number of different sets that its set is linked with (its copies not counted).
    """
    return keyed_components(docs, doc_id, text, size, percent).drop("set_key")


def keep_one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """The rows whose id is the smallest of their component.

    Rows with a null id and rows without words stay. Rows with one id and one set stay or go together; rows with one
    id and different sets are judged one by one. Only ids (and sets, where an id is ambiguous) are joined to the documents.
    """
    groups = keyed_components(docs, doc_id, text, size, percent)
    judged = groups.where("doc_id IS NOT NULL").groupBy("doc_id", "set_key").agg(F.max(F.col("component_id") != F.col("doc_id")).alias("goes"))
    scratch = Scratch(docs.sparkSession, "kept")
    ids = scratch.settle(judged.groupBy("doc_id").agg(F.max("goes").alias("goes"), F.min("goes").alias("all_go"), F.collect_set(F.when(F.col("goes"), F.col("set_key"))).alias("gone_sets")).where("goes"), "ids")
    names = [F.col(f"`{c}`") for c in docs.columns]
    kept = docs.join(ids.select(F.col("doc_id").alias(doc_id)), doc_id, "left_anti").select(*names)
    ambiguous = ids.where("NOT all_go").select(F.col("doc_id").alias("_id"), "gone_sets")
    if ambiguous.isEmpty():
        return kept
    rows = docs.select(F.struct(*names).alias("_row"), F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("_text")).join(ambiguous, "_id")
    stay = set_columns(rows, size, "_text").where(~F.array_contains("gone_sets", F.col("set_key")))
    return kept.union(stay.select(*[F.col(f"_row.`{c}`").alias(c) for c in docs.columns]))


def op10_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingle sets have a Jaccard similarity of 0.85 or more."""
    return jaccard_components(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("n_links")


OP10_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[i : i + least(len(ws), 4) - 1], ' ') AS g FROM w, unnest(generate_series(1, greatest(len(ws) - 3, 1))) AS t(i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT x, y FROM p JOIN n u ON u.doc_id = x JOIN n v ON v.doc_id = y WHERE 100 * c >= 85 * (u.n + v.n - c)),
l AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT a, y FROM reach JOIN l ON b = x)
SELECT w.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, low AS component_id FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY 1) USING (doc_id)
"""
