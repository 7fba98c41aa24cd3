"""Byte-level BPE encoding and decoding with a segment tree over byte positions.

Each match of the pre-token pattern is encoded separately. A leaf of the tree stands for a live
token's first byte and holds the rank of the pair that the token forms with its right neighbour;
the root is the leftmost pair of least rank. A merge updates the leaves of the merged token, of
its swallowed neighbour and of its left neighbour, so a piece of n bytes takes O(n log n). The trees of a group's
unknown pieces, where several are of like length, are arrays with a row each and merge in step.

Token ids travel as little-endian unsigned 32-bit integers in a binary column.

Defined results: null text is encoded as the empty text (no ids); an empty table gives no rows; ties of rank
go to the leftmost pair; a very long text is encoded whole, and a pre-token of n bytes takes about 100 n bytes of
memory; extra columns play no part; repeated rows get equal ids; null
ids decode to null; an id that the vocabulary lacks raises. Lone surrogates can't occur in Spark strings.
"""

from __future__ import annotations

import base64
from collections import defaultdict
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioscope.llm.common import table

#: Pre-tokens that a worker remembers in each of two generations (about 60 MB each) unless told otherwise; longer ones aren't remembered.
REMEMBERED, REMEMBERED_CHARS = 300_000, 64
NO_PAIR = 1 << 62
#: Pre-tokens that are split off before the unknown ones among them are merged; leaves of trees in memory at once; fewer pieces than FEW
#: go through their trees one by one.
GROUP, LEAVES, FEW = 50_000, 1 << 17, 16


def merge_piece(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token."""
    if (whole := ranks.get(piece)) is not None:
        return [whole]
    n = len(piece)
    leaves = 1 << (n - 1).bit_length()
    get = ranks.get
    # a node is rank * leaves + position, so that the least node is the leftmost pair of least rank
    tree = [NO_PAIR] * (2 * leaves)
    for i in range(n - 1):
        if (rank := get(piece[i : i + 2])) is not None:
            tree[leaves + i] = rank * leaves + i
    for k in range(leaves - 1, 0, -1):
        x, y = tree[2 * k], tree[2 * k + 1]
        tree[k] = x if x < y else y
    end, before = list(range(1, n + 1)), list(range(-1, n))
    while (least := tree[1]) < NO_PAIR:
        i = least % leaves
        j = end[i]
        stop = end[i] = end[j]
        here, right = leaves + i, leaves + j
        tree[right] = tree[here] = NO_PAIR
        if stop < n:
            before[stop] = i
            if (rank := get(piece[i : end[stop]])) is not None:
                tree[here] = rank * leaves + i
        left = here
        if (p := before[i]) >= 0:
            left = leaves + p
            rank = get(piece[p:stop])
            tree[left] = NO_PAIR if rank is None else rank * leaves + p
        while here > 1:  # the three leaves' ancestors, level by level; they soon coincide
            here >>= 1
            left >>= 1
            right >>= 1
            x, y = tree[2 * here], tree[2 * here + 1]
            tree[here] = x if x < y else y
            if left != here:
                x, y = tree[2 * left], tree[2 * left + 1]
                tree[left] = x if x < y else y
            if right != here:
                x, y = tree[2 * right], tree[2 * right + 1]
                tree[right] = x if x < y else y
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : end[i]]])
        i = end[i]
    return out


class Merges:
    """The segment trees of many pre-tokens at once, a row each; a vocabulary's tokens are numbered by rank."""

    def __init__(self, ranks: dict[bytes, int]):
        names = sorted(ranks, key=ranks.__getitem__)
        names += [b for b in map(bytes, zip(range(256))) if b not in ranks]  # these merge, but have no id
        number = {name: k for k, name in enumerate(names)}
        self.ids = np.array([ranks.get(name, -1) for name in names], np.int64)
        self.none = len(names)  # what stands beside the first and the last token
        self.single = np.array([number[b] for b in map(bytes, zip(range(256)))], np.int64)
        pairs = {}
        for k, name in enumerate(names):
            for cut in range(1, len(name)):
                if (x := number.get(name[:cut])) is not None and (y := number.get(name[cut:])) is not None:
                    pairs[x * (self.none + 1) + y] = k
        self.pairs = np.array(sorted([*pairs, NO_PAIR]), np.int64)
        self.merged = np.array([pairs.get(x, NO_PAIR) for x in self.pairs.tolist()], np.int64)
        first, second = np.divmod(np.arange(1 << 16), 256)
        self.of_bytes = self.rank(self.single[first], self.single[second])

    def rank(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Number of the token that two tokens side by side form, or NO_PAIR."""
        key = x * (self.none + 1) + y
        at = self.pairs.searchsorted(key)
        return np.where(self.pairs[at] == key, self.merged[at], NO_PAIR)

    def merge(self, pieces: list[bytes], leaves: int) -> list[bytes]:
        """Ids of pieces of ``leaves`` bytes at most, a power of two, as ``merge_piece`` gives them, as bytes."""
        m, bits, wide = len(pieces), leaves.bit_length() - 1, leaves + 1
        n = np.fromiter(map(len, pieces), np.int64, m)
        raw = np.frombuffer(b"".join([p.ljust(leaves, b"\0") for p in pieces]), np.uint8).reshape(m, leaves)
        places = np.arange(wide)
        live = places < n[:, None]
        token = np.full((m, wide), self.none)
        token[:, :leaves] = self.single[raw]
        token[~live] = self.none
        tree = np.full((m, 2 * leaves), NO_PAIR)
        two = self.of_bytes[raw[:, :-1] * np.int64(256) + raw[:, 1:]]
        two = np.where((two < NO_PAIR) & live[:, 1:leaves], two * leaves + places[: leaves - 1], NO_PAIR)
        tree[:, leaves : 2 * leaves - 1] = two
        for level in range(bits - 1, -1, -1):
            k = 1 << level
            np.minimum(tree[:, 2 * k : 4 * k : 2], tree[:, 2 * k + 1 : 4 * k : 2], out=tree[:, k : 2 * k])
        end, before = np.tile(places + 1, m), np.tile(places - 1, m)
        alive, token, tree = live.ravel(), token.ravel(), tree.ravel()
        rows = np.arange(m)
        while True:
            least = tree[rows * (2 * leaves) + 1]
            rows, least = rows[least < NO_PAIR], least[least < NO_PAIR]
            if not rows.size:
                break
            i, new, at, root = least & (leaves - 1), least >> bits, rows * wide, rows * (2 * leaves)
            j = end[at + i]
            stop = end[at + j]
            end[at + i] = stop
            before[at + stop] = i
            alive[at + j] = False
            token[at + i] = new
            p = before[at + i]
            first = p < 0
            to_left = self.rank(token[at + np.where(first, leaves, p)], new)
            to_right = self.rank(new, token[at + stop])
            p = np.where(first, i, p)
            tree[root + leaves + p] = np.where(to_left < NO_PAIR, to_left * leaves + p, NO_PAIR)
            tree[root + leaves + j] = NO_PAIR
            tree[root + leaves + i] = np.where(to_right < NO_PAIR, to_right * leaves + i, NO_PAIR)
            nodes = np.stack([p, i, j]) + leaves
            for _ in range(bits):  # the three leaves' ancestors, level by level
                nodes >>= 1
                below = root + 2 * nodes
                tree[root + nodes] = np.minimum(tree[below], tree[below + 1])
        ids = self.ids[token[alive]]
        if (ids < 0).any():
            raise KeyError("a byte that the vocabulary lacks")
        coded = ids.astype("<u4").tobytes()
        stops = (4 * alive.reshape(m, wide).sum(1).cumsum()).tolist()
        return [coded[a:b] for a, b in zip([0, *stops], stops)]


class Vocabulary:
    """The ids of texts; those of pre-tokens are remembered.

    When the table is full it becomes the older generation, from which entries in use come back.
    """

    def __init__(self, path: str, pattern: str, remembered: int = REMEMBERED):
        import regex

        self.younger: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.remembered = remembered
        with open(path, "rb") as lines:  # a file of the installed tokenizer package, present on every node
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.tokens = dict(zip(self.ranks.values(), self.ranks.keys()))
        self.merges = Merges(self.ranks)
        self.split = regex.compile(pattern).findall

    def merge_all(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pre-tokens as bytes; those of like length go through their trees together."""
        out, by_leaves = [b""] * len(pieces), defaultdict(list)
        for k, piece in enumerate(pieces):
            if (whole := self.ranks.get(piece)) is not None:
                out[k] = whole.to_bytes(4, "little")
            else:
                by_leaves[max(8, 1 << (len(piece) - 1).bit_length())].append(k)
        for leaves, places in by_leaves.items():
            rows = max(1, LEAVES // leaves)
            for part in (places[a : a + rows] for a in range(0, len(places), rows)):
                if len(part) < FEW:
                    coded = [np.array(merge_piece(pieces[k], self.ranks), "<u4").tobytes() for k in part]
                else:
                    coded = self.merges.merge([pieces[k] for k in part], leaves)
                for k, ids in zip(part, coded):
                    out[k] = ids
        return out

    def encode_all(self, texts: Iterable[str | None]) -> list[bytes]:
        """The ids of each text, by groups of some ``GROUP`` pre-tokens, whose unknown ones are merged together."""
        out, group, size = [], [], 0
        for text in texts:
            group.append(self.split(text) if text else [])
            size += len(group[-1])
            if size >= GROUP:
                out += self._coded(group)
                group, size = [], 0
        return out + self._coded(group)

    def _coded(self, group: list[list[str]]) -> list[bytes]:
        asked = set().union(*group)
        new = asked.difference(self.younger)
        if len(self.younger) + len(new) > self.remembered:
            self.older, self.younger, new = self.younger, {}, asked
        back = {p: self.older[p] for p in new if p in self.older}
        unknown = [p for p in new if p not in back]
        self.younger |= back
        self.younger.update(zip(unknown, self.merge_all([p.encode() for p in unknown])))
        out = [b"".join(map(self.younger.__getitem__, pieces)) for pieces in group]
        for piece in unknown:
            if len(piece) > REMEMBERED_CHARS:
                del self.younger[piece]
        return out

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes | None) -> bytes | None:
        return None if ids is None else b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=1)
def _vocabulary(path: str, pattern: str, remembered: int = REMEMBERED) -> Vocabulary:
    return Vocabulary(path, pattern, remembered)


def encode(text: Column, path: str, pattern: str) -> Column:
    """The ids of a text as binary, little-endian unsigned 32-bit integers."""

    @F.pandas_udf("binary")
    def ids(texts: pd.Series) -> pd.Series:
        return pd.Series(_vocabulary(path, pattern).encode_all(texts), dtype=object)

    return ids(F.coalesce(text, F.lit("")))


def decode(ids: Column, path: str, pattern: str) -> Column:
    """The bytes that ids of ``encode`` stand for."""

    @F.pandas_udf("binary")
    def raw(all_ids: pd.Series) -> pd.Series:
        return all_ids.map(_vocabulary(path, pattern).decode, na_action="ignore")

    return raw(ids)


CHECKED = T.StructType([T.StructField("ids", T.BinaryType()), T.StructField("round_trip", T.BooleanType())])


def encode_checked(text: Column, path: str, pattern: str, remembered: int = REMEMBERED) -> Column:
    """A struct of the ids and of whether decoding them gives the text's bytes, in one pass over the workers."""

    @F.pandas_udf(CHECKED)
    def ids(texts: pd.Series) -> pd.DataFrame:
        v = _vocabulary(path, pattern, remembered)
        coded = v.encode_all(texts)
        return pd.DataFrame({"ids": coded, "round_trip": [v.decode(c) == t.encode() for c, t in zip(coded, texts)]})

    return ids(F.coalesce(text, F.lit("")))


DECODED = T.StructType([T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())])


def encode_decoded(text: Column, path: str, pattern: str, remembered: int = REMEMBERED) -> Column:
    """A struct of the ids and of the bytes that they stand for. ``decode`` of ``encode`` would be chained by Spark, which encodes a text
    once for the ids and once more for what is decoded."""

    @F.pandas_udf(DECODED)
    def both(texts: pd.Series) -> pd.DataFrame:
        v = _vocabulary(path, pattern, remembered)
        coded = v.encode_all(texts)
        return pd.DataFrame({"ids": coded, "decoded": [v.decode(c) for c in coded]})

    return both(F.coalesce(text, F.lit("")))


def default_files() -> tuple[str, str]:
    """Path and pattern of the public 50k byte-level vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again."""
    path, pattern = default_files()
    docs = table(spark, sf_dir, "documents")
    coded = docs.select("doc_id", encode_decoded(F.col("text"), path, pattern).alias("coded"))
    return coded.select(
        "doc_id",
        F.expr("CAST(octet_length(coded.ids) div 4 AS BIGINT)").alias("n_tokens"),
        F.sha2("coded.ids", 256).alias("ids_sha256"),
        F.sha2("coded.decoded", 256).alias("decoded_sha256"),
    )
