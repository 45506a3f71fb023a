"""Byte-level BPE encoding and decoding with segment trees (operator 6).

A piece of text (one match of the pre-split pattern) is a row of byte positions. A segment tree over them holds,
for each live position, the rank of the pair that starts there, packed with the position: the root is the
leftmost pair of minimum rank. A merge joins a position with its live right neighbour and updates three leaves
and the paths above them, logarithmic in the piece's length. Pieces of like length are merged side by side in
one numpy array of trees; long pieces have a tree of their own. Merged pieces are remembered up to a bound.

Ids equal those of the usual library for rank files: a piece that is a token itself is that token.
Defined results: a null or empty text has no tokens and both digests are those of no bytes; each input row gives
one row; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from varaq.llm.common import chunks, in_small_batches, table

VOCABULARY = "byte_bpe_50k.tiktoken"
#: Pieces that a worker remembers, and the longest of them in characters.
REMEMBERED = 400_000
LONGEST = 64
#: Longest piece, in bytes, that shares an array with others.
SIDE_BY_SIDE = 128
NONE = np.int64(1) << 62


class ByteBpe:
    """Encoder and decoder for a rank file."""

    def __init__(self, rank_file: bytes, pattern: str):
        import regex

        pairs = (line.split() for line in rank_file.splitlines() if line)
        self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        self.tokens = {r: t for t, r in self.ranks.items()}
        self.find = regex.compile(pattern).findall
        self.base = max(self.tokens) + 2
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        keys, values = [], []
        for token, rank in self.ranks.items():
            for k in range(1, len(token)):
                a, b = self.ranks.get(token[:k]), self.ranks.get(token[k:])
                if a is not None and b is not None:
                    keys.append(a * self.base + b)
                    values.append(rank)
        order = np.argsort(np.array(keys, dtype=np.int64))
        self.pair_keys = np.array(keys, dtype=np.int64)[order]
        self.pair_ranks = np.array(values, dtype=np.int64)[order]
        self.pair_rank = dict(zip(keys, values, strict=True))
        self.known: dict[str, bytes] = {}

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of the pairs a, b; NONE where they do not merge. Ids below 0 never do."""
        key = a * self.base + b
        at = np.searchsorted(self.pair_keys, key)
        at[at == len(self.pair_keys)] = 0
        return np.where((self.pair_keys[at] == key) & (a >= 0) & (b >= 0), self.pair_ranks[at], NONE)

    def _merge_many(self, pieces: list[bytes], leaves: int) -> list[bytes]:
        """Ids, packed, of pieces with 2 to `leaves` bytes; leaves is a power of two."""
        n = len(pieces)
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=n)
        raw = np.frombuffer(b"".join(x.ljust(leaves, b"\0") for x in pieces), dtype=np.uint8).reshape(n, leaves)
        at = np.arange(leaves)
        # column `leaves` is a stand-in for "no neighbour": its token is -1
        token = np.full((n, leaves + 1), -1, dtype=np.int64)
        token[:, :leaves] = np.where(at < lengths[:, None], self.byte_ids[raw], -1)
        right = np.empty((n, leaves + 1), dtype=np.int64)
        right[:, :leaves] = np.where(at + 1 < lengths[:, None], at + 1, leaves)
        right[:, leaves] = leaves
        left = np.empty((n, leaves + 1), dtype=np.int64)
        left[:, :leaves] = np.where(at > 0, at - 1, leaves)
        left[:, leaves] = leaves
        rank = self._rank(token[:, :-1].ravel(), token[:, 1:].ravel()).reshape(n, leaves)
        tree = np.full((n, 2 * leaves), NONE, dtype=np.int64)
        tree[:, leaves:] = np.where(rank < NONE, rank * leaves + at, NONE)
        width = leaves
        while width > 1:
            width //= 2
            tree[:, width : 2 * width] = np.minimum(tree[:, 2 * width : 4 * width : 2], tree[:, 2 * width + 1 : 4 * width : 2])
        rows = np.flatnonzero(tree[:, 1] < NONE)
        while len(rows):
            top = tree[rows, 1]
            pos = top % leaves
            gone = right[rows, pos]
            after, before = right[rows, gone], left[rows, pos]
            merged = top // leaves
            token[rows, pos] = merged
            token[rows, gone] = -1
            right[rows, pos] = after
            left[rows, after] = pos  # in the stand-in's column this is never read as a neighbour
            ahead = self._rank(merged, token[rows, after])
            behind = self._rank(token[rows, before], merged)
            tree[rows, leaves + gone] = NONE
            tree[rows, leaves + pos] = np.where(ahead < NONE, ahead * leaves + pos, NONE)
            has = before < leaves
            tree[rows[has], leaves + before[has]] = np.where(behind[has] < NONE, behind[has] * leaves + before[has], NONE)
            who = np.concatenate((rows, rows, rows[has]))
            node = np.concatenate((gone, pos, before[has])) + leaves
            for _ in range(leaves.bit_length() - 1):
                node >>= 1
                tree[who, node] = np.minimum(tree[who, 2 * node], tree[who, 2 * node + 1])
            rows = rows[tree[rows, 1] < NONE]
        live = token[:, :leaves] >= 0
        packed = token[:, :leaves][live].astype("<u4").tobytes()
        ends = np.cumsum(live.sum(axis=1)) * 4
        return [packed[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

    def _merge_long(self, piece: bytes) -> bytes:
        """Ids, packed, of a piece of any length, by one segment tree."""
        n = len(piece)
        leaves = 1 << max(1, (n - 1).bit_length())
        none, rank_of, base = int(NONE), self.pair_rank, self.base
        token = self.byte_ids[np.frombuffer(piece, dtype=np.uint8)].tolist()
        right, left = [*range(1, n), -1], list(range(-1, n - 1))
        tree = [none] * (2 * leaves)
        for k in range(n - 1):
            r = rank_of.get(token[k] * base + token[k + 1])
            if r is not None:
                tree[leaves + k] = r * leaves + k
        for k in range(leaves - 1, 0, -1):
            a, b = tree[2 * k], tree[2 * k + 1]
            tree[k] = a if a < b else b

        def put(at: int, value: int) -> None:
            k = at + leaves
            tree[k] = value
            k >>= 1
            while k:
                a, b = tree[2 * k], tree[2 * k + 1]
                low = a if a < b else b
                if tree[k] == low:
                    return
                tree[k] = low
                k >>= 1

        def pair(at: int) -> int:
            r = rank_of.get(token[at] * base + token[right[at]]) if right[at] >= 0 else None
            return none if r is None else r * leaves + at

        while (top := tree[1]) < none:
            pos = top % leaves
            gone = right[pos]
            token[pos], token[gone] = top // leaves, -1
            after = right[pos] = right[gone]
            if after >= 0:
                left[after] = pos
            put(gone, none)
            put(pos, pair(pos))
            if left[pos] >= 0:
                put(left[pos], pair(left[pos]))
        return np.array([t for t in token if t >= 0], dtype="<u4").tobytes()

    def merge(self, pieces: list[str]) -> list[bytes]:
        """Packed ids of each piece."""
        out: list[bytes] = [b""] * len(pieces)
        sizes: dict[int, list[int]] = {}
        raw = [x.encode() for x in pieces]
        for k, b in enumerate(raw):
            r = self.ranks.get(b)
            if r is not None:
                out[k] = r.to_bytes(4, "little")
            elif len(b) > SIDE_BY_SIDE:
                out[k] = self._merge_long(b)
            elif b:
                sizes.setdefault(1 << (len(b) - 1).bit_length(), []).append(k)
        for leaves, which in sizes.items():
            step = max(1, 400_000 // leaves)
            for a in range(0, len(which), step):
                some = which[a : a + step]
                for k, ids in zip(some, self._merge_many([raw[k] for k in some], leaves), strict=True):
                    out[k] = ids
        return out

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Packed ids (little-endian unsigned 32-bit) of each text."""
        split = [self.find(t) for t in texts]
        known = self.known
        new = list({p for pieces in split for p in pieces if p not in known})
        now = dict(zip(new, self.merge(new), strict=True))
        if len(known) + len(now) > REMEMBERED:
            needed = {p: known[p] for pieces in split for p in pieces if p in known}
            known.clear()
            known.update(needed)
        known.update((p, ids) for p, ids in now.items() if len(p) <= LONGEST)
        long = {p: ids for p, ids in now.items() if len(p) > LONGEST}  # used once, not remembered
        get = known.__getitem__ if not long else lambda p: long[p] if p in long else known[p]
        return [b"".join(map(get, pieces)) for pieces in split]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_LOADED: dict[tuple, ByteBpe] = {}


def loaded(rank_file: bytes, pattern: str) -> ByteBpe:
    """One encoder for each Python worker and vocabulary."""
    key = (hashlib.sha256(rank_file).digest(), pattern)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = ByteBpe(rank_file, pattern)
    return _LOADED[key]


def read_vocabulary(name: str = VOCABULARY) -> tuple[bytes, str]:
    """The rank file, of fixed size, and the pre-split pattern that belongs to it."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read(), public_tokenizers.PATTERN


def _encoder(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(*shared.value)
        for whole in batches:
            for batch in chunks(whole):
                texts = pc.fill_null(batch.column("text"), "").to_pylist()
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(bpe.encode_batch(texts), pa.binary())], names=["doc_id", "ids"])

    return run


def _round_trip(shared, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(*shared.value)
        for whole in batches:
            for batch in chunks(whole):
                ids = bpe.encode_batch(pc.fill_null(batch.column("text"), "").to_pylist())
                more = batch.schema.names[2:]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"),
                        pa.array([len(x) // 4 for x in ids], pa.int64()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                        pa.array([hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids]),
                        *map(batch.column, more),
                        *([pa.array(ids, pa.binary())] if with_ids else []),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *more, *(["ids"] if with_ids else [])],
                )

    return run


def _decoder(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(*shared.value)
        for batch in batches:
            data = [bpe.decode(x or b"") for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(data, pa.binary())], names=["doc_id", "data"])

    return run


def _texts(docs: DataFrame, *more: str) -> DataFrame:
    return in_small_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)


def encode(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id and ids: the tokens of the whole text as little-endian unsigned 32-bit integers."""
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    return _texts(docs).mapInArrow(_encoder(shared), "doc_id bigint, ids binary")


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id and data: the bytes that ids stand for."""
    shared = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    return encoded.select("doc_id", "ids").mapInArrow(_decoder(shared), "doc_id bigint, data binary")


def round_trip(docs: DataFrame, vocabulary: str = VOCABULARY, position: bool = False) -> DataFrame:
    """Token count and the digests of ids and decoded bytes, for each row of docs; with its position and its ids, if
    asked for."""
    shared = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", position bigint, ids binary" * position
    return _texts(docs, *["position"] * position).mapInArrow(_round_trip(shared, position), schema)


def op6_byte_bpe(spark, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))


def placed(docs: DataFrame) -> DataFrame:
    """doc_id, text and position: the place (0, 1, ...) of a row in the files that docs is read from, file after file in
    the order they were written. Spark deals files to tasks by size, so the order of rows alone says nothing."""
    at = docs.metadataColumn("_metadata")
    rows = docs.select("doc_id", "text", at["file_name"].alias("_file"), at["row_index"].alias("_index"))
    sizes = rows.groupBy("_file").agg((F.max("_index") + 1).alias("_rows"))  # a row for each file
    number = F.coalesce(F.regexp_extract("_file", "^part-([0-9]+)", 1).try_cast("bigint"), F.lit(-1))
    earlier = Window.partitionBy().orderBy(number, "_file").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("_file", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(before), "_file").select("doc_id", "text", (F.col("_before") + F.col("_index")).alias("position"))


def tokenise(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: each document's tokens (ids, little-endian unsigned 32-bit), the digests that prove
    the round trip, and its position in the order that the stage before has written (docs as read from Parquet)."""
    return round_trip(placed(docs), position=True)
