"""Token counts by heap-and-linked-list byte-pair merging (operator 5).

A piece starts as a linked list of byte symbols, the last one with the end-of-word mark. A heap holds the ranks
of adjacent pairs with their positions; the lowest is popped again and again, merged if it still stands, and its
two new neighbours are pushed. No ids come out: a piece has as many tokens as symbols less merges.

Text is prepared as the vocabulary's file says: special strings are cut out first and count one each, the rest is
brought to NFC, lower-cased and split. Defined results: null or empty texts have no bytes and no tokens; one row
for each input row; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varaq.llm.common import chunks, in_small_batches, table

VOCABULARY = "word_bpe_49k.json"
LIMIT = 2048
#: Pieces whose count a worker remembers, and the longest of them in characters.
REMEMBERED = 600_000
LONGEST = 64


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 stands for itself,
    the others follow from U+0100 in order."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, spare = [], 256
    for b in range(256):
        letters.append(chr(b) if b in own else chr(spare))
        spare += b not in own
    return letters


class WordBpe:
    def __init__(self, file: bytes):
        import regex

        spec = json.loads(file)
        model = spec["model"]
        ids, end = model["vocab"], model["end_of_word_suffix"]
        letters = _byte_letters()
        self.inner = [ids[c] for c in letters]
        self.last = [ids[c + end] for c in letters]
        self.pairs: dict[int, int] = {}  # left id, right id -> rank, merged id
        for rank, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            self.pairs.setdefault(ids[a] << 16 | ids[b], rank << 16 | ids[a + b])
        specials = [t["content"] for t in spec["added_tokens"]]
        self.cut = regex.compile("|".join(map(regex.escape, sorted(specials, key=len, reverse=True)))).split if specials else lambda t: [t]
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.find = regex.compile(split["pattern"]["Regex"]).findall
        self.known: dict[str, int] = {}

    def tokens(self, piece: str) -> int:
        data = piece.encode()
        n = len(data)
        symbol = [self.inner[b] for b in data[:-1]]
        symbol.append(self.last[data[-1]])
        if n == 1:
            return 1
        pairs = self.pairs
        heap = []
        for k in range(n - 1):
            got = pairs.get(symbol[k] << 16 | symbol[k + 1])
            if got is not None:
                heap.append((got >> 16) << 32 | k)
        if not heap:
            return n
        heapify(heap)
        right = [*range(1, n), -1]
        left = [*range(-1, n - 1)]
        merges = 0
        while heap:
            top = heappop(heap)
            k = top & 0xFFFFFFFF
            j = right[k]
            if symbol[k] < 0 or j < 0:
                continue
            got = pairs.get(symbol[k] << 16 | symbol[j])
            if got is None or got >> 16 != top >> 32:
                continue  # the pair that was pushed here has gone
            merges += 1
            symbol[k], symbol[j] = got & 0xFFFF, -1
            after = right[k] = right[j]
            if after >= 0:
                left[after] = k
                got = pairs.get(symbol[k] << 16 | symbol[after])
                if got is not None:
                    heappush(heap, (got >> 16) << 32 | k)
            before = left[k]
            if before >= 0:
                got = pairs.get(symbol[before] << 16 | symbol[k])
                if got is not None:
                    heappush(heap, (got >> 16) << 32 | before)
        return n - merges

    def count(self, text: str) -> int:
        parts = self.cut(text)
        total = len(parts) - 1
        known = self.known
        for part in parts:
            # letter by letter as the library does it: no special case for a final sigma
            pieces = self.find(unicodedata.normalize("NFC", part).replace("Σ", "σ").lower())
            for p in set(pieces).difference(known):
                if len(p) <= LONGEST:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[p] = self.tokens(p)
            try:
                total += sum(map(known.__getitem__, pieces))
            except KeyError:  # long pieces, or the memory was cleared meanwhile
                total += sum(known[p] if p in known else self.tokens(p) for p in pieces)
        return total


_LOADED: dict[bytes, WordBpe] = {}


def loaded(file: bytes) -> WordBpe:
    key = hashlib.sha256(file).digest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = WordBpe(file)
    return _LOADED[key]


def _counter(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = loaded(shared.value)
        for whole in batches:
            for batch in chunks(whole):
                text = pc.fill_null(batch.column("text"), "")
                n = [bpe.count(t) for t in text.to_pylist()]
                size = pc.binary_length(text).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), size, pa.array(n, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    return run


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """n_bytes, n_tokens and over_limit for each row of docs."""
    import public_tokenizers

    with open(public_tokenizers.path(vocabulary), "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())  # a file of fixed size
    texts = in_small_batches(docs).select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_counter(shared), "doc_id bigint, n_bytes bigint, n_tokens bigint").withColumn("over_limit", F.col("n_tokens") > limit)


def op5_token_count(spark, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
