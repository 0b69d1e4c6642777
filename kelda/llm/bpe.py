"""BPE encoding and decoding (operator 6).

A piece's symbols form a doubly linked list. A priority queue holds the merges that neighbours
allow, by rank and then by place; a merge that one of its symbols no longer takes part in is stale
and skipped when it comes up. Decoding concatenates the vocabulary's strings of the ids.

Null and empty texts have no ids and decode to the empty text. The special token's string in a
text becomes its id. Very long texts are handled whole. One pass without a shuffle; a
worker's memory is bounded by ``pieces.MAX_PIECES`` and one batch of texts.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kelda.llm.pieces import PieceCoder, char_blocks


@lru_cache(maxsize=1)
def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes for
    themselves, the others for the letters from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    letters, extra = [], 256
    for byte in range(256):
        letters.append(chr(byte) if byte in plain else chr(extra))
        extra += byte not in plain
    return letters


class Bpe:
    """A byte-level BPE vocabulary from a tokenizer's JSON file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        vocab: dict[str, int] = told["model"]["vocab"]
        letters = byte_letters()
        byte_of = {letter: byte for byte, letter in enumerate(letters)}
        self.first = [vocab.get(letter, -1) for letter in letters]
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.strings = [b""] * size
        for string, i in vocab.items():
            self.strings[i] = bytes(byte_of[c] for c in string)
        for string, i in self.special.items():
            self.strings[i] = string.encode()
        #: (left id << 32 | right id) -> (rank << 32 | id of the two merged)
        self.merges: dict[int, int] = {}
        for rank, merge in enumerate(told["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.merges.setdefault(vocab[left] << 32 | vocab[right], rank << 32 | vocab[left + right])

    def encode_piece(self, piece: str) -> list[int]:
        if piece in self.special:
            return [self.special[piece]]
        first = self.first
        symbol = [first[b] for b in piece.encode()]
        n = len(symbol)
        if n < 2:
            return symbol
        merges, pop, push = self.merges.get, heapq.heappop, heapq.heappush
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        right[-1] = -1
        queue = []
        for i in range(n - 1):
            known = merges(symbol[i] << 32 | symbol[i + 1])
            if known is not None:
                queue.append((known >> 32, i, known & 0xFFFFFFFF, symbol[i], symbol[i + 1]))
        heapq.heapify(queue)
        while queue:
            _, i, merged, a, b = pop(queue)
            j = right[i]
            # Stale: one of the two has been merged away or has become another symbol.
            if symbol[i] != a or j < 0 or symbol[j] != b:
                continue
            symbol[i], symbol[j] = merged, -1
            after = right[i] = right[j]
            if after >= 0:
                left[after] = i
                known = merges(merged << 32 | symbol[after])
                if known is not None:
                    push(queue, (known >> 32, i, known & 0xFFFFFFFF, merged, symbol[after]))
            before = left[i]
            if before >= 0:
                known = merges(symbol[before] << 32 | merged)
                if known is not None:
                    push(queue, (known >> 32, before, known & 0xFFFFFFFF, symbol[before], merged))
        return [s for s in symbol if s >= 0]

    def decode(self, ids: Sequence[int]) -> str:
        """The vocabulary's strings of the ids, one after the other; broken UTF-8 is replaced."""
        strings = self.strings
        return b"".join([strings[i] for i in ids]).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def _loaded(path: str) -> tuple[Bpe, PieceCoder, list[str]]:
    bpe = Bpe(path)
    encode = bpe.encode_piece
    coder = PieceCoder(lambda pieces: [encode(piece) for piece in pieces])
    return bpe, coder, [str(i) for i in range(len(bpe.strings))]


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _slim(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))


def encode(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids): the token ids of every whole text. ``vocabulary`` is the path of a tokenizer's
    JSON file, the same on all machines."""
    path = vocabulary or default_vocabulary()
    slim = _slim(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, coder, _ = _loaded(path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for start, stop in char_blocks(texts):
                ids, offsets = coder(texts[start:stop])
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids))
                keys = batch.column("id").slice(start, stop - start)
                yield pa.RecordBatch.from_arrays([keys, lists], names=["id", "ids"])

    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(run, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text) of (id, ids)."""
    path = vocabulary or default_vocabulary()
    slim = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, _, _ = _loaded(path)
        for batch in batches:
            texts = [bpe.decode(ids or ()) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(texts, pa.string())], names=["id", "text"])

    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(run, f"id {kind}, text string").withColumnRenamed("id", id_col)


def digests(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_tokens, ids_sha256, decoded_sha256 of every whole text, encoded and decoded in one
    pass so that the ids need not be stored."""
    path = vocabulary or default_vocabulary()
    slim = _slim(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, coder, spelled = _loaded(path)
        sha = hashlib.sha256
        for batch in batches:
            texts = batch.column("text").to_pylist()
            counts, of_ids, of_text = [], [], []
            for start, stop in char_blocks(texts):
                ids, offsets = coder(texts[start:stop])
                every, places = ids.tolist(), offsets.tolist()
                for a, b in zip(places, places[1:]):
                    own = every[a:b]
                    counts.append(b - a)
                    of_ids.append(sha(",".join([spelled[i] for i in own]).encode()).hexdigest())
                    of_text.append(sha(bpe.decode(own).encode()).hexdigest())
            columns = [batch.column("id"), pa.array(counts, pa.int64()), pa.array(of_ids), pa.array(of_text)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = slim.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return slim.mapInArrow(run, schema).withColumnRenamed("id", id_col)
