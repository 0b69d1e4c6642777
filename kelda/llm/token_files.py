"""Token ids in binary files (operator 7).

Documents are sorted by id over the cluster and each task writes its range in files of a bounded
number of tokens. In a file, ids are replaced by their rank of frequency in that file (ties: the
smaller id first); a rank takes one to four bytes, and its length stands in two bits of a separate
control byte, four ranks to a byte. Control bytes are decoded by table lookup: one table has the
bytes to gather for each of the 256 control bytes, so numpy decodes four ids at a time.

File, all numbers little-endian: 8 bytes magic; uint64 documents, tokens, ranks, data bytes;
int64 document ids (a null id: -2**63); uint32 tokens of each document; uint32 id of each rank;
control bytes; data bytes.

Null and empty texts have the end id alone. Repeated ids stand next to each other in the order
of their texts' hashes. An empty table makes no file and no rows. Columns beside id and text are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kelda.llm.files import TaskFiles, folder_of, one_task_a_file
from kelda.llm.pieces import PieceCoder, char_blocks
from kelda.llm.tables import stored
from kelda.sources.scratch import scratch_path

MAGIC = b"KELDATF1"
NO_ID = -(2**63)
END_ID = 2
#: Tokens of a file (a document is never cut).
FILE_TOKENS = 4_000_000
_STEP = 1 << 18


def pack(ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Control bytes and data bytes of numbers below 2**32."""
    ranks = ranks.astype(np.uint32, copy=False)
    more = (ranks > 0xFF).astype(np.uint8)
    more += ranks > 0xFFFF
    more += ranks > 0xFFFFFF
    padded = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    padded[: len(ranks)] = more
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    sizes = more.astype(np.int64) + 1
    place = np.cumsum(sizes) - sizes
    data = np.empty(int(sizes.sum()), np.uint8)
    data[place] = ranks & 0xFF
    for k in (1, 2, 3):
        which = np.flatnonzero(more >= k)
        data[place[which] + k] = ranks[which] >> np.uint32(8 * k) & np.uint32(0xFF)
    return control, data


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By control byte: bytes of its four numbers, which 16 bytes to gather, which of them count."""
    sizes = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1
    begin = np.cumsum(sizes, axis=1) - sizes
    within = np.arange(4)
    gather = (begin[:, :, None] + within).reshape(256, 16)
    counts = (within < sizes[:, :, None]).reshape(256, 16)
    return sizes, np.where(counts, gather, 0), np.where(counts, 255, 0).astype(np.uint8)


def unpack(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    """The n numbers that ``pack`` has packed."""
    sizes, gather, counts = _tables()
    padding = len(control) * 4 - n  # the last control byte may name numbers that are not there
    data = np.concatenate([data, np.zeros(padding, np.uint8)]) if padding else data
    ends = np.cumsum(sizes.sum(axis=1)[control])
    out = np.empty(len(control) * 4, np.uint32)
    for start in range(0, len(control), _STEP):
        own = control[start : start + _STEP]
        base = ends[start : start + _STEP] - sizes.sum(axis=1)[own]
        found = data[base[:, None] + gather[own]] & counts[own]
        out[4 * start : 4 * (start + len(own))] = found.view("<u4").ravel()
    return out[:n]


def file_bytes(doc_ids: np.ndarray, lengths: np.ndarray, ids: np.ndarray) -> list[bytes]:
    """The parts of one token file."""
    counts = np.bincount(ids) if len(ids) else np.empty(0, np.int64)
    used = np.flatnonzero(counts)
    by_rank = used[np.argsort(-counts[used], kind="stable")].astype(np.uint32)
    rank_of = np.zeros(len(counts), np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    control, data = pack(rank_of[ids]) if len(ids) else (np.empty(0, np.uint8),) * 2
    head = np.array([len(doc_ids), len(ids), len(by_rank), len(data)], "<u8")
    arrays = [head, doc_ids.astype("<i8"), lengths.astype("<u4"), by_rank.astype("<u4"), control, data]
    return [MAGIC, *(a.tobytes() for a in arrays)]


def read_file(folder: str, name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document ids, their numbers of tokens, and all token ids of one file."""
    system, path = folder_of(folder)
    with system.open_input_file(f"{path}/{name}") as file:
        raw = file.read()
    if raw[:8] != MAGIC:
        raise ValueError(f"{name} is not a token file")
    n_docs, n_tokens, n_ranks, n_data = (int(x) for x in np.frombuffer(raw, "<u8", 4, 8))
    at = 40
    doc_ids = np.frombuffer(raw, "<i8", n_docs, at)
    lengths = np.frombuffer(raw, "<u4", n_docs, at := at + 8 * n_docs)
    by_rank = np.frombuffer(raw, "<u4", n_ranks, at := at + 4 * n_docs)
    n_control = -(-n_tokens // 4)
    control = np.frombuffer(raw, np.uint8, n_control, at := at + 4 * n_ranks)
    data = np.frombuffer(raw, np.uint8, n_data, at + n_control)
    ids = by_rank[unpack(control, data, n_tokens)] if n_tokens else np.empty(0, np.uint32)
    return doc_ids, lengths, ids


@lru_cache(maxsize=2)
def _coder(path: str) -> PieceCoder:
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def encode(pieces: list[str]) -> list[list[int]]:
        return [e.ids for e in tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    return PieceCoder(encode)


def write_token_files(
    docs: DataFrame,
    folder: str,
    vocabulary: str | None = None,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
    file_tokens: int = FILE_TOKENS,
) -> DataFrame:
    """Encode every whole text and write the files; returns their listing, in order of part and
    seq: (part, seq, file, n_docs, n_tokens). ``folder`` is one that all executors share."""
    from kelda.llm.bpe import default_vocabulary

    path = vocabulary or default_vocabulary()
    slim = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text")
    )
    # By the text's hash, too: rows of one id are spread, and no text goes to the driver's sample.
    hashed = slim.withColumn("h", F.xxhash64("text"))
    ranged = hashed.repartitionByRange("id", "h").sortWithinPartitions("id", "h", "text").select("id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, files = _coder(path), TaskFiles(folder, ".ktf")
        keys: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        listed, held = [], 0

        def flush() -> None:
            parts = [np.concatenate(x) for x in (keys, lengths, ids)]
            name = files.write(*file_bytes(*parts))
            listed.append((files.part, files.count - 1, name, len(parts[0]), len(parts[2])))
            for x in (keys, lengths, ids):
                x.clear()

        for batch in batches:
            texts = batch.column("text").to_pylist()
            own_keys = batch.column("id").fill_null(NO_ID).to_numpy()
            for start, stop in char_blocks(texts):
                found, offsets = coder(texts[start:stop])
                size = np.diff(offsets) + 1
                ends = np.cumsum(size) - 1
                block = np.full(len(found) + len(size), end_id, np.int32)
                inside = np.ones(len(block), bool)
                inside[ends] = False
                block[inside] = found
                keys.append(own_keys[start:stop])
                lengths.append(size)
                ids.append(block)
                held += len(block)
                if held >= file_tokens:
                    flush()
                    held = 0
        if keys:
            flush()
        columns = list(zip(*listed)) if listed else [(), (), (), (), ()]
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            names=["part", "seq", "file", "n_docs", "n_tokens"],
        )

    return stored(
        ranged.mapInArrow(run, "part int, seq int, file string, n_docs bigint, n_tokens bigint"),
        "token-listing",
    )


def with_starts(listing: DataFrame) -> DataFrame:
    """The listing with the number of tokens before each file.

    Totals of the parts (one row a task) are summed up in order; files only within their part.
    """
    parts = listing.groupBy("part").agg(F.sum("n_tokens").alias("_total"))
    upto = F.sum("_total").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    before = parts.select("part", F.coalesce(upto, F.lit(0)).alias("_before"))
    earlier = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0))
    return listing.withColumn("_within", within).join(before, "part").select(
        *listing.columns, (F.col("_before") + F.col("_within")).alias("start")
    )


def read_token_files(listing: DataFrame, folder: str, with_ids: bool = True) -> DataFrame:
    """Per document of the files: doc_id, start, n_tokens, ids_crc32 and, on request, its ids."""
    files = listing.count()
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, first in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist()):
                doc_ids, lengths, ids = read_file(folder, name)
                ends = np.cumsum(lengths, dtype=np.int64)
                begins = ends - lengths
                raw = memoryview(ids.astype("<u4").tobytes())
                sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
                columns = [
                    pa.array(doc_ids, mask=doc_ids == NO_ID),
                    pa.array(first + begins, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(sums, pa.int64()),
                ]
                if with_ids:
                    offsets = np.append(begins, len(ids)).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    placed = with_starts(listing).select("file", "start")
    return one_task_a_file(placed, files).mapInArrow(run, schema)


def round_trip(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """Write the files to a folder of their own and read them back: a row per document."""
    folder = scratch_path(spark, "tokens")
    return read_token_files(write_token_files(docs, folder, **options), folder, with_ids=False)
