"""Packing token ids into sequences of a fixed length: concatenate and cut.

1. Each task encodes its documents, ends each with an end id, and writes them with the number of ids ahead
   of them in the task. The table also holds, by task, the number of ids.
2. Prefix sums over the tasks' totals (one row a task) give every document its place in the concatenation of all.
3. Fixed windows of the concatenation are the sequences. A document that reaches over a boundary gets one
   record (piece) on each side; no other document is touched, and nothing is shuffled.

What is left after the last whole window is cut into sequences whose lengths are the powers of two that it
is the sum of, longest first. Such sequences need no padding, so nothing is padded at all.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from waitcast.llm.bpe import ragged
from waitcast.llm.chunk_codes import large, pieces, worker_encoder
from waitcast.llm.scratch import materialise

WINDOW = 4096

PIECES = "doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def encode(docs: DataFrame, model: str, end_id: int) -> DataFrame:
    """(part, ahead, doc_id, n, bits, ids) of ``docs`` (doc_id, text), written to the shared folder.

    part: the task that wrote the row; ahead: ids before the document in that task; ids: n little-endian unsigned
    integers of ``bits`` bits, the end id included. A null text is empty.
    """
    bits = 16 if max(Tokenizer.from_str(model).get_vocab_size(), end_id + 1) <= 1 << 16 else 32

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, ahead = worker_encoder(model), TaskContext.get().partitionId(), 0
        for b in batches:
            at = 0
            for piece in pieces(large(b.column(1))):
                ids = encoder(piece).ended(end_id)
                ends = np.cumsum(ids.sizes)
                data = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(piece),
                    [None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64) * (bits // 8)), pa.py_buffer(ids.flat.astype(f"<u{bits // 8}"))])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(piece), part, np.int64)), pa.array(ends - ids.sizes + ahead), b.column(0).slice(at, len(piece)),
                     pa.array(ids.sizes), pa.array(np.full(len(piece), bits, np.int32)), data.cast(pa.binary())],
                    names=["part", "ahead", "doc_id", "n", "bits", "ids"])
                ahead, at = ahead + int(ends[-1]), at + len(piece)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return materialise(rows.mapInArrow(run, "part long, ahead long, doc_id long, n long, bits int, ids binary"), "packing-ids")


def boundaries(total: int, window: int) -> np.ndarray:
    """Where the sequences after the last whole window start, and the end: the binary digits of what is left."""
    left, starts = total % window, [total - total % window]
    for bit in reversed(range(window.bit_length())):
        if left >> bit & 1:
            starts.append(starts[-1] + (1 << bit))
    return np.array(starts, np.int64)


def cut(place: np.ndarray, size: np.ndarray, total: int, window: int) -> tuple[np.ndarray, ...]:
    """(row, start, length, sequence, offset) of the pieces of documents that stand at ``place`` and hold ``size`` ids."""
    tail = boundaries(total, window)
    whole = int(tail[0]) // window

    def sequence_of(x: np.ndarray) -> np.ndarray:
        return np.where(x < tail[0], x // window, whole + np.searchsorted(tail, x, "right") - 1)

    def start_of(sequence: np.ndarray) -> np.ndarray:
        return np.where(sequence < whole, sequence * window, tail[np.clip(sequence - whole, 0, len(tail) - 1)])

    first = sequence_of(place)
    n = sequence_of(place + size - 1) - first + 1
    row = np.repeat(np.arange(len(place)), n)
    sequence = ragged(first, n)
    begin = np.maximum(place[row], start_of(sequence))
    end = np.minimum((place + size)[row], start_of(sequence + 1))
    return row, begin - place[row], end - begin, sequence, begin - start_of(sequence)


def pack(docs: DataFrame, model: str, end_id: int, window: int = WINDOW) -> DataFrame:
    """The pieces of all documents of ``docs`` (doc_id, text): one row per document and sequence.

    The documents are encoded with the tokenizers model (its JSON; no special tokens are added, and the string of an
    added token in a text is that token, as in the library) and each ends with ``end_id``, so that an empty or null
    text has one id. Returns doc_id, start (ids of the document before the piece), length, ids (little-endian unsigned
    32-bit integers), ids_crc32, doc_tokens (with the end id), sequence_id (from 0, without gaps) and offset (in the
    sequence, without gaps). ``window`` is a power of two. Every sequence is full, or a power of two long. Rows that share
    a doc_id are separate documents; null doc_ids stay null. An empty table gives no pieces. Documents follow
    each other as they are read.
    """
    if window < 1 or window & (window - 1):
        raise ValueError("the window must be a power of two")
    rows = encode(docs, model, end_id)
    parts = rows.groupBy("part").agg(F.sum("n").alias("n"))  # one row per task
    running = F.sum("n").over(W.partitionBy(F.lit(0)).orderBy("part").rowsBetween(W.unboundedPreceding, W.currentRow))
    parts = parts.select("part", (running - F.col("n")).alias("base"), F.sum("n").over(W.partitionBy(F.lit(0))).alias("total"))
    placed = rows.join(F.broadcast(parts), "part").select("doc_id", (F.col("base") + F.col("ahead")).alias("place"), "n", "total", "bits", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, len(b), 256):  # a few texts at a time
                piece = b.slice(lo, 256)
                place, size = piece.column(1).to_numpy(), piece.column(2).to_numpy()
                bits = piece.column(4)[0].as_py()
                row, start, length, sequence, offset = cut(place, size, piece.column(3)[0].as_py(), window)
                texts = [np.frombuffer(v.as_buffer(), f"<u{bits // 8}").astype("<u4") for v in piece.column(5)]
                data = [texts[r][s:s + n].tobytes() for r, s, n in zip(row.tolist(), start.tolist(), length.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0).take(pa.array(row)), pa.array(start), pa.array(length), pa.array(data, pa.binary()),
                     pa.array(list(map(zlib.crc32, data)), pa.int64()), pa.array(size[row]), pa.array(sequence), pa.array(offset)],
                    names=["doc_id", "start", "length", "ids", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return placed.mapInArrow(run, PIECES)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids, offsets) from the result of pack(): every sequence's ids, and the documents in it by
    offset. A sequence gathers at most a window of ids."""
    each = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "ids")))
    rows = packed.groupBy("sequence_id").agg(each.alias("p"))
    joined = F.aggregate("p", F.lit(b""), lambda done, x: F.concat(done, x["ids"]))
    return rows.select("sequence_id", joined.alias("ids"), F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("offsets"))
