"""Token ids in files: fixed-width bit packing in blocks.

A token file set is a folder of Parquet files of blocks, one file per range of doc_id, in ascending
order of the range number ``part``. A block holds whole documents, about 65,536 ids, each id in the
fewest bits that hold the vocabulary, little-endian, without gaps: id i of a block stands at bit
i * bits of ``data``, so any slice is read without the rest. A block's row also tells the document
ids, where in the block each document starts, and the number of ids ahead of the block in its part.

Parquet is the container: blocks are written by Spark's committer, so a lost executor leaves no
partial file, and any store that Spark writes will do.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from waitcast.llm.chunk_codes import large, pieces, worker_encoder
from waitcast.llm.scratch import folder, partitions, text_or_empty

BLOCK_IDS = 1 << 16
BLOCK_SCHEMA = "part int, block int, ahead long, n_ids long, bits int, doc_ids array<long>, starts array<long>, data binary"


def width(vocabulary: int) -> int:
    """Bits that hold the ids 0 to vocabulary - 1."""
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """Eight ids fill ``bits`` bytes; each id is shifted into the bytes that it reaches over."""
    n = len(ids)
    eights = np.zeros((n + 7) // 8 * 8, np.uint64)
    eights[:n] = ids
    eights = eights.reshape(-1, 8)
    out = np.zeros((len(eights), bits), np.uint8)
    for k in range(8):
        first, shift = divmod(k * bits, 8)
        value = eights[:, k] << np.uint64(shift)
        for j in range((shift + bits + 7) // 8):
            out[:, first + j] |= (value >> np.uint64(8 * j)).astype(np.uint8)
    return out.tobytes()[:(n * bits + 7) // 8]


def unpack_bits(data: bytes | memoryview, bits: int, first: int, n: int) -> np.ndarray:
    """Ids first to first + n - 1 of a block; reads only their bytes."""
    lo = first * bits // 8
    part = np.frombuffer(data, np.uint8)[lo:((first + n) * bits + 7) // 8]
    padded = np.concatenate([part, np.zeros(8, np.uint8)])
    wide = np.ndarray((len(part) + 1,), "<u8", padded, strides=(1,))  # the 8 bytes from each byte on
    at = np.arange(first, first + n, dtype=np.int64) * bits - 8 * lo
    return ((wide[at >> 3] >> (at & 7).astype(np.uint64)) & np.uint64((1 << bits) - 1)).astype("<u4")


@dataclass(frozen=True)
class TokenFiles:
    """A token file set at ``path``."""

    spark: SparkSession
    path: str

    def blocks(self) -> DataFrame:
        return self.spark.read.schema(BLOCK_SCHEMA).parquet(self.path)

    def read(self, doc_ids: list[int] | None = None) -> DataFrame:
        """(doc_id, start, n_tokens, ids) of all documents, or of some: start counts the ids of all documents
        before it in the set; ids are little-endian unsigned 32-bit integers, the end id included."""
        blocks = self.blocks()
        ends = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))  # one row per file
        before = F.sum("n").over(W.partitionBy(F.lit(0)).orderBy("part").rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("n")
        ends = ends.select("part", before.alias("base"))
        if doc_ids is not None:
            blocks = blocks.where(F.arrays_overlap("doc_ids", F.array(*[F.lit(d).cast("long") for d in doc_ids])))
        wanted = None if doc_ids is None else set(doc_ids)
        rows = blocks.join(F.broadcast(ends), "part").select((F.col("base") + F.col("ahead")).alias("base"), "n_ids", "bits", "doc_ids", "starts", "data")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for base, n, bits, names, starts, data in zip(*b.columns, strict=True):
                    names, starts = names.as_py(), starts.values.to_numpy()
                    size = np.diff(starts, append=n.as_py())
                    kept = [i for i, d in enumerate(names) if wanted is None or d in wanted]
                    ids = [unpack_bits(data.as_buffer(), bits.as_py(), int(starts[i]), int(size[i])).tobytes() for i in kept]
                    yield pa.RecordBatch.from_arrays([pa.array([names[i] for i in kept], pa.int64()), pa.array(starts[kept] + base.as_py(), pa.int64()),
                                                      pa.array(size[kept], pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"])

        return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def write(docs: DataFrame, model: str, end_id: int = 0, path: str | None = None, block_ids: int = BLOCK_IDS) -> TokenFiles:
    """Encode ``docs`` (doc_id, text) with the tokenizers model (its JSON; no special tokens are added, and the
    string of an added token in a text is that token, as in the library), end each document with ``end_id``,
    and write them in ascending order of doc_id.

    Documents without doc_id come first; rows that share a doc_id follow each other in the order of a
    hash of their texts. A null text is empty and has the end id alone. An empty table gives an empty set.
    """
    spark: SparkSession = docs.sparkSession
    path = path or folder(spark, "token-files")
    bits = width(max(Tokenizer.from_str(model).get_vocab_size(), end_id + 1))
    text = text_or_empty()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("tie"))
    rows = rows.repartitionByRange(partitions(spark), "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, block, ahead = worker_encoder(model), TaskContext.get().partitionId(), 0, 0
        names, held, n = [], [], 0

        def row() -> pa.RecordBatch:
            sizes = np.fromiter(map(len, held), np.int64, len(held))
            data = pack_bits(np.concatenate(held), bits)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([ahead]), pa.array([n]), pa.array([bits], pa.int32()),
                 pa.array([names], pa.list_(pa.int64())), pa.array([np.cumsum(sizes) - sizes], pa.list_(pa.int64())), pa.array([data], pa.binary())],
                names=["part", "block", "ahead", "n_ids", "bits", "doc_ids", "starts", "data"])

        for b in batches:
            at = 0
            for piece in pieces(large(b.column(1))):
                for name, ids in zip(b.column(0).slice(at, len(piece)).to_pylist(), encoder(piece).ended(end_id).each(), strict=True):
                    names.append(name)
                    held.append(ids)
                    n += len(ids)
                    if n >= block_ids:
                        yield row()
                        block, ahead = block + 1, ahead + n
                        names, held, n = [], [], 0
                at += len(piece)
        if names:
            yield row()

    rows.mapInArrow(run, BLOCK_SCHEMA).write.option("compression", "none").parquet(path)
    return TokenFiles(spark, path)
