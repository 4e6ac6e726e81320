"""Byte-level BPE encoding and decoding with a global distinct-word shuffle.

1. Split: texts are cut into pre-tokens, and each run of documents (a batch) is written as positions:
   its distinct pre-tokens, and for each document the sequence of their numbers. The table is bucketed
   by batch, so it needs no shuffle when the ids come back.
2. Encode: the distinct pre-tokens of all batches are exploded and shuffled by word; each word is
   encoded once, wherever and however often it stands. A word has one row per batch that holds it.
3. Join: the ids return to their batches, one row per word partition and batch, and every document is
   reassembled by position.

Decoding joins ids with the token-byte table, whose size is the vocabulary's.
"""

from __future__ import annotations

import base64
import re
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waitcast.llm.scratch import folder, partitions

#: A batch ends at so many bytes of text, or after one longer text; bounds a task's memory.
BATCH_BYTES = 1 << 25
#: Texts are cut in groups of about so many bytes, and so many distinct chunks are cut further at a time.
GROUP_BYTES = 1 << 21
GROUP_CHUNKS = 1 << 14
#: Words whose ids are sent back in one row at most.
SEND_WORDS = 1 << 20
#: Documents of a batch stored in one row: up to about so many positions.
ROW_WORDS = 1 << 18


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a .tiktoken file: token bytes in base64 and rank on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


_LOOSE_SPACE = re.compile(r" (?:\s|\Z)")
_CHUNK = re.compile(r"(?= \S)")
#: The same for Arrow, whose white space is a superset of Python's.
_MAYBE_LOOSE = r" (?:[\s\x0b\x1c-\x1f\x{85}\p{Z}]|$)"


def chunks(text: str) -> list[str]:
    """The text cut before each space that comes before something else than white space, the space left out.

    No pre-token reaches over such a place: a space goes with what follows it, and runs of white space
    leave their last space to it. Chunks repeat more often than texts and are cut further only once.
    """
    if _LOOSE_SPACE.search(text) is None:
        return text.split(" ")
    first, *rest = _CHUNK.split(text)
    # a text that starts with a space has its first chunk empty
    return [first, *[c[1:] for c in rest]]


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of all entries of the runs [start, start + size)."""
    ends = np.cumsum(sizes)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.int64)
    return np.arange(ends[-1]) + np.repeat(starts - (ends - sizes), sizes)


def cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """chunks() of some texts (large strings without nulls), one text after another, and how many each text has."""
    loose = pc.match_substring_regex(texts, _MAYBE_LOOSE).to_numpy(zero_copy_only=False)
    strict = pc.split_pattern(texts.filter(pa.array(~loose)), " ")
    flat, sizes = strict.flatten(), np.diff(strict.offsets.to_numpy())
    if not loose.any():
        return flat, sizes
    lists = [chunks(t) for t in texts.filter(pa.array(loose)).to_pylist()]
    flat = pa.concat_arrays([flat, pa.array(chain.from_iterable(lists), pa.large_string())])
    sizes = np.concatenate([sizes, np.fromiter(map(len, lists), np.int64, len(lists))])
    order = np.argsort(np.concatenate([np.flatnonzero(~loose), np.flatnonzero(loose)]))
    return flat.take(pa.array(ragged((np.cumsum(sizes) - sizes)[order], sizes[order]))), sizes[order]


def numbered(parts: list[pa.DictionaryArray]) -> tuple[pa.Array, np.ndarray]:
    """The different values of all parts, and the number of each entry's value. Empties the list."""
    one = pa.chunked_array(parts).unify_dictionaries()
    parts.clear()
    return one.chunk(0).dictionary, np.concatenate([c.indices.to_numpy() for c in one.chunks])


def pack(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, byte plane by byte plane, in Zstandard."""
    planes = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


class Batch:
    """Documents cut into chunks. Chunks are held once for each group of texts, texts as numbers of their chunks."""

    def __init__(self) -> None:
        self.ids, self.sizes, self.chunks, self.bytes = [], [], [], 0

    def add(self, ids: pa.Array, texts: pa.Array) -> None:
        flat, sizes = cut(texts)
        self.ids.append(ids)
        self.sizes.append(sizes)
        self.chunks.append(flat.dictionary_encode())
        self.bytes += texts.nbytes

    def words(self, pattern: str) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """The batch's pre-tokens; which of them each different chunk has, one chunk after another; how many it has; and the
        chunks of all texts by number."""
        known, code = numbered(self.chunks)
        # a text's first chunk has no space before it and is another one than the same chunk after a space
        code *= 2
        code += 1
        n = np.concatenate(self.sizes)
        code[np.cumsum(n) - n] -= 1
        used = np.zeros(2 * len(known), bool)
        used[code] = True
        sequence = (np.cumsum(used, dtype=np.int32) - 1)[code]
        del code
        used = np.flatnonzero(used)
        find, sizes, parts = regex.compile(pattern).findall, [], []
        for lo in range(0, len(used), GROUP_CHUNKS):
            some = used[lo:lo + GROUP_CHUNKS]
            found = [find(f" {c}" if spaced else c) for c, spaced in zip(known.take(pa.array(some >> 1)).to_pylist(), (some & 1).tolist(), strict=True)]
            sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
            parts.append(pa.array(chain.from_iterable(found), pa.string()).dictionary_encode())
        return *numbered(parts), np.concatenate(sizes), sequence

    def rows(self, name: int, pattern: str) -> Iterator[pa.RecordBatch]:
        words, flat, size, sequence = self.words(pattern)
        at = np.cumsum(size) - size
        ids, lengths = pa.concat_arrays(self.ids), np.concatenate(self.sizes)
        # positions of some documents in each row, and some of the words
        ends = np.cumsum(lengths)
        group = (ends - lengths) // ROW_WORDS
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(lengths)]
        share = -(-len(words) // (len(cuts) - 1))
        for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            part = sequence[ends[a] - lengths[a]:ends[b - 1]]
            last = np.cumsum(np.concatenate([[0], size[part]]))[np.cumsum(lengths[a:b])]
            sizes = np.diff(np.concatenate([[0], last]))
            own = words.slice(i * share, share)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name], pa.int64()), pa.ListArray.from_arrays([0, b - a], ids.slice(a, b - a)), pa.ListArray.from_arrays([0, b - a], pa.array(sizes)),
                 pa.array([pack(flat[ragged(at[part], size[part])])], pa.binary()), pa.array([i * share], pa.int64()), pa.ListArray.from_arrays([0, len(own)], own)],
                names=["batch", "ids", "sizes", "positions", "base", "words"])


def split(docs: DataFrame, pattern: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Positions of the pre-tokens of ``docs`` (doc_id, text), batch by batch, as a table bucketed by batch.

    batch; ids, sizes: doc_id and number of pre-tokens of some documents; positions: the numbers of their
    pre-tokens, packed; words: some of the batch's pre-tokens, numbered from base.
    """
    spark: SparkSession = docs.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = TaskContext.get().partitionId() << 32
        batch, most = Batch(), min(GROUP_BYTES, batch_bytes)
        for b in batches:
            texts, at = pc.fill_null(b.column(1).cast(pa.large_string()), ""), 0
            ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
            while at < len(b):
                upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
                batch.add(b.column(0).slice(at, upto - at), texts.slice(at, upto - at))
                at = upto
                if batch.bytes >= batch_bytes:
                    yield from batch.rows(name, pattern)
                    name, batch = name + 1, Batch()
        if batch.ids:
            yield from batch.rows(name, pattern)
        del batch
        pa.default_memory_pool().release_unused()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "batch long, ids array<long>, sizes array<long>, positions binary, base long, words array<string>")
    table = f"positions_{uuid.uuid4().hex}"
    (rows.write.format("parquet").option("compression", "zstd").bucketBy(partitions(spark), "batch").sortBy("batch")
     .saveAsTable(table, path=folder(spark, "positions")))
    return spark.table(table)


def encode_words(split_rows: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """(batch, at, sizes, ids): the ids of each batch's pre-tokens, packed, in some rows of many words each."""
    n = partitions(split_rows.sparkSession)
    words = split_rows.select("batch", "base", F.posexplode("words").alias("at", "word")).withColumn("at", (F.col("base") + F.col("at")).cast("int"))
    words = words.repartition(n, "word").sortWithinPartitions("word")

    def send(held: list[tuple[np.ndarray, ...]], encoded: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        size, flat = map(np.concatenate, zip(*encoded, strict=True))
        start = np.cumsum(size) - size
        batch, at, which = map(np.concatenate, zip(*held, strict=True))
        order = np.lexsort((at, batch))
        batch, at, which = batch[order], at[order], which[order]
        cuts = [0, *(np.flatnonzero(np.diff(batch)) + 1).tolist(), len(batch)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            w = which[a:b]
            yield pa.RecordBatch.from_arrays(
                [pa.array(batch[a:a + 1]), *[pa.array([pack(x)], pa.binary()) for x in (np.diff(at[a:b], prepend=0), size[w], flat[ragged(start[w], size[w])])]],
                names=["batch", "at", "sizes", "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        last, last_ids, known, n_rows, encoded, held = None, [], 0, 0, [], []
        for b in batches:
            # rows come sorted, so equal words follow each other, over batches too
            codes = b.column(2).dictionary_encode()
            fresh = codes.dictionary.to_pylist()
            if not fresh:
                continue
            if fresh[0] == last and not known:
                encoded, known = [_flat([last_ids])], 1
            again = int(fresh[0] == last)
            lists = [encode(w) for w in fresh[again:]]
            held.append((b.column(0).to_numpy(), b.column(1).to_numpy(), codes.indices.to_numpy() + (known - again)))
            encoded.append(_flat(lists))
            last, last_ids, known, n_rows = fresh[-1], lists[-1] if lists else last_ids, known + len(lists), n_rows + len(b)
            if n_rows >= SEND_WORDS:
                yield from send(held, encoded)
                known, n_rows, encoded, held = 0, 0, [], []
        if held:
            yield from send(held, encoded)

    return words.select("batch", "at", "word").mapInArrow(run, "batch long, at binary, sizes binary, ids binary")


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """Sizes of some lists, and their entries."""
    size = np.fromiter(map(len, lists), np.int64, len(lists))
    return size, np.fromiter(chain.from_iterable(lists), np.uint32, int(size.sum()))


def _reassemble(positions: pa.Table, words: pa.Table) -> pa.Table:
    """(doc_id, ids) of one batch: each document's ids by position, as little-endian unsigned 32-bit integers."""
    place, size, ids = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (
        [np.cumsum(unpack(v.as_py()).astype(np.int64)) for v in words.column("at")],
        [unpack(v.as_py()).astype(np.int64) for v in words.column("sizes")],
        [unpack(v.as_py()) for v in words.column("ids")]))
    start_of, size_of = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    start_of[place], size_of[place] = np.cumsum(size) - size, size
    out = []
    for row in range(positions.num_rows):
        sequence = unpack(positions.column("positions")[row].as_py())
        n_ids, n_words = size_of[sequence], positions.column("sizes")[row].values.to_numpy()
        found = ids[ragged(start_of[sequence], n_ids)].astype("<u4")
        ends = np.concatenate([[0], np.cumsum(n_ids)])[np.concatenate([[0], np.cumsum(n_words)])]
        names = positions.column("ids")[row].values
        out.append(pa.RecordBatch.from_arrays([names, _binary(4 * ends, found)], names=["doc_id", "ids"]))
    return pa.Table.from_batches(out, pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())]))


def _binary(ends: np.ndarray, data: np.ndarray) -> pa.Array:
    """Binary values that follow each other in ``data``; ``ends``: 0 and the end of each in bytes."""
    wide = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data)])
    return wide.cast(pa.binary())


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id and ids.

    ids: little-endian unsigned 32-bit integers, as the tiktoken library gives them for the whole text with
    these ranks and pattern and no special tokens. A null text is empty and has no ids. The pattern must let
    a space go with what follows it and leave the last one of several to it, as patterns of byte-level BPE do.
    """
    rows = split(docs, pattern, batch_bytes)
    found = encode_words(rows, ranks, pattern)
    both = rows.select("batch", "ids", "sizes", "positions").groupBy("batch").cogroup(found.groupBy("batch"))
    return both.applyInArrow(_reassemble, "doc_id long, ids binary")


def decode(tokens: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """``tokens`` (all columns, among them ids as from encode) with ``decoded``, the bytes that the ids stand for.

    Null ids give null. An id that the ranks lack is an error.
    """
    table = sorted(ranks.items(), key=lambda t: t[1])
    ids = np.array([i for _, i in table], np.int64)
    size, start = (np.full(int(ids.max()) + 1 if len(ids) else 0, -1, np.int64) for _ in range(2))
    lengths = np.array([len(t) for t, _ in table], np.int64)
    size[ids], start[ids] = lengths, np.cumsum(lengths) - lengths
    data = np.frombuffer(b"".join(t for t, _ in table), np.uint8)
    tokens = tokens.drop("decoded") if "decoded" in tokens.columns else tokens
    names, at = tokens.columns, tokens.columns.index("ids")

    def bytes_of(texts: pa.Array) -> pa.Array:
        lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64) // 4
        found = np.frombuffer(b"".join(v.as_buffer() for v in texts if v.is_valid), "<u4")
        if len(found) and (found.max() >= len(size) or size[found].min() < 0):
            raise ValueError("an id is not in the vocabulary")
        n = size[found]
        ends = np.concatenate([[0], np.cumsum(n)])[np.concatenate([[0], np.cumsum(lengths)])]
        decoded = _binary(ends, data[ragged(start[found], n)])
        return decoded if not texts.null_count else pc.if_else(pc.is_valid(texts), decoded, pa.scalar(None, pa.binary()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, len(b), 256):  # a few texts at a time
                part = b.slice(lo, 256)
                yield pa.RecordBatch.from_arrays([*part.columns, bytes_of(part.column(at))], names=[*names, "decoded"])

    return tokens.mapInArrow(run, T.StructType([*tokens.schema.fields, T.StructField("decoded", T.BinaryType())]))
