"""Substring dedup over a compacted De Bruijn graph of words.

A window of ``window`` words is a path in the graph of word k-mers. Its node with the smallest hash
(of k-mers of ``node`` words) is its minimiser; the run of consecutive windows with the same
minimiser is one compacted edge: anchor hash, hash of all words it covers, and source coordinates
(document, first word, number of windows). Equal windows have the same minimiser at the same place,
so a window can only be repeated where its anchor is. About one edge per 14 words is shuffled
instead of 35-word windows at every word.

1. Edges whose anchor stands only once are dropped (aggregate by anchor, join back).
2. Equal edges (anchor and content) compact into one; an edge with two or more sources is a
   nonbranching repeated path: all its windows are repeated, and its coordinates become spans.
3. Where an anchor branches (edges of different content), one source of each edge is taken apart
   into its windows, and these are counted with the edges' weights.
4. A document meets its spans once, by a join, and loses the words they cover.

Anchor and content (or window) hash together have 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waitcast.llm import words
from waitcast.llm.scratch import materialise, text_or_empty

#: Fixed value of the contract query: words of a window.
WINDOW = 35
#: Words of a node.
NODE = 8

_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
_BACK = np.uint64(pow(int(_STEP), -1, 1 << 64))


class SpanHash:
    """64-bit hashes of any runs of entries of ``h``, from running sums."""

    def __init__(self, h: np.ndarray):
        with np.errstate(over="ignore"):
            self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * words.powers(len(h), _STEP))])
        self.back = words.powers(len(h) + 1, _BACK)

    def __call__(self, first: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return words.mixed((self.sums[first + size] - self.sums[first]) * self.back[first] + np.asarray(size).astype(np.uint64))


def edges(g: words.Group, window: int, node: int) -> tuple[np.ndarray, ...]:
    """Compacted edges of a group of texts: anchor hash, content hash, text, first word, number of windows."""
    n = g.n_words
    doc = np.repeat(np.arange(len(n)), n)
    nodes = words.rolled(g.hash, node)
    starts = max(len(g.hash) - window + 1, 0)
    first = np.flatnonzero(doc[:starts] == doc[window - 1:]) if starts else np.zeros(0, np.int64)
    if not len(first):
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    place = np.lib.stride_tricks.sliding_window_view(nodes, window - node + 1)[:starts].argmin(1)  # the leftmost of equal ones
    anchor = first + place[first]
    new = np.ones(len(first), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[first[1:]] != doc[first[:-1]])
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(first)))
    begin = first[at]
    content = SpanHash(g.hash)(begin, size + window - 1)
    text = doc[begin]
    return nodes[anchor[at]], content, text, begin - g.word_at[text], size


def _keyed(docs: DataFrame) -> DataFrame:
    """doc_id, r (hash of the text; both tell rows apart, rows alike in both fare alike) and text."""
    text = text_or_empty()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("r"), text.alias("text"))


def compacted_edges(docs: DataFrame, window: int = WINDOW, node: int = NODE) -> DataFrame:
    """(anchor, content, doc_id, r, first, windows) for each compacted edge of each row of ``docs``."""
    names = ["anchor", "content", "doc_id", "r", "first", "windows"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g in words.groups(batch.column(2)):
                anchor, content, text, first, size = edges(g, window, node)
                rows = pa.array(text + g.rows.start)
                yield pa.RecordBatch.from_arrays([pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64)), batch.column(0).take(rows),
                                                  batch.column(1).take(rows), pa.array(first, pa.int32()), pa.array(size, pa.int32())], names=names)

    return _keyed(docs).mapInArrow(run, "anchor long, content long, doc_id long, r long, first int, windows int")


def _windows(docs: DataFrame, taken: DataFrame, window: int) -> DataFrame:
    """(anchor, hash, doc_id, r, first, sources) for each window of the edges ``taken``."""
    lists = taken.groupBy("doc_id", "r").agg(F.collect_list(F.struct("anchor", "first", "windows", "sources")).alias("edges"))
    lists = lists.select(F.col("doc_id").alias("l_id"), F.col("r").alias("l_r"), "edges")
    both = _keyed(docs).join(lists, F.col("doc_id").eqNullSafe(F.col("l_id")) & (F.col("r") == F.col("l_r"))).select("doc_id", "r", "text", "edges")
    names = ["anchor", "hash", "doc_id", "r", "first", "sources"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(3)
            ends, entries = column.offsets.to_numpy(), column.values
            anchor, first, size, sources = (entries.field(i).to_numpy() for i in range(4))
            for g in words.groups(batch.column(2)):
                lo, hi = ends[g.rows.start], ends[g.rows.stop]
                text = np.repeat(np.arange(len(g.rows)), np.diff(ends[g.rows.start:g.rows.stop + 1]))
                each = size[lo:hi].astype(np.int64)
                own = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)  # window number in its edge
                start = np.repeat(first[lo:hi].astype(np.int64), each) + own
                text = np.repeat(text, each)
                hashed = SpanHash(g.hash)(g.word_at[text] + start, window)
                rows = pa.array(text + g.rows.start)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(anchor[lo:hi], each)), pa.array(hashed.view(np.int64)), batch.column(0).take(rows),
                                                  batch.column(1).take(rows), pa.array(start, pa.int32()), pa.array(np.repeat(sources[lo:hi], each))], names=names)

    return both.mapInArrow(run, "anchor long, hash long, doc_id long, r long, first int, sources long")


def repeated_spans(docs: DataFrame, window: int = WINDOW, node: int = NODE) -> DataFrame:
    """(doc_id, r, first, size): spans of words that repeated windows cover; spans may overlap."""
    every = compacted_edges(docs, window, node)
    # aggregated sides are written before the joins, so that AQE can split a hot anchor
    often = every.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    often = materialise(often, "substring-anchors")
    found = materialise(every.join(often, "anchor"), "substring-edges")

    source = F.struct("doc_id", "r", "first", "windows")
    compact = found.groupBy("anchor", "content").agg(F.count(F.lit(1)).alias("sources"), F.min(source).alias("s"))
    compact = materialise(compact, "substring-compact")
    spans = found.join(compact.where("sources > 1").select("anchor", "content"), ["anchor", "content"]).select(
        "doc_id", "r", "first", (F.col("windows") + (window - 1)).alias("size"))

    branching = compact.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    branching = materialise(branching, "substring-branching")
    taken = compact.join(branching, "anchor").select("anchor", "s.doc_id", "s.r", "s.first", "s.windows", "sources")
    apart = materialise(_windows(docs, taken, window), "substring-windows")
    # rows alike in id and text yield an edge's windows once each; they have two sources then anyway
    again = apart.groupBy("anchor", "hash").agg(F.sum("sources").alias("n")).where("n > 1").select("anchor", "hash")
    again = materialise(again, "substring-again")
    single = apart.where("sources = 1").join(again, ["anchor", "hash"]).select("doc_id", "r", "first", F.lit(window).alias("size"))
    return spans.union(single)


def dedup_substrings(docs: DataFrame, window: int = WINDOW, node: int = NODE) -> DataFrame:
    """``docs`` (all columns) with n_words, n_removed and kept_text.

    Words are runs of anything but ASCII white space; a null text has none. Each word goes that is covered
    by a window of ``window`` consecutive words which also starts anywhere else, in the same document or
    another; repeated rows count as further documents. The kept words are joined by one space. A text of
    fewer words than a window stays whole.
    """
    docs = docs.drop(*[c for c in ("n_words", "n_removed", "kept_text") if c in docs.columns])
    spans = repeated_spans(docs, window, node).groupBy("doc_id", "r").agg(F.collect_list(F.struct("first", "size")).alias("_llm_spans"))
    spans = spans.select(F.col("doc_id").alias("_llm_id"), F.col("r").alias("_llm_r"), "_llm_spans")
    text = text_or_empty()
    rows = docs.join(spans, F.col("doc_id").cast("long").eqNullSafe(F.col("_llm_id")) & (F.xxhash64(text) == F.col("_llm_r")), "left").drop("_llm_id", "_llm_r")
    schema = T.StructType(docs.schema.fields[:]).add("n_words", "long").add("n_removed", "long").add("kept_text", "string")
    at, width, names = docs.columns.index("text"), len(docs.columns), schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for value, found in zip(batch.column(at), batch.column(width), strict=True):
                split = (value.as_py() or "").encode().split()  # at ASCII white space
                n_words.append(len(split))
                if found.is_valid:
                    entries = found.values
                    change = np.zeros(len(split) + 1, np.int64)
                    first, size = entries.field(0).to_numpy(), entries.field(1).to_numpy()
                    np.add.at(change, first, 1)
                    np.add.at(change, first + size, -1)
                    stays = np.cumsum(change[:-1]) == 0
                    split = [w for w, s in zip(split, stays.tolist(), strict=True) if s]
                n_removed.append(n_words[-1] - len(split))
                kept.append(b" ".join(split))
            new = [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:width], *new], names=names)

    return rows.mapInArrow(run, schema)
