"""MinHash near-dedup: one-permutation hashing, optimal densification, banded buckets, star edges.

Each distinct shingle set (copies are collapsed first) gets one signature from a single hash pass:
the hash picks a bin and its rest competes for the bin's minimum; an empty bin borrows from a bin
that a hash sequence of its own picks, until one is not empty. Bands of the signature are bucket
keys. Inside a bucket each set is paired with the bucket's centre only, so pairs grow with the
number of rows, not with its square. Pairs are confirmed on the full sets.

A star can miss a link between two sets that are both unlike the centre. So further rounds draw new
centres in the buckets that still hold sets of several components. What is still apart then is
compared completely, but not as pairs: a bucket's sets are dealt into blocks, a task takes two blocks
and multiplies their incidence matrices, and only links come out. So no pair that shares a bucket is
left open, a large bucket is spread over many tasks, and no list of its pairs is ever made. Sets that
are in the bucket's main component already are not compared with each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waitcast.llm import words
from waitcast.llm.components import components
from waitcast.llm.scratch import materialise


@dataclass(frozen=True)
class Params:
    """shingle: words per shingle. Sets are linked with 100 * intersection >= percent * union. bands of rows
    values each: two sets of similarity 0.8 share no bucket with a chance of (1 - 0.8 ** 6) ** 40 = 5e-6.
    rounds: of drawn centres. block: sets of a bucket that a task compares with as many others."""

    shingle: int = 5
    percent: int = 80
    bands: int = 40
    rows: int = 6
    rounds: int = 1
    block: int = 256

    @property
    def bins(self) -> int:
        return self.bands * self.rows


def shingle_sets(g: words.Group, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct k-word shingle hashes of each text of a group: (text, hash), sorted.

    A text of fewer words has its whole sequence as its one shingle; one without words has none.
    """
    n = g.n_words
    doc = np.repeat(np.arange(len(n)), n)
    h = words.rolled(g.hash, k)
    inside = doc[:len(h)] == doc[k - 1:] if len(h) else np.zeros(0, bool)
    d, s = doc[:len(h)][inside], h[inside]
    for i in np.flatnonzero((n > 0) & (n < k)):
        d = np.append(d, i)
        s = np.append(s, words.rolled(g.hash[g.word_at[i]:g.word_at[i + 1]], int(n[i])))
    order = np.lexsort((s, d))
    d, s = d[order], s[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (s[1:] != s[:-1])
    return d[new], s[new]


def set_digest(d: np.ndarray, s: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size of each text's set, and two sums over hashes of its shingles that name the set."""
    size = np.bincount(d, minlength=n)
    out = []
    with np.errstate(over="ignore"):
        for salt in (0x1D8E4E27C47D124F, 0xEB44ACCAB455D165):
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words.mixed(s ^ np.uint64(salt)))])
            end = np.cumsum(size)
            out.append(total[end] - total[end - size])
    return size, out[0].view(np.int64), out[1].view(np.int64)


def signatures(d: np.ndarray, s: np.ndarray, n: int, bins: int) -> np.ndarray:
    """One-permutation MinHash with optimal densification: texts x bins; texts without shingles get zeros."""
    where = (s >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)  # the upper half picks the bin
    value = words.mixed(s) >> np.uint64(1)
    none = np.uint64((1 << 64) - 1)
    sig = np.full(n * bins, none, np.uint64)
    np.minimum.at(sig, d * bins + where.astype(np.int64), value)
    sig = sig.reshape(n, bins)
    filled = sig != none
    empty_text = ~filled.any(1)
    filled[empty_text] = True
    sig[empty_text] = 0
    out = sig.copy()
    row, col = np.nonzero(~filled)
    attempt = 1
    while len(row):
        with np.errstate(over="ignore"):
            pick = words.mixed(col.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(attempt))
        donor = ((pick >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
        good = filled[row, donor]
        out[row[good], col[good]] = sig[row[good], donor[good]]
        row, col = row[~good], col[~good]
        attempt += 1
    return out


def band_keys(sig: np.ndarray, p: Params) -> np.ndarray:
    """Bucket key of each band: texts x bands."""
    out = np.zeros((len(sig), p.bands), np.uint64)
    with np.errstate(over="ignore"):
        out += np.arange(1, p.bands + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        for r in range(p.rows):
            out = words.mixed(out ^ sig[:, r::p.rows][:, :p.bands])
    return out


def _sketch(docs: DataFrame, p: Params) -> DataFrame:
    """(doc_id, n_shingles, d1, d2, keys): the set's size and digest, and its bucket keys, for each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g in words.groups(batch.column(1), fold=words.FOLD):
                n = len(g.rows)
                d, s = shingle_sets(g, p.shingle)
                size, d1, d2 = set_digest(d, s, n)
                keys = band_keys(signatures(d, s, n, p.bins), p).view(np.int64)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * p.bands), pa.array(keys.ravel()))
                ids = batch.column(0).slice(g.rows.start, n)
                yield pa.RecordBatch.from_arrays([ids, pa.array(size, pa.int64()), pa.array(d1), pa.array(d2), lists],
                                                 names=["doc_id", "n_shingles", "d1", "d2", "keys"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, d1 long, d2 long, keys array<long>")


def _sets(docs: DataFrame, p: Params) -> DataFrame:
    """(doc_id, shingles): the distinct shingle hashes of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g in words.groups(batch.column(1), fold=words.FOLD):
                d, s = shingle_sets(g, p.shingle)
                cut = np.concatenate([[0], np.cumsum(np.bincount(d, minlength=len(g.rows)))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(cut), pa.array(s.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(g.rows.start, len(g.rows)), lists], names=["doc_id", "shingles"])

    return docs.mapInArrow(run, "doc_id long, shingles array<long>")


def _confirm(pairs: DataFrame, sets: DataFrame, p: Params) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    both = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("s_a")), "a")
    both = both.join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("s_b")), "b")
    common = F.size(F.array_intersect("s_a", "s_b"))
    both = both.select("a", "b", common.alias("common"), (F.size("s_a") + F.size("s_b")).alias("total"))
    return both.where(100 * F.col("common") >= p.percent * (F.col("total") - F.col("common"))).select("a", "b")


def _pairs(rows: DataFrame, a: str, n_a: str, b: str, n_b: str, p: Params) -> DataFrame:
    """Distinct pairs (a < b) of the columns a and b, without those whose sizes rule a link out."""
    rows = rows.where(100 * F.least(n_a, n_b) >= p.percent * F.greatest(n_a, n_b))
    return rows.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a < b").distinct()


def _shared(numbers: list[np.ndarray]) -> np.ndarray:
    """Numbers that each two of the lists share: their incidence matrix times its transpose, some columns at a time."""
    n = len(numbers)
    row = np.repeat(np.arange(n), [len(x) for x in numbers])
    _, column, times = np.unique(np.concatenate(numbers), return_inverse=True, return_counts=True)
    several = times[column] > 1
    row, column = row[several], np.unique(column[several], return_inverse=True)[1]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out, width = np.zeros((n, n), np.float32), 4096
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, (lo, lo + width))
        part = np.zeros((n, width), np.float32)
        part[row[a:b], column[a:b] - lo] = 1
        out += part @ part.T
    return out


def _blockwise(apart: DataFrame, sets: DataFrame, p: Params) -> DataFrame:
    """Pairs (a, b) of sets in a bucket (bucket, rep, part) but in different parts that may be linked.

    Compares 32-bit halves of the shingle hashes, which is enough to rule nearly all other pairs out.
    """
    sizes = apart.groupBy("bucket", "part").agg(F.count(F.lit(1)).alias("members"))
    main = sizes.groupBy("bucket").agg(F.max(F.struct("members", "part")).alias("main"), F.sum("members").alias("members"))
    main = materialise(main.select("bucket", F.col("main.part").alias("main"), F.ceil(F.col("main.members") / p.block).cast("int").alias("main_blocks"),
                                   F.ceil((F.col("members") - F.col("main.members")) / p.block).cast("int").alias("rest_blocks")), "near-main")
    rows = apart.join(main, "bucket").withColumn("in_main", F.col("part") == F.col("main"))
    own = F.pmod(F.xxhash64("rep"), F.when(F.col("in_main"), F.col("main_blocks")).otherwise(F.col("rest_blocks"))).cast("int")
    pair = lambda kind, x, y: F.struct(F.lit(kind).alias("kind"), x.cast("int").alias("x"), y.cast("int").alias("y"))
    rest = F.sequence(F.lit(0), F.col("rest_blocks") - 1)
    with_main = F.transform(F.sequence(F.lit(0), F.col("main_blocks") - 1), lambda y: pair("main", own, y))
    with_rest = F.transform(rest, lambda y: pair("rest", F.least(own, y), F.greatest(own, y)))
    blocks = F.when(F.col("in_main"), F.transform(rest, lambda x: pair("main", x, own))).otherwise(F.concat(with_main, with_rest))
    rows = rows.select("bucket", "rep", "part", F.explode(blocks).alias("block"))
    half = sets.select(F.col("doc_id").alias("rep"), F.transform("shingles", lambda x: F.shiftright(x, 32).cast("int")).alias("halves"))
    rows = rows.join(half, "rep").select("bucket", "block.*", "rep", "part", "halves")

    def compare(group: pa.Table) -> pa.Table:
        rep, part = (group.column(c).to_numpy() for c in ("rep", "part"))
        full, numbers = np.zeros(len(rep), np.int64), []
        for i, x in enumerate(group.column("halves")):
            x = x.values.to_numpy()
            full[i] = len(x)
            numbers.append(np.unique(x))
        lost = full - np.array([len(x) for x in numbers])  # shingles of one set with the same half
        most = _shared(numbers) + np.minimum(lost[:, None], lost[None])
        near = (100 * most >= p.percent * (full[:, None] + full[None] - most)) & (part[:, None] < part[None])
        a, b = np.nonzero(near)
        return pa.table({"a": np.minimum(rep[a], rep[b]), "b": np.maximum(rep[a], rep[b])})

    return rows.groupBy("bucket", "kind", "x", "y").applyInArrow(compare, "a long, b long").distinct()


def links(docs: DataFrame, classes: DataFrame, p: Params) -> DataFrame:
    """Links (a, b) between representatives of different sets that join what is linked: (rep, n, keys) in.

    Not every link is listed, but two sets that links connect are connected by listed ones.
    """
    members = classes.select("rep", "n", F.explode("keys").alias("bucket"))
    draw = F.struct(F.xxhash64("rep").alias("by"), "rep", "n")
    crowd = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("members"), F.min(draw).alias("centre")).where("members > 1")
    crowd = materialise(crowd.select("bucket", F.col("centre.rep").alias("centre"), F.col("centre.n").alias("centre_n")), "near-centres")
    members = materialise(members.join(crowd, "bucket").select("bucket", "rep", "n", "centre", "centre_n"), "near-buckets")
    asked = members.select(F.col("rep").alias("doc_id")).distinct()
    sets = _sets(docs.join(asked, "doc_id", "left_semi"), p)
    # rows that share a doc_id are searched by the largest of their sets
    sets = materialise(sets.groupBy("doc_id").agg(F.max_by("shingles", F.struct(F.size("shingles"), F.xxhash64("shingles"))).alias("shingles")), "near-sets")

    tested = materialise(_pairs(members, "rep", "n", "centre", "centre_n", p), "near-pairs")
    found = materialise(_confirm(tested, sets, p), "near-links")
    for step in range(p.rounds + 1):
        parts = components(found)
        apart = members.select("bucket", "rep", "n").join(parts, F.col("rep") == F.col("node"), "left")
        apart = materialise(apart.select("bucket", "rep", "n", F.coalesce("component", "rep").alias("part")), "near-parts")
        drawn = F.struct(F.xxhash64("rep", "bucket", F.lit(step)).alias("by"), "rep", "n", "part")
        mixed = apart.groupBy("bucket").agg(F.min(drawn).alias("c"), F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo <> hi")
        mixed = materialise(mixed.select("bucket", F.col("c.rep").alias("centre"), F.col("c.n").alias("centre_n"), F.col("c.part").alias("centre_part")), "near-centres")
        apart = apart.join(mixed, "bucket")
        if step < p.rounds:
            apart = materialise(apart, "near-apart")
            pairs = _pairs(apart.where("part <> centre_part"), "rep", "n", "centre", "centre_n", p)
        else:
            pairs = _blockwise(materialise(apart.select("bucket", "rep", "part"), "near-apart"), sets, p)
        pairs = materialise(pairs.join(tested, ["a", "b"], "left_anti"), "near-pairs")
        tested = tested.union(pairs)
        found = found.union(materialise(_confirm(pairs, sets, p), "near-links"))
        members = apart
    return found


def near_duplicates(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, d1, d2, component_id, kept.

    A-Z are lower-cased; words are runs of anything but ASCII white space. A text of fewer words than a
    shingle has all of them as its one shingle; a text without words is linked with nothing.
    component_id is the smallest doc_id that links reach, the document's own included; kept: it is the
    document's own. Rows that share a doc_id are one document, searched by its text with most shingles.
    A row without doc_id joins the component of documents with the same set and is not kept then; else
    it has no component and is kept. (d1, d2) names the set.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = materialise(_sketch(docs, p), "near-sketch")
    classes = rows.where("n_shingles > 0").groupBy("d1", "d2").agg(
        F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"), F.first("keys").alias("keys")).where("rep IS NOT NULL")
    classes = materialise(classes, "near-classes")
    found = links(docs, classes, p)
    same_set = rows.where("n_shingles > 0").join(classes.select("d1", "d2", "rep"), ["d1", "d2"])
    # a document whose rows have several sets joins their classes
    several = same_set.where("doc_id <> rep").groupBy("doc_id").agg(F.min("rep").alias("lo"), F.max("rep").alias("hi")).where("lo <> hi")
    own = same_set.where("doc_id IS NOT NULL").join(several.select("doc_id"), "doc_id", "left_semi")
    parts = components(found.union(own.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))))
    named = classes.select("d1", "d2", "rep").join(parts, F.col("rep") == F.col("node"), "left").select(
        "d1", "d2", F.coalesce("component", "rep").alias("class_component"))
    out = rows.select("doc_id", "n_shingles", "d1", "d2").join(named, ["d1", "d2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("class_component")).otherwise(F.col("doc_id"))
    component = F.when(F.col("n_shingles") > 0, F.coalesce(component, F.col("doc_id"))).otherwise(component)
    return out.select("doc_id", "n_shingles", "d1", "d2", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def dedup(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """The rows of ``docs`` that stay, columns unchanged: one document of each component, and all texts without words."""
    kept = near_duplicates(docs, p).where("kept").select(F.col("doc_id").alias("_llm_id")).distinct()
    return docs.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col("_llm_id")), "left_semi")
