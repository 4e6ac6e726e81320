"""Phrase collocation mining: multikey three-way quicksort of suffixes, routed by their leading words.

1. Words are counted by language. Pairs of neighbouring frequent words are counted (the leading words).
2. Every place from which three words follow in frequent pairs gives a suffix of at most five words, ended where
   a pair is infrequent, since no frequent phrase reaches over such a place. Equal suffixes of a batch are one
   with a weight. Suffixes are routed over the cluster by their three leading words, in sorted blocks of many routes, so each
   phrase of three words or more is counted in one place.
3. Each route is partitioned by multikey three-way quicksort: words smaller than, equal to and larger than a pivot at
   one depth; the equal part goes on at the next depth, and its weight is the phrase's count. Parts lighter than the
   least count are abandoned.
4. Phrases are cut in two, scored and ranked with joins on their words.

Words are 64-bit hashes of language and word until the last step. That no two words share the hash of a frequent one is
checked; the hash is changed otherwise. Frequent words and pairs go to the tasks as bit sets of a fixed size,
whose false positives only make suffixes that the sort abandons. A route that could hold many rows (both leading pairs are
very frequent) is split by all its words, its parts are counted apart and summed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from waitcast.llm import words
from waitcast.llm.bpe import ragged
from waitcast.llm.scratch import materialise, partitions

#: The longest phrase, the least count, the phrases a language reports, and the language of null.
LONGEST = 5
LEAST = 100
TOP = 2000
UNKNOWN = "und"

#: Bits of the sets of frequent words and pairs, whatever their number: 16 MB.
SET_BITS = 1 << 27
#: Pairs as frequent as this count as hot; also about the rows that one sort takes.
HOT = 1 << 20
#: Hash functions tried until no frequent word shares its number.
SEEDS = 8

#: Bytes that end a piece, and bytes of words.
ENDS = np.zeros(256, bool)
ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
WORD = ~ENDS
WORD[[0x20, 0x09]] = False


class Hashing:
    """A numbering of (language, word) by 64 bits, never 0; another one for each seed."""

    def __init__(self, seed: int) -> None:
        order = np.random.Generator(np.random.PCG64(seed)).permutation(256).astype(np.uint8) if seed else np.arange(256, dtype=np.uint8)
        self.seed, self.fold = seed, order[words.FOLD]
        self.back, self.word, self.ends = np.zeros(256, np.uint8), np.zeros(256, bool), np.zeros(256, bool)
        self.back[order], self.word[order], self.ends[order] = np.arange(256, dtype=np.uint8), WORD, ENDS

    def of_language(self, lang: str) -> int:
        return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8, salt=bytes([self.seed])).digest(), "little")

    def batch(self, b: pa.RecordBatch) -> Iterator[tuple[words.Group, np.ndarray, np.ndarray, np.ndarray]]:
        """For groups of texts of a batch (lang, text): the group, the text of each word, the word's number, and whether the
        next word follows it in the same piece."""
        langs = b.column(0).dictionary_encode()
        salts = np.array([self.of_language(x) for x in langs.dictionary.to_pylist()], np.uint64)
        salt = salts[langs.indices.to_numpy()]
        for g in words.groups(b.column(1), self.word, self.fold):
            text = np.repeat(np.arange(g.rows.start, g.rows.stop), g.n_words)
            number = np.maximum(words.mixed(g.hash ^ salt[text]), np.uint64(1))
            piece = np.cumsum(self.ends[g.data])[g.first] if len(g.first) else np.zeros(0, np.int64)
            follows = np.zeros(len(number), bool)
            follows[:-1] = (text[1:] == text[:-1]) & (piece[1:] == piece[:-1])
            yield g, text, number, follows


def row_hash(rows: np.ndarray) -> np.ndarray:
    h = np.zeros(len(rows), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(rows.shape[1]):
            h = words.mixed(h * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return h


def combined(rows: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different rows and the sum of their weights. Rows are sorted by a hash; a shared hash may leave equal rows apart."""
    if not len(rows):
        return rows, weight
    order = np.argsort(row_hash(rows), kind="stable")
    rows = rows[order]
    starts = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]).any(axis=1)]))
    return rows[starts], np.add.reduceat(weight[order], starts)


def bit_set(spark: SparkSession, numbers: DataFrame) -> np.ndarray:
    """A set of ``numbers`` (one long column) as SET_BITS bits; at most SET_BITS / 64 rows come to the driver."""
    x = F.col(numbers.columns[0])
    place = F.shiftrightunsigned(x, 6).bitwiseAND(F.lit(SET_BITS // 64 - 1))
    bit = F.expr(f"shiftleft(1L, cast({numbers.columns[0]} & 63 AS INT))")
    rows = numbers.select(place.alias("place"), bit.alias("bit")).groupBy("place").agg(F.bit_or("bit").alias("bits")).toArrow()
    held = np.zeros(SET_BITS // 64, np.uint64)
    held[rows.column("place").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return held


def member(held: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    return (held[((numbers >> np.uint64(6)) & np.uint64(SET_BITS // 64 - 1)).astype(np.int64)] >> (numbers & np.uint64(63))) & np.uint64(1) == 1


def longs(column: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(column).view(np.int64))


def count_words(docs: DataFrame, hashing: Hashing) -> DataFrame:
    """(id, lang, word, n): the words of each Arrow batch with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, found = b.column(0).to_pylist(), {}
            kept = []
            for g, text, number, _ in hashing.batch(b):
                ids, first, n = np.unique(number, return_index=True, return_counts=True)
                size = (g.end - g.first)[first]
                data = hashing.back[g.data[ragged(g.first[first], size)]]
                word = pa.LargeStringArray.from_buffers(len(ids), pa.py_buffer(np.concatenate([[0], np.cumsum(size)]).astype(np.int64)), pa.py_buffer(data))
                kept.append((ids, n, word, text[first]))
            if not kept:
                continue
            ids, n, text = (np.concatenate([k[i] for k in kept]) for i in (0, 1, 3))
            word = pa.concat_arrays([k[2] for k in kept])
            found, first, back = np.unique(ids, return_index=True, return_inverse=True)
            total = np.bincount(back, n, len(found)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [longs(found), pa.array([langs[t] for t in text[first].tolist()], pa.string()), word.take(pa.array(first)).cast(pa.string()), pa.array(total)],
                names=["id", "lang", "word", "n"])

    return docs.mapInArrow(run, "id long, lang string, word string, n long")


def maybe_frequent(named: DataFrame, frequent_words: object, held_rows: int = 1 << 15) -> DataFrame:
    """The rows (id, lang, word) whose words may be frequent, mostly once a task: equal rows are dropped after ``held_rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, unlike = [], 0
        for b in batches:
            kept.append(b.filter(pa.array(member(frequent_words.value, b.column(0).to_numpy().view(np.uint64)))))
            if sum(map(len, kept)) >= unlike + held_rows:
                kept = pa.Table.from_batches(kept).group_by(["id", "lang", "word"], use_threads=False).aggregate([]).combine_chunks().to_batches()
                unlike = sum(map(len, kept))
        if kept:
            yield from pa.Table.from_batches(kept).group_by(["id", "lang", "word"], use_threads=False).aggregate([]).to_batches(max_chunksize=10_000)

    return named.mapInArrow(run, "id long, lang string, word string")


def count_pairs(docs: DataFrame, hashing: Hashing, frequent_words: object, hot_words: object) -> DataFrame:
    """(w1, w2, f): neighbouring words that may both be frequent.

    The pairs of an Arrow batch travel in blocks, sorted, so that a first word repeats in a run. Pairs are dealt to blocks by their
    first word, those of a very frequent first word by the second word's leading bits too."""
    blocks = 4 * partitions(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, hot = frequent_words.value, hot_words.value
        for b in batches:
            kept = []
            for _, _, number, follows in hashing.batch(b):
                ok = member(held, number)
                at = np.flatnonzero(follows[:-1] & ok[:-1] & ok[1:])
                kept.append(combined(np.stack([number[at], number[at + 1]], axis=1), np.ones(len(at), np.int64)))
            rows, n = (np.concatenate(x) for x in zip(*kept, strict=True)) if kept else (np.zeros((0, 2), np.uint64), None)
            del kept
            if not len(rows):
                continue
            part = np.where(member(hot, rows[:, 0]), rows[:, 1] >> np.uint64(58), np.uint64(0))
            block = (words.mixed(rows[:, 0] ^ part) % np.uint64(blocks)).astype(np.int32)
            order = np.lexsort((rows[:, 1], rows[:, 0], block))
            block, w1, w2 = block[order], rows[order, 0], rows[order, 1]
            del rows
            first = np.flatnonzero(np.concatenate([[True], (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1])]))
            block, w1, w2, n = block[first], w1[first], w2[first], np.add.reduceat(n[order], first)
            start = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
            offsets = pa.array(np.concatenate([start, [len(w1)]]).astype(np.int32))
            columns = [pa.ListArray.from_arrays(offsets, x) for x in (longs(w1), longs(w2), pa.array(n.astype(np.int32)))]
            yield pa.RecordBatch.from_arrays([pa.array(block[start]), *columns], names=["block", "w1", "w2", "n"])

    packed = docs.mapInArrow(run, "block int, w1 array<long>, w2 array<long>, n array<int>").repartition("block")
    # one shuffle: equal pairs lie in the same block, so the counts of (block, w1, w2) need no other
    return packed.select("block", F.inline(F.arrays_zip("w1", "w2", "n"))).groupBy("block", "w1", "w2").agg(F.sum("n").alias("f")).drop("block")


def pair_number(w1: Column, w2: Column) -> Column:
    """The number of a pair in the sets of pairs; pair_numbers() is the same in numpy."""
    return w1.bitwiseXOR(F.shiftleft(w2, 7)).bitwiseXOR(F.shiftrightunsigned(w2, 57))


def pair_numbers(w1: np.ndarray, w2: np.ndarray) -> np.ndarray:
    return w1 ^ (w2 << np.uint64(7)) ^ (w2 >> np.uint64(57))


def suffixes(docs: DataFrame, hashing: Hashing, frequent_pairs: object, hot_pairs: object) -> DataFrame:
    """(block, w1 ... w5, n): suffixes of three to five words, 0 where they end, and their weights.

    The suffixes of an Arrow batch travel in blocks, sorted, so that leading words repeat in a run. They are dealt to blocks by
    their three leading words; those of a split route, whose blocks have odd numbers, by all words."""
    blocks = 4 * partitions(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, hot = frequent_pairs.value, hot_pairs.value
        for b in batches:
            kept = []
            for _, _, number, follows in hashing.batch(b):
                pair = np.zeros(len(number), np.uint64)
                pair[:-1] = pair_numbers(number[:-1], number[1:])
                goes_on = follows & member(held, pair)
                at = np.flatnonzero(goes_on[:-1] & goes_on[1:])
                rows, on = np.zeros((len(at), LONGEST), np.uint64), np.ones(len(at), bool)
                for k in range(LONGEST):
                    place = np.minimum(at + k, len(number) - 1)
                    if k:
                        on &= goes_on[np.minimum(at + k - 1, len(number) - 1)]
                    rows[:, k] = np.where(on, number[place], 0)
                kept.append(combined(rows, np.ones(len(at), np.int64)))
            if not kept:
                continue
            rows, n = combined(*(np.concatenate(x) for x in zip(*kept, strict=True)))
            del kept
            if not len(rows):
                continue
            split = member(hot, pair_numbers(rows[:, 0], rows[:, 1])) & member(hot, pair_numbers(rows[:, 1], rows[:, 2]))
            route = np.where(split, row_hash(rows), row_hash(rows[:, :3]))
            block = (route % np.uint64(blocks)).astype(np.int32) * 2 + split.astype(np.int32)
            order = np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0], block))
            block, rows, n = block[order], rows[order], n[order]
            start = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
            offsets = pa.array(np.concatenate([start, [len(rows)]]).astype(np.int32))
            columns = [pa.ListArray.from_arrays(offsets, x) for x in (*[longs(rows[:, k]) for k in range(LONGEST)], pa.array(n))]
            yield pa.RecordBatch.from_arrays([pa.array(block[start]), *columns], names=["block", *[f"w{k + 1}" for k in range(LONGEST)], "n"])

    return docs.mapInArrow(run, "block int, " + ", ".join(f"w{k + 1} array<long>" for k in range(LONGEST)) + ", n array<long>")


def multikey_sort(rows: np.ndarray, weight: np.ndarray, least: int, shortest: int = 3) -> Iterator[tuple[int, int, int]]:
    """(row, length, count) of each phrase of ``shortest`` words or more that starts suffixes of a weight of ``least`` or more.

    Multikey three-way quicksort of pointers to the suffixes (rows of word numbers, 0 where they end): a part is
    divided at its depth by a pivot; lighter parts than ``least`` are abandoned.
    """
    parts = [(np.arange(len(rows)), 0)]
    while parts:
        part, depth = parts.pop()
        key = rows[part, depth]
        pivot = np.sort(key[[0, len(key) // 2, -1]])[1]
        equal = part[key == pivot]
        count = int(weight[equal].sum())
        if pivot and count >= least:
            if depth + 1 >= shortest:
                yield int(equal[0]), depth + 1, count
            if depth + 1 < rows.shape[1]:
                parts.append((equal, depth + 1))
        for side in (part[key < pivot], part[key > pivot]):
            if len(side) and int(weight[side].sum()) >= least:
                parts.append((side, depth))


def partial_counts(rows: np.ndarray, weight: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(phrases of one length, weights) of the leading three and more words of some suffixes of split routes."""
    for k in range(3, rows.shape[1] + 1):
        on = rows[:, k - 1] != 0
        yield combined(rows[on, :k], weight[on])


def mine(routed: DataFrame, least: int, run_rows: int) -> DataFrame:
    """(ids, n): phrases of three words or more and their counts, in parts where a route is split."""
    spark = routed.sparkSession
    rows = routed.repartition(partitions(spark), "block").sortWithinPartitions("block")

    def lists(found: list[tuple[np.ndarray, int]]) -> pa.RecordBatch:
        size = np.array([len(r) for r, _ in found], np.int32)
        flat = np.concatenate([r for r, _ in found]) if found else np.zeros(0, np.uint64)
        ids = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), longs(flat))
        return pa.RecordBatch.from_arrays([ids, pa.array([n for _, n in found], pa.int64())], names=["ids", "n"])

    def whole(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        return combined(*(np.concatenate(x) for x in zip(*held, strict=True)))

    def flush(held: list[tuple[np.ndarray, np.ndarray]], split: bool) -> Iterator[pa.RecordBatch]:
        data, weight = whole(held)
        if not split:
            yield lists([(data[i, :k], n) for i, k, n in multikey_sort(data, weight, least)])
            return
        for phrases, n in partial_counts(data, weight):
            for lo in range(0, len(phrases), 100_000):
                yield lists(list(zip(phrases[lo:lo + 100_000], n[lo:lo + 100_000].tolist(), strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, last, limit = [], 0, -1, run_rows
        for b in batches:
            for at, block in enumerate(b.column("block").to_pylist()):
                # split routes are counted in parts, others wait for the end of their block
                if held and (block != last or (last % 2 and n >= run_rows)):
                    yield from flush(held, bool(last % 2))
                    held, n, limit = [], 0, run_rows
                one = b.slice(at, 1)
                data = np.stack([one.column(f"w{k + 1}").flatten().to_numpy().view(np.uint64) for k in range(LONGEST)], axis=1)
                held.append((data, one.column("n").flatten().to_numpy()))
                n, last = n + len(data), block
                if n >= limit:
                    held = [whole(held)]
                    n = len(held[0][0])
                    limit = n + run_rows
        if held:
            yield from flush(held, bool(last % 2))

    return rows.mapInArrow(run, "ids array<long>, n long")


def phrases(docs: DataFrame, least: int = LEAST, hot: int = HOT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frequent phrases of one to five words of ``docs`` (lang, text): (ids, f), (id, lang, word), (lang, n).

    ids: numbers of the phrase's words; f: how often it stands in the pieces of its language, overlaps included;
    n: all words of a language. Only phrases with f >= least are returned, with all their parts.
    """
    spark: SparkSession = docs.sparkSession
    for seed in range(SEEDS):
        hashing = Hashing(seed)
        counted = materialise(count_words(docs, hashing), "collocation-words")
        frequent = materialise(counted.groupBy("id").agg(F.sum("n").alias("f")).where(F.col("f") >= least), "collocation-frequent")
        held = spark.sparkContext.broadcast(bit_set(spark, frequent.select("id")))
        names = maybe_frequent(counted.select("id", "lang", "word"), held).distinct().join(frequent.select("id"), "id")
        names = materialise(names, "collocation-names")
        if names.groupBy("id").count().where("count > 1").isEmpty():
            break
    else:
        raise RuntimeError("every hash function tried gives a frequent word and another word one number")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))

    hot_words = spark.sparkContext.broadcast(bit_set(spark, frequent.where(F.col("f") >= hot).select("id")))
    pairs = materialise(count_pairs(docs, hashing, held, hot_words).where(F.col("f") >= least), "collocation-pairs")
    number = pair_number(F.col("w1"), F.col("w2")).alias("number")
    held_pairs, hot_pairs = (spark.sparkContext.broadcast(bit_set(spark, pairs.where(F.col("f") >= m).select(number))) for m in (least, hot))
    longer = mine(suffixes(docs, hashing, held_pairs, hot_pairs), least, hot)
    longer = longer.groupBy("ids").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    found = frequent.select(F.array("id").alias("ids"), "f").unionByName(pairs.select(F.array("w1", "w2").alias("ids"), "f")).unionByName(longer)
    return materialise(found, "collocation-phrases"), names, totals


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, share: int = 100, hot: int = HOT) -> DataFrame:
    """The first ``top`` phrases of each language of ``docs`` (lang, text) by association.

    Candidates are phrases of two to five words that stand ``least`` times or more inside pieces (texts, A-Z lower-cased,
    are cut at ``[.,;:!?]`` and line ends, words at spaces and tabs). A cut in a first part and a rest scores
    floor(1000 * a * n / (l * r)); the lowest-scoring cut counts, of equal ones the one with the shortest first part.
    Candidates that stand inside a longer one which is at least ``share`` per cent as frequent are left out. Returns lang, rank
    (from 1: score descending, a descending, phrase ascending), phrase, a, l, r, n, score. A null language is ``und``,
    a null text empty; repeated rows count as often as they stand. An empty table, or one without candidates, gives no rows.
    """
    rows = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), "text")
    found, names, totals = phrases(rows, least, hot)
    size = F.size("ids")
    candidates = found.where(size >= 2).select("ids", F.col("f").alias("a"))

    cuts = candidates.select("ids", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("*", F.slice("ids", F.lit(1), F.col("k")).alias("first"), F.slice("ids", F.col("k") + 1, size - F.col("k")).alias("rest"))
    cuts = cuts.join(found.select(F.col("ids").alias("first"), F.col("f").alias("l")), "first")
    cuts = cuts.join(found.select(F.col("ids").alias("rest"), F.col("f").alias("r")), "rest")
    lang = names.select(F.col("id").alias("head"), "lang").join(totals, "lang")
    cuts = cuts.withColumn("head", F.element_at("ids", 1)).join(lang, "head")
    wide = "decimal(19,0)"
    above = F.col("a").cast(wide) * F.col("n").cast(wide) * F.lit(1000).cast("decimal(4,0)")
    cuts = cuts.withColumn("above", above).withColumn("below", F.col("l").cast(wide) * F.col("r").cast(wide))
    cuts = cuts.withColumn("score", F.expr("above div below"))
    best = cuts.groupBy("ids", "a", "lang", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select("ids", "a", "lang", "n", "cut.*")

    inside = [(i, k) for k in range(2, LONGEST) for i in range(LONGEST - k + 1)]
    parts = F.array(*[F.when(size >= i + k, F.slice("ids", i + 1, k)) for i, k in inside])
    longer = candidates.where(size >= 3).select("ids", "a", F.explode(parts).alias("part")).where("part IS NOT NULL AND size(part) < size(ids)")
    longer = longer.groupBy("part").agg(F.max("a").alias("longer")).select(F.col("part").alias("ids"), "longer")
    kept = best.join(longer, "ids", "left").where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * share))

    text = kept.select("ids", F.posexplode("ids").alias("place", "id")).join(names.select("id", "word"), "id")
    text = text.groupBy("ids").agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("t"))
    kept = kept.join(text.select("ids", F.concat_ws(" ", "t.word").alias("phrase")), "ids")
    # first within parts of a language, so that no task ranks all phrases of a large one
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    kept = kept.withColumn("salt", F.pmod(F.xxhash64("ids"), F.lit(partitions(docs.sparkSession))))
    kept = kept.withColumn("rank", F.row_number().over(W.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    kept = kept.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return kept.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
