"""Phrase collocations against a plain count of all phrases."""

import collections
import re

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.conftest import prose, rows_of, table
from waitcast.llm import collocations

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, top=2000, share=100):
    count, n = collections.Counter(), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(FOLD)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            count.update((lang, tuple(w[i:i + k])) for k in range(1, 6) for i in range(len(w) - k + 1))
    found = collections.defaultdict(list)
    frequent = [(lang, p) for (lang, p), a in count.items() if len(p) > 1 and a >= least]
    longer = collections.Counter()
    for lang, p in frequent:
        for k in range(2, len(p)):
            for i in range(len(p) - k + 1):
                longer[lang, p[i:i + k]] = max(longer[lang, p[i:i + k]], count[lang, p])
    for lang, p in frequent:
        a = count[lang, p]
        cuts = [(1000 * a * n[lang] // (count[lang, p[:k]] * count[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        if 100 * longer[lang, p] < share * a or not longer[lang, p]:
            found[lang].append((-score, -a, " ".join(p).encode(), count[lang, p[:k]], count[lang, p[k:]]))
    return [(lang, rank, p.decode(), -a, l, r, n[lang], -score)
            for lang, ps in found.items() for rank, (score, a, p, l, r) in enumerate(sorted(ps)[:top], 1)]


def corpus():
    rows = [("en", prose(i % 7, 60).replace("\n", " ")) for i in range(40)] + [("fr", prose(i, 40)) for i in range(20)]
    rows += [(None, "New York, new york; NEW YORK city!"), ("und", "new york new york\tnew york")] * 6 + [("x", "a a a a a a a a a a. a a é É é é é é")] * 3
    return rows + [("en", None), ("en", ""), (None, None), ("en", " \t\n.,"), ("hot", "to be or not to be " * 200)] + [("hot", "one\x00two   three" * 9)] * 5


@pytest.mark.parametrize("hot", [1 << 20, 10, 1])
def test_collocations(spark, hot):
    rows = corpus()
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    got = collocations.collocations(docs, least=5, hot=hot)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert rows_of(got, *got.columns) == table(plain(rows, 5))


def test_collocations_by_share_and_top_with_clashing_columns(spark):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "old", "old", 1) for r in rows], "lang string, text string, ids string, word string, n int")
    got = collocations.collocations(docs, least=6, top=4, share=50)
    assert rows_of(got, *got.columns) == table(plain(rows, 6, 4, 50))


def test_collocations_of_nothing(spark):
    docs = spark.createDataFrame([("en", "one two three"), (None, None)], "lang string, text string")
    assert collocations.collocations(docs).count() == 0 and collocations.collocations(docs.limit(0)).count() == 0


def test_another_hash_when_words_share_a_number(spark, monkeypatch):
    tried = []
    real = collocations.count_words

    def shared(docs, hashing):
        tried.append(hashing.seed)
        rows = real(docs, hashing)
        return rows.selectExpr("id & 1 AS id", "lang", "word", "n") if hashing.seed == 0 else rows

    monkeypatch.setattr(collocations, "count_words", shared)
    rows = corpus()
    got = collocations.collocations(spark.createDataFrame(rows, "lang string, text string"), least=5)
    assert tried == [0, 1] and rows_of(got, *got.columns) == table(plain(rows, 5))


def test_multikey_sort_counts_weighted_suffixes():
    r = np.random.default_rng(3)
    rows = r.integers(1, 4, (400, 5)).astype(np.uint64)
    for i, k in enumerate(r.integers(3, 6, 400)):
        rows[i, k:] = 0
    weight = r.integers(1, 5, 400)
    want = collections.Counter()
    for row, w in zip(rows.tolist(), weight.tolist(), strict=True):
        for k in range(3, 6):
            if row[k - 1]:
                want[tuple(row[:k])] += w
    got = {tuple(rows[i, :k].tolist()): n for i, k, n in collocations.multikey_sort(rows, weight, 12)}
    assert got == {p: n for p, n in want.items() if n >= 12}
    parts = collections.Counter()
    for phrases, n in collocations.partial_counts(rows, weight):
        for p, x in zip(phrases.tolist(), n.tolist(), strict=True):
            parts[tuple(p)] += x
    assert parts == want


def test_words_of_one_language_have_other_numbers_in_another():
    h = collocations.Hashing(0)
    ((_, _, number, follows),) = h.batch(pa.RecordBatch.from_arrays([pa.array(["a", "b"]), pa.array(["x y. x", "x"])], names=["lang", "text"]))
    assert number[0] == number[2] != number[3] and follows.tolist() == [True, False, False, False]


def test_suffixes_travel_in_blocks_of_whole_routes(spark):
    """However many suffixes a batch has, it sends a bounded number of rows; each leading triple lies in one block, no place is lost."""
    texts = [prose(i, 400).replace("\n", " ").replace(".", " ").replace(",", " ") for i in range(60)]
    docs = spark.createDataFrame([("en", t) for t in texts], "lang string, text string").coalesce(1)
    every, none = (spark.sparkContext.broadcast(np.full(collocations.SET_BITS // 64, fill, np.uint64)) for fill in (~np.uint64(0), np.uint64(0)))
    blocks, h = 4 * int(spark.conf.get("spark.sql.shuffle.partitions")), collocations.Hashing(0)
    places = sum(max(len(re.findall("[^ \t]+", piece)) - 2, 0) for t in texts for piece in re.split("[.,;:!?\x0a-\x0d]", t))
    for hot, lead in ((none, 3), (every, 5)):
        rows = collocations.suffixes(docs, h, every, hot).collect()
        assert len(rows) <= blocks < places and {r.block % 2 for r in rows} == {lead // 5}
        assert sum(sum(r.n) for r in rows) == places
        home = {}
        for r in rows:
            for words in zip(r.w1, r.w2, r.w3, r.w4, r.w5, strict=True):
                assert home.setdefault(words[:lead], r.block) == r.block
