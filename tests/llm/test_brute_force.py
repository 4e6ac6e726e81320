"""Every operator against a plain version in Python, on tables with nulls, empty and very long texts, ties,
repeated rows and columns with clashing names; and on empty tables."""

import collections
import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from tests.llm.conftest import prose, rows_of, table
from waitcast.llm import bpe, exact_dedup, licenses, line_dedup, lm_scoring, mixing, near_dedup, quality, substring_dedup, token_files

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
sha = lambda t: hashlib.sha256(t.encode()).hexdigest()


# 1 mixing

def test_mix_sizes_targets_and_taken(edge, clashing, edge_rows):
    got = mixing.plan(edge).collect()
    assert rows_of(mixing.plan(edge), "doc_id", "size", "target", "taken") == rows_of(mixing.plan(clashing), "doc_id", "size", "target", "taken")
    size = collections.Counter()
    for _, text, source in edge_rows:
        size[source] += len(WORD.findall(text or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(size, key=lambda s: (s is None, s)))}
    total, capped = 1.5 * sum(size.values()), set()
    while True:  # deal out, cap, deal the excess again
        left = total - sum(2 * size[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[x] for x in weight if x not in capped) for s in weight if s not in capped}
        over = {s for s, t in share.items() if t > 2 * size[s]}
        if not over:
            break
        capped |= over
    target = {s: share.get(s, 2.0 * size[s]) for s in size}
    largest = collections.Counter()
    for r in got:
        assert r.size == len(WORD.findall(next(t for i, t, s in edge_rows if i == r.doc_id and len(WORD.findall(t or "")) == r.size) or ""))
        assert r.source_size == size[r.source] and r.target == pytest.approx(target[r.source])
        assert r.taken in (0, r.size, 2 * r.size)
        largest[r.source] = max(largest[r.source], r.size)
    for s in size:
        assert abs(sum(r.taken for r in got if r.source == s) - target[s]) <= largest[s] + 1
    assert len(got) == len(edge_rows)


def test_mix_is_near_its_targets_with_a_hot_source(spark):
    rows = [(i, prose(i, 20 + i % 30), "hot" if i % 3 else f"s{i % 7}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.plan(docs).collect()
    for s in {r.source for r in got}:
        mine = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 2 * max(r.size for r in mine)
    again = mixing.plan(docs.repartition(7)).collect()
    assert {(r.doc_id, r.taken) for r in got} == {(r.doc_id, r.taken) for r in again}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in got)


def test_mix_uses_given_weights_and_keeps_columns(spark, clashing):
    weights = spark.createDataFrame([("a", 1.0), ("b", 0.0)], "source string, weight double")
    got = mixing.plan(clashing, weights, share=0.5).collect()
    assert all(r.target == 0 and r.taken == 0 for r in got if r.source != "a")
    mixed = mixing.mix(clashing)
    assert mixed.columns == clashing.columns and {r["w"] for r in mixed.collect()} == {"old"}


# 2 byte-level BPE, 7 token files

@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


def plain_ids(ranks, text):
    return np.array(tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary(text or ""), "<u4").tobytes()


def test_bpe_round_trip(edge, clashing, edge_rows, ranks):
    for docs in (edge, clashing):
        got = bpe.decode(bpe.encode(docs, ranks, public_tokenizers.PATTERN), ranks)
        want = [(i, plain_ids(ranks, t), (t or "").encode()) for i, t, _ in edge_rows]
        assert table([(r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in got.collect()]) == table(want)


def test_bpe_in_many_small_batches(edge, edge_rows, ranks, monkeypatch):
    monkeypatch.setattr(bpe, "SEND_WORDS", 50)
    for batch_bytes in (1, 300, 5000):
        got = bpe.encode(edge.repartition(5), ranks, public_tokenizers.PATTERN, batch_bytes=batch_bytes)
        assert table([(r.doc_id, bytes(r.ids)) for r in got.collect()]) == table([(i, plain_ids(ranks, t)) for i, t, _ in edge_rows])


def test_positions_of_a_batch_in_several_rows(edge_rows, monkeypatch):
    import regex
    monkeypatch.setattr(bpe, "ROW_WORDS", 30)
    monkeypatch.setattr(bpe, "GROUP_CHUNKS", 7)
    batch = bpe.Batch()
    for lo in range(0, len(edge_rows), 5):
        some = edge_rows[lo:lo + 5]
        batch.add(pa.array([i for i, _, _ in some], pa.int64()), pa.array([t or "" for _, t, _ in some], pa.large_string()))
    rows = list(batch.rows(3, public_tokenizers.PATTERN))
    words = {r["base"] + k: w for b in rows for r in b.to_pylist() for k, w in enumerate(r["words"])}
    got = []
    for b in rows:
        (r,) = b.to_pylist()
        at = bpe.unpack(r["positions"]).tolist()
        for doc_id, n in zip(r["ids"], r["sizes"], strict=True):
            got.append((doc_id, [words[k] for k in at[:n]]))
            at = at[n:]
    assert len(rows) > 5 and len(set(words.values())) == len(words) and {r["batch"] for b in rows for r in b.to_pylist()} == {3}
    assert got == [(i, regex.findall(public_tokenizers.PATTERN, t or "")) for i, t, _ in edge_rows]


def test_chunks_never_cut_a_pretoken():
    import random

    import regex
    find = regex.compile(public_tokenizers.PATTERN).findall
    r = random.Random(5)
    for _ in range(3000):
        text = "".join(r.choices(["a", "é", "1", " ", "  ", "\n", "\t", "'s", "'", "!", "\x1c", "\x85", " ", " ", "漢", "<|endoftext|>"], k=r.randint(0, 12)))
        first, *rest = bpe.chunks(text)
        assert first + "".join(f" {c}" for c in rest) == text
        assert [w for c in (first, *[f" {c}" for c in rest]) for w in find(c)] == find(text)
        some = [text, "plain words here", text[::-1], ""]
        flat, sizes = bpe.cut(pa.array(some, pa.large_string()))
        cut, ends = flat.to_pylist(), np.cumsum(sizes).tolist()
        for a, b, t in zip([0, *ends], ends, some, strict=False):
            assert [w for i, c in enumerate(cut[a:b]) for w in find(f" {c}" if i else c)] == find(t)


def test_decode_refuses_unknown_ids_and_keeps_nulls(spark, ranks):
    tokens = spark.createDataFrame([(1, None, "x"), (2, bytearray(b""), "x")], "doc_id long, ids binary, decoded string")
    assert [(r.doc_id, r.decoded) for r in bpe.decode(tokens, ranks).orderBy("doc_id").collect()] == [(1, None), (2, bytearray(b""))]
    bad = spark.createDataFrame([(1, bytearray((99_999).to_bytes(4, "little")))], "doc_id long, ids binary")
    with pytest.raises(Exception, match="not in the vocabulary"):
        bpe.decode(bad, ranks).collect()


def test_token_files(edge, clashing, edge_rows):
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        model = f.read()
    tokenizer = Tokenizer.from_str(model)
    want = collections.Counter((i, np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes()) for i, t, _ in edge_rows)
    for docs in (edge, clashing):
        files = token_files.write(docs, model, block_ids=64)
        got = files.read().collect()
        assert collections.Counter((r.doc_id, bytes(r.ids)) for r in got) == want
        got = sorted(got, key=lambda r: r.start)
        assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
        ids = [r.doc_id for r in got]
        assert ids == sorted(ids, key=lambda i: (i is not None, i))
        some = files.read([7, 16]).collect()
        assert {(r.doc_id, r.start) for r in some} == {(r.doc_id, r.start) for r in got if r.doc_id in (7, 16)}
        block = files.blocks().where("n_ids > 100").first()
        assert (token_files.unpack_bits(bytes(block.data), block.bits, 37, 11) == token_files.unpack_bits(bytes(block.data), block.bits, 0, block.n_ids)[37:48]).all()


@pytest.mark.parametrize("bits", [1, 5, 8, 13, 16, 17, 31])
def test_bit_packing(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1001).astype("<u4")
    data = token_files.pack_bits(ids, bits)
    assert len(data) == (1001 * bits + 7) // 8
    assert (token_files.unpack_bits(data, bits, 0, 1001) == ids).all() and (token_files.unpack_bits(data, bits, 990, 11) == ids[990:]).all()


# 3 license scans

def test_license_scan(edge, clashing, edge_rows, spark):
    notice = "Permission is hereby granted, free of charge, to any lucky person obtaining a copy of this software and associated documentation"
    more = [(100, "x GNU General Public License gnu general PUBLIC license and an Apache License; CC BY. mit-license!", None), (101, notice, None),
            (102, "gnu general public", None), (103, "ccé by cc", None)]
    rows = [(i, t) for i, t, _ in (*edge_rows, *more)]
    docs = edge.unionByName(spark.createDataFrame(more, edge.schema))
    want = []
    for i, t in rows:
        w = licenses.split_words(t or "")
        at = sorted((j, p.label) for p in licenses.BASE for j in range(len(w)) if w[j:j + len(p.phrase.split())] == p.phrase.split())
        want.append((i, len(w), len(at), at[0][0] if at else None, at[-1][0] if at else None, ",".join(sorted({x for _, x in at}))))
    got = licenses.scan(docs)
    assert rows_of(got, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels") == table(want)
    found = {r.doc_id: r for r in got.collect()}
    assert found[101].labels == "mit" and 0.75 <= found[101].score < 1 and found[101].n_base == 0
    assert found[102].labels == "" and found[102].score == 0 and found[100].score == 1 and found[103].labels == ""
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) for r in found.values())
    assert rows_of(licenses.scan(clashing), "doc_id", "n_words", "labels") == rows_of(licenses.scan(edge), "doc_id", "n_words", "labels")


# 4 exact dedup

def test_exact_dedup(spark, edge, clashing, edge_rows):
    groups = collections.defaultdict(list)
    for i, t, _ in edge_rows:
        groups[(t or "").translate(FOLD)].append(i)
    want = []
    for i, t, _ in edge_rows:
        mine = groups[(t or "").translate(FOLD)]
        keep = max((x for x in mine if x is not None), default=None)
        want.append((i, keep, len(mine), i == keep, sha((t or "").translate(FOLD))))
    for docs in (edge, clashing):
        index = exact_dedup.DigestIndex(spark, buckets=4)
        index.add(docs)
        got = index.lookup(docs)
        assert rows_of(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == table(want)
        kept = exact_dedup.dedup(docs)
        assert kept.columns == docs.columns
        assert collections.Counter((r.text or "").translate(FOLD) for r in kept.collect()) == collections.Counter(list(groups))


def test_exact_dedup_index_takes_batches(spark):
    batch = lambda rows: spark.createDataFrame(rows, "doc_id long, text string")
    index = exact_dedup.DigestIndex(spark, buckets=4)
    assert index.add(batch([(1, "A"), (2, "a"), (3, "b")])).count() == 2
    fresh = index.add(batch([(4, "B"), (5, "c"), (6, None)]))
    assert sorted(r.keep_id for r in fresh.collect()) == [5, 6]
    index.close()
    again = exact_dedup.DigestIndex(spark, index.path, buckets=4)  # a later session continues with it
    got = {r.text_sha256: (r.keep_id, r.group_size) for r in again.lookup(batch([(1, "a"), (3, "b"), (9, "")])).collect()}
    assert got == {sha("a"): (2, 2), sha("b"): (4, 2), sha(""): (6, 1)}


# 5 substring dedup

def brute_substrings(texts, window):
    split = [WORD.findall(t or "") for t in texts]
    count = collections.Counter(tuple(w[i:i + window]) for w in split for i in range(len(w) - window + 1))
    out = []
    for w in split:
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if count[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        out.append((len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return out


def test_substring_dedup(spark, edge, clashing, edge_rows):
    want = table([(i, *b) for (i, _, _), b in zip(edge_rows, brute_substrings([t for _, t, _ in edge_rows], 35))])
    assert rows_of(substring_dedup.dedup_substrings(edge), "doc_id", "n_words", "n_removed", "kept_text") == want
    got = substring_dedup.dedup_substrings(clashing)
    assert rows_of(got, "doc_id", "n_words", "n_removed", "kept_text") == want and {r["rep"] for r in got.collect()} == {"old"}


def test_substring_dedup_with_shared_passages_and_few_words(spark):
    import random
    r = random.Random(7)
    rows = []
    for i in range(60):  # a tiny vocabulary gives overlapping, nested and self-repeating passages
        w = r.choices(["a", "b"], k=r.randint(0, 90)) if i % 2 else prose(i, r.randint(20, 80)).split()
        for _ in range(r.randint(0, 3)):
            passage = prose(1000 + r.randint(0, 4), 60).split()
            lo = r.randint(0, 30)
            at = r.randint(0, len(w))
            w[at:at] = passage[lo:lo + r.randint(5, 45)]
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    for window, node in ((35, 8), (9, 4), (12, 12)):
        want = table([(i, *b) for (i, _), b in zip(rows, brute_substrings([t for _, t in rows], window))])
        assert rows_of(substring_dedup.dedup_substrings(docs, window, node), "doc_id", "n_words", "n_removed", "kept_text") == want


# 6 quality rules

def brute_measures(t):
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    triples = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    cover = {i + j for i in range(len(w) - 2) if triples[tuple(w[i:i + 3])] > 1 for j in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover)


def test_quality_measures(edge, clashing, edge_rows):
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    want = []
    for i, t, _ in edge_rows:
        m = brute_measures(t or "")
        want.append((i, *m, m[0] < 50 or 100 * m[4] > 50 * m[0]))
    for docs in (edge, clashing):
        got = quality.score(docs)
        assert rows_of(got, *names) == table(want)
        assert rows_of(got, "doc_id", "kept") == rows_of(quality.score(docs, keep_text=False), "doc_id", "kept")
        assert not any(r.kept and r.base_failed for r in got.collect())
        assert quality.keep(docs).columns == docs.columns


def test_quality_tells_junk_from_prose(spark):
    good = [(i, prose(i, 150)) for i in range(150)]
    junk = [(1000 + i, " ".join(w + "###%%%" for w in prose(i, 150).split())) for i in range(12)]
    junk += [(1100 + i, prose(i, 150).upper().replace(" ", "!! ")) for i in range(12)]
    junk += [(1200 + i, prose(i, 150).replace(" ", " | ")) for i in range(12)]
    kept = {r.doc_id for r in quality.keep(spark.createDataFrame(good + junk, "doc_id long, text string")).collect()}
    assert len(kept & {i for i, _ in good}) >= 148 and len(kept - {i for i, _ in good}) <= 2


def test_quality_estimation_finds_the_accuracies():
    r = np.random.default_rng(3)
    good = r.random(20_000) < 0.8
    votes = np.where(r.random((20_000, 5)) < np.where(good[:, None], 0.02, 0.6), -1, 0)
    patterns, which, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    posterior, share, vote = quality.estimate(patterns, counts.astype(float))
    assert abs(share - 0.8) < 0.03 and ((posterior[which.ravel()] > 0.5) == good).mean() > 0.95
    assert (abs(vote[1, :, 0] - 0.6) < 0.08).all() and (vote[0, :, 0] < 0.06).all()


# 8 near dedup

def brute_components(rows, k, percent=80):
    def shingles(t):
        w = WORD.findall((t or "").translate(FOLD))
        return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])
    sets = [(i, shingles(t)) for i, t in rows]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [(i, len(s), find(i)) for i, s in sets if i is not None]


def test_near_dedup(spark, edge, clashing, edge_rows):
    for k in (2, 5):
        want = brute_components([(i, t) for i, t, _ in edge_rows], k)
        got = near_dedup.near_duplicates(edge, near_dedup.Params(shingle=k))
        assert rows_of(got.where("doc_id IS NOT NULL"), "doc_id", "n_shingles", "component_id") == table(want)
        assert got.count() == len(edge_rows)
        no_id = {r.n_shingles: (r.component_id, r.kept) for r in got.where("doc_id IS NULL").collect()}
        assert no_id[0] == (None, True) and (7, False) in no_id.values()
        assert rows_of(near_dedup.near_duplicates(clashing, near_dedup.Params(shingle=k)), "doc_id", "component_id") == rows_of(got, "doc_id", "component_id")
    kept = near_dedup.dedup(clashing)
    assert kept.columns == clashing.columns and {r["rep"] for r in kept.collect()} == {"old"}


@pytest.mark.parametrize("p", [near_dedup.Params(shingle=2), near_dedup.Params(shingle=2, rounds=0, block=3)])
def test_near_dedup_chains_and_families(spark, p):
    import random
    r = random.Random(11)
    rows = []
    for f in range(6):  # each text changes a few words of one before it: chains whose ends are unlike each other
        text = prose(f, 60).split()
        for i in range(25):
            rows.append((len(rows), " ".join(text)))
            if i % 3:
                text = list(r.choice([t for _, t in rows[-min(i, 6):]]).split()) if i > 3 and r.random() < 0.5 else text
            for _ in range(r.randint(1, 3)):
                text[r.randrange(len(text))] = f"w{r.randrange(1000)}"
    want = brute_components(rows, 2)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), p)
    assert rows_of(got, "doc_id", "n_shingles", "component_id") == table(want)


# 9 LM scoring

def test_lm_scores(spark, edge, edge_rows, clashing):
    chosen = {7, 11, 13, 99}
    target = spark.createDataFrame([(i,) for i in (*chosen, 7, None)], "doc_id long")
    counts = [collections.Counter(), collections.Counter()]
    for i, t, _ in edge_rows:
        b = (t or "").encode()
        for j in range(len(b) - 4):
            counts[1][b[j:j + 5]] += 1
            counts[0][b[j:j + 5]] += i in chosen
    scale = sum(counts[0].values()) / sum(counts[1].values())
    counts[1] = {g: n * scale for g, n in counts[1].items()}
    context = [collections.Counter(), collections.Counter()]
    for c, x in zip(counts, context):
        for g, n in c.items():
            x[g[:4]] += n
    for docs in (edge, clashing):
        got = lm_scoring.score(docs, target)
        assert got.count() == len(edge_rows)
        for r in got.where("doc_id IS NOT NULL").collect():
            b = (next(t for i, t, _ in edge_rows if i == r.doc_id) or "").encode()
            grams = [b[j:j + 5] for j in range(len(b) - 4)]
            assert r.n_tokens == len(grams)
            if not grams:
                assert r.score is None
                continue
            loss = [-np.mean([np.log((c[g] + 1 / 256) / (x[g[:4]] + 1)) for g in grams]) for c, x in zip(counts, context)]
            assert r.loss_target == pytest.approx(loss[0]) and r.score == pytest.approx(loss[0] - loss[1], abs=1e-9)


def test_lm_scores_rank_held_out_texts(spark):
    like = [(i, prose(i, 80)) for i in range(80)]
    other = [(100 + i, " ".join("".join(reversed(w)) for w in prose(i, 80).split())) for i in range(80)]
    target = spark.createDataFrame([(i,) for i in range(60)], "doc_id long")
    got = {r.doc_id: r.score for r in lm_scoring.score(spark.createDataFrame(like + other, "doc_id long, text string"), target).collect()}
    assert max(got[i] for i in range(60, 80)) < min(got[100 + i] for i in range(80))


# 10 line dedup

def brute_lines(rows):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(FOLD)
    holders = collections.defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            holders[key(x)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        last = lambda x: max(h for h in holders[key(x)] if h is not None)
        kept = [x for x in lines if len(key(x)) < 40 or len(holders[key(x)]) < 5 or last(x) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_line_dedup(spark, edge, clashing, edge_rows):
    shared = "  A line of more than forty CODE points, é, shared by many texts\t"
    more = [(200 + i, f"{prose(i, 20)}\n{shared if i % 2 else shared.lower().strip()}\nshort\n{shared}", "z") for i in range(6)]
    rows = [(i, t) for i, t, _ in (*edge_rows, *more)]
    want = table(brute_lines(rows))
    got = line_dedup.dedup_lines(edge.unionByName(spark.createDataFrame(more, edge.schema)))
    assert rows_of(got, "doc_id", "n_lines", "n_dropped", "kept_text") == want
    got = line_dedup.dedup_lines(clashing)
    assert rows_of(got, "doc_id", "n_lines", "n_dropped", "kept_text") == table(brute_lines([(i, t) for i, t, _ in edge_rows]))
    assert {r["rep"] for r in got.collect()} == {"old"}


def test_line_runs_are_compacted(spark):
    line = "a line that is long enough to be looked at by the runs"
    runs = line_dedup.LineRuns(spark, fanout=2, buckets=3)
    rows = [(i, f"{line}\nown {i}") for i in range(6)]
    for r in rows:
        runs.add(spark.createDataFrame([r], "doc_id long, text string"))
    assert [len(x) for x in runs.levels] == [0, 1, 1]
    got = runs.strip(spark.createDataFrame(rows, "doc_id long, text string"))
    assert rows_of(got, "doc_id", "n_lines", "n_dropped", "kept_text") == table(brute_lines(rows))


# empty tables

def test_empty_tables(spark, empty, ranks):
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        model = f.read()
    index = exact_dedup.DigestIndex(spark, buckets=2)
    index.add(empty)
    results = [mixing.plan(empty), mixing.mix(empty), bpe.decode(bpe.encode(empty, ranks, public_tokenizers.PATTERN), ranks), licenses.scan(empty),
               index.lookup(empty), exact_dedup.dedup(empty), substring_dedup.dedup_substrings(empty), quality.score(empty), quality.keep(empty),
               token_files.write(empty, model).read(), near_dedup.near_duplicates(empty), near_dedup.dedup(empty),
               lm_scoring.score(empty, empty), line_dedup.dedup_lines(empty)]
    assert [r.count() for r in results] == [0] * len(results)


def test_crc_of_token_files_is_that_of_zlib(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(bytearray(b"\x01\x00\x00\x00"),)], "ids binary").select(F.crc32("ids").alias("c"))
    assert df.first().c == zlib.crc32(b"\x01\x00\x00\x00")
