"""The pipeline's stages, each on what its predecessor kept, against plain versions in Python."""

import collections
import hashlib

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from tests.llm.conftest import CLASHES, prose
from tests.llm.test_brute_force import FOLD, WORD, brute_components, brute_measures
from waitcast.llm import bpe

SCHEMA = "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in CLASHES)
STAGES = ["quality rules", "exact dedup", "near dedup", "mix of sources", "token ids"]


def corpus(edge_rows):
    """Rows of edge cases, clean prose, copies, near copies and junk; the ids of the clean and of the junk rows."""
    clean = [(1000 + i, prose(100 + i, 120 + i), "hot" if i % 3 else f"s{i % 5}") for i in range(90)]
    copies = [(2000 + i, t.upper() if i % 2 else t, "s1") for i, (_, t, _) in enumerate(clean[:20])]
    near = [(3000 + i, t.replace(t.split()[40], "changed", 1), None) for i, (_, t, _) in enumerate(clean[20:40])]
    junk = [(4000 + i, " ".join(w + "###%%%" for w in prose(i, 150).split()), "hot") for i in range(15)]
    rows = [*edge_rows, *clean, *clean[:3], *copies, *near, *junk]
    return rows, {i for i, _, _ in clean}, {i for i, _, _ in junk}


@pytest.fixture()
def steps(monkeypatch):
    """What run() writes after each stage, by name."""
    kept, write = {}, corpus_pipeline.materialise

    def remember(df, name):
        kept[name] = write(df, name)
        return kept[name]
    monkeypatch.setattr(corpus_pipeline, "materialise", remember)
    return kept


def sets_of(df):
    return [(r.doc_id, r.text, r.source) for r in df.collect()]


def test_stages_against_plain_versions(spark, edge_rows, steps, tmp_path):
    rows, clean, junk = corpus(edge_rows)
    docs = spark.createDataFrame([(*r, *["old"] * len(CLASHES)) for r in rows], SCHEMA)
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    result = corpus_pipeline.run(spark, str(tmp_path))
    assert [n for n, _ in corpus_pipeline.STAGES] == STAGES
    quality, exact, near, mixed, ids = (steps["pipeline-" + n.replace(" ", "-")] for n in STAGES)
    assert all(df.columns == docs.columns for df in (quality, exact, near, mixed)) and ids.columns == result.columns

    # quality: rows as they came; those that the base rules fail and junk are gone, clean ones stay, repeated rows too
    after, left = collections.Counter(sets_of(quality)), collections.Counter(rows)
    assert all(after[r] in (0, n) for r, n in left.items()) and not set(after) - set(left)
    for i, text, _ in after:
        m = brute_measures(text or "")
        assert m[0] >= 50 and 100 * m[4] <= 50 * m[0]
    assert clean <= {i for i, _, _ in after} and not junk & {i for i, _, _ in after}

    # exact dedup: of texts equal but for the case of A-Z, one row of the largest doc_id
    largest = {}
    for i, text, _ in after:
        key = (text or "").translate(FOLD)
        largest[key] = max(largest.get(key, (False, 0)), (i is not None, i or 0))
    got = sets_of(exact)
    assert collections.Counter((i is not None, i or 0) for i, _, _ in got) == collections.Counter(largest.values())
    assert {(t or "").translate(FOLD) for _, t, _ in got} == set(largest) and set(got) <= set(after)

    # near dedup: the smallest doc_id of each component of texts at a similarity of 0.8 on five-word shingles
    component = {i: c for i, _, c in brute_components([(i, t) for i, t, _ in got], 5)}
    before, got = got, sets_of(near)
    assert collections.Counter(got) == collections.Counter(r for r in before if r[0] is None or component[r[0]] == r[0])
    assert len(got) < len(before)

    # mix: sources near their targets, no row more than twice
    size, weight = collections.Counter(), {}
    for _, text, source in got:
        size[source] += len(WORD.findall(text or ""))
    for k, s in enumerate(sorted(size, key=lambda s: (s is None, s))):
        weight[s] = (5, 2, 1)[k % 3]
    total, capped = 1.5 * sum(size.values()), set()
    while True:
        budget = total - sum(2 * size[s] for s in capped)
        share = {s: budget * weight[s] / sum(weight[x] for x in weight if x not in capped) for s in weight if s not in capped}
        over = {s for s, t in share.items() if t > 2 * size[s]}
        if not over:
            break
        capped |= over
    taken, times = collections.Counter(), collections.Counter(sets_of(mixed))
    for (i, text, source), n in times.items():
        assert (i, text, source) in got and n <= 2
        taken[source] += n * len(WORD.findall(text or ""))
    longest = max(len(WORD.findall(t or "")) for _, t, _ in got)
    assert all(abs(taken[s] - share.get(s, 2 * size[s])) <= longest + 1 for s in size)

    # token ids: those of the library for each row of the mix, and the text back
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = collections.Counter()
    for (i, text, _), n in times.items():
        tokens = library.encode_ordinary(text or "")
        want[(i, len(tokens), b"".join(t.to_bytes(4, "little") for t in tokens), hashlib.sha256((text or "").encode()).hexdigest())] += n
    assert collections.Counter((r.doc_id, r.n_tokens, bytes(r.ids), r.decoded_sha256) for r in result.collect()) == want


def test_pipeline_of_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    result = corpus_pipeline.run(spark, str(tmp_path))
    assert result.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"] and result.isEmpty()
