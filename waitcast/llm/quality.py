"""Quality rules under weak supervision.

Every rule votes for a text, against it, or abstains. Expectation maximisation over the votes of
the whole corpus estimates how often each rule votes rightly on good and on bad texts, and a text's
posterior probability of being good replaces the demand that it pass every rule.

The votes of a text are one of at most 3 ** rules patterns. The corpus is counted by pattern,
so the estimation works on a table whose size is bounded by the rules, not by the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waitcast.llm import words
from waitcast.llm.scratch import materialise

SYMBOLS = b"#*$%&|<>"
#: Fixed values of the contract query: below so many words, or above this share of repeated words, a text fails.
MIN_WORDS = 50
MAX_REPEATED = 50

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_letters", "n_bare_words", "n_lines", "n_end_lines"]


def _covered(again: np.ndarray) -> np.ndarray:
    """Words in a marked window of three, from the marks at the windows' first words."""
    out = np.concatenate([again, [False, False]])
    out[1:] |= np.concatenate([again, [False]])
    out[2:] |= again
    return out


def _group_measures(g: words.Group) -> dict[str, np.ndarray]:
    """The measures of a group of texts, by whole-array operations over their bytes and words."""
    data, at, n = g.data, g.offsets, len(g.rows)

    def count(mask: np.ndarray) -> np.ndarray:
        ends = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return ends[at[1:]] - ends[at[:-1]]

    table = lambda chars: np.isin(np.arange(256, dtype=np.uint8), np.frombuffer(chars, np.uint8))
    upper = (data >= 0x41) & (data <= 0x5A)
    high = data >= 0xC0  # one lead byte for each character beyond ASCII
    letters = upper | ((data >= 0x61) & (data <= 0x7A)) | high
    starts_char = (data & 0xC0) != 0x80
    out = {"n_words": g.n_words, "word_chars": count(starts_char & words.NOT_SPACE[data]), "n_symbols": count(table(SYMBOLS)[data]),
           "n_upper": count(upper), "n_letters": count(letters)}

    doc = np.repeat(np.arange(n), g.n_words)
    ahead = np.concatenate([[0], np.cumsum(letters, dtype=np.int64)])
    out["n_bare_words"] = np.bincount(doc[ahead[g.end] == ahead[g.first]], minlength=n)

    # three-word windows inside one text, told apart by text
    k = words.rolled(g.hash, 3)
    inside = doc[:len(k)] == doc[2:] if len(k) else np.zeros(0, bool)
    with np.errstate(over="ignore"):
        key = words.mixed(k ^ words.mixed(doc[:len(k)].astype(np.uint64) + np.uint64(1)))
    key = key[inside]
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    again_sorted = np.zeros(len(key), bool)
    again_sorted[1:] |= same
    again_sorted[:-1] |= same
    found = np.zeros(len(k), bool)
    flags = np.zeros(len(key), bool)
    flags[order] = again_sorted
    found[inside] = flags
    cover = _covered(found)[:len(doc)] if len(k) else np.zeros(len(doc), bool)
    out["n_repeat_words"] = np.bincount(doc[cover], minlength=n)

    # lines: cut at line feeds and at the ends of texts
    line_first, line_end = words.spans(data, at[:-1], np.arange(256) != 0x0A)
    filled = np.searchsorted(g.first, line_end) > np.searchsorted(g.first, line_first)  # has a word
    line_first, line_end = line_first[filled], line_end[filled]
    line_doc = np.searchsorted(at, line_first, "right") - 1
    with np.errstate(over="ignore"):
        line_key = words.mixed(words.hashes(data, line_first, line_end) ^ words.mixed(line_doc.astype(np.uint64) + np.uint64(1)))
    _, first_seen = np.unique(line_key, return_index=True)
    dup = np.ones(len(line_key), bool)
    dup[first_seen] = False
    out["n_dup_lines"] = np.bincount(line_doc[dup], minlength=n)
    out["n_lines"] = np.bincount(line_doc, minlength=n)
    last_word = np.searchsorted(g.first, line_end) - 1
    ends_well = table(b".!?\"'):;,")[data[g.end[last_word] - 1]] if len(line_doc) else np.zeros(0, bool)
    out["n_end_lines"] = np.bincount(line_doc[ends_well], minlength=n)
    return out


def measure(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """``docs`` (all columns, but for the text on demand) with the MEASURES of the text as longs; a null text has none of anything.

    Words are runs of anything but ASCII white space. word_chars: code points in words; n_symbols:
    characters of ``#*$%&|<>``; n_dup_lines: lines with a word that equal an earlier line;
    n_repeat_words: words in three-word windows found twice or more in the text; n_upper: A-Z;
    n_letters: ASCII letters and characters beyond ASCII; n_bare_words: words without any; n_lines: lines with a word; n_end_lines:
    those that end with a punctuation mark.
    """
    docs = docs.drop(*[c for c in MEASURES if c in docs.columns])
    names = [c for c in docs.columns if keep_text or c != "text"]
    schema = T.StructType([*[docs.schema[c] for c in names], *[T.StructField(m, T.LongType()) for m in MEASURES]])
    at, old = docs.columns.index("text"), [docs.columns.index(c) for c in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: dict[str, list[np.ndarray]] = {m: [] for m in MEASURES}
            for g in words.groups(batch.column(at)):
                for m, v in _group_measures(g).items():
                    parts[m].append(v)
            new = [pa.array(np.concatenate(parts[m]) if parts[m] else np.zeros(0), pa.int64()) for m in MEASURES]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in old], *new], names=[*names, *MEASURES])

    return docs.mapInArrow(run, schema)


def votes() -> dict[str, Column]:
    """Each rule's vote from the measures: 1 good, -1 bad, 0 abstains. Thresholds are usual ones for web text.

    Passing a test says little, as junk of one kind passes the tests for all other kinds; so a rule
    that looks for junk votes against or abstains, and only the rules for running prose vote for.
    """
    share = lambda part, whole: F.col(part) / F.greatest(F.col(whole), F.lit(1))
    against = lambda bad: F.when(bad, -1).otherwise(0)
    in_favour = lambda good: F.when(good, 1).otherwise(0)
    mean = share("word_chars", "n_words")
    return {
        "word_length": against((F.col("n_words") > 0) & ((mean < 3) | (mean > 10))),
        "symbols": against(share("n_symbols", "n_words") > 0.1),
        "dup_lines": against((F.col("n_lines") >= 10) & (share("n_dup_lines", "n_lines") > 0.3)),
        "repeats": against(share("n_repeat_words", "n_words") > 0.3),
        "capitals": against(share("n_upper", "n_letters") > 0.3),
        "letters": against(share("n_letters", "word_chars") < 0.8),
        "bare_words": against(share("n_bare_words", "n_words") > 0.2),
        "sentences": in_favour((F.col("n_lines") > 0) & (share("n_end_lines", "n_lines") >= 0.5)),
        "length": in_favour((F.col("n_words") >= 100) & (F.col("n_words") <= 100_000)),
    }


#: Where estimation starts: how often a rule votes against, abstains, and votes for a text of each class.
#: A bad text breaks some of the rules, not all of them.
START = {"good": (0.02, 0.49, 0.49), "bad": (0.30, 0.45, 0.25)}


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, float, np.ndarray]:
    """Posterior of good for each vote pattern, the share of good texts, and how the rules vote.

    patterns: one row per pattern, one column per rule, of -1, 0, 1. Given the truth, rules count as
    independent, and each has its own probabilities of the three votes on good and on bad texts
    (returned as class x rule x vote). The start and a prior of the weight of sqrt(texts) on it say
    which of the classes is the good one; a rule never votes against good texts more often than
    against bad ones.
    """
    n_rules = patterns.shape[1]
    start = np.stack([np.tile(START[k], (n_rules, 1)) for k in ("good", "bad")])
    if not len(patterns):
        return np.zeros(0), 0.5, start
    cast = np.stack([patterns == v for v in (-1, 0, 1)], 2).astype(float)  # pattern x rule x vote
    total = counts.sum()
    prior = start * max(1.0, total ** 0.5)
    vote, share, posterior = start, 0.8, np.full(len(patterns), 0.8)
    for _ in range(rounds):
        good, bad = (np.einsum("prv,rv->p", cast, np.log(vote[c])) for c in (0, 1))
        new = 1 / (1 + np.exp(np.clip(bad + np.log1p(-share) - good - np.log(share), -700, 700)))
        by_class = np.stack([np.einsum("p,prv->rv", counts * w, cast) for w in (new, 1 - new)]) + prior
        vote = by_class / by_class.sum(2, keepdims=True)
        turned = vote[0, :, 0] > vote[1, :, 0]
        vote[:, turned] = vote[:, turned].mean(0)
        share = float(np.clip((counts * new).sum() / total, 0.01, 0.99))
        done, posterior = np.abs(new - posterior).max() < 1e-9, new
        if done:
            break
    return posterior, share, vote


def score(docs: DataFrame, threshold: float = 0.5, keep_text: bool = True) -> DataFrame:
    """``docs`` (all columns, but for the text on demand) with the measures, base_failed, posterior (of
    being good) and kept.

    base_failed: fewer than 50 words, or more than half of the words repeated. kept: not base_failed
    and a posterior of at least ``threshold``. The votes are counted over all rows, repeated ones too.
    """
    spark = docs.sparkSession
    named = {f"_llm_vote_{k}": v for k, v in votes().items()}
    docs = docs.drop(*[c for c in ("base_failed", "posterior", "kept") if c in docs.columns])
    if keep_text:
        rows = measure(docs).withColumns(named)
        voted = measure(docs.select("text"), keep_text=False).withColumns(named)
    else:
        rows = voted = materialise(measure(docs, keep_text=False).withColumns(named), "quality-measures")
    table = voted.groupBy(*named).count().toPandas()  # at most 3 ** rules rows
    posterior, _, _ = estimate(table[list(named)].to_numpy(), table["count"].to_numpy(float))
    known = [(*map(int, votes_), float(p)) for votes_, p in zip(table[list(named)].itertuples(index=False), posterior, strict=True)]
    known = spark.createDataFrame(known, ", ".join(f"_llm_p{k} int" for k in named) + ", posterior double")
    same = [F.col(k) == F.col(f"_llm_p{k}") for k in named]
    rows = rows.join(F.broadcast(known), same, "left").drop(*named, *[f"_llm_p{k}" for k in named])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return rows.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= threshold))


def keep(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that are kept, columns unchanged."""
    return score(docs, threshold).where("kept").select(*docs.columns)
