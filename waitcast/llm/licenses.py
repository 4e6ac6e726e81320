"""License scans by diagonal voting.

All rolling word k-grams of all texts are joined with the k-grams of license templates. A match of
text position p and template position t votes for the diagonal p - t; votes are aggregated by
document, template and diagonal, diagonals that lie next to each other (a word more or less in
between) are merged, and spans with enough of a template's votes are verified on the words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waitcast.llm import words
from waitcast.llm.scratch import text_or_empty


@dataclass(frozen=True)
class Template:
    """Words of a license text and its label. Exact ones must stand word for word."""

    label: str
    phrase: str
    exact: bool = False


#: Fixed values of the contract query: phrases and their labels.
BASE = (
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
)
#: Sentences of well-known public license notices; at most 64 words each.
NOTICES = (
    Template("agpl", "gnu affero general public license"),
    Template("apache", "licensed under the apache license version 2 0 you may not use this file except in compliance with the license"),
    Template("artistic", "the artistic license 2 0 copyright the perl foundation"),
    Template("boost", "boost software license version 1 0"),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    Template("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    Template("cc-by-nc", "licensed under cc by nc 4 0"),
    Template("cc-by-sa", "creative commons attribution sharealike"),
    Template("cc0", "cc0 1 0 universal public domain dedication"),
    Template("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Template("lgpl", "gnu lesser general public license"),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Template("unlicense", "this is free and unencumbered software released into the public domain"),
)
#: Words of a k-gram; no template has fewer.
GRAM = 2
#: Share of a template's k-grams that must vote, and of its words that must be verified.
SHARE = 0.75
#: Diagonals at most so far apart are one place.
DRIFT = 2

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_words(text: str) -> list[str]:
    """Words of a text with A-Z lower-cased: runs of digits, letters a-z and characters beyond ASCII."""
    return _WORD.findall(text.translate(_FOLD))


def template_grams(spark: SparkSession, templates: tuple[Template, ...]) -> DataFrame:
    """(t_gram, template, t_at): a row for each k-gram of each template; as many as their words."""
    rows = []
    for i, t in enumerate(templates):
        n = len(t.phrase.split())
        if not GRAM <= n <= 64:
            raise ValueError(f"a template has {GRAM} to 64 words: {t.phrase}")
        (g,) = words.groups(pa.array([t.phrase]), words.ALNUM, words.FOLD)
        rows += [(int(h), i, at) for at, h in enumerate(words.rolled(g.hash, GRAM).view(np.int64))]
    return spark.createDataFrame(rows, "t_gram long, template int, t_at int")


def _keyed(docs: DataFrame) -> DataFrame:
    text = text_or_empty()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("r"), text.alias("text"))


def grams(docs: DataFrame) -> DataFrame:
    """(doc_id, r, at, gram): every rolling word k-gram of every row; r is a hash of the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g in words.groups(batch.column(2), words.ALNUM, words.FOLD):
                rolled = words.rolled(g.hash, GRAM).view(np.int64)
                # the k-grams of a text: all that start in it but for the last k - 1
                lo = g.word_at[:-1]
                n = np.maximum(g.n_words - (GRAM - 1), 0)
                at = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(rolled[at]))
                part = slice(g.rows.start, g.rows.stop)
                yield pa.RecordBatch.from_arrays([batch.column(0)[part], batch.column(1)[part], lists], names=["doc_id", "r", "grams"])

    found = _keyed(docs).mapInArrow(run, "doc_id long, r long, grams array<long>")
    return found.select("doc_id", "r", F.posexplode("grams").alias("at", "gram"))


def places(docs: DataFrame, templates: tuple[Template, ...], share: float = SHARE, drift: int = DRIFT) -> DataFrame:
    """(doc_id, r, template, first, last): spans, in words, where enough of a template's k-grams vote."""
    table = template_grams(docs.sparkSession, templates)
    votes = grams(docs).join(F.broadcast(table), F.col("gram") == F.col("t_gram"))  # as long as the templates
    votes = votes.groupBy("doc_id", "r", "template", (F.col("at") - F.col("t_at")).alias("diagonal")).agg(
        F.bit_or(F.expr("shiftleft(1L, t_at)")).alias("voted"))  # repeated rows vote once
    exact = F.element_at(F.array(*[F.lit(t.exact) for t in templates]), F.col("template") + 1)
    n = F.element_at(F.array(*[F.lit(len(t.phrase.split())) for t in templates]), F.col("template") + 1)
    votes = votes.withColumn("exact", exact).withColumn("n", n)
    votes = votes.where(~F.col("exact") | (F.bit_count("voted") == F.col("n") - (GRAM - 1)))
    one = W.partitionBy("doc_id", "r", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("exact") | (F.col("diagonal") - F.lag("diagonal").over(one) > drift), F.lit(True))
    votes = votes.withColumn("apart", apart.cast("int"))
    votes = votes.withColumn("place", F.sum("apart").over(one.rowsBetween(W.unboundedPreceding, W.currentRow)))
    merged = votes.groupBy("doc_id", "r", "template", "place").agg(
        F.bit_or("voted").alias("voted"), F.min("diagonal").alias("lo"), F.max("diagonal").alias("hi"), F.first("n").alias("n"))
    enough = F.bit_count("voted") >= F.lit(share) * (F.col("n") - (GRAM - 1))
    return merged.where(enough).select("doc_id", "r", "template", F.greatest("lo", F.lit(0)).alias("first"), (F.col("hi") + F.col("n") - 1).alias("last"))


def verified(found: list[str], template: Template) -> float:
    """Share of the template's words that stand in ``found`` in order; 0 or 1 for an exact one."""
    wanted = template.phrase.split()
    if template.exact:
        return float(found == wanted)
    blocks = SequenceMatcher(None, found, wanted, autojunk=False).get_matching_blocks()
    return sum(b.size for b in blocks) / len(wanted)


def scan(docs: DataFrame, base: tuple[Template, ...] = BASE, notices: tuple[Template, ...] = NOTICES,
         share: float = SHARE, drift: int = DRIFT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): its license statements.

    Returns doc_id, n_words, n_base (places of base phrases), first_word and last_word (smallest and
    largest start of one, words from 0; else null), base_labels and labels (distinct, sorted,
    comma-joined; empty if there are none), score (the largest share of a template's words that was
    verified, 0 to 1) and spans (label, first, last). A null text is empty. Rows repeated with the
    same id and text get the same result.
    """
    templates = (*base, *notices)
    n_base = len(base)
    lists = places(docs, templates, share, drift).groupBy("doc_id", "r").agg(F.collect_list(F.struct("template", "first", "last")).alias("places"))
    lists = lists.select(F.col("doc_id").alias("l_id"), F.col("r").alias("l_r"), "places")
    rows = _keyed(docs).join(lists, F.col("doc_id").eqNullSafe(F.col("l_id")) & (F.col("r") == F.col("l_r")), "left").select("doc_id", "text", "places")
    span = T.ArrayType(T.StructType([T.StructField("label", T.StringType()), T.StructField("first", T.LongType()), T.StructField("last", T.LongType())]))
    schema = T.StructType([T.StructField(name, kind) for name, kind in (
        ("doc_id", T.LongType()), ("n_words", T.LongType()), ("n_base", T.LongType()), ("first_word", T.LongType()), ("last_word", T.LongType()),
        ("base_labels", T.StringType()), ("labels", T.StringType()), ("score", T.DoubleType()), ("spans", span))])
    arrow = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64())]))

    def check(text: str, found: list[dict]) -> dict:
        split = split_words(text)
        base_at, base_labels, labels, score, spans = [], set(), set(), 0.0, []
        for f in sorted(found, key=lambda f: (f["first"], f["template"])):
            t = templates[f["template"]]
            part = verified(split[f["first"]:f["last"] + 1], t)
            if part < (1.0 if t.exact else share):
                continue
            if f["template"] < n_base:
                base_at.append(f["first"])
                base_labels.add(t.label)
            labels.add(t.label)
            score = max(score, part)
            spans.append({"label": t.label, "first": f["first"], "last": f["last"]})
        return {"n_base": len(base_at), "first_word": min(base_at, default=None), "last_word": max(base_at, default=None),
                "base_labels": ",".join(sorted(base_labels)), "labels": ",".join(sorted(labels)), "score": min(score, 1.0), "spans": spans}

    none = check("", [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [g.n_words for g in words.groups(batch.column(1), words.ALNUM, words.FOLD)]
            out = [check(t.as_py(), p.as_py()) if p.is_valid else none for t, p in zip(batch.column(1), batch.column(2), strict=True)]
            column = lambda name, kind: pa.array([o[name] for o in out], kind)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.concatenate([*counts, np.zeros(0, np.int64)]), pa.int64()),
                 *[column(k, pa.int64()) for k in ("n_base", "first_word", "last_word")],
                 *[column(k, pa.string()) for k in ("base_labels", "labels")], column("score", pa.float64()), column("spans", arrow)],
                names=schema.names)

    return rows.mapInArrow(run, schema)
