import random

import pytest

SYLLABLES = "an be co di en fo ga he in jo ka le mi no or pa qu re si to un ve wi xy zo".split()


def prose(seed: int, n: int, line: int = 12) -> str:
    """n made-up words with punctuation and line feeds."""
    r = random.Random(seed)
    words = ["".join(r.choices(SYLLABLES, k=r.randint(1, 3))) for _ in range(n)]
    out = [w.capitalize() + ("." if i % 9 == 8 else "") for i, w in enumerate(words)]
    return "\n".join(" ".join(out[i:i + line]) for i in range(0, n, line))


#: Names that the operators use inside or add; a table may hold columns of these names.
CLASHES = ("kept", "n_words", "ids", "decoded", "digest", "rep", "size", "place", "part", "batch", "stay", "last", "keep_id", "text_sha256",
           "group_size", "n_lines", "kept_text", "posterior", "target", "component_id", "n", "w", "key", "h1", "at", "template", "score")


@pytest.fixture(scope="session")
def edge_rows():
    """(doc_id, text, source): nulls in any column, empty and very long texts, ties, repeated rows, white space of all kinds."""
    base = prose(1, 120)
    near = base.replace(base.split()[60], "changed")
    return [
        (1, None, "a"), (2, "", "a"), (3, " \t\n\x0b\x0c\r ", "a"), (4, "one", None), (5, "one two", None), (6, "one two", "b"),
        (7, base, "b"), (8, base, "c"), (8, base, "c"), (9, base.upper(), "c"), (10, near, "a"), (11, prose(2, 60), "a"),
        (None, base, "a"), (None, "no id", "a"), (None, None, None), (12, prose(3, 30_000), "long"), (13, "Ünï côdé 漢字 é́ \U0001f600  nbsp sep", "a"),
        (14, "same line " * 8 + "\n" + "x", "a"), (15, ("word " * 200).strip(), "d"), (16, "Licensed under the Apache License, Version 2.0.", "d"),
        (17, "a\x00b <|endoftext|> \x1c\x85 it's I'LL we'll  two   three\n\n four", "d"), (18, prose(2, 60), "a"), (19, "  lead and trail  ", None), (20, "\n\n\n", "a"),
    ]


@pytest.fixture()
def edge(spark, edge_rows):
    return spark.createDataFrame(edge_rows, "doc_id long, text string, source string")


@pytest.fixture()
def clashing(spark, edge_rows):
    """The same rows with further columns whose names the operators use as well."""
    return spark.createDataFrame([(*r, *["old"] * len(CLASHES)) for r in edge_rows],
                                 "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in CLASHES))


@pytest.fixture()
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string")


def rows_of(df, *columns):
    """Rows as a sorted list of tuples; null sorts first."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: [(x is not None, x) for x in r])


def table(rows):
    return sorted(rows, key=lambda r: [(x is not None, x) for x in r])
