"""Conversation repair against a plain search over edit scripts."""

import collections
import hashlib
import itertools
import random
import re
import zlib

import pytest

from tests.llm.conftest import rows_of, table
from waitcast.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string"
EMPTY = hashlib.sha256(b"").hexdigest()
CHAR = re.compile(r"[^\x20\x09-\x0D]")


def damaged(rows):
    convs = collections.defaultdict(list)
    for c, t, r, x in rows:
        convs[c]
        c_, t_, r, x = (" " if v is None else str(v) for v in (c, t, r, x))
        kind = zlib.crc32(f"{c_}:{t_}".encode()) % 20
        if kind != 0:
            x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
            convs[c] += [(t, "user" if kind == 4 else r, x)] * (2 if kind == 3 else 1)
    return convs


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        chars = CHAR.findall(text)
        out.append("blank" if not chars else "duplicate" if (role, text) in seen else "" if chars[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, wrong):
    """(cost, audit, lines) by trying every script with at most three insertions in a place."""
    best = None
    for inserted in itertools.product(range(4), repeat=len(rows) + 1):
        if sum(inserted) * 2 > 2 + 3 * len(rows):
            continue
        for kept in itertools.product("DKRr", repeat=len(rows)):
            if any(f in ("blank", "duplicate") and e != "D" for e, f in zip(kept, wrong, strict=True)):
                continue
            cost, audit, shape = 0, "", []
            for i in range(len(rows) + 1):
                cost, audit, shape = cost + 2 * inserted[i], audit + "I" * inserted[i], shape + [None] * inserted[i]
                if i < len(rows):
                    e = kept[i]
                    cost += {"D": 3, "K": 0, "R": 2, "r": 2}[e] + (e != "D" and wrong[i] == "truncated")
                    audit += e.upper()
                    shape += [] if e == "D" else [(rows[i][1] if e == "K" else {"R": "user", "r": "assistant"}[e], rows[i][2])]
            if best and (cost, audit) >= best[:2]:
                continue
            for roles in itertools.product(("user", "assistant"), repeat=shape.count(None)):
                fill = iter(roles)
                lines = [(next(fill), "") if x is None else x for x in shape]
                if all(role for role, _ in lines) and re.fullmatch("(s?(ua)+)?", "".join(role[0] for role, _ in lines)):
                    best = cost, audit, lines
                    break
    return best


def by_states(rows, wrong):
    """The same for long conversations: whole scripts by the last initial."""
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user", "a": "assistant"}

    def keep(found, state, way):
        if state not in found or way[:2] < found[state][:2]:
            found[state] = way

    def insertions(found):
        for _ in range(3):
            for state, (cost, audit, lines) in list(found.items()):
                for n in set(after[state]) & {"u", "a"}:
                    keep(found, n, (cost + 2, audit + "I", (*lines, (name[n], ""))))
        return found

    found = {"": (0, "", ())}
    for (_, role, text), f in zip(rows, wrong, strict=True):
        then = {}
        for state, (cost, audit, lines) in insertions(found).items():
            keep(then, state, (cost + 3, audit + "D", lines))
            if f in ("", "truncated"):
                for n in after[state]:
                    if role[:1] == n:
                        keep(then, n, (cost + (f != ""), audit + "K", (*lines, (role, text))))
                    if n in name:
                        keep(then, n, (cost + (f != "") + 2, audit + "R", (*lines, (name[n], text))))
        found = then
    found = insertions(found)
    return min((found[s] for s in ("", "a") if s in found), key=lambda w: w[:2])


def summary(name, rows, search):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    wrong, turns = faults(rows), [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    cost, audit, lines = search(rows, wrong)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
    return (name, gaps, *[wrong.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit, digest)


def random_rows(r, name, n):
    texts = ["Hi.", "Hi.", "so", "ok!", "", " \t", "what?", "end. ", "nb ", None, *[f"t{i}." for i in range(n)]]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    return [(name, r.choice([None, *range(n)]), r.choice(roles), r.choice(texts)) for _ in range(n)]


def test_every_script_of_short_conversations():
    r = random.Random(2)
    for i in range(60):
        rows = sorted(damaged(random_rows(r, i, r.randint(0, 4))).get(i, []), key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))[:4]
        wrong = faults(rows)
        assert cheapest(rows, wrong)[:2] == by_states(rows, wrong)[:2]
        (cost, audit), = conversations.derive([conversations.Row(role, text, turn, f) for (turn, role, text), f in zip(rows, wrong, strict=True)], 0, True).values()
        assert (cost, audit) == cheapest(rows, wrong)[:2]


@pytest.mark.parametrize("segment_rows", [64, 3, 1])
def test_repair_of_damaged_conversations(spark, segment_rows):
    r = random.Random(7)
    rows = [x for c in range(120) for x in random_rows(r, c, r.randint(1, 8))] + random_rows(r, None, 9)
    rows += random_rows(r, 1000, 300) + [(1001, 1, "user", "same.")] * 200 + [(1001, 2, "assistant", "a.")]  # hot conversations
    docs = spark.createDataFrame(rows, SCHEMA)
    want = [summary(c, v, by_states) for c, v in damaged(rows).items() if v]
    got = conversations.repair(conversations.damage(docs.repartition(5)), segment_rows)
    assert rows_of(got.summary, *got.summary.columns) == table(want)
    # the repaired rows are those that the digest is taken of
    lines = collections.defaultdict(list)
    for x in sorted(got.rows.collect(), key=lambda x: (x.part, x.seq, x.place)):
        lines[x.conv_id].append(f"{x.role}:{x.text}")
    assert all(hashlib.sha256("\n".join(lines[w[0]]).encode()).hexdigest() == w[-1] for w in want)


def test_segments_end_by_size_too(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"{i}. " + "x" * 50 + ".") for i in range(20)]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = conversations.segments(conversations.marked(docs), 64, 120).collect()
    assert len(found) >= 10 and all(len(s.roles) <= 2 and not s.whole for s in found)
    (got,) = conversations.repair(docs, 64, 120).summary.collect()
    assert (got.cost, got.audit) == (0, "K" * 20)


def test_conversations_without_rows_and_clashing_columns(spark):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(dropped, 0, "user", "Hi."), (None, None, None, None), (5000, None, "user", "A."), (5000, None, "assistant", "B.")]
    docs = spark.createDataFrame([(*r, "old", 3, "old") for r in rows], SCHEMA + ", copy string, cost int, later string")
    want = [summary(c, v, by_states) for c, v in damaged(rows).items()]
    got = conversations.damaged_and_repaired(docs)
    assert rows_of(got, *got.columns) == table(want)
    assert (dropped, 0, 0, 0, 0, 0, 0, "", EMPTY) in want
    assert conversations.damaged_and_repaired(docs.limit(0)).count() == 0


def test_ties_take_the_least_script(spark):
    rows = [(1, 0, "user", "A."), (1, 1, "user", "B."), (2, 0, "assistant", "A."), (3, 0, "system", "S."), (4, 0, "system", "S."), (4, 1, "user", "U")]
    got = {r.conv_id: (r.cost, r.audit) for r in conversations.repair(spark.createDataFrame(rows, SCHEMA)).summary.collect()}
    assert got == {1: (2, "KR"), 2: (2, "IK"), 3: (3, "D"), 4: (3, "KKI")}
