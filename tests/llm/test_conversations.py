"""Conversation repair against an exhaustive search over edits."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from waterline.llm.conversations import Edits, damage, repair, repaired_turns

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
BLANKS = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = text.replace(".", "").replace("!", "").replace("?", "")
        if kind == 4:
            role = "user"
        yield conv, turn, role, text
        if kind == 3:
            yield conv, turn, role, text


def scripts(rows, state=0, inserted=0):
    """Every sequence of edits that gives the pattern: cost, audit, turns. Two insertions in a row at most at one place."""
    if not rows and state in (0, 3):
        yield 0, "", []
    if inserted < 2:
        to, role = (3, "assistant") if state == 2 else (2, "user")
        for cost, audit, turns in scripts(rows, to, inserted + 1):
            yield cost + 2, "I" + audit, [(role, ""), *turns]
    if rows:
        (role, text, fault), rest = rows[0], rows[1:]
        for cost, audit, turns in scripts(rest, state):
            yield cost + 3, "D" + audit, turns
        if fault not in ("blank", "duplicate"):
            more = fault == "truncated"
            to, named = (3, "assistant") if state == 2 else (2, "user")
            for cost, audit, turns in scripts(rest, to):
                yield cost + 2 + more, "R" + audit, [(named, text), *turns]
            to = {("s", 0): 1, ("u", 0): 2, ("u", 1): 2, ("u", 3): 2, ("a", 2): 3}.get((role[:1], state))
            if to is not None:
                for cost, audit, turns in scripts(rest, to):
                    yield cost + more, "K" + audit, [(role, text), *turns]


def plain_repair(rows, convs):
    """rows after damage."""
    found = []
    for conv in convs:
        mine = [r for r in rows if r[0] == conv]
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        seen, faulty = set(), []
        for _, _, role, text in mine:
            ending = text.rstrip(BLANKS)[-1:]
            fault = "blank" if not ending else "duplicate" if (role, text) in seen else None if ending in ".!?" else "truncated"
            seen.add((role, text))
            faulty.append((role, text, fault))
        cost, audit, turns = min(scripts(faulty), key=lambda x: x[:2])
        times = [r[1] for r in mine if r[1] is not None]
        gaps = max(times) - min(times) + 1 - len(set(times)) if times else 0
        pairs = zip(mine, mine[1:])
        counts = [sum(f == kind for _, _, f in faulty) for kind in ("blank", "duplicate", "truncated")]
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in pairs)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in turns).encode()).hexdigest()
        found.append((conv, gaps, *counts, illegal, cost, audit, digest, turns))
    return sorted(found, key=lambda x: (x[0] is not None, x[0]))


def made_rows(n, seed):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "Why?", "", " \t", "Go!", "x.\n", None, "und ß", "Yes"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, ""]
    rows = [(rng.choice([1, 2, 3, 4, 5, 6, 7, 8, None]), rng.choice([None, 0, 1, 2, 3, 9, -4]), rng.choice(roles), rng.choice(texts)) for _ in range(n)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return made_rows(26, 1) + [(50, t, "user", "Same.") for t in range(4)] + [(51, 0, "system", "Only."), (51, 0, "system", "Only.")]


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda x: (x[0] is not None, x[0]))


@pytest.mark.parametrize("bounds", [{}, {"most_rows": 0, "block_rows": 2}, {"most_rows": 3, "block_rows": 1}, {"most_bytes": 8, "block_rows": 3}])
def test_repair_is_the_cheapest(spark, rows, bounds):
    expected = plain_repair(list(plain_damage(rows)), {r[0] for r in rows})
    damaged = damage(spark.createDataFrame(rows, SCHEMA).repartition(3))
    assert collected(repair(damaged, **bounds)) == [x[:-1] for x in expected]


@pytest.mark.parametrize("bounds", [{}, {"most_rows": 0, "block_rows": 2}])
def test_repaired_turns(spark, rows, bounds):
    expected = plain_repair([(c, t, r or ("" if r == "" else " "), " " if x is None else x) for c, t, r, x in rows], {r[0] for r in rows})
    made = repaired_turns(spark.createDataFrame(rows, SCHEMA).repartition(3), **bounds)
    found = {}
    for r in made.orderBy("conv_id", "part", "block", "place").collect():
        found.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert found == {x[0]: x[-1] for x in expected if x[-1]}


def test_blocks_agree_on_a_long_conversation(spark):
    rng = random.Random(3)
    long = [(1, t // 2, rng.choice(["user", "user", "assistant", "system"]), rng.choice(["Yes.", "No", f"{t}.", f"{t}?", ""])) for t in range(3000)]
    alike = [(2, None, "user", f"{t}.") for t in range(2000)]
    df = spark.createDataFrame(long + alike + made_rows(30, 2), SCHEMA).repartition(7)
    assert collected(repair(df)) == collected(repair(df, most_rows=500, block_rows=64))


def test_first_difference_decides():
    edits = Edits()

    def node(labels):
        at = 0
        for x in labels:
            at = edits.add(at, x)
        return at

    rng = random.Random(4)
    words = ["".join(rng.choice("DIKR") for _ in range(rng.randint(0, 40))) for _ in range(60)]
    words += [w + x for w in words[:20] for x in ("D", "R", "KK")]
    for a in words:
        for b in words:
            assert edits.less(node(a), node(b)) == (a < b)
    # Hashes may collide: the nodes decide.
    edits.hash = [0] * len(edits.hash)
    assert all(edits.less(node(a), node(b)) == (a < b) for a in words for b in words)


def test_empty_and_extra_columns(spark):
    assert repair(spark.createDataFrame([], SCHEMA)).count() == 0
    odd = spark.createDataFrame([(1, 0, "user", "Hi.", 1, 2, 3)], SCHEMA + ", part int, blank int, cost int")
    assert [r["audit"] for r in repair(damage(odd)).collect()] in (["KI"], [""])
    assert [r["audit"] for r in repair(odd).collect()] == ["KI"]


def test_long_text(spark):
    text = "word " * 400_000 + "end."
    row = repair(spark.createDataFrame([(1, 0, "user", text), (1, 1, "assistant", "Yes.")], SCHEMA)).first()
    assert (row["audit"], row["truncated"]) == ("KK", 0)
