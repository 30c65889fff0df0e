"""Tries of conversations against brute force over all prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from pairscore.llm.prefix_trie import prefix_trie, rebuilt, turn_lists

TURNS = "conv_id long, turn long, role string, text string"


def lists(rows):
    out = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            out[conv_id].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in out.items()}


def with_heads(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = convs.get(c - c % 100, [])[:h] + own[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    below = defaultdict(list)
    for p in members:
        if p:
            below[p[:-1]].append(p)

    def subtree(p):
        todo, out = [p], []
        while todo:
            out.append(todo.pop())
            todo += below[out[-1]]
        return out

    rows = []
    for p, own in members.items():
        tree = subtree(p)
        ends = sorted(c for c in own if len(convs[c]) == len(p))
        saved = sum((len(members[q]) - 1) * len(q[-1][1]) for q in tree if q)
        rows.append((min(own), len(p), min(members[p[:-1]]) if p else None, len(own), len(below[p]), sum(not below[q] for q in tree), saved, hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return rows


def got(spark, rows, heads=False, **options):
    convs = turn_lists(spark.createDataFrame(rows, TURNS))
    return [tuple(r) for r in prefix_trie(rebuilt(convs) if heads else convs, **options).collect()]


def order(rows):
    return sorted(rows, key=repr)


def made(seed, n):
    """Few different turns, so that tries are bushy and deep; copies, gaps, nulls and ties of equal turns."""
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(300), n):
        same = rnd.random() < 0.3
        for turn in range(rnd.randrange(1, 9)):
            role, text = rnd.choice(["user", "assistant", None]), rnd.choice(["a", "bcd", "é😀", "", None])
            rows.append((c, None if turn == 0 and rnd.random() < 0.2 else turn * 2, "user" if same else role, "same" if same else text))
    rows += rows[:3]
    rows.append((None, 0, "user", "of none"))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("options", [{}, {"group_turns": 5}, {"group_turns": 1, "few": 0}, {"group_turns": 40}])
def test_against_brute_force(spark, options):
    rows = made(len(options), 120)
    assert order(got(spark, rows, **options)) == order(brute(lists(rows)))


def test_rebuilt_conversations(spark):
    rows = made(7, 150)
    assert order(got(spark, rows, True, group_turns=10)) == order(brute(with_heads(lists(rows))))


def test_turnless_conversations_end_at_the_root(spark):
    """Conversations of one turn whose heads don't exist become turnless, where h takes that turn."""
    rows = [(c, 0, "user", "x") for c in range(101, 130)]
    want = brute(with_heads(lists(rows)))
    assert want[0][1] == 0 and want[0][7] != hashlib.sha256(b"").hexdigest()
    assert order(got(spark, rows, True)) == order(want)


def test_one_long_conversation_and_many_copies(spark):
    """Deeper than Python's recursion, and more copies than a group's limit: neither is dealt again."""
    deep = [(1, i, "user", "x") for i in range(3_000)]
    copies = [(c, i, "user", f"t{i}") for c in range(10, 60) for i in range(4)]
    found = got(spark, deep + copies, group_turns=100)
    assert len(found) == 1 + 3_000 + 4
    assert {r[3] for r in found if r[0] == 10} == {50}
    assert max(r[1] for r in found) == 3_000


def test_empty_and_extra_columns(spark):
    assert got(spark, []) == []
    rows = made(3, 40)
    more = spark.createDataFrame(rows, TURNS).selectExpr("*", "1 AS key", "2 AS level", "'p' AS path", "3 AS digests", "4 AS chars", "5 AS t")
    assert order([tuple(r) for r in prefix_trie(turn_lists(more)).collect()]) == order(brute(lists(rows)))
