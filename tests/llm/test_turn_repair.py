"""Operator 13 against a table of all rows, its SQL, and itself in chunks of two rows."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from checks.compare import connect, differences
from tesora.llm import queries, turn_repair

DATA = "/root/testdata/sf0.01"
NEXT, TO = {"": "user", "s": "user", "p": "user", "u": "assistant"}, {"user": "u", "assistant": "p"}


def cheapest(rows, faults):
    """(cost, audit, messages) by a table of all rows that holds whole audits."""
    best = {"": (0, "", [])}

    def chains(state, cost, audit, left):
        for _ in range(4):
            yield state, cost, audit, left
            role = NEXT[state]
            state, cost, audit, left = TO[role], cost + 5, audit + "I", left + [(role, "")]

    for (_, role, text), fault in zip(rows, faults):
        new = {}
        for state, found in best.items():
            for at, cost, audit, left in chains(state, *found):
                moves = [(at, cost + 2, audit + "D", left)]
                if fault not in ("blank", "duplicate"):
                    more = 5 if fault == "truncated" else 0
                    then = NEXT[at]
                    moves.append((TO[then], cost + 1 + more, audit + "R", left + [(then, text)]))
                    if role[:1] == "s" and at == "":
                        moves.append(("s", cost + more, audit + "K", left + [(role, text)]))
                    elif role[:1] == then[0]:
                        moves.append((TO[then], cost + more, audit + "K", left + [(role, text)]))
                for to, *rest in moves:
                    if to not in new or rest[:2] < list(new[to][:2]):
                        new[to] = tuple(rest)
        best = new
    ends = [(c, a, left) for s, found in best.items() for at, c, a, left in chains(s, *found) if at in ("", "p")]
    return min(ends, key=lambda x: x[:2])


def brute(rows):
    held = defaultdict(list)
    shown = lambda v: " " if v is None else str(v)
    for conv, turn, role, text in rows:
        own, how = held[conv], zlib.crc32(f"{shown(conv)}:{shown(turn)}".encode()) % 20
        text = "" if how == 1 else re.sub("[.!?]", "", shown(text)) if how == 2 else shown(text)
        own += [(turn, "user" if how == 4 else shown(role), text)] * {0: 0, 3: 2}.get(how, 1)
    out = []
    for conv, own in held.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        turns, seen, faults = [t for t, _, _ in own if t is not None], set(), []
        for _, role, text in own:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit, left = cheapest(own, faults)
        n = Counter(faults)
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((conv, gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit, sha))
    return sorted(out, key=repr)


def repaired(turns, **settings):
    return sorted(map(tuple, turn_repair.digests(turn_repair.repair(turns, **settings)).collect()), key=repr)


row = st.tuples(st.sampled_from("suax"), st.sampled_from([turn_repair.SOUND, turn_repair.BLANK, turn_repair.TRUNCATED]))


@given(st.lists(row, max_size=14), st.data())
@settings(max_examples=400, deadline=None)
def test_recursion_equals_the_whole_table_also_over_stretches(rows, data):
    names = {turn_repair.SOUND: "", turn_repair.BLANK: "blank", turn_repair.TRUNCATED: "truncated"}
    want = cheapest([(0, role, "x") for role, _ in rows], [names[f] for _, f in rows])
    steps = [*[turn_repair.row_step(role, fault) for role, fault in rows], turn_repair.END]
    cost, end = turn_repair.final_state(steps)
    assert (cost, "".join(turn_repair.audits(steps, 0, end))) == want[:2]
    cuts = sorted(data.draw(st.lists(st.integers(0, len(rows)), max_size=4)))
    edges = [0, *cuts, len(rows)]
    stretches = [steps[a:b] for a, b in zip(edges, edges[1:])] + [[turn_repair.END]]
    tables = [turn_repair.table(s) for s in stretches]
    assert turn_repair.final_state(tables) == (cost, end)
    path = [0, *turn_repair.crossings(tables, 0, end)]
    assert "".join(p for s, a, b in zip(stretches, path, path[1:]) for p in turn_repair.audits(s, a, b)) == want[1]


@given(st.lists(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3), st.integers(0, 3)), min_size=1, max_size=6), max_size=6))
@settings(max_examples=300, deadline=None)
def test_equal_costs_take_the_least_audit(moves):
    """Tables of random moves with many ties, each audit ending in its own step's mark."""
    steps = [turn_repair._least([(a, b, c, f"{'xyz'[(a + b + c) % 3]}{a}{b};") for a, b, c in some]) for some in moves]
    ways = {0: [(0, "")]}
    for step in steps:
        new = defaultdict(list)
        for a, b, cost, audit in step:
            new[b] += [(c + cost, text + audit) for c, text in ways.get(a, [])]
        ways = new
    for end, found in ways.items():
        if found:
            assert "".join(turn_repair.audits(steps, 0, end)) == min(found)[1]


def test_the_query_equals_its_sql_and_brute_force(spark):
    query = queries.op13_turn_repair(spark, DATA)
    assert not differences(query, connect(DATA), queries.oracle_sql()["op13_turn_repair"])
    turns = queries.table(spark, DATA, "conversations")
    want = brute([tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()])
    assert sorted(map(tuple, query.collect()), key=repr) == want
    assert repaired(turn_repair.damage(turns), chunk_rows=2) == want


@pytest.mark.parametrize("chunk_rows", [1, 3, 2048])
def test_odd_rows_and_long_conversations(spark, chunk_rows):
    long = [(7, i, ["user", "assistant"][i % 2], f"Turn {i}{'.' * (i % 5 > 0)}") for i in range(400)]
    rows = [
        *long, (None, None, None, None), (None, 1, "user", "Hi."), (2, None, "user", "A"), (2, None, "assistant", None), (3, 0, "", "No role."),
        (4, 1, "user", "Twice."), (4, 1, "user", "Twice."), (4, 5, "system", "Late."), (5, 0, "System", "Upper."), (6, 2, "assistant", "x " * 200_000 + "."),
        (6, 9, "user", "\x0b\n "), (8, 0, "system", "Only."), (9, 0, "user", "Ask?"), (9, 1, "unknown", "Known."), (-(2**62), 0, "user", "Q?"),
    ]
    turns = spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, audit string, cost int")
    want = brute(rows)
    assert repaired(turn_repair.damage(turns), chunk_rows=chunk_rows) == want
    assert repaired(turn_repair.damage(turns.limit(0)), chunk_rows=chunk_rows) == []


def test_conversations_of_which_all_is_dropped(spark):
    gone = [i for i in range(200) if zlib.crc32(f"{i}:0".encode()) % 20 == 0]
    turns = spark.createDataFrame([(i, 0, "user", "x.") for i in gone], "conv_id long, turn long, role string, text string")
    empty = hashlib.sha256(b"").hexdigest()
    assert repaired(turn_repair.damage(turns)) == sorted([(i, 0, 0, 0, 0, 0, 0, "", empty) for i in gone], key=repr)


def test_one_row_repeated_very_often_is_one_row_of_work(spark):
    turns = spark.range(30_000).selectExpr("1L AS conv_id", "id % 2 AS turn", "'user' AS role", "'Same.' AS text", "1L AS copies")
    ((conv, gaps, blank, duplicate, truncated, illegal, cost, audit, _),) = repaired(turns)
    assert (gaps, blank, duplicate, truncated, illegal, cost) == (0, 0, 29_999, 0, 29_999, 60_000) and audit == "D" * 30_000
