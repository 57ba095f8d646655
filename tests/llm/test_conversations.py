"""Conversation repair against a plain search over all edits."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from llm import conversations as C

SPACES = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, cost string, n int, kind string"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        shown = [" " if x is None else x for x in (conv, turn)]
        fault = zlib.crc32(f"{shown[0]}:{shown[1]}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        row = (conv, turn, "user" if fault == 4 else role, text)
        out += [row] * (2 if fault == 3 else 1)
    return out


def after(state):
    return "assistant" if state == "u" else "user"


def search(rows):
    """All states with the least (cost, edits) that reach them, row after row."""
    order = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest())
    rows = sorted(rows, key=order)
    seen, faults = set(), []
    for _, role, text in rows:
        body = text.rstrip(SPACES)
        if not body:
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append("" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))

    def inserted(best):
        best = dict(best)
        for _ in range(5):
            for state, (cost, edits, left) in list(best.items()):
                put(best, after(state)[0], (cost + 3, edits + "I", (*left, (after(state), ""))))
        return best

    def put(best, state, way):
        if state not in best or way[:2] < best[state][:2]:
            best[state] = way

    best = {"": (0, "", ())}
    for (_, role, text), fault in zip(rows, faults):
        now = {}
        for state, (cost, edits, left) in inserted(best).items():
            put(now, state, (cost + 4, edits + "D", left))
            if fault in ("blank", "duplicate"):
                continue
            late = 3 * (fault == "truncated")
            if role[:1] in {"": ("s", "u"), "u": ("a",)}.get(state, ("u",)):
                put(now, role[:1], (cost + late, edits + "K", (*left, (role, text))))
            name = after(state)
            put(now, name[0], (cost + late + 3, edits + "R", (*left, (name, text))))
        best = now
    best = inserted(best)
    cost, edits, left = min((best[s] for s in ("", "a") if s in best), key=lambda w: w[:2])
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{name: faults.count(name) for name in ("blank", "duplicate", "truncated")},
        "illegal": sum(p not in ("su", "ua", "au") for p in pairs),
        "cost": cost, "audit": edits,
        "repaired_sha256": hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest(),
    }, left


def brute(rows):
    of = defaultdict(list)
    for conv, *row in damage(rows):
        of[conv].append(row)
    return {conv: search(of[conv])[0] for conv in {r[0] for r in rows}}


def random_rows(seed, conversations, most):
    r = random.Random(seed)
    texts = ["Yes.", "no", "", " \t", "Why?", "Go on!\n", "a.b", None, "ok. "]
    roles = ["user", "assistant", "system", "assistant", "user", "tool", "", None, "User"]
    rows = []
    for conv in [None, *range(conversations)]:
        for _ in range(r.randint(1, most)):
            turn = r.choice([None, r.randint(-2, most), r.randint(0, most)])
            text = r.choice(texts) if r.random() < 0.4 else f"t{r.randint(0, 10**6)}{r.choice('.!? ,')}"
            rows.append((conv, turn, r.choice(roles), text))
    return rows + rows[:5]


def table(spark, rows, parts=3):
    more = [(*row, "x", 1, "y") for row in rows]
    return spark.createDataFrame(more, SCHEMA).repartition(parts)


def results(df):
    return {r.conv_id: {k: v for k, v in r.asDict().items() if k != "conv_id"} for r in df.collect()}


def test_random_conversations(spark):
    rows = random_rows(1, 120, 12)
    assert results(C.judge_damaged(table(spark, rows))) == brute(rows)


def test_one_conversation_over_many_tasks(spark, monkeypatch):
    """Pieces of a few rows, so all levels above them are at work."""
    monkeypatch.setattr(C, "PIECE", 7)
    r = random.Random(3)
    hot = [
        (5, i // 2, r.choice(["user", "assistant", "system"]), f"m{r.randint(0, 300)}{r.choice('.,')}")
        for i in range(600)
    ]
    rows = hot + random_rows(2, 20, 9) + [(5, None, "user", "same.")] * 200
    assert results(C.judge_damaged(table(spark, rows))) == brute(rows)


def test_repaired_turns(spark, monkeypatch):
    monkeypatch.setattr(C, "PIECE", 4)
    rows = random_rows(4, 15, 14)
    got = defaultdict(list)
    for r in C.repair(table(spark, rows)).collect():
        got[r.conv_id].append((r.block, r.no, r.place, r.role, r.text))
    of = defaultdict(list)
    for conv, turn, role, text in rows:
        of[conv].append((turn, " " if role is None else role, " " if text is None else text))
    for conv, mine in of.items():
        assert [x[3:] for x in sorted(got[conv])] == list(search(mine)[1])


def test_meeting_point_does_not_matter():
    """Vectors that meet anywhere give the edits of a search over whole prefixes."""
    r = np.random.default_rng(9)
    for n in (1, 2, 3, 8, 33):
        kinds = r.integers(0, 9, n)
        cost, rank = C._COST[kinds], C._RANK[kinds]
        lo, hi = np.array([0]), np.array([n])
        leave = C.last_states(cost, rank, lo, hi)
        before, after_ = C.crossings(cost, rank, lo, hi, np.array([0]), leave)
        best = {0: (0, "")}
        for i in range(n):
            now = {}
            for s, (c, e) in best.items():
                for t in range(4):
                    way = (c + int(cost[i, s, t]), e + C._EDITS[rank[i, s, t]])
                    if cost[i, s, t] < C._FAR:
                        now[t] = min(now.get(t, way), way)
            best = now
        want = min((c + int(C._CLOSE[s]), e + "I" * C._CLOSING[s]) for s, (c, e) in best.items())
        edits = "".join(C._EDITS[k] for k in C._RANK[kinds, before, after_])
        assert edits + "I" * C._CLOSING[int(leave[0])] == want[1]


def test_a_very_long_text_and_a_conversation_that_is_dropped(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    kept = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 > 5)
    rows = [(gone, 0, "user", "lost."), (kept, 0, "user", "x" * 2_000_000 + ".")]
    got = results(C.judge_damaged(table(spark, rows)))
    assert got == brute(rows)
    assert got[gone]["audit"] == "" and got[gone]["repaired_sha256"] == hashlib.sha256(b"").hexdigest()
    assert got[kept]["audit"] == "KI" and got[kept]["cost"] == 3


@pytest.mark.parametrize("f", [C.judge_damaged, C.judge, C.repair])
def test_empty_table(spark, f):
    assert f(table(spark, [])).collect() == []
