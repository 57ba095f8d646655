"""Conversation repair: the cheapest edits that make roles alternate, by Hirschberg's way.

What has been read of a conversation is one of four states: nothing, a system turn, a
user turn, an assistant turn. The cheapest edits from one end are a vector of four costs.
A vector from the front and one from the back meet in the middle of the rows; the state
in which they meet best ends the first half and begins the second, and both halves are
cut again. Only vectors are held, not a table of all rows and states.

Rows are sorted by ranges of (conversation, turn), so a conversation can go over several
tasks. Nearly all lie inside one task and are done there. The others are cut into pieces;
a piece is summed up by its four vectors, the same meeting of vectors over pieces fixes
the states between them, and each piece is then done on its own.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveframe.sources.scratch import settle

PIECE = 4096  # rows of a conversation that are solved together
SPACES = " \t\n\x0b\x0c\r"
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
ROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3  # costs
# Initials of roles, and the pairs of them that may follow each other.
INITIALS = ("s", "u", "a")
LEGAL = ((0, 1), (1, 2), (2, 1))
OTHER, FORCED = 3, 8

_FAR = 1 << 40
_KEYS = 1 << 12
_INSERTED = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_NAMES = {USER: "user", ASSISTANT: "assistant"}
# Empty turns that close a conversation.
_CLOSING = {NOTHING: 0, SYSTEM: 2, USER: 1, ASSISTANT: 0}
_CLOSE = np.array([INSERT * _CLOSING[s] for s in range(4)])


def _ways(kind: int, state: int) -> Iterator[tuple[int, int, str]]:
    """All ways to read a row of a kind: the state after it, the cost, the edits."""
    initial, cut_off = kind // 2, kind % 2
    cost, edits = 0, ""
    for _ in range(4):
        yield state, cost + DELETE, edits + "D"
        if kind != FORCED:
            late = CUT_OFF * cut_off
            if initial == 0 and state == NOTHING:
                yield SYSTEM, cost + late, edits + "K"
            after = _INSERTED[state]
            if initial == (1 if after == USER else 2):
                yield after, cost + late, edits + "K"
            yield after, cost + ROLE + late, edits + "R"
        state, cost, edits = _INSERTED[state], cost + INSERT, edits + "I"


def _tables():
    """For each kind of row and two states the least cost, and the edits, by their rank."""
    best: dict[tuple[int, int, int], tuple[int, str]] = {}
    for kind in range(FORCED + 1):
        for state in range(4):
            for after, cost, edits in _ways(kind, state):
                at = kind, state, after
                best[at] = min(best.get(at, (_FAR, "")), (cost, edits))
    names = sorted({edits for _, edits in best.values()})
    cost = np.full((FORCED + 1, 4, 4), _FAR)
    rank = np.zeros((FORCED + 1, 4, 4), np.int64)
    for at, (c, edits) in best.items():
        cost[at], rank[at] = c, names.index(edits)
    return cost, rank, names


_COST, _RANK, _EDITS = _tables()


def _unit(states: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Vectors that begin in one state each: no cost there, no way elsewhere."""
    cost = np.full((len(states), 4), _FAR)
    cost[np.arange(len(states)), states] = 0
    rank = np.argsort(np.argsort(cost, axis=1, kind="stable"), axis=1)
    return cost, rank


def forward(cost, rank, lo, hi, states):
    """For ranges lo to hi of steps: least costs from a state to all, and their order.

    The order is that of the edits so far, so of equal costs those are kept whose edits
    come first. No edits of two states begin each other, since all end with the same row.
    """
    total, order = _unit(states)
    live = np.flatnonzero(hi > lo)
    step = 0
    while len(live):
        at = lo[live] + step
        way = total[live][:, :, None] + cost[at]
        key = order[live][:, :, None] * 1024 + rank[at]
        least = (np.minimum(way, _FAR) * _KEYS + key).min(axis=1)
        total[live] = least // _KEYS
        order[live] = np.argsort(np.argsort(least % _KEYS, axis=1, kind="stable"), axis=1)
        step += 1
        live = live[lo[live] + step < hi[live]]
    return total, order


def backward(cost, lo, hi, states):
    """For ranges lo to hi of steps: least costs from all states to one at the end."""
    total, _ = _unit(states)
    live = np.flatnonzero(hi > lo)
    step = 1
    while len(live):
        way = cost[hi[live] - step] + total[live][:, None, :]
        total[live] = np.minimum(way, _FAR).min(axis=2)
        step += 1
        live = live[hi[live] - step >= lo[live]]
    return total


def crossings(cost, rank, lo, hi, enter, leave) -> tuple[np.ndarray, np.ndarray]:
    """The state before and after each step of the best way through each range."""
    before, after = np.zeros(len(cost), np.int64), np.zeros(len(cost), np.int64)
    some = hi > lo
    lo, hi, enter, leave = lo[some], hi[some], enter[some], leave[some]
    while len(lo):
        one = hi - lo == 1
        before[lo[one]], after[lo[one]] = enter[one], leave[one]
        lo, hi, enter, leave = lo[~one], hi[~one], enter[~one], leave[~one]
        middle = (lo + hi) // 2
        front, order = forward(cost, rank, lo, middle, enter)
        total = front + backward(cost, middle, hi, leave)
        best = total == total.min(axis=1, keepdims=True)
        state = np.where(best, order, 4).argmin(axis=1)
        lo, hi = np.concatenate([lo, middle]), np.concatenate([middle, hi])
        enter, leave = np.concatenate([enter, state]), np.concatenate([state, leave])
    return before, after


def last_states(cost, rank, lo, hi) -> np.ndarray:
    """The state after each range that a whole conversation best ends with."""
    total, order = forward(cost, rank, lo, hi, np.zeros(len(lo), np.int64))
    total = total + _CLOSE
    best = total == total.min(axis=1, keepdims=True)
    return np.where(best, order, 4).argmin(axis=1)


def summaries(cost, rank, lo, hi) -> tuple[np.ndarray, np.ndarray]:
    """For each range and each state to begin with: the costs and order of all ends."""
    every = np.tile(np.arange(4), len(lo))
    total, order = forward(cost, rank, np.repeat(lo, 4), np.repeat(hi, 4), every)
    return total.reshape(-1, 4, 4), order.reshape(-1, 4, 4)


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role and text after the contract's damage; nulls are one space.

    A checksum of ``conv_id:turn`` modulo 20 drops a row (0), empties its text (1), takes
    its sentence marks away (2), repeats it (3) or makes its role user (4).
    """
    part = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")) % 20
    marked = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        part("role").alias("role"), part("text").alias("text"), fault.alias("fault"),
    ).filter("fault <> 0")
    text = (
        F.when(F.col("fault") == 1, "")
        .when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
    )
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return marked.withColumn("copy", F.explode(copies)).select(
        "conv_id", "turn", role.alias("role"), text.alias("text")
    )


def sorted_rows(rows: DataFrame) -> DataFrame:
    """Distinct rows with copies and kind, in order, dealt by ranges of it.

    Equal rows are counted before anything moves. What a conversation says several times
    is found by an aggregate, so no task has to see a whole conversation.
    """
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    plain = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        role.alias("role"), text.alias("text"),
    )
    end = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    counted = settle(
        plain.groupBy("conv_id", "turn", "role", "text")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("mark", F.unhex(F.sha2("text", 256)))
        .withColumn("blank", end == "")
        .withColumn("cut_off", ~end.isin("", ".", "!", "?")),
        "turns",
    )
    again = (
        counted.filter("NOT blank")
        .groupBy(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("mark").alias("_mark"))
        .agg(
            F.count(F.lit(1)).alias("_turns"), F.min("turn").alias("_first"),
            F.max(F.col("turn").isNull()).alias("_early"),
        )
        .filter("_turns > 1")
    )
    again = settle(again, "repeated-turns")
    same = (
        F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role"))
        & (F.col("mark") == F.col("_mark")) & ~F.col("blank")
    )
    first = F.when(F.col("_early"), F.col("turn").isNull()).otherwise(
        F.col("turn").eqNullSafe(F.col("_first"))
    )
    initial = F.substring("role", 1, 1)
    of_role = F.lit(OTHER)
    for i, letter in enumerate(INITIALS):
        of_role = F.when(initial == letter, i).otherwise(of_role)
    copy = F.col("_turns").isNotNull() & ~first
    kind = F.when(F.col("blank") | copy, FORCED).otherwise(
        of_role * 2 + F.col("cut_off").cast("int")
    )
    ready = settle(
        counted.join(again, same, "left").select(
            "conv_id", "turn", "role", "text", "mark", "n", "blank",
            of_role.alias("initial"), kind.cast("int").alias("kind"),
        ),
        "marked-turns",
    )
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "mark")]
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return ready.repartitionByRange(tasks, *order).sortWithinPartitions(*order).drop("mark")


_TURN = "array<struct<role:string,text:string>>"
_FIGURES = ("blank", "duplicate", "truncated", "illegal", "turns", "cost")
_SOLVED = (
    "conv_id long, block int, no int, whole boolean, "
    + ", ".join(f"{name} long" for name in _FIGURES)
    + ", low long, high long, opens int, closes int, audit string, sha string, "
    f"repaired {_TURN}, kinds binary, copies binary, roles array<string>, texts array<string>, "
    "costs array<long>, ranks array<long>"
)
_REPAIRED = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
_KINDS = pa.schema(
    [
        ("conv_id", pa.int64()), ("block", pa.int32()), ("no", pa.int32()), ("whole", pa.bool_()),
        *((name, pa.int64()) for name in _FIGURES),
        ("low", pa.int64()), ("high", pa.int64()), ("opens", pa.int32()), ("closes", pa.int32()),
        ("audit", pa.string()), ("sha", pa.string()), ("repaired", _REPAIRED),
        ("kinds", pa.binary()), ("copies", pa.binary()),
        ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
        ("costs", pa.list_(pa.int64())), ("ranks", pa.list_(pa.int64())),
    ]
)


def _inserted(state: int, n: int) -> tuple[list[tuple[str, str]], int]:
    out = []
    for _ in range(n):
        state = _INSERTED[state]
        out.append((_NAMES[state], ""))
    return out, state


def _written(kinds, copies, roles, texts, before, after) -> tuple[str, list[tuple[str, str]], int]:
    """The edits of solved rows as one string, the turns they leave, and the cost."""
    audit, turns, cost = [], [], 0
    ranks = _RANK[kinds, before, after].tolist()
    total = int(_COST[kinds, before, after].sum() + DELETE * (copies - 1).sum())
    for i, (edits, state, n) in enumerate(zip(ranks, before.tolist(), copies.tolist())):
        edits = _EDITS[edits]
        audit.append(edits)
        if n > 1:
            audit.append("D" * (n - 1))
        if len(edits) > 1:
            new, state = _inserted(state, len(edits) - 1)
            turns += new
        if edits[-1] == "K":
            turns.append((roles[i], texts[i]))
        elif edits[-1] == "R":
            turns.append((_NAMES[_INSERTED[state]], texts[i]))
    return "".join(audit), turns, total + cost


def _line(turn: tuple[str, str]) -> bytes:
    return f"{turn[0]}:{turn[1]}".encode()


class _Rows:
    """Some rows of a task as arrays."""

    def __init__(self, table: pa.Table) -> None:
        self.table = table
        column = lambda name, none=0: np.asarray(table.column(name).fill_null(none))
        self.conv, self.turn = column("conv_id"), column("turn")
        self.no_conv = np.asarray(table.column("conv_id").is_null())
        self.no_turn = np.asarray(table.column("turn").is_null())
        self.kind, self.initial = column("kind").astype(np.int64), column("initial").astype(np.int64)
        self.n, self.blank = column("n"), column("blank", False)

    def starts(self) -> np.ndarray:
        new = np.ones(len(self.conv), bool)
        new[1:] = (self.conv[1:] != self.conv[:-1]) | (self.no_conv[1:] != self.no_conv[:-1])
        return np.flatnonzero(new)


def _figures(r: _Rows, lo: np.ndarray, hi: np.ndarray) -> dict[str, list]:
    """Counts over ranges of rows, and what stands at their ends."""
    first = np.zeros(len(r.conv), bool)
    first[lo] = True
    forced = r.kind == FORCED
    legal = np.zeros(len(r.conv), bool)
    for a, b in LEGAL:
        legal[1:] |= (r.initial[:-1] == a) & (r.initial[1:] == b)
    same = np.zeros(len(r.conv), bool)
    same[1:] = (r.turn[1:] == r.turn[:-1]) & ~r.no_turn[:-1] & ~first[1:]
    each = {
        "blank": np.where(r.blank, r.n, 0),
        "duplicate": np.where(r.blank, 0, r.n - 1 + forced),
        "truncated": (~forced & (r.kind % 2 == 1)).astype(np.int64),
        "illegal": r.n - 1 + (~legal & ~first),
        "turns": (~r.no_turn & ~same).astype(np.int64),
    }
    out: dict[str, list] = {}
    for name, values in each.items():
        sums = np.zeros(len(values) + 1, np.int64)
        np.cumsum(values, out=sums[1:])
        out[name] = (sums[hi] - sums[lo]).tolist()
    # Rows without a turn come first.
    none = np.zeros(len(r.conv) + 1, np.int64)
    np.cumsum(r.no_turn, out=none[1:])
    at = lo + none[hi] - none[lo]
    known = (at < hi).tolist()
    at = np.minimum(at, len(r.turn) - 1)
    out["low"] = [x if k else None for x, k in zip(r.turn[at].tolist(), known)]
    out["high"] = [x if k else None for x, k in zip(r.turn[hi - 1].tolist(), known)]
    out["opens"], out["closes"] = r.initial[lo].tolist(), r.initial[hi - 1].tolist()
    return out


def _emit(rows: dict[str, list]) -> pa.RecordBatch:
    n = len(rows["conv_id"])
    return pa.RecordBatch.from_arrays(
        [pa.array(rows.get(f.name, [None] * n), f.type) for f in _KINDS], schema=_KINDS
    )


def _named(r: _Rows, at: np.ndarray) -> list:
    return [None if none else x for none, x in zip(r.no_conv[at].tolist(), r.conv[at].tolist())]


def _done(r: _Rows, lo: np.ndarray, hi: np.ndarray, keep: bool) -> pa.RecordBatch:
    """Whole conversations, solved."""
    cost, rank = _COST[r.kind], _RANK[r.kind]
    leave = last_states(cost, rank, lo, hi)
    before, after = crossings(cost, rank, lo, hi, np.zeros(len(lo), np.int64), leave)
    roles = r.table.column("role").to_pylist()
    texts = r.table.column("text").to_pylist()
    out = {"conv_id": _named(r, lo), **_figures(r, lo, hi)}
    out |= {name: [] for name in ("cost", "audit", "sha", "repaired")}
    for a, b, state in zip(lo.tolist(), hi.tolist(), leave.tolist()):
        audit, turns, total = _written(
            r.kind[a:b], r.n[a:b], roles[a:b], texts[a:b], before[a:b], after[a:b]
        )
        more = _CLOSING[state]
        turns += _inserted(state, more)[0]
        out["cost"].append(total + INSERT * more)
        out["audit"].append(audit + "I" * more)
        out["sha"].append(hashlib.sha256(b"\n".join(map(_line, turns))).hexdigest())
        out["repaired"].append([dict(role=x, text=y) for x, y in turns] if keep else None)
    n = len(lo)
    return _emit(out | {"whole": [True] * n, "block": [0] * n, "no": [0] * n})


def _piece(r: _Rows, a: int, b: int, block: int, no: int) -> pa.RecordBatch:
    """Rows a to b of a conversation that may go on elsewhere, summed up."""
    lo, hi = np.array([a]), np.array([b])
    costs, ranks = summaries(_COST[r.kind], _RANK[r.kind], lo, hi)
    part = r.table.slice(a, b - a)
    return _emit(
        {
            "conv_id": _named(r, lo), "block": [block], "no": [no], "whole": [False],
            **_figures(r, lo, hi), "cost": [0],
            "kinds": [r.kind[a:b].astype("u1").tobytes()], "copies": [r.n[a:b].tobytes()],
            "roles": [part.column("role").to_pylist()], "texts": [part.column("text").to_pylist()],
            "costs": [costs.reshape(-1).tolist()], "ranks": [ranks.reshape(-1).tolist()],
        }
    )


def _solve_inside(rows: DataFrame, keep: bool) -> DataFrame:
    """Solved conversations of each task, and pieces of those at its ends or too long."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, no = TaskContext.get().partitionId(), 0
        held: pa.Table | None = None
        inside = False  # whether the first of the held rows begins a conversation
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if held is None else pa.concat_tables([held, table])
            r = _Rows(table.combine_chunks())
            starts = r.starts()
            last = int(starts[-1])
            if len(starts) > 1:
                lo, hi = starts[:-1], starts[1:]
                if not inside:
                    yield _piece(r, 0, int(hi[0]), block, no)
                    no += 1
                    lo, hi = lo[1:], hi[1:]
                if len(lo):
                    yield _done(r, lo, hi, keep)
                inside = True
            while r.table.num_rows - last > PIECE:
                # Too long to wait for its end.
                yield _piece(r, last, last + PIECE, block, no)
                no, last, inside = no + 1, last + PIECE, False
            held = r.table.slice(last)
        if held is not None and held.num_rows:
            yield _piece(_Rows(held.combine_chunks()), 0, held.num_rows, block, no)

    return rows.mapInArrow(work, _SOLVED)


def _matrices(items: list, name: str) -> np.ndarray:
    return np.array([x[name] for x in items], np.int64).reshape(-1, 4, 4)


def _folded(pieces: DataFrame) -> DataFrame:
    """The pieces of each conversation and block as one; a block holds as many as fit it."""
    listed = F.array_sort(F.collect_list(F.struct("no", "costs", "ranks")))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            costs, ranks = [], []
            for items in batch.column("items").to_pylist():
                c, r = _matrices(items, "costs"), _matrices(items, "ranks")
                total, order = summaries(c, r, np.array([0]), np.array([len(c)]))
                costs.append(total.reshape(-1).tolist())
                ranks.append(order.reshape(-1).tolist())
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("conv_id"), batch.column("block"),
                    pa.array(costs, kind), pa.array(ranks, kind), batch.column("items"),
                ],
                names=["conv_id", "block", "costs", "ranks", "items"],
            )

    item = "struct<no:int,costs:array<long>,ranks:array<long>>"
    grouped = pieces.groupBy("conv_id", "block").agg(listed.alias("items"))
    return grouped.mapInArrow(
        work, f"conv_id long, block int, costs array<long>, ranks array<long>, items array<{item}>"
    )


def _routed(grouped: DataFrame, number: str, whole: bool) -> DataFrame:
    """(number, enter, leave, final) of each item of each row's list.

    Rows of whole conversations begin with nothing and end as is best; others have the
    states to begin and end with.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {name: [] for name in (*fixed, number, "enter", "leave", "final")}
            for row in batch.to_pylist():
                items = row["items"]
                cost, rank = _matrices(items, "costs"), _matrices(items, "ranks")
                lo, hi = np.array([0]), np.array([len(items)])
                if whole:
                    enter, leave = np.array([NOTHING]), last_states(cost, rank, lo, hi)
                else:
                    enter, leave = np.array([row["enter"]]), np.array([row["leave"]])
                before, after = crossings(cost, rank, lo, hi, enter, leave)
                last = len(items) - 1
                for i, item in enumerate(items):
                    for name in fixed:
                        out[name].append(row[name])
                    out[number].append(item[number])
                    out["enter"].append(int(before[i]))
                    out["leave"].append(int(after[i]))
                    out["final"].append(i == last and (whole or row["final"]))
            kinds = {"conv_id": pa.int64(), "final": pa.bool_()}
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, kinds.get(k, pa.int32())) for k, v in out.items()], names=list(out)
            )

    fixed = ("conv_id",) if whole else ("block",)
    first = "conv_id long" if whole else "block int"
    return grouped.mapInArrow(work, f"{first}, {number} int, enter int, leave int, final boolean")


def _solve_across(pieces: DataFrame, keep: bool) -> DataFrame:
    """The pieces with edits, cost and the turns they leave.

    States between the blocks of a conversation are fixed first, of which there is one a
    task at most, then those between the pieces of each block.
    """
    folded = settle(_folded(pieces), "conversation-blocks")
    listed = F.array_sort(F.collect_list(F.struct("block", "costs", "ranks")))
    routes = _routed(folded.groupBy("conv_id").agg(listed.alias("items")), "block", True)
    # A null conv_id is a conversation too.
    routes = routes.select(
        F.col("conv_id").alias("_conv"), F.col("block").alias("_block"), "enter", "leave", "final"
    )
    of_block = folded.select("conv_id", "block", "items").join(
        routes,
        F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block")),
    )
    states = _routed(of_block.drop("_conv", "_block"), "no", False).select(
        F.col("block").alias("_block"), F.col("no").alias("_no"), "enter", "leave", "final"
    )
    ready = pieces.drop("costs", "ranks", "audit", "sha", "cost", "repaired").join(
        states, (F.col("block") == F.col("_block")) & (F.col("no") == F.col("_no"))
    )
    figures = [f for f in _FIGURES if f != "cost"]
    kept = ["conv_id", "block", "no", *figures, "low", "high", "opens", "closes"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            audits, turns_of, costs = [], [], []
            wanted = ["kinds", "copies", "roles", "texts", "enter", "leave", "final"]
            for row in batch.select(wanted).to_pylist():
                kinds = np.frombuffer(row["kinds"], "u1").astype(np.int64)
                copies = np.frombuffer(row["copies"], np.int64)
                cost, rank = _COST[kinds], _RANK[kinds]
                lo, hi = np.array([0]), np.array([len(kinds)])
                before, after = crossings(
                    cost, rank, lo, hi, np.array([row["enter"]]), np.array([row["leave"]])
                )
                audit, turns, total = _written(
                    kinds, copies, row["roles"], row["texts"], before, after
                )
                more = _CLOSING[row["leave"]] if row["final"] else 0
                turns += _inserted(row["leave"], more)[0]
                audits.append(audit + "I" * more)
                turns_of.append([dict(role=x, text=y) for x, y in turns])
                costs.append(total + INSERT * more)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in kept), pa.array(costs, pa.int64()),
                    pa.array(audits, pa.string()), pa.array(turns_of, _REPAIRED),
                ],
                names=[*kept, "cost", "audit", "repaired"],
            )

    schema = (
        "conv_id long, block int, no int, " + ", ".join(f"{f} long" for f in figures)
        + ", low long, high long, opens int, closes int, cost long, audit string, "
        f"repaired {_TURN}"
    )
    return ready.mapInArrow(work, schema)


_PER_CONVERSATION = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string, repaired_sha256 string"
)


def _digests(solved: DataFrame) -> DataFrame:
    """One row for each conversation that lies in several pieces.

    A SHA-256 has to be fed in order, so the pieces of a conversation come one after the
    other to one task, which holds one of them, the running digest and the edits.
    """
    names = [f for f in _FIGURES if f not in ("turns", "cost")]

    def row_of(state: dict) -> pa.RecordBatch:
        low, high = state["low"], state["high"]
        gaps = 0 if low is None else high - low + 1 - state["turns"]
        values = [
            state["conv_id"], gaps, *(state[n] for n in names), state["cost"],
            "".join(state["audit"]), state["sha"].hexdigest(),
        ]
        kinds = [pa.int64()] * 7 + [pa.string()] * 2
        columns = [c.split()[0] for c in _PER_CONVERSATION.split(", ")]
        return pa.RecordBatch.from_arrays(
            [pa.array([v], k) for v, k in zip(values, kinds)], names=columns
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict | None = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if state is None or row["conv_id"] != state["conv_id"]:
                    if state:
                        yield row_of(state)
                    state = {**row, "audit": [], "sha": hashlib.sha256(), "any": False}
                else:
                    for name in (*names, "turns", "cost"):
                        state[name] += row[name]
                    state["illegal"] += (state["closes"], row["opens"]) not in LEGAL
                    if state["high"] is not None and state["high"] == row["low"]:
                        state["turns"] -= 1
                    state["low"] = row["low"] if state["low"] is None else state["low"]
                    state["high"] = row["high"] if row["high"] is not None else state["high"]
                    state["closes"] = row["closes"]
                state["audit"].append(row["audit"])
                for turn in row["repaired"]:
                    if state["any"]:
                        state["sha"].update(b"\n")
                    state["sha"].update(_line((turn["role"], turn["text"])))
                    state["any"] = True
        if state:
            yield row_of(state)

    tasks = int(solved.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = solved.repartition(tasks, "conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), "block", "no"
    )
    return placed.mapInArrow(work, _PER_CONVERSATION)


def _gaps() -> Column:
    return F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0).cast("long"))


def _solved(rows: DataFrame, keep: bool) -> tuple[DataFrame, DataFrame]:
    """Conversations solved within a task, and solved pieces of the others."""
    both = settle(_solve_inside(sorted_rows(rows), keep), "conversations")
    pieces = both.filter("NOT whole").drop("whole")
    return both.filter("whole"), settle(_solve_across(pieces, keep), "conversation-pieces")


def judge(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    One row for each conversation of (conv_id, turn, role, text). Rows are taken by turn,
    null turns first; rows of one turn by role and then by a digest of the text. Null
    roles and texts are one space; a null conv_id is a conversation. Equal rows are
    copies, which stand next to each other. A row's first fault counts: blank, duplicate
    of an earlier row in role and text, truncated. audit has the cheapest edits in order,
    K(eep), R(ole), D(elete), I(nsert), of equally cheap ones the first in ASCII order;
    they leave nothing, or a system turn at most and then user and assistant turns in
    pairs. Other columns are not looked at. An empty table gives no rows.
    """
    whole, pieces = _solved(rows, False)
    names = [c.split()[0] for c in _PER_CONVERSATION.split(", ")]
    inside = whole.withColumn("gaps", _gaps()).withColumnRenamed("sha", "repaired_sha256")
    return inside.select(*names).unionAll(_digests(pieces))


def repair(rows: DataFrame) -> DataFrame:
    """(conv_id, block, no, place, role, text): the turns that the cheapest edits leave.

    Ordered by block, no and place within a conversation. As judge() for the rest.
    """
    whole, pieces = _solved(rows, True)
    columns = ["conv_id", "block", "no", F.posexplode("repaired").alias("place", "turn")]
    both = whole.select(*columns).unionAll(pieces.select(*columns))
    return both.select("conv_id", "block", "no", "place", "turn.role", "turn.text")


def judge_damaged(conversations: DataFrame) -> DataFrame:
    """judge() after damaged(); conversations without any row left have no edits."""
    found = judge(damaged(conversations))
    ids = conversations.select(F.col("conv_id").cast("long").alias("_conv")).distinct()
    joined = ids.join(found, F.col("_conv").eqNullSafe(F.col("conv_id")), "left")
    empty = hashlib.sha256(b"").hexdigest()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return joined.select(
        F.col("_conv").alias("conv_id"),
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"),
    )
