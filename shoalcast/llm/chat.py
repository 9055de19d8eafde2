"""Repair and rendering of conversations whose turns break the order of roles.

A legal conversation has at most one system turn, first, and then user and assistant in turn, user first.
Dynamic programming over that automaton picks, for each conversation, the cheapest choice for every turn:
keep it, merge it into the message before, relabel it, or put an empty turn before it.  Conversations are cut
into blocks of ``BLOCK`` turn numbers; a block's cost from any state to any other is a small matrix.  Up to ``FAN``
neighbouring matrices chain to one, level by level, until a conversation has few; the cheapest way through these is
found, and then, level by level back, through the ones they came from.  Each block then repairs itself between known
states, so one conversation of any length spreads over tasks at every step.  Blocks travel in bundles of bounded
rows and bytes, whole by construction: a grouped map, unlike a sort in partitions, can't be split between tasks.

Turns go by number, then by a hash of role and text; turns without a number come last; rows that repeat a turn
in full count once.  Rows without a conv_id form one conversation.  Null texts are empty and cost little to merge;
a null or unknown role may take any role cheaply.  Long texts stay whole.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial, reduce
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoalcast.session import cut_lineage, drop_written

BLOCK = 256
FAN = 256
BUNDLE_ROWS, BUNDLE_BYTES = 8192, 16 << 20
ROLES = ("start", "system", "user", "assistant")
ALIASES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant", "chatbot": "assistant"}
LEGAL = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
FINAL = (2, 3)
# Binary fractions, so that sums do not depend on the order of adding.
MERGE, RELABEL, RELABEL_UNKNOWN, INSERT, MERGE_EMPTY = 0.5, 1.0, 0.25, 1.5, 0.09375
FAR = float("inf")
NO_ID = -(1 << 63)
OPENING, CLOSING = "<|im_start|>{role}\n", "<|im_end|>\n"


def choices(state: int, role: int, empty: bool) -> list[tuple[float, int, str, int]]:
    """(cost, next state, action, inserted role) of everything that may be done with a turn."""
    relabel = RELABEL_UNKNOWN if role == 0 else RELABEL
    out = []
    for after in LEGAL[state]:
        out.append((0.0, after, "keep", 0) if after == role else (relabel, after, "relabel", 0))
        if role in LEGAL[after]:
            out.append((INSERT, role, "insert", after))
    if state:
        merge = MERGE_EMPTY if empty else MERGE
        out.append((merge if role == state else merge + relabel, state, "merge", 0))
    return out


def step_matrix(role: int, empty: bool) -> list[list[float]]:
    matrix = [[FAR] * 4 for _ in range(4)]
    for state in range(4):
        for cost, after, _, _ in choices(state, role, empty):
            matrix[state][after] = min(matrix[state][after], cost)
    return matrix


STEPS = {(role, empty): step_matrix(role, empty) for role in range(4) for empty in (False, True)}


def chained(one: list[list[float]], two: list[list[float]]) -> list[list[float]]:
    return [[min(one[s][m] + two[m][t] for m in range(4)) for t in range(4)] for s in range(4)]


NODE = [("c", pa.int64()), ("blk", pa.int64()), ("sub", pa.int64())]
MATRIX = [*NODE, ("matrix", pa.list_(pa.float64()))]
BOUNDS = [*NODE, ("enter", pa.int32()), ("leave", pa.int32()), ("is_last", pa.bool_())]
SQL_TYPES = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string", pa.bool_(): "boolean", pa.list_(pa.float64()): "array<double>"}


def node_of(row: dict) -> tuple:
    return row["c"], row["blk"], row["sub"]


def table_of(rows: list[tuple], kinds: list[tuple[str, pa.DataType]]) -> pa.Table:
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.Table.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, kinds)], names=[n for n, _ in kinds])


def bundled(df: DataFrame, whole: list[str], n: int, run: Callable[[list[dict]], Iterator[tuple]], kinds: list[tuple[str, pa.DataType]]) -> DataFrame:
    """``run`` over rows in ``n`` bundles; rows with equal ``whole`` columns share one."""
    schema = ", ".join(f"{name} {SQL_TYPES[kind]}" for name, kind in kinds)
    dealt = df.withColumn("bundle", F.pmod(F.xxhash64(*whole), F.lit(n)))
    return dealt.groupBy("bundle").applyInArrow(lambda group: table_of(list(run(group.to_pylist())), kinds), schema)


def in_turn(row: dict) -> tuple:
    # Turns alike up to here cost the same, so the matrices do not need the texts.
    alike = row["t"], row["h"], row["role_number"], row["is_empty"]
    return *node_of(row), *alike, row["role"] is not None, row["role"] or "", row["text"] is not None, row["text"] or ""


def matrices(rows: list[dict]) -> Iterator[tuple]:
    """The cost of each block from state to state."""
    for key, turns in groupby(sorted(rows, key=in_turn), node_of):
        steps = [STEPS[r["role_number"], r["is_empty"]] for r in turns]
        yield *key, [x for line in reduce(chained, steps) for x in line]


def square(flat: list[float]) -> list[list[float]]:
    return [flat[i : i + 4] for i in range(0, 16, 4)]


def parent(row: dict, by: tuple[int, int]) -> tuple:
    return row["c"], row["blk"] // by[0], row["sub"] // by[1]


def divided(name: str, by: int):
    """The column divided without a fraction, rounded down, as // does."""
    return F.expr(f"({name} - pmod({name}, {by}L)) div {by}L")


def raised(by: tuple[int, int], rows: list[dict]) -> Iterator[tuple]:
    """Chained matrices of the children of each parent."""
    for key, children in groupby(sorted(rows, key=node_of), lambda r: parent(r, by)):
        yield *key, [x for line in reduce(chained, [square(r["matrix"]) for r in children]) for x in line]


ENDS = [FAR if s == 0 else 0.0 if s in FINAL else INSERT for s in range(4)]


def lowered(by: tuple[int, int] | None, rows: list[dict]) -> Iterator[tuple]:
    """The states between which each child lies on the cheapest way through its parent, or through the conversation
    if ``by`` is None: rows hold a child's matrix and its parent's enter, leave and is_last."""
    whole = (lambda r: r["c"]) if by is None else (lambda r: parent(r, by))
    for _, group in groupby(sorted(rows, key=node_of), whole):
        children = list(group)
        first = children[0]
        # Of equally cheap ways only one that ends where the next parent begins will do.
        state, ahead = (0, ENDS) if by is None else (first["enter"], [0.0 if t == first["leave"] else FAR for t in range(4)])
        after = []
        for row in reversed(children):
            after.append(ahead)
            m = square(row["matrix"])
            ahead = [min(m[s][t] + ahead[t] for t in range(4)) for s in range(4)]
        for k, (row, ahead) in enumerate(zip(children, reversed(after))):
            m = square(row["matrix"])
            leave = min(range(4), key=lambda t: (m[state][t] + ahead[t], t))
            yield *node_of(row), state, leave, k == len(children) - 1 and (by is None or first["is_last"])
            state = leave


def block_bounds(nodes: DataFrame) -> DataFrame:
    """(c, blk, sub, enter, leave, is_last) of each block of the written table ``nodes`` (c, blk, sub, matrix)."""
    levels = [(nodes, None)]
    while True:
        table = levels[-1][0]
        per = table.groupBy("c").agg(F.count(F.lit(1)).alias("n"), F.max("sub").alias("sub"))
        count, most, sub = per.agg(F.sum("n"), F.max("n"), F.max("sub")).first()
        if not count or most <= FAN:
            break
        by = (1, FAN) if sub else (FAN, 1)
        whole = table.withColumns({"ub": divided("blk", by[0]), "us": divided("sub", by[1])})
        levels.append((cut_lineage(bundled(whole, ["c", "ub", "us"], count // BUNDLE_ROWS + 1, partial(raised, by), MATRIX)), by))
    ends = bundled(levels[-1][0], ["c"], (count or 0) // BUNDLE_ROWS + 1, partial(lowered, None), BOUNDS)
    for (table, _), (_, by) in zip(reversed(levels[:-1]), reversed(levels)):
        above = cut_lineage(ends).select("c", F.col("blk").alias("ub"), F.col("sub").alias("us"), "enter", "leave", "is_last")
        children = table.withColumns({"ub": divided("blk", by[0]), "us": divided("sub", by[1])})
        n = table.count() // BUNDLE_ROWS + 1
        ends = bundled(children.join(above, ["c", "ub", "us"]), ["c", "ub", "us"], n, partial(lowered, by), BOUNDS)
    return ends


def cheapest(turns: list[tuple[int, bool]], enter: int, leave: int) -> list[tuple[int, str, int]]:
    """(state after, action, inserted role) of each turn on the cheapest way from ``enter`` to ``leave``."""
    best = [FAR] * 4
    best[enter] = 0.0
    came: list[list] = []
    for role, empty in turns:
        reached, ways = [FAR] * 4, [None] * 4
        for state in range(4):
            if best[state] < FAR:
                for cost, after, action, inserted in choices(state, role, empty):
                    if best[state] + cost < reached[after]:
                        reached[after], ways[after] = best[state] + cost, (state, action, inserted)
        best = reached
        came.append(ways)
    out, state = [], leave
    for ways in reversed(came):
        before, action, inserted = ways[state]
        out.append((state, action, inserted))
        state = before
    return out[::-1]


def repaired(rows: list[dict]) -> Iterator[tuple]:
    """Turns with the bounds of their blocks to repaired, rendered turns."""
    for _, turns in groupby(sorted(rows, key=in_turn), node_of):
        held = list(turns)
        way = cheapest([(r["role_number"], r["is_empty"]) for r in held], held[0]["enter"], held[0]["leave"])
        state = held[0]["enter"]
        for k, (row, (after, action, inserted)) in enumerate(zip(held, way)):
            text = row["text"] or ""
            if action == "merge":
                piece = f"\n{text}" if text else ""
            else:
                piece = CLOSING if state else ""
                if inserted:
                    piece += OPENING.format(role=ROLES[inserted]) + CLOSING
                piece += OPENING.format(role=ROLES[after]) + text
            if row["is_last"] and k == len(held) - 1:
                piece += CLOSING
                if after not in FINAL:
                    piece += OPENING.format(role="user") + CLOSING
            conv = None if row["c"] == NO_ID else row["c"]
            yield conv, row["turn"], row["role"], ROLES[after], action, ROLES[inserted] if inserted else None, row["blk"], row["sub"], k, piece
            state = after


REPAIRED = [("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("final_role", pa.string()), ("action", pa.string()), ("inserted", pa.string())]
REPAIRED += [("block", pa.int64()), ("part", pa.int64()), ("place", pa.int32()), ("rendered", pa.string())]


def format_chat(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row for each turn: conv_id, turn, role, final_role, action, inserted (role of the empty turn put
    before it), and rendered; the rendered pieces of a conversation in the order of (block, part, place) are
    its training text."""
    rows = conversations.select(
        F.coalesce(F.col("conv_id").cast("long"), F.lit(NO_ID)).alias("c"), F.col("turn").cast("long").alias("turn"), "role", "text"
    ).distinct()
    rows = rows.withColumn("h", F.xxhash64("role", "text")).withColumn("t", F.coalesce("turn", F.lit((1 << 63) - 1)))
    rows = rows.withColumn("span", F.expr(f"t div {block}"))
    # A span with a turn number of too many different rows is cut into its numbers, and those by the
    # hashes that order their rows.
    crowded = rows.groupBy("c", "span", "t").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
    spans = crowded.select("c", "span").distinct().withColumn("cut", F.lit(True))
    rows = rows.join(spans, ["c", "span"], "left").join(crowded.select("c", "t", "n"), ["c", "t"], "left")
    part = F.floor((F.col("h") / float(1 << 64) + 0.5) * F.ceil(F.col("n") / block)).cast("long")
    number = F.when(F.col("cut"), F.col("t")).otherwise(F.col("span") * block)
    known = {name: ROLES.index(name) for name in ROLES[1:]} | {a: ROLES.index(r) for a, r in ALIASES.items()}
    role = F.lower(F.trim("role"))
    code = F.lit(0)
    for name, value in known.items():
        code = F.when(role == name, value).otherwise(code)
    empty = F.coalesce(F.trim("text") == "", F.lit(True))
    rows = rows.select("c", number.alias("blk"), F.coalesce(part, F.lit(0)).alias("sub"), "t", "h", "turn", "role", "text", code.alias("role_number"), empty.alias("is_empty"))
    return repaired_blocks(rows)


def repaired_blocks(rows: DataFrame) -> DataFrame:
    rows = cut_lineage(rows)
    n, size = rows.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    bundles = max(n // BUNDLE_ROWS, (size or 0) // BUNDLE_BYTES) + 1
    key = ["c", "blk", "sub"]
    short = rows.withColumn("text", F.lit(None).cast("string"))
    nodes = cut_lineage(bundled(short, key, bundles, matrices, MATRIX))
    ends = cut_lineage(block_bounds(nodes))
    drop_written(nodes)
    return bundled(rows.join(ends, key), key, bundles, repaired, REPAIRED)
