"""Repair of conversations by rank-convergence parallel Viterbi.

A repaired conversation is an optional system turn and then pairs of user and assistant turns, or
nothing. Rows are kept, given another role, deleted, or preceded by inserted empty turns; the
cheapest edits win, the ASCII-least string of their initials among equals.

Costs run backwards over four states (nothing yet, after system, after user, after assistant):
the vector at a row holds the least cost of the rest from each state. Rows of all conversations
stand in one distributed order and are cut into chunks of equal size, so a conversation of any
length is many groups. Where a conversation goes on in the next chunk, a chunk starts from a
speculative vector. Fix-up passes then hand each chunk the vector its successor found and run
it again until old and new vectors differ only by a constant, which happens after a few rows
since each row narrows what can differ; no pass is left once all boundaries agree.

Stitched like this, every chunk knows its costs up to a constant, which is all that tracing
needs. A chunk traces the least edits from each of the four states, so it is a map of four
states; the maps of a conversation in order give the state each chunk begins in, and one more
pass traces all chunks at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from velomart.llm.common import with_row_key
from velomart.workspace import materialize

#: Rows of a chunk, as a power of two: the bound of a group.
CHUNK_BITS = 10
WHITE = " \t\n\x0b\f\r"
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
REROLE, DELETE, INSERT, UNFINISHED = 3, 4, 3, 3

# states, and kinds of rows: 1 system, 2 user, 3 assistant, 0 any other role
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_ROLES = {_SYSTEM: "system", _USER: "user", _ASSISTANT: "assistant"}
#: The state that an inserted or reroled turn leads to.
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_NEVER = 1 << 40
#: Least cost to end from each state: an assistant, a pair, or nothing is missing.
_END = (0, 2 * INSERT, INSERT, 0)

Vector = tuple[int, int, int, int]


def _kept(state: int, kind: int) -> int:
    """The state after a row of ``kind`` is kept, or 0 where it may not stand."""
    if kind == _SYSTEM:
        return _SYSTEM if state == _START else 0
    return kind if kind and _NEXT[state] == kind else 0


def _before(kind: int, fault: int, after: Vector) -> Vector:
    """The vector at a row from the vector after it."""
    own = []
    for state in range(4):
        cost = DELETE + after[state]
        if fault not in (BLANK, DUPLICATE):
            more = UNFINISHED if fault == TRUNCATED else 0
            kept = _kept(state, kind)
            if kept:
                cost = min(cost, more + after[kept])
            cost = min(cost, more + REROLE + after[_NEXT[state]])
        own.append(cost)
    # inserted turns before the row: no state is worth more than three of them away
    for _ in range(3):
        own = [min(cost, INSERT + own[_NEXT[state]]) for state, cost in enumerate(own)]
    return tuple(own)


def _level(vector: Vector) -> Vector:
    """Vectors that differ by a constant are level to the same."""
    least = min(vector)
    return tuple(v - least for v in vector)


def _vectors(rows: list[tuple[int, int]], after: Vector) -> list[Vector]:
    """The vectors before each (kind, fault) row and after the last."""
    out = [after]
    for kind, fault in reversed(rows):
        out.append(_before(kind, fault, out[-1]))
    return out[::-1]


def _again(rows: list[tuple[int, int]], old: Vector, new: Vector, found: Vector) -> Vector:
    """The level vector before ``rows`` with ``new`` after them; it was ``found`` with ``old``."""
    for kind, fault in reversed(rows):
        if _level(old) == _level(new):
            return found
        old, new = _before(kind, fault, old), _before(kind, fault, new)
    return _level(new)


class Step(NamedTuple):
    before: list[str]
    edit: str
    role: str | None
    cost: int


def _inserted(state: int, vector: Vector) -> tuple[list[str], int]:
    roles = []
    while vector[state] and vector[state] == INSERT + vector[_NEXT[state]]:
        state = _NEXT[state]
        roles.append(_ROLES[state])
    return roles, state


def trace(rows: list[tuple[int, int]], vectors: list[Vector], state: int) -> tuple[list[Step], int]:
    """The ASCII-least cheapest edits from ``state``, and the state they lead to.

    D, I, K and R stand in this order, and each leads to one state, so taking the first that is
    cheapest at every step gives the least string.
    """
    steps = []
    for (kind, fault), here, after in zip(rows, vectors, vectors[1:], strict=False):
        inserted: list[str] = []
        more = UNFINISHED if fault == TRUNCATED else 0
        while True:
            if here[state] == DELETE + after[state]:
                steps.append(Step(inserted, "D", None, DELETE + INSERT * len(inserted)))
                break
            if here[state] == INSERT + here[_NEXT[state]]:
                state = _NEXT[state]
                inserted.append(_ROLES[state])
                continue
            kept = _kept(state, kind)
            if kept and here[state] == more + after[kept]:
                state = kept
                steps.append(Step(inserted, "K", None, more + INSERT * len(inserted)))
            else:
                state = _NEXT[state]
                steps.append(Step(inserted, "R", _ROLES[state], more + REROLE + INSERT * len(inserted)))
            break
    return steps, state


def _segments(chunk: pa.Table) -> Iterator[tuple[str, int, list[int], list[tuple[int, int]]]]:
    """(key, chunk, row numbers, rows) of each conversation in one chunk, in order."""
    found = sorted(
        zip(*(chunk[c].to_pylist() for c in ("n", "key", "kind", "fault")), strict=True)
    )
    if not found:
        return
    number = found[0][0] >> CHUNK_BITS
    lo = 0
    for hi in range(1, len(found) + 1):
        if hi == len(found) or found[hi][1] != found[lo][1]:
            rows = found[lo:hi]
            yield rows[0][1], number, [r[0] for r in rows], [(r[2], r[3]) for r in rows]
            lo = hi


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


_SEGMENT = "key string, chunk long, vector array<long>, first int, last int, illegal long"
_PLACE = [("key", pa.string()), ("chunk", pa.int64())]
_SEGMENT_ARROW = pa.schema(
    [
        *_PLACE,
        ("vector", pa.list_(pa.int64())),
        ("first", pa.int32()),
        ("last", pa.int32()),
        ("illegal", pa.int64()),
    ]
)
_PAIRS = {(_SYSTEM, _USER), (_USER, _ASSISTANT), (_ASSISTANT, _USER)}


def _first_pass(chunk: pa.Table) -> pa.Table:
    """Every stretch of a conversation in a chunk, with the vector before it from a guess."""
    out = []
    for key, number, _, rows in _segments(chunk):
        kinds = [kind for kind, _ in rows]
        illegal = sum(pair not in _PAIRS for pair in zip(kinds, kinds[1:], strict=False))
        out.append((key, number, _level(_vectors(rows, _END)[0]), kinds[0], kinds[-1], illegal))
    return _table(out, _SEGMENT_ARROW)


def _fix_up(rows: pa.Table, boundary: pa.Table) -> pa.Table:
    """The stretches of one chunk that were handed another vector, run again."""
    handed = {b["key"]: b for b in boundary.to_pylist()}
    out = []
    for key, number, _, content in _segments(rows):
        b = handed.get(key)
        if b is not None:
            vector = _again(content, tuple(b["used"]), tuple(b["needed"]), tuple(b["vector"]))
            out.append((key, number, b["needed"], vector))
    return _table(out, pa.schema([*_PLACE, ("used", pa.list_(pa.int64())), ("vector", pa.list_(pa.int64()))]))


def _maps(rows: pa.Table, boundary: pa.Table) -> pa.Table:
    """For the stretches of one chunk: the state each of the four states leads to."""
    handed = {b["key"]: tuple(b["used"]) for b in boundary.to_pylist()}
    out = []
    for key, number, _, content in _segments(rows):
        if key in handed:
            vectors = _vectors(content, handed[key])
            out.append((key, number, [trace(content, vectors, state)[1] for state in range(4)]))
    return _table(out, pa.schema([*_PLACE, ("to", pa.list_(pa.int32()))]))


def _begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, chunk, to) in order to (key, chunk, state): the state every stretch begins in."""
    current, state = None, _START
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if row["key"] != current:
                current, state = row["key"], _START
            out.append((current, row["chunk"], state))
            state = row["to"][state]
        yield from _table(
            out, pa.schema([("of_key", pa.string()), ("of_chunk", pa.int64()), ("state", pa.int32())])
        ).to_batches()


_EDIT = "key string, n long, before array<string>, edit string, role string, after array<string>, cost long"
_EDIT_ARROW = pa.schema(
    [
        ("key", pa.string()),
        ("n", pa.int64()),
        ("before", pa.list_(pa.string())),
        ("edit", pa.string()),
        ("role", pa.string()),
        ("after", pa.list_(pa.string())),
        ("cost", pa.int64()),
    ]
)


def _edit(rows: pa.Table, boundary: pa.Table) -> pa.Table:
    """The edits of every row of one chunk; stretches without a boundary are whole."""
    handed = {b["key"]: b for b in boundary.to_pylist()}
    out = []
    for key, _, numbers, content in _segments(rows):
        b = handed.get(key)
        after = tuple(b["used"]) if b else _END
        steps, state = trace(content, _vectors(content, after), b["state"] if b else _START)
        ending = _inserted(state, _END)[0] if b is None or b["final"] else []
        for i, (n, step) in enumerate(zip(numbers, steps, strict=True)):
            last = ending if i == len(steps) - 1 else []
            out.append((key, n, step.before, step.edit, step.role, last, step.cost + INSERT * len(last)))
    return _table(out, _EDIT_ARROW)


def _in_order(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """All rows in one stored order, numbered: ``n`` ascends by conversation, turn, role, text.

    The last key is the place in the file, so that equal rows can part between two ranges.
    """
    rows = rows.select(
        F.col(f"`{conv_col}`").alias("conv"),
        F.col(f"`{turn_col}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(" ")).alias("text"),
    )
    keyed = with_row_key(rows, "file", "row").withColumns(
        {
            "key": F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit("null")),
            "h1": F.xxhash64("text"),
            "h2": F.xxhash64(F.lit(1), "text"),
        }
    )
    order = [F.col("key"), F.col("turn").asc_nulls_first(), *map(F.col, ("role", "h1", "h2", "file", "row"))]
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    return materialize(ordered.drop("file", "row").withColumn("n", F.monotonically_increasing_id()), "ordered_turns")


def _marked(ordered: DataFrame) -> DataFrame:
    """(key, n, chunk, kind, fault): what the costs need of every row."""
    trimmed = F.rtrim("text", F.lit(WHITE))
    initial = F.left("role", F.lit(1))
    kind = F.when(initial == "s", _SYSTEM).when(initial == "u", _USER).when(initial == "a", _ASSISTANT).otherwise(0)
    slim = ordered.select(
        "key",
        "n",
        "role",
        "h1",
        "h2",
        kind.alias("kind"),
        (trimmed == "").alias("blank"),
        F.right(trimmed, F.lit(1)).isin(".", "!", "?").alias("finished"),
    )
    same = ["key", "role", "h1", "h2"]
    # stored, so that a text in very many rows of one conversation is a key that can be split
    first = materialize(
        slim.groupBy(*same).agg(F.min("n").alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1"),
        "first_turns",
    ).drop("copies")
    fault = (
        F.when(F.col("blank"), BLANK)
        .when(F.col("n") != F.col("first"), DUPLICATE)
        .when(~F.col("finished"), TRUNCATED)
        .otherwise(0)
    )
    chunk = F.shiftright("n", CHUNK_BITS)
    return materialize(
        slim.join(first, same, "left").select("key", "n", chunk.alias("chunk"), "kind", fault.alias("fault")),
        "marked_turns",
    )


def _per_chunk(rows: DataFrame, boundaries: DataFrame, run, schema: str) -> DataFrame:
    boundaries = boundaries.withColumnRenamed("chunk", "of_chunk")
    return rows.groupBy("chunk").cogroup(boundaries.groupBy("of_chunk")).applyInArrow(run, schema)


def _array(vector: Vector) -> Column:
    return F.array(*[F.lit(v).cast("long") for v in vector])


def _stitched(marked: DataFrame, segments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows and boundaries of conversations in several chunks, once all boundaries agree.

    A boundary has ``used``: the vector after a stretch, which is level and final.
    """
    of = Window.partitionBy("key")
    several = segments.withColumn("parts", F.count(F.lit(1)).over(of)).where("parts > 1")
    state = materialize(several.select("key", "chunk", "vector", _array(_END).alias("used")), "boundaries")
    rows = materialize(marked.join(state.select("key", "chunk"), ["key", "chunk"], "left_semi"), "long_turns")
    while True:
        following = F.lead("vector").over(of.orderBy("chunk"))
        needed = state.withColumn("final", following.isNull()).withColumn(
            "needed", F.coalesce(following, _array(_END))
        )
        needed = materialize(needed, "needed")
        open_ = needed.where("needed <> used")
        if open_.isEmpty():
            return rows, needed.select("key", "chunk", "used", "final")
        schema = "key string, chunk long, used array<long>, vector array<long>"
        again = rows.join(open_.select("chunk").distinct(), "chunk", "left_semi")
        fixed = _per_chunk(again, open_, _fix_up, schema)
        done = needed.where("needed = used").select("key", "chunk", "used", "vector")
        state = materialize(done.unionByName(fixed), "boundaries")


def _edits(marked: DataFrame, segments: DataFrame) -> DataFrame:
    rows, boundaries = _stitched(marked, segments)
    maps = _per_chunk(rows, boundaries, _maps, "key string, chunk long, to array<int>")
    begin = (
        maps.repartition("key")
        .sortWithinPartitions("key", "chunk")
        .mapInArrow(_begin, "of_key string, of_chunk long, state int")
    )
    same = (F.col("key") == F.col("of_key")) & (F.col("chunk") == F.col("of_chunk"))
    known = materialize(boundaries.join(begin, same).drop("of_key", "of_chunk"), "stitched")
    return materialize(_per_chunk(marked, known, _edit, _EDIT), "edits")


class Repair(NamedTuple):
    #: conv, n, j, role, text, edit (I, K or R): the repaired rows, in the order of (n, j)
    rows: DataFrame
    #: conv, gaps, blank, duplicate, truncated, illegal, cost, audit of every conversation
    audit: DataFrame


def repair(
    rows: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> Repair:
    """Faults, cheapest edits and repaired rows of all conversations.

    Rows stand by turn, null turns first, ties by role and then by a hash of the text, so equal
    rows are neighbours. A null role or text is one space; rows with a null conversation are one
    conversation. A row's first fault counts: blank, duplicate (role and text seen earlier in the
    conversation), truncated. Blank and duplicate rows must go. An empty table gives no rows; other
    columns are not read.
    """
    ordered = _in_order(rows, conv_col, turn_col, role_col, text_col)
    marked = _marked(ordered)
    segments = materialize(marked.groupBy("chunk").applyInArrow(_first_pass, _SEGMENT), "segments")
    edits = _edits(marked, segments)

    turn = F.col("turn").cast("decimal(20,0)")
    spread = F.max(turn) - F.min(turn) + 1 - F.count_distinct("turn")
    turns = ordered.groupBy("key").agg(
        F.first("conv").alias("conv"),
        F.least(F.coalesce(spread, F.lit(0)), F.lit((1 << 63) - 1)).cast("long").alias("gaps"),
    )
    following = F.lead("first").over(Window.partitionBy("key").orderBy("chunk"))
    pair = F.concat(F.col("last").cast("string"), following.cast("string"))
    legal = [f"{a}{b}" for a, b in sorted(_PAIRS)]
    across = F.when(pair.isNotNull() & ~pair.isin(*legal), 1).otherwise(0)
    illegal = (
        segments.withColumn("illegal", F.col("illegal") + across)
        .groupBy("key")
        .agg(F.sum("illegal").alias("illegal"))
    )
    number = lambda fault: F.count_if(F.col("fault") == fault)
    faults = marked.groupBy("key").agg(
        number(BLANK).alias("blank"), number(DUPLICATE).alias("duplicate"), number(TRUNCATED).alias("truncated")
    )
    letters = F.concat(
        F.repeat(F.lit("I"), F.size("before")), F.col("edit"), F.repeat(F.lit("I"), F.size("after"))
    )
    parts = edits.groupBy("key", F.shiftright("n", CHUNK_BITS).alias("chunk")).agg(
        F.sum("cost").alias("cost"), F.array_sort(F.collect_list(F.struct("n", letters.alias("x")))).alias("x")
    )
    parts = parts.select("key", "chunk", "cost", F.array_join("x.x", "").alias("x"))
    costs = parts.groupBy("key").agg(
        F.sum("cost").alias("cost"), F.array_sort(F.collect_list(F.struct("chunk", "x"))).alias("x")
    )
    costs = costs.select("key", "cost", F.array_join("x.x", "").alias("audit"))
    audit = turns.join(faults, "key").join(illegal, "key").join(costs, "key").drop("key")

    empty = lambda role: F.struct(role.alias("role"), F.lit("").alias("text"), F.lit("I").alias("edit"))
    own = F.array(F.struct(F.coalesce("role", "old_role").alias("role"), "text", "edit"))
    turn_list = F.concat(
        F.transform("before", empty), F.filter(own, lambda t: t["edit"] != "D"), F.transform("after", empty)
    )
    repaired = (
        ordered.select("n", "conv", F.col("role").alias("old_role"), "text")
        .join(edits.drop("key", "cost"), "n")
        .select("conv", "n", F.posexplode(turn_list).alias("j", "t"))
        .select("conv", "n", "j", "t.role", "t.text", "t.edit")
    )
    return Repair(repaired, audit)
