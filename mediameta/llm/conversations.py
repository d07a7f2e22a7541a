"""Repair of conversations: the cheapest edits to a well-formed sequence of roles, the ASCII-least among equals.

Rows are range-sorted and numbered once, whatever the size of a conversation, and cut into segments of ``SEGMENT`` rows.
A segment is a min-plus matrix over the four states of the role pattern. Scans over segments, and over segments of
segments, carry costs from the end to each segment, and later the state in which each segment is entered. Inside a segment
the cost table gives the arcs on cheapest paths; their nodes are ranked by what they can spell in 1, 2, 4, ... letters, and
the least path is read off the doubled pointers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediameta.llm.common import written

#: Rows in a segment and segments in a segment of segments, as powers of two; rows whose nodes a task ranks at once.
SEGMENT, FAN, AT_ONCE = 12, 12, 1 << 15

# Fixed values of the contract: white space, ends of a sentence, costs.
SPACES, ENDS = " \t\n\x0b\x0c\r", "[.!?]"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
# Letters of the edits in ASCII order, and the roles which an insert or a new role can have.
LETTERS, ROLES = "DIKR", {"u": "user", "a": "assistant"}

# States of (s?(ua)+)?: nothing yet, after s, after u, after a. Nothing and after a may end.
STATES, FAR = 4, 1 << 40
# The state after an initial u, a, s or another; -1 where it cannot follow.
_NEXT = np.array([[2, -1, 1, -1], [2, -1, -1, -1], [-1, 3, -1, -1], [2, -1, -1, -1]])
# The one state, and its role, that an inserted or renamed row leads to.
_MADE, _MADE_ROLE = np.array([2, 2, 3, 2]), "uuau"
_END = np.array([0, 2 * INSERT, INSERT, 0])
# Cheapest inserts from state to state.
_INSERTS = np.array([[0, FAR, 2, 4], [FAR, 0, 2, 4], [FAR, FAR, 0, 2], [FAR, FAR, 2, 0]]) // 2 * INSERT
# A row as a byte: its initial's class, 4 if it must go, 8 if it is cut off.
_GO, _CUT = 4, 8


def _arcs() -> tuple[np.ndarray, np.ndarray]:
    """Cost and target state of each edit that uses up a row, by byte, state and letter (D, I, K, R; I uses none)."""
    cost = np.full((16, STATES, 4), FAR, np.int64)
    target = np.zeros((16, STATES, 4), np.int64)
    for byte in range(16):
        extra = TRUNCATED if byte & _CUT else 0
        for state in range(STATES):
            cost[byte, state, 0], target[byte, state, 0] = DELETE, state
            if not byte & _GO:
                cost[byte, state, 3], target[byte, state, 3] = REROLE + extra, _MADE[state]
                if _NEXT[state, byte & 3] >= 0:
                    cost[byte, state, 2], target[byte, state, 2] = KEEP + extra, _NEXT[state, byte & 3]
    return cost, target


_COST, _TARGET = _arcs()


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus products of matrices, pair by pair."""
    return np.minimum((a[..., :, :, None] + b[..., None, :, :]).min(axis=-2), FAR)


def _row_matrices() -> np.ndarray:
    out = np.full((16, STATES, STATES), FAR, np.int64)
    for byte in range(16):
        for state in range(STATES):
            for letter in (0, 2, 3):
                to = _TARGET[byte, state, letter]
                out[byte, state, to] = min(out[byte, state, to], _COST[byte, state, letter])
    return _product(np.broadcast_to(_INSERTS, out.shape), out)


_ROWS = _row_matrices()


def _segment_matrices(codes: list[np.ndarray]) -> np.ndarray:
    """One matrix per segment: neighbours are multiplied until one is left."""
    sizes = np.array([len(c) for c in codes])
    matrix = _ROWS[np.concatenate(codes)]
    owner = np.repeat(np.arange(len(codes)), sizes)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    while len(owner) > len(codes):
        left = place % 2 == 0
        paired = np.flatnonzero(~left)
        matrix[paired - 1] = _product(matrix[paired - 1], matrix[paired])
        matrix, owner, place = matrix[left], owner[left], place[left] // 2
    return matrix


def damage(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) damaged by crc32 of ``conv_id:turn`` modulo 20; nulls count as one space.

    0 drops the row, 1 empties its text, 2 takes the ends of sentences out, 3 repeats it, 4 makes its role user.
    """
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    return (
        rows.select("conv_id", "turn", shown("role").alias("role"), shown("text").alias("text"), kind.alias("kind"))
        .filter("kind <> 0")
        .withColumn("text", F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", ENDS, "")).otherwise(F.col("text")))
        .withColumn("role", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")))
        .withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
        .select("conv_id", "turn", "role", "text")
    )


def _key(conv_id: Column) -> Column:
    """A conversation's name without a null."""
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def number_rows(rows: DataFrame) -> DataFrame:
    """Rows (key, turn, role, text, digest) with ``pos``: 0, 1, ... through all conversations, by turn (nulls first).

    Rows of one turn come by a digest of role and text, so equal rows are neighbours; a number given where the row was
    read spreads equal rows over the ranges too. The order is fixed by a written table.
    """
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    keyed = rows.select(_key(F.col("conv_id")).alias("key"), "turn", "role", "text", digest.alias("digest"), F.monotonically_increasing_id().alias("salt"))
    order = ["key", "turn", "digest", "salt"]
    # The explicit number keeps adaptive execution from joining ranges, so a partition's index is its place.
    partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = keyed.repartitionByRange(partitions, *order).sortWithinPartitions(*order).drop("salt")
    table = written(ranges.withColumn("mark", F.monotonically_increasing_id()), "conversations-ordered")
    # One row per partition.
    sizes = table.groupBy(F.shiftright("mark", 33).alias("part")).count().orderBy("part").collect()
    starts, at = [], 0
    for row in sizes:
        starts.append((row["part"], at))
        at += row["count"]
    offsets = F.broadcast(rows.sparkSession.createDataFrame(starts, "part long, start long"))
    placed = table.withColumn("part", F.shiftright("mark", 33)).join(offsets, "part")
    return placed.select("key", "turn", "role", "text", "digest", (F.col("start") + F.col("mark").bitwiseAND((1 << 33) - 1)).alias("pos"))


def find_faults(placed: DataFrame) -> DataFrame:
    """(key, pos, turn, initial, fault) of numbered rows; fault is blank, duplicate, truncated or empty, the first that holds."""
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    rows = placed.select("key", "pos", "turn", F.left("role", F.lit(1)).alias("initial"), (trimmed == "").alias("blank"), (~F.right(trimmed, F.lit(1)).rlike(ENDS)).alias("cut"), "digest")
    # Equal rows are counted where they are read, and what is joined back is one row number per different row.
    firsts = rows.filter("not blank").groupBy("key", "digest").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("cut"), "truncated").otherwise("")
    return rows.join(firsts, "pos", "left").select("key", "pos", "turn", "initial", fault.alias("fault"))


def _pack_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (block, pos) to one row per (key, block)."""
    names = ["key", "block", "start", "codes", "element", "illegal", "first", "last"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.int64(), pa.string(), pa.string()]
    legal = {"su", "ua", "au"}
    done: list[list] = []
    rows = 0
    open_: list | None = None

    def out() -> pa.RecordBatch:
        matrices = _segment_matrices([np.frombuffer(d[3], np.uint8) for d in done]).reshape(len(done), -1)
        columns = list(zip(*[[*d[:3], bytes(d[3]), m.tolist(), *d[4:]] for d, m in zip(done, matrices, strict=True)], strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        for key, block, pos, initial, fault in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            code = max(0, "uas?".find(initial)) if initial in ("u", "a", "s") else 3
            code |= _GO if fault in ("blank", "duplicate") else _CUT if fault == "truncated" else 0
            if open_ is None or open_[:2] != [key, block]:
                if open_ is not None:
                    done.append(open_)
                    rows += len(open_[3])
                    if rows > AT_ONCE:
                        yield out()
                        done, rows = [], 0
                open_ = [key, block, pos, bytearray(), 0, initial, initial]
            else:
                open_[4] += open_[6] + initial not in legal
                open_[6] = initial
            open_[3].append(code)
    if open_ is not None:
        done.append(open_)
        yield out()


def pack_segments(nodes: DataFrame, bits: int = SEGMENT) -> DataFrame:
    """One row per conversation and segment: its rows as bytes, its matrix, and what the pairs of initials in it are."""
    rows = nodes.select("key", F.shiftright("pos", bits).alias("block"), "pos", "initial", "fault")
    schema = "key string, block long, start long, codes binary, element array<long>, illegal long, first string, last string"
    return rows.repartition("block").sortWithinPartitions("block", "pos").mapInArrow(_pack_segments, schema)


class _Costs:
    """From the end: the context is the cost to the end by state, an element the matrix of a segment."""

    backward, first = True, _END.tolist()

    @staticmethod
    def compose(elements: list[list[int]]) -> list[int]:
        out = np.array(elements[0]).reshape(STATES, STATES)
        for e in elements[1:]:
            out = _product(out, np.array(e).reshape(STATES, STATES))
        return out.ravel().tolist()

    @staticmethod
    def step(element: list[int], context: list[int]) -> list[int]:
        return (np.array(element).reshape(STATES, STATES) + np.array(context)).min(axis=1).tolist()


class _Entries:
    """From the start: the context is the state at a segment's start, an element the state at its end by state."""

    backward, first = False, [0]

    @staticmethod
    def compose(elements: list[list[int]]) -> list[int]:
        out = list(range(STATES))
        for e in elements:
            out = [e[s] for s in out]
        return out

    @staticmethod
    def step(element: list[int], context: list[int]) -> list[int]:
        return [element[context[0]]]


def _composed(kind, most: int = 256) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []

        def out() -> pa.RecordBatch:
            row = [[group[0]], [group[1]], [kind.compose(held)]]
            kinds = [pa.string(), pa.int64(), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(row, kinds, strict=True)], ["key", "block", "element"])

        for batch in batches:
            for key, parent, element in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if group != (key, parent):
                    if group is not None:
                        yield out()
                    group, held = (key, parent), []
                held.append(element)
                if len(held) > most:
                    held = [kind.compose(held)]
        if group is not None:
            yield out()

    return run


def _scanned(kind) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, context = None, None
        for batch in batches:
            keys, parents, blocks, elements, firsts = (c.to_pylist() for c in batch.columns)
            out = []
            for key, parent, element, first in zip(keys, parents, elements, firsts, strict=True):
                if group != (key, parent):
                    group, context = (key, parent), first
                out.append(context)
                context = kind.step(element, context)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(blocks, pa.int64()), pa.array(out, pa.list_(pa.int64()))], ["key", "block", "context"])

    return run


def contexts(nodes: DataFrame, kind, levels: int, bits: int = FAN) -> DataFrame:
    """(key, block, context) of each (key, block, element): a scan of a conversation's blocks in order of ``kind``.

    Above the first of ``levels``, blocks are joined by ``2 ** bits`` first, so no task goes through more of them in a row.
    """
    rows = nodes.select("key", F.shiftright("block", bits).alias("parent"), "block", "element")
    if levels <= 1:
        rows = rows.withColumn("first", F.lit(kind.first).cast("array<long>"))
    else:
        dealt = rows.repartition("key", "parent").sortWithinPartitions("key", "parent", "block").select("key", "parent", "element")
        above = dealt.mapInArrow(_composed(kind), "key string, block long, element array<long>")
        found = contexts(written(above, "conversations-level"), kind, levels - 1, bits)
        rows = rows.join(found.select("key", F.col("block").alias("parent"), F.col("context").alias("first")), ["key", "parent"])
    order = F.desc("block") if kind.backward else F.asc("block")
    sorted_ = rows.repartition("key", "parent").sortWithinPartitions("key", "parent", order)
    return sorted_.select("key", "parent", "block", "element", "first").mapInArrow(_scanned(kind), "key string, block long, context array<long>")


def least_paths(codes: list[np.ndarray], ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
    """Per segment and state at its start: the cost to the conversation's end, the state at the segment's end, the letters.

    ``ends`` has the cost from each segment's end on, by state.
    """
    sizes = np.array([len(c) for c in codes])
    base = np.cumsum(sizes + 1) - sizes - 1
    # A segment has a place before each row and one behind the last; a node is a place and a state.
    places = int(base[-1] + sizes[-1] + 1)
    code = np.zeros(places, np.int64)
    closing = np.zeros(places, bool)
    for b, n, c in zip(base, sizes, codes, strict=True):
        code[b : b + n] = c
        closing[b + n] = True
    to_go = np.zeros((places, STATES), np.int64)
    to_go[base + sizes] = ends
    for back in range(1, int(sizes.max()) + 1):
        at = (base + sizes - back)[sizes >= back]
        byte = code[at]
        used = (_COST[byte] + np.take_along_axis(to_go[at + 1][:, None, :], _TARGET[byte], 2)).min(axis=2)
        to_go[at] = (_INSERTS + used[:, None, :]).min(axis=2)

    # Arcs on cheapest paths, by letter.
    place = np.arange(places)
    after = np.minimum(place + 1, places - 1)
    cost, target = _COST[code], after[:, None, None] * STATES + _TARGET[code]
    cost[:, :, 1], target[:, :, 1] = INSERT, place[:, None] * STATES + _MADE
    good = (cost + to_go.ravel()[target] == to_go[:, :, None]) & ~closing[:, None, None]
    good, target = good.reshape(-1, 4), target.reshape(-1, 4)
    node = np.arange(places * STATES)
    ended = np.repeat(closing, STATES)

    def choose(rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # By letter, then by the rank of where the arc leads.
        order = np.where(good, np.arange(4) * (len(node) + 1) + rank[target], np.iinfo(np.int64).max)
        letter = order.argmin(axis=1)
        return np.where(ended, 0, letter + 1), np.where(ended, node, target[node, letter])

    # Rank by one letter, then by two, four and so on: a pair of ranks is a rank of twice the length.
    rank, pointer = choose(np.zeros(len(node), np.int64))
    while not ended[pointer].all():
        rank = np.unique(rank * (rank.max() + 1) + rank[pointer], return_inverse=True)[1]
        pointer = pointer[pointer]
    # The last ranks settle what the first letter leaves open; doubled pointers then give every step of a path.
    letter, pointer = choose(rank)
    pointers, length = [pointer], (~ended).astype(np.int64)
    while not ended[pointers[-1]].all():
        length = length + length[pointers[-1]]
        pointers.append(pointers[-1][pointers[-1]])
    starts = (base[:, None] * STATES + np.arange(STATES)).ravel()
    total = length[starts]
    step = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
    here = np.repeat(starts, total)
    for k, hop in enumerate(pointers):
        here = np.where(step >> k & 1, hop[here], here)
    text = np.frombuffer(("?" + LETTERS).encode(), np.uint8)[letter[here]].tobytes().decode()
    bounds = np.concatenate(([0], np.cumsum(total)))
    words = [text[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    exits = (pointers[-1][starts] % STATES).reshape(-1, STATES)
    return to_go[base], exits, [words[i : i + STATES] for i in range(0, len(words), STATES)]


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "block", "costs", "element", "audits"]
    for batch in batches:
        keys, blocks, codes, ends = (c.to_pylist() for c in batch.columns)
        at = 0
        while at < len(keys):
            to, rows = at, 0
            while to < len(keys) and (to == at or rows + len(codes[to]) <= AT_ONCE):
                rows += len(codes[to])
                to += 1
            costs, exits, audits = least_paths([np.frombuffer(c, np.uint8) for c in codes[at:to]], np.array(ends[at:to]))
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[at:to], pa.string()), pa.array(blocks[at:to], pa.int64()), pa.array(costs.tolist(), longs),
                    pa.array(exits.tolist(), longs), pa.array(audits, pa.list_(pa.string())),
                ],
                names,
            )
            at = to


def _row_edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A segment's letters to one row per row: what is inserted before and behind it, and its own letter and new role."""
    names = ["key", "pos", "before", "edit", "renamed", "after"]
    for batch in batches:
        keys, poss, befores, edits, renamed, afters = ([] for _ in names)
        for key, start, codes, audit, state, after in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            pos, before = start, ""
            for letter in audit:
                if letter == "I":
                    before += _MADE_ROLE[state]
                    state = int(_MADE[state])
                    continue
                keys.append(key)
                poss.append(pos)
                befores.append(before)
                edits.append(letter)
                renamed.append(_MADE_ROLE[state] if letter == "R" else "")
                afters.append("")
                state = int(_TARGET[codes[pos - start], state, LETTERS.index(letter)])
                pos, before = pos + 1, ""
            afters[-1] = after
        kinds = [pa.string(), pa.int64(), *[pa.string()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip((keys, poss, befores, edits, renamed, afters), kinds, strict=True)], names)


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits, each before the row of the same place, to the repaired rows."""
    plan = None
    for batch in batches:
        out: list[tuple] = []
        for key, pos, is_row, turn, role, text, before, edit, renamed, after in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if not is_row:
                plan = (before, edit, renamed, after)
                continue
            before, edit, renamed, after = plan
            out.extend((key, pos, None, ROLES[r], "", "I") for r in before)
            if edit != "D":
                out.append((key, pos, turn, ROLES[renamed] if renamed else role, text, edit))
            out.extend((key, pos, None, ROLES[r], "", "I") for r in after)
        columns = list(zip(*out, strict=True)) if out else [()] * 6
        kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 3]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["key", "pos", "turn", "role", "text", "edit"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of whole conversations in order to one digest each; only the hash's state is held."""
    key, hashed = None, None

    def out(pairs: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.string())], ["key", "repaired_sha256"])

    for batch in batches:
        done = []
        for at, role, text in zip(*(batch.column(c).to_pylist() for c in ("key", "role", "text")), strict=True):
            if at != key:
                if key is not None:
                    done.append((key, hashed.hexdigest()))
                key, hashed = at, hashlib.sha256()
            else:
                hashed.update(b"\n")
            hashed.update(f"{role}:{text}".encode())
        yield out(done)
    if key is not None:
        yield out([(key, hashed.hexdigest())])


class Repair:
    """The plan of a repair: ``rows`` are the repaired rows, ``report`` has one row per conversation.

    ``conversations`` are (conv_id, turn, role, text) without further columns; ``known`` names every conversation that
    the report shall have. Null role and text count as one space, null turns come first, rows of a null conv_id are one
    conversation. Rows of one turn are taken by a digest of role and text; equal rows stay neighbours. A role is judged by
    its first character, any but u, a and s can only be renamed or deleted, and so can an empty role.
    """

    def __init__(self, conversations: DataFrame, known: DataFrame | None = None, *, segment: int = SEGMENT, fan: int = FAN):
        shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
        self.known = (conversations if known is None else known).select("conv_id").distinct()
        self.spark, self.segment = conversations.sparkSession, segment
        self.placed = number_rows(conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), shown("role"), shown("text")))
        self.nodes = written(find_faults(self.placed), "conversations-nodes")
        self.segments = written(pack_segments(self.nodes, segment), "conversations-segments")
        levels, blocks = 1, self.nodes.count() >> segment >> fan
        while blocks:
            levels, blocks = levels + 1, blocks >> fan
        ends = contexts(self.segments, _Costs, levels, fan)
        found = self.segments.join(ends, ["key", "block"]).select("key", "block", "codes", "context")
        paths = written(found.mapInArrow(_paths, "key string, block long, costs array<long>, element array<long>, audits array<string>"), "conversations-paths")
        entered = contexts(paths, _Entries, levels, fan)
        last = self.segments.groupBy("key").agg(F.max("block").alias("last_block"))
        rows = self.segments.select("key", "block", "start", "codes")
        state = F.col("context")[0].cast("int")
        # What is inserted behind the last row: after s a user and an assistant, after u an assistant.
        left = F.when(F.col("block") == F.col("last_block"), F.col("element")[state])
        chosen = paths.join(entered, ["key", "block"]).join(rows, ["key", "block"]).join(last, "key")
        self.chosen = written(
            chosen.select(
                "key", "block", "start", "codes", state.alias("state"), F.col("audits")[state].alias("audit"), F.col("costs")[state].alias("cost"),
                F.when(left == 1, "ua").when(left == 2, "a").otherwise("").alias("after"),
            ),
            "conversations-chosen",
        )

    def edits(self) -> DataFrame:
        """(key, pos, before, edit, renamed, after) of each row."""
        columns = "key string, pos long, before string, edit string, renamed string, after string"
        return self.chosen.select("key", "start", "codes", "audit", "state", "after").mapInArrow(_row_edits, columns)

    def _repaired(self, *deal: str | Column) -> DataFrame:
        nothing = [F.lit(None).cast("string").alias(c) for c in ("before", "edit", "renamed", "after")]
        texts = self.placed.select("key", "pos", F.lit(True).alias("is_row"), "turn", "role", "text", *nothing)
        plans = self.edits().select(
            "key", "pos", F.lit(False).alias("is_row"), F.lit(None).cast("long").alias("turn"),
            F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), "before", "edit", "renamed", "after",
        )
        # An edit and its row fall to one task and stand next to each other.
        dealt = texts.unionByName(plans).repartition(*deal).sortWithinPartitions("key", "pos", "is_row")
        return dealt.mapInArrow(_apply, "key string, pos long, turn long, role string, text string, edit string")

    def rows(self) -> DataFrame:
        """The repaired rows (key, pos, turn, role, text, edit) by segment; inserted ones have no turn and no text."""
        return self._repaired("key", F.shiftright("pos", self.segment))

    def digests(self) -> DataFrame:
        """(key, repaired_sha256): a hash goes through a conversation in order, so each streams through one task."""
        return self._repaired("key").mapInArrow(_digests, "key string, repaired_sha256 string")

    def report(self) -> DataFrame:
        faults = [F.count_if(F.col("fault") == f).alias(f) for f in ("blank", "duplicate", "truncated")]
        counted = self.nodes.groupBy("key").agg(F.min("turn").alias("low"), F.max("turn").alias("high"), F.count_distinct("turn").alias("turns"), *faults)
        behind = self.segments.select("key", (F.col("block") - 1).alias("block"), F.col("first").alias("next"))
        pair = F.concat("last", "next")
        broken = F.col("illegal") + F.when(pair.isin("su", "ua", "au") | F.col("next").isNull(), 0).otherwise(1)
        pairs = self.segments.join(behind, ["key", "block"], "left").groupBy("key").agg(F.sum(broken).alias("illegal"))
        lists = self.chosen.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("block", "audit", "after", "cost"))).alias("parts"))
        spelled = F.concat(F.array_join(F.col("parts.audit"), ""), F.regexp_replace(F.array_join(F.col("parts.after"), ""), ".", "I"))
        audits = lists.select("key", spelled.alias("audit"), F.col("parts")[0]["cost"].alias("cost"))
        out = self.known.withColumn("key", _key(F.col("conv_id")))
        for part in (counted, pairs, audits, self.digests()):
            out = out.join(part, "key", "left")
        number = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
        return out.select(
            "conv_id",
            F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).cast("long").alias("gaps"),
            *[number(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")],
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
        )


def damage_and_repair(conversations: DataFrame) -> DataFrame:
    """The report on damaged rows, with every original conversation; one without rows left has zeros and empty texts."""
    plain = conversations.select("conv_id", "turn", "role", "text")
    return Repair(damage(plain), plain).report()
