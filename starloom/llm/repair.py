"""Conversation structure repair (operator 11): square-root checkpointed dynamic programming.

The rows of a conversation, in order, shall get role initials ``(s?(ua)+)?`` by the cheapest edits: keep 0,
change the role to user or assistant 1, delete 2, insert an empty turn 5, and 5 more for a truncated row that is
not deleted.  Blank rows and rows that repeat an earlier role and text must go.  Of all cheapest edit lists
the one whose initials (D, I, K, R) are least in ASCII is taken; state and initial fix the edit.

A state is what the repaired rows so far allow next (``START`` to ``CLOSED``); a row costs a step from state to
state.  No task ever walks through a whole conversation:

1. Rows are sorted by range over all conversations and stored with their place.  Runs of at most B rows
   of a conversation are its blocks, B the square root of the longest conversation, so both the rows of a block and the
   blocks of a conversation stay near that root however hot a conversation is.
2. Each block is summed up by its state-to-state costs.
3. Backward over the blocks of a conversation: the cost vector at each block's end, the checkpoints.
4. Each block recomputes the vectors inside from its checkpoint and walks forward once from every state;
   strung together over the blocks this gives the state in which each block really starts.
5. Each block walks once more from that state and emits its edits.

Cost vectors differ from state to state by a few units only, so a step is one look into a small table
of those seen.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from starloom.llm.batches import Scratch, importable

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
EDITS = {"D": "Delete", "I": "Insert", "K": "Keep", "R": "Rerole"}
ROLES = {"u": "user", "a": "assistant"}
START, OPENED, ASKED, CLOSED = range(4)
STATES = range(4)
_INITIALS = "sua"
_FITS = {(START, 0): OPENED, (START, 1): ASKED, (OPENED, 1): ASKED, (CLOSED, 1): ASKED, (ASKED, 2): CLOSED}
_TURN = {START: ASKED, OPENED: ASKED, CLOSED: ASKED, ASKED: CLOSED}  # the only state a user or assistant turn can lead to
_LEGAL = {(0, 1), (1, 2), (2, 1)}
#: Codes of a row: initial (s, u, a, other) + 4 * fault.
SOUND, DOOMED, CUT = 0, 1, 2
_NEVER = 1 << 60
_FINAL = (0, 2 * INSERT, INSERT, 0)
_LEAST_BITS = 8
_BLANKS = " \t\n\x0b\x0c\r"


# ---------------------------------------------------------------- the automaton


def choices(code: int, state: int) -> list[tuple[str, int, int]]:
    """(initial of the edit, cost, next state) of what may be done with a row, in ASCII order."""
    initial, fault = code & 3, code >> 2
    out = [("D", DELETE, state)]
    if fault != DOOMED:
        more = TRUNCATED if fault == CUT else 0
        if (state, initial) in _FITS:
            out.append(("K", KEEP + more, _FITS[state, initial]))
        out.append(("R", REROLE + more, _TURN[state]))
    return out


def _with_inserts(cost: list[int]) -> tuple[int, ...]:
    """Costs from each state when turns may be inserted first."""
    once = [min(cost[s], INSERT + cost[_TURN[s]]) for s in STATES]
    return tuple(min(once[s], INSERT + once[_TURN[s]]) for s in STATES)


class Steps:
    """Steps over rows, remembered by code and cost vector; vectors are held less their least entry."""

    def __init__(self):
        self.before: dict[tuple, tuple[tuple[int, ...], int]] = {}
        self.taken: dict[tuple, tuple[str, str, int]] = {}

    def back(self, code: int, after: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
        """Costs before a row from those after it, and what was taken off them."""
        known = self.before.get((code, after))
        if known is None:
            cost = _with_inserts([min(c + after[to] for _, c, to in choices(code, s)) for s in STATES])
            least = min(cost)
            known = self.before[code, after] = (tuple(c - least if c < _NEVER else _NEVER for c in cost), least)
        return known

    def take(self, code: int, after: tuple[int, ...], state: int) -> tuple[str, str, int]:
        """Least tight edits at a row: (initials, initials of the roles that are written, next state)."""
        known = self.taken.get((code, after, state))
        if known is None:
            here, off = self.back(code, after)
            here = [c + off for c in here]
            edits, roles, at, to = "", "", state, None
            while to is None:
                for edit, cost, following in sorted([*choices(code, at), ("I", INSERT, None)]):
                    rest = here[_TURN[at]] if edit == "I" else after[following]
                    if cost + rest == here[at]:
                        break
                edits += edit
                if edit in "IR":
                    roles += _written(at)
                if edit == "I":
                    at = _TURN[at]
                else:
                    to = following
            known = self.taken[code, after, state] = (edits, roles, to)
        return known

    def block_costs(self, codes: bytes) -> list[int]:
        """Costs from each state at a block's begin (row) to each at its end (column), 16 entries."""
        out = [0] * 16
        for end in STATES:
            shape, total = tuple(0 if s == end else _NEVER for s in STATES), 0
            for code in reversed(codes):
                shape, more = self.back(code, shape)
                total += more
            for s in STATES:
                out[4 * s + end] = min(shape[s] + total, _NEVER)
        return out

    def inside(self, codes: bytes, checkpoint: list[int]) -> list[tuple[int, ...]]:
        """Costs after each row of a block, recomputed from those at its end."""
        least = min(checkpoint)
        shape = tuple(c - least for c in checkpoint)
        out = []
        for code in reversed(codes):
            out.append(shape)
            shape, _ = self.back(code, shape)
        return out[::-1]

    def end_of(self, codes: bytes, costs: list[tuple[int, ...]], state: int) -> int:
        """State after a walk through a block."""
        for code, after in zip(codes, costs):
            state = self.take(code, after, state)[2]
        return state


def _written(state: int) -> str:
    """Initial of the role that an inserted or changed turn gets in ``state``."""
    return "a" if state == ASKED else "u"


# ---------------------------------------------------------------- rows and blocks


def ordered(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows of ``conversations`` (``conv_id``, ``turn``, ``role``, ``text``) sorted and stored, ``place`` rising in that order.

    The order is conversation, turn (nulls first), role, text.  Null roles and texts become one space.
    """
    trimmed = F.trim("text", F.lit(_BLANKS))
    initial = F.substring("role", 1, 1)
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"),
        F.monotonically_increasing_id().alias("origin"),  # spreads rows that are equal in all else
    )
    order = ["conv_id", "turn", "role", "text", "origin"]
    code = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3) + 4 * (
        F.when(trimmed == "", DOOMED).when(F.substring(trimmed, -1, 1).isin(".", "!", "?"), SOUND).otherwise(CUT)
    )
    said = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"))
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return scratch.keep(placed.select(
        F.monotonically_increasing_id().alias("place"), "conv_id", "turn", "role", "text", code.alias("code"), said.alias("said")
    ))


def _streamed(make: Callable[[], Callable], ddl: str, frame: DataFrame) -> DataFrame:
    """``make()`` once for each task; its function gets the rows as tuples, then yields tuples of the columns of ``ddl``."""
    importable(frame.sparkSession)
    schema = StructType.fromDDL(ddl)
    names = schema.names
    columns = frame.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = to_arrow_schema(schema)

        def rows():
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in columns))

        out: list[tuple] = []
        for row in make()(rows()):
            out.append(row)
            if len(out) >= 2048:
                yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*out), kinds)], names=names)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*out), kinds)], names=names)

    return frame.mapInArrow(run, schema)


_BLOCKS = (
    "conv_id long, block long, first_place long, codes binary, costs array<long>, blank long, duplicate long, truncated long, "
    "illegal long, opens int, closes int, first_turn long, last_turn long, turns long"
)


def _blocks(rows: DataFrame, bits: int) -> DataFrame:
    """One row for each block: codes of its rows in order, costs from state to state, and counts."""
    block = F.shiftright("place", bits).alias("block")
    firsts = rows.groupBy("conv_id", "said").agg(F.min("place").alias("place"))  # hot texts meet as one row for each task
    parts = rows.select("conv_id", block, "place", "turn", "code").unionByName(
        firsts.select("conv_id", block, "place", F.lit(None).cast("long").alias("turn"), F.lit(-1).alias("code"))
    )
    keys = ["conv_id", "block", "place", "code"]  # the mark of a first, -1, comes before its row
    dealt = parts.repartition("conv_id", "block").sortWithinPartitions(*keys).select(*keys, "turn")

    def make():
        steps = Steps()

        def summed(key, place, codes, counts, pairs, turns):
            distinct = len(set(turns))
            first, last = (turns[0], turns[-1]) if turns else (None, None)
            return (*key, place, bytes(codes), steps.block_costs(codes), *counts, pairs, codes[0] & 3, codes[-1] & 3, first, last, distinct)

        def run(rows):
            key, codes, turns, counts, pairs, place, marked = None, bytearray(), [], [0, 0, 0], 0, 0, False
            for conv, block, at, code, turn in rows:
                if code < 0:
                    marked = True
                    continue
                if codes and key != (conv, block):
                    yield summed(key, place, codes, counts, pairs, turns)
                    codes, turns, counts, pairs = bytearray(), [], [0, 0, 0], 0
                if not codes:
                    key, place = (conv, block), at
                fault = code >> 2
                if fault == DOOMED:
                    counts[0] += 1
                elif not marked:
                    counts[1] += 1
                    code = (code & 3) | DOOMED << 2
                elif fault == CUT:
                    counts[2] += 1
                if codes and (codes[-1] & 3, code & 3) not in _LEGAL:
                    pairs += 1
                if turn is not None and (not turns or turns[-1] != turn):
                    turns.append(turn)
                codes.append(code)
                marked = False
            if codes:
                yield summed(key, place, codes, counts, pairs, turns)

        return run

    return _streamed(make, _BLOCKS, dealt)


def _checkpoints(blocks: DataFrame) -> DataFrame:
    """(conv_id, block, after, last, cost): costs from each state at each block's end, and from the start of a conversation at its begin."""
    dealt = blocks.select("conv_id", "block", "costs").repartition("conv_id").sortWithinPartitions("conv_id", F.desc("block"))

    def make():
        def run(rows):
            key, after, begun = None, _FINAL, False
            for conv, block, costs in rows:
                last = not begun or conv != key
                if last:
                    key, after, begun = conv, _FINAL, True
                before = tuple(min(costs[4 * s + e] + after[e] for e in STATES) for s in STATES)
                yield conv, block, list(after), last, before[START]
                after = before

        return run

    return _streamed(make, "conv_id long, block long, after array<long>, last boolean, cost long", dealt)


def _on_block(left: DataFrame, right: DataFrame) -> DataFrame:
    """Equi-join on conversation (null is one) and block, unique on both sides."""
    right = right.withColumnsRenamed({"conv_id": "_conv", "block": "_block"})
    return left.join(right, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("block") == F.col("_block"))).drop("_conv", "_block")


def _starts(walks: DataFrame) -> DataFrame:
    """(conv_id, block, start): the state each block begins in, from the ends that each block has for every state."""
    dealt = walks.repartition("conv_id").sortWithinPartitions("conv_id", "block").select("conv_id", "block", "ends")

    def make():
        def run(rows):
            key, state, begun = None, START, False
            for conv, block, ends in rows:
                if not begun or conv != key:
                    key, state, begun = conv, START, True
                yield conv, block, state
                state = ends[state]

        return run

    return _streamed(make, "conv_id long, block long, start int", dealt)


def _ends(blocks: DataFrame) -> DataFrame:
    """``blocks`` with checkpoints as (conv_id, block, ends): where a walk from each state ends."""

    def make():
        steps = Steps()

        def run(rows):
            for conv, block, codes, after in rows:
                costs = steps.inside(codes, after)
                yield conv, block, [steps.end_of(codes, costs, s) for s in STATES]

        return run

    return _streamed(make, "conv_id long, block long, ends array<int>", blocks.select("conv_id", "block", "codes", "after"))


def _edits(blocks: DataFrame) -> DataFrame:
    """(place, edits, roles) for each row: initials of the edits at it, and of the roles that they write."""

    def make():
        steps = Steps()

        def run(rows):
            for place, codes, after, last, state in rows:
                costs = steps.inside(codes, after)
                for i, (code, here) in enumerate(zip(codes, costs)):
                    edits, roles, state = steps.take(code, here, state)
                    if last and i + 1 == len(codes):
                        while state in (OPENED, ASKED):  # what is left open at the end is closed there
                            edits, roles, state = edits + "I", roles + _written(state), _TURN[state]
                    yield place + i, edits, roles

        return run

    return _streamed(make, "place long, edits string, roles string", blocks.select("first_place", "codes", "after", "last", "start"))


# ---------------------------------------------------------------- the operator


def repair(conversations: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Edits and faults of ``conversations`` (``conv_id``, ``turn``, ``role``, ``text``; further columns are ignored).

    Edits: (conv_id, place, step, turn, edit, role, text), one row for each edit; by place and step they are in order.
    ``edit`` is Keep, Rerole, Delete or Insert; role and text are those after the edit (of a deleted row: its own).
    Faults: one row for each conversation, (conv_id, gaps, blank, duplicate, truncated, illegal, cost).

    Rows without an id are one conversation.  Null roles and texts count as one space.  Rows of one turn are in the
    order of role, then text; of equal rows all but one are duplicates.  No rows give no rows.
    """
    rows = ordered(conversations, scratch)
    longest = rows.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 1
    bits = max(_LEAST_BITS, ((longest - 1).bit_length() + 1) // 2)
    blocks = scratch.keep(_blocks(rows, bits))
    checked = scratch.keep(_on_block(blocks.select("conv_id", "block", "first_place", "codes"), _checkpoints(blocks)))
    steps = _edits(_on_block(checked, _starts(_ends(checked))))
    turned = F.element_at(F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair]), F.col("written"))
    edits = (
        rows.join(steps, "place")
        .select("conv_id", "place", "turn", "role", "text", "edits", "roles", F.posexplode(F.split("edits", "")).alias("step", "initial"))
        # R and I write a role each, in order
        .withColumn("nth", F.length(F.regexp_replace(F.expr("left(edits, step + 1)"), "[^IR]", "")))
        .withColumn("written", F.when(F.col("initial").isin("I", "R"), F.substring("roles", F.col("nth"), F.lit(1))))
        .select(
            "conv_id", "place", "step", "turn",
            F.element_at(F.create_map(*[F.lit(x) for pair in EDITS.items() for x in pair]), F.col("initial")).alias("edit"),
            F.when(F.col("written").isNotNull(), turned).otherwise(F.col("role")).alias("role"),
            F.when(F.col("initial") == "I", "").otherwise(F.col("text")).alias("text"),
        )
    )
    return edits, _faults(blocks, checked)


def _faults(blocks: DataFrame, checked: DataFrame) -> DataFrame:
    """Counts of each conversation; pairs and turns that meet at the border of two blocks are looked at there."""
    order = Window.partitionBy("conv_id").orderBy("block")  # about the square root of a conversation's rows
    opens, closes = F.col("opens"), F.lag("closes").over(order)
    legal = F.lit(False)
    for a, b in sorted(_LEGAL):
        legal = legal | ((closes == a) & (opens == b))
    joined = blocks.select(
        "conv_id", "block", "blank", "duplicate", "truncated", "first_turn", "last_turn",
        (F.col("illegal") + F.when(closes.isNull() | legal, 0).otherwise(1)).alias("illegal"),
        (F.col("turns") - F.when(F.lag("last_turn").over(order) == F.col("first_turn"), 1).otherwise(0)).alias("turns"),
    )
    gaps = F.max("last_turn") - F.min("first_turn") + 1 - F.sum("turns")
    counts = joined.groupBy("conv_id").agg(
        F.coalesce(gaps, F.lit(0)).alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")]
    )
    cost = checked.groupBy(F.col("conv_id").alias("_conv")).agg(F.min_by("cost", "block").alias("cost"))
    return counts.join(cost, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")


def digests(edits: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256): initials of all edits and the digest of the repaired ``role:text`` lines.

    A digest reads a conversation in order, so its rows stream through one task, which holds none of them.
    """
    dealt = edits.repartition("conv_id").sortWithinPartitions("conv_id", "place", "step").select("conv_id", "edit", "role", "text")

    def make():
        def run(rows):
            key, audit, digest, any_line = None, None, None, False
            for conv, edit, role, text in rows:
                if audit is None or conv != key:
                    if audit is not None:
                        yield key, audit.decode(), digest.hexdigest()
                    key, audit, digest, any_line = conv, bytearray(), hashlib.sha256(), False
                audit += edit[0].encode()
                if edit != "Delete":
                    digest.update(f"{chr(10) if any_line else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
                    any_line = True
            if audit is not None:
                yield key, audit.decode(), digest.hexdigest()

        return run

    return _streamed(make, "conv_id long, audit string, repaired_sha256 string", dealt)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows of ``conversations`` with planted faults, chosen by the CRC of ``conv_id:turn`` (nulls: one space) modulo 20.

    0 drops a row, 1 empties its text, 2 takes the marks ``.!?`` from it, 3 repeats the row, 4 makes its role user.
    """
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    return (
        conversations.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), fault.alias("fault"))
        .where("fault <> 0")
        .select(
            "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
            F.explode(F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("time"),
        )
        .drop("time")
    )
