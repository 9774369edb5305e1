"""Chat formatting (operator 10): prefix-target expansion.

A turn is written as  <|im_start|>ROLE<|im_sep|>TEXT<|im_end|>.  Control strings inside roles and texts are
broken by a backslash after their first character, and backslashes are doubled, so formatted text never
holds a control string of its own and can be read back.  Every assistant turn becomes one example: all turns
before it as context and its own text as the only span under the loss.  Turns after the last
assistant turn, or a conversation without one, give one more example without a loss span, so
nothing is lost.

Rows are sorted, numbered and written once, and cut into runs of at most ``1 << RUN_BITS`` rows.  Each run of a conversation is a
unit of work of its own: it gets the rows before it as context and makes the examples of its turns, so a long
conversation is dealt over many tasks.  A task holds the formatted prefix of one conversation at a time; the examples of a
conversation together grow with the square of its turns: that is what they are.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.batches import Scratch, importable

START, SEPARATOR, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
CONTROLS = (START, SEPARATOR, END, "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TARGET_ROLE = "assistant"
EXAMPLES = "conv_id long, example int, n_turns int, text string, loss_start int, loss_end int"
DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
_BREAK = re.compile(r"\\|" + "|".join(re.escape(c) for c in CONTROLS))
_UNBREAK = re.compile(r"\\(.)", re.DOTALL)
_TURN = re.compile(re.escape(START) + "(.*?)" + re.escape(SEPARATOR) + "(.*?)" + re.escape(END), re.DOTALL)
_BATCH_CHARS = 1 << 20
RUN_BITS = 8


def escape(text: str) -> str:
    return _BREAK.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return _UNBREAK.sub(r"\1", text)


def turns_of(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn, read back from formatted text."""
    return [(unescape(role), unescape(text)) for role, text in _TURN.findall(formatted)]


def _runs(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, run, own, last, place, role, text): the rows of each run and, with ``own`` false, those of its context."""
    order = ["conv_id", "turn", "role", "text", "origin"]
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text",
        F.monotonically_increasing_id().alias("origin"),  # spreads rows that are equal in all else
    )
    placed = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = scratch.keep(placed.select(F.monotonically_increasing_id().alias("place"), "conv_id", "role", "text"))
    rows = rows.withColumn("at", F.shiftright("place", RUN_BITS))
    runs = scratch.keep(rows.select("conv_id", "at").distinct())
    ends = runs.groupBy("conv_id").agg(F.max("at").alias("end"))
    x, y = runs.alias("x"), runs.alias("y")
    reached = x.join(y, F.col("x.conv_id").eqNullSafe(F.col("y.conv_id")) & (F.col("x.at") <= F.col("y.at")))
    reached = reached.select(F.col("x.conv_id").alias("c"), F.col("x.at").alias("a"), F.col("y.at").alias("run"))
    reached = reached.join(ends.withColumnRenamed("conv_id", "e"), F.col("c").eqNullSafe(F.col("e"))).select("c", "a", "run", (F.col("run") == F.col("end")).alias("last"))
    return rows.join(reached, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("at") == F.col("a"))).select(
        "conv_id", "run", (F.col("at") == F.col("run")).alias("own"), "last", "place", "role", "text"
    )


def examples(conversations: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """One row per example of ``conversations`` (``conv_id``, ``turn``, ``role``, ``text``).

    Turns of one conversation come in the order of turn, role, text (null first), so ties and repeated rows have a
    fixed place; null texts and roles are empty; rows without an id form one conversation.  Further
    columns are ignored.  No rows give no rows.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        size = 0
        key, prefix, n, example, open_turns = None, [], 0, 0, False
        length, started = 0, False

        def flush():
            columns = list(zip(*out)) if out else [[]] * 6
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int32()]
            names = ["conv_id", "example", "n_turns", "text", "loss_start", "loss_end"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            for conv, run, own, last, role, text in zip(*(c.to_pylist() for c in batch.columns)):
                if not started or (conv, run) != key:
                    if started and open_turns:
                        out.append((key[0], example, n, "".join(prefix), None, None))
                    key, prefix, n, example, open_turns, length, started = (conv, run), [], 0, 0, False, 0, True
                head, body = START + escape(role or "") + SEPARATOR, escape(text or "")
                begin = length + len(head)
                prefix.append(head + body + END)
                length = begin + len(body) + len(END)
                n += 1
                target = role == TARGET_ROLE
                open_turns = own and last and not target
                if target and own:
                    whole = "".join(prefix)
                    prefix = [whole]
                    out.append((conv, example, n, whole, begin, begin + len(body)))
                    size += len(whole)
                example += target
                if size > _BATCH_CHARS or len(out) > 2000:
                    yield flush()
                    out, size = [], 0
        if started and open_turns:
            out.append((key[0], example, n, "".join(prefix), None, None))
        yield flush()

    importable(conversations.sparkSession)
    runs = _runs(conversations, scratch or Scratch(conversations.sparkSession))
    dealt = runs.repartition("conv_id", "run").sortWithinPartitions("conv_id", "run", "place")
    return dealt.select("conv_id", "run", "own", "last", "role", "text").mapInArrow(walk, EXAMPLES)


_PARTS = "conv_id long, example int, n_turns long, turns_sha256 string, loss string, formatted_chars long"


def _sha256(texts: list[str]) -> str:
    digest = hashlib.sha256()
    for text in texts:
        digest.update(text.encode("utf-8", "surrogatepass"))
    return digest.hexdigest()


def digests(formatted: DataFrame) -> DataFrame:
    """What the examples of each conversation say when read back; ``formatted`` as :func:`examples` returns it.

    Examples that follow each other are read where they are; only their loss texts move on, and one task takes those of a
    conversation in order, without holding them, as a digest of the whole asks.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "example", "n_turns", "turns_sha256", "loss", "formatted_chars"]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        out: list[tuple] = []
        key, number, last, loss, chars, size, held = None, None, "", [], 0, 0, 0

        def close():
            turns = turns_of(last)
            return (key, number, len(turns), _sha256([f"{role}\n{text}\n" for role, text in turns]), "".join(loss), chars)

        def flush():
            columns = list(zip(*out)) if out else [[]] * 6
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            rows = zip(*(batch.column(c).to_pylist() for c in ("conv_id", "example", "text", "loss_start", "loss_end")))
            for conv, example, text, begin, end in rows:
                if number is None or conv != key or example != number + 1 or held > _BATCH_CHARS:
                    if number is not None:
                        out.append(close())
                        size += held
                    key, loss, chars, held = conv, [], 0, 0
                number, last = example, text
                chars += len(text)
                if begin is not None:
                    loss.append(unescape(text[begin:end]))
                    held += len(loss[-1])
                if len(out) > 2000 or size > _BATCH_CHARS:
                    yield flush()
                    out, size = [], 0
        if number is not None:
            out.append(close())
        yield flush()

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        out: list[tuple] = []
        now = None

        def flush():
            columns = list(zip(*out)) if out else [[]] * 6
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        for batch in batches:
            for conv, n, turns, loss, chars in zip(*(c.to_pylist() for c in batch.columns)):
                if now is None or now[0] != conv:
                    if now is not None:
                        out.append((*now[:4], now[4].hexdigest(), now[5]))
                    now = [conv, 0, "", 0, hashlib.sha256(), 0]
                now[1:4] = n, turns, now[3] + len(loss)
                now[4].update(loss.encode("utf-8", "surrogatepass"))
                now[5] += chars
            if len(out) > 2000:
                yield flush()
                out = []
        if now is not None:
            out.append((*now[:4], now[4].hexdigest(), now[5]))
        yield flush()

    importable(formatted.sparkSession)
    parts = formatted.mapInArrow(read, _PARTS).repartition("conv_id").sortWithinPartitions("conv_id", "example")
    return parts.select("conv_id", "n_turns", "turns_sha256", "loss", "formatted_chars").mapInArrow(together, DIGESTS)
