"""Keyword in text.

Two forms with the same result.  The goals are a fixed table of 20 rows, so
matching against them is a filter over a literal array inside a projection: no
join, no shuffle, and the cost per keyword row is constant.  For two tables
that both grow there is an index of each keyword's rarest piece.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.bloom import bloom, might_hold
from starloom.session import stored

SCORE_PRIMARY = 80.0
SCORE_SECONDARY = 60.0
PIECE = 4
CHUNK = 512
HOT = 4096


def match_fixed_targets(
    keywords: DataFrame, keyword: str, targets: Sequence[tuple[int, str, str]], target_id: str = "ods_sk",
    score: str = "nivel_confianca",
) -> DataFrame:
    """J9 against a literal list of (id, primary text, secondary text).

    The lower-case keyword inside the primary text scores 80, inside the
    secondary text only 60; blank and null keywords never match (Q9).
    """
    literal = F.array(*[
        F.struct(
            F.lit(number).alias(target_id),
            F.lit(primary.lower()).alias("primary"),
            F.lit(secondary.lower()).alias("secondary"),
        )
        for number, primary, secondary in targets
    ])
    word = F.lower(F.col(keyword))
    hits = F.filter(literal, lambda t: t["primary"].contains(word) | t["secondary"].contains(word))
    return (
        keywords.filter(F.trim(F.coalesce(F.col(keyword), F.lit(""))) != "")
        .withColumn("_hit", F.explode(hits))
        .select(
            *keywords.columns,
            F.col(f"_hit.{target_id}").alias(target_id),
            F.when(F.col("_hit.primary").contains(word), SCORE_PRIMARY).otherwise(SCORE_SECONDARY).alias(score),
        )
    )


def _grams(text: Column) -> Column:
    """The ``PIECE`` characters from each position of ``text`` on that has as many after it; linear in the text."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{PIECE}}}))."), F.lit(1))


def _occurrences(texts: DataFrame, text_id: str, longest: int, widths: Sequence[int], known: Column) -> DataFrame:
    """(text id, ``_piece``, ``_window``, ``_at``): positions of ``_text`` where a piece that the filter ``known`` lets through begins.

    A text is cut into chunks of at least the longest keyword, and a chunk into the ``PIECE`` characters from each
    position on; so arrays stay as short as a chunk and every step is linear in the text.  ``_window`` holds
    what a keyword around the piece can cover, the piece begins at its character ``_at`` (from 0).
    """
    step = max(CHUNK, longest)
    cut = texts.select(text_id, F.regexp_extract_all("_text", F.lit(f"(?s).{{1,{step}}}"), F.lit(0)).alias("_chunks"))

    def neighbours(chunk: Column, i: Column) -> Column:
        before = F.coalesce(F.get("_chunks", i - 1), F.lit(""))
        after = F.coalesce(F.get("_chunks", i + 1), F.lit(""))
        return F.struct(chunk.alias("core"), F.right(before, F.lit(longest)).alias("before"), F.left(after, F.lit(longest)).alias("after"))

    # outer: a plain explode of an array that is built here would make Spark test its size first, and build it twice
    chunk = cut.select(text_id, F.explode_outer(F.transform("_chunks", neighbours)).alias("_c")).select(
        text_id, "_c.*", F.concat("_c.before", "_c.core", "_c.after").alias("_whole")
    )
    padded = F.concat("core", F.rpad(F.substring("after", 1, PIECE - 1), PIECE - 1, "\0"))
    places = chunk.select(
        text_id, F.length("before").alias("_before"), "_whole", F.posexplode_outer(_grams(padded)).alias("_in", "_gram")
    )
    narrow = F.array(*[F.substring("_gram", 1, w) for w in widths])
    pieces = places.withColumn("_piece", F.col("_gram") if list(widths) == [PIECE] else F.explode_outer(narrow))
    held = pieces.where(F.col("_piece").isNotNull() & might_hold(known, F.col("_piece"), 1))
    begin = F.col("_before") + F.col("_in")
    first = F.greatest(begin - longest, F.lit(0))
    # never null here; were they nullable, the join would have both tested, and so built, at every position of the texts
    window = F.coalesce(F.substring("_whole", first + 1, F.lit(2 * longest)), F.lit(""))
    return held.select(text_id, "_piece", window.alias("_window"), F.coalesce(begin - first, F.lit(0)).alias("_at"))


def contains_pairs(
    keywords: DataFrame, keyword_id: str, keyword: str, texts: DataFrame, text_id: str, text: str
) -> DataFrame:
    """J9 for two growing tables: pairs (keyword id, text id) where the text contains the keyword, by a rarest-piece index.

    Both ids must be unique; blank and null keywords match nothing, case is ignored.

    Of all pieces (``PIECE`` characters, or a shorter keyword whole) of a keyword, the one that is rarest in the
    texts files it in the index, with its offset.  The texts are then read once more: only positions where a filed piece
    begins leave a task, with the characters around them, and meet the index on the piece; the match is
    verified right there.  A keyword with a piece that no text has is out at once.  A piece that takes more than
    one ``HOT``-th of all positions is dealt over several tasks; there are less than ``HOT`` of them for each width.
    """
    words = keywords.select(F.col(keyword_id), F.lower(F.col(keyword)).alias("_word")).filter(F.trim("_word") != "")
    size = F.length("_word")
    longest, widths = words.agg(F.max(size), F.collect_set(F.least(size, F.lit(PIECE)))).first()
    body = texts.select(F.col(text_id), F.lower(F.col(text)).alias("_text"))
    if not widths:  # at most PIECE different widths
        return words.select(keyword_id).join(body.select(text_id), F.lit(False))
    widths = sorted(widths)
    own = F.when(size < PIECE, F.array("_word")).otherwise(_grams(F.col("_word")))
    filed = words.select(keyword_id, "_word", F.posexplode_outer(own).alias("_offset", "_piece"))
    counts = stored(
        _occurrences(body, text_id, longest, widths, bloom(filed, "_piece", 1)).groupBy("_piece").agg(F.count("*").alias("_rows"))
    )
    rarest = F.min(F.struct(F.coalesce("_rows", F.lit(0)).alias("_rows"), "_offset", "_piece")).alias("_r")
    index = stored(
        filed.join(counts, "_piece", "left").groupBy(keyword_id, "_word").agg(rarest)
        .select(keyword_id, "_word", "_r.*").filter("_rows > 0")
    )
    share = F.ceil(F.col("_rows") * HOT / counts.agg(F.sum("_rows")).scalar())
    hot = index.filter(share > 1).select("_piece", share.alias("_parts")).distinct()
    found = _occurrences(body, text_id, longest, widths, bloom(index, "_piece", 1)).join(F.broadcast(hot), "_piece", "left")
    dealt = found.withColumn("_part", F.coalesce(F.pmod(F.xxhash64(text_id, "_at", "_window"), F.col("_parts")), F.lit(0)))
    copies = index.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("bigint"), share - 1)))
    begin = F.col("_at") - F.col("_offset")
    same = (begin >= 0) & (F.substring("_window", begin + 1, F.length("_word")) == F.col("_word"))
    return dealt.join(copies, ["_piece", "_part"]).filter(same).select(keyword_id, text_id, "_word").distinct().drop("_word")
