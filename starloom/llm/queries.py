"""Registered queries of the operators of this folder, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import (
    chat, decontaminate, language, mixing, ngram_join, pieces, pii, quality, repair, token_counts, topk, url_filter, whiten,
)
from starloom.llm.batches import Scratch, held_out

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def keep(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return keep


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_JOIN_SQL = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes na ON na.doc_id = a.doc_id JOIN sizes nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n
  HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))
), reach AS (
  SELECT doc_id AS x, doc_id AS y FROM words
  UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y
)
SELECT d.doc_id, coalesce(sizes.n, 0) AS n_shingles, min(reach.y) AS component_id
FROM words d LEFT JOIN sizes USING (doc_id) JOIN reach ON reach.x = d.doc_id GROUP BY d.doc_id, sizes.n
"""


@_query(_JOIN_SQL)
def op7_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of all documents by 4-word shingles, 85 % alike."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return ngram_join.near_duplicate_groups(docs, Scratch(spark), ngram_join.Rule(words=4, percent=85))


_DECONTAMINATION_SQL = rf"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT item_id, n, unnest(list_transform(range(1, greatest(len(w) - n + 1, 1) + 1), lambda i: array_to_string(w[i:i+n-1], ' '))) AS s
  FROM (SELECT item_id, w, least(len(w), 10) AS n FROM item_words WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT n FROM windows),
runs AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i+n-1], ' '))) AS s
  FROM doc_words, lengths WHERE len(w) >= n
), hits AS (SELECT doc_id, i, runs.n, item_id FROM runs JOIN windows ON windows.s = runs.s AND windows.n = runs.n),
hit_words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS digest
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  coalesce(digest, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


@_query(_DECONTAMINATION_SQL)
def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """What of each document occurs in the benchmark."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    marked = decontaminate.mark_contaminated(docs, _table(spark, folder, "benchmark"))
    return marked.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@_query()
def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from the training fold."""
    docs = _table(spark, folder, "documents")
    model = language.train(language.train_fold(docs.select("doc_id", "text", "lang")))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "lang_shares")


@_query()
def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document, learned from the labels of the training fold."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    model = quality.train(docs, _table(spark, folder, "labels"))
    return quality.score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


_TOP_SQL = """
WITH rows AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 64)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
  FROM rows q JOIN rows c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
FROM scored QUALIFY rank <= 20
"""


@_query(_TOP_SQL)
def op2_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The 20 best of all vectors for each whose id is divisible by 20."""
    vectors = _table(spark, folder, "embeddings").select("vec_id", "embedding")
    return topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), 20, Scratch(spark))


# Verdict, host and path of each rule, as the contract states them.
URL_RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"), ("block", "net", "/fr/"),
]

_URL_SQL = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, instr(url, '://') + 3), '^[^?#]*') ELSE '' END AS rest
  FROM pages
), urls AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    substr(rest, length(regexp_extract(rest, '^[^/]*')) + 1) AS path FROM parts
), rules(verdict, h, p) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), best AS (
  SELECT page_id, arg_max(h || p, length(h) * 1000 + length(p)) AS rule, arg_max(verdict, length(h) * 1000 + length(p)) AS verdict
  FROM urls JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id
)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN regexp_matches(host, '(^|[.-])spam[.-]') THEN 'block' ELSE 'allow' END) AS verdict
FROM urls LEFT JOIN best USING (page_id)
"""


@_query(_URL_SQL)
def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every page; without a rule, hosts with the word spam in their name are listed."""
    pages = _table(spark, folder, "pages").select("page_id", "url")
    host, _ = url_filter.host_and_path()
    listed = pages.select(host.alias("key")).distinct().where(F.col("key").rlike(r"(^|[.-])spam[.-]"))
    judged = url_filter.judge(pages, URL_RULES, listed, Scratch(spark))
    return judged.select("page_id", "host", "path", "rule", "verdict")


_ESCAPED = r"regexp_replace(coalesce({0}, ''), '\\|<\|im_start\|>|<\|im_sep\|>|<\|im_end\|>|<\|endoftext\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>', 'x\0', 'g')"

_CHAT_SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t,
    length({_ESCAPED.format('role')}) + length({_ESCAPED.format('text')}) + 32 AS chars,
    row_number() OVER w AS i, sum(chars) OVER w AS upto, count(*) OVER (PARTITION BY conv_id) AS n
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role NULLS FIRST, text NULLS FIRST ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY i)) AS turns_sha256,
  coalesce(sum(length(t)) FILTER (r = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY i) FILTER (r = 'assistant'), '')) AS loss_sha256,
  coalesce(sum(upto) FILTER (r = 'assistant' OR i = n), 0)::BIGINT AS formatted_chars
FROM turns GROUP BY conv_id
"""


@_query(_CHAT_SQL)
def op10_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one made of control strings, formatted and read back."""
    control = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], "conv_id long, turn long, role string, text string")
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    return chat.digests(chat.examples(rows))


@_query()
def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every document before and after redactions, counted through its tree."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    edited = token_counts.counted_through_edits(token_counts.redactions(docs))
    return edited.select(
        "doc_id", "tokens_before", "n_edits", "tokens_after", "reencoded", F.size("lengths").cast("long").alias("n_pretokens")
    )


@_query()
def op5_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data in every document."""
    found = pii.find(_table(spark, folder, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


@_query()
def op8_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as piece ids, and whether they decode to its text."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    coded = pieces.coded(docs)
    return coded.select("doc_id", "n_pieces", "ids_sha256", F.col("text").eqNullSafe(F.col("decoded")).alias("round_trip"), "ids")


@_query()
def op12_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """What the mix takes of every document."""
    docs = _table(spark, folder, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs, Scratch(spark)).select("doc_id", "size", "source_size", "target", "taken", "copies")


@_query()
def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """The 16 leading whitened components of every vector."""
    return whiten.whiten(_table(spark, folder, "embeddings").select("vec_id", "embedding"), Scratch(spark))


# costs before a row, inserts allowed, from those after it: u0..u3 without inserts first
_REPAIR_SQL = r"""
WITH RECURSIVE numbers AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce([4294967295] || list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ord(c)),
      lambda h, b: list_reduce([xor(h, b)] || [0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295) % 20 AS fault
  FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE fault WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END))
  FROM numbers
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged
), judged AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
    CASE left(role, 1) WHEN 's' THEN 's' WHEN 'u' THEN 'u' WHEN 'a' THEN 'a' ELSE '-' END AS r
  FROM placed
), coded AS MATERIALIZED (
  SELECT conv_id, i, role, text, turn, fault, r, CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000 WHEN fault = 'truncated' THEN 5 ELSE 0 END AS more,
    lag(r) OVER (PARTITION BY conv_id ORDER BY i) AS r_before
  FROM judged
), counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (r_before IS NOT NULL AND r_before || r NOT IN ('su', 'ua', 'au')) AS illegal
  FROM coded GROUP BY conv_id
), back AS (
  SELECT conv_id, n + 1 AS i, 0 AS v0, 10 AS v1, 5 AS v2, 0 AS v3 FROM counts
  UNION ALL
  SELECT conv_id, i, least(u0, 5 + u2, 10 + u3), least(u1, 5 + u2, 10 + u3), least(u2, 5 + u3), least(u3, 5 + u2)
  FROM (
    SELECT back.conv_id, coded.i,
      least(2 + v0, more + 1 + v2, more + CASE r WHEN 's' THEN v1 WHEN 'u' THEN v2 ELSE 1000000 END) AS u0,
      least(2 + v1, more + 1 + v2, more + CASE r WHEN 'u' THEN v2 ELSE 1000000 END) AS u1,
      least(2 + v2, more + 1 + v3, more + CASE r WHEN 'a' THEN v3 ELSE 1000000 END) AS u2,
      least(2 + v3, more + 1 + v2, more + CASE r WHEN 'u' THEN v2 ELSE 1000000 END) AS u3
    FROM back JOIN coded ON coded.conv_id IS NOT DISTINCT FROM back.conv_id AND coded.i = back.i - 1
  )
), costs AS MATERIALIZED (SELECT conv_id, i, [v0, v1, v2, v3] AS v FROM back),
walk AS (
  SELECT conv_id, 1::BIGINT AS i, 0 AS s, '' AS audit, []::VARCHAR[] AS lines, false AS done FROM counts
  UNION ALL
  SELECT conv_id, CASE WHEN e IN ('I', '.') THEN i ELSE i + 1 END, CASE e WHEN 'D' THEN s WHEN '.' THEN s WHEN 'K' THEN keep ELSE turned END,
    CASE e WHEN '.' THEN audit ELSE audit || e END,
    CASE e WHEN 'K' THEN lines || [role || ':' || text] WHEN 'R' THEN lines || [said || ':' || text] WHEN 'I' THEN lines || [said || ':'] ELSE lines END, e = '.'
  FROM (
    SELECT *, CASE WHEN role IS NULL THEN CASE WHEN here[s + 1] = 0 THEN '.' ELSE 'I' END
      WHEN 2 + after[s + 1] = here[s + 1] THEN 'D' WHEN 5 + here[turned + 1] = here[s + 1] THEN 'I'
      WHEN keep >= 0 AND more + after[keep + 1] = here[s + 1] THEN 'K' ELSE 'R' END AS e
    FROM (
      SELECT walk.*, coded.role, coded.text, more, h.v AS here, a.v AS after, CASE s WHEN 2 THEN 3 ELSE 2 END AS turned,
        CASE s WHEN 2 THEN 'assistant' ELSE 'user' END AS said,
        CASE WHEN s = 0 AND r = 's' THEN 1 WHEN s <> 2 AND r = 'u' THEN 2 WHEN s = 2 AND r = 'a' THEN 3 ELSE -1 END AS keep
      FROM walk JOIN costs h ON h.conv_id IS NOT DISTINCT FROM walk.conv_id AND h.i = walk.i
      LEFT JOIN costs a ON a.conv_id IS NOT DISTINCT FROM walk.conv_id AND a.i = walk.i + 1
      LEFT JOIN coded ON coded.conv_id IS NOT DISTINCT FROM walk.conv_id AND coded.i = walk.i
      WHERE NOT done
    )
  )
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(v[1], 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts ON counts.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN costs ON costs.conv_id IS NOT DISTINCT FROM o.conv_id AND costs.i = 1
LEFT JOIN walk ON walk.conv_id IS NOT DISTINCT FROM o.conv_id AND done
"""


@_query(_REPAIR_SQL)
def op11_repair(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, damaged and repaired."""
    rows = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    edits, faults = repair.repair(repair.damaged(rows), Scratch(spark))
    out = rows.select("conv_id").distinct()
    for part in (faults, repair.digests(edits)):
        part = part.withColumnRenamed("conv_id", "_conv")
        out = out.join(part, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").drop("_conv")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.sha2(F.lit(b""), 256)
    return out.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))
