"""Dedup, surrogate keys, unknown members, bridge maintenance."""

import uuid

from pyspark.sql import functions as F

from registered import SQL, load, query
from registered.joins import TARGETS, TARGETS_SQL
from starloom.fixed_values import POSITION
from starloom.operators.dedup import best_per_pair, distinct_rows, input_order, latest_per_key, one_per_key, without_position
from starloom.operators.keys import extend_keys, factorized, surrogate_key, with_unknown_member
from starloom.operators.maintain import deactivate, insert_missing, promote
from starloom.operators.match import match_fixed_targets
from starloom.operators.shape import stack_rows
from starloom.session import ensure_checkpoint_dir
from starloom.sources.ranged import RangedTable
from starloom.sources.readers import numbered_parquet
from starloom.sources.versions import VersionedTable


@query("""
    SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders
    ) WHERE n = 1
""")
def latest_order_per_customer(spark, folder):
    orders = load(spark, folder, "orders").select("o_custkey", "o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"))
    return latest_per_key(orders, ["o_custkey"], ["o_orderdate"], [F.desc("o_orderkey")])


@query("""
    SELECT user_id, event_id, which FROM (
        SELECT user_id, event_id, 'first' AS which, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events
        UNION ALL
        SELECT user_id, event_id, 'last', row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) FROM events
    ) WHERE n = 1
""")
def first_last_per_key(spark, folder):
    events = load(spark, folder, "events").select("user_id", "event_id", "ts")
    first = one_per_key(events, ["user_id"], ["ts", "event_id"]).withColumn("which", F.lit("first"))
    last = one_per_key(events, ["user_id"], [F.desc("ts"), F.desc("event_id")]).withColumn("which", F.lit("last"))
    return stack_rows([first, last]).drop("ts")


@query("""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, which FROM (
        SELECT *, 'last' AS which, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY place DESC) AS n
        FROM (SELECT *, row_number() OVER () AS place FROM lineitem)
        UNION ALL
        SELECT *, 'first', row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY place)
        FROM (SELECT *, row_number() OVER () AS place FROM lineitem)
    ) WHERE n = 1
""")
def first_last_in_file_order(spark, folder):
    """D3, D4 by the position in the file."""
    lines = numbered_parquet(spark, f"{folder}/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", *POSITION
    )
    keys = ["l_orderkey", "l_linenumber"]
    ends = [one_per_key(lines, keys, input_order(lines, last)).withColumn("which", F.lit(which)) for which, last in (("first", False), ("last", True))]
    return without_position(stack_rows(ends))


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber, l_tax FROM lineitem")
def distinct_line_kinds(spark, folder):
    return distinct_rows(load(spark, folder, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber", "l_tax"))


@query("SELECT l_partkey, l_suppkey, max(l_quantity) AS l_quantity FROM lineitem GROUP BY l_partkey, l_suppkey")
def distinct_pair(spark, folder):
    return best_per_pair(load(spark, folder, "lineitem"), ["l_partkey", "l_suppkey"], "l_quantity")


@query("""
    SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS order_sk FROM orders
""")
def surrogate_keys(spark, folder):
    orders = load(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return surrogate_key(orders, "order_sk", [F.desc("o_totalprice"), "o_orderkey"]).drop("o_totalprice")


@query("""
    SELECT p_partkey, dense_rank() OVER (ORDER BY p_name) AS name_id,
           dense_rank() OVER (ORDER BY p_brand || '||' || p_type) AS kind_id
    FROM part
""")
def sorted_factorize(spark, folder):
    parts = load(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    ids = factorized(factorized(parts, "name_id", ["p_name"]), "kind_id", ["p_brand", "p_type"])
    return ids.select("p_partkey", "name_id", "kind_id")


@query("""
    SELECT 0 AS nation_sk, -1 AS n_nationkey, 'NÃO INFORMADO' AS n_name, CAST(NULL AS INT) AS n_regionkey
    UNION ALL
    SELECT row_number() OVER (ORDER BY n_nationkey), n_nationkey, n_name, n_regionkey FROM nation
""")
def unknown_member_union(spark, folder):
    keyed = surrogate_key(load(spark, folder, "nation"), "nation_sk", ["n_nationkey"])
    return with_unknown_member(keyed, {"nation_sk": 0, "n_nationkey": -1, "n_name": "NÃO INFORMADO"})


def part_bridge(spark, folder):
    """Automatic associations of the words of part names with the fixed targets."""
    parts = load(spark, folder, "part").select(
        F.col("p_partkey").alias("tema_sk"), F.explode(F.array_distinct(F.split("p_name", " "))).alias("word"), "p_size"
    )
    pairs = match_fixed_targets(parts, "word", TARGETS)
    return pairs.select(
        "tema_sk", "ods_sk", F.lit("Automática").alias("tipo_associacao"), "nivel_confianca",
        F.when(F.col("p_size") > 25, "big").alias("observacao"), F.lit(True).alias("ativo"),
    )


BRIDGE_SQL = f"""
    targets(ods_sk, a, b) AS (VALUES {TARGETS_SQL}),
    words AS (SELECT p_partkey AS tema_sk, lower(unnest(list_distinct(string_split(p_name, ' ')))) AS word, p_size FROM part),
    bridge AS (
        SELECT tema_sk, ods_sk, 'Automática' AS tipo_associacao,
               CAST(CASE WHEN contains(a, word) THEN 80 ELSE 60 END AS DOUBLE) AS nivel_confianca,
               CASE WHEN p_size > 25 THEN 'big' END AS observacao, true AS ativo
        FROM words JOIN targets ON contains(a, word) OR contains(b, word) WHERE trim(word) <> ''
    )
"""


@query(f"""
    WITH {BRIDGE_SQL},
    wanted AS (SELECT l_partkey AS tema_sk, CAST(3 AS INT) AS ods_sk FROM lineitem WHERE l_quantity >= 49 GROUP BY 1)
    SELECT * FROM bridge
    UNION ALL
    SELECT tema_sk, ods_sk, 'Manual', CAST(100 AS DOUBLE), NULL, true FROM wanted w
    WHERE NOT EXISTS (SELECT 1 FROM bridge b WHERE b.tema_sk = w.tema_sk AND b.ods_sk = w.ods_sk)
""")
def insert_if_absent(spark, folder):
    wanted = load(spark, folder, "lineitem").filter("l_quantity >= 49").select(
        F.col("l_partkey").alias("tema_sk"), F.lit(3).alias("ods_sk"), F.lit("Manual").alias("tipo_associacao"),
        F.lit(100.0).alias("nivel_confianca"), F.lit(True).alias("ativo"),
    )
    return insert_missing(part_bridge(spark, folder), wanted)


@query(f"""
    WITH {BRIDGE_SQL}
    SELECT tema_sk, ods_sk, tipo_associacao, nivel_confianca,
           CASE WHEN ods_sk = 2 AND nivel_confianca < 80 THEN coalesce(observacao || ' | ', '') || 'reviewed' ELSE observacao END AS observacao,
           ativo AND NOT (ods_sk = 2 AND nivel_confianca < 80) AS ativo
    FROM bridge
""")
def soft_delete_update(spark, folder):
    weak = (F.col("ods_sk") == 2) & (F.col("nivel_confianca") < 80)
    return deactivate(part_bridge(spark, folder), weak, "reviewed")


@query(f"""
    WITH {BRIDGE_SQL}
    SELECT tema_sk, ods_sk, CASE WHEN hit THEN 'Validada' ELSE tipo_associacao END AS tipo_associacao,
           CASE WHEN hit THEN CAST(95 AS DOUBLE) ELSE nivel_confianca END AS nivel_confianca, observacao, ativo
    FROM (
        SELECT *, nivel_confianca >= 80 AND tema_sk IN (SELECT l_partkey FROM lineitem WHERE l_discount >= 0.1) AS hit FROM bridge
    )
""")
def promote_semi(spark, folder):
    reviewed = load(spark, folder, "lineitem").filter("l_discount >= 0.1").select(F.col("l_partkey").alias("tema_sk"))
    return promote(part_bridge(spark, folder), reviewed)


# --- the same changes on a stored bridge, part by part ----------------------------

def stored_bridge(spark, folder):
    table = RangedTable(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/bridge-{uuid.uuid4().hex}")
    table.create(part_bridge(spark, folder), "tema_sk", ["tema_sk", "ods_sk"], 16)
    return table


@query(SQL["insert_if_absent"])
def stored_insert_if_absent(spark, folder):
    """M1 on stored parts."""
    wanted = load(spark, folder, "lineitem").filter("l_quantity >= 49").select(
        F.col("l_partkey").alias("tema_sk"), F.lit(3).alias("ods_sk"), F.lit("Manual").alias("tipo_associacao"),
        F.lit(100.0).alias("nivel_confianca"), F.lit(True).alias("ativo"),
    )
    table = stored_bridge(spark, folder)
    table.insert_missing(wanted)
    return table.read()


@query(SQL["soft_delete_update"])
def stored_soft_delete(spark, folder):
    """M2 on stored parts."""
    table = stored_bridge(spark, folder)
    table.deactivate((F.col("ods_sk") == 2) & (F.col("nivel_confianca") < 80), "reviewed")
    return table.read()


@query(SQL["promote_semi"])
def stored_promote(spark, folder):
    """M3 on stored parts."""
    table = stored_bridge(spark, folder)
    table.promote(load(spark, folder, "lineitem").filter("l_discount >= 0.1").select(F.col("l_partkey").alias("tema_sk")))
    return table.read()


@query("""
    WITH first AS (SELECT p_brand, p_type, row_number() OVER (ORDER BY p_brand, p_type) AS kind_sk FROM (SELECT DISTINCT p_brand, p_type FROM part WHERE p_partkey % 3 = 0)),
    second AS (
        SELECT p_brand, p_type, (SELECT max(kind_sk) FROM first) + row_number() OVER (ORDER BY p_brand, p_type) AS kind_sk
        FROM (SELECT DISTINCT p_brand, p_type FROM part EXCEPT SELECT p_brand, p_type FROM first)
    )
    SELECT * FROM first UNION ALL SELECT * FROM second
""")
def keys_of_two_lots(spark, folder):
    """A third of the parts is loaded first, then all; keys of the first lot stay, the others come behind them."""
    part = load(spark, folder, "part")
    table = VersionedTable(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/kinds-{uuid.uuid4().hex}")
    kind = ["p_brand", "p_type"]
    empty = spark.createDataFrame([], "kind_sk bigint, p_brand string, p_type string")
    table.load(extend_keys(empty, part.filter("p_partkey % 3 = 0"), "kind_sk", kind))
    table.load(extend_keys(table.read(), part, "kind_sk", kind), "append")
    return table.read()
