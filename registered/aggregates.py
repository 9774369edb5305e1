"""Aggregates, distributions and consolidation."""

from pyspark.sql import functions as F

from registered import load, query
from starloom.functions.numbers import percentage
from starloom.operators.aggregates import (
    conditional_counts, count_by, count_rows, distinct_by, first_by, match_ratio, profile, value_distribution,
)
from starloom.operators.consolidate import consolidate
from starloom.operators.shape import stack_rows
from starloom.operators.sketches import HLL_ERROR, KLL_ERROR, merged, sketch, stacked
from starloom.session import stored


@query("""
    SELECT event_type, count(*) AS events, CAST(count(DISTINCT user_id) AS BIGINT) AS users,
           CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) AS total, min(value) AS lowest, max(value) AS highest
    FROM events GROUP BY event_type
""")
def group_profile(spark, folder):
    events = load(spark, folder, "events").withColumn("amount", F.col("value").cast("decimal(18,2)"))
    return events.groupBy("event_type").agg(
        F.count("*").alias("events"),
        F.count_distinct("user_id").alias("users"),
        F.sum("amount").cast("double").alias("total"),
        F.min("value").alias("lowest"),
        F.max("value").alias("highest"),
    )


@query("SELECT count(*) AS total FROM lineitem")
def row_count(spark, folder):
    return count_rows(load(spark, folder, "lineitem"))


@query("""
    SELECT l_returnflag, l_linestatus, count(*) AS total FROM lineitem
    GROUP BY l_returnflag, l_linestatus ORDER BY total DESC, l_returnflag, l_linestatus
""")
def count_per_group(spark, folder):
    return count_by(load(spark, folder, "lineitem"), ["l_returnflag", "l_linestatus"])


@query("""
    SELECT count(DISTINCT o_custkey) AS o_custkey, count(DISTINCT o_orderstatus) AS o_orderstatus,
           count(DISTINCT o_orderpriority) AS o_orderpriority, count(DISTINCT o_orderdate) AS o_orderdate
    FROM orders
""")
def distinct_profile(spark, folder):
    return profile(load(spark, folder, "orders"), ["o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate"])


PROFILED = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]


@query("""
    WITH cells AS (
        SELECT year(o_orderdate) >= 1995 AS late, unnest(['o_custkey', 'o_orderstatus', 'o_totalprice', 'o_orderdate']) AS "column",
               unnest([o_custkey::VARCHAR, o_orderstatus, o_totalprice::VARCHAR, o_orderdate::VARCHAR]) AS v,
               unnest([o_custkey, NULL, o_totalprice, NULL]::DOUBLE[]) AS number
        FROM orders
    )
    SELECT late, "column", count(*) AS rows, count(*) - count(v) AS nulls, min(number) AS least, max(number) AS most, count(DISTINCT v) AS exact,
           true AS distinct_within, CASE WHEN min(number) IS NOT NULL THEN true END AS median_within
    FROM cells GROUP BY 1, 2
""")
def merged_profile(spark, folder):
    """Sketches of yearly parts, stored, then merged into two spans; each estimate held against the exact result.

    Within: 4 standard errors for distinct values, 2 rank errors for the median.
    """
    orders = load(spark, folder, "orders").withColumn("year", F.year("o_orderdate"))
    parts = stored(sketch(orders, PROFILED, ["year"]))
    spans = merged(parts.withColumn("late", F.col("year") >= 1995), ["late"], {"median": 0.5})
    late = orders.withColumn("late", F.col("year") >= 1995)
    exact = stacked(late, PROFILED, ["late"]).distinct().groupBy("late", "c").agg(F.count("*").alias("exact"))
    named = exact.select("late", F.element_at(F.array(*[F.lit(c) for c in PROFILED]), F.col("c") + 1).alias("column"), "exact")
    # share of rows at most the estimated median, for each number column
    asked = spans.filter("median IS NOT NULL").groupBy("late").pivot("column", ["o_custkey", "o_totalprice"]).agg(F.first("median"))
    ranks = late.join(F.broadcast(asked.withColumnsRenamed({"o_custkey": "m0", "o_totalprice": "m1"})), "late").groupBy("late").agg(
        F.array(*[
            F.struct(F.lit(c).alias("column"), F.avg((F.col(c) < F.col(m)).cast("int")).alias("low"), F.avg((F.col(c) <= F.col(m)).cast("int")).alias("high"))
            for c, m in (("o_custkey", "m0"), ("o_totalprice", "m1"))
        ]).alias("r")
    ).select("late", F.explode("r").alias("r")).select("late", "r.*")
    error = 4 * HLL_ERROR
    return spans.join(named, ["late", "column"]).join(ranks, ["late", "column"], "left").select(
        "late", "column", "rows", "nulls", "least", "most", "exact",
        (F.abs(F.col("distinct") - F.col("exact")) <= F.greatest(F.lit(1.0), F.col("exact") * error)).alias("distinct_within"),
        F.when(F.col("least").isNotNull(), (F.col("low") <= 0.5 + 2 * KLL_ERROR) & (F.col("high") >= 0.5 - 2 * KLL_ERROR)).alias("median_within"),
    )


@query("""
    SELECT l_suppkey, count(DISTINCT l_partkey) AS parts, count(*) AS lines,
           CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
    FROM lineitem GROUP BY l_suppkey
""")
def distinct_and_sum_per_group(spark, folder):
    lines = load(spark, folder, "lineitem").withColumn("units", F.col("l_quantity").cast("bigint"))
    return distinct_by(lines, ["l_suppkey"], {"parts": "l_partkey"}, rows="lines", sums={"quantity": "units"})


@query("""
    SELECT count(*) AS total, count(*) FILTER (c_acctbal > 0) AS matched,
           count(*) FILTER (c_acctbal > 0) * 100.0::DOUBLE / count(*) AS match_pct
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey
""")
def ratio_summary(spark, folder):
    # customers are unique, so orders are counted per customer before the join
    per_customer = load(spark, folder, "orders").groupBy("o_custkey").agg(F.count("*").alias("orders"))
    joined = per_customer.join(load(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"), "left")
    counted = joined.agg(
        F.sum("orders").alias("total"),
        F.coalesce(F.sum(F.when(F.col("c_acctbal") > 0, F.col("orders"))), F.lit(0)).alias("matched"),
    )
    return counted.withColumn("match_pct", percentage(F.col("matched"), F.col("total")))


@query("""
    SELECT count(*) AS total, count(*) FILTER (event_type = 'purchase') AS matched,
           count(*) FILTER (event_type = 'purchase') * 100.0::DOUBLE / count(*) AS match_pct
    FROM events
""")
def match_share(spark, folder):
    return match_ratio(load(spark, folder, "events"), F.col("event_type") == "purchase")


@query("""
    SELECT o_orderstatus, count(*) FILTER (o_orderpriority = '1-URGENT') AS urgent,
           count(*) FILTER (o_totalprice > 250000) AS large,
           count(*) FILTER (o_orderpriority = '1-URGENT' OR o_totalprice > 250000) AS either
    FROM orders GROUP BY o_orderstatus
""")
def conditional_counts_by_group(spark, folder):
    urgent, large = F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") > 250000
    counts = conditional_counts({"urgent": urgent, "large": large, "either": urgent | large})
    return load(spark, folder, "orders").groupBy("o_orderstatus").agg(*counts)


@query("SELECT p_size, count(*) AS total FROM part GROUP BY p_size ORDER BY p_size DESC")
def value_distribution_desc(spark, folder):
    return value_distribution(load(spark, folder, "part"), "p_size")


@query("""
    SELECT p_brand, count(*) AS parts FROM part GROUP BY p_brand HAVING count(*) >= 80
""")
def having_threshold(spark, folder):
    return count_by(load(spark, folder, "part"), ["p_brand"], "parts").filter("parts >= 80")


@query("""
    SELECT o_custkey, o_orderkey, o_totalprice FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders
    ) WHERE n = 1
""")
def first_row_per_group(spark, folder):
    return first_by(load(spark, folder, "orders"), ["o_custkey"], ["o_orderkey", "o_totalprice"], ["o_orderdate", "o_orderkey"])


@query("""
    WITH rows AS (
        SELECT 0 AS role, s_suppkey AS id, s_nationkey AS nation, CASE WHEN s_acctbal > 2000 THEN s_name END AS name,
               CASE WHEN s_acctbal < 8000 THEN CAST(s_suppkey AS VARCHAR) ELSE '' END AS code,
               CAST(NULL AS VARCHAR) AS segment
        FROM supplier
        UNION ALL
        SELECT 1, c_custkey, c_nationkey, c_name, '', nullif(c_mktsegment, 'BUILDING') FROM customer WHERE c_acctbal > 500
    ),
    scored AS (
        SELECT *, (CASE WHEN coalesce(name, '') = '' THEN 1 ELSE 0 END) + (CASE WHEN coalesce(code, '') = '' THEN 1 ELSE 0 END)
                  + (CASE WHEN coalesce(segment, '') = '' THEN 1 ELSE 0 END) AS gaps
        FROM rows
    ),
    best AS (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY nation ORDER BY gaps, role, id) AS n FROM scored) WHERE n = 1
    ),
    firsts AS (
        SELECT nation, arg_min(name, (role, id)) FILTER (coalesce(name, '') <> '') AS name,
               arg_min(code, (role, id)) FILTER (coalesce(code, '') <> '') AS code,
               arg_min(segment, (role, id)) FILTER (coalesce(segment, '') <> '') AS segment
        FROM scored GROUP BY nation
    )
    SELECT b.nation, coalesce(nullif(b.name, ''), f.name, b.name) AS name,
           coalesce(nullif(b.code, ''), f.code, b.code) AS code,
           coalesce(nullif(b.segment, ''), f.segment, b.segment) AS segment
    FROM best b JOIN firsts f ON b.nation = f.nation
""")
def role_union_consolidate(spark, folder):
    """Two roles stacked, then the fullest row per nation with its gaps filled."""
    suppliers = load(spark, folder, "supplier").select(
        F.lit(0).alias("role"), F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation"),
        F.when(F.col("s_acctbal") > 2000, F.col("s_name")).alias("name"),
        F.when(F.col("s_acctbal") < 8000, F.col("s_suppkey").cast("string")).otherwise("").alias("code"),
    )
    customers = load(spark, folder, "customer").filter("c_acctbal > 500").select(
        F.lit(1).alias("role"), F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"),
        F.col("c_name").alias("name"), F.lit("").alias("code"),
        F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")).alias("segment"),
    )
    return consolidate(stack_rows([suppliers, customers]), "nation", ["role", "id"])
