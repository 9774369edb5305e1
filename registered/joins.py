"""Lookups, joins and text matching."""

from pyspark.sql import functions as F

from registered import load, query
from starloom.functions.text import public_or_private
from starloom.operators.aggregates import distinct_by, distinct_list, top
from starloom.operators.filters import at_maximum, in_subquery, without_unknown
from starloom.operators.fingerprints import differing_groups
from starloom.operators.integrity import orphan_keys, orphan_rows, reconcile
from starloom.operators.keys import surrogate_key, with_unknown_member
from starloom.operators.lookup import (
    attach_bridge, backfill, enrich_by_name, enrich_unique, lookup_sk, lookup_sk_fallback, lookup_sk_priority,
)
from starloom.operators.match import contains_pairs, match_fixed_targets
from starloom.plans.reports import themes_by_group_of_state


def customer_dimension(spark, folder):
    """Customers in credit with keys 1..n and the unknown member 0."""
    in_credit = load(spark, folder, "customer").filter("c_acctbal > 0")
    keyed = surrogate_key(in_credit, "customer_sk", ["c_custkey"])
    return with_unknown_member(keyed, {"customer_sk": 0, "c_name": "UNKNOWN"})


KEYED_CUSTOMERS = """
    keyed AS (
        SELECT row_number() OVER (ORDER BY c_custkey) AS customer_sk, *
        FROM customer WHERE c_acctbal > 0
    )
"""


@query("""
    SELECT r_name, CAST(count(DISTINCT c_custkey) AS BIGINT) AS total_customers, count(*) AS total_orders
    FROM orders
    JOIN customer ON o_custkey = c_custkey AND c_acctbal > 0
    JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey
    GROUP BY r_name ORDER BY r_name
""")
def star_distinct_by_region(spark, folder):
    dim = customer_dimension(spark, folder)
    fact = lookup_sk(
        load(spark, folder, "orders").select("o_custkey"), dim, F.col("o_custkey"), F.col("c_custkey"), "customer_sk",
        clean=None,
    )
    # orders are counted per customer key before the dimensions join
    per_customer = without_unknown(fact, "customer_sk").groupBy("customer_sk").agg(F.count("*").alias("orders"))
    place = load(spark, folder, "nation").join(
        load(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    star = per_customer.join(dim, "customer_sk").join(place, F.col("c_nationkey") == F.col("n_nationkey"))
    result = distinct_by(star, ["r_name"], {"total_customers": "c_custkey"}, sums={"total_orders": "orders"})
    return result.orderBy("r_name")


@query("""
    SELECT p_brand, CAST(count(DISTINCT p_type) AS BIGINT) AS types, CAST(count(DISTINCT p_name) AS BIGINT) AS names
    FROM lineitem JOIN part ON l_partkey = p_partkey
    GROUP BY p_brand
""")
def macro_distinct_children(spark, folder):
    used = load(spark, folder, "lineitem").select(F.col("l_partkey").alias("p_partkey")).distinct()
    parts = load(spark, folder, "part").join(used, "p_partkey")
    return distinct_by(parts, ["p_brand"], {"types": "p_type", "names": "p_name"})


@query("""
    SELECT CASE WHEN s_acctbal < 1000 THEN 'PRIVADO' ELSE 'PÚBLICO' END AS category,
           CAST(count(DISTINCT c_custkey) AS BIGINT) AS themes
    FROM customer CROSS JOIN supplier
    WHERE c_nationkey = s_nationkey
    GROUP BY 1
""")
def category_case_distinct(spark, folder):
    themes = load(spark, folder, "customer").withColumnRenamed("c_nationkey", "nationkey")
    status = F.when(F.col("s_acctbal") < 1000, "Particular").otherwise("Oficial")
    members = load(spark, folder, "supplier").withColumnRenamed("s_nationkey", "nationkey").withColumn("status", status)
    return themes_by_group_of_state(
        themes, members, "nationkey", "c_custkey", public_or_private("status"), "category", "themes"
    )


@query("""
    SELECT s_suppkey, s_name, CAST(count(DISTINCT l_partkey) AS BIGINT) AS parts
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    GROUP BY s_suppkey, s_name ORDER BY parts DESC, s_suppkey LIMIT 20
""")
def top_suppliers(spark, folder):
    counted = distinct_by(load(spark, folder, "lineitem"), ["l_suppkey"], {"parts": "l_partkey"})
    named = counted.join(load(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    return top(named.select("s_suppkey", "s_name", "parts"), 20, [F.desc("parts"), "s_suppkey"])


@query(f"""
    WITH {KEYED_CUSTOMERS}
    SELECT o_orderkey, coalesce(customer_sk, 0) AS customer_sk
    FROM orders LEFT JOIN keyed ON o_custkey = c_custkey
""")
def sk_lookup_default0(spark, folder):
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey")
    dim = customer_dimension(spark, folder)
    found = lookup_sk(orders, dim, F.col("o_custkey"), F.col("c_custkey"), "customer_sk", clean=None)
    return found.select("o_orderkey", "customer_sk")


@query(f"""
    WITH {KEYED_CUSTOMERS}
    SELECT o_orderkey, coalesce(customer_sk, 0) AS customer_sk
    FROM orders LEFT JOIN keyed ON o_custkey = c_custkey AND o_orderstatus <> 'F'
""")
def sk_lookup_with_missing_keys(spark, folder):
    """A third of the orders has no key at all: they are spread, not piled up."""
    key = F.when(F.col("o_orderstatus") != "F", F.col("o_custkey"))
    orders = load(spark, folder, "orders").select("o_orderkey", key.alias("key"))
    dim = customer_dimension(spark, folder)
    return lookup_sk(orders, dim, F.col("key"), F.col("c_custkey"), "customer_sk", clean=None).drop("key")


@query(f"""
    WITH {KEYED_CUSTOMERS}
    SELECT o_orderkey, coalesce(customer_sk, 0) AS customer_sk
    FROM orders LEFT JOIN keyed ON o_custkey = c_custkey
""")
def sk_lookup_fallback(spark, folder):
    """The first lookup column never hits; keys arrive as text like '899.0'."""
    orders = load(spark, folder, "orders").select("o_orderkey", F.concat("o_custkey", F.lit(".0")).alias("customer_id"))
    dim = customer_dimension(spark, folder)
    found = lookup_sk_fallback(orders, dim, "customer_id", ["c_mktsegment", "c_custkey", "c_name"], "customer_sk")
    return found.select("o_orderkey", "customer_sk")


@query(f"""
    WITH {KEYED_CUSTOMERS},
    pairs AS (
        SELECT 0 AS rank, CAST(c_nationkey AS VARCHAR) AS key, customer_sk FROM keyed
        UNION ALL
        SELECT 1, CAST(c_custkey AS VARCHAR), customer_sk FROM keyed
    ),
    firsts AS (
        SELECT key, customer_sk FROM (
            SELECT *, row_number() OVER (PARTITION BY key ORDER BY rank, customer_sk) AS n FROM pairs
        ) WHERE n = 1
    )
    SELECT event_id, coalesce(customer_sk, 0) AS customer_sk,
           CASE WHEN customer_sk > 0 THEN 'MATCHED' ELSE 'UNMATCHED' END AS match_status
    FROM events LEFT JOIN firsts ON CAST(user_id AS VARCHAR) = key
""")
def multi_key_first_wins(spark, folder):
    events = load(spark, folder, "events").select("event_id", "user_id")
    dim = customer_dimension(spark, folder)
    found = lookup_sk_priority(events, dim, "user_id", ["c_nationkey", "c_custkey"], "customer_sk")
    return found.select("event_id", "customer_sk", "match_status")


@query("""
    WITH bridge AS (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_quantity > 45)
    SELECT p_partkey, coalesce(l_suppkey, -1) AS l_suppkey
    FROM part LEFT JOIN bridge ON p_partkey = l_partkey
""")
def bridge_fanout(spark, folder):
    pairs = load(spark, folder, "lineitem").filter("l_quantity > 45").select(
        (F.col("l_partkey") + 1).alias("part_sk"), (F.col("l_suppkey") + 1).alias("supplier_sk")
    )
    parts = load(spark, folder, "part").select("p_partkey", (F.col("p_partkey") + 1).alias("part_sk"))
    found = attach_bridge(parts, pairs, "part_sk", "supplier_sk")
    return found.select("p_partkey", (F.col("supplier_sk") - 1).alias("l_suppkey"))


# Three target texts for the keyword match.
TARGETS = [
    (1, "small rings, bolts and other fasteners", "metal work"),
    (2, "red, blue and green colours", "paint for a widget or a gear"),
    (3, "large and heavy machine parts", "Small parts box"),
]
TARGETS_SQL = ", ".join(f"({i}, '{a.lower()}', '{b.lower()}')" for i, a, b in TARGETS)


@query(f"""
    WITH targets(target_id, a, b) AS (VALUES {TARGETS_SQL}),
    words AS (SELECT p_partkey, lower(unnest(string_split(p_name, ' '))) AS word FROM part)
    SELECT p_partkey, word, target_id, CAST(CASE WHEN contains(a, word) THEN 80 ELSE 60 END AS DOUBLE) AS score
    FROM words JOIN targets ON contains(a, word) OR contains(b, word)
    WHERE trim(word) <> ''
""")
def keyword_theta_match(spark, folder):
    words = load(spark, folder, "part").select("p_partkey", F.explode(F.split("p_name", " ")).alias("word"))
    return match_fixed_targets(words, "word", TARGETS, "target_id", "score").withColumn("word", F.lower("word"))


@query("""
    WITH words AS (
        SELECT lower(word) AS word, min(p_partkey) AS word_id
        FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS word FROM part) GROUP BY 1
    )
    SELECT word_id, p_partkey FROM words JOIN part ON contains(lower(p_name), word)
""")
def keyword_contains_pairs(spark, folder):
    """Two growing tables: every word of the part names inside every part name."""
    parts = load(spark, folder, "part").select("p_partkey", "p_name")
    words = parts.select("p_partkey", F.explode(F.split(F.lower("p_name"), " ")).alias("word"))
    unique = words.groupBy("word").agg(F.min("p_partkey").alias("word_id"))
    return contains_pairs(unique, "word_id", "word", parts, "p_partkey", "p_name")


@query("""
    WITH terms AS (
        SELECT DISTINCT lower(w[i] || ' ' || w[i + 1]) AS term
        FROM (SELECT string_split(text, ' ') AS w, unnest(range(1, len(string_split(text, ' ')))) AS i FROM benchmark)
    )
    SELECT term, doc_id FROM terms JOIN documents ON contains(lower(text), term)
""")
def benchmark_terms_in_documents(spark, folder):
    """J9 at size: every pair of neighbouring words of the benchmark inside every whole document."""
    words = load(spark, folder, "benchmark").select(F.split("text", " ").alias("w"))
    pair = F.transform("w", lambda x, i: F.concat(x, F.lit(" "), F.get("w", i + 1)))
    terms = words.select(F.explode(pair).alias("term")).select(F.lower("term").alias("term")).filter("term IS NOT NULL").distinct()
    documents = load(spark, folder, "documents").select("doc_id", "text")
    return contains_pairs(terms, "term", "term", documents, "doc_id", "text")


@query("""
    SELECT n_nationkey, n_name, count(s_suppkey) AS suppliers
    FROM nation LEFT JOIN supplier ON n_nationkey = s_nationkey AND s_acctbal > 5000
    GROUP BY n_nationkey, n_name HAVING count(s_suppkey) < 3
""")
def left_join_extra_on_having(spark, folder):
    rich = load(spark, folder, "supplier").filter("s_acctbal > 5000").groupBy(
        F.col("s_nationkey").alias("n_nationkey")
    ).agg(F.count("s_suppkey").alias("suppliers"))
    nations = load(spark, folder, "nation").join(rich, "n_nationkey", "left")
    counted = nations.select("n_nationkey", "n_name", F.coalesce("suppliers", F.lit(0)).alias("suppliers"))
    return counted.filter("suppliers < 3")


@query("""
    SELECT o_orderkey, count(*) AS rows FROM orders
    WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey) GROUP BY o_orderkey
""")
def orphans_left_anti(spark, folder):
    return orphan_keys(load(spark, folder, "orders"), load(spark, folder, "lineitem"), "o_orderkey", "l_orderkey")


@query("""
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""")
def semi_in_subquery(spark, folder):
    builders = load(spark, folder, "customer").filter("c_mktsegment = 'BUILDING'")
    wanted = builders.select(F.col("c_custkey").alias("o_custkey"))
    return in_subquery(load(spark, folder, "orders"), wanted, "o_custkey").select("o_orderkey", "o_custkey", "o_totalprice")


@query("""
    SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)
""")
def scalar_subquery_max(spark, folder):
    return at_maximum(load(spark, folder, "orders"), "o_orderdate").select("o_orderkey", "o_custkey")


@query("""
    SELECT c_custkey, c_name, o_orderkey FROM customer LEFT JOIN (
        SELECT o_custkey, o_orderkey,
               row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS n
        FROM orders
    ) ON c_custkey = o_custkey AND n = 1
""")
def enrich_with_latest(spark, folder):
    """The right side is cut to one row per key before the join."""
    customers = load(spark, folder, "customer").select("c_custkey", "c_name")
    orders = load(spark, folder, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderdate", "o_orderkey")
    return enrich_unique(customers, orders, "c_custkey", [F.desc_nulls_last("o_orderdate"), "o_orderkey"]).drop("o_orderdate")


@query("""
    WITH names AS (SELECT upper(p_name) AS name, min(p_partkey) AS first_part FROM part GROUP BY 1)
    SELECT p_partkey, first_part FROM part LEFT JOIN names ON upper(p_name) = name
""")
def enrich_by_shared_name(spark, folder):
    """A name is shared by many rows on both sides and still does not fan out."""
    parts = load(spark, folder, "part")
    right = parts.select(F.concat(F.lit(" "), F.lower("p_name")).alias("right_name"), F.col("p_partkey").alias("first_part"))
    return enrich_by_name(parts.select("p_partkey", "p_name"), right, "p_name", "right_name", ["first_part"]).select(
        "p_partkey", "first_part"
    )


@query("""
    SELECT s_suppkey, coalesce(nullif(CASE WHEN s_acctbal > 5000 THEN 'known' END, ''), n_name) AS label
    FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
""")
def backfill_from_table(spark, folder):
    suppliers = load(spark, folder, "supplier").select(
        "s_suppkey", F.col("s_nationkey").alias("n_nationkey"), F.when(F.col("s_acctbal") > 5000, "known").alias("label")
    )
    nations = load(spark, folder, "nation").select("n_nationkey", F.col("n_name").alias("label"))
    return backfill(suppliers, nations, "n_nationkey", ["label"]).drop("n_nationkey")


@query("""
    SELECT r_name, count(DISTINCT n_nationkey) AS nations,
           string_agg(DISTINCT n_name, ', ' ORDER BY n_name) AS nation_list
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY r_name
""")
def string_agg_distinct(spark, folder):
    used = load(spark, folder, "supplier").select(F.col("s_nationkey").alias("n_nationkey")).distinct()
    nations = load(spark, folder, "nation").join(used, "n_nationkey")
    rows = nations.join(load(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    lists = distinct_list(rows, ["r_name"], "n_name", "nation_list")
    return distinct_by(rows, ["r_name"], {"nations": "n_nationkey"}).join(lists, "r_name")


@query("""
    SELECT n_name, left_value, right_value, left_value - right_value AS difference FROM (
        SELECT n_name, count(DISTINCT o_custkey) AS left_value,
               count(DISTINCT CASE WHEN c_acctbal > 0 THEN o_custkey END) AS right_value
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        GROUP BY n_name
    )
""")
def reconcile_raw_vs_star(spark, folder):
    """Customers with orders per nation, from the raw tables and from the star."""
    nation = load(spark, folder, "nation")
    buyers = load(spark, folder, "orders").select("o_custkey").distinct()
    raw = buyers.join(load(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    dim = customer_dimension(spark, folder)
    star = lookup_sk(buyers, dim, F.col("o_custkey"), F.col("c_custkey"), "customer_sk", clean=None)
    star = without_unknown(star, "customer_sk").join(dim, "customer_sk")

    def per_nation(rows):
        named = rows.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        return distinct_by(named, ["n_name"], {"customers": "o_custkey"})

    return reconcile(per_nation(raw), per_nation(star), ["n_name"], "customers")


@query("""
    SELECT DISTINCT p_partkey + 1 AS part_sk, s_suppkey + 1 AS supplier_sk, n_nationkey + 1 AS nation_sk,
           (SELECT CAST(min(o_orderkey) AS BIGINT) FROM orders WHERE year(o_orderdate) = 1997) AS time_sk
    FROM lineitem
    JOIN part ON l_partkey = p_partkey
    JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey
""")
def theme_fact_distinct(spark, folder):
    """Distinct keys over joins, the time key from a scalar subquery."""
    used = load(spark, folder, "lineitem").select("l_partkey", "l_suppkey").distinct()
    parts = load(spark, folder, "part").select("p_partkey")
    suppliers = load(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    nations = load(spark, folder, "nation").select("n_nationkey")
    day = load(spark, folder, "orders").filter(F.year("o_orderdate") == 1997).agg(F.min("o_orderkey"))
    rows = (
        used.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
    )
    return rows.select(
        (F.col("p_partkey") + 1).alias("part_sk"), (F.col("s_suppkey") + 1).alias("supplier_sk"),
        (F.col("n_nationkey") + 1).alias("nation_sk"), day.scalar().alias("time_sk"),
    )


CHANGED_SQL = """
    changed AS (
        SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_orderkey % 991 = 0 AND l_linenumber = 1 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity
        FROM lineitem WHERE NOT (l_orderkey % 1009 = 0 AND l_linenumber = 2)
        UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE l_orderkey % 1013 = 0
    )
"""


@query(f"""
    WITH {CHANGED_SQL}, original AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem),
    differing AS (
        SELECT DISTINCT l_orderkey FROM (
            (SELECT * FROM original EXCEPT ALL SELECT * FROM changed) UNION ALL (SELECT * FROM changed EXCEPT ALL SELECT * FROM original)
        )
    )
    SELECT l_orderkey, (SELECT count(*) FROM original o WHERE o.l_orderkey = d.l_orderkey) AS left_rows,
           (SELECT count(*) FROM changed c WHERE c.l_orderkey = d.l_orderkey) AS right_rows
    FROM differing d
""")
def orders_that_differ(spark, folder):
    """The orders of which a changed copy of the lines has other rows, by fingerprints of key ranges."""
    columns = ["l_orderkey", "l_linenumber", "l_partkey", "l_quantity"]
    original = load(spark, folder, "lineitem").select(*columns)
    more = F.when((F.col("l_orderkey") % 991 == 0) & (F.col("l_linenumber") == 1), F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    copy = original.withColumn("l_quantity", more).filter("NOT (l_orderkey % 1009 = 0 AND l_linenumber = 2)")
    copy = copy.unionByName(original.filter("l_orderkey % 1013 = 0"))
    return differing_groups(original, copy, "l_orderkey")


@query("""
    SELECT l.* FROM lineitem l ANTI JOIN (SELECT o_orderkey FROM orders WHERE o_orderkey % 500 <> 3) ON l_orderkey = o_orderkey
""")
def orphan_lines(spark, folder):
    """Whole lines of orders that are missing, by a Bloom filter of the orphan keys in the scan."""
    orders = load(spark, folder, "orders").filter("o_orderkey % 500 <> 3").select("o_orderkey")
    return orphan_rows(load(spark, folder, "lineitem"), orders, "l_orderkey", "o_orderkey")
