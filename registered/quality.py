"""Data quality and integrity."""

from pyspark.sql import functions as F

from registered import load, query
from starloom.operators.integrity import all_zero, duplicate_keys, null_counts, orphan_rows, outside_range, star_report
from starloom.operators.quality import RuleSet, summarize


def order_rules() -> RuleSet:
    rules = RuleSet()
    rules.add_rule("key_unique", "o_orderkey", "unique")
    rules.add_rule("customer_unique", "o_custkey", "unique")
    rules.add_rule("note_unique", "note", "unique", severity="WARNING")
    rules.add_rule("note_present", "note", "not_null")
    rules.add_rule("price_range", "o_totalprice", "range", {"min": 1000, "max": 400000}, "WARNING")
    rules.add_rule("note_range", "note", "range", {"min": 5})
    rules.add_rule("priority_format", "o_orderpriority", "format", {"pattern": "[1-3]-"})
    rules.add_rule("status_values", "o_orderstatus", "values", {"values": ["F", "O"]}, "WARNING")
    rules.add_rule("note_length", "note", "length", {"min_length": 2, "max_length": 6})
    rules.add_rule("absent_column", "missing", "not_null")
    rules.add_rule("strange_rule", "o_orderkey", "telepathy")
    return rules


def orders_with_note(spark, folder):
    """Orders with a note that is null, a word or a number."""
    note = F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority")).when(
        F.col("o_orderstatus") == "O", (F.col("o_custkey")).cast("string")
    )
    return load(spark, folder, "orders").withColumn("note", note)


RULES_SQL = """
    noted AS (
        SELECT *, CASE o_orderstatus WHEN 'F' THEN o_orderpriority WHEN 'O' THEN CAST(o_custkey AS VARCHAR) END AS note FROM orders
    ),
    results AS (
        SELECT 'key_unique' AS rule_name, 'o_orderkey' AS column_name, 'ERROR' AS severity, count(*) - count(DISTINCT o_orderkey) AS failed_count, true AS runs FROM noted
        UNION ALL SELECT 'customer_unique', 'o_custkey', 'ERROR', count(*) - count(DISTINCT o_custkey), true FROM noted
        UNION ALL SELECT 'note_unique', 'note', 'WARNING', count(*) - count(DISTINCT note) - max(CASE WHEN note IS NULL THEN 1 ELSE 0 END), true FROM noted
        UNION ALL SELECT 'note_present', 'note', 'ERROR', count(*) FILTER (note IS NULL), true FROM noted
        UNION ALL SELECT 'price_range', 'o_totalprice', 'WARNING', count(*) FILTER (o_totalprice < 1000 OR o_totalprice > 400000), true FROM noted
        UNION ALL SELECT 'note_range', 'note', 'ERROR', count(*) FILTER (TRY_CAST(note AS DOUBLE) < 5), true FROM noted
        UNION ALL SELECT 'priority_format', 'o_orderpriority', 'ERROR', count(*) FILTER (NOT regexp_matches(o_orderpriority, '^[1-3]-')), true FROM noted
        UNION ALL SELECT 'status_values', 'o_orderstatus', 'WARNING', count(*) FILTER (o_orderstatus NOT IN ('F', 'O')), true FROM noted
        UNION ALL SELECT 'note_length', 'note', 'ERROR', count(*) FILTER (length(note) < 2 OR length(note) > 6), true FROM noted
        UNION ALL SELECT 'absent_column', 'missing', 'ERROR', 0, false
        UNION ALL SELECT 'strange_rule', 'o_orderkey', 'ERROR', 0, false
    )
"""


@query(f"""
    WITH {RULES_SQL}
    SELECT rule_name, column_name, severity, runs AND failed_count = 0 AS passed, CAST(failed_count AS BIGINT) AS failed_count,
           (SELECT count(*) FROM orders) AS total_count
    FROM results
""")
def quality_rules(spark, folder):
    return order_rules().measure(orders_with_note(spark, folder)).drop("position", "message")


@query(f"""
    WITH {RULES_SQL}, judged AS (SELECT *, runs AND failed_count = 0 AS passed FROM results)
    SELECT count(*) AS total_rules, count(*) FILTER (passed) AS passed_rules, count(*) FILTER (NOT passed) AS failed_rules,
           count(*) FILTER (NOT passed AND severity = 'ERROR') AS error_count,
           count(*) FILTER (NOT passed AND severity = 'WARNING') AS warning_count,
           count(*) FILTER (passed) / count(*)::DOUBLE AS success_rate
    FROM judged
""")
def quality_rules_summary(spark, folder):
    return summarize(order_rules().measure(orders_with_note(spark, folder)))


@query("""
    SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS n FROM orders) WHERE n > 1
""")
def quality_repeated_rows(spark, folder):
    return order_rules().failing_rows(orders_with_note(spark, folder), "customer_unique", "o_orderkey").select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE o_totalprice < 1000 OR o_totalprice > 400000")
def quality_failing_rows(spark, folder):
    return order_rules().failing_rows(orders_with_note(spark, folder), "price_range", "o_orderkey").select("o_orderkey")


@query("""
    SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def pk_grain_duplicates(spark, folder):
    return duplicate_keys(load(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT p_partkey, p_size FROM part WHERE NOT (p_size BETWEEN 5 AND 40)")
def check_range(spark, folder):
    return outside_range(load(spark, folder, "part"), "p_size", 5, 40).select("p_partkey", "p_size")


@query("""
    SELECT count(*) FILTER (o_custkey IS NULL) AS o_custkey, count(*) FILTER (o_orderstatus = 'P') AS note FROM orders
""")
def not_null_counts(spark, folder):
    return null_counts(orders_with_note(spark, folder), ["o_custkey", "note"])


@query("""
    SELECT count(*) AS total, count(*) FILTER (l_discount <> 0) AS non_zero, count(*) FILTER (l_discount <> 0) = 0 AS suspicious FROM lineitem
""")
def suspicious_zero(spark, folder):
    return all_zero(load(spark, folder, "lineitem"), "l_discount")


@query("""
    SELECT s_suppkey, s_nationkey FROM supplier WHERE s_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9800)
""")
def fk_orphan_rows(spark, folder):
    nations = load(spark, folder, "customer").filter("c_acctbal > 9800")
    return orphan_rows(load(spark, folder, "supplier"), nations, "s_nationkey", "c_nationkey").select("s_suppkey", "s_nationkey")


@query("""
    SELECT 'pk customer(c_custkey)' AS "constraint", CAST(count(*) - count(DISTINCT c_custkey) AS BIGINT) AS violations FROM customer
    UNION ALL SELECT 'pk lineitem(l_orderkey, l_linenumber)',
                     (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
    UNION ALL SELECT 'fk orders.o_custkey -> customer', count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)
    UNION ALL SELECT 'fk orders.o_orderkey -> lineitem', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
""")
def star_constraints(spark, folder):
    """Every declared key of the star with its violations."""
    tables = {name: load(spark, folder, name) for name in ("customer", "orders", "lineitem")}
    return star_report(
        tables,
        {"customer": ["c_custkey"], "lineitem": ["l_orderkey", "l_linenumber"]},
        [("orders", "o_custkey", "customer", "c_custkey"), ("orders", "o_orderkey", "lineitem", "l_orderkey")],
    )
