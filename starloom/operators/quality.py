"""Declarative data quality.

All rules of a table are compiled into one aggregate, so the table is read
once however many rules there are.  Only the counts, one row, leave Spark.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.fixed_values import NAME_COLUMN, SK_COLUMN, STATES, UNKNOWN_CODE
from starloom.functions.numbers import to_double

RULE_TYPES = ("not_null", "unique", "range", "format", "values", "length")


@dataclass(frozen=True)
class Rule:
    name: str
    column: str
    kind: str
    parameters: Mapping[str, object] = field(default_factory=dict)
    severity: str = "ERROR"


class QualityError(ValueError):
    """At least one ERROR rule failed; carries all results."""

    def __init__(self, message: str, results: list[dict]):
        super().__init__(message)
        self.results = results


class RuleSet:
    """V1: rules of one table."""

    def __init__(self, rules: Sequence[Rule] = (), null_as_nan_text: bool = False):
        self.rules = list(rules)
        # ledger Q20: whether 'format' and 'length' see a null as the text 'nan'
        self.null_as_nan_text = null_as_nan_text

    def add_rule(
        self, name: str, column: str, kind: str, parameters: Mapping[str, object] | None = None,
        severity: str = "ERROR",
    ) -> RuleSet:
        self.rules.append(Rule(name, column, kind, parameters or {}, severity))
        return self

    def _text(self, rule: Rule) -> Column:
        text = F.col(rule.column).cast("string")
        return F.coalesce(text, F.lit("nan")) if self.null_as_nan_text else text

    def _broken(self, rule: Rule) -> Column:
        """V2, V4-V7: condition of a failing row (not for 'unique')."""
        column, given = F.col(rule.column), rule.parameters
        if rule.kind == "not_null":
            return column.isNull()
        if rule.kind == "range":
            number = to_double(column)
            tests = []
            if given.get("min") is not None:
                tests.append(number < given["min"])
            if given.get("max") is not None:
                tests.append(number > given["max"])
            # text that is no number passes
            outside = tests[0] | tests[1] if len(tests) == 2 else tests[0] if tests else F.lit(False)
            return F.coalesce(outside, F.lit(False))
        if rule.kind == "format":
            return ~F.coalesce(self._text(rule).rlike(f"^(?:{given['pattern']})"), F.lit(False))
        if rule.kind == "values":
            return ~F.coalesce(column.isin(list(given["values"])), F.lit(False))
        size = F.length(self._text(rule))
        too_long = size > given["max_length"] if given.get("max_length") is not None else F.lit(False)
        return F.coalesce((size < given.get("min_length", 0)) | too_long, F.lit(False))

    def _refusal(self, rule: Rule, columns: Sequence[str]) -> str | None:
        """V8: why a rule cannot run at all."""
        if rule.column not in columns:
            return f"no column named {rule.column}"
        if rule.kind not in RULE_TYPES:
            return f"no rule of kind {rule.kind}"
        if rule.kind == "format" and not rule.parameters.get("pattern"):
            return "a format rule needs a pattern"
        if rule.kind == "values" and not rule.parameters.get("values"):
            return "a values rule needs its values"
        return None

    def _failed_count(self, rule: Rule) -> Column:
        if rule.kind == "unique":
            # V3: rows that repeat an earlier value, nulls being equal to each other
            column = F.col(rule.column)
            null_group = F.coalesce(F.max(F.when(column.isNull(), 1).otherwise(0)), F.lit(0))
            return F.count("*") - F.count_distinct(column) - null_group
        return F.count_if(self._broken(rule))

    def measure(self, df: DataFrame) -> DataFrame:
        """One row per rule: name, column, severity, passed, failed and total counts, message."""
        refusals = {i: self._refusal(rule, df.columns) for i, rule in enumerate(self.rules)}
        runnable = [i for i, refusal in refusals.items() if refusal is None]
        counts = df.agg(
            F.count("*").alias("_total"), *[self._failed_count(self.rules[i]).alias(f"_failed_{i}") for i in runnable]
        )
        lines = []
        for i, rule in enumerate(self.rules):
            refused = refusals[i]
            failed = F.lit(0).cast("bigint") if refused else F.col(f"_failed_{i}").cast("bigint")
            lines.append(F.struct(
                F.lit(i).alias("position"),
                F.lit(rule.name).alias("rule_name"),
                F.lit(rule.column).alias("column_name"),
                F.lit("ERROR" if refused else rule.severity).alias("severity"),
                (F.lit(False) if refused else failed == 0).alias("passed"),
                failed.alias("failed_count"),
                F.col("_total").alias("total_count"),
                F.lit(refused or f"{rule.kind} on {rule.column}").alias("message"),
            ))
        return counts.select(F.inline(F.array(*lines)))

    def failing_rows(self, df: DataFrame, rule_name: str, row_id: str) -> DataFrame:
        """V9: the rows that break a rule, as a DataFrame.

        For 'unique' these are all but the row with the smallest id of each
        value; the anti join runs on the row id, which no value can make hot.
        """
        rule = next(r for r in self.rules if r.name == rule_name)
        if rule.kind == "unique":
            firsts = df.groupBy(rule.column).agg(F.min(row_id).alias(row_id)).select(row_id)
            return df.join(firsts, row_id, "left_anti")
        return df.filter(self._broken(rule))

    def gate(self, df: DataFrame) -> list[dict]:
        """Raise when an ERROR rule fails; warnings are returned with the results."""
        results = [row.asDict() for row in self.measure(df).collect()]
        errors = [r for r in results if not r["passed"] and r["severity"] == "ERROR"]
        if errors:
            names = ", ".join(r["rule_name"] for r in errors)
            raise QualityError(f"{len(errors)} validation error(s): {names}", results)
        return results


def summarize(results: DataFrame) -> DataFrame:
    """Totals of a rule result table."""
    failed = ~F.col("passed")
    return results.agg(
        F.count("*").alias("total_rules"),
        F.count_if("passed").alias("passed_rules"),
        F.count_if(failed).alias("failed_rules"),
        F.count_if(failed & (F.col("severity") == "ERROR")).alias("error_count"),
        F.count_if(failed & (F.col("severity") == "WARNING")).alias("warning_count"),
        F.coalesce(F.avg(F.col("passed").cast("double")), F.lit(0.0)).alias("success_rate"),
    )


def dimension_rules(dimension: str) -> RuleSet:
    """The standard rules of a dimension; the name column comes from the registry (Q27)."""
    key = SK_COLUMN[dimension]
    rules = RuleSet()
    rules.add_rule("sk_not_null", key, "not_null")
    rules.add_rule("sk_unique", key, "unique")
    rules.add_rule("sk_range", key, "range", {"min": 0})
    rules.add_rule("nome_not_null", NAME_COLUMN[dimension], "not_null")
    if dimension == "tempo":
        rules.add_rule("ano_range", "ano", "range", {"min": 2000, "max": 2030}, "WARNING")
        rules.add_rule("mes_range", "mes", "range", {"min": 1, "max": 12})
    if dimension == "localidade":
        codes = [code for _, code, _, _ in STATES] + [UNKNOWN_CODE]
        rules.add_rule("uf_format", "sigla_uf", "format", {"pattern": "[A-Z]{2}$"})
        rules.add_rule("uf_values", "sigla_uf", "values", {"values": codes}, "WARNING")
    if dimension == "ies":
        rules.add_rule("nome_length", "des_ies", "length", {"min_length": 3, "max_length": 255}, "WARNING")
    return rules


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Required columns exist and there is at least one row."""
    for column in columns:
        if column not in df.columns:
            raise ValueError(f"required column '{column}' is absent")
    if df.isEmpty():
        raise ValueError("no rows after the transformations")
    return df
