"""Job template (B23): extract, limit, transform, validate, load."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from starloom.operators.quality import RuleSet, dimension_rules
from starloom.sources.writers import LoadReport, save_parquet, save_table


@dataclass(frozen=True)
class Job:
    """What is built, from what, and where it goes.

    A dimension job names its ``dimension`` and is validated with its standard
    rules; ``rules`` replaces them.  Targets with a slash are parquet folders,
    others are catalog tables.
    """

    target: str
    extract: Callable[[SparkSession], DataFrame]
    transform: Callable[[DataFrame], DataFrame]
    dimension: str | None = None
    rules: RuleSet | None = None
    mode: str = "replace"


@dataclass(frozen=True)
class JobResult:
    data: DataFrame
    checks: list[dict]
    load: LoadReport | None


def run_job(
    spark: SparkSession, job: Job, dry_run: bool = False, limit: int | None = None, skip_load: bool = False
) -> JobResult:
    """Run one job; an ERROR rule stops it before anything is written."""
    source = job.extract(spark)
    if limit is not None:
        source = source.limit(limit)
    data = job.transform(source)
    rules = job.rules or (dimension_rules(job.dimension) if job.dimension else None)
    checks = rules.gate(data) if rules else []
    if dry_run or skip_load:
        return JobResult(data, checks, None)
    save = save_parquet if "/" in job.target else save_table
    return JobResult(data, checks, save(data, job.target, job.mode))
