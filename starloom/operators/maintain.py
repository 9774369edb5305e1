"""Changes to the theme-goal bridge (M1-M3), as rewrites ``DataFrame -> DataFrame``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.text import append_note


def insert_missing(bridge: DataFrame, rows: DataFrame, pair=("tema_sk", "ods_sk")) -> DataFrame:
    """M1: add associations whose pair is new."""
    new = rows.dropDuplicates(list(pair)).join(bridge.select(*pair), list(pair), "left_anti")
    return bridge.unionByName(new, allowMissingColumns=True)


def deactivate(bridge: DataFrame, condition: Column, note: Column | str) -> DataFrame:
    """M2: soft delete with an audit note."""
    hit = F.coalesce(condition, F.lit(False))
    return bridge.withColumns({
        "ativo": F.col("ativo") & ~hit,
        "observacao": F.when(hit, append_note("observacao", note)).otherwise(F.col("observacao")),
    })


def promote(
    bridge: DataFrame, reviewed: DataFrame, source: str = "Automática", target: str = "Validada",
    threshold: float = 80.0, confidence: float = 95.0, key: str = "tema_sk",
) -> DataFrame:
    """M3: reviewed automatic associations with enough confidence change type and confidence."""
    marks = reviewed.select(key).distinct().withColumn("_reviewed", F.lit(True))
    hit = (
        (F.col("tipo_associacao") == source)
        & (F.col("nivel_confianca") >= threshold)
        & F.coalesce(F.col("_reviewed"), F.lit(False))
    )
    level = dict(bridge.dtypes)["nivel_confianca"]
    return (
        bridge.join(marks, key, "left")
        .withColumns({
            "tipo_associacao": F.when(hit, target).otherwise(F.col("tipo_associacao")),
            "nivel_confianca": F.when(hit, F.lit(confidence).cast(level)).otherwise(F.col("nivel_confianca")),
        })
        .select(*bridge.columns)
    )
