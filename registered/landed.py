"""Landed JSON of unknown shape: fields found, values that don't fit reported."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registered import load, query
from starloom.plans import raw
from starloom.sources import variants

# --- events whose properties drift -------------------------------------------------

# One user in four writes the number as a number, one as text, one as words with a second field, one as a list; some
# texts are no JSON.

EVENTS_SQL = """
    rows AS (SELECT event_id, user_id % 4 AS how, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type = 'error' AS bad, event_type FROM events),
    kinds AS (
        SELECT event_id, 'k' AS campo, CASE how WHEN 0 THEN 'BIGINT' WHEN 3 THEN 'ARRAY' ELSE 'STRING' END AS tipo FROM rows WHERE NOT (bad AND k > 90)
        UNION ALL SELECT event_id, 'source', 'STRING' FROM rows WHERE how = 2 AND NOT (bad AND k > 90)
    )
"""


def drifting_events(spark, folder):
    events = load(spark, folder, "events")
    k, how = F.get_json_object("props", "$.k"), F.col("user_id") % 4
    text = (
        F.when(how == 0, F.col("props")).when(how == 1, F.concat(F.lit('{"k": " '), k, F.lit('.0"}')))
        .when(how == 2, F.concat(F.lit('{"k": "n/a", "source": "'), "event_type", F.lit('"}')))
        .otherwise(F.concat(F.lit('{"k": ['), k, F.lit("]}")))
    )
    cut = F.when((F.col("event_type") == "error") & (k.cast("int") > 90), F.concat(F.lit("cut "), "props")).otherwise(text)
    return variants.parsed(events.select("event_id", cut.alias("texto")), "texto")


@query(f"WITH {EVENTS_SQL} SELECT campo, tipo, count(*) AS linhas FROM kinds GROUP BY 1, 2")
def event_field_kinds(spark, folder):
    """Fields and kinds of all records."""
    return variants.field_kinds(drifting_events(spark, folder))


def shown(deviations: Column | str) -> Column:
    """Deviations as one text."""
    return F.array_join(F.transform(deviations, lambda d: F.concat_ws(":", d["campo"], d["tipo"], d["texto"])), ";")


@query(f"""
    WITH {EVENTS_SQL}
    SELECT event_id, CASE WHEN NOT (bad AND k > 90) AND how < 2 THEN k END AS k,
           CASE WHEN bad AND k > 90 THEN ':ILEGIVEL' WHEN how = 2 THEN 'k:STRING:n/a;source:STRING:' || event_type
                WHEN how = 3 THEN 'k:ARRAY:[' || k || ']' END AS desvios
    FROM rows
""")
def event_props_typed(spark, folder):
    """Values that the type holds, and all others by name."""
    rows = variants.typed(drifting_events(spark, folder), {"k": "bigint"}, ["event_id"])
    return rows.select("event_id", "k", shown("_desvios").alias("desvios"))


@query(f"""
    WITH {EVENTS_SQL}
    SELECT campo, tipo, count(*) AS linhas FROM (
        SELECT '' AS campo, 'ILEGIVEL' AS tipo FROM rows WHERE bad AND k > 90
        UNION ALL SELECT campo, tipo FROM kinds JOIN rows USING (event_id) WHERE how >= 2
    ) GROUP BY 1, 2
""")
def event_props_deviations(spark, folder):
    return variants.deviations(variants.typed(drifting_events(spark, folder), {"k": "bigint"}, ["event_id"]))


# --- institutions as pages of a feed and of a catalogue -----------------------------

PAGE = 20


def pages_of(rows: DataFrame, record: Column, *groups: str) -> DataFrame:
    """Records as landed pages of ``PAGE`` suppliers; every fifth page failed."""
    number = F.floor(F.col("s_suppkey") / PAGE)
    listed = rows.select(*groups, number.alias("pagina"), record.alias("r")).groupBy(*groups, "pagina").agg(F.array_join(F.collect_list("r"), ", ").alias("l"))
    good = F.when(F.col("pagina") % 5 == 4, "false").otherwise("true")
    text = F.concat(F.lit('{"success": '), good, F.lit(', "result": {"records": ['), "l", F.lit("]}}"))
    return listed.select(*groups, text.alias("texto"))


def member(name: str, value: Column | str, quote: str = "") -> Column:
    return F.concat(F.lit(f'"{name}": {quote}'), value, F.lit(quote))


@query(f"""
    SELECT s_name AS des_entidade, CASE s_suppkey % 4 WHEN 0 THEN s_suppkey WHEN 1 THEN s_suppkey END AS cod_entidade_capes, 2000 + s_nationkey AS an_base,
           CASE WHEN s_suppkey % 7 = 3 THEN true END AS publica,
           CASE s_suppkey % 4 WHEN 2 THEN 'CD_ENTIDADE_CAPES:STRING:sem código' WHEN 3 THEN 'CD_ENTIDADE_CAPES:DECIMAL:' || s_suppkey || '.5' END AS desvios
    FROM supplier WHERE (s_suppkey // {PAGE}) % 5 <> 4
""")
def institution_feed(spark, folder):
    """Codes as numbers, as text, as words and with a fraction; a field of some records, one without any value."""
    key = F.col("s_suppkey").cast("string")
    how = F.col("s_suppkey") % 4
    code = F.when(how == 0, key).when(how == 1, F.concat(F.lit('" '), key, F.lit('.0"'))).when(how == 2, '"sem código"').otherwise(F.concat(key, F.lit(".5")))
    record = F.concat(
        F.lit("{"), member("NM_ENTIDADE", "s_name", '"'), F.lit(", "), member("CD_ENTIDADE_CAPES", code), F.lit(", "),
        member("AN_BASE", (F.col("s_nationkey") + 2000).cast("string"), '"'), F.lit(', "Vazia": null'),
        F.when(F.col("s_suppkey") % 7 == 3, ', "Publica": true').otherwise(""), F.lit("}"),
    )
    rows = raw.raw_ies_pages(pages_of(load(spark, folder, "supplier"), record), "texto")
    return rows.select("des_entidade", "cod_entidade_capes", "an_base", "publica", shown("_desvios").alias("desvios"))


@query(f"""
    WITH kept AS (SELECT * FROM supplier WHERE (s_suppkey // {PAGE}) % 5 <> 4)
    SELECT s_name AS nm_entidade_ensino, s_suppkey AS cd_entidade_ensino, CASE WHEN s_nationkey >= 15 THEN n_name END AS nm_municipio_entidade_ensino,
           CASE WHEN s_nationkey < 15 THEN 2021 ELSE 2022 END AS ano_referencia, CASE WHEN s_nationkey < 15 THEN 2020 END AS an_base
    FROM kept JOIN nation ON s_nationkey = n_nationkey
""")
def institution_catalogue(spark, folder):
    """An older resource of some suppliers and a newer one of all, spelled differently; the third has other columns."""
    suppliers = load(spark, folder, "supplier").join(load(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    key = F.col("s_suppkey").cast("string")
    older = F.concat(F.lit("{"), member("NM_ENTIDADE_ENSINO", "s_name", '"'), F.lit(", "), member("CD_ENTIDADE_ENSINO", key), F.lit(', "ano_base": "2020"}'))
    newer = F.concat(F.lit("{"), member("nome_entidade", "s_name", '"'), F.lit(", "), member("codigo_entidade", key, '"'), F.lit(", "),
                     member("municipio", "n_name", '"'), F.lit("}"))
    other = F.concat(F.lit("{"), member("z", key), F.lit("}"))
    # every supplier stands in each resource that lists it
    copies = suppliers.select("*", F.explode(F.expr("filter(array(0, 1, 2), r -> r > 0 OR s_nationkey < 15)")).alias("ordem"))
    record = F.when(F.col("ordem") == 0, older).when(F.col("ordem") == 1, other).otherwise(newer)
    pages = pages_of(copies, record, "ordem").withColumn("ano", F.when(F.col("ordem") == 0, 2021).otherwise(2022))
    return raw.raw_ies_catalog(pages, "texto", "ordem", "ano").select(
        "nm_entidade_ensino", "cd_entidade_ensino", "nm_municipio_entidade_ensino", "ano_referencia", "an_base"
    )
