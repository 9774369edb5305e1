"""Facts (B18-B22)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.fixed_values import GOAL_DESCRIPTORS, GOALS, NOT_INFORMED
from starloom.functions import numbers, text
from starloom.functions.labels import match_note, state_code
from starloom.operators.keys import surrogate_key
from starloom.operators.lookup import attach_bridge, chosen_lookup, key_table, lookup_sk, lookup_sk_fallback, lookup_sk_priority
from starloom.operators.match import match_fixed_targets
from starloom.operators.registry import lookup_many
from starloom.operators.shape import (
    first_filled, light_name, present, rename_all, resolve_aliases, snake_name, standard_sk, with_defaults,
)
from starloom.plans.factored import ThemeFactors
from starloom.schemas import conform


def _with_row_id(fact: DataFrame, name: str, how: str | None) -> DataFrame:
    """K4: 'dense' ids 1..n in content order, 'unique' ids without any shuffle, or none."""
    if how == "dense":
        return surrogate_key(fact, name, fact.columns)
    if how == "unique":
        return fact.withColumn(name, F.monotonically_increasing_id() + 1)
    return fact


def year_keys(dim_tempo: DataFrame) -> DataFrame:
    """Q2: the key of a year is that of its last day."""
    return dim_tempo.filter("tempo_sk > 0").groupBy("ano").agg(F.max("tempo_sk").alias("tempo_sk"))


def year_key(dim_tempo: DataFrame, year: Column) -> Column:
    """Q2 without a join: the few years of a calendar are one map, a year that it lacks gives 0."""
    years = year_keys(dim_tempo.filter("ano IS NOT NULL"))
    keys = years.agg(F.map_from_entries(F.collect_list(F.struct("ano", "tempo_sk"))).alias("keys")).scalar()
    return F.coalesce(keys[year], F.lit(0))


# Role column of an authorship row, dimension, key.
AUTHOR_ROLES = {
    "docente": "ID_PESSOA_DOCENTE",
    "discente": "ID_PESSOA_DISCENTE",
    "posdoc": "ID_PESSOA_POS_DOC",
    "titulado": "ID_PESSOA_EGRESSO",
}


def fact_producao(authors: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """One row per authorship; each role looked up by person id, 0 when it has none."""
    fact = authors.select(
        F.col("ID_ADD_PRODUCAO_INTELECTUAL").cast("bigint").alias("producao_id"),
        F.col("AN_BASE_PRODUCAO").cast("int").alias("ano_base"),
        F.col("ID_TIPO_PRODUCAO").alias("tipo_producao"),
        F.col("ID_SUBTIPO_PRODUCAO").alias("subtipo_producao"),
        text.author_type("TP_AUTOR").alias("tipo_autor"),
        F.col("NR_ORDEM").alias("ordem_autor"),
        *[text.id_text(authors, column).alias(column) for column in AUTHOR_ROLES.values()],
    )
    fact = fact.withColumn("tempo_sk", year_key(dims["tempo"], F.col("ano_base")))
    people = {
        f"{dimension}_sk": (F.col(column), key_table(dims[dimension], text.id_text(dims[dimension], "id_pessoa"), f"{dimension}_sk", clean=None))
        for dimension, column in AUTHOR_ROLES.items() if dimension in dims
    }
    fact = lookup_many(fact, people)
    fact = fact.withColumns({f"{d}_sk": F.lit(0) for d in AUTHOR_ROLES if d not in dims})
    return conform(fact.withColumns({"localidade_sk": F.lit(0), "qtd_producao": F.lit(1)}), "fact_producao")


def author_coverage(fact: DataFrame) -> DataFrame:
    """A10: rows with a known author per role, and in any role."""
    keys = ["docente_sk", "discente_sk", "titulado_sk", "posdoc_sk"]
    known_any = F.greatest(*keys) > 0
    return fact.agg(
        F.count("*").alias("total"),
        *[F.count_if(F.col(k) > 0).alias(f"com_{k[:-3]}") for k in keys],
        F.count_if(known_any).alias("com_algum_autor"),
    )


# Spellings of the authorship columns after name standardisation.
AUTHORSHIP_ALIASES = {
    "producao_id": ["id_add_producao_intelectual", "id_producao", "id_producao_autor"],
    "ano_base": ["an_base_producao", "ano_base", "an_base"],
    "codigo_programa": ["cd_programa", "cd_programa_ies", "codigo_programa"],
    "codigo_ies": ["cd_entidade_capes", "codigo_capes_da_ies", "codigo_ies"],
    "sigla_ies": ["sg_ies", "sigla_ies"],
    "tema_id": ["tema_id", "id_tema", "tema", "tema_codigo"],
    "palavra_chave": ["palavra_chave", "palavrachave_nome", "palavras_chave", "keyword"],
    "tipo_autor": ["tp_autor", "tipo_autor"],
    "ordem_autor": ["nr_ordem", "ordem_autor"],
    "docente_id": ["id_pessoa_docente", "id_docente", "docente_id"],
    "discente_id": ["id_pessoa_discente", "id_discente"],
    "titulado_id": ["id_pessoa_egresso", "id_pessoa_titulado"],
    "posdoc_id": ["id_pessoa_pos_doc", "id_posdoc"],
    "fonte_dados": ["fonte_dados"],
}
# Per dimension the fact columns to try and the dimension columns to search (Q3, Q5).
AUTHORSHIP_LOOKUPS = {
    "tema": (["tema_id", "palavra_chave"], ["tema_id", "palavrachave_id", "palavra_chave"]),
    "ppg": (["codigo_programa"], ["codigo_programa", "codigo_do_ppg"]),
    "ies": (["codigo_ies", "sigla_ies"], ["cod_entidade_capes", "sg_ies"]),
    "docente": (["docente_id"], ["id_pessoa", "id_docente"]),
    "discente": (["discente_id"], ["id_pessoa", "id_discente"]),
    "titulado": (["titulado_id"], ["id_pessoa"]),
    "posdoc": (["posdoc_id"], ["id_pessoa"]),
}
PERSON_ROLES = ("docente", "discente", "titulado", "posdoc")
AUTHORSHIP_SOURCE = "add_producao_autor"


def fact_producao_tema(
    authors: DataFrame, dims: Mapping[str, DataFrame], bridge: DataFrame | None = None, row_id: str | None = "unique"
) -> DataFrame:
    """Authorship by theme and goal; distinct rows, ``ods_sk`` in the grain (Q6)."""
    named = rename_all(authors, snake_name)
    source = resolve_aliases(named, AUTHORSHIP_ALIASES)
    fact = source
    if dims.get("tempo") is not None:
        year = numbers.whole_number(source, "ano_base").cast("int")
        fact = fact.withColumn("tempo_sk", year_key(dims["tempo"], year))
    keyed = {}
    for dimension, (candidates, searched) in AUTHORSHIP_LOOKUPS.items():
        sk = f"{dimension}_sk"
        dim = dims.get(dimension)
        if dim is None:
            fact = fact.withColumn(sk, F.lit(0))
            continue
        # only candidates that the source really has; a choice among several costs one look at the data
        real = [c for c in candidates if present(named, AUTHORSHIP_ALIASES[c])]
        key = first_filled(source, real)
        if dimension in PERSON_ROLES:
            chosen = chosen_lookup(source, standard_sk(dim, dimension), key, searched, sk)
            if chosen is None:
                fact = fact.withColumn(sk, F.lit(0))
            else:
                keyed[sk] = chosen
        else:
            fact = lookup_sk_fallback(fact, standard_sk(dim, dimension), key, searched, sk, probe=source)
    fact = lookup_many(fact, keyed)
    fact = with_defaults(fact, {"tempo_sk": 0}).select(
        numbers.whole_number(source, "producao_id").alias("producao_id"),
        *[numbers.at_least_zero(f"{d}_sk").cast("int").alias(f"{d}_sk") for d in ("tempo", *AUTHORSHIP_LOOKUPS)],
        F.coalesce("tipo_autor", F.lit(NOT_INFORMED)).alias("tipo_autor"),
        numbers.whole_number(source, "ordem_autor").cast("int").alias("ordem_autor"),
        F.lit(1).alias("qtd_autores"),
        F.lit(1).alias("qtd_producoes"),
        numbers.whole_number(source, "ano_base").cast("int").alias("ano_base"),
        F.coalesce("fonte_dados", F.lit(AUTHORSHIP_SOURCE)).alias("fonte_dados"),
    )
    # equal rows fall together before the goals multiply them
    fact = fact.distinct()
    fact = attach_bridge(fact, bridge, "tema_sk", "ods_sk") if bridge is not None else fact.withColumn("ods_sk", F.lit(0))
    return conform(_with_row_id(fact, "producao_tema_id", row_id), "fact_producao_tema")


GRADUATION_SOURCE = "mapeamentos_titulados_2023"
GRADUATION_SCORES = ["score_title", "score_abstract", "score_keywords", "score_final"]
GRADUATION_TEXTS = ["hash_id", "uf_tema", "uf_pesquisador", "modelo_explicacao", "modelo_erro", "model"]


def fact_titulacao(
    mappings: DataFrame, dims: Mapping[str, DataFrame | None], base_year: int = 2023, row_id: str | None = "unique"
) -> DataFrame:
    """Graduates by theme with model scores and match status."""
    rows = with_defaults(rename_all(mappings, light_name), {
        **dict.fromkeys(GRADUATION_SCORES, 0.0), **dict.fromkeys(GRADUATION_TEXTS, ""),
        "tema_id": 0, "modelo_nivel": "NA", "fonte_dados": GRADUATION_SOURCE,
    })
    states = ("uf_tema", "uf_pesquisador")
    rows = rows.select(
        F.trim(F.coalesce(F.col("hash_id").cast("string"), F.lit(""))).alias("hash_id"),
        numbers.safe_int("tema_id").cast("int").alias("tema_id"),
        F.lit(base_year).alias("ano_base"),
        *[F.when(F.trim(F.coalesce(c, F.lit(""))) == "", "").otherwise(state_code(c)).alias(c) for c in states],
        *[numbers.safe_float(c).alias(c) for c in GRADUATION_SCORES],
        F.upper(F.coalesce("modelo_nivel", F.lit("NA"))).alias("modelo_nivel"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("modelo_explicacao", "modelo_erro", "model")],
        F.coalesce("fonte_dados", F.lit(GRADUATION_SOURCE)).alias("fonte_dados"),
    )
    zero = F.lit(0)
    tempo, tema = dims.get("tempo"), dims.get("tema")
    # one year for all rows: its key is a scalar, no join of the fact
    day = tempo.filter((F.col("tempo_sk") > 0) & (F.col("ano") == base_year)).agg(F.max("tempo_sk").alias("tempo_sk")).scalar() if tempo is not None else zero
    rows = rows.withColumn("tempo_sk", F.coalesce(day, zero))
    rows = lookup_sk(rows, tema, F.col("tema_id"), F.col("tema_id"), "tema_sk", clean=None) if tema is not None else rows.withColumn("tema_sk", zero)
    searched = ["id_discente_original", "id_pessoa", "id_lattes"]
    rows = lookup_sk_priority(rows, dims.get("titulado"), "hash_id", searched, "titulado_sk")
    return conform(_with_row_id(rows, "titulacao_id", row_id), "fact_titulacao")


def goal_targets() -> list[tuple[int, str, str]]:
    return [(number, GOAL_DESCRIPTORS[number], name) for number, name, _, _ in GOALS]


def fact_tema_ods(dim_tema: DataFrame, row_id: str | None = "dense", day: Column | None = None) -> DataFrame:
    """Automatic theme-goal associations from keywords, one for each pair (D5), ids 1..n in their order (K4)."""
    themes = dim_tema.filter("tema_sk > 0").select("tema_sk", "palavra_chave")
    matched = match_fixed_targets(themes, "palavra_chave", goal_targets())
    # of several matches of a pair the surest stays, then the first by its keyword
    surest = F.min(F.struct((-F.col("nivel_confianca")).alias("_order"), "palavra_chave", "nivel_confianca")).alias("_m")
    pairs = matched.groupBy("tema_sk", "ods_sk").agg(surest).select("tema_sk", "ods_sk", "_m.palavra_chave", "_m.nivel_confianca")
    rows = pairs.select(
        "tema_sk", "ods_sk",
        F.lit("Automática").alias("tipo_associacao"),
        "nivel_confianca",
        (day if day is not None else F.current_date()).alias("data_associacao"),
        F.lit("Sistema").alias("usuario_associacao"),
        match_note(F.lower("palavra_chave")).alias("observacao"),
        F.lit(True).alias("ativo"),
    )
    keyed = surrogate_key(rows, "tema_ods_id", ["tema_sk", "ods_sk"]) if row_id == "dense" else _with_row_id(rows, "tema_ods_id", row_id)
    return conform(keyed, "fact_tema_ods")


def bridge_summary(bridge: DataFrame) -> DataFrame:
    """Associations, themes and goals covered, mean goals per theme."""
    counted = bridge.agg(
        F.count("*").alias("associacoes"),
        F.count_distinct("tema_sk").alias("temas"),
        F.count_distinct("ods_sk").alias("ods"),
    )
    return counted.withColumn("media_ods_por_tema", F.col("associacoes") / F.nullif(F.col("temas"), F.lit(0)))


def fact_temas(
    raw_tema: DataFrame, dim_tema: DataFrame, dim_ies: DataFrame, dim_localidade: DataFrame, dim_tempo: DataFrame,
    year: int = 2025,
) -> DataFrame:
    """Presence of a theme at each institution of its state.

    The pairs are the rows of this fact; reports that only count them read the factors.
    """
    pairs = ThemeFactors.of(raw_tema, dim_tema, dim_ies, dim_localidade).pairs()
    day = dim_tempo.filter(F.col("ano") == year).agg(F.min("tempo_sk").alias("tempo_sk"))
    # the key of the year is one value: a scalar subquery, no join
    presence = {c: F.lit(1) for c in ("presente_na_uf", "presente_na_categoria", "presente_na_ies", "presente_na_regiao")}
    return conform(pairs.withColumns({"tempo_sk": day.scalar(), **presence, "qtd_registros": F.lit(1)}), "fact_temas")
