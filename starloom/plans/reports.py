"""Reports (R1-R24).  Each takes the tables it reads and returns the result set.

Report rows are ordered as in the reports, with the group columns as
tie-breakers so that equal counts come out the same every time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.labels import state_code
from starloom.functions.numbers import percentage
from starloom.functions.text import filled, public_or_private
from starloom.operators.aggregates import count_by, distinct_by, profile, top, value_distribution
from starloom.operators.filters import active_only, without_unknown


def _ordered(df: DataFrame, measure: str, keys: Sequence[str]) -> DataFrame:
    return df.orderBy(F.desc(measure), *keys)


def _theme_ids(dim_tema: DataFrame) -> DataFrame:
    # places and themes both have a state, so each side brings only what is read
    return dim_tema.select("tema_sk", "tema_id")


# --- themes on the star -------------------------------------------------------

def themes_by_state_name(fact: DataFrame, dim_tema: DataFrame, dim_localidade: DataFrame) -> DataFrame:
    """R1."""
    # the fact is counted per key pair first, so the dimensions meet the pairs only
    pairs = without_unknown(fact, "tema_sk").groupBy("tema_sk", "localidade_sk").agg(F.count("*").alias("linhas"))
    star = pairs.join(_theme_ids(dim_tema), "tema_sk").join(dim_localidade.select("localidade_sk", "nome_uf"), "localidade_sk")
    counted = distinct_by(star, ["nome_uf"], {"total_temas": "tema_id"}, sums={"total_registros_fato": "linhas"})
    return counted.orderBy("nome_uf")


def macro_theme_sizes(fact: DataFrame, dim_tema: DataFrame) -> DataFrame:
    """R2."""
    # only theme attributes are counted: each theme that the fact uses is needed once
    star = dim_tema.join(fact.select("tema_sk").distinct(), "tema_sk")
    counted = distinct_by(star, ["macrotema_nome"], {"qtd_temas": "tema_nome", "qtd_palavra_chave": "palavra_chave"})
    return _ordered(counted, "qtd_palavra_chave", ["macrotema_nome"])


# A fact of theme-institution pairs has far more rows than keys.  The reports sum it up by whole-number keys in one narrow
# aggregate for each side that is counted, and only what is left meets the names; distinct values of two sides in
# one aggregate would copy each pair three times, with its names.

def _by_theme(fact: DataFrame, *keys: str) -> DataFrame:
    return fact.groupBy(*keys, "tema_sk").agg(F.sum("qtd_registros").alias("qtd_registros"))


def _with_members(counted: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """``counted`` with the distinct institutions of each group; a group without a name is one too."""
    there = members.groupBy(F.col(key).alias("_group")).agg(F.count_distinct("ies_sk").alias("qtd_ies"))
    return counted.join(there, counted[key].eqNullSafe(there["_group"])).drop("_group")


def _of_known_themes(fact: DataFrame, dim_tema: DataFrame) -> DataFrame:
    return fact.join(dim_tema.select("tema_sk"), "tema_sk", "left_semi")


def themes_by_state(fact: DataFrame, dim_tema: DataFrame, dim_localidade: DataFrame) -> DataFrame:
    """R7."""
    places = dim_localidade.select("localidade_sk", "sigla_uf")
    star = _by_theme(fact, "localidade_sk").join(_theme_ids(dim_tema), "tema_sk").join(places, "localidade_sk")
    counted = distinct_by(star, ["sigla_uf"], {"qtd_temas_uf": "tema_id"}, sums={"total_associacoes": "qtd_registros"})
    members = _of_known_themes(fact, dim_tema).select("localidade_sk", "ies_sk").distinct().join(places, "localidade_sk")
    rows = _with_members(counted, members, "sigla_uf").select("sigla_uf", "qtd_temas_uf", "qtd_ies", "total_associacoes")
    return _ordered(rows, "qtd_temas_uf", ["sigla_uf"])


def _category(dim_ies: DataFrame) -> DataFrame:
    return dim_ies.select(
        "ies_sk", "des_ies", public_or_private("des_status_juridico").alias("categoria_administrativa")
    )


def themes_by_category(fact: DataFrame, dim_tema: DataFrame, dim_ies: DataFrame) -> DataFrame:
    """R8."""
    name = "categoria_administrativa"
    categories = _category(dim_ies).drop("des_ies")
    star = _by_theme(fact.join(categories, "ies_sk"), name).join(_theme_ids(dim_tema), "tema_sk")
    counted = distinct_by(star, [name], {"qtd_temas_categoria": "tema_id"}, sums={"total_associacoes": "qtd_registros"})
    members = _of_known_themes(fact, dim_tema).select("ies_sk").distinct().join(categories, "ies_sk")
    rows = _with_members(counted, members, name).select(name, "qtd_temas_categoria", "qtd_ies", "total_associacoes")
    return _ordered(rows, "qtd_temas_categoria", [name])


def themes_by_region(fact: DataFrame, dim_tema: DataFrame, dim_localidade: DataFrame) -> DataFrame:
    """R9."""
    places = dim_localidade.select("localidade_sk", "regiao")
    star = _by_theme(fact, "localidade_sk").join(_theme_ids(dim_tema), "tema_sk").join(places, "localidade_sk")
    counted = distinct_by(
        star, ["regiao"], {"qtd_temas_regiao": "tema_id", "qtd_ufs": "localidade_sk"},
        sums={"total_associacoes": "qtd_registros"},
    )
    return _ordered(counted, "qtd_temas_regiao", ["regiao"])


def top_institutions(
    fact: DataFrame, dim_tema: DataFrame, dim_ies: DataFrame, dim_localidade: DataFrame, k: int | None = 20
) -> DataFrame:
    """All institutions when ``k`` is None."""
    # an institution has many keywords of a theme: they fall together before its names are joined
    themes = fact.join(_theme_ids(dim_tema), "tema_sk").select("ies_sk", "localidade_sk", "tema_id").distinct()
    star = themes.join(_category(dim_ies), "ies_sk").join(dim_localidade.select("localidade_sk", "sigla_uf"), "localidade_sk")
    keys = ["des_ies", "categoria_administrativa", "sigla_uf"]
    ranked = _ordered(distinct_by(star, keys, {"qtd_temas_ies": "tema_id"}), "qtd_temas_ies", keys)
    return ranked if k is None else ranked.limit(k)


# --- themes on the raw tables -------------------------------------------------
#
# Themes and institutions meet through their state.  The reports count distinct
# themes, so both sides are cut to the distinct keys that matter before they
# meet: no report forms the theme-institution pairs.

def raw_themes_by_state(raw_tema: DataFrame) -> DataFrame:
    """R3."""
    return _ordered(distinct_by(raw_tema, ["uf"], {"qtd_temas_por_uf": "tema_id"}), "qtd_temas_por_uf", ["uf"])


def themes_by_group_of_state(
    themes: DataFrame, members: DataFrame, state: str, theme: str, group: Column, name: str, measure: str
) -> DataFrame:
    """Distinct themes per group of the members that share the theme's state."""
    groups = members.select(state, group.alias(name)).distinct()
    return themes.select(state, theme).distinct().join(groups, state).groupBy(name).agg(F.count_distinct(theme).alias(measure))


def raw_themes_by_category(raw_tema: DataFrame, raw_ies: DataFrame, status: str = "status_juridico_ppg") -> DataFrame:
    """R4."""
    counted = themes_by_group_of_state(
        raw_tema, raw_ies, "uf", "tema_id", public_or_private(status), "categoria_administrativa", "qtd_temas_por_categoria"
    )
    return _ordered(counted, "qtd_temas_por_categoria", ["categoria_administrativa"])


def raw_top_institutions(raw_tema: DataFrame, raw_ies: DataFrame, k: int = 20) -> DataFrame:
    """An institution has one state, so its themes are those of the state."""
    per_state = distinct_by(raw_tema.filter("uf IS NOT NULL"), ["uf"], {"qtd_temas_por_ies": "tema_id"})
    keys = ["nome_ies", "uf", "status_juridico_ppg"]
    members = raw_ies.select(*keys).distinct()
    return _ordered(members.join(per_state, "uf").select(*keys, "qtd_temas_por_ies"), "qtd_temas_por_ies", keys).limit(k)


def raw_themes_by_region(raw_tema: DataFrame, dim_localidade: DataFrame) -> DataFrame:
    """States match in any case (Q16)."""
    themes = raw_tema.select(state_code("uf").alias("sigla_uf"), "tema_id")
    places = dim_localidade.filter("localidade_sk > 0")
    counted = themes_by_group_of_state(
        themes, places, "sigla_uf", "tema_id", F.col("regiao"), "regiao", "qtd_temas_por_regiao"
    )
    return _ordered(counted, "qtd_temas_por_regiao", ["regiao"])


# --- goals --------------------------------------------------------------------

def associations_by_type(bridge: DataFrame) -> DataFrame:
    """Active associations per type, largest first."""
    return count_by(active_only(bridge), ["tipo_associacao"])


def associations_by_goal(bridge: DataFrame, dim_ods: DataFrame, k: int = 10) -> DataFrame:
    """Top goals by active associations."""
    counted = active_only(bridge).groupBy("ods_sk").agg(F.count("*").alias("total"))
    named = counted.join(dim_ods.select("ods_sk", "ods_numero", "ods_nome"), "ods_sk")
    return top(named.select("ods_numero", "ods_nome", "total"), k, [F.desc("total"), "ods_numero"])


def associations_by_theme(bridge: DataFrame, dim_tema: DataFrame, k: int = 10) -> DataFrame:
    """Top keywords by active associations."""
    counted = active_only(bridge).groupBy("tema_sk").agg(F.count("*").alias("linhas"))
    named = counted.join(dim_tema.select("tema_sk", "palavra_chave"), "tema_sk")
    summed = named.groupBy("palavra_chave").agg(F.sum("linhas").alias("total"))
    return top(summed, k, [F.desc("total"), "palavra_chave"])


def goals_by_themes(bridge: DataFrame, dim_ods: DataFrame, k: int = 10) -> DataFrame:
    """R12."""
    counted = distinct_by(active_only(bridge), ["ods_sk"], {"total_temas": "tema_sk"}, rows="total_associacoes")
    named = counted.join(dim_ods.select("ods_sk", "ods_numero", "ods_nome"), "ods_sk")
    return top(named.drop("ods_sk"), k, [F.desc("total_temas"), "ods_numero"]).select(
        "ods_numero", "ods_nome", "total_temas", "total_associacoes"
    )


def themes_of_goal(bridge: DataFrame, dim_tema: DataFrame, dim_ods: DataFrame, number: int) -> DataFrame:
    """R13."""
    goal = dim_ods.filter(F.col("ods_numero") == number).select("ods_sk")
    rows = active_only(bridge).join(goal, "ods_sk", "left_semi").join(dim_tema.select("tema_sk", "palavra_chave"), "tema_sk")
    return rows.select("palavra_chave", "tipo_associacao", "nivel_confianca", "observacao").orderBy(
        F.desc("nivel_confianca"), "palavra_chave"
    )


def goal_coverage_by_programme(
    fact: DataFrame, bridge: DataFrame, dim_ods: DataFrame, dim_ppg: DataFrame
) -> DataFrame:
    """Goals per programme with their list in number order.

    The fact shrinks to its distinct (programme, theme) pairs before the bridge
    multiplies it.
    """
    pairs = fact.select("ppg_sk", "tema_sk").distinct()
    goals = active_only(bridge).select("tema_sk", "ods_sk").distinct()
    numbered = dim_ods.select("ods_sk", "ods_numero")
    rows = pairs.join(goals, "tema_sk").join(numbered, "ods_sk").join(dim_ppg.select("ppg_sk", "nome_programa"), "ppg_sk")
    covered = rows.select("nome_programa", "ods_sk", "ods_numero").distinct()
    in_order = F.array_sort(F.collect_set("ods_numero"))
    listed = F.array_join(F.transform(in_order, lambda n: n.cast("string")), ", ")
    result = covered.groupBy("nome_programa").agg(
        F.count_distinct("ods_sk").alias("ods_cobertos"), listed.alias("lista_ods")
    )
    return _ordered(result, "ods_cobertos", ["nome_programa"])


def under_covered_goals(bridge: DataFrame, dim_ods: DataFrame, below: int = 5) -> DataFrame:
    """Goals with few active themes, those without any included."""
    used = active_only(bridge).groupBy("ods_sk").agg(F.count("tema_sk").alias("total_temas"))
    rows = without_unknown(dim_ods, "ods_sk").join(used, "ods_sk", "left")
    counted = rows.select("ods_numero", "ods_nome", "ods_tipo", F.coalesce("total_temas", F.lit(0)).alias("total_temas"))
    return counted.filter(F.col("total_temas") < below).orderBy("total_temas", "ods_numero")


def association_quality(bridge: DataFrame) -> DataFrame:
    """R16, A13."""
    return active_only(bridge).groupBy("tipo_associacao").agg(
        F.count("*").alias("total_associacoes"),
        F.count_distinct("tema_sk").alias("temas_unicos"),
        F.count_distinct("ods_sk").alias("ods_unicos"),
        F.avg("nivel_confianca").alias("media_confianca"),
    )


# --- dimensions ---------------------------------------------------------------

def programmes_by(dim_ppg: DataFrame, column: str, k: int | None = None) -> DataFrame:
    """Programmes per region, modality, status or area."""
    counted = count_by(without_unknown(dim_ppg, "ppg_sk"), [column])
    return counted if k is None else counted.limit(k)


def programme_grades(dim_ppg: DataFrame) -> DataFrame:
    """R17, O4."""
    return value_distribution(without_unknown(dim_ppg, "ppg_sk"), "nota_programa")


def student_profile(dim_discente: DataFrame, with_unknown_member: bool = True) -> DataFrame:
    """R18."""
    rows = dim_discente if with_unknown_member else without_unknown(dim_discente, "discente_sk")
    return rows.agg(
        F.count("*").alias("total_discentes"),
        F.count_distinct("sexo").alias("sexos"),
        F.count_distinct("situacao_discente").alias("situacoes"),
        F.count_distinct("grau_academico").alias("graus"),
        F.min("ano_base").alias("ano_min"),
        F.max("ano_base").alias("ano_max"),
    )


def institutions_by(dim_ies: DataFrame, column: str, k: int | None = None) -> DataFrame:
    """Null groups are not counted."""
    counted = count_by(dim_ies.filter(F.col(column).isNotNull()), [column])
    return counted if k is None else counted.limit(k)


def calendar_summary(dim_tempo: DataFrame) -> DataFrame:
    """The unknown member counts as a day, as in the report."""
    return dim_tempo.agg(
        F.min("ano").alias("ano_min"),
        F.max("ano").alias("ano_max"),
        F.count("*").alias("dias"),
        F.count_if(F.col("fim_de_semana") == "S").alias("dias_fim_de_semana"),
        F.count_if(F.col("fim_de_semana") == "N").alias("dias_uteis"),
    )


def goals_by(dim_ods: DataFrame, column: str) -> DataFrame:
    """R21."""
    return count_by(without_unknown(dim_ods, "ods_sk"), [column])


def goal_list(dim_ods: DataFrame) -> DataFrame:
    """R21."""
    return dim_ods.select("ods_codigo", "ods_nome", "ods_tipo", "ods_categoria").orderBy("ods_codigo")


def places_by_level(dim_localidade: DataFrame) -> DataFrame:
    """R22."""
    grouped = dim_localidade.groupBy("nivel").agg(
        F.count("*").alias("total"), F.count_distinct("regiao").alias("regioes")
    )
    return grouped.orderBy("nivel")


def professor_profile(dim_docente: DataFrame) -> DataFrame:
    """R23."""
    total = F.count("*")
    with_data = F.count_if(filled("tipo_documento"))
    with_grant = F.count_if(F.col("pq_categoria_nivel").isNotNull())
    return dim_docente.agg(
        total.alias("total"),
        F.count_if("bl_doutor").alias("doutores"),
        F.count_if("bl_bolsa_pq").alias("bolsistas"),
        F.count_if("bl_coordenador_ppg").alias("coordenadores"),
        with_data.alias("com_dados_pessoais"),
        percentage(with_data, total).alias("pct_dados_pessoais"),
        with_grant.alias("com_bolsa_registrada"),
        percentage(with_grant, total).alias("pct_bolsa_registrada"),
    )


def raw_profile(raw: DataFrame, counted: Sequence[str], listed: str) -> DataFrame:
    """Rows, distinct counts and the sorted list of a short code column."""
    values = F.array_join(F.transform(F.array_sort(F.collect_set(listed)), lambda v: v.cast("string")), ", ")
    return raw.agg(
        F.count("*").alias("linhas"),
        *[F.count_distinct(c).alias(f"unicos_{c}") for c in counted],
        values.alias(f"lista_{listed}"),
    )


def distinct_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """R24, A12."""
    return profile(df, columns)
