"""Dimensions (B7-B17), each with its unknown member at key 0.

Keys follow a stated total order, so two runs on the same input give the same
keys.  Calendar and goals have a fixed size; the others are keyed on all
executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.fixed_values import NOT_INFORMED, POSITION
from starloom.functions import dates, labels, numbers, text
from starloom.operators.consolidate import consolidate
from starloom.operators.dedup import input_order, latest_per_key, one_per_key, without_position
from starloom.operators.filters import at_maximum, is_domestic, is_graduate, with_value, without_unknown
from starloom.operators.keys import small_surrogate_key, surrogate_key, with_unknown
from starloom.operators.lookup import backfill, enrich_by_name, enrich_unique
from starloom.operators.shape import (
    first_present, nulls_filled, present, select_renamed, stack_rows, with_defaults, with_natural_id,
)
from starloom.schemas import TABLES, conform
from starloom.sources import readers

DEFAULT_YEAR = 2025


def _finish(df: DataFrame, dimension: str) -> DataFrame:
    table = f"dim_{dimension}"
    return with_unknown(conform(df, table), dimension)


def dim_tempo(
    spark: SparkSession, first: str | Column = "2013-01-01", last: str | Column = "2027-12-31",
    bounds: DataFrame | None = None,
) -> DataFrame:
    """One row per day."""
    days = small_surrogate_key(readers.days(spark, first, last, bounds), "tempo_sk", ["data"])
    return _finish(days.withColumns(dates.calendar_columns("data")), "tempo")


# Spellings of the columns of the place files.
STATE_COLUMNS = {
    "sigla_uf": ["uf", "sigla", "sigla_uf", "estado_sigla"],
    "nome_uf": ["nome", "nome_uf", "estado", "estado_nome"],
    "codigo_uf": ["codigo_uf", "codigo", "id_uf", "codigo_ibge"],
    "regiao": ["regiao", "região", "region"],
    "latitude": ["latitude", "lat"],
    "longitude": ["longitude", "lon", "lng"],
}
CITY_COLUMNS = {
    "codigo_ibge": ["codigo_ibge", "codigo", "id_municipio"],
    "municipio": ["municipio", "nome_municipio", "nome", "nome_mun", "cidade"],
    "codigo_uf": ["codigo_uf", "uf_id", "id_uf"],
    "latitude": ["latitude", "lat"],
    "longitude": ["longitude", "lon", "lng"],
    "capital": ["capital"],
}


def _aliased(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    return df.select(*[
        (F.col(f"`{source}`") if source else F.lit(None)).cast("string").alias(target)
        for target, source in ((t, first_present(df, c)) for t, c in aliases.items())
    ])


def dim_localidade(spark: SparkSession, cities: DataFrame, states: DataFrame | None = None) -> DataFrame:
    """States, then their municipalities; missing state attributes from the fixed table (Q15)."""
    uf = _aliased(states if states is not None else readers.states(spark), STATE_COLUMNS).withColumns({
        "regiao": F.upper(F.coalesce("regiao", labels.region_of_state("sigla_uf"))),
        "nome_uf": F.coalesce("nome_uf", labels.name_of_state("sigla_uf")),
        "codigo_uf": numbers.to_double("codigo_uf").try_cast("int"),
    })
    state_rows = uf.withColumns({
        "nivel": F.lit("UF"), "capital": F.lit(0), "nome": F.coalesce("nome_uf", "sigla_uf"),
    })
    # one row per state number; first by its abbreviation
    by_number = uf.filter("codigo_uf IS NOT NULL").groupBy("codigo_uf").agg(
        F.min_by(F.struct("sigla_uf", "regiao"), F.col("sigla_uf")).alias("_s")
    ).select("codigo_uf", "_s.*")
    city = _aliased(cities, CITY_COLUMNS)
    number = F.coalesce(
        text.prefix_number("codigo_ibge", 2), numbers.to_double("codigo_uf").try_cast("int")
    )
    city = city.withColumn("codigo_uf", number)
    city = backfill(city, by_number, "codigo_uf", ["sigla_uf", "regiao"])
    city = city.withColumn("sigla_uf", F.coalesce("sigla_uf", labels.state_code_of_ibge("codigo_uf")))
    city = city.withColumn("regiao", F.coalesce("regiao", labels.region_of_state("sigla_uf")))
    names = uf.filter("sigla_uf IS NOT NULL").groupBy("sigla_uf").agg(F.min("nome_uf").alias("nome_uf"))
    city = backfill(city, names, "sigla_uf", ["nome_uf"])
    city_rows = city.withColumns({
        "nivel": F.lit("MUNICIPIO"),
        "nome": F.col("municipio"),
        "capital": numbers.safe_int("capital").cast("int"),
        "codigo_ibge": numbers.to_double("codigo_ibge").try_cast("bigint"),
    })
    both = stack_rows([state_rows, city_rows]).withColumns({
        "sigla_regiao": text.region_initials("regiao"),
        "latitude": numbers.to_double("latitude"),
        "longitude": numbers.to_double("longitude"),
    })
    order = [F.when(F.col("nivel") == "UF", 0).otherwise(1), "sigla_uf", "codigo_ibge", "nome"]
    return _finish(surrogate_key(both, "localidade_sk", order), "localidade")


def dim_tema(raw_tema: DataFrame) -> DataFrame:
    """Distinct theme rows with the state code."""
    columns = ["macrotema_id", "macrotema_nome", "tema_id", "tema_nome", "palavrachave_id", "palavra_chave", "uf"]
    rows = with_defaults(
        raw_tema.withColumnsRenamed({"palavrachave_nome": "palavra_chave"}), {"uf": F.lit(None).cast("string")}
    ).select(*columns).distinct()
    coded = rows.withColumn("sigla_uf", labels.state_code("uf"))
    order = ["tema_id", "palavrachave_id", "macrotema_id", "tema_nome", "palavra_chave", "macrotema_nome", "uf"]
    return _finish(surrogate_key(coded, "tema_sk", order), "tema")


def dim_ods(spark: SparkSession) -> DataFrame:
    """The 20 goals; the key is the goal number."""
    goals = readers.goals(spark)
    full = goals.withColumns({
        "ods_nome": text.title_words(F.trim("ods_nome")),
        "ods_descricao": F.trim("ods_descricao"),
        "ods_codigo": F.concat(F.lit("ODS-"), text.zero_pad("ods_numero", 2)),
        "ods_status": F.lit("Ativo"),
        "ods_categoria": labels.goal_category("ods_numero"),
        "ods_tipo": labels.goal_kind("ods_numero"),
        **labels.goal_macro("ods_numero"),
    })
    return _finish(small_surrogate_key(full, "ods_sk", ["ods_numero"]), "ods")


# Employer and alma-mater columns of the professor file.
EMPLOYER_COLUMNS = {
    "CD_ENTIDADE_CAPES": "cod_entidade_capes",
    "SG_ENTIDADE_ENSINO": "sg_ies",
    "NM_ENTIDADE_ENSINO": "des_ies",
    "NR_CNPJ_IES": "nr_cnpj_ies",
    "CS_STATUS_JURIDICO": "des_status_juridico",
    "DS_DEPENDENCIA_ADMINISTRATIVA": "des_dependencia_adm",
    "NM_REGIAO": "des_regiao",
    "SG_UF_PROGRAMA": "sg_uf",
    "NM_MUNICIPIO_PROGRAMA_IES": "des_municipio_programa",
    "CD_IBGE_PROGRAMA_IES": "cod_ibge_municipio",
}
ALMA_MATER_COLUMNS = {"SG_IES_TITULACAO": "sg_ies", "NM_IES_TITULACAO": "des_ies"}


def dim_ies(professors: DataFrame) -> DataFrame:
    """Institutions as employer or domestic alma mater, consolidated by name."""
    place = {c: c for c in POSITION}
    roles = [select_renamed(professors, {**EMPLOYER_COLUMNS, **place}).withColumn("_papel", F.lit(0))]
    if first_present(professors, ALMA_MATER_COLUMNS):
        country = first_present(professors, ["NM_PAIS_IES_TITULACAO"])
        home = professors.filter(is_domestic(country)) if country else professors
        roles.append(select_renamed(home, {**ALMA_MATER_COLUMNS, **place}).withColumn("_papel", F.lit(1)))
    rows = with_value(stack_rows(roles), "sg_ies", "des_ies")
    attributes = [c for c in rows.columns if c not in (*POSITION, "_papel")]
    # a million professors name few institutions: equal rows shrink before the shuffle
    known = present(rows, POSITION)
    first_seen = F.min(F.struct("_papel", *known) if known else F.col("_papel")).alias("_vista")
    unique = rows.groupBy(*attributes).agg(first_seen)
    ordered = unique.select("*", F.struct("_vista", *attributes).alias("_ordem")).drop("_vista")
    merged = consolidate(ordered, "des_ies", ["_ordem"])
    keyed = surrogate_key(merged, "ies_sk", ["des_ies"])
    trimmed = {c: F.trim(c) for c, kind in keyed.dtypes if kind == "string"}
    codes = {c: numbers.to_double(c).try_cast("int") for c in present(keyed, ["cod_entidade_capes", "cod_ibge_municipio"])}
    return _finish(keyed.withColumns({**trimmed, **codes}), "ies")


# Programme dimension columns from the raw programme table.
PROGRAMME_COLUMNS = {
    "codigo_do_ppg": "codigo_programa",
    "nome_ppg": "nome_programa",
    "nota_do_ppg": "nota_programa",
    "modalidade_do_ppg": "modalidade",
    "situacao_do_ppg": "situacao",
    "programa_em_rede": "programa_em_rede",
    "nome_da_ies": "ies_vinculada",
    "codigo_capes_da_ies": "codigo_ies",
    "uf_da_ies": "uf",
    "nome_da_regiao_da_ies": "regiao",
    "area_de_conhecimento_do_ppg": "area_conhecimento",
    "grande_area_do_ppg": "grande_area",
    "area_de_avaliacao_do_ppg": "area_avaliacao",
    "total_de_cursos_do_ppg": "total_cursos",
    "quantidade_de_docentes_no_ppg": "quantidade_docentes",
    "quantidade_de_discentes_matriculados_no_ppg": "quantidade_discentes",
    "ano_base": "ano_base",
}
PROGRAMME_NUMBERS = ["codigo_ies", "total_cursos", "quantidade_docentes", "quantidade_discentes", "ano_base"]
MODALITY_CODES = {"ACADÊMICO": "Acadêmico", "PROFISSIONAL": "Profissional", "ACADEMICO": "Acadêmico"}
NETWORK_CODES = {"N": "Não", "S": "Sim"}


def dim_ppg(raw_ppg: DataFrame) -> DataFrame:
    """Programmes, the first row per code."""
    rows = with_value(select_renamed(raw_ppg, PROGRAMME_COLUMNS), "codigo_programa")
    unique = one_per_key(rows, ["codigo_programa"], [])
    special = {"codigo_programa", "nota_programa", *PROGRAMME_NUMBERS}
    texts = [c for c in PROGRAMME_COLUMNS.values() if c not in special]
    absent = {c: "Não" if c == "programa_em_rede" else NOT_INFORMED for c in texts}
    full = with_defaults(unique, {**absent, **dict.fromkeys(PROGRAMME_NUMBERS, 0), "nota_programa": 0.0})
    full = full.withColumns({c: text.default_if_blank(c, NOT_INFORMED) for c in texts})
    full = full.withColumns({
        "modalidade": text.recode("modalidade", MODALITY_CODES),
        "programa_em_rede": text.recode("programa_em_rede", NETWORK_CODES),
        "nome_programa": F.upper("nome_programa"),
        "nota_programa": numbers.safe_float("nota_programa"),
        **{c: numbers.safe_int(c) for c in PROGRAMME_NUMBERS},
    })
    return _finish(surrogate_key(full, "ppg_sk", ["codigo_programa"]), "ppg")


# Professor columns from the base file, the raw table and the grants.
PROFESSOR_COLUMNS = {
    "ID_PESSOA": "id_pessoa",
    "NM_DOCENTE": "des_docente",
    "DS_CATEGORIA_DOCENTE": "des_categoria_docente",
    "DS_REGIME_TRABALHO": "des_regime_trabalho",
    "DS_FAIXA_ETARIA": "des_faixa_etaria",
    "TP_SEXO_DOCENTE": "cs_sexo",
    "IN_DOUTOR": "in_doutor",
    "AN_TITULACAO": "an_titulacao",
    "NM_GRAU_TITULACAO": "des_grau_titulacao",
    "NM_AREA_BASICA_TITULACAO": "des_area_titulacao",
    "SG_IES_TITULACAO": "sg_ies_titulacao",
    "CD_CAT_BOLSA_PRODUTIVIDADE": "cod_bolsa_produtividade",
    "IN_COORDENADOR_PPG": "in_coordenador_ppg",
    "ID_LATTES": "id_lattes",
}
PROFESSOR_DETAIL_COLUMNS = {
    "id_pessoa": "id_pessoa",
    "tp_documento_docente": "tipo_documento",
    "nr_documento_docente": "documento_docente",
    "an_nascimento_docente": "ano_nascimento",
    "ds_tipo_nacionalidade_docente": "nacionalidade",
    "nm_pais_nacionalidade_docente": "pais_nacionalidade",
    "ds_tipo_vinculo_docente_ies": "vinculo_ies",
    "nm_ies_titulacao": "nome_ies_titulacao",
    "nm_pais_ies_titulacao": "pais_titulacao",
    "ano_base": "ano_base_mais_recente",
}
GRANT_DETAIL_COLUMNS = {
    "id_lattes": "id_lattes",
    "des_beneficiario": "nome_beneficiario",
    "cod_categoria_nivel": "pq_categoria_nivel",
    "cod_modalidade": "pq_modalidade",
    "des_grande_area": "pq_grande_area",
    "des_area": "pq_area",
    "data_inicio_processo": "pq_data_inicio",
    "data_termino_processo": "pq_data_termino",
}


def professor_base(raw_docente: DataFrame) -> DataFrame:
    """the latest year of the raw table in the shape of the base file."""
    latest = at_maximum(raw_docente, "ano_base")
    names = {c.lower(): c for c in PROFESSOR_COLUMNS if c != "IN_COORDENADOR_PPG"}
    return select_renamed(latest, names).withColumn("IN_COORDENADOR_PPG", F.lit("NÃO"))


def dim_docente(base: DataFrame | None, raw_docente: DataFrame, grants: DataFrame | None = None) -> DataFrame:
    """Professors enriched with personal data and grants; without a base file the latest raw year."""
    source = base if base is not None else professor_base(raw_docente)
    rows = select_renamed(source, {**PROFESSOR_COLUMNS, **{c: c for c in POSITION}})
    rows = rows.withColumn("id_pessoa", text.id_text(rows, "id_pessoa"))
    rows = without_position(one_per_key(with_value(rows, "id_pessoa"), ["id_pessoa"], input_order(rows)))
    rows = with_defaults(rows, {
        "in_doutor": "", "in_coordenador_ppg": "", "cod_bolsa_produtividade": F.lit(None).cast("string"),
        "cs_sexo": F.lit(None).cast("string"),
    }).withColumns({
        "bl_doutor": text.yes_flag("in_doutor"),
        "bl_coordenador_ppg": text.yes_flag("in_coordenador_ppg"),
        "cs_sexo": text.sex_code("cs_sexo"),
    })
    details = select_renamed(raw_docente, PROFESSOR_DETAIL_COLUMNS)
    details = details.withColumn("id_pessoa", text.id_text(details, "id_pessoa"))
    rows = enrich_unique(rows, details, "id_pessoa", [F.desc_nulls_last("ano_base_mais_recente")])
    grant_columns = ["pq_categoria_nivel", "pq_modalidade", "pq_grande_area", "pq_area", "pq_data_inicio", "pq_data_termino"]
    if grants is not None:
        offers = with_value(select_renamed(grants, GRANT_DETAIL_COLUMNS), "id_lattes")
        newest = [F.desc_nulls_last("pq_data_inicio")]
        if "id_lattes" in rows.columns:
            rows = enrich_unique(rows, offers.drop("nome_beneficiario"), "id_lattes", newest)
        else:
            by_researcher = one_per_key(offers, ["id_lattes"], newest)
            rows = enrich_by_name(rows, by_researcher, "des_docente", "nome_beneficiario", newest)
    wanted = [*PROFESSOR_COLUMNS.values(), *PROFESSOR_DETAIL_COLUMNS.values(), *grant_columns]
    rows = with_defaults(rows, {c: F.lit(None).cast("string") for c in wanted})
    granted = text.filled("cod_bolsa_produtividade") | F.col("pq_categoria_nivel").isNotNull()
    rows = rows.withColumns({
        "bl_bolsa_pq": granted,
        **{c: dates.any_timestamp(c).cast("date") for c in ("pq_data_inicio", "pq_data_termino")},
        "an_titulacao": numbers.to_double("an_titulacao").try_cast("int"),
        "ano_nascimento": numbers.to_double("ano_nascimento").try_cast("int"),
    })
    columns = [name for name, _ in TABLES["dim_docente"] if name in rows.columns]
    return _finish(surrogate_key(rows.select(*columns), "docente_sk", ["id_pessoa"]), "docente")


# Student columns and defaults.
STUDENT_COLUMNS = {
    "ID_DISCENTE": "id_discente",
    "ID_PESSOA": "id_pessoa",
    "NM_DISCENTE": "nome_discente",
    "TP_DOCUMENTO_DISCENTE": "tipo_documento",
    "NR_DOCUMENTO_DISCENTE": "numero_documento",
    "TP_SEXO_DISCENTE": "sexo",
    "DT_NASCIMENTO_DISCENTE": "data_nascimento",
    "DS_IDADE_ANOBASE": "idade_ano_base",
    "NM_PAIS_NACIONALIDADE_DISCENTE": "pais_nacionalidade",
    "DS_TIPO_NACIONALIDADE_DISCENTE": "tipo_nacionalidade",
    "NM_RACA_COR": "raca_cor",
    "IN_NECESSIDADE_PESSOAL": "necessidade_especial",
    "ST_INGRESSANTE": "status_ingressante",
    "DS_GRAU_ACADEMICO_DISCENTE": "grau_academico",
    "DT_MATRICULA_DISCENTE": "data_matricula",
    "NM_SITUACAO_DISCENTE": "situacao_discente",
    "DT_SITUACAO_DISCENTE": "data_situacao",
    "DS_FAIXA_ETARIA": "faixa_etaria",
    "NM_ORIENTADOR_PRINCIPAL": "orientador_principal",
    "NM_TESE_DISSERTACAO": "titulo_tese_dissertacao",
    "QT_MES_TITULACAO": "meses_para_titulacao",
    "ID_LATTES": "id_lattes",
    "AN_BASE": "ano_base",
}
STUDENT_DEFAULTS = {
    "nome_discente": NOT_INFORMED,
    "sexo": NOT_INFORMED,
    "pais_nacionalidade": "BRASIL",
    "tipo_nacionalidade": "BRASILEIRA",
    "raca_cor": "NÃO DECLARADO",
    "necessidade_especial": "N",
    "status_ingressante": NOT_INFORMED,
    "grau_academico": NOT_INFORMED,
    "situacao_discente": NOT_INFORMED,
    "faixa_etaria": NOT_INFORMED,
    "orientador_principal": NOT_INFORMED,
    "titulo_tese_dissertacao": NOT_INFORMED,
}


def dim_discente(students: DataFrame) -> DataFrame:
    """The last row per student; newest base year first where no input position is known."""
    rows = select_renamed(students, {**STUDENT_COLUMNS, **{c: c for c in POSITION}})
    rows = with_defaults(rows, {c: F.lit(None).cast("string") for c in STUDENT_COLUMNS.values()})
    rows = rows.withColumns({c: text.id_text(rows, c) for c in ("id_discente", "id_pessoa")})
    last = input_order(rows, last_first=True) or [F.desc_nulls_last("ano_base")]
    unique = without_position(one_per_key(with_value(rows, "id_discente"), ["id_discente"], last))
    clean = nulls_filled(unique, STUDENT_DEFAULTS).withColumns({
        "meses_para_titulacao": numbers.safe_int("meses_para_titulacao"),
        "idade_ano_base": numbers.safe_int("idade_ano_base"),
        "ano_base": numbers.safe_int("ano_base", DEFAULT_YEAR),
        **{c: dates.any_timestamp(c).cast("date") for c in ("data_nascimento", "data_matricula", "data_situacao")},
    })
    return _finish(surrogate_key(clean, "discente_sk", ["id_discente"]), "discente")


# Graduate columns that are called otherwise for students, and defaults.
GRADUATE_COLUMNS = {
    "id_discente": "id_discente_original",
    "nome_discente": "nome_titulado",
    "grau_academico": "grau_titulacao",
    "situacao_discente": "situacao_titulacao",
    "data_situacao": "data_titulacao",
    "titulo_tese_dissertacao": "titulo_trabalho_final",
}
GRADUATE_DEFAULTS = {
    "nome_titulado": NOT_INFORMED,
    "sexo": NOT_INFORMED,
    "pais_nacionalidade": "BRASIL",
    "raca_cor": "NÃO DECLARADO",
    "grau_titulacao": NOT_INFORMED,
    "situacao_titulacao": "TITULADO",
    "faixa_etaria": NOT_INFORMED,
    "orientador_principal": NOT_INFORMED,
    "titulo_trabalho_final": NOT_INFORMED,
}


def dim_titulado(students: DataFrame) -> DataFrame:
    """Graduates among the students of the student dimension."""
    graduates = without_unknown(students, "discente_sk").filter(
        is_graduate("grau_academico", "situacao_discente", "meses_para_titulacao")
    )
    rows = graduates.withColumnsRenamed(GRADUATE_COLUMNS)
    unique = latest_per_key(rows, ["id_discente_original"], ["ano_base"]).drop("discente_sk")
    clean = nulls_filled(unique, GRADUATE_DEFAULTS).withColumns({
        "meses_para_titulacao": numbers.safe_int("meses_para_titulacao"),
        "idade_ano_base": numbers.safe_int("idade_ano_base"),
        "ano_base": numbers.safe_int("ano_base", DEFAULT_YEAR),
    }).withColumns({
        "anos_para_titulacao": numbers.months_to_years("meses_para_titulacao"),
        "nivel_titulacao": text.degree_level("grau_titulacao"),
    })
    return _finish(surrogate_key(clean, "titulado_sk", [F.desc("ano_base"), "id_discente_original"]), "titulado")


# Post-doc columns and defaults.
POSTDOC_COLUMNS = {
    "ID_POS_DOC": "id_posdoc",
    "NM_PESSOA_POS_DOC": "nome_posdoc",
    "NM_TP_IDENTIFICADOR": "tipo_documento",
    "NR_DOCUMENTO": "numero_documento",
    "TP_SEXO": "sexo",
    "DT_NASCIMENTO": "data_nascimento",
    "NM_PAIS_NACIONALIDADE": "pais_nacionalidade",
    "DH_INICIO_POS_DOC": "data_inicio",
    "DH_FIM_POS_DOC": "data_termino",
    "NR_ORCID_POS_DOC": "id_lattes",
    "AN_BASE": "ano_base",
    "NM_AREA_AVALIACAO": "area_avaliacao",
}
POSTDOC_DEFAULTS = {
    "nome_posdoc": NOT_INFORMED,
    "sexo": NOT_INFORMED,
    "pais_nacionalidade": "BRASIL",
    "tipo_documento": "CPF",
    "numero_documento": "00000000000",
}


def dim_posdoc(postdocs: DataFrame) -> DataFrame:
    """Post-docs, newest row per id, with age, age band, status and length of stay (Q21, Q22)."""
    rows = postdocs.withColumnsRenamed({k: v for k, v in POSTDOC_COLUMNS.items() if k in postdocs.columns})
    rows = with_natural_id(rows, "id_posdoc", "posdoc")
    rows = with_defaults(rows.select(*present(rows, POSTDOC_COLUMNS.values())), {
        "data_nascimento": F.lit(None).cast("string"), "data_inicio": F.lit(None).cast("string"),
        "data_termino": F.lit(None).cast("string"), "ano_base": F.lit(None).cast("string"),
    })
    rows = rows.withColumn("id_posdoc", text.id_text(rows, "id_posdoc"))
    unique = latest_per_key(with_value(rows, "id_posdoc"), ["id_posdoc"], ["ano_base"])
    clean = nulls_filled(unique, POSTDOC_DEFAULTS).withColumns({
        "ano_base": numbers.safe_int("ano_base", DEFAULT_YEAR),
        "situacao_posdoc": dates.stay_status("data_termino"),
        **{c: dates.any_timestamp(c) for c in ("data_nascimento", "data_inicio", "data_termino")},
    })
    clean = clean.withColumn("idade_ano_base", dates.age_in_year("ano_base", "data_nascimento")).withColumns({
        "id_pessoa": F.col("id_posdoc"),
        "raca_cor": F.lit("NÃO DECLARADO"),
        "faixa_etaria": dates.age_band("idade_ano_base"),
        "orientador_principal": F.lit(NOT_INFORMED),
        "area_concentracao": F.col("area_avaliacao") if "area_avaliacao" in clean.columns else F.lit(NOT_INFORMED),
        "meses_duracao": dates.months_between_days("data_inicio", "data_termino"),
    })
    return _finish(surrogate_key(clean, "posdoc_sk", [F.desc("ano_base"), "id_posdoc"]), "posdoc")


# Production columns (several sources of one target are coalesced in this order), defaults.
PRODUCTION_COLUMNS = {
    "ID_ADD_PRODUCAO": "id_producao",
    "ID_ADD_PRODUCAO_INTELECTUAL": "id_producao",
    "NM_TIPO_PRODUCAO": "tipo_producao",
    "NM_SUBTIPO_PRODUCAO": "subtipo_producao",
    "DS_TITULO": "titulo_producao",
    "AN_BASE": "ano_producao",
    "AN_PRODUCAO": "ano_producao",
    "AN_BASE_PRODUCAO": "ano_base",
    "ano_base": "ano_base",
    "NM_PERIODICO": "nome_periodico",
    "DS_ISSN": "issn",
    "DS_ISBN": "isbn",
    "DS_DOI": "doi",
    "NM_EDITORA": "editora",
    "SG_PAIS_PUBLICACAO": "pais_publicacao",
    "NM_IDIOMA": "idioma",
    "DS_NATUREZA": "natureza_producao",
    "DS_MEIO_DIVULGACAO": "meio_divulgacao",
}
PRODUCTION_TITLES = {
    "tipo_producao": NOT_INFORMED,
    "subtipo_producao": NOT_INFORMED,
    "titulo_producao": "SEM TÍTULO",
}
PRODUCTION_DEFAULTS = {
    "nome_periodico": NOT_INFORMED,
    "issn": "",
    "isbn": "",
    "doi": "",
    "editora": NOT_INFORMED,
    "pais_publicacao": "BRA",
    "idioma": "PORTUGUÊS",
    "natureza_producao": NOT_INFORMED,
    "meio_divulgacao": NOT_INFORMED,
}


def dim_producao(productions: DataFrame) -> DataFrame:
    """Productions of several years, the newest row per id."""
    ids = [c for c, target in PRODUCTION_COLUMNS.items() if target == "id_producao"]
    texts = productions.select(*[
        (text.id_text(productions, c) if c in ids else F.col(c).cast("string")).alias(c) for c in productions.columns
    ])
    rows = select_renamed(texts, PRODUCTION_COLUMNS)
    rows = with_defaults(rows, {**PRODUCTION_TITLES, "ano_producao": "0", "ano_base": "0"})
    rows = with_value(rows, "id_producao")
    rows = nulls_filled(rows, PRODUCTION_TITLES).withColumns({
        "ano_producao": numbers.safe_int("ano_producao").cast("int"),
        "ano_base": text.zero_pad(numbers.safe_int("ano_base"), 4),
    })
    listed = {c: F.trim(F.coalesce(c, F.lit(d))) for c, d in PRODUCTION_DEFAULTS.items() if c in rows.columns}
    rows = rows.withColumns(listed) if listed else rows
    unique = latest_per_key(rows, ["id_producao"], ["ano_base", "ano_producao"])
    order = [F.desc("ano_base"), F.desc("ano_producao"), "id_producao"]
    return _finish(surrogate_key(unique, "producao_sk", order), "producao")
