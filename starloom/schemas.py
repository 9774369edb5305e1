"""Target schemas, one per table: ``(column, SQL type)`` in stored order.

A ``varchar(n)`` type means: store a string of at most ``n`` characters.  Only the tables in
``CUT_TABLES`` shorten longer texts (P15), and never their keys; elsewhere a longer text is an error.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Table layouts.
TABLES: dict[str, list[tuple[str, str]]] = {
    "dim_tempo": [
        ("tempo_sk", "int"), ("data", "date"), ("ano", "int"), ("semestre", "int"), ("trimestre", "int"),
        ("mes", "int"), ("dia", "int"), ("dia_semana", "varchar(20)"), ("fim_de_semana", "varchar(1)"),
    ],
    "dim_localidade": [
        ("localidade_sk", "int"), ("sigla_uf", "varchar(2)"), ("nome_uf", "varchar(100)"),
        ("regiao", "varchar(20)"), ("sigla_regiao", "varchar(3)"), ("latitude", "decimal(10,7)"),
        ("longitude", "decimal(10,7)"), ("nivel", "varchar(40)"), ("municipio", "varchar(120)"),
        ("codigo_ibge", "bigint"), ("capital", "smallint"), ("nome", "varchar(120)"),
    ],
    "dim_tema": [
        ("tema_sk", "int"), ("macrotema_id", "int"), ("macrotema_nome", "varchar(255)"), ("tema_id", "int"),
        ("tema_nome", "varchar(255)"), ("palavrachave_id", "int"), ("palavra_chave", "varchar(255)"),
        ("sigla_uf", "varchar(2)"),
    ],
    "dim_ods": [
        ("ods_sk", "int"), ("ods_numero", "int"), ("ods_nome", "varchar(255)"), ("ods_descricao", "string"),
        ("ods_codigo", "varchar(20)"), ("ods_status", "varchar(50)"), ("ods_categoria", "varchar(50)"),
        ("ods_macrocategoria", "varchar(60)"), ("ods_associados", "string"), ("ods_foco_principal", "string"),
        ("ods_tipo", "varchar(50)"),
    ],
    "dim_ies": [
        ("ies_sk", "int"), ("cod_entidade_capes", "int"), ("sg_ies", "varchar(50)"), ("des_ies", "varchar(255)"),
        ("des_status_juridico", "varchar(100)"), ("des_dependencia_adm", "varchar(100)"),
        ("nr_cnpj_ies", "varchar(20)"), ("des_regiao", "varchar(50)"), ("sg_uf", "varchar(2)"),
        ("des_municipio_programa", "varchar(100)"), ("cod_ibge_municipio", "int"),
    ],
    "dim_ppg": [
        ("ppg_sk", "int"), ("codigo_programa", "varchar(50)"), ("nome_programa", "varchar(500)"),
        ("nota_programa", "decimal(3,1)"), ("modalidade", "varchar(50)"), ("situacao", "varchar(50)"),
        ("programa_em_rede", "varchar(50)"), ("ies_vinculada", "varchar(500)"), ("codigo_ies", "int"),
        ("uf", "varchar(20)"), ("regiao", "varchar(50)"), ("area_conhecimento", "varchar(200)"),
        ("grande_area", "varchar(200)"), ("area_avaliacao", "varchar(200)"), ("total_cursos", "int"),
        ("quantidade_docentes", "int"), ("quantidade_discentes", "int"), ("ano_base", "int"),
    ],
    "dim_docente": [
        ("docente_sk", "int"), ("id_pessoa", "varchar(50)"), ("des_docente", "varchar(255)"),
        ("des_categoria_docente", "string"), ("des_regime_trabalho", "string"), ("des_faixa_etaria", "string"),
        ("cs_sexo", "varchar(1)"), ("bl_doutor", "boolean"), ("an_titulacao", "int"),
        ("des_grau_titulacao", "varchar(100)"), ("des_area_titulacao", "varchar(255)"),
        ("sg_ies_titulacao", "varchar(20)"), ("bl_bolsa_pq", "boolean"),
        ("cod_bolsa_produtividade", "varchar(20)"), ("bl_coordenador_ppg", "boolean"),
        ("id_lattes", "varchar(50)"), ("tipo_documento", "varchar(50)"), ("documento_docente", "varchar(50)"),
        ("ano_nascimento", "int"), ("nacionalidade", "string"), ("pais_nacionalidade", "varchar(100)"),
        ("vinculo_ies", "string"), ("nome_ies_titulacao", "string"), ("pais_titulacao", "string"),
        ("pq_categoria_nivel", "varchar(50)"), ("pq_modalidade", "string"), ("pq_grande_area", "string"),
        ("pq_area", "varchar(255)"), ("pq_data_inicio", "date"), ("pq_data_termino", "date"),
        ("ano_base_mais_recente", "int"),
    ],
    "dim_discente": [
        ("discente_sk", "int"), ("id_discente", "varchar(50)"), ("id_pessoa", "varchar(50)"),
        ("nome_discente", "varchar(255)"), ("tipo_documento", "varchar(20)"), ("numero_documento", "varchar(50)"),
        ("sexo", "varchar(20)"), ("data_nascimento", "date"), ("idade_ano_base", "int"),
        ("pais_nacionalidade", "varchar(100)"), ("tipo_nacionalidade", "varchar(50)"), ("raca_cor", "varchar(50)"),
        ("necessidade_especial", "varchar(5)"), ("status_ingressante", "varchar(50)"),
        ("grau_academico", "varchar(50)"), ("data_matricula", "date"), ("situacao_discente", "varchar(100)"),
        ("data_situacao", "date"), ("faixa_etaria", "varchar(50)"), ("orientador_principal", "varchar(255)"),
        ("titulo_tese_dissertacao", "string"), ("meses_para_titulacao", "int"), ("id_lattes", "varchar(50)"),
        ("ano_base", "int"),
    ],
    "dim_titulado": [
        ("titulado_sk", "int"), ("id_discente_original", "varchar(50)"), ("id_pessoa", "varchar(50)"),
        ("nome_titulado", "varchar(255)"), ("tipo_documento", "varchar(50)"), ("numero_documento", "varchar(50)"),
        ("sexo", "varchar(20)"), ("data_nascimento", "date"), ("idade_ano_base", "int"),
        ("pais_nacionalidade", "varchar(100)"), ("raca_cor", "varchar(50)"), ("grau_titulacao", "varchar(100)"),
        ("nivel_titulacao", "varchar(20)"), ("data_matricula", "date"), ("situacao_titulacao", "varchar(100)"),
        ("data_titulacao", "date"), ("faixa_etaria", "varchar(50)"), ("orientador_principal", "varchar(255)"),
        ("titulo_trabalho_final", "string"), ("meses_para_titulacao", "int"),
        ("anos_para_titulacao", "decimal(4,1)"), ("id_lattes", "varchar(50)"), ("ano_base", "int"),
    ],
    "dim_posdoc": [
        ("posdoc_sk", "int"), ("id_posdoc", "varchar(50)"), ("id_pessoa", "varchar(50)"),
        ("nome_posdoc", "varchar(255)"), ("tipo_documento", "varchar(50)"), ("numero_documento", "varchar(50)"),
        ("sexo", "varchar(20)"), ("data_nascimento", "date"), ("idade_ano_base", "int"),
        ("pais_nacionalidade", "varchar(100)"), ("raca_cor", "varchar(50)"), ("data_inicio", "date"),
        ("data_termino", "date"), ("situacao_posdoc", "varchar(100)"), ("faixa_etaria", "varchar(50)"),
        ("orientador_principal", "varchar(255)"), ("area_concentracao", "varchar(255)"), ("meses_duracao", "int"),
        ("id_lattes", "varchar(50)"), ("ano_base", "int"),
    ],
    "dim_producao": [
        ("producao_sk", "int"), ("id_producao", "varchar(50)"), ("tipo_producao", "varchar(100)"),
        ("subtipo_producao", "varchar(100)"), ("titulo_producao", "varchar(500)"), ("ano_producao", "int"),
        ("nome_periodico", "varchar(300)"), ("issn", "varchar(20)"), ("isbn", "varchar(20)"), ("doi", "varchar(100)"),
        ("editora", "varchar(200)"), ("pais_publicacao", "varchar(10)"), ("idioma", "varchar(50)"),
        ("natureza_producao", "varchar(100)"), ("meio_divulgacao", "varchar(100)"), ("ano_base", "varchar(4)"),
    ],
    "fact_producao": [
        ("producao_id", "bigint"), ("tempo_sk", "int"), ("docente_sk", "int"), ("discente_sk", "int"),
        ("titulado_sk", "int"), ("posdoc_sk", "int"), ("localidade_sk", "int"), ("tipo_producao", "int"),
        ("subtipo_producao", "int"), ("tipo_autor", "varchar(50)"), ("ordem_autor", "int"), ("qtd_producao", "int"),
    ],
    "fact_producao_tema": [
        ("producao_tema_id", "bigint"), ("producao_id", "bigint"), ("tempo_sk", "int"), ("tema_sk", "int"),
        ("ods_sk", "int"), ("ppg_sk", "int"), ("ies_sk", "int"), ("docente_sk", "int"), ("discente_sk", "int"),
        ("titulado_sk", "int"), ("posdoc_sk", "int"), ("tipo_autor", "varchar(100)"), ("ordem_autor", "int"),
        ("qtd_autores", "int"), ("qtd_producoes", "int"), ("ano_base", "int"), ("fonte_dados", "varchar(60)"),
    ],
    "fact_titulacao": [
        ("titulacao_id", "bigint"), ("titulado_sk", "int"), ("tema_sk", "int"), ("tempo_sk", "int"),
        ("hash_id", "varchar(128)"), ("tema_id", "int"), ("ano_base", "int"), ("uf_tema", "varchar(2)"),
        ("uf_pesquisador", "varchar(2)"), ("score_title", "decimal(10,6)"), ("score_abstract", "decimal(10,6)"),
        ("score_keywords", "decimal(10,6)"), ("score_final", "decimal(10,6)"), ("modelo_nivel", "varchar(20)"),
        ("modelo_explicacao", "string"), ("modelo_erro", "string"), ("model", "varchar(120)"),
        ("match_status", "varchar(20)"), ("fonte_dados", "varchar(120)"),
    ],
    "fact_tema_ods": [
        ("tema_ods_id", "bigint"), ("tema_sk", "int"), ("ods_sk", "int"), ("tipo_associacao", "varchar(50)"),
        ("nivel_confianca", "decimal(5,2)"), ("data_associacao", "date"), ("usuario_associacao", "varchar(100)"),
        ("observacao", "string"), ("ativo", "boolean"),
    ],
    "fact_temas": [
        ("tema_sk", "int"), ("ies_sk", "int"), ("localidade_sk", "int"), ("tempo_sk", "int"),
        ("presente_na_uf", "int"), ("presente_na_categoria", "int"), ("presente_na_ies", "int"),
        ("presente_na_regiao", "int"), ("qtd_registros", "int"),
    ],
}

# Primary keys and the wider business grain of each table.
PRIMARY_KEY = {
    "dim_tempo": ["tempo_sk"], "dim_localidade": ["localidade_sk"], "dim_tema": ["tema_sk"], "dim_ods": ["ods_sk"],
    "dim_ies": ["ies_sk"], "dim_ppg": ["ppg_sk"], "dim_docente": ["docente_sk"], "dim_discente": ["discente_sk"],
    "dim_titulado": ["titulado_sk"], "dim_posdoc": ["posdoc_sk"], "dim_producao": ["producao_sk"],
    "fact_producao_tema": ["producao_tema_id"], "fact_titulacao": ["titulacao_id"], "fact_tema_ods": ["tema_ods_id"],
}
GRAIN = {
    "dim_discente": ["id_discente"],
    "dim_producao": ["id_producao"],
    "fact_tema_ods": ["tema_sk", "ods_sk"],
    "fact_producao_tema": [
        "producao_id", "tema_sk", "ods_sk", "docente_sk", "discente_sk", "titulado_sk", "posdoc_sk", "ppg_sk",
        "ies_sk", "ordem_autor", "tipo_autor", "ano_base",
    ],
}

# Tables whose long descriptive texts are cut to their width.
CUT_TABLES = {"dim_discente", "dim_titulado", "dim_posdoc", "dim_docente", "dim_producao"}

_VARCHAR = re.compile(r"varchar\((\d+)\)")


def spark_type(sql_type: str) -> str:
    return "string" if _VARCHAR.fullmatch(sql_type) else sql_type


def _is_key(name: str) -> bool:
    return name.endswith(("_sk", "_id")) or name.startswith("id_") or name in ("codigo_programa", "cod_entidade_capes")


def conform(df: DataFrame, table: str, on_misfit: str = "error") -> DataFrame:
    """Columns of ``table`` in stored order with their types; absent ones are null.

    A text longer than its column and a value that its type cannot hold are errors.  Descriptive
    texts of ``CUT_TABLES`` are cut.  ``on_misfit="cut"`` also cuts the texts of other tables and makes
    values without a fit null, keys excepted; :func:`misfits` counts what that changes.
    """
    if on_misfit not in ("error", "cut"):
        raise ValueError("on_misfit is 'error' or 'cut'")
    columns = []
    for name, sql_type in TABLES[table]:
        if name not in df.columns:
            columns.append(F.lit(None).cast(spark_type(sql_type)).alias(name))
            continue
        limit, lenient = _VARCHAR.fullmatch(sql_type), on_misfit == "cut" and not _is_key(name)
        if limit:
            text, width = F.col(name).cast("string"), int(limit.group(1))
            if lenient or (table in CUT_TABLES and not _is_key(name)):
                stored = F.substring(text, 1, width)
            else:
                refused = F.raise_error(F.concat(F.lit(f"{table}.{name} holds {width} characters, not: "), text))
                stored = F.when(F.length(text) > width, refused).otherwise(text)
            columns.append(stored.alias(name))
        else:
            columns.append((F.col(name).try_cast(sql_type) if lenient else F.col(name).cast(sql_type)).alias(name))
    return df.select(*columns)


def misfits(df: DataFrame, table: str) -> DataFrame:
    """One row: for each column of ``table``, how many values are too long or do not fit its type."""
    counts = []
    for name, sql_type in TABLES[table]:
        if name in df.columns:
            limit, value = _VARCHAR.fullmatch(sql_type), F.col(name)
            odd = F.length(value.cast("string")) > int(limit.group(1)) if limit else value.isNotNull() & value.try_cast(sql_type).isNull()
            counts.append(F.count_if(F.coalesce(odd, F.lit(False))).alias(name))
    return df.agg(*counts)


def empty_table(spark: SparkSession, table: str) -> DataFrame:
    """Typed empty stand-in for a table that is missing."""
    ddl = ", ".join(f"{name} {spark_type(sql_type)}" for name, sql_type in TABLES[table])
    return spark.createDataFrame([], ddl)
