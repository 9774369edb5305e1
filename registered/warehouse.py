"""The warehouse itself, built from the given tables.

The given tables stand in for the education files: customers are students,
suppliers institutions, parts themes, orders productions.  Each builder below
only renames and derives columns; the work is done by ``starloom.plans``.
"""

from pyspark.sql import functions as F

from registered import load, query
from registered.expressions import order_calendar
from starloom.fixed_values import GOAL_DESCRIPTORS, GOALS, POSITION, STATES
from starloom.plans import dims, facts, raw, reports
from starloom.session import by_loaded_size
from starloom.sources.readers import numbered_parquet

UNKNOWN = "'NÃO INFORMADO'"


def text_literal(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# --- students, graduates -------------------------------------------------------

def student_file(spark, folder):
    """One row per order: the student is the customer, the base year that of the order."""
    orders = load(spark, folder, "orders")
    customers = load(spark, folder, "customer")
    degree = F.when(F.col("c_mktsegment") == "BUILDING", "MESTRADO").when(
        F.col("c_mktsegment") == "FURNITURE", "Doutorado Profissional"
    ).when(F.col("c_mktsegment") == "MACHINERY", "GRADUAÇÃO")
    status = F.when(F.col("o_orderstatus") == "F", "TITULADO").when(F.col("o_orderstatus") == "O", "MATRICULADO")
    months = F.when(F.col("o_totalprice") > 250000, F.floor(F.col("o_totalprice") / 10000).cast("string")).otherwise("nan")
    rows = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return rows.select(
        F.concat("o_custkey", F.lit(".0")).alias("ID_DISCENTE"),
        F.col("o_custkey").cast("string").alias("ID_PESSOA"),
        F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("NM_DISCENTE"),
        F.lit(None).cast("string").alias("TP_SEXO_DISCENTE"),
        F.date_format("o_orderdate", "dd/MM/yyyy").alias("DT_MATRICULA_DISCENTE"),
        degree.alias("DS_GRAU_ACADEMICO_DISCENTE"),
        status.alias("NM_SITUACAO_DISCENTE"),
        months.alias("QT_MES_TITULACAO"),
        F.col("o_orderkey").cast("string").alias("ID_LATTES"),
        F.year("o_orderdate").alias("AN_BASE"),
    )


# the newest base year wins; ties go through the other columns in file order
STUDENTS_SQL = """
    student_rows AS (
        SELECT CAST(o_custkey AS VARCHAR) AS id_discente, CASE WHEN c_acctbal > 0 THEN c_name END AS nome,
               strftime(o_orderdate, '%d/%m/%Y') AS matricula,
               CASE c_mktsegment WHEN 'BUILDING' THEN 'MESTRADO' WHEN 'FURNITURE' THEN 'Doutorado Profissional' WHEN 'MACHINERY' THEN 'GRADUAÇÃO' END AS grau,
               CASE o_orderstatus WHEN 'F' THEN 'TITULADO' WHEN 'O' THEN 'MATRICULADO' END AS situacao,
               CASE WHEN o_totalprice > 250000 THEN CAST(CAST(floor(o_totalprice / 10000) AS BIGINT) AS VARCHAR) ELSE 'nan' END AS meses,
               CAST(o_orderkey AS VARCHAR) AS id_lattes, year(o_orderdate) AS ano
        FROM orders JOIN customer ON o_custkey = c_custkey
    ),
    students AS (
        SELECT CAST(row_number() OVER (ORDER BY id_discente) AS INT) AS discente_sk, id_discente, coalesce(nome, 'NÃO INFORMADO') AS nome,
               CAST(strptime(matricula, '%d/%m/%Y') AS DATE) AS matricula, coalesce(grau, 'NÃO INFORMADO') AS grau,
               coalesce(situacao, 'NÃO INFORMADO') AS situacao, CASE WHEN meses = 'nan' THEN 0 ELSE CAST(meses AS INT) END AS meses,
               id_lattes, CAST(ano AS INT) AS ano
        FROM (
            SELECT *, row_number() OVER (
                PARTITION BY id_discente
                ORDER BY ano DESC, nome NULLS FIRST, matricula, grau NULLS FIRST, situacao NULLS FIRST, meses, id_lattes
            ) AS n FROM student_rows
        ) WHERE n = 1
    )
"""


def student_dimension_of(spark, folder):
    return dims.dim_discente(student_file(spark, folder))


@query(f"""
    WITH {STUDENTS_SQL}
    SELECT discente_sk, id_discente, id_discente AS id_pessoa, nome AS nome_discente, 'BRASIL' AS pais_nacionalidade, matricula AS data_matricula,
           grau AS grau_academico, situacao AS situacao_discente, meses AS meses_para_titulacao, id_lattes, ano AS ano_base
    FROM students
    UNION ALL SELECT 0, '0', '0', {UNKNOWN}, {UNKNOWN}, NULL, {UNKNOWN}, {UNKNOWN}, 0, '0', 0
""")
def student_dimension(spark, folder):
    return student_dimension_of(spark, folder).select(
        "discente_sk", "id_discente", "id_pessoa", "nome_discente", "pais_nacionalidade", "data_matricula",
        "grau_academico", "situacao_discente", "meses_para_titulacao", "id_lattes", "ano_base",
    )


@query(f"""
    WITH {STUDENTS_SQL}
    SELECT count(*) + 1 AS total_discentes, 1 AS sexos, (SELECT count(*) FROM (SELECT situacao FROM students UNION SELECT {UNKNOWN})) AS situacoes,
           (SELECT count(*) FROM (SELECT grau FROM students UNION SELECT {UNKNOWN})) AS graus, 0 AS ano_min, max(ano) AS ano_max
    FROM students
""")
def student_report(spark, folder):
    return reports.student_profile(student_dimension_of(spark, folder))


@query(f"""
    WITH {STUDENTS_SQL}
    SELECT CAST(row_number() OVER (ORDER BY ano DESC, id_discente) AS INT) AS titulado_sk, id_discente AS id_discente_original, nome AS nome_titulado,
           grau AS grau_titulacao, CASE WHEN upper(grau) LIKE '%MESTRADO%' THEN 'MESTRE' ELSE 'DOUTOR' END AS nivel_titulacao,
           situacao AS situacao_titulacao, meses AS meses_para_titulacao, CAST(round_even(meses / 12.0::DOUBLE, 1) AS DOUBLE) AS anos_para_titulacao, ano AS ano_base
    FROM students WHERE upper(grau) IN ('MESTRADO', 'DOUTORADO PROFISSIONAL') AND (situacao IN ('TITULADO', 'NÃO INFORMADO') OR meses > 0)
    UNION ALL SELECT 0, '0', {UNKNOWN}, {UNKNOWN}, {UNKNOWN}, {UNKNOWN}, 0, 0, 0
""")
def graduate_dimension(spark, folder):
    graduates = dims.dim_titulado(student_dimension_of(spark, folder))
    return graduates.select(
        "titulado_sk", "id_discente_original", "nome_titulado", "grau_titulacao", "nivel_titulacao", "situacao_titulacao",
        "meses_para_titulacao", F.col("anos_para_titulacao").cast("double").alias("anos_para_titulacao"), "ano_base",
    )


# --- post-docs -----------------------------------------------------------------

def postdoc_file(spark, folder):
    lines = load(spark, folder, "lineitem").join(
        load(spark, folder, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    birth = F.date_sub("o_orderdate", (F.col("l_quantity") * 600).cast("int"))
    return lines.select(
        F.col("o_custkey").cast("string").alias("ID_POS_DOC"),
        F.when(F.col("l_returnflag") != "R", F.col("l_shipdate")).cast("string").alias("DH_FIM_POS_DOC"),
        F.col("o_orderdate").cast("string").alias("DH_INICIO_POS_DOC"),
        birth.cast("string").alias("DT_NASCIMENTO"),
        F.year("o_orderdate").cast("string").alias("AN_BASE"),
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("NR_ORCID_POS_DOC"),
    )


@query(f"""
    WITH rows AS (
        SELECT CAST(o_custkey AS VARCHAR) AS id, CASE WHEN l_returnflag <> 'R' THEN l_shipdate END AS fim, o_orderdate AS inicio,
               CAST(o_orderdate AS DATE) - CAST(l_quantity * 600 AS INT) AS nascimento, year(o_orderdate) AS ano,
               l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS orcid
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    ),
    newest AS (
        SELECT *, ano - year(nascimento) AS idade FROM (
            SELECT *, row_number() OVER (PARTITION BY id ORDER BY ano DESC, nascimento, inicio, fim NULLS FIRST, orcid) AS n FROM rows
        ) WHERE n = 1
    )
    SELECT CAST(row_number() OVER (ORDER BY ano DESC, id) AS INT) AS posdoc_sk, id AS id_posdoc, id AS id_pessoa, CAST(idade AS INT) AS idade_ano_base,
           CASE WHEN fim IS NULL THEN 'ATIVO' ELSE 'CONCLUÍDO' END AS situacao_posdoc,
           CASE WHEN idade <= 0 OR idade > 100 THEN {UNKNOWN} WHEN idade <= 25 THEN 'ATÉ 25' WHEN idade <= 35 THEN '26-35' WHEN idade <= 45 THEN '36-45'
                WHEN idade <= 55 THEN '46-55' WHEN idade <= 65 THEN '56-65' ELSE 'ACIMA DE 65' END AS faixa_etaria,
           CAST(coalesce(round_even(floor((epoch_us(fim) - epoch_us(inicio)) / 86400000000) / 30.44::DOUBLE, 0), 0) AS INT) AS meses_duracao,
           orcid AS id_lattes, CAST(ano AS INT) AS ano_base
    FROM newest
    UNION ALL SELECT 0, '0', '0', 0, {UNKNOWN}, {UNKNOWN}, 0, '0', 0
""")
def postdoc_dimension(spark, folder):
    return dims.dim_posdoc(postdoc_file(spark, folder)).select(
        "posdoc_sk", "id_posdoc", "id_pessoa", "idade_ano_base", "situacao_posdoc", "faixa_etaria", "meses_duracao",
        "id_lattes", "ano_base",
    )


# --- productions ---------------------------------------------------------------

def production_file(spark, folder):
    return load(spark, folder, "orders").select(
        (F.col("o_custkey") * 1.0).alias("ID_ADD_PRODUCAO_INTELECTUAL"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("NM_TIPO_PRODUCAO"),
        F.concat(F.lit("Order "), "o_orderkey").alias("DS_TITULO"),
        F.when(F.col("o_orderstatus") == "F", F.year("o_orderdate")).cast("string").alias("AN_BASE"),
        F.year("o_orderdate").cast("string").alias("AN_PRODUCAO"),
        F.year("o_orderdate").alias("AN_BASE_PRODUCAO"),
        F.concat(F.lit(" "), "o_orderpriority").alias("NM_PERIODICO"),
        F.lit(None).cast("string").alias("DS_DOI"),
    )


@query(f"""
    WITH newest AS (
        SELECT * FROM (
            SELECT *, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority ELSE {UNKNOWN} END AS tipo, 'Order ' || o_orderkey AS titulo, year(o_orderdate) AS ano,
                   row_number() OVER (
                       PARTITION BY o_custkey ORDER BY year(o_orderdate) DESC,
                       CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority ELSE {UNKNOWN} END, 'Order ' || o_orderkey
                   ) AS n
            FROM orders
        ) WHERE n = 1
    )
    SELECT CAST(row_number() OVER (ORDER BY ano DESC, CAST(o_custkey AS VARCHAR)) AS INT) AS producao_sk, CAST(o_custkey AS VARCHAR) AS id_producao,
           tipo AS tipo_producao, {UNKNOWN} AS subtipo_producao, titulo AS titulo_producao, CAST(ano AS INT) AS ano_producao,
           o_orderpriority AS nome_periodico, '' AS doi, CAST(ano AS VARCHAR) AS ano_base
    FROM newest
    UNION ALL SELECT 0, '0', 'Desconhecido', {UNKNOWN}, {UNKNOWN}, 0, {UNKNOWN}, NULL, '0000'
""")
def production_dimension(spark, folder):
    return dims.dim_producao(production_file(spark, folder)).select(
        "producao_sk", "id_producao", "tipo_producao", "subtipo_producao", "titulo_producao", "ano_producao",
        "nome_periodico", "doi", "ano_base",
    )


# --- institutions --------------------------------------------------------------

def _uf(number):
    """A state for each nation number, in the order of the state table."""
    codes = F.array(*[F.lit(code) for _, code, _, _ in STATES])
    return F.element_at(codes, (number + 1).cast("int"))


UF_SQL = "ufs(nation, uf, uf_name, region, ibge) AS (VALUES " + ", ".join(
    f"({i}, '{code}', '{name}', '{region}', {ibge})" for i, (ibge, code, name, region) in enumerate(STATES)
) + ")"


def institution_file(spark, folder):
    """Professor rows: employer is the supplier, alma mater the customer's segment."""
    lines = load(spark, folder, "lineitem").select("l_orderkey", "l_suppkey").distinct()
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    # rows of the small files take far more in the driver than their files: broadcast by what they take, else they meet the orders
    customers = by_loaded_size(load(spark, folder, "customer").select("c_custkey", "c_nationkey", "c_acctbal"))
    suppliers = by_loaded_size(load(spark, folder, "supplier").select("s_suppkey", "s_name", "s_nationkey", "s_acctbal"))
    ordered = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    rows = lines.join(ordered, F.col("l_orderkey") == F.col("o_orderkey")).join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    return rows.select(
        F.when(F.col("o_orderstatus") == "F", F.col("s_suppkey")).alias("CD_ENTIDADE_CAPES"),
        F.concat(F.lit("S"), "s_suppkey").alias("SG_ENTIDADE_ENSINO"),
        F.concat(F.lit("Inst "), "s_suppkey").alias("NM_ENTIDADE_ENSINO"),
        F.when(F.col("o_orderstatus") != "P", F.when(F.col("s_acctbal") < 2000, "Particular").otherwise("Federal")).alias("CS_STATUS_JURIDICO"),
        F.when(F.col("o_orderstatus") == "O", F.lower("s_name")).otherwise("").alias("NM_MUNICIPIO_PROGRAMA_IES"),
        _uf(F.col("s_nationkey")).alias("SG_UF_PROGRAMA"),
        F.concat(F.lit("M"), "c_nationkey").alias("SG_IES_TITULACAO"),
        F.concat(F.lit("Inst "), "c_nationkey").alias("NM_IES_TITULACAO"),
        F.when(F.col("c_acctbal") < 0, "França").alias("NM_PAIS_IES_TITULACAO"),
    )


INSTITUTIONS_SQL = f"""
    {UF_SQL},
    professor_rows AS (
        SELECT o_orderstatus AS st, s_suppkey, s_acctbal, s_name, s_nationkey, c_nationkey, c_acctbal
        FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) JOIN orders ON l_orderkey = o_orderkey
        JOIN supplier ON l_suppkey = s_suppkey JOIN customer ON o_custkey = c_custkey
    ),
    role_rows AS (
        SELECT 0 AS papel, CASE WHEN st = 'F' THEN s_suppkey END AS cod, 'S' || s_suppkey AS sg, 'Inst ' || s_suppkey AS des,
               CASE WHEN st <> 'P' THEN CASE WHEN s_acctbal < 2000 THEN 'Particular' ELSE 'Federal' END END AS status,
               CASE WHEN st = 'O' THEN lower(s_name) ELSE '' END AS municipio, uf
        FROM professor_rows JOIN ufs ON s_nationkey = nation
        UNION
        SELECT 1, NULL, 'M' || c_nationkey, 'Inst ' || c_nationkey, NULL, NULL, NULL FROM professor_rows WHERE c_acctbal >= 0
    ),
    role_scored AS (
        SELECT *, (CASE WHEN cod IS NULL THEN 1 ELSE 0 END) + (CASE WHEN coalesce(status, '') = '' THEN 1 ELSE 0 END)
                  + (CASE WHEN coalesce(municipio, '') = '' THEN 1 ELSE 0 END) + (CASE WHEN uf IS NULL THEN 1 ELSE 0 END) AS gaps,
               row_number() OVER (ORDER BY papel, cod NULLS FIRST, sg, des, status NULLS FIRST, uf NULLS FIRST, municipio NULLS FIRST) AS seq
        FROM role_rows
    ),
    institutions AS (
        SELECT CAST(row_number() OVER (ORDER BY des) AS INT) AS ies_sk, des, best.sg AS sg,
               coalesce(best.cod, first_cod) AS cod, coalesce(best.status, first_status) AS status,
               coalesce(nullif(best.municipio, ''), first_municipio, best.municipio) AS municipio, coalesce(best.uf, first_uf) AS uf
        FROM (
            SELECT des, arg_min({{'sg': sg, 'cod': cod, 'status': status, 'municipio': municipio, 'uf': uf}}, (gaps, seq)) AS best,
                   arg_min(cod, seq) FILTER (cod IS NOT NULL) AS first_cod, arg_min(status, seq) FILTER (status IS NOT NULL) AS first_status,
                   arg_min(municipio, seq) FILTER (coalesce(municipio, '') <> '') AS first_municipio, arg_min(uf, seq) FILTER (uf IS NOT NULL) AS first_uf
            FROM role_scored GROUP BY des
        )
    )
"""


def institution_dimension_of(spark, folder):
    return dims.dim_ies(institution_file(spark, folder))


@query(f"""
    WITH {INSTITUTIONS_SQL}
    SELECT ies_sk, CAST(cod AS INT) AS cod_entidade_capes, sg AS sg_ies, des AS des_ies, status AS des_status_juridico, uf AS sg_uf, municipio AS des_municipio_programa
    FROM institutions
    UNION ALL SELECT 0, 0, 'XX', {UNKNOWN}, {UNKNOWN}, 'XX', {UNKNOWN}
""")
def institution_dimension(spark, folder):
    return institution_dimension_of(spark, folder).select(
        "ies_sk", "cod_entidade_capes", "sg_ies", "des_ies", "des_status_juridico", "sg_uf", "des_municipio_programa"
    )


@query(f"""
    WITH {INSTITUTIONS_SQL}
    SELECT des_status_juridico, count(*) AS total FROM (SELECT status AS des_status_juridico FROM institutions UNION ALL SELECT {UNKNOWN})
    WHERE des_status_juridico IS NOT NULL GROUP BY 1
""")
def institution_report(spark, folder):
    return reports.institutions_by(institution_dimension_of(spark, folder), "des_status_juridico", 10)


# --- places --------------------------------------------------------------------

def city_file(spark, folder):
    return load(spark, folder, "supplier").select(
        F.concat(F.element_at(F.array(*[F.lit(ibge) for ibge, _, _, _ in STATES]), F.col("s_nationkey") + 1).cast("string"),
                 F.lpad(F.col("s_suppkey").cast("string"), 9, "0")).alias("codigo_ibge"),
        F.col("s_name").alias("nome"),
        F.col("s_acctbal").cast("string").alias("lat"),
        F.when(F.col("s_acctbal") > 9000, "1").alias("capital"),
    )


PLACES_SQL = f"""
    {UF_SQL},
    places AS (
        SELECT CAST(row_number() OVER (ORDER BY level, uf, ibge, nome) AS INT) AS localidade_sk, * FROM (
            SELECT 0 AS level, 'UF' AS nivel, uf, uf_name, region, NULL AS ibge, uf_name AS nome, 0 AS capital FROM ufs
            UNION ALL
            SELECT 1, 'MUNICIPIO', uf, uf_name, region, CAST(ibge || lpad(CAST(s_suppkey AS VARCHAR), 9, '0') AS BIGINT), s_name, CASE WHEN s_acctbal > 9000 THEN 1 ELSE 0 END
            FROM supplier JOIN ufs ON s_nationkey = nation
        )
    )
"""


@query(f"""
    WITH {PLACES_SQL}
    SELECT localidade_sk, nivel, uf AS sigla_uf, uf_name AS nome_uf, region AS regiao, translate(substr(region, 1, 2), 'Ç', 'C') AS sigla_regiao,
           ibge AS codigo_ibge, CAST(capital AS SMALLINT) AS capital, nome
    FROM places
    UNION ALL SELECT 0, {UNKNOWN}, 'XX', {UNKNOWN}, {UNKNOWN}, 'XX', NULL, 0, {UNKNOWN}
""")
def place_dimension(spark, folder):
    return dims.dim_localidade(spark, city_file(spark, folder)).select(
        "localidade_sk", "nivel", "sigla_uf", "nome_uf", "regiao", "sigla_regiao", "codigo_ibge", "capital", "nome"
    )


@query(f"""
    WITH {PLACES_SQL}
    SELECT nivel, count(*) AS total, count(DISTINCT region) AS regioes FROM (
        SELECT nivel, region FROM places UNION ALL SELECT {UNKNOWN}, {UNKNOWN}
    ) GROUP BY nivel
""")
def place_report(spark, folder):
    return reports.places_by_level(dims.dim_localidade(spark, city_file(spark, folder)))


# --- themes and goals ----------------------------------------------------------

def theme_sheet(spark, folder):
    """One cell of keywords per part; the state follows from the size."""
    goal_words = F.array(*[F.lit(GOAL_DESCRIPTORS[n].split(", ")[0]) for n, _, _, _ in GOALS])
    word = F.element_at(goal_words, (F.col("p_size") % 20 + 1).cast("int"))
    return load(spark, folder, "part").select(
        F.concat(F.lit(" "), "p_type").alias("macro_tema_1_label"),
        F.col("p_brand").alias("TEMA"),
        F.concat_ws("|", "p_name", word, F.lit(" água ;")).alias("PALAVRA-CHAVE"),
        F.element_at(F.array(*[F.lit(name) for _, _, name, _ in STATES]), (F.col("p_size") % 27 + 1).cast("int")).alias("UF"),
    )


GOAL_WORDS_SQL = "goal_words(i, goal_word) AS (VALUES " + ", ".join(
    f"({i}, {text_literal(GOAL_DESCRIPTORS[row[0]].split(', ')[0])})" for i, row in enumerate(GOALS)
) + ")"
GOALS_SQL = "goals(ods_sk, descriptors, name) AS (VALUES " + ", ".join(
    f"({n}, {text_literal(GOAL_DESCRIPTORS[n].lower())}, {text_literal(name.lower())})" for n, name, _, _ in GOALS
) + ")"

RAW_THEMES_SQL = f"""
    {UF_SQL}, {GOAL_WORDS_SQL},
    theme_rows AS (
        SELECT p_type AS macro, p_brand AS tema, upper(uf_name) AS uf_upper, uf,
               trim(unnest([p_name, goal_word, 'água', ''])) AS palavra
        FROM part JOIN goal_words ON i = p_size % 20 JOIN ufs ON nation = p_size % 27
    ),
    raw_themes AS (
        SELECT dense_rank() OVER (ORDER BY macro) AS macrotema_id, macro AS macrotema_nome,
               dense_rank() OVER (ORDER BY macro || '||' || tema) AS tema_id, tema AS tema_nome,
               dense_rank() OVER (ORDER BY palavra) AS palavrachave_id, palavra AS palavrachave_nome, uf_upper, uf
        FROM theme_rows
    ),
    themes AS (
        SELECT CAST(row_number() OVER (ORDER BY tema_id, palavrachave_id, uf_upper) AS INT) AS tema_sk, *
        FROM (SELECT DISTINCT * FROM raw_themes)
    )
"""


def theme_raw(spark, folder):
    return raw.raw_tema(theme_sheet(spark, folder))


@query(f"""
    WITH {RAW_THEMES_SQL}
    SELECT macrotema_id, macrotema_nome, tema_id, tema_nome, palavrachave_id, palavrachave_nome, uf_upper AS uf FROM raw_themes
""")
def raw_theme_table(spark, folder):
    return theme_raw(spark, folder).drop("fonte_arquivo", "created_at")


@query(f"""
    WITH {RAW_THEMES_SQL}
    SELECT uf_upper AS uf, count(DISTINCT tema_id) AS qtd_temas_por_uf FROM raw_themes GROUP BY uf_upper
""")
def raw_themes_per_state(spark, folder):
    return reports.raw_themes_by_state(theme_raw(spark, folder))


@query(f"""
    WITH {RAW_THEMES_SQL}
    SELECT region AS regiao, count(DISTINCT tema_id) AS qtd_temas_por_regiao
    FROM raw_themes JOIN ufs ON raw_themes.uf = ufs.uf GROUP BY region
""")
def raw_themes_per_region(spark, folder):
    return reports.raw_themes_by_region(theme_raw(spark, folder), dims.dim_localidade(spark, city_file(spark, folder)))


def raw_institutions(spark, folder):
    uf_name = F.upper(F.element_at(F.array(*[F.lit(name) for _, _, name, _ in STATES]), F.col("s_nationkey") + 1))
    return load(spark, folder, "supplier").select(
        F.col("s_name").alias("nome_ies"), uf_name.alias("uf"),
        F.when(F.col("s_acctbal") < 2000, "Particular").otherwise("Federal").alias("status_juridico_ppg"),
    )


@query(f"""
    WITH {RAW_THEMES_SQL},
    ies AS (SELECT upper(uf_name) AS uf_upper, CASE WHEN s_acctbal < 2000 THEN 'PRIVADO' ELSE 'PÚBLICO' END AS categoria FROM supplier JOIN ufs ON s_nationkey = nation)
    SELECT categoria AS categoria_administrativa, count(DISTINCT tema_id) AS qtd_temas_por_categoria
    FROM (SELECT DISTINCT uf_upper, tema_id FROM raw_themes) AS t CROSS JOIN ies WHERE t.uf_upper = ies.uf_upper GROUP BY 1
""")
def raw_themes_per_category(spark, folder):
    return reports.raw_themes_by_category(theme_raw(spark, folder), raw_institutions(spark, folder))


@query(f"""
    WITH {RAW_THEMES_SQL}, counts AS (SELECT uf_upper, count(DISTINCT tema_id) AS n FROM raw_themes GROUP BY uf_upper)
    SELECT s_name AS nome_ies, upper(uf_name) AS uf, CASE WHEN s_acctbal < 2000 THEN 'Particular' ELSE 'Federal' END AS status_juridico_ppg, n AS qtd_temas_por_ies
    FROM supplier JOIN ufs ON s_nationkey = nation JOIN counts ON uf_upper = upper(uf_name)
    ORDER BY n DESC, nome_ies, 2, 3 LIMIT 20
""")
def raw_top_institutions(spark, folder):
    return reports.raw_top_institutions(theme_raw(spark, folder), raw_institutions(spark, folder))


def theme_dimension_of(spark, folder):
    return dims.dim_tema(theme_raw(spark, folder))


@query(f"""
    WITH {RAW_THEMES_SQL}
    SELECT tema_sk, macrotema_id, macrotema_nome, tema_id, tema_nome, palavrachave_id, palavrachave_nome AS palavra_chave, uf AS sigla_uf FROM themes
    UNION ALL SELECT 0, 0, {UNKNOWN}, 0, {UNKNOWN}, 0, {UNKNOWN}, 'XX'
""")
def theme_dimension(spark, folder):
    return theme_dimension_of(spark, folder)


BRIDGE_SQL = f"""
    {RAW_THEMES_SQL}, {GOALS_SQL},
    bridge AS (
        SELECT tema_sk, ods_sk, palavrachave_nome AS palavra, CASE WHEN contains(descriptors, lower(palavrachave_nome)) THEN 80 ELSE 60 END AS nivel
        FROM themes JOIN goals ON contains(descriptors, lower(palavrachave_nome)) OR contains(name, lower(palavrachave_nome))
        WHERE palavrachave_nome <> ''
    )
"""


def themes_and_bridge(spark, folder):
    """The theme dimension, built once, and its associations."""
    themes = theme_dimension_of(spark, folder)
    return themes, facts.fact_tema_ods(themes, row_id=None)


def goal_bridge_of(spark, folder):
    return themes_and_bridge(spark, folder)[1]


@query(f"""
    WITH {BRIDGE_SQL}
    SELECT row_number() OVER (ORDER BY tema_sk, ods_sk) AS tema_ods_id, tema_sk, ods_sk, 'Automática' AS tipo_associacao, CAST(nivel AS DOUBLE) AS nivel_confianca,
           'Match automático: "' || lower(palavra) || '" encontrada em descritores ODS' AS observacao, true AS ativo
    FROM bridge
""")
def goal_bridge(spark, folder):
    bridge = facts.fact_tema_ods(theme_dimension_of(spark, folder))
    return bridge.select(
        "tema_ods_id", "tema_sk", "ods_sk", "tipo_associacao", F.col("nivel_confianca").cast("double").alias("nivel_confianca"),
        "observacao", "ativo",
    )


@query(f"""
    WITH {BRIDGE_SQL}
    SELECT count(*) AS associacoes, count(DISTINCT tema_sk) AS temas, count(DISTINCT ods_sk) AS ods, count(*) / count(DISTINCT tema_sk)::DOUBLE AS media_ods_por_tema
    FROM bridge
""")
def goal_bridge_summary(spark, folder):
    return facts.bridge_summary(goal_bridge_of(spark, folder))


@query(f"""
    WITH {BRIDGE_SQL}
    SELECT ods_sk AS ods_numero, count(DISTINCT tema_sk) AS total_temas, count(*) AS total_associacoes FROM bridge
    GROUP BY ods_sk ORDER BY total_temas DESC, ods_sk LIMIT 10
""")
def goals_by_themes(spark, folder):
    return reports.goals_by_themes(goal_bridge_of(spark, folder), dims.dim_ods(spark)).drop("ods_nome")


@query(f"""
    WITH {BRIDGE_SQL}
    SELECT palavra AS palavra_chave, count(*) AS total FROM bridge GROUP BY palavra ORDER BY total DESC, palavra LIMIT 10
""")
def keywords_by_associations(spark, folder):
    themes, bridge = themes_and_bridge(spark, folder)
    return reports.associations_by_theme(bridge, themes)


@query(f"""
    WITH {BRIDGE_SQL}
    SELECT ods_sk AS ods_numero, count(*) AS total FROM bridge GROUP BY ods_sk ORDER BY total DESC, ods_sk LIMIT 10
""")
def goals_by_associations(spark, folder):
    return reports.associations_by_goal(goal_bridge_of(spark, folder), dims.dim_ods(spark)).drop("ods_nome")


@query(f"""
    WITH {BRIDGE_SQL}
    SELECT 'Automática' AS tipo_associacao, count(*) AS total_associacoes, count(DISTINCT tema_sk) AS temas_unicos, count(DISTINCT ods_sk) AS ods_unicos,
           round(avg(nivel), 6) AS media_confianca
    FROM bridge
""")
def association_quality(spark, folder):
    return reports.association_quality(goal_bridge_of(spark, folder)).withColumn(
        "media_confianca", F.round(F.col("media_confianca").cast("double"), 6)
    )


@query(f"WITH {BRIDGE_SQL} SELECT 'Automática' AS tipo_associacao, count(*) AS total FROM bridge")
def associations_by_type(spark, folder):
    return reports.associations_by_type(goal_bridge_of(spark, folder))


@query(f"""
    WITH {BRIDGE_SQL}
    SELECT goals.ods_sk AS ods_numero, CASE WHEN goals.ods_sk <= 17 THEN 'Oficial ONU' ELSE 'Expandido' END AS ods_tipo, count(tema_sk) AS total_temas
    FROM goals LEFT JOIN bridge ON goals.ods_sk = bridge.ods_sk GROUP BY 1, 2 HAVING count(tema_sk) < 5
""")
def under_covered_goals(spark, folder):
    return reports.under_covered_goals(goal_bridge_of(spark, folder), dims.dim_ods(spark)).drop("ods_nome")


@query(f"""
    WITH {BRIDGE_SQL}
    SELECT palavra AS palavra_chave, 'Automática' AS tipo_associacao, CAST(nivel AS DOUBLE) AS nivel_confianca FROM bridge WHERE ods_sk = 6
""")
def themes_of_goal(spark, folder):
    themes, bridge = themes_and_bridge(spark, folder)
    rows = reports.themes_of_goal(bridge, themes, dims.dim_ods(spark), 6)
    return rows.select("palavra_chave", "tipo_associacao", F.col("nivel_confianca").cast("double").alias("nivel_confianca"))


# --- programmes and professors -------------------------------------------------

def programme_file(spark, folder):
    return load(spark, folder, "part").select(
        F.lit(" 2024").alias("Ano Base"), F.col("p_partkey").cast("string").alias("Codigo capes da IES"),
        F.concat(F.col("p_brand"), F.lit("-"), "p_type").alias("Código do PPG"),
        F.when(F.col("p_size") > 5, F.col("p_name")).otherwise("nan").alias("Nome PPG"),
        F.when(F.col("p_size") < 40, F.col("p_size").cast("string")).otherwise("A").alias("Nota do PPG"),
        F.when(F.col("p_size") > 25, "ACADÊMICO").otherwise("PROFISSIONAL").alias("Modalidade do PPG - Acadêmico ou Profissional"),
        F.when(F.col("p_size") > 45, "S").when(F.col("p_size") > 10, "N").alias("Programa em rede (Sim/Não)"),
        F.lit("").alias("UF da IES"), F.col("p_size").alias("Quantidade de docentes no PPG"),
    )


RAW_PROGRAMMES_SQL = """
    raw_programmes AS (
        SELECT 2024 AS ano_base, CAST(p_partkey AS INT) AS codigo_ies, p_brand || '-' || p_type AS codigo, CASE WHEN p_size > 5 THEN p_name END AS nome,
               CASE WHEN p_size < 40 THEN p_size END AS nota, CASE WHEN p_size > 25 THEN 'ACADÊMICO' ELSE 'PROFISSIONAL' END AS modalidade,
               CASE WHEN p_size > 45 THEN 'S' WHEN p_size > 10 THEN 'N' END AS rede, CAST(p_size AS INT) AS docentes
        FROM part
    )
"""


@query(f"""
    WITH {RAW_PROGRAMMES_SQL}
    SELECT ano_base, codigo_ies AS codigo_capes_da_ies, codigo AS codigo_do_ppg, nome AS nome_ppg, CAST(nota AS DOUBLE) AS nota_do_ppg, modalidade AS modalidade_do_ppg,
           rede AS programa_em_rede, CAST(NULL AS VARCHAR) AS uf_da_ies, docentes AS quantidade_de_docentes_no_ppg
    FROM raw_programmes
""")
def raw_programme_table(spark, folder):
    rows = raw.raw_ppg(programme_file(spark, folder)).drop("fonte_arquivo", "created_at")
    return rows.withColumn("nota_do_ppg", F.col("nota_do_ppg").cast("double"))


PROGRAMMES_SQL = f"""
    {RAW_PROGRAMMES_SQL},
    programmes AS (
        SELECT CAST(row_number() OVER (ORDER BY codigo) AS INT) AS ppg_sk, * FROM (
            SELECT *, row_number() OVER (
                PARTITION BY codigo ORDER BY nome NULLS FIRST, nota NULLS FIRST, modalidade, rede NULLS FIRST, codigo_ies
            ) AS n FROM raw_programmes
        ) WHERE n = 1
    )
"""


def programme_dimension_of(spark, folder):
    return dims.dim_ppg(raw.raw_ppg(programme_file(spark, folder)))


@query(f"""
    WITH {PROGRAMMES_SQL}
    SELECT ppg_sk, codigo AS codigo_programa, upper(coalesce(nome, {UNKNOWN})) AS nome_programa, CAST(coalesce(nota, 0) AS DOUBLE) AS nota_programa,
           CASE modalidade WHEN 'ACADÊMICO' THEN 'Acadêmico' ELSE 'Profissional' END AS modalidade,
           CASE rede WHEN 'S' THEN 'Sim' WHEN 'N' THEN 'Não' ELSE {UNKNOWN} END AS programa_em_rede, codigo_ies, {UNKNOWN} AS uf, {UNKNOWN} AS regiao,
           docentes AS quantidade_docentes, ano_base
    FROM programmes
    UNION ALL SELECT 0, '0', {UNKNOWN}, 0, {UNKNOWN}, {UNKNOWN}, 0, 'XX', {UNKNOWN}, 0, 0
""")
def programme_dimension(spark, folder):
    return programme_dimension_of(spark, folder).select(
        "ppg_sk", "codigo_programa", "nome_programa", F.col("nota_programa").cast("double").alias("nota_programa"), "modalidade",
        "programa_em_rede", "codigo_ies", "uf", "regiao", "quantidade_docentes", "ano_base",
    )


@query(f"""
    WITH {PROGRAMMES_SQL}
    SELECT CASE modalidade WHEN 'ACADÊMICO' THEN 'Acadêmico' ELSE 'Profissional' END AS modalidade, count(*) AS total FROM programmes GROUP BY 1
""")
def programmes_by_modality(spark, folder):
    return reports.programmes_by(programme_dimension_of(spark, folder), "modalidade")


@query(f"""
    WITH {PROGRAMMES_SQL}
    SELECT CAST(coalesce(nota, 0) AS DOUBLE) AS nota_programa, count(*) AS total FROM programmes GROUP BY 1
""")
def programme_grades(spark, folder):
    grades = reports.programme_grades(programme_dimension_of(spark, folder))
    return grades.withColumn("nota_programa", F.col("nota_programa").cast("double"))


def professor_files(spark, folder, orders=None):
    """The CSV of the professors: one row per order, the person is the customer; numbered orders keep their position."""
    orders = load(spark, folder, "orders") if orders is None else orders
    rows = orders.join(load(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return rows.select(
        F.year("o_orderdate").cast("string").alias("AN_BASE"), F.concat(F.lit(" "), "o_custkey").alias("ID_PESSOA"),
        F.col("c_name").alias("NM_DOCENTE"), F.lit("101").alias("CD_PROGRAMA_IES"),
        F.col("o_orderpriority").alias("TP_DOCUMENTO_DOCENTE"), F.col("o_orderkey").cast("string").alias("NR_DOCUMENTO_DOCENTE"),
        F.when(F.col("c_acctbal") > 0, "Sim").otherwise("Não").alias("IN_DOUTOR"),
        F.when(F.col("c_mktsegment") == "BUILDING", "1A").alias("CD_CAT_BOLSA_PRODUTIVIDADE"),
        F.when(F.col("o_orderstatus") == "F", "1999").otherwise("NA").alias("AN_TITULACAO"),
        F.lit("file.csv").alias("fonte_arquivo"), *[c for c in POSITION if c in orders.columns],
    )


# rows that agree on the key keep the first in content order, as no input position is known
RAW_PROFESSORS_SQL = """
    raw_professors AS (
        SELECT * FROM (
            SELECT o_custkey AS id_pessoa, year(o_orderdate) AS ano_base, c_name AS nome, upper(o_orderpriority) AS tipo, CAST(o_orderkey AS VARCHAR) AS documento,
                   CASE WHEN c_acctbal > 0 THEN 'SIM' ELSE 'NÃO' END AS doutor, CASE WHEN c_mktsegment = 'BUILDING' THEN '1A' ELSE '' END AS bolsa,
                   CASE WHEN o_orderstatus = 'F' THEN 1999 ELSE 0 END AS titulacao,
                   row_number() OVER (PARTITION BY o_custkey, year(o_orderdate)
                       ORDER BY c_name, upper(o_orderpriority), CAST(o_orderkey AS VARCHAR)) AS n
            FROM orders JOIN customer ON o_custkey = c_custkey
        ) WHERE n = 1
    )
"""


@query(f"""
    WITH {RAW_PROFESSORS_SQL}
    SELECT id_pessoa, ano_base, nome AS nm_docente, tipo AS tp_documento_docente, documento AS nr_documento_docente, doutor AS in_doutor,
           bolsa AS cd_cat_bolsa_produtividade, titulacao AS an_titulacao
    FROM raw_professors
""")
def raw_professor_table(spark, folder):
    return raw.raw_docente(professor_files(spark, folder)).select(
        "id_pessoa", "ano_base", "nm_docente", "tp_documento_docente", "nr_documento_docente", "in_doutor",
        "cd_cat_bolsa_produtividade", "an_titulacao",
    )


@query("""
    SELECT o_custkey AS id_pessoa, year(o_orderdate) AS ano_base, CAST(o_orderkey AS VARCHAR) AS nr_documento_docente, upper(o_orderpriority) AS tp_documento_docente
    FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey, year(o_orderdate) ORDER BY place DESC) AS n
        FROM (SELECT *, row_number() OVER () AS place FROM orders)
    ) WHERE n = 1 AND o_custkey IN (SELECT c_custkey FROM customer)
""")
def raw_professors_by_position(spark, folder):
    """B1 by file position: the last row of a person and year in the file stays."""
    orders = numbered_parquet(spark, f"{folder}/orders.parquet")
    return raw.raw_docente(professor_files(spark, folder, orders)).select("id_pessoa", "ano_base", "nr_documento_docente", "tp_documento_docente")


def grant_file(spark, folder):
    return load(spark, folder, "lineitem").select(
        F.concat("l_orderkey", F.lit("")).alias("_c0"),
        F.lpad(F.col("l_orderkey").cast("string"), 9, "0").alias("# Id Lattes"),
        F.concat(F.lit(" customer#"), F.lpad(F.col("l_partkey").cast("string"), 9, "0")).alias("# Nome Beneficiário"),
        F.lower(F.concat(F.lit("pq-"), "l_returnflag")).alias("# Cod Categoria Nível"),
        F.when(F.col("l_linestatus") == "O", F.date_format("l_shipdate", "dd/MM/yyyy")).otherwise("99/99/9999").alias("# Data Início Processo"),
    )


GRANTS_SQL = """
    raw_grants AS (
        SELECT l_orderkey AS id_registro, lpad(CAST(l_orderkey AS VARCHAR), 9, '0') AS id_lattes, 'customer#' || lpad(CAST(l_partkey AS VARCHAR), 9, '0') AS nome,
               upper('pq-' || l_returnflag) AS nivel, CASE WHEN l_linestatus = 'O' THEN CAST(l_shipdate AS DATE) END AS inicio
        FROM lineitem
    )
"""


@query(f"""
    WITH {GRANTS_SQL}
    SELECT id_registro, id_lattes, nome AS des_beneficiario, nivel AS cod_categoria_nivel, inicio AS data_inicio_processo FROM raw_grants
""")
def raw_grant_table(spark, folder):
    return raw.raw_fomentopq(grant_file(spark, folder)).drop("fonte_arquivo", "created_at")


PROFESSORS_SQL = f"""
    {RAW_PROFESSORS_SQL}, {GRANTS_SQL},
    latest_year AS (SELECT * FROM raw_professors WHERE ano_base = (SELECT max(ano_base) FROM raw_professors)),
    base AS (
        SELECT *, CAST(row_number() OVER (ORDER BY CAST(id_pessoa AS VARCHAR)) AS INT) AS docente_sk FROM latest_year
    ),
    details AS (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id_pessoa ORDER BY ano_base DESC, tipo, documento) AS k FROM raw_professors) WHERE k = 1
    ),
    by_researcher AS (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id_lattes ORDER BY inicio DESC NULLS LAST, nome, nivel) AS k FROM raw_grants) WHERE k = 1
    ),
    by_name AS (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY upper(nome) ORDER BY inicio DESC NULLS LAST, id_lattes, nivel) AS j FROM by_researcher) WHERE j = 1
    ),
    professors AS (
        SELECT docente_sk, CAST(base.id_pessoa AS VARCHAR) AS id_pessoa, base.nome AS des_docente, base.doutor = 'SIM' AS bl_doutor,
               CAST(base.titulacao AS INT) AS an_titulacao, base.bolsa <> '' OR by_name.nivel IS NOT NULL AS bl_bolsa_pq, false AS bl_coordenador_ppg,
               details.tipo AS tipo_documento, details.documento AS documento_docente, by_name.id_lattes AS id_lattes, by_name.nivel AS pq_categoria_nivel,
               by_name.inicio AS pq_data_inicio, CAST(details.ano_base AS INT) AS ano_base_mais_recente
        FROM base LEFT JOIN details ON base.id_pessoa = details.id_pessoa LEFT JOIN by_name ON upper(base.nome) = upper(by_name.nome)
    )
"""


def professor_dimension_of(spark, folder):
    return dims.dim_docente(
        None, raw.raw_docente(professor_files(spark, folder)), raw.raw_fomentopq(grant_file(spark, folder))
    )


@query(f"""
    WITH {PROFESSORS_SQL}
    SELECT * FROM professors
    UNION ALL SELECT 0, '0', 'Desconhecido', false, NULL, false, false, NULL, NULL, NULL, NULL, NULL, NULL
""")
def professor_dimension(spark, folder):
    return professor_dimension_of(spark, folder).select(
        "docente_sk", "id_pessoa", "des_docente", "bl_doutor", "an_titulacao", "bl_bolsa_pq", "bl_coordenador_ppg", "tipo_documento",
        "documento_docente", "id_lattes", "pq_categoria_nivel", "pq_data_inicio", "ano_base_mais_recente",
    )


@query(f"""
    WITH {PROFESSORS_SQL}
    SELECT count(*) + 1 AS total, count(*) FILTER (bl_doutor) AS doutores, count(*) FILTER (bl_bolsa_pq) AS bolsistas, 0 AS coordenadores,
           count(*) FILTER (tipo_documento <> '') AS com_dados_pessoais, round(count(*) FILTER (tipo_documento <> '') * 100.0::DOUBLE / (count(*) + 1), 6) AS pct_dados_pessoais,
           count(pq_categoria_nivel) AS com_bolsa_registrada, round(count(pq_categoria_nivel) * 100.0::DOUBLE / (count(*) + 1), 6) AS pct_bolsa_registrada
    FROM professors
""")
def professor_report(spark, folder):
    profile = reports.professor_profile(professor_dimension_of(spark, folder))
    return profile.withColumns({c: F.round(c, 6) for c in ("pct_dados_pessoais", "pct_bolsa_registrada")})


@query(f"""
    WITH {RAW_PROFESSORS_SQL}
    SELECT count(*) AS linhas, count(DISTINCT id_pessoa) AS unicos_id_pessoa, count(DISTINCT nome) AS unicos_nm_docente,
           string_agg(DISTINCT CAST(ano_base AS VARCHAR), ', ' ORDER BY CAST(ano_base AS VARCHAR)) AS lista_ano_base
    FROM raw_professors
""")
def raw_professor_report(spark, folder):
    return reports.raw_profile(raw.raw_docente(professor_files(spark, folder)), ["id_pessoa", "nm_docente"], "ano_base")


# --- facts ---------------------------------------------------------------------

def authorship_file(spark, folder):
    """One row per line: its order is the production, one of four roles the author."""
    lines = load(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_shipdate"
    )
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    person = F.col("o_custkey").cast("double")
    return rows.select(
        F.col("l_orderkey").alias("ID_ADD_PRODUCAO_INTELECTUAL"), F.year("l_shipdate").alias("AN_BASE_PRODUCAO"),
        F.lit(1).alias("ID_TIPO_PRODUCAO"), F.col("l_linenumber").alias("ID_SUBTIPO_PRODUCAO"),
        F.when(F.col("l_returnflag") == "A", "-").when(F.col("l_returnflag") == "N", "DISCENTE").alias("TP_AUTOR"),
        F.col("l_linenumber").alias("NR_ORDEM"), F.lit(None).cast("double").alias("ID_PESSOA_DOCENTE"),
        F.when(F.col("l_returnflag") == "N", person).alias("ID_PESSOA_DISCENTE"), F.lit(None).cast("double").alias("ID_PESSOA_POS_DOC"),
        F.when(F.col("l_returnflag") == "R", person).alias("ID_PESSOA_EGRESSO"),
        F.concat("l_suppkey", F.lit(".0")).alias("CD_ENTIDADE_CAPES"), (F.col("l_partkey") % 200).alias("TEMA_ID"),
    )


AUTHORS_SQL = f"""
    {STUDENTS_SQL},
    graduates AS (
        SELECT CAST(row_number() OVER (ORDER BY ano DESC, id_discente) AS INT) AS titulado_sk, * EXCLUDE (discente_sk) FROM students
        WHERE upper(grau) IN ('MESTRADO', 'DOUTORADO PROFISSIONAL') AND (situacao IN ('TITULADO', 'NÃO INFORMADO') OR meses > 0)
    ),
    day_bounds AS (SELECT date_trunc('year', min(o_orderdate)) AS a FROM orders),
    years AS (
        SELECT y AS ano, CAST(date_diff('day', a, make_date(y, 12, 31)) + 1 AS INT) AS tempo_sk
        FROM (SELECT unnest(generate_series((SELECT min(year(o_orderdate)) FROM orders), (SELECT max(year(o_orderdate)) FROM orders))) AS y), day_bounds
    ),
    authors AS (
        SELECT l_orderkey AS producao_id, l_linenumber AS ordem, l_returnflag AS flag, CAST(o_custkey AS VARCHAR) AS person, CAST(year(l_shipdate) AS INT) AS ano,
               l_suppkey AS ies, l_partkey % 200 AS tema_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    )
"""


def author_dimensions(spark, folder):
    students = student_dimension_of(spark, folder)
    return {"tempo": order_calendar(spark, folder), "discente": students, "titulado": dims.dim_titulado(students)}


@query(f"""
    WITH {AUTHORS_SQL}
    SELECT producao_id, coalesce(tempo_sk, 0) AS tempo_sk, 0 AS docente_sk, coalesce(discente_sk, 0) AS discente_sk, coalesce(titulado_sk, 0) AS titulado_sk,
           0 AS posdoc_sk, 0 AS localidade_sk, 1 AS tipo_producao, ordem AS subtipo_producao,
           CASE flag WHEN 'A' THEN 'PARTICIPANTE EXTERNO' WHEN 'N' THEN 'DISCENTE' ELSE {UNKNOWN} END AS tipo_autor, ordem AS ordem_autor, 1 AS qtd_producao
    FROM authors LEFT JOIN years ON authors.ano = years.ano
    LEFT JOIN students ON flag = 'N' AND person = students.id_discente
    LEFT JOIN graduates ON flag = 'R' AND person = graduates.id_discente
""")
def authorship_fact(spark, folder):
    return facts.fact_producao(authorship_file(spark, folder), author_dimensions(spark, folder))


@query(f"""
    WITH {AUTHORS_SQL}, keyed AS (
        SELECT coalesce(discente_sk, 0) AS d, coalesce(titulado_sk, 0) AS t FROM authors
        LEFT JOIN students ON flag = 'N' AND person = students.id_discente LEFT JOIN graduates ON flag = 'R' AND person = graduates.id_discente
    )
    SELECT count(*) AS total, 0 AS com_docente, count(*) FILTER (d > 0) AS com_discente, count(*) FILTER (t > 0) AS com_titulado, 0 AS com_posdoc,
           count(*) FILTER (d > 0 OR t > 0) AS com_algum_autor
    FROM keyed
""")
def authorship_coverage(spark, folder):
    return facts.author_coverage(facts.fact_producao(authorship_file(spark, folder), author_dimensions(spark, folder)))


FULL_SQL = f"{AUTHORS_SQL}, {BRIDGE_SQL}, " + INSTITUTIONS_SQL.replace(f"{UF_SQL},", "", 1)
THEMED_SQL = f"""
    {FULL_SQL},
    theme_keys AS (SELECT tema_id, max(tema_sk) AS tema_sk FROM themes GROUP BY tema_id),
    ies_keys AS (SELECT cod, max(ies_sk) AS ies_sk FROM institutions WHERE cod IS NOT NULL GROUP BY cod),
    plain AS (
        SELECT DISTINCT producao_id, coalesce(tempo_sk, 0) AS tempo_sk, coalesce(k.tema_sk, 0) AS tema_sk, 0 AS ppg_sk, coalesce(i.ies_sk, 0) AS ies_sk,
               0 AS docente_sk, coalesce(discente_sk, 0) AS discente_sk, coalesce(titulado_sk, 0) AS titulado_sk, 0 AS posdoc_sk,
               CASE flag WHEN 'A' THEN '-' WHEN 'N' THEN 'DISCENTE' ELSE {UNKNOWN} END AS tipo_autor, ordem AS ordem_autor, authors.ano AS ano_base
        FROM authors LEFT JOIN years ON authors.ano = years.ano
        LEFT JOIN students ON flag = 'N' AND person = students.id_discente
        LEFT JOIN graduates ON flag = 'R' AND person = graduates.id_discente
        LEFT JOIN theme_keys k ON authors.tema_id = k.tema_id LEFT JOIN ies_keys i ON authors.ies = i.cod
    ),
    themed AS (
        SELECT plain.*, coalesce(bridge.ods_sk, 0) AS ods_sk FROM plain LEFT JOIN bridge ON plain.tema_sk = bridge.tema_sk
    )
"""


def themed_star(spark, folder, row_id):
    """The fact with the bridge and institutions that it was built from."""
    themes, bridge = themes_and_bridge(spark, folder)
    institutions = institution_dimension_of(spark, folder)
    tables = {**author_dimensions(spark, folder), "tema": themes, "ies": institutions}
    return facts.fact_producao_tema(authorship_file(spark, folder), tables, bridge, row_id), bridge, institutions


def themed_fact_of(spark, folder, row_id):
    return themed_star(spark, folder, row_id)[0]


@query(f"""
    WITH {THEMED_SQL}
    SELECT producao_id, tempo_sk, tema_sk, ods_sk, ppg_sk, ies_sk, docente_sk, discente_sk, titulado_sk, posdoc_sk, tipo_autor, ordem_autor,
           1 AS qtd_autores, 1 AS qtd_producoes, ano_base, 'add_producao_autor' AS fonte_dados
    FROM themed
""")
def authorship_theme_fact(spark, folder):
    return themed_fact_of(spark, folder, None).drop("producao_tema_id")


@query(f"""
    WITH {THEMED_SQL}
    SELECT count(*) AS total, count(*) AS ids, 1 AS first_id, count(*) AS last_id FROM themed
""")
def authorship_theme_ids(spark, folder):
    """K4: row ids are dense from 1."""
    return themed_fact_of(spark, folder, "dense").agg(
        F.count("*").alias("total"), F.count_distinct("producao_tema_id").alias("ids"),
        F.min("producao_tema_id").alias("first_id"), F.max("producao_tema_id").alias("last_id"),
    )


def mapping_file(spark, folder):
    """Graduates by theme: the graduate is the order's customer, the theme the line's part."""
    lines = load(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_discount", "l_returnflag")
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey")
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(
        F.concat(F.lit(" "), "o_custkey").alias("hash id"), (F.col("l_partkey") % 200).cast("string").alias("Tema-ID"),
        F.col("l_discount").cast("string").alias("score_final"), F.lower("l_returnflag").alias("modelo nivel"),
    )


@query(f"""
    WITH {AUTHORS_SQL}, {RAW_THEMES_SQL},
    theme_keys AS (SELECT tema_id, max(tema_sk) AS tema_sk FROM themes GROUP BY tema_id),
    searched AS (
        SELECT key, arg_min(titulado_sk, (rank, titulado_sk)) AS titulado_sk FROM (
            SELECT 0 AS rank, id_discente AS key, titulado_sk FROM graduates UNION ALL SELECT 1, id_discente, titulado_sk FROM graduates
            UNION ALL SELECT 2, id_lattes, titulado_sk FROM graduates
        ) GROUP BY key
    )
    SELECT coalesce(s.titulado_sk, 0) AS titulado_sk, coalesce(k.tema_sk, 0) AS tema_sk, CAST(tempo_sk AS INT) AS tempo_sk, CAST(o_custkey AS VARCHAR) AS hash_id,
           CAST(l_partkey % 200 AS INT) AS tema_id, 2000 AS ano_base, l_discount AS score_final, l_returnflag AS modelo_nivel,
           CASE WHEN s.titulado_sk > 0 THEN 'MATCHED' ELSE 'UNMATCHED' END AS match_status
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey LEFT JOIN searched s ON CAST(o_custkey AS VARCHAR) = s.key
    LEFT JOIN theme_keys k ON l_partkey % 200 = k.tema_id JOIN years ON years.ano = 2000
""")
def graduation_fact(spark, folder):
    tables = author_dimensions(spark, folder)
    tables["tema"] = theme_dimension_of(spark, folder)
    fact = facts.fact_titulacao(mapping_file(spark, folder), tables, base_year=2000, row_id=None)
    return fact.select(
        "titulado_sk", "tema_sk", "tempo_sk", "hash_id", "tema_id", "ano_base", F.col("score_final").cast("double").alias("score_final"),
        "modelo_nivel", "match_status",
    )


@query(f"""
    WITH {THEMED_SQL}
    SELECT des AS nome_programa, count(DISTINCT ods_sk) AS ods_cobertos, array_to_string(list_sort(list(DISTINCT ods_sk)), ', ') AS lista_ods
    FROM themed JOIN institutions ON themed.ies_sk = institutions.ies_sk WHERE ods_sk > 0 GROUP BY des
""")
def goal_coverage_by_programme(spark, folder):
    """R14, with the institution in the place of the programme."""
    star, bridge, institutions = themed_star(spark, folder, None)
    fact = star.filter("ies_sk > 0").withColumn("ppg_sk", F.col("ies_sk"))
    names = institutions.select(F.col("ies_sk").alias("ppg_sk"), F.col("des_ies").alias("nome_programa"))
    return reports.goal_coverage_by_programme(fact, bridge, dims.dim_ods(spark), names)


# --- the simplified theme fact and its reports -----------------------------------
#
# A theme is present where a supplier really delivers its part: the pairs come
# from the lines, so their number grows with the lines.

def presence_fact(spark, folder):
    """Distinct (theme, institution, place) from the lines, in the layout of the simplified fact."""
    used = load(spark, folder, "lineitem").select("l_partkey", "l_suppkey").distinct()
    members = load(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    return used.join(members, F.col("l_suppkey") == F.col("s_suppkey")).select(
        (F.col("l_partkey") + 1).cast("int").alias("tema_sk"), (F.col("l_suppkey") + 1).cast("int").alias("ies_sk"),
        (F.col("s_nationkey") + 1).alias("localidade_sk"), F.lit(1).alias("qtd_registros"),
    )


def part_themes(spark, folder):
    return load(spark, folder, "part").select(
        (F.col("p_partkey") + 1).cast("int").alias("tema_sk"), F.col("p_brand").alias("tema_id"), F.col("p_name").alias("palavra_chave"),
        F.col("p_brand").alias("tema_nome"), F.col("p_type").alias("macrotema_nome"),
    )


def nation_places(spark, folder):
    regions = load(spark, folder, "region")
    return load(spark, folder, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        (F.col("n_nationkey") + 1).alias("localidade_sk"), F.col("n_name").alias("nome_uf"), F.col("n_name").alias("sigla_uf"),
        F.col("r_name").alias("regiao"),
    )


def supplier_institutions(spark, folder):
    return load(spark, folder, "supplier").select(
        (F.col("s_suppkey") + 1).cast("int").alias("ies_sk"), F.col("s_name").alias("des_ies"),
        F.when(F.col("s_acctbal") < 2000, "Particular").otherwise("Federal").alias("des_status_juridico"),
    )


PRESENCE_SQL = """
    presence AS (
        SELECT p_brand, p_name, p_type, s_suppkey, s_name, CASE WHEN s_acctbal < 2000 THEN 'PRIVADO' ELSE 'PÚBLICO' END AS categoria, n_name, n_nationkey, r_name
        FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
        JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    )
"""


@query(f"""
    WITH {PRESENCE_SQL}
    SELECT n_name AS nome_uf, count(DISTINCT p_brand) AS total_temas, count(*) AS total_registros_fato FROM presence GROUP BY n_name ORDER BY n_name
""")
def themes_by_state_name(spark, folder):
    return reports.themes_by_state_name(presence_fact(spark, folder), part_themes(spark, folder), nation_places(spark, folder))


@query(f"""
    WITH {PRESENCE_SQL}
    SELECT p_type AS macrotema_nome, count(DISTINCT p_brand) AS qtd_temas, count(DISTINCT p_name) AS qtd_palavra_chave FROM presence GROUP BY p_type
""")
def macro_theme_sizes(spark, folder):
    return reports.macro_theme_sizes(presence_fact(spark, folder), part_themes(spark, folder))


@query(f"""
    WITH {PRESENCE_SQL}
    SELECT n_name AS sigla_uf, count(DISTINCT p_brand) AS qtd_temas_uf, count(DISTINCT s_suppkey) AS qtd_ies, count(*) AS total_associacoes FROM presence GROUP BY n_name
""")
def themes_by_state(spark, folder):
    return reports.themes_by_state(presence_fact(spark, folder), part_themes(spark, folder), nation_places(spark, folder))


@query(f"""
    WITH {PRESENCE_SQL}
    SELECT categoria AS categoria_administrativa, count(DISTINCT p_brand) AS qtd_temas_categoria, count(DISTINCT s_suppkey) AS qtd_ies, count(*) AS total_associacoes
    FROM presence GROUP BY categoria
""")
def themes_by_category(spark, folder):
    return reports.themes_by_category(presence_fact(spark, folder), part_themes(spark, folder), supplier_institutions(spark, folder))


@query(f"""
    WITH {PRESENCE_SQL}
    SELECT r_name AS regiao, count(DISTINCT p_brand) AS qtd_temas_regiao, count(DISTINCT n_nationkey) AS qtd_ufs, count(*) AS total_associacoes FROM presence GROUP BY r_name
""")
def themes_by_region(spark, folder):
    return reports.themes_by_region(presence_fact(spark, folder), part_themes(spark, folder), nation_places(spark, folder))


@query(f"""
    WITH {PRESENCE_SQL}
    SELECT s_name AS des_ies, categoria AS categoria_administrativa, n_name AS sigla_uf, count(DISTINCT p_brand) AS qtd_temas_ies
    FROM presence GROUP BY 1, 2, 3 ORDER BY qtd_temas_ies DESC, 1, 2, 3 LIMIT 20
""")
def top_institutions(spark, folder):
    return reports.top_institutions(
        presence_fact(spark, folder), part_themes(spark, folder), supplier_institutions(spark, folder), nation_places(spark, folder)
    )
