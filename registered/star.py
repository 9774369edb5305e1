"""Facts with every role and candidate in use, and the reports on the simplified theme fact."""

from pyspark.sql import functions as F

from registered import SQL, load, query
from registered.expressions import order_calendar
from registered.warehouse import (
    AUTHORS_SQL, BRIDGE_SQL, INSTITUTIONS_SQL, PLACES_SQL, PROFESSORS_SQL, PROGRAMMES_SQL, RAW_THEMES_SQL, STUDENTS_SQL, UF_SQL,
    UNKNOWN, author_dimensions, city_file, goal_bridge_of, institution_dimension_of, postdoc_file, professor_dimension_of,
    programme_dimension_of, student_dimension_of, theme_raw, themes_and_bridge,
)
from starloom.fixed_values import CATEGORY_DEFAULT, GOALS
from starloom.operators.filters import active_only, without_unknown
from starloom.operators.maintain import deactivate
from starloom.operators.quality import dimension_rules, require
from starloom.operators.shape import with_natural_id
from starloom.plans import dims, facts, reports
from starloom.plans.factored import ThemeFactors

# --- authorship with all four roles, programmes, keywords and acronyms -----------

# Line 1 names a professor, 2 a student, 3 a post-doc, 4 a graduate, 5 a professor who is a student too, the others
# nobody; a third of the post-docs is unknown.


def roles_file(spark, folder):
    lines = load(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    orders = load(spark, folder, "orders").select("o_orderkey", "o_custkey")
    part = load(spark, folder, "part").select("p_partkey", "p_name", "p_brand", "p_type")
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(part, F.col("l_partkey") == F.col("p_partkey"))
    person, line = F.col("o_custkey").cast("double"), F.col("l_linenumber")
    stranger = (F.col("l_orderkey") + 10_000_000).cast("double")
    return rows.select(
        F.col("l_orderkey").alias("ID_ADD_PRODUCAO_INTELECTUAL"), F.year("l_shipdate").alias("AN_BASE_PRODUCAO"),
        F.lit(1).alias("ID_TIPO_PRODUCAO"), line.alias("ID_SUBTIPO_PRODUCAO"), F.lit("DOCENTE").alias("TP_AUTOR"), line.alias("NR_ORDEM"),
        F.when(line.isin(1, 5), person).alias("ID_PESSOA_DOCENTE"), F.when(line.isin(2, 5), person).alias("ID_PESSOA_DISCENTE"),
        F.when(line == 3, F.when(F.col("l_suppkey") % 3 == 0, stranger).otherwise(person)).alias("ID_PESSOA_POS_DOC"),
        F.when(line == 4, person).alias("ID_PESSOA_EGRESSO"),
        F.when(line < 6, F.concat_ws("-", "p_brand", "p_type")).otherwise("none such").alias("CD_PROGRAMA"),
        # empty codes: the acronym and the keyword are looked up in their place
        F.lit(None).cast("string").alias("CD_ENTIDADE_CAPES"), F.concat(F.lit("s"), "l_suppkey").alias("SG_IES"),
        F.lit(None).cast("int").alias("TEMA_ID"), F.when(line != 7, F.col("p_name")).otherwise("no such word").alias("PALAVRA_CHAVE"),
    )


ROLES_SQL = f"""
    {AUTHORS_SQL}, {PROFESSORS_SQL},
    postdocs AS (
        SELECT id, CAST(row_number() OVER (ORDER BY max(ano) DESC, id) AS INT) AS posdoc_sk
        FROM (SELECT CAST(o_custkey AS VARCHAR) AS id, year(o_orderdate) AS ano FROM orders SEMI JOIN lineitem ON l_orderkey = o_orderkey) GROUP BY id
    ),
    role_lines AS (
        SELECT l_orderkey AS producao_id, l_linenumber AS n, CAST(year(l_shipdate) AS INT) AS ano, l_suppkey, l_partkey, CAST(o_custkey AS VARCHAR) AS person,
               CASE WHEN l_suppkey % 3 = 0 THEN CAST(l_orderkey + 10000000 AS VARCHAR) ELSE CAST(o_custkey AS VARCHAR) END AS postdoc
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    ),
    roles AS (
        SELECT role_lines.*, coalesce(tempo_sk, 0) AS tempo_sk, coalesce(docente_sk, 0) AS docente_sk, coalesce(discente_sk, 0) AS discente_sk,
               coalesce(titulado_sk, 0) AS titulado_sk, coalesce(posdoc_sk, 0) AS posdoc_sk
        FROM role_lines LEFT JOIN years ON role_lines.ano = years.ano
        LEFT JOIN professors ON n IN (1, 5) AND person = professors.id_pessoa
        LEFT JOIN students ON n IN (2, 5) AND person = students.id_discente
        LEFT JOIN postdocs ON n = 3 AND postdoc = postdocs.id
        LEFT JOIN graduates ON n = 4 AND person = graduates.id_discente
    )
"""


def role_dimensions(spark, folder):
    return {
        **author_dimensions(spark, folder), "docente": professor_dimension_of(spark, folder),
        "posdoc": dims.dim_posdoc(postdoc_file(spark, folder)),
    }


@query(f"""
    WITH {ROLES_SQL}
    SELECT producao_id, tempo_sk, docente_sk, discente_sk, titulado_sk, posdoc_sk, 0 AS localidade_sk, 1 AS tipo_producao, n AS subtipo_producao,
           'DOCENTE' AS tipo_autor, n AS ordem_autor, 1 AS qtd_producao
    FROM roles
""")
def authorship_all_roles(spark, folder):
    """B18 with professors, students, post-docs and graduates."""
    return facts.fact_producao(roles_file(spark, folder), role_dimensions(spark, folder))


@query(f"""
    WITH {ROLES_SQL}
    SELECT count(*) AS total, count(*) FILTER (docente_sk > 0) AS com_docente, count(*) FILTER (discente_sk > 0) AS com_discente,
           count(*) FILTER (titulado_sk > 0) AS com_titulado, count(*) FILTER (posdoc_sk > 0) AS com_posdoc,
           count(*) FILTER (docente_sk + discente_sk + titulado_sk + posdoc_sk > 0) AS com_algum_autor
    FROM roles
""")
def all_roles_coverage(spark, folder):
    return facts.author_coverage(facts.fact_producao(roles_file(spark, folder), role_dimensions(spark, folder)))


ROLES_STAR_SQL = f"""
    {ROLES_SQL}, {BRIDGE_SQL}, {INSTITUTIONS_SQL.replace(f"{UF_SQL},", "", 1)}, {PROGRAMMES_SQL},
    word_keys AS (SELECT upper(palavrachave_nome) AS word, max(tema_sk) AS tema_sk FROM themes GROUP BY 1),
    acronym_keys AS (SELECT upper(sg) AS acronym, max(ies_sk) AS ies_sk FROM institutions WHERE sg IS NOT NULL GROUP BY 1),
    plain_roles AS (
        SELECT DISTINCT producao_id, tempo_sk, coalesce(w.tema_sk, 0) AS tema_sk, coalesce(p.ppg_sk, 0) AS ppg_sk, coalesce(i.ies_sk, 0) AS ies_sk,
               docente_sk, discente_sk, titulado_sk, posdoc_sk, roles.n AS ordem_autor, roles.ano AS ano_base
        FROM roles JOIN part ON l_partkey = p_partkey
        LEFT JOIN word_keys w ON roles.n <> 7 AND upper(p_name) = w.word
        LEFT JOIN programmes p ON roles.n < 6 AND p_brand || '-' || p_type = p.codigo
        LEFT JOIN acronym_keys i ON 'S' || l_suppkey = i.acronym
    ),
    star_roles AS (
        SELECT plain_roles.*, coalesce(bridge.ods_sk, 0) AS ods_sk FROM plain_roles LEFT JOIN bridge ON plain_roles.tema_sk = bridge.tema_sk
    )
"""


def roles_star(spark, folder):
    """B19 with every lookup, and the bridge and programmes that it was built from."""
    themes, bridge = themes_and_bridge(spark, folder)
    programmes = programme_dimension_of(spark, folder)
    tables = {
        **role_dimensions(spark, folder), "tema": themes, "ppg": programmes, "ies": institution_dimension_of(spark, folder),
    }
    return facts.fact_producao_tema(roles_file(spark, folder), tables, bridge, None), bridge, programmes


@query(f"""
    WITH {ROLES_STAR_SQL}
    SELECT producao_id, tempo_sk, tema_sk, ods_sk, ppg_sk, ies_sk, docente_sk, discente_sk, titulado_sk, posdoc_sk, 'DOCENTE' AS tipo_autor, ordem_autor,
           1 AS qtd_autores, 1 AS qtd_producoes, ano_base, 'add_producao_autor' AS fonte_dados
    FROM star_roles
""")
def authorship_theme_all_roles(spark, folder):
    """Keyword and acronym stand in for empty codes; every dimension hits and misses."""
    return roles_star(spark, folder)[0].drop("producao_tema_id")


@query(f"""
    WITH {ROLES_STAR_SQL}
    SELECT upper(coalesce(p.nome, {UNKNOWN})) AS nome_programa, count(DISTINCT s.ods_sk) AS ods_cobertos,
           array_to_string(list_sort(list(DISTINCT s.ods_sk)), ', ') AS lista_ods
    FROM star_roles s LEFT JOIN programmes p USING (ppg_sk) WHERE s.ods_sk > 0 GROUP BY 1
""")
def goals_per_programme(spark, folder):
    """R14 on real programmes; rows without one count for the unknown member."""
    fact, bridge, programmes = roles_star(spark, folder)
    return reports.goal_coverage_by_programme(fact, bridge, dims.dim_ods(spark), programmes)


# --- the simplified theme fact ---------------------------------------------------

TEMAS_SQL = f"""
    {RAW_THEMES_SQL}, {INSTITUTIONS_SQL.replace(f"{UF_SQL},", "", 1)}, {PLACES_SQL.replace(f"{UF_SQL},", "", 1)},
    first_day AS (SELECT CAST(date_diff('day', date_trunc('year', min(o_orderdate)), make_date(1996, 1, 1)) + 1 AS INT) AS tempo_sk FROM orders),
    theme_states AS (
        SELECT DISTINCT t.tema_sk, r.uf FROM (SELECT DISTINCT tema_id, tema_nome, uf FROM raw_themes) r
        JOIN themes t ON r.tema_id = t.tema_id AND r.tema_nome = t.tema_nome
    ),
    temas AS (
        SELECT s.tema_sk, i.ies_sk, p.localidade_sk, s.uf FROM theme_states s JOIN institutions i ON i.uf = s.uf JOIN places p ON p.uf = s.uf AND p.level = 0
    )
"""


def theme_star(spark, folder):
    """B22 with the themes, institutions and places that it was built from."""
    listed = theme_raw(spark, folder)
    themes = dims.dim_tema(listed)
    institutions = institution_dimension_of(spark, folder)
    places = dims.dim_localidade(spark, city_file(spark, folder))
    fact = facts.fact_temas(listed, themes, institutions, places, order_calendar(spark, folder), 1996)
    return fact, themes, institutions, places


@query(f"""
    WITH {TEMAS_SQL}
    SELECT tema_sk, ies_sk, localidade_sk, (SELECT tempo_sk FROM first_day) AS tempo_sk, 1 AS presente_na_uf, 1 AS presente_na_categoria, 1 AS presente_na_ies,
           1 AS presente_na_regiao, 1 AS qtd_registros
    FROM temas
""")
def simplified_theme_fact(spark, folder):
    """B22, J14."""
    return theme_star(spark, folder)[0]


@query(f"""
    WITH {TEMAS_SQL}
    SELECT temas.uf AS sigla_uf, count(DISTINCT tema_id) AS qtd_temas_uf, count(DISTINCT ies_sk) AS qtd_ies, count(*) AS total_associacoes
    FROM temas JOIN themes USING (tema_sk) GROUP BY 1
""")
def simplified_by_state(spark, folder):
    """R7 on the built fact."""
    fact, themes, _, places = theme_star(spark, folder)
    return reports.themes_by_state(fact, themes, places)


@query(f"""
    WITH {TEMAS_SQL}
    SELECT CASE WHEN status IS NULL THEN {UNKNOWN} WHEN status = 'Particular' THEN 'PRIVADO' ELSE 'PÚBLICO' END AS categoria_administrativa,
           count(DISTINCT tema_id) AS qtd_temas_categoria, count(DISTINCT ies_sk) AS qtd_ies, count(*) AS total_associacoes
    FROM temas JOIN themes USING (tema_sk) JOIN institutions USING (ies_sk) GROUP BY 1
""")
def simplified_by_category(spark, folder):
    """R8 on the built fact."""
    fact, themes, institutions, _ = theme_star(spark, folder)
    return reports.themes_by_category(fact, themes, institutions)


@query(f"""
    WITH {TEMAS_SQL}
    SELECT region AS regiao, count(DISTINCT tema_id) AS qtd_temas_regiao, count(DISTINCT temas.localidade_sk) AS qtd_ufs, count(*) AS total_associacoes
    FROM temas JOIN themes USING (tema_sk) JOIN places ON places.localidade_sk = temas.localidade_sk GROUP BY 1
""")
def simplified_by_region(spark, folder):
    """R9 on the built fact."""
    fact, themes, _, places = theme_star(spark, folder)
    return reports.themes_by_region(fact, themes, places)


@query(f"""
    WITH {TEMAS_SQL}
    SELECT des AS des_ies, CASE WHEN status IS NULL THEN {UNKNOWN} WHEN status = 'Particular' THEN 'PRIVADO' ELSE 'PÚBLICO' END AS categoria_administrativa,
           temas.uf AS sigla_uf, count(DISTINCT tema_id) AS qtd_temas_ies
    FROM temas JOIN themes USING (tema_sk) JOIN institutions USING (ies_sk) GROUP BY 1, 2, 3
""")
def simplified_by_institution(spark, folder):
    """R10 on the built fact, all institutions."""
    fact, themes, institutions, places = theme_star(spark, folder)
    return reports.top_institutions(fact, themes, institutions, places, None)


# the same reports without the pairs


def theme_factors(spark, folder):
    themes = theme_raw(spark, folder)
    return ThemeFactors.of(
        themes, dims.dim_tema(themes), institution_dimension_of(spark, folder), dims.dim_localidade(spark, city_file(spark, folder))
    )


@query(SQL["simplified_by_state"])
def factored_by_state(spark, folder):
    """R7 on the factors."""
    return theme_factors(spark, folder).by_state()


@query(SQL["simplified_by_category"])
def factored_by_category(spark, folder):
    """R8 on the factors."""
    return theme_factors(spark, folder).by_category()


@query(SQL["simplified_by_region"])
def factored_by_region(spark, folder):
    """R9 on the factors."""
    return theme_factors(spark, folder).by_region()


@query(SQL["simplified_by_institution"])
def factored_by_institution(spark, folder):
    """R10 on the factors, all institutions."""
    return theme_factors(spark, folder).by_institution(None)


GOAL_LABELS_SQL = ", ".join(f"({number}, '{category or CATEGORY_DEFAULT}')" for number, _, _, category in GOALS)


@query(f"""
    WITH {BRIDGE_SQL}, labels(number, category) AS (VALUES {GOAL_LABELS_SQL})
    SELECT category AS ods_categoria, count(*) AS total FROM labels WHERE number IN (SELECT ods_sk FROM bridge) GROUP BY 1
""")
def goals_in_use_by_category(spark, folder):
    """B10 with its labels, R21: the goals that a theme is associated with."""
    used = goal_bridge_of(spark, folder).select("ods_sk").distinct()
    return reports.goals_by(dims.dim_ods(spark).join(used, "ods_sk", "left_semi"), "ods_categoria")


@query(f"""
    WITH {INSTITUTIONS_SQL},
    dim AS (SELECT ies_sk, des FROM institutions UNION ALL SELECT 0, {UNKNOWN}),
    failed AS (
        SELECT 'sk_not_null' AS rule_name, 'ies_sk' AS column_name, 'ERROR' AS severity, count(*) FILTER (ies_sk IS NULL) AS n FROM dim
        UNION ALL SELECT 'sk_unique', 'ies_sk', 'ERROR', count(*) - count(DISTINCT ies_sk) FROM dim
        UNION ALL SELECT 'sk_range', 'ies_sk', 'ERROR', count(*) FILTER (ies_sk < 0) FROM dim
        UNION ALL SELECT 'nome_not_null', 'des_ies', 'ERROR', count(*) FILTER (des IS NULL) FROM dim
        UNION ALL SELECT 'nome_length', 'des_ies', 'WARNING', count(*) FILTER (length(des) < 3 OR length(des) > 255) FROM dim
    )
    SELECT rule_name, column_name, severity, n = 0 AS passed, CAST(n AS BIGINT) AS failed_count, (SELECT count(*) FROM dim) AS total_count FROM failed
""")
def institution_rules(spark, folder):
    """V10 on the built dimension."""
    return dimension_rules("ies").measure(institution_dimension_of(spark, folder)).drop("position", "message")


@query(f"""
    WITH {INSTITUTIONS_SQL}
    SELECT uf AS sg_uf, count(*) AS total FROM (SELECT uf, des FROM institutions WHERE des IS NOT NULL) WHERE uf IS NOT NULL GROUP BY 1
""")
def gated_institutions(spark, folder):
    """V12, V13, R19 by state: counted only if the built dimension has its columns and no rule of kind ERROR fails."""
    institutions = require(institution_dimension_of(spark, folder), "ies_sk", "des_ies", "sg_uf")
    dimension_rules("ies").gate(institutions)
    return reports.institutions_by(without_unknown(institutions, "ies_sk"), "sg_uf")


@query(f"""
    WITH {STUDENTS_SQL}
    SELECT count(*) AS total_discentes, 1 AS sexos, count(DISTINCT situacao) AS situacoes, count(DISTINCT grau) AS graus, min(ano) AS ano_min, max(ano) AS ano_max
    FROM students
""")
def known_students_report(spark, folder):
    """R18 without the unknown member."""
    return reports.student_profile(student_dimension_of(spark, folder), with_unknown_member=False)


@query("""
    SELECT user_id, event_type, count(*) AS linhas, count(*) AS ids, count(*) - 1 AS copias FROM events GROUP BY 1, 2
""")
def events_by_content_id(spark, folder):
    """Rows without an id get one from their content; equal rows are numbered, so all of them stay."""
    rows = with_natural_id(load(spark, folder, "events").select("user_id", "event_type"), "codigo", "evento")
    copied = F.count_if(F.col("codigo").contains("-"))
    return rows.groupBy("user_id", "event_type").agg(F.count("*").alias("linhas"), F.count_distinct("codigo").alias("ids"), copied.alias("copias"))


# --- the bridge after a soft delete ----------------------------------------------

@query(f"""
    WITH {BRIDGE_SQL}
    SELECT ods_sk AS ods_numero, count(*) AS total FROM bridge WHERE nivel >= 80 GROUP BY ods_sk ORDER BY total DESC, ods_sk LIMIT 10
""")
def active_goals_by_associations(spark, folder):
    """Associations of low confidence are deactivated and no longer count."""
    bridge = active_only(deactivate(goal_bridge_of(spark, folder), F.col("nivel_confianca") < 80, "weak"))
    return reports.associations_by_goal(bridge, dims.dim_ods(spark)).drop("ods_nome")
