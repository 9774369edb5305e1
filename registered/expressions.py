"""Scalar expressions and shaping."""

from pyspark.sql import functions as F

from registered import load, query
from starloom.fixed_values import (
    CATEGORY_DEFAULT, GOALS, GRADUATE_DEGREES, GRADUATE_STATUS_WORDS, MACRO_CATEGORIES, MACRO_DEFAULT_NAME, STATES,
    WEEKDAYS,
)
from starloom.functions import dates, labels, numbers, text
from starloom.operators.filters import is_domestic, is_graduate, with_value, year_in_name
from starloom.operators.shape import (
    apply_types, blanks_to_null, drop_empty, feed_name, fit_varchar, leading, nulls_filled, rename_all,
    resolve_aliases, select_renamed, snake_name, stack_rows, with_defaults,
)
from starloom.plans import dims, reports
from starloom.sources.readers import catalog_resources, records_of


@query(r"""
    SELECT doc_id, md5(trim(regexp_replace(text, '[ \t\n\x0B\f\r]+', ' ', 'g'))) AS digest,
           length(trim(regexp_replace(text, '[ \t\n\x0B\f\r]+', ' ', 'g'))) AS length
    FROM documents
""")
def text_cleaning(spark, folder):
    clean = text.clean_text("text")
    documents = load(spark, folder, "documents")
    return documents.select("doc_id", F.md5(clean).alias("digest"), F.length(clean).cast("bigint").alias("length"))


@query("""
    SELECT c_custkey, regexp_replace(c_name, '[^0-9]', '', 'g') AS digits,
           CASE WHEN length(number) = 11 THEN number ELSE '' END AS tax_number
    FROM (SELECT *, regexp_replace(c_name || '.' || c_nationkey, '[^0-9]', '', 'g') AS number FROM customer)
""")
def digits_only(spark, folder):
    customers = load(spark, folder, "customer")
    return customers.select(
        "c_custkey", text.only_digits("c_name").alias("digits"),
        text.tax_number(F.concat("c_name", F.lit("."), "c_nationkey")).alias("tax_number"),
    )


MIXED_SQL = """
    mixed AS (
        SELECT event_id, CASE event_type
            WHEN 'error' THEN 'nan' WHEN 'click' THEN '' WHEN 'purchase' THEN user_id || '.0'
            WHEN 'signup' THEN 'x' || user_id ELSE CAST(user_id AS VARCHAR) || '.75' END AS raw
        FROM events
    )
"""


def mixed_numbers(spark, folder):
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    raw = (
        F.when(kind == "error", "nan").when(kind == "click", "").when(kind == "purchase", F.concat(user, F.lit(".0")))
        .when(kind == "signup", F.concat(F.lit("x"), user)).otherwise(F.concat(user, F.lit(".75")))
    )
    return load(spark, folder, "events").select("event_id", raw.alias("raw"))


@query(f"""
    WITH {MIXED_SQL}
    SELECT event_id, coalesce(CAST(trunc(number) AS BIGINT), -1) AS as_int, coalesce(number, 0.5) AS as_float,
           CASE WHEN trim(raw) IN ('', 'nan') THEN NULL ELSE upper(regexp_replace(raw, '\\.0$', '')) END AS key
    FROM (SELECT *, CASE WHEN raw = 'nan' THEN NULL ELSE TRY_CAST(raw AS DOUBLE) END AS number FROM mixed)
""")
def safe_numeric(spark, folder):
    return mixed_numbers(spark, folder).select(
        "event_id", numbers.safe_int("raw", -1).alias("as_int"), numbers.safe_float("raw", 0.5).alias("as_float"),
        text.identifier("raw").alias("key"),
    )


@query("""
    SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS float_id, CAST(o_custkey AS VARCHAR) AS text_id
    FROM orders
""")
def float_ids(spark, folder):
    orders = load(spark, folder, "orders").withColumn("number", F.col("o_custkey").cast("double"))
    return orders.select(
        "o_orderkey", text.float_id("number").alias("float_id"),
        text.without_float_suffix(F.concat(F.lit(" "), "o_custkey", F.lit(".0"))).alias("text_id"),
    )


@query("""
    SELECT p_partkey, CASE WHEN length(CAST(p_partkey AS VARCHAR)) < 4 THEN lpad(CAST(p_partkey AS VARCHAR), 4, '0')
           ELSE CAST(p_partkey AS VARCHAR) END AS padded,
           substr(p_name, 1, 5) AS short, substr(p_brand, 1, 7) AS brand
    FROM part
""")
def pad_truncate(spark, folder):
    parts = fit_varchar(load(spark, folder, "part"), {"p_brand": 7})
    return parts.select(
        "p_partkey", text.zero_pad("p_partkey", 4).alias("padded"), text.truncate("p_name", 5).alias("short"),
        F.col("p_brand").alias("brand"),
    )


STATES_SQL = "states(ibge, uf, name, region) AS (VALUES " + ", ".join(str(row) for row in STATES) + ")"


@query(f"""
    WITH {STATES_SQL}
    SELECT o_orderkey, coalesce(uf, 'XX') AS uf, region,
           translate(upper(substr(region, 1, 2)), 'Ç', 'C') AS initials, name, coalesce(uf, 'XX') AS uf_of_name,
           coalesce(regexp_full_match(uf, '[A-Z]{{2}}'), false) AS is_code
    FROM orders LEFT JOIN states ON TRY_CAST(substr(CAST(o_orderkey AS VARCHAR), 1, 2) AS INT) = ibge
""")
def code_prefix_lookup(spark, folder):
    uf = labels.state_code_of_ibge(text.prefix_number("o_orderkey", 2))
    rows = load(spark, folder, "orders").select("o_orderkey", uf.alias("code"))
    region, name = labels.region_of_state("code"), labels.name_of_state("code")
    return rows.select(
        "o_orderkey", F.coalesce("code", F.lit("XX")).alias("uf"), region.alias("region"),
        text.region_initials(region).alias("initials"), name.alias("name"),
        labels.state_code(F.concat(F.lit(" "), F.lower(name))).alias("uf_of_name"), text.is_state_code("code").alias("is_code"),
    )


@query(r"""
    SELECT lang, count(*) AS terms, count(*) FILTER (term <> '') AS filled_terms, count(DISTINCT term) AS different_terms
    FROM (SELECT lang, trim(unnest(regexp_split_to_array(text, '[\n\r|/;,]'))) AS term FROM documents)
    GROUP BY lang
""")
def split_explode_terms(spark, folder):
    terms = load(spark, folder, "documents").select("lang", F.explode(text.split_terms("text")).alias("term"))
    return terms.groupBy("lang").agg(
        F.count("*").alias("terms"), F.count_if(text.filled("term")).alias("filled_terms"),
        F.count_distinct("term").alias("different_terms"),
    )


@query("""
    SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'MESTRE' WHEN '2-HIGH' THEN 'DOUTOR'
               WHEN '3-MEDIUM' THEN 'MESTRE' ELSE 'OUTROS' END AS level,
           CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'F' THEN 'F' ELSE 'O' END AS sex,
           o_orderstatus = 'F' AS yes, o_orderpriority IN ('1-URGENT', '3-MEDIUM') OR o_orderstatus = 'F' AS either,
           CASE WHEN o_orderstatus = 'F' THEN 'CONCLUÍDO' ELSE 'ATIVO' END AS stay
    FROM orders
""")
def level_sex_and_flags(spark, folder):
    degree = text.recode("o_orderpriority", {
        "1-URGENT": "mestrado profissional", "2-HIGH": "Doutorado", "3-MEDIUM": "MESTRADO E DOUTORADO",
    })
    sex = F.when(F.col("o_orderstatus") == "P", " ").otherwise(F.concat(F.lit(" "), F.lower("o_orderstatus"), F.lit("eminino")))
    answer = F.when(F.col("o_orderstatus") == "F", " sim ").when(F.col("o_orderstatus") == "O", "NÃO")
    end = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))
    level = text.degree_level(degree)
    return load(spark, folder, "orders").select(
        "o_orderkey", level.alias("level"), text.sex_code(sex).alias("sex"), text.yes_flag(answer).alias("yes"),
        (text.yes_flag(answer) | F.coalesce(level == "MESTRE", F.lit(False))).alias("either"), dates.stay_status(end).alias("stay"),
    )


@query("""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS day,
           CAST(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE 2025 - year(o_orderdate) END AS INT) AS age
    FROM orders
""")
def parse_dates(spark, folder):
    written = F.when(F.col("o_orderstatus") == "P", "2023-13-01").otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
    rows = load(spark, folder, "orders").select("o_orderkey", dates.day_month_year(written).alias("day"))
    return rows.select("o_orderkey", "day", dates.age_in_year(F.lit(2025), "day").alias("age"))


@query("""
    SELECT months, CAST(round_even(months / 12.0, 1) AS DOUBLE) AS years, count(*) AS lines FROM (
        SELECT CAST(round_even(floor((epoch_us(l_shipdate) - epoch_us(o_orderdate)) / 86400000000) / 30.44::DOUBLE, 0) AS INT) AS months
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    ) GROUP BY months
""")
def duration_months(spark, folder):
    lines = load(spark, folder, "lineitem").select("l_orderkey", "l_shipdate")
    orders = load(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    months = joined.groupBy(dates.months_between_days("o_orderdate", "l_shipdate").alias("months")).agg(F.count("*").alias("lines"))
    return months.withColumn("years", numbers.months_to_years("months"))


@query("""
    SELECT CASE WHEN age <= 0 OR age > 100 THEN 'NÃO INFORMADO' WHEN age <= 25 THEN 'ATÉ 25' WHEN age <= 35 THEN '26-35'
                WHEN age <= 45 THEN '36-45' WHEN age <= 55 THEN '46-55' WHEN age <= 65 THEN '56-65' ELSE 'ACIMA DE 65' END AS band,
           count(*) AS parts
    FROM (SELECT p_size * 3 - 20 AS age FROM part) GROUP BY band
""")
def age_bands(spark, folder):
    band = dates.age_band(F.col("p_size") * 3 - 20)
    return load(spark, folder, "part").groupBy(band.alias("band")).agg(F.count("*").alias("parts"))


@query("""
    SELECT c_custkey, 'Customer-Of The #' || n_name_part || '/Best Buyer' AS title, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS balance
    FROM (SELECT *, CAST(c_nationkey AS VARCHAR) AS n_name_part FROM customer)
""")
def title_words_and_clip(spark, folder):
    phrase = F.concat(F.lit("customer-OF the #"), F.col("c_nationkey").cast("string"), F.lit("/best buyer"))
    return load(spark, folder, "customer").select(
        "c_custkey", text.title_words(phrase).alias("title"), numbers.at_least_zero("c_acctbal").alias("balance")
    )


CATEGORY_SQL = "goals(n, category) AS (VALUES " + ", ".join(f"({n}, '{c}')" for n, _, _, c in GOALS) + ")"
MACRO_SQL = "macros(n, macro) AS (VALUES " + ", ".join(
    f"({n}, '{name}')" for name, main, _, _, _ in MACRO_CATEGORIES for n in main
) + ")"


@query(f"""
    WITH {CATEGORY_SQL}, {MACRO_SQL}
    SELECT p_partkey, coalesce(category, '{CATEGORY_DEFAULT}') AS category, coalesce(macro, '{MACRO_DEFAULT_NAME}') AS macro,
           CASE WHEN p_size <= 17 THEN 'Oficial ONU' ELSE 'Expandido' END AS kind, p_size AS number,
           'Match automático: "' || p_name || '" encontrada em descritores ODS' ||
               CASE WHEN macro IS NULL THEN '' ELSE '; macrocategoria(s): ' || macro ||
                   CASE WHEN p_size IN (18, 20) THEN ', Institucional / Governança (Transversal)' ELSE '' END END AS note
    FROM part LEFT JOIN goals ON p_size = goals.n LEFT JOIN macros ON p_size = macros.n
""")
def goal_labels(spark, folder):
    number = labels.goal_number(F.concat(F.lit("ODS "), "p_size"))
    return load(spark, folder, "part").select(
        "p_partkey", labels.goal_category("p_size").alias("category"),
        labels.goal_macro("p_size")["ods_macrocategoria"].alias("macro"), labels.goal_kind("p_size").alias("kind"),
        number.alias("number"), labels.match_note("p_name", labels.goal_macro_labels("p_size")).alias("note"),
    )


@query("""
    SELECT event_id, CASE event_type WHEN 'error' THEN 'PARTICIPANTE EXTERNO' WHEN 'click' THEN 'NÃO INFORMADO' ELSE event_type END AS author,
           CASE event_type WHEN 'view' THEN NULL ELSE upper(event_type) END AS name
    FROM events
""")
def author_and_name_text(spark, folder):
    kind = F.col("event_type")
    author = F.when(kind == "error", "-").when(kind != "click", kind)
    name = F.when(kind == "view", "  ").otherwise(F.concat(F.lit(" "), kind, F.lit(" ")))
    return load(spark, folder, "events").select(
        "event_id", text.author_type(author).alias("author"), text.match_name(name).alias("name")
    )


@query("""
    SELECT c_custkey, c_mktsegment FROM customer
    WHERE CASE c_mktsegment WHEN 'BUILDING' THEN true WHEN 'FURNITURE' THEN true WHEN 'MACHINERY' THEN true ELSE false END
      AND c_acctbal > 0
""")
def domestic_with_value(spark, folder):
    country = (
        F.when(F.col("c_mktsegment") == "BUILDING", "").when(F.col("c_mktsegment") == "MACHINERY", "República do Brasil")
        .when(F.col("c_mktsegment") != "FURNITURE", "Chile")
    )
    name = F.when(F.col("c_acctbal") > 0, F.col("c_name")).otherwise(" ")
    rows = load(spark, folder, "customer").withColumns({"country": country, "name": name})
    return with_value(rows.filter(is_domestic("country")), "name").select("c_custkey", "c_mktsegment")


@query(f"""
    WITH rows AS (
        SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'MESTRADO' WHEN '2-HIGH' THEN 'DOUTORADO PROFISSIONAL' ELSE 'OUTRO' END AS degree,
               CASE o_orderstatus WHEN 'F' THEN 'ALUNO TITULADO' WHEN 'P' THEN 'MATRICULADO' END AS status,
               CASE WHEN o_totalprice > 300000 THEN 12 ELSE 0 END AS months
        FROM orders
    )
    SELECT o_orderkey FROM rows
    WHERE degree IN ({", ".join(f"'{d}'" for d in GRADUATE_DEGREES)})
      AND (coalesce(regexp_matches(status, '{"|".join(GRADUATE_STATUS_WORDS)}'), false) OR months > 0)
""")
def graduate_filter(spark, folder):
    degree = F.when(F.col("o_orderpriority") == "1-URGENT", "Mestrado").when(
        F.col("o_orderpriority") == "2-HIGH", "doutorado profissional"
    ).otherwise("outro")
    status = F.when(F.col("o_orderstatus") == "F", "aluno titulado").when(F.col("o_orderstatus") == "P", "matriculado")
    months = F.when(F.col("o_totalprice") > 300000, "12").otherwise("nan")
    return load(spark, folder, "orders").filter(is_graduate(degree, status, months)).select("o_orderkey")


DAYS_SQL = "names(i, day_name) AS (VALUES " + ", ".join(f"({i}, '{name}')" for i, name in enumerate(WEEKDAYS)) + ")"


@query(f"""
    WITH {DAYS_SQL},
    bounds AS (SELECT date_trunc('year', min(o_orderdate)) AS a, date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS b FROM orders),
    days AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS data FROM bounds)
    SELECT CAST(row_number() OVER (ORDER BY data) AS INT) AS tempo_sk, data, CAST(year(data) AS INT) AS ano, CASE WHEN month(data) > 6 THEN 2 ELSE 1 END AS semestre,
           CAST(quarter(data) AS INT) AS trimestre, CAST(month(data) AS INT) AS mes, CAST(day(data) AS INT) AS dia, day_name AS dia_semana,
           CASE WHEN isodow(data) >= 6 THEN 'S' ELSE 'N' END AS fim_de_semana
    FROM days JOIN names ON i = isodow(data) - 1
    UNION ALL SELECT 0, NULL, NULL, NULL, NULL, NULL, NULL, 'NÃO INFORMADO', 'N'
""")
def time_dimension(spark, folder):
    """The calendar of the years that the orders cover."""
    return order_calendar(spark, folder)


def order_calendar(spark, folder):
    bounds = load(spark, folder, "orders").agg(
        F.to_date(F.date_trunc("year", F.min("o_orderdate"))).alias("first"),
        F.date_sub(F.add_months(F.to_date(F.date_trunc("year", F.max("o_orderdate"))), 12), 1).alias("last"),
    )
    return dims.dim_tempo(spark, F.col("first"), F.col("last"), bounds)


@query("""
    WITH days AS (
        SELECT CAST(unnest(generate_series(date_trunc('year', min(o_orderdate)), date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY,
               INTERVAL 1 DAY)) AS DATE) AS data FROM orders
    )
    SELECT CAST(min(year(data)) AS INT) AS ano_min, CAST(max(year(data)) AS INT) AS ano_max, count(*) + 1 AS dias,
           count(*) FILTER (isodow(data) >= 6) AS dias_fim_de_semana, count(*) FILTER (isodow(data) < 6) + 1 AS dias_uteis
    FROM days
""")
def calendar_report(spark, folder):
    return reports.calendar_summary(order_calendar(spark, folder))


@query("""
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events
""")
def json_records_inline(spark, folder):
    """Each event carries one landed page of records."""
    page = F.concat(F.lit('{"success": true, "result": {"records": ['), F.regexp_replace("props", r"\}$", ""),
                    F.lit(', "event_id": '), "event_id", F.lit("}]}}"))
    pages = load(spark, folder, "events").select(page.alias("page"))
    return records_of(pages, "page", "STRUCT<k: INT, event_id: BIGINT>")


@query("""
    SELECT o_orderkey, 'r2' AS resource, CASE WHEN year(o_orderdate) IN (1996, 1998) THEN year(o_orderdate) END AS ano_referencia
    FROM orders
    WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'F' AND year(o_orderdate) IN (1996, 1998)
""")
def catalog_resources_by_year(spark, folder):
    """Each order is a data set with one closed and one open resource."""
    title = F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Programas de 2020").otherwise("Outros")
    year = F.year("o_orderdate").cast("string")

    def resource(number, name, active):
        return F.struct(F.lit(number).alias("id"), name.alias("name"), active.alias("datastore_active"))

    resources = F.array(
        resource("r1", F.concat(F.lit("dados "), year), F.lit(False)),
        resource("r2", F.concat(F.lit("programa-"), year), F.col("o_orderstatus") == "F"),
    )
    catalog = load(spark, folder, "orders").select(
        F.col("o_orderkey").cast("string").alias("name"), title.alias("title"), resources.alias("resources")
    )
    found = catalog_resources(catalog, "programa", [1996, 1998])
    return found.select(
        F.col("name").cast("bigint").alias("o_orderkey"), F.col("resource_id").alias("resource"),
        F.col("ano_referencia").cast("bigint").alias("ano_referencia"),
    )


@query("""
    SELECT source, CASE WHEN lang = 'en' THEN '2023' WHEN lang = 'fr' THEN '2024' END AS year, count(*) AS files
    FROM documents GROUP BY 1, 2
""")
def year_in_file_name(spark, folder):
    tail = F.when(F.col("lang") == "en", "_2023.parquet").when(F.col("lang") == "fr", "_1999_2024_x.parquet").otherwise("_20.parquet")
    names = load(spark, folder, "documents").select("source", F.concat(F.lit("add_"), "source", tail).alias("name"))
    return names.groupBy("source", year_in_name("name").alias("year")).agg(F.count("*").alias("files"))


@query("""
    SELECT s_suppkey AS cod_ies, s_name AS des_ies, CASE WHEN s_acctbal > 0 THEN s_name END AS des_sigla,
           CASE WHEN s_acctbal > 0 THEN s_nationkey END AS qtd_cursos, 'BRA' AS pais, s_name AS rotulo
    FROM supplier
""")
def shaped_columns(spark, folder):
    """Feed names, blanks to null, empty column dropped, types, defaults, aliases, order."""
    nation = F.when(F.col("s_acctbal") > 0, F.concat("s_nationkey", F.lit(".0"))).otherwise("n/d")
    feed = load(spark, folder, "supplier").select(
        F.col("s_suppkey").cast("string").alias("Código IES"), F.concat(F.lit(" "), "s_name").alias("NM_IES"),
        F.when(F.col("s_acctbal") > 0, F.col("s_name")).otherwise(" NULL ").alias("Nome Sigla"),
        nation.alias("Quantidade Cursos"), F.lit(None).cast("string").alias("vazia"),
    )
    named = blanks_to_null(rename_all(feed, feed_name))
    typed = apply_types(drop_empty(named), {"cod_ies": "bigint", "qtd_cursos": "int", "ausente": "int"})
    full = nulls_filled(with_defaults(typed, {"pais": F.lit(None).cast("string")}), {"pais": "BRA"})
    labelled = resolve_aliases(full, {"rotulo": ["sigla", "des_ies"]}, keep=full.columns)
    return leading(labelled, ["cod_ies", "des_ies"])


@query("""
    SELECT s_suppkey AS codigo, s_name AS nome, CAST(NULL AS VARCHAR) AS segmento, 'supplier' AS papel FROM supplier
    UNION ALL SELECT c_custkey, c_name, c_mktsegment, 'customer' FROM customer
""")
def role_union(spark, folder):
    """Two roles by name, absent columns null."""
    suppliers = select_renamed(load(spark, folder, "supplier"), {"s_suppkey": "Código", "s_name": "Nome"})
    customers = select_renamed(
        load(spark, folder, "customer"), {"c_custkey": "Código", "c_name": "Nome", "c_mktsegment": "Segmento"}
    )
    tagged = [suppliers.withColumn("Papel", F.lit("supplier")), customers.withColumn("Papel", F.lit("customer"))]
    return rename_all(stack_rows(tagged), snake_name).select("codigo", "nome", "segmento", "papel")
