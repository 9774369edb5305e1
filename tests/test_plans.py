"""Raw tables, dimensions, facts and reports on small domain rows with the edge cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from registered import warehouse
from starloom import schemas
from starloom.operators.integrity import orphan_keys
from starloom.operators.keys import factorized
from starloom.operators.quality import dimension_rules
from starloom.operators.shape import with_natural_id
from starloom.plans import dims, facts, raw, reports
from starloom.plans.factored import ThemeFactors
from starloom.schemas import TABLES, empty_table
from starloom.session import loaded_bytes
from starloom.sources import readers

UNKNOWN = "NÃO INFORMADO"


def dense(df, key):
    found = sorted(r[0] for r in df.select(key).collect())
    assert found == list(range(len(found)))


def member(df, key, number):
    return df.filter(F.col(key) == number).first().asDict()


@pytest.fixture(scope="module")
def themes(spark):
    sheet = spark.createDataFrame(
        [("Saúde", "T1", "saúde mental|vacinação;", "SÃO PAULO"), ("Saúde", "T2", None, "SP"), ("Água", "T1", "água", "Xis")],
        "macro_tema_1_label string, TEMA string, `PALAVRA-CHAVE` string, UF string",
    )
    return raw.raw_tema(sheet)


@pytest.fixture(scope="module")
def dim_tema(themes):
    return dims.dim_tema(themes)


def test_raw_docente_keeps_the_last_row_of_the_newest_file(spark, tmp_path, rows):
    head = "AN_BASE;ID_PESSOA;CD_PROGRAMA_IES;NM_DOCENTE;IN_DOUTOR;SG_UF_PROGRAMA\n"
    (tmp_path / "d-1.csv").write_bytes((head + "2021;1.0;P;Zé;s;sp\n2021;1;P; Ana ;S;NA\n").encode("latin-1"))
    (tmp_path / "d-2.csv").write_bytes((head + "2022;x;3;B;N;rj\n2021;1;P;Eva;n;mg\n").encode("latin-1"))
    out = raw.raw_docente(readers.csv_files(spark, [str(p) for p in tmp_path.glob("*.csv")]))
    assert out.columns[:3] == ["id_pessoa", "nm_docente", "ano_base"]
    assert rows(out.select("id_pessoa", "ano_base", "cd_programa_ies", "nm_docente", "in_doutor", "sg_uf_programa")) == [
        (0, 2022, 3, "B", "N", "RJ"), (1, 2021, 0, "Eva", "N", "MG"),
    ]
    only = raw.raw_docente(readers.csv_files(spark, [str(tmp_path / "d-1.csv")]))
    assert [(r["nm_docente"], r["sg_uf_programa"]) for r in only.collect()] == [("Ana", "")]


def test_raw_ppg(spark):
    df = spark.createDataFrame(
        [("2024", " 10 ", "nan", "x", "Sim"), ("bad", None, "N", "4.0", "")],
        "`Ano Base` string, `Código do PPG` string, `Nome PPG` string, `Nota do PPG` string, `Programa em rede (Sim/Não)` string",
    )
    out = raw.raw_ppg(df, with_id=True).orderBy("id").collect()
    assert [r["id"] for r in out] == [1, 2]
    assert (out[0]["codigo_do_ppg"], out[0]["ano_base"], str(out[0]["nota_do_ppg"])) == (None, None, "4.0")
    assert (out[1]["codigo_do_ppg"], out[1]["nome_ppg"], out[1]["nota_do_ppg"], out[1]["programa_em_rede"]) == ("10", None, None, "Sim")


def test_raw_tema_explodes_terms(themes, rows):
    got = rows(themes.select("tema_nome", "tema_id", "palavrachave_nome", "uf"))
    assert got == sorted([
        ("T1", 1, "saúde mental", "SÃO PAULO"), ("T1", 1, "vacinação", "SÃO PAULO"), ("T1", 1, "", "SÃO PAULO"),
        ("T2", 2, "", "SP"), ("T1", 3, "água", "XIS"),
    ], key=repr)


def test_raw_fomentopq(spark):
    df = spark.createDataFrame(
        [("1.0", "007", "ana", "pq-1a", "31/12/2023"), (None, None, None, None, "2023-13-01")],
        "`Unnamed: 0` string, `# Id Lattes` string, `# Nome Beneficiário` string, `# Cod Categoria Nível` string, `# Data Início Processo` string",
    )
    out = raw.raw_fomentopq(df).orderBy(F.desc("id_registro")).collect()
    assert (out[0]["id_registro"], out[0]["id_lattes"], out[0]["cod_categoria_nivel"]) == (1, "007", "PQ-1A")
    assert out[0]["data_inicio_processo"] == dt.date(2023, 12, 31)
    assert (out[1]["id_registro"], out[1]["id_lattes"], out[1]["data_inicio_processo"]) == (0, "", None)


def test_raw_ies_and_catalog(spark, rows):
    df = spark.createDataFrame(
        [(1, " 5.0", "nan", None, "x")], "_id int, CD_ENTIDADE_CAPES string, `NM_IES` string, vazia string, AN_BASE string"
    )
    out = raw.raw_ies(df)
    assert out.columns == ["_id_original", "cod_entidade_capes", "des_ies", "an_base"]
    assert rows(out) == [(1, 5, None, None)]
    first = spark.createDataFrame([("A", "1"), ("A", "1")], "nm_entidade_ensino string, CD_ENTIDADE_CAPES string")
    second = spark.createDataFrame([("A", "1", "SP"), ("B", "2", "RJ")], "NM_ENTIDADE_ENSINO string, codigo_capes string, uf string")
    other = spark.createDataFrame([(1,)], "z int")
    got = raw.raw_ies_api([(first, 2021), (other, 2021), (second, 2022)])
    assert rows(got.select("nm_entidade_ensino", "cd_entidade_capes", "ano_referencia", "sg_uf_entidade_ensino")) == [
        ("A", 1, 2021, None), ("B", 2, 2022, "RJ"),
    ]
    # the same from landed pages, whatever their fields
    def page(df):
        return df.select(F.to_json(F.struct(F.lit(True).alias("success"), F.struct(F.collect_list(F.struct("*")).alias("records")).alias("result"))).alias("p"))

    feed = raw.raw_ies_pages(page(df), "p")
    assert rows(feed.select(*out.columns)) == rows(out)
    assert [tuple(d) for d in feed.first()["_desvios"]] == [("AN_BASE", "STRING", "x")]
    assert feed.columns == [*sorted(out.columns, key=["an_base", "cod_entidade_capes", "des_ies", "_id_original"].index), "_desvios"]
    pages = None
    for rank, (frame, year) in enumerate([(first, 2021), (other, 2021), (second, None)]):
        one = page(frame).select(F.lit(rank).alias("n"), F.lit(year).cast("int").alias("ano"), "p")
        pages = one if pages is None else pages.unionAll(one)
    listed = raw.raw_ies_catalog(pages, "p", "n", "ano")
    assert rows(listed.select("nm_entidade_ensino", "cd_entidade_capes", "ano_referencia", "sg_uf_entidade_ensino")) == [
        ("A", 1, 2021, None), ("B", 2, None, "RJ"),
    ]


def test_dim_tempo(spark):
    days = dims.dim_tempo(spark)
    assert days.count() == 5479
    dense(days, "tempo_sk")
    last = member(days, "tempo_sk", 5478)
    assert (last["data"], last["dia_semana"], last["fim_de_semana"], last["semestre"]) == (dt.date(2027, 12, 31), "SEXTA-FEIRA", "N", 2)
    assert dimension_rules("tempo").gate(days)
    assert tuple(reports.calendar_summary(days).first())[:3] == (2013, 2027, 5479)


def test_dim_localidade(spark):
    cities = spark.createDataFrame(
        [("3550308", "São Paulo", None), ("9999999", "Nowhere", "1")], "codigo_ibge string, nome string, capital string"
    )
    places = dims.dim_localidade(spark, cities)
    assert places.count() == 30
    dense(places, "localidade_sk")
    city = places.filter("municipio = 'São Paulo'").first()
    assert (city["sigla_uf"], city["regiao"], city["sigla_regiao"], city["nome_uf"], city["capital"]) == ("SP", "SUDESTE", "SU", "São Paulo", 0)
    assert places.filter("municipio = 'Nowhere'").first()["sigla_uf"] is None
    states = spark.createDataFrame([("SP", "São Paulo", "35", "-23.5")], "sigla string, estado string, codigo_uf string, lat string")
    named = dims.dim_localidade(spark, cities, states)
    assert str(named.filter("nivel = 'UF'").first()["latitude"]) == "-23.5000000"


def test_dim_tema(dim_tema):
    dense(dim_tema, "tema_sk")
    assert member(dim_tema, "tema_sk", 0)["sigla_uf"] == "XX"
    assert {r["sigla_uf"] for r in dim_tema.filter("tema_sk > 0").collect()} == {"SP", "XX"}


def test_dim_ods(spark):
    goals = dims.dim_ods(spark)
    assert goals.count() == 21 and goals.filter("ods_sk <> ods_numero").count() == 0
    three = member(goals, "ods_sk", 3)
    assert (three["ods_nome"], three["ods_codigo"], three["ods_macrocategoria"]) == ("Saúde E Bem-Estar", "ODS-03", "Social")
    assert {r["ods_tipo"]: r["total"] for r in reports.goals_by(goals, "ods_tipo").collect()} == {"Oficial ONU": 17, "Expandido": 3}


def test_dim_ies_consolidates_roles(spark):
    df = spark.createDataFrame(
        [("1", "USP", "Univ A", "Federal", None, "USP", "Univ A", None),
         (None, "USP", "Univ A", "", "SP", "MIT", "Tech", "EUA"),
         ("2", "", "Univ B", "Federal", "RJ", "UB", "Univ B", "Brasil")],
        "CD_ENTIDADE_CAPES string, SG_ENTIDADE_ENSINO string, NM_ENTIDADE_ENSINO string, CS_STATUS_JURIDICO string, SG_UF_PROGRAMA string, "
        "SG_IES_TITULACAO string, NM_IES_TITULACAO string, NM_PAIS_IES_TITULACAO string",
    )
    out = dims.dim_ies(df)
    dense(out, "ies_sk")
    assert out.count() == 3
    a = out.filter("des_ies = 'Univ A'").first()
    assert (a["cod_entidade_capes"], a["des_status_juridico"], a["sg_uf"]) == (1, "Federal", "SP")
    # without an acronym the employer row is dropped, the alma mater row stays
    b = out.filter("des_ies = 'Univ B'").first()
    assert (b["sg_ies"], b["cod_entidade_capes"]) == ("UB", None)


def test_dim_ppg(spark):
    df = spark.createDataFrame(
        [("10", "direito", "5", "ACADEMICO", "S"), ("10", "outro", "4", None, None), (None, "x", None, None, None), ("9", None, "A", "X", "nan")],
        "codigo_do_ppg string, nome_ppg string, nota_do_ppg string, modalidade_do_ppg string, programa_em_rede string",
    )
    out = dims.dim_ppg(df)
    dense(out, "ppg_sk")
    ten, nine = out.filter("codigo_programa = '10'").first(), out.filter("codigo_programa = '9'").first()
    assert (ten["nome_programa"], ten["modalidade"], ten["programa_em_rede"], float(ten["nota_programa"])) == ("DIREITO", "Acadêmico", "Sim", 5.0)
    assert (nine["nome_programa"], nine["modalidade"], nine["programa_em_rede"], float(nine["nota_programa"])) == (UNKNOWN, "X", UNKNOWN, 0.0)


def test_dim_docente(spark):
    base = spark.createDataFrame(
        [(1, "Ana", "SIM", None, "L1", "feminino"), (1, "Ana 2", "NÃO", "1A", "L9", "F"), (2, "Bia", None, "", None, None), (3, "Eva", "S", "2", "L3", "m")],
        "ID_PESSOA bigint, NM_DOCENTE string, IN_DOUTOR string, CD_CAT_BOLSA_PRODUTIVIDADE string, ID_LATTES string, TP_SEXO_DOCENTE string",
    ).withColumns({"_arquivo": F.lit("a"), "_bloco": F.lit(0), "_linha": F.when(F.col("NM_DOCENTE") == "Ana", 0).otherwise(1)})
    details = spark.createDataFrame(
        [(1, "CPF", 2021), (1, "RG", 2022)], "id_pessoa bigint, tp_documento_docente string, ano_base int"
    )
    grants = spark.createDataFrame(
        [("L1", "ANA", "PQ-2", "2020-01-01"), ("L1", "ANA", "PQ-1", "2021-01-01"), ("", "X", "PQ", None)],
        "id_lattes string, des_beneficiario string, cod_categoria_nivel string, data_inicio_processo string",
    )
    out = dims.dim_docente(base, details, grants)
    dense(out, "docente_sk")
    assert out.columns == [c for c, _ in TABLES["dim_docente"]]
    ana = out.filter("id_pessoa = '1'").first()
    assert (ana["des_docente"], ana["bl_doutor"], ana["tipo_documento"], ana["pq_categoria_nivel"], ana["bl_bolsa_pq"], ana["cs_sexo"]) == (
        "Ana", True, "RG", "PQ-1", True, "F")
    bia = out.filter("id_pessoa = '2'").first()
    assert (bia["bl_doutor"], bia["bl_bolsa_pq"], bia["tipo_documento"], bia["pq_data_inicio"]) == (False, False, None, None)
    assert reports.professor_profile(out).first()["doutores"] == 2
    by_name = dims.dim_docente(base.drop("ID_LATTES"), details, grants)
    assert by_name.filter("id_pessoa = '1'").first()["id_lattes"] == "L1"
    assert dims.dim_docente(base, details, None).count() == 4


@pytest.fixture(scope="module")
def students(spark):
    df = spark.createDataFrame(
        [("1", "P1", "Ana", "MESTRADO", "TITULADO", "9", "2020"), ("1", "P1", "Ana", "MESTRADO", "TITULADO", "15", "2021"),
         ("2", "P1", None, "DOUTORADO", None, "3", None), ("3", "P3", "Caio", "GRADUAÇÃO", "TITULADO", "9", "2020"),
         ("4", "P4", "Duda", "Doutorado", "MATRICULADO", "nan", "2020"), (None, "P5", "Z", None, None, None, None)],
        "ID_DISCENTE string, ID_PESSOA string, NM_DISCENTE string, DS_GRAU_ACADEMICO_DISCENTE string, NM_SITUACAO_DISCENTE string, "
        "QT_MES_TITULACAO string, AN_BASE string",
    )
    return dims.dim_discente(df)


def test_dim_discente(students):
    dense(students, "discente_sk")
    assert students.count() == 5
    two = students.filter("id_discente = '2'").first()
    assert (two["nome_discente"], two["pais_nacionalidade"], two["ano_base"]) == (UNKNOWN, "BRASIL", 2025)
    assert students.filter("id_discente = '1'").first()["meses_para_titulacao"] == 15
    profile = reports.student_profile(students, with_unknown_member=False).first()
    assert (profile["total_discentes"], profile["ano_max"]) == (4, 2025)


def test_dim_titulado(students, rows):
    out = dims.dim_titulado(students)
    dense(out, "titulado_sk")
    got = rows(out.filter("titulado_sk > 0").select("id_discente_original", "nivel_titulacao", F.col("anos_para_titulacao").cast("double"), "ano_base"))
    assert got == [("1", "MESTRE", 1.2, 2021), ("2", "DOUTOR", 0.2, 2025)]


def test_dim_posdoc(spark):
    df = spark.createDataFrame(
        [("7", "Ana", "1990-05-01", "2020-01-01", "2020-07-01", "2023"), ("7", "Ana", "1990-05-01", None, None, "2022"), ("8", None, None, "2020-01-01", None, None)],
        "ID_POS_DOC string, NM_PESSOA_POS_DOC string, DT_NASCIMENTO string, DH_INICIO_POS_DOC string, DH_FIM_POS_DOC string, AN_BASE string",
    )
    out = dims.dim_posdoc(df)
    dense(out, "posdoc_sk")
    seven, eight = out.filter("id_posdoc = '7'").first(), out.filter("id_posdoc = '8'").first()
    assert (seven["idade_ano_base"], seven["faixa_etaria"], seven["situacao_posdoc"], seven["meses_duracao"]) == (33, "26-35", "CONCLUÍDO", 6)
    assert (eight["idade_ano_base"], eight["faixa_etaria"], eight["situacao_posdoc"], eight["meses_duracao"], eight["ano_base"]) == (0, UNKNOWN, "ATIVO", 0, 2025)


def test_dim_producao(spark):
    df = spark.createDataFrame(
        [(12345678.0, None, "2020", 2021.0, None, "x" * 30), (12345678.0, "ARTIGO", "2019", 2020.0, None, None), (None, "T", None, None, None, None)],
        "ID_ADD_PRODUCAO_INTELECTUAL double, NM_TIPO_PRODUCAO string, AN_PRODUCAO string, AN_BASE_PRODUCAO double, NM_IDIOMA string, DS_ISSN string",
    )
    out = dims.dim_producao(df)
    assert out.count() == 2
    one = member(out, "producao_sk", 1)
    assert (one["id_producao"], one["tipo_producao"], one["ano_producao"], one["ano_base"], one["idioma"], len(one["issn"])) == (
        "12345678", UNKNOWN, 2020, "2021", "PORTUGUÊS", 20)
    assert member(out, "producao_sk", 0)["tipo_producao"] == "Desconhecido"


def test_fact_producao(spark, students, rows):
    authors = spark.createDataFrame(
        [(1, 2020, 1, 2, "-", 1, None, 1.0, None, None), (1, 2020, 1, 2, None, 2, 177173.0, None, None, None), (2, 1900, 1, 2, "X", 1, None, None, None, 9.0)],
        "ID_ADD_PRODUCAO_INTELECTUAL bigint, AN_BASE_PRODUCAO int, ID_TIPO_PRODUCAO int, ID_SUBTIPO_PRODUCAO int, TP_AUTOR string, NR_ORDEM int, "
        "ID_PESSOA_DOCENTE double, ID_PESSOA_DISCENTE double, ID_PESSOA_POS_DOC double, ID_PESSOA_EGRESSO double",
    )
    people = spark.createDataFrame([(0, "0"), (4, "177173"), (5, "1"), (6, "1")], "sk int, id_pessoa string")
    tables = {
        "tempo": dims.dim_tempo(spark),
        "docente": people.withColumnRenamed("sk", "docente_sk"),
        "discente": people.withColumnRenamed("sk", "discente_sk"),
    }
    fact = facts.fact_producao(authors, tables)
    assert fact.columns == [c for c, _ in TABLES["fact_producao"]]
    last_day = tables["tempo"].filter("data = '2020-12-31'").first()["tempo_sk"]
    assert rows(fact.select("producao_id", "ordem_autor", "tempo_sk", "docente_sk", "discente_sk", "titulado_sk", "tipo_autor")) == [
        (1, 1, last_day, 0, 6, 0, "PARTICIPANTE EXTERNO"), (1, 2, last_day, 4, 0, 0, UNKNOWN), (2, 1, 0, 0, 0, 0, "X"),
    ]
    assert facts.author_coverage(fact).first()["com_algum_autor"] == 2
    assert orphan_keys(fact, tables["docente"], "docente_sk", "docente_sk").count() == 0


def test_fact_producao_tema(spark, dim_tema, rows):
    authors = spark.createDataFrame(
        [("10", 2020, "vacinação", 1), ("10", 2020, "vacinação", 1), ("11", 2020, "saúde mental", 1), ("12", None, None, None)],
        "`ID Produção` string, AN_BASE int, `Palavra-Chave` string, NR_ORDEM int",
    ).withColumnRenamed("ID Produção", "ID_PRODUCAO").withColumn("tema_id", F.lit(None).cast("int"))
    bridge = facts.fact_tema_ods(dim_tema)
    fact = facts.fact_producao_tema(authors, {"tempo": dims.dim_tempo(spark), "tema": dim_tema}, bridge)
    assert fact.columns == [c for c, _ in TABLES["fact_producao_tema"]]
    # tema_id exists but is empty, so the keyword is looked up
    named = fact.join(dim_tema, "tema_sk").select("producao_id", "palavra_chave", "ods_sk", "tipo_autor", "producao_tema_id")
    assert rows(named.drop("producao_tema_id")) == [(10, "vacinação", 3, UNKNOWN), (11, "saúde mental", 3, UNKNOWN), (12, UNKNOWN, 0, UNKNOWN)]
    assert sorted(r["producao_tema_id"] for r in fact.collect()) == [1, 2, 3]
    unique = facts.fact_producao_tema(authors, {}, None, row_id="unique")
    assert unique.select("producao_tema_id").distinct().count() == unique.count() == 3


def test_fact_titulacao(spark, students, dim_tema, rows):
    mappings = spark.createDataFrame(
        [(" 1", "1", "sp", "0.5"), ("P1", "x", None, "nan"), ("zz", "99", "rj", None)],
        "`Hash ID` string, tema_id string, `UF-Tema` string, score_final string",
    )
    tables = {"titulado": dims.dim_titulado(students), "tema": dim_tema, "tempo": None}
    fact = facts.fact_titulacao(mappings, tables)
    got = rows(fact.select("hash_id", "tema_id", "uf_tema", F.col("score_final").cast("double"), "match_status", F.col("tema_sk") > 0))
    assert got == [("1", 1, "SP", 0.5, "MATCHED", True), ("P1", 0, "", 0.0, "MATCHED", False), ("zz", 99, "RJ", 0.0, "UNMATCHED", False)]
    absent = facts.fact_titulacao(mappings, {})
    assert {r["match_status"] for r in absent.collect()} == {"DIM_ABSENT"}


def test_bridge_and_goal_reports(spark, dim_tema, rows):
    bridge = facts.fact_tema_ods(dim_tema)
    goals = dims.dim_ods(spark)
    pairs = rows(bridge.join(dim_tema, "tema_sk").select("palavra_chave", "ods_sk", F.col("nivel_confianca").cast("double")))
    assert pairs == [("saúde mental", 3, 80.0), ("vacinação", 3, 80.0), ("água", 14, 60.0), ("água", 6, 80.0)]
    assert len(pairs) == 4
    assert tuple(reports.goals_by_themes(bridge, goals, 1).first())[2:] == (2, 2)
    few = reports.under_covered_goals(bridge, goals)
    assert few.count() == 20 and few.first()["total_temas"] == 0
    assert facts.bridge_summary(bridge).first()["temas"] == 3
    fact = spark.createDataFrame([(1, r["tema_sk"]) for r in bridge.collect()], "ppg_sk int, tema_sk int")
    programme = spark.createDataFrame([(1, "DIREITO")], "ppg_sk int, nome_programa string")
    assert tuple(reports.goal_coverage_by_programme(fact, bridge, goals, programme).first()) == ("DIREITO", 3, "3, 6, 14")


def test_bridge_has_one_row_a_pair_and_dense_ids(spark, rows):
    """Ids used to be those of partitions, and a theme key that came twice made its pairs twice."""
    words = [(k, word) for k in (9, 2, 5, 7) for word in ("água", "saúde mental")] + [(1, "zzz"), (3, None), (0, "água")]
    themes = spark.createDataFrame(words, "tema_sk int, palavra_chave string").repartition(4, "tema_sk")
    bridge = facts.fact_tema_ods(themes)
    got = [tuple(r) for r in bridge.select("tema_ods_id", "tema_sk", "ods_sk", F.col("nivel_confianca").cast("int")).orderBy("tema_ods_id").collect()]
    pairs = [(k, goal, sure) for k in (2, 5, 7, 9) for goal, sure in ((3, 80), (6, 80), (14, 60))]
    assert got == [(i, *pair) for i, pair in enumerate(pairs, 1)]


def test_simplified_theme_fact_and_reports(spark, themes, dim_tema, rows, tmp_path):
    dim_ies = spark.createDataFrame(
        [(0, "XX", UNKNOWN, UNKNOWN), (1, "SP", "Univ A", "Particular"), (2, "SP", "Univ B", "Federal"), (3, "RJ", "Univ C", "Federal")],
        "ies_sk int, sg_uf string, des_ies string, des_status_juridico string",
    )
    cities = spark.createDataFrame([("3550308", "São Paulo")], "codigo_ibge string, nome string")
    places = dims.dim_localidade(spark, cities)
    days = dims.dim_tempo(spark)
    fact = facts.fact_temas(themes, dim_tema, dim_ies, places, days)
    in_state = dim_tema.filter("sigla_uf = 'SP'").count()
    assert fact.count() == in_state * 2
    assert fact.select("tempo_sk").distinct().collect()[0][0] == days.filter("data = '2025-01-01'").first()["tempo_sk"]
    state = reports.themes_by_state(fact, dim_tema, places).first()
    assert (state["sigla_uf"], state["qtd_temas_uf"], state["qtd_ies"], state["total_associacoes"]) == ("SP", 2, 2, in_state * 2)
    by_category = {r["categoria_administrativa"]: r["qtd_temas_categoria"] for r in reports.themes_by_category(fact, dim_tema, dim_ies).collect()}
    assert by_category == {"PRIVADO": 2, "PÚBLICO": 2}
    assert reports.themes_by_region(fact, dim_tema, places).first()["regiao"] == "SUDESTE"
    assert [r["des_ies"] for r in reports.top_institutions(fact, dim_tema, dim_ies, places).collect()] == ["Univ A", "Univ B"]
    # no pair is copied for a second distinct count, and a state's pairs are dealt over tasks
    for report in (reports.themes_by_state(fact, dim_tema, places), reports.themes_by_category(fact, dim_tema, dim_ies), reports.themes_by_region(fact, dim_tema, places)):
        pairs_first = report._jdf.queryExecution().optimizedPlan().toString()
        assert "ies_sk" not in "".join(line for line in pairs_first.splitlines() if "Expand [" in line)
    dealt = ThemeFactors(
        spark.range(3000).selectExpr("CAST(id AS INT) AS tema_sk", "CAST(id AS INT) AS tema_id", "'SP' AS _uf"), *[getattr(ThemeFactors.of(themes, dim_tema, dim_ies, places), c) for c in ("members", "places")]
    ).pairs()
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 6000 and len(sizes) > 1
    # the same counts from the factors, also from stored ones, and no pairs on the way
    factors = ThemeFactors.of(themes, dim_tema, dim_ies, places)
    factors.save(str(tmp_path / "factors"))
    for held in (factors, ThemeFactors.open(spark, str(tmp_path / "factors"))):
        assert rows(held.by_state()) == rows(reports.themes_by_state(fact, dim_tema, places))
        assert rows(held.by_category()) == rows(reports.themes_by_category(fact, dim_tema, dim_ies))
        assert rows(held.by_region()) == rows(reports.themes_by_region(fact, dim_tema, places))
        assert rows(held.by_institution()) == rows(reports.top_institutions(fact, dim_tema, dim_ies, places))
        assert rows(held.pairs().select("tema_sk", "ies_sk", "localidade_sk")) == rows(fact.select("tema_sk", "ies_sk", "localidade_sk"))
    with pytest.raises(ValueError, match="members"):
        ThemeFactors.of(themes, dim_tema, dim_ies.limit(0), places).save(str(tmp_path / "none"))


def test_raw_reports_agree_with_the_pairs(spark, rows):
    """The reports never form the theme-institution pairs; a cross join gives the same."""
    raw_tema = spark.createDataFrame([("SP", 1), ("SP", 2), ("SP", 2), ("RJ", 2), ("RJ", 3), (None, 4)], "uf string, tema_id int")
    raw_ies = spark.createDataFrame(
        [("A", "SP", "Particular"), ("B", "SP", "Federal"), ("C", "RJ", "Particular"), ("C", "RJ", "Particular")],
        "nome_ies string, uf string, status_juridico_ppg string",
    )
    raw_tema.createOrReplaceTempView("rt")
    raw_ies.createOrReplaceTempView("ri")
    pairs = "FROM rt CROSS JOIN ri WHERE rt.uf = ri.uf"
    category = spark.sql(f"SELECT CASE WHEN status_juridico_ppg = 'Particular' THEN 'PRIVADO' ELSE 'PÚBLICO' END AS c, count(DISTINCT tema_id) AS n {pairs} GROUP BY 1")
    assert rows(reports.raw_themes_by_category(raw_tema, raw_ies)) == rows(category)
    institutions = spark.sql(f"SELECT nome_ies, ri.uf, status_juridico_ppg, count(DISTINCT tema_id) AS n {pairs} GROUP BY ALL")
    assert rows(reports.raw_top_institutions(raw_tema, raw_ies)) == rows(institutions)


def test_empty_tables_have_all_columns(spark):
    for table in TABLES:
        assert empty_table(spark, table).columns == [c for c, _ in TABLES[table]]


def test_facts_keep_states_and_refuse_what_does_not_fit(spark, rows):
    mappings = spark.createDataFrame(
        [("1", "PARANÁ", "sp"), ("2", "São Paulo", " "), ("3", "PA", None)], "hash_id string, uf_tema string, uf_pesquisador string"
    )
    fact = facts.fact_titulacao(mappings, {})
    assert rows(fact.select("hash_id", "uf_tema", "uf_pesquisador")) == [("1", "PR", "SP"), ("2", "SP", ""), ("3", "PA", "")]
    long = mappings.withColumn("hash_id", F.repeat("hash_id", 200))
    with pytest.raises(Exception, match="hash_id holds 128"):
        facts.fact_titulacao(long, {}).collect()
    assert schemas.misfits(long, "fact_titulacao").first()["hash_id"] == 3
    wide = spark.createDataFrame([("x" * 200, 3_000_000_000)], "model string, ano_base long")
    cut = schemas.conform(wide, "fact_titulacao", on_misfit="cut").first()
    assert (len(cut["model"]), cut["ano_base"]) == (120, None)
    with pytest.raises(Exception):
        schemas.conform(wide, "fact_titulacao").collect()


def test_the_year_of_a_fact_is_no_join(spark):
    mappings = spark.createDataFrame([("1",)], "hash_id string")
    tempo = spark.createDataFrame([(7, 2023), (9, 2023), (11, 2024)], "tempo_sk int, ano int")
    fact = facts.fact_titulacao(mappings, {"tempo": tempo})
    assert fact.first()["tempo_sk"] == 9
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_equal_rows_without_an_id_all_stay(spark):
    twice = with_natural_id(spark.createDataFrame([("a",), ("a",), ("b",)], "nome string"), "id_posdoc", "posdoc")
    assert twice.select("id_posdoc").distinct().count() == 3
    keyless = spark.createDataFrame([("x",), ("y",)], "OUTRA string")
    assert raw.raw_docente(keyless).count() == 2


@pytest.mark.parametrize("name, most", [("authorship_fact", 4), ("authorship_theme_fact", 12)])
def test_roles_need_no_exchange_of_their_own(spark, name, most):
    import registered

    registered.load_all()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        fact = registered.QUERIES[name](spark, "/root/testdata/sf0.001")
        plan = fact._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") <= most and "BroadcastHashJoin" not in plan


def test_rows_of_a_repetitive_sheet_are_never_broadcast(spark):
    # many rows of few names: the files of the rows are tiny, the rows are not
    sheet = spark.range(60_000).selectExpr(
        "concat('macro ', id % 3) AS macro_tema_1_label", "concat('T', id % 5) AS TEMA",
        "concat_ws('|', concat('a keyword of some length ', id % 7), 'água', '') AS `PALAVRA-CHAVE`", "'SP' AS UF",
    )
    themes = raw.raw_tema(sheet)
    plan = themes._jdf.queryExecution().executedPlan().toString()
    assert "BuildRight" in plan and "BuildLeft" not in plan
    assert themes.count() == 180_000 and themes.agg(F.max("tema_id"), F.max("palavrachave_id")).first()[:] == (15, 9)


def test_ids_of_many_names_are_joined_by_shuffle(spark):
    # 200,000 sorted names make a file below Spark's limit, but 20 MB of rows
    names = spark.range(200_000).select(F.format_string("a name of some length %09d", "id").alias("name"))
    ids = factorized(names, "name_id", ["name"])
    plan = ids._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert ids.filter("name_id = 1 + int(substr(name, -9))").count() == 200_000


def test_long_names_are_not_broadcast(spark, rows):
    # 12,000 names are few rows and, as their texts repeat, small files, but 24 MB of text
    sheet = spark.range(12_000).select(
        F.lit("macro").alias("macro_tema_1_label"), F.concat(F.lit("T"), F.col("id") % 3).alias("TEMA"),
        F.concat(F.repeat(F.lit("a long name "), 170), F.format_string("%09d", "id")).alias("PALAVRA-CHAVE"),
        F.when(F.col("id") % 2 == 0, "BAHIA").otherwise("ACRE").alias("UF"),
    )
    themes = raw.raw_tema(sheet)
    plan = themes._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert themes.filter("palavrachave_id = 1 + int(substr(palavrachave_nome, -9))").count() == 12_000
    places = dims.dim_localidade(spark, spark.createDataFrame([("2900001", "A"), ("1200001", "B")], "codigo_ibge string, nome string"))
    assert rows(reports.raw_themes_by_region(themes, places)) == [("NORDESTE", 3), ("NORTE", 3)]


def test_loaded_bytes_count_texts_by_length(spark):
    table = spark.createDataFrame([("x" * 1000, 1), ("á" * 50, 2), ("short", 3), (None, 4)], "t string, n int")
    assert loaded_bytes(table) == 4 * (20 + 4 + 2 * 8 + 32) + 980 + 80
    assert loaded_bytes(table.select("n")) == 4 * (4 + 8 + 32) and loaded_bytes(table.limit(0)) == 0


def test_customers_of_a_small_file_are_not_broadcast(spark, tmp_path):
    # 200,000 customers make a file below Spark's limit, but 16 MB of rows
    tables = {
        "customer": spark.range(200_000).selectExpr("id AS c_custkey", "1L AS c_nationkey", "CAST(1.5 AS double) AS c_acctbal"),
        "supplier": spark.range(3).selectExpr("id AS s_suppkey", "concat('Supplier ', id) AS s_name", "id AS s_nationkey", "CAST(1 AS double) AS s_acctbal"),
        "orders": spark.range(6).selectExpr("id AS o_orderkey", "id * 7 AS o_custkey", "'F' AS o_orderstatus"),
        "lineitem": spark.range(12).selectExpr("id % 7 AS l_orderkey", "id % 4 AS l_suppkey"),
    }
    for name, table in tables.items():
        table.write.parquet(str(tmp_path / f"{name}.parquet"))
    rows = warehouse.institution_file(spark, str(tmp_path))
    joins = [line for line in rows._jdf.queryExecution().executedPlan().toString().splitlines() if "Join" in line]
    assert any("SortMergeJoin [o_custkey" in line for line in joins)
    assert not any("BroadcastHashJoin [o_custkey" in line for line in joins)
    # orders 0 to 5 and suppliers 0 to 2 are known
    assert rows.count() == len({(i % 7, i % 4) for i in range(12) if i % 7 < 6 and i % 4 < 3})


def test_theme_factors_broadcast_no_themes(spark, rows):
    listed = spark.range(4).selectExpr("CAST(1 + id % 2 AS int) AS tema_id", "concat('T', id % 2) AS tema_nome", "if(id < 2, 'BAHIA', 'ACRE') AS uf")
    themes = spark.range(5).selectExpr("CAST(id AS int) AS tema_sk", "CAST(1 + id % 2 AS int) AS tema_id", "concat('T', id % 2) AS tema_nome")
    members = spark.range(1).selectExpr("1 AS ies_sk", "'A' AS des_ies", "'Federal' AS des_status_juridico", "'BA' AS sg_uf")
    places = spark.range(1).selectExpr("'UF' AS nivel", "'BA' AS sigla_uf", "1 AS localidade_sk", "'NORDESTE' AS regiao")
    found = ThemeFactors.of(listed, themes, members, places).themes
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [tema_id" in plan and "BroadcastHashJoin [tema_id" not in plan
    assert rows(found) == [(sk, 1 + sk % 2, uf) for sk in range(1, 5) for uf in ("AC", "BA")]
