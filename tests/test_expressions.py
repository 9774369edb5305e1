"""Scalar expressions on edge values: null, blank, 'nan', accents, halves, band edges."""

import datetime as dt

from pyspark.sql import functions as F

from starloom.functions import dates, labels, numbers, text
from starloom.operators.filters import is_domestic, is_graduate, year_in_name


def values(spark, inputs, expression, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
    return [r[0] for r in frame.orderBy("i").select(expression(F.col("v"))).collect()]


def test_clean_text(spark):
    assert values(spark, [None, " a \r\n b\t c ", ""], text.clean_text) == ["", "a b c", ""]


def test_tax_number(spark):
    assert values(spark, ["123.456.789-01", "12", None], text.tax_number) == ["12345678901", "", ""]


def test_blank_to_null(spark):
    assert values(spark, [" x ", "", " nan", "NULL", "None", None], text.blank_to_null) == ["x"] + [None] * 5


def test_identifier_keeps_inner_point_zero(spark):
    given = ["177173.0", "1.05", " ab ", "nan", "None", "", None]
    assert values(spark, given, text.identifier) == ["177173", "1.05", "AB", None, None, None, None]


def test_ids_by_column_type(spark):
    frame = spark.createDataFrame([(12345678.0, 7, "x.0"), (1.5, None, None)], "d double, i bigint, s string")
    got = frame.select(*[text.id_text(frame, c) for c in ("d", "i", "s")]).collect()
    assert [tuple(r) for r in got] == [("12345678", "7", "x"), ("1.5", None, None)]
    assert [r[0] for r in frame.select(text.float_id("d")).collect()] == ["12345678", "1"]


def test_numbers_never_raise(spark):
    given = ["12.7", "-3.9", "nan", "", None, "abc", "1e3", "12d", "1e300"]
    assert values(spark, given, numbers.safe_int) == [12, -3, 0, 0, 0, 0, 1000, 0, 0]
    assert values(spark, given[:6], lambda c: numbers.safe_float(c, -1)) == [12.7, -3.9, -1, -1, -1, -1]


def test_half_even_years(spark):
    assert values(spark, [3, 9, 15, 24], numbers.months_to_years, "int") == [0.2, 0.8, 1.2, 2.0]


def test_title_words(spark):
    assert values(spark, ["saúde e bem-estar", "(paz) d'água"], text.title_words) == ["Saúde E Bem-Estar", "(Paz) D'Água"]


def test_zero_pad_keeps_longer(spark):
    assert values(spark, ["7", "12345"], lambda c: text.zero_pad(c, 3)) == ["007", "12345"]


def test_split_terms(spark):
    got = values(spark, ["a|b; c,d/e,", None, "x\ny"], text.split_terms)
    assert got == [["a", "b", "c", "d", "e", ""], [""], ["x", "y"]]


def test_flags_and_codes(spark):
    assert values(spark, ["sim", "S", "NÃO", None], text.yes_flag) == [True, True, False, False]
    assert values(spark, ["masculino", "F", "x", " ", None], text.sex_code) == ["M", "F", "O", None, None]
    assert values(spark, ["Mestrado em X", "DOUTORADO", "outro", None], text.degree_level) == ["MESTRE", "DOUTOR", "OUTROS", "OUTROS"]
    assert values(spark, ["-", None, "DOCENTE"], text.author_type) == ["PARTICIPANTE EXTERNO", "NÃO INFORMADO", "DOCENTE"]
    assert values(spark, ["Particular", "Federal", None], text.public_or_private) == ["PRIVADO", "PÚBLICO", "PÚBLICO"]


def test_age_bands(spark):
    ages = [0, 1, 25, 26, 65, 66, 100, 101, None]
    unknown = "NÃO INFORMADO"
    expected = [unknown, "ATÉ 25", "ATÉ 25", "26-35", "56-65", "ACIMA DE 65", "ACIMA DE 65", unknown, unknown]
    assert values(spark, ages, dates.age_band, "int") == expected


def test_dates(spark):
    assert values(spark, ["31/12/2023", "2023-13-01", None], dates.day_month_year) == [dt.date(2023, 12, 31), None, None]
    free = values(spark, ["2020-02-29", "01/03/2021", "never"], lambda c: dates.any_timestamp(c).cast("date"))
    assert free == [dt.date(2020, 2, 29), dt.date(2021, 3, 1), None]


def test_months_use_whole_days(spark):
    frame = spark.createDataFrame(
        [("2020-01-01 12:00:00", "2020-02-01 11:00:00"), ("2020-01-01 00:00:00", None)], "a string, b string"
    ).select(F.col("a").cast("timestamp").alias("a"), F.col("b").cast("timestamp").alias("b"))
    # 30 whole days, although the dates are 31 days apart
    assert [r[0] for r in frame.select(dates.months_between_days("a", "b")).collect()] == [1, 0]


def test_states(spark):
    assert values(spark, ["SÃO PAULO", "São Paulo", "sp", "Xis", None], labels.state_code) == ["SP", "SP", "SP", "XX", "XX"]
    assert values(spark, ["CENTRO-OESTE", "nordeste", "çx"], text.region_initials) == ["CE", "NO", "CX"]


def test_goal_numbers_and_labels(spark):
    assert values(spark, ["ODS 4", "17", "4.0", "none", None], labels.goal_number) == [4, 17, 4, None, None]
    got = values(spark, [20, 1, 99], lambda c: labels.goal_macro_labels(c), "int")
    assert got == [["Econômica", "Institucional / Governança (Transversal)"], ["Social"], []]
    assert values(spark, [18, 99], lambda c: labels.goal_macro(c)["ods_macrocategoria"], "int") == ["Social", "Expansão Complementar"]
    assert values(spark, [99], lambda c: labels.goal_macro(c)["ods_associados"], "int") == ["ODS 99"]


def test_domestic_and_graduates(spark):
    assert values(spark, [None, "", "República do Brasil", "Chile"], is_domestic) == [True, True, True, False]
    frame = spark.createDataFrame(
        [("Mestrado", "TITULADO", None), ("DOUTORADO", "MATRICULADO", "12"), ("DOUTORADO", None, "0"), ("GRADUAÇÃO", "TITULADO", "9")],
        "d string, s string, m string",
    )
    assert [r[0] for r in frame.select(is_graduate("d", "s", "m")).collect()] == [True, True, False, False]


def test_year_in_name_takes_the_last(spark):
    names = ["add_producao_2022.parquet", "add_2021_producao_2023_x.parquet", "add_producao.parquet", "a_20233.parquet"]
    assert values(spark, names, year_in_name) == ["2022", "2023", None, None]


def test_append_note(spark):
    assert values(spark, ["old", None], lambda c: text.append_note(c, "new")) == ["old | new", "new"]


def test_impossible_dates_are_not_parsed(spark):
    texts = ["99/99/9999", "32/01/2020", "00/01/2020", "01/13/2020", "01/00/2020", "no date", "31/02/2020", " 29/02/2020 ", None]
    assert values(spark, texts, dates.day_month_year) == [None] * 7 + [dt.date(2020, 2, 29), None]
    # the parser fails by exceptions; it gets only texts that pass a test before
    plan = spark.range(1).select(F.col("id").cast("string").alias("x")).select(dates.day_month_year("x"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("RLIKE") < plan.index("gettimestamp")
