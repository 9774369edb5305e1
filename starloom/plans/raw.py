"""Raw tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.fixed_values import MISSING_WORDS
from starloom.functions.dates import day_month_year
from starloom.functions.numbers import safe_int, to_double
from starloom.functions.text import blank_to_null, split_terms
from starloom.operators.dedup import input_order, one_per_key, without_position
from starloom.operators.keys import factorized, surrogate_key
from starloom.operators.shape import (
    apply_types, blanks_to_null, drop_empty, feed_name, find_like, first_present, leading, present, rename_all,
    select_renamed, snake_name, stack_rows, with_lineage,
)
from starloom.session import by_loaded_size, stored
from starloom.sources.variants import found_types, page_records, typed

# Number and upper-case columns and leading columns of the professor files.
PROFESSOR_NUMBERS = [
    "ano_base", "id_pessoa", "an_nascimento_docente", "an_titulacao", "cd_area_avaliacao", "cd_programa_ies",
    "cd_conceito_programa", "cd_entidade_capes", "cd_entidade_emec", "cd_area_basica_titulacao",
    "id_add_foto_programa", "id_add_foto_programa_ies",
]
PROFESSOR_UPPER = [
    "sg_entidade_ensino", "sg_uf_programa", "tp_documento_docente", "ds_categoria_docente", "in_doutor",
    "sg_ies_titulacao",
]
PROFESSOR_KEY = ["id_pessoa", "ano_base", "cd_programa_ies"]
PROFESSOR_FIRST = [
    "id_pessoa", "nm_docente", "ano_base", "nm_entidade_ensino", "sg_uf_programa", "ds_categoria_docente",
    "nm_programa_ies", "nm_area_avaliacao", "in_doutor", "fonte_arquivo", "created_at",
]

# Text and number columns of the programme file.
PROGRAMME_TEXT = [
    "nome_da_ies", "nome_da_regiao_da_ies", "sigla_da_regiao_da_ies", "uf_da_ies", "status_juridico_da_ies",
    "nome_ppg", "modalidade_do_ppg", "situacao_do_ppg", "programa_em_rede", "grande_area_do_ppg",
    "area_de_conhecimento_do_ppg", "area_de_avaliacao_do_ppg",
]
PROGRAMME_NUMBERS = [
    "ano_base", "codigo_capes_da_ies", "cd_regiao_ibge", "codigo_grande_area_do_ppg",
    "codigo_area_de_conhecimento_do_ppg", "id_area_de_avaliacao_do_ppg", "total_de_cursos_do_ppg",
    "quantidade_de_docentes_no_ppg", "quantidade_de_discentes_matriculados_no_ppg",
]

# Columns of the grant file.
GRANT_COLUMNS = {
    "# Id Lattes": "id_lattes",
    "# Nome Beneficiário": "des_beneficiario",
    "# Nome País": "des_pais",
    "# Nome Região": "des_regiao",
    "# Nome UF": "des_uf",
    "# Nome Cidade": "des_cidade",
    "# Nome Grande Área": "des_grande_area",
    "# Nome Área": "des_area",
    "# Nome Sub-área": "des_subarea",
    "# Cod Modalidade": "cod_modalidade",
    "# Cod Categoria Nível": "cod_categoria_nivel",
    "# Nome Instituto": "des_instituto",
    "# Data Início Processo": "data_inicio_processo",
    "# Data Término Processo": "data_termino_processo",
}

# Types of the institution feeds.
FEED_TYPES = {
    "an_base": "bigint", "cod_entidade_capes": "bigint", "cod_entidade_emec": "bigint",
    "ano_inicio_programa": "bigint", "cod_conceito_programa": "bigint",
}
CATALOG_TYPES = {
    "cd_entidade_ensino": "bigint", "cd_entidade_capes": "bigint", "cd_entidade_emec": "bigint",
    "ano_referencia": "int", "an_base": "int",
}
# Institution columns of the catalogue resources, each with its other spellings.
CATALOG_COLUMNS = {
    "nm_entidade_ensino": ["NM_ENTIDADE_ENSINO", "nm_entidade_ensino", "nome_entidade", "ies_nome"],
    "sg_entidade_ensino": ["SG_ENTIDADE_ENSINO", "sg_entidade_ensino", "sigla_entidade", "ies_sigla"],
    "cd_entidade_ensino": ["CD_ENTIDADE_ENSINO", "cd_entidade_ensino", "codigo_entidade", "ies_codigo"],
    "cd_entidade_capes": ["CD_ENTIDADE_CAPES", "cd_entidade_capes", "codigo_capes"],
    "cd_entidade_emec": ["CD_ENTIDADE_EMEC", "cd_entidade_emec", "codigo_emec"],
    "ds_dependencia_administrativa": ["DS_DEPENDENCIA_ADMINISTRATIVA", "ds_dependencia_administrativa", "dependencia"],
    "cs_status_juridico": ["CS_STATUS_JURIDICO", "cs_status_juridico", "status_juridico"],
    "nm_municipio_entidade_ensino": ["NM_MUNICIPIO_ENTIDADE_ENSINO", "nm_municipio_entidade_ensino", "municipio"],
    "sg_uf_entidade_ensino": ["SG_UF_ENTIDADE_ENSINO", "sg_uf_entidade_ensino", "uf"],
    "nm_regiao_entidade_ensino": ["NM_REGIAO_ENTIDADE_ENSINO", "nm_regiao_entidade_ensino", "regiao"],
    "an_base": ["AN_BASE", "an_base", "ano_base"],
}
CATALOG_KEY = ["cd_entidade_ensino", "cd_entidade_capes", "nm_entidade_ensino"]


def _csv_text(name: str) -> Column:
    """Trimmed text of a CSV cell, '' for a missing one."""
    cell = F.col(name)
    return F.when(cell.isNull() | cell.isin(MISSING_WORDS), "").otherwise(F.trim(cell))


def raw_docente(files: DataFrame) -> DataFrame:
    """B1: professors of several years, the last row per person, year and programme.

    ``files`` comes from :func:`starloom.sources.readers.csv_files`.
    """
    renamed = rename_all(files, lambda c: "ano_base" if c == "AN_BASE" else c if c.startswith("_") else c.lower())
    kept = ("fonte_arquivo", "created_at")
    texts = {c: _csv_text(c) for c, kind in renamed.dtypes if kind == "string" and c not in kept and c[0] != "_"}
    clean = renamed.withColumns(texts)
    clean = clean.withColumns({c: safe_int(c) for c in present(clean, PROFESSOR_NUMBERS)})
    clean = clean.withColumns({c: F.upper(c) for c in present(clean, PROFESSOR_UPPER)})
    keys = present(clean, PROFESSOR_KEY)
    # without any key column no two rows are of the same person
    last = one_per_key(clean, keys, input_order(clean, last_first=True)) if keys else clean
    return leading(without_position(last), PROFESSOR_FIRST)


def raw_ppg(file: DataFrame, source: str = "ppg_2024.csv", with_id: bool = False) -> DataFrame:
    """B2: programmes, header to snake case, blanks to null, bad numbers to null (Q11: so for codes)."""
    def name(header: str) -> str:
        snake = snake_name(header)
        # two headers carry an explanation after the name
        return next((n for n in ("modalidade_do_ppg", "programa_em_rede") if snake.startswith(n)), snake)

    renamed = rename_all(file, name)
    texts = {c: blank_to_null(c) for c in present(renamed, [*PROGRAMME_TEXT, "codigo_do_ppg"])}
    numbers = {c: to_double(c).try_cast("int") for c in present(renamed, PROGRAMME_NUMBERS)}
    grade = {"nota_do_ppg": to_double("nota_do_ppg").try_cast("decimal(3,1)")} if "nota_do_ppg" in renamed.columns else {}
    clean = with_lineage(renamed.withColumns({**texts, **numbers, **grade}), source)
    if not with_id:
        return clean
    return surrogate_key(clean, "id", ["codigo_do_ppg", *[c for c in clean.columns if c != "codigo_do_ppg"]])


def raw_tema(sheet: DataFrame, source: str = "temas.csv") -> DataFrame:
    """Themes from the exported sheet, one row per keyword, sorted dense ids."""
    macro = find_like(sheet, "macro_tema_1_label", ["macro"])
    theme = find_like(sheet, "TEMA", ["tema"])
    words = find_like(sheet, "PALAVRA-CHAVE", ["palavra", "chave"])
    state = find_like(sheet, "UF", ["uf", "estado"])
    if not macro or not theme:
        raise ValueError("macro-theme and theme columns are required")

    def text(name: str | None) -> Column:
        return F.trim(F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))) if name else F.lit("")

    cell = F.col(f"`{words}`") if words else F.lit("")
    rows = sheet.select(
        text(macro).alias("macrotema_nome"),
        text(theme).alias("tema_nome"),
        F.upper(text(state)).alias("uf"),
        F.explode(split_terms(cell)).alias("palavrachave_nome"),
    )
    # the sheet is exploded once; ids are given to the distinct names, and the rows meet them in one join
    rows = stored(rows)
    names = ["macrotema_nome", "tema_nome", "palavrachave_nome"]
    ids = stored(rows.select(*names).distinct())
    ids = factorized(ids, "macrotema_id", ["macrotema_nome"])
    ids = factorized(ids, "tema_id", ["macrotema_nome", "tema_nome"])
    ids = factorized(ids, "palavrachave_id", ["palavrachave_nome"])
    ids = stored(ids.withColumnsRenamed({c: f"_{c}" for c in names}))
    # every row has its ids; as a left join it can only broadcast the distinct names, never the rows
    same = [rows[c].eqNullSafe(ids[f"_{c}"]) for c in names]
    return with_lineage(
        rows.join(by_loaded_size(ids), same, "left").select(
            "macrotema_id", "macrotema_nome", "tema_id", "tema_nome", "palavrachave_id", "palavrachave_nome", "uf"
        ),
        source,
    )


def raw_fomentopq(file: DataFrame, source: str = "fomento.csv") -> DataFrame:
    """Productivity grants with typed id and dates."""
    first = file.columns[0]
    renamed = select_renamed(file, {first: "id_registro", **GRANT_COLUMNS})
    clean = renamed.withColumns({c: _csv_text(c) for c in renamed.columns})
    clean = clean.withColumn("id_registro", safe_int("id_registro"))
    clean = clean.withColumns({c: F.upper(c) for c in present(clean, ["cod_modalidade", "cod_categoria_nivel"])})
    dates = present(clean, ["data_inicio_processo", "data_termino_processo"])
    return with_lineage(clean.withColumns({c: day_month_year(c) for c in dates}), source)


def raw_ies(records: DataFrame) -> DataFrame:
    """Institution feed with standard names, typed numbers, blanks null.

    Columns and rows without any value are dropped before blanks become null,
    so a column of blanks stays.
    """
    return apply_types(blanks_to_null(drop_empty(rename_all(records, feed_name))), FEED_TYPES)


def raw_ies_pages(pages: DataFrame, text: str) -> DataFrame:
    """B5 from landed pages whose fields are not known: they are found by one aggregate over all records.

    Numbers that their column can't hold are in ``_desvios`` instead of lost.
    """
    records = page_records(pages, text)
    types = {name: FEED_TYPES.get(feed_name(name), found) for name, found in found_types(records).items()}
    return blanks_to_null(rename_all(typed(records, types).dropna("all"), feed_name))


def raw_ies_catalog(pages: DataFrame, text: str, rank: str, year: str) -> DataFrame:
    """B6 from one table of landed pages: ``rank`` orders the resources, ``year`` is the one that a resource's name mentions.

    Which spelling of a column a resource uses is an aggregate over its records, so any number of resources is one
    scan and one plan.  All columns exist; what types don't hold is in ``_desvios``.
    """
    records = page_records(pages, text, [rank, year])
    members = F.try_variant_get("registro", "$", "map<string,variant>")
    # position of the first spelling that any record of the resource has
    used = records.select(rank, members.alias("_m")).groupBy(rank).agg(*[
        F.min(F.coalesce(*[F.when(F.map_contains_key("_m", s), i + 1) for i, s in enumerate(spellings)])).alias(f"_{target}")
        for target, spellings in CATALOG_COLUMNS.items()
    ])
    used = used.filter(F.coalesce(*[f"_{t}" for t in CATALOG_COLUMNS]).isNotNull()).withColumnRenamed(rank, "_rank")
    keys = {t: F.element_at(F.array(*map(F.lit, s)), F.col(f"_{t}")) for t, s in CATALOG_COLUMNS.items()}
    rows = typed(
        records.join(used, F.col(rank) == F.col("_rank")), {t: CATALOG_TYPES.get(t, "string") for t in CATALOG_COLUMNS},
        [F.col(rank).alias("_ordem"), F.col(year).cast("int").alias("ano_referencia")], keys=keys, report_new=False,
    )
    return with_lineage(one_per_key(rows, CATALOG_KEY, ["_ordem"]).drop("_ordem"), "catalog")


def raw_ies_api(resources: Sequence[tuple[DataFrame, int | None]]) -> DataFrame:
    """Institutions of several catalogue resources, one row per institution.

    Each resource comes with the year that its name mentions.  The first row
    per key wins in the order of the resources.
    """
    frames = []
    for rank, (frame, year) in enumerate(resources):
        found = {t: first_present(frame, c) for t, c in CATALOG_COLUMNS.items()}
        columns = [F.col(source).cast("string").alias(target) for target, source in found.items() if source]
        if columns:
            rows = frame.select(*columns).distinct()
            if year is not None:
                rows = rows.withColumn("ano_referencia", F.lit(year))
            frames.append(rows.withColumn("_ordem", F.lit(rank)))
    if not frames:
        raise ValueError("no resource has institution columns")
    rows = stack_rows(frames)
    keys = present(rows, CATALOG_KEY)
    unique = one_per_key(rows, keys, ["_ordem"]) if keys else rows.distinct()
    return with_lineage(apply_types(unique.drop("_ordem"), CATALOG_TYPES), "catalog")
