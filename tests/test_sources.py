"""Readers and writers on small landed files."""

import json

import pytest
from pyspark.sql import functions as F

from starloom.plans import raw
from starloom.plans.job import Job, run_job
from starloom.operators.maintain import deactivate, insert_missing, promote
from starloom.operators.quality import QualityError
from starloom.sources import readers, variants, writers
from starloom.sources.ledger import LedgerTable, one_parquet
from starloom.sources.ranged import RangedTable
from starloom.sources.versions import ConcurrentLoad, VersionedTable


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_csv_files_union_by_name_with_position(spark, tmp_path, rows):
    a = write(tmp_path / "p-2021.csv", 'AN_BASE;NM;X\n2021;"João; ""Jr""\nSilva";1\n2021;b;2\n', "latin-1")
    b = write(tmp_path / "p-2022.csv", "X;AN_BASE;NOVA\n7;2022;é\n", "latin-1")
    df = readers.csv_files(spark, [b, a, str(tmp_path / "absent.csv")], multi_line=True, missing="skip")
    assert rows(df.select("AN_BASE", "NM", "X", "NOVA", "fonte_arquivo")) == sorted([
        ("2021", 'João; "Jr"\nSilva', "1", None, "p-2021.csv"), ("2021", "b", "2", None, "p-2021.csv"),
        ("2022", None, "7", "é", "p-2022.csv"),
    ], key=repr)
    first = df.filter("_arquivo = 'p-2021.csv'").orderBy("_bloco", "_linha").first()
    assert first["X"] == "1"
    with pytest.raises(readers.SourceMissing):
        readers.csv_files(spark, [str(tmp_path / "absent.csv")], missing="skip")
    with pytest.raises(readers.SourceMissing, match="absent"):
        readers.csv_files(spark, [a, str(tmp_path / "absent.csv")])


def test_csv_keeps_leading_zeros(spark, tmp_path):
    path = write(tmp_path / "f.csv", "id,nome\n007,São\n")
    assert tuple(readers.csv(spark, path).first()) == ("007", "São")


def test_csv_or_default(spark, tmp_path):
    assert readers.csv_or_default(spark, str(tmp_path / "no.csv"), lambda: readers.states(spark), missing="skip").count() == 27
    with pytest.raises(readers.SourceMissing):
        readers.csv_or_default(spark, str(tmp_path / "no.csv"), lambda: readers.states(spark))


def test_yearly_parquet(spark, tmp_path, rows):
    folder = tmp_path / "prod"

    def put(name, df):
        df.coalesce(1).write.parquet(str(tmp_path / "w" / name))
        part = next((tmp_path / "w" / name).glob("*.parquet"))
        folder.mkdir(exist_ok=True)
        (folder / name).write_bytes(part.read_bytes())

    put("add_producao_2022.parquet", spark.createDataFrame([(1,)], "ID int"))
    put("add_producao_2023.parquet", spark.createDataFrame([(2, "2099")], "ID int, ano_base string"))
    put("add_producao_autor_2023.parquet", spark.createDataFrame([(3,)], "ID int"))
    put("other_2023.parquet", spark.createDataFrame([(4,)], "ID int"))
    assert rows(readers.yearly_parquet(spark, str(folder)).select("ID", "ano_base")) == [(1, "2022"), (2, "2099")]
    assert rows(readers.yearly_parquet(spark, str(folder), years=[2022]).select("ID")) == [(1,)]


def test_numbered_parquet_and_pruning(spark, tmp_path):
    path = str(tmp_path / "n")
    spark.range(5).selectExpr("id", "id * 2 AS twice").coalesce(1).write.parquet(path)
    assert [r["_linha"] for r in readers.numbered_parquet(spark, path).orderBy("id").collect()] == [0, 1, 2, 3, 4]
    plan = readers.parquet(spark, path, ["id"])._jdf.queryExecution().toString()
    assert "ReadSchema: struct<id:bigint>" in plan


def test_object_store_settings():
    with pytest.raises(ValueError):
        readers.object_store_options({})
    given = {"OBJECT_STORE_ENDPOINT": "host:1", "OBJECT_STORE_ACCESS_KEY": "a", "OBJECT_STORE_SECRET_KEY": "b"}
    assert readers.object_store_options(given)["fs.s3a.endpoint"] == "http://host:1"


def test_source_chain(spark):
    def broken():
        raise FileNotFoundError("remote")

    empty, full = lambda: spark.range(0), lambda: spark.range(3)
    assert readers.first_available([broken, empty, full]).count() == 3
    assert readers.first_available([full, lambda: spark.range(1)], prefer_local=True).count() == 1
    with pytest.raises(readers.SourceMissing):
        readers.first_available([broken, empty])


def test_find_path(tmp_path):
    write(tmp_path / "add_x_producao_autor_1.parquet", "")
    found = readers.find_path(None, str(tmp_path), ["a.parquet"], "add*producao*autor*.parquet")
    assert found.endswith("add_x_producao_autor_1.parquet")
    with pytest.raises(readers.SourceMissing):
        readers.find_path(str(tmp_path / "no"), str(tmp_path), [])
    with pytest.raises(readers.SourceMissing):
        readers.find_path(None, str(tmp_path), ["a"], None)


def test_record_pages(spark, tmp_path, rows):
    pages = [
        {"success": True, "result": {"records": [{"a": 1, "b": "x"}, {"a": 2, "b": None}]}},
        {"success": True, "result": {"records": []}},
        {"success": False, "result": {"records": [{"a": 9, "b": "bad"}]}},
    ]
    for i, page in enumerate(pages):
        write(tmp_path / f"page{i}.json", json.dumps(page, indent=1))
    assert rows(readers.record_pages(spark, str(tmp_path))) == [(1, "x"), (2, None)]


def test_variant_fields_and_deviations(spark, rows):
    texts = [
        '{"a":1,"b":"x","c":null,"d":1.5}', '{"a":"7.0","e":[1],"b":2}', "bad{", None, "[1]", '{"a":"n/a","a b":1}',
        '{"a":99999999999999999999,"b":{"q":1}}', '{"a":true,"b":" "}', '{"a":9007199254740993}', '{"a":2.5}', '{"a":""}', '{}',
    ]
    records = variants.parsed(spark.createDataFrame(list(enumerate(texts)), "id int, t string"), "t")
    assert variants.found_types(records) == {"a": "string", "a b": "bigint", "b": "string", "d": "double", "e": "string"}
    out = variants.typed(records, {"a": "bigint", "b": "string", "d": "double", "absent": "boolean"}, ["id"])
    got = {r["id"]: (r["a"], r["b"], r["d"], r["absent"], [tuple(d) for d in r["_desvios"] or []]) for r in out.collect()}
    assert got == {
        0: (1, "x", 1.5, None, []), 1: (7, "2", None, None, [("e", "ARRAY", "[1]")]), 2: (None, None, None, None, [("", "ILEGIVEL", None)]),
        3: (None, None, None, None, [("", "ILEGIVEL", None)]), 4: (None, None, None, None, [("", "ARRAY", "[1]")]),
        5: (None, None, None, None, [("a", "STRING", "n/a"), ("a b", "BIGINT", "1")]),
        6: (None, '{"q":1}', None, None, [("a", "DECIMAL", "99999999999999999999"), ("b", "OBJECT", '{"q":1}')]),
        7: (None, " ", None, None, [("a", "BOOLEAN", "true")]), 8: (9007199254740993, None, None, None, []),
        9: (None, None, None, None, [("a", "DECIMAL", "2.5")]), 10: (None, None, None, None, []), 11: (None, None, None, None, []),
    }
    assert ("a", "DECIMAL", 2) in rows(variants.deviations(out))
    flags = variants.parsed(spark.createDataFrame([('{"f": true}',), ('{"f": 1}',), ('{"f": "false"}',)], "t string"), "t")
    assert [(r["f"], bool(r["_desvios"])) for r in variants.typed(flags, {"f": "boolean"}).collect()] == [(True, False), (None, True), (False, False)]
    # a text is parsed once, however many fields are read
    plan = variants.typed(records, {"a": "bigint", "b": "string"}, ["id"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1
    wide = spark.range(variants.MAX_FIELDS + 1).selectExpr("concat('{\"k', id, '\": 1}') AS t")
    with pytest.raises(ValueError, match="fields"):
        variants.found_types(variants.parsed(wide, "t"))


def test_variant_pages(spark, rows):
    pages = spark.createDataFrame([
        (1, '{"success":true,"result":{"records":[{"a":1},{"a":2}]}}'), (2, '{"success":false,"result":{"records":[{"a":3}]}}'),
        (3, '{"success":true,"result":{"records":{"a":4}}}'), (4, '{"success":true,"result":{"records":[]}}'), (5, None), (6, "x"), (7, "{}"),
    ], "id int, t string")
    found = variants.page_records(pages, "t", ["id"])
    assert rows(found.selectExpr("id", "CAST(registro AS STRING) AS r")) == [(1, '{"a":1}'), (1, '{"a":2}')]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("parseJson") == 1
    assert variants.found_types(variants.page_records(pages.filter("id > 4"), "t")) == {}


def test_catalog(spark, tmp_path, rows):
    def resource(i, name, active):
        return {"id": i, "name": name, "datastore_active": active}

    sets = [
        {"name": "p", "title": "Programas", "resources": [resource("r1", "2021", True), resource("r2", "2022", False)]},
        {"name": "q", "title": "Programas", "resources": [resource("r3", "2022", False)]},
        {"name": "s", "title": "Outros", "resources": [resource("r4", "2021", True)]},
        {"name": "t", "title": "programa", "resources": [resource("r5", "1999", True), resource("r6", "x 2023", True)]},
    ]
    path = write(tmp_path / "catalog.json", json.dumps({"result": {"results": sets}}))
    found = readers.catalog_resources(readers.catalog_page(spark, path), "programa", [2021, 2022, 2023])
    assert rows(found.select("resource_id", "ano_referencia")) == [("r1", 2021), ("r6", 2023)]


def test_missing_table_is_typed_and_empty(spark):
    assert readers.table(spark, "dim_tema").columns[0] == "tema_sk"
    assert readers.table(spark, "dim_tema").count() == 0
    assert readers.table_rows(spark, "dim_tema") == 0
    assert readers.optional_table(spark, "dim_tema") is None


def test_save_modes_and_reconciliation(spark, tmp_path):
    target = str(tmp_path / "out")
    first = writers.save_parquet(spark.range(10), target, rows_per_file=3)
    assert (first.written, first.found, first.complete) == (10, 10, True)
    more = writers.save_parquet(spark.range(5), target, "append")
    assert (more.before, more.written, more.found, more.complete) == (10, 5, 15, True)
    assert writers.save_parquet(spark.range(0), target).skipped
    assert spark.read.parquet(target).count() == 15
    with pytest.raises(Exception):
        writers.save_parquet(spark.range(1), target, "fail")


def test_swap_tables(spark):
    for name in ("live_t", "fresh_t", "old_t"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    writers.save_table(spark.range(1), "live_t")
    writers.save_table(spark.range(2), "fresh_t")
    writers.swap_tables(spark, "live_t", "fresh_t", "old_t")
    assert (readers.table_rows(spark, "live_t"), readers.table_rows(spark, "old_t")) == (2, 1)
    for name in ("live_t", "old_t"):
        spark.sql(f"DROP TABLE {name}")


def test_job_template(spark, tmp_path):
    target = str(tmp_path / "tema")

    def themes(df):
        return df.selectExpr("CAST(id AS INT) AS tema_sk", "'n' AS tema_nome")

    job = Job(target, lambda s: s.range(6), themes, dimension="tema")
    assert run_job(spark, job, limit=2).load.found == 2
    assert run_job(spark, job, dry_run=True).load is None
    bad = Job(target, lambda s: s.range(3), lambda df: themes(df).withColumn("tema_sk", F.lit(1)), dimension="tema")
    with pytest.raises(QualityError):
        run_job(spark, bad)
    assert spark.read.parquet(target).count() == 2


class Stopped(Exception):
    pass


STEPS = ("_write", "_stage", "_commit")


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("after", [False, True])
@pytest.mark.parametrize("mode", ["replace", "append"])
def test_a_load_that_stops_leaves_a_whole_version(spark, tmp_path, monkeypatch, step, after, mode):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.load(spark.range(100))
    real = getattr(VersionedTable, step)

    def stop(self, *args):
        if after:
            real(self, *args)
        raise Stopped

    monkeypatch.setattr(VersionedTable, step, stop)
    with pytest.raises(Stopped):
        table.load(spark.range(1000, 1050), mode)
    monkeypatch.undo()
    switched = step == "_commit" and after
    wanted = {100} if not switched else {50} if mode == "replace" else {150}
    assert {table.read().count(), table.current().rows} == wanted and table.damaged() == []
    assert bool(table.sweep()) == (not switched and (after or step != "_write"))
    assert table.load(spark.range(7), "append").complete and table.read().count() == wanted.pop() + 7


def test_versions_are_read_restored_and_released(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        table.read()
    assert table.load(spark.range(0)).skipped and table.versions() == []
    assert table.load(spark.range(10), note="first").written == 10
    assert table.load(spark.range(10, 15), "append").found == 15
    table.load(spark.range(3), partition_by=None)
    assert [v.rows for v in table.versions()] == [10, 15, 3] and table.versions()[0].note == "first"
    assert table.read(2).count() == 15 and table.read().count() == 3
    table.release(1)  # its data is part of version 2
    assert table.read(2).count() == 15 and [v.number for v in table.versions()] == [2, 3]
    table.restore(2)
    assert table.read().count() == 15
    with pytest.raises(ValueError):
        table.release(4)
    with pytest.raises(ValueError):
        table.load(spark.range(1).withColumnRenamed("id", "other"), "append")
    table.release(3)
    table.release(2)
    assert table.read().count() == 15 and table.sweep() == []


def test_of_two_loads_at_once_one_is_told(spark, tmp_path, monkeypatch):
    one, two = (VersionedTable(spark, str(tmp_path / "t")) for _ in range(2))
    one.load(spark.range(1))
    real = VersionedTable._stage

    def raced(self, *args):
        monkeypatch.undo()
        two.load(spark.range(2), "append")
        real(self, *args)

    monkeypatch.setattr(VersionedTable, "_stage", raced)
    with pytest.raises(ConcurrentLoad):
        one.load(spark.range(4), "append")
    assert one.read().count() == 3


def test_an_unreadable_target_is_no_empty_one(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "part.parquet").write_text("no parquet")
    with pytest.raises(Exception, match="(?i)parquet"):
        writers.save_parquet(spark.range(5), str(tmp_path / "t"), "append")


def test_a_swap_that_stopped_is_completed(spark):
    for name in ("live_s", "fresh_s", "old_s"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    writers.save_table(spark.range(1), "old_s")  # the live table was renamed, the fresh one not yet
    writers.save_table(spark.range(2), "fresh_s")
    writers.swap_tables(spark, "live_s", "fresh_s", "old_s")
    assert spark.table("live_s").count() == 2 and spark.table("old_s").count() == 1
    spark.sql("DROP TABLE live_s")
    with pytest.raises(LookupError):
        writers.swap_tables(spark, "live_s", "fresh_s", "old_s")
    assert spark.table("live_s").count() == 1
    spark.sql("DROP TABLE live_s")


def bridge_rows(spark):
    return spark.range(1000).selectExpr(
        "CAST(id AS int) AS tema_sk", "CAST(id % 3 AS int) AS ods_sk", "'Automática' AS tipo_associacao",
        "CAST(60 + id % 40 AS double) AS nivel_confianca", "CAST(NULL AS string) AS observacao", "true AS ativo",
    )


def test_a_change_rewrites_touched_parts_only(spark, tmp_path, rows):
    table = RangedTable(spark, str(tmp_path / "b"))
    start = bridge_rows(spark)
    table.create(start, "tema_sk", ["tema_sk", "ods_sk"], 8)
    first = table.current()
    assert len(first.folders) == 8 and rows(table.read().select(start.columns)) == rows(start) and table.log() is None
    new = start.where("tema_sk IN (5, 6)").withColumn("ods_sk", F.lit(9)).unionByName(start.where("tema_sk = 900"))
    table.insert_missing(new)
    second = table.current()
    assert len(set(first.folders) - set(second.folders)) == 1  # 900 was there: its part stays too
    assert rows(table.read().select(start.columns)) == rows(insert_missing(start, new).select(start.columns))
    told = table.log().collect()
    assert {(r["version"], r["action"], r["before"], r["after"]["tema_sk"]) for r in told} == {(2, "insert", None, 5), (2, "insert", None, 6)}
    weak = (F.col("tema_sk") > 990) & (F.col("nivel_confianca") < 95)
    before = table.read()
    table.deactivate(weak, "reviewed")
    third = table.current()
    assert len(set(second.folders) - set(third.folders)) == 1
    assert rows(table.read()) == rows(deactivate(before, weak, "reviewed").select(before.columns))
    reviewed = spark.createDataFrame([(30,), (31,), (500,), (None,), (12345,)], "tema_sk int")
    before = table.read()
    table.promote(reviewed)
    assert rows(table.read()) == rows(promote(before, reviewed).select(before.columns))
    assert rows(table.read(1).select(start.columns)) == rows(start)
    last = table.current().number
    table.promote(reviewed.where("tema_sk > 12000"))
    assert table.current().number == last and table.damaged() == []
    for old in (1, 2, 3):
        table.release(old)
    assert table.log().count() == len(told) + third.rows * 0 + table.log().where("action <> 'insert'").count()
    assert table.sweep() == [] and table.read().count() == 1002


def test_a_change_that_stops_leaves_the_old_parts(spark, tmp_path, monkeypatch):
    table = RangedTable(spark, str(tmp_path / "b"))
    table.create(bridge_rows(spark), "tema_sk", ["tema_sk", "ods_sk"], 4)
    def stop(self, *args):
        raise Stopped

    for step in ("_write_parts", "_stage", "_commit"):
        monkeypatch.setattr(RangedTable, step, stop)
        with pytest.raises(Stopped):
            table.deactivate(F.col("tema_sk") < 10, "x")
        monkeypatch.undo()
        assert table.current().number == 1 and table.read().where("NOT ativo").count() == 0 and table.damaged() == []
    table.sweep()
    table.deactivate(F.col("tema_sk") < 10, "x")
    assert table.read().where("NOT ativo").count() == 10


def test_file_ledger(spark, tmp_path, rows):
    source = tmp_path / "source"
    source.mkdir()
    head = "AN_BASE;ID_PESSOA;CD_PROGRAMA_IES;NM_DOCENTE\n"
    write(source / "d 1.csv", head + "2021;1;P;Zé\n2021;1;P;Ana\n2021;2;P;Rui\n", "latin-1")
    write(source / "d-2.csv", head + "2021;3;P;Eva\n", "latin-1")
    write(source / "notes.txt", "no rows of ours")
    table = LedgerTable(spark, str(tmp_path / "held"))

    def names(report):
        return [[p.rsplit("/", 1)[1] for p in found] for found in (report.new, report.changed, report.vanished)]

    def same_as_full():
        wanted = ["id_pessoa", "ano_base", "nm_docente"]
        full = raw.raw_docente(readers.csv_files(spark, [str(p) for p in source.glob("*.csv")]))
        held = raw.raw_docente(table.read())
        assert rows(held.select(*wanted)) == rows(full.select(*wanted)) and set(held.columns) == set(full.columns)

    first = table.update(str(source), "*.csv")
    assert names(first) == [["d 1.csv", "d-2.csv"], [], []] and (first.rows, first.unchanged, first.new_columns) == (4, 0, {})
    same_as_full()
    # nothing new: no version
    again = table.update(str(source), "*.csv")
    assert names(again) == [[], [], []] and (again.unchanged, again.rows, table.current().number) == (2, 4, 1)
    # a second year with a further column, a changed file; the untouched one keeps its folder
    kept = next(e["folder"] for p, e in table.files_held().items() if p.endswith("d 1.csv"))
    write(source / "d-2.csv", head + "2021;3;P;Eva Maria\n2021;4;P;Lia\n", "latin-1")
    write(source / "d-3.csv", "ID_PESSOA;AN_BASE;CD_PROGRAMA_IES;NM_DOCENTE;SG_UF_PROGRAMA\n1;2022;P;Ana;sp\n", "latin-1")
    second = table.update(str(source), "*.csv")
    assert names(second) == [["d-3.csv"], ["d-2.csv"], []] and (second.unchanged, second.rows) == (1, 6)
    assert list(second.new_columns.values()) == [["SG_UF_PROGRAMA"]]
    assert kept in table.current().folders and table.damaged() == []
    same_as_full()
    # a file that is gone takes its rows along, unless told otherwise; old versions stay readable
    (source / "d 1.csv").rename(tmp_path / "away.csv")
    write(source / "d-4.csv", head)
    stay = LedgerTable(spark, table.path).update(str(source), "*.csv", vanished="keep")
    assert names(stay) == [["d-4.csv"], [], ["d 1.csv"]] and stay.rows == 6
    third = table.update(str(source), "*.csv")
    assert names(third) == [[], [], ["d 1.csv"]] and third.rows == 3
    assert table.read(2).count() == 6 and table.read().count() == 3
    same_as_full()
    write(source / "d-4.csv", "")
    assert names(table.update(str(source), "*.csv")) == [[], [], ["d-4.csv"]]
    for number in range(1, table.current().number):
        table.release(number)
    assert table.sweep() == [] and table.read().count() == 3
    with pytest.raises(ValueError):
        table.update(str(source), vanished="maybe")


def test_file_ledger_of_parquet_stops_whole(spark, tmp_path, rows, monkeypatch):
    source = str(tmp_path / "source")
    spark.range(3).selectExpr("id", "id AS a").coalesce(1).write.parquet(source)
    table = LedgerTable(spark, str(tmp_path / "held"))
    assert table.update(source, "*.parquet", one_parquet).rows == 3
    spark.range(3, 5).selectExpr("id", "'x' AS b").coalesce(1).write.mode("append").parquet(source)
    with monkeypatch.context() as stopped:
        stopped.setattr(LedgerTable, "_commit", lambda *_: (_ for _ in ()).throw(OSError("stopped")))
        with pytest.raises(OSError, match="stopped"):
            table.update(source, "*.parquet", one_parquet)
    assert table.read().count() == 3 and len(table.files_held()) == 1
    report = table.update(source, "*.parquet", one_parquet)
    assert report.rows == 5 and list(report.new_columns.values()) == [["b"]]
    assert rows(table.read().select("id", "a", "b")) == [(0, 0, None), (1, 1, None), (2, 2, None), (3, None, "x"), (4, None, "x")]
    assert table.sweep() and table.read().count() == 5
