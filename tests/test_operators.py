"""Relational operators on hand-made rows."""

import random

import pytest
from pyspark.sql import functions as F

from starloom.operators import aggregates, bloom, dedup, fingerprints, integrity, keys, lookup, maintain, match, registry, shape, sketches
from starloom.operators.consolidate import consolidate
from starloom.operators.quality import QualityError, RuleSet, dimension_rules, require, summarize


def test_naming_rules():
    assert shape.snake_name("# Nome Sub-área (x)") == "nome_sub_area_x"
    assert shape.light_name(" Tema - ID ") == "tema__id"
    assert shape.feed_name("NM_ENTIDADE") == "des_entidade"
    assert shape.feed_name("Código Nome") == "cod_des"
    assert shape.feed_name("_id") == "_id_original"
    assert shape.feed_name("x_id_y_id") == "x_id_y_id_original"


def test_select_renamed_coalesces_shared_targets(spark, rows):
    df = spark.createDataFrame([(None, 2), (1, 3)], "A int, B int")
    assert rows(shape.select_renamed(df, {"A": "x", "B": "x", "absent": "y"})) == [(1,), (2,)]


def test_first_filled_skips_empty_columns(spark):
    df = spark.createDataFrame([(None, "a")], "x string, y string")
    assert shape.first_filled(df, ["z", "x", "y"]) == "y"
    assert shape.first_filled(df, ["z"]) is None


def test_drop_empty(spark):
    df = spark.createDataFrame([("a", None), (None, None)], "x string, y string")
    out = shape.drop_empty(df)
    assert out.columns == ["x"] and out.count() == 1


def test_standard_sk_and_natural_id(spark):
    df = spark.createDataFrame([(1, "a")], "sk int, nome string")
    assert shape.standard_sk(df, "ies").columns == ["ies_sk", "nome"]
    made = shape.with_natural_id(df, "id_posdoc", "posdoc")
    assert len(made.first()["id_posdoc"]) == 32


def test_latest_per_key_and_ties(spark, rows):
    df = spark.createDataFrame([(1, 2020, "a"), (1, 2021, "c"), (1, 2021, "b"), (2, None, "z")], "k int, y int, v string")
    assert rows(dedup.latest_per_key(df, ["k"], ["y"])) == [(1, 2021, "b"), (2, None, "z")]


def test_dedup_keeps_one_row_per_task_before_the_shuffle(spark):
    plan = dedup.latest_per_key(spark.range(10).selectExpr("id % 2 k", "id v"), ["k"], ["v"])
    assert "WindowGroupLimit" in plan._jdf.queryExecution().toString()


def test_surrogate_key_equals_global_window(spark, rows):
    df = spark.range(1000).selectExpr("id", "id * 7919 % 1000 AS v")
    keyed = keys.surrogate_key(df, "sk", [F.desc("v"), "id"])
    expected = sorted(((1000 - r["v"], r["id"], r["v"]) for r in df.collect()), key=repr)
    assert rows(keyed) == expected
    with pytest.raises(ValueError):
        keys.surrogate_key(df, "sk", [])


def test_surrogate_key_does_not_depend_on_partitions(spark, rows):
    df = spark.range(500).selectExpr("id", "pmod(hash(id), 7) AS v")
    one = rows(keys.surrogate_key(df.repartition(1), "sk", ["v", "id"]))
    spark.conf.set("spark.sql.shuffle.partitions", "11")
    try:
        assert rows(keys.surrogate_key(df.repartition(9), "sk", ["v", "id"])) == one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert [r[0] for r in sorted(one)] == list(range(1, 501))


def test_factorized_handles_nulls_and_blanks(spark, rows):
    df = spark.createDataFrame([("b",), ("a",), ("",), ("a",)], "v string")
    assert rows(keys.factorized(df, "id", ["v"]).select("v", "id")) == [("", 1), ("a", 2), ("a", 2), ("b", 3)]


def test_unknown_member(spark, rows):
    df = spark.createDataFrame([(1, "a", 2.5)], "sk int, v string, x double")
    assert rows(keys.with_unknown_member(df, {"sk": 0, "v": "?"})) == [(0, "?", None), (1, "a", 2.5)]


def dimension(spark):
    return spark.createDataFrame(
        [(0, "0", "X"), (1, "10", "A"), (2, "20", "B"), (3, "20", "C")], "d_sk int, id string, alias string"
    )


def test_lookup_keeps_rows_and_takes_last_key(spark, rows):
    fact = spark.createDataFrame([(1, "10.0"), (2, "20"), (3, None), (4, "nan"), (5, "99")], "f int, id string")
    found = lookup.lookup_sk(fact, dimension(spark), "id", "id", "d_sk")
    assert rows(found.select("f", "d_sk")) == [(1, 1), (2, 3), (3, 0), (4, 0), (5, 0)]


def test_lookup_by_shuffle_gives_the_same(spark, rows):
    """The same result when nothing may be broadcast and most keys are missing."""
    fact = spark.range(2000).selectExpr("id AS f", "CASE WHEN id % 3 = 0 THEN id % 50 END AS k")
    dim = spark.range(40).selectExpr("CAST(id + 1 AS INT) AS d_sk", "id AS k")
    kept = {name: spark.conf.get(name) for name in ("spark.sql.autoBroadcastJoinThreshold",)}
    results = []
    for threshold in ("-1", "10485760"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        results.append(rows(lookup.lookup_sk(fact, dim, F.col("k"), F.col("k"), "d_sk", clean=None)))
    for name, value in kept.items():
        spark.conf.set(name, value)
    expected = sorted(
        ((f, k, k + 1 if k is not None and k < 40 else 0) for f in range(2000) for k in [f % 50 if f % 3 == 0 else None]),
        key=repr,
    )
    assert results[0] == results[1] == expected


def test_missing_keys_are_spread(spark):
    """Rows without a key do not share one join value."""
    fact = spark.range(3000).selectExpr("id AS f", "CAST(NULL AS BIGINT) AS k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        dim = spark.range(5).selectExpr("CAST(id + 1 AS INT) AS d_sk", "id AS k")
        found = lookup.lookup_sk(fact, dim, F.col("k"), F.col("k"), "d_sk", clean=None)
        sizes = [r["count"] for r in found.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(sizes) == 3000 and max(sizes) < 1500


def test_lookup_fallback_order(spark, rows):
    dim = spark.createDataFrame([(1, "zz", "10"), (2, "yy", "20")], "d_sk int, code string, id string")
    fact = spark.createDataFrame([(1, "10.0"), (2, "30")], "f int, key string")
    assert rows(lookup.lookup_sk_fallback(fact, dim, "key", ["none", "code", "id"], "d_sk").select("f", "d_sk")) == [(1, 1), (2, 0)]
    assert rows(lookup.lookup_sk_fallback(fact, dim, None, ["id"], "d_sk").select("d_sk")) == [(0,), (0,)]
    # the first column with a hit is used for the whole fact
    both = spark.createDataFrame([(1, "10", "10"), (2, "x", "30")], "d_sk int, code string, id string")
    assert rows(lookup.lookup_sk_fallback(fact, both, "key", ["code", "id"], "d_sk").select("f", "d_sk")) == [(1, 1), (2, 0)]


def test_priority_lookup(spark, rows):
    dim = spark.createDataFrame([(1, "a", "b"), (2, "b", "c"), (0, "z", "z")], "d_sk int, k1 string, k2 string")
    fact = spark.createDataFrame([(" a",), ("B",), ("c",), ("z",), (None,)], "key string")
    got = lookup.lookup_sk_priority(fact, dim, "key", ["k1", "k2"], "d_sk").select("key", "d_sk", "match_status")
    assert rows(got) == sorted([(" a", 1, "MATCHED"), ("B", 2, "MATCHED"), ("c", 2, "MATCHED"), ("z", 0, "UNMATCHED"),
                                (None, 0, "UNMATCHED")], key=repr)
    absent = lookup.lookup_sk_priority(fact, None, "key", ["k1"], "d_sk")
    assert {r["match_status"] for r in absent.collect()} == {"DIM_ABSENT"}


def test_bridge_fans_out(spark, rows):
    fact = spark.createDataFrame([(1,), (2,), (0,)], "tema_sk int")
    bridge = spark.createDataFrame([(1, 5), (1, 6), (1, 6)], "tema_sk int, ods_sk int")
    assert rows(lookup.attach_bridge(fact, bridge, "tema_sk", "ods_sk")) == [(0, 0), (1, 5), (1, 6), (2, 0)]


def test_name_enrichment_does_not_multiply(spark, rows):
    left = spark.createDataFrame([("Ana",), (" ",), (None,)], "nome string")
    right = spark.createDataFrame([(" ANA", 1), ("ana ", 2), ("", 9)], "n string, v int")
    got = lookup.enrich_by_name(left, right, "nome", "n", ["v"]).select("nome", "v")
    assert rows(got) == sorted([("Ana", 1), (" ", None), (None, None)], key=repr)


GOALS = [(1, "água potável, saneamento", "vida na água"), (2, "energia solar", "Água limpa")]


def test_fixed_targets(spark, rows):
    themes = spark.createDataFrame([(1, "ÁGUA"), (2, "solar"), (3, " "), (4, None), (5, "nada")], "t int, palavra string")
    got = match.match_fixed_targets(themes, "palavra", GOALS).select("t", "ods_sk", "nivel_confianca")
    assert rows(got) == [(1, 1, 80.0), (1, 2, 60.0), (2, 2, 80.0)]


def test_contains_pairs_against_brute_force(spark, rows):
    words = ["a", "gato", "gat", "elefante azul", "Elefante", "fante", "zzz", " ", "o", "azul e"]
    texts = ["O gato e o elefante azul", "nada", "elefant", "", "AZUL e gata", "fantefante", "o"]
    left = spark.createDataFrame(list(enumerate(words)), "w int, word string")
    right = spark.createDataFrame(list(enumerate(texts)), "t int, body string")
    expected = [
        (w, t) for w, word in enumerate(words) if word.strip() for t, body in enumerate(texts) if word.lower() in body.lower()
    ]
    assert rows(match.contains_pairs(left, "w", "word", right, "t", "body")) == sorted(expected, key=repr)


def test_consolidate_fills_gaps_in_order(spark, rows):
    df = spark.createDataFrame(
        [("x", 1, None, "", "c1"), ("x", 2, "a2", None, None), ("x", 3, "a3", "b3", None), ("y", 4, None, "", None)],
        "nome string, pos int, a string, b string, c string",
    )
    assert rows(consolidate(df, "nome", ["pos"])) == [("x", "a3", "b3", "c1"), ("y", None, "", None)]


def test_maintenance(spark, rows):
    bridge = spark.createDataFrame(
        [(1, 1, "Automática", 80.0, None, True), (2, 1, "Automática", 60.0, "n", True)],
        "tema_sk int, ods_sk int, tipo_associacao string, nivel_confianca double, observacao string, ativo boolean",
    )
    new = spark.createDataFrame([(1, 1), (3, 2), (3, 2)], "tema_sk int, ods_sk int")
    assert rows(maintain.insert_missing(bridge, new).select("tema_sk", "ods_sk")) == [(1, 1), (2, 1), (3, 2)]
    off = maintain.deactivate(bridge, F.col("tema_sk") == 2, "off")
    assert rows(off.select("tema_sk", "observacao", "ativo")) == [(1, None, True), (2, "n | off", False)]
    promoted = maintain.promote(bridge, spark.createDataFrame([(1,), (1,), (2,)], "tema_sk int"))
    assert rows(promoted.select("tema_sk", "tipo_associacao", "nivel_confianca")) == [(1, "Validada", 95.0), (2, "Automática", 60.0)]


def test_rules_read_the_table_once(spark):
    rules = RuleSet().add_rule("u", "v", "unique").add_rule("n", "v", "not_null").add_rule("r", "v", "range", {"max": 3})
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (9,)], "v int")
    got = {r["rule_name"]: r["failed_count"] for r in rules.measure(df).collect()}
    # a repeated null counts as a repeated value
    assert got == {"u": 2, "n": 2, "r": 1}


def test_rules_on_empty_and_on_nan_text(spark):
    empty = spark.createDataFrame([], "v string")
    rules = RuleSet(null_as_nan_text=True).add_rule("f", "v", "format", {"pattern": "nan"}).add_rule("u", "v", "unique")
    assert all(r["passed"] for r in rules.measure(empty).collect())
    one_null = spark.createDataFrame([(None,)], "v string")
    assert all(r["passed"] for r in rules.measure(one_null).collect())
    strict = RuleSet().add_rule("f", "v", "format", {"pattern": "nan"})
    assert not strict.measure(one_null).first()["passed"]


def test_gate(spark):
    df = spark.createDataFrame([(0, "AC"), (0, "a1")], "localidade_sk int, sigla_uf string").withColumn("nome", F.lit("n"))
    with pytest.raises(QualityError) as error:
        dimension_rules("localidade").gate(df)
    failed = {r["rule_name"] for r in error.value.results if not r["passed"]}
    assert failed == {"sk_unique", "uf_format", "uf_values"}
    warned = RuleSet().add_rule("v", "nome", "values", {"values": ["m"]}, "WARNING")
    assert not warned.gate(df)[0]["passed"]
    summary = summarize(warned.measure(df)).first()
    assert (summary["error_count"], summary["warning_count"], summary["success_rate"]) == (0, 1, 0.0)


def test_require(spark):
    with pytest.raises(ValueError):
        require(spark.range(1), "x")
    with pytest.raises(ValueError):
        require(spark.range(0), "id")
    assert require(spark.range(1), "id").count() == 1


def test_integrity(spark, rows):
    fact = spark.createDataFrame([(1,), (1,), (7,), (None,)], "k int")
    dim = spark.createDataFrame([(1,), (2,)], "sk int")
    assert rows(integrity.orphan_keys(fact, dim, "k", "sk")) == [(7, 1)]
    assert rows(integrity.duplicate_keys(fact, ["k"])) == [(1, 2)]
    assert [r["data_type"] for r in integrity.describe_schema(dim).collect()] == ["int"]
    assert integrity.all_zero(spark.createDataFrame([(0,), (0,)], "k int"), "k").first()["suspicious"]


def test_contains_pairs_of_odd_texts(spark, monkeypatch):
    monkeypatch.setattr(match, "CHUNK", 7)
    monkeypatch.setattr(match, "HOT", 8)
    rng = random.Random(11)
    letters = "ab é日😀\0\n"
    texts = ["".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 3, 8, 30, 200]))) for _ in range(60)] + [None, "A" * 3000, "xABCDEFGHIJKLMNOPy"]
    words = {"".join(rng.choice(letters) for _ in range(rng.choice([1, 2, 3, 4, 5, 9]))) for _ in range(80)}
    words = [*words, None, "  ", "Abcdefghijklmnop", "aaaa", "a" * 40, "nowhere", "é", "日😀", texts[4][:9]]
    left = spark.createDataFrame([(i, w) for i, w in enumerate(words)], "w int, word string")
    right = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "t int, body string")
    found = {tuple(r) for r in match.contains_pairs(left, "w", "word", right, "t", "body").collect()}
    assert found == {
        (i, j) for i, w in enumerate(words) for j, t in enumerate(texts) if w and w.strip(" ") and t is not None and w.lower() in t.lower()
    }


def test_contains_pairs_files_under_the_rarest_piece(spark):
    texts = spark.createDataFrame([(i, "the cat sat on the mat") for i in range(50)] + [(99, "the zebra")], "t int, body string")
    words = spark.createDataFrame([(1, "the zebra"), (2, "the cat")], "w int, word string")
    plan = match.contains_pairs(words, "w", "word", texts, "t", "body")
    assert plan.count() == 51
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoop" not in text


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_registry_equals_lookups_in_turn(no_broadcast, monkeypatch, rows):
    spark = no_broadcast
    monkeypatch.setattr(registry, "HOT", 4)
    people = spark.createDataFrame([(str(i), i + 1) for i in range(20)], "_key string, _sk int")
    others = spark.createDataFrame([(f"{i}|{i}", 100 + i) for i in range(5)], "_key string, _sk int")
    numbers_ = spark.createDataFrame([(i, 500 + i) for i in range(9)], "_key bigint, _sk int")
    data = [(i, str(i % 25) if i % 2 else "7", f"{i % 6}|{i % 6}" if i % 3 else None, i % 11 if i % 5 else None) for i in range(400)]
    fact = spark.createDataFrame([*data, *data[:3], (None, None, None, None)], "n int, a string, b string, c bigint")
    keys_ = {"a_sk": (F.col("a"), people), "b_sk": (F.col("b"), others), "c_sk": (F.col("c"), numbers_)}
    chained = fact
    for target, (key, table) in keys_.items():
        chained = lookup.attach_key(chained, table, key, target)
    found = registry.lookup_many(fact, keys_)
    assert rows(found) == rows(chained.select(found.columns))
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1  # by row, of the keys found
    assert rows(registry.lookup_many(fact.where("false"), keys_)) == []


def test_small_keys_move_nothing(spark):
    fact = spark.range(100).withColumn("k", F.col("id").cast("string"))
    table = spark.createDataFrame([("1", 1)], "_key string, _sk int")
    found = registry.lookup_many(fact, {"s": (F.col("k"), table)})
    assert found.filter("s = 1").count() == 1
    assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()


def test_stacked_distinct_counts(spark):
    rows_ = [(1, -0.0, "a", b"x", [1, None], None, None), (1, 0.0, "A", b"y", [1, None], None, None), (None, float("nan"), None, b"x", None, None, None),
             (2, float("nan"), "a", None, [1], None, None)]
    frame = spark.createDataFrame(rows_, "i int, d double, s string, b binary, l array<int>, n string, `x.y` int")
    names = ["i", "d", "s", "b", "l", "n"]
    found = aggregates.profile(frame, names)
    assert tuple(found.first()) == (2, 2, 2, 2, 2, 0)
    assert tuple(found.first()) == tuple(frame.agg(*[F.count_distinct(c) for c in names]).first())
    assert "Expand" not in found._jdf.queryExecution().executedPlan().toString()
    assert tuple(aggregates.profile(frame.where("false"), names).first()) == (0,) * 6


def test_sketches_merge(spark):
    frame = spark.range(60_000).selectExpr("id % 7 AS part", "id % 20011 AS k", "CAST(id AS double) / 3 AS x", "IF(id % 2 = 0, concat('t', id % 90), NULL) AS t")
    parts = sketches.sketch(frame, ["k", "x", "t"], ["part"])
    assert parts.count() == 21
    whole = {r["column"]: r for r in sketches.merged(parts, quantiles={"q": 0.25}).collect()}
    again = {r["column"]: r for r in sketches.merged(sketches.merged(parts.withColumn("half", F.col("part") > 3), ["half"]), quantiles={"q": 0.25}).collect()}
    for found in (whole, again):
        assert abs(found["k"]["distinct"] - 20011) <= 4 * sketches.HLL_ERROR * 20011 and found["t"]["distinct"] == 45
        assert abs(found["x"]["q"] / 20_000 - 0.25) <= 2 * sketches.KLL_ERROR and found["t"]["q"] is None
        assert (found["t"]["rows"], found["t"]["nulls"], found["x"]["most"]) == (60_000, 30_000, 59_999 / 3)
    empty = sketches.merged(sketches.sketch(frame.selectExpr("part", "CAST(NULL AS int) AS z"), ["z"], ["part"]), quantiles={"q": 0.5}).first()
    assert (empty["rows"], empty["nulls"], empty["distinct"], empty["q"]) == (60_000, 60_000, 0, None)


def test_orphan_rows_move_only_what_may_be_lost(no_broadcast, rows):
    spark = no_broadcast
    fact = spark.range(5000).selectExpr("IF(id % 50 = 0, NULL, id % 400) AS k", "id AS wide", "concat('x', id) AS _place")
    dim = spark.range(400).where("id % 100 <> 7").selectExpr("id AS member")
    found = integrity.orphan_rows(fact, dim, "k", "member")
    assert rows(found) == rows(fact.join(dim, fact["k"] == dim["member"], "left_anti")) and found.columns == fact.columns
    near = fact.filter(bloom.might_hold(bloom.bloom(dim, "member"), F.col("k")))
    assert near.where("k % 100 <> 7").count() == fact.where("k % 100 <> 7").count() and near.where("k % 100 = 7").count() == 0
    assert integrity.orphan_rows(fact, dim.where("false"), "k", "member").count() == 5000
    assert integrity.orphan_rows(fact.where("false"), dim, "k", "member").count() == 0


def test_differing_groups(spark, monkeypatch, rows):
    data = [(i if i % 40 else None, i % 5, None if i % 3 else "t") for i in range(2000)] + [(-9, 1, "n"), (2**62, 1, "n"), (7, 1, "d"), (7, 1, "d")]
    left = spark.createDataFrame(data, "k long, a int, b string")
    assert fingerprints.differing_groups(left, left.select("b", "k", "a").repartition(5), "k").count() == 0
    other = [r for r in data if r[0] != 500] + [(7, 1, "d"), (None, 1, "z"), (10**15, 0, None)]
    other = [(k, a, "t" if (k, b) == (1001, None) else b) for k, a, b in other]
    right = spark.createDataFrame(other, "k long, a int, b string")
    count = lambda side, k: sum(r[0] == k for r in side)
    want = sorted(((k, count(data, k), count(other, k)) for k in (None, 7, 500, 1001, 10**15)), key=repr)
    assert rows(fingerprints.differing_groups(left, right, "k")) == want
    monkeypatch.setattr(fingerprints, "RANGES", 1)
    assert rows(fingerprints.differing_groups(left, right, "k")) == want
    assert fingerprints.differing_groups(left.where("false"), left.where("false"), "k").count() == 0
    assert rows(fingerprints.differing_groups(left.where("k = 7"), left.where("false"), "k")) == [(7, count(data, 7), 0)]


def test_later_loads_keep_assigned_keys(spark, rows):
    known = spark.createDataFrame([(1, "b", 1), (2, None, None), (5, "a", 2)], "sk long, x string, y int")
    fresh = spark.createDataFrame([("a", 2, 0), ("a", 1, 0), (None, None, 0), (None, 3, 0), ("a", 1, 1)], "x string, y int, z int")
    assert rows(keys.extend_keys(known, fresh, "sk", ["x", "y"])) == [(6, None, 3), (7, "a", 1)]
    assert rows(keys.extend_keys(known.where("false"), fresh.where("y = 1"), "sk", ["x", "y"])) == [(1, "a", 1)]
    assert keys.extend_keys(known, fresh.where("false"), "sk", ["x", "y"]).count() == 0


def test_contains_pairs_cuts_windows_only_where_a_piece_begins(spark):
    words = spark.createDataFrame([(1, "gato"), (2, "azul e")], "w int, word string")
    texts = spark.createDataFrame([(1, "o gato"), (2, "azul e o gato")], "t int, body string")
    found = match.contains_pairs(words, "w", "word", texts, "t", "body")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # a filter on the window below the explosion would build it at every position of the texts
    assert not [line for line in plan.splitlines() if "Filter" in line and "substring(" in line]
    assert sorted(map(tuple, found.collect())) == [(1, 1), (1, 2), (2, 2)]
