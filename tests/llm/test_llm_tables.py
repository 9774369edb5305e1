"""Operators on vectors and urls, and every query against its SQL."""

import numpy as np
import pytest

from compare import database, difference
from starloom.llm import bloom, queries, topk, url_filter
from starloom.llm.batches import Scratch

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return database(FOLDER)


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_agrees_with_sql(spark, connection, monkeypatch, name):
    import registered

    monkeypatch.setitem(registered.QUERIES, name, queries.QUERIES[name])
    if name in queries.SQL:
        monkeypatch.setitem(registered.SQL, name, queries.SQL[name])
    assert difference(spark, connection, FOLDER, name) is None


@pytest.mark.parametrize("block", [8192, 3])
def test_top_k(spark, monkeypatch, block):
    monkeypatch.setattr(topk, "QUERY_BLOCK", block)
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(90)]
    rows += [(100, None), (101, []), (102, [1.0, None, 0.0, 0.0]), (103, [float("nan"), 0.0, 0.0, 0.0]), (104, [float("inf"), 0.0, 0.0, 0.0])]
    rows += [(None, [1.0, 1.0, 1.0, 1.0]), (120, [0.5, 2.0]), (121, [1.0, 1.0]), (7, rows[7][1]), (-20, [0.0, 0.0, 0.0, -0.01])]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, rank int")
    found = topk.top_k(frame, frame.where("vec_id % 20 = 0"), 5, Scratch(spark)).collect()
    good = [(i, np.floor(np.float32(v).astype(float) * 64).astype(int)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()]
    for q, v in good:
        if q % 20 == 0:
            scores = sorted((-int(v @ w), i) for i, w in good if i != q and len(w) == len(v))[:5]
            assert [(r["score"], r["vec_id"]) for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == q] == [(-s, i) for s, i in scores]
    assert topk.top_k(frame.where("false"), frame.where("false"), 5, Scratch(spark)).count() == 0


def test_top_k_of_many_blocks_has_a_flat_plan(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    rng = np.random.default_rng(2)
    frame = spark.createDataFrame([(i, rng.integers(-2, 3, 4).astype(float).tolist()) for i in range(60)], "vec_id long, embedding array<double>")
    found = topk.top_k(frame, frame.where("vec_id % 2 = 0"), 3, Scratch(spark))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("\n") == 1 and "parquet" in plan and found.count() == 90
    whole = topk.top_k(frame, frame.where("vec_id % 2 = 0"), 3, Scratch(spark))
    assert found.exceptAll(whole).isEmpty()


def test_top_k_refuses_what_a_long_cannot_hold(spark):
    frame = spark.createDataFrame([(0, [1e12, 1.0]), (1, [1e12, 2.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError):
        topk.top_k(frame, frame, 5, Scratch(spark))


def test_cascade_is_exact(spark):
    universe = spark.range(5000).selectExpr("concat('k', id) AS key").union(spark.sql("SELECT CAST(NULL AS STRING)"))
    listed = spark.range(0, 5000, 7).selectExpr("concat('k', id) AS key").union(spark.sql("SELECT 'absent'"))
    cascade = url_filter.build_cascade(universe, listed, Scratch(spark))
    assert len(cascade.levels) > 1
    rows = universe.where("key IS NOT NULL").select("key", *bloom.hashes("key")).toPandas()
    told = cascade.listed(rows.h1.to_numpy(), rows.h2.to_numpy())
    assert [int(k[1:]) % 7 == 0 for k in rows.key] == told.tolist()
    empty = url_filter.build_cascade(universe, listed.where("false"), Scratch(spark))
    assert not empty.levels and not empty.listed(rows.h1.to_numpy(), rows.h2.to_numpy()).any()


def test_cascade_of_more_keys_than_a_filter_holds(spark, monkeypatch):
    monkeypatch.setattr(bloom, "MAX_BITS", 2048)
    monkeypatch.setattr(bloom.shape, "__defaults__", (2048,))
    universe = spark.range(6000).selectExpr("concat('k', id) AS key")
    for step in (3, 1):
        cascade = url_filter.build_cascade(universe, universe.where(f"CAST(substring(key, 2) AS INT) % {step} = 0"), Scratch(spark))
        assert len(cascade.cascades) > 2 and all(len(w) * 64 <= 2048 for c in cascade.cascades for w, _ in c.levels)
        rows = universe.select("key", *bloom.hashes("key")).toPandas()
        told = cascade.listed(rows.h1.to_numpy(), rows.h2.to_numpy())
        assert [int(k[1:]) % step == 0 for k in rows.key] == told.tolist()


def test_urls_keep_columns_of_any_name(spark):
    frame = spark.createDataFrame([(1, "http://a.com/", "k", "x", 7)], "page_id long, url string, _keys string, _h1 string, __H2 int")
    row = url_filter.judge(frame, queries.URL_RULES, spark.createDataFrame([], "key string"), Scratch(spark)).first()
    assert (row["_keys"], row["_h1"], row["__H2"], row["rule"], row["verdict"]) == ("k", "x", 7, "com/", "allow")


def test_urls(spark):
    urls = {
        "http://A.Example.com/en/x?q=1": ("block", "example.com/en/"), "https://www.example.com/en/": ("allow", "www.example.com/en/"),
        "http://x.www.example.com/en/a#b": ("allow", "www.example.com/en/"), "http://example.com": ("allow", None), "http://a.com/?": ("allow", "com/"),
        "ftp://a.b.net/es/1": ("block", "net/es/"), "http://a.net/de/": ("allow", None), "http://notexample.com/en/": ("allow", "com/"), "nothing": ("allow", None),
        None: ("allow", None), "http://spam-x.org/a": ("block", None), "http://net/fr/": ("block", "net/fr/"), "http://a..com/": ("allow", "com/"), "": ("allow", None), "a://b?c://d/e": ("allow", None),
    }
    frame = spark.createDataFrame([(i, u, "r", 1) for i, u in enumerate(urls)] + [(0, next(iter(urls)), "r", 1)], "page_id long, url string, rule string, Host int")
    listed = spark.createDataFrame([("spam-x.org",), (None,)], "key string")
    for r in url_filter.judge(frame, queries.URL_RULES, listed, Scratch(spark)).collect():
        assert (r["verdict"], r["rule"]) == urls[r["url"]], r["url"]
    assert url_filter.judge(frame.where("false"), queries.URL_RULES, listed, Scratch(spark)).count() == 0
    assert {r["verdict"] for r in url_filter.judge(frame, [], listed.where("false"), Scratch(spark)).collect()} == {"allow"}
