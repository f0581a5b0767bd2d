"""The serving set under its pointer, stored grams, look-ups by key."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tagpulse.operators import serving as V
from tagpulse.sources import serving_store as store


def tables(spark, mark):
    one = lambda text: spark.createDataFrame([(1, mark)], text)
    return {"totals": one("i int, x string"), "categories": spark.createDataFrame([(3, 1, mark)], "category int, i int, x string"), "tags": spark.createDataFrame([(mark,)], "name string"), "names": spark.createDataFrame([("t", 1, mark)], "tag string, pos int, x string"), "search": spark.createDataFrame([("t", mark)], "tag string, x string"), "meta": one("i int, x string")}


def marks(tables):
    return {r[-1] for df in tables.values() for r in df.collect()}


def test_readers_keep_their_version(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "s")
    with pytest.raises(FileNotFoundError):
        store.read_serving(spark, root)
    first = store.publish(tables(spark, "one"), root)
    held = store.read_serving(spark, root)
    write, calls = store.write_keyed, []

    def killed(df, path, *rest):
        calls.append(path)
        if len(calls) == 4:
            raise RuntimeError("killed")
        write(df, path, *rest)

    monkeypatch.setattr(store, "write_keyed", killed)
    with pytest.raises(RuntimeError):
        store.publish(tables(spark, "two"), root)
    assert store.current_version(spark, root) == first and marks(store.read_serving(spark, root)) == {"one"}
    monkeypatch.setattr(store, "write_keyed", write)
    second = store.publish(tables(spark, "three"), root)
    assert marks(held) == {"one"} and marks(store.read_serving(spark, root)) == {"three"}
    assert marks(store.read_serving(spark, root, first)) == {"one"}
    store.expire_versions(spark, root, keep=[first])
    assert {p.name for p in (tmp_path / "s").iterdir() if p.is_dir()} == {first, second}
    store.expire_versions(spark, root)
    assert {p.name for p in (tmp_path / "s").iterdir() if p.is_dir()} == {second}
    with pytest.raises(ValueError):
        store.publish({k: v for k, v in tables(spark, "x").items() if k != "meta"}, root)


def scanned(df):
    """Rows that the scans of an executed query gave out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    seen, todo = 0, [plan]
    while todo:
        p = todo.pop()
        if "AdaptiveSparkPlan" in p.nodeName():
            todo.append(p.executedPlan())
            continue
        if p.nodeName().startswith("Scan parquet"):
            seen += p.metrics().apply("numOutputRows").value()
        if "QueryStage" in p.nodeName():
            todo.append(p.plan())
        todo.extend(p.children().apply(i) for i in range(p.children().size()))
    return seen


def test_lookup_reads_one_row_group(spark, tmp_path, monkeypatch):
    """Of 60,000 names in row groups of some thousands: a name there reads one row group, one that is missing within the range none."""
    monkeypatch.setattr(store, "KEYED_BLOCK", 64 << 10)
    path = str(tmp_path / "dim")
    dim = spark.range(60_000).select(F.col("id").cast("int").alias("tag_id"), F.concat(F.lit("part_"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("name"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    store.write_keyed(dim, path, ["name"])
    groups = sorted(__import__("pyarrow.parquet", fromlist=["x"]).ParquetFile(p).metadata.row_group(0).num_rows for p in (tmp_path / "dim").glob("*.parquet"))
    hit, miss = V.find(spark.read.parquet(path), "part_017171"), V.find(spark.read.parquet(path), "part_017171x")
    assert [r.tag_id for r in hit.collect()] == [17171]
    assert 0 < scanned(hit) <= groups[-1] < 30_000
    assert scanned(miss) == 0


def test_stored_search(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "KEYED_BLOCK", 64 << 10)
    rows = spark.createDataFrame([(f"tag{i}", [f"name {i}", "あい" if i % 2 else "x", "ab"]) for i in range(3000)] + [("none", [])], "tag string, terms array<string>")
    path = str(tmp_path / "grams")
    store.write_postings(V.postings(rows), path)
    queries = spark.createDataFrame([("E 29",), ("e 2999",), ("い",), ("",), ("zzz",), ("AB",), ("me 17",), ("name 1 ",)], "query string")
    got, want = V.search_stored(queries, path), V.search_many(rows, queries)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.where("query = 'い'").count() == 1500
    one = V.search_stored(spark.createDataFrame([("e 2999",)], "query string"), path)
    plan = one._jdf.queryExecution().toString()
    assert "PushedFilters: [" in plan and "gram" in plan.split("PushedFilters: [", 1)[1]
    assert "explode" not in plan.lower()
    assert scanned(one) < spark.read.parquet(f"{path}/postings").count() / 5
    assert V.search_stored(queries.limit(0), path).count() == 0


def test_declared_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).select("id", F.lit(dt.date(2020, 1, 1)).alias("day")).write.parquet(path)
    store.require_tables(spark, {path: "id long, day date"})
    for schema in ("id int", "id long, day string", "other long"):
        with pytest.raises(ValueError, match="not as declared"):
            store.require_tables(spark, {path: schema})
    with pytest.raises(FileNotFoundError):
        store.require_tables(spark, {f"{path}x": "id long"})


def test_a_place_of_a_term_is_stored_once(spark):
    rows = spark.createDataFrame([("t", ["abcd", "aaaa", "x"])], "tag string, terms array<string>")
    assert sorted((r.term, r.gram) for r in V.postings(rows).collect()) == [("aaaa", "a"), ("aaaa", "aa"), ("aaaa", "aaa"), ("abcd", "abc"), ("abcd", "bcd"), ("abcd", "cd"), ("abcd", "d"), ("x", "x")]


def test_serving_set_is_made_of_written_tables(spark, monkeypatch):
    """What several tables are made of is a scan of a written table, and so is each table before the range sort that reads it twice."""
    from tagpulse.plans import file_queries

    steps = lambda df: all("/step-" in f for f in df.inputFiles()) and "Scan parquet" in (plan := df._jdf.queryExecution().sparkPlan().toString()) and len(plan.strip().splitlines()) == 1
    seen, real = [], V.serving_set

    def watched(dim, months, totals, categories, names, pool, *rest, **options):
        out = real(dim, months, totals, categories, names, pool, *rest, **options)
        seen.append({"inputs": [steps(df) for df in (months, totals, categories, names)], **{k: steps(df) for k, df in out.items()}})
        return out

    monkeypatch.setattr(V, "serving_set", watched)
    kinds = {r.kind for r in file_queries.serving_set(spark, "/root/testdata/sf0.001").select("kind").distinct().collect()}
    assert kinds == set(store.TABLES)
    assert seen == [{"inputs": [True] * 4} | dict.fromkeys(store.TABLES, True)] * 2


def test_names_list_reads_its_inputs_once(spark):
    """Aliases that repeat a name are found without a join of the list to itself."""
    from tagpulse.functions.han import Converter
    from tagpulse.plans.fixture import STAGES

    dim = spark.createDataFrame([("a",), ("b",), (None,)], "name string")
    names = V.fill_chinese(spark.createDataFrame([("a", "国", None, "x", "X", None)], "tag string, zh_hans string, zh_hant string, ja string, en string, ko string"), Converter(STAGES))
    listed = V.names_list(dim, names, spark.createDataFrame([("a", ["y", "Y", "X", "A"]), ("b", ["b", "z", "z"])], "tag string, names array<string>"))
    assert sorted(map(tuple, listed.collect())) == [("a", 0, "zh_hans", "国"), ("a", 1, "zh_hant", "國"), ("a", 2, "ja", "x"), ("a", 3, "en", "X"), ("a", 5, None, "y"), ("b", 6, None, "z")]
    assert listed._jdf.queryExecution().optimizedPlan().toString().count("Generate") == 1
