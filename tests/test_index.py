"""Golden rows of the index: aliases, cells, totals, months, metrics, ingest."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tagpulse.operators import aliases as A
from tagpulse.operators import cells as C
from tagpulse.operators import series as S
from tagpulse.plans import file_queries
from tagpulse.sources.readers import active_aliases
from tagpulse.streaming import ingest as I

TAGS = [(1, "solo", 0, 500, 0), (2, "singer", 4, 300, 0), (3, "rare", 0, 3, 0), (4, "old_word", 0, 200, 1), (5, "painter", 1, 900, 0)]
POSTS = [
    (1, "2005-01-01T01:00:00-05:00", "solo singer painter", 10, 1, 0), (2, "2005-01-01T23:59:00-05:00", "solo diva nickname", 20, None, None),
    (3, "2005-01-02T00:00:00-05:00", "solo rare", 4, 2, 0), (4, "2005-01-02T00:00:00-05:00", "solo", 99, 9, 1), (5, "2005-1-2", "solo", 1, 1, 0), (6, None, "solo", 1, 1, 0),
]


@pytest.fixture
def tables(spark):
    tags = spark.createDataFrame(TAGS, "id int, name string, category int, post_count long, is_deprecated int")
    posts = spark.createDataFrame(POSTS, "id long, created_at string, tag_string string, fav_count int, score int, is_deleted int")
    aliases = spark.createDataFrame([("nickname", "diva", "active"), ("diva", "singer", "active"), ("gone", "solo", "deleted")], "antecedent_name string, consequent_name string, status string")
    return tags, posts, aliases


def lookup(tables):
    tags, _, aliases = tables
    return A.tag_lookup(C.tag_dim(tags), A.resolve_aliases(active_aliases(aliases)))


def test_dimension_floor_category_flag(tables):
    rows = {r.name: r.is_deprecated for r in C.tag_dim(tables[0]).collect()}
    assert rows == {"solo": False, "singer": False, "old_word": True}


def test_chains_and_cycles(spark):
    edges = [("a", "b"), ("b", "c"), ("x", "y"), ("y", "z"), ("z", "y"), ("p", "p")]
    got = A.resolve_aliases(spark.createDataFrame(edges, "antecedent_name string, consequent_name string")).collect()
    assert {r[0]: r[1] for r in got} == {"a": "c", "b": "c", "x": "y", "y": "y", "z": "y", "p": "p"}


def test_alias_overrides_tag_of_its_name(spark, tables):
    dim = C.tag_dim(tables[0])
    aliases = spark.createDataFrame([("solo", "singer")], "antecedent_name string, consequent_name string")
    assert {r.name: r.tag_id for r in A.tag_lookup(dim, aliases).collect()}["solo"] == 2


def test_cells_count_multiplicity(tables):
    got = {(r.tag_id, str(r.day)): (r.posts, r.fav_sum) for r in C.daily_cells(tables[1], lookup(tables)).collect()}
    assert got == {(1, "2005-01-01"): (2, 30), (2, "2005-01-01"): (3, 50), (1, "2005-01-02"): (1, 4)}


def test_totals_count_posts(tables):
    got = {str(r.day): (r.posts, r.fav_sum) for r in C.daily_totals(tables[1]).collect()}
    assert got == {"2005-01-01": (2, 30), "2005-01-02": (1, 4)}
    assert C.daily_totals(tables[1], include_deleted=True).where("day = '2005-01-02'").first().posts == 2


def test_totals_of_every_post(spark, tables, monkeypatch, tmp_path):
    from tagpulse.plans import index_queries as Q
    from tagpulse.sources.sinks import write_clustered

    more = spark.createDataFrame([(7000, "2005-01-03T00:00:00-05:00", "solo", 1, 1, 0)], tables[1].schema)
    posts = tables[1].where("id <> 5").union(more)
    assert {str(r.day): r.posts for r in C.daily_totals(posts, include_deleted=True, max_id=3).collect()} == {"2005-01-01": 2}
    monkeypatch.setattr(Q.Index, "view", lambda self, name: posts)
    assert {str(r.day): (r.posts, r.max_id) for r in Q.every_post_totals(spark, "x").collect()} == {"2005-01-01": (2, 7001), "2005-01-02": (2, 7001), "2005-01-03": (1, 7001)}
    write_clustered(spark.range(300).withColumnRenamed("id", "tag_id"), str(tmp_path / "c"), ["tag_id"])
    cells = spark.read.parquet(str(tmp_path / "c"))
    assert cells.count() == 300 and cells.where("tag_id between 20 and 120").count() == 101


def test_ingest_in_slices_equals_one_shot(spark, tables, tmp_path):
    source, out, ckpt = (str(tmp_path / n) for n in ("posts", "out", "ckpt"))
    tables[1].repartition(3).write.parquet(source)
    stream = spark.readStream.schema(tables[1].schema).option("maxFilesPerTrigger", 1).parquet(source)
    I.ingest(stream, out, ckpt, {"floor": 100})
    I.ingest(stream, out, ckpt, {"floor": 100})
    cells, totals = I.merged(spark, out, lookup(tables))
    assert sorted(cells.collect()) == sorted(C.daily_cells(tables[1], lookup(tables)).collect())
    assert sorted(totals.collect()) == sorted(C.daily_totals(tables[1]).collect())
    with pytest.raises(ValueError):
        I.ingest(stream, out, ckpt, {"floor": 200})


def months(spark, values):
    first = dt.date(2010, 1, 1)
    rows = [(i, dt.date(2010 + i // 12, 1 + i % 12, 1), v) for i, v in enumerate(values)]
    assert rows[0][1] == first
    return spark.createDataFrame(rows, "i int, month date, posts long")


@pytest.mark.parametrize(
    ("values", "expected"),
    [([100] * 20, (0, 19)), ([100] * 19 + [10], (0, 18)), ([10] + [100] * 19, (1, 19)), ([10] + [100] * 18 + [10], (1, 18)), ([100] * 10 + [5] + [100] * 9, (0, 19)), ([1, 100], (0, 1))],
)
def test_complete_months(spark, values, expected):
    assert tuple(S.complete_months(months(spark, values)).first()) == expected


def test_concentration_invariants(spark):
    rows = [(t, dt.date(2010, 1, 1), t * 10) for t in range(1, 6)] + [(9, dt.date(2010, 2, 1), 7)]
    tag_months = spark.createDataFrame([(t, m, p, 0, 0) for t, m, p in rows], "tag_id int, month date, posts long, fav_sum long, score_sum long")
    dim = spark.createDataFrame([(t, f"t{t}", 3, 1, False) for t in (1, 2, 3, 4, 5, 9)], "tag_id int, name string, category int, post_count long, is_deprecated boolean")
    for r in S.category_monthly(tag_months, dim).collect():
        assert 1 <= r.n_eff <= r.active_tags + 1e-9
    sums = S.category_share(tag_months, dim).groupBy("category", "month").agg(F.sum("s").alias("s")).collect()
    assert all(abs(r.s - 1) < 1e-9 for r in sums)
    assert S.relative(tag_months, dim).where("month = '2010-02-01'").count() == 0  # a lone tag has no competitor


def test_dense_series_fills_gaps(spark):
    axis = months(spark, [5] * 6)
    values = axis.where("i in (1, 4)").select(F.lit("z").alias("name"), "month", F.col("posts"))
    assert [(r.i, r.posts) for r in S.dense_series(values, axis, "name", "posts").orderBy("i").collect()] == [(1, 5), (2, 0), (3, 0), (4, 5)]


def test_smoothing_keeps_a_line_and_its_ends(spark):
    series = spark.createDataFrame([("a", i, 3.0 * i + 1) for i in range(30)], "name string, i int, v double")
    for r in S.smooth(series, "name", "v", 12).collect():
        assert abs(r.smoothed - (3.0 * r.i + 1)) < 1e-6
    assert S.smooth(series, "name", "v", 0).where("i = 3").first().smoothed == 10.0


def test_serving_sql_states_the_operators_n_eff(spark):
    """To the last bit, in category months of many unequal counts."""
    import duckdb

    rows = [(t, dt.date(2020, m, 1), t * m % 7 + t % 11 + 1) for t in range(400) for m in range(1, 13)]
    months = spark.createDataFrame([(*r, 0, 0) for r in rows], "tag_id int, month date, posts long, fav_sum long, score_sum long")
    dim = spark.createDataFrame([(t, f"t{t}", t % 3) for t in range(400)], "tag_id int, name string, category int")
    got = {(r.category, r.month): r.n_eff for r in S.category_monthly(months, dim).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE months (tag_id INT, month DATE, posts BIGINT)")
    con.executemany("INSERT INTO months VALUES (?, ?, ?)", rows)
    con.execute("CREATE TABLE dim AS SELECT i AS tag_id, 't' || i AS name, i % 3 AS category FROM range(400) r(i)")
    want = {(c, m): n for c, m, n in con.execute(f"WITH {file_queries.WHOLE_CATEGORIES} SELECT category, month, n_eff FROM categories").fetchall()}
    assert got == want
