"""Slices: committed whole or not at all, by ids, merged by levels."""

import pytest
from pyspark.sql import functions as F

from tagpulse import schemas
from tagpulse.operators import cells as C
from tagpulse.streaming import ingest as I


@pytest.fixture(scope="module")
def posts(spark):
    rows = [(i, f"2005-01-{1 + i % 9:02d}T12:00:00.000-05:00", f"a b{i % 4}" + (" a" if i % 3 else ""), i, -i, int(i % 7 == 0)) for i in range(3, 60)]
    return spark.createDataFrame(rows, schemas.POSTS).cache()


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.createDataFrame([("a", 1), ("b0", 2), ("b1", 3), ("b2", 1)], "name string, tag_id int").cache()


def places(tmp_path):
    return [str(tmp_path / n) for n in ("posts", "out", "ckpt")]


def same(got, posts, lookup):
    cells, totals = got
    assert sorted(cells.collect()) == sorted(C.daily_cells(posts, lookup).collect())
    assert sorted(totals.collect()) == sorted(C.daily_totals(posts).collect())


def test_a_killed_slice_shows_neither_half(spark, posts, lookup, tmp_path, monkeypatch):
    """Killed between the two writes of its second slice, and again before the marker."""
    source, out, ckpt = places(tmp_path)
    posts.repartitionByRange(3, "id").write.parquet(source)
    stream = lambda: spark.readStream.schema(posts.schema).option("maxFilesPerTrigger", 1).parquet(source)
    write, hadoop = I.write_part, I._hadoop

    def killed(df, path):
        if path.endswith("totals/batch=1"):
            raise RuntimeError("killed")
        write(df, path)

    monkeypatch.setattr(I, "write_part", killed)
    with pytest.raises(Exception, match="killed"):
        I.ingest(stream(), out, ckpt)
    assert (tmp_path / "out/cells/batch=1").exists()
    first = I.read_runs(spark, out, [(0, 1)])
    cells, totals = I.merged(spark, out, lookup)
    assert sorted(totals.collect()) == sorted(first[1].collect())
    assert sorted(cells.collect()) == sorted(C.cells_of_names(first[0], lookup).collect())

    monkeypatch.setattr(I, "write_part", write)
    monkeypatch.setattr(I, "_hadoop", lambda s, p: (_ for _ in ()).throw(RuntimeError("killed")) if p.endswith("done/batch=1") else hadoop(s, p))
    with pytest.raises(Exception, match="killed"):
        I.ingest(stream(), out, ckpt)
    assert I.committed(spark, out) == {(0, 1)} and sorted(I.merged(spark, out, lookup)[1].collect()) == sorted(totals.collect())

    monkeypatch.setattr(I, "_hadoop", hadoop)
    I.ingest(stream(), out, ckpt)
    assert I.committed(spark, out) == {(0, 1), (1, 2), (2, 3)}
    same(I.merged(spark, out, lookup), posts, lookup)


@pytest.mark.parametrize("chunk", [7, 60, 1000])
def test_slices_of_ids(spark, posts, lookup, tmp_path, chunk):
    _, out, ckpt = places(tmp_path)
    I.ingest_ranges(posts, out, ckpt, chunk, fan=100)
    assert len(I.committed(spark, out)) == -(-60 // chunk)
    I.ingest_ranges(posts, out, ckpt, chunk, fan=100)
    assert len(I.committed(spark, out)) == -(-60 // chunk)
    same(I.merged(spark, out, lookup), posts, lookup)


def test_later_rows_and_a_killed_range(spark, posts, lookup, tmp_path, monkeypatch):
    """A run up to id 30, one that is killed in its second slice, one over a table that has grown: nothing twice, late low ids left out."""
    _, out, ckpt = places(tmp_path)
    I.ingest_ranges(posts, out, ckpt, 10, max_id=30, fan=100)
    write = I.write_part
    monkeypatch.setattr(I, "write_part", lambda df, path: (_ for _ in ()).throw(RuntimeError("killed")) if path.endswith("totals/batch=4") else write(df, path))
    with pytest.raises(Exception, match="killed"):
        I.ingest_ranges(posts, out, ckpt, 10, fan=100)
    same(I.merged(spark, out, lookup), posts.where("id < 40"), lookup)
    monkeypatch.setattr(I, "write_part", write)
    late = spark.createDataFrame([(1, "2005-01-01T00:00:00-05:00", "a", 1, 1, 0), (75, "2005-01-02T00:00:00-05:00", "a", 1, 1, 0)], posts.schema)
    I.ingest_ranges(posts.union(late), out, ckpt, 10, fan=100)
    same(I.merged(spark, out, lookup), posts.union(late.where("id > 1")), lookup)
    with pytest.raises(ValueError):
        I.ingest_ranges(posts, out, ckpt, 20)


def test_cover_takes_the_largest_runs():
    runs = {(i, i + 1) for i in range(1000)} | {(i, i + 10) for i in range(0, 1000, 10)} | {(i, i + 100) for i in range(0, 1000, 100)} | {(0, 1000)}
    assert I.cover(runs) == [(0, 1000)]
    assert len(I.cover({r for r in runs if r[1] <= 999})) == 27
    assert I.cover(set()) == [] and I.cover({(0, 1), (2, 3)}) == [(0, 1), (2, 3)]


def test_merging_by_levels(spark, lookup, tmp_path):
    """Thirty slices by threes: a reader meets three runs, totals stay, also when merging is interrupted, and after expiry."""
    out = str(tmp_path / "out")
    for n in range(30):
        cells = spark.createDataFrame([("a", n, 1, n, -n), (f"b{n % 4}", n, 2, 0, 1)], "name string, n int, posts long, fav_sum long, score_sum long")
        day = F.date_add(F.lit("2005-01-01").cast("date"), F.col("n") % 5).alias("day")
        cells = cells.select("name", day, "posts", "fav_sum", "score_sum")
        I.commit_run(spark, out, n, n + 1, cells, cells.where("name = 'a'").drop("name"))
    before = [sorted(t.collect()) for t in I.merged(spark, out, lookup)]
    I.compact(spark, out, 3)
    done = I.committed(spark, out)
    assert (0, 27) in done and I.cover(done) == [(0, 27), (27, 30)]
    assert [sorted(t.collect()) for t in I.merged(spark, out, lookup)] == before
    I.compact(spark, out, 3)
    assert I.committed(spark, out) == done
    I.expire(spark, out)
    assert len(list((tmp_path / "out/cells").iterdir())) == 2
    assert [sorted(t.collect()) for t in I.merged(spark, out, lookup)] == before
    cells, _ = I.merged(spark, out, lookup)
    assert len({f.rpartition("/")[0] for f in cells.inputFiles()}) <= 3
