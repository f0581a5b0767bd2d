"""Readers: files of several values, files that break off, sizes above one object."""

import json

import duckdb
import pytest

import __spark_entry__ as entry_module
from tagpulse import schemas
from tagpulse.plans import file_queries
from tagpulse.sources import readers, sinks

PROPOSED = '{"fixes": {"a": "1", "b": "2"}, "reject": ["x"]}'


@pytest.fixture
def file(tmp_path):
    def make(text, name="x.json"):
        (tmp_path / name).write_text(text, encoding="utf-8")
        return str(tmp_path / name)

    return make


def test_values_of_a_text():
    assert readers.json_values('{"a": 1}') == (['{"a": 1}'], None)
    assert readers.json_values(' {"a": "}{"}\n[1]{}\r\n') == (['{"a": "}{"}', "[1]", "{}"], None)
    bodies, error = readers.json_values('{"a": 1} {"b": ')
    assert bodies == ['{"a": 1}'] and error
    for text in ("", " \n"):
        assert readers.json_values(text) == ([], "no JSON value")


def test_proposals_of_every_object(spark, file, tmp_path):
    file(PROPOSED + '\n{"fixes": {"b": "3", "c": "4"}}' + '{"patterns": ["p"]}')
    got = readers.read_proposals(spark, [str(tmp_path)], ["x*.json"]).collect()
    assert sorted((r.tag, r.round, r.file, r.value) for r in got) == [("a", 0, "x.json", "1"), ("b", 0, "x.json", "3"), ("c", 0, "x.json", "4")]


READ = {
    "map": lambda s, p: readers.read_name_map(s, p),
    "layer": lambda s, p: readers.read_layer(s, p),
    "pool": lambda s, p: readers.read_alias_pool(s, p, s.createDataFrame([("a",)], "tag string")),
    "proposals": lambda s, p: readers.read_proposals(s, [p.rpartition("/")[0]], [p.rpartition("/")[2]]),
    "rejections": lambda s, p: readers.read_rejections(s, p),
    "translations": lambda s, p: readers.read_translation_table(s, p),
    "overrides": lambda s, p: readers.read_overrides(s, p),
    "variants": lambda s, p: readers.read_variants(s, p),
}
WHOLE = {"map": '{"a": {"ja": "x"}}', "layer": '{"a": "x"}', "pool": '{"a": ["x"]}', "proposals": '{"fixes": {"a": "x"}}', "rejections": '["a"]', "translations": '{"a": "x"}', "overrides": '{"a": ["ja"]}', "variants": '{"a": "x"}'}


@pytest.mark.parametrize("kind", sorted(READ))
def test_two_values_and_cut_files(spark, file, kind):
    one = WHOLE[kind]
    two = one + "\n" + one.replace('"a"', '"b"')
    assert READ[kind](spark, file(two)).count() == (1 if kind == "pool" else 2)  # of the pool a is wanted
    for broken in (one[:-1], two[:-1], one + "]", "", "7", '"text"'):
        with pytest.raises(Exception, match="corrupt file .*x.json"):
            READ[kind](spark, file(broken)).collect()


def test_fields_of_another_kind(spark, file, tmp_path):
    path = file('{"fixes": ["a"]}')
    with pytest.raises(Exception, match="corrupt file"):
        readers.read_proposals(spark, [str(tmp_path)], ["*.json"]).collect()
    assert readers.corrupt_files(spark, path, schemas.PROPOSALS).count() == 1


def test_corrupt_files_are_listed(spark, file, tmp_path):
    for name, text in (("good.json", '{"a": "1"}{"b": "2"}'), ("cut.json", '{"a": "1"}{"b": '), ("list.json", "[1]"), ("empty.json", "")):
        file(text, name)
    found = {r.file.rpartition("/")[2]: r.error for r in readers.corrupt_files(spark, f"{tmp_path}/*.json", "map<string,string>").collect()}
    assert set(found) == {"cut.json", "list.json", "empty.json"} and found["empty.json"] == "no JSON value"


def test_batches_of_a_cut_file(spark, file, tmp_path):
    file('{"a": "x"}{"b": null, "c": {"zh_hans": "y"}}', "out_0001.json")
    file('{"a": "x"}{"b": ', "out_0002.json")
    answers, states = readers.read_batches(spark, str(tmp_path))
    assert sorted(tuple(r) for r in answers.collect()) == [(1, "a", "x"), (1, "c", "y")]
    assert {r.batch: r.corrupt for r in states.collect()} == {1: False, 2: True}


@pytest.mark.parametrize("name", ["proposal_files", "name_map_files", "pool_files"])
def test_several_objects_in_a_folder(spark, name):
    """At a size of more than one object a folder."""
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("part", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    want = con.execute(file_queries.ORACLE_SQL[name]).df()
    got = entry_module.queries()[name](spark, folder).toPandas()
    assert len(want) > file_queries.PER_FILE or name == "pool_files"
    key = lambda df: sorted(json.dumps(r, default=str) for r in df[sorted(df.columns)].values.tolist())
    assert key(got) == key(want)


def test_batches_in_folders_of_their_number(spark, tmp_path):
    for batch, text in ((0, '{"a":"x"}'), (12, '{"b":{"zh_hans":"y"},"c":null}'), (7, '{"d":"z"')):
        (tmp_path / f"batch={batch}").mkdir()
        (tmp_path / f"batch={batch}" / "part-00000_3.txt").write_text(text)
    answers, states = readers.read_batches(spark, str(tmp_path), files="*/*.txt", number=r"batch=(\d+)/[^/]*$")
    assert sorted(map(tuple, answers.collect())) == [(0, "a", "x"), (12, "b", "y")]
    assert {r.batch for r in states.collect() if r.corrupt} == {7}


def test_batches_are_committed_by_tasks(spark, tmp_path, monkeypatch):
    """The option reaches the write; files lie where they belong."""
    assert sinks.MANY_FILES["mapreduce.fileoutputcommitter.algorithm.version"] == "2"
    sinks.write_batches(spark.range(6).selectExpr("concat('n', id) AS name", "CAST(id div 2 AS INT) AS batch"), str(tmp_path / "b"))
    assert sorted(p.name for p in (tmp_path / "b").iterdir() if p.is_dir()) == ["batch=0", "batch=1", "batch=2"]


def test_batches_written_by_tasks(spark, tmp_path):
    """What the tasks write reads as what Spark's own writer leaves; former folders go, batches keep their rows' order, null and text batches too."""
    rows = spark.range(60).selectExpr("id", "if(id % 7 = 0, NULL, concat('国\"\\n', id)) AS name", "CAST(if(id % 11 = 5, NULL, id div 4) AS INT) AS batch", "array(id) AS list", "DATE'2020-01-02' AS day").repartition(5)
    path, spark_path = str(tmp_path / "b"), str(tmp_path / "s")
    sinks.write_batches(rows.withColumn("batch", rows["batch"] + 100), path)
    sinks.write_batches(rows, f"file://{path}")
    rows.write.partitionBy("batch").json(spark_path)
    back = lambda p: spark.read.schema(rows.schema).json(p)
    assert sorted(back(path).collect(), key=str) == sorted(back(spark_path).collect(), key=str) == sorted(rows.select(back(path).columns).collect(), key=str)
    folders = lambda p: sorted(x.name for x in p.iterdir() if x.is_dir())
    assert folders(tmp_path / "b") == folders(tmp_path / "s")
    assert {f.name[:5] for f in (tmp_path / "b").glob("*/*")} == {"part-"} and (tmp_path / "b" / "_SUCCESS").exists()
    sinks.write_batches(spark.range(12).coalesce(1).selectExpr("id", "CAST(id % 3 AS INT) AS batch"), path)
    assert [json.loads(x)["id"] for x in next((tmp_path / "b" / "batch=1").iterdir()).read_text().splitlines()] == [1, 4, 7, 10]
    sinks.write_batches(spark.range(3).selectExpr("id", "concat('a/', id) AS batch"), path)
    assert spark.read.schema("id long, batch string").json(path).count() == 3
    sinks.write_batches(rows.limit(0), path)
    assert folders(tmp_path / "b") == [] and back(path).count() == 0
    with pytest.raises(ValueError, match="is read by"):
        sinks.write_batches(spark.read.schema(rows.schema).json(spark_path), spark_path)
    assert back(spark_path).count() == 60
    sinks.write_lines(spark.createDataFrame([(3, "x"), (3, None)], "batch int, value string").coalesce(1), path)
    assert (tmp_path / "b" / "batch=3" / "part-00000.txt").read_text() == "x\n\n"


def test_many_batches_start_no_processes(spark, tmp_path):
    """Hadoop's writer took some 25 ms of a task for each folder."""
    import time

    rows = spark.range(6000).selectExpr("id", "CAST(id div 2 AS INT) AS batch").coalesce(1)
    sinks.write_batches(rows.limit(10), str(tmp_path / "b"))
    began = time.time()
    sinks.write_batches(rows, str(tmp_path / "b"))
    assert time.time() - began < 20
    assert spark.read.schema("id long, batch int").json(str(tmp_path / "b")).count() == 6000
