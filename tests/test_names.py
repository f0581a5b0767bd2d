"""Golden rows of names, conversion, search and review."""

import json

import pytest
from pyspark.sql import functions as F

from tagpulse.functions import text as T
from tagpulse.functions.han import Converter, convert
from tagpulse.operators import names as N
from tagpulse.operators import review as R
from tagpulse.operators import serving as V
from tagpulse.sources import readers, sinks

CONV = Converter(
    {
        "t2s": [[("國", "国"), ("蘋", "苹"), ("會", "会")]], "s2t": [[("国", "國"), ("苹", "蘋"), ("会", "會")]], "s2tw": [[("国", "國"), ("苹", "蘋"), ("会", "會")]],
        "jp2t": [[("黒", "黑"), ("国", "國"), ("会", "會")]], "t2jp": [[("黑", "黒"), ("國", "国"), ("會", "会")]],
    }
)
NAMES = "tag string, zh_hans string, zh_hant string, ja string, en string, ko string, rejected boolean"


def one(spark, fn, *values):
    return [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string").orderBy("i").select(fn(F.col("x"))).collect()]


def test_text_functions(spark):
    assert one(spark, T.title_slug, "big_red-dog", "a__b") == ["Big Red-dog", "A  B"]
    assert one(spark, T.strip_trailing_bracket, "名(a)", "(a)") == ["名", "(a)"]
    assert one(spark, T.expand_iteration, "幽々子", "々子", "佐々々") == ["幽幽子", "々子", "佐佐佐"]
    assert one(spark, T.repair_brackets, "足柄「一番)", "盗贼(山", "a))", "(b", "(c)") == ["足柄(一番)", "盗贼(山)", "a", "b", "(c)"]
    assert one(spark, lambda c: T.full_width(c, "zh_hans"), "崩坏:星穹", "Re:从零", "有罪!?", "未来 (cosplay)", "罗托(DQ3)") == ["崩坏：星穹", "Re:从零", "有罪！？", "未来（cosplay）", "罗托(DQ3)"]
    assert one(spark, T.stem, "a_(x)_b", "c_(d)") == ["a_b", "c"]
    assert one(spark, lambda c: T.strict_day(c).cast("string"), "2005-01-01T00", "2005-1-01T00", "2005-13-01") == ["2005-01-01", None, None]
    assert one(spark, T.is_han_name, "東京", "東京タワー", None) == [True, False, False]


def test_conversion_longest_match_and_protection(spark):
    stage = [("头发", "頭髮"), ("发", "發"), ("头", "頭")]
    assert one(spark, lambda c: convert(c, [stage]), "头发发头") == ["頭髮發頭"]
    assert one(spark, lambda c: convert(c, [stage], "x"), "头x发") == ["頭x發"]


def test_repairs_are_guarded(spark):
    assert one(spark, CONV.repair_simplified, "国会", "黒国", "月姫") == ["国会", "黑国", "月姬"]
    assert one(spark, CONV.is_simplified, "国", "國", "姫") == [True, False, False]
    assert one(spark, CONV.repair_traditional, "黒會", "國") == ["黑會", "國"]


def test_override_layer_follows_only_conversions(spark):
    names = spark.createDataFrame([("a", "国", "國", None, None, None, False), ("b", "国", "別名", None, None, None, False)], NAMES)
    layer = spark.createDataFrame([("a", "会", None, None), ("b", "会", None, None), ("c", None, None, "會")], "tag string, value string, hans string, hant string")
    got = {r.tag: (r.zh_hans, r.zh_hant) for r in N.override_layer(names, layer, CONV).collect()}
    assert got == {"a": ("会", "會"), "b": ("会", "別名"), "c": (None, "會")}


def test_rejected_is_not_absent(spark):
    names = spark.createDataFrame([("a", "国", "國", "x", None, None, False), ("c", None, None, None, "C", None, False)], NAMES)
    out = N.reject_layer(names, spark.createDataFrame([("a",), ("b",)], "tag string"))
    rows = {r.tag: json.loads(r.names) for r in sinks.display_name_rows(out).collect()}
    assert rows == {"a": {"zh_hans": None, "zh_hant": None, "ja": "x"}, "b": {"zh_hans": None, "zh_hant": None}, "c": {"en": "C"}}


def test_disambiguation(spark):
    tags = ["homura", "homura_(magical)", "ritsuka_(male)", "ritsuka_(female)", "admiral_(kan)", "female_admiral_(kan)", "alone_(game)"]
    same = {"homura": "焰", "ritsuka": "立香", "admiral": "提督", "female": "提督", "alone": "独"}
    rows = [(t, same[t.split("_")[0]], None, None, None, None, False) for t in tags]
    labels = spark.createDataFrame([("magical", "魔法", 1), ("male", "男", 1)], "qualifier string, label string, priority int")
    names = spark.createDataFrame(rows, NAMES)
    got = {r.tag: r.zh_hans for r in N.disambiguate(names, names.select("tag"), labels, CONV).collect()}
    assert got == {
        "homura": "焰", "homura_(magical)": "焰（魔法）", "ritsuka_(male)": "立香（男）", "ritsuka_(female)": "立香（female）", "admiral_(kan)": "提督", "female_admiral_(kan)": "提督（female）", "alone_(game)": "独",
    }


def test_pick_and_build(spark):
    wiki = [("cat_(game)", 0, "ネコ(ゲーム)"), ("cat_(game)", 1, "国"), ("cat_(game)", 2, "Cat")]
    buckets = N.bucket_aliases(spark.createDataFrame(wiki, "tag string, pos int, name string"), CONV)
    row = N.build_map(buckets, N.pick_character, CONV).first()
    assert (row.ja, row.en, row.zh_hans) == ("ネコ", "Cat", "国")


def test_names_list_and_search(spark):
    dim = spark.createDataFrame([(1, "cat", 0, 5, False), (2, "dog", 0, 5, False)], "tag_id int, name string, category int, post_count long, is_deprecated boolean")
    names = spark.createDataFrame([("cat", "国", "國", "ネコ", "Cat", None, False)], NAMES)
    pool = spark.createDataFrame([("cat", ["ネコ", "CAT", "neko", "NEKO"]), ("dog", ["inu"])], "tag string, names array<string>")
    listed = V.names_list(dim, names, pool)
    assert [r.name for r in listed.where("tag = 'cat'").orderBy("pos").collect()] == ["国", "國", "ネコ", "Cat", "neko"]
    rows = V.search_rows(dim, listed, CONV)
    assert V.search(rows, "ねこ").first().tag == "cat"
    queries = spark.createDataFrame([("ek",), ("國",), ("inu",), ("",)], "query string")
    assert sorted(map(tuple, V.search_many(rows, queries).collect())) == [("ek", "cat"), ("inu", "dog"), ("國", "cat")]


def test_review_verdicts(spark):
    answers = spark.createDataFrame([("a", "国"), ("b", "國"), ("c", "neko"), ("d", "ネコ国"), ("e", " "), ("z", "国")], "tag string, value string")
    inputs = spark.createDataFrame([(t, "国" if t == "a" else None) for t in "abcde"], "tag string, current_zh string")
    got = {r.tag: r.verdict for r in R.judge(answers, inputs, CONV, review=True).collect()}
    assert got == {"a": "confirmed", "b": "not-simplified", "c": "no-han", "d": "contains-kana", "e": "empty", "z": "unknown-tag"}


def test_readers(spark, tmp_path):
    def put(name, value, bom=""):
        path = tmp_path / name
        path.write_text(bom + (value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)), encoding="utf-8")
        return str(path)

    layer = readers.read_layer(spark, put("layer.json", {"a": "国", "b": {"zh_hant": "會"}}))
    assert sorted(map(tuple, layer.collect()), key=str) == [("a", "国", None, None), ("b", None, None, "會")]
    assert readers.read_layer(spark, str(tmp_path / "none.json")).count() == 0
    assert readers.read_rejections(spark, put("r1.json", ["x"])).first().tag == "x"
    assert readers.read_rejections(spark, put("r2.json", {"y": "v"})).first().tag == "y"
    put("out_0001.json", {"a": "国", "b": {"zh_hans": "会"}, "c": None}, bom="﻿")
    put("out_0002.json", "[broken")
    answers, status = readers.read_batches(spark, str(tmp_path))
    assert sorted(map(tuple, answers.collect())) == [(1, "a", "国"), (1, "b", "会")]
    assert {r.batch: r.corrupt for r in status.collect()} == {1: False, 2: True}
    put("fix1.json", {"fixes": {"a": "国"}, "reject": ["q"]})
    assert tuple(readers.read_proposals(spark, [str(tmp_path)], ["none*.json", "fix*.json"]).first()) == ("a", 1, "fix1.json", "国")
    put("s1.tsv", "tag\tcurrent_zh\na\t国\n")
    put("s2.tsv", "qualifier\tbefore\nq\tx\n")
    assert {r.tag for r in readers.read_review_shards(spark, f"{tmp_path}/*.tsv").collect()} == {"a", "q"}
    with pytest.raises(FileNotFoundError):
        readers.read_alias_pool(spark, str(tmp_path / "pool.json"), spark.createDataFrame([("a",)], "tag string"))
    assert readers.read_overrides(spark, put("o.json", {"n": ["ja"], "m": "no"})).first().langs == ["ja"]


def test_search_takes_every_twentieth_key(spark, monkeypatch):
    from tagpulse.plans import name_queries as Q

    asked = []
    monkeypatch.setattr(Q, "spelled", lambda s, d: s.range(1, 101).selectExpr("id AS k", "'abc' AS hant"))
    monkeypatch.setattr(Q, "_search_rows", lambda s, d: None)
    monkeypatch.setattr(Q.V, "search_many", lambda rows, queries: asked.append({r.query for r in queries.collect()}))
    Q.search_many_whole(spark, "x")
    assert asked == [{"abc", "RT_20", "RT_40", "RT_60", "RT_80", "RT_100"}]
