"""Views of the library's input tables over the star schema and documents: one SQL text for Spark and for DuckDB.

Posts are orders, tags are parts, names are spelled from part keys, so everything grows with the data.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = ("part", "orders", "lineitem", "documents", "labels", "events")

#: Small dictionaries for the conversion jobs: characters that part keys are spelled with, and one phrase.
STAGES = {
    "t2s": [[("會", "会"), ("國", "国"), ("學", "学"), ("圖", "图"), ("劍", "剑"), ("樂", "乐")]],
    "s2t": [[("会", "會"), ("国", "國"), ("学", "學"), ("图", "圖"), ("剑", "劍"), ("乐", "樂")]],
    "s2tw": [[("会", "會"), ("国", "國"), ("学", "學"), ("图", "圖"), ("剑", "劍"), ("乐", "樂")]],
    "jp2t": [[("剣", "劍"), ("国", "國"), ("学", "學"), ("楽", "樂"), ("会", "會")]],
    "t2jp": [[("劍", "剣"), ("國", "国"), ("學", "学"), ("樂", "楽"), ("會", "会")]],
}
PHRASES = [("会国", "協和"), ("会", "會"), ("国", "國")]

SQL = {
    "tags": """
        SELECT CAST(p_partkey AS INT) AS id, 'part_' || CAST(p_partkey AS STRING) AS name,
               CASE WHEN p_type LIKE 'ECONOMY%' OR p_type LIKE 'SMALL%' THEN 0 WHEN p_type LIKE 'PROMO%' THEN 1
                    WHEN p_type LIKE 'LARGE%' THEN 3 WHEN p_type LIKE 'MEDIUM%' THEN 4 ELSE 5 END AS category,
               coalesce(n, 0) AS post_count, CASE WHEN p_size % 10 = 0 THEN 1 ELSE 0 END AS is_deprecated
        FROM {part} LEFT JOIN (SELECT l_partkey, count(*) AS n FROM {lineitem} GROUP BY l_partkey) c ON l_partkey = p_partkey""",
    "aliases": """
        SELECT 'alias_' || CAST(p_partkey AS STRING) AS antecedent_name, 'part_' || CAST(p_partkey AS STRING) AS consequent_name, 'active' AS status
        FROM {part} WHERE p_partkey % 10 IN (3, 7)
        UNION ALL SELECT 'old_' || CAST(p_partkey AS STRING), 'alias_' || CAST(p_partkey AS STRING), 'active' FROM {part} WHERE p_partkey % 10 = 3
        UNION ALL SELECT 'loop_a', 'loop_b', 'active' UNION ALL SELECT 'loop_b', 'loop_a', 'active'
        UNION ALL SELECT 'gone', 'part_1', 'deleted'""",
    "posts": """
        SELECT o_orderkey AS id, CAST(CAST(o_orderdate AS DATE) AS STRING) || 'T12:00:00.000-05:00' AS created_at, tag_string,
               CAST(fav AS INT) AS fav_count, CAST(floor(o_totalprice) AS INT) AS score, CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS is_deleted
        FROM {orders} LEFT JOIN (
          SELECT l_orderkey, sum(l_quantity) AS fav, JOINED AS tag_string FROM (
            SELECT l_orderkey, l_quantity,
                   CASE WHEN l_linenumber % 2 = 0 AND l_partkey % 10 = 3 THEN 'old_' WHEN l_linenumber % 2 = 0 AND l_partkey % 10 = 7 THEN 'alias_' ELSE 'part_' END
                   || CAST(l_partkey AS STRING) AS t FROM {lineitem}) x
          GROUP BY l_orderkey) y ON l_orderkey = o_orderkey""",
    # names: Han (mixed forms), kana, Hangul and Latin spellings of part keys
    "spelled": """
        SELECT 'part_' || CAST(p_partkey AS STRING) AS tag, p_partkey AS k, p_size AS size,
               translate(CAST(p_partkey AS STRING), '0123456789', '会国学图剑乐山水火木') AS hans,
               translate(CAST(p_partkey AS STRING), '0123456789', '會國學圖劍樂山水火木') AS hant,
               translate(CAST(p_partkey AS STRING), '0123456789', '会国学圖剣楽山水火木') AS jahan,
               translate(CAST(p_partkey AS STRING), '0123456789', 'アイウエオカキクケコ') AS kana,
               translate(CAST(p_partkey AS STRING), '0123456789', '가나다라마바사아자차') AS hangul,
               'Name ' || CAST(p_partkey AS STRING) AS latin
        FROM {part}""",
}


def spark_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = SQL[name].replace("JOINED", "array_join(sort_array(collect_list(t)), ' ')")
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"{{{t}}}" in text}
    return spark.sql(text, **used)


def duck_view(name: str) -> str:
    text = SQL[name].replace("JOINED", "string_agg(t, ' ' ORDER BY t)")
    return re.sub(r"\{(\w+)\}", r"\1", text).replace("AS STRING", "AS VARCHAR")


def duck(sql: str, *views: str) -> str:
    """``sql`` with the named fixture views in front."""
    return "WITH RECURSIVE " + ", ".join(f"{v} AS ({duck_view(v)})" for v in views) + (", " if views else "") + sql.strip()
