"""Queries over the index: dimension, cells, rollups, series, metrics, charts; each with its DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators import aliases as A
from ..operators import cells as C
from ..operators import series as S
from ..sources.readers import active_aliases
from ..sources.serving_store import require_tables
from ..sources.shared import new_path, written
from ..sources.sinks import artifact_report, write_clustered
from ..streaming import ingest as I
from .fixture import duck, spark_view

FLOOR = 5
FIRST = "1995-01-01"  # orders begin before the index's own first day


class Index:
    """The fixture's inputs, and the tables derived from them, made when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._kept: dict[str, DataFrame] = {}

    def view(self, name: str) -> DataFrame:
        return self._kept.get(name) or spark_view(self.spark, self.sf_dir, name)

    def kept(self) -> Index:
        """With posts and tags written, for queries that read them more than once: each is a join over all line items."""
        self._kept = {name: written(self.view(name)) for name in ("tags", "posts")}
        return self

    @property
    def dim(self) -> DataFrame:
        return C.tag_dim(self.view("tags"), FLOOR)

    @property
    def resolved(self) -> DataFrame:
        return A.resolve_aliases(active_aliases(self.view("aliases")))

    @property
    def lookup(self) -> DataFrame:
        return written(A.tag_lookup(self.dim, self.resolved))

    @property
    def daily(self) -> DataFrame:
        return C.daily_cells(self.view("posts"), self.lookup, FIRST)

    @property
    def months(self) -> DataFrame:
        return C.monthly_cells(self.view("posts"), self.lookup, FIRST)

    @property
    def totals(self) -> DataFrame:
        return S.monthly(C.daily_totals(self.view("posts"), FIRST))

    @property
    def axis(self) -> DataFrame:
        return S.month_axis(self.totals)


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


DIM = f"""dim AS (SELECT id AS tag_id, name, category::TINYINT AS category, post_count::BIGINT AS post_count, is_deprecated <> 0 AS is_deprecated
  FROM tags WHERE post_count >= {FLOOR} AND category <> 1)"""
RESOLVED = """edges AS (SELECT antecedent_name AS a, consequent_name AS b FROM aliases WHERE status = 'active'),
walk AS (SELECT a, b AS n, 1 AS d FROM edges UNION ALL SELECT walk.a, e.b, d + 1 FROM walk JOIN edges e ON e.a = walk.n WHERE d < 12),
resolved AS (SELECT a AS antecedent_name, coalesce(min(n) FILTER (n NOT IN (SELECT a FROM edges)), min(n) FILTER (d > 6)) AS consequent_name FROM walk GROUP BY a)"""
LOOKUP = """lookup AS (
  SELECT name, arg_max(tag_id, p) AS tag_id FROM (
    SELECT name, tag_id, 0 AS p FROM dim UNION ALL SELECT antecedent_name, tag_id, 1 FROM resolved JOIN dim ON dim.name = consequent_name) GROUP BY name)"""
LIVE = """live AS (SELECT substr(created_at, 1, 10)::DATE AS day, tag_string, coalesce(fav_count, 0)::BIGINT AS fav, coalesce(score, 0)::BIGINT AS score
  FROM posts WHERE is_deleted = 0 AND created_at IS NOT NULL AND tag_string IS NOT NULL)"""
DAILY = """daily AS (
  SELECT tag_id, day, count(*) AS posts, sum(fav)::BIGINT AS fav_sum, sum(score)::BIGINT AS score_sum
  FROM (SELECT day, fav, score, unnest(string_split(tag_string, ' ')) AS name FROM live) JOIN lookup USING (name) GROUP BY tag_id, day)"""
TOTALS = "total_daily AS (SELECT day, count(*) AS posts, sum(fav)::BIGINT AS fav_sum, sum(score)::BIGINT AS score_sum FROM live GROUP BY day)"
MONTHS = """months AS (SELECT tag_id, date_trunc('month', day)::DATE AS month, sum(posts)::BIGINT AS posts, sum(fav_sum)::BIGINT AS fav_sum, sum(score_sum)::BIGINT AS score_sum FROM daily GROUP BY ALL)"""
TOTAL_MONTHS = """totals AS (SELECT date_trunc('month', day)::DATE AS month, sum(posts)::BIGINT AS posts, sum(fav_sum)::BIGINT AS fav_sum, sum(score_sum)::BIGINT AS score_sum FROM total_daily GROUP BY ALL)"""
CATEGORIES = """shares AS (SELECT name, category, month, posts, posts / sum(posts) OVER (PARTITION BY category, month) AS s FROM months JOIN dim USING (tag_id)),
categories AS (SELECT category, month, sum(posts)::BIGINT AS posts, 1 / sum(s * s) AS n_eff, count(*) AS active_tags FROM shares GROUP BY ALL)"""
AXIS = """epoch AS (SELECT min(month) AS e, max(month) AS z FROM totals),
axis AS (SELECT i::INT AS i, (e + to_months(i::INT))::DATE AS month FROM epoch, unnest(range(0, datediff('month', e, z) + 1)) AS u(i)),
points AS (SELECT name, datediff('month', e, month)::INT AS i, posts FROM months JOIN dim USING (tag_id), epoch)"""
COMPLETE = """line AS (SELECT i, coalesce(posts, 0) AS posts FROM axis LEFT JOIN totals USING (month)),
n AS (SELECT max(i) AS last_i FROM line),
whole AS (SELECT CASE WHEN last_i < 13 THEN 0 WHEN (SELECT posts FROM line WHERE i = 0) < 0.6 * (SELECT list_sort(list(posts))[7] FROM line WHERE i BETWEEN 1 AND 12) THEN 1 ELSE 0 END AS "first",
  CASE WHEN last_i < 13 THEN last_i WHEN (SELECT posts FROM line, n WHERE i = last_i) < 0.6 * (SELECT list_sort(list(posts))[7] FROM line, n WHERE i BETWEEN last_i - 12 AND last_i - 1) THEN last_i - 1 ELSE last_i END AS "last" FROM n)"""
DENSE = """ends AS (SELECT name, min(i) AS a, max(i) AS z FROM points GROUP BY name),
dense AS (SELECT e.name, u.i::INT AS i, coalesce(p.posts, 0) AS posts FROM (SELECT name, unnest(range(a, z + 1)) AS i FROM ends) u JOIN ends e USING (name) LEFT JOIN points p ON p.name = e.name AND p.i = u.i)"""
SMOOTH = """kernel AS (
  SELECT c.name, c.i, sum(w) AS s0, sum(w * d) AS s1, sum(w * d * d) AS s2, sum(w * y) AS t0, sum(w * d * y) AS t1 FROM (
    SELECT a.name, a.i, (b.i - a.i)::DOUBLE AS d, b.posts::DOUBLE AS y, exp(-((b.i - a.i) * (b.i - a.i))::DOUBLE / 18) AS w
    FROM {src} a JOIN {src} b ON a.name = b.name AND abs(a.i - b.i) <= 6) c GROUP BY ALL),
smoothed AS (SELECT name, i, CASE WHEN s0 * s2 - s1 * s1 > 1e-12 THEN (s2 * t0 - s1 * t1) / (s0 * s2 - s1 * s1) ELSE t0 / s0 END AS smoothed FROM kernel)"""


def sql(final: str, *parts: str, views: tuple[str, ...] = ("tags", "aliases", "posts")) -> str:
    return duck(", ".join(parts) + " " + final, *views)


CELLS = (DIM, RESOLVED, LOOKUP, LIVE, DAILY)
ALL = (*CELLS, TOTALS, MONTHS, TOTAL_MONTHS)


def tag_dim(spark, d):
    return Index(spark, d).dim


def alias_resolve(spark, d):
    return Index(spark, d).resolved


def tag_lookup(spark, d):
    x = Index(spark, d)
    return A.tag_lookup(x.dim, x.resolved)


def daily_cells(spark, d):
    return Index(spark, d).daily


def daily_totals(spark, d):
    return C.daily_totals(Index(spark, d).view("posts"), FIRST)


def all_posts_totals(spark, d):
    """Deleted posts too, below the bound that a run takes by default: the table's next id."""
    posts = Index(spark, d).view("posts")
    bound = F.broadcast(C.next_id(posts))  # one row
    below = posts.crossJoin(bound).where("id < max_id").drop("max_id")
    return C.daily_totals(below, FIRST, include_deleted=True).crossJoin(bound)


def every_post_totals(spark, d):
    """As all_posts_totals, without a bound."""
    posts = Index(spark, d).view("posts")
    return C.daily_totals(posts, FIRST, include_deleted=True).crossJoin(F.broadcast(C.next_id(posts)))  # one row


def tag_monthly(spark, d):
    return Index(spark, d).months


def total_monthly(spark, d):
    return Index(spark, d).totals


def category_monthly(spark, d):
    x = Index(spark, d).kept()
    return rounded(S.category_monthly(x.months, x.dim), "n_eff")


def share(spark, d):
    x = Index(spark, d).kept()
    return rounded(S.share(x.months, x.totals, x.dim), "share")


def relative(spark, d):
    x = Index(spark, d).kept()
    return rounded(S.relative(x.months, x.dim), "relative", places=9)


def series_arrays(spark, d):
    x = Index(spark, d).kept()
    out = S.series_arrays(x.months, x.dim, x.axis, 2 * FLOOR)
    return out.withColumns({c: F.array_join(F.col(c).cast("array<string>"), ",") for c in ("months", "values")})


def _dense(x: Index) -> DataFrame:
    return S.dense_series(x.months.join(x.dim.select("tag_id", "name"), "tag_id"), x.axis, "name", "posts")


def dense_series(spark, d):
    return _dense(Index(spark, d).kept())


def full_axis_series(spark, d):
    x = Index(spark, d).kept()
    named = x.months.join(x.dim.where("category = 3").select("tag_id", "name"), "tag_id")
    return S.dense_series(named, x.axis, "name", "posts", full_axis=True)


def dense_categories(spark, d):
    x = Index(spark, d).kept()
    return rounded(S.dense_categories(S.category_monthly(x.months, x.dim), x.axis), "n_eff")


def complete_months(spark, d):
    return S.complete_months(Index(spark, d).axis)


def moving_average(spark, d):
    return rounded(S.moving_average(dense_series(spark, d), "name", "posts"), "smoothed")


def smooth_local_linear(spark, d):
    return rounded(S.smooth(dense_series(spark, d), "name", "posts", 12), "smoothed")


def smoothed_peak(spark, d):
    return rounded(S.peak(S.smooth(dense_series(spark, d), "name", "posts", 12)), "peak")


def value_at(spark, d):
    x = Index(spark, d).kept()
    return S.value_at(_dense(x), x.axis, "posts").select("name", "i", "posts")


def chart(spark, d):
    x = Index(spark, d).kept()
    return rounded(S.chart(x.months, x.dim, x.totals, ["part_4", "part_8", "part_22", "part_25", "part_33"], "posts", 3, 60), "smoothed", "value")


def relative_top_ten(spark, d):
    """The flagship: monthly relative index of the ten most-used tags."""
    x = Index(spark, d).kept()
    top = x.dim.orderBy(F.desc("post_count"), "name").limit(10).select("name")
    return rounded(S.relative(x.months, x.dim).join(F.broadcast(top), "name"), "relative", places=9)


def ingest_incremental(spark, d):
    """Posts written as a stream of files, ingested in slices, the last slice twice; equals daily_cells."""
    x = Index(spark, d)
    source, out, ckpt = (new_path(spark, n) for n in ("posts", "ingest", "ingest-checkpoint"))
    posts = x.view("posts")
    posts.repartition(4).write.parquet(source)
    stream = spark.readStream.schema(posts.schema).option("maxFilesPerTrigger", 2).parquet(source)
    for _ in range(2):
        I.ingest(stream, out, ckpt, {"floor": FLOOR, "deleted": False}, FIRST)
    return I.merged(spark, out, x.lookup)[0]


def clustered_read(spark, d):
    """Daily cells written clustered, one range of tags read back."""
    path = new_path(spark, "clustered")
    write_clustered(Index(spark, d).daily, path, ["tag_id", "day"])
    require_tables(spark, {path: schemas.DAILY})
    return spark.read.parquet(path).where("tag_id between 20 and 120")


def clustered_whole(spark, d):
    """Daily cells written clustered, all of them read back."""
    path = new_path(spark, "clustered")
    write_clustered(Index(spark, d).daily, path, ["tag_id", "day"])
    require_tables(spark, {path: schemas.DAILY})
    return spark.read.parquet(path)


def artifact_rows(spark, d):
    x = Index(spark, d)
    paths = {n: new_path(spark, n) for n in ("dim_tag", "fact_total_monthly")}
    write_clustered(x.dim, paths["dim_tag"], ["tag_id"])
    write_clustered(x.totals, paths["fact_total_monthly"], ["month"])
    return artifact_report(spark, paths).select("name", "rows", (F.col("bytes") > 0).alias("has_bytes"))


def event_share(spark, d):
    """Days and types of the event stream, with each type's share of its day."""
    events = spark.read.parquet(f"{d}/events.parquet").select(F.col("event_type").alias("name"), F.to_date("ts").alias("day"))
    cells = events.groupBy("name", "day").agg(F.count("*").alias("posts"))
    whole = cells.groupBy("day").agg(F.sum("posts").alias("all_posts"))
    return cells.join(whole, "day").select("name", "day", "posts", F.round(F.col("posts") * 10000 / F.col("all_posts"), 6).alias("share"))


QUERIES = {f.__name__: f for f in (
    tag_dim, alias_resolve, tag_lookup, daily_cells, daily_totals, all_posts_totals, every_post_totals, tag_monthly, total_monthly, category_monthly, share, relative, relative_top_ten, series_arrays, dense_series, full_axis_series,
    dense_categories, complete_months, moving_average, smooth_local_linear, smoothed_peak, value_at, chart, ingest_incremental, clustered_read, clustered_whole, artifact_rows, event_share,
)}

RELATIVE = "SELECT name, category, month, posts, round(s / (1 / n_eff - s * s), 9) AS relative FROM shares JOIN categories c USING (category, month) WHERE active_tags > 1"
ORACLE_SQL = {
    "tag_dim": sql("SELECT * FROM dim", DIM, views=("tags",)),
    "alias_resolve": sql("SELECT * FROM resolved", RESOLVED, views=("aliases",)),
    "tag_lookup": sql("SELECT * FROM lookup", DIM, RESOLVED, LOOKUP, views=("tags", "aliases")),
    "daily_cells": sql("SELECT * FROM daily", *CELLS),
    "ingest_incremental": sql("SELECT * FROM daily", *CELLS),
    "clustered_read": sql("SELECT * FROM daily WHERE tag_id BETWEEN 20 AND 120", *CELLS),
    "daily_totals": sql("SELECT * FROM total_daily", LIVE, TOTALS, views=("posts",)),
    "all_posts_totals": sql(
        "SELECT substr(created_at, 1, 10)::DATE AS day, count(*) AS posts, sum(coalesce(fav_count, 0))::BIGINT AS fav_sum, sum(score)::BIGINT AS score_sum, (SELECT max(id) + 1 FROM posts) AS max_id FROM posts WHERE tag_string IS NOT NULL GROUP BY 1",
        "x AS (SELECT 1)", views=("posts",)),
    "tag_monthly": sql("SELECT * FROM months", *ALL),
    "total_monthly": sql("SELECT * FROM totals", LIVE, TOTALS, TOTAL_MONTHS, views=("posts",)),
    "category_monthly": sql("SELECT category, month, posts, round(n_eff, 6) AS n_eff, active_tags FROM categories", *ALL, CATEGORIES),
    "share": sql("SELECT name, month, m.posts, round(m.posts * 10000 / t.posts, 6) AS share FROM months m JOIN dim USING (tag_id) JOIN totals t USING (month)", *ALL),
    "relative": sql(RELATIVE.replace("posts,", "shares.posts,"), *ALL, CATEGORIES),
    "relative_top_ten": sql(f"SELECT * FROM ({RELATIVE.replace('posts,', 'shares.posts,')}) WHERE name IN (SELECT name FROM dim ORDER BY post_count DESC, name LIMIT 10)", *ALL, CATEGORIES),
    "series_arrays": sql(
        f"SELECT name, category, post_count, min(i) AS first_i, max(i) AS last_i, string_agg(i::VARCHAR, ',' ORDER BY i) AS months, string_agg(posts::VARCHAR, ',' ORDER BY i) AS values FROM points JOIN dim USING (name) WHERE post_count >= {2 * FLOOR} GROUP BY ALL",
        *ALL, AXIS),
    "dense_series": sql("SELECT * FROM dense", *ALL, AXIS, DENSE),
    "full_axis_series": sql("SELECT t.name, a.i, coalesce(p.posts, 0) AS posts FROM (SELECT DISTINCT name FROM points JOIN dim USING (name) WHERE category = 3) t CROSS JOIN axis a LEFT JOIN points p ON p.name = t.name AND p.i = a.i", *ALL, AXIS),
    "dense_categories": sql("SELECT t.category, a.i, coalesce(c.posts, 0) AS posts, round(coalesce(c.n_eff, 0), 6) AS n_eff FROM (SELECT DISTINCT category FROM categories) t CROSS JOIN axis a LEFT JOIN categories c ON c.category = t.category AND c.month = a.month", *ALL, CATEGORIES, AXIS),
    "complete_months": sql("SELECT * FROM whole", *ALL, AXIS, COMPLETE),
    "moving_average": sql("SELECT name, i, round(avg(posts) OVER (PARTITION BY name ORDER BY i ROWS BETWEEN 4 PRECEDING AND 4 FOLLOWING), 6) AS smoothed FROM dense", *ALL, AXIS, DENSE),
    "smooth_local_linear": sql("SELECT name, i, round(smoothed, 6) AS smoothed FROM smoothed", *ALL, AXIS, DENSE, SMOOTH.replace("{src}", "dense")),
    "smoothed_peak": sql("SELECT round(max(smoothed), 6) AS peak FROM smoothed", *ALL, AXIS, DENSE, SMOOTH.replace("{src}", "dense")),
    "value_at": sql('SELECT name, i, posts FROM dense WHERE i = (SELECT "last" FROM whole)', *ALL, AXIS, DENSE, COMPLETE),
    "chart": sql(
        """SELECT s.name, s.i, month, round(f.posts::DOUBLE, 6) AS value, round(smoothed, 6) AS smoothed FROM smoothed s JOIN fit f ON f.name = s.name AND f.i = s.i JOIN axis ON axis.i = s.i
           WHERE s.i >= (SELECT min(i) FROM fit g WHERE g.name = s.name AND posts > 0) AND s.i BETWEEN 3 AND 60""",
        *ALL, AXIS, DENSE, COMPLETE, "fit AS (SELECT dense.* FROM dense, whole WHERE i BETWEEN \"first\" AND \"last\" AND name IN ('part_4', 'part_8', 'part_22', 'part_25', 'part_33'))", SMOOTH.replace("{src}", "fit")),
    "artifact_rows": sql("SELECT 'dim_tag' AS name, count(*) AS rows, true AS has_bytes FROM dim UNION ALL SELECT 'fact_total_monthly', count(*), true FROM totals", *ALL),
    "event_share": "SELECT *, round(posts * 10000 / sum(posts) OVER (PARTITION BY day), 6) AS share FROM (SELECT event_type AS name, CAST(ts AS DATE) AS day, count(*) AS posts FROM events GROUP BY 1, 2)",
}
ORACLE_SQL["every_post_totals"] = ORACLE_SQL["all_posts_totals"]
ORACLE_SQL["clustered_whole"] = ORACLE_SQL["daily_cells"]
