"""Serving tables, name lists, search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.han import Converter
from ..schemas import LANGS
from ..sources.serving_store import read_by_key, read_by_prefix
from ..sources.shared import written
from .names import filled
from .series import complete_months, dense_categories, month_axis, series_arrays

#: Fixed value: the longest name, in bytes, that the bundle format took.
MAX_NAME_BYTES = 255


def fill_chinese(names: DataFrame, conv: Converter) -> DataFrame:
    """The missing Chinese script from the other; a rejected tag has neither and stays without."""
    hans, hant = F.col("zh_hans"), F.col("zh_hant")
    return names.withColumns(
        {"zh_hant": F.when(filled(hans) & ~filled(hant), conv.traditional(hans)).otherwise(hant), "zh_hans": F.when(filled(hant) & ~filled(hans), conv.simplify(hant)).otherwise(hans)}
    )


def names_list(dim: DataFrame, names: DataFrame, pool: DataFrame) -> DataFrame:
    """(tag, pos, lang, name): display names in slot order, then aliases equal to nothing before them, case aside.

    pool: (tag, names array). Aliases have a null lang and never become display names.
    """
    rows = dim.select(F.col("name").alias("tag")).join(names, "tag", "left").join(pool.select("tag", F.col("names").alias("aliases")), "tag", "left")
    shown = F.array(*[F.struct(F.lit(c).alias("lang"), F.col(c).alias("name")) for c in LANGS])
    aliases = F.transform(F.coalesce("aliases", F.array().cast("array<string>")), lambda a: F.struct(F.lit(None).cast("string").alias("lang"), a.alias("name")))
    every = rows.select("tag", F.posexplode(F.concat(shown, aliases)).alias("pos", "e")).select("tag", "pos", "e.lang", "e.name").where(F.col("tag").isNotNull() & filled(F.col("name")))
    # one name of one tag is the group, and the joins by tag above have dealt the rows already
    folded = every.withColumn("key", F.lower("name")).withColumn("first_pos", F.min("pos").over(Window.partitionBy("tag", "key")))
    kept = folded.where(F.col("lang").isNotNull() | ((F.col("pos") == F.col("first_pos")) & (F.col("key") != F.lower("tag"))))
    return kept.select("tag", "pos", "lang", "name")


def display(names: DataFrame, lang: str) -> DataFrame:
    """(tag, shown): the name in a language, else the slug."""
    return names.select("tag", F.when(filled(F.col(lang)), F.col(lang)).otherwise(F.col("tag")).alias("shown"))


def variants(name: Column, conv: Converter) -> Column:
    """Spellings by which a query in one script finds a name in another."""
    han = T.has_han(name) & ~T.has_kana(name)
    forms = F.array(F.when(T.has_katakana(name), T.to_hiragana(name)), F.when(han, conv.simplify(name)), F.when(han, conv.traditional(name)))
    return F.filter(forms, lambda v: v.isNotNull())


def search_rows(dim: DataFrame, listed: DataFrame, conv: Converter) -> DataFrame:
    """(tag, terms): the slug, then names and aliases with their variants; lower case, no repeats."""
    forms = F.concat(F.array("name"), variants(F.col("name"), conv))
    each = listed.select("tag", F.struct("pos", forms.alias("forms")).alias("s")).groupBy("tag").agg(F.array_sort(F.collect_list("s")).alias("n"))
    spelled = F.flatten("n.forms")
    joined = dim.select(F.col("name").alias("tag")).join(each, "tag", "left")
    terms = F.concat(F.array(F.lower("tag")), F.coalesce(F.transform(spelled, F.lower), F.array().cast("array<string>")))
    return joined.select("tag", F.filter(F.array_distinct(terms), lambda t: t != "").alias("terms"))


def current_only(rows: DataFrame, dim: DataFrame) -> DataFrame:
    """Search rows without those of deprecated tags."""
    return rows.join(dim.where("is_deprecated").select(F.col("name").alias("tag")), "tag", "left_anti")


def search(rows: DataFrame, query: str, limit: int = 20, hide_deprecated: DataFrame | None = None) -> DataFrame:
    """(tag, hit): tags with a term that contains the query, in tag order, with the first such term.

    ``hide_deprecated``: a dimension whose deprecated tags are not shown.
    """
    if hide_deprecated is not None:
        rows = current_only(rows, hide_deprecated)
    hits = F.filter("terms", lambda t: t.contains(query.lower()))
    return rows.select("tag", hits.alias("h")).where(F.size("h") > 0).select("tag", F.element_at("h", 1).alias("hit")).orderBy("tag").limit(limit)


def find(dim: DataFrame, name: str) -> DataFrame:
    return dim.where(F.col("name") == name)


def grams(text: Column, n: int = 3) -> Column:
    """Distinct n-grams of a text, or the text itself where it is shorter."""
    each = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(text) - n + 1)), lambda i: F.substring(text, i, F.lit(n)))
    return F.array_distinct(each)


def search_many(rows: DataFrame, queries: DataFrame, n: int = 3) -> DataFrame:
    """(query, tag): all tags each query finds. Equi-joins on character n-grams find candidates, contains() confirms.

    Each query is looked up by its rarest n-gram only. Queries shorter than n characters meet terms by all their
    substrings of that length. Empty queries find nothing.
    """
    asked = queries.select("query", F.lower("query").alias("q")).where("q <> ''").distinct()
    terms = written(rows.select("tag", F.explode("terms").alias("term")))  # read twice for each length
    sizes = [r[0] for r in asked.select(F.least(F.length("q"), F.lit(n))).distinct().collect()]  # n numbers at most
    out = asked.select("query", F.lit(None).cast("string").alias("tag")).limit(0)
    for size in sorted(sizes):
        some = asked.where(F.length("q") == size) if size < n else asked.where(F.length("q") >= n)
        keyed = written(some.select("query", "q", F.explode(grams(F.col("q"), size)).alias("gram")))
        every = terms.where(F.length("term") >= size).select("tag", "term", F.explode(grams(F.col("term"), size)).alias("gram"))
        by_gram = every.join(keyed.select("gram").distinct(), "gram", "left_semi")  # only what is asked for is counted and shuffled
        frequency = by_gram.groupBy("gram").agg(F.count("*").alias("f"))
        rarest = keyed.join(frequency, "gram", "left").groupBy("query", "q").agg(F.min_by("gram", F.struct(F.coalesce("f", F.lit(0)), "gram")).alias("gram"))
        found = by_gram.join(rarest, "gram").where(F.col("term").contains(F.col("q"))).select("query", "tag")
        out = out.unionByName(found)
    return out.distinct()


def postings(rows: DataFrame, n: int = 3) -> DataFrame:
    """(gram, tag, term): the n characters at every place of every term, fewer at its end, to be stored and searched many times.

    A shorter query is the beginning of such a gram, so grams of fewer characters need not be stored.
    """
    terms = rows.select("tag", F.explode("terms").alias("term"))
    every = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("term")), lambda i: F.substring(F.col("term"), i, F.lit(n))))
    return terms.where("term <> ''").select(F.explode(every).alias("gram"), "tag", "term")


def search_stored(queries: DataFrame, path: str, n: int = 3) -> DataFrame:
    """(query, tag): as search_many, over stored postings: a query reads the postings of its rarest gram and nothing else, a query of
    fewer than n characters those of the grams that begin with it.
    """
    spark = queries.sparkSession
    asked = written(queries.select("query", F.lower("query").alias("q")).where("q <> ''").distinct())
    own = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("q") - n + 1), lambda i: F.substring(F.col("q"), i, F.lit(n))))
    keyed = written(asked.where(F.length("q") >= n).select("query", "q", F.explode(own).alias("gram")))
    # a gram without postings comes first: such a query finds nothing
    frequency = read_by_key(spark, f"{path}/frequency", "gram", keyed)
    rarest = keyed.join(frequency, "gram", "left").groupBy("query", "q").agg(F.min_by("gram", F.struct(F.coalesce("f", F.lit(0)), "gram")).alias("gram"))
    rarest = written(rarest)
    found = read_by_key(spark, f"{path}/postings", "gram", rarest).join(rarest, "gram").select("query", "q", "tag", "term")
    short = asked.where(F.length("q") < n)
    for size in sorted(r[0] for r in short.select(F.length("q")).distinct().collect()):  # n - 1 numbers at most
        some = short.where(F.length("q") == size).withColumn("start", F.col("q"))
        begun = read_by_prefix(spark, f"{path}/postings", "gram", some.select("start"))
        found = found.unionByName(begun.withColumn("start", F.substring("gram", 1, size)).join(some, "start").select("query", "q", "tag", "term"))
    return found.where(F.col("term").contains(F.col("q"))).select("query", "tag").distinct()


def servable(dim: DataFrame, min_posts: int = 0, limit_bytes: bool = True) -> DataFrame:
    kept = dim.where(F.col("post_count") >= min_posts)
    return kept.where(F.octet_length("name") <= MAX_NAME_BYTES) if limit_bytes else kept


def serving_rows(dim: DataFrame, tag_months: DataFrame, totals: DataFrame, names: DataFrame, pool: DataFrame, conv: Converter, min_posts: int = 0, limit_bytes: bool = True) -> dict[str, DataFrame]:
    """The tables behind chart and search: totals, categories, tags with their runs, names, search rows.

    The names are written, as the search rows are made of them.
    """
    axis = month_axis(totals)
    kept = servable(dim, min_posts, limit_bytes)
    listed = written(names_list(kept, fill_chinese(names, conv), pool))
    return {"totals": axis, "tags": series_arrays(tag_months, kept, axis), "names": listed, "search": search_rows(kept, listed, conv)}


def serving_set(dim: DataFrame, tag_months: DataFrame, totals: DataFrame, categories: DataFrame, names: DataFrame, pool: DataFrame, conv: Converter, min_posts: int = 0, limit_bytes: bool = True) -> dict[str, DataFrame]:
    """The six tables that are published together: those of serving_rows, category series on the whole axis, and meta.

    meta is one row: epoch (first month), months, first_complete, last_complete (by index), categories, and serving_stats.
    All six are written: a range sort samples what it sorts, and so makes it twice. ``discard`` frees them when they are published.
    """
    made = serving_rows(dim, tag_months, totals, names, pool, conv, min_posts, limit_bytes)
    made |= {name: written(made[name]) for name in ("totals", "tags", "search")}
    axis = made["totals"]
    series = written(dense_categories(categories, axis))
    complete = complete_months(axis).select(F.col("first").alias("first_complete"), F.col("last").alias("last_complete"))
    kinds = series.agg(F.countDistinct("category").alias("categories"))
    meta = axis.agg(F.min("month").alias("epoch"), F.count("*").alias("months"))
    for one in (complete, kinds, serving_stats(servable(dim, min_posts, limit_bytes), names, pool)):  # one row each
        meta = meta.crossJoin(F.broadcast(one))
    return {**made, "categories": series, "meta": written(meta)}


def dense_category_table(categories: DataFrame, totals: DataFrame) -> DataFrame:
    return dense_categories(categories, month_axis(totals))


def serving_stats(dim: DataFrame, names: DataFrame, pool: DataFrame) -> DataFrame:
    """(tags, displayable, translated): all, with some name, with some name or alias."""
    rows = dim.select(F.col("name").alias("tag")).join(names, "tag", "left").join(pool.select("tag", F.size("names").alias("k")), "tag", "left")
    shown = T.any_of([filled(F.col(c)) for c in LANGS])
    one = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0))
    return rows.agg(F.count("*").alias("tags"), one(shown).alias("displayable"), one(shown | F.coalesce(F.col("k") > 0, F.lit(False))).alias("translated"))


def language_coverage(long_names: DataFrame) -> DataFrame:
    return long_names.where(filled(F.col("value"))).groupBy("lang").agg(F.count("*").alias("tags"))


def category_coverage(dim: DataFrame, names: DataFrame, lang: str = "zh_hans", often: int = 1000) -> DataFrame:
    """(category, tags, named_share, post_share, often_share): named tags, posts under them, and among much-used tags."""
    rows = dim.join(names.select(F.col("tag").alias("name"), filled(F.col(lang)).alias("named")), "name", "left").withColumn("named", F.coalesce("named", F.lit(False)))
    yes = F.col("named").cast("double")
    posts = F.sum(F.when(F.col("named"), F.col("post_count")).otherwise(0))
    return rows.groupBy("category").agg(
        F.count("*").alias("tags"), F.avg(yes).alias("named_share"), F.try_divide(posts, F.sum("post_count")).alias("post_share"), F.avg(F.when(F.col("post_count") >= often, yes)).alias("often_share")
    )
