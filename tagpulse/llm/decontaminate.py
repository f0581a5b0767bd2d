"""Benchmark decontamination by SimHash of item-sized windows, on DataFrame functions only.

Candidates come from an exact join on word shingles: a sweep over the positions of a document that share a shingle
with a benchmark item gives, for every start, the exact weighted similarity of the document's window of the item's
size and the item: sum of the lesser counts over sum of the greater. The order of the shared shingles does not
matter. The best window that reaches the threshold gets a SimHash of its shingles, which is compared with the item's
by radius + 1 blocks of the 64 bits: within ``radius`` bits two fingerprints agree on a block. The blocks are keyed
by item, so they filter the candidates and find none. Where the best window is beyond the radius, every other
start that reaches the threshold is tried.

Defined cases: letter case and white space do not count; null texts, and documents or items of fewer than
``shingle`` words, match nothing; windows end with the document; repeated rows of a document or an item count
once each; rows with a null id take part; an empty table on either side gives no row; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialize, table

SHINGLE, THRESHOLD, RADIUS = 5, 0.8, 19
#: Most benchmark shingles that are broadcast to the scan; above, the join shuffles both sides. A row is four numbers, 32 bytes
#: and about as many of overhead, so 64 MB at most.
BROADCAST_ROWS = 1_000_000


def word_array(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def shingles(words: Column, first: Column, last: Column, shingle: int) -> Column:
    """Hashes of the shingles that start at words first..last (0-based); empty if there are none."""
    each = F.transform(F.sequence(first, F.greatest(first, last)), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(shingle)]))
    return F.when(last >= first, each).otherwise(F.array().cast("array<bigint>"))


def simhash(hashes: str) -> Column:
    """64-bit SimHash of an array column of hashes, repeats counted."""
    return F.expr(
        f"aggregate(sequence(0, 63), 0L, (fp, b) -> fp | shiftleft(cast(2 * aggregate({hashes}, 0, (n, h) -> n + cast(shiftright(h, b) & 1 as int)) > size({hashes}) as bigint), b))"
    )


def blocks_of(fp: str, radius: int) -> Column:
    """Array of (block number, its bits): radius + 1 blocks that cover the 64 bits."""
    n = radius + 1
    edges = [64 * i // n for i in range(n + 1)]
    return F.array(*[F.struct(F.lit(i).alias("no"), F.expr(f"shiftrightunsigned({fp}, {a}) & {(1 << (b - a)) - 1}L").alias("bits")) for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))])


def sweep(hits: DataFrame, threshold: float) -> DataFrame:
    """(row_key, item, size, start, end, total, both): runs of window starts, start..end - 1, that share ``both`` shingles with the item and reach ``threshold``.

    ``hits`` has (row_key, total, item, size, h, m, pos): a document of ``total`` shingles has h, which the item has
    m times, at pos. A window holds pos as one of its first m occurrences of h if it begins after the m-th
    occurrence before pos and at most size - 1 before pos, so sums over the ends of these intervals give the exact
    common count at every start.
    """
    pair = ["row_key", "item", "size", "total"]
    dealt = hits.repartition("row_key", "item")  # one shuffle for all that follows
    each = dealt.groupBy(*pair, "h", "m").agg(F.sort_array(F.collect_set("pos")).alias("at"))
    # the whole document's common count bounds that of its windows
    most = F.sum(F.least(F.size("at").cast("long"), F.col("m"))).over(Window.partitionBy("row_key", "item"))
    each = each.withColumn("most", most).where(F.col("most") >= F.ceil(threshold * F.col("size") - 1e-9))
    spans = each.select(*pair, F.expr("explode(transform(at, (p, j) -> struct(greatest(0, p - size + 1, if(j >= m, at[cast(j - m as int)] + 1, 0)) as a, p + 1 as z)))").alias("s"))
    steps = spans.select(*pair, F.explode(F.array(F.struct(F.col("s.a").alias("start"), F.lit(1).alias("step")), F.struct(F.col("s.z").alias("start"), F.lit(-1).alias("step")))).alias("e")).select(*pair, "e.*")
    steps = steps.groupBy(*pair, "start").agg(F.sum("step").alias("step"))
    along = Window.partitionBy("row_key", "item").orderBy("start")
    runs = steps.select(*pair, "start", F.lead("start").over(along).alias("end"), F.sum("step").over(along).alias("both"))
    # the windows of a run are alike, but those that the document's end cuts get shorter: its last start is its best
    return runs.where((F.col("both") > 0) & (similarity(F.col("end") - 1) >= threshold))


def similarity(start: Column) -> Column:
    """Weighted similarity of the window at ``start``, of a run of sweep()."""
    window = F.least(F.col("size"), F.col("total") - start)
    return F.col("both") / (window + F.col("size") - F.col("both"))


def leaks(docs: DataFrame, benchmark: DataFrame, shingle: int = SHINGLE, threshold: float = THRESHOLD, radius: int = RADIUS) -> DataFrame:
    """(row_key, doc_id, item_id, start, distance, similarity): the best window of each document and item that leak.

    row_key is xxhash64(doc_id, text); start counts words from 0.
    """
    item_words = benchmark.select(F.col("item_id").cast("long").alias("item_id"), word_array(F.col("text")).alias("w")).where(F.size("w") >= shingle)
    items = materialize(item_words.select("item_id", shingles(F.col("w"), F.lit(0), F.size("w") - shingle, shingle).alias("hs")).distinct().withColumn("item", F.xxhash64("item_id", "hs")))
    parts = items.select("item", F.size("hs").alias("size"), F.explode("hs").alias("h")).groupBy("item", "size", "h").agg(F.count("*").alias("m"))
    if parts.count() <= BROADCAST_ROWS:
        parts = F.broadcast(parts)
    key = F.xxhash64("doc_id", "text").alias("row_key")
    words = docs.select(key, F.col("doc_id").cast("long").alias("doc_id"), word_array(F.col("text")).alias("w")).where(F.size("w") >= shingle)
    starts = words.select("row_key", (F.size("w") - shingle + 1).alias("total"), F.posexplode(shingles(F.col("w"), F.lit(0), F.size("w") - shingle, shingle)).alias("pos", "h"))
    runs = materialize(sweep(starts.join(parts, "h"), threshold))

    item_keys = items.withColumn("fp", simhash("hs")).select("item", F.col("fp").alias("item_fp"), F.explode(blocks_of("fp", radius)).alias("k")).select("item", "item_fp", "k.*")
    distance = F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp")))

    def near(windows: DataFrame) -> DataFrame:
        """The windows (row_key, item, size, start, similarity) within ``radius`` of their item, with doc_id and distance."""
        wanted = materialize(windows.groupBy("row_key").agg(F.collect_list(F.struct("item", "start", "size", "similarity")).alias("wanted")))
        again = words.join(wanted, "row_key").dropDuplicates(["row_key"]).select("row_key", "doc_id", "w", F.explode("wanted").alias("x"))
        last = F.least(F.col("x.start") + F.col("x.size") - 1, F.size("w") - shingle)
        cut = again.select("row_key", "doc_id", "x.item", "x.start", "x.similarity", shingles(F.col("w"), F.col("x.start"), last, shingle).alias("hs"))
        printed = materialize(cut.withColumn("fp", simhash("hs")).drop("hs"))
        keyed = printed.select("*", F.explode(blocks_of("fp", radius)).alias("k")).select(*printed.columns, "k.*")
        return keyed.join(item_keys, ["item", "no", "bits"]).select("row_key", "doc_id", "item", "start", distance.alias("distance"), "similarity").where(F.col("distance") <= radius).distinct()

    whole = F.col("end") - 1 + F.col("size") <= F.col("total")
    first = runs.withColumn("start", F.when(whole, F.col("start")).otherwise(F.col("end") - 1)).withColumn("similarity", similarity(F.col("start")))
    first = first.groupBy("row_key", "item", "size").agg(F.max(F.struct("similarity", -F.col("start"))).alias("b"))
    found = materialize(near(first.select("row_key", "item", "size", (-F.col("b.col2")).alias("start"), "b.similarity")))
    rest = runs.join(found, ["row_key", "item"], "left_anti")
    if not rest.isEmpty():  # best windows beyond the radius: all other starts that reach the threshold
        every = rest.withColumn("start", F.explode(F.sequence(F.col("start"), F.col("end") - 1))).withColumn("similarity", similarity(F.col("start")))
        more = near(every.where(F.col("similarity") >= threshold).select("row_key", "item", "size", "start", "similarity"))
        more = more.groupBy("row_key", "doc_id", "item").agg(F.max(F.struct("similarity", -F.col("start"), -F.col("distance"))).alias("b"))
        found = found.unionByName(more.select("row_key", "doc_id", "item", (-F.col("b.col2")).alias("start"), (-F.col("b.col3")).alias("distance"), "b.similarity"))
    return found.join(items.select("item", "item_id"), "item").select("row_key", "doc_id", "item_id", "start", "distance", "similarity")


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` in which no benchmark item leaks."""
    bad = leaks(docs, benchmark, **options).select(F.col("row_key").alias("_key")).distinct()
    return docs.join(bad, F.xxhash64(docs["doc_id"], docs["text"]) == bad["_key"], "left_anti")


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("row_key")
