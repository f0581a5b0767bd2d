"""Hard-negative mining over an inverted multi-index.

Index: each half of the vector space has a codebook of its own, so two codewords make a cell. A codeword's radius is the largest
distance to it of any half-vector that it stands for. For a query q, q1.c1 + |q1| r1 + q2.c2 + |q2| r2 bounds the scores of a cell from
above, and the same with minus from below.

Search: a multi-sequence heap visits a query's cells by this upper bound: both codebooks are ranked by their half of it, and cells
leave a heap of pairs of ranks. A first visit takes cells of about ``SEED_ROWS`` rows; its n-th best score then certifies where
the second visit may stop, at the first cell whose bound is below it. A query has windows of scores, each with its own n-th
best; cells wholly above every window are passed over. Both visits are jobs: cells, cut into blocks of ``BLOCK`` rows, meet the queries
that visit them, in blocks too, and a block's scores are one exact product of integer matrices. Results equal a scan of all rows.

Before that, of rows of equal vector and label only the ``n`` of smallest id are indexed, since no others can be among a result's first
n, and anchors of equal vector and label are searched once, so a very common vector costs nothing.

The codebooks are fitted on a bounded sample (``SAMPLE`` rows of smallest hash); their size follows the number of rows, up to
``MOST_WORDS``, so what is sent to tasks is bounded by MOST_WORDS ** 2 cells. All rows are indexed.

Defined cases: rows with a null id, label or vector, or a null or non-finite component, take no part; exact repeats of a row
count once; an anchor's own id is no other row; shorter vectors are filled up with zeros; an empty table, or one without
anchors or positives, gives no rows; extra columns are ignored. Scores must fit in a long.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .clusters import integer_vectors
from .common import materialize, table

SAMPLE, MOST_WORDS, CELL_ROWS = 4096, 512, 1024
SEED_ROWS, BLOCK = 4096, 4096
#: Any score is above this.
NONE = -(1 << 63)


@dataclass(frozen=True)
class Index:
    """Codebooks, radii and rows by cell; bounded by the number of codewords."""

    words: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    rows: np.ndarray

    @property
    def half(self) -> int:
        return self.words[0].shape[1]

    def blocks(self) -> np.ndarray:
        return -(-self.rows // BLOCK)


def _first(rows: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The first n rows of each key; Spark cuts each task's rows to n a key before it shuffles them."""
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_r") <= n).drop("_r")


def _fit(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """k codewords of a bounded sample by Lloyd's rounds, from rows spread over it."""
    words = np.unique(x[np.linspace(0, len(x) - 1, k).astype(int)], axis=0)
    for _ in range(rounds):
        near = _nearest(x, words)
        n = np.bincount(near, minlength=len(words))
        sums = np.zeros_like(words)
        np.add.at(sums, near, x)
        words = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], words)
    return words


def _nearest(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    return ((words**2).sum(axis=1) - 2 * (x @ words.T)).argmin(axis=1)


def _dense(column: pa.Array, dims: int) -> np.ndarray:
    """Rows of ``dims`` longs."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def build(rows: DataFrame, dims: int) -> tuple[DataFrame, Index]:
    """((id, label, v, cell, block), index) of (id, label, v) with vectors of an even number of components."""
    count = rows.count()
    k = int(min(MOST_WORDS, max(2, np.ceil((count / CELL_ROWS) ** 0.5))))
    sample = np.array([r.v for r in rows.orderBy(F.xxhash64("id", "label", "v")).limit(SAMPLE).select("v").collect()], float)
    half = dims // 2
    words = (_fit(sample[:, :half], k), _fit(sample[:, half:], k))
    sizes = [len(w) for w in words]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _dense(b.column(2), dims).astype(float)
            parts = [(x[:, :half], words[0]), (x[:, half:], words[1])]
            near = [_nearest(p, w) for p, w in parts]
            far = [np.linalg.norm(p - w[n], axis=1) for (p, w), n in zip(parts, near, strict=True)]
            cell = near[0] * sizes[1] + near[1]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int32)), pa.array(far[0]), pa.array(far[1])], names=["id", "label", "v", "cell", "far1", "far2"])

    placed = materialize(rows.select("id", "label", "v").mapInArrow(assign, "id long, label long, v array<long>, cell int, far1 double, far2 double"))
    held = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("far1").alias("r1"), F.max("far2").alias("r2")).collect()  # MOST_WORDS ** 2 rows at most
    radii, at = (np.zeros(sizes[0]), np.zeros(sizes[1])), np.zeros(sizes, np.int64)
    for r in held:
        i, j = divmod(r.cell, sizes[1])
        at[i, j] = r.n
        radii[0][i], radii[1][j] = max(radii[0][i], r.r1), max(radii[1][j], r.r2)
    index = Index(words, radii, at.ravel())
    blocks = rows.sparkSession.createDataFrame([(r.cell, int(index.blocks()[r.cell])) for r in held], "cell int, blocks int")
    cut = placed.drop("far1", "far2").join(F.broadcast(blocks), "cell")  # a row a cell
    return cut.withColumn("block", F.pmod(F.xxhash64("id", "label"), F.col("blocks")).cast("int")).drop("blocks"), index


def visit(index: Index, q: np.ndarray) -> Iterator[tuple[int, float, float, float]]:
    """(cell, upper, lower, centre) of the cells that hold rows, by falling upper bound of the scores with q."""
    sides = []
    for x, words, radii in zip((q[: index.half], q[index.half :]), index.words, index.radii, strict=True):
        centre, slack = words @ x, radii * np.linalg.norm(x) * (1 + 1e-9) + 1e-6 * (1 + np.abs(words) @ np.abs(x))
        order = np.argsort(-(centre + slack), kind="stable")
        sides.append((order, (centre + slack)[order].tolist(), centre, slack))
    (o1, u1, c1, s1), (o2, u2, c2, s2) = sides
    heap, rows, width = [(-(u1[0] + u2[0]), 0, 0)], index.rows, len(o2)
    while heap:
        bound, i, j = heapq.heappop(heap)
        # each pair of ranks has one pair before it: (i, j - 1), or (i - 1, 0) in the first column
        if j + 1 < width:
            heapq.heappush(heap, (-(u1[i] + u2[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(o1):
            heapq.heappush(heap, (-(u1[i + 1] + u2[0]), i + 1, 0))
        a, b = int(o1[i]), int(o2[j])
        cell = a * width + b
        if rows[cell]:
            centre = float(c1[a] + c2[b])
            yield cell, -bound, centre - float(s1[a] + s2[b]), centre


def chosen(index: Index, q: np.ndarray, high: list[int], low: list[int], known: list[int | None] | None) -> Iterator[int]:
    """Cells of the first visit (known: None), or of the second, once the windows' n-th best scores are known.

    A window is a range of scores, low to high. The second visit stops when no window needs a score that a cell can have.
    """
    seeds, left, top = set(), SEED_ROWS, max(high)
    cells = visit(index, q)
    passed = []
    for cell, upper, lower, centre in cells:
        if left > 0 and lower <= top and upper >= min(low) and centre <= top:
            seeds.add(cell)
            left -= index.rows[cell]
        else:
            passed.append((cell, upper, lower))
        if known is None:
            if left <= 0:
                break
        elif left <= 0 and upper < min(max(l, s if s is not None else l) for l, s in zip(low, known, strict=True)):  # noqa: E741
            break
    if known is None:
        yield from seeds
        return
    for cell, upper, lower in passed:
        if any(upper >= max(l, s if s is not None else l) and lower <= h for h, l, s in zip(high, low, known, strict=True)):  # noqa: E741
            yield cell


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Integer products; by way of doubles where these hold every partial sum exactly."""
    if np.abs(q).max(initial=0).astype(float) * np.abs(x).max(initial=0).astype(float) * x.shape[1] < 2.0**53:
        return (q.astype(float) @ x.astype(float).T).astype(np.int64)
    return q @ x.T


def search(rows: DataFrame, index: Index, queries: DataFrame, dims: int, n: int, same: bool) -> DataFrame:
    """(qid, window, id, score): the first n rows of each window of (qid, label, v, high, low), arrays of bounds.

    same: of the query's own label, else of any other. Ties by smaller id.
    """
    count = queries.count()
    parts = max(1, -(-count // BLOCK))

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v, names = _dense(b.column(2), dims), b.schema.names
            highs, lows = b.column(3).to_pylist(), b.column(4).to_pylist()
            known = b.column(5).to_pylist() if "known" in names else [None] * len(v)
            at, cells = [], []
            for i in range(len(v)):
                for c in chosen(index, v[i].astype(float), highs[i], lows[i], known[i]):
                    at.append(i)
                    cells.append(c)
                if len(at) > 20_000:
                    yield spread(b, at, cells)
                    at, cells = [], []
            yield spread(b, at, cells)

    def spread(b: pa.RecordBatch, at: list[int], cells: list[int]) -> pa.RecordBatch:
        kept = b.take(pa.array(at, pa.int64())).columns[:5]
        return pa.RecordBatch.from_arrays([*kept, pa.array(cells, pa.int32())], names=["qid", "label", "v", "high", "low", "cell"])

    def score(asked: pa.Table, held: pa.Table) -> pa.Table:
        out: tuple[list, list, list, list] = ([], [], [], [])
        if asked.num_rows and held.num_rows:
            held = held.sort_by("id")
            flat = lambda t: np.concatenate([_dense(c, dims) for c in t.column("v").chunks])
            ids, labels, x = held.column("id").to_numpy(), held.column("label").to_numpy(), flat(held)
            s = exact_scores(flat(asked), x)
            mine = (asked.column("label").to_numpy()[:, None] == labels) == same
            qids = asked.column("qid").to_pylist()
            for i, (highs, lows) in enumerate(zip(asked.column("high").to_pylist(), asked.column("low").to_pylist(), strict=True)):
                for w, (h, l) in enumerate(zip(highs, lows, strict=True)):  # noqa: E741
                    fit = np.flatnonzero(mine[i] & (s[i] <= h) & (s[i] >= l))
                    if len(fit) > n:  # all that reach the n-th score, then ties by id
                        fit = fit[s[i, fit] >= -np.partition(-s[i, fit], n - 1)[n - 1]]
                    for j in fit[np.argsort(-s[i, fit], kind="stable")][:n]:
                        for column, value in zip(out, (qids[i], w, int(ids[j]), int(s[i, j])), strict=True):
                            column.append(value)
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.int64())], names=["qid", "window", "id", "score"])

    by_cell = queries.sparkSession.createDataFrame([(c, int(k)) for c, k in enumerate(index.blocks()) if k], "cell int, blocks int")

    def found(asked: DataFrame) -> DataFrame:
        requests = materialize(asked.mapInArrow(plan, "qid long, label long, v array<long>, high array<long>, low array<long>, cell int").withColumn("part", F.pmod(F.xxhash64("qid"), F.lit(parts)).cast("int")))
        left = requests.join(F.broadcast(by_cell), "cell").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).drop("blocks")  # a row a cell
        right = rows.join(materialize(requests.select("cell", "part").distinct()), "cell").select("cell", "part", "block", "id", "label", "v")
        keys = ["cell", "block", "part"]
        each = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(score, "qid long, window int, id long, score long")
        return materialize(_first(each, ["qid", "window"], [F.desc("score"), F.asc("id")], n))

    asked = queries.select("qid", "label", "v", "high", "low")
    seeds = found(asked)
    nth = seeds.groupBy("qid", "window").agg(F.count("*").alias("c"), F.min("score").alias("s")).where(F.col("c") == n)
    by_window = nth.groupBy("qid").agg(F.map_from_entries(F.collect_list(F.struct("window", "s"))).alias("s"))  # a row a window
    each = F.transform(F.sequence(F.lit(0), F.size("high") - 1), lambda w: F.try_element_at("s", w))
    known = asked.join(by_window, "qid", "left").select(*asked.columns, each.alias("known"))
    return _first(seeds.unionByName(found(known)), ["qid", "window"], [F.desc("score"), F.asc("id")], n)


def mine(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows of (id, label, v) where ``anchors`` holds.

    A negative's score lies between ``least`` and ``most`` hundredths of its positive's.
    """
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = materialize(rows.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), "v").where("id IS NOT NULL AND label IS NOT NULL").distinct())
    longest = rows.agg(F.max(F.size("v"))).first()[0]
    if longest is None:
        return rows.sparkSession.createDataFrame([], schema)
    dims = max(2, longest + longest % 2)
    filled = F.concat("v", F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("v")))
    rows = rows.withColumn("v", filled)
    chosen_rows = rows.where(anchors)
    n = max(negatives, positives + 1)
    held, index = build(materialize(_first(rows, ["label", "v"], [F.asc("id")], n)), dims)
    held = materialize(held)

    keyed = chosen_rows.withColumn("qid", F.xxhash64("label", "v"))
    query = materialize(keyed.select("qid", "label", "v").dropDuplicates(["qid"]))
    every = query.withColumns({"high": F.array(F.lit((1 << 63) - 1).cast("long")), "low": F.array(F.lit(NONE).cast("long"))})
    near = materialize(search(held, index, every, dims, positives + 1, same=True))

    pairs = keyed.select(F.col("id").alias("anchor_id"), "qid").join(near.select("qid", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "qid").where("anchor_id <> positive_id")
    pairs = materialize(_first(pairs, ["anchor_id", "qid"], [F.desc("positive_score"), F.asc("positive_id")], positives))
    asked = pairs.where("positive_score >= 0").groupBy("qid").agg(F.array_sort(F.collect_set("positive_score")).alias("scores"))  # positives + 1 at most
    # scores are not below zero here, so div rounds down
    high, low = F.expr(f"transform(scores, s -> ({most} * s) div 100)"), F.expr(f"transform(scores, s -> ({least} * s + 99) div 100)")
    windows = materialize(query.join(asked, "qid").select("qid", "label", "v", "scores", high.alias("high"), low.alias("low")))
    hard = search(held, index, windows, dims, negatives, same=False)
    scores = windows.select("qid", F.posexplode("scores").alias("window", "positive_score"))
    named = hard.join(scores, ["qid", "window"]).withColumn("rank", F.row_number().over(Window.partitionBy("qid", "window").orderBy(F.desc("score"), "id")).cast("int"))
    named = materialize(named)
    out = pairs.join(named.select("qid", "positive_score", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")), ["qid", "positive_score"])
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = integer_vectors(table(spark, sf_dir, "embeddings"), scale=256, keep=[label.alias("label")])
    return mine(rows.withColumnRenamed("vec_id", "id"), F.col("id") % 100 == 0)


OP11_SQL = """
WITH r AS MATERIALIZED (
  SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), s AS MATERIALIZED (
  SELECT a.id AS anchor, r.id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score FROM r a, r WHERE a.id % 100 = 0 AND a.id <> r.id
), p AS (SELECT anchor, id, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, id) <= 5)
SELECT p.anchor AS anchor_id, p.id AS positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
WINDOW w AS (PARTITION BY p.anchor, p.id ORDER BY s.score DESC, s.id) QUALIFY row_number() OVER w <= 10
"""
