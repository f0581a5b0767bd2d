"""MinHash near-duplicate detection by bottom-k sketches of one hash function.

A text's set is its distinct word shingles, as 64-bit XXH64 values; its sketch the smallest ``INDEXED`` of them (of a full set, the
smallest ``K``). Texts of equal sets are one class.

1. Inverted lists. Of each sketch the first values in a common order are listed, so that a linked pair shares a listed value: an
   order in which values of more than ``LIMIT`` sketches (passages that many texts share, large families of copies) come last, else
   by value. Values met once are dropped, and of lists with the same members one is kept.
2. Overlaps. The members of a list are compared in one task, a long list in pieces of about ``LIMIT``; the smallest values of
   both sketches together estimate the similarity. Members without a partner within ``SIGMAS`` deviations of the aim go no further.
3. The others come again with their full sets, made anew from the texts. Pairs that a finer estimate lets pass are confirmed on these,
   the most similar first; a pair already joined by links is not looked at. So a piece returns a spanning forest of its links, and
   no step emits all pairs of a group, nor is a partner capped.

Long lists with mostly the same members become one. They are dealt anew a few times, with the members of most links in every piece, until their components cease to
grow; at last the members outside a long list's largest component are compared with all of it, block by block.

What can be lost: a pair at the aim misses the lists with a probability of some 1e-9 at most (0.15 ** 16 without frequent
values; ``SIGMAS`` deviations with them; never for sets of at most INDEXED shingles), and the estimate at ``SIGMAS``
deviations. Classes are keyed by 64 bits of a hash of the whole set.

Defined cases: a null or wordless text has an empty set and links with nothing; texts of fewer than ``shingle`` words are one
shingle; repeated rows each keep their row; rows with a null id take part and get the smallest non-null id of their component
(null if there is none); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER, by_key, connected_components, discard, materialize, table

SEED = 42
#: Values of a full set's sketch; of the sketch that lists are made of; listed ones of a text with few frequent values.
K, INDEXED, NARROW = 128, 32, 16
SIGMAS = 6
LIMIT = 256
#: Members of most links that join each piece of a long list; rounds of dealing it anew; rows of the last comparison, against the
#: lists' own, that make further rounds needless.
HUBS, ROUNDS, CHEAP = 8, 4, 20


@dataclass(frozen=True)
class Rule:
    """Linked: 100 * intersection >= percent * union, of word shingles."""

    shingle: int = 5
    percent: int = 80

    def beyond(self, k: int) -> float:
        """So many of k sketch values at most does the other set of a linked pair lack."""
        t = self.percent / 100
        return k * (1 - t) + SIGMAS * (k * t * (1 - t)) ** 0.5

    @property
    def wide(self) -> int:
        return min(INDEXED, int(self.beyond(INDEXED)) + 1)

    def least(self, k: int) -> int:
        """Shared values of a pair's k smallest that make it a candidate."""
        return int(k - self.beyond(k))


def shingle_set(text: bytes | None, shingle: int) -> np.ndarray:
    """The distinct shingles' hashes, sorted."""
    words = (text or b"").translate(LOWER).split()
    if not words:
        return np.zeros(0, np.uint64)
    digest, n = xxhash.xxh64_intdigest, min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]).tolist()
    return np.array(sorted({digest(joined[a : b - 1], SEED) for a, b in zip([0, *ends], ends[n - 1 :], strict=False)}), np.uint64)


def _longs(values: list[np.ndarray]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, values)])
    flat = np.concatenate(values).view(np.int64) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))


def sketches(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(doc_id, text_hash, n, cls, sketch): one row per input row; the class is null for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, cls, low = [], [], []
            for t in b.column(2):
                s = shingle_set(t.as_py(), shingle)
                n.append(len(s))
                cls.append(xxhash.xxh64_intdigest(s.tobytes(), len(s)) if len(s) else None)
                low.append(s[:INDEXED])
            key = pa.array([None if c is None else c - (1 << 64) if c >> 63 else c for c in cls], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), key, _longs(low)], names=["doc_id", "text_hash", "n", "cls", "sketch"])

    text = F.col(text_col)
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("text"))
    return picked.mapInArrow(run, "doc_id long, text_hash long, n long, cls long, sketch array<long>")


def full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(cls, members) of the classes of ``wanted`` (cls, first: their first row's id and text hash)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), _longs([shingle_set(t.as_py(), shingle) for t in b.column(1)])], names=["cls", "members"])

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.xxhash64(text_col).alias("_hash"), F.col(text_col).cast("binary").alias("text"))
    of = wanted.select("cls", F.col("first.doc_id").alias("_w"), F.col("first.text_hash").alias("_wh"))
    found = rows.join(of, rows["_id"].eqNullSafe(of["_w"]) & (rows["_hash"] == of["_wh"])).select("cls", "text")
    return found.mapInArrow(run, "cls long, members array<long>").dropDuplicates(["cls"])


def listed(classes: DataFrame, rule: Rule) -> DataFrame:
    """(cls, v): the sketch values under which a class is listed, frequent ones only where the others do not suffice."""
    low = classes.select("cls", F.posexplode(F.slice("sketch", 1, INDEXED)).alias("rank", "v"))
    frequent = materialize(low.groupBy("v").agg(F.count("*").alias("m")).where(F.col("m") > LIMIT).select("v"))
    ranks = low.join(by_key(frequent, "v"), "v").groupBy("cls").agg(F.array_sort(F.collect_set("rank")).alias("late"))  # INDEXED at most
    late = F.coalesce("late", F.array().cast("array<int>"))
    every = F.sequence(F.lit(0), F.least(F.lit(INDEXED), F.col("n").cast("int")) - 1)
    order = F.concat(F.array_except(every, late), late)
    p = F.when(2 * F.size(late) > F.size(every), rule.wide).otherwise(NARROW)
    p = F.when(F.col("n") <= INDEXED, F.least(p, F.floor(F.col("n") * (100 - rule.percent) / 100).cast("int") + 1)).otherwise(p)
    chosen = classes.join(ranks, "cls", "left").select("cls", F.transform(F.slice(order, F.lit(1), p), lambda r: F.element_at("sketch", r + 1)).alias("vs"))
    return chosen.select("cls", F.explode("vs").alias("v"))


def lists(postings: DataFrame) -> DataFrame:
    """(v, m, cls): the inverted lists of (cls, v) with two members or more, one of those with the same members."""
    postings = materialize(postings)
    sums = postings.groupBy("v").agg(F.count("*").alias("m"), F.sum(F.xxhash64("cls").cast("decimal(38,0)")).alias("members")).where("m > 1")
    kept = sums.groupBy("m", "members").agg(F.min("v").alias("v")).select("v", "m")
    return postings.join(by_key(kept, "v"), "v").select("v", "m", "cls")


#: Long lists that share so much of the smaller one's members become one.
ALIKE = 0.7


def together(long_: DataFrame) -> DataFrame:
    """Long lists (v, m, cls) of which those with mostly the same members are made one, so that a pair is not met again in each."""
    own = materialize(long_.select("cls", "v", "m"))
    other = own.select("cls", F.col("v").alias("w"), F.col("m").alias("mw"))
    shared = own.join(other, "cls").where("v < w").groupBy("v", "w", "m", "mw").agg(F.count("*").alias("c"))  # a member has INDEXED lists at most
    alike = shared.where(F.col("c") >= ALIKE * F.least("m", "mw")).select(F.col("v").alias("a"), F.col("w").alias("b"))
    groups = connected_components(alike).select(F.col("node").alias("v"), F.col("component").alias("g"))
    whole = materialize(own.join(groups, "v", "left").select(F.coalesce("g", "v").alias("v"), "cls").distinct())
    return materialize(whole.join(by_key(whole.groupBy("v").agg(F.count("*").alias("m")), "v"), "v").select("v", "m", "cls"))


def _pieces(m: str) -> F.Column:
    return F.ceil(F.col(m) / LIMIT).cast("int")


TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def _overlaps(rule: Rule, i: int, others: np.ndarray, s: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(candidate, similarity) of row i against others, by sketches s (a row each) of sets of n members."""
    k = s.shape[1]
    mine = s[i, : min(k, n[i])]
    at = np.searchsorted(mine, s[others])
    hit = mine[np.minimum(at, len(mine) - 1)] == s[others]
    hit &= np.arange(k) < np.minimum(n[others], k)[:, None]
    both = hit.sum(axis=1)
    sure = (n[i] <= k) & (n[others] <= k)
    place = np.arange(1, k + 1) + at + 1 - np.cumsum(hit, axis=1)  # in both sketches together
    within = (hit & (place <= k)).sum(axis=1)
    union = n[i] + n[others] - both
    good = np.where(sure, 100 * both >= rule.percent * union, within >= rule.least(k))
    return good, np.where(sure, both / union, within / k)


def partners(rule: Rule, i: int, comp: np.ndarray, n: np.ndarray, side: np.ndarray) -> np.ndarray:
    """Rows of other components, of a size that allows a link, that row i is compared with; side: 1 is compared with 2, 3 with both."""
    near_size = (100 * n >= rule.percent * n[i]) & (100 * n[i] >= rule.percent * n)
    return np.flatnonzero(near_size & (comp != comp[i]) & (side & 2 > 0) & ((np.arange(len(comp)) > i) | (side & 1 == 0)))


def _sketch_matrix(lists_: list[np.ndarray], k: int) -> np.ndarray:
    s = np.full((len(lists_), k), TOP)
    for row, values in zip(s, lists_, strict=True):
        row[: min(k, len(values))] = values[:k]
    return s


def by_piece(close, names: list[str]):
    """A task over partitions sorted by piece; ``close`` turns (piece, cls, comp, n, side, sets) of one into columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done() -> pa.RecordBatch:
            t = pa.Table.from_batches(held)
            _, first = np.unique(np.stack([t.column("cls").to_numpy(), t.column("side").to_numpy() & 1]), axis=1, return_index=True)  # hubs can come twice
            t = t.take(pa.array(np.sort(first)))
            sets = [x.values.to_numpy().view(np.uint64) for c in t.column("members").chunks for x in c]
            numbers = [t.column(c).to_numpy() for c in ("cls", "comp", "n", "side")]
            return pa.RecordBatch.from_arrays(close(held[0].column(0)[0].as_py(), *numbers, sets), names=names)

        for batch in batches:
            keys = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)] if len(keys) else []
            for x, y in zip(cuts, cuts[1:], strict=False):
                if held and held[-1].column(0)[0].as_py() != keys[x]:
                    yield done()
                    held.clear()
                held.append(batch.slice(x, y - x))
        if held:
            yield done()

    return run


def _flags(rule: Rule):
    """(piece, cls, comp, n, side) of the members that have a candidate in another component."""

    def close(piece: int, cls: np.ndarray, comp: np.ndarray, n: np.ndarray, side: np.ndarray, sets: list[np.ndarray]) -> list[pa.Array]:
        s, flagged = _sketch_matrix(sets, INDEXED), np.zeros(len(cls), bool)
        for i in np.flatnonzero(side & 1):
            others = partners(rule, i, comp, n, side)
            if len(others):
                good, _ = _overlaps(rule, i, others, s, n)
                flagged[others[good]] = True
                flagged[i] |= good.any()
        return [pa.array(np.full(int(flagged.sum()), piece)), *[pa.array(x[flagged]) for x in (cls, comp, n, side)]]

    return by_piece(close, ["piece", "cls", "comp", "n", "side"])


def confirmed(rule: Rule):
    """(a, b): a spanning forest of the links between components, confirmed on full sets."""

    def close(piece: int, cls: np.ndarray, comp: np.ndarray, n: np.ndarray, side: np.ndarray, sets: list[np.ndarray]) -> list[pa.Array]:
        s, found = _sketch_matrix(sets, K), []
        for i in np.flatnonzero(side & 1):
            others = partners(rule, i, comp, n, side)
            if len(others):
                good, like = _overlaps(rule, i, others, s, n)
                found.extend(zip((-like[good]).tolist(), [int(i)] * int(good.sum()), others[good].tolist(), strict=True))
        root = {c: c for c in comp.tolist()}

        def find(c: int) -> int:
            while root[c] != c:
                root[c] = root[root[c]]
                c = root[c]
            return c

        out = []
        for _, i, j in sorted(found):
            x, y = find(int(comp[i])), find(int(comp[j]))
            if x == y:
                continue
            small, large = (i, j) if n[i] <= n[j] else (j, i)
            at = np.searchsorted(sets[large], sets[small])
            both = int((sets[large][np.minimum(at, n[large] - 1)] == sets[small]).sum())
            if 100 * both >= rule.percent * (n[i] + n[j] - both):
                root[x] = y
                out.append((int(cls[i]), int(cls[j])))
        return [pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)]

    return by_piece(close, ["a", "b"])


def dealt(rows: DataFrame) -> DataFrame:
    """Rows of pieces, each piece together in one partition."""
    return rows.select("piece", "cls", "comp", "n", "side", "members").repartition("piece").sortWithinPartitions("piece")


class Linker:
    """Links of the classes (cls, n, first, sketch), confirmed on full sets; grows round by round."""

    def __init__(self, docs: DataFrame, classes: DataFrame, rule: Rule, id_col: str, text_col: str):
        self.docs, self.classes, self.rule, self.cols = docs, classes, rule, (id_col, text_col)
        self.links: DataFrame | None = None
        self.comps: DataFrame | None = None
        self.sets: DataFrame | None = None

    def labelled(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with cls) with their component so far."""
        if self.comps is None:
            return rows.withColumn("comp", F.col("cls"))
        return rows.join(self.comps, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))

    def link(self, pieces: DataFrame, later: DataFrame | None = None) -> None:
        """Adds the links of ``pieces`` (piece, cls, comp, side). later: classes (cls) of the pieces still to come."""
        rows = pieces.join(self.classes.select("cls", "n", F.col("sketch").alias("members")), "cls")
        flagged = materialize(dealt(rows).mapInArrow(_flags(self.rule), "piece long, cls long, comp long, n long, side int"))
        if self.sets is None:
            each = flagged.select("cls")
            wanted = self.classes.select("cls", "first").join((each if later is None else each.unionByName(later)).distinct(), "cls", "left_semi")
            self.sets = materialize(full_sets(self.docs, wanted, *self.cols, self.rule.shingle))
        new = materialize(dealt(flagged.join(self.sets, "cls")).mapInArrow(confirmed(self.rule), "a long, b long"))
        discard(flagged)
        self.links = new if self.links is None else materialize(self.links.unionByName(new).distinct())
        groups = connected_components(self.links)
        self.comps = groups.select(F.col("node").alias("cls"), F.col("component").alias("comp"))

    def degrees(self) -> DataFrame:
        both = self.links.select(F.col("a").alias("cls")).union(self.links.select("b"))
        return both.groupBy("cls").agg(F.count("*").alias("degree"))


def linked_components(docs: DataFrame, classes: DataFrame, rule: Rule, id_col: str, text_col: str) -> DataFrame:
    """(cls, comp) of the classes that have a link."""
    all_lists = materialize(lists(listed(classes, rule)))
    short, long_ = all_lists.where(F.col("m") <= LIMIT), all_lists.where(F.col("m") > LIMIT)
    work = Linker(docs, classes, rule, id_col, text_col)
    pieces = work.labelled(short.select(F.col("v").alias("piece"), "cls")).withColumn("side", F.lit(3))
    if long_.isEmpty():
        work.link(pieces)
        return work.comps
    long_ = together(long_)
    # each round deals another one of a member's long lists; a member has as many as are listed at most
    own = materialize(long_.groupBy("cls").agg(F.array_sort(F.collect_set(F.struct("v", "m"))).alias("own")))
    before = None
    for n in range(ROUNDS):
        one = F.element_at("own", F.lit(n) % F.size("own") + 1)
        turn = own.select("cls", one["v"].alias("v"), one["m"].alias("m"))
        key = lambda k, n=n: F.xxhash64("v", k, F.lit(n))
        part = turn.select(key(F.pmod(F.xxhash64("cls", F.lit(n)), _pieces("m"))).alias("piece"), "cls")
        if n:
            best = Window.partitionBy("v").orderBy(F.desc("degree"), "cls")  # Spark cuts each task's rows to HUBS before the shuffle
            hubs = turn.join(work.degrees(), "cls").withColumn("r", F.row_number().over(best)).where(F.col("r") <= HUBS)
            spread = hubs.select("cls", "v", F.explode(F.sequence(F.lit(0), _pieces("m") - 1)).alias("k"))
            part = part.unionByName(spread.select(key(F.col("k")).alias("piece"), "cls"))
        part = work.labelled(part).withColumn("side", F.lit(3))
        work.link(part if n else pieces.unionByName(part), own.select("cls"))
        open_ = _open(work.labelled(long_)).agg(F.sum("outer").alias("outer"), F.sum("m").alias("m"), F.sum("block_rows").alias("block_rows")).first()  # one row
        if not open_.outer:
            return work.comps
        if open_.block_rows <= CHEAP * open_.m or before is not None and open_.outer > 0.9 * before:
            break
        before = open_.outer
    work.link(blocks(work.labelled(long_)))
    return work.comps


def _largest(rows: DataFrame) -> DataFrame:
    """(v, main, inside): the largest component of each list, and its members."""
    sizes = rows.groupBy("v", "comp").agg(F.count("*").alias("c"))
    return by_key(sizes.groupBy("v").agg(F.max_by("comp", F.struct("c", "comp")).alias("main"), F.max("c").alias("inside")), "v")


def _open(rows: DataFrame) -> DataFrame:
    """(v, m, outer, block_rows) of each long list: members outside its largest component, and the rows that blocks makes of it."""
    sizes = rows.groupBy("v", "m", "comp").agg(F.count("*").alias("c")).groupBy("v", "m").agg((F.col("m") - F.max("c")).alias("outer"))
    return sizes.withColumn("block_rows", F.col("outer") * _pieces("m") + F.col("m") * F.ceil(F.col("outer") / LIMIT))


def blocks(rows: DataFrame) -> DataFrame:
    """(piece, cls, comp, side): members outside a list's largest component (1) meet all its members (2), block by block."""
    each = rows.join(_largest(rows), "v").where("m > inside").withColumn("outer", F.ceil((F.col("m") - F.col("inside")) / LIMIT).cast("int"))
    i, j = F.pmod(F.xxhash64("cls", F.lit("i")), F.col("outer")), F.pmod(F.xxhash64("cls", F.lit("j")), _pieces("m"))
    left = each.where("comp <> main").select("v", "cls", "comp", i.alias("i"), F.explode(F.sequence(F.lit(0), _pieces("m") - 1)).alias("j"), F.lit(1).alias("side"))
    right = each.select("v", "cls", "comp", F.explode(F.sequence(F.lit(0), F.col("outer") - 1)).alias("i"), j.alias("j"), F.lit(2).alias("side"))
    return left.unionByName(right).select(F.xxhash64("v", "i", "j").alias("piece"), "cls", "comp", "side")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Rule = Rule()) -> DataFrame:  # noqa: B008
    """(doc_id, text_hash, n_shingles, label, component_id), one row per input row; label names the group, null for empty sets."""
    rows = materialize(sketches(docs, id_col, text_col, rule.shingle))
    first = F.min(F.struct("doc_id", "text_hash")).alias("first")
    classes = materialize(rows.where("cls IS NOT NULL").groupBy("cls").agg(F.first("n").alias("n"), first, F.min("doc_id").alias("least"), F.first("sketch").alias("sketch")))
    comps = linked_components(docs, classes, rule, id_col, text_col)
    named = materialize(classes.select("cls", "least").join(comps, "cls", "left").select("cls", "least", F.coalesce("comp", "cls").alias("label")))
    smallest = by_key(named.groupBy("label").agg(F.min("least").alias("component_id")), "label")
    full = rows.join(named.select("cls", "label").join(smallest, "label"), "cls").select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "label", "component_id")
    empty = rows.where("cls IS NULL").select("doc_id", "text_hash", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("label"), F.col("doc_id").alias("component_id"))
    return full.unionByName(empty)


def op12_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(table(spark, sf_dir, "documents"), rule=Rule(shingle=3, percent=85))
    return groups.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


OP12_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingles AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS s FROM words, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS t(i) WHERE len(w) > 0
), sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)
), edges AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT DISTINCT a AS node, a AS to_ FROM edges UNION SELECT r.node, e.b FROM reach r JOIN edges e ON e.a = r.to_),
least AS (SELECT node, min(to_) AS m FROM reach GROUP BY node)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id, d.doc_id = least(d.doc_id, coalesce(m, d.doc_id)) AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN least l ON l.node = d.doc_id
"""
