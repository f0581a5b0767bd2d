"""SimHash near-duplicate detection by pigeonhole blocks.

Each text gets a 64-bit fingerprint. Distinct fingerprints are keyed by every choice of ``keep`` out of
``blocks`` bit blocks: two fingerprints that differ in at most blocks - keep bits share such a key, so
joining on the keys loses no link. A key that more than ``limit`` fingerprints share is split: the same holds for
the bits it leaves open, so its fingerprints are keyed anew by one of radius + 1 blocks of those bits as well, until no
group is larger. Candidates are verified by their Hamming distance, and linked groups are closed to connected components.

``similar_groups`` has no radius for its rule but a similarity of shingle sets. Its candidates come from wider apart than blocks can
reach: many keys of some bits each, drawn at random, so that a pair at the aim shares one of them with a probability of
``RECALL``; the Hamming distance sifts them, and those left are confirmed on their full sets.

Defined cases: a null or wordless text has fingerprint zero and links like any other; texts of fewer than
``shingle`` words hash as one sequence; repeated rows each keep their row; rows with a null id take part
and get the smallest non-null id of their component (null if there is none); extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, by_key, connected_components, discard, materialize, table
from .minhash import Rule, blocks, by_piece, confirmed, dealt, full_sets, lists, partners, shingle_set, together

SEED = 42


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash of the word shingles of a UTF-8 text, repeats counted."""
    words = (text or b"").translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(accumulate((len(w) + 1 for w in words)))
    starts = [0, *ends]
    digest = xxhash.xxh64_intdigest
    n = min(shingle, len(words))
    hashes = np.array([digest(joined[a : b - 1], SEED) for a, b in zip(starts, ends[n - 1 :], strict=False)], np.uint64)
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp): fp is the fingerprint's 64 bits as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column(2)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps)], names=["doc_id", "text_hash", "fp"])

    text = F.col(text_col)
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("text"))
    return picked.mapInArrow(run, "doc_id long, text_hash long, fp long")


def block_masks(blocks: int, keep: int) -> list[int]:
    """Bit masks of every choice of ``keep`` of ``blocks`` nearly equal blocks of 64 bits."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    each = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(each, keep)]


def _grow(fps: np.ndarray, radius: int) -> Iterator[tuple[int, int]]:
    """(member, root) within one key's fingerprints: breadth-first over what is not reached yet."""
    left = fps
    while len(left):
        root, queue, left = left[0], [left[0]], left[1:]
        while queue and len(left):
            near = np.bitwise_count(left ^ queue.pop()) <= radius
            if near.any():
                found = left[near]
                left = left[~near]
                queue.extend(found)
                for x in found:
                    yield int(x), int(root)


def _links(radius: int):
    """Per partition sorted by key: a spanning set of the links within each key, never all pairs."""

    def emit(fps: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
        cut = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        size = np.diff(np.r_[cut, len(keys)])
        two = cut[size == 2]
        x, y = fps[two], fps[two + 1]
        ok = np.bitwise_count(x ^ y) <= radius
        a, b = [x[ok].view(np.int64)], [y[ok].view(np.int64)]
        more = [p for at, n in zip(cut[size > 2], size[size > 2], strict=True) for p in _grow(fps[at : at + n], radius)]
        if more:
            pairs = np.array(more, np.uint64).view(np.int64)
            a.append(pairs[:, 0])
            b.append(pairs[:, 1])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = fps = None
        for batch in batches:
            k = batch.column(0).to_numpy(zero_copy_only=False)
            f = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            keys, fps = (k, f) if keys is None else (np.concatenate([keys, k]), np.concatenate([fps, f]))
            open_at = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0  # the last key may go on
            if open_at:
                yield emit(fps[:open_at], keys[:open_at])
                keys, fps = keys[open_at:], fps[open_at:]
        if keys is not None and len(keys):
            yield emit(fps, keys)

    return run


def signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def narrower(mask: int, parts: int) -> list[int]:
    """``mask`` with each of ``parts`` nearly equal blocks of its open bits."""
    bits = [b for b in range(64) if not mask >> b & 1]
    cuts = [len(bits) * i // parts for i in range(parts + 1)]
    return [mask | sum(1 << b for b in bits[x:y]) for x, y in zip(cuts, cuts[1:], strict=False)]


def near_links(distinct: DataFrame, radius: int = 3, blocks: int = 6, limit: int = 1024) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp) whose closure has every pair within ``radius``.

    Splitting ends: fingerprints that share all but n bits are 2 ** n at most.
    """
    spark = distinct.sparkSession
    masks = block_masks(blocks, blocks - radius)
    rows = distinct.select("fp", F.explode(F.array(*[F.lit(signed(m)).cast("long") for m in masks])).alias("mask"))
    links = None
    while True:
        keyed = rows.select("fp", "mask", F.xxhash64("mask", F.col("fp").bitwiseAND(F.col("mask"))).alias("k"))
        hot = materialize(keyed.groupBy("k").agg(F.count("*").alias("n")).where(F.col("n") > limit).select("k"))
        done = hot.isEmpty()
        small = keyed if done else keyed.join(hot, "k", "left_anti")
        found = small.select("k", "fp").repartition("k").sortWithinPartitions("k").mapInArrow(_links(radius), "a long, b long")
        links = found if links is None else links.unionByName(found)
        if done:
            return links.distinct()
        finer = [(m, n) for m in masks for n in narrower(m, radius + 1)]
        # a row for each of the finer masks, whose number does not depend on the data
        of = spark.createDataFrame([(signed(m), signed(n)) for m, n in finer], "mask long, finer long")
        rows = materialize(keyed.join(hot, "k", "left_semi").join(F.broadcast(of), "mask").select("fp", F.col("finer").alias("mask")).distinct())
        masks = sorted({n for _, n in finer})


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 3, blocks: int = 6) -> DataFrame:
    """(doc_id, text_hash, fp, label, component_id), one row per input row.

    label names the group (its smallest fingerprint), component_id is the group's smallest id.
    """
    fps = materialize(fingerprints(docs, id_col, text_col, shingle))
    distinct = materialize(fps.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    groups = connected_components(near_links(distinct, radius, blocks))
    named = distinct.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first_id", F.coalesce("component", "fp").alias("label"))
    smallest = by_key(named.groupBy("label").agg(F.min("first_id").alias("component_id")), "label")
    return fps.join(named.select("fp", "label").join(smallest, "label"), "fp").select("doc_id", "text_hash", "fp", "label", "component_id")


#: Of similar_groups: words a feature of the fingerprint, the share of bits in which a pair at the aim differs, the largest number of them
#: that is looked at, the part of such pairs that share a key, and members that are compared in one task.
FEATURE, DIFFERING, FAR, RECALL, GROUP = 2, 0.10, 14, 0.98, 256


def drawn_masks(count: int, seed: int = 1) -> list[int]:
    """Masks of as many random bits as tell ``count`` fingerprints apart, and as many masks as RECALL takes."""
    bits = int(min(48, max(12, np.ceil(np.log2(max(2, count))))))
    n = int(np.ceil(np.log(1 - RECALL) / np.log(1 - (1 - DIFFERING) ** bits)))
    rng = np.random.default_rng(seed)
    return [sum(1 << int(b) for b in rng.choice(64, bits, replace=False)) for _ in range(n)]


def _sets_and_fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(doc_id, text_hash, n, cls, fp): cls stands for the shingle set, n is its size; one row per input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [shingle_set(t.as_py(), shingle) for t in b.column(2)]
            cls = np.array([xxhash.xxh64_intdigest(x.tobytes(), len(x)) for x in sets], np.uint64).view(np.int64)
            fps = np.array([fingerprint(t.as_py(), FEATURE) for t in b.column(2)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([len(x) for x in sets], pa.int64()), pa.array(cls), pa.array(fps)], names=["doc_id", "text_hash", "n", "cls", "fp"])

    text = F.col(text_col)
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.cast("binary").alias("text"))
    return picked.mapInArrow(run, "doc_id long, text_hash long, n long, cls long, fp long")


def _near(rule: Rule):
    """(piece, cls, comp, n, side) of members whose fingerprint lies within FAR bits of another's of fitting size."""

    def close(piece: int, cls: np.ndarray, comp: np.ndarray, n: np.ndarray, side: np.ndarray, fps: list[np.ndarray]) -> list[pa.Array]:
        f, flagged = np.concatenate(fps), np.zeros(len(cls), bool)
        for i in np.flatnonzero(side & 1):
            others = partners(rule, i, comp, n, side)
            good = np.bitwise_count(f[others] ^ f[i]) <= FAR
            flagged[others[good]] = True
            flagged[i] |= good.any()
        return [pa.array(np.full(int(flagged.sum()), piece)), *[pa.array(x[flagged]) for x in (cls, comp, n, side)]]

    return by_piece(close, ["piece", "cls", "comp", "n", "side"])


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rule: Rule = Rule()) -> DataFrame:  # noqa: B008
    """(doc_id, text_hash, label, component_id): groups of texts linked by the rule, and of equal shingle sets; empty sets are one group.

    A key that over GROUP texts share is dealt in pieces, differently for each key. Then those of its texts that are outside its
    largest group meet all the others, block by block, so that every two texts that share a key are compared or in one group.
    """
    rows = materialize(_sets_and_fingerprints(docs, id_col, text_col, rule.shingle))
    first = F.min(F.struct("doc_id", "text_hash")).alias("first")
    classes = materialize(rows.groupBy("cls").agg(F.first("n").alias("n"), first, F.min("doc_id").alias("least"), F.first("fp").alias("fp")))
    masks = F.array(*[F.lit(signed(m)).cast("long") for m in drawn_masks(classes.count())])
    keyed = classes.where("n > 0").select("cls", F.explode(masks).alias("mask"), "fp")
    shared = materialize(lists(keyed.select("cls", F.xxhash64("mask", F.col("fp").bitwiseAND(F.col("mask"))).alias("v"))))
    part = F.pmod(F.xxhash64("cls", "v"), F.ceil(F.col("m") / GROUP).cast("int"))
    pieces = shared.select(F.when(F.col("m") <= GROUP, F.col("v")).otherwise(F.xxhash64("v", part)).alias("piece"), "cls", F.col("cls").alias("comp"), F.lit(3).alias("side"))

    def linked(pieces: DataFrame) -> DataFrame:
        members = classes.select("cls", "n", F.array("fp").alias("members"))
        near = materialize(dealt(pieces.join(members, "cls")).mapInArrow(_near(rule), "piece long, cls long, comp long, n long, side int"))
        wanted = classes.select("cls", "first").join(near.select("cls").distinct(), "cls", "left_semi")
        links = materialize(dealt(near.join(full_sets(docs, wanted, id_col, text_col, rule.shingle), "cls")).mapInArrow(confirmed(rule), "a long, b long"))
        discard(near)
        return links

    links = linked(pieces)
    groups = connected_components(links)
    long_ = shared.where(F.col("m") > GROUP)
    if not long_.isEmpty():
        comps = groups.select(F.col("node").alias("cls"), F.col("component").alias("comp"))
        open_ = together(long_).join(comps, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
        groups = connected_components(links.unionByName(linked(blocks(open_))))
    named = materialize(classes.select("cls", "least").join(groups.withColumnRenamed("node", "cls"), "cls", "left").select("cls", "least", F.coalesce("component", "cls").alias("label")))
    smallest = by_key(named.groupBy("label").agg(F.min("least").alias("component_id")), "label")
    return rows.join(named.select("cls", "label").join(smallest, "label"), "cls").select("doc_id", "text_hash", "label", "component_id")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similar: Rule | None = None, **options) -> DataFrame:
    """The rows of ``docs`` with one document of each near-duplicate group: that of the smallest id.

    Groups are those of near_groups, or of similar_groups by the rule ``similar``. Where several texts of a group bear its
    smallest id, the one of the smallest hash stays; exact repeats of the row go.
    """
    found = similar_groups(docs, id_col, text_col, similar) if similar else near_groups(docs, id_col, text_col, **options)
    groups = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    keep = groups.groupBy("label").agg(F.min(F.struct("doc_id", "text_hash")).alias("k")).select("label", "k.*")
    keep = keep.select(F.col("label").alias("_label"), F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    same = docs[id_col].cast("long").eqNullSafe(keep["_id"]) & (F.xxhash64(docs[text_col]) == keep["_hash"])
    return docs.join(keep, same).dropDuplicates(["_label"]).select(*[docs[c] for c in docs.columns])


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
