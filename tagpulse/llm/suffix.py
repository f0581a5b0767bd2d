"""Exact removal of long repeated byte strings by external induced sorting.

A byte goes if a ``length``-byte string that covers it also starts anywhere else in the corpus (UTF-8 bytes,
matches inside one document included, never across documents, judged on the input).

Sorting every suffix of a corpus is not needed to know that. As in induced sorting, a sample of places is picked by the
text alone, only what lies around equal samples is sorted, and each suffix is put in order by the one behind it:

1. Sample. Every string of ``length`` bytes is anchored at its ``gram``-byte substring of least hash (a minimizer),
   a choice that depends on the string alone, so equal strings are anchored alike. The strings with one anchor
   occurrence start at consecutive bytes and form a block.
2. Names. Blocks are named by hash and counted. A block that occurs twice is repeated whole; an anchor of one
   block only repeats nothing. Copies of any number meet as counts, combined before the shuffle.
3. Induction. What is left, different blocks around equal anchors, is dealt to shards by anchor. A shard lays its
   blocks out on disk by column, aligned at the anchor. The order of the suffixes that start in a column follows from
   the order of those one column to the right: (byte, rank behind it) enters a priority queue together with the
   common-prefix value, and leaves it in order. So the order is carried from the blocks' ends, where all suffixes are
   empty, through the anchors to the blocks' first bytes. A string is repeated when a neighbour in the order shares
   ``length`` bytes with it. The queue keeps a file for each byte value beyond its memory limit; a task holds about 10
   bytes for each block of up to 2 * length - gram bytes, so a shard may be far larger than memory.
   Groups around one anchor that are too large for a task are split before (``split_groups``).

Defined cases: null text is empty; texts shorter than ``length`` keep all; repeated rows are copies of each other
and lose all their strings; null ids are kept; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterable, Iterator
from functools import reduce
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_key, discard, materialize, table

LENGTH, GRAM = 400, 128
GROUP_LIMIT = 1000  # different blocks around one anchor that one task sorts; larger groups are split first
ROWS = 8192  # blocks that are laid out on disk at once
SLAB = 1 << 19  # bytes hashed at once; longer texts go in overlapping slabs
BASE = 0x9E3779B97F4A7C15 | 1
ANCHORS = "row_key long, anchor long, block long, lo int, hi int, at int"


def _powers() -> tuple[np.ndarray, np.ndarray]:
    n = SLAB + LENGTH
    up = np.full(n, BASE, np.uint64)
    down = np.full(n, pow(BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def anchors(text: bytes, length: int, gram: int, powers: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[int, int, int, int, int]]:
    """(anchor hash, block hash, lo, hi, at): strings starting at lo..hi have their anchor at byte ``at``."""
    up, down = powers
    for base in range(0, max(0, len(text) - length + 1), SLAB):
        data = np.frombuffer(text, np.uint8, min(len(text) - base, SLAB + length - 1), base)
        n = len(data)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data + np.uint64(1)) * down[:n], out=sums[1:])
        hashes = (sums[gram:] - sums[:-gram]) * up[: n - gram + 1]
        hashes ^= hashes >> np.uint64(29)
        hashes *= np.uint64(0xBF58476D1CE4E5B9)
        hashes ^= hashes >> np.uint64(32)
        low = np.uint64((1 << 20) - 1)
        least = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64)
        width, span = length - gram + 1, 1
        while span * 2 <= width:
            least = np.minimum(least[:-span], least[span:])
            span *= 2
        if width > span:
            least = np.minimum(least[: span - width], least[width - span :])
        at = (least & low).astype(np.int64)
        lo = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        hi = np.r_[lo[1:], len(at)] - 1
        names = hashes[at[lo]].view(np.int64)
        for a, x, y, p in zip(names.tolist(), (lo + base).tolist(), (hi + base).tolist(), (at[lo] + base).tolist(), strict=True):
            h = xxhash.xxh3_64_intdigest(text[x : y + length], 5)
            yield a, h - (1 << 64) if h >> 63 else h, x, y, p


def row_key(id_col: str, text_col: str) -> Column:
    return F.xxhash64(id_col, text_col)


def find_anchors(docs: DataFrame, id_col: str, text_col: str, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = _powers()
        names = [c.split()[0] for c in ANCHORS.split(", ")]
        kinds = [pa.int64()] * 3 + [pa.int32()] * 3
        for b in batches:
            rows: list[tuple] = []
            for key, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                text = text.as_py() or b""
                if len(text) >= length:
                    rows += [(key, *x) for x in anchors(text, length, gram, powers)]
                if len(rows) > 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    picked = docs.select(row_key(id_col, text_col).alias("row_key"), F.col(text_col).cast("binary").alias("text"))
    return picked.mapInArrow(run, ANCHORS)


class ByteQueue:
    """Disk-backed priority queue on (preceding byte, rank of the suffix behind it).

    Suffixes enter in the order of their rank, so a bucket for each byte value is a queue in itself. An entry
    carries the common prefix with the entry before it in its bucket: one more than the least value passed since.
    Buckets over ``limit`` entries in all go to files of ``folder``.
    """

    def __init__(self, folder: str, limit: int):
        self.folder, self.limit, self.held = folder, limit, 0
        self.memory: dict[int, list[np.ndarray]] = {}
        self.files: dict[int, Path] = {}
        self.passed = np.zeros(256, np.int64)  # least common prefix since the bucket's last entry
        self.seen = np.zeros(256, bool)

    def push(self, byte: np.ndarray, suffix: np.ndarray, lcp: np.ndarray) -> None:
        """One chunk in rank order; lcp[i] is shared with the suffix before it. Suffixes of negative ``byte`` end here."""
        at = np.flatnonzero(byte >= 0)
        if not len(at):
            np.minimum(self.passed, lcp.min(), out=self.passed)
            return
        order = at[np.argsort(byte[at], kind="stable")]
        of = byte[order]
        shared = np.empty(len(order), np.int64)
        shared[1:] = np.minimum.reduceat(np.append(lcp, 1 << 40), order + 1)[:-1] if len(order) > 1 else 0
        first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]])
        # within a bucket the values from one entry to the next count; reduceat does not span a descent in ``order``
        so_far = np.minimum.accumulate(lcp)
        heads = of[first]
        shared[first] = np.where(self.seen[heads], np.minimum(self.passed[heads], so_far[order[first]]), -1)
        entries = np.stack([suffix[order], shared + 1], axis=1)
        after = np.minimum.accumulate(np.append(lcp, 1 << 40)[::-1])[::-1]  # least value from here on
        np.minimum(self.passed, so_far[-1], out=self.passed)
        ends = np.r_[first[1:], len(order)]
        self.passed[heads] = after[order[ends - 1] + 1]
        self.seen[heads] = True
        for c, a, b in zip(heads.tolist(), first.tolist(), ends.tolist(), strict=True):
            self.memory.setdefault(c, []).append(entries[a:b])
        self.held += len(order)
        if self.held > self.limit:
            self.spill()

    def spill(self) -> None:
        if not self.files:
            self.folder = tempfile.mkdtemp(dir=self.folder)
        for c, parts in self.memory.items():
            path = self.files.setdefault(c, Path(self.folder) / str(c))
            with path.open("ab") as out:
                np.concatenate(parts).tofile(out)
        self.memory, self.held = {}, 0

    def pop_all(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(suffix, common prefix) in order, in chunks of about the memory limit; the queue is empty afterwards."""
        held: list[np.ndarray] = []
        for part in self._parts():
            held.append(part)
            if sum(map(len, held)) >= self.limit:
                yield self._chunk(held)
                held = []
        if held:
            yield self._chunk(held)

    def _chunk(self, parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        entries = np.concatenate(parts)
        return entries[:, 0], entries[:, 1]

    def _parts(self) -> Iterator[np.ndarray]:
        for c in sorted({*self.memory, *self.files}):
            if c in self.files:
                path = self.files[c]
                for start in range(0, path.stat().st_size, 16 * self.limit):
                    yield np.fromfile(path, np.int64, 2 * self.limit, offset=start).reshape(-1, 2)
                path.unlink()
            if c in self.memory:
                yield np.concatenate(self.memory[c])


class Shard:
    """A shard's blocks on disk: their bytes by column, aligned at the anchor (column ``width``), and their names."""

    def __init__(self, folder: str, width: int, length: int):
        self.folder, self.width, self.columns, self.size = Path(folder), width, width + length, 0
        self.parts: list[int] = []  # rows of each part; its file is open only while a column of it is read
        self.data, self.names = np.zeros((ROWS, self.columns), np.int16), np.zeros((ROWS, 4), np.int64)
        self.held = 0

    def add(self, data: bytes, offset: int, name: tuple[int, int, int, int]) -> None:
        """A block whose anchor is at ``offset``; ``name`` is (anchor, block, copies, place of the anchor from the block's first string)."""
        first = self.width - offset
        self.data[self.held, first : first + len(data)] = np.frombuffer(data, np.uint8).astype(np.int16) + 1
        self.names[self.held] = name
        self.held += 1
        self.size += 1
        if self.held == ROWS:
            self.flush()

    def flush(self) -> None:
        if self.held:
            with (self.folder / "names").open("ab") as out:
                self.names[: self.held].tofile(out)
            np.ascontiguousarray(self.data[: self.held].T).tofile(self.folder / f"part{len(self.parts)}")
            self.parts.append(self.held)
            self.data[:] = 0
            self.held = 0

    def column(self, c: int) -> np.ndarray:
        """The blocks' bytes in a column; -1 where a block has none."""
        return np.concatenate([np.fromfile(self.folder / f"part{k}", np.int16, n, offset=2 * c * n) for k, n in enumerate(self.parts)]) - 1

    def name(self, blocks: np.ndarray) -> np.ndarray:
        return np.memmap(self.folder / "names", np.int64, "r", shape=(self.size, 4))[blocks]


def induce(shard: Shard, length: int, memory: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(blocks, least, greatest): the strings that start least..greatest bytes before these blocks' anchors are repeated.

    Suffixes are put in order column by column, from the last to the first; at most about ``memory`` are held at a time.
    """
    chunks: Iterable[tuple[np.ndarray, np.ndarray]] = ()
    behind = np.full(shard.size, -1, np.int16)
    began = np.full(shard.size, -1, np.int16)
    for c in range(shard.columns - 1, -2, -1):
        here = shard.column(c) if c >= 0 else np.full(shard.size, -1, np.int16)
        queue = ByteQueue(str(shard.folder), memory)
        ends = np.flatnonzero((here >= 0) & (behind < 0))  # with nothing behind them: before all others
        for at in range(0, len(ends), memory):
            some = ends[at : at + memory]
            queue.push(here[some], some, np.zeros(len(some), np.int64))
        repeated, last = np.zeros(shard.size, bool), -1
        for suffix, lcp in chunks:
            same = lcp >= length
            repeated[suffix[same]] = True
            repeated[np.r_[last, suffix[:-1]][same]] = True
            last = int(suffix[-1])
            queue.push(here[suffix], suffix, lcp)
        distance = shard.width - c - 1
        if distance >= 0:
            over = np.flatnonzero((began >= 0) & ~repeated)
            for d in np.unique(began[over]).tolist():
                yield over[began[over] == d], d, distance - 1
            began[over] = -1
            began[repeated & (began < 0)] = distance
        chunks, behind = queue.pop_all(), here
    over = np.flatnonzero(began >= 0)
    for d in np.unique(began[over]).tolist():
        yield over[began[over] == d], d, shard.width


def _shards(length: int, gram: int, memory: int):
    """Per shard: (anchor, block, first, last) runs of string starts, counted from the block's first, that are repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with tempfile.TemporaryDirectory() as folder:  # of this task alone
            shard = Shard(folder, length - gram, length)
            for b in batches:
                for anchor, block, copies, base, offset, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    shard.add(data, offset, (anchor, block, copies, base + offset))
            shard.flush()
            for blocks, least, greatest in induce(shard, length, memory) if shard.size else ():
                for at in range(0, len(blocks), memory):
                    names = shard.name(blocks[at : at + memory])
                    anchor, block, _, place = names[names[:, 2] == 1].T  # other blocks are known to be repeated whole
                    yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(block), pa.array((place - greatest).astype(np.int32)), pa.array((place - least).astype(np.int32))], names=["anchor", "block", "first", "last"])

    return run


def _cut_blocks(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text, need in zip(b.column(0), b.column(1), strict=True):
                data = text.as_py()
                for x in need.as_py():
                    rows.append((x["anchor"], x["block"], x["copies"], 0, x["at"] - x["lo"], data[x["lo"] : x["hi"] + length], x["hot"]))
            if rows:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[*PIECES, "hot"])

    return run


PIECES = ["anchor", "block", "copies", "base", "offset", "data"]


def _open_groups(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n): groups of several pieces one of which occurs once; nothing else is left to decide."""
    sized = pieces.groupBy(*keys).agg(F.count("*").alias("n"), F.min("copies").alias("least"))
    return by_key(sized.where("n > 1 and least = 1").select(*keys, "n"), *keys)


def split_groups(pieces: DataFrame, length: int, width: int, limit: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Splits groups of over ``limit`` pieces around one anchor until none is left.

    A piece's strings start up to ``width`` bytes before the anchor. This range of distances is halved, and each piece
    with it. Equal halves are counted: a half that occurs twice is repeated whole. Halves are grouped anew by the bytes
    that all strings of their range share, which grow longer, so a group either falls apart or its pieces become
    equal. Returns groups to sort, and repeated (anchor, block, first, last). After log2(width) rounds a piece is one
    string, and then there is nothing left to split.
    """
    to_sort, repeated = [], []
    n = F.length("data") - length + 1
    pieces = pieces.withColumn("near", F.lit(0)).withColumn("far", F.lit(width))
    while not pieces.isEmpty():
        parts = pieces.withColumn("mid", F.floor((F.col("near") + F.col("far")) / 2).cast("int")).withColumn("least", F.col("offset") - n + 1)
        ahead = F.col("offset") - F.greatest(F.col("mid"), F.col("least") - 1)
        skip = F.greatest(F.lit(0), F.col("offset") - F.col("mid"))
        left = F.struct("base", "offset", F.substring("data", F.lit(1), ahead - 1 + length).alias("data"), (F.col("mid") + 1).alias("near"), "far")
        right = F.struct((F.col("base") + skip).alias("base"), (F.col("offset") - skip).alias("offset"), F.substring("data", skip + 1, F.length("data")).alias("data"), "near", F.col("mid").alias("far"))
        both = F.array_compact(F.array(F.when((F.col("offset") > F.col("mid")), left), F.when(F.col("least") <= F.col("mid"), right)))
        halves = parts.where("near < far").select("anchor", "block", "copies", F.explode(both).alias("h")).select("anchor", "block", "copies", "h.*")
        named = materialize(halves.withColumn("name", F.xxhash64("data", "near")))
        counts = named.groupBy("anchor", "name").agg(F.sum("copies").alias("total"), F.min(F.struct("block", "base")).alias("one"))
        joined = named.join(by_key(counts, "anchor", "name"), ["anchor", "name"])
        repeated.append(materialize(joined.where("total > 1").select("anchor", "block", F.col("base").alias("first"), (F.col("base") + n - 1).alias("last"))))
        distinct = joined.where((F.col("block") == F.col("one.block")) & (F.col("base") == F.col("one.base"))).withColumn("copies", F.col("total"))
        core = F.xxhash64("anchor", "near", "far", F.substring("data", F.col("offset") - F.col("near") + 1, F.lit(length) - (F.col("far") - F.col("near"))))
        grouped = materialize(distinct.select(*PIECES, "near", "far", core.alias("core")))
        sized = materialize(grouped.join(_open_groups(grouped, ["core"]), "core"))
        to_sort.append(sized.where(F.col("n") <= limit).select(*PIECES, F.col("core").alias("deal")))
        discard(named, grouped)
        pieces = sized.where(F.col("n") > limit).select(*PIECES, "near", "far")
    return to_sort, repeated


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, memory: int = 200_000, limit: int = GROUP_LIMIT) -> DataFrame:
    """(row_key, spans): byte ranges [from, to) covered by repeated strings, unmerged; rows without any are absent."""
    found = materialize(find_anchors(docs, id_col, text_col, length, gram))
    blocks = materialize(found.groupBy("anchor", "block").agg(F.count("*").alias("copies"), F.min(F.struct("row_key", "lo", "hi", "at")).alias("one")))
    rest = blocks.join(_open_groups(blocks, ["anchor"]), "anchor").select("one.row_key", "n", F.struct("anchor", "block", "copies", "one.lo", "one.hi", "one.at", (F.col("n") > limit).alias("hot")).alias("x"))
    need = rest.groupBy("row_key").agg(F.collect_list("x").alias("need"))
    texts = docs.select(row_key(id_col, text_col).alias("row_key"), F.col(text_col).cast("binary").alias("text"))
    cut = texts.join(need, "row_key").select("text", "need").mapInArrow(_cut_blocks(length), "anchor long, block long, copies long, base int, offset int, data binary, hot boolean")
    whole = [blocks.where("copies > 1").select("anchor", "block", F.lit(0).alias("first"), F.lit(None).cast("int").alias("last"))]
    if rest.where(F.col("n") > limit).isEmpty():
        to_sort = [cut.select(*PIECES, F.col("anchor").alias("deal"))]
    else:
        cut = materialize(cut)
        more, split = split_groups(cut.where("hot").dropDuplicates(["anchor", "block"]).select(*PIECES), length, length - gram, limit)
        to_sort, whole = [cut.where("not hot").select(*PIECES, F.col("anchor").alias("deal")), *more], [*whole, *split]
    shards = reduce(DataFrame.unionByName, to_sort).repartition("deal").select(*PIECES)
    partial = shards.mapInArrow(_shards(length, gram, memory), "anchor long, block long, first int, last int")
    repeated = materialize(reduce(DataFrame.unionByName, [*whole, partial]))
    discard(blocks)
    last = F.coalesce(F.col("lo") + F.col("last"), F.col("hi"))
    spans = found.join(repeated, ["anchor", "block"]).select("row_key", F.struct((F.col("lo") + F.col("first")).alias("from"), (last + length).alias("to")).alias("span"))
    return spans.groupBy("row_key").agg(F.collect_list("span").alias("spans"))


def merge_spans(spans: list[dict]) -> list[tuple[int, int]]:
    """Maximal ranges."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["from"], s["to"]) for s in spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _apply(min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, gone, runs, digests, kept = [], [], [], [], []
            for text, spans in zip(b.column(b.num_columns - 2), b.column(b.num_columns - 1), strict=True):
                data = text.as_py() or b""
                cut = [(x, y) for x, y in merge_spans(spans.as_py() or []) if len(data[x:y].split()) >= min_words]
                ends = [0, *(y for _, y in cut)]
                rest = b"".join(data[a:z] for a, z in zip(ends, [*(x for x, _ in cut), len(data)], strict=True))
                sizes.append(len(data))
                gone.append(len(data) - len(rest))
                runs.append(len(cut))
                digests.append(hashlib.sha256(rest).hexdigest())
                kept.append(rest.decode("utf-8", "ignore"))
            head = [b.column(i) for i in range(b.num_columns - 2)]
            names = [b.schema.field(i).name for i in range(b.num_columns - 2)]
            yield pa.RecordBatch.from_arrays([*head, pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()), pa.array(digests, pa.string()), pa.array(kept, pa.string())], names=[*names, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM, memory: int = 200_000, limit: int = GROUP_LIMIT, min_words: int = 0, prefix: str = "") -> DataFrame:
    """The other columns of ``docs`` and, each with ``prefix`` before its name, n_bytes, n_removed, n_spans, kept_sha256, kept.

    kept is the text that stays; the digest is of its bytes, and of a character cut in two nothing stays in kept.
    With ``min_words``, maximal runs of repeated strings that hold fewer words stay.
    """
    spans = repeated_spans(docs, id_col, text_col, length, gram, memory, limit).withColumnRenamed("row_key", "_key")
    made = [prefix + c for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")]
    rest = [c for c in docs.columns if c != text_col and c not in made]  # a result takes the place of a column of its name
    keyed = docs.select(*[F.col(c).alias(f"c{k}") for k, c in enumerate(rest)], F.col(text_col).cast("binary").alias("_text"), row_key(id_col, text_col).alias("_key"))
    schema = "".join(f"c{k} {f.dataType.simpleString()}, " for k, f in enumerate(docs.select(*rest).schema))
    joined = keyed.join(spans, "_key", "left").drop("_key")
    return joined.mapInArrow(_apply(min_words), f"{schema}n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string").toDF(*rest, *made)


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns, and as ``text`` what stays of each document."""
    return cut_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).withColumnRenamed("kept", "text")
