"""Local image descriptors that find cropped or edited copies.

Corners are found at several scales, each is given an orientation by its patch's intensity centroid, and binary
tests along that orientation make a 128-bit descriptor. Descriptors meet in Hamming tables (joins on bit
chunks, distance checked), a few tables at a time. One such match makes two images a candidate, of which all descriptors are
then compared, block of classes by block, to which each query image goes once.
Matches of two images must agree on one similarity transform: they vote for scale, rotation and shift, and the best
bin's votes are the consensus.

The tables hold no images, so grey images are derived from ``embeddings``: a vector weighs fixed band-pass
patterns. Equal images are one class, so groups of any number of copies cost one search; every other image is searched
for itself. Near-equal images (cosine of their vectors) are found besides: signs of projections are cut into bands, each
band's bucket links its members to its smallest id, links are checked, and so is each member against the image of the group's
smallest id. All pairs inside a group are candidates without meeting in tables, where each would come once for each corner. On request
(``near``) such a group becomes one class. That is cheaper where near copies abound, but a copy of a member that is none of
the class's own image is then missed.

Defined cases: null, empty or non-finite vectors and vectors of zeros give no image and no class; images without corners
match nothing; rows with a null id stand in no class's name, but count in the class of a row with an id that equals them;
repeated rows are copies; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_key, connected_components, materialize, table

SIDE, BITS, RADIUS = 64, 128, 9
SCALES = (1.0, 0.75)
CHUNK, CHUNKS, MAX_DISTANCE = 18, 7, 24
BIN, MIN_VOTES = 6.0, 5
TABLES, BLOCK, FLUSH = 2, 2048, 50_000  # tables that are joined at a time; classes of a block; matches that vote at a time
BANDS, BAND_BITS, LINK, SAME = 16, 24, 0.95, 0.9  # cosines: of a link, and of a member and its class
_PATTERNS: dict[int, np.ndarray] = {}


def _blur(images: np.ndarray, times: int) -> np.ndarray:
    for _ in range(times):
        for axis in (-1, -2):
            images = (np.roll(images, 1, axis) + 2 * images + np.roll(images, -1, axis)) / 4
    return images


def render(vectors: np.ndarray) -> np.ndarray:
    """Grey images (n, SIDE, SIDE) in 0..1: fixed band-pass noise patterns weighted by the vectors' components."""
    dim = vectors.shape[1]
    if dim not in _PATTERNS:
        noise = np.random.default_rng(dim).standard_normal((dim, SIDE, SIDE)).astype(np.float32)
        band = _blur(noise, 3) - _blur(noise, 8)
        _PATTERNS[dim] = (band / band.std(axis=(1, 2), keepdims=True)).reshape(dim, -1)
    images = (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)) @ _PATTERNS[dim]
    return (1 / (1 + np.exp(-1.5 * images))).reshape(-1, SIDE, SIDE).astype(np.float32)


def edit(images: np.ndarray, kind: int, seed: int) -> np.ndarray:
    """An edited copy: 0 crops and darkens, 1 turns a quarter and raises contrast, 2 crops, blurs and adds noise."""
    if kind == 0:
        return images[:, 8:60, 6:58] * 0.7 + 0.05
    if kind == 1:
        return np.clip((np.rot90(images, axes=(1, 2)) - 0.5) * 1.3 + 0.5, 0, 1)
    noise = np.random.default_rng(seed).standard_normal(images.shape[1:]).astype(np.float32) * 0.02  # for each image the same, whatever stands beside it
    return _blur(images[:, 4:60, 4:60], 1) + noise[4:60, 4:60]


def _resize(images: np.ndarray, scale: float) -> np.ndarray:
    h, w = (int(round(s * scale)) for s in images.shape[1:])
    y, x = (np.minimum((np.arange(n) + 0.5) / scale - 0.5, s - 1.001).clip(0) for n, s in ((h, images.shape[1]), (w, images.shape[2])))
    y0, x0 = y.astype(int), x.astype(int)
    fy, fx = (y - y0)[:, None].astype(np.float32), (x - x0)[None, :].astype(np.float32)
    top = images[:, y0][:, :, x0] * (1 - fx) + images[:, y0][:, :, x0 + 1] * fx
    low = images[:, y0 + 1][:, :, x0] * (1 - fx) + images[:, y0 + 1][:, :, x0 + 1] * fx
    return top * (1 - fy) + low * fy


def _tests() -> np.ndarray:
    """Point pairs of the binary tests, inside the patch at any orientation."""
    points = np.random.default_rng(99).normal(0, RADIUS / 2.2, (BITS, 2, 2))
    norm = np.linalg.norm(points, axis=2, keepdims=True)
    return points * np.minimum(1, (RADIUS - 1) / np.maximum(norm, 1e-9))


def describe(images: np.ndarray) -> list[dict[str, np.ndarray]]:
    """For each image: x, y (in its own pixels), angle, scale and the two halves of the descriptors."""
    tests = _tests()
    dy, dx = np.mgrid[-RADIUS : RADIUS + 1, -RADIUS : RADIUS + 1]
    disc = np.flatnonzero((dy**2 + dx**2 <= RADIUS**2).ravel())
    oy, ox = dy.ravel()[disc], dx.ravel()[disc]
    found: list[list[np.ndarray]] = []
    for scale in SCALES:
        level = _blur(images if scale == 1.0 else _resize(images, scale), 1)
        gy, gx = np.gradient(level, axis=1), np.gradient(level, axis=2)
        xx, yy, xy = _blur(gx * gx, 2), _blur(gy * gy, 2), _blur(gx * gy, 2)
        response = xx * yy - xy * xy - 0.05 * (xx + yy) ** 2
        peak = response > 1e-9
        for sy in (-1, 0, 1):
            for sx in (-1, 0, 1):
                if sy or sx:
                    peak &= response >= np.roll(response, (sy, sx), (1, 2))
        edge = RADIUS + 1
        peak[:, :edge], peak[:, -edge:], peak[:, :, :edge], peak[:, :, -edge:] = False, False, False, False
        n, y, x = np.nonzero(peak)
        patch = level[n[:, None], y[:, None] + oy, x[:, None] + ox]
        angle = np.arctan2(patch @ oy.astype(np.float32), patch @ ox.astype(np.float32))
        c, s = np.cos(angle)[:, None], np.sin(angle)[:, None]
        value = []
        for k in (0, 1):
            px = np.rint(x[:, None] + tests[:, k, 0] * c - tests[:, k, 1] * s).astype(int)
            py = np.rint(y[:, None] + tests[:, k, 0] * s + tests[:, k, 1] * c).astype(int)
            value.append(level[n[:, None], py.clip(0, level.shape[1] - 1), px.clip(0, level.shape[2] - 1)])
        bits = np.packbits(value[0] < value[1], axis=1, bitorder="little").view(np.int64)
        found.append([n, (x + 0.5) / scale, (y + 0.5) / scale, angle, np.full(len(n), 1 / scale), bits[:, 0], bits[:, 1]])
    n, *rest = (np.concatenate(a) for a in zip(*found, strict=True))
    order = np.argsort(n, kind="stable")
    cut = np.searchsorted(n[order], np.arange(len(images) + 1))
    names = ("x", "y", "angle", "scale", "d0", "d1")
    return [{k: v[order[a:b]] for k, v in zip(names, rest, strict=True)} for a, b in zip(cut, cut[1:], strict=False)]


def _pack(x: np.ndarray, y: np.ndarray, angle: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Place, angle and scale of a corner in one long, since each row is dealt out once for each table."""
    turn = np.rint((angle % (2 * np.pi)) * 10_000).astype(np.int64)
    level = np.rint(np.log2(scale) * 2).astype(np.int64) + 64
    return np.rint(x * 16).astype(np.int64) << 44 | np.rint(y * 16).astype(np.int64) << 24 | turn << 8 | level


def _unpack(col: str) -> dict[str, Column]:
    cut = lambda shift, bits: F.expr(f"shiftrightunsigned({col}, {shift}) & {(1 << bits) - 1}L")
    return {"x": cut(44, 18) / 16, "y": cut(24, 20) / 16, "angle": cut(8, 16) / 10_000, "level": cut(0, 8) - 64}


def keypoints(classes: DataFrame, edited: bool) -> DataFrame:
    """(class_id, near_id, place, d0, d1), the last three lists with an entry for each corner of a class's image, or of its edited copy."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 48):
                ids, near, vectors = (batch.column(k).slice(at, 48).to_pylist() for k in (0, 1, 2))
                groups: dict[tuple[int, int], list[int]] = {}
                for k, v in enumerate(vectors):
                    groups.setdefault((len(v), ids[k] // 20 % 3 if edited else -1), []).append(k)
                for (_, kind), some in groups.items():
                    images = render(np.array([vectors[k] for k in some], np.float32))
                    out = describe(edit(images, kind, 1) if edited else images)
                    got = {c: np.concatenate([o[c] for o in out]) for c in ("x", "y", "angle", "scale", "d0", "d1")}
                    cuts = pa.array(np.r_[0, np.cumsum([len(o["x"]) for o in out])].astype(np.int32))
                    lists = [pa.ListArray.from_arrays(cuts, pa.array(v.astype(np.int64))) for v in (_pack(got["x"], got["y"], got["angle"], got["scale"]), got["d0"], got["d1"])]
                    names = [pa.array([x[k] for k in some], pa.int64()) for x in (ids, near)]
                    yield pa.RecordBatch.from_arrays([*names, *lists], names=["class_id", "near_id", "place", "d0", "d1"])

    near = "near_id" if "near_id" in classes.columns else F.lit(None).cast("long").alias("near_id")
    return classes.select("class_id", near, "embedding").mapInArrow(run, "class_id long, near_id long, place array<long>, d0 array<long>, d1 array<long>")


def each_corner(images: DataFrame) -> DataFrame:
    """A row for each corner of ``images``, which have lists of them."""
    return images.select("class_id", "near_id", F.explode(F.arrays_zip("place", "d0", "d1")).alias("c")).select("class_id", "near_id", "c.place", "c.d0", "c.d1")


def _chunks(d0: str, d1: str, tables: Sequence[int]) -> Column:
    """Keys of these of the CHUNKS Hamming tables: a table's run of CHUNK bits of the descriptor, with its number on top."""
    each = []
    for k in tables:
        a = k * CHUNK
        low = f"shiftrightunsigned({d0}, {a})" if a < 64 else f"shiftrightunsigned({d1}, {a - 64})"
        if a < 64 < a + CHUNK:
            low = f"({low} | shiftleft({d1}, {64 - a}))"
        each.append(F.expr(f"cast({low} & {(1 << CHUNK) - 1}L as int) | {k << CHUNK}"))
    return F.explode(F.array(*each))


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the rows that have an image."""
    number = F.transform("embedding", lambda v: v.cast("float"))
    fine = (F.size("embedding") > 0) & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < 1e30)) & F.exists("embedding", lambda v: v != 0)
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), number.alias("embedding")).where(fine)


def equal_classes(rows: DataFrame) -> DataFrame:
    """(class_id, embedding, n_rows, n_queries): distinct vectors, named by their smallest id."""
    queries = F.sum(F.coalesce(F.col("vec_id") % 20 == 0, F.lit(False)).cast("int"))
    return usable(rows).groupBy("embedding").agg(F.min("vec_id").alias("class_id"), F.count("*").alias("n_rows"), queries.alias("n_queries")).where("class_id is not null")


def band_keys(classes: DataFrame) -> DataFrame:
    """(class_id, key): for each band the signs of the vector's projections on fixed random directions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = 1 << np.arange(BAND_BITS, dtype=np.int64)
        for batch in batches:
            sizes = batch.column(1).value_lengths().to_numpy()
            for dim in np.unique(sizes).tolist():
                some = batch.filter(pa.array(sizes == dim))
                vectors = some.column(1).flatten().to_numpy().reshape(-1, dim)
                signs = vectors @ np.random.default_rng(dim).standard_normal((dim, BANDS * BAND_BITS)).astype(np.float32) > 0
                bands = signs.reshape(-1, BANDS, BAND_BITS) @ weights + (np.arange(BANDS) << BAND_BITS) + (dim << BAND_BITS + 8)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(some.column(0).to_numpy(), BANDS)), pa.array(bands.ravel())], names=["class_id", "key"])

    return classes.select("class_id", "embedding").mapInArrow(run, "class_id long, key long")


def cosine(a: str, b: str) -> Column:
    def dot(x: str, y: str) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q), F.lit(0.0), lambda n, v: n + v)

    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def near_equal(classes: DataFrame) -> DataFrame:
    """(class_id, near_id): classes of equal images that go into another's class."""
    keys = materialize(band_keys(classes))
    leaders = by_key(keys.groupBy("key").agg(F.min("class_id").alias("leader"), F.count("*").alias("n")).where("n > 1").drop("n"), "key")
    vectors = classes.select("class_id", F.col("embedding").alias("own"))

    def checked(pairs: DataFrame, other: str, least: float) -> DataFrame:
        theirs = vectors.select(F.col("class_id").alias(other), F.col("own").alias("other"))
        return pairs.join(vectors, "class_id").join(theirs, other).where(cosine("own", "other") >= least).select("class_id", other)

    links = checked(keys.join(leaders, "key").where("class_id <> leader").select("class_id", "leader").distinct(), "leader", LINK)
    groups = connected_components(links.select(F.col("class_id").alias("a"), F.col("leader").alias("b")))
    return checked(groups.where("node <> component").select(F.col("node").alias("class_id"), F.col("component").alias("near_id")), "near_id", SAME)


def image_classes(rows: DataFrame, near: bool = True) -> tuple[DataFrame, DataFrame]:
    """Classes (class_id, embedding, n_rows, n_queries), and the class of each vector (embedding, class_id)."""
    equal = materialize(equal_classes(rows))
    if not near:
        return equal, equal.select("embedding", "class_id")
    named = materialize(equal.join(near_equal(equal), "class_id", "left").select("embedding", F.coalesce("near_id", "class_id").alias("class_id"), "n_rows", "n_queries"))
    sums = named.groupBy("class_id").agg(F.sum("n_rows").alias("n_rows"), F.sum("n_queries").alias("n_queries"))
    return materialize(equal.select("class_id", "embedding").join(sums, "class_id")), named.select("embedding", "class_id")


def find_copies(rows: DataFrame, near: bool = True) -> DataFrame:
    """(query_class, class_id, n_rows, votes): classes of which the edited image of a query class is a copy.

    Query classes are those that hold a row whose id is divisible by 20; all classes are searched. ``near``: whether
    near-equal images are one class.
    """
    return search(image_classes(rows, near)[0])


def search(classes: DataFrame) -> DataFrame:
    groups = materialize(classes.join(near_equal(classes), "class_id", "left").select("class_id", "near_id", "embedding", "n_queries"), free=True)
    asked, stored = described(groups)
    met = [materialize(meet(asked, stored, range(k, min(k + TABLES, CHUNKS))), free=True) for k in range(0, CHUNKS, TABLES)]
    best = compare(reduce(DataFrame.union, met, inside(groups)), asked, stored)
    return best.join(classes.select("class_id", "n_rows"), "class_id").select(F.col("q_class_id").alias("query_class"), "class_id", "n_rows", "votes")


def described(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The query classes' edited images and all classes' images as lists of corners, see ``keypoints``."""
    stored = materialize(keypoints(classes, False))
    return materialize(keypoints(classes.where("n_queries > 0"), True)), stored


def _asked(corners: DataFrame) -> DataFrame:
    return corners.select(*[F.col(c).alias(f"q_{c}") for c in corners.columns])


def corners(classes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The corners of the query classes' edited images (columns q_...) and those of all classes."""
    asked, stored = described(classes)
    return _asked(each_corner(asked)), each_corner(stored)


def close() -> Column:
    """Whether an asked and a stored descriptor match."""
    return F.bit_count(F.col("q_d0").bitwiseXOR(F.col("d0"))) + F.bit_count(F.col("q_d1").bitwiseXOR(F.col("d1"))) <= MAX_DISTANCE


def _group(near_id: str, class_id: str) -> Column:
    return F.coalesce(near_id, class_id)


def inside(groups: DataFrame) -> DataFrame:
    """(q_class_id, class_id): each query class with all classes of its group of near-equal ones, itself too."""
    own = groups.select("class_id", "n_queries", _group("near_id", "class_id").alias("of"))
    return own.where("n_queries > 0").select(F.col("class_id").alias("q_class_id"), "of").join(own, "of").select("q_class_id", "class_id")


def meet(asked: DataFrame, stored: DataFrame, tables: Sequence[int]) -> DataFrame:
    """(q_class_id, class_id) of different groups with matching corners that share a key of one of these Hamming tables."""
    left = _asked(each_corner(asked)).select("q_class_id", "q_near_id", "q_d0", "q_d1", _chunks("q_d0", "q_d1", tables).alias("q_key"))
    right = each_corner(stored).select("class_id", "near_id", "d0", "d1", _chunks("d0", "d1", tables).alias("key"))
    apart = _group("q_near_id", "q_class_id") != _group("near_id", "class_id")
    return left.join(right, (F.col("q_key") == F.col("key")) & apart & close()).select("q_class_id", "class_id").distinct()


def most_votes(pair: np.ndarray, q_place: np.ndarray, place: np.ndarray, corner: np.ndarray, n: int) -> np.ndarray:
    """The most stored corners that vote for one similarity transform, for each of ``n`` pairs of images; as ``agree`` counts them.

    ``pair`` and ``corner`` number a match's pair and its stored corner within its image.
    """
    (qx, qy, qa, ql), (x, y, a, level) = ((p >> 44 & (1 << 18) - 1, p >> 24 & (1 << 20) - 1, p >> 8 & (1 << 16) - 1, p & 255) for p in (q_place, place))
    turn, octave, mid = qa / 10_000 - a / 10_000, ql - level, SIDE / 2
    ratio, x, y = 2.0 ** (octave / 2), x / 16, y / 16
    cx = qx / 16 + ratio * (np.cos(turn) * (mid - x) - np.sin(turn) * (mid - y))
    cy = qy / 16 + ratio * (np.sin(turn) * (mid - x) + np.cos(turn) * (mid - y))
    best = np.zeros(n, np.int64)
    for sa in (0.0, 0.5):
        for sx in (0.0, 0.5):
            for sy in (0.0, 0.5):
                key = pair * 16 + octave + 8
                for part, bits in ((np.floor(turn * (6 / np.pi) + sa) % 12, 4), (np.floor(cx / BIN + sx) + 128, 8), (np.floor(cy / BIN + sy) + 128, 8), (corner, 14)):
                    key = key << bits | part.astype(np.int64)
                bins, votes = np.unique(np.unique(key) >> 14, return_counts=True)
                np.maximum.at(best, bins >> 24, votes)
    return best


def compare(candidates: DataFrame, asked: DataFrame, stored: DataFrame) -> DataFrame:
    """(q_class_id, class_id, votes): the candidate image pairs of which enough matches, of all their corners, vote for one similarity transform.

    Classes are dealt in blocks. A query image goes once to each block that has a candidate for it, behind the block's
    classes, so that a task holds one block and reads queries one by one.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, {}
        for batch in batches:
            block, query, ids = (batch.column(k).to_pylist() for k in (0, 1, 2))
            place, d0, d1 = (batch.column(k).flatten().to_numpy() for k in (3, 4, 5))
            d0, d1 = d0.view(np.uint64), d1.view(np.uint64)  # of signed numbers, bits of the absolute value are counted
            cut = np.r_[0, np.cumsum(batch.column(3).value_lengths().to_numpy())]
            pairs: list[tuple[int, int]] = []
            found: list[tuple[np.ndarray, ...]] = []
            n = 0
            for k in range(batch.num_rows):
                if block[k] != at:
                    at, held = block[k], {}
                own = tuple(v[cut[k] : cut[k + 1]] for v in (place, d0, d1))
                if query[k] is None:
                    held[ids[k][0]] = tuple(v.copy() for v in own)
                    continue
                for first in range(0, len(ids[k]), 64):
                    some = ids[k][first : first + 64]
                    c_place, c0, c1 = (np.concatenate([held[c][v] for c in some]) for v in (0, 1, 2))
                    sizes = np.array([len(held[c][0]) for c in some])
                    of, corner = np.repeat(np.arange(len(some)), sizes), np.arange(len(c0)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                    i, j = np.nonzero(np.bitwise_count(own[1][:, None] ^ c0) + np.bitwise_count(own[2][:, None] ^ c1) <= MAX_DISTANCE)
                    enough = np.bincount(of[j], minlength=len(some)) >= MIN_VOTES
                    if enough.any():
                        i, j = i[enough[of[j]]], j[enough[of[j]]]
                        number = len(pairs) + np.cumsum(enough) - 1
                        found.append((number[of[j]], own[0][i], c_place[j], corner[j]))
                        pairs += [(query[k], c) for c, fine in zip(some, enough, strict=True) if fine]
                        n += len(i)
                if n >= FLUSH:
                    yield settled(pairs, found)
                    pairs, found, n = [], [], 0
            if pairs:
                yield settled(pairs, found)

    def settled(pairs: list[tuple[int, int]], found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        votes = most_votes(*(np.concatenate(c) for c in zip(*found, strict=True)), len(pairs))
        fine = votes >= MIN_VOTES
        ids = np.array(pairs, np.int64)[fine]
        return pa.RecordBatch.from_arrays([pa.array(ids[:, 0]), pa.array(ids[:, 1]), pa.array(votes[fine])], names=["q_class_id", "class_id", "votes"])

    blocks = max(int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-stored.count() // BLOCK))
    block = F.pmod(F.xxhash64("class_id"), F.lit(blocks)).alias("block")
    held = stored.select(block, F.lit(None).cast("long").alias("q_class_id"), F.array("class_id").alias("ids"), "place", "d0", "d1")
    # a class comes from several tables; a list has at most the classes of its block
    wanted = candidates.groupBy(block, "q_class_id").agg(F.collect_set("class_id").alias("ids"))
    queries = asked.select(F.col("class_id").alias("q_class_id"), "place", "d0", "d1")
    sought = wanted.join(queries, "q_class_id").select("block", "q_class_id", "ids", "place", "d0", "d1")
    rows = held.union(sought).repartition("block").sortWithinPartitions("block", F.col("q_class_id").asc_nulls_first())
    return rows.mapInArrow(run, "q_class_id long, class_id long, votes long")


def agree(met: DataFrame, classes: DataFrame) -> DataFrame:
    """The image pairs of which enough of the matches ``met`` vote for one similarity transform, for matches that come as rows."""
    # votes of two images are matches of theirs, so fewer matches than votes needed decide at once
    matched = met.groupBy("q_class_id", "class_id").agg(F.collect_set(F.struct("q_place", "place")).alias("m")).where(F.size("m") >= MIN_VOTES)
    pairs = matched.select("q_class_id", "class_id", F.explode("m").alias("p")).select("q_class_id", "class_id", "p.*")
    q, c = _unpack("q_place"), _unpack("place")
    turn = q["angle"] - c["angle"]
    octave = q["level"] - c["level"]
    ratio = F.pow(F.lit(2.0), octave / 2)
    mid = F.lit(SIDE / 2)
    cx = q["x"] + ratio * (F.cos(turn) * (mid - c["x"]) - F.sin(turn) * (mid - c["y"]))
    cy = q["y"] + ratio * (F.sin(turn) * (mid - c["x"]) + F.cos(turn) * (mid - c["y"]))
    vote = pairs.select("q_class_id", "class_id", "place", turn.alias("turn"), octave.alias("octave"), cx.alias("cx"), cy.alias("cy"))
    shifts = F.explode(F.array(*[F.struct(F.lit(a).alias("sa"), F.lit(b).alias("sx"), F.lit(c).alias("sy")) for a in (0.0, 0.5) for b in (0.0, 0.5) for c in (0.0, 0.5)]))
    binned = vote.withColumn("s", shifts).select(
        "q_class_id", "class_id", "place", "octave", "s",
        F.pmod(F.floor(F.col("turn") * (6 / np.pi) + F.col("s.sa")), F.lit(12)).alias("a"), F.floor(F.col("cx") / BIN + F.col("s.sx")).alias("bx"), F.floor(F.col("cy") / BIN + F.col("s.sy")).alias("by"),
    )
    votes = binned.groupBy("q_class_id", "class_id", "octave", "s", "a", "bx", "by").agg(F.count_distinct("place").alias("votes"))
    best = votes.groupBy("q_class_id", "class_id").agg(F.max("votes").cast("long").alias("votes")).where(F.col("votes") >= MIN_VOTES)
    return best.join(classes.select("class_id", "n_rows"), "class_id").select(F.col("q_class_id").alias("query_class"), "class_id", "n_rows", "votes")


def members(rows: DataFrame, of_vector: DataFrame) -> DataFrame:
    """(vec_id, class_id) of each row; class_id is null without an image."""
    key = F.xxhash64("embedding").alias("_hash")
    named = of_vector.select(key, F.col("embedding").alias("_embedding"), "class_id")
    own = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda v: v.cast("float")).alias("embedding"))
    same = (F.col("_key") == F.col("_hash")) & (F.col("embedding") == F.col("_embedding"))
    return own.withColumn("_key", F.xxhash64("embedding")).join(named, same, "left").select("vec_id", "class_id")


def op4_image_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Membership, a row (vec_id, class_id) for each row; then the found pairs of classes (query_class, class_id, n_rows, votes)."""
    rows = table(spark, sf_dir, "embeddings")
    classes, of_vector = image_classes(rows, near=False)  # different images lose no pair to the image of a class
    nothing = lambda kind, name: F.lit(None).cast(kind).alias(name)
    own = members(rows, of_vector).select("vec_id", "class_id", nothing("long", "query_class"), nothing("long", "n_rows"), nothing("long", "votes"))
    return own.unionByName(search(classes).withColumn("vec_id", F.lit(None).cast("long")))
