"""Hard negatives, MinHash groups and centroid clusters against brute force; odd inputs of every kind."""

import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tagpulse.llm import clusters, minhash, negatives

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [f"{a}{b}{c}" for a in ("ka", "lo", "mi", "ru", "te") for b in ("no", "sa", "vi", "du") for c in ("n", "r", "st", "l")]
VECTORS = "vec_id long, embedding array<float>, label int"


def prose(seed, n):
    rng = random.Random(seed)
    return [rng.choice(WORDS) + str(rng.randrange(9)) for _ in range(n)]


def edited(words, seed, n):
    """``words`` with n of them replaced."""
    rng, out = random.Random(seed), list(words)
    for k in range(n):
        out[rng.randrange(len(out))] = f"new{seed}x{k}"
    return out


def shingles(text, n):
    words = (text or "").encode().translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))).split()
    return {b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def groups_by_hand(rows, n=3, percent=85):
    """{row number: smallest id} by comparing all pairs."""
    sets = [shingles(t, n) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: (len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)}


def found_groups(spark, rows):
    df = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOCS).repartition(5)
    got = minhash.near_groups(df, rule=minhash.Rule(3, 85)).collect()
    return {r.doc_id: (r.n_shingles, r.component_id) for r in got}


def test_minhash_pairs_at_the_edge(spark):
    """Texts of all sizes with edits that bring them just above and below the aim."""
    rows = []
    for k, size in enumerate((3, 4, 8, 12, 30, 60, 65, 90, 130, 140, 300, 900)):
        base = prose(k, size)
        rows.append((len(rows), " ".join(base)))
        for e in range(0, max(2, size // 12)):
            rows.append((len(rows), " ".join(edited(base, 1000 * k + e, e))))
    assert found_groups(spark, rows) == groups_by_hand(rows)


@pytest.mark.parametrize("hot", ["family", "star", "passage"])
def test_minhash_long_lists(spark, monkeypatch, hot):
    """With lists of over 6 members dealt in pieces, groups are those of all pairs: chains, stars without other links, shared passages."""
    monkeypatch.setattr(minhash, "LIMIT", 6)
    base, rows = prose(5, 150), []
    if hot == "family":
        rows = [(k, " ".join(edited(base, k, k % 5))) for k in range(60)]
    elif hot == "star":
        rows = [(k, " ".join(base[: 3 * (k % 6)] + [f"a{k}x{i}" for i in range(4)] + base[3 * (k % 6) + 4 :] if k else base)) for k in range(60)]
        rows += [(100 + k, " ".join(edited(base, 100 + k, 7))) for k in range(40)]
    else:
        rows = [(k, " ".join(prose(100 + k, 20 + k) + base + prose(200 + k % 20, 10))) for k in range(60)]
    rows += [(1000 + k, " ".join(prose(900 + k, 60))) for k in range(5)]
    want = groups_by_hand(rows)
    assert found_groups(spark, rows) == want
    if hot != "passage":
        assert max(Counter(c for _, c in want.values()).values()) > 30


def test_minhash_odd_inputs(spark):
    twice = " ".join(prose(1, 40))
    rows = [(1, ""), (2, None), (3, " \n\t"), (None, twice), (4, twice), (4, twice), (5, "one two"), (6, "One  TWO\n"), (7, "Straße ÄÖ é日本 " * 30), (8, " ".join(prose(3, 30_000))), (9, "one"), (None, "lonely words here only")]
    df = spark.createDataFrame([(d, t, None, None, None) for d, t in rows], DOCS).withColumns({c: F.lit(1) for c in ("n", "cls", "sketch", "v", "comp", "label", "component_id", "first", "text_hash", "kept", "piece")})
    got = minhash.near_groups(df, rule=minhash.Rule(3, 85)).collect()
    assert len(got) == len(rows)
    by = {(r.doc_id, r.n_shingles): r.component_id for r in got}
    assert [by[1, 0], by[2, 0], by[3, 0]] == [1, 2, 3]
    assert by[None, 38] == by[4, 38] == 4 and by[5, 1] == by[6, 1] == 5 and by[9, 1] == 9 and by[None, 2] is None
    assert minhash.near_groups(spark.createDataFrame([], DOCS)).count() == 0


def vectors(seed, n, centres=6, dims=64, spread=0.4):
    rng = np.random.default_rng(seed)
    mids = rng.normal(size=(centres, dims)) / 8
    return [(i, [float(x) for x in (mids[c] + rng.normal(size=dims) * spread / 8).astype(np.float32)], int(c)) for i, c in enumerate(rng.integers(0, centres, n))]


def test_loosening_holds_for_points_of_the_sphere():
    """No point of a sphere comes nearer to a moved centroid than allowed, and the allowance is below the drift."""
    rng, less = np.random.default_rng(3), 0
    for _ in range(60):
        k, dims = 4, int(rng.integers(1, 6))
        old = rng.integers(-500, 500, (k, dims))
        new = old + rng.integers(-80, 80, (k, dims))
        radii = rng.uniform(0, 300, k)
        allowed = clusters.loosening(old, new, radii)
        drift = np.linalg.norm((new - old).astype(float), axis=1)
        for i in range(k):
            away = rng.normal(size=(4000, dims))
            x = old[i] + away / np.linalg.norm(away, axis=1, keepdims=True) * radii[i] * rng.uniform(0, 1, (4000, 1)) ** 0.2
            real = max((np.linalg.norm(x - old[j], axis=1) - np.linalg.norm(x - new[j], axis=1)).max() for j in range(k) if j != i)
            assert real <= allowed[i]
            less += allowed[i] < 0.9 * max(drift[j] for j in range(k) if j != i)
    assert less > 60


def clusters_by_hand(x, start, rounds):
    c = start.copy()
    for n in range(rounds + 1):
        near = ((x[:, None] - c[None]) ** 2).sum(axis=2).argmin(axis=1)
        if n < rounds:
            c = np.array([[int(s) // int((near == i).sum()) for s in x[near == i].sum(axis=0)] if (near == i).any() else c[i] for i in range(len(c))])
    return near, c


@pytest.mark.parametrize("spread", [0.05, 0.4, 3.0])
def test_clusters_equal_plain_rounds(spark, spread):
    rows = vectors(7, 700, spread=spread)
    rows += [(1000 + i, rows[0][1], 0) for i in range(300)]  # a very common vector
    df = spark.createDataFrame(rows, VECTORS).repartition(6)
    kept = clusters.integer_vectors(df, dims=64).cache()
    x = {r.vec_id: r.v for r in kept.collect()}
    ids = sorted(x)
    start = clusters.starting_centroids(kept, 8, "3:")
    near, c = clusters_by_hand(np.array([x[i] for i in ids]), start, 10)
    assigned, centroids = clusters.cluster(kept)
    assert (centroids == c).all()
    assert {r.vec_id: r.cluster for r in assigned.collect()} == dict(zip(ids, near.tolist(), strict=True))


def test_clusters_leave_most_vectors_unscanned(spark, monkeypatch):
    """The bounds settle vectors: over all rounds fewer are compared with all centroids than there are vectors times rounds."""
    rng = np.random.default_rng(1)
    x = np.array([v for _, v, _ in vectors(2, 3000, centres=8, spread=0.3)]) * 1024 // 1
    x = x.astype(np.int64)
    new = x[rng.choice(len(x), 8, replace=False)]
    import pyarrow as pa

    asked, plain = [], clusters.scan
    monkeypatch.setattr(clusters, "scan", lambda rows, c: (asked.append(len(rows)), plain(rows, c))[1])
    values = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * 64, pa.int32()), pa.array(x.ravel()))
    zero = np.zeros(len(x))
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(len(x))), values, pa.array(np.full(len(x), -1), pa.int32()), pa.array(np.full(len(x), -1), pa.int32()), pa.array(zero), pa.array(zero)], names=["vec_id", "v", "was", "cluster", "upper", "lower"])
    old, radii = new, np.zeros(8)
    for _ in range(10):
        batch = next(clusters._assign(old, new, radii)(iter([batch])))
        near, upper = batch.column(3).to_numpy(), batch.column(4).to_numpy()
        radii = np.array([upper[near == i].max(initial=0) for i in range(8)])
        old, new = new, np.array([x[near == i].sum(axis=0) // max(1, (near == i).sum()) if (near == i).any() else new[i] for i in range(8)])
    assert sum(asked) < 6 * len(x)


def test_clusters_odd_inputs(spark):
    good = [float(i) / 7 for i in range(64)]
    rows = [(1, good, 1), (1, good, 1), (None, [0.5] * 64, None), (2, None, 1), (3, [1.0] * 63, 1), (4, [*good[:-1], None], 1), (5, [*good[:-1], float("nan")], 1), (6, [*good[:-1], float("inf")], 1), (7, [], 1)]
    df = spark.createDataFrame(rows, VECTORS).withColumns({c: F.lit(1) for c in ("v", "cluster", "was", "upper", "distance", "centroid")})
    got = clusters.clusters(clusters.integer_vectors(df, dims=64)).collect()
    assert sorted((r.vec_id or 0, r.distance, r.inertia) for r in got) == [(0, 0, 0), (1, 0, 0), (1, 0, 0)]
    none = spark.createDataFrame([], VECTORS)
    assert clusters.clusters(clusters.integer_vectors(none, dims=64)).count() == 0


def negatives_by_hand(spark, rows):
    con = duckdb.connect()
    embeddings = spark.createDataFrame(rows, VECTORS).toPandas()  # noqa: F841
    con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[], label INTEGER)")
    con.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", [list(r) for r in rows])
    return sorted(con.execute(negatives.OP11_SQL).fetchall())


def mined(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    spark.createDataFrame(rows, VECTORS).repartition(3).write.parquet(f"{path}/embeddings.parquet")
    got = negatives.op11_hard_negatives(spark, path).collect()
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in got)


@pytest.mark.parametrize("block", [4096, 40])
def test_negatives_equal_a_scan(spark, tmp_path, monkeypatch, block):
    """Over small blocks and few seeds too; with ties, a very common vector, and anchors of it."""
    for name in ("BLOCK", "SEED_ROWS", "CELL_ROWS"):
        monkeypatch.setattr(negatives, name, block)
    rows = vectors(11, 900, centres=10)
    rows = [(i, rows[5][1] if i % 3 == 0 else v, label) for i, v, label in rows] + [(-100, rows[7][1], 3)]
    got = mined(spark, tmp_path, rows)
    assert got == negatives_by_hand(spark, rows) and len(got) > 100


def test_negatives_odd_inputs(spark, tmp_path):
    a = [0.5] * 8
    rows = [(0, a, 1), (1, a, 1), (1, a, 1), (2, [0.3] * 8, 2), (3, [0.3] * 5, 2), (4, None, 2), (5, [*a[:-1], None], 2), (6, [*a[:-1], float("nan")], 2), (8, [0.2] * 8, None), (None, a, 1), (100, a, 4), (200, [], 1), (9, [0.0] * 8, 2)]
    got = mined(spark, tmp_path, rows)
    assert {r[0] for r in got} <= {0, 100, 200}
    assert [(r[1], r[2], r[3]) for r in got if r[0] == 100] == []  # no other row of label 4
    assert [(r[1], r[2], r[3]) for r in got if r[0] == 0 and r[1] == 1] == []  # label of id 0 becomes 2
    assert [(r[1], r[3]) for r in got if r[0] == 0 and r[1] == 2][:1] == [] or all(30 * r[4] <= 100 * r[5] <= 90 * r[4] for r in got)
    assert negatives.mine(spark.createDataFrame([], "id long, label long, v array<long>"), F.col("id") % 100 == 0).count() == 0


def test_cells_come_by_falling_bound():
    """The heap visits every cell that holds rows once, and each score of a cell lies within its bounds."""
    rng = np.random.default_rng(4)
    x = rng.integers(-300, 300, (500, 10)).astype(float)
    words = tuple(negatives._fit(x[:, a:b], 6) for a, b in ((0, 5), (5, 10)))
    near = [negatives._nearest(x[:, 5 * s : 5 * s + 5], words[s]) for s in (0, 1)]
    radii = tuple(np.array([np.linalg.norm(x[near[s] == i, 5 * s : 5 * s + 5] - words[s][i], axis=1).max(initial=0) for i in range(6)]) for s in (0, 1))
    cell = near[0] * 6 + near[1]
    index = negatives.Index(words, radii, np.bincount(cell, minlength=36))
    for q in x[:20]:
        got = list(negatives.visit(index, q))
        assert sorted(c for c, *_ in got) == sorted(set(cell.tolist()))
        uppers = [u for _, u, _, _ in got]
        assert uppers == sorted(uppers, reverse=True)
        for c, upper, lower, _ in got:
            scores = x[cell == c] @ q
            assert lower <= scores.min() and scores.max() <= upper
