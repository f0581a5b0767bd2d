"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

Inputs are words and characters. Words are runs of ASCII letters, digits and other letters' bytes, of any length, case folded. Each word is its hashed word vector beside the mean of its hashed character
trigram vectors. A document is cut into overlapping windows that together cover every word; each window is read
in both directions, its states are pooled by attention and give a probability, and the document's score is that
of its most toxic window. Fitting follows suit: a toxic document teaches by its most toxic window, a clean one
by its most toxic window and a random one.

Defined cases: null and wordless texts are one empty window; texts shorter than a window are padded; texts of
any length are read whole; a null id is not held out; repeated rows each get a row; with no usable labels every
score is next to 0; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .quality import score_documents
from .sample import Adam, sigmoid, training_sample

WINDOW, STRIDE = 48, 36
EARLY, DROP = 3, 0.05  # random windows a document in the first third of the epochs; share of words left out in training
WORD_BUCKETS, CHAR_BUCKETS = 1 << 13, 1 << 12
WORD_DIM, CHAR_DIM, HIDDEN, ATTENTION = 12, 12, 12, 8
#: ASCII letters to lower case, other ASCII but digits to spaces; bytes of other letters stay.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(FOLD).split()


def init(seed: int) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    shapes = {
        "word": (WORD_BUCKETS, WORD_DIM), "char": (CHAR_BUCKETS, CHAR_DIM), "wx": (2, WORD_DIM + CHAR_DIM, 3 * HIDDEN), "b": (2, 1, 3 * HIDDEN),
        "u": (2, HIDDEN, 3 * HIDDEN), "wa": (2 * HIDDEN, ATTENTION), "va": (ATTENTION,), "out": (2 * HIDDEN,), "bias": (1,),
    }
    scale = {"b": 0, "bias": 0, "word": 0.02, "char": 0.02}  # small vectors: a word never seen in training says next to nothing
    return {k: (rng.standard_normal(s) * scale.get(k, 0.3)).astype(np.float32) for k, s in shapes.items()}


class Vocabulary:
    """Distinct words by number; number 0 pads. Keeps each word's hash buckets."""

    def __init__(self):
        self.index: dict[bytes, int] = {}
        self.word, self.grams, self.lens = [0], [], [0]

    def ids(self, found: list[bytes]) -> np.ndarray:
        index = self.index
        for w in set(found).difference(index):
            index[w] = len(self.word)
            marked = b"<" + w + b">"
            grams = [zlib.crc32(marked[i : i + 3]) % CHAR_BUCKETS for i in range(len(marked) - 2)]
            self.word.append(zlib.crc32(w) % WORD_BUCKETS)
            self.grams += grams
            self.lens.append(len(grams))
        return np.fromiter(map(index.__getitem__, found), np.int32, len(found))

    def arrays(self, start: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word buckets, trigram buckets end to end, and trigram counts, from word number ``start`` on."""
        lens = np.array(self.lens[start:])
        return np.array(self.word[start:]), np.array(self.grams[len(self.grams) - int(lens.sum()) :], np.int64), lens


def inputs(p: dict[str, np.ndarray], word: np.ndarray, grams: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Input vectors of words; a word without trigrams is the padding and all zero."""
    x = np.zeros((len(word), WORD_DIM + CHAR_DIM), np.float32)
    real = lens > 0
    if real.any():
        x[real, :WORD_DIM] = p["word"][word[real]]
        starts = (np.cumsum(lens) - lens)[real]
        x[real, WORD_DIM:] = np.add.reduceat(p["char"][grams], starts, axis=0) / lens[real, None]
    return x


def windows(ids: np.ndarray) -> np.ndarray:
    """Overlapping windows over all ids; the last ends with the text, a short text is padded by 0."""
    if len(ids) <= WINDOW:
        return np.pad(ids, (0, WINDOW - len(ids)))[None, :]
    starts = np.minimum(np.arange(0, len(ids) - WINDOW + STRIDE, STRIDE), len(ids) - WINDOW)
    return ids[starts[:, None] + np.arange(WINDOW)]


def forward(p: dict[str, np.ndarray], proj: np.ndarray, win: np.ndarray, keep: bool = False):
    """Window probabilities; proj holds the gate inputs (2, words, 3 * HIDDEN). With ``keep`` also what back() needs."""
    n, steps = win.shape
    h = np.zeros((2, n, HIDDEN), np.float32)
    states = np.empty((steps, n, 2 * HIDDEN), np.float32)
    trace = []
    for t in range(steps):
        x = np.stack([proj[0].take(win[:, t], axis=0), proj[1].take(win[:, steps - 1 - t], axis=0)])
        hu = h @ p["u"]
        x[..., : 2 * HIDDEN] += hu[..., : 2 * HIDDEN]
        zr = 1 / (1 + np.exp(-x[..., : 2 * HIDDEN]))
        z, r, hn = zr[..., :HIDDEN], zr[..., HIDDEN:], hu[..., 2 * HIDDEN :]
        c = np.tanh(x[..., 2 * HIDDEN :] + r * hn)
        new = c + z * (h - c)
        if keep:
            trace.append((h, z, r, c, hn))
        h = new
        states[t, :, :HIDDEN] = h[0]
        states[steps - 1 - t, :, HIDDEN:] = h[1]
    a = np.tanh(states @ p["wa"])
    e = a @ p["va"]
    pad = win.T == 0
    pad[0] = False
    e = np.where(pad, -1e9, e)
    w = np.exp(e - e.max(axis=0))
    w /= w.sum(axis=0)
    pooled = np.einsum("tb,tbh->bh", w, states)
    prob = sigmoid(pooled @ p["out"] + p["bias"][0])
    return (prob, (states, trace, a, w, pooled)) if keep else prob


def back(p: dict[str, np.ndarray], win: np.ndarray, kept, dlogit: np.ndarray):
    """Gradients of the recurrent part, and those of the gate inputs (2, steps, windows, 3 * HIDDEN)."""
    states, trace, a, w, pooled = kept
    steps, n, _ = states.shape
    g = {"out": pooled.T @ dlogit, "bias": np.array([dlogit.sum()], np.float32)}
    dpooled = dlogit[:, None] * p["out"]
    dstates = w[..., None] * dpooled
    dw = np.einsum("bh,tbh->tb", dpooled, states)
    de = w * (dw - (w * dw).sum(axis=0))
    da = de[..., None] * p["va"] * (1 - a * a)
    g["va"] = np.einsum("tb,tba->a", de, a)
    g["wa"] = np.einsum("tbh,tba->ha", states, da)
    dstates += da @ p["wa"].T
    g["u"] = np.zeros_like(p["u"])
    dx = np.empty((2, steps, n, 3 * HIDDEN), np.float32)
    dh = np.zeros((2, n, HIDDEN), np.float32)
    ut = p["u"].transpose(0, 2, 1)
    for t in range(steps - 1, -1, -1):
        h, z, r, c, hn = trace[t]
        dh = dh + np.stack([dstates[t, :, :HIDDEN], dstates[steps - 1 - t, :, HIDDEN:]])
        dc = dh * (1 - z) * (1 - c * c)
        dz = dh * (h - c) * z * (1 - z)
        dr = dc * hn * r * (1 - r)
        dhu = np.concatenate([dz, dr, dc * r], axis=-1)
        full = np.concatenate([dz, dr, dc], axis=-1)
        dx[0, t], dx[1, steps - 1 - t] = full[0], full[1]
        g["u"] += h.transpose(0, 2, 1) @ dhu
        dh = dh * z + dhu @ ut
    return g, dx


def fit(rows: list[tuple[str, int]], epochs: int = 5, batch: int = 64, rate: float = 0.01, seed: int = 11) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    p = init(seed)
    vocabulary = Vocabulary()
    docs = [windows(vocabulary.ids(words(t))) for t, _ in rows]
    labels = np.array([y for _, y in rows], np.float32)
    if len(docs) == 0:
        p["out"][:] = 0
        p["bias"][:] = -30
        return p
    word, grams, lens = vocabulary.arrays()
    starts = np.cumsum(lens) - lens
    all_windows = np.concatenate(docs)
    of = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    first = np.r_[0, np.cumsum([len(d) for d in docs])[:-1]]
    adam = Adam(p, rate)
    for epoch in range(epochs):
        proj = inputs(p, word, grams, lens) @ p["wx"] + p["b"]
        prob = np.concatenate([forward(p, proj, all_windows[i : i + 4096]) for i in range(0, len(all_windows), 4096)]) if epoch else rng.random(len(all_windows))
        order = np.lexsort((-prob, of))
        top = order[first]
        counts = np.diff(np.r_[first, len(of)])
        some = [first + (rng.random(len(docs)) * counts).astype(int) for _ in range(EARLY)]
        early = epoch < max(1, epochs // 3)
        chosen = rng.permutation(np.concatenate([*some, top]) if early else np.r_[top, some[0][labels == 0]])
        for at in range(0, len(chosen), batch):
            pick = chosen[at : at + batch]
            win, y = all_windows[pick], labels[of[pick]]
            win = np.where(rng.random(win.shape) < DROP, 0, win)
            used, local = np.unique(win, return_inverse=True)
            each = lens[used]
            flat = np.repeat(starts[used] - (np.cumsum(each) - each), each) + np.arange(each.sum())
            x = inputs(p, word[used], grams[flat], each)
            local = local.reshape(win.shape)
            pads_zero = np.where(win == 0, 0, local + 1)
            proj = np.concatenate([np.zeros((2, 1, 3 * HIDDEN), np.float32) + p["b"], x @ p["wx"] + p["b"]], axis=1)
            prob, kept = forward(p, proj, pads_zero, keep=True)
            g, dx = back(p, pads_zero, kept, ((prob - y) / len(y)).astype(np.float32))
            by = local.T.ravel()
            seq = np.argsort(by, kind="stable")
            dproj = np.add.reduceat(dx.reshape(2, -1, 3 * HIDDEN)[:, seq], np.searchsorted(by[seq], np.arange(len(used))), axis=1)
            g["b"] = dproj.sum(axis=1, keepdims=True)
            g["wx"] = x.T @ dproj
            din = (dproj @ p["wx"].transpose(0, 2, 1)).sum(axis=0)
            real = each > 0
            g["word"], g["char"] = np.zeros_like(p["word"]), np.zeros_like(p["char"])
            np.add.at(g["word"], word[used][real], din[real, :WORD_DIM])
            np.add.at(g["char"], grams[flat], np.repeat(din[:, WORD_DIM:] / np.maximum(each, 1)[:, None], each, axis=0))
            adam.step(g)
    return p


def scorer(p: dict[str, np.ndarray], cache_words: int = 150_000, slab: int = 2048):
    """A function from texts to scores. Gate inputs of up to ``cache_words`` words are remembered (memory only)."""
    state: dict = {}

    def reset() -> None:
        state["v"], state["proj"], state["n"] = Vocabulary(), np.zeros((2, 1024, 3 * HIDDEN), np.float32), 0

    def extend() -> np.ndarray:
        v, n = state["v"], state["n"]
        total = len(v.word)
        if total > n:
            while state["proj"].shape[1] < total:
                state["proj"] = np.concatenate([state["proj"], np.zeros_like(state["proj"])], axis=1)
            state["proj"][:, n:total] = inputs(p, *v.arrays(n)) @ p["wx"] + p["b"]
            state["n"] = total
        return state["proj"]

    reset()

    def score(texts: list[str | None]) -> np.ndarray:
        best = np.zeros(len(texts))
        wins, docs, held = [], [], 0

        def flush() -> None:
            nonlocal held
            if held:
                proj, all_docs = extend(), np.concatenate(docs)
                stacked = np.concatenate(wins)
                for i in range(0, len(stacked), slab):
                    np.maximum.at(best, all_docs[i : i + slab], forward(p, proj, stacked[i : i + slab]))
                wins.clear()
                docs.clear()
                held = 0

        for k, text in enumerate(texts):
            if len(state["v"].word) > cache_words:
                flush()
                reset()
            w = windows(state["v"].ids(words(text)))
            wins.append(w)
            docs.append(np.full(len(w), k))
            held += len(w)
            if held >= slab:
                flush()
        flush()
        return best

    return score


def toxicity_scores(docs: DataFrame, labels: DataFrame, per_class: tuple[int, int] = (2000, 1200), max_chars: int = 20_000, threshold: float = 0.5) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row of ``docs``."""
    p = fit(training_sample(docs, labels, "toxic", per_class, max_chars))
    return score_documents(docs, lambda: scorer(p), threshold)


def drop_toxic(docs: DataFrame, labels: DataFrame, per_class: tuple[int, int] = (2000, 1200), max_chars: int = 20_000, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, all columns."""
    p = fit(training_sample(docs, labels, "toxic", per_class, max_chars))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = scorer(p)
        for b in batches:
            yield b.filter(pa.array(score(b.column("text").to_pylist()) < threshold))

    return docs.mapInArrow(run, docs.schema)


def op3_toxicity_bigru(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
