"""Quality classifier: supervised subword embeddings.

Tokens are runs without white space, case kept, of any length. A token's vector is the mean of its hashed word vector and its
hashed character n-gram vectors. Each pair of neighbours has a hashed vector too, by both words in order. A document's vector is the mean over all its tokens and pairs, and a softmax over two classes follows. Vectors and softmax are learned by
stochastic gradient descent in numpy. At scoring each distinct token is reduced to its class margin once, so a
whole text of any length costs one look-up a token.

Defined cases: null and empty texts score by the bias alone; a null id is not held out; repeated rows each get a
row; with no usable labels every score is 0.5; extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .sample import held_out, sigmoid, training_sample

NGRAMS = (2, 3)
SIZE, PAIRS = 1 << 16, 1 << 14  # vectors of words and n-grams, and of pairs behind them


@dataclass
class Subwords:
    """emb: one vector a bucket; out: the softmax's two rows; bias: of the two classes."""

    emb: np.ndarray
    out: np.ndarray
    bias: np.ndarray


def words(text: str | None) -> list[str]:
    return (text or "").split()


def word_hash(word: str) -> int:
    return zlib.crc32(b"\x00" + word.encode("utf-8", "replace"))


def buckets(word: str) -> list[int]:
    """The word's own bucket, then those of its character n-grams between end marks."""
    marked = f"<{word}>"
    if marked.isascii():
        data = marked.encode()
        grams = [data[i : i + n] for n in NGRAMS for i in range(len(data) - n + 1)]
    else:
        grams = [marked[i : i + n].encode("utf-8", "replace") for n in NGRAMS for i in range(len(marked) - n + 1)]
    return [word_hash(word) % SIZE, *[zlib.crc32(g) % SIZE for g in grams]]


def pair_buckets(hashes: np.ndarray) -> np.ndarray:
    """Buckets of neighbours, by the hashes of consecutive words in their order."""
    h = hashes.astype(np.uint64)
    mixed = (h[:-1] * np.uint64(0x9E3779B97F4A7C15)) ^ (h[1:] * np.uint64(0xC2B2AE3D27D4EB4F))
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return SIZE + (mixed >> np.uint64(40)).astype(np.int64) % PAIRS


class _Vocabulary:
    """Distinct words by number, with their hashes, and their buckets laid end to end."""

    def __init__(self):
        self.index, self.hashes, self.flat, self.starts = {}, [], [], [0]

    def ids(self, found: list[str]) -> list[int]:
        index = self.index
        for w in set(found).difference(index):
            index[w] = len(self.hashes)
            self.hashes.append(word_hash(w))
            self.flat += buckets(w)
            self.starts.append(len(self.flat))
        return [index[w] for w in found]


def fit(rows: list[tuple[str, int]], dim: int = 8, epochs: int = 4, rate: float = 0.3, seed: int = 7) -> Subwords:
    """Plain SGD, one document a step, the rate falling in a line to zero. Vectors of pairs begin at zero."""
    rng = np.random.default_rng(seed)
    emb = np.concatenate([rng.uniform(-1 / dim, 1 / dim, (SIZE, dim)), np.zeros((PAIRS, dim))]).astype(np.float32)
    model = Subwords(emb, np.zeros((2, dim), np.float32), np.zeros(2, np.float32))
    vocabulary = _Vocabulary()
    docs = []
    for text, y in rows:
        ids = np.array(vocabulary.ids(words(text)))
        if len(ids):
            docs.append((*_shares(vocabulary, ids), y))
    for step, i in enumerate(np.concatenate([rng.permutation(len(docs)) for _ in range(epochs)]) if docs else []):
        at, share, y = docs[i]
        doc = share @ model.emb[at]
        z = model.out @ doc + model.bias
        p = np.exp(z - z.max())
        p /= p.sum()
        p[y] -= 1
        lr = rate * (1 - step / (epochs * len(docs)))
        pull = p @ model.out
        model.out -= lr * np.outer(p, doc)
        model.bias -= lr * p
        model.emb[at] -= (lr * 50) * share[:, None] * pull[None, :]
    return model


def _shares(vocabulary: _Vocabulary, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a document, and each one's share in the document's mean."""
    total = 2 * len(ids) - 1
    pairs, pair_count = np.unique(pair_buckets(np.array([vocabulary.hashes[k] for k in ids])), return_counts=True)
    some, count = np.unique(ids, return_counts=True)
    of = [vocabulary.flat[vocabulary.starts[k] : vocabulary.starts[k + 1]] for k in some]
    lens = np.array([len(x) for x in of])
    at, inverse = np.unique(np.concatenate(of), return_inverse=True)
    share = np.bincount(inverse, np.repeat(count / total / lens, lens))
    return np.r_[at, pairs], np.r_[share, pair_count / total].astype(np.float32)


def scorer(model: Subwords, cache_words: int = 200_000, slab: int = 200_000):
    """A function from texts to scores; it remembers the margins of up to ``cache_words`` words (memory only)."""
    margin = (model.emb @ (model.out[1] - model.out[0])).astype(np.float64)
    listed = margin.tolist()
    bias = float(model.bias[1] - model.bias[0])
    index: dict[str, int] = {}
    table = np.zeros((1 << 12, 2))  # margin and hash of each known word

    def numbers(found: list[str]) -> list[int]:
        nonlocal table
        new = set(found).difference(index)
        if new and len(index) + len(new) > cache_words:
            index.clear()
            new = set(found)
        if new:
            first = len(index)
            if first + len(new) > len(table):
                table = np.concatenate([table, np.zeros((max(len(table), len(new)), 2))])
            fresh = []
            for w in new:
                index[w] = len(index)
                b = buckets(w)
                fresh.append((sum(map(listed.__getitem__, b)) / len(b), word_hash(w)))
            table[first : len(index)] = fresh
        return list(map(index.__getitem__, found))

    def total(found: list[str]) -> float:
        """Sum of margins; a long text goes in slabs that share a word, for the pair between them."""
        out = 0.0
        for at in range(0, len(found), slab):
            ids = numbers(found[max(0, at - 1) : at + slab])
            some = table[ids]
            out += some[(at > 0) :, 0].sum() + margin[pair_buckets(some[:, 1].astype(np.int64))].sum()
        return out

    def score(texts: list[str | None]) -> np.ndarray:
        out = np.empty(len(texts))
        for k, text in enumerate(texts):
            found = words(text)
            out[k] = total(found) / max(1, 2 * len(found) - 1) + bias
        return sigmoid(out)

    return score


def score_documents(docs: DataFrame, score_of, threshold: float) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each row; ``score_of()`` makes the scoring function in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = score_of()
        for b in batches:
            s = score(b.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(s), pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "text")
    return picked.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def quality_scores(docs: DataFrame, labels: DataFrame, per_class: tuple[int, int] = (1000, 1000), max_chars: int = 20_000, threshold: float = 0.3) -> DataFrame:
    model = fit(training_sample(docs, labels, "quality", per_class, max_chars))
    return score_documents(docs, lambda: scorer(model), threshold)


def op9_quality_subword(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
