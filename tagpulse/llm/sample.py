"""The labelled rows that classifiers are fitted on, and a small Adam optimiser."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def held_out(doc_id):
    """True where crc32 of the id as text leaves no remainder by 5; such rows never train."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def training_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: tuple[int, int], max_chars: int) -> list[tuple[str, int]]:
    """(text, label) of at most ``per_class[y]`` rows of each label y, the first by hash of their id.

    Only fitting is bounded so: rows that are held out, unlabelled or longer than ``max_chars`` take no part.
    The result has at most sum(per_class) * max_chars characters and goes to the driver.
    """
    usable = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", F.col(label).cast("int").alias("y")).dropDuplicates(["doc_id"])
    first = None
    for y in (0, 1):
        part = usable.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * per_class[y])
        first = part if first is None else first.unionByName(part)
    texts = docs.select("doc_id", "text").where(F.col("text").isNotNull() & (F.length("text") <= max_chars))
    # at most 2 * sum(per_class) ids are broadcast
    rows = texts.join(F.broadcast(first), "doc_id").select("y", F.xxhash64("doc_id").alias("k"), "doc_id", "text")
    out: list[tuple[str, int]] = []
    for y in (0, 1):
        out += [(r.text, y) for r in rows.where(F.col("y") == y).orderBy("k", "doc_id", "text").limit(per_class[y]).collect()]
    return out


class Adam:
    """Adam steps in place on a dict of arrays."""

    def __init__(self, params: dict[str, np.ndarray], rate: float):
        self.params, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        scale = self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for k, g in grads.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            self.params[k] -= (scale * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)).astype(np.float32)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))
