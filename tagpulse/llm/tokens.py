"""Token counts by offset-mapped attribution.

A document's pieces (its lines, or several fields) are laid end to end and encoded once as a whole. Token lengths in
bytes give every token's span; spans are joined to the pieces' intervals by binary search, and a token
that crosses a boundary is allotted by an explicit rule:

- ``start``: to the piece that holds its first byte;
- ``most``: to the piece that holds most of its bytes, the earlier one on a tie;
- ``share``: to each piece in proportion to its bytes.

Defined cases: a null or empty document is one empty piece with no token; a line keeps its newline; a text that ends
with a newline has no empty last line; null fields are empty; texts are encoded whole at any length; repeated
rows each get their rows; null ids are kept; extra columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the word pattern that goes with this vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def load_ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, Path(path).read_bytes().splitlines())}


def lines(text: str) -> list[str]:
    parts = text.split("\n")
    kept = [p + "\n" for p in parts[:-1]] + [parts[-1]] * (parts[-1] != "")
    return kept or [""]


class Counter:
    """Counts tokens of pieces of whole texts. ``ranks`` maps token bytes to ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.encode = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.lens = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, k in ranks.items():
            self.lens[k] = len(token)

    def attribute(self, pieces: list[str], rule: str = "start") -> np.ndarray:
        whole = "".join(pieces)
        ends = np.cumsum([len(p.encode("utf-8", "replace")) for p in pieces]) if not whole.isascii() else np.cumsum([len(p) for p in pieces])
        tokens = np.array(self.encode(whole), np.int64)
        stop = np.cumsum(self.lens[tokens])
        start = stop - self.lens[tokens]
        first = np.searchsorted(ends, start, side="right")
        last = np.searchsorted(ends, stop - 1, side="right")
        counts = np.zeros(len(pieces)) if rule == "share" else np.zeros(len(pieces), np.int64)
        if rule == "start":
            return counts + np.bincount(first, minlength=len(pieces))
        whole_ones = first == last
        counts += np.bincount(first[whole_ones], minlength=len(pieces))
        for k in np.flatnonzero(~whole_ones):
            cuts = np.clip(ends[first[k] : last[k] + 1], start[k], stop[k])
            parts = np.diff(np.r_[start[k], cuts])
            if rule == "most":
                counts[first[k] + int(parts.argmax())] += 1
            else:
                counts[first[k] : last[k] + 1] += parts / (stop[k] - start[k])
        return counts


def count_sections(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN, rule: str = "start") -> DataFrame:
    """(doc_id, section, n_chars, n_tokens): a row for each line of each document."""
    ranks = load_ranks(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(ranks, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                b = batch.slice(at, 1000)
                pieces = [lines(t or "") for t in b.column(1).to_pylist()]
                counts = [counter.attribute(p, rule) for p in pieces]
                lens = np.array([len(p) for p in pieces])
                rows = np.repeat(np.arange(len(pieces)), lens)
                section = np.arange(len(rows)) - np.repeat(np.cumsum(lens) - lens, lens)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(rows)), pa.array(section, pa.int64()), pa.array([len(x) for p in pieces for x in p], pa.int64()), pa.array(np.concatenate(counts).astype(np.float64 if rule == "share" else np.int64))],
                    names=["doc_id", "section", "n_chars", "n_tokens"],
                )

    kind = "double" if rule == "share" else "long"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, f"doc_id long, section long, n_chars long, n_tokens {kind}")


def count_fields(docs: DataFrame, fields: list[str], separator: str = "\n", vocabulary: str = VOCABULARY, pattern: str = PATTERN, rule: str = "start") -> DataFrame:
    """(doc_id, field, n_tokens) of string columns encoded as one text; a separator belongs to the field before it."""
    ranks = load_ranks(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(ranks, pattern)
        for b in batches:
            texts = list(zip(*(b.column(i + 1).to_pylist() for i in range(len(fields))), strict=True))
            counts = [counter.attribute([(x or "") + separator * (k < len(fields) - 1) for k, x in enumerate(row)], rule) for row in texts]
            rows = np.repeat(np.arange(len(texts)), len(fields))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows)), pa.array(fields * len(texts)), pa.array(np.concatenate(counts).astype(np.float64) if counts else np.zeros(0))], names=["doc_id", "field", "n_tokens"])

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *[F.col(f).cast("string").alias(f) for f in fields])
    return picked.mapInArrow(run, "doc_id long, field string, n_tokens double")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_sections(table(spark, sf_dir, "documents"))
