"""Han conversion by dictionaries.

A stage is a list of (source, target) pairs, longest match first. The dictionary is a parameter of the job, so its size is that of a
word list, never of the data. Stages of single characters and small ones of phrases are expressions of the plan; a larger
phrase stage would make the plan grow with it, so it is sent to the tasks once and walked there, by first character and length.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import ITERATION_MARK, expand_iteration

#: Characters that conversion leaves alone, and glyphs it has no answer for.
PROTECTED = "吒乾於薹徵紬芸疏予欠装醋露回樫魟鰤鯱鉾弁"
TAIWAN_PROTECTED = "里占斗岩托"
GAPS = {"姫": "姬", "姉": "姐", "篠": "筱"}
JAPANESE_ONLY = "[姫々姉]"

Stage = list[tuple[str, str]]
MAX_PAIRS = 100_000
#: Up to so many phrases a stage is part of the plan.
INLINE = 100


def read_stages(table: DataFrame) -> dict[str, Stage]:
    """Conversion stages of a dictionary table (stage, src, dst), which must be within ``MAX_PAIRS`` rows."""
    rows = table.select("stage", "src", "dst").limit(MAX_PAIRS + 1).collect()
    if len(rows) > MAX_PAIRS:
        raise ValueError(f"a conversion dictionary of more than {MAX_PAIRS} pairs")
    out: dict[str, Stage] = {}
    for r in rows:
        out.setdefault(r.stage, []).append((r.src, r.dst))
    return out


def _apply(col: Column, stage: Stage) -> Column:
    if not stage:
        return col
    if all(len(s) == len(d) == 1 for s, d in stage):
        return F.translate(col, "".join(s for s, _ in stage), "".join(d for _, d in stage))
    longest = sorted((s for s, _ in stage), key=lambda s: (-len(s), s))
    pattern = "(?s)(" + "|".join(map(re.escape, longest)) + "|.)"
    known = F.create_map(*[F.lit(x) for pair in dict(stage).items() for x in pair])
    return F.array_join(F.transform(F.regexp_extract_all(col, F.lit(pattern), F.lit(1)), lambda t: F.coalesce(F.try_element_at(known, t), t)), "")


def _by_first(stage: Stage) -> dict[str, tuple[dict[str, str], list[int]]]:
    """For each first character, its phrases and their lengths, the longest first."""
    out: dict[str, tuple[dict[str, str], list[int]]] = {}
    for src, dst in dict(stage).items():
        if src:
            out.setdefault(src[0], ({}, []))[0][src] = dst
    return {c: (phrases, sorted({len(p) for p in phrases}, reverse=True)) for c, (phrases, _) in out.items()}


def walk(stages: list[Stage], protected: str = "") -> Callable[[Column], Column]:
    """A column function that converts as ``convert``, by steps over the text in Arrow batches."""
    tables = [_by_first(stage) for stage in stages]
    split = re.compile(f"([{re.escape(protected)}]+)") if protected else None

    def texts(values: pd.Series) -> pd.Series:
        def through(text: str) -> str:
            for table in tables:
                out, i, n = [], 0, len(text)
                while i < n:
                    phrases, lengths = table.get(text[i], ({}, ()))
                    for size in lengths:
                        found = phrases.get(text[i : i + size])
                        if found is not None and i + size <= n:
                            out.append(found)
                            i += size
                            break
                    else:
                        out.append(text[i])
                        i += 1
                text = "".join(out)
            return text

        def one(text: str | None) -> str | None:
            if text is None:
                return None
            parts = split.split(text) if split else [text]
            return "".join(p if k % 2 else through(p) for k, p in enumerate(parts))

        return values.map(one, na_action="ignore")

    return F.pandas_udf(texts, "string")


def convert(col: Column, stages: list[Stage], protected: str = "") -> Column:
    """All stages in turn; protected characters stay, and no match reaches across one."""
    if any(len(stage) > INLINE and any(len(s) > 1 or len(d) != 1 for s, d in stage) for stage in stages):
        return walk(stages, protected)(col)

    def through(c: Column) -> Column:
        for stage in stages:
            c = _apply(c, stage)
        return c

    if not protected:
        return through(col)
    runs = F.regexp_extract_all(col, F.lit(f"(?s)([{protected}]+|[^{protected}]+)"), F.lit(1))
    cut = F.array_join(F.transform(runs, lambda r: F.when(r.rlike(f"^[{protected}]"), r).otherwise(through(r))), "")
    return F.when(col.rlike(f"[{protected}]"), cut).otherwise(through(col))  # few texts need to be cut


@dataclass
class Converter:
    """Named conversions made of dictionary stages: t2s, s2t, s2tw, jp2t, t2jp."""

    stages: dict[str, list[Stage]] = field(default_factory=dict)

    def _named(self, name: str) -> list[Stage]:
        return self.stages.get(name, [])

    def plain(self, c: Column, name: str) -> Column:
        """A conversion without protected characters."""
        return convert(c, self._named(name))

    def simplify(self, c: Column) -> Column:
        return convert(c, self._named("t2s"), PROTECTED)

    def traditional(self, c: Column) -> Column:
        return self.plain(c, "s2t")

    def taiwan(self, c: Column) -> Column:
        return convert(c, self._named("s2tw"), TAIWAN_PROTECTED)

    def from_ja(self, c: Column) -> Column:
        return convert(c, self._named("jp2t"), PROTECTED)

    def to_ja(self, c: Column) -> Column:
        return self.plain(c, "t2jp")

    def is_simplified(self, c: Column) -> Column:
        return ~c.rlike(JAPANESE_ONLY) & (self.simplify(self.from_ja(c)) == c)

    def is_traditional(self, c: Column) -> Column:
        plain = self.plain(c, "t2s")
        return ~c.rlike(JAPANESE_ONLY) & ~((plain == c) & (self.taiwan(c) != c))

    def has_japanese_glyphs(self, c: Column) -> Column:
        return c.rlike(JAPANESE_ONLY) | (self.from_ja(c) != c)

    def repair_simplified(self, c: Column) -> Column:
        fixed = self.simplify(self.from_ja(strip_ja(c)))
        return F.when(self.is_simplified(c), c).when(self.is_simplified(fixed), fixed).otherwise(c)

    def repair_traditional(self, c: Column) -> Column:
        fixed = self.from_ja(strip_ja(c))
        return F.when(~self.has_japanese_glyphs(c), c).when(~self.has_japanese_glyphs(fixed), fixed).otherwise(c)

    def repair(self, c: Column, lang: str) -> Column:
        """Only values that fail their script's test, and only if the repair passes it."""
        if lang == "zh_hans":
            return self.repair_simplified(c)
        return F.when(self.is_traditional(c), c).otherwise(self.repair_traditional(c)) if lang == "zh_hant" else c

    def han_lang(self, c: Column) -> Column:
        """Language of a Han-only name: simplified characters, Japanese forms, else traditional."""
        return F.when(self.traditional(c) != c, "zh_hans").when(self.plain(c, "jp2t") != c, "ja").otherwise("zh_hant")


def strip_ja(col: Column) -> Column:
    """Glyphs and the iteration mark, resolved before conversion."""
    marked = F.when(col.contains(ITERATION_MARK), expand_iteration(col)).otherwise(col)
    return F.translate(marked, "".join(GAPS), "".join(GAPS.values()))


ColumnRule = Callable[[Column], Column]
