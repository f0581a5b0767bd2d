"""Column functions on dates, slugs, scripts and punctuation; native expressions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Character ranges; each use has its own.
HAN_NAME, KANA_NAME, HANGUL_NAME = "[㐀-䶿一-鿿豈-﫿]", "[぀-ヿㇰ-ㇿ]", "[가-힣ᄀ-ᇿ㄰-㆏]"
HANGUL_BUCKET = "[가-힯ᄀ-ᇿ㄰-㆏]"
HAN_PLAIN, KANA_PLAIN, HANGUL_PLAIN, KATAKANA = "[一-鿿〇]", "[぀-ヿ]", "[가-힣ᄀ-ᇿ]", "[ァ-ヶ]"
FULL_WIDTH = {":": "：", "!": "！", "?": "？", ",": "，", ";": "；"}
WRONG_OPENERS = "「{『【"
KATAKANA_DOT, MIDDLE_DOT = "・", "·"
ITERATION_MARK = "々"


def strict_day(col: Column) -> Column:
    """Date of the first ten characters when they read YYYY-MM-DD, else null."""
    text = F.substring(col, 1, 10)
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))


def month_of(day: Column) -> Column:
    return F.trunc(day, "MM")


def month_index(month: Column, epoch: Column) -> Column:
    """Whole months from ``epoch``."""
    return epoch_month(month) - epoch_month(epoch)


def epoch_month(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day) - 1


def yyyymmdd(day: Column) -> Column:
    return F.date_format(day, "yyyyMMdd").cast("int")


def split_tags(col: Column) -> Column:
    return F.filter(F.split(col, " "), lambda t: t != "")


def title_slug(col: Column) -> Column:
    """Underscores to spaces, each word's first letter raised, the rest untouched."""
    words = F.split(F.replace(col, F.lit("_"), F.lit(" ")), " ")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30))), " ")


def strip_disambig(col: Column) -> Column:
    return F.regexp_replace(col, r"_\([^()]*\)$", "")


def character_en(col: Column) -> Column:
    return title_slug(strip_disambig(col))


def strip_trailing_bracket(col: Column) -> Column:
    """Without a closing bracketed note, unless nothing else is there."""
    return F.coalesce(F.nullif(F.trim(F.regexp_replace(col, "[(（][^()（）]*[)）]$", "")), F.lit("")), col)


def has_han(col: Column) -> Column:
    return col.rlike(HAN_NAME)


def has_kana(col: Column) -> Column:
    return col.rlike(KANA_NAME)


def has_hangul(col: Column) -> Column:
    return col.rlike(HANGUL_NAME)


def has_katakana(col: Column) -> Column:
    return col.rlike(KATAKANA)


def is_han_name(col: Column) -> Column:
    """Han without kana or Hangul; false for null."""
    return F.coalesce(has_han(col) & ~has_kana(col) & ~has_hangul(col), F.lit(False))


def to_hiragana(col: Column) -> Column:
    kata = "".join(map(chr, range(ord("ァ"), ord("ヶ") + 1)))
    return F.translate(col, kata, "".join(chr(ord(c) - 0x60) for c in kata))


def full_width_chinese(col: Column) -> Column:
    """Punctuation between Han, brackets that hold Han, a spaced closing bracket, and the katakana dot."""
    # whole runs of signs that Han precedes and Han or the end follows, at any length; all else in pieces that end before a sign
    signs = ":!?,;：！？，；"
    run, rest = (F.regexp_extract_all(col, F.lit(f"(?s)(?<={HAN_PLAIN})([{signs}]+)(?={HAN_PLAIN}|$)|(.[^{signs}]*)"), F.lit(k)) for k in (1, 2))
    wide = F.zip_with(run, rest, lambda a, b: F.concat(F.translate(a, "".join(FULL_WIDTH), "".join(FULL_WIDTH.values())), b))
    col = F.when(col.rlike(f"{HAN_PLAIN}[{signs}]"), F.array_join(wide, "")).otherwise(col)
    col = F.regexp_replace(col, rf"(?<={HAN_PLAIN})\(([^()]*{HAN_PLAIN}[^()]*)\)", "（$1）")
    col = F.regexp_replace(col, rf"(?<={HAN_PLAIN}) \(([^()]+)\)$", "（$1）")
    return F.replace(col, F.lit(KATAKANA_DOT), F.lit(MIDDLE_DOT))


def full_width(col: Column, lang: str) -> Column:
    """Chinese gets all rules, Korean only the dot, other languages none."""
    if lang in ("zh_hans", "zh_hant"):
        return full_width_chinese(col)
    return F.replace(col, F.lit(KATAKANA_DOT), F.lit(MIDDLE_DOT)) if lang == "ko" else col


def _count(col: Column, char: str) -> Column:
    return F.length(col) - F.length(F.replace(col, F.lit(char), F.lit("")))


def repair_brackets(col: Column) -> Column:
    """Only where ASCII brackets do not balance: another opening shape becomes one, or the spare or missing one is mended."""
    opened, closed = _count(col, "("), _count(col, ")")
    fixed = F.regexp_replace(col, r"\)+$", "")
    for wrong in reversed(WRONG_OPENERS):
        fixed = F.when(col.contains(wrong), F.regexp_replace(col, f"^([^\\{wrong}]*)\\{wrong}", "$1(")).otherwise(fixed)
    unclosed = F.when(col.startswith("("), F.regexp_replace(col, r"^\(+", "")).otherwise(F.concat(col, F.lit(")")))
    return F.when(closed > opened, fixed).when(opened > closed, unclosed).otherwise(col)


def normalize_slugs(col: Column) -> Column:
    return F.when(col.rlike(r"[^\x00-\x7F]"), F.replace(col, F.lit("_"), F.lit(" "))).otherwise(col)


def qualifiers(col: Column) -> Column:
    return F.regexp_extract_all(col, F.lit(r"\(([^()]+)\)"), F.lit(1))


def stem(col: Column) -> Column:
    bare = F.replace(F.regexp_replace(col, r"\([^()]+\)", ""), F.lit("__"), F.lit("_"))
    return F.regexp_replace(bare, "^_+|_+$", "")


def expand_iteration(col: Column) -> Column:
    """The iteration mark repeats the character before it in the output; at the start it stays."""
    chars = F.split(col, "(?!^)")
    return F.aggregate(chars, F.lit(""), lambda out, c: F.concat(out, F.when((c == ITERATION_MARK) & (out != ""), F.right(out, F.lit(1))).otherwise(c)))


def parse_json(col: Column, schema: str) -> Column:
    return F.from_json(col, schema)


def print_json(col: Column) -> Column:
    return F.to_json(col)


def ordered_distinct(col: Column) -> Column:
    return F.array_distinct(col)


def first_n(col: Column, n: int) -> Column:
    return F.slice(col, 1, n)


def upper_median(values: Column) -> Column:
    """Element n // 2 of the ascending values."""
    return F.element_at(F.array_sort(values), (F.size(values) / 2).cast("int") + 1)


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
