"""Text and value expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The four linear tiers and their patterns as printed on drawings.
TIERS = ("X.", "X.X", "X.XX", "X.XXX")
LINEAR_VALUE = r"^±\d+(\.\d+)?$"
# Signs of plain drawing text, and what GBK reads where drawing fonts have plus-minus.
SYMBOLS = frozenset("±°ΩΦφ×²³µ")
ASCII = frozenset(map(chr, range(128)))
GBK_PLUS_MINUS = "∴"
ANGULAR_VALUE = r"^±\d+(\.\d+)?°$"


@F.pandas_udf(StringType())
def _nfkc(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


def compact(text: Column) -> Column:
    """NFKC, then no white space at all. NFKC has no built-in: Arrow batches, and only for text outside ASCII."""
    plain = text.rlike(r"^[\x00-\x7F]*$")
    return F.regexp_replace(F.when(plain, text).otherwise(_nfkc(F.when(~plain, text))), r"[\s 　]+", "")


def strip_prefix(model: Column, prefixes: list[str]) -> Column:
    """The first listed prefix that fits, in any case, once, and never to nothing; else unchanged."""
    m = F.trim(model)
    out = None
    for p in prefixes:
        hit = F.startswith(F.upper(m), F.lit(p.upper())) & (F.length(m) > len(p))
        new = F.ltrim(F.substring(m, F.lit(len(p) + 1), F.length(m)))
        out = F.when(hit, new) if out is None else out.when(hit, new)
    return model if out is None else out.otherwise(model)


def split_field(text: Column) -> Column:
    """Label and value around the first colon, of either width; value null without one."""
    parts = F.split(text, "[:：]", 2)
    return F.struct(F.trim(parts[0]).alias("label"), F.when(F.size(parts) == 2, F.trim(F.get(parts, 1))).alias("value"))


def page_counter(text: Column, total: str = "total", page: str = "page") -> Column:
    """m/n from a text that names both numbers; null otherwise."""
    n, m = (F.regexp_extract(F.lower(text), rf"{w}\s*(\d+)", 1) for w in (total, page))
    return F.when((n != "") & (m != ""), F.concat_ws("/", m, n))


def clean(text: Column) -> Column:
    """Non-empty, without outer white space or control characters."""
    return F.coalesce((text != "") & (F.trim(text) == text) & ~text.rlike(r"[\x00-\x1f\x7f]"), F.lit(False))


def contains_any(text: Column, vocabulary: Column) -> Column:
    """Whether a word of an array occurs in the text."""
    return F.exists(vocabulary, lambda w: F.contains(text, w))


def starts_any(text: Column, prefixes: Column) -> Column:
    return F.exists(prefixes, lambda p: F.startswith(text, p))


def literal_pattern(parts: Column) -> Column:
    """An alternation of literal texts."""
    return F.array_join(F.transform(parts, lambda p: F.regexp_replace(p, r"([\\.\[\]{}()*+?^$|/-])", r"\\$1")), "|")


def tier_line(tier: Column, value: Column) -> Column:
    return F.concat_ws(" ", tier, value)


def tiers_valid(tiers: Column, values: Column, pattern: str = LINEAR_VALUE) -> Column:
    """Exactly the four tiers in order, each with a value of the pattern."""
    return F.coalesce((tiers == F.array(*[F.lit(t) for t in TIERS])) & F.forall(values, lambda v: v.rlike(pattern)), F.lit(False))


def file_safe(name: Column, suffix: str = "") -> Column:
    return F.concat(F.replace(name, F.lit("/"), F.lit("_")), F.lit(suffix))


def switch(text: Column) -> Column:
    """key=value with a typed value: struct(key, kind, value)."""
    parts = F.split(text, "=", 2)
    v = F.get(parts, 1)
    kind = F.when(v.isNull() | (v == ""), "flag").when(v.rlike(r"^-?\d+$"), "int").when(v.rlike(r"^-?\d*\.\d+$"), "float").when(F.lower(v).isin("true", "false"), "bool").when(v.rlike(r"^[\[{]"), "json").otherwise("str")
    return F.struct(parts[0].alias("key"), kind.alias("kind"), v.alias("value"))


def cell_text(words: Column) -> Column:
    """Upper case, blanks removed, of an array of words."""
    return F.upper(F.replace(F.array_join(words, ""), F.lit(" "), F.lit("")))


def repair_symbols(text: Column, pairs: dict[str, str] | None = None) -> Column:
    """Replaces symbols that were decoded with the wrong code page; plus-minus and degree by default."""
    for bad, good in (pairs or {"Â±": "±", "Â°": "°"}).items():
        text = F.replace(text, F.lit(bad), F.lit(good))
    return text


@F.pandas_udf(StringType())
def redecode(s: pd.Series) -> pd.Series:
    """Text that was GBK but read as Latin-1, perhaps stored as UTF-8 and read as cp1252 after that, read again.

    Plain text with drawing symbols, and text that no such reading changes, stays. The sign that drawing fonts put at
    plus-minus becomes plus-minus.
    """

    def read(x, wrong, right):
        try:
            return x.encode(wrong).decode(right)
        except UnicodeError:
            return None

    def one(x):
        if x is None or x.isascii() or set(x) - SYMBOLS <= ASCII:
            return x
        found = (read(t, "latin-1", "gbk") for t in (read(x, "cp1252", "utf-8"), x) if t)
        changed = [r.replace(GBK_PLUS_MINUS, "±") for r in found if r is not None and r != x]
        return changed[0] if changed else x

    return s.map(one)


def canonical_json(**fields: Column) -> Column:
    """Compact JSON of the fields in order of their names; nulls stay."""
    pairs = [F.named_struct(*[x for n in sorted(fields) for x in (F.lit(n), fields[n])])]
    return F.to_json(pairs[0], {"ignoreNullFields": "false"})


def canonical_text(text: Column) -> Column:
    """Compact JSON of a JSON text with the keys of all its objects in order; null if it is none.

    A variant keeps the fields of an object by name, so its text is canonical at every depth. Arrays keep their order.
    """
    return F.to_json(F.try_parse_json(text))


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def ratio(part: Column, whole: Column) -> Column:
    """Share with a denominator of at least 1."""
    return part / F.greatest(F.lit(1), whole)


def effective_dpi(pixels: Column, points: Column) -> Column:
    return F.bround(pixels * 72 / points, 1)
