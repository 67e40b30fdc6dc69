"""Column expressions that several operators share. All are built-in functions; nothing here runs Python on rows."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Latin letters that are no base letter with marks, and how they are written without them.
SPELLED = {"ß": "ss", "æ": "ae", "œ": "oe", "þ": "th", "ð": "d", "đ": "d", "ħ": "h", "ı": "i", "ł": "l", "ø": "o", "ŧ": "t"}


def _base_letters() -> dict[str, str]:
    """The small Latin letters with marks, and the ASCII letter that each is made from: by Unicode's own decompositions."""
    bases = ((chr(k), unicodedata.normalize("NFD", chr(k))[0]) for k in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00)))
    return {c: b for c, b in bases if c != b and b.isascii() and c == c.lower()}


BASES = _base_letters()
ACCENTED, PLAIN = "".join(BASES), "".join(BASES.values())
#: Combining marks, which stand by themselves in decomposed texts.
_MARKS = r"[\\u0300-\\u036F]"


def strip_accents(c: Column) -> Column:
    """UDF01: lower case, Latin letters without accents or spelled in ASCII; null becomes the empty string."""
    out = F.translate(F.regexp_replace(F.lower(c), r"[\u0300-\u036F]", ""), ACCENTED, PLAIN)
    for letter, spelled in SPELLED.items():
        out = F.replace(out, F.lit(letter), F.lit(spelled))
    return F.coalesce(out, F.lit(""))


def ascii_only(c: Column) -> Column:
    """UDF02: without characters beyond ASCII."""
    return F.regexp_replace(c, r"[^\x00-\x7F]", "")


def register_sql_functions(spark: SparkSession) -> None:
    """strip_accents(text) and ascii_only(text) for SQL texts, as SQL functions: they are inlined into the plan."""
    plain = f"translate(regexp_replace(lower(s), '{_MARKS}', ''), '{ACCENTED}', '{PLAIN}')"
    for letter, spelled in SPELLED.items():
        plain = f"replace({plain}, '{letter}', '{spelled}')"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION strip_accents(s STRING) RETURNS STRING RETURN coalesce({plain}, '')")
    spark.sql(r"CREATE OR REPLACE TEMPORARY FUNCTION ascii_only(s STRING) RETURNS STRING RETURN regexp_replace(s, '[^\\x00-\\x7F]', '')")


def safe_ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where it is undefined."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def month_end(c: Column, months: int = 0) -> Column:
    """The last day of the month `months` after that of c."""
    return F.last_day(F.add_months(F.trunc(c, "MM"), months))


def iso_utc(c: Column) -> Column:
    """A date or time as yyyy-MM-ddTHH:mm:ssZ."""
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def ordered_case(x: Column, bounds: list[tuple[float, str]], otherwise: str) -> Column:
    """PRJ04: the label of the first bound that x is below."""
    out = F
    for bound, label in bounds:
        out = out.when(x < bound, label)
    return out.otherwise(otherwise)


def first_bin(x: Column, uppers: list[float]) -> Column:
    """DR01: the number, from 1, of the first bin whose upper bound is at least x; the last bin takes the rest and nulls.
    One bin or none: always 1."""
    if len(uppers) < 2:
        return F.lit(1)
    out = F
    for k, upper in enumerate(uppers[:-1], 1):
        out = out.when(x <= upper, k)
    return out.otherwise(len(uppers))


def hash_share(c: Column, parts: int = 1000) -> Column:
    """AB01: md5 of a text, read as one 128-bit number, modulo parts. Four 32-bit steps, each within a long."""
    digest = F.md5(c.cast("string"))
    acc = F.lit(0).cast("long")
    for at in (1, 9, 17, 25):
        acc = (acc * F.lit(1 << 32) + F.conv(F.substring(digest, at, 8), 16, 10).cast("long")) % F.lit(parts)
    return acc


def parse_vector(c: Column) -> Column:
    """PRJ13: "[1.0,2.0]" as an array of doubles; what is no number becomes null."""
    return F.transform(F.split(F.regexp_replace(c, r"[\[\]\s]", ""), ","), lambda x: x.try_cast("double"))


def clear_names(df: DataFrame, *names: str) -> list[str]:
    """Column names for inside use that df, in whatever case, does not have."""
    mine, mark = {c.lower() for c in df.columns}, "_"
    while any(f"{mark}{n}".lower() in mine for n in names):
        mark += "_"
    return [f"{mark}{n}" for n in names]
