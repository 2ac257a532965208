"""String expressions with the white-space, case and length rules of the documents' conventions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that carry no meaning for coverage.
STOPWORDS = (
    "the of a an and to in for is on or by with at as be are was were this that its it from no not any all may can do does "
    "has have will shall which who whom into out about over under such per via than then thus but if so we you they he she"
).split()


#: What (?U)\s matches, for trimming: a pattern would be tried at every character.
SPACE = "\t\n\u000b\f\r \u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACE))


def lstrip(c: Column) -> Column:
    return F.ltrim(c, F.lit(SPACE))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(SPACE))


def indent(c: Column) -> Column:
    return F.regexp_extract(c, r"(?U)^(\s*)", 1)


def collapse(c: Column) -> Column:
    return F.regexp_replace(strip(c), r"(?U)\s+", " ")


def blank(c: Column) -> Column:
    return F.coalesce(strip(c), F.lit("")) == ""


def one_break(c: Column) -> Column:
    """All kinds of line breaks as \\n, without one at the end: splitting then gives the lines."""
    return F.regexp_replace(F.regexp_replace(c, "\r\n|[\r\u000b\u000c\u001c-\u001e\u0085\u2028\u2029]", "\n"), "\n$", "")


def casefold(c: Column) -> Column:
    """Lower case with sharp s as ss."""
    return F.replace(F.lower(c), F.lit("ß"), F.lit("ss"))


def alnum_key(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", "")


def present_key(c: Column) -> Column:
    return collapse(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"(?U)[^\w\s]", ""))


def label_key(c: Column) -> Column:
    return F.lower(F.regexp_replace(strip(F.regexp_replace(strip(c), r"^\*+|\*+$", "")), r"(?U)\s+", " "))


def figure_key(c: Column) -> Column:
    return collapse(F.regexp_replace(F.lower(F.regexp_replace(c, r"\$[^$]*\$", " ")), "[^a-z0-9 ]+", " "))


def heading_raw_key(c: Column) -> Column:
    return casefold(collapse(c))


def heading_key(c: Column) -> Column:
    return casefold(collapse(F.regexp_replace(strip(c), r"^\d+(?:\.\d+)*\s+", "")))


#: A whole run of letters and digits, two or more, that is no stop word.
TOKEN = f"(?<![a-z0-9])(?!(?:{'|'.join(STOPWORDS)})(?![a-z0-9]))[a-z0-9]{{2,}}"


def tokens(c: Column) -> Column:
    """Significant tokens in order, repeats kept."""
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(TOKEN), F.lit(0))


def share_in(part: Column, whole: Column) -> Column:
    """Share of the tokens in ``part`` (repeats count) that ``whole`` has; null for no tokens."""
    return F.when(F.size(part) > 0, F.size(F.filter(part, lambda t: F.array_contains(whole, t))) / F.size(part))


def covered(line: Column, whole: Column, least: float = 0.6) -> Column:
    """A line of fewer than two tokens counts as covered."""
    own = tokens(line)
    return (F.size(own) < 2) | (F.coalesce(share_in(own, whole), F.lit(0.0)) >= least)


def set_overlap(a: Column, b: Column) -> Column:
    """Distinct tokens of ``a`` in ``b`` over distinct tokens of ``a``."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(F.array_distinct(a))).otherwise(0.0)


def line_key(c: Column) -> Column:
    """Key under which item lines count as the same."""
    s = F.replace(F.lower(strip(c)), F.lit("`"), F.lit(""))
    return F.regexp_replace(F.regexp_replace(s, r"(?U)\s+", " "), r"(?U)\s*\|\s*", "|")


def replace_first(line: Column, old: Column, new: Column) -> Column:
    at = F.position(old, line)
    return F.when((at > 0) & (F.length(old) > 0), F.concat(F.substring(line, F.lit(1), at - 1), new, F.substr(line, at + F.length(old)))).otherwise(line)


def flag_after(line: Column, value: Column, flag: str) -> Column:
    return F.when(F.contains(line, F.lit(flag)), line).otherwise(replace_first(line, value, F.concat(value, F.lit(" " + flag))))
