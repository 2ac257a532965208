"""Designators, values, flags and verdicts in lines about circuits, as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip

# The narrow and the wide vocabulary of designators, values with units, pin-to-net lines.
NARROW = r"\b([UQ]\d+\.[A-Z]\d+|U\d+[A-Z]?|R\d+|C\d+|L\d+|J\d+|D\d+|Q\d+|X\d+)\b"
WIDE = r"\b([UQ]\d+\.[A-Z]\d+|ANT\d+|SW\d+|TP\d+|FB\d+|U\d+[A-Z]?|R\d+|C\d+|L\d+|J\d+|D\d+|Q\d+|X\d+|Y\d+|K\d+|M\d+)\b"
RANGE = r"\b([RCULJDQX]\d+)\s*[-–]\s*([RCULJDQX]\d+)\b"
VALUE = (
    r"(?<![A-Za-z0-9_])(\d+(?:\.\d+)?\s*[pnuµμmkKMR]?[FΩ]|\d+(?:\.\d+)?\s*[kKmM]?[ΩR]\b|\d+R\d+|\d+(?:\.\d+)?\s*[kKmM](?![A-Za-z0-9_])"
    r"|\d+(?:\.\d+)?\s*[pnuµμ]?H|\d+(?:\.\d+)?\s*V\b|\d+(?:\.\d+)?\s*%|\b[0-9]{4}\b(?![A-Za-z0-9_]))"
)
PIN_NET = r"(?i)\b([A-Z]{1,3}\d+)(?:\.([A-Z]?\d*[A-Z]?\d*)|\s*(?:pin\s+)?([A-Z]{0,2}\d+[A-Z]?))\s*-+>\s*([A-Za-z0-9_]+)"
KEYWORDS = r"(?i)(schematic|회로도|\bnet\b|\bGND\b|\bVDD\b|\bpin\b)"
ARTIFACT_NETS = ("Net_", "Pin_", "PiUn", "PiJn", "PiLn", "PiMn", "COC", "COR", "PIU", "N_D_", "SUBV_", "DXT", "BF_C", "SGP")
UNREADABLE, UNVERIFIED, CONFIRMED, ABSENT = "[unreadable]", "[unverified]", "confirmed", "absent"


def designators(line: Column, wide: bool = False) -> Column:
    return F.array_distinct(F.regexp_extract_all(line, F.lit(WIDE if wide else NARROW), F.lit(1)))


def has_range(line: Column) -> Column:
    return line.rlike(RANGE)


def normal_value(v: Column) -> Column:
    return F.lower(F.translate(F.replace(strip(v), F.lit(" "), F.lit("")), "µμΩK", "uuRk"))


def values(segment: Column) -> Column:
    return F.transform(F.regexp_extract_all(segment, F.lit(VALUE), F.lit(1)), strip)


def value_segment(line: Column, designator: Column) -> Column:
    """Where the value of a designator may stand: after it up to the next one, or in a table row
    its cell's rest and the next cell if that has no designator. Remarks in parentheses are left out."""
    plain = lambda c: F.regexp_replace(c, r"\([^)]*\)", " ")
    after = lambda c: F.when(F.contains(c, designator), F.substr(c, F.position(designator, c) + F.length(designator))).otherwise("")
    cells = F.split(line, r"\|")
    place = F.array_min(F.filter(F.sequence(F.lit(1), F.size(cells)), lambda k: F.array_contains(designators(F.element_at(cells, k)), designator)))
    following = F.coalesce(F.try_element_at(cells, place + 1), F.lit(""))
    row = F.concat(after(plain(F.element_at(cells, place))), F.lit(" | "), F.when(F.size(designators(following)) == 0, plain(following)).otherwise(""))
    rest = after(line)
    stop = F.regexp_instr(rest, F.lit(NARROW))
    prose = F.when(F.contains(line, designator), plain(F.when(stop > 0, F.substr(rest, F.lit(1), stop - 1)).otherwise(rest))).otherwise(plain(line))
    return F.when(line.rlike(r"^\s*\|"), F.when(place.isNotNull(), row).otherwise(plain(line))).otherwise(prose)


def verdict(line: Column, designator: Column) -> Column:
    """(verdict, raw): what a line says of a designator."""
    found = values(value_segment(line, designator))
    doubted = line.rlike(r"(?i)\[unverified(?:\s+range)?\]")
    says = F.when(line.rlike(r"(?i)\[unreadable\]"), UNREADABLE).when(doubted, UNVERIFIED)
    says = says.when(F.size(found) > 0, normal_value(F.try_element_at(found, F.lit(1)))).otherwise(CONFIRMED)
    raw = F.when(~says.isin(UNREADABLE, UNVERIFIED, CONFIRMED), F.try_element_at(found, F.lit(1)))
    return F.struct(says.alias("verdict"), raw.alias("raw"))


def normal_ref(ref: Column) -> Column:
    s = F.element_at(F.split(F.upper(F.regexp_replace(ref, r"(?U)[\s\-_]", "")), r"\."), 1)
    return F.regexp_replace(s, r"^([A-Z]{1,3}\d+)[A-Z]$", "$1")


def ref_prefix(ref: Column) -> Column:
    return F.regexp_extract(ref, "^([A-Z]+)", 1)


def is_named_net(name: Column) -> Column:
    artifact = F.exists(F.array(*[F.lit(p) for p in ARTIFACT_NETS]), lambda p: F.startswith(name, p))
    return (F.length(name) > 2) & ~artifact


def pin_nets(line: Column) -> Column:
    """(ref, pin, net) of each pin-to-net phrase of a line."""
    part = lambda k: F.regexp_extract_all(line, F.lit(PIN_NET), F.lit(k))
    zipped = F.arrays_zip(part(1).alias("a"), part(2).alias("b"), part(3).alias("c"), part(4).alias("d"))
    return F.transform(zipped, lambda p: F.struct(normal_ref(p["a"]).alias("ref"), F.upper(F.when(p["b"] != "", p["b"]).otherwise(p["c"])).alias("pin"), p["d"].alias("net")))


def tier(lines: Column, count: Column, pins: Column, keywords: Column) -> Column:
    """(tier, reason) from the signals of a page."""
    light = (count >= 5) | (pins >= 1) | (lines >= 200) | (F.size(keywords) > 0)
    name = F.when(lines >= 2500, "dense").when((lines >= 800) & (count >= 15), "dense").when(light, "light").otherwise("text")
    why = F.when(lines >= 2500, "strong_vector").when((lines >= 800) & (count >= 15), "vec+desig").otherwise("")
    return F.struct(name.alias("tier"), why.alias("reason"))
