"""Normalised text: comparison forms of addresses, postcodes, numbers and units."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The accepted postcode shapes without their space.
POSTCODE = "(GIR0AA|[A-PR-UWYZ][0-9][0-9A-HJKSTUW]?|[A-PR-UWYZ][A-HK-Y][0-9][0-9ABEHMNPRVWXY]?)[0-9][ABD-HJLNP-UW-Z]{2}"
#: Words that open a unit.
UNITS = ("FLAT", "APARTMENT", "APT", "UNIT", "ROOM", "MAISONETTE")


def full_match(text: Column, pattern: str) -> Column:
    return text.rlike(rf"\A(?:{pattern})\z")


#: The spaces of all scripts (Unicode category Zs).
SPACES = "".join(map(chr, (0x20, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000)))


def trimmed(text: Column) -> Column:
    """Without spaces of any script at the ends."""
    return F.btrim(text.cast("string"), F.lit(SPACES))


def blank_to_null(text: Column) -> Column:
    return F.nullif(trimmed(text), F.lit(""))


def normalise_address(text: Column) -> Column:
    """Upper-case letters and digits with single spaces between; NULL if there are none.

    A sharp s counts as a separator: it has no single upper-case letter among A to Z.
    """
    upper = F.upper(F.replace(text.cast("string"), F.lit("ß"), F.lit(" ")))
    return F.nullif(F.trim(F.regexp_replace(upper, "[^A-Z0-9]+", " ")), F.lit(""))


def compact_postcode(text: Column) -> Column:
    return F.upper(F.regexp_replace(trimmed(text), r"[ \t\n\f\r]+", ""))


def postcode_status(text: Column) -> Column:
    return F.when(blank_to_null(text).isNull(), "MISSING").when(full_match(compact_postcode(text), POSTCODE), "VALID").otherwise("INVALID")


def postcode(text: Column) -> Column:
    """Outward part, a space, inward part; NULL unless valid."""
    dense = compact_postcode(text)
    return F.when(postcode_status(text) == "VALID", F.concat(F.left(dense, F.length(dense) - 3), F.lit(" "), F.right(dense, F.lit(3))))


def postcode_sector(text: Column) -> Column:
    """The outward part and the first inward digit."""
    whole = postcode(text)
    return F.left(whole, F.length(whole) - 2)


def first_number_token(text: Column) -> Column:
    """First number that stands alone, with a letter at most."""
    return F.nullif(F.regexp_extract(normalise_address(text), r"(?:^| )([0-9]+[A-Z]?)(?= |$)", 1), F.lit(""))


def role_component(text: Column) -> Column:
    """Letters, digits, slashes and hyphens of a text, in upper case."""
    return F.nullif(F.regexp_replace(F.upper(text.cast("string")), "[^A-Z0-9/-]+", ""), F.lit(""))


def unit_identifier(text: Column) -> Column:
    """A unit's number or letters without the word before it."""
    upper = F.regexp_replace(F.upper(text.cast("string")), rf"^({'|'.join(UNITS)}) *", "")
    return F.nullif(F.regexp_replace(upper, "[^A-Z0-9/-]+", ""), F.lit(""))


#: Fixed value: a building's number or range of numbers, each with a letter at most, that no letter or digit touches.
DESIGNATOR = "[0-9]+[A-Z]?(?: *- *[0-9]+[A-Z]?)?"
_ALONE = rf"(?<![A-Z0-9])({DESIGNATOR})(?![A-Z0-9])"


def _dense(text: Column) -> Column:
    return F.nullif(F.regexp_replace(text, " +", ""), F.lit(""))


def first_designator(text: Column) -> Column:
    """The first number or range in a text."""
    return _dense(F.regexp_extract(F.upper(text.cast("string")), _ALONE, 1))


def only_designator(text: Column) -> Column:
    """The number or range that a text ends with, if no other one stands alone in it and it has no slash."""
    upper = F.upper(text.cast("string"))
    all_ = F.regexp_extract_all(upper, F.lit(_ALONE), F.lit(1))
    return F.when((F.size(all_) == 1) & ~F.contains(upper, F.lit("/")) & upper.rlike(rf"{_ALONE}[ ,.]*$"), _dense(F.get(all_, F.lit(0))))


def complete_number_designator(text: Column) -> Column:
    """The number or range that a text ends with, if it holds no other number and no slash."""
    upper = F.upper(text.cast("string"))
    found = _dense(F.regexp_extract(upper, rf"(?:^|[^A-Z0-9])({DESIGNATOR})[ ,.]*$", 1))
    numbers = F.size(F.regexp_extract_all(upper, F.lit("([0-9]+)"), F.lit(1)))
    return F.when(~F.contains(upper, F.lit("/")) & (numbers == F.when(F.contains(found, F.lit("-")), 2).otherwise(1)), found)


def has_token(whole: Column, part: Column) -> Column:
    """Whether part stands in whole as words of its own."""
    pad = lambda x: F.concat(F.lit(" "), x, F.lit(" "))
    return F.contains(pad(whole), pad(part))


def snake_header(names: list[str]) -> list[str]:
    """Column names for a file's header; two that fall together are an error."""
    out = []
    for name in names:
        plain = re.sub(r"[^0-9a-z]+", "_", name.strip().lower()).strip("_")
        out.append(("column_" if plain[:1].isdigit() else "") + plain + "_raw")
    if len(set(out)) != len(out):
        raise ValueError(f"header names fall together: {names}")
    return out
