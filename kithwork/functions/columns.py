"""Column expressions shared by the operators. All of them stay inside generated JVM code."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

# Fixed values of a multiplicative congruential generator (Fishman and Moore): modulus, multiplier.
HASH_MODULUS = 2147483647
HASH_MULTIPLIER = 742938285


def split_fields(value: Column, sep: str) -> Column:
    """Split on a literal separator, keeping leading and inner empty fields but no trailing ones.

    An empty text is one empty field; a text of separators only has no field.
    """
    if len(sep) == 1:
        stripped = F.rtrim(value, F.lit(sep))
    else:
        trailing = F.regexp_replace(value, f"({re.escape(sep)})+$", "")
        stripped = F.when(value.endswith(sep), trailing).otherwise(value)
    return (
        F.when(value == "", F.array(F.lit("")))
        .when(stripped == "", F.array().cast("array<string>"))
        .otherwise(F.split(stripped, re.escape(sep)))
    )


def full_name(first: Column, last: Column) -> Column:
    return F.concat_ws(" ", first, last)


def street_address(street: Column, city: Column, state: Column) -> Column:
    return F.concat_ws(", ", street, city, state)


def age_units(birth_year: Column, birth_month: Column, as_of: tuple[int, int], unit: str) -> Column:
    """Age as a whole number of months or years, so that sums over it are exact."""
    year, month = as_of
    if unit == "year":
        return (F.lit(year) - birth_year).cast("bigint")
    if unit == "month":
        return ((F.lit(year) - birth_year) * 12 + (F.lit(month) - birth_month)).cast("bigint")
    raise ValueError(f"unit must be 'month' or 'year', not {unit!r}")


def units_per_year(unit: str) -> int:
    return {"month": 12, "year": 1}[unit]


def number_list(items: Column, tag: str = "", exact: bool = False) -> Column:
    """``1) A, 2) B & 3) C <tag>``: the last item follows an ampersand, the tag closes the text.

    ``exact`` keeps two oddities of the original text form: one leading space before a single
    item, and a tag shortened by two characters where there is no item.
    """
    suffix = f" {tag}" if tag else ""
    count = F.size(items)
    head = F.transform(
        F.slice(items, F.lit(1), F.greatest(count - 1, F.lit(0))),
        lambda item, i: F.concat((i + 1).cast("string"), F.lit(") "), item),
    )
    last = F.concat(count.cast("string"), F.lit(") "), F.get(items, count - 1), F.lit(suffix))
    return (
        F.when(count >= 2, F.concat(F.array_join(head, ", "), F.lit(" & "), last))
        .when(count == 1, F.concat(F.lit(" " if exact else ""), last))
        .when(count == 0, F.lit(suffix[2:] if exact else tag))
    )


def spread_hash(key: Column, seed: int, stream: int = 0) -> Column:
    """Reproducible pseudo-random integer in [0, modulus) from an integer key, in portable arithmetic.

    Different streams are independent of each other.
    """
    multiplier = pow(HASH_MULTIPLIER, stream + 1, HASH_MODULUS)
    small = F.pmod(key.cast("bigint"), F.lit(HASH_MODULUS))
    return F.pmod(small * multiplier + seed % HASH_MODULUS, F.lit(HASH_MODULUS))


def dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)
