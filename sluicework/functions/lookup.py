"""Lookup of a column in a small literal table, and number display."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# A literal map is scanned from the start, so larger tables are cut into maps of about so many keys by a checksum.
KEYS_A_MAP = 64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once.

    Spark does not share a costly expression that is used several times inside conditional branches or lambdas.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


_SEPARATOR = "\x1f"


def literal_array(values: Sequence[str]) -> Column:
    """A constant array of texts. One literal is split, which Spark folds; a literal per value would slow planning."""
    if any(_SEPARATOR in v for v in values):
        raise ValueError("a value holds the unit separator")
    return F.split(F.lit(_SEPARATOR.join(values)), _SEPARATOR)


def literal_map(table: Mapping[str, str | int]) -> Column:
    """A constant map from texts to texts or whole numbers; Spark folds it to one literal."""
    values = literal_array([str(v) for v in table.values()])
    if all(isinstance(v, int) for v in table.values()):
        values = values.cast("array<int>")
    return F.map_from_arrays(literal_array(list(table)), values)


def lookup(key: Column, table: Mapping[str, str | int], default: Column | None = None) -> Column:
    """Value of ``key`` in ``table``, else ``default`` (null when not given).

    A table of any size is a constant of the plan; one that grows with the data belongs in a join
    (see ``operators.joins.lookup_join``).
    """
    parts = -(-len(table) // KEYS_A_MAP)
    if parts <= 4:
        found = F.try_element_at(literal_map(table), key)
    else:
        cut: list[dict[str, str | int]] = [{} for _ in range(parts)]
        for name, value in table.items():
            cut[zlib.crc32(name.encode()) % parts][name] = value
        maps = F.array(*(literal_map(part or {next(iter(table)): next(iter(table.values()))}) for part in cut))
        found = F.try_element_at(F.get(maps, (F.crc32(key.cast("binary")) % parts).cast("int")), key)
    return found if default is None else F.coalesce(found, default)


def blank_to_null(c: Column) -> Column:
    """Empty text counts as missing."""
    return F.nullif(c, F.lit(""))


def display_number(c: Column, pattern: str, decimals: int = 0, missing: str = "—") -> Column:
    """Format a number half-even at ``decimals`` places into ``pattern`` (one ``%s``); ``missing`` for null."""
    text = F.format_number(F.bround(c.cast("double"), decimals), decimals)
    return F.when(c.isNull(), F.lit(missing)).otherwise(F.format_string(pattern, text))


def display_count(c: Column, missing: str = "—") -> Column:
    """1234567 -> '1,234,567'; decimals are cut off."""
    return display_number(F.when(c < 0, F.ceil(c)).otherwise(F.floor(c)), "%s", 0, missing)


def display_percent(c: Column, missing: str = "—") -> Column:
    """42.5 -> '42%' (half-even)."""
    return display_number(c, "%s%%", 0, missing)


def display_money(c: Column, missing: str = "—") -> Column:
    """81234.4 -> '$81,234'."""
    return display_number(c, "$%s", 0, missing)


def display_thousands(c: Column, missing: str = "—") -> Column:
    """81234.4 -> '$81k'."""
    return display_number(c / F.lit(1000.0), "$%sk", 0, missing)


def title_case(c: Column) -> Column:
    """Fallback written form of a tag."""
    return F.initcap(c)


def ratio(num: Column, den: Column, default: float | None = 0.0) -> Column:
    """``num / den`` as double, ``default`` when there is nothing to divide by."""
    out = F.try_divide(num.cast("double"), den.cast("double"))
    return out if default is None else F.coalesce(out, F.lit(default))


def percent(num: Column, den: Column, decimals: int = 1, default: float | None = 0.0) -> Column:
    """``100 * num / den``, rounded half-even."""
    return F.bround(F.lit(100.0) * ratio(num, den, default), decimals)
