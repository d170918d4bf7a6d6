"""Conditions that part a table into ranges of about equally many rows, for keys of any columns.

The source only answers aggregate queries: it counts the rows between candidate values, and ranges with too many rows get
new candidates inside them, until a range is small enough or holds one value of its column.  Such a value, if it is
frequent, is parted by the next column of the key.  Candidates lie evenly between the least and the greatest value that
was found: numbers and days by arithmetic, texts by their first differing characters.

Ranges are in lexicographic order of the key; NULL comes before all values.  Every row satisfies exactly one condition.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from decimal import Decimal
from typing import Any

from tableferry.sources.jdbc import literal, quoted

#: Runs a query at the source; one row (as a tuple) for each group.
Ask = Callable[[str], Sequence[Sequence[Any]]]

#: A range is cut further while it holds more than this share of a wanted partition.
FINE = 0.25
#: Parts that a range is cut into in one round, and rounds for one column.
PARTS, ROUNDS = 8, 24
#: Characters after the common beginning by which texts are cut.
_WIDTH = 4
_BASE = 0x110000


@dataclass(frozen=True)
class Range:
    """Rows with ``fixed`` values in the first columns, and the next column from ``low`` to ``high``."""

    fixed: tuple
    low: Any
    high: Any
    rows: int


def at_least(columns: Sequence[str], cut: Sequence, dialect: str = "") -> str:
    """The key is not before the cut, which may name values of its first columns only."""
    name, value = quoted(columns[0], dialect), literal(cut[0])
    if len(cut) == 1:
        return f"{name} >= {value}"
    return f"({name} > {value} or ({name} = {value} and {at_least(columns[1:], cut[1:], dialect)}))"


def before(columns: Sequence[str], cut: Sequence, dialect: str = "") -> str:
    """The key is before the cut; NULL is before all values."""
    name, value = quoted(columns[0], dialect), literal(cut[0])
    if len(cut) == 1:
        return f"({name} < {value} or {name} is null)"
    return f"({name} < {value} or {name} is null or ({name} = {value} and {before(columns[1:], cut[1:], dialect)}))"


def conditions(columns: Sequence[str], cuts: Sequence[Sequence], dialect: str = "") -> list[str]:
    """One condition for each range between the cuts, in order; each row satisfies one."""
    if not cuts:
        return ["1=1"]
    out = [before(columns, cuts[0], dialect)]
    out += [f"{at_least(columns, a, dialect)} and {before(columns, b, dialect)}" for a, b in zip(cuts, cuts[1:], strict=False)]
    return [*out, at_least(columns, cuts[-1], dialect)]


def _as_number(text: str) -> int:
    number = 0
    for i in range(_WIDTH):
        number = number * _BASE + (ord(text[i]) + 1 if i < len(text) else 0)
    return number


def _as_text(number: int) -> str:
    points = []
    for _ in range(_WIDTH):
        number, point = divmod(number, _BASE)
        points.append(point)
    # No half of a pair, and nothing that a source may refuse.
    return "".join(chr(p - 1) for p in reversed(points) if p and 0x20 <= p - 1 and not 0xD800 <= p - 1 < 0xE000)


def between(low: Any, high: Any, parts: int) -> list:
    """Values that part what lies between two others, the first of them above ``low`` and the last at most ``high``."""
    if low == high:
        return []
    if isinstance(low, datetime):
        found = [low + (high - low) * i / parts for i in range(1, parts)]
    elif isinstance(low, date):
        found = [low + timedelta(days=(high - low).days * i // parts) for i in range(1, parts)]
    elif isinstance(low, str):
        common = next((i for i, (a, b) in enumerate(zip(low, high, strict=False)) if a != b), min(len(low), len(high)))
        a, b = _as_number(low[common:]), _as_number(high[common:])
        found = [low[:common] + _as_text(a + (b - a) * i // parts) for i in range(1, parts)]
    elif isinstance(low, (int, Decimal)):
        found = [low + (high - low) * i // parts if isinstance(low, int) else low + (high - low) * i / parts for i in range(1, parts)]
    elif isinstance(low, float):
        found = [low + (high - low) * i / parts for i in range(1, parts)]
    else:
        raise ValueError(f"no values lie between {type(low).__name__}s: split by other columns")
    # The greatest itself is the last candidate: what is below it may then be one value.
    return sorted({x for x in [*found, high] if low < x <= high})


def _refined(ask: Ask, table: str, columns: Sequence[str], wanted: float, dialect: str, fixed: tuple = ()) -> list[Range]:
    """Ranges of the column behind the fixed ones, each with few rows or one value, in order."""
    name = quoted(columns[len(fixed)], dialect)
    same = [f"{quoted(c, dialect)} = {literal(v)}" for c, v in zip(columns, fixed, strict=False)]
    where = " and ".join([*same, f"{name} is not null"])
    count, low, high = ask(f"select count(*), min({name}), max({name}) from {table} where {where}")[0]
    done, large = [], [Range(fixed, low, high, count)] if count else []
    for _ in range(ROUNDS):
        done += [r for r in large if r.rows <= wanted or r.low == r.high]
        large = [r for r in large if r.rows > wanted and r.low != r.high]
        if not large:
            break
        # One query for all large ranges: the number of the last candidate that a value reaches.
        branches: list[str] = []
        for r in large:
            values = between(r.low, r.high, PARTS)
            for number, value in enumerate([*values, None]):
                low_end = f"{name} >= {literal(values[number - 1] if number else r.low)}"
                high_end = f"{name} < {literal(value)}" if value is not None else f"{name} <= {literal(r.high)}"
                branches.append(f"when {low_end} and {high_end} then {len(branches)}")
        inside = " or ".join(f"({name} >= {literal(r.low)} and {name} <= {literal(r.high)})" for r in large)
        found = ask(f"select part, count(*), min(k), max(k) from (select {name} as k, case {' '.join(branches)} end as part from {table} "
                    f"where {' and '.join([*same, f'({inside})'])}) parts group by part")
        if any(part is None for part, *_ in found) or sum(n for _, n, *_ in found) != sum(r.rows for r in large):
            raise ValueError(f"{table}: the source orders {columns[len(fixed)]} otherwise than its values compare here, or its rows changed")
        large = [Range(fixed, low, high, n) for _, n, low, high in sorted(found, key=lambda x: x[0])]
    return sorted([*done, *large], key=lambda r: r.low)


def _fine(ask: Ask, table: str, columns: Sequence[str], wanted: float, dialect: str, fixed: tuple = ()) -> list[Range]:
    out = []
    for r in _refined(ask, table, columns, wanted, dialect, fixed):
        if r.rows > wanted and r.low == r.high and len(fixed) + 1 < len(columns):
            inner = _fine(ask, table, columns, wanted, dialect, (*fixed, r.low))
            # Rows without a value in the next column are before the others.
            missing = r.rows - sum(x.rows for x in inner)
            out += [*([Range((*fixed,), r.low, r.low, missing)] if missing else []), *inner]
        else:
            out.append(r)
    return out


def even_cuts(ask: Ask, table: str, columns: Sequence[str], partitions: int, dialect: str = "") -> list[tuple]:
    """Cuts of the key that part a table into at most so many ranges, of about equally many rows each.

    Where one value of the whole key has more rows than a range should have, it stays in one.
    """
    if not columns:
        raise ValueError(f"{table}: give the columns to split by")
    (total,) = ask(f"select count(*) from {table}")[0]
    if partitions < 2 or not total:
        return []
    mean = total / partitions
    fine = _fine(ask, table, columns, max(1.0, mean * FINE), dialect)
    cuts: list[tuple] = []
    # NULLs of the first column are at the beginning.
    held = total - sum(r.rows for r in fine)
    for r in fine:
        if held and held + r.rows > mean * (1 + FINE / 2) and len(cuts) < partitions - 1:
            cuts.append((*r.fixed, r.low))
            held = 0
        held += r.rows
    return sorted(set(cuts), key=cuts.index)


def even_conditions(ask: Ask, table: str, columns: Sequence[str], partitions: int, dialect: str = "") -> list[str]:
    """Conditions for a parallel read, one for each range of about equally many rows."""
    return conditions(columns, even_cuts(ask, table, columns, partitions, dialect), dialect)
