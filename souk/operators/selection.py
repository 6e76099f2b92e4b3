"""Rows at given positions of a whole table, and NTILE from them, without sorting the table.

A position (the end of a tile, a percentile, a median) is found from counts of values: the
values' range is cut into ``CELLS`` cells, rows are counted per cell (one hash aggregation, combined
map-side), and the cell of each position is cut again until it is one value.  Several columns and positions share
each pass, two or three of which do for money in cents.  Only if a position falls inside the rows of one value are those rows
ranked by their id, with the range ranking, so that a value held by most rows is spread over tasks too.

A tile is then a comparison of a row's (value, id) with the k - 1 ends, in one projection: no
window, no join, no shuffle of the rows.

NULLs are ranked first in ascending and last in descending order.  Values are integers or
decimals of at most 18 digits, whose spread fits 63 bits.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ranking import SortKey, rank_buckets

CELLS = 1 << 14  # cells of a pass; the driver gets at most that many counts per position


def whole_number(df: DataFrame, column: str) -> Column:
    """The column as a bigint in the same order (decimals in units of their last digit)."""
    t = df.schema[column].dataType
    if isinstance(t, T.DecimalType) and t.precision <= 18:
        return (F.col(column) * F.lit(10**t.scale)).cast("decimal(38,0)").cast("bigint")
    if isinstance(t, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return F.col(column).cast("bigint")
    raise TypeError(f"{column}: {t.simpleString()} has no order in whole numbers of 64 bits")


@dataclass(frozen=True)
class Place:
    """The value at a position: rows before that value, and rows that hold it."""

    value: int
    before: int
    count: int


def _ranked_value(df: DataFrame, key: SortKey) -> Column:
    v = whole_number(df, key.column)
    return -v if key.descending else v


def extent(df: DataFrame, keys: dict[str, SortKey]) -> tuple[int, dict[str, tuple[int | None, int | None, int]]]:
    """Rows, and per key least value, greatest value and NULLs, in one pass."""
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, key in enumerate(keys.values()):
        v = _ranked_value(df, key)
        aggs += [F.min(v).alias(f"lo{i}"), F.max(v).alias(f"hi{i}"), F.count(v).alias(f"n{i}")]
    r = df.agg(*aggs).first()
    return r["n"], {name: (r[f"lo{i}"], r[f"hi{i}"], r["n"] - r[f"n{i}"]) for i, name in enumerate(keys)}


def null_rank(lo: int | None, hi: int | None, descending: bool) -> int:
    """The number that stands for NULL: before all values, or after them."""
    if lo is None:
        return 0
    return hi + 1 if descending else lo - 1


def values_at(df: DataFrame, keys: dict[str, SortKey], positions: dict[str, list[int]], known=None) -> dict[str, dict[int, Place]]:
    """name -> position (from 1) -> ``Place``, in the order of each key; values as ranked (negated if descending)."""
    n, ext = known or extent(df, keys)
    numbers, todo, found = {}, [], {name: {} for name in keys}
    for name, key in keys.items():
        lo, hi, nulls = ext[name]
        stand = null_rank(lo, hi, key.descending)
        numbers[name] = F.coalesce(_ranked_value(df, key), F.lit(stand).cast("bigint"))
        whole = (stand if lo is None else min(lo, stand if nulls else lo), stand if hi is None else max(hi, stand if nulls else hi))
        wanted = sorted({p for p in positions[name] if 1 <= p <= n})
        if wanted:
            todo.append((name, *whole, 0, wanted))
    while todo:  # (key, least, greatest, rows before, positions inside)
        cells = []
        for i, (name, lo, hi, _, _) in enumerate(todo):
            width = -(-(hi - lo + 1) // CELLS)
            v = numbers[name]
            inside = v.between(lo, hi)
            cell = F.when(inside, F.floor((v - F.lit(lo)) / F.lit(width)).cast("bigint") if width > 1 else v - F.lit(lo))
            cells.append(F.struct(F.lit(i).alias("i"), cell.alias("cell")))
        counted = df.select(F.explode(F.array(*cells)).alias("c")).filter("c.cell is not null")
        counts = counted.groupBy("c.i", "c.cell").agg(F.count(F.lit(1)).alias("n")).collect()  # CELLS rows per entry of todo at most
        of: dict[int, list] = {}
        for r in counts:
            of.setdefault(r["i"], []).append((r["cell"], r["n"]))
        after = []
        for i, (name, lo, hi, before, wanted) in enumerate(todo):
            width = -(-(hi - lo + 1) // CELLS)
            inner: dict[tuple, list] = {}
            for cell, rows in sorted(of.get(i, [])):
                while wanted and wanted[0] <= before + rows:
                    inner.setdefault((lo + cell * width, min(hi, lo + (cell + 1) * width - 1), before, rows), []).append(wanted.pop(0))
                before += rows
            for (a, b, seen, rows), here in inner.items():
                if a == b:
                    found[name].update({p: Place(a, seen, rows) for p in here})
                else:
                    after.append((name, a, b, seen, here))
        todo = after
    return found


def tile_ends(n: int, k: int) -> list[int]:
    """Last position of each tile but the last, as NTILE(k) deals n rows."""
    q, r = divmod(n, k)
    return [t * q + min(t, r) for t in range(1, k)]


def tiles(df: DataFrame, keys: dict[str, SortKey], tiebreak: str, k: int) -> dict[str, Column]:
    """name -> NTILE(k) over (key, tiebreak) as a column of ``df``; ``tiebreak`` is unique and not NULL."""
    n, ext = extent(df, keys)
    ends = tile_ends(n, k)
    places = values_at(df, keys, {name: ends for name in keys}, (n, ext))
    numbers = {name: F.coalesce(_ranked_value(df, key), F.lit(null_rank(ext[name][0], ext[name][1], key.descending)).cast("bigint"))
               for name, key in keys.items()}
    # values that hold the end of a tile before their last row: their rows are ranked by the tie-break
    cut = sorted({(name, p.value, p.before, p.count) for name in keys for end, p in places[name].items() if end < p.before + p.count})
    ids: dict[tuple, str] = {}
    if cut:
        slots, start = F.array(*[F.when(numbers[name] == F.lit(v), F.lit(i)) for i, (name, v, _, _) in enumerate(cut)]), 0
        rows = df.select(F.col(tiebreak).alias("id"), F.explode(slots).alias("slot")).filter("slot is not null")
        wanted = {}
        for name, value, before, count in cut:
            wanted |= {start + end - before: (name, end) for end, p in places[name].items() if p.value == value and end < before + count}
            start += count
        ranked = rank_buckets(rows, [SortKey("slot")], ["id"]).with_row_number("rn")
        for r in ranked.filter(F.col("rn").isin(list(wanted))).select("rn", "id").collect():  # one row per end of a tile
            ids[wanted[r["rn"]]] = r["id"]
    out = {}
    for name in keys:
        tile = F.lit(1)
        for end in ends:
            p = places[name].get(end)
            if p is None:  # fewer rows than tiles: the end is before the first row
                tile = tile + 1 if end < 1 else tile
                continue
            beyond = numbers[name] > F.lit(p.value)
            if (name, end) in ids:
                beyond = beyond | ((numbers[name] == F.lit(p.value)) & (F.col(tiebreak) > F.lit(ids[name, end])))
            tile = tile + F.when(beyond, 1).otherwise(0)
        out[name] = tile.cast("int")
    return out


def values_by_position(df: DataFrame, column: str, positions) -> dict[int, object]:
    """position (from 1, NULLs left out) -> value of ``column`` in its own type; ``positions`` is called with the number of values."""
    known = df.filter(F.col(column).isNotNull())
    keys = {column: SortKey(column)}
    n, ext = extent(known, keys)
    wanted = positions(n) if n else []
    places = values_at(known, keys, {column: wanted}, (n, ext))[column]
    t = df.schema[column].dataType
    if isinstance(t, T.DecimalType):
        return {p: Decimal(places[p].value).scaleb(-t.scale) for p in wanted}
    return {p: places[p].value for p in wanted}


def percentile_disc(df: DataFrame, value_col: str, p: float) -> DataFrame:
    """Smallest non-NULL value whose CUME_DIST reaches p: the value at position ceil(p * n). One row, none without values."""
    found = values_by_position(df, value_col, lambda n: [max(1, math.ceil(Decimal(str(p)) * n))])
    return df.sparkSession.createDataFrame([(v,) for v in found.values()], T.StructType([df.schema[value_col]]))


def median_values(df: DataFrame, value_col: str) -> list:
    """The one or two middle values of the non-NULL ones."""
    return list(values_by_position(df, value_col, lambda n: sorted({(n + 1) // 2, (n + 2) // 2})).values())
