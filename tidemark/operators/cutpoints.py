"""Exact NTILE of several orders at once by distributed selection: find the rows at the tile borders, then compare.

A tile border is an order statistic. Sampled rows around each wanted position are counted exactly, for all borders of
all orders in one aggregation, and the brackets shrink until the few rows left inside are fetched. Once they hold a
small part of the rows, only the keys of these are written and read on: the table itself is read a few times, however
many rounds there are. Every row then gets its tile by comparing its keys with at most n - 1 border rows: nothing is
dealt, sorted or rewritten, and the driver holds a bounded number of keys however large the table is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.materialize import materialize
from tidemark.operators.ntile import SortKey

HELD = 50_000           # rows of a bracket that are fetched
SAMPLE = 10_000         # rows sampled of a larger bracket
KEPT = 4                # brackets that hold less than this part of the rows read are written
_PARTS = 1 << 30


@dataclass
class _Border:
    """The row at ``position`` (from 1) of an order; it lies strictly between ``low`` and ``high``, among ``inside`` rows."""
    order: list[SortKey]
    position: int
    inside: int
    below: int = 0              # rows up to ``low``
    low: tuple | None = None
    high: tuple | None = None
    row: tuple | None = None

    def bracket(self) -> Column:
        cond = F.lit(True) if self.low is None else after(self.order, self.low)
        return cond if self.high is None else cond & ~after(self.order, self.high) & ~equal(self.order, self.high)


def _nulls_first(k: SortKey) -> bool:
    return k.ascending if k.nulls_first is None else k.nulls_first


def equal(order: Sequence[SortKey], row: Sequence) -> Column:
    """Whether a row's keys equal ``row`` (NULL equals NULL)."""
    out = F.lit(True)
    for k, v in zip(order, row):
        out = out & F.col(k.col).eqNullSafe(F.lit(v))
    return out


def after(order: Sequence[SortKey], row: Sequence) -> Column:
    """Whether a row comes strictly after ``row`` in the order (NULL placement included)."""
    later, same = F.lit(False), F.lit(True)
    for k, v in zip(order, row):
        c = F.col(k.col)
        if v is None:
            beyond = c.isNotNull() if _nulls_first(k) else F.lit(False)
        else:
            beyond = F.coalesce(c > F.lit(v) if k.ascending else c < F.lit(v), F.lit(not _nulls_first(k)))
        later, same = later | (same & beyond), same & c.eqNullSafe(F.lit(v))
    return later


def _sorted(rows: list[tuple], order: Sequence[SortKey]) -> list[tuple]:
    """Rows in Spark's order of the keys: NaN above every number, NULLs where the key puts them."""
    for i, k in reversed(list(enumerate(order))):
        null = (0,) if _nulls_first(k) == k.ascending else (2,)
        rows.sort(key=lambda r: null if r[i] is None else (1, r[i] != r[i], 0 if r[i] != r[i] else r[i]), reverse=not k.ascending)
    return rows


def _fetch(df: DataFrame, borders: Sequence[_Border], wanted: Sequence[Column]) -> list[list[tuple]]:
    """Sorted keys of the rows wanted for each border, in one job; the rows are a sample or a bracket, so bounded."""
    if not borders:
        return []
    cols = list(dict.fromkeys(k.col for b in borders for k in b.order))
    any_of = F.lit(False)
    for c in wanted:
        any_of = any_of | c
    rows = df.where(any_of).select(*cols, *[c.alias(f"_wanted{i}") for i, c in enumerate(wanted)]).collect()
    at = {c: i for i, c in enumerate(cols)}
    return [_sorted([tuple(r[at[k.col]] for k in b.order) for r in rows if r[len(cols) + i]], b.order) for i, b in enumerate(borders)]


def _inside(df: DataFrame, borders: Sequence[_Border]) -> DataFrame:
    """The keys of the rows that lie in a bracket."""
    any_of = F.lit(False)
    for b in borders:
        any_of = any_of | b.bracket()
    return df.where(any_of).select(*dict.fromkeys(k.col for b in borders for k in b.order))


def _shrink(df: DataFrame, borders: Sequence[_Border], sample: int, turn: int) -> bool:
    """Narrow every bracket by two sampled rows around its wanted place, counted exactly in one pass.

    ``df`` holds at least the rows of the brackets; those up to a bracket are counted already.
    Every sampled row lies inside its bracket, so it narrows it; False if some bracket had none.
    """
    drawn = [F.pmod(F.xxhash64(F.lit(turn), *[k.col for k in b.order]), F.lit(_PARTS)) < max(1, _PARTS * sample // b.inside)
             for b in borders]
    tests, counts = [], []
    for b, rows in zip(borders, _fetch(df, borders, [b.bracket() & d for b, d in zip(borders, drawn)])):
        at, margin = (b.position - b.below) / b.inside * len(rows), 2 + 2 * len(rows) ** 0.5
        for i in {max(0, int(at - margin)), min(len(rows) - 1, int(at + margin))} if rows else ():
            tests.append((b, rows[i], b.below))
            upto = b.bracket() & ~after(b.order, rows[i])
            counts += [F.count_if(upto), F.count_if(upto & ~equal(b.order, rows[i]))]
    if not counts:
        return False
    ranks = df.agg(*counts).first()
    for i, (b, row, below) in enumerate(tests):
        upto, before = below + ranks[2 * i], below + ranks[2 * i + 1]
        end = b.below + b.inside
        if before < b.position <= upto:
            b.row = row
        elif upto < b.position and upto > b.below:
            b.low, b.below, b.inside = row, upto, end - upto
        elif b.position <= before < end:
            b.high, b.inside = row, before - b.below
    return len({id(b) for b, *_ in tests}) == len(borders)


def border_rows(df: DataFrame, tiles: Mapping[str, tuple[int, Sequence[SortKey]]], total: int | None = None,
                held: int = HELD, sample: int = SAMPLE) -> dict[str, list[tuple]]:
    """For each name (tiles, order): keys of the last row of every tile but the last.

    ``df`` is read a few times (twice if it has at most ``held`` rows): give a written table. The keys inside the
    brackets are written when they are few, so later rounds read those alone. Rows equal in all keys
    are not parted, so give tie-breaks up to a unique key. Tiles beyond the number of rows have no border. Keys are
    numbers, text, booleans or dates.
    """
    kinds = df.select(*{k.col for _, order in tiles.values() for k in order}).limit(1).schema
    bad = [f.name for f in kinds if f.dataType.typeName() not in ("byte", "short", "integer", "long", "float", "double", "decimal", "string", "boolean", "date")]
    if bad:
        raise TypeError(f"order keys {bad}: only numbers, text, booleans and dates can be compared with border rows")
    total = df.count() if total is None else total
    borders = {}
    for name, (n, order) in tiles.items():
        q, r = divmod(total, n)
        ends = [t * q + min(t, r) for t in range(1, n)]
        borders[name] = [_Border(list(order), p, total) for p in dict.fromkeys(ends) if 0 < p < total]
    open_, turn, read = [b for bs in borders.values() for b in bs], 0, total
    while open_:
        ready = [b for b in open_ if b.inside <= held]
        # Borders of one order with the same bracket (a small table) share what is fetched.
        for b, rows in zip(ready, _fetch(df, ready, [b.bracket() for b in ready])):
            b.row = rows[b.position - b.below - 1]
        open_ = [b for b in open_ if b.row is None]
        if open_:
            turn += 1
            if not _shrink(df, open_, sample, turn):
                sample *= 2
            open_ = [b for b in open_ if b.row is None]
            left = sum(b.inside for b in open_)
            if open_ and KEPT * left <= read:
                df, read = materialize(_inside(df, open_), "brackets"), left
    return {n: [b.row for b in bs] for n, bs in borders.items()}


def ntiles(df: DataFrame, tiles: Mapping[str, tuple[int, Sequence[SortKey]]], **options) -> DataFrame:
    """``df`` with a column NTILE(n) OVER (ORDER BY order) for each name (n, order); see :func:`border_rows`."""
    borders = border_rows(df, tiles, **options)
    out = {}
    for name, (_, order) in tiles.items():
        tile = F.lit(1)
        for row in borders[name]:
            tile = tile + after(order, row).cast("int")
        out[name] = tile
    return df.withColumns(out)
