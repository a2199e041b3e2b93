"""Column-level helpers: pure expressions, all JVM-side and codegen friendly."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bool_from_text(c: ColumnOrName) -> Column:
    """Text TRUE/FALSE (any case) to boolean, anything else NULL."""
    u = F.upper(F.trim(_c(c).cast("string")))
    return F.when(u == "TRUE", F.lit(True)).when(u == "FALSE", F.lit(False))


def null_tokens_to_null(c: ColumnOrName, tokens) -> Column:
    """Map any of several null tokens (and the empty string) to NULL."""
    col = _c(c)
    return F.when(col.isin(list(tokens)) | (col == ""), F.lit(None).cast("string")).otherwise(col)


def exact_sum(c: ColumnOrName, scale: int = 10) -> Column:
    """Sum computed exactly in decimal, returned as double. Values keep ``scale`` digits after the point.

    Double sums depend on the order rows arrive in; a decimal sum does not, so
    the same data always gives the same bits regardless of partitioning.
    """
    return F.sum(_c(c).cast(f"decimal(28,{scale})")).cast("double")


def mean_of(c: ColumnOrName, scale: int = 10) -> Column:
    """Order-independent mean: exact decimal sum / non-null count (NULL if none)."""
    col = _c(c)
    return F.try_divide(F.sum(col.cast(f"decimal(28,{scale})")).cast("double"),
                        F.count(col).cast("double"))


def safe_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """num / den, NULL when den is 0 or NULL (ANSI division would raise)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def range_bin_lower(c: ColumnOrName, width: int) -> Column:
    """Lower bound of the bin: floor(round_half_even(x) / width) * width.

    ``bround`` is banker's rounding like Python's ``round``; ``floor`` (not
    integer division) sends negatives downward.
    """
    return F.floor(F.bround(_c(c).cast("double"), 0) / F.lit(width)) * F.lit(width)


def range_bin_label(c: ColumnOrName, width: int, float_label: bool) -> Column:
    """"lo to hi" with hi = lo + width - 1.

    Float inputs print as ``40.0 to 49.0``; integer inputs as ``150000 to 159999``.
    -0.0 cannot occur because the lower bound is an integral floor.
    """
    lo = range_bin_lower(c, width)
    if float_label:
        lo_s = lo.cast("double").cast("string")
        hi_s = (lo + F.lit(width - 1)).cast("double").cast("string")
    else:
        lo_s = lo.cast("bigint").cast("string")
        hi_s = (lo + F.lit(width - 1)).cast("bigint").cast("string")
    return F.concat(lo_s, F.lit(" to "), hi_s)


def season(month: ColumnOrName) -> Column:
    """Quarter-of-year season ladder: <=3 Winter, <=6 Spring, <=9 Summer, else Fall."""
    m = _c(month)
    return (F.when(m <= 3, "Winter").when(m <= 6, "Spring").when(m <= 9, "Summer")
            .otherwise("Fall"))


def uri_segment(c: ColumnOrName, index: int) -> Column:
    """0-based ``index``-th '/'-separated segment, NULL when the URI is shorter."""
    return F.get(F.split(_c(c), "/"), index)


def month_name(c: ColumnOrName) -> Column:
    return F.date_format(_c(c), "MMMM")


def day_name(c: ColumnOrName) -> Column:
    return F.date_format(_c(c), "EEEE")


def table_name_from_file(c: ColumnOrName) -> Column:
    """File name -> valid lower-case table name.

    Drop the last extension, replace every char outside [A-Za-z0-9_] with '_',
    lower-case, and prefix ``table_`` when the result starts with a digit.
    """
    base = F.regexp_extract(_c(c), r"([^/]*)$", 1)
    # os.path.splitext rule: the last dot splits only if a non-dot precedes it.
    stem = F.regexp_replace(base, r"^(.*[^.].*)\.[^.]*$", "$1")
    clean = F.lower(F.regexp_replace(stem, r"[^a-zA-Z0-9_]", "_"))
    return F.when(clean.rlike(r"^[0-9]"), F.concat(F.lit("table_"), clean)).otherwise(clean)


def fresh(columns: Iterable[str], *names: str) -> list[str]:
    """The names, each with underscores in front until no column is called so (without regard to case)."""
    taken, out = {c.lower() for c in columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
