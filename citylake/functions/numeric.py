"""Rounding, clipping, lenient casts and order-independent means."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def np_round(c: Column | str, digits: int = 0) -> Column:
    """Half-to-even on the scaled double, as numpy rounds a column."""
    if digits == 0:
        return F.rint(_col(c))
    scale = float(10**digits)
    return F.rint(_col(c) * scale) / scale


def clip(c: Column | str, low: float | None = None, high: float | None = None) -> Column:
    """Bound a value; NULL stays NULL (`greatest` alone would turn it into the bound)."""
    value = _col(c)
    bounded = value
    if low is not None:
        bounded = F.greatest(bounded, F.lit(low))
    if high is not None:
        bounded = F.least(bounded, F.lit(high))
    return F.when(value.isNotNull(), bounded)


def lenient_int(c: Column | str, to: str = "int") -> Column:
    """Text or number to a rounded integer; anything unreadable becomes NULL."""
    return F.rint(_col(c).try_cast("double")).try_cast(to)


def lenient_date(c: Column | str) -> Column:
    return _col(c).try_cast("date")


def date_or_constant(df: DataFrame, column: str, constant: str) -> Column:
    """The column as a date, or one date for all rows where the table lacks the column."""
    return lenient_date(column) if column in df.columns else F.lit(constant).cast("date")


def lenient_timestamp(c: Column | str) -> Column:
    """Mixed ISO forms to a UTC timestamp cut to the second."""
    return F.date_trunc("second", F.try_to_timestamp(_col(c)))


def null_to_false(c: Column | str) -> Column:
    return F.coalesce(_col(c), F.lit(False))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN means "missing" in the data model; SQL functions only skip NULL."""
    floating = {
        f.name: F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.FloatType, T.DoubleType))
    }
    return df.withColumns(floating) if floating else df


def exact_mean(c: Column | str, digits: int) -> Column:
    """Mean of a metric already rounded to `digits` decimals.

    Summing scaled integers makes the result independent of task order and
    retries, which a sum of doubles is not.
    """
    scale = 10**digits
    total = F.sum(F.rint(_col(c) * float(scale)).cast("bigint"))
    return F.try_divide(total.cast("double"), (F.count(_col(c)) * scale).cast("double"))


def share_of(condition: Column) -> Column:
    """Percentage of rows for which the condition holds (NULL counts as no)."""
    return F.count_if(condition).cast("double") / F.count(F.lit(1)).cast("double") * 100.0


def lookup(key: Column | str, table: dict, default=None) -> Column:
    """Constant map access; a missing key gives the default."""
    pairs = [F.lit(x) for item in table.items() for x in item]
    found = F.try_element_at(F.create_map(*pairs), _col(key))
    return found if default is None else F.coalesce(found, F.lit(default))


def proportional_counts(total: Column | str, shares: dict[str, float], prefix: str = "cnt_") -> list[Column]:
    """Split an integer total by fixed shares; the last class takes what is left, at least 0."""
    names = list(shares)
    amount = _col(total)
    parts = [np_round(amount * shares[name]).cast("int") for name in names[:-1]]
    taken = sum(parts[1:], parts[0])
    rest = F.when(amount.isNotNull(), F.greatest(amount - taken, F.lit(0)).cast("int"))
    return [p.alias(prefix + n) for n, p in zip(names, [*parts, rest])]
