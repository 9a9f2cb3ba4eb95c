"""Sums and means that do not depend on the order in which rows arrive.

Adding doubles gives other last digits on every shuffle layout.  Prices and volumes are quoted with a
fixed number of decimals, so with `scale` set they are added as whole numbers of the smallest unit,
which is exact and stays in generated code.  Without `scale` the plain double aggregate is used.
"""

from pyspark.sql import Column, WindowSpec, functions as F


def _over(aggregate: Column, window: WindowSpec | None) -> Column:
    return aggregate if window is None else aggregate.over(window)


def whole_units(column: Column, scale: int) -> Column:
    """A measure with at most `scale` decimals as a whole number of its smallest unit."""
    return F.rint(column.cast("double") * float(10 ** scale)).cast("bigint")


def total(column: Column, scale: int | None = None, over: WindowSpec | None = None) -> Column:
    if scale is None:
        return _over(F.sum(column), over)
    return _over(F.sum(whole_units(column, scale)), over) / float(10 ** scale)


def mean(column: Column, scale: int | None = None, over: WindowSpec | None = None) -> Column:
    if scale is None:
        return _over(F.avg(column), over)
    # The sum of no values is NULL, so the count is never a zero divisor that matters.
    count = F.nullif(_over(F.count(column), over), F.lit(0))
    return total(column, scale, over) / count
