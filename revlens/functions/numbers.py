"""Correctly rounded decimal text from doubles.

``printf``-style formatting in the JVM rounds the shortest decimal form half up, while the
published texts round the exact binary value half to even. The product ``x * 10**places`` is
therefore computed together with its rounding error (Dekker's product), and the error decides ties.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = 134217729.0  # 2**27 + 1


def _scaled(value: Column, places: int) -> Column:
    factor = float(10**places)
    product = value * F.lit(factor)
    wide = value * F.lit(_SPLIT)
    high = wide - (wide - value)
    error = (high * F.lit(factor) - product) + (value - high) * F.lit(factor)
    near = F.rint(product)
    gap = product - near
    return (
        F.when((gap == 0.5) & (error > 0), near + 1.0)
        .when((gap == -0.5) & (error < 0), near - 1.0)
        .otherwise(near)
    )


def round_exact(value: Column, places: int) -> Column:
    """Round a double to ``places`` decimals, ties judged on the exact binary value."""
    return _scaled(value.cast("double"), places) / F.lit(float(10**places))


def fixed(value: Column, places: int) -> Column:
    """Text with exactly ``places`` (>= 1) decimals; NULL stays NULL."""
    value = value.cast("double")
    units = F.abs(_scaled(value, places).cast("bigint"))
    base = F.lit(10**places).cast("bigint")
    whole = F.floor(units / base)
    return F.concat(
        F.when(value < 0, "-").otherwise(""),
        whole.cast("string"),
        F.lit("."),
        F.lpad((units % base).cast("string"), places, "0"),
    )


def percent(value: Column, places: int = 1) -> Column:
    """0.123 -> '12.3%'."""
    return F.concat(fixed(value.cast("double") * F.lit(100.0), places), F.lit("%"))


def signed(value: Column) -> Column:
    """Whole number with an explicit sign."""
    return F.concat(F.when(value < 0, "").otherwise("+"), value.cast("string"))


def byte_text(size: Column) -> Column:
    """Bytes in the largest unit up to TB whose value stays under 1024, one decimal."""
    size = size.cast("double")
    text = F.concat(fixed(size / float(1024**4), 1), F.lit(" TB"))
    for power, unit in ((3, "GB"), (2, "MB"), (1, "KB"), (0, "B")):
        text = F.when(
            size < float(1024 ** (power + 1)),
            F.concat(fixed(size / float(1024**power), 1), F.lit(f" {unit}")),
        ).otherwise(text)
    return text
