"""Lenient numeric casts and NULL-safe arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seasonline.functions.html import bind

# What counts as a number. Spark alone would also take type suffixes such as "1.0d" and "1f".
NUMBER_PATTERN = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)\s*$"
WHOLE_PATTERN = r"^\s*[+-]?\d+(\.0*)?\s*$"


def number(text: Column) -> Column:
    """``text`` as a double; NULL where it is not a number (also for NaN)."""
    return F.when(text.rlike(NUMBER_PATTERN), text.try_cast("double"))


def whole_number(text: Column) -> Column:
    """``text`` such as ``2010.0`` or ``7`` as an int; NULL where it is not a whole number."""
    return F.when(text.rlike(WHOLE_PATTERN), text.try_cast("double").try_cast("int"))


def float_text(value: Column) -> Column:
    """A double in float notation: the shortest digits, an exponent only below 0.0001 and from 1e16 on."""

    def written(text: Column) -> Column:
        mantissa, exponent = F.split_part(text, F.lit("E"), F.lit(1)), F.split_part(text, F.lit("E"), F.lit(2))
        power = exponent.try_cast("int")
        plain = F.rtrim(text.try_cast("decimal(38,20)").cast("string"), F.lit("0"))
        scientific = F.concat(
            F.regexp_replace(mantissa, r"\.0$", ""),
            F.when(power < 0, "e-").otherwise("e+"),
            F.lpad(F.abs(power).cast("string"), F.greatest(F.length(F.abs(power).cast("string")), F.lit(2)), "0"),
        )
        return (
            F.when(text.endswith("y"), F.replace(text, F.lit("Infinity"), F.lit("inf")))
            .when(text.endswith("N"), F.lit("nan"))
            # Most numbers have no exponent and are written as they are.
            .when(~F.contains(text, F.lit("E")), text)
            .when(power.between(-4, 15), F.concat(plain, F.when(F.endswith(plain, F.lit(".")), "0").otherwise("")))
            .otherwise(scientific)
        )

    return bind(value.cast("string"), written)


def present(value: Column) -> Column:
    """True for a usable number: neither NULL nor NaN."""
    return value.isNotNull() & ~F.isnan(value)


def ratio(numerator: Column, denominator: Column) -> Column:
    """The quotient, or NULL where the denominator is zero or missing."""
    return F.try_divide(numerator, denominator)


def positive_log(value: Column) -> Column:
    """Natural logarithm; NULL where it is undefined."""
    return F.when(value > 0, F.log(value))
