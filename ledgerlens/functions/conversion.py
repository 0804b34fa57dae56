"""Text clean-up and strict type conversion for staged columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions.calendar import lenient_date

# CSV cells with exactly this text are NULL, in string columns too.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)

# Java's parser would also take "1.5d", "2f" and hex floats, so the accepted text is spelled out.
NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity)\s*\z"


def null_tokens(name: str) -> Column:
    """The text column `name` without its null tokens; one SQL expression instead of a literal per token."""
    column = "`" + name.replace("`", "``") + "`"
    listed = ", ".join(f"'{token}'" for token in NULL_TOKENS)
    return F.expr(f"CASE WHEN {column} NOT IN ({listed}) THEN {column} END").alias(name)


def strict_double(text: Column, name: str) -> Column:
    """Text to double; text that is no number fails the job, in ANSI mode or not."""
    complaint = F.concat(F.lit(f"column {name} is not a number: "), text)
    return F.when(text.rlike(NUMBER), text.try_cast("double")).when(
        text.isNotNull(), F.raise_error(complaint).cast("double")
    )


def nan_to_null(number: Column) -> Column:
    return F.nanvl(number, F.lit(None).cast("double"))


def text_to(field: T.StructField, text: Column) -> Column:
    """Text column to the declared type of `field`."""
    if isinstance(field.dataType, T.StringType):
        return text
    if isinstance(field.dataType, T.DoubleType):
        return nan_to_null(strict_double(text, field.name))
    if isinstance(field.dataType, T.DateType):
        return lenient_date(text)
    raise TypeError(f"no text conversion to {field.dataType.simpleString()} for {field.name}")


def family(kind: T.DataType) -> str:
    """The type a column of JSON values is staged as: 64-bit integer, double, boolean or text."""
    if isinstance(kind, T.IntegralType):
        return "bigint"
    if isinstance(kind, (T.FractionalType, T.DecimalType)):
        return "double"
    return "boolean" if isinstance(kind, T.BooleanType) else "string"
