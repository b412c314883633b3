"""Scalar formatting functions (X1, X2) and text predicates (F4 helpers)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType

# Characters that split words for word matching: anything that is neither a
# letter nor a digit, in any script.
WORD_SPLIT = r"[^\p{L}\p{N}]+"


def round_half_even(col: Column, places: int) -> Column:
    """Round a double to ``places`` decimals, half to even on the scaled value.

    ``rint(x * 10^n) / 10^n`` is the numpy rule; ``bround`` rounds the exact
    decimal expansion instead and differs on values such as ``2.675``. From
    2^52 on a double is a whole number and stays as it is.
    """
    scale = float(10 ** places)
    return F.when(F.abs(col) < F.lit(float(1 << 52)), F.rint(col * F.lit(scale)) / F.lit(scale)).otherwise(col)


def round_floats(df: DataFrame, places: int | None) -> DataFrame:
    """Round every float/double column of ``df`` (X1); other columns untouched."""
    if places is None:
        return df
    float_cols = {f.name for f in df.schema.fields
                  if isinstance(f.dataType, (DoubleType, FloatType))}
    if not float_cols:
        return df
    return df.select([
        round_half_even(F.col(f"`{c}`").cast("double"), places).alias(c) if c in float_cols
        else F.col(f"`{c}`")
        for c in df.columns
    ])


def decimal_mark(col: Column, mark: str = ",") -> Column:
    """Text of a number with ``mark`` as decimal separator (X2), for writing."""
    text = col.cast("string")
    return text if mark == "." else F.replace(text, F.lit("."), F.lit(mark))


def parse_decimal_mark(col: Column, mark: str = ",", dtype: DataType | str = "double") -> Column:
    """Number from text written with ``mark`` as decimal separator (S3).

    An empty cell is NULL; text that is no such number raises, also with ANSI mode off.
    """
    text = col if mark == "." else F.replace(col, F.lit(mark), F.lit("."))
    if mark != ".":  # a dot is not this file's decimal mark
        text = F.when(~F.contains(col, F.lit(".")), text).when(col.isNotNull(), F.lit("?"))
    number = text.try_cast(dtype)
    filled = col.isNotNull() & (F.trim(col) != "")
    bad = F.raise_error(F.concat(F.lit("not a number: "), col)).cast(dtype)
    return F.when(filled & number.isNull(), bad).otherwise(number)


def word_match(col: Column, word: str) -> Column:
    """True where ``word`` is one of the words of the text (case-insensitive).

    Words are the runs of letters and digits. A word made of letters and
    digits only is matched with one regular expression over the whole text
    (no array is built per row); other words fall back to splitting.
    """
    w = word.lower()
    if w and re.fullmatch(r"\w+", w) and "_" not in w:
        pattern = r"(?<![\p{L}\p{N}])" + re.escape(w) + r"(?![\p{L}\p{N}])"
        return F.coalesce(F.lower(col).rlike(pattern), F.lit(False))
    return F.coalesce(F.array_contains(F.split(F.lower(col), WORD_SPLIT), F.lit(w)),
                      F.lit(False))


def keyword_match(col: Column, value) -> Column:
    """Exact match on a keyword field."""
    return F.coalesce(col == F.lit(value), F.lit(False))
