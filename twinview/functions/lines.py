"""Tab-separated click lines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WHOLE_NUMBER = r"^[+-]?[0-9]+$"


def line_fields(value: Column | str) -> Column:
    """Fields of a line. The line end and trailing empty fields do not count, inner ones do."""
    value = F.col(value) if isinstance(value, str) else value
    without_end = F.rtrim(value, F.lit("\r\n"))
    return F.split(F.rtrim(without_end, F.lit("\t")), "\t", -1)


def epoch_ms(text: Column, strict: bool = False) -> Column:
    """Text as LONG. What is no whole number becomes NULL or, if strict, fails the query."""
    number = F.when(text.rlike(WHOLE_NUMBER), text.try_cast("long"))
    if not strict:
        return number
    message = F.concat(F.lit("not an epoch-ms timestamp: "), text)
    return F.coalesce(number, F.raise_error(message).cast("long"))


def tab_line(*columns: Column) -> Column:
    """One line out of columns; NULL is written as an empty field."""
    return F.concat_ws("\t", *(F.coalesce(c.cast("string"), F.lit("")) for c in columns))
