"""String functions (STR1-STR5) as built-in column expressions (no Python UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabwright.functions.fixed import DIGITS_PATTERN, TITLE_PATTERN


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def qcol(name: str) -> Column:
    """Column by exact name, also when the name holds dots (``family_survival_0.5``)."""
    return F.col("`" + name.replace("`", "``") + "`")


def first_char(c) -> Column:
    """First character; null stays null."""
    return F.substring(_c(c), 1, 1)


def extract_or_null(c, pattern: str, group: int = 1) -> Column:
    """Regex group, null when nothing matches (Spark's ``regexp_extract`` returns '')."""
    return F.nullif(F.regexp_extract(_c(c), pattern, group), F.lit(""))


def first_digits(c) -> Column:
    """First run of digits as text (``A/5 21171`` -> ``5``), null when there is none."""
    return extract_or_null(c, DIGITS_PATTERN)


def last_digits(c) -> Column:
    """Last run of digits (``A/5 21171`` -> ``21171``): the ticket number proper."""
    return extract_or_null(c, r"([0-9]+)[^0-9]*$")


def honorific(c, pattern: str = TITLE_PATTERN) -> Column:
    """Honorific from ``Surname, Title. Given``: letters between a space and a full stop."""
    return extract_or_null(c, pattern)


def before_first(c, sep: str = ",", trim: bool = False) -> Column:
    """Text before the first ``sep`` (the whole text when absent), optionally trimmed."""
    head = F.substring_index(_c(c), sep, 1)
    return F.trim(head) if trim else head
