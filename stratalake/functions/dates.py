"""Date and timestamp parsing. Text that does not parse becomes null."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratalake.schemas import PRICE_TIMESTAMP_FORMAT

# --- fixed values: Portuguese month labels, January first --------------------
MONTH_LABELS = [
    "jan", "fev", "mar", "abr", "mai", "jun", "jul", "ago", "set", "out", "nov", "dez",
]
DAY_FIRST_FORMATS = ("d/M/yyyy", "d.M.yyyy", "d-M-yyyy", "yyyy-M-d")
SHORT_YEAR_FORMATS = ("d/M/yy", "d.M.yy", "d-M-yy")
# Two-digit years from here on are of the last century.
CENTURY_PIVOT = 69
TIME_OF_DAY = r"[ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?\s*$"


def month_label_date(label: Column) -> Column:
    """First day of the month named by ``mmm/yy``; the year is 20yy.

    Case does not matter. Any other shape, a four-digit year too, gives null.
    """
    numbers = [F.lit(part) for pair in zip(MONTH_LABELS, range(1, 13)) for part in pair]
    month = F.try_element_at(F.create_map(*numbers), F.lower(F.substring(label, 1, 3)))
    year = F.substring(label, 5, 2).try_cast("int") + 2000
    return F.when(
        label.rlike(r"\A[A-Za-z]{3}/[0-9]{2}\z"), F.make_date(year, month, F.lit(1))
    )


def month_label(date: Column) -> Column:
    """The ``mmm/yy`` label of a date."""
    labels = F.array(*[F.lit(label) for label in MONTH_LABELS])
    year = F.lpad((F.year(date) % 100).cast("string"), 2, "0")
    return F.concat(F.element_at(labels, F.month(date)), F.lit("/"), year)


def day_first_date(text: Column, formats: Sequence[str] = DAY_FIRST_FORMATS) -> Column:
    """Date from day-first text; the first format that fits wins.

    A time of day after the date is left out. A year of two digits is 1969 to
    1999 from 69 on and 2000 to 2068 below.
    """
    day = F.trim(F.regexp_replace(text, TIME_OF_DAY, ""))
    full = [F.try_to_date(day, fmt) for fmt in formats]
    short = F.coalesce(*[F.try_to_date(day, fmt) for fmt in SHORT_YEAR_FORMATS])
    last = F.when(F.year(short) % 100 >= CENTURY_PIVOT, F.add_months(short, -1200))
    return F.coalesce(*full, last, short)


def iso_date(text: Column) -> Column:
    return text.try_cast("date")


def iso_timestamp(text: Column) -> Column:
    return text.try_cast("timestamp")


def price_timestamp(text: Column, fmt: str = PRICE_TIMESTAMP_FORMAT) -> Column:
    return F.try_to_timestamp(text, F.lit(fmt))


def date_text(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")


def date_parts(date: Column) -> list[Column]:
    """``ano``, ``mes`` and ``dia`` of a date or timestamp."""
    return [
        F.year(date).alias("ano"),
        F.month(date).alias("mes"),
        F.dayofmonth(date).alias("dia"),
    ]


def month_start(year: str = "ano", month: str = "mes") -> Column:
    return F.make_date(F.col(year), F.col(month), F.lit(1))


def day_of(year: str = "ano", month: str = "mes", day: str = "dia") -> Column:
    return F.make_date(F.col(year), F.col(month), F.col(day))
