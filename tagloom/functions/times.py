"""Date and time functions as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.functions.text import as_col

# ---- fixed values: strftime directives and the Spark pattern letters -------
DIRECTIVES = {
    "%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss", "%f": "SSSSSS",
    "%y": "yy", "%b": "MMM", "%B": "MMMM", "%j": "DDD", "%I": "hh", "%p": "a", "%a": "E", "%A": "EEEE", "%%": "'%'",
}

# ---- fixed values: step names and the interval they stand for --------------
STEPS = {
    "S": "INTERVAL '1' SECOND", "s": "INTERVAL '1' SECOND", "min": "INTERVAL '1' MINUTE", "T": "INTERVAL '1' MINUTE",
    "H": "INTERVAL '1' HOUR", "h": "INTERVAL '1' HOUR", "D": "INTERVAL '1' DAY", "W": "INTERVAL '7' DAY",
}


def spark_pattern(strftime_format: str) -> str:
    """Turn ``%Y-%m`` style formats into Spark datetime patterns."""
    out, i = [], 0
    while i < len(strftime_format):
        piece = strftime_format[i : i + 2]
        if piece in DIRECTIVES:
            out.append(DIRECTIVES[piece])
            i += 2
        else:
            char = strftime_format[i]
            out.append(f"'{char}'" if char.isalpha() else char)
            i += 1
    return "".join(out)


def parse_time(col: Column | str, fmt: str = "%Y-%m-%d %H:%M:%S.%f") -> Column:
    return F.to_timestamp_ntz(as_col(col), F.lit(spark_pattern(fmt)))


def format_time(col: Column | str, fmt: str = "%Y-%m") -> Column:
    return F.date_format(as_col(col), spark_pattern(fmt))


def to_date(col: Column | str) -> Column:
    return as_col(col).cast("date")


def trailing_week(day: Column | str) -> Column:
    """The seven days that end on ``day``, as text."""
    d = to_date(day)
    return F.transform(F.sequence(F.date_sub(d, 6), d), lambda x: x.cast("string"))


def month_start(col: Column | str) -> Column:
    return F.trunc(to_date(col), "MM")


def last_month_days(col: Column | str) -> Column:
    """Every day of the month before ``col``, as text."""
    first = month_start(col)
    return F.transform(F.sequence(F.add_months(first, -1), F.date_sub(first, 1)), lambda x: x.cast("string"))


def time_range(start: Column | str, periods: int = 300, freq: str = "S") -> Column:
    """``periods`` instants from ``start``, one ``freq`` apart."""
    step = F.expr(STEPS[freq])
    begin = as_col(start).cast("timestamp_ntz")
    return F.sequence(begin, begin + step * F.lit(periods - 1), step)


def now(fmt: str = "%Y-%m-%d %H:%M:%S:%f") -> Column:
    return F.date_format(F.current_timestamp(), spark_pattern(fmt))
