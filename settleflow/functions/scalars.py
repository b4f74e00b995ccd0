"""Column expressions shared by the jobs. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def if_null(first: Column, fallback, as_type: str) -> Column:
    """``first`` or ``fallback``, in the declared type of ``first``."""
    value = fallback if isinstance(fallback, Column) else F.lit(fallback)
    return F.coalesce(first, value).cast(as_type)


def money(value: Column) -> Column:
    return value.cast("decimal(16,2)")


def join_text(*parts: Column) -> Column:
    """Concatenation in which a missing part counts as empty text."""
    return F.concat(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts])


def zero_pad(number: Column, width: int) -> Column:
    """Left-pad with zeros; longer numbers stay whole (plain ``lpad`` would cut them)."""
    text = number.cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def code_part(code: Column, from_right: int) -> Column:
    """Dash-separated part counted from the right; NULL beyond four parts or when missing."""
    parts = F.split(code, "-")
    size = F.size(parts)
    usable = (size <= 4) & (size >= from_right)
    return F.when(usable, F.element_at(parts, F.lit(-from_right)))


def code_part_int(code: Column, from_right: int) -> Column:
    return code_part(code, from_right).try_cast("int")


def due_date(start: Column, days: int = 15, working_days: bool = False) -> Column:
    """Payment deadline of a bill.

    The default is the closed form the billing desk uses: ``days`` plus two per full working
    week, plus one when the start weekday (Sunday = 1) pushes past Saturday or is a Friday with
    no remainder. ``working_days=True`` counts Monday-to-Friday days instead.
    """
    day = start.cast("date")
    weekday = F.dayofweek(day)
    rest = (days - 1) % 5
    if not working_days:
        push = F.when(weekday + F.lit(rest) >= 7, 1)
        if rest == 0:
            push = push.when(weekday == 6, 1)
        return F.date_add(day, (F.lit(days + (days - 1) // 5 * 2) + push.otherwise(0)).cast("int"))
    # move a weekend start back to Friday, then count whole weeks and a remainder
    back = F.when(weekday == 1, 2).when(weekday == 7, 1).otherwise(0)
    from_monday = F.when((weekday == 1) | (weekday == 7), 4).otherwise(weekday - 2)
    extra = F.when(from_monday + F.lit(days % 5) > 4, 2).otherwise(0)
    return F.date_add(day, (F.lit(days // 5 * 7 + days % 5) + extra - back).cast("int"))


def buddhist_year2(day: Column) -> Column:
    """Last two digits of the Buddhist-era year."""
    return zero_pad((F.year(day) + 543) % 100, 2)


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def is_midnight(moment: Column) -> Column:
    """True when no time of day was given."""
    return F.date_format(moment, "HH:mm:ss") == "00:00:00"


def link_token(code: Column) -> Column:
    """Base64 of a code, for deep links."""
    return F.base64(code.cast("binary"))


def messages(*pairs: tuple[Column, Column | str], sep: str = ", ") -> Column:
    """Text of all rules that hold, in the given order; empty when none does."""
    found = [F.when(test, text if isinstance(text, Column) else F.lit(text)) for test, text in pairs]
    return F.array_join(F.array_compact(F.array(*found)), sep)


def first_message(*pairs: tuple[Column, str]) -> Column:
    """Text of the first rule that holds; NULL when none does."""
    chosen = None
    for test, text in pairs:
        chosen = F.when(test, F.lit(text)) if chosen is None else chosen.when(test, F.lit(text))
    return chosen


def flag(test: Column) -> Column:
    """1 when the test holds, otherwise 0 (also for NULL)."""
    return F.when(test, 1).otherwise(0)
