"""Partial dates: structs of year, month and day where null is unknown and years before Christ are negative."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from scriptoria.functions.text import bound

# Month names for display.
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"]
_ISO = r"^(-?\d{1,4})(?:-(\d{1,2}))?(?:-(\d{1,2}))?$"


def _int(text: Column) -> Column:
    return text.try_cast("int")


def partial_date(text: Column) -> Column:
    """year, year-month, year-month-day, or --month-day; two-digit years with a minus are of the last century."""
    century = F.when(F.rlike(text, F.lit(r"^-\d{2}(-|$)")), F.concat(F.lit("19"), F.substring(text, 2, 99))).otherwise(text)
    yearless = F.rlike(text, F.lit(r"^--\d{1,2}-\d{1,2}$"))
    part = lambda k: _int(F.regexp_extract(century, _ISO, k))
    bare = lambda k: _int(F.regexp_extract(text, r"^--(\d{1,2})-(\d{1,2})$", k))
    return F.struct(F.when(~yearless, part(1)).alias("year"), F.when(yearless, bare(1)).otherwise(part(2)).alias("month"), F.when(yearless, bare(2)).otherwise(part(3)).alias("day"))


def era_year(text: Column) -> Column:
    """The year of text such as 44 B.C. or A.D. 79: negative before Christ, null without digits."""
    year = _int(F.regexp_extract(text, r"(-?\d+)", 1))
    return F.when(F.rlike(F.replace(F.upper(text), F.lit("."), F.lit("")), F.lit(r"\bB ?CE?\b")), -F.abs(year)).otherwise(year)


def date_range(text: Column) -> Column:
    """start and end of a/b; a single date is both."""
    return F.struct(partial_date(F.split_part(text, F.lit("/"), F.lit(1))).alias("start"), partial_date(F.coalesce(F.try_element_at(F.split(text, "/"), F.lit(2)), text)).alias("end"))


def document_year(text: Column, widest: int = 20) -> Column:
    """The year of a text's date: the middle of a range of up to widest years, null for longer ones.

    The middle is cut towards zero, which matters for years before Christ.
    """
    first = _int(F.regexp_extract(text, r"^\s*(-?\d+)", 1))
    second = _int(F.regexp_extract(text, r"^\s*-?\d+\s*-\s*(-?\d+)", 1))
    before = F.rlike(F.replace(F.upper(text), F.lit("."), F.lit("")), F.lit(r"\bBCE?\b"))
    a, b = F.when(before, -F.abs(first)).otherwise(first), F.when(before, -F.abs(second)).otherwise(second)
    return F.when(b.isNull(), a).when(F.abs(b - a) <= widest, ((a + b) / 2).cast("int"))


def ordinal(n: Column) -> Column:
    last = F.when((n % 100).between(11, 13), "th").when(n % 10 == 1, "st").when(n % 10 == 2, "nd").when(n % 10 == 3, "rd").otherwise("th")
    return F.concat(n.cast("string"), last)


def authority_date(date: Column) -> Column:
    """Padded form such as 0079-08-24 or -0431; unknown parts end it."""
    y = F.concat(F.when(date["year"] < 0, "-").otherwise(""), F.lpad(F.abs(date["year"]).cast("string"), 4, "0"))
    m, d = F.lpad(date["month"].cast("string"), 2, "0"), F.lpad(date["day"].cast("string"), 2, "0")
    return F.when(date["month"].isNull(), y).when(date["day"].isNull(), F.concat_ws("-", y, m)).otherwise(F.concat_ws("-", y, m, d))


def display_date(date: Column) -> Column:
    """August 24th, 79 and the like, with B.C. for negative years."""
    month = F.element_at(F.array(*(F.lit(m) for m in MONTHS)), date["month"])
    year = F.concat(F.abs(date["year"]).cast("string"), F.when(date["year"] < 0, " B.C.").otherwise(""))
    return F.when(date["month"].isNull(), year).when(date["day"].isNull(), F.concat_ws(" ", month, year)).otherwise(F.concat(month, F.lit(" "), ordinal(date["day"]), F.coalesce(F.concat(F.lit(", "), year), F.lit(""))))


def is_valid(date: Column) -> Column:
    """Whether every known part is within its bounds."""
    return F.coalesce(date["month"].between(1, 12), F.lit(True)) & F.coalesce(date["day"].between(1, 31), F.lit(True))


def is_valid_time(hour: Column, minute: Column, second: Column, fraction: Column) -> Column:
    """Whether every known part of a time is within its bounds; -1 says that a part is not known, 24 and 60 are allowed."""
    bounds = [(hour, -1, 24), (minute, -1, 60), (second, -1, 60), (fraction, 0, 1)]
    out = F.lit(True)
    for part, low, high in bounds:
        out = out & F.coalesce(part.between(low, high), F.lit(True))
    return out


def within(date: Column, start: Column, end: Column) -> Column:
    """Lexicographic range test; missing parts are the first of a start and the last of an end."""

    def filled(d: Column, month: int, day: int) -> Column:
        return F.struct(d["year"], F.coalesce(d["month"], F.lit(month)), F.coalesce(d["day"], F.lit(day)))

    return (filled(date, 1, 1) >= filled(start, 1, 1)) & (filled(date, 12, 31) <= filled(end, 12, 31))


def padded_year(year: Column) -> Column:
    """-0431 or 0079, for sorted labels."""
    return F.concat(F.when(year < 0, "-").otherwise(""), F.lpad(F.abs(year).cast("string"), 4, "0"))


def free_date(text: Column) -> Column:
    """Dates as people type them: y, y era, -m, -y, m-d, y-m, -m-d, -y-m, y-m-d, --d and -y-m-d; else null.

    A number over 12 where a month could stand is a year before Christ after a leading minus, else a
    day after a month. Zero parts are unknown; a date without any part is null.
    """
    return bound(F.regexp_replace(F.trim(text), "-+$", ""), lambda bare: bound(_typed_parts(bare), _typed_date))


def _typed_parts(bare: Column) -> Column:
    part = lambda k: F.regexp_extract(bare, r"^(-{0,2})(\d+)(?:-(\d*))?(?:-(\d+))?$", k)
    era = F.replace(F.upper(F.regexp_extract(bare, r"^\d+\s*([A-Za-z.]+)$", 1)), F.lit("."), F.lit(""))
    return F.struct(part(1).alias("signs"), _int(part(2)).alias("a"), _int(part(3)).alias("b"), _int(part(4)).alias("c"), era.alias("era"), _int(F.regexp_extract(bare, r"^(\d+)\s*[A-Za-z.]+$", 1)).alias("named"))


def _typed_date(parts: Column) -> Column:
    signs, a, b, c, era, named = (parts[k] for k in ("signs", "a", "b", "c", "era", "named"))
    plain, late = signs == "", a > 12
    month_first = plain & c.isNull() & (b > 12)
    year = F.when(era != "", F.when(era.isin("BC", "BCE"), -named).otherwise(named)).when(plain & ~F.coalesce(month_first, F.lit(False)), a).when((signs == "-") & (late | c.isNotNull()), -a)
    month = F.when(month_first, a).when(plain, b).when((signs == "-") & (late | c.isNotNull()), b).when(signs == "-", a)
    day = F.when(month_first, b).when(plain, c).when((signs == "-") & c.isNotNull(), c).when((signs == "-") & ~late, b).when((signs == "--") & b.isNull() & c.isNull(), a)
    known = F.struct(*(F.when(x != 0, x).alias(n) for n, x in (("year", year), ("month", month), ("day", day))))
    return bound(known, lambda d: F.when(F.coalesce(d["year"], d["month"], d["day"]).isNotNull(), d))


def timestamped(text: Column) -> Column:
    """date, hour, minute, second and fraction of an ISO date with a time; parts that are missing are null.

    The fraction follows a comma or a full stop.
    """
    time = F.split_part(text, F.lit("T"), F.lit(2))
    pattern = r"^(\d{1,2})(?::(\d{2}))?(?::(\d{2}))?(?:[.,](\d+))?"
    part = lambda k: F.regexp_extract(time, pattern, k)
    fraction = F.when(part(4) != "", F.concat(F.lit("0."), part(4)).try_cast("double"))
    return F.struct(partial_date(F.split_part(text, F.lit("T"), F.lit(1))).alias("date"), _int(part(1)).alias("hour"), _int(part(2)).alias("minute"), _int(part(3)).alias("second"), fraction.alias("fraction"))


def compared(a: Column, b: Column) -> Column:
    """-1, 0 or 1 as a is before, like or after b, field by field; unknown parts come first."""
    one = F.struct(*(F.coalesce(a[k], F.lit(-(1 << 31))) for k in ("year", "month", "day")))
    two = F.struct(*(F.coalesce(b[k], F.lit(-(1 << 31))) for k in ("year", "month", "day")))
    return F.when(one < two, -1).when(one > two, 1).otherwise(0)
