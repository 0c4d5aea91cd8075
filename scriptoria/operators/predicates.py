"""Conditions on persons, places and dates as people ask for them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from scriptoria.functions.dates import authority_date, display_date


def person(forename_of: Column, surname_of: Column, forename: str | None = None, surname: str | None = None, full: str | None = None) -> Column:
    """Any of: the forename, the surname (one letter: its first), a part of the full name; case does not count.

    Nothing asked for is nothing found.
    """
    given = []
    if forename:
        given.append(F.lower(forename_of) == forename.lower() if len(forename) > 1 else F.lower(F.left(forename_of, F.lit(1))) == forename.lower())
    if surname:
        given.append(F.lower(surname_of) == surname.lower() if len(surname) > 1 else F.lower(F.left(surname_of, F.lit(1))) == surname.lower())
    if full:
        given.append(F.lower(F.concat_ws(" ", forename_of, surname_of)).contains(full.lower()))
    return reduce(lambda a, b: a | b, given, F.lit(False))


def place(columns: dict[str, str], keyword: str | None = None, **given: str) -> Column:
    """All of the given fields equal, case aside; a keyword alone is the site. columns: field to column name."""
    asked = dict(given) or {"site": keyword}
    return reduce(lambda a, b: a & b, (F.lower(F.col(columns[k])) == str(v).lower() for k, v in asked.items() if v is not None), F.lit(True))


def dated(date: Column, keyword: str) -> Column:
    """The display form or the authority form is the keyword, or one part is its number."""
    number = F.lit(keyword).try_cast("int")
    parts = [F.coalesce(date[k] == number, F.lit(False)) for k in ("year", "month", "day")]
    return reduce(lambda a, b: a | b, parts, F.coalesce(display_date(date) == keyword, F.lit(False)) | F.coalesce(authority_date(date) == keyword, F.lit(False)))


def equal_where_given(**given) -> Column:
    """Conjunction of column == value for every value that is not None."""
    return reduce(lambda a, b: a & b, (F.col(c) == v for c, v in given.items() if v is not None), F.lit(True))
