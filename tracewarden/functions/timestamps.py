"""Mixed-format time parsing.

Every format family is one anchored pattern that rearranges the text into ISO order;
the ISO text is then cast with ``try_cast``, whose parser yields null (no exception)
on impossible dates. Input is stripped text. No session time zone is involved: results are ``timestamp_ntz``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import lookup

# English month abbreviations in calendar order.
MONTHS = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")

_CLOCK = r"\d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?"
_TAIL = rf"(?:[ T]({_CLOCK}))?"


def _from_epoch(digits: Column) -> Column:
    zero = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return zero + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), digits.try_cast("decimal(18,6)"))


def _rearranged(c: Column, pattern: str, order: str) -> Column:
    return F.when(
        c.rlike(pattern), F.trim(F.regexp_replace(c, pattern, order)).try_cast("timestamp_ntz")
    )


def _month_name(c: Column, pattern: str) -> Column:
    """Day, month abbreviation, year and clock: groups 1 to 4 of ``pattern``."""
    month = F.upper(F.regexp_extract(c, pattern, 2))
    number = lookup(month, {name: f"{i:02d}" for i, name in enumerate(MONTHS, 1)})
    iso = F.concat(
        F.regexp_extract(c, pattern, 3), F.lit("-"), number, F.lit("-"),
        F.regexp_extract(c, pattern, 1), F.lit(" "), F.regexp_extract(c, pattern, 4),
    )
    return F.when(c.rlike(pattern), F.trim(iso).try_cast("timestamp_ntz"))


def _twelve_hour(c: Column, pattern: str, order: str) -> Column:
    """Groups 1-3 date parts, 4 hour (1-12), 5 minutes and seconds, 6 the A of AM or P of PM."""
    hour = F.regexp_extract(c, pattern, 4).try_cast("int")
    afternoon = F.upper(F.regexp_extract(c, pattern, 6)) == "P"
    clock = hour % 12 + F.when(afternoon, 12).otherwise(0)
    iso = F.concat(
        F.regexp_replace(c, pattern, order), F.lit(" "), clock.cast("string"),
        F.lit(":"), F.regexp_extract(c, pattern, 5),
    )
    return F.when(c.rlike(pattern) & hour.between(1, 12), iso.try_cast("timestamp_ntz"))


def _mark(c: Column, place: int) -> Column:
    """One character of a text: tells cheaply which families the text can belong to."""
    return F.substring(c, place, 1)


def _half_day_only(c: Column, time: Column) -> Column:
    return F.when(_mark(c, -1).isin("m", "M"), time)


def mixed_timestamp(c: Column) -> Column:
    """IAM and identity grammar: the families the sources use, day-first for slashes.

    A slash date that has no day-first reading is read month-first; dashed dates are
    month-first with a day-first second reading. Anything else is null ("unparsed").
    """
    slash = rf"^(\d{{2}})/(\d{{2}})/(\d{{4}}){_TAIL}$"
    loose = rf"^(\d{{1,2}})[-/](\d{{1,2}})[-/](\d{{4}}){_TAIL}$"
    named = rf"^(\d{{1,2}})-([A-Za-z]{{3}})-(\d{{4}}){_TAIL}$"
    half_day = r"^(\d{2})-(\d{2})-(\d{4}) (\d{1,2}):(\d{2}(?::\d{2})?) ?([AaPp])[Mm]$"
    third, fifth = _mark(c, 3), _mark(c, 5)
    # the character that ends the year or the day decides which patterns are worth trying
    return F.when(fifth == "-", F.coalesce(
        _rearranged(c, rf"^(\d{{4}})-(\d{{2}})-(\d{{2}}){_TAIL}$", "$1-$2-$3 $4"),
        _month_name(c, named), _rearranged(c, loose, "$3-$1-$2 $4"), _rearranged(c, loose, "$3-$2-$1 $4"),
    )).when(fifth == "/", F.coalesce(
        _rearranged(c, rf"^(\d{{4}})/(\d{{2}})/(\d{{2}}){_TAIL}$", "$1-$2-$3 $4"),
        _rearranged(c, loose, "$3-$1-$2 $4"), _rearranged(c, loose, "$3-$2-$1 $4"),
    )).when(third == "/", F.coalesce(
        _rearranged(c, slash, "$3-$2-$1 $4"), _rearranged(c, slash, "$3-$1-$2 $4"),
        _rearranged(c, loose, "$3-$1-$2 $4"), _rearranged(c, loose, "$3-$2-$1 $4"),
    )).otherwise(F.coalesce(
        F.when(c.rlike(r"^\d{10}$"), _from_epoch(c)),
        _month_name(c, named),
        _half_day_only(c, F.coalesce(_twelve_hour(c, half_day, "$3-$1-$2"), _twelve_hour(c, half_day, "$3-$2-$1"))),
        _rearranged(c, loose, "$3-$1-$2 $4"), _rearranged(c, loose, "$3-$2-$1 $4"),
    ))


def identity_timestamp(c: Column) -> Column:
    """The "no date" texts match no family, so they need no test of their own."""
    return mixed_timestamp(c)


def endpoint_timestamp(c: Column) -> Column:
    """Endpoint grammar: a fixed list of formats tried in order; one- or two-digit fields."""
    two = r"(\d{1,2})"
    clock = r"(\d{1,2}:\d{1,2}:\d{1,2})"
    short = r"(\d{1,2}:\d{1,2}(?::\d{1,2})?)"
    year_first = rf"^(\d{{4}})-{two}-{two}(?:(?:T|\s+){clock})?$"
    year_slash = rf"^(\d{{4}})/{two}/{two}(?:\s+{short})?$"
    slash = rf"^{two}/{two}/(\d{{4}})(?:\s+{short})?$"
    named = rf"^{two}-([A-Za-z]{{3}})-(\d{{4}})(?:\s+{short})?$"
    half_day = rf"^{two}-{two}-(\d{{4}})\s+{two}:(\d{{1,2}}(?::\d{{1,2}})?)\s+([AaPp])[Mm]$"
    dashed = F.substring(c, 2, 2).contains("-")
    return F.coalesce(
        F.when(c.rlike(r"^\d{10}(\.0)?$"), _from_epoch(F.substring(c, 1, 10))),
        F.when(_mark(c, 5) == "-", _rearranged(c, year_first, "$1-$2-$3 $4")),
        F.when(_mark(c, 5) == "/", _rearranged(c, year_slash, "$1-$2-$3 $4")),
        F.when(F.substring(c, 2, 2).contains("/"), F.coalesce(
            _rearranged(c, slash, "$3-$2-$1 $4"), _rearranged(c, slash, "$3-$1-$2 $4"))),
        F.when(dashed, _month_name(c, named)),
        F.when(dashed, _half_day_only(c, _twelve_hour(c, half_day, "$3-$1-$2"))),
    )


def firewall_timestamp(c: Column) -> Column:
    """Firewall grammar: fully anchored two-digit formats, no month-first second reading.

    All fields have fixed places, so one pattern checks a text and its pieces are cut by place. The
    separators after the day and the year tell the families apart.
    """
    def piece(start: int, length: int = 20) -> Column:
        return F.substring(c, start, length)

    def family(pattern: str, *iso: Column | str) -> Column:
        text = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in iso])
        return F.when(c.rlike(pattern), text.try_cast("timestamp_ntz"))

    clock = r"\d{2}:\d{2}:\d{2}"
    month = lookup(F.upper(piece(4, 3)), {name: f"{i:02d}" for i, name in enumerate(MONTHS, 1)})
    hour = piece(12, 2).try_cast("int")
    in_day = (hour % 12 + F.when(piece(21, 1) == "P", 12).otherwise(0)).cast("string")
    third, fifth = _mark(c, 3), _mark(c, 5)
    return (
        F.when(fifth == "-", family(rf"^\d{{4}}-\d{{2}}-\d{{2}}[ T]{clock}$", c))
        .when(third == "/", family(r"^\d{2}/\d{2}/\d{4}(?: \d{2}:\d{2})?$", piece(7, 4), "-", piece(4, 2), "-", piece(1, 2), piece(11)))
        .when(third == "-", F.coalesce(
            family(rf"^\d{{2}}-[A-Za-z]{{3}}-\d{{4}} {clock}$", piece(8, 4), "-", month, "-", piece(1, 2), piece(12)),
            F.when(hour.between(1, 12), family(
                rf"^\d{{2}}-\d{{2}}-\d{{4}} {clock} [AP]M$",
                piece(7, 4), "-", piece(1, 2), "-", piece(4, 2), " ", in_day, piece(14, 6)))))
        .when(fifth == "/", family(r"^\d{4}/\d{2}/\d{2}$", F.replace(c, F.lit("/"), F.lit("-"))))
        .otherwise(F.when(c.rlike(r"^\d{10}$"), _from_epoch(c)))
    )


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a naive time (the session time zone is UTC)."""
    return F.unix_micros(ts.cast("timestamp"))
