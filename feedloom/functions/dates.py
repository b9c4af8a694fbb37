"""Date columns. All instants are formatted in UTC; the session zone must be UTC.

A date text is first rewritten to `year-month-day hour:minute:second|zone` by a chain of
regular expressions and then parsed once, which keeps the expressions small.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from feedloom import vocab
from feedloom.functions.core import col, map_get
from feedloom.functions.text import clean_text

ISO_Z = "yyyy-MM-dd'T'HH:mm:ss'Z'"

_MONTH = (
    "(" + "|".join(m[:3] for m in vocab.MONTHS) + ")"
    "(?:" + "|".join(m[3:] for m in vocab.MONTHS if m[3:]) + ")?"
)
_CLOCK = r"(\d{1,2}):(\d{2})(?::(\d{2}))?(?:\s*([+-]\d{4})|\s+([A-Za-z]+))?(?:\s*\(.*\))?$"

# Mail-style dates: optional weekday, day and month in either order, year, time, zone.
_MAIL = (
    (rf"^(?:[A-Za-z]+,?\s*)?(\d{{1,2}})[ -]{_MONTH}[ -](\d{{4}}|\d{{2}})\s+" + _CLOCK, "$3-$2-$1 $4:$5:$6|$7$8"),
    (rf"^(?:[A-Za-z]+,\s*)?{_MONTH} (\d{{1,2}}),? (\d{{4}}|\d{{2}})\s+" + _CLOCK, "$3-$1-$2 $4:$5:$6|$7$8"),
)
# Calendar dates without a time: year first, and with a month name.
_NUMERIC = (
    (r"^(\d{4})([-/])(\d{1,2})\2(\d{1,2})$", "$1-$3-$4 0:0:0|"),
    (r"^(\d{4})-(\d{1,2})$", "$1-$2-1 0:0:0|"),
    (r"^(\d{4})$", "$1-1-1 0:0:0|"),
)
_NAMED = (
    (r"^(\d{1,2}) (" + "|".join(m[:3] for m in vocab.MONTHS) + r") (\d{4})$", "$3-$2-$1 0:0:0|"),
    (rf"^{_MONTH} (\d{{1,2}}), (\d{{4}})$", "$3-$1-$2 0:0:0|"),
)
_ISO_TIME = (
    (
        r"^(\d{4})-?(\d{2})-?(\d{2})[^\d](\d{2})(?::?(\d{2})(?::?(\d{2})(?:[.,]\d+)?)?)?(Z|[+-]\d{2}(?::?\d{2})?)?$",
        "$1-$2-$3 $4:$5:$6|$7",
    ),
)
_ISO_DAY = ((r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3 0:0:0|"),)
# Two-digit years, and missing minutes or seconds.
_TIDY = (
    (r"^([0-6]\d)-", "20$1-"),
    (r"^(\d\d)-", "19$1-"),
    (r":(?=[:|])", ":0"),
)


def _rewrite(text: Column, *groups) -> Column:
    for rules in groups:
        for pattern, form in rules:
            text = F.regexp_replace(text, "(?i)" + pattern, form)
    return text


def _rewritten(text: Column, with_time, year_first) -> Column:
    """Only the rules that fit the look of the text are tried."""
    return (
        F.when(text.contains(":"), _rewrite(text, with_time, _TIDY))
        .when(text.rlike("^[0-9]{4}"), _rewrite(text, year_first))
        .otherwise(_rewrite(text, _NAMED))
    )


def _wall_clock(rewritten: Column) -> Column:
    """Timestamp as written, before the zone is applied."""
    stamp = F.substring_index(rewritten, "|", 1)
    return F.when(
        rewritten.rlike(r"^[0-9]+-[0-9]+-[0-9]+ [0-9:]+[|]"),
        F.try_to_timestamp(stamp, F.lit("yyyy-M-d H:m:s")),
    ).when(
        rewritten.contains("|"),
        F.try_to_timestamp(stamp, F.lit("yyyy-MMM-d H:m:s")),
    )


def _zone_minutes(rewritten: Column) -> Column:
    """Minutes east of UTC; unknown or missing zones count as UTC."""
    zone = F.upper(F.substring_index(rewritten, "|", -1))
    number = F.regexp_replace(F.replace(zone, F.lit(":"), F.lit("")), r"^([+-]\d{2})$", "${1}00")
    number = number.try_cast("int")
    hours = (number / 100).cast("int")
    return F.coalesce(
        map_get(vocab.ZONE_MINUTES, zone), hours * 60 + (number - hours * 100), F.lit(0)
    )


def parse_release_date(c: Column | str) -> Column:
    """Calendar day as written, without shifting it to UTC. ISO date-times give NULL."""
    return F.to_date(_wall_clock(_rewritten(clean_text(c), _MAIL, _NUMERIC)))


def parse_published(c: Column | str) -> Column:
    """Instant in UTC at second precision: ISO, then mail style, then plain dates."""
    rewritten = _rewritten(clean_text(c), _ISO_TIME + _MAIL, _ISO_DAY + _NUMERIC)
    return F.timestamp_seconds(
        F.unix_timestamp(_wall_clock(rewritten)) - _zone_minutes(rewritten) * 60
    )


def iso_z(c: Column) -> Column:
    return F.date_format(c, ISO_Z)


def iso_offset(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def epoch_ms_date(c: Column | str) -> Column:
    """UTC calendar day of a millisecond count."""
    return F.to_date(F.timestamp_millis(F.floor(col(c).try_cast("double")).cast("long")))


def release_from_days(run_date: Column, days: Column | str) -> Column:
    """Day of release from a count of days in release, where day 1 is the release day."""
    count = F.regexp_replace(F.trim(col(days)), ",", "").try_cast("int")
    return F.date_sub(run_date, count - 1)
