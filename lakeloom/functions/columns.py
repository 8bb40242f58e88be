"""Column functions with the null and error rules of warehouse SQL. Every function that needs "now" takes `as_of`."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

Cols = Column | str


def _c(x: Cols) -> Column:
    return F.col(x) if isinstance(x, str) else x


# Conversion and arithmetic.


def safe_cast(x: Cols, kind: str) -> Column:
    """Null instead of an error."""
    return _c(x).try_cast(kind)


def safe_divide(a: Cols, b: Cols) -> Column:
    return F.try_divide(_c(a), _c(b))


def greatest_strict(*xs: Cols) -> Column:
    """Null if any argument is; Spark's own greatest skips nulls."""
    return F.when(_all_known(xs), F.greatest(*map(_c, xs)))


def least_strict(*xs: Cols) -> Column:
    return F.when(_all_known(xs), F.least(*map(_c, xs)))


def _all_known(xs: tuple[Cols, ...]) -> Column:
    known = F.lit(True)
    for x in xs:
        known = known & _c(x).isNotNull()
    return known


def div(a: Cols, b: Cols) -> Column:
    """Whole division toward zero, null where b is zero."""
    return F.try_divide(_c(a) - F.try_mod(_c(a), _c(b)), _c(b)).cast("long")


def readable_size(n: Cols) -> Column:
    """Bytes as text in B, KB, MB, GB or TB, two decimals above B; each unit is 1024 of the one before."""
    n = _c(n)
    out = F.format_string("%d B", n.cast("long"))
    for power, unit in ((1, "KB"), (2, "MB"), (3, "GB"), (4, "TB")):
        out = F.when(n >= 1024**power, F.format_string(f"%.2f {unit}", n / float(1024**power))).otherwise(out)
    return F.when(n.isNotNull(), out)


def distance_km(lon_a: Cols, lat_a: Cols, lon_b: Cols, lat_b: Cols) -> Column:
    """Great-circle distance of two points in degrees, in km with two decimals."""
    a, b = F.radians(_c(lat_a)), F.radians(_c(lat_b))
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(_c(lon_b) - _c(lon_a)) / 2), 2)
    return F.round(F.asin(F.sqrt(F.least(h, F.lit(1.0)))) * (2 * 6371.0), 2)


def fail_if(condition: Column, message: str, value: Column) -> Column:
    """`value`, or an error with `message` where the condition holds."""
    return F.when(condition, F.raise_error(F.lit(message))).otherwise(value)


# Text.


def extract(text: Cols, pattern: str, group: int = 0) -> Column:
    """The match, or null where there is none; Spark's own gives an empty text."""
    return F.when(F.regexp_like(_c(text), F.lit(pattern)), F.regexp_extract(_c(text), pattern, group))


def contains_any_case(text: Cols, part: Cols | str) -> Column:
    part = F.lit(part) if isinstance(part, str) else part
    return F.contains(F.lower(_c(text)), F.lower(part))


def nth_index(text: Cols, part: str, nth: int) -> Column:
    """1-based place of the nth occurrence of `part`, 0 if there are fewer."""
    text = _c(text)
    before = F.substring_index(text, part, nth)
    return F.when(
        before == text,
        F.when(
            F.endswith(text, F.lit(part)) & (F.size(F.split(text, _quoted(part))) == nth + 1),
            F.char_length(text) - len(part) + 1
        ).otherwise(0)
    ).otherwise(F.char_length(before) + 1)


def _quoted(text: str) -> str:
    return "\\Q" + text + "\\E"


def part_at(text: Cols, separator: str, index: int) -> Column:
    """The 0-based part of a text split at a literal separator; from the end if negative; null outside."""
    return F.try_element_at(F.split(_c(text), _quoted(separator)), F.lit(index + 1 if index >= 0 else index))


# Time.


def to_local(ts: Cols, zone: str) -> Column:
    """A UTC instant as zone-less local time."""
    return F.from_utc_timestamp(_c(ts), zone).cast("timestamp_ntz")


def now_local(zone: str) -> Column:
    """The zone-less local time of the statement's start; casts to a date or a time of day follow the local clock."""
    return to_local(F.current_timestamp(), zone)


def created_partition(ts: Cols, zone: str, unknown: str = "2099-01-01") -> Column:
    """The local creation date, or the sentinel for a null."""
    return F.coalesce(F.to_date(F.from_utc_timestamp(_c(ts), zone)), F.lit(unknown).cast("date"))


def object_id_time(object_id: Cols) -> Column:
    """The creation time in the first eight hex digits of a document id; null where they are none."""
    head = F.substring(_c(object_id), 1, 8)
    return F.when(
        F.regexp_like(head, F.lit("^[0-9a-fA-F]{8}$")), F.timestamp_seconds(F.conv(head, 16, 10).cast("long"))
    )


def date_diff(part: str, later: Cols, earlier: Cols) -> Column:
    """The number of part boundaries between two dates: DAY, WEEK (Monday), MONTH, QUARTER or YEAR."""
    a, b = _c(later), _c(earlier)
    part = part.upper()
    if part == "DAY":
        return F.datediff(a, b)
    if part == "WEEK":
        return (F.datediff(F.trunc(a, "week"), F.trunc(b, "week")) / 7).cast("int")
    if part == "MONTH":
        return (F.year(a) - F.year(b)) * 12 + F.month(a) - F.month(b)
    if part == "QUARTER":
        return (F.year(a) - F.year(b)) * 4 + F.quarter(a) - F.quarter(b)
    if part == "YEAR":
        return F.year(a) - F.year(b)
    raise ValueError(f"no part {part}")


def week_of_year(day: Cols) -> Column:
    """0 to 53: the number of Mondays of the year up to the day; not the ISO week."""
    day = _c(day)
    first = F.trunc(day, "year")
    return F.floor(
        (F.datediff(day, first) + F.weekday(first)) / 7
    ).cast("int") + F.when(F.weekday(first) == 0, 1).otherwise(0)


#: Format codes and their Spark patterns.
CODES = {
    "%Y": "yyyy", "%y": "yy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss", "%j": "DDD", "%b": "MMM",
    "%B": "MMMM", "%a": "EEE", "%A": "EEEE", "%p": "a", "%I": "hh", "%F": "yyyy-MM-dd", "%T": "HH:mm:ss", "%R": "HH:mm"
}


def strftime_pattern(codes: str) -> str:
    """A Spark date pattern for a text with %-codes; letters outside codes are quoted."""
    out, at = "", 0
    while at < len(codes):
        two = codes[at : at + 2]
        if two in CODES:
            out, at = out + CODES[two], at + 2
        elif two.startswith("%"):
            raise ValueError(f"no code {two}")
        else:
            out, at = out + (f"'{codes[at]}'" if codes[at].isalpha() else codes[at]), at + 1
    return out


def format_time(ts: Cols, codes: str) -> Column:
    return F.date_format(_c(ts), strftime_pattern(codes))


def normalise_date(text: Cols) -> Column:
    """A date from the text forms in use, by length: MMyyyy (6; first of month), ddMMyyyy (8), dd/MM/yyyy or yyyy-MM-dd
    (10), ISO instants (24); else null.
    """
    text = F.trim(_c(text))
    n = F.char_length(text)
    return (
        F.when(n == 6, F.try_to_date(F.concat(F.lit("01"), text), "ddMMyyyy"))
        .when(n == 8, F.try_to_date(text, "ddMMyyyy"))
        .when((n == 10) & F.contains(text, F.lit("/")), F.try_to_date(text, "dd/MM/yyyy"))
        .when(n == 10, F.try_to_date(text, "yyyy-MM-dd"))
        .when(n == 24, F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd"))
    )


def expiry_bucket(expires: Cols, as_of: Cols) -> Column:
    """A label for the time left."""
    left = F.datediff(_c(expires), _c(as_of))
    return (
        F.when(left.isNull(), "unknown")
        .when(left < 0, "expired")
        .when(left <= 90, "0-3 months")
        .when(left <= 180, "3-6 months")
        .when(left <= 365, "6-12 months")
        .otherwise("over 12 months")
    )


def age_years(born: Cols, as_of: Cols) -> Column:
    """Full years: one less until the birthday."""
    born, as_of = _c(born), _c(as_of)
    return F.year(as_of) - F.year(born) - (F.date_format(as_of, "MMdd") < F.date_format(born, "MMdd")).cast("int")


def past_date(as_of: dt.date, days: int = 0, months: int = 0) -> dt.date:
    """The date so many months, then days, before `as_of`; the month's last day where the day doesn't exist."""
    at = as_of.year * 12 + as_of.month - 1 - months
    year, month = divmod(at, 12)
    last = (dt.date(year + (month == 11), (month + 1) % 12 + 1, 1) - dt.timedelta(days=1)).day
    return dt.date(year, month + 1, min(as_of.day, last)) - dt.timedelta(days=days)


def past_datetime(as_of: dt.datetime, days: int = 0, months: int = 0) -> dt.datetime:
    return dt.datetime.combine(past_date(as_of.date(), days, months), as_of.time(), as_of.tzinfo)


def is_day_of_week(as_of: dt.date, *days: int) -> bool:
    """Whether the date is one of these days, 1 for Sunday to 7 for Saturday."""
    return as_of.isoweekday() % 7 + 1 in days


def relative_range(said: str, as_of: dt.date) -> tuple[dt.date, dt.date]:
    """Start and end, both included: `l30d`, `l2w` or `l1m` before `as_of`, or `2024-01-01,2024-02-01`."""
    if "," in said:
        start, end = (dt.date.fromisoformat(x.strip()) for x in said.split(","))
        return start, end
    kind, number = said[-1:], said[1:-1]
    if said[:1] != "l" or kind not in "dwm" or not number.isdigit():
        raise ValueError(f"no range {said!r}")
    n = int(number)
    return past_date(as_of, days=n * {"d": 1, "w": 7, "m": 0}[kind], months=n if kind == "m" else 0), as_of


# JSON, arrays and structs.


def json_value(doc: Cols, path: str) -> Column:
    return F.get_json_object(_c(doc), path)


def json_array(doc: Cols, kind: str = "string") -> Column:
    """A JSON array as a Spark array; null where the text is none."""
    return F.from_json(_c(doc), f"array<{kind}>")


def json_keys(doc: Cols) -> Column:
    """The keys of a JSON object with their values as text, as a map."""
    return F.from_json(_c(doc), "map<string,string>")


def lookup(entries: Cols, key: str) -> Column:
    """The value of a key in an array of (key, value) structs; the last one where the key repeats, null where it is
    absent.
    """
    found = F.filter(_c(entries), lambda e: e["key"] == key)
    return F.try_element_at(found, F.lit(-1))["value"]


def last_valid(values: Cols) -> Column:
    """The last element that is neither null nor empty."""
    return F.try_element_at(F.filter(_c(values), lambda v: v.isNotNull() & (v.cast("string") != "")), F.lit(-1))


def parse_pg_array(text: Cols) -> Column:
    """`{a,"b",NULL}` as an array of texts; `{}` is empty; other text is one element; null is null."""
    text = _c(text)
    inner = F.substring(text, 2, 1 << 30)
    inner = F.substring(inner, F.lit(1), F.char_length(inner) - 1)
    parts = F.regexp_extract_all(inner, F.lit(r'("(?:[^"\\]|\\.)*"|[^,]+)'), F.lit(1))
    plain = F.transform(
        parts,
        lambda p: F.when(
            F.startswith(F.trim(p), F.lit('"')),
            F.regexp_replace(F.regexp_replace(F.trim(p), '^"|"$', ""), r"\\(.)", "$1")
        ).otherwise(F.when(F.upper(F.trim(p)) != "NULL", F.trim(p)))
    )
    literal = F.startswith(text, F.lit("{")) & F.endswith(text, F.lit("}"))
    return F.when(
        literal, F.when(F.trim(inner) == "", F.array().cast("array<string>")).otherwise(plain)
    ).when(text.isNotNull(), F.array(text))
