"""Date and time expressions.

Every parse is guarded by an anchored pattern, so it never depends on
``spark.sql.legacy.timeParserPolicy`` and never throws under ANSI mode.  Results are
TIMESTAMP_NTZ (wall-clock, no zone), the type of the source tables.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

_MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")
_MONTH = (r"(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sep(?:t(?:ember)?)?"
          r"|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)")
_WEEKDAY = r"(?:(?:mon|tue(?:s)?|wed(?:nes)?|thu(?:rs)?|fri|sat(?:ur)?|sun)(?:day)?[.,]*\s+)?"
_ORDINAL = r"(?:st|nd|rd|th)?"
_ZONE = r"(?:\s*(?:z|utc|gmt|[+-]\d{2}(?::?\d{2})?))?"
#: A time of day; it has minutes or AM/PM.
_TIME = (r"(?:(?:t|,?\s+)(\d{1,2})(?::(\d{1,2})(?::([0-5]?\d)(?:\.(\d{1,6})\d*)?)?|(?=\s*[ap]\.?m))"
         r"(?:\s*([ap])\.?m\.?)?" + _ZONE + r")?")
_TIME_FIELDS = ("h", "mi", "s", "fraction", "half")
#: Spellings and the fields they fill, in group order; a time may follow each.
_SPELLINGS = (
    (r"(\d{1,2})[/.-](\d{1,2})[/.-](\d{4}|\d{2})", "a b y"),
    (r"(\d{4})[/.-](\d{1,2})[/.-](\d{1,2})", "y m d"),
    (r"(\d{1,2})" + _ORDINAL + r"(?:[/.-]|\s+)" + _MONTH + r"[.,]?(?:[/.-]|\s+)(\d{4}|\d{2})", "d name y"),
    (_MONTH + r"\.?(?:-|\s+)(\d{1,2})" + _ORDINAL + r"(?:-|,?\s+)(\d{4})", "name d y"),
    (r"(\d{4})(?:[/.-]|\s+)" + _MONTH + r"\.?(?:[/.-]|\s+)(\d{1,2})", "y name d"),
    (r"(\d{4})(\d{2})(\d{2})(?:(\d{2})(\d{2})([0-5]\d))?", "y m d h mi s"),
)
_GROUPS = [*" ".join(f for _, f in _SPELLINGS).split(), *_TIME_FIELDS]
_FIELDS = ("a", "b", "y", "m", "name", "d", *_TIME_FIELDS)
_SHAPE = r"(?i)^\s*" + _WEEKDAY + "(?:" + "|".join(p for p, _ in _SPELLINGS) + ")" + _TIME + r"\s*$"
#: Starts what a matched value is rewritten to, so that matching and taking the groups are one run of the pattern.
_MATCHED = "\u0001"
#: One field is filled by one spelling at most: the groups that may fill it stand side by side.
_REWRITTEN = "|".join([_MATCHED, *("".join(f"${i + 1}" for i, g in enumerate(_GROUPS) if g == f) for f in _FIELDS)])


def parse_mixed(c, dayfirst: bool = False) -> Column:
    """Tolerant parse of mixed spellings: numeric dates with ``/``, ``-`` or ``.``, ISO dates, month names in any
    place, ordinals (``4th``), ``yyyyMMdd[HHmmss]``, a leading weekday (not checked), two-digit years (69-99 are 19xx),
    optional times with seconds, fractions (to microseconds), AM/PM (then minutes may be absent) and a zone.
    Blanks around and repeated blanks are ignored.

    Ambiguous d/M vs M/d is resolved by ``dayfirst`` (the other order is tried when the first is
    not a valid date).  A zone or offset is dropped: the wall-clock time stays.  Anything else is null
    (``operators.shapes.date_shapes`` tells which shapes of a column that holds for).
    The pattern runs once a value: it rewrites the value to its fields, which make the timestamp.
    """
    x = as_col(c)
    rewritten = F.regexp_replace(x, _SHAPE, _REWRITTEN)
    fields = F.when(rewritten.startswith(_MATCHED) & ~x.startswith(_MATCHED), F.split(rewritten, r"\|", -1))

    def build(f: Column) -> Column:
        def value(name):
            """The field's text; null if the value has none."""
            return F.nullif(f[1 + _FIELDS.index(name)], F.lit(""))

        def number(name):
            return value(name).cast("int")

        year = number("y")
        year = F.when(F.length(value("y")) == 2, year + F.when(year >= 69, 1900).otherwise(2000)).otherwise(year)
        named = F.array_position(F.array(*map(F.lit, _MONTHS)), F.lower(F.substring(value("name"), 1, 3))).cast("int")
        hour = F.coalesce(number("h"), F.lit(0))
        pm = F.lower(value("half")) == "p"
        hour = (F.when(value("half").isNull(), hour)
                .when(hour.between(1, 12), F.pmod(hour, F.lit(12)) + F.when(pm, 12).otherwise(0)))
        seconds = F.concat(F.coalesce(value("s"), F.lit("0")), F.lit("."), F.coalesce(value("fraction"), F.lit("0"))).cast("decimal(16,6)")

        def at(month, day):
            return F.try_make_timestamp_ntz(year, month, day, hour, F.coalesce(number("mi"), F.lit(0)), seconds)

        first, second = (number("b"), number("a")) if dayfirst else (number("a"), number("b"))
        return F.coalesce(at(F.coalesce(number("m"), named, first), F.coalesce(number("d"), second)), at(second, first))

    return F.transform(F.array(fields), build)[0]


def parse_exact(c, fmt: str, guard: str | None = None) -> Column:
    c = as_col(c)
    parsed = F.try_to_timestamp(c, F.lit(fmt))
    if guard:
        parsed = F.when(c.rlike(guard), parsed)
    return parsed.cast("timestamp_ntz")


def to_ts(c) -> Column:
    """Coerce a string column with the tolerant parser (see ``coerce_ts`` for typed columns)."""
    return parse_mixed(as_col(c).cast("string"))


def coerce_ts(df, name: str) -> Column:
    """Column ``name`` of ``df`` as TIMESTAMP_NTZ: timestamps and dates pass through (cast),
    anything else goes through the tolerant parser."""
    from pyspark.sql import types as T
    c = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return c.cast("timestamp_ntz")
    return to_ts(c)


def pad_seconds(t) -> Column:
    """Append ':00' to a time that does not have exactly two colons."""
    t = as_col(t)
    colons = F.length(t) - F.length(F.replace(t, F.lit(":"), F.lit("")))
    return F.when(colons == 2, t).otherwise(F.concat(t, F.lit(":00")))


def format_ts(c, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(as_col(c), fmt)


def floor_day_diff(end, start) -> Column:
    """Whole days between two timestamps, floored (-23 h -> -1)."""
    micros = F.timestamp_diff("MICROSECOND", as_col(start), as_col(end))
    return F.floor(micros / F.lit(86_400_000_000)).cast("bigint")


def add_days(ts, days) -> Column:
    """ts + a possibly fractional number of days."""
    micros = (as_col(days) * F.lit(86_400_000_000)).cast("bigint")
    return F.timestamp_add("MICROSECOND", micros, as_col(ts))
