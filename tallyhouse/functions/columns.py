"""Scalar column helpers. Everything here stays inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Trend symbols of the report cards.
UP, DOWN = "▲", "▼"
# Fixed value: the invisible label put on every second axis tick.
ZERO_WIDTH_SPACE = "​"


def as_col(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def surrogate_key(natural_id: ColumnOrName) -> Column:
    """64-bit hash of an id's text; null stays null (xxhash64 alone returns its seed)."""
    c = as_col(natural_id)
    return F.when(c.isNotNull(), F.xxhash64(c.cast("string")))


def date_key(date: ColumnOrName) -> Column:
    """YYYYMMDD as a bigint."""
    return F.date_format(as_col(date), "yyyyMMdd").cast("bigint")


def flag(value: ColumnOrName) -> Column:
    """Bit columns arrive as booleans, 0/1 numbers or 'true'/'false' text."""
    return as_col(value).cast("boolean")


def flag_text(value: ColumnOrName) -> Column:
    """A bit column as the text 'true' / 'false'; null stays null."""
    return as_col(value).cast("boolean").cast("string")


def iso_text(timestamp: ColumnOrName) -> Column:
    """ISO text; milliseconds appear only when there are any."""
    c = as_col(timestamp)
    fraction = F.date_format(c, ".SSS")
    return F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"),
                    F.when(fraction == ".000", "").otherwise(fraction))


def decode(code: ColumnOrName, labels: Mapping, otherwise: str | None = "Unknown") -> Column:
    c = as_col(code)
    out = None
    for key, label in labels.items():
        out = F.when(c == key, label) if out is None else out.when(c == key, label)
    return out.otherwise(F.lit(otherwise))


def rank_in(value: ColumnOrName, order: list, otherwise: int | None) -> Column:
    """1-based place of a value in a fixed order; unlisted values get `otherwise`."""
    return decode(value, {v: i for i, v in enumerate(order, start=1)}, otherwise)


def blank_concat(*parts: ColumnOrName) -> Column:
    """Text join where a missing part counts as ''."""
    return F.concat(*[F.coalesce(as_col(p).cast("string"), F.lit("")) for p in parts])


def differs(value: ColumnOrName, other) -> Column:
    """Null-safe <>: a null value differs from a non-null one and is kept."""
    return ~as_col(value).eqNullSafe(F.lit(other))


def not_in(value: ColumnOrName, excluded: list) -> Column:
    """Null-safe NOT IN a literal list: a null value is kept."""
    c = as_col(value)
    return c.isNull() | ~c.isin(excluded)


def contains_fold(text: ColumnOrName, needle: str) -> Column:
    """Case-insensitive contains."""
    return F.lower(as_col(text)).contains(needle.lower())


# --- numbers ---------------------------------------------------------------

def safe_divide(num: ColumnOrName, den: ColumnOrName, alternate=None) -> Column:
    """Division giving `alternate` when the denominator is zero or missing."""
    q = F.try_divide(as_col(num).cast("double"), as_col(den).cast("double"))
    return q if alternate is None else F.coalesce(q, F.lit(float(alternate)))


def change_ratio(current: ColumnOrName, previous: ColumnOrName, alternate=None) -> Column:
    """(current - previous) / previous, missing counts acting as 0 in the difference."""
    cur, prev = (F.coalesce(as_col(c), F.lit(0)) for c in (current, previous))
    return F.round(safe_divide(cur - prev, prev, alternate), 6)


def round_up(value: ColumnOrName) -> Column:
    """Away from zero to a whole number."""
    c = as_col(value)
    return F.when(c >= 0, F.ceil(c)).otherwise(F.floor(c))


def round_down(value: ColumnOrName) -> Column:
    """Towards zero to a whole number."""
    c = as_col(value)
    return F.when(c >= 0, F.floor(c)).otherwise(F.ceil(c))


def trend_arrow(ratio: ColumnOrName) -> Column:
    c = as_col(ratio)
    return F.when(c >= 0, UP).when(c < 0, DOWN)


def exact(value: ColumnOrName, precision: int = 18, scale: int = 2) -> Column:
    return as_col(value).cast(f"decimal({precision},{scale})")


# --- display text ----------------------------------------------------------

def dash_if_null(text: ColumnOrName) -> Column:
    return F.coalesce(as_col(text).cast("string"), F.lit("-"))


def percent_text(ratio: ColumnOrName) -> Column:
    """Format 0%."""
    return F.concat(F.round(as_col(ratio) * 100).cast("bigint").cast("string"), F.lit("%"))


def signed_percent_text(ratio: ColumnOrName) -> Column:
    """Format +0.0%;-0.0%;0.0%."""
    tenths = F.round(as_col(ratio) * 1000).cast("bigint")
    size = F.abs(tenths)
    sign = F.when(tenths > 0, "+").when(tenths < 0, "-").otherwise("")
    return F.concat(sign, F.floor(size / 10).cast("string"), F.lit("."),
                    F.pmod(size, F.lit(10)).cast("string"), F.lit("%"))


def thousands_text(value: ColumnOrName) -> Column:
    """Format #,0."""
    return F.format_number(F.round(as_col(value)).cast("bigint"), 0)


def month_year_text(date: ColumnOrName) -> Column:
    return F.date_format(as_col(date), "MMM yy")


def month_day_text(date: ColumnOrName) -> Column:
    return F.date_format(as_col(date), "MM/dd")


def short_date_text(date: ColumnOrName) -> Column:
    """Format M/D/YYYY."""
    return F.date_format(as_col(date), "M/d/yyyy")


def pad2(number: ColumnOrName) -> Column:
    return F.lpad(as_col(number).cast("string"), 2, "0")


# A cheap pattern goes before the number casts: most unfit texts never reach a parser.
INTEGER = r"^\s*[+-]?\d{1,19}\s*$"
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def safe_cast(text: ColumnOrName, kind: str) -> Column:
    """Cast a text, giving null where it does not fit."""
    c = as_col(text)
    pattern = {"int": INTEGER, "bigint": INTEGER, "double": NUMBER}.get(kind)
    return c.try_cast(kind) if pattern is None else F.when(c.rlike(pattern), c.try_cast(kind))


# --- JSON and text splitting -------------------------------------------------

def single_spaced(text: ColumnOrName) -> Column:
    """Spaces removed from the ends and runs of spaces inside made one."""
    return F.trim(F.regexp_replace(as_col(text), " +", " "))


def strip(text: ColumnOrName) -> Column:
    """White space of any kind removed from the ends."""
    return F.regexp_replace(as_col(text), r"^\s+|\s+$", "")


def split_before(text: ColumnOrName, separator: str) -> Column:
    """Text before the first separator; null if there is none."""
    c = as_col(text)
    at = F.instr(c, F.lit(separator))
    return F.when(at > 0, F.substring(c, F.lit(1), at - 1))


def split_after(text: ColumnOrName, separator: str) -> Column:
    """Text after the first separator; null if there is none."""
    c = as_col(text)
    at = F.instr(c, F.lit(separator))
    return F.when(at > 0, F.substring(c, at + len(separator), F.length(c)))


def iso_timestamp(text: ColumnOrName) -> Column:
    """ISO text ending in 'Z', '+00:00' or '+0000' to a timestamp; bad text gives null."""
    c = as_col(text)
    zoned = F.regexp_replace(F.regexp_replace(c, "Z$", "+00:00"),
                             r"([+-]\d{2})(\d{2})$", "$1:$2")
    return zoned.try_cast("timestamp")


def in_box(lat: ColumnOrName, lng: ColumnOrName, south, north, west, east) -> Column:
    """Inside a latitude/longitude box, with missing and zero coordinates rejected."""
    la, lo = as_col(lat), as_col(lng)
    return (la != 0) & (lo != 0) & la.between(south, north) & lo.between(west, east)


def distinct_count(column: str, where: Column | None = None) -> Column:
    """Aggregate: distinct values, a blank counted as one value, of the rows `where` holds."""
    c, held = F.col(column), F.lit(True) if where is None else F.coalesce(where, F.lit(False))
    blank = F.coalesce(F.max((c.isNull() & held).cast("int")), F.lit(0))
    return F.count_distinct(F.when(held, c)) + blank
