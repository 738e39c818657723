"""Column functions for numbers, dates, arrays and coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# French month names by their first letters, in order.
FRENCH_MONTHS = ("janv", "f[ée]vr", "mars", "avr", "mai", "juin", "juil", "ao[ûu]t", "sept", "oct", "nov", "d[ée]c")


def numeric(x: Column) -> Column:
    """Thousands commas dropped; anything else that isn't a number is null."""
    return F.replace(x, F.lit(","), F.lit("")).try_cast("double")


def half_up(x: Column) -> Column:
    """Rounds halves towards plus infinity."""
    return F.floor(x + F.lit(0.5))


def prefix_number(x: Column) -> Column:
    """The number that a text begins with, with a decimal comma or point."""
    return F.nullif(F.regexp_extract(F.regexp_replace(x, ",", "."), r"^\s*([-+]?\d+(?:\.\d+)?)", 1), F.lit("")).try_cast("double")


def swiss_number(x: Column) -> Column:
    """Currency, apostrophes and mixed separators: the last of point and comma is the decimal mark."""
    raw = F.regexp_replace(x, r"[^0-9.,-]", "")
    both = raw.contains(",") & raw.contains(".")
    comma_last = F.length(raw) - F.locate(",", F.reverse(raw)) > F.length(raw) - F.locate(".", F.reverse(raw))
    plain = (
        F.when(both & comma_last, F.replace(F.replace(raw, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
        .when(both, F.replace(raw, F.lit(","), F.lit("")))
        .otherwise(F.replace(raw, F.lit(","), F.lit(".")))
    )
    return F.regexp_replace(plain, "[.-]+$", "").try_cast("double")


def percentage(part: Column, whole: Column, digits: int = 2) -> Column:
    """Share in percent, null for a whole of zero."""
    return F.round(part / F.nullif(whole, F.lit(0)) * 100, digits)


def clamp(x: Column, low: float = 0.0, high: float = 1.0) -> Column:
    """Null counts as zero."""
    return F.greatest(F.lit(low), F.least(F.lit(high), F.coalesce(x, F.lit(0.0))))


def bucket(x: Column, *borders: float) -> Column:
    """Number of borders that a value has reached, plus one; null stays null."""
    return F.when(x.isNotNull(), sum((F.when(x >= b, 1).otherwise(0) for b in borders), F.lit(1)))


def range_middle(x: Column) -> Column:
    """The middle of 'a-b', or the only number of a text."""
    a, b = (F.nullif(F.regexp_extract(x, r"(\d+)(?:\s*-\s*(\d+))?", i), F.lit("")).try_cast("double") for i in (1, 2))
    return F.when(b.isNotNull(), (a + b) / 2).otherwise(a)


def to_hex(r: Column, g: Column, b: Column) -> Column:
    """Colour of three channels."""
    return F.concat(F.lit("#"), *[F.lpad(F.lower(F.hex(c.cast("bigint"))), 2, "0") for c in (r, g, b)])


def any_date(x: Column, *patterns: str) -> Column:
    """The first pattern that fits."""
    return F.coalesce(*[F.try_to_date(x, p) for p in patterns or ("d-M-yyyy", "d/M/yyyy", "d.M.yyyy", "yyyy-MM-dd")])


def full_year(yy: Column, pivot: int, inclusive: bool = True) -> Column:
    """Two-digit years: from the pivot on they are of the last century."""
    return yy + F.when((yy >= pivot) if inclusive else (yy > pivot), 1900).otherwise(2000)


def french_date(x: Column) -> Column:
    """'3 février 2024' and abbreviations."""
    low = F.lower(x)
    month = F.coalesce(*[F.when(low.rlike(rf"\d(?:er)?\s+{m}"), F.lit(i + 1)) for i, m in enumerate(FRENCH_MONTHS)])
    day, year = (F.nullif(F.regexp_extract(low, p, 1), F.lit("")).try_cast("int") for p in (r"(\d{1,2})(?:er)?\s", r"(\d{4})"))
    return F.when(month.isNotNull() & day.isNotNull() & year.isNotNull(), F.try_to_date(F.format_string("%04d-%02d-%02d", year, month, day)))


def sunday_first(ts: Column) -> Column:
    """Day of week with Sunday as 0."""
    return F.dayofweek(ts) - 1


def keywords(x: Column) -> Column:
    """Trimmed parts between commas and semicolons, in order, each once."""
    return F.array_distinct(F.filter(F.transform(F.split(x, "[,;]"), lambda p: F.trim(p)), lambda p: p != ""))


def flags(**columns: Column) -> Column:
    """Names of the true flags."""
    return F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in columns.items()]))


def lv03_to_wgs84(east: Column, north: Column) -> tuple[Column, Column]:
    """Longitude and latitude of Swiss grid metres by the published approximation (G2); take 2e6 and 1e6 off LV95 first."""
    y, x = (east - 600000) / 1e6, (north - 200000) / 1e6
    lon = 2.6779094 + 4.728982 * y + 0.791484 * y * x + 0.1306 * y * x * x - 0.0436 * y * y * y
    lat = 16.9023892 + 3.238272 * x - 0.270978 * y * y - 0.002528 * x * x - 0.0447 * y * y * x - 0.0140 * x * x * x
    return lon * 100 / 36, lat * 100 / 36


def prefix_integer(x: Column) -> Column:
    """The whole number that a text begins with, whatever follows; null without one."""
    return F.nullif(F.regexp_extract(x, r"^\s*([-+]?[0-9]+)", 1), F.lit("")).try_cast("bigint")


def day_first(x: Column) -> Column:
    """``d/m/yyyy`` as ``yyyy-mm-dd``; a text of any other number of parts passes through, trimmed."""
    parts = F.split(F.trim(x), "/")
    two = lambda i: F.when(F.length(parts[i]) < 2, F.lpad(parts[i], 2, "0")).otherwise(parts[i])
    return F.when(F.size(parts) == 3, F.concat_ws("-", F.get(parts, F.lit(2)), two(1), two(0))).otherwise(F.trim(x))


def candle_times(open_ms: Column, interval_ms: Column) -> Column:
    """Opening and closing time (a millisecond before the next one opens), hour and day of week with Sunday as 0, from milliseconds."""
    opened = F.timestamp_millis(open_ms)
    return F.struct(opened.alias("open_time"), F.timestamp_millis(open_ms + interval_ms - 1).alias("close_time"), F.hour(opened).alias("hour_utc"), sunday_first(opened).alias("dow_utc"))


def fetch_from(newest: Column, today: Column, days: int) -> Column:
    """First day to fetch: ``days`` before today, or the newest day known where that is earlier, so that no gap is left."""
    return F.least(newest.cast("date"), F.date_sub(today, days))


def swiss_point(lines: Column) -> Column:
    """``(lon, lat)`` of the first line ``2600000.5/1200000``, null without one."""
    pattern = r"^([0-9]{7}\.?[0-9]*)/([0-9]{7}\.?[0-9]*)\z"
    line = F.try_element_at(F.filter(lines, lambda x: x.rlike(pattern)), F.lit(1))
    metres = [F.regexp_extract(line, pattern, i).try_cast("double") - d for i, d in ((1, 2e6), (2, 1e6))]
    lon, lat = lv03_to_wgs84(*metres)
    return F.when(line.isNotNull(), F.struct(lon.alias("lon"), lat.alias("lat")))


def ewkt(point: Column) -> Column:
    """A point ``(lon, lat)`` as text with its reference system."""
    return F.concat(F.lit("SRID=4326;POINT("), point["lon"].cast("string"), F.lit(" "), point["lat"].cast("string"), F.lit(")"))
