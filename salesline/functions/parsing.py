"""Column expressions that turn messy text into typed values. Bad input gives null, never an error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Year, month and day with signs between them; month, day and year if the second number can't be a month; day, month and
# year; or eight digits. Perhaps a time follows, perhaps a zone.
STAMP = (
    r"^\s*(?:(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})|(\d{1,2})[-/.](1[3-9]|[2-9]\d)[-/.](\d{4})"
    r"|(\d{1,2})[-/.](\d{1,2})[-/.](\d{4})|(\d{4})(\d{2})(\d{2}))"
    r"(?:[T ]+(\d{1,2}:\d{2})(?:(:\d{2}(?:\.\d{1,6})?)\d*)?)?\s*(?:Z|z|UTC|([+-]\d{2}):?(\d{2})?)?\s*$"
)
# Digits with a point and an exponent, or infinity; "NaN", "None" and "-" are no numbers.
NUMBER = r"^\s*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?[dDfF]?|[iI][nN][fF](?:[iI][nN][iI][tT][yY])?)\s*$"
MARK = "\x01"
# The parts in the order of the year, month, day, time and zone.
PARTS = f"{MARK}$1$6$9$10-$2$4$8$11-$3$5$7$12 $13$14|$15|$16"


def normalized_name(name: Column) -> Column:
    """Lower case, runs of blanks, dashes and underscores as one underscore, other signs dropped."""
    s = F.regexp_replace(F.lower(F.trim(name)), r"[\s\-_]+", "_")
    return F.btrim(F.regexp_replace(s, "[^a-z0-9_]", ""), F.lit("_"))


def clean_number(text: Column) -> Column:
    """Drop blanks and currency signs, read a comma as the decimal point. Texts that stand for no number are null."""
    return _double(F.translate(text.cast("string"), ", €$", "."))


def plain_number(text: Column) -> Column:
    """A number whose decimal point may be a comma; anything else is null."""
    return _double(F.translate(text.cast("string"), ",", "."))


def numbers(cleaned: Sequence[Column], plain: Sequence[Column] = ()) -> Column:
    """An array of numbers, those of ``clean_number`` before those of ``plain_number``.

    One small function goes over the texts. Spark keeps a projection with such a function out of the method it makes of a
    stage; beyond 8,000 bytes that method would never be compiled, and all that made the texts would be interpreted.
    """
    texts = [F.translate(t.cast("string"), ", €$", ".") for t in cleaned]
    return F.transform(F.array(*texts, *[F.translate(t.cast("string"), ",", ".") for t in plain]), _double)


def _double(text: Column) -> Column:
    """The number a text is. A pattern turns other texts away, as a cast that fails costs many times one that doesn't."""
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def scrub(number: Column) -> Column:
    """NaN as null."""
    return F.when(~F.isnan(number), number)


def first_digits(text: Column) -> Column:
    """The first run of digits as an integer: ``store_12`` gives 12."""
    run = F.regexp_extract(text.cast("string"), r"(\d+)", 1)
    return F.when(run != "", run).try_cast("bigint")


def parsed_timestamp(text: Column) -> Column:
    """The date and time a text states, day before month, in UTC; null if it states none.

    Days and months may have one digit. A second number above 12 after a day is the day, and the first the month.
    Minutes, seconds and fractions may be missing; a zone's offset is taken off. One pattern writes the parts in the order
    of a timestamp, which is then cast. It has 8 signs at least and starts with a digit or a blank, so that other texts need
    no pattern.
    """
    stamp = F.regexp_replace(F.when((F.octet_length(text) >= 8) & (F.ascii(text) <= ord("9")), text), STAMP, PARTS)
    at = F.substring_index(F.substring(stamp, 2, 40), "|", 1).try_cast("timestamp_ntz")
    hours = F.substring_index(F.substring_index(stamp, "|", -2), "|", 1)
    minutes = F.substring_index(stamp, "|", -1).try_cast("int")
    ahead = F.when(hours.startswith("-"), -1).otherwise(1)
    offset = F.make_dt_interval(F.lit(0), hours.try_cast("int"), ahead * F.coalesce(minutes, F.lit(0)))
    local = F.when(stamp.endswith("||"), at).otherwise(at - offset)
    return F.when(stamp.startswith(MARK) & (stamp != text), local)


def day_first_date(text: Column) -> Column:
    return parsed_timestamp(text).cast("date")


def request_timestamp(text: Column) -> Column:
    """Dates as requests write them: a stated date and time, or seconds since 1970. Eight digits are a date."""
    t = F.trim(text)
    is_seconds = t.rlike(r"^[0-9]+(\.[0-9]+)?$") & ~t.rlike(r"^[0-9]{8}$")
    seconds = F.when(is_seconds, t.try_cast("double"))
    since = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since
    return F.when(is_seconds, epoch).otherwise(parsed_timestamp(t))


def swapped_date(text: Column) -> Column:
    """Read ``year-day-month``: swap the last two parts when the second cannot be a month."""
    parts = F.split(text, "[-/]")
    digits = text.rlike(r"^\d+[-/]\d+[-/]\d+$")
    year_text = F.get(parts, F.lit(0))
    short = year_text.try_cast("int")
    year = F.when(F.length(year_text) == 2, F.when(short <= 50, short + 2000).otherwise(short + 1900)).otherwise(short)
    second, third = F.get(parts, F.lit(1)).try_cast("int"), F.get(parts, F.lit(2)).try_cast("int")
    iso = F.concat_ws(
        "-",
        F.lpad(year.cast("string"), 4, "0"),
        F.lpad(third.cast("string"), 2, "0"),
        F.lpad(second.cast("string"), 2, "0"),
    )
    fits = digits & (second > 12) & (third <= 12) & (F.length(F.get(parts, F.lit(1))) <= 2)
    return F.when(fits, F.try_to_timestamp(iso, F.lit("yyyy-MM-dd"))).cast("date")


def repaired_date(parsed: Column, text: Column) -> Column:
    """Keep a parsed date; otherwise try the swap."""
    return F.coalesce(parsed, swapped_date(text))


def promo_flag(x: Column) -> Column:
    """1 for true, 'True' or 1; everything else is 0."""
    return F.when(F.lower(x.cast("string")).isin("true", "1", "1.0"), 1).otherwise(0)
