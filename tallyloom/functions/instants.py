"""Instants written in several notations, as microseconds since the Unix epoch."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space around a text.
BLANKS = "\t\n\x0b\x0c\r \x85\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
_ISO = r"^(\d{4})(-?)(\d{2})\2(\d{2})[T ]\s*(\d{2})(:?)(\d{2})(?:\6(\d{2})(?:[.,](\d{1,9}))?)?\s*(?:(Z|UTC|GMT)|([+-]\d{2})(?::?(\d{2}))?)?$"
_DIGITS = r"^\d+$"


def strip(text: Column) -> Column:
    """The text without white space of any kind around it."""
    return F.btrim(text, F.lit(BLANKS))


def _dashed(s: Column, at: int) -> Column:
    """yyyyMMdd and, from character ``at`` on, HHmmss as a form that the cast to a timestamp reads."""
    part = lambda i, n: F.substring(s, i, n)
    return F.concat(part(1, 4), F.lit("-"), part(5, 2), F.lit("-"), part(7, 2), F.lit("T"), part(at, 2), F.lit(":"), part(at + 2, 2), F.lit(":"), part(at + 4, 2), F.lit("Z"))


def instant_micros(text: Column) -> Column:
    """Microseconds since the epoch, or null where the text denotes no instant.

    Read are ISO forms (basic or extended, T or blank between day and time, seconds and fraction optional, with Z, an
    offset or none: then UTC), 14-digit stamps, Unix seconds (9 or 10 digits) and milliseconds (12 or 13 digits), in
    either letter case and with stray blanks around them. Days without a time, words and impossible dates give null.
    The result doesn't depend on the session's time zone. The usual forms are told apart by length and single
    characters and read by the cast; only what is left meets a regular expression.

    The code that Spark generates for all of this is longer than what the JVM compiles in one method. The lambda in the last
    branch, which whole-stage code can't hold, has it generated in small methods instead: half the time per row.
    """
    s = F.upper(strip(text))
    n = F.length(s)
    at = lambda i: F.substring(s, i, 1)
    micros = lambda x: F.unix_micros(x.try_cast("timestamp"))
    compact = (n == 16) & (at(9) == "T") & (at(16) == "Z")
    dashed = (n >= 19) & (at(5) == "-") & (at(8) == "-") & (at(11).isin("T", " ")) & (at(14) == ":") & (at(17) == ":")
    zoned = (at(20) == "Z") | F.substring(s, 20, 40).rlike(r"^(?:\.\d+)?(?:Z|[+-]\d{2}:\d{2})$")
    number = s.try_cast("bigint")
    parts = F.split(F.regexp_replace(s, _ISO, "$1$3$4$5$7|$8|$9|$11|$12"), r"\|")
    seconds = F.when(F.length(parts[1]) > 0, parts[1]).otherwise("00")
    fraction = F.rpad(F.substring(parts[2], 1, 6), 6, "0").try_cast("bigint")
    zone = F.when(F.length(parts[3]) > 0, F.concat(parts[3], F.lit(":"), F.when(F.length(parts[4]) > 0, parts[4]).otherwise("00"))).otherwise("Z")
    iso = F.unix_micros(F.try_to_timestamp(F.concat(parts[0], seconds, zone), F.lit("yyyyMMddHHmmssXXX"))) + F.coalesce(fraction, F.lit(0))
    return (
        F.when(compact & F.translate(F.substring(s, 1, 15), "0123456789", "").eqNullSafe("T"), micros(_dashed(s, 10)))
        .when(dashed & (n == 19), micros(F.concat(s, F.lit("Z"))))
        .when(dashed & zoned, micros(s))
        .when(number.isNotNull() & s.rlike(_DIGITS), F.when(n == 14, micros(_dashed(s, 9))).when(n.isin(9, 10), number * 1_000_000).when(n.isin(12, 13), number * 1_000))
        .when(s.rlike(_ISO), F.get(F.transform(F.array(iso), lambda x: x), F.lit(0)))
    )


def compact_utc(seconds: Column) -> Column:
    """Seconds since the epoch as YYYYMMDDTHHMMSSZ, whatever the session's time zone."""
    day = F.floor(seconds / 86_400).cast("int")
    rest = F.pmod(seconds, F.lit(86_400)).cast("int")
    two = lambda c: F.lpad(c.cast("int").cast("string"), 2, "0")
    return F.concat(
        F.replace(F.date_add(F.lit("1970-01-01").cast("date"), day).cast("string"), F.lit("-"), F.lit("")),
        F.lit("T"), two(F.floor(rest / 3600)), two(F.floor(rest % 3600 / 60)), two(rest % 60), F.lit("Z"),
    )


def is_finite(value: Column) -> Column:
    """True for finite numbers, false for null, NaN and infinities."""
    return F.coalesce(~F.isnan(value) & (F.abs(value) < float("inf")), F.lit(False))
