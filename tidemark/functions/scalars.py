"""Column -> Column helpers. All are Spark built-in expressions (no Python UDFs),
so they stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_PLATFORM_SOURCE = "Platform"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ascii_bucket(id_col, buckets: int = 100) -> Column:
    """Sum of the code points of the id, modulo ``buckets`` (NULL id -> NULL)."""
    chars = F.split(_c(id_col), "")
    total = F.aggregate(F.transform(chars, lambda ch: F.ascii(ch)), F.lit(0), lambda acc, x: acc + x)
    return (total % buckets).cast("int")


def touch_point(email, platform_email, logged_in, source,
                platform: str = DEFAULT_PLATFORM_SOURCE) -> Column:
    """1: same person (case-insensitive e-mail), logged in, sourced from the platform;
    2: same person and logged in; 0 otherwise (NULLs give 0)."""
    same = F.lower(_c(email)) == F.lower(_c(platform_email))
    logged = F.coalesce(_c(logged_in), F.lit(False))
    return (F.when(same & logged & (_c(source) == F.lit(platform)), F.lit(1))
            .when(same & logged, F.lit(2)).otherwise(F.lit(0)).cast("int"))


#: Time texts by their shape (of the trimmed text) and how each is read. ISO forms are tried before,
#: except for bare numbers, which would be read as years. Month comes before day in ambiguous slashed dates.
_MONTH, _CLOCK = r"[A-Za-z]{3,9}\.?", r"\d{1,2}:\d{2}(:\d{2})?"
_HALF = r"\d{1,2}:\d{2}(:\d{2})? ?[AaPp][Mm]"
TIME_FORMS: tuple[tuple[str, str], ...] = (
    (rf"^\d{{1,2}} [A-Za-z]{{3}} \d{{4}} {_CLOCK} [+-]\d{{4}}$", "d MMM yyyy H:mm[:ss] Z"),      # RFC 2822 (weekday and zone names are dropped before)
    (rf"^\d{{1,2}} [A-Za-z]{{3}} \d{{4}}( {_CLOCK})?$", "d MMM yyyy[ H:mm[:ss]]"),
    (rf"^\d{{1,2}} [A-Za-z]{{4,9}} \d{{4}}( {_CLOCK})?$", "d MMMM yyyy[ H:mm[:ss]]"),
    (rf"^[A-Za-z]{{3}} \d{{1,2}}, \d{{4}} {_HALF}$", "MMM d, yyyy h:mm[:ss][ ]a"),
    (rf"^[A-Za-z]{{4,9}} \d{{1,2}}, \d{{4}} {_HALF}$", "MMMM d, yyyy h:mm[:ss][ ]a"),
    (rf"^[A-Za-z]{{3}} \d{{1,2}}, \d{{4}}( {_CLOCK})?$", "MMM d, yyyy[ H:mm[:ss]]"),
    (rf"^[A-Za-z]{{4,9}} \d{{1,2}}, \d{{4}}( {_CLOCK})?$", "MMMM d, yyyy[ H:mm[:ss]]"),
    (rf"^(1[3-9]|2\d|3[01])/\d{{1,2}}/\d{{4}}( {_CLOCK})?$", "d/M/yyyy[ H:mm[:ss]]"),
    (rf"^\d{{1,2}}/\d{{1,2}}/\d{{4}}( {_CLOCK})?$", "M/d/yyyy[ H:mm[:ss]]"),
    (rf"^\d{{1,2}}/\d{{1,2}}/\d{{4}} {_HALF}$", "M/d/yyyy h:mm[:ss][ ]a"),
    (rf"^\d{{4}}/\d{{1,2}}/\d{{1,2}}( {_CLOCK})?$", "yyyy/M/d[ H:mm[:ss]]"),
    (rf"^\d{{4}}-\d{{1,2}}-\d{{1,2}} {_HALF}$", "yyyy-M-d h:mm[:ss][ ]a"),
    (rf"^\d{{1,2}}\.\d{{1,2}}\.\d{{4}}( {_CLOCK})?$", "d.M.yyyy[ H:mm[:ss]]"),
    (r"^\d{8}T\d{6}Z$", "yyyyMMdd'T'HHmmss'Z'"),
)


def parse_time(text, patterns: Sequence[str] = (), forms: Sequence[tuple[str, str]] = TIME_FORMS) -> Column:
    """Lenient text -> timestamp; NULL when nothing parses.

    ISO-8601 forms (with ``T``, fractions, ``Z`` or ``+0000`` offsets) are handled by ``try_cast``. Numbers of
    9 or 10 digits are epoch seconds, of 12 or 13 epoch milliseconds (with or without a fraction). Then
    come the caller's ``patterns`` in order, then the one of ``forms`` whose shape the text has. What is not ISO goes
    through functions of one element, so the table is neither compiled into nor evaluated by the path of ISO texts.
    """
    def once(value: Column, fn) -> Column:
        return F.get(F.transform(F.array(value), fn), F.lit(0))

    def shaped(plain: Column) -> Column:
        return reduce(lambda acc, f: acc.when(plain.rlike(f[0]), F.try_to_timestamp(plain, F.lit(f[1]))), forms,
                      F.when(F.lit(False), F.lit(None).cast("timestamp")))

    def lenient(c: Column) -> Column:
        number = r"^\d{%s}(\.\d+)?$"
        micros = F.when(c.rlike(number % "9,10"), c.try_cast("decimal(20,6)") * 1_000_000).when(
            c.rlike(number % "12,13"), c.try_cast("decimal(20,6)") * 1_000)
        plain = F.regexp_replace(F.regexp_replace(c, r"\s+", " "), r"(?i)^(mon|tue|wed|thu|fri|sat|sun)[a-z]*,? ", "")
        plain = F.regexp_replace(F.regexp_replace(plain, r" (GMT|UTC|UT|Z)$", " +0000"), rf"^({_MONTH}) (\d{{1,2}}) (\d{{4}})", "$1 $2, $3")
        return F.coalesce(F.timestamp_micros(micros.cast("bigint")), c.try_cast("timestamp"),
                          *[F.try_to_timestamp(c, F.lit(p)) for p in patterns], once(plain, shaped))

    raw = _c(text)
    return F.coalesce(F.when(raw.rlike(r"^\d{4}-"), raw.try_cast("timestamp")), once(F.trim(raw), lenient))


def to_bool(text) -> Column:
    """'true'/'false' (any case) -> boolean, anything else NULL."""
    return _c(text).try_cast("boolean")


def to_epoch_long(text) -> Column:
    """Numeric text -> rounded bigint (HALF_UP), NULL when not numeric."""
    return F.round(_c(text).try_cast("double")).try_cast("bigint")


def epoch_ms_to_s(ms) -> Column:
    """Milliseconds -> whole seconds, truncating like a cast."""
    return (_c(ms) / 1000).cast("bigint")


def any_not_null(cols: Iterable) -> Column:
    return reduce(lambda a, b: a | b, [_c(x).isNotNull() for x in cols])


def latest_stage(history) -> Column:
    """Newest (CreatedDate, StageName) of an opportunity history array.

    Same as sorting the projected structs descending and taking the first, but
    without a sort and without failing on an empty array (returns NULL)."""
    projected = F.transform(_c(history), lambda h: F.struct(h["CreatedDate"].alias("CreatedDate"),
                                                            h["StageName"].alias("StageName")))
    return F.array_max(projected)


def closed_won(is_closed, is_won) -> Column:
    return F.when((_c(is_closed) == F.lit(True)) & (_c(is_won) == F.lit(True)), F.lit(1)).otherwise(F.lit(0))
