"""Column-level helpers.  All are built-in Spark expressions (JVM side, inside
whole-stage codegen); none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from roadlens import schemas as S

_REGEX_META = set(r".^$*+?()[]{}|\/")


def _regex_quote(sep: str) -> str:
    return "".join("\\" + ch if ch in _REGEX_META else ch for ch in sep)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def java_split(c, sep: str) -> Column:
    """Split like ``java.lang.String.split(sep)``: trailing empty pieces are
    dropped, leading and interior ones kept; ``""`` gives ``[""]`` and a
    string made only of separators gives ``[]``.  Spark's ``split`` keeps
    trailing empties, hence the strip first."""
    x = _col(c)
    q = _regex_quote(sep)
    if len(sep) == 1:
        stripped = F.rtrim(x, F.lit(sep))  # trailing run of one character
    else:
        stripped = F.regexp_replace(x, "(" + q + ")+\\z", "")
    return (F.when((x != F.lit("")) & (stripped == F.lit("")), F.array().cast("array<string>"))
            .otherwise(F.split(stripped, q)))


def parse_log_time(c, fmt: str = S.LOG_TIME_FORMAT) -> Column:
    """Text time of a log line -> TIMESTAMP_NTZ (NULL when malformed)."""
    return F.try_to_timestamp(_col(c), F.lit(fmt)).cast("timestamp_ntz")


def format_log_time(c, fmt: str = S.LOG_TIME_FORMAT) -> Column:
    return F.date_format(_col(c), fmt)


def hour_of_text(c) -> Column:
    """Hour cut from a raw ``dd/MM/yyyy HH:mm:ss`` text without validation:
    the text must split on blank into exactly two pieces and the second on
    ``:`` into exactly three; otherwise the hour is ``""`` (kept as a group)."""
    x = _col(c)
    parts = java_split(x, " ")
    clock = F.try_element_at(parts, F.lit(2))
    pieces = java_split(clock, ":")
    ok = (x.contains(" ") & (F.size(parts) == 2) & clock.contains(":") & (F.size(pieces) == 3))
    return F.when(ok, F.try_element_at(pieces, F.lit(1))).otherwise(F.lit(""))


def hour_of_time(c) -> Column:
    """Two-digit hour of a timestamp column; NULL time -> ``""``.  The hour
    is extracted as an integer and padded (no date formatter per row)."""
    return F.coalesce(F.lpad(F.hour(_col(c)).cast("string"), 2, "0"), F.lit(""))


def truncating_average(total: str, n: str) -> Column:
    """Integer average ``total div n`` of two named columns (truncates toward
    zero like Java int division); NULL when ``n`` is 0."""
    return F.expr(f"CASE WHEN `{n}` <> 0 THEN CAST(`{total}` AS BIGINT) div `{n}` END")


def whole_number(c) -> Column:
    """A reading as a whole number, fractions cut off; NULL for NULL, NaN,
    infinity and what is no number, never an error."""
    return _col(c).try_cast("bigint")


def is_over(c, limit) -> Column:
    """``c > limit``; NaN is over no limit."""
    x = _col(c)
    return (x > limit) & (x != F.lit(float("nan")))


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def duration_seconds(text: str) -> int:
    """Whole seconds of a duration text such as ``60 seconds`` or ``1 hour``."""
    n, unit = text.split()
    seconds = _UNIT_SECONDS.get(unit.lower().removesuffix("s"))
    if seconds is None or int(n) < 1:
        raise ValueError(f"not a duration in seconds to weeks: {text!r}")
    return int(n) * seconds


def congestion_level(speed) -> Column:
    """Level of an average speed: <=5 jammed, <=10 severe, <=30 slow, else normal."""
    s = _col(speed)
    expr = None
    for limit, name in S.CONGESTION_LEVELS:
        expr = F.when(s <= limit, F.lit(name)) if expr is None else expr.when(s <= limit, F.lit(name))
    return expr.otherwise(F.lit(S.CONGESTION_DEFAULT))


def monitor_of_props(props="props", field: str = "k") -> Column:
    """Integer monitor id held in a JSON text column (``{"k": 7}``)."""
    return F.get_json_object(_col(props), "$." + field).try_cast("int")


__all__ = [
    "java_split", "parse_log_time", "format_log_time", "hour_of_text", "hour_of_time",
    "truncating_average", "whole_number", "is_over", "duration_seconds", "congestion_level", "monitor_of_props",
]
