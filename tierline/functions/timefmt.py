"""Time helpers: arrival stamps, lenient parsing and ISO-8601 text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: ISO-8601 UTC text with whole seconds, as tickets carry it.
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"
# Same with microseconds, so that a round trip keeps every digit.
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def now() -> Column:
    """Current time; one value per query or micro-batch."""
    return F.current_timestamp()


def lenient_timestamp(text: Column | str) -> Column:
    """Text to timestamp; unparsable or null text gives null instead of an
    error (ANSI ``cast`` would raise). Text without a zone is UTC, whatever
    the session's zone is."""
    col = F.col(text) if isinstance(text, str) else text
    in_utc = [F.concat(col, F.lit(tail)).try_cast("timestamp") for tail in ("Z", "T00:00:00Z")]
    return F.coalesce(*in_utc, col.try_cast("timestamp"))


def iso_text(ts: Column | str, micros: bool = False) -> Column:
    """Format a timestamp as ISO-8601 UTC text. Zoned timestamps are converted
    to UTC first; wall-clock timestamps are UTC by definition. The session's
    zone has no influence."""
    col = F.col(ts) if isinstance(ts, str) else ts
    zoned = F.convert_timezone(F.current_timezone(), F.lit("UTC"), col.cast("timestamp_ntz")).cast("string")
    text = F.when(F.typeof(col) == "timestamp", zoned).otherwise(col.cast("timestamp_ntz").cast("string"))
    seconds = F.replace(F.substring_index(text, ".", 1), F.lit(" "), F.lit("T"))
    if not micros:
        return F.concat(seconds, F.lit("Z"))
    fraction = F.rpad(F.split_part(text, F.lit("."), F.lit(2)), 6, "0")
    return F.concat(seconds, F.lit("."), fraction, F.lit("Z"))


def epoch_seconds(ts: Column | None = None) -> Column:
    """Seconds since the epoch of ``ts`` (or of now)."""
    return F.unix_timestamp() if ts is None else F.unix_timestamp(ts)
