"""Time parsing and normalisation expressions (FN-3, COE-3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two upload-time layouts the manifest uses, and the
# output layout of normalised times.
# The closing Z is read as the zone it names, whatever the session's zone is.
ISO_FORMATS = ["yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"]
OUT_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def parse_iso(col, formats: list[str] | None = None) -> Column:
    """First format that parses wins; NULL marks an unparsable time."""
    c = _c(col)
    fmts = formats or ISO_FORMATS
    parsed = [F.try_to_timestamp(c, F.lit(f)) for f in fmts]
    # fractions shorter than six digits
    parsed.append(F.when(c.rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{1,9}Z$"), F.try_to_timestamp(c)))
    return F.coalesce(*parsed)


def format_iso(col, fmt: str = OUT_FORMAT) -> Column:
    """An instant as UTC text, independent of the session zone."""
    ts = _c(col)
    if fmt != OUT_FORMAT:
        return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), fmt)
    secs = F.floor(F.unix_micros(ts) / F.lit(1_000_000))
    day = F.floor(secs / F.lit(86_400))
    left = secs - day * F.lit(86_400)

    def two(x) -> Column:
        return F.lpad(F.floor(x).cast("string"), 2, "0")

    return F.concat(F.date_from_unix_date(day.cast("int")).cast("string"), F.lit("T"), two(left / 3600), F.lit(":"),
                    two((left % 3600) / 60), F.lit(":"), two(left % 60), F.lit("Z"))


# text that names its offset or zone itself
OFFSET_RX = r"\d:\d\d(:\d\d(\.\d+)?)?\s*(Z|UTC|GMT|[+-]\d{1,2}(:?\d\d)?|[A-Za-z]+/[A-Za-z_/]+)$"


def to_utc(col, source_tz: str | None = None) -> Column:
    """Time text -> instant, whatever the session zone is: text that
    carries an offset or zone is converted by it, other text is the wall
    clock of ``source_tz`` (UTC when not given). Unparsable -> NULL."""
    c = _c(col).cast("string")
    wall = c.try_cast("timestamp_ntz")
    if source_tz:
        wall = F.convert_timezone(F.lit(source_tz), F.lit("UTC"), wall)
    # by calendar parts: Spark would read a difference of wall clocks in the session zone
    seconds = (F.unix_date(wall.cast("date")).cast("long") * 86_400 + F.hour(wall) * 3_600 + F.minute(wall) * 60)
    micros = seconds * 1_000_000 + (F.date_part(F.lit("SECOND"), wall) * 1_000_000).cast("long")
    return F.when(c.rlike(OFFSET_RX), F.try_to_timestamp(c)).otherwise(F.timestamp_micros(micros))


def days_since_epoch(col) -> Column:
    """Whole days since 1970-01-01 (COE-3 ``integer`` mode): floor of the
    elapsed time in days, like subtracting the epoch and taking ``days``."""
    c = _c(col)
    secs = F.unix_micros(to_utc(c))
    return F.floor(secs / F.lit(86_400_000_000)).cast("int")
