"""Line formats: syslog and the combined access log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed line formats.
SYSLOG = r"^([A-Z][a-z]{2}) +([0-9]{1,2}) ([0-9]{2}:[0-9]{2}:[0-9]{2}) (\S+) ([^\s:\[]+)(?:\[([0-9]+)\])?: (.*)$"
ACCESS = (
    r'^(\S+) (\S+) (\S+) \[([^\]]+)\] "(?:(\S+) (\S+)(?: HTTP/([0-9.]+))?|-)" ([0-9]{3}) ([0-9]+|-)'
    r' "([^"]*)" "([^"]*)"$'
)


MARK = "\u0001"


def _parts(column: str, pattern: str, groups: int) -> Column:
    """All groups of a match as an array, from one evaluation of the pattern; NULL without a match."""
    joined = F.regexp_replace(column, pattern, MARK.join(f"${i}" for i in range(1, groups + 1)))
    parts = F.split(joined, MARK)
    return F.when(F.size(parts) == groups, parts)


def _text(parts: Column, index: int, absent: str = "") -> Column:
    return F.nullif(parts[index], F.lit(absent))


def parse_syslog(df: DataFrame, column: str, year: int) -> DataFrame:
    """Add time, host, program, pid and message; unparsable lines get NULL fields.

    The text has no year, so the caller names it.  One- and two-digit days both parse.
    """
    parsed = df.withColumn("_p", _parts(column, SYSLOG, 7))
    p = F.col("_p")
    stamp = F.concat_ws(" ", F.lit(str(int(year))), p[0], p[1], p[2])
    return parsed.withColumns({
        "event_ts": F.try_to_timestamp(F.when(p.isNotNull(), stamp), F.lit("yyyy MMM d HH:mm:ss")),
        "logsource": _text(p, 3), "program": _text(p, 4), "pid": _text(p, 5).try_cast("int"), "syslog_message": p[6],
    }).drop("_p")


ACCESS_FIELDS = (
    "client", "ident", "auth", "stamp", "verb", "path", "http_version", "status", "bytes", "referrer", "agent",
)


def parse_access(df: DataFrame, column: str) -> DataFrame:
    """Add the fields of a combined access-log line; `-` means absent."""
    parsed = df.withColumn("_p", _parts(column, ACCESS, len(ACCESS_FIELDS)))
    part = {n: F.nullif(_text(F.col("_p"), i), F.lit("-")) for i, n in enumerate(ACCESS_FIELDS)}
    stamp = part.pop("stamp")
    part["status"], part["bytes"] = part["status"].try_cast("int"), part["bytes"].try_cast("bigint")
    return parsed.withColumns({
        "event_ts": F.try_to_timestamp(stamp, F.lit("dd/MMM/yyyy:HH:mm:ss Z")), **part,
    }).drop("_p")
