"""Commit metadata conversions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: text of the epoch timestamp used when a commit has no date.
EPOCH = "1970-01-01 00:00:00"


def svn_date(text: Column) -> Column:
    """ISO-8601 text (``2011-05-31T06:04:39.500900Z``) -> TIMESTAMP (UTC);
    NULL or empty text -> the epoch."""
    cleaned = F.regexp_replace(F.regexp_replace(text, "Z$", ""), "T", " ")
    ts = F.try_to_timestamp(cleaned)
    return F.when((text.isNull()) | (text == ""), F.lit(EPOCH).cast("timestamp")).otherwise(ts)


def date_parts(ts: Column) -> Column:
    """struct(seconds, micros, offset) of a UTC timestamp."""
    us = F.unix_micros(ts.cast("timestamp"))
    secs = F.floor(us / F.lit(1_000_000)).cast("long")
    return F.struct(secs.alias("seconds"), (us - secs * 1_000_000).cast("int").alias("micros"),
                    F.lit("+0000").alias("offset"))


def parse_person(fullname: Column) -> Column:
    """``name <email>`` -> struct(fullname, name, email); empty parts NULL."""
    full = F.coalesce(fullname, F.lit(""))
    lt = F.instr(full, "<")
    raw_name = F.when(lt > 0, F.substring_index(full, "<", 1)).otherwise(full)
    rest = F.when(lt > 0, F.substring(full, lt + 1, 1 << 30))
    gt = F.instr(F.reverse(rest), ">")
    email = F.when(gt > 0, F.substring(rest, 1, F.length(rest) - gt)).otherwise(rest)
    return F.struct(full.alias("fullname"),
                    F.nullif(F.trim(raw_name), F.lit("")).alias("name"),
                    F.nullif(email, F.lit("")).alias("email"))
