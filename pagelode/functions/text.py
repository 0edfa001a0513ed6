"""Text, time and payload expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tokens(text: Column) -> Column:
    """Lower-cased runs of letters and digits. No stop words, no stemming."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def iso_time(ts: Column) -> Column:
    """UTC time as ISO-8601 text; as usual, a zero fraction is left out."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(ts, ".SSSSSS")
    return F.concat(whole, F.when(fraction == ".000000", "").otherwise(fraction))


def epoch_seconds(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1e6)


def preview(content: Column, chars: int = 200) -> Column:
    text = F.coalesce(content, F.lit(""))
    return F.when(F.length(text) > chars,
                  F.concat(F.substring(text, 1, chars), F.lit("..."))).otherwise(text)


def backoff_delay(attempt: Column) -> Column:
    return F.pow(F.lit(2.0), attempt)


def json_ascii(text: Column) -> Column:
    """The text as it stands between the quotes of an ASCII-only JSON document."""
    plain = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    # The short escapes of JSON.
    for char, escape in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f")):
        plain = F.replace(plain, F.lit(char), F.lit(escape))
    wide = F.concat_ws("", F.transform(
        F.regexp_extract_all(plain, F.lit(r"(?s)[\x20-\x7e]+|."), F.lit(0)),
        lambda run: F.when(run.rlike(r"^[\x20-\x7e]"), run).otherwise(
            F.regexp_replace(F.lower(F.hex(F.encode(run, "UTF-16BE"))), "(.{4})", r"\\u$1")),
    ))
    return F.when(plain.rlike(r"[^\x20-\x7e]"), wide).otherwise(plain)


def payload_key(url: Column, depth: Column) -> Column:
    """The payload text of a queued URL; its bytes break ties of equal scores."""
    return F.concat(F.lit('{"url": "'), json_ascii(url), F.lit('", "depth": '),
                    depth.cast("string"), F.lit("}"))
