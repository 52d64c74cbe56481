"""Column helpers for JSON text kept one object per line."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweir.functions.time import naive_utc


def strip(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\n\r\x0b\x0c"))


def is_blank(line: Column) -> Column:
    return strip(line) == ""


def split_response(pages: DataFrame) -> DataFrame:
    """One row per element of the JSON arrays in ``value``, as text."""
    items = F.from_json("value", "array<string>")
    return pages.select(F.explode(items).alias("value"))


def add_ingested_at(line: Column, moment: datetime | str | None = None) -> Column:
    """Put ``_ingested_at`` at the end of a JSON object.

    The text is spliced, so keys no schema knows about survive. An earlier
    ``_ingested_at`` is overruled: JSON readers keep the last of equal keys.
    """
    stamp = f'"_ingested_at":"{naive_utc(moment).isoformat()}Z"}}'
    whole = strip(line)
    body = strip(F.substring(whole, F.lit(1), F.length(whole) - 1))
    comma = F.when(body == "{", "").otherwise(",")
    return F.concat(body, comma, F.lit(stamp))


def payload_text(payload: Column, line: Column) -> Column:
    """JSON text of a payload; an empty, zero or false payload becomes NULL.

    ``payload`` is the field as parsed to a string, which no longer tells the
    string "0" from the number. Payloads are objects in practice; only the
    others are looked up again in the line.
    """
    nested = payload.startswith("{") | payload.startswith("[")
    looked_up = F.to_json(F.variant_get(F.try_parse_json(line), "$.payload", "variant"))
    scalar = F.coalesce(looked_up, payload)
    empty_scalar = scalar.isin('""', "false") | F.coalesce(
        scalar.try_cast("double") == 0, F.lit(False)
    )
    return F.when(nested & ~payload.isin("{}", "[]"), payload).when(
        payload.isNotNull() & ~nested & ~empty_scalar, scalar
    )
