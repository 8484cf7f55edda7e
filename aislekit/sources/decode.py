"""Column decoders for text-encoded values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PROMO_STRUCT = "array<struct<promotion_id:string,promotion_type:string,amount:double>>"


def parse_list(c: Column) -> Column:
    """JSON list, else a Python-literal list (single quotes), else [];
    null and '' give []."""
    js = F.from_json(c, "array<string>")
    py = F.from_json(F.translate(c, "'", '"'), "array<string>")
    return F.coalesce(js, py, F.array().cast("array<string>"))


def parse_list_of_struct(c: Column, ddl: str = PROMO_STRUCT) -> Column:
    """List of structs (e.g. applied promotions) from JSON or
    Python-literal text; unparsable text gives []."""
    return F.coalesce(F.from_json(c, ddl), F.from_json(F.translate(c, "'", '"'), ddl),
                      F.array().cast(ddl))


def parse_channels(c: Column) -> Column:
    """A literal list is parsed; other text is split on ',' and
    trimmed; null gives []."""
    s = F.trim(c)
    listed = parse_list(s)
    split = F.filter(F.transform(F.split(s, ","), lambda x: F.trim(x)), lambda x: x != "")
    return (F.when(c.isNull(), F.array().cast("array<string>"))
            .when(s.startswith("["), listed).otherwise(split))


def normalise_bool(c: Column) -> Column:
    """Text 'true' / 'false' in any case -> boolean; anything else null."""
    s = F.lower(F.trim(c.cast("string")))
    return F.when(s == "true", F.lit(True)).when(s == "false", F.lit(False))
