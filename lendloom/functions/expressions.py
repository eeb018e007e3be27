"""Column expressions that several layers share."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The text that stands for a null in a surrogate key, and the id of unknown members.
NULL_IN_KEY = "_dbt_utils_surrogate_key_null_"
UNKNOWN = "__UNKNOWN__"
#: Characters besides white space after which initcap_words begins a new word.
WORD_BREAKS = r"""!?@"^#$&~_,.:;+\-*%/|\\\[\](){}<>"""


def col(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def surrogate_key(*columns: str | Column) -> Column:
    """MD5 of the columns' text joined by hyphens; a null column still counts."""
    return F.md5(F.concat_ws("-", *(F.coalesce(col(c).cast("string"), F.lit(NULL_IN_KEY)) for c in columns)).cast("binary"))


def unknown_key() -> Column:
    return surrogate_key(F.lit(UNKNOWN))


def date_key(day: str | Column) -> Column:
    """A date as the number yyyymmdd."""
    return F.date_format(col(day), "yyyyMMdd").cast("int")


def initcap_words(text: str | Column) -> Column:
    """Each word's first letter in upper case, the rest lower; words end at white space and punctuation."""
    parts = F.regexp_extract_all(F.lower(col(text)), F.lit(rf"([\s{WORD_BREAKS}]+|[^\s{WORD_BREAKS}]+)"), F.lit(1))
    return F.when(col(text).isNotNull(), F.array_join(F.transform(parts, F.initcap), ""))


def full_match(text: str | Column, pattern: str) -> Column:
    """Whether the whole text matches; rlike alone would look for a match anywhere."""
    return col(text).rlike(rf"\A(?:{pattern})\z")


def variant_text(record: str | Column, field: str, kind: str = "string") -> Column:
    """A field of a VARIANT record; missing fields and JSON nulls are null."""
    return F.try_variant_get(col(record), f"$.{field}", kind)


def has_field(record: str | Column, field: str) -> Column:
    """Whether the field is there, JSON null included."""
    return F.try_variant_get(col(record), f"$.{field}", "variant").isNotNull()


def object_construct(keep_null: bool = False, **fields: str | Column) -> Column:
    """A VARIANT object of the fields; those that are null are left out unless keep_null, which makes them JSON nulls."""
    text = F.to_json(F.struct(*(col(v).alias(k) for k, v in fields.items())), {"ignoreNullFields": str(not keep_null).lower()})
    return F.parse_json(text)


def record_hash(record: str | Column) -> Column:
    """SHA-256 of a VARIANT record's canonical JSON text."""
    return F.sha2(F.to_json(col(record)), 256)


def blank_to_null(text: str | Column) -> Column:
    return F.nullif(F.trim(col(text)), F.lit(""))


def safe_pct(part: Column, whole: Column) -> Column:
    """100 * part / whole to two places, null where whole is 0. Decimal arithmetic, so no ties are lost to floats."""
    return F.round(F.lit(100) * part.cast("decimal(20,0)") / F.nullif(whole.cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)")), 2)


def days_between(start: str | Column, end: str | Column) -> Column:
    """Calendar days from start to end: midnights crossed, not whole days passed."""
    return F.datediff(col(end), col(start))


def base_name(path: str | Column) -> Column:
    return F.regexp_extract(col(path), "[^/]+$", 0)


TABLE_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_$]*(?:\.[A-Za-z_][A-Za-z0-9_$]*){0,2}")


def checked_name(name: str) -> str:
    """The name, if it is safe to resolve as a table."""
    if not TABLE_NAME.fullmatch(name):
        raise ValueError(f"not a table name: {name!r}")
    return name
