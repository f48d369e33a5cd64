"""Text hygiene as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardweave.functions import lookups as L

# U+2028, U+2029, carriage return, line feed: each becomes one space
_LINE_BREAKS = "\u2028\u2029\r\n"


def norm_text(col: Column) -> Column:
    """Trimmed, lower-cased, with runs of white space squeezed to one space."""
    return F.regexp_replace(F.lower(F.trim(col)), r"\s+", " ")


def blank_to_null(col: Column) -> Column:
    """Trimmed text; NULL where nothing is left."""
    return F.nullif(F.trim(col), F.lit(""))


def scrub_line_breaks(col: Column) -> Column:
    """One record must stay one line: line separators become spaces."""
    return F.translate(col, _LINE_BREAKS, " " * len(_LINE_BREAKS))


def normalise_url(col: Column) -> Column:
    """Lower-cased, trimmed, without trailing slashes; NULL when blank."""
    return F.nullif(F.regexp_replace(F.lower(F.trim(col)), "/+$", ""), F.lit(""))


def redact_email_text(col: Column) -> Column:
    return F.regexp_replace(col, L.EMAIL_PATTERN, L.EMAIL_MASK)


def has_email(col: Column) -> Column:
    return F.coalesce(col.rlike(L.EMAIL_PATTERN), F.lit(False))


def redact_emails(df: DataFrame, keep: tuple[str, ...] = ("SourceUrl",), arrays: bool = False,
                  count_as: str = "emails_redacted") -> DataFrame:
    """Mask e-mail addresses in every string column outside ``keep``.

    ``count_as`` receives the number of fields changed on the row. With
    ``arrays`` the elements of array<string> columns are masked as well (and
    an array with at least one hit counts as one field).
    """
    string_array = T.ArrayType(T.StringType())
    columns, hits = [], []
    for field in df.schema.fields:
        col = F.col(f"`{field.name}`")
        if field.name in keep:
            columns.append(col)
        elif isinstance(field.dataType, T.StringType):
            columns.append(redact_email_text(col).alias(field.name))
            hits.append(has_email(col).cast("int"))
        elif arrays and field.dataType.simpleString() == string_array.simpleString():
            columns.append(F.transform(col, redact_email_text).alias(field.name))
            hits.append(F.coalesce(F.exists(col, has_email), F.lit(False)).cast("int"))
        else:
            columns.append(col)
    changed = sum(hits[1:], hits[0]) if hits else F.lit(0)
    return df.select(*columns, changed.alias(count_as))


def json_string_array(col: Column) -> Column:
    """array<string> -> JSON array text with proper escaping."""
    return F.to_json(col)


def path_tail(col: Column, parts: int = 2) -> Column:
    """Last ``parts`` components of a path."""
    return F.regexp_extract(col, "/".join(["[^/]+"] * parts) + "$", 0)
