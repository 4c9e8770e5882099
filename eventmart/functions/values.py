"""Column expressions over JSON values held as VARIANT.

A SQL NULL variant means the key is absent; a JSON ``null`` is a non-null variant.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as white space at the ends of a log line.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Spellings of a floating-point number that are accepted in text.
FLOAT_PATTERN = (
    r"(?i)^[+-]?((\d+(_\d+)*)(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)(e[+-]?\d+(_\d+)*)?$"
    r"|^[+-]?(inf|infinity|nan)$"
)


def strip(text: Column) -> Column:
    """Trim all white space; only the ends of the text are looked at."""
    return F.btrim(text, F.lit(WHITESPACE))


def field(value: Column, key: str) -> Column:
    return F.try_variant_get(value, f"$.{key}", "variant")


def as_text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def as_list(value: Column) -> Column:
    return value.try_cast("array<variant>")


def as_object(value: Column) -> Column:
    return value.try_cast("map<string,variant>")


def is_object(value: Column) -> Column:
    return as_object(value).isNotNull()


def is_text(value: Column) -> Column:
    return F.schema_of_variant(value) == "STRING"


def is_boolean(value: Column) -> Column:
    return F.schema_of_variant(value) == "BOOLEAN"


def parse_float(text: Column) -> Column:
    """Text to double; NULL when the text is not a number."""
    bare = strip(text)
    return F.when(bare.rlike(FLOAT_PATTERN), F.replace(bare, F.lit("_"), F.lit("")).try_cast("double"))


def as_float(value: Column) -> Column:
    """Number, boolean or numeric text to double; NULL for anything else."""
    return F.when(is_text(value), parse_float(as_text(value))).otherwise(
        F.try_variant_get(value, "$", "double")
    )


def float_or_default(value: Column, default: float = 0.0) -> Column:
    """An absent key gives the default; a present one that is no number gives NULL."""
    return F.when(value.isNull(), F.lit(default)).otherwise(as_float(value))


def text_or_default(value: Column, default: str = "") -> Column:
    return F.when(value.isNull(), F.lit(default)).otherwise(as_text(value))


def is_truthy(value: Column) -> Column:
    """False for absent, null, false, 0, "", [] and {}; the text "0" is true."""
    kind = F.schema_of_variant(value)
    return F.coalesce(
        F.when(kind == "VOID", F.lit(False))
        .when(kind == "STRING", as_text(value) != "")
        .when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
        .when(kind.startswith("OBJECT"), kind != "OBJECT<>")
        .when(kind.startswith("ARRAY"), F.size(as_list(value)) > 0)
        .otherwise(F.try_variant_get(value, "$", "double") != 0.0),
        F.lit(False),
    )


def json_constant(text: Column) -> Column:
    """A text column as a JSON string value."""
    return text.cast("variant")
