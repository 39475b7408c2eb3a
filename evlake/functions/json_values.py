"""Reading loosely typed JSON held as VARIANT.

A field is taken only when its JSON type is usable: casting first and checking
later would turn ``true`` into 1 and 1.5 into 1. All of it is built-in column
expressions.

Taking a sub-value out as VARIANT re-encodes it, so objects are opened with one
cast to a struct of the wanted members (:func:`members`) instead of one path
lookup per field.
"""

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from evlake.fixed_values import WHITESPACE

_NUMBER_KINDS = r"^(BIGINT|DOUBLE|DECIMAL)"
# VARIANT keeps 1.0 as a decimal without a fraction. A decimal of more than 18
# digits is an integer that did not fit 64 bits.
_INTEGRAL_FLOAT = r"^DECIMAL\((\d|1[0-8]),0\)$"
_WHOLE_NUMBER = r"^[+-]?[0-9]+(?:_[0-9]+)*$"
_EMPTY_JSON = r'^(null|false|""|\{\}|\[\]|-?0(\.0*)?([eE][+-]?\d+)?)$'


def slot(name: str) -> str:
    """Column name for a JSON member; Spark's names ignore case, JSON's do not."""
    return re.sub("([A-Z])", r"^\1", name)


def members(names: list[str]) -> str:
    """Type of a struct with the given object members, each left as VARIANT."""
    return "struct<" + ", ".join(f"`{n}`: variant" for n in names) + ">"


def slots(names: list[str]) -> str:
    """The same type with the names made distinct; a cast to it renames."""
    return members([slot(n) for n in names])


def open_object(value: Column, names: list[str], path: str = "$") -> Column:
    """The named members of a JSON object; null when there is no object."""
    return F.try_variant_get(value, path, members(names)).cast(slots(names))


def member(obj: Column, name: str) -> Column:
    return obj[slot(name)]


def kind(value: Column) -> Column:
    """JSON type as text: STRING, BIGINT, DECIMAL(p,s), DOUBLE, BOOLEAN, VOID, ..."""
    return F.schema_of_variant(value)


def as_text(value: Column) -> Column:
    return F.try_variant_get(value, "$", "string")


def strip(text: Column) -> Column:
    """Text without surrounding whitespace, Unicode blanks included."""
    return F.btrim(text, F.lit(WHITESPACE))


def non_blank(text: Column) -> Column:
    """Stripped text, null when nothing is left.

    From the first to the last character that is no blank; written so that
    ``text``, costly to take out of a VARIANT, is evaluated once.
    """
    seen = f"[^{WHITESPACE}]"
    return F.get(F.regexp_extract_all(text, F.lit(f"(?s){seen}(?:.*{seen})?"), F.lit(0)), F.lit(0))


def string_only(value: Column) -> Column:
    """A JSON string as it is; any other type null."""
    return F.when(kind(value) == "STRING", as_text(value))


def text_value(value: Column) -> Column:
    """A non-blank string, stripped, or a number written out; anything else null."""
    t, text = kind(value), as_text(value)
    return (
        F.when(t == "STRING", non_blank(text))
        .when(t.rlike(_INTEGRAL_FLOAT), F.concat(text, F.lit(".0")))
        .when(t.rlike(_NUMBER_KINDS), text)
    )


def whole_value(value: Column) -> Column:
    """A 64-bit integer from an integer, an integral number or integer text."""
    t = kind(value)
    number = F.try_variant_get(value, "$", "bigint")
    real = F.try_variant_get(value, "$", "double")
    text = strip(as_text(value))
    return (
        F.when((t == "BIGINT") | t.rlike(r"^DECIMAL\(\d+,0\)$"), number)
        .when(t == "DOUBLE", F.when((real % 1 == 0) & (real < F.lit(float(2**63))), number))
        .when(
            (t == "STRING") & text.rlike(_WHOLE_NUMBER),
            F.replace(text, F.lit("_"), F.lit("")).try_cast("bigint"),
        )
    )


def _first(obj: Column, names: list[str], read: Callable[[Column], Column]) -> Column:
    """First non-null reading among the struct fields ``names``.

    An object rarely has two spellings of one field, so the general case sits in
    a branch of its own: reading every spelling in place makes generated code so
    long that the JVM leaves it uncompiled.
    """
    values = [member(obj, n) for n in names]
    present = sum((v.isNotNull().cast("int") for v in values), F.lit(0))
    readings = F.transform(F.array(*values), read)
    return F.when(present < 2, read(F.coalesce(*values))).otherwise(
        F.get(F.array_compact(readings), F.lit(0))
    )


def first_text(obj: Column, names: list[str]) -> Column:
    """First usable text among struct fields ``names``."""
    return _first(obj, names, text_value)


def first_whole(obj: Column, names: list[str]) -> Column:
    """First usable integer among struct fields ``names``."""
    return _first(obj, names, whole_value)


def is_empty(value: Column) -> Column:
    """Absent, null, false, zero, or an empty string, array or object."""
    return F.coalesce(F.to_json(value).rlike(_EMPTY_JSON), F.lit(True))


def either(first: Column, second: Column) -> Column:
    """``first``, or ``second`` when ``first`` is empty.

    A non-empty value of the wrong type still hides ``second``. The emptiness
    test runs only where ``second`` exists.
    """
    return F.when(second.isNotNull() & is_empty(first), second).otherwise(first)
