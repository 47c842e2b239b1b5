"""Reading loosely typed JSON payloads as Columns.

Producers send numbers as text, booleans as numbers and nulls where they mean nothing.
The rules are those of a dynamically typed consumer: a field counts as given when it is
truthy, and is then converted with int(), float() or str(). They are spelled out over
VARIANT values, so no Python runs per row. stream-safe.

Differences kept on purpose: a document with a bare NaN is malformed as a whole, and
objects or arrays in a scalar field count as unusable.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The texts that count as what.
NUMBER_TEXT = r"^\s*[+-]?(([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity|nan))\s*$"
WHOLE_KIND, OTHER_NUMBERS = "BIGINT", "D"  # DOUBLE, or DECIMAL with its precision and scale; JSON has no other kinds of numbers
NOT_ZERO = "[1-9]"


def decode(message: Column, binary: bool = True) -> Column:
    """UTF-8 bytes (or text) to VARIANT; null when the text is not JSON.

    ``cast`` and not ``decode`` turns bytes into text: invalid bytes then make one
    message malformed instead of failing the task.
    """
    return F.try_parse_json(message.cast("string") if binary else message)


def with_fields(
    df: DataFrame, value: str, names: Iterable[str], numbers: Iterable[str] = (), truthy: Iterable[str] | None = None,
    longs: Iterable[str] | None = None, doubles: Iterable[str] | None = None, strings: Iterable[str] | None = None,
    texts: Iterable[str] | None = None, numeric: Iterable[str] | None = None,
) -> DataFrame:
    """Parse a message column once and add what the fields hold.

    Per field: ``_kind_*``, ``_text_*``, ``_number_*`` (is it one), ``_string_*`` (str() of it) and ``_truthy_*``; where
    ``texts``, ``numeric``, ``strings`` and ``truthy`` are given, only for the fields they name: what nobody asks for is left
    out of the generated method, which the JVM compiles only up to 8,000 bytes;
    for the ``numbers`` also ``_long_*`` and ``_double_*``, or only what ``longs`` and ``doubles`` name. ``_object`` tells whether the message is a JSON object at all.

    The message is cut into its fields in one pass: a struct of VARIANT fields is null for
    anything but an object, and a field of it is null where the object has no such key.

    The values go through a one-element ``inline``. That keeps them computed once: a filter
    on something derived from them would otherwise be pushed below the parsing, which then
    runs again for every mention of a field.
    """
    names, numbers = list(names), list(numbers)
    longs, doubles = (numbers if asked is None else list(asked) for asked in (longs, doubles))
    truthy, strings, texts, numeric = (names if asked is None else list(asked) for asked in (truthy, strings, texts, numeric))
    shape = ", ".join(f"`{name}`: variant" for name in names)
    parsed = df.withColumn("_doc", F.try_variant_get(decode(F.col(value)), "$", f"struct<{shape}>"))
    read = {"_object": F.col("_doc").isNotNull()}
    for name in names:
        read[f"_kind_{name}"] = F.schema_of_variant(F.col("_doc")[name])
        read[f"_text_{name}"] = F.try_variant_get(F.col("_doc")[name], "$", "string")
    for name in longs:
        read[f"_long_{name}"] = F.try_variant_get(F.col("_doc")[name], "$", "bigint")
    for name in doubles:
        read[f"_double_{name}"] = F.try_variant_get(F.col("_doc")[name], "$", "double")
    judged = {}
    for name in names:
        kind, text = F.col(f"_kind_{name}"), F.col(f"_text_{name}")
        number = (kind == WHOLE_KIND) | kind.startswith(OTHER_NUMBERS)
        if name in numeric:
            judged[f"_number_{name}"] = number
        if name in strings:
            judged[f"_string_{name}"] = F.when((kind == "STRING") | number, text).when(kind == "BOOLEAN", F.initcap(text))
        if name in truthy:
            judged[f"_truthy_{name}"] = F.coalesce(
                F.when(kind == "STRING", text != "").when(number, text.rlike(NOT_ZERO)).otherwise((kind == "BOOLEAN") & (text == "true")),
                F.lit(False),
            )
    every = parsed.withColumns(read).withColumns(judged)
    unasked = {f"_text_{name}" for name in names if name not in texts}
    return every.select(*df.columns, F.inline(F.array(F.struct(*[c for c in read if c not in unasked], *judged))))


def is_object() -> Column:
    return F.col("_object")


class Field:
    """One field of a message read with ``with_fields``."""

    def __init__(self, name: str):
        self.name = name
        self.kind = F.col(f"_kind_{name}")
        self.text = F.col(f"_text_{name}")
        self.absent = self.kind.isNull()
        self.null = self.kind.eqNullSafe(F.lit("VOID"))
        self.missing = self.absent | self.null
        self.is_text = self.kind == "STRING"
        self.is_number = F.col(f"_number_{name}")

    def as_double(self) -> Column:
        """float(): numbers, flags and number text; anything else gives null."""
        unreadable = self.is_text & ~self.text.rlike(NUMBER_TEXT)
        return F.when(~unreadable, F.col(f"_double_{self.name}"))

    def as_long(self) -> Column:
        """int(): cuts fractions of numbers, reads whole-number text; anything else gives null."""
        return F.col(f"_long_{self.name}")

    def as_text(self) -> Column:
        """str() of a scalar; true and false are written with a capital."""
        return F.col(f"_string_{self.name}")

    def truthy(self) -> Column:
        """Given and not empty, zero or false."""
        return F.col(f"_truthy_{self.name}")

    def text_or(self, default: Column | str, literal_null: bool = False) -> Column:
        """Text with a default for an absent field.

        An explicit null takes the default too, unless ``literal_null`` asks for the
        word ``None`` that a str() of it would give.
        """
        default = F.lit(default) if isinstance(default, str) else default
        if not literal_null:
            return F.when(self.missing, default).otherwise(self.as_text())
        return F.when(self.absent, default).when(self.null, F.lit("None")).otherwise(self.as_text())
