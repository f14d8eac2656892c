"""Typing of condition values.

Callers hand over text, numbers or booleans as they came from a form or a JSON
item. They are compared in the type of the column, as a database server would do
with an untyped bind value.
"""

from __future__ import annotations

import re
from decimal import Decimal
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Whitespace and line ends as ECMAScript defines them.
JS_SPACE = "\t\n\x0b\x0c\r \xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
JS_LINE_END = "\n\r\u2028\u2029"

_DECIMAL = re.compile(r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\Z", re.ASCII)
_RADIX = re.compile(r"0([xX][0-9a-fA-F]+|[oO][0-7]+|[bB][01]+)\Z")
_INFINITE = {"Infinity": float("inf"), "+Infinity": float("inf"), "-Infinity": float("-inf")}
_EDGES = re.compile(f"^[{JS_SPACE}]+|[{JS_SPACE}]+$")


def parse_number(text: str) -> Decimal | None:
    """The number a text stands for by ECMAScript rules; None for blank or other text."""
    text = _EDGES.sub("", text)
    if text in _INFINITE:
        return Decimal(text)
    if _RADIX.match(text):
        return Decimal(int(text, 0))
    return Decimal(text) if _DECIMAL.match(text) else None


def number_text(value: float | int | Decimal) -> str:
    """A number as ECMAScript prints it: ``7`` for 7.0, ``1e+21``, ``1e-7``."""
    number = float(value)
    if number != number:
        return "NaN"
    if number in (float("inf"), float("-inf")):
        return "Infinity" if number > 0 else "-Infinity"
    if number == 0:
        return "0"
    sign, digits, exponent = Decimal(repr(number)).normalize().as_tuple()
    text = "".join(map(str, digits))
    point = len(text) + exponent
    if 0 < point <= 21:
        body = text + "0" * exponent if exponent >= 0 else f"{text[:point]}.{text[point:]}"
    elif -6 < point <= 0:
        body = "0." + "0" * -point + text
    else:
        mantissa = text[0] + ("." + text[1:] if len(text) > 1 else "")
        body = f"{mantissa}e{'+' if point > 0 else '-'}{abs(point - 1)}"
    return ("-" if sign else "") + body


def value_text(value: Any) -> str:
    """Scalar to text: ``true``, ``null``, ``2023``; anything nested is refused."""
    if value is None:
        return "null"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float, Decimal)):
        return number_text(value)
    if isinstance(value, str):
        return value
    raise ValueError(f"expected a text, number or boolean, got {type(value).__name__}")


def _plain(number: Decimal) -> str:
    return format(number, "f") if number.is_finite() else str(number)


def typed_literal(value: Any, dtype: T.DataType, numeric_text: bool = False) -> Column:
    """``value`` as a literal of the column type ``dtype``.

    ``numeric_text`` applies to range conditions: text that reads as a number is
    taken as that number first, so ``"007"`` compares as ``7`` even with a text column.
    """
    if value is None:
        return F.lit(None).cast(dtype)
    if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
        text = str(value) if isinstance(value, int) else number_text(value)
    else:
        text = value_text(value)
    if numeric_text and not isinstance(value, bool):
        number = parse_number(text)
        if number is not None:
            text = number_text(number) if isinstance(dtype, T.StringType) else _plain(number)
    if isinstance(dtype, T.StringType):
        return F.lit(text)
    if isinstance(dtype, T.DecimalType) and _DECIMAL.match(text.strip()):
        # keep the scale of the value: rounding it to the column's would move a bound
        return F.lit(Decimal(text.strip()))
    return F.lit(text).cast(dtype)
