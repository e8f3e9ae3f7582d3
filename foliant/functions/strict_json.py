"""JSON as the standard has it: constants such as NaN are not values."""

from __future__ import annotations

import json


def _no_constant(name: str):
    raise ValueError(f"{name} is not JSON")


def _number(text: str) -> int | float:
    """A number with a point or an exponent; a whole one is equal to the one without: 1754.0 is 1754."""
    value = float(text)
    return int(value) if value.is_integer() else value


_DECODER, _WHOLE = json.JSONDecoder(parse_constant=_no_constant), json.JSONDecoder(parse_constant=_no_constant, parse_float=_number)


def loads(text: str | bytes, whole: bool = False):
    """The value of a JSON text; ValueError if it isn't one, or is nested too deeply to read. `whole` reads 1754.0 as 1754."""
    if isinstance(text, bytes):
        text = text.decode("utf-8", "surrogatepass")
    if text.startswith("\ufeff"):
        raise ValueError("a byte order mark is not JSON")
    try:
        return (_WHOLE if whole else _DECODER).decode(text)
    except RecursionError:
        raise ValueError("nested too deeply") from None
