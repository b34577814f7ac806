"""Filter patterns of log subscriptions, as column expressions.

``{ ($.kind = "SERVER" || $.attributes.['http.code'] >= 500) && $.parent NOT EXISTS }``

A field is a path from ``$``: names, quoted names in brackets, list places. It is
compared with a text (``*`` stands for anything), a number or a ``%regular expression%``,
or tested with EXISTS, NOT EXISTS, IS NULL, IS TRUE or IS FALSE. ``&&`` binds closer than
``||``. Texts match JSON strings only and numbers JSON numbers only; ``= *`` matches
whatever is there, also null; no comparison holds for a field that is absent.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from spanflow.functions.json import field, present, strict_bool, strict_str, type_name

# Fixed value: the pattern that a subscription has by default.
DEFAULT_PATTERN = (
    "{ (($.resource.attributes.['service.name'] = * || $.attributes.['aws.local.service'] = *)"
    " && $.attributes.['aws.xray.inprogress'] NOT EXISTS) || ($._aws.xray.decorator_type = \"managed_link\") }"
)

_NAME = r"[A-Za-z_][A-Za-z0-9_-]*"
_STEP = re.compile(rf"""\.?\['([^']*)'\]|\.?\["([^"]*)"\]|\.?\[(\d+)\]|\.({_NAME})""")
_TOKEN = re.compile(
    rf"""\s*(?:(?P<field>\$(?:\.?\['[^']*'\]|\.?\["[^"]*"\]|\.?\[\d+\]|\.{_NAME})+)"""
    r"""|(?P<sign>&&|\|\||<=|>=|!=|=|<|>|\(|\))"""
    r"""|(?P<test>NOT\s+EXISTS|EXISTS|IS\s+NULL|IS\s+TRUE|IS\s+FALSE)(?![^\s()&|])"""
    r"""|"(?P<quoted>(?:[^"\\]|\\.)*)"|%(?P<regex>[^%]+)%"""
    r"""|(?P<number>[-+]?\d+(?:\.\d+)?(?:[eE][-+]?\d+)?)(?![^\s()&|])|(?P<bare>[^\s()&|="<>!]+))\s*"""
)
_NUMBERS = r"^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL.*)$"


def _path(text: str) -> str:
    """A pattern's field as a VARIANT path."""
    parts = []
    for single, double, place, name in _STEP.findall(text):
        if place:
            parts.append(f"[{place}]")
        elif "'" in double:
            parts.append(f'["{double}"]')
        else:
            parts.append(f"['{single or double or name}']")
    return "$" + "".join(parts)


def _tokens(text: str) -> list[tuple[str, str]]:
    found, at = [], 0
    while at < len(text):
        token = _TOKEN.match(text, at)
        if not token:
            raise ValueError(f"filter pattern: cannot read {text[at:]!r}")
        found.append((token.lastgroup, token[token.lastgroup]))
        at = token.end()
    return found


def _wildcards(text: str) -> str:
    return "^(?s:" + ".*".join(re.escape(part) for part in text.split("*")) + ")$"


def _number(record: Column, path: str) -> Column:
    """The value as a double if it is a JSON number."""
    kind = type_name(field(record, path))
    return F.when(kind.rlike(_NUMBERS), F.try_variant_get(record, path, "double"))


def _comparison(record: Column, path: str, sign: str, kind: str, text: str) -> Column:
    if kind == "number":
        value, other = _number(record, path), F.lit(float(text))
        holds = {"=": value == other, "!=": value == other, "<": value < other, ">": value > other, "<=": value <= other, ">=": value >= other}[sign]
    elif sign not in ("=", "!="):
        raise ValueError(f"filter pattern: {sign} needs a number, not {text!r}")
    elif kind == "regex":
        holds = strict_str(record, path).rlike(text)
    elif kind == "bare" and text == "*":
        holds = present(record, path)
    else:
        text = re.sub(r"\\(.)", r"\1", text) if kind == "quoted" else text
        value = strict_str(record, path)
        holds = value.rlike(_wildcards(text)) if "*" in text else value == text
    holds = F.coalesce(holds, F.lit(False))
    return present(record, path) & ~holds if sign == "!=" else holds


def _test(record: Column, path: str, test: str) -> Column:
    if test.endswith("EXISTS"):
        there = present(record, path)
        return ~there if test.startswith("NOT") else there
    if test == "IS NULL":
        return F.coalesce(F.is_variant_null(field(record, path)), F.lit(False))
    return F.coalesce(strict_bool(record, path) == (test == "IS TRUE"), F.lit(False))


def filter_pattern(text: str) -> Callable[[Column], Column]:
    """A pattern as a function from a parsed record to true or false, never null."""
    inner = text.strip()
    if not (inner.startswith("{") and inner.endswith("}")):
        raise ValueError("filter pattern: braces are missing")
    tokens = _tokens(inner[1:-1].strip())

    def build(record: Column) -> Column:
        left = list(reversed(tokens))

        def take() -> tuple[str, str]:
            if not left:
                raise ValueError("filter pattern: ends too early")
            return left.pop()

        def any_of() -> Column:
            found = all_of()
            while left and left[-1] == ("sign", "||"):
                left.pop()
                found = found | all_of()
            return found

        def all_of() -> Column:
            found = one()
            while left and left[-1] == ("sign", "&&"):
                left.pop()
                found = found & one()
            return found

        def one() -> Column:
            kind, value = take()
            if (kind, value) == ("sign", "("):
                found = any_of()
                if take() != ("sign", ")"):
                    raise ValueError("filter pattern: a bracket is not closed")
                return found
            if kind != "field":
                raise ValueError(f"filter pattern: a field was expected, not {value!r}")
            path = _path(value)
            kind, value = take()
            if kind == "test":
                return _test(record, path, " ".join(value.split()))
            if kind != "sign" or value not in ("=", "!=", "<", ">", "<=", ">="):
                raise ValueError(f"filter pattern: a comparison was expected, not {value!r}")
            other, operand = take()
            if other in ("sign", "field", "test"):
                raise ValueError(f"filter pattern: a value was expected, not {operand!r}")
            return _comparison(record, path, value, other, operand)

        found = any_of()
        if left:
            raise ValueError(f"filter pattern: {left[-1][1]!r} was not expected")
        return found

    build(F.lit(None).cast("variant"))  # so that a wrong pattern fails here
    return build
