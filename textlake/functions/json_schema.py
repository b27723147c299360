"""JSON Schema documents compiled to column expressions over JSON texts.

A text is parsed once to a variant, whose values keep their JSON types, so a number is no text and a
text no number anywhere, in lists and nested objects too. Each keyword of a document becomes a
condition; a keyword that isn't known is an error when the document is compiled, never a rule that is passed over.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping

from pyspark.sql import Column, functions as F

Test = Callable[[Column], Column]
#: What Spark calls the types of values of a JSON type.
_NUMBER = r"(?:BIGINT|DECIMAL\(.*\)|DOUBLE|FLOAT)"
_SCALARS = {"string": "STRING", "boolean": "BOOLEAN", "null": "VOID", "number": _NUMBER, "integer": _NUMBER}


def _let(value: Column, body: Test) -> Column:
    """``body`` of ``value``, which is evaluated once however often ``body`` has it."""
    return F.transform(F.array(value), lambda x: body(x))[0]


def _all(tests: list[Column]) -> Column:
    return functools.reduce(Column.__and__, tests) if tests else F.lit(True)


def _names(names) -> Column:
    return F.array(*map(F.lit, names)).cast("array<string>")


def _text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def _real(v: Column) -> Column:
    return F.try_variant_get(v, "$", "double")


def _list(v: Column) -> Column:
    """The items of a list; null for other values."""
    return F.try_variant_get(v, "$", "array<variant>")


def _fields(v: Column) -> Column:
    """The fields of an object by name; null for other values."""
    return F.try_variant_get(v, "$", "map<string,variant>")


def _scalar(kind: str) -> Test:
    return lambda v: F.schema_of_variant(v).rlike(f"^{_SCALARS[kind]}$")


def _one_of(values: list) -> Test:
    if odd := [x for x in values if isinstance(x, bool) or not isinstance(x, str | int | float)]:
        raise ValueError(f"enum and const take texts and numbers, not {odd}")
    texts, numbers = [x for x in values if isinstance(x, str)], [float(x) for x in values if not isinstance(x, str)]
    return lambda v: (_scalar("string")(v) & _text(v).isin(texts)) | (_scalar("number")(v) & _real(v).isin(numbers))


#: Keywords by the type that they speak of: tests of the text, the number, the list of items or the fields.
_OF_TYPE: dict[str, dict[str, Callable[..., Test]]] = {
    "string": {"minLength": lambda n: lambda t: F.length(t) >= n, "maxLength": lambda n: lambda t: F.length(t) <= n, "pattern": lambda p: lambda t: t.rlike(p)},
    "number": {"minimum": lambda x: lambda r: r >= x, "maximum": lambda x: lambda r: r <= x, "exclusiveMinimum": lambda x: lambda r: r > x, "exclusiveMaximum": lambda x: lambda r: r < x},
    "array": {
        "minItems": lambda n: lambda a: F.size(a) >= n,
        "maxItems": lambda n: lambda a: F.size(a) <= n,
        "uniqueItems": lambda yes: lambda a: F.size(F.array_distinct(F.transform(a, lambda x: F.to_json(x)))) == F.size(a) if yes else F.lit(True),
        "items": lambda s: lambda a: F.forall(a, compiled(s)),
    },
    "object": {
        "required": lambda names: lambda m: F.size(F.array_except(_names(names), F.map_keys(m))) == 0,
        "properties": lambda schemas: lambda m: _all([_let(F.try_element_at(m, F.lit(n)), lambda v, s=s: v.isNull() | compiled(s)(v)) for n, s in schemas.items()]),
        "_closed": lambda names: lambda m: F.size(F.array_except(F.map_keys(m), _names(names))) == 0,
    },
}
_PARTS = {"string": _text, "number": _real, "array": _list, "object": _fields}


def _typed(kind: str, tests: list[Test]) -> Test:
    """Values of type ``kind`` that all ``tests`` hold for."""
    part = {"integer": "number"}.get(kind, kind)
    more = [*tests, lambda r: r == F.floor(r)] if kind == "integer" else tests
    if kind in ("array", "object"):
        return lambda v: _let(_PARTS[kind](v), lambda x: x.isNotNull() & _all([t(x) for t in more]))
    if not more:
        return _scalar(kind)
    return lambda v: _scalar(kind)(v) & _let(_PARTS[part](v), lambda x: _all([t(x) for t in more]))


def compiled(schema: Mapping) -> Test:
    """A test of variant values, true or false, by ``schema``. Titles and descriptions are passed over."""
    tests: dict[str, list[Test]] = {kind: [] for kind in _OF_TYPE}
    anywhere: list[Test] = []
    for keyword, what in schema.items():
        kind = next((k for k, known in _OF_TYPE.items() if keyword in known), None)
        if kind:
            tests[kind].append(_OF_TYPE[kind][keyword](what))
        elif keyword in ("enum", "const"):
            anywhere.append(_one_of(what if keyword == "enum" else [what]))
        elif keyword == "additionalProperties":
            if not isinstance(what, bool):
                raise ValueError("additionalProperties is true or false here")
            tests["object"] += [_OF_TYPE["object"]["_closed"](list(schema.get("properties", {})))] * (not what)
        elif keyword not in ("type", "title", "description", "$schema", "$id"):
            raise ValueError(f"unknown keyword {keyword!r}")
    kinds = schema.get("type", ["string", "number", "array", "object", "boolean", "null"])
    kinds = [kinds] if isinstance(kinds, str) else kinds
    if unknown := set(kinds) - _SCALARS.keys() - {"array", "object"}:
        raise ValueError(f"unknown types {sorted(unknown)}")
    either = [_typed(k, tests.get({"integer": "number"}.get(k, k), [])) for k in kinds]
    return lambda v: F.coalesce(_all([functools.reduce(Column.__or__, [t(v) for t in either]), *[t(v) for t in anywhere]]), F.lit(False))


def errors(raw: Column, schema: Mapping) -> Column:
    """What a JSON text breaks of an object's schema: not_an_object, missing_fields, unknown_fields, then each field that is not as its schema says, in the order of the schema.

    A text that can't be parsed, one with a repeated name in an object and null are no objects, and
    all their required fields are missing; absent fields that are required break their own rule too.
    """
    fields, required = schema.get("properties", {}), schema.get("required", [])

    def broken(m: Column) -> Column:
        keys = F.coalesce(F.map_keys(m), _names([]))
        tests = {"not_an_object": m.isNull(), "missing_fields": F.size(F.array_except(_names(required), keys)) > 0}
        if schema.get("additionalProperties") is False:
            tests["unknown_fields"] = F.size(F.array_except(keys, _names(fields))) > 0
        for name, s in fields.items():
            tests[name] = _let(F.try_element_at(m, F.lit(name)), lambda v, name=name, s=s: ~F.when(v.isNull(), F.lit(name not in required)).otherwise(compiled(s)(v)))
        return F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in tests.items()]))

    return _let(_fields(F.try_parse_json(raw)), broken)
