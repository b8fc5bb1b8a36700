"""JSON-Schema rules compiled to native column expressions.

A schema document (the subset ``type`` / type list, ``required``, ``enum``,
``properties``, nested) becomes one ``ARRAY<STRING>`` expression listing every
violation of a JSON text, evaluated by Spark on the VARIANT produced by
``try_parse_json``: no Python runs per record.

Type rules on the VARIANT's schema string: string = STRING; integer = an
integral type, a DECIMAL with scale 0 (``1.0`` parses so) or a whole DOUBLE;
number = any numeric type, never BOOLEAN; object = OBJECT<…>; array =
ARRAY<…>; boolean = BOOLEAN; null = VOID (a JSON null; a missing key is SQL
NULL instead, so "required but nullable" is expressible).

Messages: ``malformed`` for text that is not JSON, then, in schema order,
``'<path>' is a required property``, ``'<path>' is not of type <types>`` and
``'<path>' is not one of [<values>]``.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.fixed import CDC_SCHEMA, CLICKSTREAM_SCHEMA, USER_PROFILE_SCHEMA

MALFORMED = "malformed"
_INTEGRAL = r"^(BIGINT|INT|SMALLINT|TINYINT|DECIMAL\(\d+,0\))$"
_NUMERIC = r"^(BIGINT|INT|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL\(\d+,\d+\))$"


def _path(parent: str, name: str) -> str:
    return f"{parent}['{name}']"


def _label(parts: list[str]) -> str:
    return ".".join(parts)


def _lit(text: str) -> str:
    """A SQL string literal (backslashes and quotes escaped)."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


# Each rule is emitted as one SQL expression over the staged columns, so a
# schema compiles into a handful of planner calls however many rules it has.

def _is_type(v: str, kind: str, t: str) -> str:
    if t == "string":
        return f"{kind} = 'STRING'"
    if t == "integer":
        d = f"try_variant_get({v}, '$', 'double')"
        return f"({kind} RLIKE {_lit(_INTEGRAL)} OR ({kind} = 'DOUBLE' AND {d} = floor({d})))"
    if t == "number":
        return f"{kind} RLIKE {_lit(_NUMERIC)}"
    if t == "boolean":
        return f"{kind} = 'BOOLEAN'"
    if t == "object":
        return f"startswith({kind}, 'OBJECT')"
    if t == "array":
        return f"startswith({kind}, 'ARRAY')"
    if t == "null":
        return f"{kind} = 'VOID'"
    raise ValueError(f"unsupported JSON type {t!r}")


def _enum_match(v: str, kind: str, values: list[Any]) -> str:
    conds = []
    strings = [x for x in values if isinstance(x, str)]
    numbers = [x for x in values if isinstance(x, (int, float)) and not isinstance(x, bool)]
    bools = [x for x in values if isinstance(x, bool)]
    if strings:
        conds.append(f"({kind} = 'STRING' AND try_variant_get({v}, '$', 'string') IN "
                     f"({', '.join(_lit(x) for x in strings)}))")
    if numbers:
        conds.append(f"({kind} RLIKE {_lit(_NUMERIC)} AND try_variant_get({v}, '$', 'double') "
                     f"IN ({', '.join(repr(float(x)) for x in numbers)}))")
    if bools:
        conds.append(f"({kind} = 'BOOLEAN' AND try_variant_get({v}, '$', 'boolean') IN "
                     f"({', '.join('true' if x else 'false' for x in bools)}))")
    if any(x is None for x in values):
        conds.append(f"{kind} = 'VOID'")
    return " OR ".join(f"coalesce({c}, false)" for c in conds) or "false"


def _type_text(t: str | list[str]) -> str:
    return ", ".join(f"'{x}'" for x in ([t] if isinstance(t, str) else t))


def _root_kind(text: str, doc: str) -> str:
    """Kind of the whole document without building its full schema string:
    once the text parsed, a leading ``{`` / ``[`` means object / array."""
    first = f"left(btrim({text}, ' \\t\\n\\r'), 1)"
    return (f"CASE WHEN {doc} IS NULL THEN NULL WHEN {first} = '{{' THEN 'OBJECT' "
            f"WHEN {first} = '[' THEN 'ARRAY' ELSE schema_of_variant({doc}) END")


def _collect_paths(path: str, rule: dict, out: list[str]) -> None:
    if path not in out:
        out.append(path)
    for req in rule.get("required", []):
        if _path(path, req) not in out:
            out.append(_path(path, req))
    for prop, sub in rule.get("properties", {}).items():
        _collect_paths(_path(path, prop), sub, out)


def _node_checks(vals: dict[str, str], kinds: dict[str, str], path: str,
                 label: list[str], rule: dict) -> list[str]:
    """Violations of ``rule`` by the value at ``path`` (skipped when absent)."""
    v, kind = vals[path], kinds[path]
    name = _label(label) if label else "$"
    out: list[str] = []
    if "type" in rule:
        types = [rule["type"]] if isinstance(rule["type"], str) else list(rule["type"])
        ok = " OR ".join(f"coalesce({_is_type(v, kind, t)}, false)" for t in types)
        msg = _lit(f"'{name}' is not of type {_type_text(rule['type'])}")
        out.append(f"CASE WHEN {v} IS NOT NULL AND NOT ({ok}) THEN {msg} END")
    if "enum" in rule:
        msg = _lit(f"'{name}' is not one of {rule['enum']!r}")
        out.append(f"CASE WHEN {v} IS NOT NULL AND NOT ({_enum_match(v, kind, rule['enum'])}) "
                   f"THEN {msg} END")
    is_object = f"coalesce({v} IS NOT NULL AND startswith({kind}, 'OBJECT'), false)"
    for req in rule.get("required", []):
        msg = _lit(f"'{_label(label + [req])}' is a required property")
        out.append(f"CASE WHEN {is_object} AND {vals[_path(path, req)]} IS NULL THEN {msg} END")
    for prop, sub in rule.get("properties", {}).items():
        out.extend(_node_checks(vals, kinds, _path(path, prop), label + [prop], sub))
    return out


def with_violations(df: DataFrame, text: Column | str, schema: dict,
                    out: str = "errors", also: dict[str, str] | None = None) -> DataFrame:
    """``df`` plus ``out ARRAY<STRING>``: violations of the JSON in ``text``.

    ``also``: further columns as SQL expressions over the parsed document
    ``__doc``, so that a caller need not parse it again.

    Staged projections — parse once, extract each path once, type each value
    once, then test — so the JSON text is parsed once per record however many
    rules there are.
    """
    text = F.col(text) if isinstance(text, str) else text
    paths: list[str] = []
    _collect_paths("$", schema, paths)
    names = {p: f"__v{i}" for i, p in enumerate(paths)}
    kinds = {p: f"__k{i}" for i, p in enumerate(paths)}
    staged = (df.withColumns({"__text": text})
                .withColumn("__doc", F.expr("try_parse_json(__text)"))
                .withColumns({names[p]: F.expr("__doc" if p == "$" else
                                               f"try_variant_get(__doc, {_lit(p)}, 'variant')")
                              for p in paths})
                .withColumns({kinds[p]: F.expr(_root_kind("__text", names[p]) if p == "$" else
                                               f"schema_of_variant({names[p]})")
                              for p in paths}))
    checks = _node_checks(names, kinds, "$", [], schema)
    # concat_ws skips NULLs; unlike filter(array, lambda) it keeps the
    # projection inside whole-stage code generation
    joined = staged.withColumn("__found", F.expr(f"concat_ws(char(31), {', '.join(checks)})"))
    result = (f"CASE WHEN __doc IS NULL THEN array({_lit(MALFORMED)}) "
              "WHEN __found = '' THEN CAST(array() AS ARRAY<STRING>) "
              "ELSE split(__found, char(31)) END")
    more = {name: F.expr(e) for name, e in (also or {}).items()}
    return (joined.withColumns({out: F.expr(result), **more})
            .drop("__text", "__doc", "__found", *names.values(), *kinds.values()))


class SchemaRegistry:
    """Named schema documents; three built in, more can be registered."""

    def __init__(self) -> None:
        self._schemas: dict[str, dict] = {
            "clickstream": CLICKSTREAM_SCHEMA,
            "cdc": CDC_SCHEMA,
            "user_profile": USER_PROFILE_SCHEMA,
        }

    def get_schema(self, name: str) -> dict | None:
        return self._schemas.get(name)

    def register_schema(self, name: str, schema: dict) -> None:
        self._schemas[name] = schema

    def list_schemas(self) -> list[str]:
        return list(self._schemas)

    def with_violations(self, name: str, df: DataFrame, text: Column | str,
                        out: str = "errors") -> DataFrame:
        schema = self.get_schema(name)
        if schema is None:
            raise KeyError(f"unknown schema {name!r}")
        return with_violations(df, text, schema, out)
