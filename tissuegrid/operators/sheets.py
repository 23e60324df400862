"""Validation and typing of text tables against a declared schema, as column expressions.

Every rule adds to one array of error texts per row, so a table is checked in a single pass.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tissuegrid.functions.text import is_null_word, parse_bool

TYPES = {
    "str": "string", "path": "string", "json": "string", "int": "bigint", "float": "double", "bool": "boolean",
    "list[str]": "array<string>", "list[int]": "array<bigint>", "list[float]": "array<double>",
}
EXPECTED = {
    "int": "expected integer", "float": "expected float", "bool": "expected boolean", "json": "expected valid literal",
    "list[int]": "expected integer in list", "list[float]": "expected float in list",
}


@dataclass(frozen=True)
class Field:
    name: str
    type: str = "str"
    required: bool = False
    default: Any = None
    allow_null: bool = False
    choices: Sequence[Any] | None = None
    min: float | None = None
    max: float | None = None
    regex: str | None = None
    allow_relative: bool = True
    extensions: Sequence[str] | None = None
    delimiter: str = ","


def check_header(columns: Sequence[str], fields: Sequence[Field], strict: bool = True) -> list[str]:
    known = {f.name for f in fields}
    errors = [f"missing required column '{f.name}'" for f in fields if f.required and f.name not in columns]
    if strict:
        errors += [f"unknown column '{c}'" for c in columns if c not in known]
    return errors


def _typed(field: Field, text: Column) -> Column:
    if field.type == "bool":
        return parse_bool(text)
    if field.type.startswith("list["):
        items = F.filter(F.transform(F.split(text, f"\\Q{field.delimiter}\\E"), lambda i: F.trim(i)), lambda i: i != "")
        inner = {"list[int]": "bigint", "list[float]": "double"}.get(field.type)
        return F.transform(items, lambda i: i.try_cast(inner)) if inner else items
    if field.type == "int":
        return F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint"))
    if field.type == "float":
        return text.try_cast("double")
    if field.type == "json":
        return F.when(F.try_parse_json(text).isNotNull(), text)
    return text


def _literal(value: Any) -> Column:
    return F.array(*[F.lit(v) for v in value]) if isinstance(value, (list, tuple)) else F.lit(value)


def _show(value: Column) -> Column:
    return value.cast("string")


def _field_error(field: Field, text: Column, value: Column) -> Column:
    """First thing wrong with a value that is there, else NULL."""
    checks = []
    is_list = field.type.startswith("list[")
    if field.type in EXPECTED:
        bad = F.exists(value, lambda v: v.isNull()) if is_list else value.isNull()
        checks.append((bad, F.lit(EXPECTED[field.type])))
    if field.type == "path":
        if not field.allow_relative:
            checks.append((~value.startswith("/"), F.lit("expected absolute path")))
        if field.extensions:
            ends = [F.lower(value).endswith(e.lower()) for e in field.extensions]
            hit = ends[0]
            for e in ends[1:]:
                hit = hit | e
            checks.append((~hit, F.lit("file extension not allowed; expected one of: " + ", ".join(field.extensions))))
    if field.choices is not None:
        allowed = "[" + ", ".join(repr(c) for c in field.choices) + "]"
        options = _literal(list(field.choices))
        if is_list:
            wrong = F.filter(value, lambda v: ~F.array_contains(options, v))
            text_of = F.concat(F.lit("["), F.array_join(F.transform(wrong, lambda v: _show(v)), ", "), F.lit("]"))
            checks.append((F.size(wrong) > 0, F.concat(F.lit("value(s) "), text_of, F.lit(f" not in allowed choices {allowed}"))))
        else:
            checks.append((~F.array_contains(options, value), F.concat(F.lit("value '"), _show(value), F.lit(f"' not in allowed choices {allowed}"))))
    numeric = field.type in ("int", "float")
    for bound, word, test in ((field.min, "below minimum", lambda v, b: v < b), (field.max, "above maximum", lambda v, b: v > b)):
        if bound is None:
            continue
        if not numeric:
            checks.append((F.lit(True), F.lit(f"{word.split()[1]} constraint requires numeric value")))
        else:
            checks.append((test(value, F.lit(bound)), F.concat(F.lit("value "), _show(value), F.lit(f" {word} {bound}"))))
    if field.regex is not None:
        checks.append((~value.rlike(f"^(?:{field.regex})"), F.lit("value does not match required pattern")))
    if not checks:
        return F.lit(None).cast("string")
    out = F.when(*checks[0])
    for condition, message in checks[1:]:
        out = out.when(condition, message)
    return out


def _row_error(row: Column, name: str, message: Column) -> Column:
    """Text of an error; the sheet's first data row is row 2."""
    return F.when(
        message.isNotNull(),
        F.concat(F.lit("Row "), (row + 2).cast("string"), F.lit(f", column '{name}': "), message),
    )


def _condition(spec: Mapping[str, Any], final: Mapping[str, Column]) -> Column:
    key = spec.get("key")
    if not spec or key is None:
        return F.lit(True)
    value, out = final[key], F.lit(True)
    if "equals" in spec:
        out = out & value.eqNullSafe(_literal(spec["equals"]))
    if "not_equals" in spec:
        out = out & ~value.eqNullSafe(_literal(spec["not_equals"]))
    if "in" in spec:
        out = out & F.coalesce(value.isin(*spec["in"]), F.lit(False))
    if "not_in" in spec:
        out = out & ~F.coalesce(value.isin(*spec["not_in"]), F.lit(False))
    if "is_null" in spec:
        out = out & (value.isNull() if spec["is_null"] else value.isNotNull())
    return out


def _unset(value: Column, kind: T.DataType | str) -> Column:
    """NULL or empty text."""
    return value.isNull() | (value == "") if kind in ("str", "path", "json") else value.isNull()


def _rule_errors(rule: Mapping[str, Any], final: Mapping[str, Column], kinds: Mapping[str, str], row: Column) -> list[Column]:
    holds = _condition(rule.get("if", {}), final)
    kind = rule.get("type")
    out = []
    if kind == "require_if":
        for key in rule.get("required_keys", []):
            out.append(_row_error(row, key, F.when(holds & _unset(final[key], kinds[key]), "value is required")))
        for key, wanted in rule.get("required_values", {}).items():
            text = F.when(holds & ~final[key].eqNullSafe(_literal(wanted)), f"expected value '{wanted}' when condition holds")
            out.append(_row_error(row, key, text))
    elif kind == "forbid_if":
        for key in rule.get("forbidden_when_set", []):
            off = _unset(final[key], kinds[key])
            if kinds[key] in ("int", "float"):
                off = off | (final[key] == -1)
            out.append(_row_error(row, key, F.when(holds & ~F.coalesce(off, F.lit(False)), "value is not allowed when condition holds")))
    elif kind == "range_if" and rule.get("key"):
        key = rule["key"]
        value = final[key]
        text = F.when(holds & value.isNull(), F.lit("value is required"))
        out.append(_row_error(row, key, text))
        for bound, word, low in ((rule.get("min"), "below minimum", True), (rule.get("max"), "above maximum", False)):
            if bound is not None:
                broken = (value < bound) if low else (value > bound)
                message = F.concat(F.lit("value "), _show(value), F.lit(f" {word} {bound}"))
                out.append(_row_error(row, key, F.when(holds & broken, message)))
    return out


def validate(sheet: DataFrame, fields: Sequence[Field], rules: Sequence[Mapping[str, Any]] = (), row: str = "row_index") -> DataFrame:
    """Typed columns plus ``errors``; rule errors are only looked for in rows whose fields are all right."""
    index = F.col(row)
    kinds = {f.name: f.type for f in fields}
    texts, finals, problems = {}, {}, []
    for f in fields:
        if f.name not in sheet.columns:
            raw = F.lit(None).cast("string")
        else:
            raw = F.col(f"`{f.name}`")
        text = F.trim(raw)
        typed = _typed(f, text)
        absent, empty = raw.isNull(), is_null_word(raw)
        default = F.lit(None).cast(TYPES[f.type]) if f.default is None else _literal(f.default).cast(TYPES[f.type])
        error = _field_error(f, text, typed)
        final = F.when(absent, default).when(~empty & error.isNull(), typed)
        message = F.when(absent, F.lit("missing required value") if f.required and f.default is None else F.lit(None).cast("string"))
        message = message.when(~absent & empty, F.lit("value cannot be null") if f.required and not f.allow_null else F.lit(None).cast("string"))
        message = message.otherwise(F.when(~empty, error))
        texts[f.name], finals[f.name] = text, final
        problems.append(_row_error(index, f.name, message))
    first = sheet.select(
        index.alias(row),
        *[finals[f.name].cast(TYPES[f.type]).alias(f.name) for f in fields],
        F.array_compact(F.array(*problems)).alias("_field_errors"),
    )
    known = {f.name: F.col(f"`{f.name}`") for f in fields}
    found = [e for r in rules for e in _rule_errors(r, known, kinds, F.col(row))]
    rule_errors = F.array_compact(F.array(*found)) if found else F.array().cast("array<string>")
    return first.withColumn(
        "errors", F.when(F.size("_field_errors") > 0, F.col("_field_errors")).otherwise(rule_errors)
    ).drop("_field_errors")


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows in order, rows with errors)."""
    return validated.where(F.size("errors") == 0).drop("errors"), validated.where(F.size("errors") > 0)


def all_or_nothing(validated: DataFrame) -> DataFrame:
    """The typed table if no row has an error, else the job fails with the first error text."""
    worst = validated.agg(F.min(F.when(F.size("errors") > 0, F.element_at("errors", 1)))).scalar()
    ok = F.when(worst.isNotNull(), F.raise_error(worst).cast("boolean")).otherwise(F.lit(True))
    return validated.where(ok).drop("errors")


def preprocess_defaults(sheet: DataFrame, switch: str = "visualize", column: str = "downscale_factor", default: int = 64) -> DataFrame:
    """Rows that ask for pictures get the default factor when theirs is missing or not positive."""
    unusable = F.coalesce(F.col(column) <= 0, F.lit(True))
    wanted = F.coalesce(F.col(switch), F.lit(False)) & unusable
    return sheet.withColumn(column, F.when(wanted, F.lit(default)).otherwise(F.col(column)))
