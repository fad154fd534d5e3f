"""Rules over several columns of a row, written as data and compiled to column tests.

A rule is a document of one of these forms, and forms nest in ``if``, ``then``, ``all``, ``any`` and ``not``:

- ``{"compare": [left, "<=", right]}`` with ``<  <=  =  !=  >=  >``,
- ``{"between": [operand, low, high]}``,
- ``{"sum": {column: factor, …}, "equals": operand, "tolerance": x}``,
- ``{"set": column}`` and ``{"unset": column}``: whether there is a value; blank text is none,
- ``{"if": …, "then": …}``, ``{"all": […]}``, ``{"any": […]}``, ``{"not": …}``.

An operand is a column name, ``{"value": x}``, or ``{"period_end": column}``, the last day of a ``YYYY-MM`` period.
A row breaks a rule only if the rule is certainly false: what a missing value leaves open is not broken.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from padron.session import col

COMPARISONS = {
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    "=": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    ">=": lambda a, b: a >= b,
    ">": lambda a, b: a > b,
}


class RuleError(ValueError):
    """A rule document that has no meaning."""


@dataclass(frozen=True)
class RowRule:
    """A named test that every row should meet."""

    name: str
    test: Mapping[str, Any]
    severity: str = "error"

    @property
    def columns(self) -> list[str]:
        """The columns the rule speaks of, in order."""
        return list(dict.fromkeys(_columns(self.test)))


def rule_from_json(document: Mapping[str, Any]) -> RowRule:
    if "name" not in document or "test" not in document:
        raise RuleError(f"a rule needs a name and a test: {document}")
    rule = RowRule(str(document["name"]), document["test"], str(document.get("severity", "error")))
    rule.columns  # noqa: B018  says at once if a form is unknown
    return rule


def _columns(test: Mapping[str, Any]) -> Iterable[str]:
    kind, body = _kind(test)
    if kind == "compare":
        yield from _operand_columns(body[0])
        yield from _operand_columns(body[2])
    elif kind == "between":
        for operand in body:
            yield from _operand_columns(operand)
    elif kind == "sum":
        yield from body
        yield from _operand_columns(test["equals"])
    elif kind in ("set", "unset"):
        yield body
    elif kind == "if":
        yield from _columns(body)
        yield from _columns(test["then"])
    elif kind == "not":
        yield from _columns(body)
    else:
        for part in body:
            yield from _columns(part)


def _kind(test: Mapping[str, Any]) -> tuple[str, Any]:
    for kind in ("compare", "between", "sum", "set", "unset", "if", "not", "all", "any"):
        if kind in test:
            return kind, test[kind]
    raise RuleError(f"unknown rule: {test}")


def _operand_columns(operand: Any) -> list[str]:
    if isinstance(operand, Mapping):
        if not {"value", "period_end"} & set(operand):
            raise RuleError(f"unknown operand: {operand}")
        return [operand["period_end"]] if "period_end" in operand else []
    return [operand] if isinstance(operand, str) else []


# ---- compiling ---------------------------------------------------------------------------------


def broken_tests(rules: Sequence[RowRule], schema: T.StructType) -> dict[str, Column]:
    """For each rule whose columns are all there, a test that holds for the rows that break it."""
    names = set(schema.names)
    return {r.name: ~compiled(r.test, schema) for r in rules if names.issuperset(r.columns)}


def compiled(test: Mapping[str, Any], schema: T.StructType) -> Column:
    """True, false, or null where a missing value leaves the outcome open."""
    kind, body = _kind(test)
    if kind == "compare":
        if len(body) != 3 or body[1] not in COMPARISONS:
            raise RuleError(f"unknown comparison: {body}")
        return _compared(body[0], body[1], body[2], schema)
    if kind == "between":
        return _compared(body[0], ">=", body[1], schema) & _compared(body[0], "<=", body[2], schema)
    if kind == "sum":
        total = F.lit(0.0)
        for name, factor in body.items():
            total = total + F.lit(float(factor)) * col(name).try_cast("double")
        equals, _ = _operand(test["equals"], schema)
        return F.abs(total - equals.try_cast("double")) <= F.lit(float(test.get("tolerance", 0)))
    if kind in ("set", "unset"):
        text = isinstance(schema[body].dataType, T.StringType)
        there = F.coalesce(F.trim(col(body)) != "", F.lit(False)) if text else col(body).isNotNull()
        return there if kind == "set" else ~there
    if kind == "if":
        return ~compiled(body, schema) | compiled(test["then"], schema)
    if kind == "not":
        return ~compiled(body, schema)
    parts = [compiled(part, schema) for part in body]
    if not parts:
        raise RuleError(f"nothing to test: {test}")
    joined = parts[0]
    for part in parts[1:]:
        joined = joined & part if kind == "all" else joined | part
    return joined


def _operand(operand: Any, schema: T.StructType) -> tuple[Column, T.DataType | None]:
    if isinstance(operand, str):
        return col(operand), schema[operand].dataType
    if isinstance(operand, Mapping) and "period_end" in operand:
        start = F.concat(col(operand["period_end"]).cast("string"), F.lit("-01")).try_cast("date")
        return F.last_day(start), T.DateType()
    return F.lit(operand["value"] if isinstance(operand, Mapping) else operand), None


def _compared(left: Any, sign: str, right: Any, schema: T.StructType) -> Column:
    """Text that meets another type is read as that type; text that can't be leaves the outcome open."""
    (a, kind_a), (b, kind_b) = _operand(left, schema), _operand(right, schema)
    text_a, text_b = (isinstance(k, T.StringType) for k in (kind_a, kind_b))
    if text_a and not text_b:
        a = a.try_cast(kind_b if kind_b is not None else _literal_type(right))
    elif text_b and not text_a:
        b = b.try_cast(kind_a if kind_a is not None else _literal_type(left))
    return COMPARISONS[sign](a, b)


def _literal_type(operand: Any) -> T.DataType:
    value = operand["value"] if isinstance(operand, Mapping) else operand
    return T.StringType() if isinstance(value, str) else T.DoubleType()
