"""One table description for all four JSON layouts in which schemas are written."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import types as T

from padron.operators.row_rules import RowRule, rule_from_json

SPARK_TYPES = {
    "string": T.StringType(),
    "integer": T.LongType(),
    "float": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
}


@dataclass(frozen=True)
class FieldSpec:
    name: str
    type: str = "string"
    nullable: bool = True
    allowed: tuple[str, ...] = ()
    minimum: float | None = None
    maximum: float | None = None
    pattern: str | None = None
    derived_from: str | None = None

    @property
    def spark_type(self) -> T.DataType:
        """An unknown type name means text."""
        return SPARK_TYPES.get(self.type.lower(), T.StringType())


@dataclass(frozen=True)
class FilterSpec:
    column: str
    condition: str
    value: Any = None


@dataclass(frozen=True)
class TableSpec:
    name: str
    fields: tuple[FieldSpec, ...]
    primary_key: tuple[str, ...] = ()
    filters: tuple[FilterSpec, ...] = ()
    rename: Mapping[str, str] = field(default_factory=dict)
    #: Further column sets of which no two rows may share all values; a row that lacks one is free.
    unique_keys: tuple[tuple[str, ...], ...] = ()
    row_rules: tuple[RowRule, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def base(self) -> TableSpec:
        """Without the columns that are derived from others."""
        return replace(self, fields=tuple(f for f in self.fields if f.derived_from is None))

    def field(self, name: str) -> FieldSpec:
        return next(f for f in self.fields if f.name == name)

    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.spark_type, f.nullable) for f in self.fields])


def _field(name: str, meta: Mapping[str, Any]) -> FieldSpec:
    rules = {**meta, **meta.get("validations", {})}
    nullable = meta["nullable"] if "nullable" in meta else not meta.get("required", False)
    return FieldSpec(
        name=name,
        type=str(meta.get("type", "string")),
        nullable=bool(nullable),
        allowed=tuple(rules.get("allowed_values", ())),
        minimum=rules.get("min_value", rules.get("min")),
        maximum=rules.get("max_value", rules.get("max")),
        pattern=rules.get("pattern"),
        derived_from=meta.get("derivado_de"),
    )


def spec_from_json(document: Mapping[str, Any], name: str, sheet: str | None = None) -> TableSpec:
    """Reads the column list, column map, per-sheet map and flat list layouts."""
    section: Mapping[str, Any] = document
    if sheet is not None:
        sheets = document.get("hojas", {})
        if sheet not in sheets or "schema" not in sheets[sheet]:
            raise ValueError(f"no schema section for sheet '{sheet}'")
        section = sheets[sheet]

    key = tuple(section.get("constraints", {}).get("primary_key", ()))
    if "schema" in section:
        fields = tuple(_field(column, meta) for column, meta in section["schema"].items())
    elif "columns" in section:
        fields = tuple(_field(meta["name"], meta) for meta in section["columns"])
        key = key or tuple(filter(None, [section.get("metadata", {}).get("key_column")]))
    elif "required_columns" in section:
        types = section.get("column_types", {})
        fields = tuple(FieldSpec(c, types.get(c, "string"), False) for c in section["required_columns"])
    elif "columnas_requeridas" in section:
        fields = tuple(FieldSpec(c) for c in section["columnas_requeridas"])
        key = tuple(filter(None, [section.get("columna_deduplicacion")]))
    else:
        raise ValueError("the document holds no column description")

    filters = tuple(
        FilterSpec(f["columna"], f["condicion"], f.get("valor")) for f in document.get("filtros", ())
    )
    constraints = section.get("constraints", {})
    unique = tuple((k,) if isinstance(k, str) else tuple(k) for k in constraints.get("unique_keys", ()))
    rules = tuple(rule_from_json(r) for r in constraints.get("row_rules", ()))
    return TableSpec(name, fields, key, filters, dict(document.get("column_mapping", {})), unique, rules)
