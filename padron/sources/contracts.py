"""What a raw source file must look like before a job may read it."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from typing import Any

from padron.sources.specs import TableSpec, spec_from_json

# Spreadsheet file extensions, and the blanks that end a header.
EXTENSIONS = (".xls", ".xlsm", ".xlsx")
HEADER_END_BLANKS = 3


@dataclass(frozen=True)
class SheetContract:
    sheet: str
    header_row: int
    start_col: int = 1
    required: tuple[str, ...] = ()
    #: Header cells read at most; None for all of them.
    max_cells: int | None = None


@dataclass(frozen=True)
class SourceContract:
    id: str
    name: str
    sheets: tuple[SheetContract, ...]
    required_sheets: tuple[str, ...] | None = None
    allowed_sheets: tuple[str, ...] | None = None
    enforce_allowed: bool = False
    extensions: tuple[str, ...] = EXTENSIONS
    file_name_pattern: str | None = None

    @property
    def must_exist(self) -> tuple[str, ...]:
        return self.required_sheets if self.required_sheets is not None else tuple(s.sheet for s in self.sheets)

    @property
    def may_exist(self) -> tuple[str, ...]:
        return self.allowed_sheets if self.allowed_sheets is not None else self.must_exist


def column_number(letters: str) -> int:
    """Spreadsheet column letters to a 1-based number."""
    number = 0
    for letter in letters.strip().upper():
        if not "A" <= letter <= "Z":
            raise ValueError(f"not a column: {letters!r}")
        number = number * 26 + ord(letter) - ord("A") + 1
    if not number:
        raise ValueError(f"not a column: {letters!r}")
    return number


@dataclass(frozen=True)
class RequiredRule:
    """Where a sheet's required columns come from: a list, or a schema document read in one of several modes."""

    listed: tuple[str, ...] = ()
    mode: str = ""
    schema: str = ""
    sheet: str | None = None
    excluded: frozenset[str] = frozenset()

    @classmethod
    def parse(cls, source: Any) -> RequiredRule:
        rule = {"required_columns": source} if isinstance(source, (list, tuple)) else dict(source or {})
        names = (str(c).strip() for c in rule.get("required_columns") or ())
        return cls(
            listed=tuple(n for n in names if n),
            mode=str(rule.get("extract", "")).strip().lower(),
            schema=str(rule.get("schema_path", "")),
            sheet=rule.get("sheet_name"),
            excluded=frozenset(_key(c) for c in rule.get("exclude_columns", ())),
        )


def _flagged(flag: str, value: bool) -> Callable[[Mapping[str, Any], RequiredRule], Iterable[str]]:
    return lambda doc, _: [c["name"] for c in doc.get("columns", ()) if c.get(flag) is value]


def _declared(nullable_too: bool) -> Callable[[Mapping[str, Any], RequiredRule], Iterable[str]]:
    def names(doc: Mapping[str, Any], rule: RequiredRule) -> Iterable[str]:
        spec: TableSpec = spec_from_json(doc, "required", rule.sheet if rule.sheet in doc.get("hojas", {}) else None)
        return [f.name for f in spec.fields if nullable_too or not f.nullable]

    return names


#: How each mode draws names from a schema document.
EXTRACTORS: dict[str, Callable[[Mapping[str, Any], RequiredRule], Iterable[str]]] = {
    "required_columns_array": lambda doc, _: doc.get("required_columns", ()),
    "columns_required_true": _flagged("required", True),
    "columns_non_nullable": _flagged("nullable", False),
    "schema_keys": _declared(nullable_too=True),
    "schema_non_nullable": _declared(nullable_too=False),
}


def required_columns(source: Any, schemas: Mapping[str, Mapping[str, Any]]) -> tuple[str, ...]:
    """The required columns of one sheet; none for an unknown mode or schema."""
    rule = RequiredRule.parse(source)
    extract, document = EXTRACTORS.get(rule.mode), schemas.get(rule.schema)
    drawn = extract(document, rule) if extract and document is not None and not rule.listed else ()
    return rule.listed or tuple(c for c in drawn if _key(c) not in rule.excluded)


def _key(name: Any) -> str:
    return " ".join(str(name).split()).upper()


def contract_from_json(
    document: Mapping[str, Any], schemas: Mapping[str, Mapping[str, Any]] | None = None
) -> SourceContract:
    rules = document.get("sheet_rules", {})
    sheets = []
    for sheet, meta in document.get("sheets", {}).items():
        start = meta.get("header_start", {})
        sheets.append(
            SheetContract(
                sheet=sheet,
                header_row=int(start.get("row_index_1_based", 1)),
                start_col=column_number(str(start.get("column_letter", "A"))),
                required=required_columns(meta.get("required_columns_source"), schemas or {}),
                max_cells=int(meta["max_scan_cols"]) if meta.get("max_scan_cols") else None,
            )
        )
    return SourceContract(
        id=str(document.get("id", "unknown")),
        name=str(document.get("name", document.get("id", "unknown"))),
        sheets=tuple(sheets),
        required_sheets=tuple(rules["required_sheets"]) if "required_sheets" in rules else None,
        allowed_sheets=tuple(rules["allowed_sheets"]) if "allowed_sheets" in rules else None,
        enforce_allowed=bool(rules.get("enforce_allowed_sheets", False)),
        extensions=tuple(
            e.lower() for e in document.get("file_type", {}).get("expected_extensions", EXTENSIONS)
        ),
        file_name_pattern=document.get("filename_regex"),
    )
