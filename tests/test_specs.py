import pytest

from padron.sources.contracts import column_number, contract_from_json, required_columns
from padron.sources.specs import spec_from_json


def test_list_layout():
    spec = spec_from_json(
        {
            "metadata": {"key_column": "A"},
            "column_mapping": {"X": "A"},
            "columns": [
                {"name": "A", "type": "string", "required": True},
                {"name": "B", "type": "integer", "nullable": True, "validations": {"min": 1, "max": 9, "allowed_values": [1, 2]}},
            ],
        },
        "t",
    )
    a, b = spec.fields
    assert (a.nullable, b.nullable, b.minimum, b.maximum, b.allowed) == (False, True, 1, 9, (1, 2))
    assert spec.primary_key == ("A",) and spec.rename == {"X": "A"}


MAP = {
    "schema": {
        "A": {"type": "string", "nullable": False, "pattern": "^x$"},
        "M": {"type": "integer", "min_value": 1, "max_value": 12, "derivado_de": "D"},
        "D": {"type": "date"},
        "U": {"type": "money"},
    },
    "constraints": {"primary_key": ["A", "D"]},
    "filtros": [{"columna": "A", "condicion": "NOT_EQUAL", "valor": "z"}],
}


def test_map_layout():
    spec = spec_from_json(MAP, "t")
    assert spec.primary_key == ("A", "D") and spec.filters[0].value == "z"
    assert spec.base.columns == ["A", "D", "U"]
    assert spec.struct().simpleString() == "struct<A:string,M:bigint,D:date,U:string>"
    assert (spec.field("M").minimum, spec.field("M").maximum, spec.field("A").pattern) == (1, 12, "^x$")


def test_sheet_and_flat_layouts():
    assert spec_from_json({"hojas": {"S": MAP}}, "t", "S").columns == ["A", "M", "D", "U"]
    with pytest.raises(ValueError):
        spec_from_json({"hojas": {"S": {}}}, "t", "S")
    flat = spec_from_json({"required_columns": ["A", "B"], "column_types": {"B": "date"}}, "t")
    assert [(f.name, f.type, f.nullable) for f in flat.fields] == [("A", "string", False), ("B", "date", False)]
    dedup = spec_from_json({"columnas_requeridas": ["CC", "N"], "columna_deduplicacion": "CC"}, "t")
    assert dedup.primary_key == ("CC",)
    with pytest.raises(ValueError):
        spec_from_json({}, "t")


def test_column_letters():
    assert [column_number(c) for c in ("A", "z", "AA", "XFD")] == [1, 26, 27, 16384]
    for bad in ("", "A1", "é"):
        with pytest.raises(ValueError):
            column_number(bad)


def test_required_column_modes():
    schemas = {
        "map": MAP,
        "sheets": {"hojas": {"S": MAP}},
        "list": {"columns": [{"name": "A", "required": True}, {"name": "B", "nullable": False}, {"name": "C"}]},
        "flat": {"required_columns": ["A", "B"]},
    }
    assert required_columns([" A ", ""], schemas) == ("A",)
    assert required_columns({"required_columns": ["Q"], "schema_path": "map", "extract": "schema_keys"}, schemas) == ("Q",)

    def by(path, mode, **more):
        return required_columns({"schema_path": path, "extract": mode, **more}, schemas)

    assert by("map", "schema_non_nullable") == ("A",)
    assert by("map", "schema_keys", exclude_columns=["a", " m "]) == ("D", "U")
    assert by("sheets", "schema_keys", sheet_name="S") == ("A", "M", "D", "U")
    assert by("list", "columns_required_true") == ("A",)
    assert by("list", "columns_non_nullable") == ("B",)
    assert by("flat", "required_columns_array") == ("A", "B")
    assert by("flat", "other") == () and required_columns(None, schemas) == ()


def test_contract_from_json():
    contract = contract_from_json(
        {
            "id": "x",
            "filename_regex": "x",
            "file_type": {"expected_extensions": [".XLSX"]},
            "sheet_rules": {"required_sheets": ["S"], "allowed_sheets": ["S", "T"], "enforce_allowed_sheets": True},
            "sheets": {"S": {"header_start": {"row_index_1_based": 2, "column_letter": "B"}, "required_columns_source": ["A"]}},
        }
    )
    sheet = contract.sheets[0]
    assert (sheet.header_row, sheet.start_col, sheet.required) == (2, 2, ("A",))
    assert contract.must_exist == ("S",) and contract.may_exist == ("S", "T") and contract.enforce_allowed
    assert contract.extensions == (".xlsx",) and contract.name == "x"
