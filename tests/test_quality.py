import pytest
from pyspark.sql import functions as F

from padron.operators import quality
from padron.sources.contracts import SheetContract, SourceContract
from padron.sources.specs import FieldSpec, TableSpec

CONTRACT = SourceContract(
    "c",
    "C",
    (SheetContract("S", 2, 2, ("Año  MES", "dni")), SheetContract("T", 1, 1, ("X",))),
    enforce_allowed=True,
    file_name_pattern=r"\d{4}-\d{2}",
)


def _findings(grid, contract=CONTRACT):
    return {tuple(r) for r in quality.check_sources(grid, contract).collect()}


def test_a_good_source_has_no_findings(grid_of):
    grid = grid_of({("2024-01.xlsx", "S"): {2: ["", " año mes", None, None, "DNI "]}, ("2024-01.xlsx", "T"): {1: ["x"]}})
    assert _findings(grid) == set()


def test_every_rule_is_reported(grid_of):
    grid = grid_of(
        {
            ("a.pdf", "S"): {2: ["", "Q"]},
            ("b.xlsx", "S"): {2: ["x", None, "DNI"]},
            ("b.xlsx", "Z"): {1: ["x"]},
            ("2024-01.xlsm", "S"): {1: ["short"]},
            ("2024-01.xlsm", "T"): {1: ["Y"]},
        }
    )
    assert _findings(grid) == {
        ("a.pdf", None, "extension", ".xls, .xlsm, .xlsx"),
        ("b.xlsx", None, "file_name", r"\d{4}-\d{2}"),
        ("b.xlsx", "T", "missing_sheet", "T"),
        ("b.xlsx", "Z", "unexpected_sheet", "Z"),
        ("b.xlsx", "S", "shifted_header", "2:2"),
        ("b.xlsx", "S", "missing_columns", "Año  MES"),
        ("2024-01.xlsm", "S", "shifted_header", "2:2"),
        ("2024-01.xlsm", "S", "missing_columns", "Año  MES, dni"),
        ("2024-01.xlsm", "T", "missing_columns", "X"),
    }


def test_header_scan_ends_after_three_blanks_and_at_its_width(grid_of):
    contract = SourceContract("c", "C", (SheetContract("S", 1, 1, ("A", "B", "Z")),))
    grid = grid_of({("f.xlsx", "S"): {1: [None, None, None, None, "A", None, None, "B", None, None, None, "Z"]}})
    assert _findings(grid, contract) == {
        ("f.xlsx", "S", "shifted_header", "1:1"),
        ("f.xlsx", "S", "missing_columns", "Z"),
    }
    narrow = SourceContract("c", "C", (SheetContract("S", 1, 1, ("A", "B"), max_cells=1),))
    assert _findings(grid_of({("f.xlsx", "S"): {1: ["A", "x", "B"]}}), narrow) == {("f.xlsx", "S", "missing_columns", "B")}


def test_failures_are_raised_together(grid_of):
    grid = grid_of({("a.pdf", "S"): {2: ["x"]}, ("b.doc", "S"): {2: ["x"]}})
    with pytest.raises(quality.QualityError) as error:
        quality.raise_if_any(quality.check_sources(grid, CONTRACT), "sources")
    assert "a.pdf" in str(error.value) and "b.doc" in str(error.value)
    quality.raise_if_any(quality.check_sources(grid.limit(0), CONTRACT), "sources")


SPEC = TableSpec(
    "t",
    (
        FieldSpec("k", nullable=False),
        FieldSpec("m.m", "integer", minimum=0, maximum=12),
        FieldSpec("s", allowed=("M", "F"), pattern="^.$"),
        FieldSpec("gone", nullable=False),
        FieldSpec("d", "date"),
    ),
    primary_key=("k",),
)


def _constraints(frame, **options):
    return {tuple(r) for r in quality.constraint_findings(frame, SPEC, **options).collect()}


def test_constraint_findings(spark):
    rows = [("a", -1, "M", "x"), ("a", 13, "XX", "x"), (None, None, None, "x"), ("b", 0, "F", None)]
    frame = spark.createDataFrame(rows, "k string, `m.m` int, s string, d string")
    found = _constraints(frame)
    assert found == {
        ("gone", "columna", "error", 1, "missing"),
        ("k", "nulo", "error", 1, ""),
        ("m.m", "minimo", "aviso", 1, "0"),
        ("s", "valores", "aviso", 1, "XX"),
        ("k", "clave", "error", 1, ""),
    }
    more = _constraints(frame, extras=True, strict_types=("date",), warn_on=(), cross_rules={"r": F.col("k") != "b"})
    assert ("m.m", "maximo", "error", 1, "12") in more
    assert ("s", "patron", "error", 1, "^.$") in more
    assert ("m.m", "minimo", "error", 1, "0") in more
    assert ("r", "regla", "error", 1, "") in more
    assert any(f[1] == "tipo" and "'d'" in f[4] for f in more)


def test_minimum_of_zero_is_checked(spark):
    frame = spark.createDataFrame([("a", -5, "M")], "k string, `m.m` int, s string")
    assert ("m.m", "minimo", "aviso", 1, "0") in _constraints(frame)


def test_no_rules_no_findings(spark):
    empty = TableSpec("e", (FieldSpec("k"),))
    assert quality.constraint_findings(spark.createDataFrame([("a",)], "k string"), empty).collect() == []


def test_schema_findings(spark):
    frame = spark.createDataFrame([(1, "x")], "k int, d string")
    found = quality.schema_findings(frame, SPEC)
    assert "column 'k': expected string, found int" in found
    assert "column 'd': expected date, found string" in found
    assert "missing column: gone" in found


def test_summaries(spark):
    frame = spark.createDataFrame([(True, "a"), (False, "b"), (None, "a")], "f boolean, m string")
    assert [tuple(r) for r in quality.flag_summary(frame, ["f"], "m").collect()] == [
        ("total", "total", 3, 100.0), ("flag", "f", 1, 33.33), ("modalidad", "a", 2, 66.67), ("modalidad", "b", 1, 33.33),
    ]
    report = {r.medida: (r.valor, r.porcentaje) for r in quality.stage_report(frame, frame.filter("f IS NULL")).collect()}
    assert report == {"filas_entrada": (3, 100.0), "filas_salida": (1, 33.33), "nulos: f": (1, 100.0)}
