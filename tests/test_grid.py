import pytest
from pyspark.sql import functions as F

from padron.operators import joins
from padron.sources import grid as grids
from padron.sources.grid import HeaderRule, SheetError


def _rows(table, *names):
    return sorted(tuple(r) for r in table.select("row_idx", *[F.col(f"`{n}`") for n in names]).collect())


def test_first_blank_ends_the_header(grid_of):
    grid = grid_of({("f", "s"): {1: [" A ", "B", None, "C"], 2: ["1", "2", "x", "3"]}})
    table, names = grids.promote_header(grid, HeaderRule(1))
    assert names == ["A", "B"] and _rows(table, *names) == [(2, "1", "2")]


def test_skip_blank_keeps_positions(grid_of):
    grid = grid_of({("f", "s"): {1: ["A", " ", None, "C"], 2: ["1", "x", "x", "3"], 3: ["1"]}})
    table, names = grids.promote_header(grid, HeaderRule(1, stop="skip_blank"))
    assert names == ["A", "C"] and _rows(table, *names) == [(2, "1", "3"), (3, "1", None)]


def test_gap_rule_allows_three_blanks_in_all(grid_of):
    grid = grid_of({("f", "s"): {1: ["A", None, "B", None, None, "C", None, "D"], 2: list("12345678")}})
    table, names = grids.promote_header(grid, HeaderRule(1, stop="gap"))
    assert names == ["A", "B", "C"] and _rows(table, *names) == [(2, "1", "3", "6")]


def test_start_column_and_row_blankness(grid_of):
    grid = grid_of({("f", "s"): {2: [None, "A", "B"], 3: ["mark", "1", None], 4: ["mark", " ", None]}})
    table, names = grids.promote_header(grid, HeaderRule(2, start_col=2))
    blank = {r.row_idx: r.b for r in table.select("row_idx", grids.row_is_blank().alias("b")).collect()}
    assert names == ["A", "B"] and blank == {3: False, 4: True}


def test_files_with_different_columns_share_one_table(grid_of):
    grid = grid_of(
        {("f1", "s"): {1: ["A", "B"], 2: ["a1", "b1"]}, ("f2", "s"): {1: ["C", "A"], 2: ["c2", "a2"]}, ("f3", "s"): {2: ["no header"]}}
    )
    table, names = grids.promote_header(grid, HeaderRule(1))
    assert names == ["A", "B", "C"]
    assert sorted(tuple(r)[0:1] + tuple(r)[3:6] for r in table.collect()) == [("f1", "a1", "b1", None), ("f2", "a2", None, "c2")]


def test_repeated_name_takes_its_last_column(grid_of):
    grid = grid_of({("f", "s"): {1: ["A", "A"], 2: ["1", "2"]}})
    table, names = grids.promote_header(grid, HeaderRule(1))
    assert names == ["A"] and _rows(table, "A") == [(2, "2")]


def test_targets_by_cleaned_name(grid_of):
    grid = grid_of({("f", "s"): {4: [None, "X", "JEFE\r\n INMEDIATO "], 5: ["", "x", "j"]}})
    rule = HeaderRule(4, stop="skip_blank", one_line=True)
    table, names = grids.promote_header(grid, rule, ["JEFE INMEDIATO"])
    assert names == ["JEFE INMEDIATO"] and _rows(table, *names) == [(5, "j")]
    with pytest.raises(SheetError, match="DNI"):
        grids.promote_header(grid, rule, ["DNI"])


def test_no_header_is_an_error(grid_of):
    with pytest.raises(SheetError):
        grids.promote_header(grid_of({("f", "s"): {1: [None, ""], 2: ["1"]}}), HeaderRule(1))


def test_header_lookup_beyond_the_bound_is_shuffled(grid_of, monkeypatch):
    sheets = {(f"f{i}", "s"): {1: ["A", "B"], 2: [f"a{i}", "b"], 3: ["x", "y"]} for i in range(20)}
    expected = sorted(map(str, grids.promote_header(grid_of(sheets), HeaderRule(1))[0].collect()))
    monkeypatch.setattr(grids, "bounded_copy", lambda layout: None)
    monkeypatch.setitem(joins.lookup_join.__kwdefaults__, "max_rows", 0)
    table, _ = grids.promote_header(grid_of(sheets), HeaderRule(1))
    assert sorted(map(str, table.collect())) == expected
    assert "_salt" in table._jdf.queryExecution().optimizedPlan().toString()


def test_sheet_selection(grid_of):
    grid = grid_of({("f", "s"): {1: ["A"]}})
    assert grids.pick_sheet(grid, "s").count() == 1
    with pytest.raises(SheetError, match="'t'"):
        grids.pick_sheet(grid, "t")
    assert grids.pick_sheet(grid, "t", required=False).count() == 0


def test_periods_and_rejected_files(grid_of):
    grid = grid_of(
        {("P 2024-01.xlsx", "Planilla"): {1: ["A"]}, ("P.xlsx", "Planilla"): {1: ["A"]}, ("P 2024-02.xlsx", "Otra"): {1: ["A"]}}
    )
    rows, rejected = grids.with_period(grid, "Planilla")
    assert [r.PERIODO for r in rows.collect()] == ["2024-01"]
    assert {r.file: r.motivo for r in rejected.collect()} == {"P.xlsx": "sin periodo", "P 2024-02.xlsx": "sin hoja Planilla"}
    with pytest.raises(SheetError):
        grids.with_period(grid.filter("file = 'P.xlsx'"), "Planilla")


def test_lock_files_and_own_outputs_are_left_out(grid_of):
    grid = grid_of({("dir/~$a.xlsx", "s"): {1: ["A"]}, ("dir\\Out 1.xlsx", "s"): {1: ["A"]}, ("dir/a.xlsx", "s"): {1: ["A"]}})
    assert [r.file for r in grids.usable_files(grid, ["Out"]).collect()] == ["dir/a.xlsx"]


def test_read_grid_with_pattern(spark, grid_of, tmp_path):
    grid_of({("f", "s"): {1: ["A"]}}).write.parquet(str(tmp_path / "g"))
    assert grids.read_grid(spark, str(tmp_path / "g"), "*.parquet").count() == 1


def test_a_sheet_without_header_is_named(grid_of):
    grid = grid_of({("f1", "s"): {1: ["A"], 2: ["a"]}, ("f2", "s"): {2: ["lost"]}, ("f3", "s"): {1: [" ", None], 2: ["lost"]}, ("f4", "s"): {1: ["A"]}})
    with pytest.raises(SheetError, match=r"no header \(2 in total\): f2/s: row 1; f3/s: row 1"):
        grids.promote_header(grid, HeaderRule(1), require_header=True)
    grids.promote_header(grid.filter("file IN ('f1', 'f4')"), HeaderRule(1), require_header=True)


def test_triage_names_every_file_that_cannot_be_used(grid_of):
    head, line = ["N°", None, " DNI "], ["1", "x", "7"]
    grid = grid_of(
        {
            ("P 2024-01.xlsx", "S"): {6: head, 7: line},
            ("P 2024-02.xlsx", "S"): {7: line},
            ("P 2024-03.xlsx", "S"): {6: [None, " "], 7: line},
            ("P 2024-04.xlsx", "S"): {6: ["N°", "OTRO"], 7: line},
            ("P 2024-05.xlsx", "T"): {6: head, 7: line},
            ("P.xlsx", "S"): {6: head, 7: line},
        }
    )
    rule = HeaderRule(6, stop="gap")
    rows, rejected = grids.triage(grid, "S", rule, lambda n: n == "DNI")
    assert {(r["file"], r["PERIODO"]) for r in rows.collect()} == {("P 2024-01.xlsx", "2024-01")}
    assert dict(map(tuple, rejected.collect())) == {
        "P 2024-02.xlsx": "sin cabecera", "P 2024-03.xlsx": "sin cabecera", "P 2024-04.xlsx": "sin columna clave",
        "P 2024-05.xlsx": "sin hoja S", "P.xlsx": "sin periodo",
    }
    keyless, rejected = grids.triage(grid.filter("file LIKE '%-04%' OR file LIKE '%-02%'"), "S", rule, lambda n: n == "DNI")
    assert keyless.count() == 2 and [r["motivo"] for r in rejected.collect()] == ["sin cabecera"]
    with pytest.raises(SheetError):
        grids.triage(grid.filter("file = 'P.xlsx'"), "S", rule)


def test_broken_files_are_rows_of_the_report(spark, tmp_path):
    folder = tmp_path / "raw data"
    for i in range(4):
        rows = spark.createDataFrame([(f"f{i}", "s", 1, ["A"]), (f"f{i}", "s", 2, [str(i)])], grids.GRID_SCHEMA)
        rows.coalesce(1).write.parquet(str(folder / f"part {i}"))
    files = sorted(p for p in folder.rglob("*.parquet"))
    files[1].write_bytes(b"no table at all")
    files[2].write_bytes(b"")
    grid, broken = grids.read_grid_files(spark, str(folder / "*"))
    assert sorted(r["file"] for r in grid.select("file").distinct().collect()) == ["f0", "f3"]
    found = broken.collect()
    assert {r["motivo"] for r in found} == {grids.UNREADABLE} and len(found) == 2
    clean, none = grids.read_grid_files(spark, str(folder / "part 0"))
    assert clean.count() == 2 and none.count() == 0
