"""Each flow from raw sheets to stored tables, on small sheets that hold the known oddities."""

from datetime import date

import pytest

from padron.operators import quality
from padron.operators.aggregates import null_profile
from padron.operators.quality import QualityError, check_sources
from padron.plans import cost_centres, employees, exams, income, internships, leaves, payroll
from padron.plans import tables as t
from padron.sources import sinks, tables
from padron.sources.grid import SheetError


def _line(header, **values):
    return [values.get(h) if h else None for h in header]


def _rows(frame, *names):
    return [tuple(r[n] for n in names) for r in frame.collect()]


# ---- employee master ---------------------------------------------------------------------------

MASTER = [*t.EMPLOYEES.columns, "CC", "NOMBRE CC", "CATEGORIA CC"]


def _master(grid_of):
    def person(doc, modality, born, hired, ended=None, **more):
        return _line(
            MASTER, **{"NUMERO DE DOC": doc, "Modalidad de Contrato": modality, "FECHA DE NAC.": born,
                       "FECH_INGR.": hired, "Fecha de Termino": ended, "GERENCIA": "G", **more},
        )

    obra = "CONTRATO POR OBRA O SERVICIO ESPECIFICO"
    return grid_of(
        {
            ("bd.xlsx", "BD"): {
                1: ["title"],
                10: [*MASTER, None, "beyond"],
                11: person("1", obra, "1/2/1935", "2015-01-01 00:00:00", CC="20", **{"NOMBRE CC": "first"}),
                12: person("2", "TERMINO DE CONVENIO", "1990-01-01 00:00:00", "nan", CC="10", **{"NOMBRE CC": "None"}),
                13: person(" 3 ", None, "31/02/2000", "2020-01-01", CC="20", **{"NOMBRE CC": "second"}),
                14: person(" ", "x", None, None),
                15: person("4", "x", None, None),
            }
        }
    )


def test_employee_flow(spark, grid_of, tmp_path):
    grid = _master(grid_of)
    silver = employees.clean(grid)
    assert _rows(silver.orderBy("row_idx"), "NUMERO DE DOC", "FECHA DE NAC.", "FECH_INGR.") == [
        ("1", "1935-02-01 00:00:00", "2015-01-01 00:00:00"),
        ("2", "1990-01-01 00:00:00", None),
        ("3", "31/02/2000", "2020-01-01"),
    ]
    assert employees.clean(grid, "BD", stop_rule="none").count() == 5
    staff, interns, missing = employees.gold(silver)
    assert missing == [] and staff.count() == 1 and interns.count() == 1
    assert _rows(staff, "FECHA DE NAC.", "FECH_INGR.") == [(date(1935, 2, 1), date(2015, 1, 1))]
    paths = employees.run(grid, str(tmp_path), "BD", as_of="2000-01-01")
    flagged = spark.read.parquet(paths["flags"]["actual"])
    assert flagged.columns == [*staff.columns, "tiempo_servicio_texto", *employees.FLAGS]
    assert _rows(flagged, "cumple_65_esteaño", "alerta_contrato_obra") == [(True, False)]
    assert {r.grupo for r in employees.summary(flagged).collect()} == {"total", "flag", "modalidad"}
    with pytest.raises(SheetError):
        employees.clean(grid, "OTHER")
    with pytest.raises(ValueError, match="FECH_INGR."):
        employees.flags(staff.drop("FECH_INGR."))


def test_flag_modes_agree_when_documents_are_unique(spark, grid_of):
    staff, _, _ = employees.gold(employees.clean(_master(grid_of)))
    forms = [sorted(map(str, employees.flags(staff, "2000-01-01", m).collect())) for m in ("auto", "projection")]
    assert forms[0] == forms[1]
    counted = employees.flags(staff, "2000-01-01", "counted")
    assert {r["repeticiones"] for r in counted.collect()} == {1}
    assert sorted(map(str, counted.drop("repeticiones").collect())) == forms[0]


def test_repeated_documents_fan_out_like_the_plain_joins(spark):
    columns = "`NUMERO DE DOC` string, `FECHA DE NAC.` date, `FECH_INGR.` date, `Fecha de Termino` date, `Modalidad de Contrato` string"
    people = [("1", None, date(2015, 1, 1), None, "a"), ("1", date(1935, 1, 1), None, None, "b"), ("2", None, None, None, "c"), (None, date(1935, 1, 1), None, None, "d")]
    out = employees.flags(spark.createDataFrame(people, columns), "2000-01-01")
    assert out.selectExpr("sum(repeticiones)").first()[0] == 16 + 1 + 1 and out.count() < 18
    unknown = out.filter("`NUMERO DE DOC` IS NULL").first()
    assert unknown["tiempo_servicio_texto"] is None and unknown["cumple_65_esteaño"] is None


def test_summary_of_repeated_documents_counts_the_joined_rows(spark):
    columns = "`NUMERO DE DOC` string, `FECHA DE NAC.` date, `FECH_INGR.` date, `Fecha de Termino` date, `Modalidad de Contrato` string"
    people = [("1", None, date(2015, 1, 1), None, "a"), ("1", date(1935, 1, 1), None, None, "b"), ("2", None, None, None, "c")]
    out = employees.flags(spark.createDataFrame(people, columns), "2000-01-01")
    told = {(r["grupo"], r["valor"]): (r["cantidad"], r["porcentaje"]) for r in employees.summary(out).collect()}
    assert told["total", "total"] == (17, 100.0)
    assert told["modalidad", "a"] == told["modalidad", "b"] == (8, 47.06) and told["modalidad", "c"] == (1, 5.88)


def test_cost_centre_flow(spark, grid_of, tmp_path):
    silver = employees.clean(_master(grid_of))
    paths = cost_centres.run(silver, str(tmp_path))
    stored = spark.read.parquet(paths["historico"])
    assert sorted(_rows(stored, "CC", "NOMBRE CC")) == [("10", None), ("20", "first")]
    assert stored.columns == ["CC", "NOMBRE CC", "CATEGORIA CC", "GERENCIA"]
    with pytest.raises(ValueError):
        cost_centres.catalogue(silver.drop("CC"))


# ---- payroll and leave ---------------------------------------------------------------------------


def _payroll(grid_of):
    head = ["N°", "DNI/CEX", None, "SEXO", "DIAS GOCE HABER(D)", "HORAS EXTRAS 25%", "F. NACIMIENTO"]
    return grid_of(
        {
            ("Planilla 2024-01 Empleados.xlsx", "Planilla"): {
                6: head,
                7: ["1", "10", "gap", " M ", "30", "1.5", "1980-01-02 00:00:00"],
                8: [None, "x"],
                9: ["Total de trabajadores del mes", None],
                10: ["2", None, None, "F", "3", "x", None],
            },
            ("Planilla 2024-02 Empleados.xlsx", "Planilla"): {
                6: ["N°", "DNI/CEX", "NOMBRES", "NETO"],
                7: ["1", "10", "Ana", "5"],
                8: ["2", "20", "Eva", "bad"],
            },
            ("~$Planilla 2024-02 Empleados.xlsx", "Planilla"): {6: ["x"], 7: ["1"]},
            ("Planilla.xlsx", "Planilla"): {6: ["DNI/CEX"], 7: ["1"]},
            ("Planilla 2024-03.xlsx", "Otra"): {6: ["DNI/CEX"], 7: ["1"]},
        }
    )


def test_payroll_flow(spark, grid_of, tmp_path):
    grid = _payroll(grid_of)
    silver, rejected = payroll.consolidate(grid)
    assert {r.file for r in rejected.collect()} == {"Planilla.xlsx", "Planilla 2024-03.xlsx"}
    assert silver.columns[:3] == ["PERIODO", "AÑO", "MES"] and dict(silver.dtypes)["MES"] == "int"
    assert sorted(_rows(silver, "PERIODO", "AÑO", "MES", "DNI/CEX", "SEXO", "NOMBRES")) == [
        ("2024-01", "2024", 1, "10", " M ", None),
        ("2024-02", "2024", 2, "10", None, "Ana"),
        ("2024-02", "2024", 2, "20", None, "Eva"),
    ]
    gold, notes = payroll.gold(silver)
    assert gold.columns[:4] == ["PERIODO", "AÑO", "MES", "NOMBRE_MES"]
    first = gold.filter("PERIODO = '2024-01'").first()
    assert (first["SEXO"], first["NOMBRE_MES"], first["F. NACIMIENTO"], first["HORAS EXTRAS 25%"]) == ("M", "Enero", date(1980, 1, 2), 1.5)
    assert notes["kept_as_text"] == [] and "ÁREA" in notes["missing"]
    mining, _ = payroll.mining_gold(silver)
    assert sorted(_rows(mining, "NETO"), key=str) == [(5.0,), (None,), (None,)]
    found = {(r.columna, r.regla) for r in payroll.findings(gold).collect()}
    assert ("NOMBRES", "nulo") in found and ("PERIODO, DNI/CEX", "clave") not in found
    paths = payroll.run(grid, str(tmp_path))
    assert spark.read.parquet(paths["gold"]).count() == 3
    assert spark.read.parquet(payroll.run(grid, str(tmp_path), mining=True)["gold"]).count() == 3


def test_one_bad_value_keeps_a_payroll_column_as_text(grid_of):
    silver, _ = payroll.consolidate(_payroll(grid_of))
    spoiled = silver.withColumn("DIAS GOCE HABER(D)", silver["`N°`"]).replace("2", "30.0", ["DIAS GOCE HABER(D)"])
    gold, notes = payroll.gold(spoiled)
    assert notes["kept_as_text"] == ["DIAS GOCE HABER(D)"]
    relaxed, notes = payroll.gold(spoiled, int_from_decimal_text=True)
    assert notes["kept_as_text"] == [] and dict(relaxed.dtypes)["DIAS GOCE HABER(D)"] == "bigint"


def _leaves(grid_of, **paid_row):
    paid = ["DNI/CEX", None, "PERIODO", "APELLIDO PATERNO", "APELLIDO MATERNO", "NOMBRES", "MOTIVO DE LIC.CON GOCE"]
    unpaid = ["DNI/CEX", "PERIODO", "APELLIDO PATERNO", "APELLIDO MATERNO", "NOMBRES", "MOTIVO DE LIC.S.G.H", "OBS"]
    full = dict(zip(paid, ["10.0", None, "2024-01", "P", "M", "N", "Salud"]), **paid_row)
    return grid_of(
        {
            ("l.xlsx", "LICENCIA CON GOCE"): {2: paid, 3: [full[h] for h in paid], 4: ["10.0", "x", "2024-01", "P", "M", "N", "Duelo"],
                                              5: [" ", None, "2024-01", "P", "M", "N", "x"], 6: ["10", None, "2024-01", "P", "M", "N", " "]},
            ("l.xlsx", "LICENCIA SIN GOCE"): {2: unpaid, 3: ["20", "2024-02", "P", "M", "N", "Viaje", "o"]},
        }
    )


def test_leave_flow(spark, grid_of, tmp_path):
    silver = leaves.consolidate(_leaves(grid_of))
    assert silver.columns == t.LEAVES.columns
    assert sorted(_rows(silver, "DNI/CEX", "MOTIVO", "TIPO_LICENCIA")) == [
        ("10", "Duelo", "CON_GOCE"), ("10", "Salud", "CON_GOCE"), ("20", "Viaje", "SIN_GOCE"),
    ]
    pay, _ = payroll.gold(payroll.consolidate(_payroll(grid_of))[0])
    enriched = leaves.enrich(pay, silver)
    assert sorted(_rows(enriched, "PERIODO", "DNI/CEX", "MOTIVO_CON_GOCE", "MOTIVO_SIN_GOCE")) == [
        ("2024-01", "10", "Duelo | Salud", None), ("2024-02", "10", None, None), ("2024-02", "20", None, "Viaje"),
    ]
    assert {r.indicador: r.cantidad for r in leaves.coverage(enriched).collect()} == {"MOTIVO_CON_GOCE": 1, "MOTIVO_SIN_GOCE": 1}
    assert spark.read.parquet(leaves.run(_leaves(grid_of), pay, str(tmp_path))["gold"]).count() == 3


def test_leave_checks_block(grid_of):
    bad = _leaves(grid_of, NOMBRES=None)
    with pytest.raises(QualityError, match="NOMBRES"):
        leaves.consolidate(bad)
    assert leaves.consolidate(bad, check="report").count() == 3
    with pytest.raises(SheetError):
        leaves.consolidate(bad.filter("sheet = 'x'"))
    assert leaves.consolidate(bad.filter("sheet LIKE '%SIN%'")).count() == 1


def test_leave_flow_publishes_nothing_when_checks_fail(spark, grid_of, tmp_path):
    pay, _ = payroll.gold(payroll.consolidate(_payroll(grid_of))[0])
    with pytest.raises(QualityError):
        leaves.run(_leaves(grid_of, NOMBRES=None), pay, str(tmp_path))
    assert not [p for p in (tmp_path / "silver").iterdir() if not p.name.startswith(".")]
    assert spark.read.parquet(str(tmp_path / "reportes" / "licencias" / "hallazgos")).count() > 0


# ---- income, internships, exams ------------------------------------------------------------------


def test_income_flow(spark, grid_of, tmp_path):
    staff = [None, *[c for c in t.INCOME_EMPLOYEES.columns if c != "PERIODO"], "PROYECTO", "CODIGO SAP"]
    students = [*[c for c in t.INCOME_INTERNS.columns if c != "PERIODO"], "CODIGO SAP"]
    grid = grid_of(
        {
            ("r.xlsx", "EMPLEADOS"): {
                2: staff,
                3: _line(staff, **{"AÑO": "2024", "MES": "1", "DNI": "7", "PROYECTO": "0", "CODIGO SAP": "#N/D", "SERVICIO": ""}),
                4: _line(staff, **{"AÑO": "2024", "MES": "13", "DNI": "8", "PROYECTO": "P", "CODIGO SAP": "1", "REGIMEN": "R"}),
                5: ["mark", " "],
                6: _line(staff, DNI="9"),
            },
            ("r.xlsx", "PRACTICANTES"): {2: students, 3: _line(students, **{"AÑO": "2024", "MES": "12", "Numero Documento": "5"})},
        }
    )
    silver = income.clean(income.read_sheet(grid, "EMPLEADOS"))
    assert silver.columns[0] == "PERIODO"
    assert sorted(_rows(silver, "PERIODO", "DNI", "PROYECTO", "CODIGO SAP")) == [("2024-01", "7", "Staff", None), ("2024-13", "8", "P", "1")]
    gold = income.employees_gold(silver)
    assert sorted(_rows(gold, "MES", "NOMBRE_MES", "SERVICIO", "REGIMEN")) == [
        (1, "Enero", "Personal_Interno", "Personal_Interno"), (13, "", "Personal_Interno", "R"),
    ]
    paths = income.run(grid, str(tmp_path))
    interns = spark.read.parquet(paths["relacion_ingresos_practicantes_gold"]["actual"])
    assert _rows(interns, "NOMBRE_MES", "Universidad de Procedencia") == [("Diciembre", "POR DEFINIR")]
    reports = income.reports(silver, silver, interns)
    assert set(reports) == {"etapa", "periodos", "nulos", "universidades"} and reports["periodos"].count() == 1
    with pytest.raises(ValueError, match="SERVICIO"):
        income.employees_gold(silver.drop("SERVICIO"))


def test_internship_flow(spark, grid_of, tmp_path):
    head = ["N°", "DNI", None, "APELLIDOS\nY NOMBRES", "CONDICION", "FECHA ING", "F.  RENOVACION", "SEDE", "UNIVERSIDAD", "JEFE INMEDIATO", "GERENCIA"]
    pro = "PRACTICANTE PROFESIONAL"

    def intern(doc, start, end):
        return ["1.0", doc, "x", " A ", pro, start, end, "S", "U", "J", "G"]

    sheet = {4: head, 5: intern("1", "45292", "01/12/2024"), 6: intern(None, "x", "x"), 7: intern("2", "2024-01-01 00:00:00", None), 1100: intern("3", None, None)}
    grid = grid_of({("c.xlsx", "Practicantes"): sheet})
    silver = internships.clean(grid)
    assert _rows(silver, "N°", "DNI", "FECHA ING", "F. RENOVACION") == [
        ("1", "1", date(2024, 1, 1), date(2024, 12, 1)), ("1", "2", date(2024, 1, 1), None),
    ]
    assert internships.findings(silver) == []
    gold = internships.gold(silver)
    assert sorted(_rows(gold, "DNI", "dias_servicio", "por_cumplir_1", "tiempo_servicio"), key=str) == [
        ("1", 335, "SI", "1 año (En límite)"), ("2", None, None, None),
    ]
    assert {r.indicador: r.cantidad for r in internships.flag_counts(gold).collect()}["por_cumplir_1"] == 1
    assert spark.read.parquet(internships.run(grid, str(tmp_path))["gold"]).count() == 2
    with pytest.raises(SheetError, match="SEDE"):
        internships.clean(grid_of({("c.xlsx", "Practicantes"): {4: [h for h in head if h != "SEDE"]}}))


def test_gold_order_puts_unknown_dates_last(spark):
    columns = ["DNI", "CONDICION", "FECHA ING", "F. RENOVACION", "SEDE", "UNIVERSIDAD", "JEFE INMEDIATO", "GERENCIA"]
    rows = [(str(i), "x", d, None, "", "", "", "") for i, d in enumerate([None, date(2020, 1, 1), date(2024, 1, 1)])]
    schema = ", ".join(f"`{c}` {'date' if c in internships.DATES else 'string'}" for c in columns)
    assert [r.DNI for r in internships.gold(spark.createDataFrame(rows, schema)).collect()] == ["2", "1", "0"]


def test_exam_flow(spark, grid_of, tmp_path):
    head = ["NOMBRE", "DNI", "FECHA DE CESE", "CAUSA DE SALIDA", "CARGO", "NOMBRE DE CC"]
    grid = grid_of(
        {
            ("e.xlsx", "DATA"): {
                3: head,
                4: [" Zoe ", "12.0", "2024-05-01 00:00:00", None, "ANALYST", "#N/D"],
                5: ["Ana", "13", "2024-06-01", "x", "STUDENT INTERNAL", "1"],
                6: ["Eva", "14", "#REF!", "x", None, "1.0"],
                7: [" ", "15", None, None, None, None],
                8: ["Off", "16", None, None, None, None],
            }
        }
    )
    silver = exams.clean(grid)
    assert sorted(_rows(silver, "NOMBRE", "DNI", "FECHA DE CESE", "CARGO", "NOMBRE DE CC")) == [
        ("Ana", "13", date(2024, 6, 1), "STUDENT INTERNAL", "1"),
        ("Eva", "14", None, "", "1"),
        ("Zoe", "12", date(2024, 5, 1), "ANALYST", ""),
    ]
    assert exams.clean(grid, strict_dates=True).filter("`FECHA DE CESE` IS NOT NULL").count() == 1
    gold, missing = exams.gold(silver)
    assert missing == [] and gold.columns == t.EXAMS.columns
    assert sorted(_rows(gold, "NOMBRE", "AÑO", "MES", "NOMBRE_MES")) == [("Eva", None, None, None), ("Zoe", 2024, 5, "Mayo")]
    columns = "CC string, `NOMBRE CC` string, `CATEGORIA CC` string, GERENCIA string"
    current = spark.createDataFrame([("1", "uno", "c", "g")], columns)
    paths = exams.run(grid, current, current.limit(0), str(tmp_path))
    enriched = spark.read.parquet(paths["enriched"]["actual"])
    assert sorted(_rows(enriched, "NOMBRE", "codigo_cc_original", "nombre_cc_completo", "status_match")) == [
        ("Eva", "1", "uno", "OK"), ("Zoe", "", None, "SIN_CODIGO"),
    ]
    assert {r.status_match: r.porcentaje for r in exams.status_summary(enriched).collect()} == {"OK": 50.0, "SIN_CODIGO": 50.0}
    assert spark.read.csv(str(tmp_path / "gold/revision/examenes_retiro_gold"), header=True).count() == 2


def test_fixed_contracts_fit_their_sheets(grid_of):
    assert check_sources(_payroll(grid_of).filter("file LIKE 'Planilla 2024-02%'"), t.MINING_CONTRACT).count() == 0
    assert check_sources(_leaves(grid_of), t.LEAVE_CONTRACT).count() == 0
    assert check_sources(_master(grid_of), t.employee_contract("BD")).count() == 0
    rules = {r.rule for r in check_sources(_payroll(grid_of), t.PAYROLL_CONTRACT).collect()}
    assert rules == {"missing_sheet", "missing_columns"}


# ---- reports and outputs of whole runs ---------------------------------------------------------


def test_reports_from_a_write_equal_those_from_passes(spark, tmp_path):
    rows = [(None, "a", True, 2), ("x", None, False, 1), ("y", "a", None, 5), ("z", "b", True, 1)]
    frame = spark.createDataFrame(rows, "`k.k` string, m string, f boolean, n int")
    kept = frame.filter("m IS NOT NULL")
    measures = {**quality.null_measures(kept.columns), **quality.flag_measures(["f"], "n")}
    stored = sinks.write_current(kept, str(tmp_path / "t"), observe=measures)
    told = tables.metrics(spark, str(tmp_path / "t"))

    def same(a, b):
        return a.columns == b.columns and sorted(map(str, a.collect())) == sorted(map(str, b.collect()))

    assert same(quality.observed_stage(spark, 4, told), quality.stage_report(frame, kept))
    assert same(quality.observed_nulls(spark, told), null_profile(kept).select("columna", "nulos", "total", "porcentaje"))
    assert same(quality.observed_flag_summary(stored, told, "m", "n"), quality.flag_summary(kept, ["f"], "m", "n"))
    empty = sinks.write_current(kept.limit(0), str(tmp_path / "e"), observe=quality.null_measures(kept.columns))
    assert same(quality.observed_stage(spark, 4, tables.metrics(spark, str(tmp_path / "e"))), quality.stage_report(frame, empty))


def test_outputs_keep_names_of_their_own(spark, tmp_path):
    paths = {"silver": "s", "gold": {"actual": "a", "historico": "h"}, "enriched": {"actual": "b", "historico": "i"}}
    assert sinks.flat_outputs(paths) == {"silver": "s", "gold.actual": "a", "gold.historico": "h", "enriched.actual": "b", "enriched.historico": "i"}
    with pytest.raises(FileNotFoundError, match="enriched.actual"):
        sinks.missing_outputs(spark, {f"{n}": f"{tmp_path}/{p}" for n, p in sinks.flat_outputs(paths).items()})


def test_a_payroll_run_reports_every_file_it_left_out(spark, grid_of, tmp_path):
    broken = spark.createDataFrame([("file:/raw/x.parquet", "ilegible")], "file string, motivo string")
    paths = payroll.run(_payroll(grid_of), str(tmp_path), unreadable=broken)
    told = {r["file"]: r["motivo"] for r in tables.read(spark, paths["rechazados"]).collect()}
    assert told["file:/raw/x.parquet"] == "ilegible" and told["Planilla.xlsx"] == "sin periodo"
