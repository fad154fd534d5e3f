"""The columns, types, keys, bounds and contracts of the workforce tables."""

from __future__ import annotations

from padron.operators.row_rules import RowRule
from padron.sources.contracts import SheetContract, SourceContract
from padron.sources.specs import FieldSpec, FilterSpec, TableSpec

# Bounds and value lists shared by several tables.
SEXES = ("M", "F")
LEAVE_KINDS = ("CON_GOCE", "SIN_GOCE")
PERIOD_PATTERN = r"^\d{4}-\d{2}$"
# How far net pay may be from income less deductions: one cent, and what floating point adds.
NET_TOLERANCE = 0.0101


def _texts(*names: str, nullable: bool = True) -> list[FieldSpec]:
    return [FieldSpec(n, nullable=nullable) for n in names]


def _dates(*names: str, nullable: bool = True) -> list[FieldSpec]:
    return [FieldSpec(n, "date", nullable) for n in names]


def _amounts(*names: str, type: str = "float") -> list[FieldSpec]:
    return [FieldSpec(n, type, minimum=0) for n in names]


_MONTH = FieldSpec("MES", "integer", False, minimum=1, maximum=12)

EMPLOYEES = TableSpec(
    "employees",
    (
        *_texts(
            "NUMERO DE DOC",
            "CODIGO SAP2",
            "NOMBRE COMPLETOS",
            "GERENCIA",
            "SEXO",
            "SEDE3",
            "WHITE COLLAR / BLUE COLLAR",
            "Modalidad de Contrato",
            nullable=False,
        ),
        *_dates("Fecha de Termino", nullable=False),
        *_texts("SERVICIO", "REGIMEN DE TRABAJO", nullable=False),
        *_dates("FECH_INGR.", "FECHA DE NAC.", nullable=False),
    ),
    primary_key=("NUMERO DE DOC",),
)
INTERN_MODALITY = "TERMINO DE CONVENIO"

COST_CENTRES = TableSpec(
    "cost_centres", tuple(_texts("CC", "NOMBRE CC", "CATEGORIA CC", "GERENCIA")), primary_key=("CC",)
)

PAYROLL = TableSpec(
    "payroll",
    (
        *_texts("PERIODO", "AÑO", nullable=False),
        _MONTH,
        *_texts("CÓDIGO CORPORATIVO"),
        *_texts("APELLIDO PATERNO", nullable=False),
        *_texts("APELLIDO MATERNO"),
        *_texts("NOMBRES", "TIPO DE DOCUMENTO", "DNI/CEX", nullable=False),
        FieldSpec("SEXO", allowed=SEXES),
        *_dates("F. NACIMIENTO"),
        *_texts("ÁREA", "CENTRO DE COSTOS"),
        *_dates("FECHA DE INGRESO", "FECHA CESE"),
        *_texts("MOTIVO CESE"),
        *_amounts("DIAS SUBSIDIO ENFERMEDAD", "DIAS GOCE HABER(D)", type="integer"),
        *_amounts(
            "# HRS EXTRAS SIMP.25%",
            "# HRS EXTRAS SIMP.35%",
            "#HRS EXTRAS DOBLES",
            "#HRS SIMP.50%",
            "HRS SIMPLES AL 50%",
            "HORAS EXTRAS 25%",
            "HORAS EXTRAS 35%",
            "HORAS EXTRAS 100%",
            "LICENCIA GOCE HABER",
        ),
        *_amounts("DIAS DIST.LIC.S.GH", type="integer"),
        *_amounts("SUBS. POR ENFERMEDAD", "SUBS. POR ACCIDENTE"),
    ),
    primary_key=("PERIODO", "DNI/CEX"),
    row_rules=(
        RowRule("cese posterior al ingreso", {"compare": ["FECHA CESE", ">", "FECHA DE INGRESO"]}),
        RowRule("motivo solo con cese", {"if": {"set": "MOTIVO CESE"}, "then": {"set": "FECHA CESE"}}),
    ),
)

MINING_PAYROLL = TableSpec(
    "mining_payroll",
    (
        *_texts("PERIODO", nullable=False),
        _MONTH,
        *_texts("AÑO", nullable=False),
        *_texts("CÓDIGO CORPORATIVO"),
        *_texts("DNI/CEX", nullable=False),
        FieldSpec("SEXO", allowed=SEXES),
        *_dates("F. NACIMIENTO"),
        *_texts("PUESTO", "SEDE", "ÁREA", "CENTRO DE COSTOS", "DESC. CENTRO DE COSTO"),
        *_dates("FECHA DE INGRESO"),
        FieldSpec("DIAS TRABAJADOS", "integer", minimum=0, maximum=31),
        *_amounts(
            "DIAS DESC MEDICO (P)",
            "# HRS EXTRAS SIMP.25%",
            "# HRS EXTRAS SIMP.35%",
            "HORAS EXTRAS 25%",
            "HORAS EXTRAS 35%",
            "#HRS EXTRAS DOBLES",
            "HORAS EXTRAS 100%",
            "DESCANSO MEDICO",
            "TOTAL INGRESOS",
            "TOTAL DESCUENTOS",
            "TOTAL APORTACIONES",
        ),
        FieldSpec("NETO", "float"),
    ),
    primary_key=("PERIODO", "DNI/CEX"),
    row_rules=(
        RowRule(
            "neto cuadra",
            {"sum": {"TOTAL INGRESOS": 1, "TOTAL DESCUENTOS": -1}, "equals": "NETO", "tolerance": NET_TOLERANCE},
            "aviso",
        ),
        RowRule("dias trabajados en rango", {"between": ["DIAS TRABAJADOS", 0, 31]}),
        RowRule("ingreso anterior al periodo", {"compare": ["FECHA DE INGRESO", "<=", {"period_end": "PERIODO"}]}),
        RowRule("neto no negativo", {"compare": ["NETO", ">=", 0]}, "aviso"),
    ),
)

LEAVES = TableSpec(
    "leaves",
    (
        *_texts(
            "PERIODO", "DNI/CEX", "APELLIDO PATERNO", "APELLIDO MATERNO", "NOMBRES", "MOTIVO", nullable=False
        ),
        FieldSpec("TIPO_LICENCIA", nullable=False, allowed=LEAVE_KINDS),
    ),
    rename={"MOTIVO DE LIC.CON GOCE": "MOTIVO", "MOTIVO DE LIC.S.G.H": "MOTIVO"},
)
LEAVE_SHEETS = {"LICENCIA CON GOCE": "CON_GOCE", "LICENCIA SIN GOCE": "SIN_GOCE"}
LEAVE_OUTPUTS = {"CON_GOCE": "MOTIVO_CON_GOCE", "SIN_GOCE": "MOTIVO_SIN_GOCE"}

INTERNSHIPS = TableSpec(
    "internships",
    (
        *_texts("N°", "DNI", "APELLIDOS Y NOMBRES", "CONDICION", nullable=False),
        *_dates("FECHA ING", "F. RENOVACION", nullable=False),
        *_texts("SEDE", "UNIVERSIDAD", "JEFE INMEDIATO", "GERENCIA", nullable=False),
    ),
)

INCOME_EMPLOYEES = TableSpec(
    "income_employees",
    (
        FieldSpec("PERIODO", nullable=False, pattern=PERIOD_PATTERN),
        FieldSpec("AÑO", "integer", False, minimum=2020),
        _MONTH,
        *_texts("DNI", "N° DOCUM.", nullable=False),
        *_dates("FECHA NACIMIENTO"),
        FieldSpec("SEXO", allowed=SEXES),
        *_texts("DEPARTAMENTO", "PROVINCIA", "DISTRITO", "CARGO", "ÁREA", "LUGAR DE TRABAJO"),
        *_dates("FECHA INICIO"),
        *_texts("WC/BC", "Tiempo de contrato"),
        *_texts("SERVICIO", "REGIMEN", nullable=False),
    ),
    primary_key=("PERIODO", "DNI"),
)

INCOME_INTERNS = TableSpec(
    "income_interns",
    (
        FieldSpec("PERIODO", nullable=False, pattern=PERIOD_PATTERN),
        FieldSpec("AÑO", "integer", False, minimum=2020),
        _MONTH,
        *_texts("Numero Documento", nullable=False),
        FieldSpec("Sexo", allowed=SEXES),
        *_texts("Cargo", "Área", "Jefe Directo", "Lugar de Trabajo", "Universidad de Procedencia", "Modalidad"),
    ),
    primary_key=("PERIODO", "Numero Documento"),
)

EXAMS = TableSpec(
    "exams",
    (
        *_texts("NOMBRE", "DNI", nullable=False),
        *_dates("FECHA DE CESE", nullable=False),
        *_texts("CAUSA DE SALIDA", "CARGO", "NOMBRE DE CC"),
        FieldSpec("AÑO", "integer", False, derived_from="FECHA DE CESE"),
        FieldSpec("MES", "integer", False, minimum=1, maximum=12, derived_from="FECHA DE CESE"),
        FieldSpec("NOMBRE_MES", derived_from="FECHA DE CESE"),
    ),
    primary_key=("DNI", "FECHA DE CESE"),
    filters=(FilterSpec("CARGO", "NOT_EQUAL", "STUDENT INTERNAL"),),
)
EXAM_DATES = (
    "F. NACIMIENTO",
    "FECHA DE CESE",
    "UTLIMA FECHA PARA EXAMEN MEDICO",
    "2DA CONVOCATORIA EXAMEN MEDICO",
)

# ---- source contracts --------------------------------------------------------------------------


def employee_contract(sheet: str) -> SourceContract:
    """The master sheet is named after the company, so its name is the caller's."""
    return SourceContract("bd", "BD Bronze", (SheetContract(sheet, 10, 1, tuple(EMPLOYEES.columns)),))


INTERNSHIP_CONTRACT = SourceContract(
    "control_practicantes",
    "Control Practicantes Bronze",
    (SheetContract("Practicantes", 4, 1, tuple(INTERNSHIPS.columns)),),
)
EXAM_CONTRACT = SourceContract(
    "examen_retiro",
    "Examen Retiro Bronze",
    (SheetContract("DATA", 3, 1, ("NOMBRE", "DNI", "FECHA DE CESE")),),
)
INCOME_CONTRACT = SourceContract(
    "ingresos",
    "PDT Relacion de Ingresos Bronze",
    (
        SheetContract("EMPLEADOS", 2, 2, ("AÑO", "MES", "DNI", "N° DOCUM.")),
        SheetContract("PRACTICANTES", 2, 1, ("AÑO", "MES", "Numero Documento")),
    ),
)
_LEAVE_COLUMNS = ("PERIODO", "DNI/CEX", "APELLIDO PATERNO", "APELLIDO MATERNO", "NOMBRES")
LEAVE_CONTRACT = SourceContract(
    "licencias",
    "Licencias Bronze",
    (
        SheetContract("LICENCIA CON GOCE", 2, 1, (*_LEAVE_COLUMNS, "MOTIVO DE LIC.CON GOCE")),
        SheetContract("LICENCIA SIN GOCE", 2, 1, (*_LEAVE_COLUMNS, "MOTIVO DE LIC.S.G.H")),
    ),
)
PAYROLL_CONTRACT = SourceContract(
    "nomina",
    "Nomina Bronze",
    (SheetContract("Planilla", 6, 1, ("APELLIDO PATERNO", "NOMBRES", "TIPO DE DOCUMENTO", "DNI/CEX")),),
)
MINING_CONTRACT = SourceContract(
    "regimen_minero",
    "Nomina Regimen Minero Bronze",
    (SheetContract("Planilla", 6, 1, ("DNI/CEX",)),),
    file_name_pattern=r"(?i)^.*(?:19|20)\d{2}-\d{2}.*\.(xlsx|xlsm|xls)$",
)
