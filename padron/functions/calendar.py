"""Periods, month names, service time, age and contract flags, internship tenure."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names as they appear in the outputs.
MONTHS = (
    "Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio",
    "Julio", "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre",
)

# Lengths of a year and a month in days.
YEAR_DAYS = 365.25
MONTH_DAYS = 30.44

PERIOD_SHAPE = r"(\d{4}-\d{2})"


@dataclass(frozen=True)
class ContractRule:
    """Alert for one contract type once the service time reaches a number of years."""

    modality: str
    from_years: float
    column: str


@dataclass(frozen=True)
class TenureRules:
    """Day ranges that matter for one intern condition."""

    condition: str
    near_year: tuple[int, int]
    full_year: int
    near_limit: tuple[int, int]


# The age targets, contract alerts and internship day ranges of the business rules.
AGE_TARGETS = (65, 70)
CONTRACT_RULES = (
    ContractRule("CONTRATO POR OBRA O SERVICIO ESPECIFICO", 4.5, "alerta_contrato_obra"),
    ContractRule("CONTRATO POR INCREMENTO DE ACTIVIDAD", 2.5, "alerta_contrato_incremento"),
)
TENURE_RULES = TenureRules("PRACTICANTE PROFESIONAL", (335, 364), 365, (640, 729))


def as_of_date(as_of: str | None) -> Column:
    """The reference day: a fixed date makes runs repeatable, none means today."""
    return F.lit(as_of).cast("date") if as_of else F.current_date()


# ---- periods and months -------------------------------------------------------------------------


def period_from_name(file_name: Column) -> Column:
    """First YYYY-MM in a file name, null when there is none."""
    return F.nullif(F.regexp_extract(file_name, PERIOD_SHAPE, 1), F.lit(""))


def build_period(year: Column, month: Column) -> Column:
    """YYYY-MM with the month padded to two characters; longer month text is kept whole."""
    text = month.cast("string")
    padded = F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text)
    return F.concat(year.cast("string"), F.lit("-"), padded)


def period_year(period: Column) -> Column:
    return F.substring(period, 1, 4)


def period_month(period: Column) -> Column:
    text = F.substring(period, 6, 2)
    return F.when(text.rlike(r"^[0-9]+$"), text.try_cast("int"))


def month_name(month: Column, default: str | None = None) -> Column:
    """Spanish month name; a number outside 1..12 gives ``default``, a null month stays null."""
    names = F.array(*[F.lit(name) for name in MONTHS])
    name = F.when(month.between(1, 12), F.get(names, month.cast("int") - 1))
    return name if default is None else F.when(month.isNotNull(), F.coalesce(name, F.lit(default)))


# ---- service time ------------------------------------------------------------------------------


def service_years(start: Column, end: Column, as_of: Column) -> Column:
    return F.datediff(F.coalesce(end, as_of), start) / F.lit(YEAR_DAYS)


def service_text(start: Column, end: Column, as_of: Column) -> Column:
    """'<y> años, <m> meses'; an unknown start leaves the numbers out but keeps the words."""
    years = service_years(start, end, as_of)
    whole = F.floor(years).cast("int")
    months = F.floor((years - F.floor(years)) * F.lit(12)).cast("int")
    return F.concat_ws("", whole.cast("string"), F.lit(" años, "), months.cast("string"), F.lit(" meses"))


def age_flags(birth: Column, as_of: Column) -> dict[str, Column]:
    """For each target age: reached this year, reached next year. Unknown birth gives null."""
    flags = {}
    for age in AGE_TARGETS:
        flags[f"cumple_{age}_esteaño"] = F.year(birth) == F.year(as_of) - F.lit(age)
        flags[f"cumple_{age}_proximoaño"] = F.year(birth) == F.year(as_of) + F.lit(1 - age)
    return flags


def contract_alerts(
    modality: Column, years: Column, rules: tuple[ContractRule, ...] = CONTRACT_RULES
) -> dict[str, Column]:
    return {r.column: (modality == F.lit(r.modality)) & (years >= F.lit(r.from_years)) for r in rules}


# ---- internship tenure -------------------------------------------------------------------------


def tenure_parts(start: Column, renewal: Column) -> dict[str, Column]:
    """Days, whole years and remaining months between two dates; null when the renewal is unknown."""
    days = F.datediff(renewal, start)
    return {
        "dias_servicio": days,
        "anios_servicio": F.floor(days / F.lit(YEAR_DAYS)).cast("int"),
        "meses_servicio": F.floor((days % F.lit(YEAR_DAYS)) / F.lit(MONTH_DAYS)).cast("int"),
    }


def tenure_flags(condition: Column, days: Column, rules: TenureRules = TENURE_RULES) -> dict[str, Column]:
    applies = condition == F.lit(rules.condition)

    def yes_no(test: Column) -> Column:
        return F.when(days.isNotNull(), F.when(applies & test, F.lit("SI")).otherwise(F.lit("NO")))

    return {
        "por_cumplir_1": yes_no(days.between(*rules.near_year)),
        "cumplio_1": yes_no(days >= rules.full_year),
        "por_cumplir_2": yes_no(days.between(*rules.near_limit)),
    }


def tenure_phrase(years: Column, months: Column, near_year: Column, near_limit: Column) -> Column:
    """The limit messages win over the plain count of years and months."""
    year_words = F.when(years == 1, F.lit("1 año")).otherwise(F.concat(years.cast("string"), F.lit(" años")))
    month_words = F.concat(months.cast("string"), F.lit(" meses"))
    counted = (
        F.when(years == 0, month_words)
        .when(months == 0, year_words)
        .otherwise(F.concat(year_words, F.lit(" y "), month_words))
    )
    return F.when(
        years.isNotNull(),
        F.when(near_year == "SI", F.lit("1 año (En límite)"))
        .when(near_limit == "SI", F.lit("2 años (Límite Máximo)"))
        .otherwise(counted),
    )


def match_status(code: Column, matched_key: Column) -> Column:
    """Outcome of a catalogue lookup; a null code counts as not found, only empty text as missing."""
    return (
        F.when(code == "", F.lit("SIN_CODIGO"))
        .when(matched_key.isNull(), F.lit("CODIGO_NO_ENCONTRADO"))
        .otherwise(F.lit("OK"))
    )
