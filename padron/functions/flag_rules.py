"""Age and contract alerts as rows of a rule table, so that rules change without code."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce
from operator import or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from padron.functions import calendar

# A rule table with more rows than this is no rule table; rules become part of every task's plan.
MAX_RULES = 1000


class FlagRuleError(ValueError):
    """A rule table or document that can't be used."""


@dataclass(frozen=True)
class ContractFlag:
    """An alert for one contract type from a service time on, until another if given, on the days it is valid."""

    modality: str
    column: str
    from_years: float
    until_years: float | None = None
    active: bool = True
    valid_from: date | None = None
    valid_to: date | None = None


@dataclass(frozen=True)
class AgeFlag:
    """Whether an age is reached this year and next year, in two columns."""

    age: int
    this_year: str
    next_year: str
    active: bool = True


@dataclass(frozen=True)
class FlagRules:
    ages: tuple[AgeFlag, ...] = ()
    contracts: tuple[ContractFlag, ...] = ()
    #: Contract types that have no age alerts, and those that have no contract alerts whatever a rule says.
    without_age: tuple[str, ...] = ()
    without_contract: tuple[str, ...] = ()

    @property
    def age_columns(self) -> list[str]:
        return [c for a in self.ages if a.active for c in (a.this_year, a.next_year)]

    @property
    def contract_columns(self) -> list[str]:
        """One column may have rules for several contract types; a rule that is off gives none."""
        return list(dict.fromkeys(r.column for r in self.contracts if r.active))

    @property
    def columns(self) -> list[str]:
        return [*self.age_columns, *self.contract_columns]


DEFAULT = FlagRules(
    tuple(AgeFlag(a, f"cumple_{a}_esteaño", f"cumple_{a}_proximoaño") for a in calendar.AGE_TARGETS),
    tuple(ContractFlag(r.modality, r.column, r.from_years) for r in calendar.CONTRACT_RULES),
)


def rules_from_json(document: Mapping[str, Any]) -> FlagRules:
    """Rules from a document with ``reglas_edad``, ``reglas_contrato`` and ``contratos_excluidos``."""
    ages = []
    for rule in document.get("reglas_edad", {}).values():
        alerts = rule["alertas"]
        this, following = (alerts[k]["columna_resultado"] for k in ("cumple_este_año", "cumple_proximo_año"))
        ages.append(AgeFlag(int(rule["edad_objetivo"]), this, following, bool(rule.get("activo", True))))
    contracts = [
        ContractFlag(
            rule["modalidad"],
            rule["columna_resultado"],
            float(rule["alerta_desde_años"]) if "alerta_desde_años" in rule else rule["alerta_desde_meses"] / 12,
            float(rule["alerta_hasta_años"]) if rule.get("alerta_hasta_años") is not None else None,
            bool(rule.get("activo", True)),
            _day(rule.get("valido_desde")),
            _day(rule.get("valido_hasta")),
        )
        for rule in document.get("reglas_contrato", ())
    ]
    excluded = document.get("contratos_excluidos", ())

    def without(key: str) -> tuple[str, ...]:
        return tuple(e["modalidad"] for e in excluded if not e.get(key, True))

    rules = FlagRules(tuple(ages), tuple(contracts), without("aplica_alertas_edad"), without("aplica_alertas_contrato"))
    return _checked(rules)


def rules_from_table(contracts: DataFrame, base: FlagRules = DEFAULT) -> FlagRules:
    """``base`` with the contract rules of a table.

    The table has ``modalidad, columna, desde`` and optionally ``hasta, activo, valido_desde, valido_hasta``.
    """
    found = contracts.limit(MAX_RULES + 1).collect()
    rules = []
    for r in (row.asDict() for row in found):
        rules.append(
            ContractFlag(
                r["modalidad"], r["columna"], float(r["desde"]), None if r.get("hasta") is None else float(r["hasta"]),
                r.get("activo") is not False, _day(r.get("valido_desde")), _day(r.get("valido_hasta")),
            )
        )
    order = sorted(rules, key=lambda r: (r.column, r.modality, r.from_years, str(r.valid_from)))
    return _checked(FlagRules(base.ages, tuple(order), base.without_age, base.without_contract))


def _day(value: Any) -> date | None:
    return date.fromisoformat(value) if isinstance(value, str) else value


def _checked(rules: FlagRules) -> FlagRules:
    if len(rules.contracts) + len(rules.ages) > MAX_RULES:
        raise FlagRuleError(f"more than {MAX_RULES} rules")
    names = rules.age_columns
    if len(set(names)) < len(names) or set(names) & set(rules.contract_columns):
        raise FlagRuleError("a result column has two meanings")
    for r in rules.contracts:
        if r.until_years is not None and r.until_years <= r.from_years:
            raise FlagRuleError(f"a rule of {r.column} ends before it begins")
    return rules


# ---- columns -----------------------------------------------------------------------------------


def age_columns(rules: FlagRules, birth: Column, modality: Column, as_of: Column) -> dict[str, Column]:
    """Per active age rule two flags; an unknown birth gives null, an excluded contract type false."""
    found = {}
    for rule in rules.ages:
        if rule.active:
            reached = F.year(birth) == F.year(as_of) - F.lit(rule.age)
            next_year = F.year(birth) == F.year(as_of) + F.lit(1 - rule.age)
            found |= {rule.this_year: reached, rule.next_year: next_year}
    return {name: _unless(flag, modality, rules.without_age) for name, flag in found.items()}


def contract_columns(rules: FlagRules, modality: Column, years: Column, as_of: Column) -> dict[str, Column]:
    """Per result column, whether any active rule for the row's contract type holds on the day."""
    found = {}
    for name in rules.contract_columns:
        tests = [_holds(r, modality, years, as_of) for r in rules.contracts if r.active and r.column == name]
        found[name] = _unless(reduce(or_, tests), modality, rules.without_contract)
    return found


def _holds(rule: ContractFlag, modality: Column, years: Column, as_of: Column) -> Column:
    test = (modality == F.lit(rule.modality)) & (years >= F.lit(rule.from_years))
    if rule.until_years is not None:
        test = test & (years < F.lit(rule.until_years))
    if rule.valid_from is not None:
        test = test & (as_of >= F.lit(rule.valid_from))
    if rule.valid_to is not None:
        test = test & (as_of <= F.lit(rule.valid_to))
    return test


def _unless(flag: Column, modality: Column, excluded: Sequence[str]) -> Column:
    return F.when(modality.isin(*excluded), F.lit(False)).otherwise(flag) if excluded else flag
