"""Unit systems for the production queries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from wellspark.functions.columns import days_in_month

# Barrels per m3 of oil; standard cubic feet per thousand m3 of gas
# (the source's "Mm3" is a thousand, not a million).
BARRELS_PER_M3 = 6.2898
SCF_PER_THOUSAND_M3 = 35_314.7


@dataclass(frozen=True)
class Units:
    """Names and factors of one unit system. ``per_day`` turns monthly volumes into rates."""

    name: str
    oil_factor: float
    gas_factor: float
    per_day: bool
    oil_column: str
    gas_column: str
    oil_total_column: str
    gas_total_column: str
    oil_scale: float
    gas_scale: float

    def _volume(self, total: Column, month: Column, factor: float) -> Column:
        value = total.cast("double")
        if factor != 1.0:
            value = value * F.lit(factor)
        return value / days_in_month(month) if self.per_day else value

    def oil(self, total: Column, month: Column) -> Column:
        return self._volume(total, month, self.oil_factor)

    def gas(self, total: Column, month: Column) -> Column:
        return self._volume(total, month, self.gas_factor)

    def oil_total(self, total: Column) -> Column:
        return total.cast("double") * F.lit(self.oil_factor)

    def gas_total(self, total: Column) -> Column:
        return total.cast("double") * F.lit(self.gas_factor)


SI = Units("si", 1.0, 1.0, False, "prod_pet_m3", "prod_gas_mm3",
           "prod_pet_m3_total", "prod_gas_mm3_total", 1e6, 1e6)
IMPERIAL = Units("imperial", BARRELS_PER_M3, SCF_PER_THOUSAND_M3, True, "oil_bbl_per_day",
                 "gas_scf_per_day", "oil_bbl_total", "gas_scf_total", 1e6, 1e9)


def units(name: str) -> Units:
    for known in (SI, IMPERIAL):
        if known.name == name:
            return known
    raise ValueError(f"unknown unit system {name!r}: use 'si' or 'imperial'")
