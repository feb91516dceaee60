"""Feature engineering F1-F12: generic column builders plus the employee preset.

All features of a table are added in one ``withColumns`` (one Project, fused into the
scan's whole-stage codegen).  Division is ANSI-safe (``try_divide``): a zero
denominator gives null instead of raising.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.exprs import flag, lookup, ratio_plus_one
from riskframe.spec import INVOLVEMENT_SCORES, SATISFACTION_SCORES


def row_mean_of_levels(df: DataFrame, cols: Sequence[str], mapping: Mapping[str, float],
                       if_none: float = 2.5) -> Column:
    """Row mean over the present ``cols``, skipping nulls; each value is mapped through
    ``mapping``, numeric strings pass through, anything else is null.  No present
    column -> ``if_none``; all values null -> null."""
    present = [c for c in cols if c in df.columns]
    if not present:
        return F.lit(float(if_none))
    vals = [F.coalesce(lookup(F.col(c).cast("string"), dict(mapping)).cast("double"),
                       F.col(c).cast("string").try_cast("double")) for c in present]
    total = sum((F.coalesce(v, F.lit(0.0)) for v in vals[1:]), F.coalesce(vals[0], F.lit(0.0)))
    count = sum((v.isNotNull().cast("int") for v in vals[1:]), vals[0].isNotNull().cast("int"))
    return F.try_divide(total, count.cast("double"))


def times_level(df: DataFrame, num: str, level_col: str, mapping: Mapping[str, float], default: float = 2) -> Column:
    """num x mapping[level_col] (unknown / null / absent column -> ``default``)."""
    if level_col in df.columns:
        lv = F.coalesce(lookup(F.col(level_col).cast("string"), dict(mapping)), F.lit(default))
    else:
        lv = F.lit(default)
    return F.col(num) * lv


def growth_ratio(a: str, b: str) -> Column:
    """(a - b) / (a + 1)."""
    return F.try_divide((F.col(a) - F.col(b)).cast("double"), F.col(a).cast("double") + F.lit(1.0))


def flag_or_zero(df: DataFrame, c: str, value: str) -> Column:
    return flag(c, value) if c in df.columns else F.lit(0)


def flag_times_inverse_level(df: DataFrame, flag_col: str, value: str, level_col: str,
                             mapping: Mapping[str, float], top: float = 5, default: float = 2) -> Column:
    """flag x (top - mapping[level_col]) with unknown/null level -> ``default``;
    either column absent -> 0."""
    if flag_col not in df.columns or level_col not in df.columns:
        return F.lit(0)
    lv = F.coalesce(lookup(F.col(level_col).cast("string"), dict(mapping)), F.lit(default))
    return flag(flag_col, value) * (F.lit(top) - lv)


def flag_times(df: DataFrame, num: str, flag_col: str, value: str) -> Column:
    """num x flag; either column absent -> 0."""
    if num not in df.columns or flag_col not in df.columns:
        return F.lit(0)
    return F.col(num) * flag(flag_col, value)


def add_features(df: DataFrame, features: Mapping[str, Column]) -> DataFrame:
    """add all features in a single projection."""
    return df.withColumns(dict(features))


def employee_features(df: DataFrame) -> dict[str, Column]:
    """F1-F11 for the employee layout (formulas as computed by the original code)."""
    sat_cols = ["JobSatisfaction", "EnvironmentSatisfaction", "RelationshipSatisfaction", "WorkLifeBalance"]
    return {
        "IncomePerYear": ratio_plus_one("MonthlyIncome", "YearsAtCompany"),
        "SatisfactionScore": row_mean_of_levels(df, sat_cols, SATISFACTION_SCORES),
        "LoyaltyIndex": ratio_plus_one("YearsWithCurrManager", "TotalWorkingYears"),
        "WorkloadScore": times_level(df, "TrainingTimesLastYear", "JobInvolvement", INVOLVEMENT_SCORES),
        "CareerGrowthRate": growth_ratio("YearsAtCompany", "YearsSinceLastPromotion"),
        "OverTimeRisk": flag_or_zero(df, "OverTime", "Yes"),
        "TenureStabilityIndex": ratio_plus_one("TotalWorkingYears", "NumCompaniesWorked"),
        "OverTimeXSatisfaction": flag_times_inverse_level(df, "OverTime", "Yes", "JobSatisfaction", SATISFACTION_SCORES),
        "StagnationRisk": ratio_plus_one("YearsSinceLastPromotion", "YearsAtCompany"),
        "IncomeVsExperience": ratio_plus_one("MonthlyIncome", "TotalWorkingYears"),
        "DistanceXOverTime": flag_times(df, "DistanceFromHome", "OverTime", "Yes"),
    }


def engineer_employee(df: DataFrame) -> DataFrame:
    return add_features(df, employee_features(df))
