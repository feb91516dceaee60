"""Column roles and parameters.

Every operator takes column names as parameters; ``Roles`` bundles the seven role
lists of a subject table so composite plans can be written once.  ``EMPLOYEE`` is the
preset for the classic employee-attrition layout.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Roles:
    target: str | None
    key: str | None
    numerical: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    # column -> ordered levels; encoded as position 0..k-1, unknown -> -1
    ordinal: dict[str, tuple[str, ...]] = field(default_factory=dict)
    onehot: tuple[str, ...] = ()
    outlier: tuple[str, ...] = ()
    engineered: tuple[str, ...] = ()
    drop: tuple[str, ...] = ()
    # integer code -> label maps applied while cleaning (C4)
    code_labels: dict[str, dict[int, str]] = field(default_factory=dict)
    # columns cast to string while cleaning
    as_string: tuple[str, ...] = ()
    # raw target value -> 0/1 (C2); anything else -> null
    target_map: dict[str, int] = field(default_factory=dict)

    @property
    def scaled(self) -> tuple[str, ...]:
        return tuple(self.numerical) + tuple(self.engineered)

    @property
    def required(self) -> tuple[str, ...]:
        cols = tuple(self.numerical) + tuple(self.categorical)
        return cols + ((self.target,) if self.target else ())


@dataclass(frozen=True)
class SplitParams:
    test_size: float = 0.20
    seed: int = 42
    stratify: bool = True


@dataclass(frozen=True)
class SmoteParams:
    enabled: bool = True
    seed: int = 42
    k_neighbors: int = 5


# ---------------------------------------------------------------------------
# Fixed values of the employee-attrition layout.  These must equal the original
# configuration for results to match: role lists, ordinal level order, integer
# code labels, dropped columns, target coding.
# ---------------------------------------------------------------------------
EMPLOYEE_DROP = ("EmployeeNumber", "EmployeeCount", "Over18", "StandardHours")
EMPLOYEE_NUMERICAL = (
    "Age", "DailyRate", "DistanceFromHome", "HourlyRate", "MonthlyIncome", "MonthlyRate",
    "NumCompaniesWorked", "PercentSalaryHike", "TotalWorkingYears", "TrainingTimesLastYear",
    "YearsAtCompany", "YearsInCurrentRole", "YearsSinceLastPromotion", "YearsWithCurrManager",
)
EMPLOYEE_CATEGORICAL = (
    "BusinessTravel", "Department", "EducationField", "Gender", "JobRole", "MaritalStatus", "OverTime",
)
EMPLOYEE_ORDINAL = {
    "Education": ("Below College", "College", "Bachelor", "Master", "Doctor"),
    "EnvironmentSatisfaction": ("Low", "Medium", "High", "Very High"),
    "JobInvolvement": ("Low", "Medium", "High", "Very High"),
    "JobLevel": ("1", "2", "3", "4", "5"),
    "JobSatisfaction": ("Low", "Medium", "High", "Very High"),
    "PerformanceRating": ("Low", "Good", "Excellent", "Outstanding"),
    "RelationshipSatisfaction": ("Low", "Medium", "High", "Very High"),
    "StockOptionLevel": ("0", "1", "2", "3"),
    "WorkLifeBalance": ("Bad", "Good", "Better", "Best"),
}
EMPLOYEE_CODE_LABELS = {
    "Education": {1: "Below College", 2: "College", 3: "Bachelor", 4: "Master", 5: "Doctor"},
    "EnvironmentSatisfaction": {1: "Low", 2: "Medium", 3: "High", 4: "Very High"},
    "JobInvolvement": {1: "Low", 2: "Medium", 3: "High", 4: "Very High"},
    "JobSatisfaction": {1: "Low", 2: "Medium", 3: "High", 4: "Very High"},
    "PerformanceRating": {1: "Low", 2: "Good", 3: "Excellent", 4: "Outstanding"},
    "RelationshipSatisfaction": {1: "Low", 2: "Medium", 3: "High", 4: "Very High"},
    "WorkLifeBalance": {1: "Bad", 2: "Good", 3: "Better", 4: "Best"},
}
EMPLOYEE_OUTLIER = ("MonthlyIncome", "TotalWorkingYears", "YearsAtCompany", "DistanceFromHome")
EMPLOYEE_ENGINEERED = (
    "IncomePerYear", "SatisfactionScore", "LoyaltyIndex", "WorkloadScore", "CareerGrowthRate",
    "OverTimeRisk", "TenureStabilityIndex", "OverTimeXSatisfaction", "StagnationRisk",
    "IncomeVsExperience", "DistanceXOverTime",
)
# satisfaction vocabulary -> score (two scales merged) and involvement -> score
SATISFACTION_SCORES = {"Low": 1, "Medium": 2, "High": 3, "Very High": 4, "Bad": 1, "Good": 2, "Better": 3, "Best": 4}
INVOLVEMENT_SCORES = {"Low": 1, "Medium": 2, "High": 3, "Very High": 4}
# the fields a partial record carries when scoring one person
ASKED_NUMERICAL = ("Age", "MonthlyIncome", "YearsAtCompany")
ASKED_CATEGORICAL = ("Department", "JobRole", "MaritalStatus", "OverTime")
MODEL_DISPLAY = {
    "logistic_regression": "Logistic Regression",
    "random_forest": "Random Forest",
    "gbt": "GBT",
}
# Verdict given before the winner is known (the winner's row is overwritten).
MODEL_VERDICT = {"Logistic Regression": "Baseline", "Random Forest": "Compare", "GBT": "Compare"}
# end of fixed values

EMPLOYEE = Roles(
    target="Attrition",
    key="EmployeeNumber",
    numerical=EMPLOYEE_NUMERICAL,
    categorical=EMPLOYEE_CATEGORICAL,
    ordinal=EMPLOYEE_ORDINAL,
    onehot=EMPLOYEE_CATEGORICAL,
    outlier=EMPLOYEE_OUTLIER,
    engineered=EMPLOYEE_ENGINEERED,
    drop=EMPLOYEE_DROP,
    code_labels=EMPLOYEE_CODE_LABELS,
    as_string=("JobLevel", "StockOptionLevel"),
    target_map={"Yes": 1, "No": 0},
)
