import pytest

from riskframe.operators import features

BASE = dict(MonthlyIncome=6000, YearsAtCompany=5, YearsSinceLastPromotion=2, YearsWithCurrManager=2, TotalWorkingYears=9,
            NumCompaniesWorked=2, TrainingTimesLastYear=3, DistanceFromHome=10, OverTime="Yes", JobSatisfaction="Medium",
            EnvironmentSatisfaction="High", RelationshipSatisfaction="Very High", WorkLifeBalance="Better",
            JobInvolvement="High")
SCHEMA = ("MonthlyIncome int, YearsAtCompany int, YearsSinceLastPromotion int, YearsWithCurrManager int, "
          "TotalWorkingYears int, NumCompaniesWorked int, TrainingTimesLastYear int, DistanceFromHome int, "
          "OverTime string, JobSatisfaction string, EnvironmentSatisfaction string, RelationshipSatisfaction string, "
          "WorkLifeBalance string, JobInvolvement string")


def _row(spark, **over):
    d = dict(BASE, **over)
    df = spark.createDataFrame([tuple(d[k] for k in BASE)], SCHEMA)
    return features.engineer_employee(df).first()


def test_golden_row(spark):
    r = _row(spark)
    assert r.IncomePerYear == 1000 and r.SatisfactionScore == 3.0 and r.LoyaltyIndex == pytest.approx(0.2)
    assert r.WorkloadScore == 9 and r.CareerGrowthRate == 0.5 and r.OverTimeRisk == 1
    assert r.TenureStabilityIndex == 3.0 and r.OverTimeXSatisfaction == 3
    assert r.StagnationRisk == pytest.approx(1 / 3) and r.IncomeVsExperience == 600 and r.DistanceXOverTime == 10


def test_golden_nulls(spark):
    r = _row(spark, OverTime="No", JobSatisfaction=None, JobInvolvement=None)
    assert r.SatisfactionScore == pytest.approx(10 / 3) and r.WorkloadScore == 6
    assert (r.OverTimeRisk, r.OverTimeXSatisfaction, r.DistanceXOverTime) == (0, 0, 0)
    r2 = _row(spark, JobSatisfaction=None)
    assert r2.OverTimeXSatisfaction == 3


def test_absent_columns(spark):
    df = spark.createDataFrame([(6000, 5, 9, 2, 3, 2, 2)],
                               "MonthlyIncome int, YearsAtCompany int, TotalWorkingYears int, NumCompaniesWorked int, "
                               "TrainingTimesLastYear int, YearsSinceLastPromotion int, YearsWithCurrManager int")
    r = features.engineer_employee(df).first()
    assert r.SatisfactionScore == 2.5 and r.WorkloadScore == 6 and r.OverTimeRisk == 0 and r.DistanceXOverTime == 0


def test_zero_denominator_is_null(spark):
    r = _row(spark, YearsAtCompany=-1)
    assert r.IncomePerYear is None
