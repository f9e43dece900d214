"""A people table derived from ``orders`` by integer arithmetic.

The raw HR file is not shipped; this view has its columns, types and domains and
grows with ``orders``, so every operator can run at any scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: (modulus, square factor, linear factor, offset) of the five hashes
_HASHES = {
    "h1": (1000003, 7919, 104729, 13),
    "h2": (1000033, 6151, 15487, 29),
    "h3": (1000037, 4421, 32452, 53),
    "h4": (1000039, 9901, 49979, 71),
    "h5": (1000081, 3571, 86028, 97),
}


def _hash(modulus: int, square: int, linear: int, offset: int):
    # reducing the key first gives the same residue and cannot overflow
    k = F.col("k") % modulus
    return (k * k * square + k * linear + offset) % modulus


def people(orders: DataFrame) -> DataFrame:
    """One raw person per order, 35 columns."""
    hashed = orders.select(F.col("o_orderkey").alias("k")).select(
        "k", *[_hash(*numbers).alias(name) for name, numbers in _HASHES.items()]
    )
    # fixed values: domains and mixing rules
    drawn = hashed.selectExpr(
        "*",
        """CASE h1 % 9 WHEN 0 THEN 'Sales Executive' WHEN 1 THEN 'Research Scientist'
             WHEN 2 THEN 'Laboratory Technician' WHEN 3 THEN 'Manufacturing Director'
             WHEN 4 THEN 'Healthcare Representative' WHEN 5 THEN 'Manager'
             WHEN 6 THEN 'Sales Representative' WHEN 7 THEN 'Research Director'
             ELSE 'Human Resources' END AS JobRole""",
        """CASE WHEN h1 % 9 IN (0, 6) THEN 'Sales' WHEN h1 % 9 = 8 THEN 'Human Resources'
             WHEN h1 % 9 = 5 AND h2 % 3 = 0 THEN 'Sales'
             WHEN h1 % 9 = 5 AND h2 % 3 = 1 THEN 'Human Resources'
             ELSE 'Research & Development' END AS Department""",
        "CAST(1 + h2 % 5 AS INT) AS JobLevel",
        "CASE WHEN h3 % 100 < 28 THEN 'Yes' ELSE 'No' END AS OverTime",
        "CASE h4 % 3 WHEN 0 THEN 'Single' WHEN 1 THEN 'Married' ELSE 'Divorced' END AS MaritalStatus",
        "CASE WHEN h5 % 10 < 4 THEN 0 ELSE CAST(1 + h5 % 3 AS INT) END AS StockOptionLevel",
        "CAST(h4 % 41 AS INT) AS TotalWorkingYears",
    ).selectExpr("*", "CAST(h5 % (TotalWorkingYears + 1) AS INT) AS YearsAtCompany")
    return drawn.selectExpr(
        "CAST(LEAST(60, 18 + TotalWorkingYears + h2 % 8) AS INT) AS Age",
        """CASE WHEN (h1 + h2 + h3 + h4 + h5) % 100 <
             6 + CASE WHEN OverTime = 'Yes' THEN 15 ELSE 0 END
               + CASE WHEN JobLevel = 1 THEN 8 ELSE 0 END
               + CASE WHEN StockOptionLevel = 0 THEN 6 ELSE 0 END
               + CASE WHEN MaritalStatus = 'Single' THEN 5 ELSE 0 END
             THEN 'Yes' ELSE 'No' END AS Attrition""",
        """CASE WHEN h2 % 10 < 1 THEN 'Non-Travel' WHEN h2 % 10 < 8 THEN 'Travel_Rarely'
             ELSE 'Travel_Frequently' END AS BusinessTravel""",
        "CAST(100 + h1 % 1400 AS INT) AS DailyRate",
        "Department",
        "CAST(1 + h3 % 29 AS INT) AS DistanceFromHome",
        "CAST(1 + h4 % 5 AS INT) AS Education",
        """CASE h5 % 6 WHEN 0 THEN 'Life Sciences' WHEN 1 THEN 'Medical' WHEN 2 THEN 'Marketing'
             WHEN 3 THEN 'Technical Degree' WHEN 4 THEN 'Other'
             ELSE 'Human Resources' END AS EducationField""",
        "CAST(1 AS INT) AS EmployeeCount",
        "k AS EmployeeNumber",
        "CAST(1 + h1 % 4 AS INT) AS EnvironmentSatisfaction",
        "CASE WHEN h2 % 5 < 3 THEN 'Male' ELSE 'Female' END AS Gender",
        "CAST(30 + h3 % 71 AS INT) AS HourlyRate",
        "CAST(1 + h4 % 4 AS INT) AS JobInvolvement",
        "JobLevel",
        "JobRole",
        "CAST(1 + h5 % 4 AS INT) AS JobSatisfaction",
        "MaritalStatus",
        "CAST(1009 + 1500 * (JobLevel - 1) + h3 % 4000 AS INT) AS MonthlyIncome",
        "CAST(2094 + h1 % 24906 AS INT) AS MonthlyRate",
        "CAST(h2 % 10 AS INT) AS NumCompaniesWorked",
        "'Y' AS Over18",
        "OverTime",
        "CAST(11 + h4 % 15 AS INT) AS PercentSalaryHike",
        "CAST(3 + CASE WHEN h4 % 15 > 8 THEN 1 ELSE 0 END AS INT) AS PerformanceRating",
        "CAST(1 + (h1 + h3) % 4 AS INT) AS RelationshipSatisfaction",
        "CAST(80 AS INT) AS StandardHours",
        "StockOptionLevel",
        "TotalWorkingYears",
        "CAST(h1 % 7 AS INT) AS TrainingTimesLastYear",
        "CAST(1 + (h2 + h4) % 4 AS INT) AS WorkLifeBalance",
        "YearsAtCompany",
        "CAST(h1 % (YearsAtCompany + 1) AS INT) AS YearsInCurrentRole",
        "CAST(h2 % (YearsAtCompany + 1) AS INT) AS YearsSinceLastPromotion",
        "CAST(h3 % (YearsAtCompany + 1) AS INT) AS YearsWithCurrManager",
    )
