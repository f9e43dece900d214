"""Fixed values of the people domain: names, labels, cuts, vocabularies.

Everything here must equal the published definitions for results to match.
Operators never import this module; the plans pass these values to them.
"""

from __future__ import annotations

from tenura.functions.encode import Band

# --- fixed values: raw people table ----------------------------------------
RAW_SCHEMA = """
    Age INT, Attrition STRING, BusinessTravel STRING, DailyRate INT, Department STRING,
    DistanceFromHome INT, Education INT, EducationField STRING, EmployeeCount INT,
    EmployeeNumber BIGINT, EnvironmentSatisfaction INT, Gender STRING, HourlyRate INT,
    JobInvolvement INT, JobLevel INT, JobRole STRING, JobSatisfaction INT,
    MaritalStatus STRING, MonthlyIncome INT, MonthlyRate INT, NumCompaniesWorked INT,
    Over18 STRING, OverTime STRING, PercentSalaryHike INT, PerformanceRating INT,
    RelationshipSatisfaction INT, StandardHours INT, StockOptionLevel INT,
    TotalWorkingYears INT, TrainingTimesLastYear INT, WorkLifeBalance INT,
    YearsAtCompany INT, YearsInCurrentRole INT, YearsSinceLastPromotion INT,
    YearsWithCurrManager INT
"""
RAW_COLUMNS = [part.split()[0] for part in RAW_SCHEMA.split(",")]

CONSTANT_COLUMNS = ["EmployeeCount", "Over18", "StandardHours"]
ID_COLUMN = "EmployeeNumber"
TARGET = "Attrition"

# raw name -> clean name, for the columns kept as they are
RENAMES = {
    "Age": "age",
    "MaritalStatus": "marital_status",
    "DistanceFromHome": "distance_from_home",
    "Department": "department",
    "JobRole": "job_role",
    "JobLevel": "job_level",
    "BusinessTravel": "business_travel",
    "Education": "education",
    "EducationField": "education_field",
    "MonthlyIncome": "monthly_income",
    "MonthlyRate": "monthly_rate",
    "DailyRate": "daily_rate",
    "HourlyRate": "hourly_rate",
    "PercentSalaryHike": "percent_salary_hike",
    "StockOptionLevel": "stock_option_level",
    "TotalWorkingYears": "total_working_years",
    "YearsAtCompany": "years_at_company",
    "YearsInCurrentRole": "years_in_current_role",
    "YearsSinceLastPromotion": "years_since_last_promotion",
    "YearsWithCurrManager": "years_with_curr_manager",
    "NumCompaniesWorked": "num_companies_worked",
    "EnvironmentSatisfaction": "environment_satisfaction",
    "JobSatisfaction": "job_satisfaction",
    "RelationshipSatisfaction": "relationship_satisfaction",
    "WorkLifeBalance": "work_life_balance",
    "JobInvolvement": "job_involvement",
    "PerformanceRating": "performance_rating",
    "TrainingTimesLastYear": "training_times_last_year",
}

# clean flag -> (raw column, value that means 1)
FLAGS = {
    "attrition": ("Attrition", "Yes"),
    "gender": ("Gender", "Male"),
    "overtime": ("OverTime", "Yes"),
}

TRAVEL_ORDER = {"Non-Travel": 0, "Travel_Rarely": 1, "Travel_Frequently": 2}

# --- fixed values: clean table, in order ------------------------------------
CLEAN_COLUMNS = [
    "attrition", "age", "gender", "marital_status", "distance_from_home",
    "department", "job_role", "job_level", "overtime", "business_travel_encoded",
    "business_travel", "education", "education_field", "monthly_income",
    "monthly_rate", "daily_rate", "hourly_rate", "percent_salary_hike",
    "stock_option_level", "total_working_years", "years_at_company",
    "years_in_current_role", "years_since_last_promotion", "years_with_curr_manager",
    "num_companies_worked", "environment_satisfaction", "job_satisfaction",
    "relationship_satisfaction", "work_life_balance", "job_involvement",
    "performance_rating", "training_times_last_year",
]
KEY = "employee_number"

# --- fixed values: bands and labels -----------------------------------------
AGE_BAND = Band([25, 35, 45, 55], ["Under 25", "25-34", "35-44", "45-54", "55+"], closed="left")
INCOME_CUTS = [2911, 4919, 8379]
INCOME_BAND = Band(
    INCOME_CUTS,
    ["Q1 (≤2,911)", "Q2 (2,912-4,919)", "Q3 (4,920-8,379)", "Q4 (>8,379)"],
    closed="right",
)
INCOME_BAND_NAMED = Band(
    INCOME_CUTS,
    ["Q1 (Low)", "Q2 (Medium-Low)", "Q3 (Medium-High)", "Q4 (High)"],
    closed="right",
)
TENURE_BAND_4 = Band(
    [2, 5, 10], ["0-2 years", "3-5 years", "6-10 years", "10+ years"], closed="right"
)
TENURE_BAND_5 = Band(
    [1, 3, 6, 11],
    ["Less than 1 year", "1-2 years", "3-5 years", "6-10 years", "10+ years"],
    closed="left",
)
DISTANCE_BAND = Band(
    [5, 11, 21],
    ["Very Close (<5 mi)", "Close (5-10 mi)", "Moderate (11-20 mi)", "Far (20+ mi)"],
    closed="left",
)
RISK_TIER = Band([0.30, 0.60], ["Low", "Medium", "High"], closed="right")
TIER_ORDER = ["High", "Medium", "Low"]

EDUCATION_LABELS = {1: "Below College", 2: "College", 3: "Bachelor", 4: "Master", 5: "Doctor"}

# --- fixed values: feature table ---------------------------------------------
NUMERIC_FEATURES = [
    "age", "distance_from_home", "education", "job_level", "monthly_income",
    "num_companies_worked", "percent_salary_hike", "stock_option_level",
    "total_working_years", "training_times_last_year", "years_at_company",
    "years_in_current_role", "years_since_last_promotion", "years_with_curr_manager",
    "environment_satisfaction", "job_satisfaction", "job_involvement",
    "performance_rating", "relationship_satisfaction", "work_life_balance",
]
BINARY_FEATURES = ["gender", "overtime", "business_travel_encoded"]

# name -> (numerator, denominator, added to the denominator)
RATIOS = {
    "income_per_year": ("monthly_income", "total_working_years", 1),
    "income_per_age": ("monthly_income", "age", 0),
    "income_per_company_year": ("monthly_income", "years_at_company", 1),
    "promo_stagnation": ("years_since_last_promotion", "years_at_company", 1),
    "role_tenure_ratio": ("years_in_current_role", "years_at_company", 1),
    "manager_stability": ("years_with_curr_manager", "years_at_company", 1),
    "career_ratio": ("total_working_years", "age", 0),
    "company_loyalty_ratio": ("years_at_company", "total_working_years", 1),
}

COMPOSITES = {
    "avg_satisfaction": [
        "environment_satisfaction", "job_satisfaction", "relationship_satisfaction",
    ],
    "overall_wellbeing": [
        "environment_satisfaction", "job_satisfaction", "relationship_satisfaction",
        "work_life_balance",
    ],
}

# name -> (column, comparison, bound)
THRESHOLD_FLAGS = {
    "is_early_career": ("total_working_years", "<=", 3),
    "is_new_hire": ("years_at_company", "<=", 2),
    "long_time_since_promo": ("years_since_last_promotion", ">=", 5),
    "is_young_employee": ("age", "<=", 30),
    "is_entry_level": ("job_level", "=", 1),
    "no_stock_options": ("stock_option_level", "=", 0),
    "low_env_satisfaction": ("environment_satisfaction", "<=", 2),
    "low_job_satisfaction": ("job_satisfaction", "<=", 2),
    "poor_work_life_balance": ("work_life_balance", "<=", 2),
}

# name -> factors; a factor is a column, or (column, value) for its indicator
INTERACTIONS = {
    "overtime_sales_rep": ["overtime", ("job_role", "Sales Representative")],
    "overtime_single": ["overtime", ("marital_status", "Single")],
    "entry_no_equity": [("job_level", 1), ("stock_option_level", 0)],
    "distance_overtime_interaction": ["distance_from_home", "overtime"],
}

DEPARTMENT_CONTEXT = {
    "dept_avg_income": "monthly_income",
    "dept_avg_age": "age",
    "dept_avg_experience": "total_working_years",
    "dept_overtime_rate": "overtime",
}
DEPARTMENT_HEADCOUNT = "dept_headcount"
ROLE_CONTEXT = {
    "role_avg_income": "monthly_income",
    "role_avg_experience": "total_working_years",
}
ROLE_HEADCOUNT = "role_headcount"
RELATIVES = {
    "income_vs_dept_avg": ("monthly_income", "dept_avg_income"),
    "age_vs_dept_avg": ("age", "dept_avg_age"),
}
CONTEXT_FEATURES = [
    "dept_avg_income", "dept_avg_age", "dept_avg_experience", "dept_headcount",
    "dept_overtime_rate", "role_avg_income", "role_avg_experience", "role_headcount",
    "income_vs_dept_avg", "age_vs_dept_avg",
]

# column -> indicator name -> value
ONE_HOT = {
    "department": {
        "dept_sales": "Sales",
        "dept_research_dev": "Research & Development",
        "dept_hr": "Human Resources",
    },
    "job_role": {
        "role_sales_executive": "Sales Executive",
        "role_research_scientist": "Research Scientist",
        "role_lab_technician": "Laboratory Technician",
        "role_manufacturing_director": "Manufacturing Director",
        "role_healthcare_rep": "Healthcare Representative",
        "role_manager": "Manager",
        "role_sales_rep": "Sales Representative",
        "role_research_director": "Research Director",
        "role_hr": "Human Resources",
    },
    "marital_status": {
        "marital_single": "Single",
        "marital_married": "Married",
        "marital_divorced": "Divorced",
    },
    "education_field": {
        "edu_life_sciences": "Life Sciences",
        "edu_medical": "Medical",
        "edu_marketing": "Marketing",
        "edu_technical": "Technical Degree",
        "edu_other": "Other",
        "edu_hr": "Human Resources",
    },
}
# label when no indicator is set
DECODE_DEFAULTS = {
    "department": "Human Resources",
    "job_role": "Unknown",
    "marital_status": "Divorced",
}

FEATURE_COLUMNS = [
    *NUMERIC_FEATURES,
    *BINARY_FEATURES,
    *RATIOS,
    *COMPOSITES,
    *THRESHOLD_FLAGS,
    *INTERACTIONS,
    *CONTEXT_FEATURES,
    *(name for names in ONE_HOT.values() for name in names),
]

# --- fixed values: fact table, in order --------------------------------------
FACT_COLUMNS = [
    "employee_key", "department_key", "job_role_key", "education_field_key",
    "marital_status_key", "business_travel_key",
    "attrition", "attrition_label",
    "age", "age_band", "gender", "gender_label", "distance_from_home",
    "department", "job_role", "job_level", "overtime", "overtime_label",
    "business_travel", "business_travel_encoded",
    "education", "education_label", "education_field",
    "monthly_income", "income_quartile", "monthly_rate", "daily_rate", "hourly_rate",
    "percent_salary_hike", "stock_option_level",
    "total_working_years", "years_at_company", "tenure_band", "years_in_current_role",
    "years_since_last_promotion", "years_with_curr_manager", "num_companies_worked",
    "environment_satisfaction", "job_satisfaction", "relationship_satisfaction",
    "work_life_balance", "job_involvement",
    "performance_rating", "training_times_last_year",
    "income_per_experience_year", "company_loyalty_ratio", "years_before_current_role",
]
FACT_ORDER = ["department", "job_role", "age", "monthly_income"]

# --- fixed values: analytics table --------------------------------------------
OVERALL = ("Overall", "All Employees")
METRIC_AVERAGES = {
    "avg_age": "age",
    "avg_income": "monthly_income",
    "avg_experience": "total_working_years",
    "avg_tenure": "years_at_company",
}

# --- fixed values: predictions table, in order --------------------------------
PREDICTION_COLUMNS = [
    "employee_key", "department_name", "job_role_name", "age", "gender_label",
    "marital_status_name", "distance_from_home", "job_level", "overtime_label",
    "monthly_income", "years_at_company", "total_working_years", "years_in_current_role",
    "years_since_last_promotion", "environment_satisfaction", "job_satisfaction",
    "work_life_balance", "relationship_satisfaction", "attrition", "attrition_label",
    "attrition_probability", "predicted_attrition", "risk_tier",
]
PREDICTION_ORDER = ["department_name", "job_role_name", "age", "monthly_income"]

# --- fixed values: exploratory column sets and thresholds ----------------------
NUMERIC_EXCLUDED = ["EmployeeCount", "StandardHours", "EmployeeNumber", "Attrition_Flag"]
CATEGORICAL_EXCLUDED = ["Attrition", "Over18"]
ORDINAL_COLUMNS = [
    "Education", "EnvironmentSatisfaction", "JobInvolvement", "JobSatisfaction",
    "RelationshipSatisfaction", "WorkLifeBalance", "PerformanceRating", "StockOptionLevel",
]
TENURE_COLUMNS = [
    "YearsAtCompany", "YearsInCurrentRole", "YearsSinceLastPromotion",
    "YearsWithCurrManager", "TotalWorkingYears",
]
NEAR_CONSTANT_SHARE = 0.01
SIGNIFICANCE = 0.05
HIGH_CORRELATION = 0.7
DROP_CORRELATION = 0.9
WEAK_CORRELATION = 0.03
STRONG_CORRELATION = 0.1
AUC_SIGNAL = 0.60
AUC_NO_SIGNAL = 0.55
AUC_LEAKAGE = 0.95
