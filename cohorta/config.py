"""Column roles of the hospital tables. One place for every list the jobs share."""

# The item ids of the five vital signs.
VITAL_ITEMS = [220045, 220210, 220277, 220048, 211]
TOP_LAB_ITEMS = 5

STAY_KEYS = ["subject_id", "hadm_id", "icustay_id"]
ADMISSION_KEYS = ["subject_id", "hadm_id"]
LABEL = "hospital_expire_flag"

VITALS = ["mean_vitals", "min_vitals", "max_vitals"]
LABS = ["mean_labs", "min_labs", "max_labs"]
CONTINUOUS = ["los", "age", *VITALS, *LABS]
COUNTS = ["num_comorbidities"]
NUMERIC = CONTINUOUS + COUNTS

# The categorical text columns of the merged table.
CATEGORICAL = [
    "admission_type", "admission_location", "discharge_location", "insurance", "language",
    "religion", "marital_status", "ethnicity", "diagnosis", "gender", "dbsource",
    "first_careunit", "last_careunit",
]

# The columns that get a log(1+x) twin in each step.
LOG_ENGINEERED = ["los", "age", "max_vitals", "min_labs"]
LOG_SCALED = ["los", "age", "min_vitals", "max_vitals", "mean_vitals", "min_labs"]

VIF_FEATURES = ["log_los", "log_age", "mean_vitals", "min_vitals", "log_max_vitals",
                "mean_labs", "log_min_labs", "max_labs", "num_comorbidities"]
SCALED_FEATURES = ["log_los", "log_age", "log_mean_vitals", "log_min_vitals", "log_max_vitals",
                   "mean_labs", "log_min_labs", "max_labs", "num_comorbidities"]
MODEL_FEATURES = ["log_los", "log_age", "log_min_vitals", "log_max_vitals",
                  "mean_labs", "log_min_labs", "max_labs", "num_comorbidities"]

UPSAMPLED_ROWS = 5000
SAMPLED_ROWS = 2500
SEED = 42
