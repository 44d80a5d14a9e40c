"""Declared table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "smallint": T.ShortType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "decimal(19,3)": T.DecimalType(19, 3),
    "decimal(20,2)": T.DecimalType(20, 2),
}


def _schema(*columns: str) -> T.StructType:
    """Columns given as ``name type``, with a trailing ``!`` where NULL is not allowed."""
    fields = []
    for column in columns:
        name, kind = column.rsplit(" ", 1)
        fields.append(T.StructField(name, _TYPES[kind.rstrip("!")], not kind.endswith("!")))
    return T.StructType(fields)


# Columns of the type-2 target, in table order.
TARGET_TEXT_COLUMNS = (
    "Survey_Designator",
    "Client_ID",
    "Hosp_Service_Code",
    "Medical_Rec_No",
    "Claim_Id",
    "Race",
    "Carrier",
    "DOB",
    "Gender",
    "Last_Name",
    "First_Name",
    "Middle_Name",
    "Address1",
    "Address2",
    "City",
    "State",
    "Zip",
    "Discharge_Date",
    "Discharge_status_id",
    "Time_of_arrival",
    "Pt_type",
    "Nursing_station",
    "Sub_Group",
    "Minor_pt_type",
    "Attending_Physician",
    "Marital_Status",
    "Patient_Phone_Nbr",
    "Financial_Class",
    "Room",
    "Bed",
    "file_name",
)
TARGET_KEYS = ("Client_ID", "Claim_Id")

TARGET = T.StructType(
    [T.StructField(c, T.StringType()) for c in TARGET_TEXT_COLUMNS]
    + [
        T.StructField("effective_date", T.DateType()),
        T.StructField("termination_date", T.StringType()),
    ]
)

# Counts are long: of the two types in use it is the one that cannot overflow.
CONTROL = _schema(
    "job_start_time timestamp",
    "job_end_time timestamp",
    "source_count bigint",
    "insert_count bigint",
    "update_count bigint",
    "delete_count bigint",
    "no_change_count bigint",
    "source_file string",
)

RECORDS = _schema(
    "tenant string!",
    "record_id bigint!",
    "authority smallint",
    "from_date date",
    "thru_date date",
    "class_code string",
    "type_code string",
    "drg_code string",
    "org1_code string",
    "org3_code string",
    "payer1_code string",
    "payer2_code string",
    "payer3_code string",
    "payer4_code string",
    "discharge_date date",
    "extra_balance_flag string",
)
CHARGES = _schema(
    "tenant string!",
    "record_id bigint!",
    "post_date date",
    "quantity decimal(19,3)",
    "amount decimal(20,2)",
    "item_code string",
    "dept_code string",
    "location_code string",
    "procedure_code string",
)
STAGED_HISTORY = _schema(
    "tenant string",
    "record_id bigint",
    "from_date date",
    "authority smallint",
    "thru_date date",
    "patient_class string",
    "inpatient_covid_flag string",
    "surgery_flag string",
    "emergency_flag string",
    "service_line_3 string",
    "service_line_2 string",
    "service_line_1 string",
    "procedure_category string",
)
HISTORY = _schema(
    "record_id bigint",
    "from_date date",
    "authority smallint",
    "tenant string",
    "job_id bigint",
    "added_at timestamp_ntz",
    "modified_at timestamp_ntz",
    "thru_date date",
    "patient_class string",
    "service_line_1 string",
    "service_line_2 string",
    "service_line_3 string",
    "procedure_category string",
    "inpatient_covid_flag string",
    "emergency_flag string",
    "surgery_flag string",
)
HISTORY_VALUES = (
    "patient_class",
    "service_line_3",
    "service_line_2",
    "service_line_1",
    "procedure_category",
    "inpatient_covid_flag",
    "surgery_flag",
    "emergency_flag",
)
QUEUE = _schema(
    "record_id bigint",
    "authority smallint",
    "tenant string",
    "job_id bigint",
    "added_at timestamp_ntz",
    "modified_at timestamp_ntz",
    "extract_date date",
    "result_date date",
)
TERMS = _schema(
    "source_key string",
    "term_key string",
)
GROUPS = _schema(
    "source_key string",
    "group_code string",
    "family string",
    "start_date date",
    "end_date date",
)
CLASSES = _schema(
    "source_key string",
    "class_kind string",
)
JOB_LOG = _schema(
    "job_id bigint",
    "script string",
    "tenant string",
    "state string",
    "start_date date",
    "logged_at timestamp_ntz",
    "row_count bigint",
    "message string",
)
JOB_STEPS = _schema(
    "job_id bigint",
    "step int",
    "phase string",
    "logged_at timestamp_ntz",
    "row_count bigint",
    "description string",
)
RUNS = _schema(
    "application string!",
    "sub_application_name string!",
    "folder string!",
    "job_member_name string!",
    "order_date timestamp_ntz",
    "start_time timestamp_ntz!",
    "end_time timestamp_ntz",
    "runtime int",
    "run_as_user string",
    "completion_status string",
)
PLACES = _schema(
    "Day string",
    "Location Name string",
    "Address string",
)
