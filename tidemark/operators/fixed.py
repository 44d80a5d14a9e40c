"""Fixed values of the classification: they must read exactly so for equal results."""

import datetime as dt

# Kinds of record class.
INPATIENT = "I"
NONPATIENT = "N"

# Class labels, in the order of the rules that give them.
OUT_NO_CHARGES = "Outpatient Without Charges"
NONPATIENT_CASES = "Nonpatient Cases"
OUT_SURGERY = "Outpatient Surgery"
OUT_SERIES = "Outpatient Series"
OUT_EMERGENCY = "Outpatient Emergency Services"
OUT_OTHER = "Outpatient Other"
IN_NORMAL_NEWBORN = "Inpatient Normal Newborn"
IN_NO_CHARGES = "Inpatient Without Charges"
IN_JOINT_VENTURE = "Inpatient Joint Venture"
IN_LONG_TERM = "Inpatient Long Term Care"
IN_RESPITE = "Inpatient Respite and Trans"
IN_BEHAVIORAL = "Inpatient Behavioral Medicine"
IN_REHAB = "Inpatient Rehab"
IN_SKILLED_NURSING = "Inpatient Skilled Nursing"
IN_HEAD_PAIN = "Inpatient Acute Head Pain"
IN_ACUTE = "Inpatient Acute"
IN_UNDEFINED = "Inpatient Undefined"
OUT_UNDEFINED = "Outpatient Undefined"
EXCLUDED = "Exclude From Reports"
LEGACY = "LEGACY CONVERSION"
OTHERS = "Undefined Others"

# Group codes the maps give.
G_SURGERY = "SURGERY"
G_ER_VISIT = "ER VISIT"
G_EMERGENCY = "EMERGENCY"
G_REHAB = "INPATIENT REHAB"
G_OUT_BEHAVIORAL = "OUTPATIENT BEHAVIORAL MEDICINE"
G_BEHAVIORAL_LOCATION = "BEHAVIORAL SERVICES - OTHER"
G_COVID = "COVID 19"
G_COVID_TEST = "COVID 19 TEST"
G_COVID_ANY = "COVID%"
G_NONPATIENT = "NONPATIENT"
G_SKILLED_NURSING = "SKILLED NURSING"
G_DELIVERY = "DELIVERY"
G_SERIES = "SERIES"
G_URGENT_CARE = "URGENT CARE"
G_NEWBORN = "NEWBORN"
G_ACUTE = "INPATIENT ACUTE"
G_NORMAL_NEWBORN = "NORMAL NEWBORN"
G_UNCODED = "UNCODED"
G_JOINT_VENTURE = "JOINT VENTURE"
G_LONG_TERM = "LONG TERM CARE"
G_RESPITE = "RESPITE AND TRANSITION CARE"
G_BEHAVIORAL = "BEHAVIORAL HEALTH"
G_HEAD_PAIN = "ACUTE HEAD PAIN"
G_EXCLUDE = "EXCLUDE FROM REPORTS"
T_LEGACY = "LEGACY CONVERSION|GRP|SubCategory"

# Families of the group map.
F_CHARGE = "ChargeCdGroup"
F_DEPARTMENT = "ChargeDepartmentGroup"
F_SERVICE = "ServiceLineDRG"
F_TYPE = "PatientTypeGroup"

# Patterns, names, numbers and dates in the rules.
PAYER_PATTERN = "VITA%"
TYPE_SOURCE = "HI"
ORG_PATTERN = "750|%"
TERM_DELIMITER = "|"
TEST_FAMILY_NAMES = ("Test Patient", "TEST", "Zztest", "TESTPRODUCTION", "Zztower")
TEST_NAME_PATTERN = "%HNAM%TEST%"
GIVEN_NAME = "GVN_NM"
EXCLUDED_AUTHORITY = 69
WORKING_DIAGNOSIS = "W%"
SKILLED_NURSING_AFTER = dt.date(2015, 9, 30)
DIAGNOSES_SINCE = dt.date(2020, 2, 1)
UNKNOWN_DISCHARGE = dt.date(1111, 11, 11)

# Service line names.
L_OUT_NO_CHARGES = "Outpatients Without Charges"
L_NEWBORN_GROUP = "Neonatology/Normal Newborn"
L_NEWBORN = "Normal Newborn"
L_UNCODED = "Uncoded"
L_UNGROUPABLE = "Ungroupable"
L_NO_PROCEDURE = "No Procedure"
L_DELIMITER = ":"
