"""Accepted spellings, labels, bounds and thresholds."""

# Sex spellings (after trimming and upper-casing).
SEX = {
    "Female": ["F", "FEMAL", "FEMALE"],
    "Male": ["M", "MALE"],
}

# Age bands, upper bounds included.
AGE_BAND = ([-1, 49, 59, 69, 79],
            ["Age below zero", "0-49", "50-59", "60-69", "70-79", "80+"])
AGE_BAND_FIVE = ([-1, 49, 54, 59, 64, 69, 74, 79],
                 ["Age below zero", "0-49", "50-54", "55-59", "60-64", "65-69", "70-74", "75-79", "80+"])
AGE_BAND_EVAL = ([-1, 54, 64, 74, 75],
                 ["Age below zero", "Other", "55-64", "65-74", "75", "Other"])
AGE_VALID = (55, 74)

# Levels of the demographic attributes.
MARITAL_STATUS = ["Single", "Married or civil partner", "Divorced", "Separated", "Widow(er)", "Prefer not to say", "Not known"]
ETHNIC_GROUP = ["Asian or Asian British", "Black or Black British", "Mixed", "Not stated", "Other Ethnic Group", "White"]
RURALITY = {
    "Urban": ["A1", "B1", "C1", "C2"],
    "Rural": ["D1", "D2", "E1", "E2", "F1", "F2"],
}

# Attendance and delivery spellings of a check (upper-cased).
ATTENDANCE = {
    "Attended": ["ATTENDED", "PARTICIPANT ATTENDED LHC", "PATICIPANT_ATTEND_LHC", "SCREENING - HEALTH CHECK (XM1XS)", "FINISHED"],
    "Partially attended": ["PARTICIPANT ATTENDED BUT DID NOT COMPLETE LHC"],
    "DNA": ["DID NOT ATTEND", "DIDNOTATTEND", "PARTICIPANT DID NOT ATTEND LHC", "PATICIPANT_DID_NOT_ATTEND_LHC"],
}
DELIVERY = {
    "F2F": ["F2F", "FACE TO FACE", "IN-PERSON"],
    "Virtual": ["PHONE", "TELEPHONE", "VIRTUAL"],
}

# Invitation outcomes (upper-cased).
INELIGIBLE = [
    "PARTICIPANT DOES NOT MEET AGE CRITERIAA",
    "PARTICIPANT DOES NOT MEET AGE CRITERIA",
    "PARTICIPANT DOES NOT MEET SMOKING CRITERIA",
    "PARTICIPANT REMOVED FROM GP LIST",
    "PARTICIPANT_REMOVED_FROM_GP_LIST",
]
ACCEPTED = ["ACCEPTED", "PARTICIPANT ACCEPTED INVITATION", "PARTICIPANT_ACCEPTED_INVITATION"]

# Invitation outcomes as used for the pathway (case as submitted).
INVITE_OUTCOME = {
    "Accepted": ["Participant accepted invitation", "Participant_accepted_invitation"],
    "Declined": ["Participant declined invitation", "Participant_declined_invitation"],
    "No response": ["Participant did not respond to invitation", "Participant_did_not_respond_to_invitation", "Screeninginvite-notreplied"],
    "Ineligible": ["Participant does not meet age criteria", "Participant does not meet smoking criteria",
                   "Participant removed from GP list", "Participant_Removed_from_GP_List"],
}

# Scan outcomes (upper-cased).
SCAN_OUTCOME = {
    "LDCT performed": ["LD CT SCAN PERFORMED", "LDCT _PERFORMED", "LDCT PERFORMED", "LDCT PERFROMED", "LDCT_PERFORMED", "PERFORMED"],
    "LDCT did not attend": ["LDCT DID NOT ATTEND"],
    "LDCT not completed (technical / operational)": [
        "LDCT NOT COMPLETED (TECHNICAL/OPERATIONA",
        "LDCT NOT COMPLETED (TECHNICAL/OPERATIONAL)",
        "LDCT NOT COMPLETED(TECHNICAL/OPERATIONAL)",
    ],
    "LDCT not completed (participant unwell)": ["LDCT NOT COMPLETED (PARTICIPANT UNWELL)"],
    "LDCT not completed (participant abandoned)": [
        "LDCT NOT COMPLETED (PARTICIPANT ABANDONE",
        "LDCT NOT COMPLETED (PARTICIPANT ABANDONED)",
        "LDCT NOT COMPLETED(PARTICIPANT ABANDONED)",
    ],
    "LDCT not completed (no reason recorded)": ["LDCT NOT COMPLETED"],
}
PERFORMED = "LDCT performed"
MISSED_SCAN = "LDCT did not attend"

# Risk thresholds and spellings of a missing exclusion reason.
PLCO_HIGH = 1.51
LLP_HIGH = 2.5
NO_EXCLUSION = ["     ", "NONE", "NULL"]
EXCLUSION = {
    "Unable to lie flat": ["UNABLE TO LIE DOWN", "UNABLE TO LIE FLAT"],
    "Weight >200Kg": ["WEIGHT >200KG"],
    "Previous CT <12 months ago": ["PREVIOUS CT <12 MONTHS AGO"],
    "Does not have capacity to consent to LDCT": ["DOES NOT HAVE CAPACITY TO CONSENT TO LDCT"],
    "Not physically fit": ["NOT PHYSICALLY FIT"],
    "Participant declined": ["PARTICIPANT DECLINED", "SCREENING DECLINED (XAZ1N)"],
    "Procedure contraindicated": ["PROCEDURE CONTRAINDICATED", "PROCEDURECONTRAINDICATED"],
}
YES_NO = {"NO": ["N", "NO"], "YES": ["Y", "YES"]}

# Accepted terms for findings beside the lungs and in the lungs.
OTHER_FINDINGS = [
    "abdominal aortic aneurysm",
    "adrenal lesions",
    "aortic valve calcification",
    "bone abnormalities",
    "consolidation",
    "coronary calcification",
    "fractures with no trauma history",
    "liver or splenic lesions",
    "mediastinal mass",
    "osteoporosis",
    "other",
    "pleural effusions/thickening",
    "renal lesions",
    "suspicious breast lesion",
    "thoracic aortic aneurysm",
    "thyroid lesion",
    "tuberculosis",
    "other cancers",
]
PULMONARY_FINDINGS = [
    "bronchiectasis",
    "respiratory bronchiolitis",
    "interstitial lung abnormalities (ilas)",
    "ila",
]

# Fixed values: (metric, accepted term, greatest distance) of the finding metrics.
OTHER_FINDING_METRICS = [
    ("7a", "consolidation", 0.2),
    ("7b", "tuberculosis", 0.2),
    ("7c", "mediastinal mass", 0.2),
    ("7d", "coronary calcification", 0.2),
    ("7e", "aortic valve calcification", 0.2),
    ("7f", "thoracic aortic aneurysm", 0.2),
    ("7g", "pleural effusions/thickening", 0.2),
    ("7h", "suspicious breast lesion", 0.2),
    ("7i", "thyroid lesion", 0.2),
    ("7j", "liver or splenic lesions", 0.2),
    ("7k", "renal lesions", 0.1),
    ("7l", "adrenal lesions", 0.1),
    ("7m", "abdominal aortic aneurysm", 0.2),
    ("7n", "bone abnormalities", 0.2),
    ("7o", "osteoporosis", 0.2),
    ("7p", "fractures with no trauma history", 0.2),
    ("7t", "other cancers", 0.3),
]
PULMONARY_FINDING_METRICS = [
    ("7q", "bronchiectasis", 0.2),
    ("7r", "respiratory bronchiolitis", 0.2),
    ("7s", "interstitial lung abnormalities (ilas)", 0.2),
    ("7s", "ila", 0.2),
]

# Code groups that are reported as unknown, and codes missing from the public list.
UNKNOWN_CODES = ["C76", "C77", "C78", "C79", "C80", "C74", "C75", "C97"]
EXTRA_CODES = {
    "D09": "Urological",
    "D41": "Urological",
    "D32": "Brain/Central Nervous System",
    "D33": "Brain/Central Nervous System",
    "D35": "Brain/Central Nervous System",
    "D42": "Brain/Central Nervous System",
    "D43": "Brain/Central Nervous System",
    "D44": "Brain/Central Nervous System",
    "D06": "Gynaecological",
    "D29": "Urological",
    "D48": "Unknown",
}

# Registry code labels.
GENDER = {0: "Not known", 1: "Male", 2: "Female", 9: "Not specified"}
ETHNICITY = {
    "A": "British",
    "B": "Irish",
    "C": "Any other White background",
    "0": "Any other White background",
    "D": "White and Black Caribbean",
    "E": "White and Black African",
    "F": "White and Asian",
    "G": "Any other mixed background",
    "H": "Indian",
    "J": "Pakistani",
    "K": "Bangladeshi",
    "L": "Any other Asian background",
    "M": "Caribbean",
    "N": "African",
    "P": "Any other Black background",
    "R": "Chinese",
    "S": "Any other ethnic group",
    "Z": "Not stated",
    "X": "Not Known",
}
ETHNICITY_GROUP = {
    "White": ["0", "A", "B", "C"],
    "Mixed": ["D", "E", "F", "G"],
    "Asian": ["H", "J", "K", "L"],
    "Black": ["M", "N", "P"],
    "Other": ["R", "S"],
}
DIAGNOSIS_EVENTS = [6, 100]
MIXED_DECILE = "Diagnosed in 2013 is 2015 quintile otherwise 2019 quintile"
QUINTILE = {
    "1 - most deprived": ["1 - most deprived", "2"],
    "2": ["3", "4"],
    "3": ["5", "6"],
    "4": ["7", "8"],
    "5 - least deprived": ["9", "10 - least deprived"],
}

# The programme's date window, and the date from which first checks are preferred.
WINDOW = ("2019-04-01", "2024-04-01")
PREFERRED_AFTER = "2019-03-31"
OUTCOME_END = "2023-08-31"
DAYS_LIMIT = 185

# Event order, used when events fall on one day.
EVENT_ORDER = [
    "Invite date",
    "LHC date",
    "LHC Date low risk",
    "Initial scan",
    "LHC Date high risk",
    "3 month follow-up scan",
    "12 month follow-up scan",
    "24 month follow-up scan",
    "48 month follow-up scan",
    "2-year+ nodule surveillance",
    "Other scan",
]
REPORTED_PHASES = ["Original", "Onboarded"]
