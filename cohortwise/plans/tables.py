"""From raw text tables to cleaned tables with derived columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortwise.functions import clean, dates
from cohortwise.operators import joins, select, windows
from cohortwise.plans import vocab

# What one current record stands for in each submitted table.
RECORD_KEYS = {
    "demographics": ["ParticipantID"],
    "invite": ["ParticipantID"],
    "check": ["ParticipantID", "LHC_Date"],
    "measurement": ["ParticipantID"],
    "scan": ["ParticipantID", "LDCT_Date"],
    "diagnostics": ["ParticipantID", "Full_Dose_CT_Date"],
    "history": ["ParticipantID"],
    "smoking": ["ParticipantID"],
}


def listed_for(listed: DataFrame, table: str | None) -> DataFrame:
    if "table_name" not in listed.columns:
        return listed
    return listed.filter(F.col("table_name").isNull() | F.col("table_name").eqNullSafe(table))


def current_records(df: DataFrame, keys: Sequence[str], bad_transactions: DataFrame | None = None,
                    bad_people: DataFrame | None = None, table: str | None = None, home: str | None = None) -> DataFrame:
    """Exclusions, then the newest record per key.

    A listed transaction counts for the table that its row names, and for all tables where it names none. Records with several
    keys are moved by ``home`` alone.
    """
    if bad_transactions is not None:
        df = select.exclude_listed(df, listed_for(bad_transactions, table), "TransactionId")
    if bad_people is not None:
        df = select.exclude_listed(df, bad_people.filter("active = 'TRUE'"), "ParticipantID")
    return select.latest_per_key(df, keys, home=home if len(keys) > 1 else None)


def tag_submission(df: DataFrame, latest_only_org: str | None = None, bad: Sequence[int] = ()) -> DataFrame:
    df = df.withColumn("org_code", F.substring("SubmittedZipFile", 1, 5))
    df = df.withColumn("received_month", dates.month_start("ReceivedDate"))
    return select.transaction_validity(select.person_validity(df), latest_only_org, bad)


def parse_dates(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Adds one parsed date per text column, all in a single projection."""
    return df.withColumns({out: dates.parse_date(F.col(f"`{c}`")) for c, out in columns.items()})


def with_months(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    return df.withColumns({out: dates.month_start(c) for c, out in columns.items()})


def order_by_frequency(df: DataFrame, column: str, out: str, missing: str | None = None) -> DataFrame:
    """Place of each value among the values by frequency, equal ones by name; a missing value is given a name and stays last.

    Counts per value are sorted inside one aggregate and unfolded by position: rows meet only the few values.
    """
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    first = F.struct(F.col(column).isNull().alias("last"), (-F.col("_n")).alias("n"), F.col(column).alias("v"))
    places = counts.agg(F.array_sort(F.collect_list(first)).alias("_l")).select(F.posexplode("_l").alias("_at", "_e"))
    places = places.select(F.col("_e.v").alias(column), (F.col("_at") + 1).cast("int").alias(out))
    ordered = joins.null_safe(df, places, [column], "inner")
    return ordered if missing is None else ordered.withColumn(column, F.coalesce(column, F.lit(missing)))


def clean_demographics(df: DataFrame, areas: DataFrame, ethnicity: DataFrame) -> DataFrame:
    df = joins.lookup(df, areas, "LSOA", {"LSOA_NAME": "lsoa_name", "Decile": "imd_decile", "RUC11CD": "rurality_code"},
                      "LSOA_CODE")
    df = joins.lookup(df, ethnicity, "Ethnicity", {"EthnicGroup": "_group"})
    age = clean.to_number(clean.null_if(clean.replace_first("Age", "yrs", ""), "NULL", "IA2"))
    low, high = vocab.AGE_VALID
    return df.withColumn("age", age).withColumns({
        "sex": clean.classify(F.upper(F.trim("Sex")), vocab.SEX, "Not known"),
        "age_validity": F.when(F.col("age").between(low, high), "Valid").otherwise("Invalid"),
        "age_band": clean.cut("age", *vocab.AGE_BAND, missing="Not known"),
        "age_band_five": clean.cut("age", *vocab.AGE_BAND_FIVE, missing="Not known"),
        "age_band_eval": clean.cut("age", *vocab.AGE_BAND_EVAL, missing="Not known"),
        "marital_status": clean.levels("Marital_Status", vocab.MARITAL_STATUS),
        "ethnic_group": clean.levels("_group", vocab.ETHNIC_GROUP),
        "rurality": F.when(F.col("rurality_code").isNotNull(),
                           clean.classify("rurality_code", vocab.RURALITY, "NOT CODED")),
    }).drop("_group")


def clean_invite(df: DataFrame, programme: str = "PROGRAMME") -> DataFrame:
    """Parsed dates, outcome date, eligibility and acceptance.

    ``programme`` is the short name that some submitters put before ACCEPTED.
    """
    df = parse_dates(df, {"First_Letter_Date": "first_letter_date", "Second_Letter_Date": "second_letter_date",
                          "Follow_Up_Call_Date": "follow_up_call_date", "Contact_Date": "contact_date"})
    df = df.withColumn("outcome_date", F.greatest("contact_date", "follow_up_call_date", "second_letter_date", "first_letter_date"))
    df = with_months(df, {"first_letter_date": "first_letter_month", "second_letter_date": "second_letter_month",
                          "follow_up_call_date": "follow_up_call_month", "outcome_date": "outcome_month"})
    outcome = F.upper("Invite_Outcome")
    return df.withColumns({
        "eligible": F.when(outcome.isin(vocab.INELIGIBLE), "Ineligible").otherwise("Eligible"),
        "accepted": F.when(outcome.isin([*vocab.ACCEPTED, f"{programme} ACCEPTED"]), "Accepted"),
    })


def clean_check(df: DataFrame) -> DataFrame:
    """Check date and attendance, also where the two were typed into each other's columns."""
    date, attendance = clean.swap_repair("LHC_Date", "LHC_Attendance", dates.parse_date)
    df = df.withColumns({"check_date": date, "attendance": attendance,
                         "stopped_smoking_date": dates.parse_date("Date_Stopped_Smoking")})
    return df.withColumns({
        "check_month": dates.month_start("check_date"),
        "attendance_category": clean.classify(F.upper("attendance"), vocab.ATTENDANCE, "NOT CODED", "NULL response"),
        "delivery_category": clean.classify(F.upper("LHC_Delivery_Mode"), vocab.DELIVERY, "NOT CODED", "NULL response"),
    })


def clean_measurement(df: DataFrame) -> DataFrame:
    plco = clean.replace_first(clean.null_if("PLCOm2012", "NULL"), r"\.{2}|:", ".")
    llp = clean.null_if("LLPv2_Risk", "NULL")
    llp = clean.replace_first(clean.replace_first(llp, r"\.{2}", "."), ">", "")
    llp = F.trim(clean.replace_first(llp, r"\?|;", ""))
    df = df.withColumns({"plco": clean.to_number(plco), "llp": clean.to_number(llp)})
    reason = clean.null_if(F.upper("Exclusion_Criteria"), *vocab.NO_EXCLUSION)
    risk = lambda c, high: F.when(F.col(c) >= high, "High risk").when(F.col(c).isNotNull(), "Low risk")
    return df.withColumns({
        "plco_risk": risk("plco", vocab.PLCO_HIGH),
        "llp_risk": risk("llp", vocab.LLP_HIGH),
        "exclusion": clean.recode(reason, vocab.EXCLUSION, "Other"),
    })


def scan_outcome(date_text, outcome_text) -> "F.Column":
    raw = F.coalesce(F.when(F.col(date_text) == vocab.PERFORMED, F.col(date_text)), F.col(outcome_text))
    return clean.recode(F.upper(raw), vocab.SCAN_OUTCOME, "Other")


def clean_scan(df: DataFrame) -> DataFrame:
    """Scan date (also from the outcome column), outcome group and referral dates.

    The scan month is that of the submitted date; a later correction of the date does
    not move it.
    """
    df = parse_dates(df, {"LDCT_ReportDate1": "report_date", "Date_Referral_Lung_Cancer": "lung_referral_date",
                          "Date_ReferralOtherCancer": "other_referral_date"})
    df = df.withColumn("scan_date", F.coalesce(dates.parse_date("LDCT_Date"), dates.parse_date("LDCT_Outcome")))
    df = with_months(df, {"scan_date": "scan_month", "lung_referral_date": "lung_referral_month"})
    return df.withColumn("scan_outcome", scan_outcome("LDCT_Date", "LDCT_Outcome"))


def correct_scan_dates(scans: DataFrame, invites: DataFrame) -> DataFrame:
    """The report date replaces a scan date that lies before the first letter, if it fits better."""
    first = invites.select("ParticipantID", F.col("first_letter_date").alias("_first")).distinct()
    better = F.coalesce((F.col("scan_date") < F.col("_first")) & (F.col("report_date") >= F.col("_first")), F.lit(False))
    return (scans.join(first, "ParticipantID", "left")
            .withColumn("report_date_used", better)
            .withColumn("scan_date", F.when(F.col("report_date_used"), F.col("report_date")).otherwise(F.col("scan_date")))
            .drop("_first"))


def time_scans(scans: DataFrame) -> DataFrame:
    """Days and complete months from the first performed scan, and the category of each scan.

    A person has one current scan a date, so the window over a person's scans is no longer than the calendar. Rows that
    are in buckets of the person are read once and not moved.
    """
    performed = F.when(F.col("scan_outcome") == vocab.PERFORMED, F.col("scan_date"))
    first = F.when(F.col("ParticipantID").isNotNull(), F.min(performed).over(Window.partitionBy("ParticipantID")))
    return (scans.withColumn("first_date", first)
            .withColumn("days_from_first", dates.days_between("first_date", "scan_date"))
            .withColumn("months_from_first", dates.complete_months("first_date", "scan_date"))
            .withColumn("scan_category", windows.scan_category("days_from_first")))


def sequence_scans(scans: DataFrame) -> DataFrame:
    """Place in the person's sequence of scan dates and complete months since the one before."""
    seq = windows.sequence_dates(scans, "ParticipantID", "scan_date")
    seq = windows.months_since_previous(seq).drop("previous")
    return scans.join(seq, ["ParticipantID", "scan_date"], "left")


def clean_diagnostics(df: DataFrame, columns: Mapping[str, str] | None = None) -> DataFrame:
    columns = columns or {"PET_CT_Date": "pet_ct_date", "Bronchoscopy_Date": "bronchoscopy_date",
                          "Pathology_Report_Date": "pathology_report_date", "Cancer_Diagnosis_Date": "diagnosis_date"}
    return with_months(parse_dates(df, columns), {"diagnosis_date": "diagnosis_month"})


def clean_history(df: DataFrame) -> DataFrame:
    return parse_dates(df, {"Cancer_Date": "cancer_date"})


def clean_smoking(df: DataFrame) -> DataFrame:
    df = parse_dates(df, {"Date_Offered_Smoking_Cessation": "offered_date", "Date_Started_Smoking_Cessation": "started_date",
                          "Date_Ended_Smoking_Cessation": "ended_date"})
    df = with_months(df, {"offered_date": "offered_month", "started_date": "started_month", "ended_date": "ended_month"})
    return df.withColumn("completed", clean.recode(
        F.upper(F.trim("Smoking_Cessation_Completed_Successfully")), vocab.YES_NO))
