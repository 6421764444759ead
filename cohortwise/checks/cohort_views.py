"""The cohort of the test views: raw tables and lookups for plans.Cohort."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortwise.plans.cohort import LISTS, Cohort
from cohortwise.plans import diagnoses
from cohortwise.sources import io
from cohortwise.sources.fixtures import Source, Views

# The submitter of whom only the newest transaction counts, and transactions never counted.
LATEST_ONLY_ORG = "ORG04"
BAD_TRANSACTIONS = [250, 251]
SITES = [("C34", "Lung"), ("C34.1", "Lung"), ("C50", "Breast"), ("C61", "Urological"), ("C76", "Other")]


RAW = ["demographics", "invite", "check", "measurement", "scan", "diagnostics", "history", "smoking", "registry", "rapid", "pathway"]
LOOKUPS = ["areas", "ethnicity", "project_names", "projects", "excluded_transactions", "excluded_people"]


# What is read of frames that are written out: of the selected records, then of the frames made from them.
_SUBMITTED = ["ParticipantID", "SubmittedZipFile", "TransactionId", "ReceivedDate"]
_VALID = ["transaction_validity", "person_validity"]
_SCAN = [*_SUBMITTED, "LDCT_Date", "LDCT_Outcome", "LDCT_ReportDate1", "Date_Referral_Lung_Cancer", "Date_ReferralOtherCancer"]
_FINDINGS = ["Other_Incidental_Findings", "Pulmonary_Incidental_Findings"]
_CHECK = ["check_date", "check_month", "first_letter_date", "attendance_category", "delivery_category", *_VALID, "eligible"]
KEEP_RECORDS = {
    "invite": [*_SUBMITTED, "First_Letter_Date", "Second_Letter_Date", "Follow_Up_Call_Date", "Contact_Date", "Invite_Outcome"],
    "check": [*_SUBMITTED, "CSURowNumber", "LHC_Date", "LHC_Attendance", "LHC_Delivery_Mode", "Date_Stopped_Smoking", "Total_Quit_Period"],
    "scan": [*_SCAN, *_FINDINGS, "Emphysema_Extent"],
    "smoking": [*_SUBMITTED, "Date_Offered_Smoking_Cessation"],
}
#: Frames of the event timeline and of the milestones.
KEEP_EVENTS = KEEP_RECORDS | {
    "scan": _SCAN,
    "checks": ["ParticipantID", *_CHECK],
    "clean_scans": ["ParticipantID", "scan_date", "scan_month", "scan_outcome", "scan_category", *_VALID],
    "diagnoses": ["pk", "ParticipantID", "diagnosis_date", "stage_group", "tumour_site_group"],
}
_MEASURED = ["scan_date", "scan_month", "scan_outcome", "scan_category", "days_from_first", "lung_referral_month", "other_referral_date",
             *_FINDINGS, "Emphysema_Extent", *_VALID]
#: Frames of the metrics.
KEEP_METRICS = KEEP_RECORDS | {
    "smoking": [*_SUBMITTED, "Date_Offered_Smoking_Cessation", "Date_Started_Smoking_Cessation", "Date_Ended_Smoking_Cessation",
                "Smoking_Cessation_Completed_Successfully"],
    "diagnostics": [*_SUBMITTED, "PET_CT_Date", "Bronchoscopy_Date", "Pathology_Report_Date", "Cancer_Diagnosis_Date"],
    "checks": ["ParticipantID", "project", *_CHECK, "CSURowNumber", "LHC_Date"],
    "first_checks": ["ParticipantID", "project", "check_date", "check_month", "first_letter_date", "delivery_category"],
    "clean_scans": ["ParticipantID", "org_code", *_MEASURED],
    "scans": ["ParticipantID", "project", "eligible", "first_letter_date", "check_date", "plco_risk", "llp_risk", *_MEASURED],
}


def cohort(spark: SparkSession, path: str, staged: bool | Collection[str] = False, keep: Mapping[str, Sequence[str]] | None = None,
           plain: Collection[str] = ()) -> Cohort:
    """The cohort of a directory; ``staged`` names the frames to write out, or True for all, and ``keep`` their columns that are read.
    Those in ``plain`` are not put in buckets of the person.

    A staged person table serves all base frames. With ``lines`` in it the order lines that several views are made of are written too.
    """
    if staged:
        io.keep_places(spark)
    src = Source(spark, path, shared=bool(staged) and (staged is True or "lines" in staged))
    stage = io.staged(spark, None if staged is True else {*(staged or ()), *LISTS}, keep, plain)
    c = Cohort(Views(src, RAW), Views(src, LOOKUPS), LATEST_ONLY_ORG, BAD_TRANSACTIONS, stage=stage)
    if staged is True or (staged and "persons" in staged):
        _ = c.persons
    return c


def site_codes(spark: SparkSession) -> DataFrame:
    """The codes as a row of constants, of which Spark knows that it is small."""
    codes = F.array(*[F.struct(F.lit(c).alias("icd_10"), F.lit(s).alias("tumour_site_group")) for c, s in SITES])
    return spark.range(1).select(F.explode(codes).alias("c")).select("c.*")


def all_diagnoses(c: Cohort, spark: SparkSession, columns: Sequence[str] | None = None) -> DataFrame:
    return diagnoses.consolidate(c.raw["registry"], c.raw["rapid"], c.raw["pathway"], diagnoses.icd_groups(site_codes(spark)),
                                 io.staged(spark), columns)
