"""Queries on exclusions, record selection and cleaning."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortwise.checks import cohort_views as views
from cohortwise.checks.registry import query
from cohortwise.checks.sql_parts import complete_months, dt
from cohortwise.functions import clean, dates, text
from cohortwise.operators import joins, reshape, select
from cohortwise.plans import diagnoses, pathway, reports, tables, vocab
from cohortwise.sources import io
from cohortwise.sources.fixtures import Source


def src(spark, path):
    return Source(spark, path)


# --- exclusions and selection

@query("exclude_transactions", """
SELECT CSURowNumber, TransactionId FROM fx_invite WHERE TransactionId NOT IN (SELECT TransactionId FROM fx_excluded_transactions WHERE table_name IS NULL OR table_name = 'invite')""")
def exclude_transactions(spark, path):
    s = src(spark, path)
    return select.exclude_listed(s.fx("fx_invite"), tables.listed_for(s.fx("fx_excluded_transactions"), "invite"), "TransactionId").select("CSURowNumber", "TransactionId")


@query("exclude_participants", """
SELECT CSURowNumber, ParticipantID FROM fx_invite WHERE ParticipantID NOT IN (SELECT ParticipantID FROM fx_excluded_people WHERE active = 'TRUE')""")
def exclude_participants(spark, path):
    s = src(spark, path)
    listed = s.fx("fx_excluded_people").filter("active = 'TRUE'")
    return select.exclude_listed(s.fx("fx_invite"), listed, "ParticipantID").select("CSURowNumber", "ParticipantID")


def _latest(name, view, part, cols):
    @query(name, f"SELECT {', '.join(cols)}, org_code, person_validity, transaction_validity FROM {part}")
    def run(spark, path, view=view, cols=cols):
        return views.cohort(spark, path).current(view).select(*cols, "org_code", "person_validity", "transaction_validity")
    return run


_latest("latest_per_person", "invite", "cur_invite", ["ParticipantID", "TransactionId", "CSURowNumber", "ReceivedDate", "First_Letter_Date"])
_latest("latest_per_person_scan", "scan", "cur_scan", ["ParticipantID", "LDCT_Date", "LDCT_Outcome", "CSURowNumber", "ReceivedDate"])
_latest("latest_per_person_ct", "diagnostics", "cur_diagnostics", ["ParticipantID", "Full_Dose_CT_Date", "CSURowNumber", "Cancer_Diagnosis_Date"])
_latest("latest_per_person_check", "check", "cur_check", ["ParticipantID", "LHC_Date", "LHC_Attendance", "CSURowNumber"])


@query("latest_snapshot_only", "SELECT TUMOUR_ID, ParticipantID, DatasetId FROM fx_registry WHERE DatasetId = (SELECT max(DatasetId) FROM fx_registry)")
def latest_snapshot_only(spark, path):
    return select.newest_snapshot(src(spark, path).fx("fx_registry")).select("TUMOUR_ID", "ParticipantID", "DatasetId")


@query("latest_submission", """
SELECT SubmittedFile, TransactionId, ReceivedDate FROM (SELECT *, max(ReceivedDate) OVER (PARTITION BY SubmittedFile) AS last_date
 FROM (SELECT DISTINCT SubmittedFile, TransactionId, ReceivedDate FROM fx_invite)) WHERE ReceivedDate = last_date""")
def latest_submission(spark, path):
    heads = src(spark, path).fx("fx_invite").select("SubmittedFile", "TransactionId", "ReceivedDate").distinct()
    return select.latest_submission(heads, "SubmittedFile")


@query("recent_transactions", """
SELECT DISTINCT SubmittedFile, ReceivedDate, TransactionId, UserEmail FROM fx_invite WHERE ReceivedDate >= DATE '2025-04-01'""")
def recent_transactions(spark, path):
    return select.recent_headers(src(spark, path).fx("fx_invite"), "2025-04-01", ["SubmittedFile", "ReceivedDate", "TransactionId", "UserEmail"])


@query("recent_transactions_by_month", """
SELECT DISTINCT SubmittedFile, ReceivedDate, TransactionId, UserEmail FROM fx_invite WHERE ReceivedDate >= DATE '2025-04-10'""")
def recent_transactions_by_month(spark, path):
    snapshot = io.save_by_month(src(spark, path).fx("fx_invite"), io.fresh_path(spark, "invite_by_month"))
    return select.recent_from_months(snapshot, "2025-04-10", ["SubmittedFile", "ReceivedDate", "TransactionId", "UserEmail"])


@query("first_per_key", """
SELECT user_id, event_type, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events) WHERE rn = 1""")
def first_per_key(spark, path):
    return select.top_per_key(src(spark, path).table("events"), ["user_id", "event_type"], [F.col("ts"), F.col("event_id")]).select(
        "user_id", "event_type", "event_id", "value")


@query("first_attended_preferred", "SELECT ParticipantID, project, check_d AS check_date, check_m AS check_month, CSURowNumber, delivery_c AS delivery FROM b_first")
def first_attended_preferred(spark, path):
    return views.cohort(spark, path).first_checks.select("ParticipantID", "project", "check_date", "check_month", "CSURowNumber",
                                                         F.col("delivery_category").alias("delivery"))


@query("distinct_rows", "SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events")
def distinct_rows(spark, path):
    return src(spark, path).table("events").select("user_id", "event_type", F.col("ts").cast("date").alias("day")).distinct()


DUPES = """SELECT user_id, event_id, d, source, mark, lag(source) OVER w AS ps, lag(mark) OVER w AS pm, lag(d) OVER w AS pd
FROM (SELECT user_id, event_id, CAST(ts AS DATE) AS d, CASE WHEN event_type IN ('view', 'click') THEN 'A' ELSE 'B' END AS source,
 CAST(user_id AS VARCHAR) || '|' || CAST(event_id % 3 AS VARCHAR) AS mark FROM events)
WINDOW w AS (PARTITION BY user_id ORDER BY d, source, mark, event_id)"""


@query("fingerprint_dedup", f"""
SELECT user_id, event_id, source FROM ({DUPES}) WHERE NOT coalesce(ps <> source AND pm = mark AND datediff('day', pd, d) < 100, FALSE)""")
def fingerprint_dedup(spark, path):
    rows = src(spark, path).table("events").select(
        "user_id", "event_id", F.col("ts").cast("date").alias("d"),
        F.when(F.col("event_type").isin("view", "click"), "A").otherwise("B").alias("source"), (F.col("event_id") % 3).alias("m"))
    return select.drop_repeated_diagnoses(rows, "user_id", "d", "source", clean.fingerprint("user_id", "m"), "event_id").select(
        "user_id", "event_id", "source")


@query("valid_transaction_flag", """
SELECT CSURowNumber, CASE WHEN TransactionId IN (250, 251) THEN 'Invalid' WHEN substr(SubmittedZipFile, 1, 5) = 'ORG04' AND TransactionId <
 (SELECT max(TransactionId) FROM fx_invite WHERE substr(SubmittedZipFile, 1, 5) = 'ORG04') THEN 'Invalid' ELSE 'Valid' END AS transaction_validity FROM fx_invite""")
def valid_transaction_flag(spark, path):
    return tables.tag_submission(src(spark, path).fx("fx_invite"), views.LATEST_ONLY_ORG, views.BAD_TRANSACTIONS).select(
        "CSURowNumber", "transaction_validity")


@query("valid_id_flag", "SELECT ParticipantID, CASE WHEN length(ParticipantID) < 60 THEN 'Invalid' ELSE 'Valid' END AS person_validity, "
       "CASE WHEN length(ParticipantID) < 15 THEN 'Invalid' ELSE 'Valid' END AS short_validity FROM fx_demographics")
def valid_id_flag(spark, path):
    df = select.person_validity(src(spark, path).fx("fx_demographics"))
    return select.person_validity(df, shortest=15, out="short_validity").select("ParticipantID", "person_validity", "short_validity")


@query("submitter_transactions", "SELECT DISTINCT TransactionId FROM fx_invite WHERE substr(SubmittedZipFile, 1, 5) = 'ORG02' AND TransactionId > 300")
def submitter_transactions(spark, path):
    return select.submitter_transactions(src(spark, path).fx("fx_invite"), "ORG02", 300)


@query("date_window_filter", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1995-04-01 00:00:00' AND o_orderdate < TIMESTAMP '2000-04-01 00:00:00'")
def date_window_filter(spark, path):
    df = src(spark, path).table("orders")
    return df.filter(dates.in_window("o_orderdate", "1995-04-01", "2000-04-01")).select("o_orderkey", "o_custkey")


@query("regex_filter", "SELECT doc_id, lang FROM documents WHERE regexp_matches(upper(text), 'THER|TION')")
def regex_filter(spark, path):
    return src(spark, path).table("documents").filter(F.upper("text").rlike("THER|TION")).select("doc_id", "lang")


# --- dates

@query("parse_dates_mixed", f"SELECT CSURowNumber, First_Letter_Date AS raw, {dt('First_Letter_Date')} AS parsed FROM fx_invite")
def parse_dates_mixed(spark, path):
    return src(spark, path).fx("fx_invite").select("CSURowNumber", F.col("First_Letter_Date").alias("raw"), dates.parse_date("First_Letter_Date").alias("parsed"))


@query("parse_excel_serial", "SELECT CSURowNumber, CAST(DATE '1899-12-30' + TRY_CAST(First_Letter_Date AS INTEGER) AS DATE) AS parsed FROM fx_invite WHERE length(First_Letter_Date) = 5")
def parse_excel_serial(spark, path):
    return src(spark, path).fx("fx_invite").filter(F.length("First_Letter_Date") == 5).select("CSURowNumber", dates.excel_serial("First_Letter_Date").alias("parsed"))


@query("parse_date_formats", """SELECT CSURowNumber, CAST(try_strptime(First_Letter_Date, ['%d/%m/%Y','%d/%m/%Y %H:%M','%b %d %Y %H:%M','%d-%m-%y','%Y-%m-%d %H:%M:%S','%Y%m%d','%d-%b-%y']) AS DATE) AS parsed
FROM fx_invite WHERE length(First_Letter_Date) <> 5""")
def parse_date_formats(spark, path):
    return src(spark, path).fx("fx_invite").filter(F.length("First_Letter_Date") != 5).select("CSURowNumber", dates.parse_formats("First_Letter_Date").alias("parsed"))


@query("month_trunc", "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month FROM orders")
def month_trunc(spark, path):
    return src(spark, path).table("orders").select("o_orderkey", dates.month_start(F.col("o_orderdate").cast("date")).alias("month"))


@query("org_code", "SELECT c_custkey, substr(c_name, 1, 5) AS org_code FROM customer")
def org_code(spark, path):
    return src(spark, path).table("customer").select("c_custkey", F.substring("c_name", 1, 5).alias("org_code"))


def _demographics(name, sql, *cols):
    @query(name, f"SELECT ParticipantID, {sql} FROM cl_demographics")
    def run(spark, path):
        return views.cohort(spark, path).demographics.select("ParticipantID", *cols)


_demographics("recode_sex", "sex_c AS sex", "sex")
_demographics("clean_age", "age_n AS age, age_validity", "age", "age_validity")
_demographics("age_bands", "age_band, age_band_five, age_band_eval", "age_band", "age_band_five", "age_band_eval")
_demographics("rurality_category", "rurality_code, rurality", "rurality_code", "rurality")


@query("factor_levels", """
SELECT c.*, f.lang_rank, g.language, g.language_ord FROM (SELECT ParticipantID, marital, ethnic_group, CASE ethnic_group WHEN 'Asian or Asian British' THEN 1 WHEN 'Black or Black British' THEN 2 WHEN 'Mixed' THEN 3
 WHEN 'Not stated' THEN 4 WHEN 'Other Ethnic Group' THEN 5 WHEN 'White' THEN 6 ELSE 7 END AS ethnic_ord, Ethnicity AS raw FROM cl_demographics) c
JOIN (SELECT Ethnicity AS raw2, CAST(rank() OVER (ORDER BY count(*) DESC) AS INTEGER) AS lang_rank FROM cl_demographics GROUP BY 1) f ON c.raw IS NOT DISTINCT FROM f.raw2
JOIN (SELECT ParticipantID, CSURowNumber, coalesce(d.Language, 'Not known') AS language, language_ord FROM cl_demographics d JOIN (SELECT Language, CAST(row_number() OVER (ORDER BY Language IS NULL, count(*) DESC, Language) AS INTEGER) AS language_ord
 FROM cl_demographics GROUP BY 1) o ON d.Language IS NOT DISTINCT FROM o.Language) g ON c.ParticipantID = g.ParticipantID""")
def factor_levels(spark, path):
    d = views.cohort(spark, path).demographics
    # the raw level ranked as a value of its own, equal counts share a rank
    freq = d.groupBy("Ethnicity").agg(F.count(F.lit(1)).alias("n"))
    line = freq.agg(F.array_sort(F.collect_list(-F.col("n"))).alias("line")).select("line").scalar()
    ranked = freq.withColumn("lang_rank", F.array_position(line, -F.col("n")).cast("int")).drop("n")
    d = tables.order_by_frequency(d, "Language", "language_ord", "Not known")
    return joins.null_safe(d, ranked, ["Ethnicity"], "inner").select(
        "ParticipantID", F.col("marital_status").alias("marital"), "ethnic_group", clean.level_order("ethnic_group", vocab.ETHNIC_GROUP).alias("ethnic_ord"),
        F.col("Ethnicity").alias("raw"), "lang_rank", F.col("Language").alias("language"), "language_ord")


def _check(name, sql, *cols):
    @query(name, f"SELECT CSURowNumber, {sql} FROM cl_check")
    def run(spark, path):
        return tables.clean_check(views.cohort(spark, path).current("check")).select("CSURowNumber", *cols)


_check("transposed_repair", "check_d AS check_date, attendance_t AS attendance", "check_date", "attendance")
_check("attendance_category", "attendance_c AS attendance_category", "attendance_category")
_check("delivery_category", "delivery_c AS delivery_category", "delivery_category")


@query("parse_many_dates", "SELECT CSURowNumber, Full_Dose_CT_Date, diagnosis_d AS diagnosis_date, pet_d AS pet_ct_date, bronch_d AS bronchoscopy_date, path_d AS pathology_report_date, diagnosis_m AS diagnosis_month FROM cl_diagnostics")
def parse_many_dates(spark, path):
    return tables.clean_diagnostics(views.cohort(spark, path).current("diagnostics")).select(
        "CSURowNumber", "Full_Dose_CT_Date", "diagnosis_date", "pet_ct_date", "bronchoscopy_date", "pathology_report_date", "diagnosis_month")


@query("outcome_date", "SELECT ParticipantID, outcome_d AS latest, coalesce(contact_d, call_d, second_letter_d, first_letter_d) AS first_known FROM cl_invite")
def outcome_date(spark, path):
    return views.cohort(spark, path).clean_invites.select(
        "ParticipantID", F.col("outcome_date").alias("latest"),
        F.coalesce("contact_date", "follow_up_call_date", "second_letter_date", "first_letter_date").alias("first_known"))


@query("invite_flags", "SELECT ParticipantID, eligible, accepted, first_letter_m AS first_letter_month, outcome_m AS outcome_month FROM cl_invite")
def invite_flags(spark, path):
    return views.cohort(spark, path).clean_invites.select("ParticipantID", "eligible", "accepted", "first_letter_month", "outcome_month")


@query("scan_outcome_recode", "SELECT CSURowNumber, LDCT_Date, outcome_c AS scan_outcome FROM p_scan")
def scan_outcome_recode(spark, path):
    return tables.clean_scan(views.cohort(spark, path).current("scan")).select("CSURowNumber", "LDCT_Date", "scan_outcome")


@query("scan_date_correction", "SELECT CSURowNumber, LDCT_Date, moved AS report_date_used, scan_d AS scan_date, scan_m AS scan_month FROM cor_scan")
def scan_date_correction(spark, path):
    c = views.cohort(spark, path)
    return tables.correct_scan_dates(tables.clean_scan(c.current("scan")), c.clean_invites).select(
        "CSURowNumber", "LDCT_Date", "report_date_used", "scan_date", "scan_month")


@query("risk_groups", "SELECT ParticipantID, plco_n AS plco, plco_r AS plco_risk, llp_n AS llp, llp_r AS llp_risk FROM cl_measurement")
def risk_groups(spark, path):
    return views.cohort(spark, path).clean_measurements.select("ParticipantID", "plco", "plco_risk", "llp", "llp_risk")


@query("exclusion_recode", "SELECT ParticipantID, exclusion_c AS exclusion FROM cl_measurement")
def exclusion_recode(spark, path):
    return views.cohort(spark, path).clean_measurements.select("ParticipantID", "exclusion")


@query("yes_no_recode", "SELECT ParticipantID, completed_c AS completed FROM cl_smoking")
def yes_no_recode(spark, path):
    return tables.clean_smoking(views.cohort(spark, path).current("smoking")).select("ParticipantID", "completed")


LINES = "lineitem JOIN orders ON l_orderkey = o_orderkey"


def lines(spark, path):
    s = src(spark, path)
    return (s.table("lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", F.col("l_shipdate").cast("date").alias("ship"))
            .join(s.table("orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderpriority", "o_orderstatus",
                                           F.col("o_orderdate").cast("date").alias("placed")), "l_orderkey"))


@query("days_between", f"SELECT l_orderkey, l_linenumber, CAST(datediff('day', o_orderdate, l_shipdate) AS INTEGER) AS days, CAST(abs(datediff('day', l_shipdate, DATE '1998-01-01')) AS INTEGER) AS apart FROM {LINES}")
def days_between(spark, path):
    return lines(spark, path).select("l_orderkey", "l_linenumber", dates.days_between("placed", "ship").alias("days"),
                                     F.abs(dates.days_between("ship", F.lit("1998-01-01").cast("date"))).alias("apart"))


@query("months_between_complete", f"SELECT l_orderkey, l_linenumber, CAST({complete_months('CAST(o_orderdate AS DATE)', 'CAST(l_shipdate AS DATE)')} AS INTEGER) AS months FROM {LINES}")
def months_between_complete(spark, path):
    return lines(spark, path).select("l_orderkey", "l_linenumber", dates.complete_months("placed", "ship").alias("months"))


@query("split_explode", "SELECT ParticipantID, LDCT_Date, CSURowNumber, token AS finding FROM tok_other")
def split_explode(spark, path):
    return views.cohort(spark, path).scans.filter("Other_Incidental_Findings IS NOT NULL").select(
        "ParticipantID", "LDCT_Date", "CSURowNumber", F.explode(text.split_findings("Other_Incidental_Findings")).alias("finding"))


@query("extract_code", "SELECT CSURowNumber, regexp_extract(upper(SubmittedFile), '_(\\w{3,5})_INVITES', 1) AS project_code FROM fx_invite")
def extract_code(spark, path):
    return src(spark, path).fx("fx_invite").select("CSURowNumber", reports.project_code("SubmittedFile", "_INVITES").alias("project_code"))


FY = "CASE WHEN month({0}) < 4 THEN CAST(year({0}) - 1 AS VARCHAR) || '-' || right(CAST(year({0}) AS VARCHAR), 2) ELSE CAST(year({0}) AS VARCHAR) || '-' || right(CAST(year({0}) + 1 AS VARCHAR), 2) END"


@query("financial_year", f"SELECT o_orderkey, {FY.format('o_orderdate')} AS financial_year FROM orders")
def financial_year(spark, path):
    return src(spark, path).table("orders").select("o_orderkey", dates.financial_year(F.col("o_orderdate").cast("date")).alias("financial_year"))


@query("month_labels", "SELECT o_orderkey, strftime(o_orderdate, '%b %Y') AS short, strftime(o_orderdate, '%B %Y') AS long, strftime(o_orderdate, '%Y%m') AS compact FROM orders")
def month_labels(spark, path):
    d = F.col("o_orderdate").cast("date")
    return src(spark, path).table("orders").select("o_orderkey", dates.month_label(d).alias("short"), dates.month_label(d, "MMMM yyyy").alias("long"),
                                                   dates.month_label(d, "yyyyMM").alias("compact"))


@query("decile_quintile", """SELECT TUMOUR_ID, CASE coalesce(CASE WHEN IMD_DECILE LIKE 'Diagnosed in 2013%' THEN IMD_QUINTILE ELSE IMD_DECILE END, '')
 WHEN '1 - most deprived' THEN '1 - most deprived' WHEN '2' THEN '1 - most deprived' WHEN '3' THEN '2' WHEN '4' THEN '2' WHEN '5' THEN '3' WHEN '6' THEN '3'
 WHEN '7' THEN '4' WHEN '8' THEN '4' WHEN '9' THEN '5 - least deprived' WHEN '10 - least deprived' THEN '5 - least deprived' END AS quintile FROM fx_registry""")
def decile_quintile(spark, path):
    return src(spark, path).fx("fx_registry").select("TUMOUR_ID", diagnoses.quintile("IMD_DECILE", "IMD_QUINTILE").alias("quintile"))


@query("code_labels", """SELECT TUMOUR_ID, CASE GENDER WHEN 0 THEN 'Not known' WHEN 1 THEN 'Male' WHEN 2 THEN 'Female' WHEN 9 THEN 'Not specified' END AS gender,
 CASE ETHNICITY WHEN 'A' THEN 'British' WHEN 'B' THEN 'Irish' WHEN 'C' THEN 'Any other White background' WHEN '0' THEN 'Any other White background' WHEN 'D' THEN 'White and Black Caribbean'
  WHEN 'E' THEN 'White and Black African' WHEN 'G' THEN 'Any other mixed background' WHEN 'H' THEN 'Indian' WHEN 'J' THEN 'Pakistani' WHEN 'K' THEN 'Bangladeshi'
  WHEN 'L' THEN 'Any other Asian background' WHEN 'M' THEN 'Caribbean' WHEN 'N' THEN 'African' WHEN 'P' THEN 'Any other Black background' WHEN 'R' THEN 'Chinese'
  WHEN 'S' THEN 'Any other ethnic group' WHEN 'Z' THEN 'Not stated' WHEN 'X' THEN 'Not Known' ELSE '<blank>' END AS ethnicity,
 CASE WHEN ETHNICITY IN ('0','A','B','C') THEN 'White' WHEN ETHNICITY IN ('D','E','F','G') THEN 'Mixed' WHEN ETHNICITY IN ('H','J','K','L') THEN 'Asian'
  WHEN ETHNICITY IN ('M','N','P') THEN 'Black' WHEN ETHNICITY IN ('R','S') THEN 'Other' ELSE 'Unknown' END AS ethnicity_group FROM fx_registry""")
def code_labels(spark, path):
    df = src(spark, path).fx("fx_registry").select("TUMOUR_ID", F.col("GENDER").alias("gender_code"), F.col("ETHNICITY").alias("ethnicity_code"),
                                                   F.col("AGE").alias("age"), F.col("DIAGNOSISDATEBEST").alias("diagnosis_date"))
    return diagnoses.code_labels(df).select("TUMOUR_ID", "gender", "ethnicity", "ethnicity_group")


@query("icd_normalise", """SELECT p_partkey, replace(raw, '.', '') AS code, substr(replace(raw, '.', ''), 1, 3) AS code3, substr(stage, 1, 1) AS stage_group
FROM (SELECT p_partkey, 'C' || CAST(10 + p_partkey % 90 AS VARCHAR) || '.' || CAST(p_partkey % 10 AS VARCHAR) AS raw, CAST(1 + p_size % 4 AS VARCHAR) || 'A' AS stage FROM part)""")
def icd_normalise(spark, path):
    key = F.col("p_partkey")
    raw = F.concat(F.lit("C"), (10 + key % 90).cast("string"), F.lit("."), (key % 10).cast("string"))
    stage = F.concat((1 + F.col("p_size") % 4).cast("string"), F.lit("A"))
    code = diagnoses.normalise_code(raw)
    return src(spark, path).table("part").select("p_partkey", code.alias("code"), F.substring(code, 1, 3).alias("code3"), F.substring(stage, 1, 1).alias("stage_group"))


@query("junk_to_null", "SELECT ParticipantID, CASE WHEN Age NOT IN ('', 'NULL', 'null', 'Null') THEN Age END AS Age, Sex, Marital_Status FROM fx_demographics")
def junk_to_null(spark, path):
    return clean.junk_to_null(src(spark, path).fx("fx_demographics").select("ParticipantID", "Age", "Sex", "Marital_Status"))


@query("project_name_resolve", "SELECT CSURowNumber, project FROM b_invites")
def project_name_resolve(spark, path):
    return views.cohort(spark, path).invites.select("CSURowNumber", "project")


@query("fingerprint_text", """SELECT TUMOUR_ID, ParticipantID || '|' || SITE_ICD10_3CHAR || '|' || coalesce(nullif(nullif(substr(STAGE_BEST, 1, 1), '?'), 'U'), 'NA') || '|' || DIAG_TRUST AS mark FROM fx_registry""")
def fingerprint_text(spark, path):
    return src(spark, path).fx("fx_registry").select("TUMOUR_ID", clean.fingerprint(
        "ParticipantID", "SITE_ICD10_3CHAR", clean.null_if(F.substring("STAGE_BEST", 1, 1), "?", "U"), "DIAG_TRUST").alias("mark"))


OUT = """CASE WHEN Invite_Outcome IN ('Participant accepted invitation','Participant_accepted_invitation') THEN 'Accepted'
 WHEN Invite_Outcome IN ('Participant declined invitation','Participant_declined_invitation') THEN 'Declined'
 WHEN Invite_Outcome IN ('Participant does not meet age criteria','Participant does not meet smoking criteria','Participant removed from GP list','Participant_Removed_from_GP_List') THEN 'Ineligible' ELSE 'No response' END"""


@query("invite_sequence", f"""SELECT ParticipantID, CASE WHEN f IS NOT NULL AND s IS NOT NULL THEN 'Invite 1 No response' WHEN f IS NOT NULL THEN 'Invite 1 ' || o END AS invite_1,
 CASE WHEN s IS NOT NULL AND t IS NOT NULL THEN 'Invite 2 No response' WHEN s IS NOT NULL THEN 'Invite 2 ' || o END AS invite_2,
 CASE WHEN t IS NOT NULL THEN 'Invite 3 ' || o END AS invite_3, 'Invite ' || o AS invite_outcome
FROM (SELECT ParticipantID, coalesce(first_letter_d, second_letter_d, call_d) AS f, coalesce(second_letter_d, call_d) AS s, call_d AS t, {OUT} AS o FROM cl_invite)""")
def invite_sequence(spark, path):
    return pathway.invite_sequence(views.cohort(spark, path).clean_invites).select("ParticipantID", "invite_1", "invite_2", "invite_3", "invite_outcome")


@query("disclosure_rounding", """SELECT o_custkey, CAST(5 * round_even(n / 5, 0) AS BIGINT) AS rounded, CASE WHEN n < 10 THEN '<10' ELSE CAST(n AS VARCHAR) END AS shown
FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1)""")
def disclosure_rounding(spark, path):
    n = src(spark, path).table("orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return n.select("o_custkey", clean.round_to("n").alias("rounded"), clean.hide_small("n").alias("shown"))


@query("report_groupings", """SELECT ParticipantID, CASE WHEN imd_decile <= 2 THEN 'Q1' WHEN imd_decile <= 10 THEN 'Q2-5' ELSE 'Not known' END AS rpt_imd,
 CASE WHEN age_band_eval IN ('55-64','65-74','75') THEN age_band_eval || 'yrs' WHEN age_band_eval IN ('Other','Age below zero') THEN 'Other' ELSE 'Not known' END AS rpt_age,
 CASE WHEN ethnic_group IN ('White','Not known') THEN ethnic_group WHEN ethnic_group <> 'Not stated' THEN 'Other ethnicities' END AS rpt_ethnicity,
 CASE WHEN p.triage_before_risk_assessment = 'Unknown' THEN 'Not known' ELSE p.triage_before_risk_assessment END AS rpt_triage
FROM b_invites i LEFT JOIN fx_projects p ON i.project = p.project""")
def report_groupings(spark, path):
    c = views.cohort(spark, path)
    df = joins.lookup(c.invites, c.lookups["projects"], "project", ["triage_before_risk_assessment", "admin"])
    return pathway.reporting_groups(df).select("ParticipantID", "rpt_imd", "rpt_age", "rpt_ethnicity", "rpt_triage")


@query("include_label", "SELECT CSURowNumber, CASE WHEN ReceivedDate >= DATE '2024-05-15' THEN 'Include' ELSE 'Exclude' END AS include FROM fx_invite")
def include_label(spark, path):
    return src(spark, path).fx("fx_invite").select("CSURowNumber", dates.include_label("ReceivedDate", "2024-06-20").alias("include"))


ACTIVITY = [("Invites", "fx_invite", "First_Letter_Date"), ("LHC", "fx_check", "LHC_Date"), ("LDCT", "fx_scan", "LDCT_Date"),
            ("Smoking", "fx_smoking", "Date_Offered_Smoking_Cessation")]


@query("activity_by_month", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, strftime(try_strptime({c}, '%d/%m/%Y'), '%Y%m') AS year_month, CAST(count(ParticipantID) AS BIGINT) AS n FROM {v} WHERE TransactionId = 200 GROUP BY 2"
    for n, v, c in ACTIVITY))
def activity_by_month(spark, path):
    s = src(spark, path)
    return reshape.union_all([
        s.fx(v).filter("TransactionId = 200").groupBy(dates.year_month_or_null(c).alias("year_month"))
        .agg(F.count("ParticipantID").alias("n")).withColumn("table_name", F.lit(n)) for n, v, c in ACTIVITY]).select("table_name", "year_month", "n")


@query("metric_id_harmonise", "SELECT project, month, CASE metric_id WHEN '4' THEN '4a' WHEN '14a' THEN '14' ELSE metric_id END AS metric_id, numerator FROM fx_metric_rows WHERE metric_name <> 'Metric 6e'")
def metric_id_harmonise(spark, path):
    return reports.harmonise_ids(src(spark, path).fx("fx_metric_rows"), ["Metric 6e"]).select("project", "month", "metric_id", "numerator")
