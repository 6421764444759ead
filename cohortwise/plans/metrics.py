"""The metric catalogue and its one-pass evaluation.

Each metric is a base frame, a month column and a condition. All metrics of a base are
counted together: a row turns into one (metric, month) entry per metric it meets, and
one grouped distinct count finishes the job.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortwise.functions import dates
from cohortwise.operators import aggregate
from cohortwise.plans import vocab
from cohortwise.plans.cohort import FINDINGS, TIMED, Cohort, counted

KEYS = ["project", "month", "metric_id", "metric_name"]


@dataclass(frozen=True)
class Metric:
    id: str
    base: str
    months: tuple[str, ...]
    where: Callable[[], Column]
    days: Callable[[], Column] | None = None
    needs: tuple[str, ...] = ()  # joins a scan metric depends on

    def name(self, programme: str) -> str:
        return NAMES[self.id].format(programme=programme)

    def frame(self, cohort: Cohort, keep: Sequence[str] = ()) -> DataFrame:
        if self.base in FINDINGS:
            return cohort.findings(*FINDINGS[self.base], timed=not set(TIMED).isdisjoint(keep))
        return cohort.scan_frame(self.needs) if self.base == "scans" else getattr(cohort, self.base)


def _has(c: str) -> Column:
    return F.col(c).isNotNull()


def _high_risk() -> Column:
    return F.coalesce(F.col("plco_risk") == "High risk", F.lit(False)) | F.coalesce(F.col("llp_risk") == "High risk", F.lit(False))


def _scan(eligible: bool, category: str | None = None, outcome: str = vocab.PERFORMED) -> Column:
    cond = counted(eligible) & _has("scan_month") & (F.col("scan_outcome") == outcome)
    return cond if category is None else cond & (F.col("scan_category") == category)


def _missed(delivery: str) -> Column:
    return (counted(True) & _has("check_month") & (F.col("attendance_category") == "DNA")
            & (F.col("delivery_category") == delivery))


def _close(term: str, distance: float) -> Column:
    return _scan(True) & (F.col("term") == term) & (F.col("distance") <= distance)


# Published names of the metrics; {programme} is the programme's name.
NAMES = {
    "1a": "Number of people invited to a {programme} (First Invites)",
    "1c": "Number of people invited to a {programme} (Follow-up Invites)",
    "2": "Number of patients who have accepted a {programme} invitation",
    "3a": "Number of patients who attended a face-to-face Lung Health Check",
    "3b": "Number of patients who attended a telephone Lung Health Check",
    "3c": "Number of patients who did not attend their face-to-face Lung Health Check",
    "3d": "Number of patients who did not attend their telephone Lung Health Check",
    "4a": "Number of participants who are referred for a Low Dose CT",
    "4b": "Number of participants who triggered a risk score for referral but were ineligible for an initial LDCT scan",
    "5a": "Number of participants who had an initial Low Dose CT scan performed",
    "5b": "Number of participants who did not attend their initial Low Dose CT scan",
    "5d": "Number of participants who have had a 3 month follow up nodule surveillance LDCT scan performed",
    "5e": "Number of participants who have had a 12 month follow up nodule surveillance LDCT scan performed",
    "5f": "Number of participants who have had a 24 month incident screening round LDCT scan performed",
    "5g": "Number of participants who have had a 48 month incident screening round LDCT scan performed",
    "5h": "Number of participants who had a nodule surveillance LDCT scan performed from a 24 month incident screening round scan onwards",
    "7": "Number of patients with incidental findings",
    "7a": "Number of patients with incidental findings - consolidation",
    "7b": "Number of patients with incidental findings - tuberculosis",
    "7c": "Number of patients with incidental findings - mediastinal mass",
    "7d": "Number of patients with incidental findings - coronary calcification",
    "7e": "Number of patients with incidental findings - aortic valve calcification",
    "7f": "Number of patients with incidental findings - thoracic aortic aneurysm",
    "7g": "Number of patients with incidental findings - pleural effusions/thickening",
    "7h": "Number of patients with incidental findings - suspicious breast lesion",
    "7i": "Number of patients with incidental findings - thyroid lesion",
    "7j": "Number of patients with incidental findings - liver or splenic lesions",
    "7k": "Number of patients with incidental findings - renal lesions",
    "7l": "Number of patients with incidental findings - adrenal lesions",
    "7m": "Number of patients with incidental findings - abdominal aortic aneurysm",
    "7n": "Number of patients with incidental findings - bone abnormalities",
    "7o": "Number of patients with incidental findings - osteoporosis",
    "7p": "Number of patients with incidental findings - fractures with no trauma history",
    "7q": "Number of patients with incidental findings - bronchiectasis",
    "7r": "Number of patients with incidental findings - respiratory bronchiolitis",
    "7s": "Number of patients with incidental findings - interstitial lung abnormalities (ilas)",
    "7t": "Number of patients with incidental findings - other cancers",
    "7t_alt": "Number of patients with incidental findings - other cancers",
    "7u": "Number of patients with incidental findings - emphysema",
    "8b": "Number of participants who were offered the option of a smoking cessation course",
    "8a": "Number of participants who took up a smoking cessation course",
    "9": "Number of participants who completed a smoking cessation course",
    "10": "Median time from initial invite to lung health check (days)",
    "11": "Median time from initial invite to CT scan (days)",
    "12": "Median time from lung health check to CT scan (days)",
    "13": "Median time from initial invite to cancer diagnosis (days)",
    "14a": "Number of participants referred to the Lung Cancer pathway following their Low Dose CT scan",
}

# Metric ids with the rule of each.
METRICS: list[Metric] = [
    Metric("1a", "invites", ("first_letter_month",),
           lambda: counted(True)),
    Metric("1c", "invites", ("second_letter_month", "follow_up_call_month"),
           lambda: counted(True)),
    Metric("2", "invites", ("outcome_month",),
           lambda: counted(True) & (F.col("accepted") == "Accepted")),
    Metric("3a", "first_checks", ("check_month",),
           lambda: F.col("delivery_category") == "F2F"),
    Metric("3b", "first_checks", ("check_month",),
           lambda: F.col("delivery_category") == "Virtual"),
    Metric("3c", "checks", ("check_month",),
           lambda: _missed("F2F")),
    Metric("3d", "checks", ("check_month",),
           lambda: _missed("Virtual")),
    Metric("4a", "measurements", ("check_month",),
           lambda: counted(True) & _high_risk()),
    Metric("4b", "measurements",
           ("check_month",), lambda: counted(True) & _high_risk() & _has("exclusion")),
    Metric("5a", "scans", ("scan_month",),
           lambda: _scan(False, "Initial scan")),
    Metric("5b", "scans", ("scan_month",),
           lambda: _scan(False, outcome=vocab.MISSED_SCAN) & (F.col("days_from_first") < 0)),
    Metric("5d", "scans", ("scan_month",),
           lambda: _scan(False, "3 month follow-up scan")),
    Metric("5e", "scans", ("scan_month",),
           lambda: _scan(False, "12 month follow-up scan")),
    Metric("5f", "scans", ("scan_month",),
           lambda: _scan(False, "24 month follow-up scan")),
    Metric("5g", "scans", ("scan_month",),
           lambda: _scan(False, "48 month follow-up scan")),
    Metric("5h", "scans", ("scan_month",),
           lambda: _scan(False, "2-year+ nodule surveillance")),
    *[Metric(i, "other_findings", ("scan_month",),
             lambda t=t, d=d: _close(t, d)) for i, t, d in vocab.OTHER_FINDING_METRICS],
    Metric("7q", "pulmonary_findings", ("scan_month",),
           lambda: _close("bronchiectasis", 0.2)),
    Metric("7r", "pulmonary_findings", ("scan_month",),
           lambda: _close("respiratory bronchiolitis", 0.2)),
    Metric("7s", "pulmonary_findings",
           ("scan_month",), lambda: _close("interstitial lung abnormalities (ilas)", 0.2) | _close("ila", 0.2)),
    Metric("7t_alt", "scans", ("scan_month",),
           lambda: _scan(True) & _has("other_referral_date"), needs=("eligibility",)),
    Metric("7u", "scans", ("scan_month",),
           lambda: _scan(True) & F.upper("Emphysema_Extent").rlike("MODERATE|SEVERE"), needs=("eligibility",)),
    Metric("8b", "smoking", ("offered_month",),
           lambda: counted(True)),
    Metric("8a", "smoking", ("started_month",),
           lambda: counted(True) & _has("offered_month")),
    Metric("9", "smoking", ("ended_month",),
           lambda: counted(True) & _has("offered_month") & _has("started_month") & (F.col("completed") == "YES")),
    Metric("10", "first_checks", ("check_month",),
           lambda: F.lit(True), lambda: dates.days_between("first_letter_date", "check_date")),
    Metric("11", "scans", ("scan_month",),
           lambda: _scan(True, "Initial scan"), lambda: dates.days_between("first_letter_date", "scan_date"), needs=("eligibility",)),
    Metric("12", "scans", ("scan_month",),
           lambda: _scan(True, "Initial scan"), lambda: dates.days_between("check_date", "scan_date"), needs=("eligibility", "first_check")),
    Metric("13", "diagnostics", ("diagnosis_month",),
           lambda: counted(True), lambda: dates.days_between("first_letter_date", "diagnosis_date")),
    Metric("14a", "scans", ("lung_referral_month",),
           lambda: _scan(True) & _high_risk(), needs=("eligibility", "risk")),
]
BY_ID = {m.id: m for m in METRICS}

# Metric 7 counts a person with any of these.
ANY_FINDING = ["7a", "7b", "7c", "7d", "7e", "7f", "7g", "7h", "7i", "7j", "7k", "7l", "7m", "7n", "7o", "7p",
               "7q", "7r", "7s", "7t_alt", "7u"]
ANY_NAME = NAMES["7"]


def _entries(base: DataFrame, metrics: Sequence[Metric], programme: str, keep: Sequence[str] = ()) -> DataFrame:
    """One row per (row, metric met, month); days only for the median metrics.

    The condition of a single metric also filters the rows, so that Spark takes it to where its columns come from.
    """
    found = []
    for m in metrics:
        days = m.days() if m.days else F.lit(None).cast("int")
        ok = m.where() if m.days is None else m.where() & (days >= 0)
        for month in m.months:
            found.append(F.when(ok & F.col(month).isNotNull(), F.struct(
                F.lit(m.id).alias("metric_id"), F.lit(m.name(programme)).alias("metric_name"),
                F.col(month).alias("month"), days.alias("days"))))
    keep = [c for c in keep if c not in ("ParticipantID", "project")]
    if len(metrics) == 1:
        base = base.filter(ok & reduce(lambda a, b: a | b, [F.col(month).isNotNull() for month in m.months]))
    return (base.select("ParticipantID", "project", *keep, F.explode(F.array_compact(F.array(*found))).alias("_e"))
            .select("ParticipantID", "project", "_e.*", *keep))


def records(cohort: Cohort, metric_id: str, keep: Sequence[str] = ()) -> DataFrame:
    """Record level evidence of one metric."""
    if metric_id == "7":
        return any_finding_records(cohort)
    m = BY_ID[metric_id]
    return _entries(m.frame(cohort, keep), [m], cohort.programme, keep)


def any_finding_records(cohort: Cohort) -> DataFrame:
    parts = _by_base(cohort, [BY_ID[i] for i in ANY_FINDING])
    return parts.withColumns({"metric_id": F.lit("7"), "metric_name": F.lit(ANY_NAME)})


def _by_base(cohort: Cohort, metrics: Sequence[Metric]) -> DataFrame:
    if any(m.base == "scans" and len(m.needs) > 1 for m in metrics):
        _ = cohort.scans  # one full scan frame serves all scan and finding metrics
    bases: dict[str, list[Metric]] = {}
    for m in metrics:
        bases.setdefault(m.base, []).append(m)
    return reduce(DataFrame.unionByName, [
        _entries(cohort.scan_frame(sorted({n for m in ms for n in m.needs})) if b == "scans" else getattr(cohort, b), ms, cohort.programme)
        for b, ms in bases.items()])


def count(records: DataFrame) -> DataFrame:
    return aggregate.distinct_people(records, KEYS)


def median(records: DataFrame) -> DataFrame:
    return aggregate.median_days(records, KEYS, "days")


def metric(cohort: Cohort, metric_id: str) -> DataFrame:
    rows = records(cohort, metric_id)
    return median(rows) if metric_id in aggregate.MEDIAN_METRICS else count(rows)


def stage_submissions(df: DataFrame, retired: Sequence[str] = ()) -> DataFrame:
    """Pre-aggregated stage counts: text columns renamed, yymm months, retired projects left out."""
    named = df.select(F.col("Place").alias("project"), F.col("Date").alias("month"), F.col("MetricID").alias("metric_id"),
                      F.col("Metric").alias("metric_name"), F.col("Number").alias("numerator"))
    out = named.withColumn("month", F.to_date(F.concat(F.lit("20"), "month"), "yyyyMM"))
    out = out.withColumn("numerator", F.col("numerator").try_cast("double"))
    return out.filter(~F.coalesce(F.col("project").isin(list(retired)), F.lit(False))) if retired else out


def all_metrics(cohort: Cohort, submissions: DataFrame | None = None) -> DataFrame:
    """Every metric by project and month.

    Finding metric 7t comes with the stage submissions and is left out here.
    """
    chosen = [m for m in METRICS if m.id not in ("7t", "7t_alt")]
    entries = _by_base(cohort, [m for m in METRICS if m.id != "7t"])
    is_finding = F.col("metric_id").isin(ANY_FINDING)
    both = F.when(is_finding, F.array(
        F.struct(F.col("metric_id").alias("i"), F.col("metric_name").alias("n")),
        F.struct(F.lit("7").alias("i"), F.lit(ANY_NAME).alias("n")))).otherwise(
        F.array(F.struct(F.col("metric_id").alias("i"), F.col("metric_name").alias("n"))))
    entries = (entries.withColumn("_m", F.explode(both))
               .withColumns({"metric_id": F.col("_m.i"), "metric_name": F.col("_m.n")}).drop("_m"))
    # People (for counts) and days (for medians) collapse to distinct values with a count
    # first, so one plain aggregate in two steps serves both kinds of metric.
    is_median = F.col("metric_id").isin(aggregate.MEDIAN_METRICS)
    values = (entries.filter(F.col("metric_id").isin([m.id for m in chosen] + ["7"]))
              .withColumn("_p", F.when(~is_median, F.col("ParticipantID")))
              .groupBy(*KEYS, "_p", "days").agg(F.count(F.lit(1)).alias("_n")))
    out = (values.groupBy(*KEYS)
           .agg(F.count("_p").cast("double").alias("_c"), F.percentile("days", F.lit(0.5), F.col("_n")).alias("_d"))
           .select(*KEYS, F.when(is_median, F.col("_d")).otherwise(F.col("_c")).alias("numerator")))
    if submissions is not None:
        out = out.unionByName(submissions.select(*KEYS, "numerator"))
    return out
