"""Report tables over long metric rows (project, metric_id, month, numerator)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortwise.functions import clean, dates
from cohortwise.operators import aggregate, joins, reshape, select
from cohortwise.plans import metrics
from cohortwise.plans.cohort import counted

# Metrics in report order, and their months and financial years.
METRIC_ORDER = ["1a", "1c", "1b", "2", "3a", "3b", "3c", "3d", "4a", "4b", "5a", "5b", "5d", "5e", "5f", "5g", "5h",
                "6a", "6b", "6c", "6d", "6e", "7", "7a", "7b", "7c", "7d", "7e", "7f", "7g", "7h", "7i", "7j", "7k",
                "7l", "7m", "7n", "7o", "7p", "7q", "7r", "7s", "7t", "7u", "8b", "8a", "9", "10", "11", "12", "13", "14"]
FIRST_MONTH, LAST_MONTH = "2019-04-01", "2024-03-01"

# Columns of the project summary and the metrics each one adds up.
SUMMARY_COLUMNS = {
    "metric_1a": ["1a"],
    "metric_1c": ["1c"],
    "metric_2": ["2"],
    "metric_3ab": ["3a", "3b"],
    "metric_3a": ["3a"],
    "metric_3b": ["3b"],
    "metric_3cd": ["3c", "3d"],
    "metric_3c": ["3c"],
    "metric_3d": ["3d"],
    "metric_4a": ["4a"],
    "metric_4b": ["4b"],
    "metric_5a": ["5a"],
    "metric_5b": ["5b"],
    "metric_5def": ["5d", "5e", "5f"],
    "metric_5d": ["5d"],
    "metric_5e": ["5e"],
    "metric_5f": ["5f"],
    "metric_5adef": ["5a", "5d", "5e", "5f"],
    "metric_14": ["14"],
    "metric_6abcd": ["6a", "6b", "6c", "6d"],
    "metric_6a": ["6a"],
    "metric_6b": ["6b"],
    "metric_6c": ["6c"],
    "metric_6d": ["6d"],
    "metric_7": ["7"],
    "metric_8b": ["8b"],
    "metric_8a": ["8a"],
    "metric_9": ["9"],
}

# Rows of the ratio summary and the row each one is divided by.
RATIO_BASE = {
    "1a": "1b",
    "1c": "1b",
    "2": "1a",
    "3ab": "2",
    "3a": "2",
    "3b": "2",
    "3cd": "2",
    "3c": "2",
    "3d": "2",
    "4a": "3ab",
    "4b": "4a",
    "5a": "4a",
    "5b": "4a",
    "14": "3ab",
    "6abcd": "3ab",
    "6a": "6abcd",
    "6b": "6abcd",
    "6c": "6abcd",
    "6d": "6abcd",
    "8b": "3ab",
    "8a": "8b",
    "9": "8a",
}

# Measures that are compared between two reports.
COMPARED = {
    "1a": "invited_first",
    "3a": "attended",
    "3b": "attended",
    "5a": "initial_scan",
}


def harmonise_ids(df: DataFrame, retired_names: Sequence[str] = ()) -> DataFrame:
    """Older metric ids take their present form; retired rows go."""
    out = df.withColumn("metric_id", F.when(F.col("metric_id") == "4", "4a")
                        .when(F.col("metric_id") == "14a", "14").otherwise(F.col("metric_id")))
    return out.filter(~clean.one_of("metric_name", retired_names)) if retired_names else out


def datasheet_rows(metrics: DataFrame, adjustments: DataFrame, projects: DataFrame, until: str, months_back: int) -> DataFrame:
    """Every project month with every metric, adjusted values first, inside the reporting months."""
    grid = reshape.complete(metrics, ["project", "month"], ["metric_id", "metric_name"], "numerator")
    adjusted = joins.overlay(grid, adjustments, ["project", "month", "metric_id"], "numerator", "adjusted_numerator")
    coded = joins.lookup(adjusted, projects, "project", {"project_code": "project_code"})
    last = F.lit(until).cast("date")
    return coded.filter((F.col("month") <= last) & (F.col("month") > F.add_months(last, -months_back)))


def active_adjustments(df: DataFrame) -> DataFrame:
    return (df.filter((F.col("active") == "TRUE") & F.col("date_removed").isNull())
            .select("project", dates.month_start("month").alias("month"), "metric_id",
                    F.col("numerator").alias("adjusted_numerator")))


def fill_template(projects: DataFrame, metrics: Sequence[str], start: str, end: str, submitted: DataFrame) -> DataFrame:
    """All expected rows with what was submitted; a project's code, month and metric are the key."""
    expected = joins.template(
        projects.select(F.col("project_code"), "project", "phase", "start_date", "eligible_population", "CACode", "CAName"),
        metrics, start, end)
    return expected.join(submitted.select("project_code", "month", "metric_id", "numerator"),
                         ["project_code", "month", "metric_id"], "left")


def flat_file(rows: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Published layout: no medians, official metric names."""
    label = clean.recode("metric_id", {v: [k] for k, v in names.items()}, F.lit(None).cast("string"))
    return (rows.filter(~F.col("metric_id").isin(aggregate.MEDIAN_METRICS))
            .select("CACode", "CAName", F.col("project_code").alias("ProjectCode"), F.col("project").alias("Project"),
                    F.col("metric_id").alias("MetricId"), label.alias("Metric"), "month",
                    F.col("numerator").alias("Numerator")))


def published_names(programme: str = "PROGRAMME") -> dict[str, str]:
    """Published name of each metric of the template that has one; ids are those of the template."""
    return {i: metrics.NAMES[old].format(programme=programme) for i, old in ((i, "14a" if i == "14" else i) for i in METRIC_ORDER) if old in metrics.NAMES}


def _metric_order() -> Column:
    return clean.level_order("metric_id", METRIC_ORDER)


def metric_table(df: DataFrame, group: Sequence[str], strict: bool, first: str = FIRST_MONTH, last: str = LAST_MONTH,
                 projects: DataFrame | None = None) -> DataFrame:
    """Total, financial year and month columns per metric for each group, in one pass.

    projects adds row 1b: the eligible population as the total, and nothing in the years and months.
    first and last bound the reported months; totals, years and months are of these rows alone.
    Medians have no totals. strict carries a missing month through, as the project
    version does. The months become columns last, from already aggregated rows.
    """
    median = F.col("metric_id").isin(aggregate.MEDIAN_METRICS)
    rows = (df.select(*group, "metric_id", "month", "numerator", dates.financial_year("month").alias("_fy"))
            .filter(F.col("month").between(F.lit(first).cast("date"), F.lit(last).cast("date"))))
    monthly = (rows.groupBy(*group, "metric_id", "_fy", "month")
               .agg(F.sum("numerator").alias("_s"), F.median("numerator").alias("_m"),
                    F.count(F.when(F.col("numerator").isNull(), 1)).alias("_missing")))
    value = F.when(median, F.col("_m")).otherwise(F.coalesce(F.col("_s"), F.lit(0)).cast("double"))
    if strict:
        value = F.when(F.col("_missing") == 0, F.when(median, F.col("_m")).otherwise(F.col("_s").cast("double")))
    monthly = monthly.withColumn("_v", value)
    years = [F.when(~median, F.coalesce(F.sum(F.when(F.col("_fy") == y, F.col("_s"))), F.lit(0)).cast("double"))
             .alias("fy_" + y.replace("-", "_")) for y in fin_years(first, last)]
    months = [F.max(F.when(F.col("month") == F.lit(m).cast("date"), F.col("_v"))).alias("m_" + m[:7].replace("-", "_"))
              for m in month_list(first, last)]
    unit = F.when(median, "Days").otherwise("People").alias("unit")
    total = F.when(~median, F.coalesce(F.sum("_s"), F.lit(0)).cast("double")).alias("total")
    table = monthly.groupBy(*group, "metric_id").agg(unit, total, *years, *months)
    if projects is None:
        return table
    people = (projects.groupBy(*group).agg(F.sum("eligible_population").cast("double").alias("total"))
              .withColumns({"metric_id": F.lit("1b"), "unit": F.lit("People"), **{"fy_" + y.replace("-", "_"): F.lit(0.0) for y in fin_years(first, last)}}))
    return table.filter("metric_id <> '1b'").unionByName(people, allowMissingColumns=True)


def fin_years(first: str, last: str) -> list[str]:
    """Financial years (April to March) from that of one month to that of another."""
    start = lambda m: int(m[:4]) - (int(m[5:7]) < 4)
    return [f"{y}-{(y + 1) % 100:02d}" for y in range(start(first), start(last) + 1)]


def month_list(first: str, last: str) -> list[str]:
    y, m = int(first[:4]), int(first[5:7])
    out = []
    while f"{y:04d}-{m:02d}-01" <= last:
        out.append(f"{y:04d}-{m:02d}-01")
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


def _sum_of(ids: Sequence[str], name: str) -> Column:
    return F.sum(F.when(F.col("metric_id").isin(list(ids)), F.coalesce("numerator", F.lit(0.0)))).alias(name)


def contents(df: DataFrame, projects: DataFrame) -> DataFrame:
    """Invited, attended, uptake, scans, cancers and the new-data flag per project, with a total row."""
    sums = df.groupBy("project").agg(
        _sum_of(["1a"], "invited"), _sum_of(["3a", "3b"], "attended"), _sum_of(["5a"], "scans"),
        _sum_of(["6a", "6b", "6c", "6d"], "cancers"))
    rows = (projects.select("project", "phase", dates.month_label("start_date").alias("start"), "eligible_population")
            .join(sums, "project", "left")
            .join(aggregate.new_data_flag(df, "project"), "project", "left"))
    total = rows.groupBy().agg(*[F.sum(c).alias(c) for c in ["eligible_population", "invited", "attended", "scans", "cancers"]])
    total = total.withColumn("project", F.lit("Total"))
    out = reshape.union_all([rows, total])
    return out.withColumn("uptake", clean.ratio("attended", "invited"))


# Stage metrics.
STAGES = {"stage_1": "6a", "stage_2": "6b", "stage_3": "6c", "stage_4": "6d", "unstageable": "6e"}


def stage_table(df: DataFrame, by: str, shares: bool) -> DataFrame:
    out = df.groupBy(by).agg(_sum_of(list(STAGES.values()), "total"), *[_sum_of([i], n) for n, i in STAGES.items()])
    out = out.filter(F.col("total").isNotNull())
    return out.withColumns({f"{n}_perc": clean.ratio(n, "total") for n in STAGES}) if shares else out


def project_summary(df: DataFrame, projects: DataFrame) -> DataFrame:
    """Metric combinations per project, and for the original, later and all projects.

    A row of data adds to its project and to its two groups; one grouping does it all.
    """
    phase = joins.lookup(df, projects, "project", {"phase": "phase"})
    group = F.when(F.col("phase") == "Original", "Original").when(F.col("phase").isNotNull(), "Onboarded / Phase 3")
    rows = phase.select("metric_id", "numerator", F.explode(F.concat(
        F.array("project"), F.array_compact(F.array(group, F.lit("Total"))))).alias("row"))  # rows without a project are a row of their own
    pop = projects.select(F.col("eligible_population").alias("n"), F.explode(F.array(
        F.col("project"), F.when(F.col("phase") == "Original", "Original").otherwise("Onboarded / Phase 3"),
        F.lit("Total"))).alias("row")).groupBy("row").agg(F.sum("n").cast("double").alias("metric_1b"))
    sums = rows.groupBy("row").agg(*[_sum_of(ids, name) for name, ids in SUMMARY_COLUMNS.items()])
    return joins.null_safe(pop, sums, ["row"], "full")


def ratio_summary(df: DataFrame, projects: DataFrame) -> DataFrame:
    """Totals of the metric combinations with the total each one is measured against."""
    combos = {n.removeprefix("metric_"): ids for n, ids in SUMMARY_COLUMNS.items()}
    members = F.array(*[F.struct(F.lit(k).alias("row_id"), F.lit(i).alias("metric_id")) for k, ids in combos.items() for i in ids])
    pairs = df.sparkSession.range(1).select(F.explode(members).alias("_m")).select("_m.*")
    sums = df.groupBy("metric_id").agg(F.sum("numerator").alias("n"))
    total = (F.broadcast(pairs).join(sums, "metric_id", "left").groupBy("row_id")
             .agg(F.coalesce(F.sum("n"), F.lit(0.0)).cast("double").alias("number")))
    people = projects.agg(F.sum("eligible_population").cast("double").alias("number")).withColumn("row_id", F.lit("1b"))
    numbers = total.unionByName(people.select("row_id", "number"))
    base = clean.recode("row_id", _invert(RATIO_BASE), F.lit(None).cast("string"))
    left = numbers.withColumn("base_id", base)
    right = numbers.select(F.col("row_id").alias("base_id"), F.col("number").alias("denominator"))
    return left.join(right, "base_id", "left").withColumn("value", clean.ratio("number", "denominator")).drop("base_id")


def _invert(mapping: Mapping[str, str]) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for k, v in mapping.items():
        out.setdefault(v, []).append(k)
    return out


def demographic_pivot(records: DataFrame, attribute: str, values: Sequence[str]) -> DataFrame:
    """Distinct people by project and one attribute, wide, with totals."""
    named = records.select("project", "ParticipantID", F.coalesce(F.col(attribute).cast("string"), F.lit("Not known")).alias("_a"))
    return aggregate.pivot_with_totals(named, "project", "_a", values, F.countDistinct("ParticipantID"))


def demographic_long(records: DataFrame, attributes: Mapping[str, str]) -> DataFrame:
    """Distinct people by project, metric and each attribute from one scan."""
    cells = F.array(*[F.struct(F.lit(label).alias("demographic"),
                               F.coalesce(F.col(c).cast("string"), F.lit("Not known")).alias("demographic_value"))
                      for label, c in attributes.items()])
    return (records.select("project", "metric_id", "ParticipantID", F.explode(cells).alias("_c"))
            .groupBy("project", "metric_id", "_c.demographic", "_c.demographic_value")
            .agg(F.countDistinct("ParticipantID").alias("participants"))
            .filter(F.col("demographic_value") != "Age below zero"))


def demographic_flatfile(counts: DataFrame) -> DataFrame:
    """Counts on the full grid of project and attribute value, per metric and attribute.

    The values of an attribute are a short list of levels, so they travel as one array
    per metric and attribute and unfold on its projects.
    """
    by = ["metric_id", "demographic"]
    values = counts.groupBy(*by).agg(F.collect_set("demographic_value").alias("_v"))
    grid = (counts.select(*by, "project").distinct().join(values, by)
            .select(*by, "project", F.explode("_v").alias("demographic_value")))
    return joins.null_safe(grid, counts, [*by, "project", "demographic_value"], "left")


def overview(metric_frames: Mapping[str, DataFrame]) -> DataFrame:
    """Distinct people by sex, age band, ethnic group, decile and metric."""
    fill = lambda c: F.coalesce(F.col(c), F.lit("Not known")).alias(c)
    parts = [f.select(F.lit(name).alias("metric_name"), fill("sex"), fill("age_band_five"), fill("ethnic_group"),
                      "imd_decile", "ParticipantID") for name, f in metric_frames.items()]
    return (reshape.union_all(parts).groupBy("metric_name", "sex", "age_band_five", "ethnic_group", "imd_decile")
            .agg(F.countDistinct("ParticipantID").alias("participants")))


def comparison_rows(flat: DataFrame, renamed: Mapping[str, str] | None = None) -> DataFrame:
    """Rows of a published flat file that are compared, with their measure."""
    rows = flat.filter(F.col("MetricId").isin(list(COMPARED)))
    rows = rows.withColumn("measure", clean.recode("MetricId", _invert(COMPARED)))
    if renamed:
        rows = rows.withColumn("Project", clean.recode("Project", {v: [k] for k, v in renamed.items()}))
    return rows.select("Project", "month", "measure", "Numerator")


def report_difference(current: DataFrame, last: DataFrame) -> DataFrame:
    """current - last by project, month and measure; what one report lacks counts as 0."""
    keys = ["Project", "month", "measure"]
    total = lambda df, name: df.groupBy(*keys).agg(F.coalesce(F.sum("Numerator"), F.lit(0)).alias(name))
    out = joins.null_safe(total(current, "current_value"), total(last, "last_value"), keys, "full").fillna(0, ["current_value", "last_value"])
    return out.withColumn("difference", F.col("current_value") - F.col("last_value"))


def submission_headers(df: DataFrame, label: str, pattern: str, since: str) -> DataFrame:
    """Distinct recent submissions of one table at their project's last receipt.

    Rows become headers first, so the later steps see submissions, not records.
    """
    heads = select.recent_headers(df, since, ["SubmittedFile", "ReceivedDate", "TransactionId", "UserEmail"])
    heads = heads.withColumn("table_name", F.lit(label)).withColumn("project_code", project_code("SubmittedFile", pattern))
    return select.latest_submission(heads, "project_code")


def project_code(c, pattern: str) -> Column:
    """Three to five word characters before the pattern, without the affixes."""
    found = F.regexp_extract(F.upper(c), r"_?(\w{3,5})" + pattern, 0)
    return clean.replace_first(clean.replace_first(F.when(found != "", found), pattern, ""), "_", "")


def submission_pivot(headers: DataFrame, tables: Sequence[str], value: str, fill: str | None, projects: DataFrame | None = None) -> DataFrame:
    """One row per submission and project, one column per table; projects adds the project's name."""
    wide = reshape.to_wide(headers, ["TransactionId", "project_code"], "table_name", tables, F.max(value), fill)
    if projects is None:
        return wide
    return wide.join(projects.groupBy("project_code").agg(F.min("project").alias("project")), "project_code", "left")


def submitter_adjustment(invites: DataFrame, since: str) -> DataFrame:
    """One submitter's follow-ups and acceptances by month, next to each other."""
    start = F.lit(since).cast("date")
    letters = invites.select("ParticipantID", F.explode(F.array(
        F.when(F.col("first_letter_date") >= start, F.col("first_letter_month")),
        F.when(F.col("second_letter_date") >= start, F.col("second_letter_month")))).alias("month")).filter("month IS NOT NULL")
    followups = aggregate.distinct_people(letters, ["month"], out="followup_invitations")
    accepted = invites.filter(counted(True) & (F.col("accepted") == "Accepted") & F.col("outcome_month").isNotNull())
    accepted = aggregate.distinct_people(
        accepted.withColumn("month", F.greatest("first_letter_month", "second_letter_month")), ["month"], out="accepted_invitations")
    return followups.join(accepted, "month", "full").filter(F.col("month") >= dates.month_start(start))
