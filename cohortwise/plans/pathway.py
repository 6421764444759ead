"""Pathway evaluation: who, when, what followed, and how people flow between stages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortwise.functions import clean, dates
from cohortwise.operators import aggregate, joins, reshape, select, windows
from cohortwise.plans import vocab
from cohortwise.plans.cohort import Cohort, counted

ID = "ParticipantID"
# Submitted tables and their short names in the list of a person's tables.
TABLES = {"invite": "invite", "history": "oh", "check": "lhc", "measurement": "meas", "scan": "ldct", "diagnostics": "diag",
          "smoking": "smoking"}


def _window(c) -> Column:
    return F.col(c).isNotNull() & dates.in_window(c, *vocab.WINDOW)


def people(cohort: Cohort) -> DataFrame:
    """One row per person of the reported phases: projects, most frequent project, tables.

    Rows are counted per person, submitter and table before anything is joined or gathered: table by table, since the rows of
    each lie by person.
    """
    count = lambda rows: rows.filter(F.length(ID) >= 60).groupBy(ID, "org_code").agg(F.count(F.lit(1)).alias("n"))
    counts = reshape.union_all([count(cohort.current(t, by_person=True).select(ID, "org_code")).withColumn("table", F.lit(n)) for t, n in TABLES.items()])
    known = counts.join(cohort.people.select(ID, "ccg_code"), ID)
    named = joins.name_projects(known, cohort.lookups["project_names"])
    reported = cohort.lookups["projects"].filter(F.col("phase").isin(vocab.REPORTED_PHASES))
    counts = select.members(named, reported, "project")
    per_project = counts.groupBy(ID, "project").agg(F.sum("n").alias("n"), F.collect_set("table").alias("t"))
    return per_project.groupBy(ID).agg(
        F.array_join(F.array_sort(F.collect_list("project")), ", ").alias("projects"),
        F.min(F.struct((-F.col("n")).alias("n"), F.col("project").alias("p"))).getField("p").alias("project_mode"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("t")))), ", ").alias("tables"))


def first_invites(cohort: Cohort, pool: DataFrame) -> DataFrame:
    """Earliest invitation date in the programme window, else the check date of the uninvited."""
    low, high = (F.lit(d).cast("date") for d in vocab.WINDOW)
    inside = F.filter(F.array("first_letter_date", "second_letter_date", "follow_up_call_date", "contact_date"),
                      lambda d: (d >= low) & (d < high))
    own = cohort.clean_invites.select(ID, F.array_min(inside).alias("date"))
    inferred = cohort.checks.filter(F.col("first_letter_date").isNull() & _window("check_date")).select(
        ID, F.col("check_date").alias("date"))
    both = own.unionByName(inferred).filter(F.col("date").isNotNull())
    return select.members(both, pool, ID).groupBy(ID).agg(F.min("date").alias("date"))


def first_checks(cohort: Cohort, pool: DataFrame) -> DataFrame:
    """First attended check, else the first scan date of people who have no such check."""
    own = cohort.checks.filter(counted(False) & _window("check_date") & (F.col("attendance_category") == "Attended"))
    scans = cohort.clean_scans.filter(counted(False) & F.col("scan_month").isNotNull() & _window("scan_date"))
    both = (own.select(ID, F.col("check_date").alias("own"), F.lit(None).cast("date").alias("other"))
            .unionByName(scans.select(ID, F.lit(None).cast("date").alias("own"), F.col("scan_date").alias("other"))))
    return (select.members(both, pool, ID).groupBy(ID)
            .agg(F.coalesce(F.min("own"), F.min("other")).alias("date")))


def scan_events(cohort: Cohort, pool: DataFrame) -> DataFrame:
    scans = cohort.clean_scans.filter(
        counted(False) & F.col("scan_month").isNotNull() & (F.col("scan_outcome") == vocab.PERFORMED) & _window("scan_date"))
    event = F.when(F.col("scan_category") == "Not classified", "Other scan").otherwise(F.col("scan_category"))
    return select.members(scans, pool, ID).select(ID, F.col("scan_date").alias("date"), event.alias("event")).distinct()


def risk_of(cohort: Cohort) -> DataFrame:
    meas = cohort.clean_measurements
    high = F.coalesce(F.col("llp_risk") == "High risk", F.lit(False)) | F.coalesce(F.col("plco_risk") == "High risk", F.lit(False))
    return meas.groupBy(ID).agg(F.max(high).alias("_high"))


def timeline(cohort: Cohort, pool: DataFrame) -> DataFrame:
    """(person, event, date) of first invite, first check with its risk, and scans."""
    invites = first_invites(cohort, pool).withColumn("event", F.lit("Invite date"))
    checks = first_checks(cohort, pool).join(risk_of(cohort), ID, "left")
    checks = checks.withColumn("event", F.when(F.col("_high"), "LHC Date high risk").otherwise("LHC Date low risk")).drop("_high")
    return reshape.union_all([invites, checks, scan_events(cohort, pool)])


def people_events(cohort: Cohort) -> DataFrame:
    """Every person of the pool with their events, the event month and a key per event."""
    pool = cohort.stage(people(cohort), "pool", ID, placed=True)
    keyed = windows.event_run_id(timeline(cohort, pool), ID, "date", "event").drop("run")
    return (pool.join(keyed, ID, "left")
            .withColumn("event_key", F.coalesce("event_key", F.concat(F.col(ID), F.lit("#1"))))
            .withColumn("event_month", dates.month_start("date")))


def link_diagnoses(events: DataFrame, diagnoses: DataFrame) -> DataFrame:
    """Each diagnosis on the nearest event on or before it; flag for check or later.

    Diagnoses are joined to what was found before the events are. An event's key holds its person, so events stay where they lie.
    """
    order = clean.level_order("event", vocab.EVENT_ORDER)
    found = joins.prior_event(events, diagnoses.withColumn("diagnosis_date", F.col("diagnosis_date").cast("date")),
                              ID, "event_key", "date", order, "pk", "diagnosis_date", with_person=True)
    before_check = F.col("event").isin("Invite date", "LHC Date low risk")
    return (events.join(found.join(diagnoses.drop(ID), "pk", "left"), [ID, "event_key"], "left")
            .withColumn("at_check_or_later", F.when(F.col("pk").isNotNull(), ~before_check)))


def funnel_steps(cohort: Cohort) -> DataFrame:
    """Distinct people after each step of building the timeline."""
    pool = cohort.stage(people(cohort), "pool", ID, placed=True)
    events = cohort.stage(timeline(cohort, pool), "timeline")
    kind = lambda cond: events.filter(cond)
    return aggregate.funnel([
        ("people", pool), ("invites", kind(F.col("event") == "Invite date")), ("checks", kind(F.col("event").startswith("LHC Date"))),
        ("scans", kind(F.col("event").endswith("scan") | F.col("event").endswith("surveillance"))), ("events", events)])


# --- person milestones

def invite_outcome(c) -> Column:
    return clean.classify(c, vocab.INVITE_OUTCOME, "No response")


def invite_sequence(df: DataFrame) -> DataFrame:
    """Outcome of the first, second and third invitation after gaps in the dates are closed."""
    second = F.coalesce("second_letter_date", "follow_up_call_date")
    first = F.coalesce("first_letter_date", "second_letter_date", "follow_up_call_date")
    third = F.col("follow_up_call_date")
    say = lambda i, this, following: F.when(this.isNotNull() & following.isNotNull(), f"Invite {i} No response").when(
        this.isNotNull(), F.concat(F.lit(f"Invite {i} "), F.col("_outcome")))
    return (df.withColumn("_outcome", invite_outcome("Invite_Outcome"))
            .withColumns({"invite_1": say(1, first, second), "invite_2": say(2, second, third),
                          "invite_3": F.when(third.isNotNull(), F.concat(F.lit("Invite 3 "), F.col("_outcome"))),
                          "invite_outcome": F.concat(F.lit("Invite "), F.col("_outcome"))})
            .drop("_outcome"))


# Check outcomes in order, best first.
CHECK_OUTCOME = {"Attended": "LHC Attended", "Partially attended": "LHC Incomplete", "DNA": "LHC DNA"}


def check_summary(checks: DataFrame) -> DataFrame:
    """Contacts, methods and best outcome per person, with cut-off flags of the last check."""
    used = checks.filter(counted(True) & F.col("check_month").isNotNull()
                         & (F.col("attendance_category") != "NULL response")
                         & ~F.col("delivery_category").isin("NULL response", "NOT CODED"))
    rank = F.when(F.col("attendance_category") == "Attended", 1).when(
        F.col("attendance_category") == "Partially attended", 2).when(F.col("attendance_category") == "DNA", 3)
    per = used.withColumn("_rank", rank).groupBy(ID).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_rank").alias("_best"), F.count("_rank").alias("_known"),
        F.max("check_date").alias("_last"),
        F.array_join(F.array_sort(F.collect_set("delivery_category")), ", ").alias("methods"))
    # an outcome that could not be coded makes the overall outcome unknown
    outcome = F.when(F.col("_known") == F.col("_n"), F.element_at(
        F.array(*[F.lit(v) for v in CHECK_OUTCOME.values()]), F.col("_best")))
    end = F.lit(vocab.OUTCOME_END).cast("date")
    before = lambda days: F.when(F.col("attendance") == "LHC Attended", F.col("_last") <= F.date_sub(end, days))
    return (per.withColumn("attendance", F.coalesce(outcome, F.lit("No LHC")))
            .withColumns({"contact_group": clean.cut("_n", [0, 1, 2], ["0 x contacts", "1 x contacts", "2 x contacts", "3+ contacts"]),
                          "check_before_end": before(0), "check_before_end_185": before(185), "check_before_end_45": before(45)})
            .drop("_n", "_best", "_known", "_last"))


def measurement_summary(measurements: DataFrame) -> DataFrame:
    high = (F.col("llp_risk") == "High risk") | (F.col("plco_risk") == "High risk")
    risk = F.when(high, "High risk").when(F.col("llp_risk").isNotNull() | F.col("plco_risk").isNotNull(), "Low risk")
    referral = F.when(F.col("risk") == "High risk",
                      F.when(F.col("exclusion").isNull(), "LDCT: referred").otherwise("LDCT: ineligible"))
    return measurements.filter(counted(True)).withColumn("risk", risk).withColumn("referral", referral).select(ID, "risk", "referral")


def valid_scans(scans: DataFrame) -> DataFrame:
    return scans.filter(counted(False) & F.col("scan_month").isNotNull() & (F.col("scan_outcome") == vocab.PERFORMED))


def scan_summary(scans: DataFrame) -> DataFrame:
    return (valid_scans(scans).groupBy(ID).agg(F.countDistinct("scan_date").alias("_n"))
            .select(ID, clean.cut("_n", [1, 2], ["1 x scan", "2 x scans", "3+ scans"]).alias("scan_group")))


def repair_gaps(df: DataFrame) -> DataFrame:
    """Stages that must have happened, given what is recorded after or before them."""
    df = df.withColumn("risk", F.coalesce("risk", F.when(
        F.col("attendance").isNotNull() | F.col("scan_group").isNotNull(), F.lit("No risk score"))))
    df = df.withColumn("referral", F.coalesce("referral", F.when(F.col("scan_group").isNotNull(), F.lit("LDCT: unknown"))))
    return df.withColumn("attendance", F.coalesce("attendance", F.when(F.col("risk").isNotNull(), F.lit("No attendance"))))


def attribute_outcomes(linked: DataFrame, site: str = "Lung", limit: int = vocab.DAYS_LIMIT,
                       programme: str = "Programme") -> DataFrame:
    """One diagnosis per person, the closest to its event: due to the programme or not, and its stage."""
    one = select.top_per_key(linked.filter(F.col("tumour_site_group") == site), [ID],
                             [F.col("days_diff").asc_nulls_last(), F.col("pk")])
    in_time = F.col("at_check_or_later") & (F.col("days_diff") <= limit)
    outcome = F.when(in_time, f"{programme}: lung cancer").when(
        F.col("at_check_or_later").isNotNull(), "Counterfactual: lung cancer")
    stage = clean.classify("stage_group", {"S 1-2": ["1", "2"], "S 3-4": ["3", "4"]}, "S ?")
    prefix = F.when(F.col("cancer_outcome") == f"{programme}: lung cancer", f"{programme}: ").when(
        F.col("cancer_outcome").isNotNull(), "C: ")
    return (one.withColumn("cancer_outcome", outcome).withColumn("cancer_stage", F.concat(prefix, stage))
            .select(ID, "cancer_outcome", "cancer_stage"))


def name_missing_outcomes(df: DataFrame) -> DataFrame:
    return df.withColumn("cancer_outcome", F.coalesce("cancer_outcome", F.when(
        F.col("scan_group").isNull(), F.lit("No lung cancer")).otherwise(F.lit("Scanned: No lung cancer"))))


def awaiting_flags(scans: DataFrame, end: str = vocab.OUTCOME_END, limit: int = vocab.DAYS_LIMIT) -> DataFrame:
    """Was the person's last scan too close to the end of the outcome data?"""
    cut = F.date_sub(F.lit(end).cast("date"), limit)
    return (valid_scans(scans).groupBy(ID).agg(F.max("scan_date").alias("last_scan"))
            .withColumn("awaiting", dates.days_between("last_scan", cut) <= 0))


def flag_awaiting(df: DataFrame, scans: DataFrame, end: str = vocab.OUTCOME_END, limit: int = vocab.DAYS_LIMIT) -> DataFrame:
    return (df.join(awaiting_flags(scans, end, limit).drop("last_scan"), ID, "left")
            .withColumn("cancer_outcome", F.when(
                (F.col("cancer_outcome") == "Scanned: No lung cancer") & F.col("awaiting"), "Scanned: Awaiting results")
                .otherwise(F.col("cancer_outcome"))).drop("awaiting"))


def smoking_status(people: DataFrame, measurements: DataFrame, smoking: DataFrame, checks: DataFrame) -> DataFrame:
    """Offered help at measurement, then in the smoking table, then a recorded quit date or period."""
    offer = F.trim("Smoking_Cessation_Offered")
    offered = measurements.filter(offer.isNotNull() & ~F.lower(offer).contains("current")
                                  & ~offer.isin("NA", "NULL", "", "No", "N"))
    in_table = smoking.filter(F.col("Date_Offered_Smoking_Cessation").isNotNull())
    stopped = F.col("Date_Stopped_Smoking").isNotNull() & ~F.col("Date_Stopped_Smoking").isin("0", "N/A", "00:00.0", "12:00:00 AM")
    quit = (F.col("Total_Quit_Period") > 0) | (stopped & (F.coalesce(F.col("Total_Quit_Period"), F.lit(0.0)) == 0))
    previous = checks.filter(quit)
    mark = lambda df, rank: df.select(ID, F.lit(rank).alias("_s"))
    marks = reshape.union_all([mark(offered, 1), mark(in_table, 1), mark(previous, 2)]).groupBy(ID).agg(F.min("_s").alias("_s"))
    return (people.select(ID).distinct().join(marks, ID, "left")
            .select(ID, F.when(F.col("_s") == 1, "Current smoker").when(F.col("_s") == 2, "Previous smoker")
                    .otherwise("Unknown").alias("smoking_status")))


def milestones(cohort: Cohort, diagnoses: DataFrame, limit: int = vocab.DAYS_LIMIT, programme: str = "Programme",
               end: str = vocab.OUTCOME_END) -> DataFrame:
    """One row per invited person of the pool with every stage of the pathway."""
    events = cohort.stage(people_events(cohort), "events", ID, placed=True)
    linked = link_diagnoses(events, cohort.stage(diagnoses, "diagnoses", ID, placed=True))
    base = invite_sequence(select.members(cohort.invites, events, ID)).select(
        ID, "project", F.lit("GP eligible population").alias("eligible_population"), "invite_1", "invite_2", "invite_3",
        "invite_outcome", "imd_decile", "rurality", "ethnic_group", "sex", "age_band_eval")
    status = smoking_status(base, cohort.current("measurement"), cohort.current("smoking"), cohort.current("check"))
    out = (joins.lookup(base.join(status, ID, "left"), cohort.lookups["projects"], "project",
                        ["phase", "CAName", "invite_mode", "lhc_delivery", "triage_before_risk_assessment", "admin"])
           .join(check_summary(cohort.checks), ID, "left")
           .join(measurement_summary(cohort.with_person(cohort.clean_measurements, ["eligibility"])), ID, "left")
           .join(scan_summary(cohort.clean_scans), ID, "left"))
    out = repair_gaps(out).join(attribute_outcomes(linked, limit=limit, programme=programme), ID, "left")
    return flag_awaiting(name_missing_outcomes(out), cohort.clean_scans, end, limit)


def cube(milestone_rows: DataFrame) -> DataFrame:
    return aggregate.collapse_person(milestone_rows, ID)


# --- flows

# Origin, destination and the outcome used where the destination is missing.
FLOW_STEPS = [
    ("eligible_population", "invite_1", "invite_outcome"),
    ("invite_1", "invite_2", "invite_outcome"),
    ("invite_2", "invite_3", "invite_outcome"),
    ("invite_3", "invite_outcome", "invite_outcome"),
    ("invite_outcome", "methods", "attendance"),
    ("methods", "contact_group", "attendance"),
    ("contact_group", "attendance", "attendance"),
    ("attendance", "risk", "referral"),
    ("risk", "referral", "referral"),
    ("referral", "scan_group", "scan_group"),
]
OUTCOME_STEPS = [
    ("scan_group", "cancer_outcome", "cancer_outcome"),
    ("cancer_outcome", "cancer_stage", "cancer_stage"),
]


def flow_edges(df: DataFrame, steps: Sequence[tuple[str, str, str]], weight: str = "participants") -> DataFrame:
    """Flow from origin to destination for every step in one pass over the cube.

    via says whether the destination itself or the outcome in its place was used.
    """
    hops = [F.when(F.col(a).isNotNull(), F.struct(
        F.lit(i).alias("step"), F.col(a).cast("string").alias("origin"),
        F.coalesce(F.col(b).cast("string"), F.col(o).cast("string")).alias("destination"),
        F.when(F.col(b).isNotNull(), "direct").otherwise("outcome").alias("via")))
        for i, (a, b, o) in enumerate(steps, 1)]
    return (df.select(weight, F.explode(F.array_compact(F.array(*hops))).alias("_h"))
            .groupBy("_h.step", "_h.origin", "_h.destination", "_h.via").agg(F.sum(weight).alias("flow")))


def flow_table(df: DataFrame, weight: str = "participants") -> DataFrame:
    """All steps of the pathway; what never arrives is named, stages only where known."""
    named = df.withColumn("scan_group", F.coalesce("scan_group", F.lit("Not scanned")))
    main = flow_edges(df, FLOW_STEPS, weight).withColumn("destination", F.coalesce("destination", F.lit("Not scanned")))
    outcome = flow_edges(named, OUTCOME_STEPS[:1], weight).withColumn("step", F.lit(len(FLOW_STEPS) + 1))
    stage = (flow_edges(df.filter(F.col("cancer_stage").isNotNull()), OUTCOME_STEPS[1:], weight)
             .withColumn("step", F.lit(len(FLOW_STEPS) + 2)))
    return reshape.union_all([main, outcome, stage])


def flow_nodes(flows: DataFrame, start: str = "GP eligible population") -> DataFrame:
    """People arriving at each node and their share of the starting population."""
    everyone = flows.filter(F.col("origin") == start).select(F.sum("flow")).scalar()
    return (flows.groupBy(F.col("destination").alias("name")).agg(F.sum("flow").alias("flow"))
            .withColumn("flow_perc", F.round(100.0 * F.col("flow") / everyone, 1)))


def filter_by(df: DataFrame, wanted: Mapping[str, Sequence]) -> DataFrame:
    for column, values in wanted.items():
        df = df.filter(F.col(column).isin(list(values)))
    return df


def breakdown(df: DataFrame, column: str, wanted: Mapping[str, Sequence], weight: str = "participants") -> DataFrame:
    """Rounded people per level after filters; levels that fall empty stay as 0."""
    levels = df.select(column).distinct()
    n = filter_by(df, wanted).groupBy(F.col(column).alias("_k")).agg(clean.round_to(F.sum(weight)).alias("n"))
    return (levels.join(n, levels[column].eqNullSafe(n["_k"]), "left").drop("_k").fillna(0, ["n"]))


# Reporting groups.
def reporting_groups(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "rpt_imd": F.when(F.col("imd_decile") <= 2, "Q1").when(F.col("imd_decile") <= 10, "Q2-5").otherwise("Not known"),
        "rpt_age": F.when(F.col("age_band_eval").isin("55-64", "65-74", "75"), F.concat("age_band_eval", F.lit("yrs")))
                    .when(F.col("age_band_eval").isin("Other", "Age below zero"), "Other").otherwise("Not known"),
        "rpt_ethnicity": clean.classify("ethnic_group", {
            "White": ["White"], "Not known": ["Not known"],
            "Other ethnicities": ["Asian or Asian British", "Black or Black British", "Mixed", "Other Ethnic Group"]}, None),
        "rpt_triage": F.when(F.col("triage_before_risk_assessment") == "Unknown", "Not known")
                       .otherwise(F.col("triage_before_risk_assessment")),
        "rpt_admin": F.when(F.col("admin") == "Unknown", "Not known").otherwise(F.col("admin")),
    })


# Groupings of the cohort's measures and their columns.
GROUPINGS = {"deprivation": "rpt_imd", "age": "rpt_age", "gender": "sex", "ethnicity": "rpt_ethnicity", "invite model": "invite_mode", "check model": "lhc_delivery",
             "triage": "rpt_triage", "admin": "rpt_admin", "alliance": "CAName", "project": "project"}


def measures_by_group(df: DataFrame, groupings: Mapping[str, str], programme: str = "Programme", weight: str = "participants") -> DataFrame:
    """The measures of every level of every grouping, and of everyone: a cell unfolds into its groups, one aggregate serves them all."""
    groups = [F.struct(F.lit("total").alias("grouping"), F.lit("Total").alias("level")),
              *[F.when(F.col(c).isNotNull(), F.struct(F.lit(g).alias("grouping"), F.col(c).cast("string").alias("level"))) for g, c in groupings.items()]]
    cells = reporting_groups(df).withColumn("_g", F.explode(F.array_compact(F.array(*groups)))).select("*", "_g.grouping", "_g.level")
    return group_measures(cells, ["grouping", "level"], programme, weight)


def group_measures(df: DataFrame, group: str | Sequence[str], programme: str = "Programme", weight: str = "participants") -> DataFrame:
    """The cohort's measures per reporting group, from one grouping, with their ratios."""
    attended = F.col("attendance") == "LHC Attended"
    by = lambda m: attended & (F.col("methods") == m)
    by_group = [group] if isinstance(group, str) else list(group)
    out = aggregate.conditional_sums(df.dropna(subset=by_group).filter("check_before_end_185"), by_group, weight, {
        "invites_first": F.col("invite_1").isNotNull(),
        "invites_second": F.col("invite_2").isNotNull(),
        "invites_third": F.col("invite_3").isNotNull(),
        "attended_f2f": by("F2F"), "attended_virtual": by("Virtual"), "attended_hybrid": by("F2F, Virtual"), "attended": attended,
        "referred": F.col("risk") == "High risk",
        "scanned": F.col("scan_group").isNotNull(),
        "programme_cancer": F.col("cancer_outcome") == f"{programme}: lung cancer",
        "counterfactual_cancer": F.col("cancer_outcome") == "Counterfactual: lung cancer",
        "scanned_no_cancer": F.col("cancer_outcome") == "Scanned: No lung cancer",
        "programme_s12": F.col("cancer_stage") == f"{programme}: S 1-2",
        "programme_s34": F.col("cancer_stage") == f"{programme}: S 3-4",
        "programme_s_unknown": F.col("cancer_stage") == f"{programme}: S ?",
    })
    return out.withColumns({
        "invites_followup": F.col("invites_second") + F.col("invites_third"),
        "invites_total": F.col("invites_first") + F.col("invites_second") + F.col("invites_third"),
        "uptake": clean.ratio("attended", "invites_first"),
        "conversion_eligible": clean.ratio("referred", "attended"),
        "conversion_realised": clean.ratio("scanned", "attended"),
    })
