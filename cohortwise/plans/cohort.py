"""The base frames of a cohort: current, cleaned records with project, eligibility,
risk and first check attached. Frames are lazy; each is built at most once."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import cached_property, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortwise.functions import text
from cohortwise.operators import joins, select
from cohortwise.plans import tables, vocab

PERSON_COLUMNS = ["ccg_code", "age_validity", "age_band", "age_band_five", "age_band_eval", "sex", "ethnic_group",
                  "imd_decile", "rurality"]
#: What a person's row holds, by the frame it comes from.
PERSON_PARTS = {"people": PERSON_COLUMNS, "eligibility": ["eligible", "first_letter_date"], "risk": ["plco_risk", "llp_risk"]}
#: What a scan has only in view of the person's other scans.
TIMED = ["first_date", "days_from_first", "months_from_first", "scan_category"]
#: Free text and accepted terms of the frames of findings.
FINDINGS = {"other_findings": ("Other_Incidental_Findings", vocab.OTHER_FINDINGS),
            "pulmonary_findings": ("Pulmonary_Incidental_Findings", vocab.PULMONARY_FINDINGS)}
ID = "ParticipantID"
#: Lookups that are made from large tables, and their keys.
LISTS = {"excluded_transactions": "TransactionId", "excluded_people": ID, "ethnicity": "Ethnicity"}


def _unwritten(df: DataFrame, name: str, key: str | None = None, placed: bool = False, buckets: int | None = None) -> DataFrame:
    return df


_unwritten.writes = lambda name: False


class Cohort:
    """``raw`` maps table names (see RECORD_KEYS, plus registry, rapid and pathway) to raw
    frames; ``lookups`` holds areas, ethnicity, project_names, projects and, optionally,
    excluded_transactions and excluded_people.

    ``stage`` is called on the frames that several others start from. Left out, everything
    stays one lazy plan, which suits a single metric. For work that reads the frames many
    times pass ``io.staged(spark)``: each is then written once to the shared folder.
    """

    def __init__(self, raw: Mapping[str, DataFrame], lookups: Mapping[str, DataFrame],
                 latest_only_org: str | None = None, bad_transactions: Sequence[int] = (),
                 programme: str = "PROGRAMME", stage: Callable[..., DataFrame] | None = None):
        self.raw, self.lookups = raw, lookups
        self.stage = stage or _unwritten
        self._current: dict[str, DataFrame] = {}
        self._listed: dict[str, DataFrame] = {}
        self.latest_only_org, self.bad_transactions, self.programme = latest_only_org, bad_transactions, programme

    # --- cleaned tables

    def listed(self, name: str) -> DataFrame | None:
        """One of the lists in LISTS. Written, its size is known: a short one is sent to where the records are, and no record is moved to meet it."""
        if name not in self._listed and name in self.lookups:
            self._listed[name] = self.stage(self.lookups[name], name, LISTS[name], placed=True, buckets=1)
        return self._listed.get(name)

    def current(self, name: str, by_person: bool = False) -> DataFrame:
        """Newest record per key with its flags; the flags look at the selected records.

        Records that are written, or are asked for by person, are moved by person at once; others by all their keys.
        """
        if name not in self._current:
            home = ID if by_person or getattr(self.stage, "writes", lambda name: True)(name) else None
            chosen = tables.current_records(self.raw[name], tables.RECORD_KEYS[name],
                                            self.listed("excluded_transactions"), self.listed("excluded_people"), name, home)
            chosen = self.stage(chosen, name, ID, placed=True)
            self._current[name] = tables.tag_submission(chosen, self.latest_only_org, self.bad_transactions)
        return self._current[name]

    @cached_property
    def demographics(self) -> DataFrame:
        return tables.clean_demographics(self.current("demographics"), self.lookups["areas"], self.listed("ethnicity"))

    @cached_property
    def clean_invites(self) -> DataFrame:
        return tables.clean_invite(self.current("invite"), self.programme)

    @cached_property
    def clean_scans(self) -> DataFrame:
        return self.stage(tables.time_scans(self.dated(tables.clean_scan(self.current("scan")))), "clean_scans", ID, placed=True)

    def dated(self, scans: DataFrame) -> DataFrame:
        return tables.correct_scan_dates(scans, self.persons if "persons" in self.__dict__ else self.clean_invites)

    @cached_property
    def clean_measurements(self) -> DataFrame:
        return tables.clean_measurement(self.current("measurement"))

    # --- joins shared by the base frames

    @cached_property
    def people(self) -> DataFrame:
        return self.demographics.select("ParticipantID", F.col("CCG_Code").alias("ccg_code"), *PERSON_COLUMNS[1:])

    @cached_property
    def eligibility(self) -> DataFrame:
        return self.clean_invites.select(ID, *PERSON_PARTS["eligibility"]).distinct()

    @cached_property
    def risk(self) -> DataFrame:
        return self.clean_measurements.select(ID, *PERSON_PARTS["risk"]).distinct()

    @cached_property
    def persons(self) -> DataFrame:
        """One row per person of demographics, invites or measurements, with all that the base frames take from these."""
        parts = [getattr(self, p) for p in PERSON_PARTS]
        return self.stage(reduce(lambda a, b: a.join(b, ID, "full"), parts), "persons", ID, placed=True)

    def with_person(self, df: DataFrame, needs: Sequence[str]) -> DataFrame:
        """Columns of the person: from the person table once that exists, else from each part that is asked for."""
        if "persons" in self.__dict__:
            return df.join(self.persons.select(ID, *[c for n in needs for c in PERSON_PARTS[n]]), ID, "left")
        return reduce(lambda d, n: d.join(getattr(self, n), ID, "left"), needs, df)

    def with_project(self, df: DataFrame, needs: Sequence[str] = ()) -> DataFrame:
        """The person's columns and the project. All joins by person come before the naming, so that they meet rows as they are bucketed."""
        df = self.with_person(df, ["people", *(n for n in needs if n in PERSON_PARTS)])
        df = self.with_first_check(df) if "first_check" in needs else df
        return joins.name_projects(df, self.lookups["project_names"])

    def with_first_check(self, df: DataFrame) -> DataFrame:
        return df.join(self.first_checks.select(ID, "check_month", "check_date"), ID, "left")

    # --- base frames

    @cached_property
    def invites(self) -> DataFrame:
        return self.with_project(self.clean_invites)

    @cached_property
    def checks(self) -> DataFrame:
        return self.stage(self.with_project(tables.clean_check(self.current("check")), ["eligibility"]), "checks", ID, placed=True)

    @cached_property
    def first_checks(self) -> DataFrame:
        """First attended check per person, preferably after the programme began."""
        attended = self.checks.filter(
            counted(True) & F.col("check_month").isNotNull() & (F.col("attendance_category") == "Attended"))
        outside = F.when(F.col("check_date") > vocab.PREFERRED_AFTER, 0).otherwise(1)
        ties = [F.col("CSURowNumber"), F.col("LHC_Date")]
        return self.stage(select.top_per_key(attended, ["ParticipantID"], [outside, F.col("check_date"), *ties]), "first_checks", ID, placed=True)

    @cached_property
    def measurements(self) -> DataFrame:
        return self.with_project(self.clean_measurements, ["eligibility", "first_check"])

    @cached_property
    def scans(self) -> DataFrame:
        return self.stage(self.scan_frame(("eligibility", "risk", "first_check")), "scans", ID, placed=True)

    def scan_frame(self, needs: Sequence[str]) -> DataFrame:
        """Scans with only the joins that are asked for; the full frame once that exists."""
        if "scans" in self.__dict__:
            return self.scans
        return self.with_project(self.clean_scans, needs)

    @cached_property
    def diagnostics(self) -> DataFrame:
        return self.with_project(tables.clean_diagnostics(self.current("diagnostics")), ["eligibility"])

    @cached_property
    def history(self) -> DataFrame:
        return self.with_project(tables.clean_history(self.current("history")))

    @cached_property
    def smoking(self) -> DataFrame:
        return self.with_project(tables.clean_smoking(self.current("smoking")), ["eligibility"])

    def findings(self, column: str, terms: Sequence[str], timed: bool = True) -> DataFrame:
        """One row per finding in the free text, with its closest accepted term.

        Each distinct text is split and scored once. Scans meet the findings of their text before they are joined by person, so
        that a filter on the term leaves few to join; without the columns in TIMED, these are all that is moved by person.
        """
        texts = self.current("scan").select(column).filter(F.col(column).isNotNull()).distinct()
        found = texts.withColumn("finding", F.explode(text.split_findings(column)))
        found = self.stage(joins.closest_terms(found, "finding", terms), "terms")
        if "scans" in self.__dict__:
            return self.scans.join(found, column)
        scans = self.clean_scans.join(found, column) if timed else self.dated(tables.clean_scan(self.current("scan")).join(found, column))
        return self.with_project(scans, ("eligibility",))

    @cached_property
    def other_findings(self) -> DataFrame:
        return self.findings(*FINDINGS["other_findings"])

    @cached_property
    def pulmonary_findings(self) -> DataFrame:
        return self.findings(*FINDINGS["pulmonary_findings"])


def counted(eligible: bool):
    """Valid transaction and person, and if asked for also eligible."""
    ok = (F.col("transaction_validity") == "Valid") & (F.col("person_validity") == "Valid")
    return ok & (F.col("eligible") == "Eligible") if eligible else ok
