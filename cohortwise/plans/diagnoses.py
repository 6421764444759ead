"""Consolidated diagnoses from the registry and the faster rapid registration."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortwise.functions import clean, dates
from cohortwise.operators import joins, select
from cohortwise.plans import vocab

REGISTRY, RAPID = "registry", "rapid"
#: Days between a rapid record and the event of its registry tumour.
RAPID_DAYS = 15
#: What a repeated diagnosis is told by.
REPEATED_BY = ["pk", "ParticipantID", "diagnosis_date", "icd10_3c", "stage_group", "trust_code", "source"]
COLUMNS = ["pk", "ParticipantID", "diagnosis_date", "icd10_3c", "stage", "tumour_site_group", "stage_group", "gender_code",
           "ethnicity_code", "age", "imd_quintile", "trust_code", "cancer_alliance", "diag_route", "source"]


def normalise_code(c) -> Column:
    """Code without its dot."""
    return F.replace(F.col(c) if isinstance(c, str) else c, F.lit("."), F.lit(""))


def icd_groups(codes: DataFrame) -> DataFrame:
    """(code, code3, site, site3): a public code list plus the codes it lacks.

    Codes that belong to several groups are reported as Unknown by their short form.
    """
    code = normalise_code("icd_10")
    listed = codes.select(code.alias("code"), F.substring(code, 1, 3).alias("code3"),
                          F.col("tumour_site_group").alias("site"))
    listed = listed.withColumn("site3", F.when(F.col("code3").isin(vocab.UNKNOWN_CODES), "Unknown").otherwise(F.col("site")))
    none = F.lit(None).cast("string")
    extra = F.array(*[F.struct(none.alias("code"), F.lit(c).alias("code3"), none.alias("site"), F.lit(s).alias("site3")) for c, s in vocab.EXTRA_CODES.items()])
    return listed.unionByName(codes.sparkSession.range(1).select(F.explode(extra).alias("e")).select("e.*"))


def site_group(df: DataFrame, code: str, groups: DataFrame, full_first: bool) -> DataFrame:
    """Site group by the full code, then the short one; or by the short one alone."""
    short = groups.select(F.col("code3").alias(code), F.col("site3").alias("tumour_site_group"))
    full = groups.select(F.col("code").alias(code), F.col("site").alias("tumour_site_group"))
    full = full if full_first else full.filter("1 = 0")
    return joins.two_stage_lookup(df, code, full, short, "tumour_site_group")


def code_labels(df: DataFrame) -> DataFrame:
    gender = reduce(lambda acc, kv: acc.when(F.col("gender_code") == kv[0], kv[1]), list(vocab.GENDER.items())[1:],
                    F.when(F.col("gender_code") == 0, vocab.GENDER[0]))
    names = {}
    for code, name in vocab.ETHNICITY.items():
        names.setdefault(name, []).append(code)
    return df.withColumns({
        "gender": gender,
        "ethnicity": clean.classify("ethnicity_code", names, "<blank>"),
        "ethnicity_group": clean.classify("ethnicity_code", vocab.ETHNICITY_GROUP, "Unknown"),
        "age_group": clean.cut("age", *vocab.AGE_BAND_EVAL, missing="Not known"),
        "diagnosis_month": dates.month_start("diagnosis_date"),
    })


def quintile(decile: str, fallback: str) -> Column:
    """Quintile label from a decile label; some years hold a note in place of the decile."""
    fixed = F.when(F.col(decile) == vocab.MIXED_DECILE, F.col(fallback)).otherwise(F.col(decile))
    return clean.recode(fixed, vocab.QUINTILE, F.lit(None).cast("string"))


def link_rapid(rapid: DataFrame, events: DataFrame) -> DataFrame:
    """Registry tumours of rapid records: nearest diagnosis event within 15 days, ties kept."""
    diagnosed = events.filter(F.col("EVENT_TYPE").isin(vocab.DIAGNOSIS_EVENTS))
    return joins.nearest_within(rapid, diagnosed, ["ParticipantID"], "TUMOUR_AVP_ID", "DIAGNOSISDATE",
                                "TUMOUR_ID", "EVENT_DATE", RAPID_DAYS)


def link_rapid_by_group(rapid: DataFrame, registry: DataFrame) -> DataFrame:
    """The same by person and tumour group within 90 days."""
    return joins.nearest_within(rapid, registry, ["ParticipantID", "tumour_site_group"], "TUMOUR_AVP_ID",
                                "DIAGNOSISDATE", "TUMOUR_ID", "DIAGNOSISDATEBEST", 90)


def consolidate(registry: DataFrame, rapid: DataFrame, events: DataFrame, groups: DataFrame,
                stage: Callable[..., DataFrame] = lambda df, name, key=None: df, columns: Sequence[str] | None = None) -> DataFrame:
    """Registry diagnoses, then rapid ones that are later than the registry and not in it.

    The registry serves for its rows, its last date and the exclusion of linked records, and is read twice more to drop
    repeats: stage writes it once (see io.staged), by person, and adds what is left of the rapid records. ``columns`` names
    those that are read later; left out, all are made, with their labels.
    """
    needed = COLUMNS if columns is None else [c for c in COLUMNS if c in columns or c in REPEATED_BY]
    registry = site_group(select.newest_snapshot(registry), "SITE_ICD10_3CHAR", groups, True).withColumn("stage_group", F.substring("STAGE_BEST", 1, 1))
    first = registry.select(
        F.col("TUMOUR_ID").alias("pk"), "ParticipantID", F.col("DIAGNOSISDATEBEST").alias("diagnosis_date"),
        F.col("SITE_ICD10_3CHAR").alias("icd10_3c"), F.col("STAGE_BEST").alias("stage"), "tumour_site_group", "stage_group",
        F.col("GENDER").alias("gender_code"), F.col("ETHNICITY").alias("ethnicity_code"), F.col("AGE").alias("age"),
        quintile("IMD_DECILE", "IMD_QUINTILE").alias("imd_quintile"), F.col("DIAG_TRUST").alias("trust_code"),
        F.col("CANALLIANCE_NAME").alias("cancer_alliance"), F.col("FINAL_ROUTE").alias("diag_route"),
        F.lit(REGISTRY).alias("source"))
    first = stage(first.select(*needed), "registry", "ParticipantID")
    # only rapid records after the registry's end can stay, so cut them before linking, and the events that none of them can be near to
    end = first.select(F.max("diagnosis_date")).scalar()
    later = stage(select.newest_snapshot(rapid).filter(F.col("DIAGNOSISDATE") > end), "rapid")
    later = site_group(later, "TUMOUR_SITE", groups, False).withColumn("stage_group", F.substring("STAGE", 1, 1))
    events = stage(select.newest_snapshot(events).filter(F.col("EVENT_TYPE").isin(vocab.DIAGNOSIS_EVENTS) & (F.col("EVENT_DATE") > F.date_sub(end, RAPID_DAYS)))
                   .select("ParticipantID", "EVENT_DATE", "EVENT_TYPE", "TUMOUR_ID"), "registry_events")
    linked = stage(later.join(link_rapid(later, events), "TUMOUR_AVP_ID", "left"), "linked")
    known = stage(select.members(first.select(F.col("pk").alias("TUMOUR_ID")), linked, "TUMOUR_ID"), "known")
    second = select.non_members(linked, known, "TUMOUR_ID").select(
        F.col("TUMOUR_AVP_ID").alias("pk"), "ParticipantID", F.col("DIAGNOSISDATE").alias("diagnosis_date"),
        F.col("TUMOUR_SITE").alias("icd10_3c"), F.col("STAGE").alias("stage"), "tumour_site_group", "stage_group",
        F.col("GENDER").alias("gender_code"), F.col("ETHNICCATEGORY").alias("ethnicity_code"), F.col("PatientAge").alias("age"),
        F.col("IMD_QUINTILE").alias("imd_quintile"), F.col("TRUST_CODE").alias("trust_code"),
        F.col("CANALLIANCE_NAME").alias("cancer_alliance"), F.col("FINAL_ROUTE").alias("diag_route"),
        F.lit(RAPID).alias("source"))
    second = second.select(*needed)
    both = stage.append(first, second, "ParticipantID") if hasattr(stage, "append") else first.unionByName(second)
    return drop_repeats(code_labels(both) if columns is None else both, lambda df: stage(df, "repeated"))


def drop_repeats(df: DataFrame, stage: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Without diagnoses that repeat one from the other source. Rows of one person are compared, so the person is no part of the mark."""
    mark = clean.fingerprint("icd10_3c", clean.null_if("stage_group", "?", "U"), "trust_code")
    return select.drop_repeated_diagnoses(df, "ParticipantID", "diagnosis_date", "source", mark, "pk", stage=stage)
