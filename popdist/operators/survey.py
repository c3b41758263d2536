"""Survey side: reference rows, survey join, demographic expansion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import decode_gender, none_text, normalize_name
from ..sources.dimensions import with_age_bands

ITEM_COLUMNS = ("medication_ingredient_name", "medication_ingredient_rxcui",
                "medication_product_name", "medication_product_rxcui", "medication_ndc")


def survey_reference(prescription: DataFrame, demographics: DataFrame) -> DataFrame:
    """Distinct (DUPERSID, person_weight, RXNDC, gender, AGELAST, region_num).

    The (person, package) pairs are made distinct before the join: a
    partial aggregate collapses refills on the map side, so the join sees far
    fewer rows.  The persons are made distinct too, so the joined rows are:
    no aggregate holds the wide rows of the join."""
    pairs = prescription.select("DUPERSID", "RXNDC").distinct()
    persons = demographics.select(
        "DUPERSID", person_weight(demographics).alias("person_weight"),
        decode_gender("SEX").alias("gender"), "AGELAST", F.col("REGION").alias("region_num")).distinct()
    return pairs.join(persons, "DUPERSID").select(
        "DUPERSID", "person_weight", "RXNDC", "gender", "AGELAST", "region_num")


def survey_join(reference: DataFrame, ndc_rows: DataFrame) -> DataFrame:
    """Reference rows joined to the cohort's package rows (one per NDC).

    Gender is shown as text with a missing value as ``'None'`` (the survey
    join compares and groups on text)."""
    right = ndc_rows.select("cohort", *ITEM_COLUMNS)
    out = reference.join(right, reference["RXNDC"] == right["medication_ndc"])
    return out.withColumn("gender", none_text("gender"))


def person_weight(demographics: DataFrame):
    """The sampling weight: numeric columns as they are; text (as read from
    the fixed-width file) as an exact decimal."""
    if dict(demographics.dtypes)["PERWTF"] == "string":
        return F.col("PERWTF").cast("decimal(18,6)")
    return F.col("PERWTF")


def persons(demographics: DataFrame) -> DataFrame:
    """Person rows with the survey-join forms of the demographics."""
    return demographics.select(
        "DUPERSID", person_weight(demographics).alias("person_weight"),
        none_text(decode_gender("SEX")).alias("gender"),
        F.col("AGELAST"), F.col("REGION").alias("region_num"))


def demographic_persons(demographics: DataFrame, region_states: DataFrame, *, age: bool,
                        state: bool, bands) -> DataFrame:
    """Persons with their demographic groups, before any fan-out to states.

    Age on: one row per band holding the age (bands may overlap, ages in no
    band drop out).  State on: persons of a region without states drop out;
    the region is kept and fanned out to states only after aggregation
    (each state belongs to one region, so the result is the same)."""
    p = persons(demographics)
    if age:
        p = with_age_bands(p, "AGELAST", bands)
    if state:
        # a semi join needs no distinct on its right side
        regions = region_states.select(F.col("region_value").alias("region_num"))
        p = p.join(regions, "region_num", "left_semi")
    return p


def clean_item_names(ndc_rows: DataFrame) -> DataFrame:
    """Names cleaned once per package row (before any join fans them out)."""
    return (ndc_rows
            .withColumn("medication_ingredient_name", normalize_name("medication_ingredient_name"))
            .withColumn("medication_product_name", normalize_name("medication_product_name")))


def person_items(prescription: DataFrame, ndc_rows: DataFrame, product: bool = True) -> DataFrame:
    """Distinct (cohort, person, ingredient[, product]) from prescriptions.

    The package side has one row per (cohort, NDC); AQE broadcasts it when
    it is small and splits hot packages otherwise.  The distinct runs a
    partial aggregate before its shuffle, so repeated fills of the same
    medicine never cross the network."""
    cols = ["cohort", "medication_ingredient_name", "medication_ingredient_rxcui"]
    if product:
        cols += ["medication_product_name", "medication_product_rxcui"]
    items = clean_item_names(ndc_rows).select("medication_ndc", *cols)
    rx = prescription.select("DUPERSID", "RXNDC")
    return (rx.join(items, rx["RXNDC"] == items["medication_ndc"])
            .select("DUPERSID", *cols).distinct())
