"""Population-weighted distributions.

For a set of cohorts sharing one demographic profile (flags and bands):

* ingredient weight X(i, d) = sum of w over distinct (i name, i id, w, person, d)
* product weight Y(p, i, d) = the same with the product in the key
* shares are X over the sum of X in d (Y over the sum of Y in (i, d)),
  rounded half-even to 3 places, 0 when the total is 0.

Sums keep the weight's type: integer weights sum exactly as bigint, survey
weights read as decimal(18, 6) sum exactly as decimal, so the result does
not depend on the order of the partial sums.

Plan shape: prescriptions -> packages (broadcast by AQE when small) ->
distinct person items (map-side partial aggregate, so repeated fills never
cross the network) -> join persons on the person id -> the second distinct
reuses that partitioning (no exchange) -> sums by (item, demographics) are
tiny.  Everything is computed at region
level and fanned out to states at the very end: every state has one region,
so X(i, a, g, state) = X(i, a, g, region(state)) and the fan-out only
multiplies the final, aggregated rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import share
from ..settings import DEFAULT_AGE_RANGES
from .survey import demographic_persons, person_items

ING = "medication_ingredient_name"
ING_ID = "medication_ingredient_rxcui"
PROD = "medication_product_name"
PROD_ID = "medication_product_rxcui"


def with_group_total(df: DataFrame, keys: list[str], value: str, total: str) -> DataFrame:
    """Add the sum of ``value`` over ``keys`` to every row.

    Used only on aggregated rows (one per item and group), so a window
    partition holds the items of one group -- a list bounded by the
    vocabulary, not by the survey.  A window keeps one lineage; joining an
    aggregate back to its own input would plan the whole input twice."""
    return df.withColumn(total, F.sum(value).over(Window.partitionBy(*keys)))


class Distribution:
    """All distribution results of one demographic profile."""

    def __init__(self, prescription: DataFrame, demographics: DataFrame, ndc_rows: DataFrame,
                 region_states: DataFrame, *, age: bool = True, gender: bool = True,
                 state: bool = True, bands=DEFAULT_AGE_RANGES, product_level: bool = True):
        self.prescription = prescription
        self.demographics = demographics
        self.ndc_rows = ndc_rows
        self.region_states = region_states
        self.age, self.gender, self.state = age, gender, state
        self.bands = bands
        self.product_level = product_level

    # -- demographic columns -------------------------------------------------
    @property
    def demos(self) -> list[str]:
        """Output demographic columns, in flag order."""
        return [n for n, on in (("age", self.age), ("gender", self.gender), ("state", self.state)) if on]

    @property
    def rdemos(self) -> list[str]:
        """Aggregation columns: the region stands in for the state."""
        return ["region_num" if d == "state" else d for d in self.demos]

    def fan_out(self, df: DataFrame) -> DataFrame:
        """Region -> its states, after aggregation (the state dimension is a
        geography table; Spark broadcasts it from its size)."""
        if not self.state:
            return df
        states = self.region_states.select(F.col("region_value").alias("region_num"), "state")
        return df.join(states, "region_num").drop("region_num")

    # -- shared intermediate ---------------------------------------------------
    @cached_property
    def people(self) -> DataFrame:
        return demographic_persons(self.demographics, self.region_states, age=self.age,
                                   state=self.state, bands=self.bands)

    @cached_property
    def joined(self) -> DataFrame:
        """Distinct person items joined to the persons' distinct demographic
        rows: the joined rows are distinct as well."""
        items = person_items(self.prescription, self.ndc_rows, product=self.product_level)
        return items.join(self.people.select("DUPERSID", "person_weight", *self.rdemos).distinct(), "DUPERSID")

    @cached_property
    def ingredient_persons(self) -> DataFrame:
        """Distinct (cohort, ingredient, weight, person, demographics); without
        the product level the joined rows are that already."""
        rows = self.joined.select("cohort", ING, ING_ID, "person_weight", "DUPERSID", *self.rdemos)
        return rows.distinct() if self.product_level else rows

    def materialize(self) -> "Distribution":
        """Cut lineage for a build that derives many outputs: the distinct
        (person, item, weight, demographics) rows are checkpointed to the
        shared checkpoint folder (they keep their person-id partitioning),
        then the two region-level aggregates -- both small -- are
        checkpointed too.  Every later output reads those, so a lost
        executor never re-runs the survey joins."""
        from ..session import cut_lineage

        cols = ["cohort", ING, ING_ID, "person_weight", "DUPERSID", *self.rdemos]
        if self.product_level:
            cols[3:3] = [PROD, PROD_ID]
        self.__dict__["joined"] = cut_lineage(self.joined.select(*cols).distinct())
        self.__dict__["ingredient_region"] = cut_lineage(self.ingredient_region)
        if self.product_level:
            self.__dict__["product_region"] = cut_lineage(self.product_region)
        return self

    # -- ingredient level --------------------------------------------------------
    @cached_property
    def ingredient_weights(self) -> DataFrame:
        """(cohort, i name, region-level demographics, weighted)."""
        return self.ingredient_persons.groupBy("cohort", ING, *self.rdemos).agg(
            F.sum("person_weight").alias("weighted"))

    @cached_property
    def ingredient_region(self) -> DataFrame:
        t = with_group_total(self.ingredient_weights, ["cohort", *self.rdemos], "weighted", "total")
        return t.withColumn("percent", share("weighted", "total"))

    def ingredient(self) -> DataFrame:
        """P(ingredient | demographics)."""
        out = self.fan_out(self.ingredient_region)
        return out.select("cohort", ING, *self.demos, "weighted", "total", "percent")

    def weighted_person_count(self) -> DataFrame:
        """Distinct persons per (ingredient, id, weight, demographics) and
        weight x count -- the reference's first two steps, kept as a table."""
        counted = (self.ingredient_persons.groupBy("cohort", ING, ING_ID, "person_weight", *self.rdemos)
                   .agg(F.count(F.lit(1)).alias("patient_count")))
        counted = counted.withColumn(
            "weighted_patient_count", F.col("person_weight") * F.col("patient_count"))
        return self.fan_out(counted).select(
            "cohort", ING, ING_ID, "person_weight", *self.demos, "patient_count",
            "weighted_patient_count")

    # -- product level -------------------------------------------------------------
    @cached_property
    def product_weights(self) -> DataFrame:
        if not self.product_level:
            raise ValueError("built without product level")
        return self.joined.groupBy("cohort", PROD, ING, *self.rdemos).agg(
            F.sum("person_weight").alias("weighted"))

    @cached_property
    def product_region(self) -> DataFrame:
        t = with_group_total(self.product_weights, ["cohort", ING, *self.rdemos], "weighted", "total")
        return t.withColumn("percent", share("weighted", "total"))

    def product(self) -> DataFrame:
        """P(product | ingredient, demographics), every ingredient at once."""
        out = self.fan_out(self.product_region)
        return out.select("cohort", PROD, ING, *self.demos, "weighted", "total", "percent")

    # -- roll-ups ---------------------------------------------------------------------
    def ingredient_rollup(self) -> DataFrame:
        """Ingredient shares over the whole cohort.

        With demographics: sum of the distinct (name, weight) pairs -- this
        removes the copies of a region's value in its states, and also equal
        weights of different groups (kept as the reference does).  Without
        demographics the level share itself is the roll-up share."""
        x = self.ingredient_region
        if not self.demos:
            return x.select(
                "cohort", ING, F.col("weighted").alias("weighted_patient_count_ingredient_demographic"),
                F.col("percent").alias("percent_ingredient_patients"),
                F.col("percent").alias("agg_percent_ingredient_patients")).distinct()
        r = (x.select("cohort", ING, "weighted").distinct()
             .groupBy("cohort", ING).agg(F.sum("weighted").alias(
                 "agg_weighted_patient_count_ingredient_demographic")))
        r = with_group_total(r, ["cohort"], "agg_weighted_patient_count_ingredient_demographic",
                             "agg_weighted_patient_count_ingredient_total")
        return r.select(
            "cohort", ING, "agg_weighted_patient_count_ingredient_demographic",
            "agg_weighted_patient_count_ingredient_total",
            share("agg_weighted_patient_count_ingredient_demographic",
                  "agg_weighted_patient_count_ingredient_total").alias("agg_percent_ingredient_patients"))

    def product_rollup(self) -> DataFrame:
        """Product shares within each ingredient over the whole cohort."""
        y = self.product_region
        if not self.demos:
            return y.select(
                "cohort", ING, PROD,
                F.col("weighted").alias("weighted_patient_count_product_demographic"),
                F.col("percent").alias("percent_product_patients"),
                F.col("percent").alias("agg_percent_product_patients")).distinct()
        r = (y.select("cohort", ING, PROD, "weighted").distinct()
             .groupBy("cohort", ING, PROD).agg(F.sum("weighted").alias(
                 "agg_weighted_patient_count_product_demographic")))
        r = with_group_total(r, ["cohort", ING], "agg_weighted_patient_count_product_demographic",
                             "agg_weighted_patient_count_product_total")
        return r.select(
            "cohort", ING, PROD, "agg_weighted_patient_count_product_demographic",
            "agg_weighted_patient_count_product_total",
            share("agg_weighted_patient_count_product_demographic",
                  "agg_weighted_patient_count_product_total").alias("agg_percent_product_patients"))

    # -- validation ------------------------------------------------------------------------
    def validation(self) -> DataFrame:
        """Joint share of a product: ingredient share x product share (both
        already rounded; the product is not rounded again)."""
        p = self.product_region.select(
            "cohort", PROD, ING, *self.rdemos,
            F.col("weighted").alias("weighted_patient_count_product_demographic"),
            F.col("total").alias("weighted_patient_count_product_total"),
            F.col("percent").alias("percent_product_patients"))
        i = self.ingredient_region.select(
            "cohort", ING, *self.rdemos,
            F.col("weighted").alias("weighted_patient_count_ingredient_demographic"),
            F.col("total").alias("weighted_patient_count_ingredient_total"),
            F.col("percent").alias("percent_ingredient_patients"))
        v = p.join(i, ["cohort", ING, *self.rdemos]).withColumn(
            "validation_percent_product_patients",
            F.col("percent_ingredient_patients") * F.col("percent_product_patients"))
        return self.fan_out(v).select(
            "cohort", PROD, ING, *self.demos,
            "weighted_patient_count_product_demographic", "weighted_patient_count_product_total",
            "percent_product_patients", "weighted_patient_count_ingredient_demographic",
            "weighted_patient_count_ingredient_total", "percent_ingredient_patients",
            "validation_percent_product_patients")
