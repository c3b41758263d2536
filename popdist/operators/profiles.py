"""Distributions of modules with different demographic profiles, in one plan.

Flags and bands are columns of the keyed module table; a demographic that a
module does not use is null in its rows.  The plan has the same nodes for
three modules and for two thousand: there is no branch and no union per
module or per profile.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.numeric import share
from ..session import small_table, staged
from ..settings import AppSettings, ModuleSettings
from .distribution import ING, ING_ID, PROD, PROD_ID, Distribution
from .survey import clean_item_names, persons

DEMOS = ["age", "gender", "region_num"]
THING = ["cohort", ING, ING_ID, PROD, PROD_ID]
PROFILE_TABLE = ("cohort string, use_age boolean, use_gender boolean, use_state boolean, "
                 "bands array<struct<age:string,lo:int,hi:int>>")


def profile_table(spark: SparkSession, modules: Sequence[ModuleSettings], app: AppSettings = AppSettings()) -> DataFrame:
    """One row per module: its demographic flags and its age bands."""
    from ..sources.dimensions import band_bounds

    return small_table(spark, [
        (m.module_name, m.flag("age"), m.flag("gender"), m.flag("state"),
         [{"age": b, "lo": lo, "hi": hi} for b, lo, hi in band_bounds(m.bands(app))])
        for m in modules], PROFILE_TABLE)


def join_nulls(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``a`` joined to ``b`` on ``keys``, where a null equals a null."""
    right = b.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    cond = None
    for k in keys:
        one = F.col(k).eqNullSafe(F.col(f"_of_{k}"))
        cond = one if cond is None else cond & one
    return a.join(right, cond).drop(*(f"_of_{k}" for k in keys))


class ProfiledDistribution(Distribution):
    """The results of ``Distribution`` for modules of any profiles.

    Both levels come from one pass over (person, ingredient, product) rows.
    Ingredients and products have numbers: names never travel with the survey's
    rows.  The rows are distinct before they meet the persons, and a person is
    one row, so after that join they are only added up.
    The weights, a few rows per item and group, are staged once; totals are
    keyed aggregates of them, so no module is ever one task."""

    def __init__(self, prescription: DataFrame, demographics: DataFrame, ndc_rows: DataFrame,
                 region_states: DataFrame, profiles: DataFrame):
        super().__init__(prescription, demographics, ndc_rows, region_states)
        self.profiles = profiles

    @cached_property
    def people(self) -> DataFrame:
        """Persons with the regions' knowledge of states; no group chosen yet."""
        known = self.region_states.select(F.col("region_value").alias("region_num")).distinct().withColumn(
            "has_states", F.lit(True))
        return persons(self.demographics).join(known, "region_num", "left")

    @cached_property
    def packages(self) -> DataFrame:
        """The package rows with clean names, staged."""
        return staged(clean_item_names(self.ndc_rows).select("medication_ndc", *THING), "profile-packages")

    @cached_property
    def things(self) -> DataFrame:
        """(ingredient, product, cohort, names and ids), staged: numbers for each
        ingredient of a module and each product of such an ingredient."""
        named = staged(self.packages.select(*THING).distinct().withColumn(
            "product", F.monotonically_increasing_id()), "profile-products-named")
        heads = named.groupBy(*THING[:3]).agg(F.min("product").alias("ingredient"))
        return staged(join_nulls(named, heads, THING[:3]), "profile-things")

    @cached_property
    def person_sets(self) -> DataFrame:
        """One row per person: the demographics, and the sampling weight.  An
        age is the first of those ages that no band of any module tells from it.
        A repeated id has its distinct rows in ``people`` and nulls elsewhere."""
        cuts = self.profiles.select(F.explode("bands").alias("b")).select(
            F.explode(F.array(F.col("b.lo"), F.col("b.hi") + 1)).alias("cut")).agg(F.collect_set("cut").alias("cuts"))
        rows = self.people.where("DUPERSID is not null").crossJoin(cuts).withColumn(
            "age_from", F.expr("array_max(filter(cuts, c -> c <= AGELAST))"))
        of_person = F.struct("person_weight", "gender", "age_from", "region_num", "has_states")
        sets = rows.groupBy("DUPERSID").agg(F.collect_set(of_person).alias("people"))
        one = F.size("people") == 1
        return sets.select(
            "DUPERSID", F.when(~one, F.col("people")).alias("people"),
            *[F.when(one, F.col("people")[0][c]).alias(c) for c in ("person_weight", "gender", "age_from", "region_num", "has_states")])

    @cached_property
    def person_things(self) -> DataFrame:
        """Distinct (cohort, DUPERSID, ingredient, product), and the person's row;
        ``first`` marks one product of each ingredient that a person has.

        A person's fills of an ingredient are sorted once, which drops the refills
        and finds the first product: both levels are told from one row."""
        codes = staged(join_nulls(self.packages, self.things, THING).select(
            "cohort", "medication_ndc", "ingredient", "product"), "profile-codes")
        keys = ["DUPERSID", "cohort", "ingredient"]
        fills = self.prescription.select("DUPERSID", F.col("RXNDC").alias("medication_ndc")).where("DUPERSID is not null").join(
            codes, "medication_ndc").select(*keys, "product").repartition(*keys)
        one = Window.partitionBy(*keys).orderBy("product")
        pairs = fills.withColumn("_before", F.lag("product").over(one)).where("_before is null or _before <> product").select(
            *keys, "product", F.col("_before").isNull().alias("first"))
        return pairs.join(self.person_sets, "DUPERSID")

    def used(self, rows: DataFrame, *keys: str) -> DataFrame:
        """``rows`` (cohort, ``keys``, people) with the demographics that their
        module uses and the weight: one row per band that holds the age where it
        uses bands, distinct within a row of ``rows``."""
        chosen = F.expr("""array_distinct(flatten(transform(
            filter(people, p -> not use_state or p.has_states),
            p -> transform(
                if(use_age, transform(filter(bands, b -> p.age_from between b.lo and b.hi), b -> b.age), array(cast(null as string))),
                a -> named_struct('person_weight', p.person_weight, 'age', a, 'gender', if(use_gender, p.gender, null),
                                  'region_num', if(use_state, p.region_num, null))))))""")
        return rows.join(self.profiles, "cohort").select("cohort", *keys, F.explode(chosen).alias("p")).select("cohort", *keys, "p.*")

    @cached_property
    def joined(self) -> DataFrame:
        """(person, product) rows with the names and the demographics."""
        one = F.struct("person_weight", "gender", "age_from", "region_num", "has_states")
        rows = self.used(self.person_things.withColumn("people", F.coalesce("people", F.array(one))), "product", "DUPERSID")
        return rows.join(self.things.drop("cohort", "ingredient"), "product").select(
            "cohort", "DUPERSID", "person_weight", PROD, PROD_ID, ING, ING_ID, *DEMOS)

    @cached_property
    def weights(self) -> DataFrame:
        """(cohort, level, ingredient, product, demographics, weighted), staged;
        the product is null on the ingredient level.

        Persons are added up by all their demographics first; bands and unused
        demographics are settled on the few sums.  Repeated ids keep their rows
        until then: how many of them are distinct depends on the module."""
        raw = ["gender", "age_from", "region_num", "has_states"]
        once = F.col("first").cast("int")
        sums = self.person_things.groupBy("cohort", "ingredient", "product", *raw, "people").agg(
            F.count(F.lit(1)).alias("n1"), F.sum("person_weight").alias("w1"),
            F.sum(once).alias("n0"), F.sum(F.when(F.col("first"), F.col("person_weight"))).alias("w0"))
        kind = sums.schema["w1"].dataType
        levels = sums.select("cohort", *raw, "people", F.explode(F.array(
            F.struct(F.lit(1).alias("level"), F.col("product").alias("thing"), F.col("n1").alias("persons"), F.col("w1").alias("weighted")),
            F.struct(F.lit(0).alias("level"), F.col("ingredient").alias("thing"), F.col("n0").alias("persons"), F.col("w0").alias("weighted")))).alias("x")).select("cohort", *raw, "people", "x.*")
        one = F.struct(F.col("weighted").alias("person_weight"), *raw)
        many = F.transform("people", lambda p: F.struct(p["person_weight"].cast(kind).alias("person_weight"), *[p[c].alias(c) for c in raw]))
        rows = levels.where("persons > 0").select(
            "cohort", "level", "thing", F.coalesce(many, F.array(one)).alias("people"),
            F.when(F.col("people").isNull(), F.lit(1)).otherwise(F.col("persons")).alias("persons"))
        names = self.things.select(F.col("product").alias("thing"), ING, PROD)  # an ingredient's number is one of its products'
        named = self.used(rows, "level", "thing", "persons").join(names, "thing").withColumn(PROD, F.when(F.col("level") == 1, F.col(PROD)))
        return staged(named.groupBy("cohort", "level", ING, PROD, *DEMOS).agg(
            F.sum((F.col("person_weight") * F.col("persons")).cast(kind)).cast(kind).alias("weighted")), "profile-weights")

    def _level(self, level: int, keys: list[str]) -> DataFrame:
        """Shares on one level, within ``keys`` and the demographics."""
        rows = self.weights.where(F.col("level") == level)
        groups = ["cohort", *keys, *DEMOS]
        totals = rows.groupBy(*groups).agg(F.sum("weighted").alias("total"))
        return join_nulls(rows, totals, groups).select(
            "cohort", ING, PROD, *DEMOS, "weighted", "total", share("weighted", "total").alias("percent"))

    @cached_property
    def ingredient_region(self) -> DataFrame:
        return self._level(0, []).drop(PROD)

    @cached_property
    def product_region(self) -> DataFrame:
        return self._level(1, [ING])

    def materialize(self) -> "ProfiledDistribution":
        """Shares of both levels staged, for builds that read them often."""
        self.__dict__["ingredient_region"] = staged(self.ingredient_region, "profile-ingredients")
        self.__dict__["product_region"] = staged(self.product_region, "profile-products")
        return self

    def fan_out(self, df: DataFrame) -> DataFrame:
        """Region -> its states where the module asks for states."""
        states = self.region_states.select(F.col("region_value").alias("region_num"), "state")
        return df.join(states, "region_num", "left").drop("region_num")

    def _rollup(self, rows: DataFrame, names: list[str], within: list[str], word: str) -> DataFrame:
        """Shares over the whole module, from distinct (name, weight) pairs.
        Without demographics this is the level's own share."""
        weight, total = f"agg_weighted_patient_count_{word}_demographic", f"agg_weighted_patient_count_{word}_total"
        sums = rows.select("cohort", *names, "weighted").distinct().groupBy("cohort", *names).agg(
            F.sum("weighted").alias(weight))
        totals = sums.groupBy("cohort", *within).agg(F.sum(weight).alias(total))
        return sums.join(totals, ["cohort", *within]).select(
            "cohort", *names, weight, total, share(weight, total).alias(f"agg_percent_{word}_patients"))

    def ingredient_rollup(self) -> DataFrame:
        return self._rollup(self.ingredient_region, [ING], [], "ingredient")

    def product_rollup(self) -> DataFrame:
        return self._rollup(self.product_region, [ING, PROD], [ING], "product")

    def validation(self) -> DataFrame:
        """Joint share of a product: ingredient share x product share."""
        p = self.product_region.select(
            "cohort", PROD, ING, *DEMOS,
            F.col("weighted").alias("weighted_patient_count_product_demographic"),
            F.col("total").alias("weighted_patient_count_product_total"),
            F.col("percent").alias("percent_product_patients"))
        i = self.ingredient_region.select(
            "cohort", ING, *DEMOS,
            F.col("weighted").alias("weighted_patient_count_ingredient_demographic"),
            F.col("total").alias("weighted_patient_count_ingredient_total"),
            F.col("percent").alias("percent_ingredient_patients"))
        v = join_nulls(p, i, ["cohort", ING, *DEMOS]).withColumn(
            "validation_percent_product_patients",
            F.col("percent_ingredient_patients") * F.col("percent_product_patients"))
        return self.fan_out(v).select(
            "cohort", PROD, ING, "age", "gender", "state",
            "weighted_patient_count_product_demographic", "weighted_patient_count_product_total",
            "percent_product_patients", "weighted_patient_count_ingredient_demographic",
            "weighted_patient_count_ingredient_total", "percent_ingredient_patients",
            "validation_percent_product_patients")
