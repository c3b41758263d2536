"""Inputs and standard modules of the registered queries."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..fixtures import Fixtures
from ..operators import cohort as co
from ..operators.distribution import Distribution
from ..operators.graph import build_crosswalk, dose_form_groups
from ..operators.profiles import ProfiledDistribution, profile_table
from ..operators.survey import survey_reference
from ..session import staged
from ..settings import ClassQuery, ModuleSettings

# The flagship module: the whole vocabulary as one cohort.
ALL = "all_medications"

# Modules used by the cohort queries (ids of the stand-in vocabulary).
BRANDS = ModuleSettings(
    module_name="brand_one_two",
    rxcui_include=("I-Brand#1", "I-Brand#2"),
    rxcui_exclude=("I-Brand#2",),
)
ECONOMY = ModuleSettings(
    module_name="economy_class",
    rxclass_include=(ClassQuery("ECONOMY", "ATC"), ClassQuery("EPC-SMALL", "has_EPC")),
    rxcui_exclude=("I-Brand#3",),
    dose_form_filter=("ECONOMY", "AMERICA Product"),
    ingredient_tty_filter="IN",
)
MIXED = ModuleSettings(
    module_name="mixed_products",
    rxcui_include=("I-Brand#7", "P-Brand#11-red plate", "M-1"),
    dose_form_filter=("STANDARD",),
    ingredient_tty_filter="MIN",
)
COHORTS = (BRANDS, ECONOMY, MIXED)

# Modules of other demographic profiles, built together with those above.
ONLY_AGE = ModuleSettings(
    module_name="only_age", rxclass_include=(ClassQuery("PROMO", "ATC"),), dose_form_filter=("PROMO", "ASIA Product"),
    flags={"age": True, "gender": False, "state": False}, age_ranges=("0-17", "18-64", "50-103"))
NO_GROUPS = ModuleSettings(
    module_name="no_groups", rxcui_include=("I-Brand#4", "M-2"), flags={"age": False, "gender": False, "state": False})
BY_STATE = ModuleSettings(
    module_name="by_state", rxcui_include=("M-0", "I-Brand#6"), ingredient_tty_filter="MIN",
    flags={"age": False, "gender": True, "state": True})
PROFILED = (*COHORTS, ONLY_AGE, NO_GROUPS, BY_STATE)


class Context:
    """Lazily built inputs over one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.fx = Fixtures(spark, sf_dir)

    # -- vocabulary --------------------------------------------------------
    @cached_property
    def built_crosswalk(self) -> DataFrame:
        return build_crosswalk(self.fx.rxnconso, self.fx.rxnrel, self.fx.rxnsat)

    @cached_property
    def dose_form_map(self) -> DataFrame:
        return dose_form_groups(self.fx.rxnconso, self.fx.rxnrel)

    # -- cohorts -------------------------------------------------------------
    def all_ndc_rows(self) -> DataFrame:
        """Flagship cohort: every package resolved to one row."""
        return co.resolve_one_per_ndc(co.whole_crosswalk(self.fx.crosswalk, ALL))

    def module_ndc_rows(self, cohorts=COHORTS) -> DataFrame:
        return co.cohort_ndc_rows(self.spark, self.fx.crosswalk, cohorts, self.dose_form_map,
                                  self.fx.class_members)

    @cached_property
    def reference(self) -> DataFrame:
        return survey_reference(self.fx.prescription, self.fx.demographics)

    def profiled(self, modules=PROFILED) -> ProfiledDistribution:
        """Modules of any demographic profiles in one plan, over staged package rows."""
        ndc = staged(self.module_ndc_rows(modules), "packages")
        return ProfiledDistribution(self.fx.prescription, self.fx.demographics, ndc, self.fx.region_states,
                                    profile_table(self.spark, modules))

    # -- distributions -----------------------------------------------------------
    def distribution(self, ndc_rows: DataFrame | None = None, **flags) -> Distribution:
        return Distribution(self.fx.prescription, self.fx.demographics,
                            self.all_ndc_rows() if ndc_rows is None else ndc_rows,
                            self.fx.region_states, **flags)


# The module of the population comparison: age bands only, one band.
PEDIATRIC = ModuleSettings(module_name=ALL, rxcui_include=("*",), age_ranges=("0-5",),
                           flags={"age": True, "gender": False, "state": False})
# Dose-form filters applied to the built crosswalk.
FORM_FILTER = ModuleSettings(module_name="forms", rxcui_include=("any",),
                             dose_form_filter=("SMALL", "ASIA Product"))
TTY_FILTER = ModuleSettings(module_name="forms", rxcui_include=("any",), ingredient_tty_filter="MIN")
# Class queries resolved by the class membership query.
CLASS_QUERIES = (ClassQuery("ECONOMY", "ATC"), ClassQuery("EPC-SMALL", "has_EPC"),
                 ClassQuery("PROMO", "ATC"), ClassQuery("EPC-LARGE", "has_MoA"))
