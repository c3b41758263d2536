"""The module build: every output of many modules in one job.

Settings are keyed tables and every output has a ``cohort`` column, so the
plan of two thousand modules of any demographic profiles is the plan of one.
The resolved package rows, the region-level weights and the remark lines are
staged once in the folder named by ``spark.checkpoint.dir``; all outputs are
derived from them.  Outputs are written with replace semantics:

* ``lookup_tables/`` long lookup CSV, one folder per module and table
* ``wide_tables/<module>/<table>.csv`` the files that the documents name
* ``modules/<module>/<module>.json`` module documents
* ``log/ndc_rows/`` the resolved package rows per module (CSV)
* ``log/survey_rows/`` the survey join of every module (CSV)
* ``log/validation/`` the validation table (CSV)
* ``log/remarks/`` remark lines (CSV)
* ``log/text/<module>/remarks.txt`` title block, settings, headers and remark lines (text)
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators import cohort as co
from ..operators import lookup, states
from ..operators.profiles import ProfiledDistribution, profile_table
from ..operators.survey import survey_join, survey_reference
from ..session import staged
from ..settings import AppSettings, ModuleSettings
from ..sources import sinks
from ..sources.module_files import write_module_files
from ..sources.wide_lookup import write_wide


@dataclass
class BuildInputs:
    prescription: DataFrame
    demographics: DataFrame
    crosswalk: DataFrame
    dose_form_map: DataFrame
    region_states: DataFrame
    class_members: DataFrame | None = None


def build_modules(spark: SparkSession, inputs: BuildInputs, modules: list[ModuleSettings], out_dir: str,
                  app: AppSettings = AppSettings()) -> dict[str, str]:
    """Build every module; returns the output folders."""
    out_dir = out_dir.rstrip("/")
    ndc_rows = staged(co.cohort_ndc_rows(spark, inputs.crosswalk, modules, inputs.dose_form_map,
                                         inputs.class_members), "build-packages")
    profiles = profile_table(spark, modules, app)
    dist = ProfiledDistribution(inputs.prescription, inputs.demographics, ndc_rows, inputs.region_states,
                                profiles).materialize()
    long = lookup.lookup_long(dist, app)
    pairs = states.prescribed_pairs(ndc_rows, inputs.prescription, inputs.demographics)

    paths = {name: f"{out_dir}/{name}" for name in ("lookup_tables", "wide_tables", "modules")} | {
        name: f"{out_dir}/log/{folder}" for name, folder in (
            ("ndc_rows", "ndc_rows"), ("survey_rows", "survey_rows"), ("validation", "validation"),
            ("remarks", "remarks"), ("remarks_log", "text"))}
    sinks.write_lookup_long(long, paths["lookup_tables"])
    write_wide(long, profiles, paths["wide_tables"])
    write_module_files(states.document_lines(states.document_pieces(dist, pairs, modules, app)), paths["modules"])
    write_module_files(states.remark_lines(states.remark_pieces(dist, modules, app)), paths["remarks_log"])
    reference = survey_reference(inputs.prescription, inputs.demographics)
    for name, rows in (("ndc_rows", ndc_rows), ("survey_rows", survey_join(reference, ndc_rows)),
                       ("remarks", states.rollup_remarks(dist, app).select("cohort", "state", "line_no", "line"))):
        rows.write.mode("overwrite").partitionBy("cohort").option("header", True).csv(paths[name])
    sinks.write_csv(dist.validation(), paths["validation"])
    return paths
