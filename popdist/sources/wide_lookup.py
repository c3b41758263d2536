"""Wide lookup files: one CSV per lookup table, each with its own columns.

The table's cells and its distinct transition names travel as long rows to the
task that writes the file, sorted: names first, then cells by demographic
group.  The task holds one header and one line at a time.  No table's names are
ever columns of a plan, so any number of tables with any headers is one job.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .module_files import read_module_files, write_module_files

DEMOS = ("age", "gender", "state")
_LINES = "module string, file string, line string"


def csv_line(values: Sequence[object]) -> str:
    """One CSV line; numbers as Python writes them, text quoted where needed."""
    out = io.StringIO()
    csv.writer(out, lineterminator="").writerow(values)
    return out.getvalue()


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table = group = None
    places: dict[str, int] = {}
    used: list[int] = []
    cells: list[float | None] = []
    out: list[tuple[str, str, str]] = []

    def line_done():
        if group is not None:
            out.append((*table, csv_line([*(group[i] for i in used), *(c or 0.0 for c in cells)])))

    def header_done():
        if table is not None and group is None:
            out.append((*table, csv_line([*(DEMOS[i] for i in used), *places])))

    for b in batches:
        names = ("cohort", "lookup_table", "used", "is_cell", *DEMOS, "transition", "probability")
        for cohort, file, flags, is_cell, *key, transition, value in zip(*(b.column(c).to_pylist() for c in names)):
            if (cohort, file) != table:
                line_done()
                table, group, places = (cohort, file), None, {}
                used = [i for i in range(len(DEMOS)) if flags[i]]
            if not is_cell:
                places[transition] = len(places)
                continue
            if key != group:
                if group is None:
                    header_done()
                line_done()
                group, cells = key, [None] * len(places)
            at = places[transition]
            if cells[at] is not None:
                raise ValueError(f"two cells for {transition} of {cohort}/{file} at {key}")
            cells[at] = 0.0 if value is None else value
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], names=["module", "file", "line"])
            out.clear()
    line_done()
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*out)], names=["module", "file", "line"])


def wide_lines(long: DataFrame, profiles: DataFrame) -> DataFrame:
    """(module, file, line): the CSV lines of every table of ``long`` (cohort,
    lookup_table, age, gender, state, transition, probability), in order within
    its partition.  A line per demographic group that the table has, null first;
    columns for the demographics that the module uses, then one per transition
    of the table, in name order; missing cells 0.0.  Two cells of one group and
    one transition are an error."""
    flags = profiles.select("cohort", F.array("use_age", "use_gender", "use_state").alias("used"))
    blank = [F.lit(None).cast("string").alias(c) for c in DEMOS]
    cells = long.select("cohort", "lookup_table", F.lit(True).alias("is_cell"), *DEMOS, "transition", "probability")
    names = long.select("cohort", "lookup_table", "transition").distinct().select(
        "cohort", "lookup_table", F.lit(False).alias("is_cell"), *blank, "transition",
        F.lit(None).cast("double").alias("probability"))
    rows = cells.unionByName(names).join(flags, "cohort")
    order = ["cohort", "lookup_table", "is_cell", *DEMOS, "transition"]
    return rows.repartition("cohort", "lookup_table").sortWithinPartitions(*order).mapInArrow(_lines, _LINES)


def write_wide(long: DataFrame, profiles: DataFrame, path: str) -> None:
    """A file ``<path>/<module>/<lookup table>`` for every table of ``long``."""
    write_module_files(wide_lines(long, profiles), path)


def read_wide(spark: SparkSession, path: str) -> DataFrame:
    return read_module_files(spark, path)
