"""Small fixed dimensions: survey region -> states, and age bands.

Both are bounded by construction (a geography, a settings list), so they are
the only tables this package broadcasts by hint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import small_table
from ..settings import parse_band

# Fixed values that must equal the reference: survey region code -> states.
REGION_STATES = {
    1: ("Northeast", ["Connecticut", "Maine", "Massachusetts", "New Hampshire", "New Jersey",
                      "New York", "Pennsylvania", "Rhode Island", "Vermont"]),
    2: ("Midwest", ["Indiana", "Illinois", "Iowa", "Kansas", "Michigan", "Minnesota", "Missouri",
                    "Nebraska", "North Dakota", "Ohio", "South Dakota", "Wisconsin"]),
    3: ("South", ["Alabama", "Arkansas", "Delaware", "District of Columbia", "Florida",
                  "Georgia", "Kentucky", "Louisiana", "Maryland", "Mississippi", "North Carolina",
                  "Oklahoma", "South Carolina", "Tennessee", "Texas", "Virginia", "West Virginia"]),
    4: ("West", ["Alaska", "Arizona", "California", "Colorado", "Hawaii", "Idaho", "Montana",
                 "Nevada", "New Mexico", "Oregon", "Utah", "Washington", "Wyoming"]),
}

REGION_LIST_SCHEMA = "region_value int, region_label string, states array<string>"


def region_state_lists(spark: SparkSession) -> DataFrame:
    """(region_value, region_label, states array) -- the nested form."""
    rows = [(k, label, states) for k, (label, states) in REGION_STATES.items()]
    return small_table(spark, rows, REGION_LIST_SCHEMA)


def explode_states(region_lists: DataFrame) -> DataFrame:
    """Nested region rows -> one (region_value, state) row per state."""
    return region_lists.select(
        F.col("region_value").cast("int").alias("region_value"),
        F.explode("states").alias("state"))


def region_states(spark: SparkSession) -> DataFrame:
    """The 51-row survey region -> state table, long form."""
    return explode_states(region_state_lists(spark))


def band_bounds(bands) -> list[tuple[str, int, int]]:
    return [(b, *parse_band(b)) for b in bands]


def with_age_bands(df: DataFrame, age_col: str, bands, out: str = "age") -> DataFrame:
    """Band (range) join by expansion: one row per band containing the age.

    Bands may overlap (the default list puts 65 in two bands); ages outside
    every band are dropped.  The band list comes from settings, so the join
    is a generator over a literal array -- no shuffle, no broadcast, stays in
    whole-stage codegen."""
    age = F.col(age_col).cast("int")
    hits = F.array(*[F.when((age >= lo) & (age <= hi), F.lit(name)) for name, lo, hi in band_bounds(bands)])
    return df.withColumn(out, F.explode(F.array_compact(hits)))


def age_band_values(spark: SparkSession, bands) -> DataFrame:
    """(age, age_values) rows: each band expanded to the ages it holds."""
    rows = [(name, lo, hi) for name, lo, hi in band_bounds(bands)]
    df = spark.createDataFrame(rows, "age string, lo int, hi int")
    return df.select("age", F.explode(F.sequence("lo", "hi")).alias("age_values"))
