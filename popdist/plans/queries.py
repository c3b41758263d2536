"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the driver tables (through the stand-in inputs of
``popdist.fixtures``) and returns a lazy DataFrame.  Single-module queries
drop the constant ``cohort`` column; multi-module ones keep it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import functions as fn
from ..operators import cohort as co
from ..operators import dosage, graph, lookup, states, survey, validation
from ..session import scratch_path, small_table
from ..settings import DEFAULT_AGE_RANGES, ModuleSettings
from ..sources import delimited, profile, sinks
from ..sources import dimensions as dims
from ..sources import fixed_width as fw
from ..operators.json_search import key_values
from ..fixtures import TABLES
from ..operators.profiles import ProfiledDistribution, profile_table
from ..sources.class_members import (
    RELATION_SOURCE,
    SINGLE_RELATION_SOURCES,
    class_query_table,
    members_of_responses,
    resolve_class_members,
    unmatched_class_queries,
)
from ..sources.wide_lookup import read_wide, write_wide
from ..streaming import incremental
from .context import ALL, CLASS_QUERIES, COHORTS, FORM_FILTER, PEDIATRIC, TTY_FILTER, Context

ALL_MODULE = ModuleSettings(module_name=ALL, rxcui_include=("*",))

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Callable[[Context], DataFrame]) -> Callable[[Context], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Context(spark, sf_dir))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    REGISTRY[fn.__name__] = run
    return fn


def _single(df: DataFrame) -> DataFrame:
    return df.drop("cohort")


# -- C9 / C10: distributions ------------------------------------------------

@query
def ingredient_distribution_all(ctx: Context) -> DataFrame:
    """Flagship: P(ingredient | age band, gender, state) over every package."""
    return _single(ctx.distribution(product_level=False).ingredient())


@query
def ingredient_distribution_age(ctx: Context) -> DataFrame:
    """Age flag only: no state filter, so unknown regions stay in."""
    return _single(ctx.distribution(gender=False, state=False, product_level=False).ingredient())


@query
def ingredient_distribution_noflags(ctx: Context) -> DataFrame:
    """No demographics: one share per ingredient over the whole survey."""
    return _single(ctx.distribution(age=False, gender=False, state=False,
                                    product_level=False).ingredient())


@query
def product_distribution_all(ctx: Context) -> DataFrame:
    """P(product | ingredient, age band, gender, state), all ingredients at once."""
    return _single(ctx.distribution().product())


@query
def product_distribution_noflags(ctx: Context) -> DataFrame:
    return _single(ctx.distribution(age=False, gender=False, state=False).product())


@query
def weighted_person_count(ctx: Context) -> DataFrame:
    """Distinct persons per (ingredient, id, weight, demographics), times weight."""
    return _single(ctx.distribution(product_level=False).weighted_person_count())


@query
def ingredient_rollup(ctx: Context) -> DataFrame:
    return _single(ctx.distribution(product_level=False).ingredient_rollup())


@query
def product_rollup(ctx: Context) -> DataFrame:
    return _single(ctx.distribution().product_rollup())


@query
def validation_distribution(ctx: Context) -> DataFrame:
    return _single(ctx.distribution().validation())


@query
def multi_cohort_distribution(ctx: Context) -> DataFrame:
    """Three modules (ids, classes, filters) in one job, keyed by cohort."""
    return ctx.distribution(ctx.module_ndc_rows(), product_level=False).ingredient()


# -- C12: lookup tables ------------------------------------------------------

@query
def lookup_long(ctx: Context) -> DataFrame:
    return _single(lookup.lookup_long(ctx.distribution()))


#: the stand-in vocabulary's names: brands, combinations, and a brand's products
WIDE_INGREDIENTS = [f"Prescribe_Brand_{i}" for i in range(1, 26)] + [f"Prescribe_Combo_{i}" for i in range(3)]
WIDE_PRODUCTS = [f"Prescribe_Brand_{i}_{a}_{b}" for i in range(1, 26)
                 for a in ("Blue", "Cold", "Hot", "Large", "New", "Old", "Red", "Small")
                 for b in ("Anvil", "Bolt", "Gear", "Gizmo", "Plate", "Ring", "Rod", "Widget")]


def _wide(ctx: Context, table: str, names: list[str], **flags) -> DataFrame:
    dist = ctx.distribution(**flags)
    long = lookup.lookup_long(dist)
    return lookup.lookup_wide(long, dist.demos, F.col("lookup_table") == F.lit(table), names)


@query
def lookup_wide_ingredient(ctx: Context) -> DataFrame:
    return _wide(ctx, "all_medications_ingredient_distribution.csv", WIDE_INGREDIENTS)


@query
def lookup_wide_product(ctx: Context) -> DataFrame:
    """The product table of one ingredient (a wide table per lookup file)."""
    return _wide(ctx, "all_medications_combo_0_product_distribution.csv", WIDE_PRODUCTS)


@query
def lookup_wide_noflags(ctx: Context) -> DataFrame:
    return _wide(ctx, "all_medications_ingredient_distribution.csv", WIDE_INGREDIENTS, age=False, gender=False, state=False)


@query
def lookup_csv_roundtrip(ctx: Context) -> DataFrame:
    """Write the long lookup as CSV folders per module and table, read back."""
    path = scratch_path(ctx.spark, "lookup-csv")
    long = lookup.lookup_long(ctx.distribution())
    sinks.write_lookup_long(long, path)
    schema = T.StructType([
        T.StructField("age", T.StringType()), T.StructField("gender", T.StringType()),
        T.StructField("state", T.StringType()), T.StructField("transition", T.StringType()),
        T.StructField("probability", T.DoubleType()), T.StructField("cohort", T.StringType()),
        T.StructField("lookup_table", T.StringType())])
    return _single(sinks.read_csv(ctx.spark, path, schema))


@query
def lookup_wide_files(ctx: Context) -> DataFrame:
    """The wide CSV file of every lookup table of six modules with four
    demographic profiles, written in one job and read back line by line."""
    dist = ctx.profiled().materialize()
    path = scratch_path(ctx.spark, "wide-files")
    write_wide(lookup.lookup_long(dist), dist.profiles, path)
    return read_wide(ctx.spark, path).withColumnRenamed("module", "cohort").withColumnRenamed("file", "lookup_table")


@query
def profile_distribution(ctx: Context) -> DataFrame:
    """Ingredient shares of modules with different flags and bands, in one plan."""
    return ctx.profiled().ingredient()


# -- C1 / C2 / J1: concept graph -------------------------------------------

@query
def build_crosswalk(ctx: Context) -> DataFrame:
    return ctx.built_crosswalk


@query
def typed_path_2hop(ctx: Context) -> DataFrame:
    return graph.traverse(ctx.fx.rxnconso, ctx.fx.rxnrel, "IN", ("ingredient_of", "constitutes"), "SCD")


@query
def typed_path_4hop(ctx: Context) -> DataFrame:
    return graph.traverse(ctx.fx.rxnconso, ctx.fx.rxnrel, "IN",
                          ("ingredient_of", "constitutes", "contained_in", "has_tradename"), "BPCK")


@query
def dose_form_groups(ctx: Context) -> DataFrame:
    return ctx.dose_form_map


# -- C5 - C7: cohorts -------------------------------------------------------------

def _ids(ctx: Context) -> DataFrame:
    return co.cohort_ingredient_ids(ctx.spark, COHORTS, ctx.fx.class_members)


@query
def cohort_include_exclude(ctx: Context) -> DataFrame:
    """(cohort, rxcui): class members and ids to include, minus exclusions."""
    return _ids(ctx)


@query
def match_either_key(ctx: Context) -> DataFrame:
    return co.match_either_key(ctx.fx.crosswalk, _ids(ctx))


@query
def distinct_products(ctx: Context) -> DataFrame:
    return co.distinct_products(co.match_either_key(ctx.fx.crosswalk, _ids(ctx)))


@query
def expand_by_product(ctx: Context) -> DataFrame:
    return co.expand_by_product(ctx.fx.crosswalk, co.match_either_key(ctx.fx.crosswalk, _ids(ctx)))


@query
def resolve_one_per_key(ctx: Context) -> DataFrame:
    matched = co.match_either_key(ctx.fx.crosswalk, _ids(ctx))
    return co.resolve_one_per_ndc(co.expand_by_product(ctx.fx.crosswalk, matched))


@query
def resolve_then_filter(ctx: Context) -> DataFrame:
    return ctx.module_ndc_rows()


@query
def filter_group_include(ctx: Context) -> DataFrame:
    rows = co.whole_crosswalk(ctx.built_crosswalk, FORM_FILTER.module_name)
    return _single(co.filter_by_dose_form(rows, [FORM_FILTER], ctx.dose_form_map, "include"))


@query
def filter_group_exclude(ctx: Context) -> DataFrame:
    rows = co.whole_crosswalk(ctx.built_crosswalk, FORM_FILTER.module_name)
    return _single(co.filter_by_dose_form(rows, [FORM_FILTER], ctx.dose_form_map, "exclude"))


@query
def filter_term_type(ctx: Context) -> DataFrame:
    rows = co.whole_crosswalk(ctx.built_crosswalk, TTY_FILTER.module_name)
    return _single(co.filter_by_ingredient_tty(rows, [TTY_FILTER]))


@query
def class_members(ctx: Context) -> DataFrame:
    queries = class_query_table(ctx.spark, [("classes", q.class_id, q.relationship) for q in CLASS_QUERIES])
    return _single(resolve_class_members(queries, ctx.fx.class_members))


@query
def class_members_by_type(ctx: Context) -> DataFrame:
    """Members of every class under all 24 relationships, from the nested
    answers, of the term types that the relationship asks for."""
    answers = ctx.fx.class_responses
    asked = F.array(*[F.struct(F.lit(r).alias("relationship"), F.lit(s).alias("rela_source"),
                               F.lit(None if r in SINGLE_RELATION_SOURCES else r).alias("rela")) for r, s in RELATION_SOURCE.items()])
    queries = answers.select(F.lit("classes").alias("cohort"), "class_id").distinct().select(
        "cohort", "class_id", F.explode(asked).alias("q")).select("cohort", "class_id", "q.*")
    return _single(resolve_class_members(queries, members_of_responses(answers)))


@query
def match_counts(ctx: Context) -> DataFrame:
    """Package codes left after each step of the cohort chain, per module."""
    steps = {"matched": lambda _: co.match_either_key(ctx.fx.crosswalk, _ids(ctx)),
             "expanded": lambda rows: co.expand_by_product(ctx.fx.crosswalk, rows),
             "resolved": co.resolve_one_per_ndc,
             "filtered": lambda rows: co.filter_by_ingredient_tty(
                 co.filter_by_dose_form(rows, COHORTS, ctx.dose_form_map), COHORTS)}
    return profile.match_counts(steps)


@query
def product_pairs(ctx: Context) -> DataFrame:
    """(product name, product id) pairs of the survey join, with row counts."""
    rows = survey.survey_join(ctx.reference, ctx.all_ndc_rows())
    return rows.groupBy("medication_product_name", "medication_product_rxcui").agg(
        F.count(F.lit(1)).alias("count"))


# -- C3 / C8 / J7 / J8: survey ------------------------------------------------------

@query
def survey_reference(ctx: Context) -> DataFrame:
    return ctx.reference


@query
def survey_join(ctx: Context) -> DataFrame:
    return _single(survey.survey_join(ctx.reference, ctx.all_ndc_rows()))


@query
def decode_gender(ctx: Context) -> DataFrame:
    d = ctx.fx.demographics
    return d.select("DUPERSID", "SEX", fn.decode_gender("SEX").alias("gender"))


@query
def age_band_expand(ctx: Context) -> DataFrame:
    """Bands expanded to single ages, equi-joined to the persons' ages."""
    ages = dims.age_band_values(ctx.spark, DEFAULT_AGE_RANGES)
    d = ctx.fx.demographics.select("DUPERSID", "AGELAST")
    return d.join(F.broadcast(ages), d["AGELAST"] == ages["age_values"]).select("DUPERSID", "AGELAST", "age")


@query
def age_band_join(ctx: Context) -> DataFrame:
    ref = ctx.reference.select("DUPERSID", "RXNDC", "AGELAST")
    return dims.with_age_bands(ref, "AGELAST", DEFAULT_AGE_RANGES)


@query
def region_fanout(ctx: Context) -> DataFrame:
    ref = ctx.reference.select("DUPERSID", "RXNDC", "region_num")
    states = ctx.fx.region_states
    return ref.join(states, ref["region_num"] == states["region_value"]).select(
        "DUPERSID", "RXNDC", "region_num", "state")


@query
def region_states(ctx: Context) -> DataFrame:
    """The nested region -> states form, exploded to long form."""
    nested = ctx.fx.region_states.groupBy("region_value").agg(F.collect_list("state").alias("states"))
    return dims.explode_states(nested)


# -- scalar functions ------------------------------------------------------------------

@query
def text_to_int_prefix(ctx: Context) -> DataFrame:
    t = ctx.fx.t
    texts = (t.lineitem.select(F.lit("quantity").alias("source"), F.col("l_quantity").cast("string").alias("text"))
             .unionByName(t.customer.select(F.lit("balance").alias("source"), F.col("c_acctbal").cast("string").alias("text")))
             .unionByName(t.part.select(F.lit("name").alias("source"), F.col("p_name").alias("text")))
             .unionByName(t.events.select(F.lit("props").alias("source"), F.col("props").alias("text"))))
    return texts.distinct().select("source", "text", fn.text_to_int_prefix("text").alias("value"))


@query
def normalize_camel(ctx: Context) -> DataFrame:
    p = ctx.fx.t.part
    name = F.concat("p_brand", F.lit(" / "), "p_name")
    return p.select("p_partkey", name.alias("name"), fn.normalize_name(name).alias("normalized"))


@query
def normalize_lower(ctx: Context) -> DataFrame:
    p = ctx.fx.t.pages
    return p.select("page_id", "url", fn.normalize_name("url", "lower").alias("normalized"))


@query
def normalize_upper_spaces(ctx: Context) -> DataFrame:
    d = ctx.fx.t.documents
    return d.select("doc_id", "source", fn.normalize_name("source", "upper", spaces=True).alias("normalized"))


@query
def json_key_values(ctx: Context) -> DataFrame:
    e = ctx.fx.t.events
    return e.select("event_id", F.explode(fn.json_key_values("props", "k")).alias("value"))


@query
def json_key_search(ctx: Context) -> DataFrame:
    """Member ids and attribute values in nested answers, at any depth."""
    found = key_values(ctx.fx.class_responses, ["class_id", "rela_source", "rela", "page"], "response", ["rxcui", "attrValue"])
    return found.groupBy("class_id", "rela_source", "rela", "page", "key", "value").agg(F.count("*").alias("n"))


# -- C4 / C17: dosage ----------------------------------------------------------------------

@query
def rx_quantity_days(ctx: Context) -> DataFrame:
    return dosage.rx_quantity_days(ctx.fx.prescription, ctx.fx.crosswalk)


@query
def dosage_instructions(ctx: Context) -> DataFrame:
    return dosage.dosage_instructions(dosage.rx_quantity_days(ctx.fx.prescription, ctx.fx.crosswalk))


# -- C18 - C20: second population ---------------------------------------------------------

def _chosen(ctx: Context) -> DataFrame:
    """The module's products: cleaned names and product ids."""
    return ctx.all_ndc_rows().select(
        "cohort", fn.normalize_name("medication_product_name").alias("medication_product_name"),
        F.col("medication_product_rxcui").alias("code")).distinct()


def _observed(ctx: Context) -> DataFrame:
    return validation.observed_distribution(ctx.fx.medications, ctx.fx.patients, _chosen(ctx))


def _expected(ctx: Context, observed: DataFrame) -> DataFrame:
    dist = ProfiledDistribution(ctx.fx.prescription, ctx.fx.demographics, ctx.all_ndc_rows(), ctx.fx.region_states,
                                profile_table(ctx.spark, [PEDIATRIC]))
    return validation.expected_counts(dist.validation(), observed, PEDIATRIC.age_ranges[0])


@query
def observed_distribution(ctx: Context) -> DataFrame:
    return _single(_observed(ctx))


@query
def expected_counts(ctx: Context) -> DataFrame:
    return _single(_expected(ctx, _observed(ctx)))


@query
def chi_square_table(ctx: Context) -> DataFrame:
    """Observed and expected orders of every product, and the counts that
    independence of the two populations predicts."""
    observed = _observed(ctx)
    table = _single(validation.contingency(observed, _expected(ctx, observed))).drop("k")
    return table.withColumns({c: F.bround(c, 8) for c in ("o_expected", "e_expected")})


@query
def chi_square(ctx: Context) -> DataFrame:
    observed = _observed(ctx)
    told = _single(validation.chi_square(observed, _expected(ctx, observed)))
    return told.withColumn("chi2", F.bround("chi2", 8)).withColumn("p_value", F.bround("p_value", 10))


# -- C14 - C16: states and documents -------------------------------------------------------

@query
def transitions(ctx: Context) -> DataFrame:
    return _single(states.transitions(ctx.distribution()))


@query
def rollup_remarks(ctx: Context) -> DataFrame:
    return _single(states.rollup_remarks(ctx.distribution()))


@query
def order_states(ctx: Context) -> DataFrame:
    pairs = states.prescribed_pairs(ctx.all_ndc_rows(), ctx.fx.prescription, ctx.fx.demographics)
    return _single(states.order_states(pairs, [ALL_MODULE]))


@query
def module_documents(ctx: Context) -> DataFrame:
    """Every state of the JSON documents of three modules, one row per state."""
    dist = ctx.profiled(COHORTS).materialize()
    pairs = states.prescribed_pairs(dist.ndc_rows, ctx.fx.prescription, ctx.fx.demographics)
    return states.module_documents(states.document_pieces(dist, pairs, list(COHORTS)))


# -- sources and sinks ------------------------------------------------------------------------

def _write_layout(df: DataFrame, columns, path: str) -> None:
    """Rows in a full vocabulary layout; fields that ``df`` lacks are empty."""
    delimited.write_pipe(df.select(*[(F.col(c) if c in df.columns else F.lit("")).alias(c) for c in columns[:-1]]), path)


def _layouts(ctx: Context) -> dict[str, tuple[DataFrame, tuple[str, ...], list[str]]]:
    """The three vocabulary files: rows, layout, wanted fields."""
    up = lambda df: df.withColumnsRenamed({c: c.upper() for c in df.columns})
    return {"nodes": (up(ctx.fx.rxnconso), delimited.RXNCONSO_COLUMNS, ["RXCUI", "SAB", "TTY", "STR"]),
            "edges": (up(ctx.fx.rxnrel), delimited.RXNREL_COLUMNS, ["RXCUI1", "RELA", "RXCUI2"]),
            "attributes": (up(ctx.fx.rxnsat), delimited.RXNSAT_COLUMNS, ["RXCUI", "SAB", "ATN", "ATV"])}


def _checked(ctx: Context, layout: str) -> tuple[DataFrame, dict[str, int]]:
    """One vocabulary file with broken lines among the good ones (every nation
    adds a cut line, every region a line with a field too many), read back."""
    rows, columns, wanted = _layouts(ctx)[layout]
    path, away = scratch_path(ctx.spark, layout), scratch_path(ctx.spark, f"{layout}-quarantine")
    _write_layout(rows, columns, path)
    t = ctx.fx.t
    t.nation.select("n_name").unionByName(t.region.select(F.concat("r_name", F.lit("|" * len(columns))).alias("n_name"))).select(
        "n_name").write.mode("append").text(path)
    return delimited.read_pipe_checked(ctx.spark, path, columns, away, most_bad=0.2, columns=wanted)


@query
def scan_pipe_delimited(ctx: Context) -> DataFrame:
    """Vocabulary nodes staged as a pipe file in the full layout, read back."""
    rows, columns, wanted = _layouts(ctx)["nodes"]
    path = scratch_path(ctx.spark, "rxnconso")
    _write_layout(rows, columns, path)
    back = delimited.read_pipe(ctx.spark, path, columns, columns=wanted)
    return back.withColumnsRenamed({c: c.lower() for c in back.columns})


@query
def scan_pipe_quarantined(ctx: Context) -> DataFrame:
    """The good rows of all three vocabulary layouts, broken lines set aside."""
    out = None
    for layout in ("nodes", "edges", "attributes"):
        rows, _ = _checked(ctx, layout)
        fields = [F.col(c) for c in rows.columns] + [F.lit(None).cast("string")] * (4 - len(rows.columns))
        one = rows.select(F.lit(layout).alias("layout"), *[f.alias(f"f{i}") for i, f in enumerate(fields, 1)])
        out = one if out is None else out.unionByName(one)
    return out


@query
def quarantine_counts(ctx: Context) -> DataFrame:
    """Whole and broken lines of each vocabulary layout."""
    rows = [(layout, *_checked(ctx, layout)[1].values()) for layout in ("nodes", "edges", "attributes")]
    return small_table(ctx.spark, rows, "layout string, whole long, broken long")


@query
def scan_fixed_width(ctx: Context) -> DataFrame:
    """Prescriptions staged in the 66-field fixed-width layout, read back."""
    path = scratch_path(ctx.spark, "rx-fixed")
    fw.write_fixed_width(ctx.fx.prescription, fw.PRESCRIPTION_SPECS, path, 610)
    back = fw.read_fixed_width(ctx.spark, path, fw.PRESCRIPTION_SPECS)
    return back.select("DUPERSID", "RXNDC", "RXQUANTY", "RXDAYSUP")


@query
def scan_fixed_width_pruned(ctx: Context) -> DataFrame:
    """Persons staged at their positions in a 4 332-wide line; five fields
    read, year digits stripped from the names."""
    path = scratch_path(ctx.spark, "person-fixed")
    d = ctx.fx.demographics.select(
        "DUPERSID", F.col("PERWTF").alias("PERWT18F"), F.col("REGION").alias("REGION18"), "SEX",
        F.least("AGELAST", F.lit(99)).alias("AGELAST"))  # the layout's two characters: ages are top-coded
    fw.write_fixed_width(d, fw.PERSON_SPECS, path, 4332)
    return fw.read_person_file(ctx.spark, path)


@query
def scan_tsv_cp1252(ctx: Context) -> DataFrame:
    """A directory-style table staged as Windows-1252 TSV with header, read back."""
    path = scratch_path(ctx.spark, "part-tsv")
    part = ctx.fx.t.part
    delimited.write_tsv(part, path)
    back = delimited.read_tsv(ctx.spark, path)
    return back.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in part.schema.fields])


@query
def incremental_match(ctx: Context) -> DataFrame:
    """Order files ingested as a stream, joined to the chosen products."""
    src = scratch_path(ctx.spark, "orders-in")
    ctx.fx.medications.repartition(6).write.mode("overwrite").option("header", True).csv(src)
    chosen = _chosen(ctx).select("medication_product_name", "code").distinct()
    out = incremental.run_order_ingest(ctx.spark, src, chosen, scratch_path(ctx.spark, "orders-out"),
                                       scratch_path(ctx.spark, "orders-ckpt"))
    return out.select("START", "PATIENT", "CODE", "medication_product_name")


@query
def scan_tsv_marks(ctx: Context) -> DataFrame:
    """Text with characters that only Windows-1252 has, through a TSV file."""
    path = scratch_path(ctx.spark, "marks-tsv")
    marks = "\u20ac \u017e \u2122 \u2013 \u0152 \u00e9 \u00fc"
    t = ctx.fx.t.part
    delimited.write_tsv(t.select("p_partkey", F.concat("p_name", F.lit(f" {marks}")).alias("label \u20ac")), path)
    back = delimited.read_tsv(ctx.spark, path)
    return back.select(F.col("p_partkey").cast("bigint").alias("p_partkey"), F.col("label \u20ac").alias("label"))


@query
def stored_row_counts(ctx: Context) -> DataFrame:
    """Row counts of the driver's tables, from the Parquet footers."""
    return profile.stored_row_counts(ctx.spark, {t: f"{ctx.fx.t.sf_dir}/{t}.parquet" for t in TABLES})


@query
def survey_by_state(ctx: Context) -> DataFrame:
    """Persons and weights of each of the 51 states of the survey's regions."""
    per_region = ctx.fx.demographics.groupBy(F.col("REGION").alias("region_value")).agg(
        F.count("*").alias("persons"), F.sum("PERWTF").alias("weight"))
    return dims.region_states(ctx.spark).join(per_region, "region_value").select("region_value", "state", "persons", "weight")


@query
def table_row_counts(ctx: Context) -> DataFrame:
    fx = ctx.fx
    return profile.table_row_counts({
        "demographics": fx.demographics, "prescription": fx.prescription, "crosswalk": fx.crosswalk,
        "rxnconso": fx.rxnconso, "rxnrel": fx.rxnrel, "rxnsat": fx.rxnsat,
        "region_states": fx.region_states})


@query
def scan_csv_columns(ctx: Context) -> DataFrame:
    """A medication-order CSV with more columns than used, read with its
    schema and only the three used columns kept (the order-file reader)."""
    path = scratch_path(ctx.spark, "orders-csv")
    t = ctx.fx.t
    li, o = t.lineitem, t.orders
    wide = li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.to_date("l_shipdate").alias("START"), F.to_date("o_orderdate").alias("STOP"),
        F.col("o_custkey").cast("string").alias("PATIENT"), F.col("l_suppkey").cast("string").alias("PAYER"),
        F.col("l_partkey").cast("bigint").alias("CODE"), F.col("l_extendedprice").alias("BASE_COST"))
    wide.write.mode("overwrite").option("header", True).csv(path)
    return delimited.read_csv_columns(ctx.spark, path, wide.schema, ["START", "PATIENT", "CODE"])


@query
def class_queries_unmatched(ctx: Context) -> DataFrame:
    """Class queries that found no member, reported instead of silently empty."""
    queries = class_query_table(ctx.spark, [("classes", q.class_id, q.relationship) for q in CLASS_QUERIES])
    return _single(unmatched_class_queries(queries, ctx.fx.class_members)).select(
        "class_id", "relationship", "rela_source")
