"""Registered oracle SQL: query name -> DuckDB SQL over the driver tables."""

from __future__ import annotations

from . import oracle as o
from . import oracle_classes as oc
from . import oracle_modules as om
from . import oracle_sources as os_
from .context import CLASS_QUERIES, COHORTS, FORM_FILTER, PROFILED, TTY_FILTER

_COHORT_COLS = ("cohort, medication_ingredient_rxcui, medication_ingredient_name, medication_ingredient_tty, "
                "medication_product_rxcui, medication_product_name, dose_form_name, medication_ndc")

ORACLES: dict[str, str] = {
    # distributions
    "ingredient_distribution_all": o.ingredient_sql(),
    "ingredient_distribution_age": o.ingredient_sql(gender=False, state=False),
    "ingredient_distribution_noflags": o.ingredient_sql(age=False, gender=False, state=False),
    "product_distribution_all": o.product_sql(),
    "product_distribution_noflags": o.product_sql(age=False, gender=False, state=False),
    "weighted_person_count": o.weighted_person_count_sql(),
    "ingredient_rollup": o.ingredient_rollup_sql(),
    "product_rollup": o.product_rollup_sql(),
    "validation_distribution": o.validation_sql(),
    "multi_cohort_distribution": o.multi_cohort_sql(COHORTS),
    # lookups
    "lookup_long": o.lookup_long_sql(),
    "lookup_csv_roundtrip": o.lookup_long_sql(),
    "lookup_wide_ingredient": o.lookup_wide_sql("all_medications_ingredient_distribution.csv", o.WIDE_INGREDIENT_NAMES),
    "lookup_wide_product": o.lookup_wide_sql("all_medications_combo_0_product_distribution.csv", o.WIDE_PRODUCT_NAMES),
    "lookup_wide_noflags": o.lookup_wide_sql("all_medications_ingredient_distribution.csv", o.WIDE_INGREDIENT_NAMES,
                                             age=False, gender=False, state=False),
    "lookup_wide_files": om.wide_files_sql(PROFILED, o.DEFAULT_BANDS),
    "profile_distribution": om.profile_sql(PROFILED, o.DEFAULT_BANDS),
    "module_documents": om.documents_sql(COHORTS),
    # concept graph
    "build_crosswalk": o.build_crosswalk_sql(),
    "typed_path_2hop": o.typed_path_sql("IN", ("ingredient_of", "constitutes"), "SCD"),
    "typed_path_4hop": o.typed_path_sql(
        "IN", ("ingredient_of", "constitutes", "contained_in", "has_tradename"), "BPCK"),
    "dose_form_groups": o.dose_form_groups_sql(),
    # cohorts
    "cohort_include_exclude": o.cohort_sql(COHORTS, "SELECT cohort, rxcui FROM ids"),
    "match_either_key": o.cohort_sql(COHORTS, f"SELECT {_COHORT_COLS} FROM matched"),
    "distinct_products": o.cohort_sql(COHORTS, "SELECT DISTINCT cohort, medication_product_rxcui FROM matched"),
    "expand_by_product": o.cohort_sql(COHORTS, f"SELECT {_COHORT_COLS} FROM expanded"),
    "resolve_one_per_key": o.cohort_sql(COHORTS, f"SELECT {_COHORT_COLS} FROM resolved"),
    "resolve_then_filter": o.cohort_sql(COHORTS, f"SELECT {_COHORT_COLS} FROM ndc"),
    "filter_group_include": o.form_filter_sql(FORM_FILTER.dose_form_filter, "include"),
    "filter_group_exclude": o.form_filter_sql(FORM_FILTER.dose_form_filter, "exclude"),
    "filter_term_type": o.term_type_sql(TTY_FILTER.ingredient_tty_filter),
    "class_members": o.class_members_sql(CLASS_QUERIES),
    "class_queries_unmatched": o.unmatched_classes_sql(CLASS_QUERIES),
    "class_members_by_type": oc.by_type_sql(),
    "json_key_search": oc.key_search_sql(),
    "match_counts": o.match_counts_sql(COHORTS),
    "product_pairs": o.product_pairs_sql(),
    # survey
    "survey_reference": o.survey_sql("SELECT * FROM ref"),
    "survey_join": o.survey_sql(o.SURVEY_JOIN_SELECT),
    "decode_gender": o.with_(o.FX_DEMOGRAPHICS) + """SELECT DUPERSID, SEX,
  CASE WHEN SEX = '1' THEN 'M' WHEN SEX = '2' THEN 'F' END AS gender FROM fx_demographics""",
    "age_band_expand": o.survey_sql("""SELECT d.DUPERSID, d.AGELAST, b.age FROM fx_demographics d
JOIN bands b ON d.AGELAST BETWEEN b.lo AND b.hi"""),
    "age_band_join": o.survey_sql("""SELECT ref.DUPERSID, ref.RXNDC, ref.AGELAST, b.age FROM ref
JOIN bands b ON ref.AGELAST BETWEEN b.lo AND b.hi"""),
    "region_fanout": o.survey_sql("""SELECT ref.DUPERSID, ref.RXNDC, ref.region_num, s.state FROM ref
JOIN fx_region_states s ON ref.region_num = s.region_value"""),
    "region_states": o.with_(o.FX_REGION_STATES) + "SELECT region_value, state FROM fx_region_states",
    # scalar functions
    "text_to_int_prefix": o.text_to_int_prefix_sql(),
    "normalize_camel": f"""SELECT p_partkey, p_brand || ' / ' || p_name AS name,
  {o.clean("p_brand || ' / ' || p_name")} AS normalized FROM part""",
    "normalize_lower": f"SELECT page_id, url, {o.clean('url', 'lower')} AS normalized FROM pages",
    "normalize_upper_spaces": f"SELECT doc_id, source, {o.clean('source', 'upper', True)} AS normalized FROM documents",
    "json_key_values": """SELECT event_id, json_extract_string(props, '$.k') AS value FROM events
WHERE json_extract(props, '$.k') IS NOT NULL""",
    # dosage
    "rx_quantity_days": o.rx_quantity_days_sql(),
    "dosage_instructions": o.dosage_sql(),
    # second population
    "observed_distribution": o.observed_sql(),
    "expected_counts": o.expected_sql(),
    "chi_square_table": o.chi_square_table_sql(),
    "chi_square": o.chi_square_sql(),
    # states
    "transitions": o.transitions_sql(),
    "rollup_remarks": o.remarks_sql(),
    "order_states": o.order_states_sql(),
    # sources
    "scan_pipe_delimited": o.with_(o.FX_RXNCONSO) + "SELECT rxcui, sab, tty, str FROM fx_rxnconso",
    "scan_fixed_width": o.with_(o.FX_PRESCRIPTION) + "SELECT DUPERSID, RXNDC, RXQUANTY, RXDAYSUP FROM fx_prescription",
    # the person layout gives the age two characters: ages are top-coded at 99
    "scan_fixed_width_pruned": o.with_(o.FX_DEMOGRAPHICS) + """SELECT DUPERSID, CAST(PERWTF AS VARCHAR) AS PERWTF,
  CAST(REGION AS VARCHAR) AS REGION, SEX, CAST(least(AGELAST, 99) AS VARCHAR) AS AGELAST FROM fx_demographics""",
    "scan_tsv_cp1252": "SELECT * FROM part",
    "scan_pipe_quarantined": os_.quarantined_sql(),
    "quarantine_counts": os_.quarantine_counts_sql(),
    "scan_tsv_marks": os_.MARKS,
    "stored_row_counts": os_.stored_counts_sql(),
    "survey_by_state": os_.by_state_sql(),
    "incremental_match": o.incremental_sql(),
    "table_row_counts": o.row_counts_sql(),
    "scan_csv_columns": """SELECT CAST(l_shipdate AS DATE) AS START, CAST(o_custkey AS VARCHAR) AS PATIENT,
  l_partkey AS CODE FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
}
