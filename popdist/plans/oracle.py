"""Independent SQL oracles (DuckDB dialect) for the registered queries.

Written in another form than the Spark code: the stand-in inputs as CTEs,
outer joins where the Spark code uses inner ones, ``BETWEEN`` for bands,
window totals where Spark joins aggregates back, ``round_even`` for
half-even rounding.  Only the driver tables are visible to these queries.
"""

from __future__ import annotations

# Fixed values, written out here again: age bands (name, first, last age), the
# prefix of state names, the paths from ingredients to products.
BANDS = (("0-3", 0, 3), ("4-7", 4, 7), ("8-11", 8, 11), ("12-17", 12, 17), ("18-25", 18, 25), ("26-35", 26, 35),
         ("36-45", 36, 45), ("46-65", 46, 65), ("65-103", 65, 103))
STATE_PREFIX = "Prescribe_"
PATHS = (
    ("IN", "ingredient_of constitutes", "SCD"), ("IN", "has_tradename ingredient_of", "SBD"),
    ("IN", "ingredient_of constitutes contained_in", "GPCK"),
    ("IN", "ingredient_of constitutes contained_in has_tradename", "BPCK"),
    ("MIN", "ingredients_of", "SCD"), ("MIN", "ingredients_of has_tradename", "SBD"),
    ("MIN", "ingredients_of contained_in", "GPCK"), ("MIN", "ingredients_of has_tradename contained_in", "BPCK"),
)
DEFAULT_BANDS = tuple(name for name, _, _ in BANDS)

# -- stand-in inputs ---------------------------------------------------------

FX_DEMOGRAPHICS = """fx_demographics AS (
  SELECT CAST(c_custkey AS VARCHAR) AS DUPERSID,
    CAST(CASE WHEN c_custkey % 97 = 0 THEN 0 ELSE floor(abs(c_acctbal)) END AS BIGINT) AS PERWTF,
    CASE WHEN c_custkey % 50 = 0 THEN '9' WHEN c_custkey % 2 = 0 THEN '1' ELSE '2' END AS SEX,
    CAST((c_custkey * 7) % 106 - 1 AS INTEGER) AS AGELAST,
    CAST(CASE WHEN c_custkey % 41 = 0 THEN -1 ELSE n_regionkey END AS INTEGER) AS REGION
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

FX_PRESCRIPTION = """fx_prescription AS (
  SELECT CAST(o_custkey AS VARCHAR) AS DUPERSID, CAST(l_partkey AS VARCHAR) AS RXNDC,
    CAST(l_quantity AS VARCHAR) AS RXQUANTY, CAST((l_linenumber - 1) * 15 AS VARCHAR) AS RXDAYSUP
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

FX_CROSSWALK = """fx_crosswalk AS (
  SELECT 'I-' || p_brand AS medication_ingredient_rxcui, p_brand AS medication_ingredient_name,
    'IN' AS medication_ingredient_tty, 'P-' || p_brand || '-' || p_name AS medication_product_rxcui,
    p_brand || ' / ' || p_name AS medication_product_name, p_type AS dose_form_name,
    CAST(p_partkey AS VARCHAR) AS medication_ndc
  FROM part
  UNION ALL
  SELECT 'M-' || CAST(p_size % 3 AS VARCHAR), 'Combo/' || CAST(p_size % 3 AS VARCHAR), 'MIN',
    'P-' || p_brand || '-' || p_name, p_brand || ' / ' || p_name, p_type, CAST(p_partkey AS VARCHAR)
  FROM part WHERE p_partkey % 5 = 0)"""

FX_REGION_STATES = """fx_region_states AS (
  SELECT CAST(r_regionkey AS INTEGER) AS region_value, n_name AS state
  FROM region JOIN nation ON n_regionkey = r_regionkey)"""

FX_RXNCONSO = """fx_rxnconso AS (
  SELECT 'R' || CAST(r_regionkey AS VARCHAR) AS rxcui, 'RXNORM' AS sab, 'IN' AS tty, r_name AS str FROM region
  UNION ALL SELECT 'N' || CAST(n_nationkey AS VARCHAR), 'RXNORM', 'SCDC', n_name FROM nation
  UNION ALL SELECT 'C' || CAST(c_custkey AS VARCHAR), 'RXNORM', 'SCD', c_name FROM customer
  UNION ALL SELECT 'O' || CAST(o_orderkey AS VARCHAR), 'RXNORM', 'GPCK', 'Pack ' || CAST(o_orderkey AS VARCHAR) FROM orders
  UNION ALL SELECT 'K' || CAST(o_orderkey AS VARCHAR), 'RXNORM', 'BPCK', 'Brand pack ' || CAST(o_orderkey AS VARCHAR) FROM orders
  UNION ALL SELECT DISTINCT 'B-' || p_brand, 'RXNORM', 'BN', p_brand FROM part
  UNION ALL SELECT 'P' || CAST(p_partkey AS VARCHAR), 'RXNORM', 'SBD', p_name FROM part
  UNION ALL SELECT DISTINCT 'M-' || c_mktsegment, 'RXNORM', 'MIN', c_mktsegment FROM customer
  UNION ALL SELECT DISTINCT 'D-' || p_type, 'RXNORM', 'DF', p_type FROM part
  UNION ALL SELECT 'G' || CAST(r_regionkey AS VARCHAR), 'RXNORM', 'DFG', r_name || ' Product' FROM region)"""

FX_RXNREL = """fx_rxnrel AS (
  SELECT 'N' || CAST(n_nationkey AS VARCHAR) AS rxcui1, 'ingredient_of' AS rela, 'R' || CAST(n_regionkey AS VARCHAR) AS rxcui2 FROM nation
  UNION ALL SELECT 'C' || CAST(c_custkey AS VARCHAR), 'constitutes', 'N' || CAST(c_nationkey AS VARCHAR) FROM customer
  UNION ALL SELECT 'O' || CAST(o_orderkey AS VARCHAR), 'contained_in', 'C' || CAST(o_custkey AS VARCHAR) FROM orders
  UNION ALL SELECT 'K' || CAST(o_orderkey AS VARCHAR), 'has_tradename', 'O' || CAST(o_orderkey AS VARCHAR) FROM orders
  UNION ALL SELECT DISTINCT 'B-' || p_brand, 'has_tradename', 'R' || CAST(p_size % 5 AS VARCHAR) FROM part
  UNION ALL SELECT 'P' || CAST(p_partkey AS VARCHAR), 'ingredient_of', 'B-' || p_brand FROM part
  UNION ALL SELECT 'C' || CAST(c_custkey AS VARCHAR), 'ingredients_of', 'M-' || c_mktsegment FROM customer
  UNION ALL SELECT 'P' || CAST(p_partkey AS VARCHAR), 'has_tradename', 'C' || CAST(p_partkey AS VARCHAR) FROM part
  UNION ALL SELECT 'K' || CAST(o_orderkey AS VARCHAR), 'contained_in', 'P' || CAST(o_custkey AS VARCHAR) FROM orders
  UNION ALL SELECT 'D-' || p_type, 'has_dose_form', 'P' || CAST(p_partkey AS VARCHAR) FROM part
  UNION ALL SELECT 'G' || CAST(p_size % 5 AS VARCHAR), 'isa', 'D-' || p_type FROM part WHERE p_type <> 'PROMO')"""

FX_RXNSAT = """fx_rxnsat AS (
  SELECT 'P' || CAST(p_partkey AS VARCHAR) AS rxcui, 'RXNORM' AS sab, 'NDC' AS atn, '7' || CAST(p_partkey AS VARCHAR) AS atv FROM part
  UNION ALL SELECT 'C' || CAST(c_custkey AS VARCHAR), 'RXNORM', 'NDC', '8' || CAST(c_custkey AS VARCHAR) FROM customer
  UNION ALL SELECT 'O' || CAST(o_orderkey AS VARCHAR), 'RXNORM', 'NDC', '9' || CAST(o_orderkey AS VARCHAR) FROM orders
  UNION ALL SELECT 'K' || CAST(o_orderkey AS VARCHAR), 'RXNORM', CASE WHEN o_orderkey % 2 = 0 THEN 'NDC' ELSE 'OTHER' END, '6' || CAST(o_orderkey AS VARCHAR) FROM orders)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# -- scalar helpers ------------------------------------------------------------

def title(expr: str) -> str:
    return ("array_to_string(list_transform(regexp_extract_all(" + expr +
            ", '[A-Za-z]+|[^A-Za-z]+'), lambda x: upper(x[1]) || lower(x[2:])), '')")


def clean(expr: str, case: str = "camel", spaces: bool = False) -> str:
    s = f"regexp_replace(regexp_replace(regexp_replace({expr}, '[^a-zA-Z0-9]', '_', 'g'), '_{{2,}}', '_', 'g'), '_$', '')"
    if case == "lower":
        s = f"lower({s})"
    elif case == "upper":
        s = f"upper({s})"
    elif case == "camel":
        s = title(s)
    if spaces:
        s = f"replace({s}, '_', ' ')"
    return s


def ratio(part: str, total: str) -> str:
    return f"COALESCE(round_even(CAST({part} AS DOUBLE) / NULLIF(CAST({total} AS DOUBLE), 0), 3), 0.0)"


def bands_values(bands=DEFAULT_BANDS) -> str:
    """The bands as rows: a known band's ages as written above, another one's
    from its name, cut by SQL."""
    known = {name: f"('{name}', {lo}, {hi})" for name, lo, hi in BANDS}
    rows = ", ".join(known.get(b, f"('{b}', CAST(split_part('{b}', '-', 1) AS INTEGER), CAST(split_part('{b}', '-', 2) AS INTEGER))")
                     for b in bands)
    return f"bands AS (SELECT * FROM (VALUES {rows}) b(age, lo, hi))"


FX_CLASS_MEMBERS = """fx_class_members AS (
  SELECT p_type AS class_id, 'ATC' AS rela_source, CAST(NULL AS VARCHAR) AS rela, 'I-' || p_brand AS rxcui FROM part
  UNION ALL SELECT 'EPC-' || p_type, 'DailyMed', 'has_EPC', 'I-' || p_brand FROM part)"""

DFG_MAP = """dfg_map AS (
  SELECT DISTINCT d.str AS df, g.str AS dfg
  FROM fx_rxnconso d
  LEFT JOIN fx_rxnrel r ON r.rxcui2 = d.rxcui AND r.rela = 'isa'
  LEFT JOIN fx_rxnconso g ON g.rxcui = r.rxcui1 AND g.sab = 'RXNORM' AND g.tty = 'DFG'
  WHERE d.sab = 'RXNORM' AND d.tty = 'DF')"""

ORDER_ONE = ("medication_ingredient_tty DESC, medication_ingredient_rxcui, medication_product_rxcui, "
             "medication_ingredient_name, medication_product_name, dose_form_name NULLS FIRST")

# The flagship cohort: every package resolved to its highest term type.
NDC_ALL = f"""ndc AS (
  SELECT 'all_medications' AS cohort, * FROM fx_crosswalk
  QUALIFY row_number() OVER (PARTITION BY medication_ndc ORDER BY {ORDER_ONE}) = 1)"""

REF = """ref AS (
  SELECT DISTINCT p.DUPERSID, d.PERWTF AS person_weight, p.RXNDC,
    CASE WHEN d.SEX = '1' THEN 'M' WHEN d.SEX = '2' THEN 'F' END AS gender,
    d.AGELAST, d.REGION AS region_num
  FROM fx_prescription p JOIN fx_demographics d ON p.DUPERSID = d.DUPERSID)"""


def q(v: str) -> str:
    return "'" + v.replace("'", "''") + "'"


def cohort_chain(cohorts) -> list[str]:
    """CTEs ids, matched, expanded, resolved, ndc for a list of modules,
    written with IN / EXISTS / QUALIFY."""
    from .oracle_classes import source_of

    def side(which: str) -> str:
        parts = []
        for m in cohorts:
            for r in getattr(m, f"rxcui_{which}") or ():
                parts.append(f"SELECT {q(m.module_name)} AS cohort, {q(r)} AS rxcui")
            for cq in getattr(m, f"rxclass_{which}") or ():
                src, many = source_of(cq.relationship)
                rela = f" AND rela = {q(cq.relationship)}" if many else ""
                parts.append(f"SELECT {q(m.module_name)} AS cohort, rxcui FROM fx_class_members "
                             f"WHERE class_id = {q(cq.class_id)} AND rela_source = {q(src)}{rela}")
        if not parts:
            parts.append("SELECT CAST(NULL AS VARCHAR) AS cohort, CAST(NULL AS VARCHAR) AS rxcui WHERE false")
        return "\n  UNION ALL ".join(parts)

    def match(name: str, ids: str) -> str:
        return f"""{name} AS (
  SELECT c.cohort, x.* FROM fx_crosswalk x, (SELECT DISTINCT cohort FROM {ids}) c
  WHERE x.medication_ingredient_rxcui IN (SELECT rxcui FROM {ids} i WHERE i.cohort = c.cohort)
     OR x.medication_product_rxcui IN (SELECT rxcui FROM {ids} i WHERE i.cohort = c.cohort))"""

    ctes = [
        f"ids_inc AS (\n  {side('include')})",
        f"ids_exc AS (\n  {side('exclude')})",
        """ids AS (SELECT DISTINCT cohort, rxcui FROM ids_inc i
  WHERE NOT EXISTS (SELECT 1 FROM ids_exc e WHERE e.cohort = i.cohort AND e.rxcui = i.rxcui))""",
        match("matched", "ids"),
        "prods AS (SELECT DISTINCT cohort, medication_product_rxcui AS rxcui FROM matched)",
        match("expanded", "prods"),
        f"""resolved AS (SELECT * FROM expanded
  QUALIFY row_number() OVER (PARTITION BY cohort, medication_ndc ORDER BY {ORDER_ONE}) = 1)""",
    ]
    form_conds, tty_conds = [], []
    for m in cohorts:
        if isinstance(m.dose_form_filter, (list, tuple)):
            vals = ", ".join(q(v) for v in m.dose_form_filter) or "NULL"
            form_conds.append(
                f"WHEN cohort = {q(m.module_name)} THEN dose_form_name IN "
                f"(SELECT df FROM dfg_map WHERE df IN ({vals}) OR dfg IN ({vals}))")
        if m.ingredient_tty_filter in ("IN", "MIN"):
            tty_conds.append(f"WHEN cohort = {q(m.module_name)} THEN medication_ingredient_tty = {q(m.ingredient_tty_filter)}")
    form = f"COALESCE(CASE {' '.join(form_conds)} ELSE TRUE END, FALSE)" if form_conds else "TRUE"
    tty = f"CASE {' '.join(tty_conds)} ELSE TRUE END" if tty_conds else "TRUE"
    ctes.append(f"ndc AS (SELECT * FROM resolved WHERE {form} AND {tty})")
    return ctes


def joined_cte(age: bool, state: bool) -> str:
    """Survey rows joined to packages, bands and states (fan-out first, the
    way the reference does it)."""
    band_join = "JOIN bands ON ref.AGELAST BETWEEN bands.lo AND bands.hi" if age else ""
    state_join = "JOIN fx_region_states s ON ref.region_num = s.region_value" if state else ""
    age_col = "bands.age" if age else "NULL AS age"
    state_col = "s.state" if state else "NULL AS state"
    return f"""j AS (
  SELECT ndc.cohort, ref.DUPERSID, ref.person_weight, COALESCE(ref.gender, 'None') AS gender,
    {age_col}, {state_col},
    {clean('ndc.medication_ingredient_name')} AS medication_ingredient_name, ndc.medication_ingredient_rxcui,
    {clean('ndc.medication_product_name')} AS medication_product_name, ndc.medication_product_rxcui
  FROM ref JOIN ndc ON ref.RXNDC = ndc.medication_ndc
  {band_join} {state_join})"""


def demo_cols(age: bool, gender: bool, state: bool) -> list[str]:
    return [n for n, on in (("age", age), ("gender", gender), ("state", state)) if on]


def dist_ctes(age=True, gender=True, state=True, bands=DEFAULT_BANDS, cohorts=None) -> list[str]:
    """All CTEs up to ``ing`` (ingredient shares) and ``prod`` (product
    shares), both with a cohort column and the demographic columns."""
    d = demo_cols(age, gender, state)
    dl = "".join(f", {c}" for c in d)
    base = [FX_DEMOGRAPHICS, FX_PRESCRIPTION, FX_CROSSWALK, FX_REGION_STATES]
    if cohorts is None:
        chain = [NDC_ALL]
    else:
        base += [FX_CLASS_MEMBERS, FX_RXNCONSO, FX_RXNREL, DFG_MAP]
        chain = cohort_chain(cohorts)
    return base + [bands_values(bands), REF, *chain, joined_cte(age, state), f"""ing AS (
  SELECT cohort, medication_ingredient_name{dl}, CAST(weighted AS BIGINT) AS weighted,
    CAST(SUM(weighted) OVER (PARTITION BY cohort{dl}) AS BIGINT) AS total,
    {ratio('weighted', 'SUM(weighted) OVER (PARTITION BY cohort' + dl + ')')} AS percent
  FROM (SELECT cohort, medication_ingredient_name{dl}, SUM(person_weight) AS weighted
    FROM (SELECT DISTINCT cohort, medication_ingredient_name, medication_ingredient_rxcui, person_weight,
            DUPERSID{dl} FROM j) x
    GROUP BY cohort, medication_ingredient_name{dl}) w)""", f"""prod AS (
  SELECT cohort, medication_product_name, medication_ingredient_name{dl}, CAST(weighted AS BIGINT) AS weighted,
    CAST(SUM(weighted) OVER (PARTITION BY cohort, medication_ingredient_name{dl}) AS BIGINT) AS total,
    {ratio('weighted', 'SUM(weighted) OVER (PARTITION BY cohort, medication_ingredient_name' + dl + ')')} AS percent
  FROM (SELECT cohort, medication_product_name, medication_ingredient_name{dl}, SUM(person_weight) AS weighted
    FROM (SELECT DISTINCT cohort, medication_product_name, medication_product_rxcui, medication_ingredient_name,
            medication_ingredient_rxcui, person_weight, DUPERSID{dl} FROM j) x
    GROUP BY cohort, medication_product_name, medication_ingredient_name{dl}) w)"""]


def ingredient_sql(age=True, gender=True, state=True, cohorts=None, keep_cohort=False) -> str:
    dl = "".join(f", {c}" for c in demo_cols(age, gender, state))
    c = "cohort, " if keep_cohort else ""
    return with_(*dist_ctes(age, gender, state, cohorts=cohorts)) + \
        f"SELECT {c}medication_ingredient_name{dl}, weighted, total, percent FROM ing"


def product_sql(age=True, gender=True, state=True) -> str:
    dl = "".join(f", {c}" for c in demo_cols(age, gender, state))
    return with_(*dist_ctes(age, gender, state)) + \
        f"SELECT medication_product_name, medication_ingredient_name{dl}, weighted, total, percent FROM prod"


def weighted_person_count_sql() -> str:
    return with_(*dist_ctes()) + """SELECT medication_ingredient_name, medication_ingredient_rxcui, person_weight,
  age, gender, state, count(DISTINCT DUPERSID) AS patient_count,
  CAST(person_weight * count(DISTINCT DUPERSID) AS BIGINT) AS weighted_patient_count
FROM j GROUP BY medication_ingredient_name, medication_ingredient_rxcui, person_weight, age, gender, state"""


ROLLUP_ING = """ring AS (
  SELECT cohort, medication_ingredient_name, SUM(weighted) AS agg
  FROM (SELECT DISTINCT cohort, medication_ingredient_name, weighted FROM ing) x GROUP BY cohort, medication_ingredient_name)"""
ROLLUP_PROD = """rprod AS (
  SELECT cohort, medication_ingredient_name, medication_product_name, SUM(weighted) AS agg
  FROM (SELECT DISTINCT cohort, medication_ingredient_name, medication_product_name, weighted FROM prod) x
  GROUP BY cohort, medication_ingredient_name, medication_product_name)"""


def ingredient_rollup_sql() -> str:
    tot = "SUM(agg) OVER (PARTITION BY cohort)"
    return with_(*dist_ctes(), ROLLUP_ING) + f"""SELECT medication_ingredient_name,
  CAST(agg AS BIGINT) AS agg_weighted_patient_count_ingredient_demographic,
  CAST({tot} AS BIGINT) AS agg_weighted_patient_count_ingredient_total,
  {ratio('agg', tot)} AS agg_percent_ingredient_patients FROM ring"""


def product_rollup_sql() -> str:
    tot = "SUM(agg) OVER (PARTITION BY cohort, medication_ingredient_name)"
    return with_(*dist_ctes(), ROLLUP_PROD) + f"""SELECT medication_ingredient_name, medication_product_name,
  CAST(agg AS BIGINT) AS agg_weighted_patient_count_product_demographic,
  CAST({tot} AS BIGINT) AS agg_weighted_patient_count_product_total,
  {ratio('agg', tot)} AS agg_percent_product_patients FROM rprod"""


def validation_select(d: list[str]) -> str:
    on = " AND ".join(f"p.{c} = i.{c}" for c in ["cohort", "medication_ingredient_name", *d])
    dl = "".join(f", p.{c}" for c in d)
    return f"""SELECT p.cohort, p.medication_product_name, p.medication_ingredient_name{dl},
  p.weighted AS weighted_patient_count_product_demographic, p.total AS weighted_patient_count_product_total,
  p.percent AS percent_product_patients, i.weighted AS weighted_patient_count_ingredient_demographic,
  i.total AS weighted_patient_count_ingredient_total, i.percent AS percent_ingredient_patients,
  i.percent * p.percent AS validation_percent_product_patients
FROM prod p JOIN ing i ON {on}"""


def validation_sql() -> str:
    return with_(*dist_ctes()) + "SELECT * EXCLUDE (cohort) FROM (" + validation_select(["age", "gender", "state"]) + ")"


def long_select(d: list[str]) -> str:
    dl = "".join(f"{c}, " for c in d)
    ing_table = clean("cohort || '_ingredient_distribution'", "lower") + " || '.csv'"
    prod_table = clean("cohort || '_' || medication_ingredient_name || '_product_distribution'", "lower") + " || '.csv'"
    return f"""SELECT cohort, {ing_table} AS lookup_table, {dl}{clean("'Prescribe_' || medication_ingredient_name")} AS transition,
  percent AS probability FROM ing
UNION ALL
SELECT cohort, {prod_table}, {dl}{clean("'Prescribe_' || medication_product_name")}, percent FROM prod"""


def lookup_long_sql() -> str:
    return with_(*dist_ctes()) + "SELECT * EXCLUDE (cohort) FROM (" + long_select(["age", "gender", "state"]) + ")"


WIDE_INGREDIENT_NAMES = [*(f"Brand_{i}" for i in range(1, 26)), "Combo_0", "Combo_1", "Combo_2"]
WIDE_PRODUCT_NAMES = [f"Brand_{i}_{word}_{thing}" for i in range(1, 26) for word in "Blue Cold Hot Large New Old Red Small".split()
                      for thing in "Anvil Bolt Gear Gizmo Plate Ring Rod Widget".split()]


def lookup_wide_sql(table: str, names: list[str], age=True, gender=True, state=True) -> str:
    """A column for every name; a name that occurs twice in a group would show
    as a sum."""
    d = demo_cols(age, gender, state)
    cols = ", ".join(d)
    cells = ", ".join(f"COALESCE(SUM(CASE WHEN transition = 'Prescribe_{n}' THEN probability END), 0.0) AS Prescribe_{n}" for n in names)
    group = f" GROUP BY {cols}" if d else ""
    return (with_(*dist_ctes(age, gender, state), f"long AS ({long_select(d)})") +
            f"SELECT {cols + ', ' if d else ''}{cells} FROM long WHERE lookup_table = {q(table)}{group}")


def multi_cohort_sql(cohorts) -> str:
    return ingredient_sql(cohorts=cohorts, keep_cohort=True)


# -- concept graph ------------------------------------------------------------

def path_branch(root_tty: str, relas, final_tty: str) -> str:
    """One ingredient -> product path in the left-join form."""
    joins = []
    prev = "r0.rxcui"
    for i, rela in enumerate(relas, 1):
        joins.append(f"LEFT JOIN fx_rxnrel e{i} ON e{i}.rxcui2 = {prev} AND e{i}.rela = {q(rela)}")
        prev = f"e{i}.rxcui1"
    joins.append(f"LEFT JOIN fx_rxnconso f ON f.rxcui = {prev} AND f.sab = 'RXNORM' AND f.tty = {q(final_tty)}")
    return (f"SELECT r0.rxcui AS medication_ingredient_rxcui, r0.str AS medication_ingredient_name, "
            f"r0.tty AS medication_ingredient_tty, f.rxcui AS medication_product_rxcui, "
            f"f.str AS medication_product_name, f.tty AS medication_product_tty\n  FROM fx_rxnconso r0 "
            + "\n  ".join(joins) + f"\n  WHERE r0.tty = {q(root_tty)} AND r0.sab = 'RXNORM'")


def crosswalk_cte(name: str = "xw") -> str:
    branches = "\n  UNION ALL\n  ".join(path_branch(root, relas.split(), final) for root, relas, final in PATHS)
    return f"""{name} AS (
  SELECT DISTINCT sq.*, dc.rxcui AS dose_form_rxcui, dc.str AS dose_form_name, dc.tty AS dose_form_tty,
    s.atv AS medication_ndc
  FROM ({branches}) sq
  LEFT JOIN fx_rxnrel dr ON dr.rxcui2 = sq.medication_product_rxcui AND dr.rela = 'has_dose_form'
  LEFT JOIN fx_rxnconso dc ON dc.rxcui = dr.rxcui1 AND dc.sab = 'RXNORM' AND dc.tty = 'DF'
  LEFT JOIN fx_rxnsat s ON s.rxcui = sq.medication_product_rxcui AND s.sab = 'RXNORM' AND s.atn = 'NDC'
  WHERE s.atv IS NOT NULL)"""


GRAPH = (FX_RXNCONSO, FX_RXNREL, FX_RXNSAT)


def build_crosswalk_sql() -> str:
    return with_(*GRAPH, crosswalk_cte()) + "SELECT * FROM xw"


def typed_path_sql(root_tty: str, relas, final_tty: str) -> str:
    joins, prev = [], "r.rxcui"
    for i, rela in enumerate(relas, 1):
        joins.append(f"JOIN fx_rxnrel e{i} ON e{i}.rxcui2 = {prev} AND e{i}.rela = {q(rela)}")
        prev = f"e{i}.rxcui1"
    return with_(FX_RXNCONSO, FX_RXNREL) + f"""SELECT DISTINCT r.rxcui AS medication_ingredient_rxcui,
  r.str AS medication_ingredient_name, r.tty AS medication_ingredient_tty, f.rxcui AS medication_product_rxcui,
  f.str AS medication_product_name, f.tty AS medication_product_tty
FROM fx_rxnconso r {' '.join(joins)}
JOIN fx_rxnconso f ON f.rxcui = {prev} AND f.sab = 'RXNORM' AND f.tty = {q(final_tty)}
WHERE r.sab = 'RXNORM' AND r.tty = {q(root_tty)}"""


def dose_form_groups_sql() -> str:
    return with_(FX_RXNCONSO, FX_RXNREL, DFG_MAP) + "SELECT df, dfg FROM dfg_map"


def form_filter_sql(values, method: str) -> str:
    vals = ", ".join(q(v) for v in values)
    listed = f"SELECT df FROM dfg_map WHERE df IN ({vals}) OR dfg IN ({vals})"
    cond = (f"dose_form_name IN ({listed})" if method == "include" else
            f"NOT EXISTS (SELECT 1 FROM ({listed}) m WHERE m.df = xw.dose_form_name)")
    return with_(*GRAPH, DFG_MAP, crosswalk_cte()) + f"SELECT * FROM xw WHERE {cond}"


def term_type_sql(tty: str) -> str:
    return with_(*GRAPH, crosswalk_cte()) + f"SELECT * FROM xw WHERE medication_ingredient_tty = {q(tty)}"


# -- cohort steps -----------------------------------------------------------------

def cohort_sql(cohorts, select: str) -> str:
    return with_(FX_CROSSWALK, FX_CLASS_MEMBERS, FX_RXNCONSO, FX_RXNREL, DFG_MAP, *cohort_chain(cohorts)) + select


def class_rows(queries) -> str:
    """(class id, relationship, source, relation to match) of class queries."""
    from .oracle_classes import source_of

    told = [(c, *source_of(c.relationship)) for c in queries]
    return ", ".join(f"({q(c.class_id)}, {q(c.relationship)}, {q(src)}, {q(c.relationship) if many else 'NULL'})" for c, src, many in told)


def class_members_sql(queries) -> str:
    rows = class_rows(queries)
    return with_(FX_CLASS_MEMBERS) + f"""SELECT DISTINCT v.class_id, v.relationship, m.rxcui
FROM (VALUES {rows}) v(class_id, relationship, rela_source, rela)
JOIN fx_class_members m ON m.class_id = v.class_id AND m.rela_source = v.rela_source
  AND (v.rela IS NULL OR m.rela = v.rela)"""


def match_counts_sql(cohorts) -> str:
    sel = "\nUNION ALL ".join(
        f"SELECT cohort, '{s}' AS stage, count(medication_ndc) AS ndc_count FROM {t} GROUP BY cohort"
        for s, t in (("matched", "matched"), ("expanded", "expanded"), ("resolved", "resolved"),
                     ("filtered", "ndc")))
    return cohort_sql(cohorts, sel)


SURVEY = (FX_DEMOGRAPHICS, FX_PRESCRIPTION, FX_CROSSWALK, FX_REGION_STATES)

SURVEY_JOIN_SELECT = """SELECT ref.DUPERSID, ref.person_weight, ref.RXNDC, COALESCE(ref.gender, 'None') AS gender,
  ref.AGELAST, ref.region_num, ndc.medication_ingredient_name, ndc.medication_ingredient_rxcui,
  ndc.medication_product_name, ndc.medication_product_rxcui, ndc.medication_ndc
FROM ref JOIN ndc ON ref.RXNDC = ndc.medication_ndc"""


def survey_sql(select: str, *extra) -> str:
    return with_(*SURVEY, bands_values(), REF, NDC_ALL, *extra) + select


def product_pairs_sql() -> str:
    return survey_sql(f"""SELECT medication_product_name, medication_product_rxcui, count(*) AS count
FROM ({SURVEY_JOIN_SELECT}) x GROUP BY medication_product_name, medication_product_rxcui""")


# -- scalars ------------------------------------------------------------------------

def prefix_int(expr: str) -> str:
    return (f"CASE WHEN {expr} IS NULL THEN NULL ELSE COALESCE(TRY_CAST(NULLIF(regexp_extract({expr}, "
            f"'^\\s*([+-]?\\d+)', 1), '') AS INTEGER), 0) END")


def text_to_int_prefix_sql() -> str:
    return f"""SELECT DISTINCT source, text, {prefix_int('text')} AS value FROM (
  SELECT 'quantity' AS source, CAST(l_quantity AS VARCHAR) AS text FROM lineitem
  UNION ALL SELECT 'balance', CAST(c_acctbal AS VARCHAR) FROM customer
  UNION ALL SELECT 'name', p_name FROM part
  UNION ALL SELECT 'props', props FROM events) t"""


# -- dosage -------------------------------------------------------------------------

RX_QTY = f"""rxq AS (
  SELECT {prefix_int('p.RXQUANTY')} AS RXQUANTY, {prefix_int('p.RXDAYSUP')} AS RXDAYSUP,
    min(x.medication_product_rxcui) AS medication_product_rxcui, x.medication_product_name,
    count(*) AS COUNT
  FROM fx_prescription p JOIN fx_crosswalk x ON p.RXNDC = x.medication_ndc
  WHERE p.RXDAYSUP > '0'
  GROUP BY p.RXQUANTY, p.RXDAYSUP, x.medication_product_name)"""


def rx_quantity_days_sql() -> str:
    return with_(FX_PRESCRIPTION, FX_CROSSWALK, RX_QTY) + "SELECT * FROM rxq"


def dosage_sql() -> str:
    return with_(FX_PRESCRIPTION, FX_CROSSWALK, RX_QTY) + """SELECT medication_product_rxcui, medication_product_name,
  RXQUANTY, RXDAYSUP, COUNT, 1 AS amount,
  CASE WHEN RXQUANTY >= RXDAYSUP THEN CAST(trunc(RXQUANTY / RXDAYSUP) AS BIGINT) ELSE 1 END AS frequency,
  CASE WHEN RXDAYSUP > RXQUANTY THEN CAST(trunc(RXDAYSUP / RXQUANTY) AS BIGINT) ELSE 1 END AS period,
  'days' AS unit, RXDAYSUP AS duration_quantity
FROM (SELECT * FROM rxq QUALIFY row_number() OVER (PARTITION BY medication_product_rxcui
        ORDER BY COUNT DESC, RXQUANTY, RXDAYSUP, medication_product_name) = 1) top
WHERE RXQUANTY <> 0 AND RXDAYSUP <> 0"""


# -- second population -----------------------------------------------------------------

OBSERVED = f"""chosen AS (SELECT DISTINCT {clean('medication_product_name')} AS medication_product_name,
    medication_product_rxcui AS code FROM ndc),
meds AS (SELECT CAST(l_shipdate AS DATE) AS START, CAST(o_custkey AS VARCHAR) AS PATIENT, 'P-' || p_brand || '-' || p_name AS CODE
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
pats AS (SELECT CAST(c_custkey AS VARCHAR) AS Id, DATE '1990-01-01' + CAST(c_custkey % 4000 AS INTEGER) AS BIRTHDATE
  FROM customer),
obs AS (SELECT medication_product_name, count(*) AS patient_count,
    CAST(count(*) AS DOUBLE) / CAST(SUM(count(*)) OVER () AS DOUBLE) AS percent
  FROM meds JOIN chosen ON meds.CODE = chosen.code JOIN pats ON meds.PATIENT = pats.Id
  WHERE date_diff('day', BIRTHDATE, START) < 2191
  GROUP BY medication_product_name)"""


def observed_sql() -> str:
    return with_(FX_CROSSWALK, NDC_ALL, OBSERVED) + "SELECT * FROM obs"


def expected_ctes() -> list[str]:
    ctes = dist_ctes(gender=False, state=False, bands=("0-5",))
    return ctes + [OBSERVED.replace("FROM ndc)", "FROM ndc WHERE true)"),
                   f"val AS ({validation_select(['age'])})",
                   """expct AS (SELECT medication_product_name, medication_ingredient_name,
    validation_percent_product_patients,
    round_even(validation_percent_product_patients * (SELECT SUM(patient_count) FROM obs), 0) AS patient_count
  FROM val WHERE age = '0-5')"""]


def expected_sql() -> str:
    return with_(*expected_ctes()) + "SELECT * FROM expct"


TABLE = """tab AS (
  SELECT medication_product_name, SUM(o_count) AS o_count, SUM(e_count) AS e_count FROM (
    SELECT medication_product_name, CAST(patient_count AS DOUBLE) AS o_count, 0.0 AS e_count FROM obs
    UNION ALL SELECT medication_product_name, 0.0, patient_count FROM expct)
  GROUP BY 1 HAVING SUM(o_count) + SUM(e_count) > 0),
cells AS (
  SELECT medication_product_name, o_count, e_count, (o_count + e_count) * SUM(o_count) OVER () / (SUM(o_count) OVER () + SUM(e_count) OVER ()) AS eo,
    (o_count + e_count) * SUM(e_count) OVER () / (SUM(o_count) OVER () + SUM(e_count) OVER ()) AS ee,
    count(*) OVER () AS k FROM tab)"""


def chi_square_table_sql() -> str:
    return with_(*expected_ctes(), TABLE) + """SELECT medication_product_name, CAST(o_count AS BIGINT) AS o_count, e_count,
  round_even(eo, 8) AS o_expected, round_even(ee, 8) AS e_expected FROM cells"""


def chi_square_sql() -> str:
    return with_(*expected_ctes(), TABLE, """st AS (
  SELECT SUM(pow(CASE WHEN k = 2 THEN greatest(abs(o_count - eo) - 0.5, 0) ELSE abs(o_count - eo) END, 2) / eo
           + pow(CASE WHEN k = 2 THEN greatest(abs(e_count - ee) - 0.5, 0) ELSE abs(e_count - ee) END, 2) / ee) AS chi2,
    any_value(k) - 1 AS dof FROM cells)""") + """SELECT round_even(chi2, 8) AS chi2, CAST(dof AS BIGINT) AS dof,
  -- finite upper-tail sums: k from 0 for even dof, half-integer steps and erfc for odd dof
  round_even(CASE WHEN chi2 <= 0 THEN 1.0 ELSE
    coalesce((SELECT SUM(exp(k * ln(chi2 / 2.0) - chi2 / 2.0 - lgamma(k + 1)))
              FROM (SELECT j + (dof % 2) / 2.0 AS k FROM range(0, CAST(dof // 2 AS BIGINT)) r(j))), 0.0)
    + CASE WHEN dof % 2 = 0 OR chi2 > 80 THEN 0.0 ELSE 1.0 -
        (SELECT SUM(exp((0.5 + n) * ln(chi2 / 2.0) - chi2 / 2.0 - lgamma(n + 1.5))) FROM range(0, 400) r(n)) END
  END, 10) AS p_value
FROM st"""


# -- states ---------------------------------------------------------------------------

def transitions_sql() -> str:
    ing_state = clean(q(STATE_PREFIX + "Ingredient"))
    ing_table = clean("cohort || '_ingredient_distribution'", "lower") + " || '.csv'"
    prod_table = clean("cohort || '_' || medication_ingredient_name || '_product_distribution'", "lower") + " || '.csv'"
    return with_(*dist_ctes(), f"""tr AS (
  SELECT cohort, {ing_state} AS state, {clean(q(STATE_PREFIX) + " || medication_ingredient_name")} AS transition,
    {ing_table} AS lookup_table_name, min(medication_ingredient_name) AS o FROM ing GROUP BY 1, 2, 3, 4
  UNION ALL
  SELECT cohort, {clean(q(STATE_PREFIX) + " || medication_ingredient_name")},
    {clean(q(STATE_PREFIX) + " || medication_product_name")}, {prod_table}, min(medication_product_name)
  FROM prod GROUP BY 1, 2, 3, 4)""") + \
        """SELECT state, ordinal, transition, CASE WHEN ordinal = 1 THEN '1' ELSE '0' END AS default_probability,
  lookup_table_name
FROM (SELECT *, row_number() OVER (PARTITION BY cohort, state, lookup_table_name ORDER BY o, transition) AS ordinal
      FROM tr) x"""


def remarks_sql() -> str:
    ing_state = clean(q(STATE_PREFIX + "Ingredient"))
    return with_(*dist_ctes(), ROLLUP_ING, ROLLUP_PROD, f"""rem AS (
  SELECT cohort, {ing_state} AS state, medication_ingredient_name AS name,
    {ratio('agg', 'SUM(agg) OVER (PARTITION BY cohort)')} AS pct FROM ring
  UNION ALL
  SELECT cohort, {clean(q(STATE_PREFIX) + " || medication_ingredient_name")}, medication_product_name,
    {ratio('agg', 'SUM(agg) OVER (PARTITION BY cohort, medication_ingredient_name)')} FROM rprod)""") + \
        """SELECT state, line_no, CAST(line_no AS VARCHAR) || '. [ ' || CAST(round_even(pct * 100.0, 2) AS VARCHAR)
  || '% ] ' || name AS line
FROM (SELECT *, row_number() OVER (PARTITION BY cohort, state ORDER BY name, pct) AS line_no FROM rem) x"""


def order_states_sql() -> str:
    return survey_sql(f"""SELECT w.state_name, w.medication_product_rxcui AS code, w.medication_product_name AS display,
  'all_medications' AS assign_to_attribute, 0 AS refills, false AS as_needed, false AS chronic,
  CAST(NULL AS VARCHAR) AS reason,
  (w.medication_product_name = f.medication_product_name AND w.medication_product_rxcui = f.medication_product_rxcui) AS has_remarks
FROM (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY state_name
        ORDER BY medication_product_name DESC, medication_product_rxcui DESC) = 1) w,
     (SELECT * FROM pairs QUALIFY row_number() OVER (ORDER BY medication_product_name, medication_product_rxcui) = 1) f""",
                      f"""pairs AS (SELECT DISTINCT medication_product_name, medication_product_rxcui,
    {clean(q(STATE_PREFIX) + " || medication_product_name")} AS state_name
  FROM ({SURVEY_JOIN_SELECT}) sj)""")


# -- sources -------------------------------------------------------------------------------

def incremental_sql() -> str:
    return with_(FX_CROSSWALK, NDC_ALL, OBSERVED) + \
        "SELECT meds.START, meds.PATIENT, meds.CODE, chosen.medication_product_name FROM meds JOIN chosen ON meds.CODE = chosen.code"


def row_counts_sql() -> str:
    names = ("demographics", "prescription", "crosswalk", "rxnconso", "rxnrel", "rxnsat", "region_states")
    sel = "\nUNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM fx_{n}" for n in names)
    return with_(*SURVEY, *GRAPH) + sel


def unmatched_classes_sql(queries) -> str:
    rows = class_rows(queries)
    return with_(FX_CLASS_MEMBERS) + f"""SELECT v.class_id, v.relationship, v.rela_source
FROM (VALUES {rows}) v(class_id, relationship, rela_source, rela)
WHERE NOT EXISTS (SELECT 1 FROM fx_class_members m WHERE m.class_id = v.class_id
  AND m.rela_source = v.rela_source AND (v.rela IS NULL OR m.rela = v.rela))"""
