"""SQL oracles of the module outputs: profiles, wide files, documents.

One statement per module or profile, joined by UNION ALL, where the Spark
code has one plan for all.  Texts and constants are written out here again.
"""

from __future__ import annotations

from . import oracle as o

RULE = "-" * 72


def _per_module(modules, app_bands, statement) -> str:
    """``statement(module, flags..., bands)`` of every module as one union."""
    return "\nUNION ALL\n".join(
        f"SELECT * FROM ({statement(m, m.flag('age'), m.flag('gender'), m.flag('state'), m.age_ranges or app_bands)})"
        for m in modules)


def _demos(age: bool, gender: bool, state: bool) -> str:
    return ", ".join(n if on else f"CAST(NULL AS VARCHAR) AS {n}" for n, on in (("age", age), ("gender", gender), ("state", state)))


def profile_sql(modules, app_bands) -> str:
    def one(m, age, gender, state, bands):
        return o.with_(*o.dist_ctes(age, gender, state, bands, cohorts=[m])) + f"""
SELECT cohort, medication_ingredient_name, {_demos(age, gender, state)}, weighted, total, percent FROM ing"""
    return _per_module(modules, app_bands, one)


def wide_files_sql(modules, app_bands) -> str:
    """A header line and a line per group of every table, as text."""
    def one(m, age, gender, state, bands):
        d = o.demo_cols(age, gender, state)
        dl = "".join(f", {c}" for c in d)
        key = " || ',' || ".join(d)
        same = "".join(f" AND c.{c} = g.{c}" for c in d)
        of = "".join(f", g.{c}" for c in d)
        return o.with_(*o.dist_ctes(age, gender, state, bands, cohorts=[m]), f"long AS ({o.long_select(d)})",
                       "names AS (SELECT DISTINCT cohort, lookup_table, transition FROM long)",
                       f"groups AS (SELECT DISTINCT cohort, lookup_table{dl} FROM long)",
                       f"""filled AS (
  SELECT g.cohort, g.lookup_table{of}, string_agg(CAST(COALESCE(c.probability, 0.0) AS VARCHAR), ',' ORDER BY n.transition) AS cells
  FROM groups g JOIN names n ON n.cohort = g.cohort AND n.lookup_table = g.lookup_table
  LEFT JOIN long c ON c.cohort = g.cohort AND c.lookup_table = g.lookup_table AND c.transition = n.transition{same}
  GROUP BY g.cohort, g.lookup_table{of})""") + f"""
SELECT cohort, lookup_table, CAST(0 AS BIGINT) AS line_no,
  {o.q(''.join(c + ',' for c in d))} || string_agg(transition, ',' ORDER BY transition) AS line
FROM names GROUP BY cohort, lookup_table
UNION ALL
SELECT cohort, lookup_table, row_number() OVER (PARTITION BY cohort, lookup_table{' ORDER BY ' + ', '.join(d) if d else ''}),
  {key + " || ',' || " if d else ''}cells FROM filled"""
    return _per_module(modules, app_bands, one)


def _json(expr: str) -> str:
    return f"CAST(to_json({expr}) AS VARCHAR)"


def _lines(*exprs: str) -> str:
    return " || ',' || ".join(_json(e) for e in exprs)


def documents_sql(modules) -> str:
    """The JSON entry of every state of every module, put together per state."""
    first = o.clean("'Prescribe_Ingredient'")
    attribute = o.clean("cohort", "lower")
    ing_table = o.clean("cohort || '_ingredient_distribution'", "lower") + " || '.csv'"
    prod_table = o.clean("cohort || '_' || medication_ingredient_name || '_product_distribution'", "lower") + " || '.csv'"
    ing_name = o.clean("'Prescribe_' || medication_ingredient_name")
    prod_name = o.clean("'Prescribe_' || medication_product_name")
    rule = o.q(RULE)
    modules_cte = "modules AS (SELECT * FROM (VALUES " + ", ".join(f"({o.q(m.module_name)})" for m in modules) + ") v(cohort))"
    return o.with_(
        *o.dist_ctes(cohorts=modules), o.ROLLUP_ING, o.ROLLUP_PROD, modules_cte,
        f"""tr AS (
  SELECT cohort, {first} AS state, 2 AS place, {ing_name} AS transition, {ing_table} AS file, min(medication_ingredient_name) AS o
  FROM ing GROUP BY ALL
  UNION ALL
  SELECT cohort, {ing_name}, 3, {prod_name}, {prod_table}, min(medication_product_name) FROM prod GROUP BY ALL)""",
        """entries AS (
  SELECT cohort, state, place, string_agg('{"transition":' || CAST(to_json(transition) AS VARCHAR) || ',"default_probability":"'
      || CASE WHEN n = 1 THEN '1' ELSE '0' END || '","lookup_table_name":' || CAST(to_json(file) AS VARCHAR) || '}', ',' ORDER BY n) AS entries
  FROM (SELECT *, row_number() OVER (PARTITION BY cohort, state, file ORDER BY o, transition) AS n FROM tr)
  GROUP BY cohort, state, place)""",
        f"""rem AS (
  SELECT cohort, {first} AS state, medication_ingredient_name AS name,
    {o.ratio('agg', 'SUM(agg) OVER (PARTITION BY cohort)')} AS pct FROM ring
  UNION ALL
  SELECT cohort, {ing_name}, medication_product_name,
    {o.ratio('agg', 'SUM(agg) OVER (PARTITION BY cohort, medication_ingredient_name)')} FROM rprod)""",
        """shares AS (
  SELECT cohort, state, string_agg(CAST(to_json(CAST(n AS VARCHAR) || '. [ ' || CAST(round_even(pct * 100.0, 2) AS VARCHAR) || '% ] ' || name)
      AS VARCHAR), ',' ORDER BY n) AS lines
  FROM (SELECT *, row_number() OVER (PARTITION BY cohort, state ORDER BY name, pct) AS n FROM rem) GROUP BY cohort, state)""",
        f"titles AS (SELECT cohort, {ing_name} AS state, upper(min(medication_ingredient_name)) AS title FROM prod GROUP BY ALL)",
        f"""tables AS (
  SELECT e.cohort, e.state AS state_name, e.place, {_json('e.state')} || ':{{"name":' || {_json('e.state')} || ',"type":"Simple","remarks":['
    || CASE WHEN e.place = 2 THEN {_lines(rule, "'Which ingredient, by share of weighted patients'", rule, "'No. [ share ] Name'")}
       ELSE {_lines(rule, "'Which product of ' || title", rule, "'No. [ share ] Name'")} END
    || ',' || lines || '],"lookup_table_transition":[' || entries || ']}}' AS entry
  FROM entries e JOIN shares USING (cohort, state) LEFT JOIN titles USING (cohort, state))""",
        f"""pairs AS (
  SELECT DISTINCT ndc.cohort, ndc.medication_product_name AS name, ndc.medication_product_rxcui AS code,
    {o.clean("'Prescribe_' || ndc.medication_product_name")} AS state_name
  FROM ref JOIN ndc ON ref.RXNDC = ndc.medication_ndc)""",
        f"""orders AS (
  SELECT w.cohort, w.state_name, 4 AS place, {_json('w.state_name')} || ':{{'
    || CASE WHEN (w.name, w.code) = (f.name, f.code)
       THEN '"remarks":[' || {_lines(rule, "'The orders, one state for each product'", rule)} || '],' ELSE '' END
    || '"name":' || {_json('w.state_name')} || ',"type":"MedicationOrder","assign_to_attribute":' || {_json(attribute.replace('cohort', 'w.cohort'))}
    || ',"codes":[{{"system":"RxNorm","code":' || {_json('w.code')} || ',"display":' || {_json('w.name')}
    || '}}],"prescription":{{"refills":0,"as_needed":false}},"direct_transition":"Terminal","chronic":false}}' AS entry
  FROM (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY cohort, state_name ORDER BY name DESC, code DESC) = 1) w
  JOIN (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY cohort ORDER BY name, code) = 1) f USING (cohort))""",
        f"""ends AS (
  SELECT cohort, 'Initial' AS state_name, 0 AS place, '"Initial":{{"type":"Initial","conditional_transition":[{{"condition":'
    || '{{"condition_type":"Attribute","attribute":' || {_json(attribute)} || ',"operator":"is nil"}},"transition":' || {_json(first)}
    || '}},{{"transition":"Terminal"}}]}}' AS entry FROM modules
  UNION ALL SELECT cohort, 'Terminal', 1, '"Terminal":{{"type":"Terminal"}}' FROM modules)""") + """
SELECT cohort, state_name, place, entry FROM (
  SELECT * FROM ends UNION ALL SELECT * FROM tables UNION ALL SELECT * FROM orders)
QUALIFY row_number() OVER (PARTITION BY cohort, state_name ORDER BY place DESC) = 1"""
