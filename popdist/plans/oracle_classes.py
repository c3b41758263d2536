"""SQL oracles over the nested class answers; fixed values written out again."""

from __future__ import annotations

from . import oracle as o

# Every relationship, its source, and whether the source has more than one.
RELATIONSHIPS = (
    ("ATC", "ATC", False), ("has_EPC", "DailyMed", True), ("has_Chemical_Structure", "DailyMed", True), ("has_MoA", "DailyMed", True),
    ("has_PE", "DailyMed", True), ("has_TC", "FMTSME", True), ("CI_with", "MEDRT", True), ("induces", "MEDRT", True),
    ("may_diagnose", "MEDRT", True), ("may_prevent", "MEDRT", True), ("may_treat", "MEDRT", True), ("CI_ChemClass", "MEDRT", True),
    ("has_active_metabolites", "MEDRT", True), ("has_Ingredient", "MEDRT", True), ("CI_MoA", "MEDRT", True), ("has_PK", "MEDRT", True),
    ("site_of_metabolism", "MEDRT", True), ("CI_PE", "MEDRT", True), ("has_schedule", "RXNORM", True), ("MESH", "MESH", False),
    ("isa_disposition", "SNOWMEDCT", True), ("isa_structure", "SNOWMEDCT", True), ("has_VAClass", "VA", True),
    ("has_VAClass_extended", "VA", True),
)



def source_of(relationship: str) -> tuple[str, bool]:
    """The relationship's source, and whether that has several relationships."""
    return next((s, many) for r, s, many in RELATIONSHIPS if r == relationship)


_RELATIONS = "relations AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, {o.q(r)}, {o.q(s)}, {str(many).lower()})" for i, (r, s, many) in enumerate(RELATIONSHIPS)) + ") v(i, relationship, source, many))"

_MEMBERS = """listed AS (
  SELECT p_type AS class_id, source AS rela_source, CASE WHEN many THEN relationship END AS rela, p_partkey // 100 AS page, p_partkey,
    unnest([
      {'n': 0, 'rxcui': 'I-' || p_brand, 'name': p_brand, 'tty': 'IN',
       'note': '[' || json_object('v', p_name || ' "' || p_type || '\\"') || ',{"attrValue":null}]'},
      {'n': 1, 'rxcui': 'M-' || p_size % 3, 'name': 'Combo/' || p_size % 3, 'tty': 'MIN', 'note': CASE WHEN p_size % 2 = 0 THEN 'true' ELSE 'false' END},
      {'n': 2, 'rxcui': 'P-' || p_brand || '-' || p_name, 'name': p_name, 'tty': 'SCD', 'note': CAST(p_size AS VARCHAR)},
      {'n': 3, 'rxcui': 'B-' || p_brand, 'name': p_brand, 'tty': 'BN', 'note': CAST(json_object('attrValue', p_type) AS VARCHAR)}]) AS m
  FROM part JOIN relations ON p_partkey % 24 = i)"""


def by_type_sql() -> str:
    return o.with_(_RELATIONS, _MEMBERS) + """
SELECT DISTINCT l.class_id, r.relationship, l.m.rxcui AS rxcui
FROM listed l JOIN relations r ON r.source = l.rela_source AND (NOT r.many OR r.relationship = l.rela)
WHERE l.m.tty IN ('IN', 'MIN') OR (r.source IN ('VA', 'RXNORM') AND l.m.tty IN ('SCD', 'SBD', 'GPCK', 'BPCK'))"""


def key_search_sql() -> str:
    return o.with_(_RELATIONS, _MEMBERS, """answers AS (
  SELECT class_id, rela_source, rela, page, '{"drugMemberGroup":{"drugMember":[' || string_agg(
      '{"minConcept":' || json_object('rxcui', m.rxcui, 'name', m.name, 'tty', m.tty)
      || ',"nodeAttr":[{"attrName":"Note","attrValue":' || m.note || '}]}', ',' ORDER BY p_partkey, m.n) || ']}}' AS response
  FROM listed GROUP BY class_id, rela_source, rela, page)""") + """
SELECT class_id, rela_source, rela, page, t.key, CASE WHEN t.type = 'VARCHAR' THEN json_extract_string(t.value, '$')
    WHEN t.type <> 'NULL' THEN CAST(t.value AS VARCHAR) END AS value, count(*) AS n
FROM answers, json_tree(answers.response) t
WHERE t.key IN ('rxcui', 'attrValue') AND t.type NOT IN ('OBJECT', 'ARRAY') GROUP BY ALL"""
