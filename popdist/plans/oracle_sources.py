"""SQL oracles of the readers and profiles; fixed values written out again."""

from __future__ import annotations

from . import oracle as o

# The survey's regions and their states.
STATES = {
    1: "Connecticut, Maine, Massachusetts, New Hampshire, New Jersey, New York, Pennsylvania, Rhode Island, Vermont",
    2: "Indiana, Illinois, Iowa, Kansas, Michigan, Minnesota, Missouri, Nebraska, North Dakota, Ohio, South Dakota, Wisconsin",
    3: ("Alabama, Arkansas, Delaware, District of Columbia, Florida, Georgia, Kentucky, Louisiana, Maryland, Mississippi, "
        "North Carolina, Oklahoma, South Carolina, Tennessee, Texas, Virginia, West Virginia"),
    4: "Alaska, Arizona, California, Colorado, Hawaii, Idaho, Montana, Nevada, New Mexico, Oregon, Utah, Washington, Wyoming",
}
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def by_state_sql() -> str:
    rows = ", ".join(f"({k}, {o.q(s)})" for k, states in STATES.items() for s in states.split(", "))
    return o.with_(o.FX_DEMOGRAPHICS) + f"""SELECT v.region_value, v.state, count(*) AS persons, CAST(sum(PERWTF) AS BIGINT) AS weight
FROM (VALUES {rows}) v(region_value, state) JOIN fx_demographics ON REGION = v.region_value GROUP BY ALL"""


def quarantined_sql() -> str:
    return o.with_(*o.GRAPH) + """SELECT 'nodes' AS layout, rxcui AS f1, sab AS f2, tty AS f3, str AS f4 FROM fx_rxnconso
UNION ALL SELECT 'edges', rxcui1, rela, rxcui2, NULL FROM fx_rxnrel
UNION ALL SELECT 'attributes', rxcui, sab, atn, atv FROM fx_rxnsat"""


def quarantine_counts_sql() -> str:
    broken = "(SELECT count(*) FROM nation) + (SELECT count(*) FROM region)"
    return o.with_(*o.GRAPH) + " UNION ALL ".join(
        f"SELECT '{layout}' AS layout, count(*) AS whole, {broken} AS broken FROM {t}"
        for layout, t in (("nodes", "fx_rxnconso"), ("edges", "fx_rxnrel"), ("attributes", "fx_rxnsat")))


def stored_counts_sql() -> str:
    return " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES)


MARKS = "SELECT p_partkey, p_name || ' \u20ac \u017e \u2122 \u2013 \u0152 \u00e9 \u00fc' AS label FROM part"
