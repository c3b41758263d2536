"""Typed walks over the concept graph and the package crosswalk.

A set of paths is one automaton: its walks are rows with a state, and every hop
is one equi-join with the edges (no iterative graph engine).  Only the root and final concept types are
enforced -- the reference joins the intermediate concepts with outer joins
and then continues from the edge, so those joins only multiply rows that a
final DISTINCT removes; they are left out here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import staged

SAB = "RXNORM"

# Fixed values that must equal the reference: the eight ingredient -> product
# paths (root type, edge types in order, final type).
CROSSWALK_PATHS = (
    ("IN", ("ingredient_of", "constitutes"), "SCD"),
    ("IN", ("has_tradename", "ingredient_of"), "SBD"),
    ("IN", ("ingredient_of", "constitutes", "contained_in"), "GPCK"),
    ("IN", ("ingredient_of", "constitutes", "contained_in", "has_tradename"), "BPCK"),
    ("MIN", ("ingredients_of",), "SCD"),
    ("MIN", ("ingredients_of", "has_tradename"), "SBD"),
    ("MIN", ("ingredients_of", "contained_in"), "GPCK"),
    ("MIN", ("ingredients_of", "has_tradename", "contained_in"), "BPCK"),
)

CROSSWALK_COLUMNS = (
    "medication_ingredient_rxcui", "medication_ingredient_name", "medication_ingredient_tty",
    "medication_product_rxcui", "medication_product_name", "medication_product_tty",
    "dose_form_rxcui", "dose_form_name", "dose_form_tty", "medication_ndc",
)


def concepts(nodes: DataFrame, tty: str, prefix: str) -> DataFrame:
    """Concepts of one term type from the vocabulary source, as
    (``{prefix}_rxcui``, ``{prefix}_name``, ``{prefix}_tty``)."""
    return nodes.where((F.col("sab") == SAB) & (F.col("tty") == tty)).select(
        F.col("rxcui").alias(f"{prefix}_rxcui"), F.col("str").alias(f"{prefix}_name"),
        F.col("tty").alias(f"{prefix}_tty"))


def typed_edges(edges: DataFrame, rela: str) -> DataFrame:
    """Edges of one type as (from, to) = (rxcui2, rxcui1), duplicates removed
    once here so that path joins never multiply repeated edges."""
    return (edges.where(F.col("rela") == rela)
            .select(F.col("rxcui2").alias("_at"), F.col("rxcui1").alias("_next")).distinct())


def extend(frontier: DataFrame, edges: DataFrame, relas: Sequence[str]) -> DataFrame:
    """Follow edge types in order from the ``_at`` column."""
    for rela in relas:
        frontier = (frontier.join(typed_edges(edges, rela), "_at")
                    .drop("_at").withColumnRenamed("_next", "_at"))
    return frontier


def traverse(nodes: DataFrame, edges: DataFrame, root_tty: str, relas: Sequence[str],
             final_tty: str, root: str = "medication_ingredient",
             final: str = "medication_product") -> DataFrame:
    """(root concept, final concept) pairs joined by a typed path, distinct."""
    start = concepts(nodes, root_tty, root).withColumn("_at", F.col(f"{root}_rxcui"))
    reached = extend(start, edges, relas)
    ends = concepts(nodes, final_tty, final).withColumnRenamed(f"{final}_rxcui", "_at")
    return (reached.join(ends, "_at").withColumnRenamed("_at", f"{final}_rxcui")
            .select(f"{root}_rxcui", f"{root}_name", f"{root}_tty",
                    f"{final}_rxcui", f"{final}_name", f"{final}_tty").distinct())


#: edges of one type from one node that one task joins; more are dealt by salt
HUB = 50_000


class PathTrie:
    """Typed paths as one automaton: paths that begin alike share states.

    ``starts`` root type -> state, ``moves`` state -> (edge type, next state),
    ``ends`` state -> final types accepted there."""

    def __init__(self, paths):
        self.starts: dict[str, int] = {}
        self.moves: list[dict[str, int]] = []
        self.ends: list[list[str]] = []
        for root_tty, relas, final_tty in paths:
            state = self.starts.get(root_tty)
            if state is None:
                state = self.starts[root_tty] = self._new()
            for rela in relas:
                if rela not in self.moves[state]:
                    self.moves[state][rela] = self._new()
                state = self.moves[state][rela]
            if final_tty not in self.ends[state]:
                self.ends[state].append(final_tty)
        self.depth = max((len(relas) for _, relas, _ in paths), default=0)

    def _new(self) -> int:
        self.moves.append({})
        self.ends.append([])
        return len(self.moves) - 1

    def edge_types(self) -> list[str]:
        return sorted({rela for moves in self.moves for rela in moves})

    def types_at(self, hop: int) -> list[str]:
        """The edge types that walks of ``hop`` edges can follow."""
        states = set(self.starts.values())
        for _ in range(hop):
            states = {n for s in states for n in self.moves[s].values()}
        return sorted({rela for s in states for rela in self.moves[s]})

    def moves_from(self, state: str = "state") -> Column:
        """The edge types that a walk can follow from its state, with the states
        they lead to."""
        per_state = [F.array(*[F.struct(F.lit(r), F.lit(n)) for r, n in moves.items()]).cast("array<struct<rela:string, state:int>>")
                     for moves in self.moves]
        return F.element_at(F.array(*per_state), F.col(state) + 1)

    def ends_at(self, state: str = "state") -> Column:
        """The concept types at which a walk in its state can end."""
        per_state = [F.array(*[F.lit(t) for t in ends]).cast("array<string>") for ends in self.ends]
        return F.element_at(F.array(*per_state), F.col(state) + 1)


def walk_edges(edges: DataFrame, relas: Sequence[str], hub: int = HUB) -> tuple[DataFrame, DataFrame | None]:
    """The edges of the given types, distinct and staged once for every hop, as
    (_at, rela, _salt, _next); and (_at, rela, _salts) of the hubs, the nodes
    with more than ``hub`` edges of one type, None where there is none."""
    typed = edges.where(F.col("rela").isin(list(relas))).select(
        F.col("rxcui2").alias("_at"), "rela", F.col("rxcui1").alias("_next"))
    once = staged(typed.distinct(), "walk-edges")
    hubs = staged(once.groupBy("_at", "rela").agg(F.count("*").alias("_n")).where(F.col("_n") > hub).select(
        "_at", "rela", F.ceil(F.col("_n") / hub).cast("int").alias("_salts")), "walk-hubs")
    if hubs.isEmpty():
        return once.withColumn("_salt", F.lit(0)), None
    salted = once.join(hubs, ["_at", "rela"], "left").withColumn(
        "_salt", F.pmod(F.xxhash64("_next"), F.coalesce("_salts", F.lit(1))).cast("int")).drop("_salts")
    return staged(salted, "walk-salted"), hubs


def walk(nodes: DataFrame, edges: DataFrame, paths, root: str = "medication_ingredient",
         final: str = "medication_product", hub: int = HUB) -> DataFrame:
    """(root concept, final concept) pairs of any of the typed ``paths``.

    All paths are walked at once: a row is (root, state, node), and each hop is
    one join with the edges.  The rows of a hop are staged: those in an accepting
    state are ends, and only the others are joined on.  The final concepts' names
    are joined once, at the end.  A hub's edges are spread over salts, and the few
    walks at a hub are copied to each of them, so no task joins a whole hub."""
    trie = PathTrie(paths)
    out_edges, hubs = walk_edges(edges, trie.edge_types(), hub)
    start = F.create_map(*[F.lit(x) for pair in trie.starts.items() for x in pair])
    held = [f"{root}_rxcui", f"{root}_name", f"{root}_tty"]
    at = nodes.where((F.col("sab") == SAB) & F.col("tty").isin(list(trie.starts))).select(
        F.col("rxcui").alias(f"{root}_rxcui"), F.col("str").alias(f"{root}_name"), F.col("tty").alias(f"{root}_tty"),
        start[F.col("tty")].alias("state"), F.col("rxcui").alias("_at"))
    done = None
    for hop in range(trie.depth + 1):
        at = staged(at, f"walk-hop-{hop}")
        ended = at.select(*held, "_at", F.explode(trie.ends_at()).alias("final"))
        done = ended if done is None else done.unionByName(ended)
        if hop == trie.depth:
            break
        rows = at.select(*held, "_at", F.explode(trie.moves_from()).alias("m")).select(*held, "_at", "m.*")
        if hubs is None:
            rows = rows.withColumn("_salt", F.lit(0))
        else:
            rows = rows.join(hubs, ["_at", "rela"], "left").withColumn(
                "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
        at = rows.join(out_edges.where(F.col("rela").isin(trie.types_at(hop))), ["_at", "rela", "_salt"]).select(*held, "state", F.col("_next").alias("_at"))
    finals = sorted({t for ends in trie.ends for t in ends})
    ends = nodes.where((F.col("sab") == SAB) & F.col("tty").isin(finals)).select(
        F.col("rxcui").alias("_at"), F.col("tty").alias("final"), F.col("str").alias(f"{final}_name"))
    ends = ends.repartition("_at", "final").distinct()  # the join's own partitioning
    return done.distinct().join(ends, ["_at", "final"]).select(
        *held, F.col("_at").alias(f"{final}_rxcui"), f"{final}_name", F.col("final").alias(f"{final}_tty"))


def ingredient_products(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Ingredient -> product pairs of the eight paths, distinct."""
    return walk(nodes, edges, CROSSWALK_PATHS)


def build_crosswalk(nodes: DataFrame, edges: DataFrame, attributes: DataFrame) -> DataFrame:
    """Ingredient -> product -> dose form -> package code (10 columns).

    Dose form is an outer lookup (a product without one keeps null dose form
    columns; a dose-form edge to a concept of another type also gives
    nulls).  The package code lookup is an inner join.  Each of the three inputs
    is made distinct on its few columns, all of which the result keeps: its wide
    rows are distinct without an aggregate over them."""
    products = ingredient_products(nodes, edges)
    forms = typed_edges(edges, "has_dose_form").join(
        concepts(nodes, "DF", "dose_form").withColumnRenamed("dose_form_rxcui", "_next"),
        "_next", "left")
    forms = forms.select(F.col("_at").alias("medication_product_rxcui"),
                         F.when(F.col("dose_form_name").isNotNull() | F.col("dose_form_tty").isNotNull(),
                                F.col("_next")).alias("dose_form_rxcui"),
                         "dose_form_name", "dose_form_tty")
    ndc = attributes.where((F.col("sab") == SAB) & (F.col("atn") == "NDC") & F.col("atv").isNotNull()).select(
        F.col("rxcui").alias("medication_product_rxcui"), F.col("atv").alias("medication_ndc"))
    forms, ndc = (df.repartition("medication_product_rxcui").distinct() for df in (forms, ndc))  # as the joins need them
    out = products.join(forms, "medication_product_rxcui", "left").join(ndc, "medication_product_rxcui")
    return out.select(*CROSSWALK_COLUMNS)


def dose_form_groups(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(df, dfg): dose forms with their groups; a form without a group keeps
    a null group."""
    forms = concepts(nodes, "DF", "df").select("df_rxcui", F.col("df_name").alias("df"))
    groups = typed_edges(edges, "isa").join(
        concepts(nodes, "DFG", "dfg").select(F.col("dfg_rxcui").alias("_next"), F.col("dfg_name").alias("dfg")),
        "_next", "left").select(F.col("_at").alias("df_rxcui"), "dfg")
    return forms.join(groups, "df_rxcui", "left").select("df", "dfg").distinct()
