"""Module states: lookup-table transitions, remark lines, medication order
states and the JSON module document.

Orderings ("first transition gets probability 1", remark numbers) are
row numbers over the names of one lookup table -- a list bounded by the
vocabulary, never by the survey size.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import normalize_name, remark_line
from ..session import small_table, staged
from ..settings import AppSettings, ModuleSettings
from .distribution import ING, PROD, PROD_ID, Distribution
from .lookup import table_name, transition_name

RULE = "-" * 72
# Fixed values that readers of the documents and other engines rely on.
GMF_VERSION = 2
CODE_SYSTEM = "RxNorm"
NIL = "is nil"
REFERENCE_URLS = (
    "https://mor.nlm.nih.gov/RxClass/",
    "https://www.nlm.nih.gov/research/umls/rxnorm/index.html",
    "https://mor.nlm.nih.gov/RxNav/",
    "https://meps.ahrq.gov/mepsweb/data_stats/MEPS_topics.jsp?topicid=46Z-1",
    "https://www.fda.gov/drugs/drug-approvals-and-databases/national-drug-code-directory",
)
TITLE_LINES = (
    "Picks one drug product with the odds seen in a weighted survey.",
    "The caller ends the order; it finds it under the attribute",
)
LINK_LINES = ("", "Where the codes and the counts come from:") + tuple(f"  {u}" for u in REFERENCE_URLS) + (
    "", "Written by popdist.")
TABLE_HEAD = ("No. [ share ] Name",)
INGREDIENT_HEADER = (RULE, "Which ingredient, by share of weighted patients", RULE) + TABLE_HEAD
ORDER_HEADER = (RULE, "The orders, one state for each product", RULE)


def _lit_array(lines) -> Column:
    return F.array(*[F.lit(x) for x in lines]) if lines else F.array().cast("array<string>")


# -- transitions ---------------------------------------------------------------

def transitions(dist: Distribution, app: AppSettings = AppSettings()) -> DataFrame:
    """(cohort, state, ordinal, transition, default_probability,
    lookup_table_name) for the ingredient table state and one product
    table state per ingredient.  Names in name order; the first transition
    of a state has default probability '1', the others '0'."""
    ing = dist.ingredient_region.select("cohort", ING).distinct().select(
        "cohort", normalize_name(F.lit(app.state_prefix + "Ingredient")).alias("state"),
        F.col(ING).alias("_order"),
        transition_name(app.state_prefix, ING).alias("transition"),
        table_name(F.col("cohort"), F.lit(app.ingredient_distribution_suffix)).alias("lookup_table_name"))
    prod = dist.product_region.select("cohort", ING, PROD).distinct().select(
        "cohort", transition_name(app.state_prefix, ING).alias("state"),
        F.col(PROD).alias("_order"),
        transition_name(app.state_prefix, PROD).alias("transition"),
        table_name(F.col("cohort"), F.lit("_"), F.col(ING),
                   F.lit(app.product_distribution_suffix)).alias("lookup_table_name"))
    # names that clean to one transition are one transition
    both = ing.unionByName(prod).groupBy("cohort", "state", "transition", "lookup_table_name").agg(
        F.min("_order").alias("_order"))
    w = Window.partitionBy("cohort", "state", "lookup_table_name").orderBy("_order", "transition")
    out = both.withColumn("ordinal", F.row_number().over(w))
    return out.select(
        "cohort", "state", "ordinal", "transition",
        F.when(F.col("ordinal") == 1, F.lit("1")).otherwise(F.lit("0")).alias("default_probability"),
        "lookup_table_name")


# -- remark lines -------------------------------------------------------------------

def rollup_remarks(dist: Distribution, app: AppSettings = AppSettings()) -> DataFrame:
    """(cohort, state, line_no, line): ``'{i}. [ {pct}% ] {name}'`` for the
    ingredient roll-up and, per ingredient, the product roll-up."""
    ir = dist.ingredient_rollup().select(
        "cohort", normalize_name(F.lit(app.state_prefix + "Ingredient")).alias("state"),
        F.col(ING).alias("name"), F.col("agg_percent_ingredient_patients").alias("pct"))
    pr = dist.product_rollup().select(
        "cohort", transition_name(app.state_prefix, ING).alias("state"),
        F.col(PROD).alias("name"), F.col("agg_percent_product_patients").alias("pct"))
    both = ir.unionByName(pr)
    w = Window.partitionBy("cohort", "state").orderBy("name", "pct")
    numbered = both.withColumn("line_no", F.row_number().over(w))
    return numbered.select("cohort", "state", "line_no", remark_line("line_no", "pct", "name").alias("line"))


# -- medication order states -------------------------------------------------------

def prescribed_pairs(ndc_rows: DataFrame, prescription: DataFrame, demographics: DataFrame) -> DataFrame:
    """(cohort, product name, product id) of the package rows that any known
    person has been prescribed: the survey join is only asked whether a row
    exists, so the packages are semi-joined to the distinct codes."""
    known = demographics.select("DUPERSID")
    codes = prescription.select("DUPERSID", "RXNDC").distinct().join(known, "DUPERSID", "left_semi").select(
        F.col("RXNDC").alias("medication_ndc")).distinct()
    return ndc_rows.join(codes, "medication_ndc", "left_semi").select("cohort", PROD, PROD_ID).distinct()


def order_states(pairs: DataFrame, modules: list[ModuleSettings],
                 app: AppSettings = AppSettings()) -> DataFrame:
    """One MedicationOrder state per state name, from (cohort, product name,
    product id) rows, repeated or not (raw names, before any demographic
    fan-out).  On a name collision the last (name, id) pair wins; the first
    pair's state carries the section remarks if it survives."""
    pairs = staged(pairs.select("cohort", PROD, PROD_ID).distinct(), "order-pairs")
    pairs = pairs.withColumn("state_name", transition_name(app.state_prefix, PROD))
    first = pairs.groupBy("cohort").agg(F.min(F.struct(PROD, PROD_ID)).alias("_first"))
    won = pairs.groupBy("cohort", "state_name").agg(
        F.max_by(F.struct(PROD, PROD_ID), F.struct(PROD, PROD_ID)).alias("_pair"))
    won = won.join(first, "cohort")
    settings = _module_rows(won.sparkSession, modules)
    out = won.join(settings, "cohort")
    return out.select(
        "cohort", "state_name",
        F.col("_pair")[PROD_ID].alias("code"),
        F.col("_pair")[PROD].alias("display"),
        "assign_to_attribute", "refills", "as_needed", "chronic", "reason",
        (F.col("_pair") == F.col("_first")).alias("has_remarks"))


MODULE_SCHEMA = ("cohort string, display_name string, attribute_source string, refills int, as_needed boolean, "
                 "chronic boolean, reason string, settings array<string>")


def _module_rows(spark, modules: list[ModuleSettings]) -> DataFrame:
    """Per-module settings as a small table (one row per module)."""
    rows = []
    for m in modules:
        refills = m.refills if isinstance(m.refills, int) and not isinstance(m.refills, bool) else 0
        as_needed = m.as_needed if m.as_needed in (True, False) else None
        chronic = m.chronic if m.chronic in (True, False) else None
        rows.append((m.module_name, m.name, m.assign_to_attribute or m.module_name, refills,
                     as_needed, chronic, m.reason, json.dumps(m.as_dict(), indent=4, default=str).split("\n")))
    df = small_table(spark, rows, MODULE_SCHEMA)
    return df.withColumn("assign_to_attribute", normalize_name("attribute_source", "lower"))


# -- module document ------------------------------------------------------------------

# A document is made of pieces, one line of text each, ordered by
# (place, state, section, line_no).  No row ever holds the states of a module
# or the names of a lookup table.
PIECE = ("cohort", "place", "state_name", "section", "line_no", "text")
HEAD, INITIAL, TERMINAL, INGREDIENTS, PRODUCTS, ORDERS, FOOT = range(-1, 6)
OPEN, HEADER, LINES, MIDDLE, ROWS, CLOSE = range(6)


def json_text(c: Column) -> Column:
    """A string as a JSON literal."""
    return F.regexp_replace(F.to_json(F.array(c)), r"(?s)^\[(.*)\]$", "$1")


def _listed(first: Column, c: Column) -> Column:
    """An element of a JSON array; all but the first begin with a comma."""
    return F.when(first, c).otherwise(F.concat(F.lit(","), c))


def _object(*fields: tuple[str, Column]) -> Column:
    """``{"name": value, ...}``; values are JSON text, null ones are left out."""
    parts = [F.when(v.isNotNull(), F.concat(F.lit(f'"{n}":'), v)) for n, v in fields]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def _fixed(rows: DataFrame, place, section: int, lines) -> DataFrame:
    """The same lines for every row of ``rows`` (cohort, state_name)."""
    return rows.select("cohort", F.lit(place).alias("place"), "state_name", F.lit(section).alias("section"),
                       F.posexplode(_lit_array(lines)).alias("line_no", "text"))


def remark_pieces(dist: Distribution, modules: list[ModuleSettings], app: AppSettings = AppSettings()) -> DataFrame:
    """The remarks of every module, a row per line: title block and settings
    (place HEAD), then a header and the shares of each lookup table.  The text
    log writes these lines, the document quotes them."""
    mods = _module_rows(dist.ingredient_region.sparkSession, modules)
    ingredient_state = normalize_name(F.lit(app.state_prefix + "Ingredient"))
    shown = normalize_name(F.coalesce(F.col("display_name"), normalize_name(F.col("cohort"), spaces=True)), "upper", spaces=True)
    head = mods.select("cohort", F.lit(HEAD).alias("place"), F.lit("").alias("state_name"), F.lit(HEADER).alias("section"),
                       F.posexplode(F.concat(
                           F.array(F.lit(RULE), F.concat(F.lit("SUBMODULE "), shown), F.lit(RULE)),
                           _lit_array(TITLE_LINES), F.array(F.concat(F.lit("  "), F.col("assign_to_attribute"))),
                           _lit_array(LINK_LINES), F.array(F.lit(""), F.lit("Its settings:")),
                           F.col("settings"))).alias("line_no", "text"))
    named = dist.product_region.groupBy("cohort", transition_name(app.state_prefix, ING).alias("state_name")).agg(
        F.upper(F.min(ING)).alias("title"))
    one = dist.ingredient_region.select("cohort", ingredient_state.alias("state_name")).distinct()
    header = _fixed(one, INGREDIENTS, HEADER, INGREDIENT_HEADER).unionByName(named.select(
        "cohort", F.lit(PRODUCTS).alias("place"), "state_name", F.lit(HEADER).alias("section"), F.posexplode(F.concat(
            F.array(F.lit(RULE), F.concat(F.lit("Which product of "), F.col("title")), F.lit(RULE)),
            _lit_array(TABLE_HEAD))).alias("line_no", "text")))
    shares = rollup_remarks(dist, app).select(
        "cohort", F.when(F.col("state") == ingredient_state, INGREDIENTS).otherwise(PRODUCTS).alias("place"),
        F.col("state").alias("state_name"), F.lit(LINES).alias("section"), "line_no", F.col("line").alias("text"))
    return head.unionByName(header).unionByName(shares).select(*PIECE)


def document_pieces(dist: Distribution, pairs: DataFrame, modules: list[ModuleSettings],
                    app: AppSettings = AppSettings()) -> DataFrame:
    """The pieces of every module's JSON document.

    States: Initial, Terminal, the ingredient table state, one product table
    state per ingredient, one order state per product; of states of one name
    the latest in that list stays.  The opening piece of a state has section
    OPEN; whoever puts the pieces together sets a comma between states."""
    mods = _module_rows(dist.ingredient_region.sparkSession, modules)
    ingredient_state = normalize_name(F.lit(app.state_prefix + "Ingredient"))

    def whole(rows: DataFrame, place: int, name: Column, text: Column) -> DataFrame:
        opening = F.concat(json_text(name), F.lit(":"), text)
        return rows.select("cohort", F.lit(place).alias("place"), name.alias("state_name"), F.lit(OPEN).alias("section"),
                           F.lit(0).alias("line_no"), opening.alias("text"))

    ask = _object(("condition", _object(("condition_type", F.lit('"Attribute"')), ("attribute", json_text(F.col("assign_to_attribute"))),
                                        ("operator", F.lit(f'"{NIL}"')))), ("transition", json_text(ingredient_state)))
    initial = whole(mods, INITIAL, F.lit("Initial"), _object(
        ("type", F.lit('"Initial"')),
        ("conditional_transition", F.concat(F.lit("["), ask, F.lit(',{"transition":"Terminal"}]')))))
    terminal = whole(mods, TERMINAL, F.lit("Terminal"), F.lit('{"type":"Terminal"}'))

    rows = transitions(dist, app)
    place = F.when(F.col("state") == ingredient_state, INGREDIENTS).otherwise(PRODUCTS)
    entries = rows.select(
        "cohort", place.alias("place"), F.col("state").alias("state_name"), F.lit(ROWS).alias("section"), F.col("ordinal").alias("line_no"),
        _listed(F.col("ordinal") == 1, _object(
            ("transition", json_text(F.col("transition"))), ("default_probability", json_text(F.col("default_probability"))),
            ("lookup_table_name", json_text(F.col("lookup_table_name"))))).alias("text"))
    tables = rows.select("cohort", place.alias("place"), F.col("state").alias("state_name")).distinct()
    frame = tables.select("cohort", "place", "state_name", F.explode(F.array(*[
        F.struct(F.lit(section).alias("section"), F.lit(0).alias("line_no"), text.alias("text")) for section, text in (
            (OPEN, F.concat(json_text(F.col("state_name")), F.lit(':{"name":'), json_text(F.col("state_name")),
                            F.lit(',"type":"Simple","remarks":['))),
            (MIDDLE, F.lit('],"lookup_table_transition":[')), (CLOSE, F.lit("]}")))])).alias("p")).select(
        "cohort", "place", "state_name", "p.*")
    remarks = remark_pieces(dist, modules, app)
    quoted = remarks.where(F.col("place") != HEAD).withColumn("text", _listed(
        (F.col("section") == HEADER) & (F.col("line_no") == 0), json_text(F.col("text"))))

    order_lines = json_text(F.lit(ORDER_HEADER[0]))
    for line in ORDER_HEADER[1:]:
        order_lines = F.concat(order_lines, F.lit(","), json_text(F.lit(line)))
    truth = lambda c: F.col(c).cast("string")
    orders = whole(order_states(pairs, modules, app), ORDERS, F.col("state_name"), _object(
        ("remarks", F.when(F.col("has_remarks"), F.concat(F.lit("["), order_lines, F.lit("]")))),
        ("name", json_text(F.col("state_name"))), ("type", F.lit('"MedicationOrder"')),
        ("assign_to_attribute", json_text(F.col("assign_to_attribute"))),
        ("codes", F.concat(F.lit("["), _object(
            ("system", F.lit(f'"{CODE_SYSTEM}"')), ("code", json_text(F.col("code"))), ("display", json_text(F.col("display")))), F.lit("]"))),
        ("prescription", _object(("refills", truth("refills")), ("as_needed", truth("as_needed")))),
        ("direct_transition", F.lit('"Terminal"')), ("chronic", truth("chronic")),
        ("reason", F.when(F.col("reason").isNotNull(), json_text(F.col("reason"))))))

    states = initial.unionByName(terminal).unionByName(frame).unionByName(entries).unionByName(quoted).unionByName(orders)
    states = staged(states.select(*PIECE), "document-pieces")
    last = states.where(F.col("section") == OPEN).groupBy("cohort", "state_name").agg(F.max("place").alias("place"))
    states = states.join(last, ["cohort", "state_name", "place"], "left_semi")

    shown = F.coalesce(F.col("display_name"), normalize_name(F.col("cohort"), spaces=True))
    head = mods.select(
        "cohort", F.lit(HEAD).alias("place"), F.lit("").alias("state_name"), F.explode(F.array(
            F.struct(F.lit(OPEN).alias("section"), F.concat(F.lit('{"name":'), json_text(normalize_name(shown, spaces=True)),
                                                            F.lit(f',"gmf_version":{GMF_VERSION},"remarks":[')).alias("text")),
            F.struct(F.lit(CLOSE).alias("section"), F.lit('],"states":{').alias("text")))).alias("p")).select(
        "cohort", "place", "state_name", "p.section", F.lit(0).alias("line_no"), "p.text")
    title = remarks.where(F.col("place") == HEAD).withColumn("text", _listed(F.col("line_no") == 0, json_text(F.col("text"))))
    foot = mods.select("cohort", F.lit(FOOT).alias("place"), F.lit("").alias("state_name"), F.lit(CLOSE).alias("section"),
                       F.lit(0).alias("line_no"), F.lit("}}").alias("text"))
    return states.unionByName(head).unionByName(title.select(*PIECE)).unionByName(foot)


def module_documents(pieces: DataFrame) -> DataFrame:
    """(cohort, state_name, place, entry): one row per state, its JSON entry put
    together from its pieces (a state has at most the lines of one lookup table)."""
    mine = pieces.where((F.col("place") != HEAD) & (F.col("place") != FOOT))
    lines = mine.groupBy("cohort", "state_name", "place").agg(
        F.sort_array(F.collect_list(F.struct("section", "line_no", "text"))).alias("lines"))
    return lines.select("cohort", "state_name", "place", F.array_join(F.transform("lines", lambda x: x["text"]), "").alias("entry"))


def _document_lines(batches):
    """(module, file, line) from sorted pieces, a comma between two states."""
    import pyarrow as pa

    module = opened = None
    for b in batches:
        cohort, place, section, text = (b.column(c).to_pylist() for c in ("cohort", "place", "section", "text"))
        for i, c in enumerate(cohort):
            if c != module:
                module, opened = c, False
            if section[i] == OPEN and place[i] != HEAD:
                text[i] = f",{text[i]}" if opened else text[i]
                opened = True
        yield pa.RecordBatch.from_pydict({"module": b.column("cohort"), "file": b.column("file"), "line": pa.array(text, pa.string())})


def document_lines(pieces: DataFrame) -> DataFrame:
    """(module, file, line): each module's JSON document, a piece per line, in
    order within a partition; the task that has a module streams its pieces."""
    named = pieces.withColumn("file", F.concat(normalize_name("cohort", "lower"), F.lit(".json")))
    return named.repartition("cohort").sortWithinPartitions(*PIECE[:5]).mapInArrow(
        _document_lines, "module string, file string, line string")


def remark_lines(remarks: DataFrame) -> DataFrame:
    """(module, file, line): each module's remarks as a text log, in order."""
    return remarks.repartition("cohort").sortWithinPartitions(*PIECE[:5]).select(
        F.col("cohort").alias("module"), F.lit("remarks.txt").alias("file"), F.col("text").alias("line"))
