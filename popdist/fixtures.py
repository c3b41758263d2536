"""Stand-in inputs derived from the driver tables.

The reference reads a drug vocabulary, survey files and a drug directory
which are not available offline.  These functions derive inputs of the same
shape from the TPC-H-like tables, as Spark DataFrame code.  Every rule reads
its whole source table, so the work grows with the scale factor.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import spread

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


class Tables:
    """Lazy access to the parquet tables of one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.table(name)
        raise AttributeError(name)


def _s(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


class Fixtures:
    """The ``fx_*`` views: survey, crosswalk, concept graph, populations."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.t = Tables(spark, sf_dir)
        self.spark = spark

    # -- survey ------------------------------------------------------------
    @cached_property
    def demographics(self) -> DataFrame:
        """Person file: DUPERSID, PERWTF (bigint), SEX (text), AGELAST, REGION.
        Weight 0, sex '9' and region -1 occur; ages run from -1 to 104."""
        c = self.t.customer
        n = self.t.nation
        k = F.col("c_custkey")
        return c.join(n, c.c_nationkey == n.n_nationkey).select(
            _s(k).alias("DUPERSID"),
            F.when(k % 97 == 0, F.lit(0)).otherwise(F.floor(F.abs("c_acctbal")))
            .cast("bigint").alias("PERWTF"),
            F.when(k % 50 == 0, F.lit("9")).when(k % 2 == 0, F.lit("1")).otherwise(F.lit("2"))
            .alias("SEX"),
            ((k * 7) % 106 - 1).cast("int").alias("AGELAST"),
            F.when(k % 41 == 0, F.lit(-1)).otherwise(F.col("n_regionkey")).cast("int")
            .alias("REGION"),
        )

    @cached_property
    def prescription(self) -> DataFrame:
        """Prescription file, all text like the staged survey file:
        DUPERSID, RXNDC, RXQUANTY ('17.0'), RXDAYSUP ('0', '15', ...)."""
        li = spread(self.t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_linenumber"), "l_orderkey")
        o = spread(self.t.orders.select("o_orderkey", "o_custkey"), "o_orderkey")
        return li.join(o, li.l_orderkey == o.o_orderkey).select(
            _s("o_custkey").alias("DUPERSID"),
            _s("l_partkey").alias("RXNDC"),
            _s("l_quantity").alias("RXQUANTY"),
            _s((F.col("l_linenumber") - 1) * 15).alias("RXDAYSUP"),
        )

    @cached_property
    def crosswalk(self) -> DataFrame:
        """Resolved-vocabulary stand-in: every part is a package (NDC) of one
        product with an IN ingredient (its brand); every fifth package also
        has a MIN row.  Names need cleaning."""
        p = self.t.part.select("p_partkey", "p_brand", "p_name", "p_type", "p_size")
        product_rxcui = F.concat(F.lit("P-"), "p_brand", F.lit("-"), "p_name")
        product_name = F.concat("p_brand", F.lit(" / "), "p_name")
        ins = p.select(
            F.concat(F.lit("I-"), "p_brand").alias("medication_ingredient_rxcui"),
            F.col("p_brand").alias("medication_ingredient_name"),
            F.lit("IN").alias("medication_ingredient_tty"),
            product_rxcui.alias("medication_product_rxcui"),
            product_name.alias("medication_product_name"),
            F.col("p_type").alias("dose_form_name"),
            _s("p_partkey").alias("medication_ndc"),
        )
        combo = _s(F.col("p_size") % 3)
        mins = p.where(F.col("p_partkey") % 5 == 0).select(
            F.concat(F.lit("M-"), combo).alias("medication_ingredient_rxcui"),
            F.concat(F.lit("Combo/"), combo).alias("medication_ingredient_name"),
            F.lit("MIN").alias("medication_ingredient_tty"),
            product_rxcui.alias("medication_product_rxcui"),
            product_name.alias("medication_product_name"),
            F.col("p_type").alias("dose_form_name"),
            _s("p_partkey").alias("medication_ndc"),
        )
        return ins.unionByName(mins)

    @cached_property
    def region_states(self) -> DataFrame:
        """Region -> state stand-in: (region_value, state)."""
        r = self.t.region
        n = self.t.nation
        return r.join(n, n.n_regionkey == r.r_regionkey).select(
            F.col("r_regionkey").cast("int").alias("region_value"),
            F.col("n_name").alias("state"))

    # -- concept graph -----------------------------------------------------
    @cached_property
    def rxnconso(self) -> DataFrame:
        """Concept nodes (rxcui, sab, tty, str)."""
        t = self.t

        def node(df, rxcui, tty, name):
            return df.select(rxcui.alias("rxcui"), F.lit("RXNORM").alias("sab"),
                             F.lit(tty).alias("tty"), name.alias("str"))

        o = t.orders
        parts = [
            node(t.region, F.concat(F.lit("R"), _s("r_regionkey")), "IN", F.col("r_name")),
            node(t.nation, F.concat(F.lit("N"), _s("n_nationkey")), "SCDC", F.col("n_name")),
            node(t.customer, F.concat(F.lit("C"), _s("c_custkey")), "SCD", F.col("c_name")),
            node(o, F.concat(F.lit("O"), _s("o_orderkey")),
                 "GPCK", F.concat(F.lit("Pack "), _s("o_orderkey"))),
            node(o, F.concat(F.lit("K"), _s("o_orderkey")),
                 "BPCK", F.concat(F.lit("Brand pack "), _s("o_orderkey"))),
            node(t.part.select("p_brand").distinct(), F.concat(F.lit("B-"), "p_brand"), "BN",
                 F.col("p_brand")),
            node(t.part, F.concat(F.lit("P"), _s("p_partkey")), "SBD", F.col("p_name")),
            node(t.customer.select("c_mktsegment").distinct(),
                 F.concat(F.lit("M-"), "c_mktsegment"), "MIN", F.col("c_mktsegment")),
            node(t.part.select("p_type").distinct(), F.concat(F.lit("D-"), "p_type"), "DF",
                 F.col("p_type")),
            node(t.region, F.concat(F.lit("G"), _s("r_regionkey")), "DFG",
                 F.concat("r_name", F.lit(" Product"))),
        ]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    @cached_property
    def rxnrel(self) -> DataFrame:
        """Typed edges (rxcui1, rela, rxcui2), read as 'rxcui2 rela rxcui1'."""
        t = self.t

        def edge(df, a, rela, b):
            return df.select(a.alias("rxcui1"), F.lit(rela).alias("rela"), b.alias("rxcui2"))

        o = t.orders
        pk = F.col("p_partkey")
        parts = [
            edge(t.nation, F.concat(F.lit("N"), _s("n_nationkey")), "ingredient_of",
                 F.concat(F.lit("R"), _s("n_regionkey"))),
            edge(t.customer, F.concat(F.lit("C"), _s("c_custkey")), "constitutes",
                 F.concat(F.lit("N"), _s("c_nationkey"))),
            edge(o, F.concat(F.lit("O"), _s("o_orderkey")), "contained_in",
                 F.concat(F.lit("C"), _s("o_custkey"))),
            edge(o, F.concat(F.lit("K"), _s("o_orderkey")), "has_tradename",
                 F.concat(F.lit("O"), _s("o_orderkey"))),
            edge(t.part.select("p_brand", "p_size").select(
                "p_brand", (F.col("p_size") % 5).alias("g")).distinct(),
                F.concat(F.lit("B-"), "p_brand"), "has_tradename",
                F.concat(F.lit("R"), _s("g"))),
            edge(t.part, F.concat(F.lit("P"), _s(pk)), "ingredient_of",
                 F.concat(F.lit("B-"), "p_brand")),
            edge(t.customer, F.concat(F.lit("C"), _s("c_custkey")), "ingredients_of",
                 F.concat(F.lit("M-"), "c_mktsegment")),
            edge(t.part, F.concat(F.lit("P"), _s(pk)), "has_tradename",
                 F.concat(F.lit("C"), _s(pk))),
            edge(o, F.concat(F.lit("K"), _s("o_orderkey")), "contained_in",
                 F.concat(F.lit("P"), _s("o_custkey"))),
            edge(t.part, F.concat(F.lit("D-"), "p_type"), "has_dose_form",
                 F.concat(F.lit("P"), _s(pk))),
            edge(t.part.where(F.col("p_type") != "PROMO"),
                 F.concat(F.lit("G"), _s(F.col("p_size") % 5)), "isa",
                 F.concat(F.lit("D-"), "p_type")),
        ]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    @cached_property
    def rxnsat(self) -> DataFrame:
        """Concept attributes (rxcui, sab, atn, atv): package codes."""
        t = self.t

        def attr(df, rxcui, atn, atv):
            return df.select(rxcui.alias("rxcui"), F.lit("RXNORM").alias("sab"),
                             atn.alias("atn"), atv.alias("atv"))

        o = t.orders
        ok = F.col("o_orderkey")
        parts = [
            attr(t.part, F.concat(F.lit("P"), _s("p_partkey")), F.lit("NDC"),
                 F.concat(F.lit("7"), _s("p_partkey"))),
            attr(t.customer,
                 F.concat(F.lit("C"), _s("c_custkey")), F.lit("NDC"),
                 F.concat(F.lit("8"), _s("c_custkey"))),
            attr(o, F.concat(F.lit("O"), _s(ok)), F.lit("NDC"),
                 F.concat(F.lit("9"), _s(ok))),
            attr(o, F.concat(F.lit("K"), _s(ok)),
                 F.when(ok % 2 == 0, F.lit("NDC")).otherwise(F.lit("OTHER")),
                 F.concat(F.lit("6"), _s(ok))),
        ]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    # -- second population (validation) -------------------------------------
    @cached_property
    def medications(self) -> DataFrame:
        """Medication orders of a second population: START, PATIENT, CODE (the
        ordered product's id, as text)."""
        li = self.t.lineitem
        o = self.t.orders
        p = self.t.part
        return li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey).select(
            F.to_date("l_shipdate").alias("START"),
            _s("o_custkey").alias("PATIENT"),
            F.concat(F.lit("P-"), "p_brand", F.lit("-"), "p_name").alias("CODE"))

    @cached_property
    def patients(self) -> DataFrame:
        """Patients of the second population: Id, BIRTHDATE."""
        c = self.t.customer
        return c.select(
            _s("c_custkey").alias("Id"),
            F.date_add(F.lit("1990-01-01").cast("date"), (F.col("c_custkey") % 4000).cast("int"))
            .alias("BIRTHDATE"))

    # -- class membership ----------------------------------------------------
    @cached_property
    def class_members(self) -> DataFrame:
        """Class membership table (class_id, rela_source, rela, rxcui): every
        part puts its brand ingredient into the class named by its type,
        under an ATC relation and a DailyMed 'has_EPC' relation."""
        p = self.t.part.select("p_type", "p_brand")
        ing = F.concat(F.lit("I-"), "p_brand")
        atc = p.select(F.col("p_type").alias("class_id"), F.lit("ATC").alias("rela_source"),
                       F.lit(None).cast("string").alias("rela"), ing.alias("rxcui"))
        epc = p.select(F.concat(F.lit("EPC-"), "p_type").alias("class_id"),
                       F.lit("DailyMed").alias("rela_source"), F.lit("has_EPC").alias("rela"),
                       ing.alias("rxcui"))
        return atc.unionByName(epc)

    @cached_property
    def class_responses(self) -> DataFrame:
        """Pages of class member answers as nested JSON documents (class_id,
        rela_source, rela, page, response).  Every part is listed in one class,
        under one of the 24 relationships, with four members: its brand as
        ingredient, a combination, its product and a brand name; attributes hold
        text with quotes, numbers, truth values, nulls and lists."""
        from .sources.class_members import RELATION_SOURCE, SINGLE_RELATION_SOURCES

        p = self.t.part
        names = F.array(*[F.lit(r) for r in RELATION_SOURCE])
        sources = F.array(*[F.lit(s) for s in RELATION_SOURCE.values()])
        which = (F.col("p_partkey") % len(RELATION_SOURCE) + 1).cast("int")
        relation = F.element_at(names, which)

        def member(rxcui, name, tty, value):
            concept = F.struct(rxcui.alias("rxcui"), name.alias("name"), F.lit(tty).alias("tty"))
            return F.concat(F.lit('{"minConcept":'), F.to_json(concept), F.lit(',"nodeAttr":[{"attrName":"Note","attrValue":'), value,
                            F.lit("}]}"))

        quoted = F.to_json(F.struct(F.concat(F.col("p_name"), F.lit(' "'), F.col("p_type"), F.lit('\\"')).alias("v")))
        members = F.concat_ws(
            ",",
            member(F.concat(F.lit("I-"), "p_brand"), F.col("p_brand"), "IN", F.concat(F.lit("["), quoted, F.lit(',{"attrValue":null}]'))),
            member(F.concat(F.lit("M-"), _s(F.col("p_size") % 3)), F.concat(F.lit("Combo/"), _s(F.col("p_size") % 3)), "MIN",
                   F.when(F.col("p_size") % 2 == 0, F.lit("true")).otherwise(F.lit("false"))),
            member(F.concat(F.lit("P-"), "p_brand", F.lit("-"), "p_name"), F.col("p_name"), "SCD", _s("p_size")),
            member(F.concat(F.lit("B-"), "p_brand"), F.col("p_brand"), "BN", F.to_json(F.struct(F.col("p_type").alias("attrValue")))))
        one = p.select(
            F.col("p_type").alias("class_id"), F.element_at(sources, which).alias("rela_source"),
            F.when(~relation.isin(*SINGLE_RELATION_SOURCES), relation).alias("rela"),
            F.expr("p_partkey div 100").alias("page"), "p_partkey", members.alias("members"))
        pages = one.groupBy("class_id", "rela_source", "rela", "page").agg(  # at most 100 parts of a page
            F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("p_partkey", "members"))), lambda m: m["members"]), ",").alias("m"))
        return pages.select("class_id", "rela_source", "rela", "page", F.concat(
            F.lit('{"drugMemberGroup":{"drugMember":['), "m", F.lit("]}}")).alias("response"))
