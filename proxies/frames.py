"""The driver's tables shaped like clinical source and vocabulary tables, whole tables throughout.

Remainders only shape values (a class, a gap, a missing value); no row is left out by one.
``oracle.py`` states the same shapes for the other engine.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardspan.operators import COPY, conform, tag_copies
from wardspan.runtime import partitions_for, stage
from wardspan.schemas import SOURCE, VOCABULARY

_AMOUNT = "decimal(18,3)"
# A third of all lines have one code, the others the code of their part.
_CODE = "string(CASE WHEN l_suppkey % 3 = 0 THEN 100 ELSE l_partkey END)"


def _pick(index: str, *values: str) -> str:
    """The value at a position counted from 0."""
    branches = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {index} {branches} END"


class Clinic:
    """Lazy source and vocabulary tables over one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._opened: dict[str, DataFrame] = {}

    def raw(self, table: str) -> DataFrame:
        if table not in self._opened:  # opening reads a footer
            self._opened[table] = self.spark.read.parquet(f"{self.folder}/{table}.parquet")
        return self._opened[table]

    @cached_property
    def n_parts(self) -> int:
        return self.raw("part").count()

    @cached_property
    def doctor(self) -> str:
        """Provider of an order; a sixth of the encounters match none."""
        n = self.raw("supplier").count()
        return f"concat('d', o_orderkey % {n + n // 5})"

    # --- source tables -------------------------------------------------------------------------

    @property
    def patients(self) -> DataFrame:
        shaped = self.raw("customer").selectExpr(
            "concat('p', c_custkey) AS id",
            "date_add(DATE '1930-01-01', int(c_custkey * 97 % 30000)) AS birthdate",
            "CASE WHEN c_custkey % 10 = 9 THEN NULL WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'f' END AS gender",
            _pick("c_custkey % 5", "white", "black", "asian", "native", "White") + " AS race",
            _pick("c_nationkey % 3", "hispanic", "nonhispanic") + " AS ethnicity",
        )
        return conform(shaped, SOURCE["patients"])

    @property
    def providers(self) -> DataFrame:
        shaped = self.raw("supplier").selectExpr(
            "concat('d', s_suppkey) AS id",
            "s_name AS name",
            _pick("s_suppkey % 2", "M", "F") + " AS gender",
            "'GENERAL PRACTICE' AS speciality",
        )
        return conform(shaped, SOURCE["providers"])

    @property
    def encounters(self) -> DataFrame:
        classes = ("", "emergency", "inpatient", "ambulatory", "wellness", "outpatient")
        shaped = self.raw("orders").selectExpr(
            "concat('e', o_orderkey) AS id",
            "o_orderdate AS start",
            """CASE WHEN o_orderkey % 500 <> 7
               THEN o_orderdate + make_dt_interval(int(o_orderkey % 120)) END AS stop""",
            "concat('p', o_custkey) AS patient",
            f"{self.doctor} AS provider",
            "concat('pay', o_orderkey % 26) AS payer",
            _pick("int(substring(o_orderpriority, 1, 1))", *classes) + " AS encounterclass",
            "CASE WHEN o_orderkey % 50 = 0 THEN '308646001' ELSE '185345009' END AS code",
            f"string(o_orderkey * 7 % {self.n_parts}) AS reasoncode",
            f"CAST(o_totalprice AS {_AMOUNT}) AS total_claim_cost",
            f"CAST(o_orderkey % 1000 AS {_AMOUNT}) AS payer_coverage",
        )
        return conform(shaped, SOURCE["encounters"])

    @cached_property
    def _order_lines(self) -> DataFrame:
        """Line items with their order, joined once: four source tables are read from them, most of
        them several times by one query, as files of such tables would be. The order's key is the
        line's, and not written again."""
        items = tag_copies(self.raw("lineitem").drop("l_discount", "l_tax", "l_linestatus"))
        orders = self.raw("orders").select("o_orderkey", "o_custkey", "o_orderdate")
        with partitions_for(self.spark, items.count() + orders.count()):
            joined = items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")
            return stage(joined, "order-lines").withColumn("o_orderkey", F.col("l_orderkey"))

    @property
    def lines(self) -> DataFrame:
        """Line items with their patient: the coded events of every kind."""
        return self._order_lines.selectExpr(
            "l_shipdate AS start",
            """CASE WHEN l_returnflag <> 'N'
               THEN l_shipdate + make_dt_interval(int(l_quantity)) END AS stop""",
            "l_shipdate AS date",
            "concat('p', o_custkey) AS patient",
            "concat('e', l_orderkey) AS encounter",
            f"{_CODE} AS code",
            f"CAST(l_extendedprice AS {_AMOUNT}) AS base_cost",
            "concat('udi', l_suppkey) AS udi",
            COPY,
        )

    def _coded(self, table: str) -> DataFrame:
        copy = T.StructField(COPY, T.LongType())
        return conform(self.lines, T.StructType([*SOURCE[table].fields, copy]))

    @property
    def conditions(self) -> DataFrame:
        return self._coded("conditions")

    @property
    def medications(self) -> DataFrame:
        return self._coded("medications")

    @property
    def procedures(self) -> DataFrame:
        return self._coded("procedures")

    @property
    def devices(self) -> DataFrame:
        return self._coded("devices")

    @property
    def immunizations(self) -> DataFrame:
        return self._coded("immunizations")

    @property
    def allergies(self) -> DataFrame:
        shaped = self.raw("orders").selectExpr(
            "o_orderdate AS start",
            "concat('p', o_custkey) AS patient",
            "concat('e', o_orderkey) AS encounter",
            f"string(o_orderkey * 3 % {self.n_parts}) AS code",
        )
        return conform(shaped, SOURCE["allergies"])

    @property
    def observations(self) -> DataFrame:
        shaped = self.raw("events").selectExpr(
            "ts AS date",
            "concat('p', user_id) AS patient",
            "concat('e', event_id) AS encounter",
            "string(event_id % 50 * 4 + 2) AS code",
            f"""CASE event_id % 5 WHEN 0 THEN string(CAST(value AS {_AMOUNT})) WHEN 1 THEN '-5'
                WHEN 2 THEN props WHEN 3 THEN '.5' ELSE concat('mv', event_id % 8) END AS value""",
            "concat('unit', event_id % 30) AS units",
        )
        return conform(shaped, SOURCE["observations"])

    @property
    def payers(self) -> DataFrame:
        shaped = self.raw("nation").selectExpr("concat('pay', n_nationkey) AS id", "n_name AS name")
        return conform(shaped, SOURCE["payers"])

    @property
    def payer_transitions(self) -> DataFrame:
        """Three plan spans per customer; those of every third customer overlap."""
        spans = self.raw("customer").selectExpr("c_custkey", "explode(array(0, 1, 2)) AS i")
        first = "date_add(DATE '1995-01-01', int(c_custkey % 200 + i * 800))"
        shaped = spans.selectExpr(
            "concat('p', c_custkey) AS patient",
            f"{first} AS start_year",
            f"date_add({first}, CASE WHEN c_custkey % 3 = 0 THEN 900 ELSE 799 END) AS end_year",
            "concat('pay', (c_custkey + i) % 26) AS payer",
        )
        return conform(shaped, SOURCE["payer_transitions"])

    @property
    def _claim_lines(self) -> DataFrame:
        return self._order_lines.selectExpr(
            "concat_ws('-', o_orderkey, l_linenumber, l_partkey, l_suppkey) AS claim",
            "concat('p', o_custkey) AS patientid",
            "concat('e', o_orderkey) AS appointmentid",
            f"{self.doctor} AS providerid",
            "concat('pay', o_orderkey % 26) AS primarypatientinsuranceid",
            f"{_CODE} AS diagnosis1",
            "l_shipdate AS currentillnessdate",
            "o_orderdate AS servicedate",
            f"CAST(l_extendedprice AS {_AMOUNT}) AS charged",
            f"CAST(l_quantity AS {_AMOUNT}) AS shared",
        )

    @property
    def claims(self) -> DataFrame:
        return conform(self._claim_lines.withColumnRenamed("claim", "id"), SOURCE["claims"])

    @property
    def claims_transactions(self) -> DataFrame:
        """One payment by the payer, one by the patient and one of another kind per claim line."""
        rows = self._claim_lines.withColumnRenamed("claim", "claimid").selectExpr(
            "*", "stack(3, '1', charged, 'p', shared, 't', charged) AS (transfertype, amount)"
        )
        return conform(rows, SOURCE["claims_transactions"])

    # --- vocabulary tables ---------------------------------------------------------------------

    def _dated(self, df: DataFrame, table: str) -> DataFrame:
        dated = df.selectExpr(
            "*", "DATE '1970-01-01' AS valid_start_date", "DATE '2099-12-31' AS valid_end_date"
        )
        return conform(dated, VOCABULARY[table])

    @property
    def concept(self) -> DataFrame:
        snomed = _pick("p_partkey div 4 % 5", "Condition", "Procedure", "Device", "Observation", "Measurement")
        loinc = _pick("p_partkey div 4 % 2", "Observation", "Measurement")
        parts = self.raw("part").selectExpr(
            "p_partkey AS concept_id",
            "p_name AS concept_name",
            f"CASE p_partkey % 4 WHEN 0 THEN {snomed} WHEN 2 THEN {loinc} ELSE 'Drug' END AS domain_id",
            _pick("p_partkey % 4", "SNOMED", "RxNorm", "LOINC", "CVX") + " AS vocabulary_id",
            "CASE WHEN p_partkey % 40 = 1 THEN 'Ingredient' ELSE 'Clinical' END AS concept_class_id",
            "CASE WHEN p_size % 3 <> 0 THEN 'S' END AS standard_concept",
            "string(p_partkey) AS concept_code",
            "CASE WHEN p_size = 50 THEN 'D' END AS invalid_reason",
        )

        def extra(table: str, key: str, base: int, name: str, prefix: str, domain: str, vocabulary: str):
            return self.raw(table).selectExpr(
                f"{key} + {base} AS concept_id",
                f"{name} AS concept_name",
                f"'{domain}' AS domain_id",
                f"'{vocabulary}' AS vocabulary_id",
                "'Value' AS concept_class_id",
                "'S' AS standard_concept",
                f"concat('{prefix}', {key}) AS concept_code",
                "string(NULL) AS invalid_reason",
            )

        units = extra("nation", "n_nationkey", 100_000_000, "n_name", "unit", "Unit", "UCUM")
        values = extra("region", "r_regionkey", 200_000_000, "r_name", "mv", "Meas value", "SNOMED")
        return self._dated(parts.unionByName(units).unionByName(values), "concept")

    @property
    def concept_relationship(self) -> DataFrame:
        parts = self.raw("part").selectExpr(
            "p_partkey AS concept_id_1",
            "CASE WHEN p_size % 11 = 0 THEN 'D' END AS invalid_reason",
            """stack(3,
               CASE WHEN p_size % 3 <> 0 THEN p_partkey ELSE p_partkey + 20 END,
               CASE WHEN p_partkey % 2 = 0 THEN 'Maps to' ELSE 'MAPS TO' END,
               CASE WHEN p_size % 7 = 0 THEN p_partkey + 40 END, 'Maps to',
               p_partkey, 'Is a') AS (concept_id_2, relationship_id)""",
        ).filter("concept_id_2 IS NOT NULL")

        def itself(table: str, key: str, base: int) -> DataFrame:
            return self.raw(table).selectExpr(
                f"{key} + {base} AS concept_id_1",
                "string(NULL) AS invalid_reason",
                f"{key} + {base} AS concept_id_2",
                "'Maps to' AS relationship_id",
            )

        own = itself("nation", "n_nationkey", 100_000_000).unionByName(
            itself("region", "r_regionkey", 200_000_000)
        )
        return self._dated(parts.unionByName(own), "concept_relationship")

    @property
    def source_to_concept_map(self) -> DataFrame:
        shaped = self.raw("supplier").selectExpr(
            "string(s_suppkey * 3) AS source_code",
            "CASE WHEN s_suppkey % 2 = 0 THEN 0 ELSE s_suppkey * 3 END AS source_concept_id",
            "'SNOMED' AS source_vocabulary_id",
            "s_name AS source_code_description",
            "s_suppkey * 4 AS target_concept_id",
            "'SNOMED' AS target_vocabulary_id",
            "CASE WHEN s_suppkey % 5 = 0 THEN 'D' END AS invalid_reason",
        )
        return self._dated(shaped, "source_to_concept_map")

    @property
    def concept_ancestor(self) -> DataFrame:
        """Clinical drugs under the ingredient that opens their block of forty, some also under the
        next one, and other concepts under themselves."""
        shaped = self.raw("part").selectExpr(
            "p_partkey AS descendant_concept_id",
            """explode(array_compact(array(
               CASE WHEN p_partkey % 4 = 1 THEN p_partkey - p_partkey % 40 + 1 ELSE p_partkey END,
               CASE WHEN p_partkey % 4 = 1 AND p_size % 5 = 0 THEN p_partkey - p_partkey % 40 + 41 END
               ))) AS ancestor_concept_id""",
            "1 AS min_levels_of_separation",
        )
        levels = shaped.selectExpr("*", "min_levels_of_separation AS max_levels_of_separation")
        return conform(levels, VOCABULARY["concept_ancestor"])

    @property
    def vocabulary(self) -> DataFrame:
        shaped = self.raw("region").selectExpr(
            "CASE WHEN r_regionkey = 0 THEN 'None' ELSE r_name END AS vocabulary_id",
            "r_name AS vocabulary_name",
            "'made for tests' AS vocabulary_reference",
            "concat('v5.0 ', r_name) AS vocabulary_version",
            "r_regionkey AS vocabulary_concept_id",
        )
        return conform(shaped, VOCABULARY["vocabulary"])
