"""Plan periods and the cost of procedures, drugs and conditions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardspan.operators import COPY, Like, conform, containment_join, dense_ids
from wardspan.plans import codes
from wardspan.runtime import BROADCAST_BYTES, real_sizes, shuffles_removed, stage
from wardspan.schemas import CDM, NUMERIC

_WORD_BITS = 6  # a word of a bit table holds 64
_CODE_BITS = 32  # of the table for each code, at least; then 3 % of the others stay in at most
_WORDS = 10, 21  # at least and at most 2 ** this many words
_AMOUNTS = ["total_charge", "total_paid", "paid_by_payer", "paid_by_patient", "paid_by_primary"]


def payer_plan_period(
    payers: DataFrame, payer_transitions: DataFrame, person: DataFrame
) -> DataFrame:
    """Plan spans of known persons at known payers, numbered by patient and start."""
    copy = [COPY] if COPY in payer_transitions.columns else []
    rows = (
        payer_transitions.select("patient", "start_year", "end_year", "payer", *copy)
        .join(payers.select(F.col("id").alias("payer"), "name"), "payer")
        .join(
            person.select("person_id", F.col("person_source_value").alias("patient")), "patient"
        )
    )
    order = ["patient", "start_year", "end_year", "payer", "name", "person_id"]
    like = [Like(payer_transitions.select("patient", "start_year", "end_year", "payer"))]
    numbered = dense_ids(rows, order, "payer_plan_period_id", like)
    unknown = [
        "payer_concept_id",
        "payer_source_concept_id",
        "plan_concept_id",
        "plan_source_concept_id",
        "sponsor_concept_id",
        "sponsor_source_concept_id",
        "stop_reason_concept_id",
        "stop_reason_source_concept_id",
    ]
    return conform(
        numbered.select(
            "payer_plan_period_id",
            "person_id",
            F.col("start_year").alias("payer_plan_period_start_date"),
            F.col("end_year").alias("payer_plan_period_end_date"),
            F.col("payer").alias("payer_source_value"),
            F.col("name").alias("plan_source_value"),
            *[F.lit(0).alias(c) for c in unknown],
        ),
        CDM["payer_plan_period"],
    )


def _billed_encounters(
    encounters: DataFrame, visit_occurrence: DataFrame, person: DataFrame
) -> DataFrame:
    """Encounters that stand for a visit of their patient. Only these carry cost: the other
    encounters of a visit get none."""
    people = person.select("person_id", F.col("person_source_value").alias("patient"))
    visits = visit_occurrence.select(
        "visit_occurrence_id", "person_id", F.col("visit_source_value").alias("encounter")
    )
    return (
        encounters.select(
            F.col("id").alias("encounter"),
            "patient",
            "provider",
            "payer",
            "start",
            "total_claim_cost",
            "payer_coverage",
        )
        .join(visits, "encounter")
        .join(people, ["patient", "person_id"])
    )


def _place(code: Column, words: int) -> tuple[Column, Column]:
    """The word of a bit table of so many words that has the bit of a code, and that bit."""
    at = F.xxhash64(code).bitwiseAND(F.lit((words << _WORD_BITS) - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))
    return F.shiftright(at, _WORD_BITS).cast("int"), bit


def _code_bits(codes_: DataFrame, words: int) -> DataFrame:
    """One row with an array of words in which the bit of each code is set."""
    word, bit = _place(F.col("code"), words)
    found = codes_.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits"))
    every = codes_.sparkSession.range(words).select(F.col("id").cast("int").alias("word"))
    filled = every.join(found, "word", "left").select("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    ordered = F.sort_array(F.collect_list(F.struct("word", "bits")))
    return filled.agg(ordered.alias("w")).select(F.col("w.bits").alias("_words"))


def _codes_of(events: DataFrame) -> Callable[..., DataFrame]:
    """Gives rows whose code some event has, and few others, which find no event to join later. Without
    this all would be shuffled first.

    Not the codes are broadcast but a bit for each of them, by its hash, in a table of 16 MB at most, so that
    the driver holds no more however many codes there are. Beyond four million codes, more and more of the
    other rows stay in."""
    known = stage(events.select("code").where("code IS NOT NULL").distinct(), "codes")
    least, most = _WORDS
    words = 1 << min(max((known.count() * _CODE_BITS >> _WORD_BITS).bit_length(), least), most)
    if words << 3 > BROADCAST_BYTES:
        return lambda rows, column="code": rows
    bits = stage(_code_bits(known, words), "code-bits")

    def kept(rows: DataFrame, column: str = "code") -> DataFrame:
        word, bit = _place(F.col(column), words)
        has = F.get("_words", word).bitwiseAND(bit) != 0
        return rows.join(F.broadcast(bits), F.col(column).isNotNull() & has, "left_semi")

    return kept


def _of_codes(rows: DataFrame, events: DataFrame, column: str = "code") -> DataFrame:
    return _codes_of(events)(rows, column)


def _charges(facts: DataFrame, billed: DataFrame) -> DataFrame:
    """Distinct amounts per visit, person and code.

    Facts are reduced to distinct charges before they meet the events of the visit: copies of a
    charge combine on the map side and never pair up with copies of the event.
    """
    base, claim, cover = F.col("base_cost"), F.col("total_claim_cost"), F.col("payer_coverage")
    return (
        facts.select("encounter", "patient", "code", "base_cost")
        .distinct()
        .join(billed, ["encounter", "patient"])
        .select(
            "visit_occurrence_id",
            "person_id",
            "code",
            (claim + base).cast(NUMERIC).alias("total_charge"),
            (cover + base).cast(NUMERIC).alias("total_paid"),
            cover.alias("paid_by_payer"),
            (claim + base - cover).cast(NUMERIC).alias("paid_by_patient"),
            F.lit(None).cast(NUMERIC).alias("paid_by_primary"),
        )
        .distinct()
    )


def _claimed(
    conditions: DataFrame, billed: DataFrame, claims: DataFrame, transactions: DataFrame
) -> DataFrame:
    """Amounts paid per visit, person and condition code: type '1' by the payer, 'p' by the patient.

    Payments are summed by claim and repeated conditions kept as a factor before they are joined, so that
    a claim meets one row of each and no step pairs the rows of a large group.
    """
    by_payer = F.when(F.col("transfertype") == "1", F.col("amount"))
    by_patient = F.when(F.col("transfertype") == "p", F.col("amount"))
    paid = (
        transactions.filter(F.col("transfertype").isin("1", "p"))
        .groupBy(
            F.col("claimid"),
            F.col("patientid").alias("patient"),
            F.col("appointmentid").alias("encounter"),
            F.col("providerid").alias("provider"),
        )
        .agg(F.sum(by_payer).alias("payer_paid"), F.sum(by_patient).alias("patient_paid"))
    )
    per_claim = claims.select(
        F.col("id").alias("claimid"),
        F.col("patientid").alias("patient"),
        F.col("diagnosis1").alias("code"),
        F.col("currentillnessdate").cast("timestamp_ntz").alias("onset"),
        F.col("appointmentid").alias("encounter"),
        F.col("providerid").alias("provider"),
        F.col("primarypatientinsuranceid").alias("payer"),
        F.col("servicedate").cast("timestamp_ntz").alias("start"),
    ).join(paid, ["claimid", "patient", "encounter", "provider"])
    noted = conditions.groupBy(
        "patient", "encounter", "code", F.col("start").cast("timestamp_ntz").alias("onset")
    ).agg(F.count(F.lit(1)).cast("decimal(10,0)").alias("times"))

    def total(column: str):
        return F.coalesce(F.sum(F.col(column) * F.col("times")), F.lit(0)).cast(NUMERIC)

    return (
        noted.join(per_claim, ["patient", "encounter", "code", "onset"])
        .join(billed, ["patient", "encounter", "provider", "payer", "start"])
        .groupBy("visit_occurrence_id", "person_id", "code")
        .agg(total("payer_paid").alias("payer"), total("patient_paid").alias("patient"))
        .select(
            "visit_occurrence_id",
            "person_id",
            "code",
            (F.col("payer") + F.col("patient")).cast(NUMERIC).alias("total_charge"),
            (F.col("payer") + F.col("patient")).cast(NUMERIC).alias("total_paid"),
            F.col("payer").alias("paid_by_payer"),
            F.col("patient").alias("paid_by_patient"),
            F.col("payer").alias("paid_by_primary"),
        )
    )


def cost(
    procedures: DataFrame,
    immunizations: DataFrame,
    medications: DataFrame,
    conditions: DataFrame,
    claims: DataFrame,
    claims_transactions: DataFrame,
    encounters: DataFrame,
    person: DataFrame,
    visit_occurrence: DataFrame,
    procedure_occurrence: DataFrame,
    drug_exposure: DataFrame,
    condition_occurrence: DataFrame,
    payer_plan_period: DataFrame,
) -> DataFrame:
    """Cost rows of four legs, each event repeated for every plan period that contains its date.

    "Paid" adds the base cost to the payer's coverage.
    """
    spark = encounters.sparkSession
    with shuffles_removed(spark), real_sizes(spark):
        # Read by all four legs.
        billed = stage(_billed_encounters(encounters, visit_occurrence, person), "billed")

        def events(table: DataFrame, prefix: str, date: str) -> DataFrame:
            return table.select(
                F.col(table.columns[0]).alias("cost_event_id"),
                "visit_occurrence_id",
                "person_id",
                F.col(f"{prefix}_source_value").alias("code"),
                F.col(date).alias("event_date"),
            )

        done = events(procedure_occurrence, "procedure", "procedure_date")
        taken = events(drug_exposure, "drug", "drug_exposure_start_date")
        suffered = events(condition_occurrence, "condition", "condition_start_date")
        of_taken, of_suffered = _codes_of(taken), _codes_of(suffered)
        diagnosed = of_suffered(conditions), billed, of_suffered(claims, "diagnosis1"), claims_transactions
        legs = [
            ("Procedure", done, _charges(_of_codes(procedures, done), billed)),
            ("Drug", taken, _charges(of_taken(immunizations), billed)),
            ("Drug", taken, _charges(of_taken(medications), billed)),
            ("Condition", suffered, _claimed(*diagnosed)),
        ]
        same = ["visit_occurrence_id", "person_id", "code"]
        rows = [
            table.join(amounts, same)
            .select("person_id", "event_date", "cost_event_id", *_AMOUNTS)
            .withColumn("cost_domain_id", F.lit(domain))
            for domain, table, amounts in legs
        ]
        plans = payer_plan_period.select(
            "person_id",
            "payer_plan_period_id",
            F.col("payer_plan_period_start_date").alias("plan_start"),
            F.col("payer_plan_period_end_date").alias("plan_end"),
        )
        # Read for the time range, for the join and for sampling. Leg by leg, so that the disk holds the shuffles
        # of one.
        priced = reduce(DataFrame.unionByName, [stage(leg, "priced") for leg in rows])
        covered = containment_join(
            priced, plans, ["person_id"], "event_date", "plan_start", "plan_end", "left"
        ).select("cost_event_id", "cost_domain_id", *_AMOUNTS, "payer_plan_period_id")
        order = ["cost_event_id", "cost_domain_id", *_AMOUNTS, "payer_plan_period_id"]
        numbered = dense_ids(covered, order, "cost_id", [Like(priced.select(*order[:-1]))])
    return conform(
        numbered.withColumns(
            {
                "total_cost": F.col("total_charge"),
                "cost_type_concept_id": F.lit(codes.COST_TYPE),
                "currency_concept_id": F.lit(codes.CURRENCY),
                "revenue_code_concept_id": F.lit(0),
                "revenue_code_source_value": F.lit(codes.REVENUE_CODE),
                "drg_concept_id": F.lit(0),
                "drg_source_value": F.lit(codes.DRG_CODE),
            }
        ),
        CDM["cost"],
    )
