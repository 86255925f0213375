"""Source codes to standard concepts."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardspan.runtime import BROADCAST_BYTES, broadcast_within, stage_measured

# A code that has this share of the facts is joined apart from the others.
FREQUENT = 1 / 500

# The sixteen columns of both maps and where each comes from in a concept row.
_SOURCE_SIDE = {
    "source_code": "concept_code",
    "source_concept_id": "concept_id",
    "source_code_description": "concept_name",
    "source_vocabulary_id": "vocabulary_id",
    "source_domain_id": "domain_id",
    "source_concept_class_id": "concept_class_id",
    "source_valid_start_date": "valid_start_date",
    "source_valid_end_date": "valid_end_date",
    "source_invalid_reason": "invalid_reason",
}
_TARGET_SIDE = {
    "target_concept_id": "concept_id",
    "target_concept_name": "concept_name",
    "target_vocabulary_id": "vocabulary_id",
    "target_domain_id": "domain_id",
    "target_concept_class_id": "concept_class_id",
    "target_invalid_reason": "invalid_reason",
    "target_standard_concept": "standard_concept",
}
MAP_COLUMNS = [*_SOURCE_SIDE, *_TARGET_SIDE]


def _named(side: dict[str, str]) -> list[str]:
    return [f"{column} AS {name}" for name, column in side.items()]


def _custom(concept: DataFrame, custom_map: DataFrame) -> DataFrame:
    """Valid rows of the custom map, completed from the concepts they name where those exist.

    The source's domain and validity come from the source concept, its class from the target.
    """
    origin = concept.selectExpr(
        "concept_id AS _origin",
        "domain_id AS source_domain_id",
        "valid_start_date AS source_valid_start_date",
        "valid_end_date AS source_valid_end_date",
    )
    goal = concept.selectExpr(
        "concept_id AS _goal",
        "concept_class_id AS source_concept_class_id",
        "concept_name AS target_concept_name",
        "domain_id AS target_domain_id",
        "concept_class_id AS target_concept_class_id",
        "invalid_reason AS target_invalid_reason",
        "standard_concept AS target_standard_concept",
    )
    rows = custom_map.filter("invalid_reason IS NULL").selectExpr(
        "source_code",
        "source_concept_id",
        "source_code_description",
        "source_vocabulary_id",
        "target_concept_id",
        "target_vocabulary_id",
        "invalid_reason AS source_invalid_reason",
    )
    return (
        rows.join(origin.hint("merge"), F.col("source_concept_id") == F.col("_origin"), "left")
        .join(goal.hint("merge"), F.col("target_concept_id") == F.col("_goal"), "left")
        .select(*MAP_COLUMNS)
    )


def source_to_standard(
    concept: DataFrame, concept_relationship: DataFrame, custom_map: DataFrame
) -> DataFrame:
    """Codes to the concepts they map to: valid "Maps to" links to valid targets (the source may be
    invalid), and the valid rows of the custom map, without repeats.

    Concepts are never broadcast: their files are many times smaller than their rows, and it is the
    files that Spark goes by."""
    link = concept_relationship.filter(
        "invalid_reason IS NULL AND lower(relationship_id) = 'maps to'"
    ).select("concept_id_1", "concept_id_2")
    source = concept.selectExpr(*_named(_SOURCE_SIDE))
    target = concept.filter("invalid_reason IS NULL").selectExpr(*_named(_TARGET_SIDE))
    linked = (
        link.hint("merge").join(source.hint("merge"), F.col("concept_id_1") == F.col("source_concept_id"))
        .join(target.hint("merge"), F.col("concept_id_2") == F.col("target_concept_id"))
        .select(*MAP_COLUMNS)
    )
    return linked.unionByName(_custom(concept, custom_map)).distinct()


def source_to_source(concept: DataFrame, custom_map: DataFrame) -> DataFrame:
    """Every concept, valid or not, mapped to itself, and the valid rows of the custom map."""
    own = concept.selectExpr(*_named(_SOURCE_SIDE | _TARGET_SIDE))
    return own.unionByName(_custom(concept, custom_map)).distinct()


def code_map(
    standard: DataFrame,
    domain: str | None = None,
    target: str | None = None,
    source: str | None = None,
    source_domain: str | None = None,
) -> DataFrame:
    """(code, target_concept_id, source_concept_id) for the standard, valid targets asked for.

    Repeated targets of a code are kept: each gives a row of its own later.
    """
    rows = standard.filter(
        (F.col("target_standard_concept") == "S") & F.col("target_invalid_reason").isNull()
    )
    wanted = {
        "target_domain_id": domain,
        "target_vocabulary_id": target,
        "source_vocabulary_id": source,
        "source_domain_id": source_domain,
    }
    for column, value in wanted.items():
        if value is not None:
            rows = rows.filter(F.col(column) == value)
    return rows.select(F.col("source_code").alias("code"), "target_concept_id", "source_concept_id")


def with_source_concept(
    mapping: DataFrame,
    own: DataFrame,
    vocabulary: str,
    domain: str | None = None,
    how: str = "inner",
) -> DataFrame:
    """Take the source concept of each code from the source-to-source map instead.

    Both maps are small and joined first, so that the events meet a single narrow map.
    """
    rows = own.filter(F.col("source_vocabulary_id") == vocabulary)
    if domain is not None:
        rows = rows.filter(F.col("source_domain_id") == domain)
    rows = rows.select(F.col("source_code").alias("code"), "source_concept_id")
    return mapping.drop("source_concept_id").join(rows, "code", how)


def map_codes(
    facts: DataFrame,
    mapping: DataFrame,
    code: str = "code",
    how: str = "inner",
    max_bytes: int = BROADCAST_BYTES,
    frequent_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Join facts to a code map, ``how`` "inner" or "left"; a code with several targets gives several
    rows, and a null code has none.

    The map is staged, and broadcast only if it takes at most ``max_bytes``; codes may be as skewed as
    they like then, as facts are not shuffled at all. Beyond that ``frequent_codes`` reads the facts'
    codes once, and facts of frequent or null codes meet the map of those codes by a broadcast (if it
    takes at most ``frequent_bytes``); only the facts of the others are shuffled.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how: inner or left, not {how!r}")
    side, size = stage_measured(mapping.withColumnRenamed("code", "_code"))

    def joined(some: DataFrame, targets: DataFrame) -> DataFrame:
        return some.join(targets, F.col(code) == F.col("_code"), how).drop("_code")

    if size <= max_bytes:
        return joined(facts, F.broadcast(side))
    often = frequent_codes(facts, code)
    apart = F.col(code).isNull() | F.col(code).isin(often)
    common = broadcast_within(side.filter(F.col("_code").isin(often)), frequent_bytes)
    rest = side.filter(~F.col("_code").isin(often)).hint("merge")
    return joined(facts.filter(apart), common).unionByName(joined(facts.filter(~apart), rest))


def frequent_codes(facts: DataFrame, code: str = "code", share: float = FREQUENT) -> list:
    """Codes of at least about ``share`` of the rows, at most 1 / share of them, by a sketch that
    combines before the shuffle. It is used to place rows, never to choose them, so that it may err."""
    k = math.ceil(1 / share)
    sketch = F.expr(f"approx_top_k(`{code}`, {k}, {16 * k})")
    top, rows = facts.agg(sketch, F.count(F.lit(1))).first()
    return [r["item"] for r in top if r["item"] is not None and r["count"] >= share * rows]


def unmapped_codes(facts: DataFrame, mapping: DataFrame) -> DataFrame:
    """(code, event_count) of the facts that mapping drops, grouped before the join."""
    seen = facts.groupBy("code").agg(F.count(F.lit(1)).alias("event_count"))
    return seen.join(mapping.select("code").distinct(), "code", "left_anti")


def rollup_to_ancestor(
    df: DataFrame,
    concept_column: str,
    concept_ancestor: DataFrame,
    concept: DataFrame,
    out: str,
    vocabulary: str = "RxNorm",
    concept_class: str = "Ingredient",
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Repeat each row for every ancestor of its concept in the given vocabulary and class. The
    ancestors are staged, and broadcast only if they take at most ``max_bytes``."""
    wanted = concept.filter(
        (F.col("vocabulary_id") == vocabulary) & (F.col("concept_class_id") == concept_class)
    ).select(F.col("concept_id").alias(out))
    closure = (
        concept_ancestor.select(
            F.col("ancestor_concept_id").alias(out),
            F.col("descendant_concept_id").alias("_descendant"),
        )
        .join(wanted, out, "left_semi")
        .distinct()
    )
    return df.join(
        broadcast_within(closure, max_bytes), F.col(concept_column) == F.col("_descendant")
    ).drop("_descendant")
