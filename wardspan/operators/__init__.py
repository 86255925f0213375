"""Reusable operators, each ``DataFrame -> DataFrame``."""

from wardspan.operators.checks import (
    check_not_null,
    check_unique,
    interval_problems,
    repeated_deaths,
)
from wardspan.operators.conform import conform, empty_table
from wardspan.operators.covering import containment_join, earliest_cover
from wardspan.operators.ids import COPY, dense_ids, tag_copies
from wardspan.operators.intervals import island_ends, merge_intervals, valid_intervals
from wardspan.operators.mapping import (
    code_map,
    map_codes,
    rollup_to_ancestor,
    source_to_source,
    source_to_standard,
    unmapped_codes,
    with_source_concept,
)
from wardspan.operators.picks import pick_best
from wardspan.operators.ranges import Like
from wardspan.operators.scans import highest_before, previous_value

__all__ = [
    "COPY",
    "Like",
    "check_not_null",
    "check_unique",
    "code_map",
    "conform",
    "containment_join",
    "dense_ids",
    "earliest_cover",
    "empty_table",
    "highest_before",
    "interval_problems",
    "island_ends",
    "map_codes",
    "merge_intervals",
    "pick_best",
    "previous_value",
    "repeated_deaths",
    "rollup_to_ancestor",
    "source_to_source",
    "source_to_standard",
    "tag_copies",
    "unmapped_codes",
    "valid_intervals",
    "with_source_concept",
]
