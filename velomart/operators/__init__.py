"""Reusable relational operators built from DataFrame primitives."""

from velomart.operators.aggregates import first_by, signed_endpoints
from velomart.operators.dedup import Marks, keep_latest, marked_apart, marks_of_repeated, merge_states
from velomart.operators.neighbors import with_neighbor
from velomart.operators.ranking import with_percent_rank, with_rank, with_row_number

__all__ = [
    "Marks",
    "first_by",
    "keep_latest",
    "marked_apart",
    "marks_of_repeated",
    "merge_states",
    "signed_endpoints",
    "with_neighbor",
    "with_percent_rank",
    "with_rank",
    "with_row_number",
]
