"""Column expressions as SQL text, for ``selectExpr``, ``filter`` and ``expr``.

Text keeps wide projections cheap to build: several hundred columns are one call, where
Column objects would cost a round trip to the JVM per operator. Everything stays inside
JVM code generation.
"""

from factloom.functions.change import effective_action, unified_action
from factloom.functions.ledger import (
    movement_label,
    opposite_side,
    own_side,
    signed_quantity,
)
from factloom.functions.text import left_chars, literal, path_segment, right_chars, source_id

__all__ = [
    "effective_action",
    "left_chars",
    "literal",
    "movement_label",
    "opposite_side",
    "own_side",
    "path_segment",
    "right_chars",
    "signed_quantity",
    "source_id",
    "unified_action",
]
