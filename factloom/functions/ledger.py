"""Derivations of the ledger-line fact."""

from __future__ import annotations

from factloom.functions.codes import DEBIT, MOVEMENT_LABELS
from factloom.functions.text import literal


def own_side(movement_sign: str, line_sign: str, own: str, other: str) -> str:
    """``own`` when the movement runs against the ledger line, else ``other``.

    A NULL sign compares as unknown and therefore yields ``other``.
    """
    return f"CASE WHEN {movement_sign} != {line_sign} THEN {own} ELSE {other} END"


def opposite_side(movement_sign: str, line_sign: str, own: str, other: str) -> str:
    """Mirror of :func:`own_side`: ``own`` when both signs agree, else ``other``."""
    return f"CASE WHEN {movement_sign} = {line_sign} THEN {own} ELSE {other} END"


def signed_quantity(line_sign: str, quantity: str) -> str:
    """Quantity as it is for a debit line, negated for every other line."""
    return f"CASE WHEN {line_sign} = {literal(DEBIT)} THEN {quantity} ELSE -({quantity}) END"


def movement_label(movement_type: str) -> str:
    """Business label of a movement type, empty text for all other types."""
    cases = " ".join(f"WHEN {literal(code)} THEN {literal(label)}" for code, label in MOVEMENT_LABELS.items())
    return f"CASE {movement_type} {cases} ELSE '' END"
