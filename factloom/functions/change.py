"""Expressions over change-capture columns."""

from __future__ import annotations

from factloom.functions.codes import UPDATED
from factloom.functions.text import literal


def unified_action(action: str, other_action: str) -> str:
    """Action code of whichever feed filled it, with create (C) written as insert (I)."""
    found = f"coalesce({action}, {other_action})"
    return f"CASE WHEN {found} = 'C' THEN 'I' ELSE {found} END"


def effective_action(loaded: str, watermark: str, action: str) -> str:
    """The row's own action if the row itself is new, otherwise an update.

    A row that is re-derived only because one of its lookups changed counts as updated.
    """
    return f"CASE WHEN {loaded} >= {watermark} THEN {action} ELSE {literal(UPDATED)} END"
