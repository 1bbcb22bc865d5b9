"""Plain descriptions that the operators take as parameters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

# SQL text for the moment a row is published.
NOW = "current_timestamp()"


def quoted(name: str, side: str | None = None) -> str:
    """Back-tick a column name so names with slashes or dots are safe."""
    text = "`" + name.replace("`", "``") + "`"
    return f"{side}.{text}" if side else text


def renamed(columns: Mapping[str, str]) -> list[str]:
    """``source AS target`` texts for ``selectExpr``."""
    return [f"{quoted(source)} AS {quoted(target)}" for source, target in columns.items()]


@dataclass(frozen=True)
class ChangeColumns:
    """Names of the change-capture columns of a feed.

    One replication route fills ``other_time``/``other_action``, the other fills
    ``time``/``action``; after unification only ``time``/``action`` remain.
    """

    other_time: str = "LAST_DTM"
    other_action: str = "LAST_ACTION_CD"
    time: str = "AEDATTM"
    action: str = "OPFLAG"


@dataclass(frozen=True)
class Lookup:
    """A left-outer enrichment step.

    ``on`` maps a column of the driving side to its counterpart in ``frame``;
    ``columns`` maps a column of ``frame`` to the name it gets in the result.
    ``copies`` False first reduces equal lookup rows to one, for results whose repeats
    are removed anyway: a lookup row that was delivered a million times then costs one
    row in the join instead of a million matches that a single task would hold.
    """

    frame: DataFrame
    on: Mapping[str, str]
    columns: Mapping[str, str]
    copies: bool = True


@dataclass(frozen=True)
class MergeSpec:
    """Upsert rule: how source rows meet target rows and what they overwrite.

    ``update`` and ``insert`` default to every target column. ``null_safe`` names
    the keys for which NULL equals NULL. ``stamp`` maps a target column to a SQL
    expression that is written on both update and insert.
    """

    keys: Sequence[str]
    update: Sequence[str] | None = None
    insert: Sequence[str] | None = None
    null_safe: Sequence[str] = ()
    stamp: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if not self.keys:
            raise ValueError("a merge needs at least one key column")
        unknown = [k for k in self.null_safe if k not in self.keys]
        if unknown:
            raise ValueError(f"null-safe columns are not keys: {unknown}")
