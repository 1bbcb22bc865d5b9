"""String expressions for keys and identifiers."""

from __future__ import annotations


def literal(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def left_chars(value: str, n: int) -> str:
    """First ``n`` characters (fewer if the text is shorter)."""
    return f"substring({value}, 1, {n})"


def right_chars(value: str, n: int) -> str:
    """Last ``n`` characters; a shorter text is returned whole."""
    return f"substring({value}, -{n}, {n})"


def source_id(system: str, client: str) -> str:
    """``<system>_<client>``; NULL when the client is NULL."""
    return f"concat({literal(system + '_')}, {client})"


def path_segment(path: str, position: int) -> str:
    """The ``position``-th (1-based) segment of a path, ``''`` when there is none."""
    return f"concat_ws('', slice(split({path}, '/'), {position}, 1))"
