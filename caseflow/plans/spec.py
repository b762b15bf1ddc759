"""Roles of an event log's columns."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class LogSpec:
    """Roles of the columns of an event log."""

    id_col: str
    order_by: tuple[str, ...]
    status_col: str
    closed: tuple[str, ...]
    labels: tuple[str, ...]
    null_tokens: tuple[str, ...] = ()
    skip: tuple[str, ...] = ()
    mixed: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()
    not_relevant: tuple[str, ...] = field(default=())
