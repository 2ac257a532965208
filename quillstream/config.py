"""Thresholds and switches: environment over file over default, resolved once on the driver."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any


@dataclass(frozen=True)
class Config:
    chunk_pages: int = 5
    repeat_lines: int = 5
    ngram: int = 3
    ngram_repeats: int = 20
    ngram_line_chars: int = 1000
    runaway_repeats: int = 20
    runaway_token_chars: int = 12
    numeric_share: float = 0.6
    table_fill: float = 0.4
    line_coverage: float = 0.6
    header_overlap: float = 0.7
    straddle_top: float = 110.0
    snap_iou: float = 0.15
    pad_points: float = 16.0
    cluster_gap: float = 28.0
    dense_lines: int = 800
    dense_lines_strong: int = 2500
    dense_designators: int = 15
    light_designators: int = 5
    light_lines: int = 200
    marker: str = "doc"
    running_headers: tuple[str, ...] = ()
    extra: Mapping[str, Any] = field(default_factory=dict)


def truthy(value: Any) -> bool:
    """False for nothing and for 0, false, no, off, none and blanks; true otherwise."""
    return value is not None and str(value).strip().lower() not in {"", "0", "false", "no", "off", "none"}


def nonempty(value: Any) -> bool:
    """True for any text that isn't empty, "0" and "false" included."""
    return bool(value)


def setting(tree: Mapping[str, Any], path: str, default: Any, cast: Callable[[Any], Any] | None = None, env: str | None = None) -> Any:
    """The environment's value, else the one at the dotted path, else the default; one that doesn't cast is passed over."""
    node: Any = tree
    for part in path.split("."):
        node = node.get(part) if isinstance(node, Mapping) else None
    for value in (os.environ.get(env) if env else None, node):
        if value is None or value == "":
            continue
        try:
            return cast(value) if cast else value
        except (TypeError, ValueError):
            continue
    return default


def name_list(raw: str | None) -> list[str]:
    return [x.strip() for x in (raw or "").split(",") if x.strip()]


def domain_variable(domain: str, prefix: str = "MODEL_") -> str:
    return prefix + "".join(c if c.isalnum() else "_" for c in domain).upper()
