"""Column names from header lines."""

from __future__ import annotations

from collections.abc import Sequence


def unique_names(names: Sequence[str]) -> list[str]:
    """Names for all columns: empty ones numbered, repeated ones suffixed."""
    filled = [name or f"Unnamed: {i}" for i, name in enumerate(names)]
    repeats = [filled[:i].count(name) for i, name in enumerate(filled)]
    return [f"{name}.{n}" if n else name for name, n in zip(filled, repeats)]
