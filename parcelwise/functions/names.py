"""Column names."""

from __future__ import annotations

import re
from collections import Counter


def snake_name(name: str) -> str:
    return "_".join(re.findall("[a-z0-9]+", name.lower()))


def snake_names(names: list[str]) -> list[str]:
    """Snake-case names, unique: Spark cannot address two columns of one name."""
    seen: Counter[str] = Counter()
    taken: set[str] = set()
    unique = []
    for position, name in enumerate(names):
        base = snake_name(name) or f"column_{position}"
        candidate = base
        while candidate in taken:
            seen[base] += 1
            candidate = f"{base}_{seen[base] + 1}"
        taken.add(candidate)
        unique.append(candidate)
    return unique
