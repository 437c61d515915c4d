"""Normalised column names."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence

# The naming rule itself.
_SEPARATORS = re.compile(r"[\s-]+", re.ASCII)
_UNWANTED = re.compile(r"[^a-z0-9_]")


def standard_name(name: str) -> str:
    """Lower-case; runs of blanks and hyphens become ``_``; anything else outside a-z 0-9 _ goes."""
    return _UNWANTED.sub("", _SEPARATORS.sub("_", name.lower()))


def standard_names(names: Sequence[str], on_collision: str = "error") -> list[str]:
    """Normalise all ``names``, keeping their order.

    Names that become empty are an error. Names that become equal are an error too, unless
    ``on_collision="suffix"``, which numbers the second and later ones (``a``, ``a_2``, ``a_3``).
    """
    if on_collision not in ("error", "suffix"):
        raise ValueError(f"on_collision must be 'error' or 'suffix', not {on_collision!r}")
    result = [standard_name(name) for name in names]
    empty = [name for name, new in zip(names, result) if not new]
    if empty:
        raise ValueError(f"Column names without any usable character: {empty}")
    clashing = {new for new, uses in Counter(result).items() if uses > 1}
    if not clashing:
        return result
    if on_collision == "error":
        clashes = {new: [n for n, r in zip(names, result) if r == new] for new in sorted(clashing)}
        raise ValueError(f"Column names become equal when normalised: {clashes}")
    taken = set(result)
    seen: set[str] = set()
    for i, new in enumerate(result):
        candidate, number = new, 1
        if new in seen:
            while candidate in taken:
                number += 1
                candidate = f"{new}_{number}"
            taken.add(candidate)
        seen.add(new)
        result[i] = candidate
    return result
