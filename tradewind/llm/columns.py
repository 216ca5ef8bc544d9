"""Names for helper columns beside the columns of a caller."""

from __future__ import annotations

from collections.abc import Sequence


def unused(columns: Sequence[str], name: str) -> str:
    """``name``, with as many underscores behind it as it takes to be none of ``columns``, in whatever case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
