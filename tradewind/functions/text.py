"""Text clean-up."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column, functions as F


@lru_cache(maxsize=1)
def _accent_table() -> tuple[str, str]:
    """Characters that NFKD turns into one base character, then the marks that it drops.

    Built from the Unicode tables over the basic plane. Characters that decompose into several base
    characters (ligatures, fractions) stay as they are.
    """
    source, target, marks = [], [], []
    for code in range(0x80, 0x10000):
        if 0xD800 <= code <= 0xDFFF:
            continue
        char = chr(code)
        if unicodedata.combining(char):
            marks.append(char)
            continue
        base = [c for c in unicodedata.normalize("NFKD", char) if not unicodedata.combining(c)]
        if len(base) == 1 and base[0] != char:
            source.append(char)
            target.append(base[0])
    return "".join(source + marks), "".join(target)


def strip_accents(value: Column) -> Column:
    """Drop accents inside the JVM: one ``translate`` (marks beyond the targets are deleted)."""
    return F.translate(value, *_accent_table())


def replace_if_contains(value: Column, rules: dict[str, str]) -> Column:
    """Apply ``rules`` in order: a value holding the key as a substring becomes the rule's value."""
    for part, whole in rules.items():
        value = F.when(value.contains(part), F.lit(whole)).otherwise(value)
    return value


def map_values(value: Column, mapping: dict[str, str]) -> Column:
    result = value
    for old, new in mapping.items():
        result = F.when(value == old, F.lit(new)).otherwise(result)
    return result
