"""Canonical names of entities."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import strip

# Plural surface forms and the names they stand for.
PLURALS = {
    "widgets": "widget",
    "gadgets": "gadget",
    "sprockets": "sprocket",
    "accessories": "accessory",
    "industrial-parts": "industrial-part",
}


def canon_entity(name: Column, plurals: Mapping[str, str] = PLURALS) -> Column:
    """Lower case without outer blanks and dots, leading article or known plural."""
    bare = F.lower(F.regexp_replace(strip(name), r"^\.+|\.+$", ""))
    bare = F.regexp_replace(bare, r"(?U)^(the|a|an)\s+", "")
    if not plurals:
        return bare
    table = F.create_map(*[F.lit(x) for pair in plurals.items() for x in pair])
    return F.coalesce(table[bare], bare)
