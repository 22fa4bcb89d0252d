"""Reading a JSON text column once."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parsed(text: Column, fields: str) -> Column:
    """A generator of one struct per row with the named `fields` of a JSON object; null if it is none.

    An array of several records is not one record, so its struct is null, too. A generator, because the optimizer moves filters below a projection and would parse the text
    once for the filter and again for the columns.
    """
    records = F.array(F.from_json(text, f"ARRAY<STRUCT<{fields}>>"))
    return F.explode_outer(F.transform(records, lambda found: F.when(F.size(found) == 1, found[0])))



def once(value: Column) -> Column:
    """A generator of exactly `value`, for the same reason."""
    return F.explode(F.array(value))
