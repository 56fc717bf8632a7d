"""Key repair and presence tests shared by operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How a missing text is written.
MISSING_TEXT = r"(?iU)^[\s\p{Pd}.]*$|^\s*(?:n/?a|none|null|nan|no title|no abstract(?: available[^.]*)?)[\s.]*$"
# The office order of the project, best first.
OFFICES = "US EP WO GB AU CA NZ IE".split()


def plain_family(c: Column) -> Column:
    """A family id without padding: outer blanks, leading zeros and a decimal part; null if blank."""
    text = F.regexp_replace(c, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")
    text = F.when(text.rlike(r"^[0-9]+(?:\.0*)?$"), F.regexp_replace(text, r"^0+(?=[0-9])|\.0*$", "")).otherwise(text)
    return F.nullif(text, F.lit(""))


def is_missing(c: Column) -> Column:
    """Whether a text is null, blank or says that there is none."""
    return c.isNull() | c.rlike(MISSING_TEXT)


def office_rank(c: Column) -> Column:
    """Position in the office order from 0; all others and nulls share the last."""
    rank = F.lit(len(OFFICES))
    for i, office in reversed(list(enumerate(OFFICES))):
        rank = F.when(c == office, i).otherwise(rank)
    return rank


