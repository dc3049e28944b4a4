"""Rule matching of a stream of second- and third-source records against a fixed first source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.operators import records, rules


def stream_matches(first: DataFrame, arriving: DataFrame) -> DataFrame:
    """Matches (s1_id, cand_id) of each arriving record, by stream-static joins without state.

    first: the first source's records, normalized. arriving: raw entities, a stream or a table.
    """
    fixed_side, _ = rules.sides(first)
    _, rest = rules.sides(records.normalized(arriving))
    return rules.all_hits(fixed_side, rest).where(F.col("match")).select("s1_id", "cand_id")
