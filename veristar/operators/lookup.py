"""Size-checked lookups: broadcast joins, and membership tests inside an expression.

A hash set in the expression lets a token array be thinned out within its row before
anything is exploded. It is used up to a bound only and never decides a result: beyond
the bound the join drops the same tokens. Numbers of known terms are looked up by
``rowterms``, in one way at every size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Row bound up to which a lookup side may be broadcast. Rows of the lookup
# tables are a token and a few numbers, so this stays far below 100 MB.
BROADCAST_ROWS = 200_000
# Up to this many tokens, a lookup is put into the expression itself.
IN_ROW_TOKENS = 20_000


def small(lookup: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast a lookup table, but only after checking its size.

    A table within the bound is fetched once, so several joins with it do not
    compute it again. Beyond the bound it is returned as it is: Spark then plans
    a shuffled join, which AQE splits where a token is hot.
    """
    rows = lookup.limit(max_rows + 1).toArrow()
    if rows.num_rows <= max_rows:
        return F.broadcast(lookup.sparkSession.createDataFrame(rows, lookup.schema))
    return lookup


def quoted(token: str) -> str:
    return "'" + token.replace("\\", "\\\\").replace("'", "\\'") + "'"


def one_of(tokens: list[str]) -> Callable[[str], str]:
    """SQL test "is this token one of them"; Spark turns the list into a hash set."""
    if not tokens:
        return lambda token: "false"
    listed = ", ".join(map(quoted, tokens))
    return lambda token: f"{token} in ({listed})"


def tokens_of(lookup: DataFrame, col: str, max_tokens: int = IN_ROW_TOKENS) -> list[str] | None:
    """The tokens of a lookup; ``None`` where it is larger than the bound."""
    rows = lookup.select(col).limit(max_tokens + 1).toArrow()
    if rows.num_rows > max_tokens:
        return None
    return [t for t in rows.column(0).to_pylist() if t is not None]


def token_test(lookup: DataFrame, col: str, max_tokens: int = IN_ROW_TOKENS) -> Callable[[str], str] | None:
    """``one_of`` for the tokens of a lookup; ``None`` where it is larger than the bound."""
    tokens = tokens_of(lookup, col, max_tokens)
    return None if tokens is None else one_of(tokens)
