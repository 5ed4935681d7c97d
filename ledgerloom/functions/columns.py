"""Hash buckets, strict extremes, padded ids and exact whole-number rounding."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.config import sql_literal as _sql_literal


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def bucket_sql(keys: list[str], salt: str, n: int) -> str:
    """SQL text of a stable draw in ``[0, n)`` from key expressions and a salt.

    The first 32 bits of an MD5, so any SQL engine can repeat it.
    """
    parts = ", ".join(f"CAST({k} AS STRING)" for k in keys)
    return f"CAST(conv(substring(md5(concat_ws('|', {parts}, '{salt}')), 1, 8), 16, 10) AS BIGINT) % {n}"


def bucket(keys: list[str], salt: str, n: int) -> Column:
    return F.expr(bucket_sql(keys, salt, n))


def nth(items: list[str], index_sql: str) -> Column:
    """The item at a 0-based position given as SQL text."""
    body = ", ".join(_sql_literal(i) for i in items)
    return F.expr(f"get(array({body}), CAST({index_sql} AS INT))")


def moment(at: datetime.datetime) -> Column:
    """A fixed time without zone, free of the driver's and the session's time zones."""
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def strict_greatest(*cols) -> Column:
    """Greatest value, or NULL as soon as one argument is NULL."""
    cols = [_col(c) for c in cols]
    return F.when(_any_null(cols), F.lit(None)).otherwise(F.greatest(*cols))


def strict_least(*cols) -> Column:
    """Least value, or NULL as soon as one argument is NULL."""
    cols = [_col(c) for c in cols]
    return F.when(_any_null(cols), F.lit(None)).otherwise(F.least(*cols))


def _any_null(cols: list[Column]) -> Column:
    out = cols[0].isNull()
    for c in cols[1:]:
        out = out | c.isNull()
    return out


def padded_id(prefix: str, number, width: int) -> Column:
    """``prefix`` + zero-padded number; a number wider than ``width`` is kept whole."""
    digits = _col(number).cast("string")
    return F.concat(
        F.lit(prefix),
        F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0")),
    )


def whole_ratio(numerator: Column, denominator: int) -> Column:
    """``numerator / denominator`` to the nearest whole number, halves away from zero.

    The numerator is an exact whole number, so a true half is hit exactly.
    """
    return F.round(numerator.cast("double") / F.lit(float(denominator))).cast("bigint")


def none_if_missing(text) -> Column:
    """The extractor writes the word ``None`` for an absent field; turn it into NULL."""
    return F.nullif(_col(text), F.lit("None"))


def pick(cases: list[tuple[Column, object]], otherwise=None) -> Column:
    """Ordered CASE: the first true condition wins."""
    chain = F.when(*cases[0])
    for condition, value in cases[1:]:
        chain = chain.when(condition, value)
    return chain.otherwise(otherwise)


def lookup(key_sql: str, table: dict, otherwise=None) -> Column:
    """Small constant mapping of a key expression, as a simple CASE."""
    whens = " ".join(f"WHEN {_sql_literal(k)} THEN {_sql_literal(v)}" for k, v in table.items())
    return F.expr(f"CASE {key_sql} {whens} ELSE {_sql_literal(otherwise)} END")
