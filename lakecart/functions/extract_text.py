"""Text form of a relational extract.

The raw CSV holds timestamps as the database's own CSV export writes them:
``yyyy-MM-dd HH:mm:ss[.ffffff]+00``, in UTC, with microseconds where there
are any.  Typed time columns (as JDBC or a mapped table delivers them) are
turned into that text before landing; columns that are text already pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakecart.schemas import spec

EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def time_text(c: Column, kind: T.DataType) -> Column:
    """Zoned text of a time column of the given type (an instant, a zone-less time, a day, or text)."""
    if isinstance(kind, T.StringType):
        return c
    if isinstance(kind, T.TimestampType):
        # From the instant, so the session's time zone plays no part.
        seconds = F.unix_micros(c).cast("decimal(20,0)") / F.lit(1_000_000).cast("decimal(8,0)")
        c = F.expr(EPOCH) + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))
    elif isinstance(kind, T.DateType):
        c = c.cast("timestamp_ntz")
    elif not isinstance(kind, T.TimestampNTZType):
        raise TypeError(f"not a time column: {kind.simpleString()}")
    # The cast writes a fraction only where there is one, without trailing zeros.
    return F.concat(c.cast("string"), F.lit("+00"))


def extract_text(source: DataFrame, table: str) -> DataFrame:
    """The columns of a source table, in its order, with every time column as text."""
    types = {f.name: f.dataType for f in source.schema.fields}
    return source.select(*[
        time_text(F.col(c), types[c]).alias(c) if kind in ("ts", "date") else F.col(c)
        for c, kind in spec(table).columns])
