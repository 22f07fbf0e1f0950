"""SNK-1 merge_upsert: insert-or-update by key, as one full outer join.

Source rows update only ``update_cols`` of matching target rows; the other
columns keep the target value; unmatched source rows are inserted; NULL
becomes 0 in numeric columns before the write (as the original did).  When
several source rows share a key the last one by ``order_col`` wins; on ties, or
without such a column, the largest row.  Merging a batch again changes nothing.  The
result is a new snapshot; writing it is the caller's choice (parquet table
under the shared folder, or ``DataFrame.mergeInto`` where the catalog
supports row-level operations).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str], update_cols: list[str],
                 order_col: str | None = None) -> DataFrame:
    rest = [c for c in source.columns if c not in keys and c != order_col]
    last = F.max(F.struct(*([order_col] if order_col else []), *rest)).alias("_last")  # partially aggregated, no window
    source = source.groupBy(*keys).agg(last).select(*keys, *[F.col(f"_last.{c}").alias(c) for c in rest])
    cols = [c for c in target.columns]
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in cols], F.lit(True).alias("_in_t"))
    s = source.select(*[F.col(c).alias(f"s_{c}") for c in cols if c in source.columns], F.lit(True).alias("_in_s"))
    cond = [F.col(f"t_{k}") == F.col(f"s_{k}") for k in keys]
    j = t.join(s, cond, "full_outer")
    out = []
    for c in cols:
        if c in keys:
            out.append(F.coalesce(F.col(f"t_{c}"), F.col(f"s_{c}")).alias(c))
        elif c in update_cols and c in source.columns:
            out.append(F.when(F.col("_in_s"), F.col(f"s_{c}")).otherwise(F.col(f"t_{c}")).alias(c))
        elif c in source.columns:
            out.append(F.when(F.col("_in_t"), F.col(f"t_{c}")).otherwise(F.col(f"s_{c}")).alias(c))
        else:
            out.append(F.col(f"t_{c}").alias(c))
    return zero_nulls(j.select(*out))


def zero_nulls(df: DataFrame) -> DataFrame:
    """NULL → 0 in numeric columns (the sink rule of the original)."""
    num = [f.name for f in df.schema.fields if f.dataType.typeName() in ("integer", "long", "double", "float", "short")]
    return df.fillna(0, subset=num)
