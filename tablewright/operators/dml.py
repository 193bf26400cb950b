"""UPDATE / DELETE / INSERT REPLACE WHERE as DataFrame rewrites.
Each returns the new table; the caller writes it to a new location."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..util import qcol


def _cond(c) -> Column:
    return F.expr(c) if isinstance(c, str) else c


def update_where(df: DataFrame, cond, sets: dict) -> DataFrame:
    """``UPDATE t SET k = v ... WHERE cond``: rows where ``cond`` is true get
    the new values (a NULL condition leaves the row unchanged).  Values may
    be Columns (for expressions) or literals; types are kept."""
    c = F.coalesce(_cond(cond), F.lit(False))
    out = []
    for f in df.schema.fields:
        if f.name in sets:
            v = sets[f.name]
            if not isinstance(v, Column):
                v = F.lit(v)
            out.append(F.when(c, v.cast(f.dataType)).otherwise(qcol(f.name)).alias(f.name))
        else:
            out.append(qcol(f.name))
    unknown = set(sets) - set(df.columns)
    if unknown:
        raise ValueError(f"update_where: unknown columns {sorted(unknown)}")
    return df.select(*out)


def delete_where(df: DataFrame, cond) -> DataFrame:
    """``DELETE FROM t WHERE cond``: only rows where ``cond`` is true go; a
    NULL condition keeps the row."""
    return df.where(~F.coalesce(_cond(cond), F.lit(False)))


def replace_where(df: DataFrame, cond, rows: DataFrame) -> DataFrame:
    """``INSERT INTO t REPLACE WHERE cond SELECT ...``: delete the rows
    matching ``cond`` and add ``rows`` (by column name) in one step."""
    kept = delete_where(df, cond)
    return kept.unionByName(rows.select(*[qcol(f.name).cast(f.dataType).alias(f.name)
                                          for f in df.schema.fields]))
