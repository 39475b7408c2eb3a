"""Fitting rows to a table that may have been created by someone else."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evlake.schema import EVENTS


def schema_drift(table: T.StructType, written: T.StructType = EVENTS) -> dict[str, list[str]]:
    """Written columns the table lacks, and table columns never written."""
    have, write = set(table.fieldNames()), set(written.fieldNames())
    return {"missing": sorted(write - have), "extra": sorted(have - write)}


def conform(rows: DataFrame, table: T.StructType) -> DataFrame:
    """Rows in the table's columns: others dropped, absent ones null."""
    given = set(rows.columns)
    return rows.select(
        *[
            (F.col(f.name) if f.name in given else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in table.fields
        ]
    )


def drift_report(rows: DataFrame, table: T.StructType) -> DataFrame:
    """One row per differing column: ``missing`` with the number of values lost,
    ``extra`` with the number of rows that get a null. One pass over the rows."""
    drift = schema_drift(table, rows.schema)
    lost = [(c, "missing", F.count(F.col(c))) for c in drift["missing"]]
    nulls = [(c, "extra", F.count("*")) for c in drift["extra"]]
    found = lost + nulls
    if not found:
        empty = "column string, status string, affected bigint"
        return rows.sparkSession.createDataFrame([], empty)
    counted = rows.agg(*[n.alias(f"n{i}") for i, (_, _, n) in enumerate(found)])
    report = [
        F.struct(F.lit(c).alias("column"), F.lit(s).alias("status"), F.col(f"n{i}").alias("affected"))
        for i, (c, s, _) in enumerate(found)
    ]
    return counted.select(F.inline(F.array(*report)))
