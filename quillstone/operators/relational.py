"""Compositions that the models share."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DECIMAL = "decimal(38,18)"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The row of each key that comes last in ``order``; nulls count as earliest."""
    by = [(F.col(c) if isinstance(c, str) else c).desc_nulls_last() for c in order]
    return _first(df, keys, by)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    by = [(F.col(c) if isinstance(c, str) else c).asc_nulls_last() for c in order]
    return _first(df, keys, by)


def _first(df: DataFrame, keys, by) -> DataFrame:
    # the filter on row_number lets the planner keep one row per key before the shuffle
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*by))).where("_rn = 1").drop("_rn")


def scd2(df: DataFrame, key: str, sequence: str, recorded_at: str) -> DataFrame:
    """valid_from, valid_to and is_current of each version of a key."""
    w = Window.partitionBy(key).orderBy(sequence)
    after = F.lead(recorded_at).over(w)
    return df.withColumns({"version_number": F.row_number().over(w).cast("bigint"), "valid_from": F.col(recorded_at), "valid_to": after}).withColumn("is_current", F.col("valid_to").isNull())


def unpivot_layers(df: DataFrame, keys: Sequence[str], layers: Sequence[str]) -> DataFrame:
    """A row per key and layer from columns ``<layer>_dr`` and ``<layer>_cr``; layers that a key lacks are left out."""
    terms = ", ".join(f"'{x}', {x}_dr, {x}_cr" for x in layers)
    return df.selectExpr(*keys, f"stack({len(layers)}, {terms}) as (layer, dr_balance, cr_balance)").where("dr_balance is not null or cr_balance is not null")


def signed_balance(dr: str, cr: str, normal: str | Column) -> Column:
    """Debits less credits on a debit-normal account, else credits less debits."""
    dr, cr = F.col(dr), F.col(cr)
    return F.when((F.col(normal) if isinstance(normal, str) else normal) == "debit", dr - cr).otherwise(cr - dr).cast(DECIMAL)


def status(ledger: Column, warehouse: Column) -> Column:
    """How the two sides of a grain compare; ``ledger`` and ``warehouse`` say whether each has it.

    A figure that only the ledger holds is a failure unless it is zero on both sides: a
    layer that no entry touched.
    """
    dr, cr = F.col("ledger_dr_balance"), F.col("ledger_cr_balance")
    return (
        F.when(~ledger, "missing_in_ledger")
        .when(~warehouse & ((dr != 0) | (cr != 0)), "missing_in_warehouse")
        .when(~warehouse, "ok_untouched_layer")
        .when((dr != F.col("warehouse_dr_balance")) | (cr != F.col("warehouse_cr_balance")), "amount_mismatch")
        .otherwise("ok")
    )


def reconcile(persisted: DataFrame, computed: DataFrame, grain: Sequence[str]) -> DataFrame:
    """Both sides of each grain in a full outer join, with a status; the sides have dr_balance and cr_balance."""
    a = persisted.select(*grain, F.col("dr_balance").alias("ledger_dr_balance"), F.col("cr_balance").alias("ledger_cr_balance"), F.lit(True).alias("_a"))
    b = computed.select(*grain, F.col("dr_balance").alias("warehouse_dr_balance"), F.col("cr_balance").alias("warehouse_cr_balance"), F.lit(True).alias("_b"))
    return a.join(b, list(grain), "full_outer").withColumn("status", status(F.col("_a").isNotNull(), F.col("_b").isNotNull())).drop("_a", "_b")


def as_of(df: DataFrame, keys: Sequence[str], version: str, recorded_at: str, cutoff) -> DataFrame:
    """The latest version of each key that was recorded by ``cutoff``."""
    return latest_per_key(df.where(F.col(recorded_at) <= cutoff), keys, [version])


def merge_on_key(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``old`` with the rows of ``new`` in place of those of the same key; merging twice changes nothing."""
    return old.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new, allowMissingColumns=True)


def except_both_ways(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that only one side has, with the side; none means equal sets."""
    return a.subtract(b).withColumn("side", F.lit("left")).unionByName(b.subtract(a).withColumn("side", F.lit("right")))


# --- generic checks: each returns the failing rows ------------------------------


def not_unique(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def is_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def not_accepted(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values))


def orphans(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    keys = parent.select(F.col(parent_column).alias(column)).distinct()
    return df.where(F.col(column).isNotNull()).join(keys, column, "left_anti")


def negative(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) < 0)


def under(df: DataFrame, column: str, least) -> DataFrame:
    return df.where(F.col(column) < least)


def not_one_current(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count_if("is_current").alias("n_current")).where("n_current <> 1")


def sequence_gaps(df: DataFrame, entity: str = "id", sequence: str = "sequence") -> DataFrame:
    """Entities whose sequences are not 1..n."""
    each = df.groupBy(F.col(entity).alias("entity_id")).agg(F.min(sequence).alias("min_sequence"), F.max(sequence).alias("max_sequence"), F.count(F.lit(1)).alias("event_count"))
    return each.where("min_sequence <> 1 or max_sequence <> event_count")
