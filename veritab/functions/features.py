"""Feature columns as JVM-side expressions (no UDFs).

Semantics follow the S-table of the design notes: text that is not a number
becomes NULL (``try_cast``), division by zero becomes NULL (``try_divide``),
comparisons with NULL give flag 0, weekdays count from Monday = 0 and the
tenure bins are right-closed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ---- fixed values ----------------------------------------------------------------------
TENURE_BINS = [(-1, 6, "0_6"), (6, 12, "7_12"), (12, 24, "13_24"), (24, 48, "25_48")]  # (lo, hi] -> label
TENURE_TOP_LABEL = "49_plus"  # (48, inf)
SERVICE_COLUMNS = ["OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV",
                   "StreamingMovies"]
NIGHT_HOURS = [0, 1, 2, 3, 4, 23]
HIGH_VELOCITY_MIN = 8
FRAUD_NUMERIC_INPUTS = ["transaction_amount", "avg_spend_7d", "previous_transactions_24h", "is_international",
                        "card_present"]
CHURN_NUMERIC_INPUTS = ["TotalCharges", "MonthlyCharges", "tenure"]


def to_double(c: str | Column) -> Column:
    """Numeric coercion; text that is not a number (or blank) becomes NULL."""
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast("double")


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 with NULL -> 0 (S3)."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def ratio_plus_one(num: Column, den: Column) -> Column:
    """num / (den + 1.0); a zero denominator gives NULL instead of an error."""
    return F.try_divide(num, den + F.lit(1.0))


def tenure_group(tenure: Column) -> Column:
    """Right-closed bins (-1,6] (6,12] (12,24] (24,48] (48,inf); outside -> NULL."""
    expr = None
    for lo, hi, label in TENURE_BINS:
        cond = (tenure > lo) & (tenure <= hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.when(tenure > 48, F.lit(TENURE_TOP_LABEL)).otherwise(F.lit(None).cast("string"))


def churn_features(df: DataFrame) -> DataFrame:
    """Each derived column only when its inputs are present (plan-time branch on the schema)."""
    names = set(df.columns)
    out = df.withColumns({c: to_double(c) for c in CHURN_NUMERIC_INPUTS if c in names})
    new = {}
    if {"TotalCharges", "tenure"} <= names:
        new["avg_monthly_spend"] = ratio_plus_one(F.col("TotalCharges"), F.col("tenure"))
    if "tenure" in names:
        new["tenure_group"] = tenure_group(F.col("tenure"))
    if "Contract" in names:
        new["is_month_to_month"] = flag(F.col("Contract") == "Month-to-month")
    services = [c for c in SERVICE_COLUMNS if c in names]
    if services:
        # 'Yes' -> 1, anything else (No, No internet service, NULL, other text) -> 0
        new["active_services_count"] = sum((flag(F.col(c) == "Yes") for c in services), F.lit(0))
    return out.withColumns(new) if new else out


def normalise_target(c: str | Column, strict: bool = False) -> Column:
    """Trim + lower; yes/1 -> 1, no/0 -> 0; anything else fails the job if ``strict``, else is NULL (counted by
    ``quality.unmapped_targets`` and the label check, and never learned from)."""
    text = (F.col(c) if isinstance(c, str) else c).cast("string")
    col = F.lower(F.trim(text))
    other = F.raise_error(F.concat(F.lit("Target of no class: "), F.coalesce(text, F.lit("NULL")))) if strict else F.lit(None)
    return F.when(col.isin("yes", "1"), F.lit(1)).when(col.isin("no", "0"), F.lit(0)).otherwise(other.cast("int"))


def to_timestamp_or_null(c: str | Column, dtype: T.DataType | None = None) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return col
    if isinstance(dtype, T.DateType):
        return col.cast("timestamp_ntz")
    return F.try_to_timestamp(col.cast("string"))


def fraud_features(df: DataFrame, drop_cols: tuple[str, ...] = ("transaction_id", "transaction_time"),
                   time_col: str = "transaction_time") -> DataFrame:
    """Coercion, hour / weekday (Monday = 0), ratio and flags; id and time dropped after use."""
    names = set(df.columns)
    out = df.withColumns({c: to_double(c) for c in FRAUD_NUMERIC_INPUTS if c in names})
    ts = to_timestamp_or_null(time_col, df.schema[time_col].dataType)
    out = out.withColumns({
        "transaction_hour": F.hour(ts),
        "transaction_dayofweek": F.weekday(ts),
    })
    out = out.withColumns({
        "amount_to_avg_ratio": ratio_plus_one(F.col("transaction_amount"), F.col("avg_spend_7d")),
        "high_velocity_flag": flag(F.col("previous_transactions_24h") >= HIGH_VELOCITY_MIN),
        "night_transaction": flag(F.col("transaction_hour").isin(*NIGHT_HOURS)),
        "intl_card_absent": flag((F.col("is_international") == 1) & (F.col("card_present") == 0)),
    })
    return out.drop(*[c for c in drop_cols if c in names])


def decode_label(prob: Column, positive: str = "Yes", negative: str = "No", threshold: float | Column = 0.5) -> Column:
    """Probability -> text label."""
    thr = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return F.when(prob >= thr, F.lit(positive)).otherwise(F.lit(negative))


def minmax_score(df: DataFrame, score_col: str, out_col: str = "score_01") -> DataFrame:
    """(s - min) / (max - min) with a constant column -> 0.5; min/max are scalar subqueries."""
    stats = df.agg(F.min(score_col).alias("mn"), F.max(score_col).alias("mx"))
    mn = stats.select("mn").scalar()
    mx = stats.select("mx").scalar()
    rng = mx - mn
    return df.withColumn(out_col, F.when(rng == 0, F.lit(0.5)).otherwise((F.col(score_col) - mn) / rng))
