"""Q1-Q14: data-quality report, record constraints and schema alignment.

Column-set checks (Q1, Q2, Q11) read only ``df.columns``. The row checks
(Q3-Q7) are one aggregate pass; the referential check (Q8) is one anti join.
The report is a DataFrame ``(check_name, bad_rows, severity)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritab.functions.features import normalise_target


def require_columns(df: DataFrame, required, what: str = "columns") -> None:
    """Q1: raise listing the sorted missing names."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required {what}: {missing}")


def require_any(df: DataFrame, options, what: str = "columns") -> None:
    """Q2: at least one of ``options`` must be present."""
    if not set(options) & set(df.columns):
        raise ValueError(f"At least one of {sorted(options)} {what} is required")


def unmapped_targets(df: DataFrame, col: str) -> DataFrame:
    """(``col``, n_rows) of target texts that normalise to no class."""
    return df.where(normalise_target(col).isNull()).groupBy(F.col(col)).agg(F.count(F.lit(1)).alias("n_rows"))


def quality_report(df: DataFrame, key_cols=(), label_col: str | None = None, id_col: str | None = None,
                   time_col: str | None = None) -> DataFrame:
    """Q3-Q7 in one aggregate: rows, NULL keys, non-binary labels, duplicate ids, bad timestamps."""
    checks: list[tuple[str, Column, str]] = [("row_count", F.count(F.lit(1)), "info")]
    if key_cols:
        any_null = None
        for c in key_cols:
            any_null = F.col(c).isNull() if any_null is None else (any_null | F.col(c).isNull())
        checks.append(("null_keys", F.count_if(any_null), "error"))
    if label_col:
        ok = F.coalesce(F.col(label_col).try_cast("double").isin(0.0, 1.0), F.lit(False))
        checks.append(("non_binary_label", F.count_if(~ok), "error"))
    if id_col:
        checks.append(("duplicate_ids", F.count(id_col) - F.count_distinct(id_col), "warn"))
    if time_col:
        dtype = df.schema[time_col].dataType
        if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            bad = F.col(time_col).isNull()
        else:
            bad = F.try_to_timestamp(F.col(time_col).cast("string")).isNull()
        checks.append(("invalid_timestamp", F.count_if(bad), "error"))
    row = df.agg(*[expr.cast("long").alias(name) for name, expr, _ in checks])
    stack = ", ".join(f"'{name}', `{name}`, '{sev}'" for name, _, sev in checks)
    report = row.selectExpr(f"stack({len(checks)}, {stack}) AS (check_name, bad_rows, severity)")
    # an empty table is itself an error row (Q3)
    return report.withColumn("severity", F.when((F.col("check_name") == "row_count") & (F.col("bad_rows") == 0),
                                                F.lit("error")).otherwise(F.col("severity")))


def unknown_references(facts: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Q8: distinct keys in ``facts`` missing from ``dim`` (anti join), as a report row."""
    missing = facts.select(key).where(F.col(key).isNotNull()).join(dim.select(key), key, "left_anti")
    return missing.agg(F.count_distinct(key).cast("long").alias("bad_rows")) \
        .select(F.lit("unknown_" + key).alias("check_name"), "bad_rows", F.lit("warn").alias("severity"))


def transaction_rules() -> list[tuple[str, Column]]:
    """Q9 predicates; a NULL predicate counts as failed."""
    s = lambda c: F.length(F.col(c).cast("string"))
    rules = [
        ("transaction_id_nonempty", s("transaction_id") >= 1),
        ("user_id_positive", F.col("user_id") >= 1),
        ("amount_positive", F.col("transaction_amount") > 0),
        ("time_text", s("transaction_time") >= 4),
    ]
    rules += [(f"{c}_nonempty", s(c) >= 1) for c in ("location", "device", "merchant_category", "payment_channel")]
    rules += [(f"{c}_binary", F.col(c).between(0, 1)) for c in ("is_international", "card_present")]
    rules += [("previous_transactions_24h_nonneg", F.col("previous_transactions_24h") >= 0),
              ("avg_spend_7d_nonneg", F.col("avg_spend_7d") >= 0)]
    return rules


def validate_records(df: DataFrame, rules: list[tuple[str, Column]] | None = None) -> DataFrame:
    """Q9: add ``failed_rules`` (array of rule names, in rule order) and ``is_valid``. Works on streams."""
    rules = rules if rules is not None else transaction_rules()
    failed = F.array(*[F.when(F.coalesce(pred, F.lit(False)), F.lit(None).cast("string")).otherwise(F.lit(name))
                       for name, pred in rules])
    out = df.withColumn("failed_rules", F.filter(failed, lambda x: x.isNotNull()))
    return out.withColumn("is_valid", F.size("failed_rules") == 0)


def validate_requests(df: DataFrame, max_top_n: int = 50, default_top_n: int = 10, max_user: int = 10 ** 10,
                      user_col: str = "user_id", n_col: str = "top_n") -> DataFrame:
    """Q10: recommend-request constraints plus the service clamp ``max(1, min(top_n, max))``."""
    n = F.coalesce(F.col(n_col), F.lit(default_top_n)) if n_col in df.columns else F.lit(default_top_n)
    out = df.withColumn(n_col, n.cast("int"))
    valid = F.coalesce(F.col(user_col).between(1, max_user) & F.col(n_col).between(1, max_top_n), F.lit(False))
    return out.withColumn("is_valid", valid) \
        .withColumn("effective_top_n", F.greatest(F.lit(1), F.least(F.col(n_col), F.lit(max_top_n))))


def check_inference_schema(df: DataFrame, expected: list[str]) -> DataFrame:
    """Q11: missing expected features -> error (sorted); extra columns dropped."""
    missing = sorted(set(expected) - set(df.columns))
    if missing:
        raise ValueError(f"Missing required features: {missing}")
    return df.select(*expected)


def align_schema(df: DataFrame, schema: T.StructType | None) -> DataFrame:
    """Q12: add missing columns as typed NULLs, drop extras, reorder; no schema -> unchanged."""
    if schema is None:
        return df
    present = set(df.columns)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) if f.name in present
                       else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


# ---- fixed values: defaults for absent optional churn fields ----------------------------
CHURN_DEFAULTS = {
    "OnlineSecurity": "No",
    "OnlineBackup": "No",
    "DeviceProtection": "No",
    "StreamingTV": "No",
    "StreamingMovies": "No",
    "PaperlessBilling": "No",
    "SeniorCitizen": 0,
    "Partner": "No",
    "Dependents": "No",
}


def fill_absent(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Q14: add *absent* columns with their default; present NULLs are left alone."""
    defaults = CHURN_DEFAULTS if defaults is None else defaults
    add = {k: F.lit(v) for k, v in defaults.items() if k not in df.columns}
    return df.withColumns(add) if add else df
