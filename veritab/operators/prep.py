"""M1-M5: exact fitted preprocessing (median / most-frequent imputation, standard scaling, one-hot).

``fit_prep`` counts values in executors and brings only scalars (medians, means,
stds, modes) and the per-column category lists (an error above a documented
number) to the driver; ``PrepModel.transform`` applies them as literal column
expressions (JVM-side, no UDF) and can emit a ``VectorUDT`` column for
``pyspark.ml``. Semantics: median = mean of the two middle values; mode ties
-> smallest value; population std with 0 -> 1; scaling is fitted on the
imputed column; unseen or NULL categories encode to all zeros.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veritab.operators.profile import NUMERIC, exact_quantiles, most_frequent


@dataclass
class PrepModel:
    numeric: list[str]
    categorical: list[str]
    medians: dict[str, float | None] = field(default_factory=dict)
    means: dict[str, float] = field(default_factory=dict)
    stds: dict[str, float] = field(default_factory=dict)
    modes: dict[str, str | None] = field(default_factory=dict)
    categories: dict[str, list[str]] = field(default_factory=dict)

    # -- M5: output feature names in order: numeric, then one-hot per column / category
    @property
    def feature_names(self) -> list[str]:
        return list(self.numeric) + [f"{c}_{v}" for c in self.categorical for v in self.categories[c]]

    def transform(self, df: DataFrame, keep: list[str] | None = None, vector_col: str | None = None) -> DataFrame:
        cols = [F.col(k) for k in (keep or [])]
        for c in self.numeric:
            x = F.coalesce(F.col(c).cast("double"), F.lit(self.medians[c]))
            std = self.stds[c] if self.stds[c] not in (None, 0.0) else 1.0
            cols.append(((x - F.lit(self.means[c])) / F.lit(std)).alias(c))
        for c in self.categorical:
            x = F.coalesce(F.col(c).cast("string"), F.lit(self.modes[c]))
            cols += [(x == F.lit(v)).cast("double").alias(f"{c}_{v}") for v in self.categories[c]]
        out = df.select(*cols)
        if vector_col:
            from pyspark.ml.feature import VectorAssembler

            out = VectorAssembler(inputCols=self.feature_names, outputCol=vector_col, handleInvalid="keep") \
                .transform(out)
        return out

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> "PrepModel":
        return PrepModel(**json.loads(text))


def split_by_dtype(df: DataFrame, exclude=()) -> tuple[list[str], list[str]]:
    """M5 column roles: numeric by dtype, everything string-like categorical; others dropped."""
    num = [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in exclude]
    cat = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BooleanType))
           and f.name not in exclude]
    if not num and not cat:
        raise ValueError("No usable feature columns")
    return num, cat


#: categories of all columns together that a one-hot model may have; more is an error, never a cut
MAX_CATEGORIES = 10_000


def fit_prep(df: DataFrame, numeric: list[str], categorical: list[str]) -> PrepModel:
    """Fit M1-M4: medians and modes from value counts, mean / population std of the imputed columns, category lists."""
    model = PrepModel(list(numeric), list(categorical))
    if numeric:
        medians = {r["column"]: r["value"] for r in exact_quantiles(df, numeric, (0.5,)).collect()}
        model.medians = {c: medians.get(c, 0.0) for c in numeric}
    if categorical:
        modes = {r["column"]: r["value"] for r in most_frequent(df, categorical).collect()}
        model.modes = {c: modes.get(c) for c in categorical}
    if numeric:
        imputed = [F.coalesce(F.col(c).cast("double"), F.lit(model.medians[c])) for c in numeric]
        row = df.agg(*[F.avg(x).alias(f"m{i}") for i, x in enumerate(imputed)],
                     *[F.stddev_pop(x).alias(f"s{i}") for i, x in enumerate(imputed)]).collect()[0]
        for i, c in enumerate(numeric):
            model.means[c] = row[f"m{i}"] or 0.0
            model.stds[c] = row[f"s{i}"] or 0.0
    if categorical:
        stacked = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("col"), F.coalesce(F.col(c).cast("string"), F.lit(model.modes[c])).alias("val"))
            for c in categorical])).alias("kv")).select("kv.col", "kv.val").where(F.col("val").isNotNull()).distinct()
        found = stacked.limit(MAX_CATEGORIES + 1).collect()
        if len(found) > MAX_CATEGORIES:
            raise ValueError(f"more than {MAX_CATEGORIES} categories in {categorical}: too many to one-hot encode")
        for r in found:
            model.categories.setdefault(r["col"], []).append(r["val"])
        for c in categorical:
            model.categories[c] = sorted(model.categories.get(c, []))
    return model


def long_features(df: DataFrame, model: PrepModel, id_col: str) -> DataFrame:
    """M4 long form ``(row id, feature, value)``: every numeric feature plus the non-zero one-hot entries."""
    t = model.transform(df, keep=[id_col])
    numeric = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in model.numeric]
    onehot = [F.when(F.col(f"{c}_{v}") != 0, F.struct(F.lit(f"{c}_{v}").alias("feature"),
                                                       F.col(f"{c}_{v}").alias("value")))
              for c in model.categorical for v in model.categories[c]]
    entries = F.filter(F.array(*(numeric + onehot)), lambda e: e.isNotNull())
    return t.select(id_col, F.explode(entries).alias("e")).select(id_col, "e.feature", "e.value")
