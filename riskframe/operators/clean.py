"""Cleaning operators C1-C12.

Fitting (medians, modes, IQR fences) is separated from applying: ``fit_profile``
returns a small ``Profile`` of literals (a bounded one-row summary), and the apply
functions are pure projections, so the main plan has no joins or cross joins.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType, StringType

from riskframe.functions.exprs import lookup, null_safe_clip
from riskframe.functions.ranking import exact_quantiles, modes, quantile_dict
from riskframe.spec import Roles


class ValidationError(ValueError):
    pass


# ---------------------------------------------------------------- C1-C4 ------
def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop id / constant columns if present."""
    present = [c for c in cols if c in df.columns]
    return df.drop(*present) if present else df


def map_target(df: DataFrame, target: str | None, mapping: Mapping[str, int]) -> DataFrame:
    """Raw target -> 0/1 (e.g. Yes -> 1, No -> 0); anything else -> null."""
    if not target or target not in df.columns or not mapping:
        return df
    return df.withColumn(target, lookup(F.col(target).cast("string"), dict(mapping)).cast("int"))


def cast_to_string(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Numeric code columns -> string labels ("2", not "2.0")."""
    out = {}
    for c in cols:
        if c not in df.columns:
            continue
        dtype = df.schema[c].dataType
        if isinstance(dtype, NumericType):
            out[c] = F.col(c).try_cast("long").cast("string")
        elif not isinstance(dtype, StringType):
            out[c] = F.col(c).cast("string")
    return df.withColumns(out) if out else df


def code_to_label(df: DataFrame, maps: Mapping[str, Mapping[int, str]]) -> DataFrame:
    """C4: integer code -> ordered label; unmapped or null -> null."""
    out = {c: lookup(F.col(c).try_cast("int"), dict(m)) for c, m in maps.items() if c in df.columns}
    return df.withColumns(out) if out else df


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in a float column is a missing value (a CSV scan reads "NaN" as one)."""
    out = {f.name: F.when(~F.isnan(f.name), F.col(f.name)) for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))}
    return df.withColumns(out) if out else df


def clean_raw(df: DataFrame, roles: Roles) -> DataFrame:
    """The raw-input cleaning shared by training and scoring (C1-C4).  The key is never dropped: dedup,
    split and scored rows need it, and no feature list holds it."""
    df = drop_columns(nan_to_null(df), [c for c in roles.drop if c != roles.key])
    df = map_target(df, roles.target, roles.target_map)
    df = cast_to_string(df, roles.as_string)
    return code_to_label(df, roles.code_labels)


# ---------------------------------------------------------------- C5 --------
def validation_report(df: DataFrame, roles: Roles) -> DataFrame:
    """C5 as data: one row per check (check, passed, detail).  Column checks are
    schema-only; emptiness is one ``isEmpty`` (a LIMIT 1 job)."""
    spark = df.sparkSession
    rows = [("non_empty", not df.isEmpty(), "")]
    if roles.target:
        rows.append(("target_present", roles.target in df.columns, roles.target))
    missing = [c for c in roles.required if c not in df.columns]
    rows.append(("required_present", not missing, ",".join(missing)))
    return spark.createDataFrame(rows, "check string, passed boolean, detail string")


def validate(df: DataFrame, roles: Roles) -> None:
    """Raise on empty table, absent target, missing required columns."""
    if roles.target and roles.target not in df.columns:
        raise ValidationError(f"no column {roles.target!r} to predict")
    missing = [c for c in roles.required if c not in df.columns]
    if missing:
        raise ValidationError(f"the table lacks {missing}")
    if df.isEmpty():
        raise ValidationError("the table has no rows")


# ---------------------------------------------------------------- C6 --------
def remove_duplicates(df: DataFrame, key: str | None = None, subset: Sequence[str] | None = None) -> DataFrame:
    """Exact duplicate rows (nulls equal) ignoring ``key``; the smallest key of
    each duplicate group is kept.  Hash aggregate with map-side combine, so a hot
    duplicate group shrinks to one row per task before the shuffle."""
    cols = list(subset) if subset else [c for c in df.columns if c != key]
    if key is None or key not in df.columns:
        return df.dropDuplicates(cols) if subset else df.distinct()
    kept = df.groupBy(*cols).agg(F.min(key).alias(key))
    return kept.select(*[c for c in df.columns if c in cols or c == key])


# ---------------------------------------------------------------- C7-C10 ----
@dataclass
class Profile:
    """Fitted cleaning state: literals only (bounded by the number of columns)."""
    medians: dict = field(default_factory=dict)
    modes: dict = field(default_factory=dict)
    fences: dict = field(default_factory=dict)  # column -> [lower, upper]

    def to_json(self) -> str:
        return json.dumps({"medians": self.medians, "modes": self.modes, "fences": self.fences})

    @classmethod
    def from_json(cls, s: str) -> "Profile":
        d = json.loads(s)
        return cls(d.get("medians", {}), d.get("modes", {}), {k: tuple(v) for k, v in d.get("fences", {}).items()})

    def save(self, spark: SparkSession, path: str) -> None:
        """Persist as a one-row Parquet table."""
        spark.createDataFrame([(self.to_json(),)], "profile string").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Profile":
        return cls.from_json(spark.read.parquet(path).first()["profile"])


def fit_impute(df: DataFrame, numerical: Sequence[str], categorical: Sequence[str]) -> Profile:
    """C7/C8 fit: exact medians (linear interpolation) and modes (ties -> smallest)."""
    num = [c for c in numerical if c in df.columns]
    cat = [c for c in categorical if c in df.columns]
    p = Profile()
    if num:
        q = quantile_dict(df, num, [0.5])
        p.medians = {c: q.get((c, 0.5)) for c in num}
    if cat:
        p.modes = {r["column"]: r["value"] for r in modes(df, cat).collect()}
    return p


def apply_impute(df: DataFrame, profile: Profile) -> DataFrame:
    """C7/C8 apply: coalesce with the fitted literals (numeric columns become double,
    as a pandas float fill would)."""
    out = {}
    for c, v in profile.medians.items():
        if c in df.columns and v is not None:
            out[c] = F.coalesce(F.col(c).cast("double"), F.lit(float(v)))
    for c, v in profile.modes.items():
        if c in df.columns and v is not None:
            out[c] = F.coalesce(F.col(c).cast("string"), F.lit(v))
    return df.withColumns(out) if out else df


def iqr_fences(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """q1, q3, iqr and fences q1 - k*iqr, q3 + k*iqr per column (exact quantiles)."""
    q = exact_quantiles(df, cols, [0.25, 0.75])
    w = q.groupBy("column").agg(
        F.max(F.when(F.col("prob") == 0.25, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("prob") == 0.75, F.col("value"))).alias("q3"),
    )
    iqr = F.col("q3") - F.col("q1")
    return w.select(
        "column", "q1", "q3", iqr.alias("iqr"),
        (F.col("q1") - F.lit(k) * iqr).alias("lower"), (F.col("q3") + F.lit(k) * iqr).alias("upper"),
    )


def fit_fences(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> dict:
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return {}
    return {r["column"]: (r["lower"], r["upper"]) for r in iqr_fences(df, cols, k).collect()}


def clip_outliers(df: DataFrame, fences: Mapping[str, tuple]) -> DataFrame:
    """Winsorise to the fences; nulls stay null."""
    out = {c: null_safe_clip(F.col(c).cast("double"), lo, hi)
           for c, (lo, hi) in fences.items() if c in df.columns and lo is not None and hi is not None}
    return df.withColumns(out) if out else df


# ---------------------------------------------------------------- C11 -------
def preprocess(df: DataFrame, roles: Roles, fit_on: DataFrame | None = None,
               profile: Profile | None = None) -> tuple[DataFrame, Profile]:
    """C11: clean (C1-C4) -> validate (C5) -> impute (C7/C8) -> dedup (C6) -> clip.

    Fences are fitted after imputation and dedup, as in the original order.  ``fit_on``
    (cleaned the same way) restricts fitting to e.g. the training part; by default the
    whole input is used (parity).  Passing ``profile`` skips fitting (scoring)."""
    cleaned = clean_raw(df, roles)
    validate(cleaned, roles)
    fit_src = clean_raw(fit_on, roles) if fit_on is not None else cleaned
    if profile is None:
        profile = fit_impute(fit_src, roles.numerical, roles.categorical)
    imputed = apply_impute(cleaned, profile)
    deduped = remove_duplicates(imputed, key=roles.key)
    if not profile.fences and roles.outlier:
        fence_src = deduped if fit_on is None else remove_duplicates(apply_impute(fit_src, profile), key=roles.key)
        profile.fences = fit_fences(fence_src, roles.outlier)
    return clip_outliers(deduped, profile.fences), profile
