"""Encoding E1-E6.

``fit_encoder`` runs ONE aggregation over the training rows (sorted level sets, means,
population standard deviations) and returns an ``EncoderModel``: plain literals.  The
model compiles to a single SQL projection, exposed as an MLlib ``SQLTransformer`` so it
can sit in a ``PipelineModel`` (saved / loaded with the classifier, S8) and stays inside
whole-stage codegen.  Output order: ordinal, one-hot, scaled (columns not named are
dropped from the feature vector).
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class MissingColumnsError(ValueError):
    pass


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _s(value: str) -> str:
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


@dataclass
class EncoderModel:
    ordinal: dict = field(default_factory=dict)   # column -> ordered levels
    onehot: dict = field(default_factory=dict)    # column -> kept levels (sorted, first dropped)
    scaler: dict = field(default_factory=dict)    # column -> (mean, scale)
    passthrough: tuple = ()                       # non-feature columns kept by transform

    # E5: output names
    def feature_names(self) -> list[str]:
        names = [f"ordinal__{c}" for c in self.ordinal]
        for c, levels in self.onehot.items():
            names += [f"onehot__{c}_{lv}" for lv in levels]
        names += [f"scaler__{c}" for c in self.scaler]
        return names

    def input_columns(self) -> list[str]:
        return list(self.ordinal) + list(self.onehot) + list(self.scaler)

    def expressions(self) -> list[tuple[str, str]]:
        out = []
        for c, levels in self.ordinal.items():
            cases = " ".join(f"WHEN {_s(lv)} THEN {i}" for i, lv in enumerate(levels))
            out.append((f"ordinal__{c}", f"CAST(CASE CAST({_q(c)} AS STRING) {cases} ELSE -1 END AS DOUBLE)"))
        for c, levels in self.onehot.items():
            for lv in levels:
                out.append((f"onehot__{c}_{lv}", f"CASE WHEN CAST({_q(c)} AS STRING) = {_s(lv)} THEN 1.0 ELSE 0.0 END"))
        for c, (mean, scale) in self.scaler.items():
            out.append((f"scaler__{c}", f"(CAST({_q(c)} AS DOUBLE) - ({mean!r})) / ({scale!r})"))
        return out

    def sql(self, keep: Sequence[str] | None = None) -> str:
        """``keep`` None keeps every input column (``*``), so scoring tables without the
        target (or with extra columns) pass through the same stage."""
        head = ["*"] if keep is None else [_q(k) for k in keep]
        cols = head + [f"{e} AS {_q(n)}" for n, e in self.expressions()]
        return "SELECT " + ", ".join(cols) + " FROM __THIS__"

    def check_columns(self, df: DataFrame) -> None:
        """Every fitted input column must be present; error names the missing ones."""
        missing = [c for c in self.input_columns() if c not in df.columns]
        if missing:
            raise MissingColumnsError(f"the input has no column {missing}")

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """E4 apply: one projection; ``keep`` carries key / label columns along."""
        self.check_columns(df)
        return df.selectExpr(*[_q(k) for k in keep], *[f"{e} AS {_q(n)}" for n, e in self.expressions()])

    def to_stages(self, keep: Sequence[str] | None = None, vector_col: str = "features") -> list:
        """MLlib stages: SQLTransformer (encoding) + VectorAssembler (feature vector)."""
        return [SQLTransformer(statement=self.sql(keep)),
                VectorAssembler(inputCols=self.feature_names(), outputCol=vector_col, handleInvalid="keep")]

    def to_pipeline_model(self, df: DataFrame, keep: Sequence[str] | None = None,
                          vector_col: str = "features") -> PipelineModel:
        return Pipeline(stages=self.to_stages(keep, vector_col)).fit(df.limit(0))

    def to_json(self) -> str:
        return json.dumps({"ordinal": self.ordinal, "onehot": self.onehot,
                           "scaler": {k: list(v) for k, v in self.scaler.items()}})

    @classmethod
    def from_json(cls, s: str) -> "EncoderModel":
        d = json.loads(s)
        return cls({k: tuple(v) for k, v in d["ordinal"].items()}, {k: tuple(v) for k, v in d["onehot"].items()},
                   {k: tuple(v) for k, v in d["scaler"].items()})


def fit_encoder(train: DataFrame, ordinal: Mapping[str, Sequence[str]], onehot: Sequence[str],
                scaled: Sequence[str], drop_first: bool = True, max_levels: int = 1000) -> EncoderModel:
    """E4 fit (E1 levels are given; E2 levels learned sorted, first dropped; E3 mean and
    population sd, zero sd -> 1).  Levels are found by a distributed distinct; a column of more than
    ``max_levels`` raises (every level becomes a column), nothing is cut off."""
    aggs = []
    for c in scaled:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"mu__{c}"), F.stddev_pop(x).alias(f"sd__{c}")]
    row = train.agg(*aggs).first() if aggs else None
    oh = {}
    for c in onehot:
        found = train.select(F.col(c).cast("string").alias("v")).where("v is not null").distinct().limit(max_levels + 1).collect()
        if len(found) > max_levels:
            raise ValueError(f"column {c!r} has more than {max_levels} levels")
        levels = sorted(r["v"] for r in found)
        oh[c] = tuple(levels[1:] if drop_first else levels)
    sc = {}
    for c in scaled:
        mu, sd = row[f"mu__{c}"], row[f"sd__{c}"]
        mu = 0.0 if mu is None else float(mu)
        sd = 1.0 if (sd is None or sd == 0.0) else float(sd)
        sc[c] = (mu, sd)
    return EncoderModel({c: tuple(v) for c, v in ordinal.items()}, oh, sc)


def align_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Select the training column set in training order; missing -> error."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumnsError(f"the input has no column {sorted(missing)}")
    return df.select(*columns)
