"""Preprocessing + boosted trees as one persistable Spark ML pipeline.

Preprocessing follows the reference's column roles:
numeric → median imputation; categorical → mode imputation then one-hot with
unseen values encoded as all zeros; boolean → one-hot with NULL as its own
category (no imputation).  Output order: numeric, categorical, boolean.

``ExactStatistics`` is the fitted transformer of the first step: exact medians
(``prep.column_quantiles``) and modes, saved with the pipeline.  The learner
(``boosting``) takes a category's number, not its one-hot vector.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.boosting import DEFAULTS as DEFAULT_PARAMS
from quarry.operators.boosting import BoostedTrees
from quarry.operators.prep import boolean_as_category, fit_medians, fit_modes
from quarry.spec import FeatureSpec, require_columns


class _Roles(Params):
    numericCols = Param(Params._dummy(), "numericCols", "numeric columns", TypeConverters.toListString)
    categoricalCols = Param(Params._dummy(), "categoricalCols", "categorical columns", TypeConverters.toListString)
    booleanCols = Param(Params._dummy(), "booleanCols", "boolean columns", TypeConverters.toListString)


class ExactStatistics(Estimator, _Roles, DefaultParamsReadable, DefaultParamsWritable):
    """Exact medians and modes of a table, for imputation."""

    @keyword_only
    def __init__(self, *, numericCols=None, categoricalCols=None, booleanCols=None):
        super().__init__()
        self._setDefault(numericCols=[], categoricalCols=[], booleanCols=[])
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "ExactStatisticsModel":
        numeric, categorical, boolean = (self.getOrDefault(x) for x in ("numericCols", "categoricalCols", "booleanCols"))
        medians = fit_medians(dataset, numeric) if numeric else {}
        modes = fit_modes(dataset, categorical) if categorical else {}
        return ExactStatisticsModel(numericCols=numeric, categoricalCols=categorical, booleanCols=boolean, statistics=json.dumps(
            {"medians": medians, "modes": {c: None if v is None else str(v) for c, v in modes.items()}}))


class ExactStatisticsModel(Model, _Roles, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``{c}__num`` (double, NULL and NaN become the median) and ``{c}__cat`` (text).

    A column without any value keeps its NULLs."""

    statistics = Param(Params._dummy(), "statistics", "medians and modes as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, numericCols=None, categoricalCols=None, booleanCols=None, statistics=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fitted = json.loads(self.getOrDefault("statistics"))
        out = {}
        for c in self.getOrDefault("numericCols"):
            x = F.col(c).cast("double")
            out[f"{c}__num"] = F.coalesce(F.when(~F.isnan(x), x), F.lit(fitted["medians"].get(c)).cast("double"))
        for c in self.getOrDefault("categoricalCols"):
            out[f"{c}__cat"] = F.coalesce(F.col(c).cast("string"), F.lit(fitted["modes"].get(c)).cast("string"))
        for c in self.getOrDefault("booleanCols"):
            out[f"{c}__cat"] = boolean_as_category(c)
        return dataset.withColumns(out) if out else dataset


@dataclass
class FittedModel:
    """A fitted ``PipelineModel`` plus the spec and parameters it was fit with."""

    pipeline: PipelineModel
    spec: FeatureSpec
    params: dict = field(default_factory=dict)

    def transform(self, df: DataFrame) -> DataFrame:
        require_columns(df, self.spec.features, "score")
        return self.pipeline.transform(df)

    def predict_proba(self, df: DataFrame, out: str = "score") -> DataFrame:
        """Input columns + positive-class probability."""
        t = self.transform(df)
        return t.select(*df.columns, F.col("probability").alias(out))

    def predict(self, df: DataFrame, threshold: float = 0.5, out: str = "prediction") -> DataFrame:
        p = self.predict_proba(df, "_p")
        return p.withColumn(out, (F.col("_p") >= F.lit(threshold)).cast("int")).drop("_p")

    def feature_importance(self) -> list[tuple[str, float]]:
        """(encoded feature name, importance) sorted by importance desc, name."""
        pairs = list(zip(self.encoded_names, map(float, self.pipeline.stages[-1].importances())))
        return sorted(pairs, key=lambda t: (-t[1], t[0]))

    @property
    def encoded_names(self) -> list[str]:
        return list(self.params.get("_encoded_names", []))

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(path)

    @classmethod
    def load(cls, path: str, spec: FeatureSpec) -> "FittedModel":
        pm = PipelineModel.load(path)
        m = cls(pm, spec, {**DEFAULT_PARAMS, **json.loads(pm.stages[-1].getOrDefault("settings"))})
        m.params["_encoded_names"] = _names_from_metadata(pm, spec)
        return m


def preprocessing_stages(spec: FeatureSpec, vector: bool = True):
    """Statistics and category numbers; with ``vector`` also the one-hot slots, assembled as ``features``."""
    stages = [ExactStatistics(numericCols=list(spec.numeric), categoricalCols=list(spec.categorical), booleanCols=list(spec.boolean))]
    num_out = [f"{c}__num" for c in spec.numeric]
    cat_in = [f"{c}__cat" for c in [*spec.categorical, *spec.boolean]]
    idx = [f"{c}__idx" for c in [*spec.categorical, *spec.boolean]]
    ohe = [f"{c}__ohe" for c in [*spec.categorical, *spec.boolean]]
    if cat_in:
        stages.append(StringIndexer(inputCols=cat_in, outputCols=idx, handleInvalid="keep",
                                    stringOrderType="alphabetAsc"))
    if not vector:
        return stages
    if cat_in:
        # The indexer maps unseen values to its extra last index; dropLast
        # removes exactly that slot, so an unseen value encodes as all zeros.
        # (handleInvalid must stay 'error' here: 'keep' would add a second
        # extra slot and dropLast would drop that one instead.)
        stages.append(OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True, handleInvalid="error"))
    stages.append(VectorAssembler(inputCols=num_out + ohe, outputCol="features", handleInvalid="error"))
    return stages


def _names_from_metadata(pm: PipelineModel, spec: FeatureSpec) -> list[str]:
    # StringIndexerModel labels give the one-hot slot names (dropLast keeps all labels)
    names = list(spec.numeric)
    for st in pm.stages:
        if st.__class__.__name__ == "StringIndexerModel":
            cols = [*spec.categorical, *spec.boolean]
            for c, labels in zip(cols, st.labelsArray):
                names += [f"{c}_{v}" for v in labels]
    return names


def feature_entries(pm: PipelineModel, spec: FeatureSpec, transformed: DataFrame, ids: list[str]) -> DataFrame:
    """Non-zero features as rows: ``ids, column_name, slot, position, value``.

    ``slot`` counts within a column, ``position`` over the assembled vector.
    Entries come from the imputed and indexed columns, so a row yields one
    entry per column at most, whatever the size of the vocabularies; a value
    that was unseen when fitting yields none."""
    entry = lambda c, slot, position, value: F.struct(
        F.lit(c).alias("column_name"), slot.cast("int").alias("slot"), position.cast("int").alias("position"), value.cast("double").alias("value"))
    entries = [entry(c, F.lit(0), F.lit(i), F.col(f"{c}__num")) for i, c in enumerate(spec.numeric)]
    at = len(spec.numeric)
    labels = next((st.labelsArray for st in pm.stages if st.__class__.__name__ == "StringIndexerModel"), [])
    for c, known in zip([*spec.categorical, *spec.boolean], labels):
        idx = F.col(f"{c}__idx")
        entries.append(entry(c, idx, F.lit(at) + idx, F.when(idx < len(known), F.lit(1.0))))
        at += len(known)
    return (transformed.select(*ids, F.explode(F.array(*entries)).alias("_e")).select(*ids, "_e.*")
            .where(F.col("value").isNotNull() & (F.col("value") != 0)))


def fit_model(train: DataFrame, spec: FeatureSpec, params: dict | None = None) -> FittedModel:
    """Fit preprocessing + boosted trees on ``train`` (label column ``spec.target``)."""
    require_columns(train, spec.training_columns[len(spec.metadata):], "fit")
    p = {**DEFAULT_PARAMS, **(params or {})}
    learner = BoostedTrees(numericCols=[f"{c}__num" for c in spec.numeric], codeCols=[f"{c}__idx" for c in [*spec.categorical, *spec.boolean]],
                           targetCol=spec.target, settings=json.dumps(p))
    pm = Pipeline(stages=[*preprocessing_stages(spec, vector=False), learner]).fit(train)
    m = FittedModel(pm, spec, p)
    m.params["_encoded_names"] = _names_from_metadata(pm, spec)
    return m


def importance_frame(model: FittedModel, spark, top_k: int | None = None) -> DataFrame:
    """(rank, feature, importance) in descending order, optional top-k."""
    pairs = model.feature_importance()
    if top_k is not None:
        pairs = pairs[:top_k]
    rows = [(i + 1, n, v) for i, (n, v) in enumerate(pairs)]
    return spark.createDataFrame(rows, "rank int, feature string, importance double")
