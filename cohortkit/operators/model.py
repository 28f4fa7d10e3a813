"""The cohort model as Spark ML stages that are saved and used again.

    model = Pipeline(stages=[FeaturePreparation(asOf="2002-01-01"), KMeansCohorts()]).fit(base)
    model.write().overwrite().save("s3a://bucket/cohort-model")
    PipelineModel.load("s3a://bucket/cohort-model").transform(new_clients)

Everything that a fit learns (medians, category levels, means and deviations,
centres) is a parameter of its model, so the pipeline's own writer and reader keep
it: a few numbers per feature, in the metadata of the stage. A scored row is
one projection; nothing is computed over the scored table.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import spec
from .cluster import fit_best_k
from .features import assemble, one_hot, prepare_features, scale, typed_features


def _param(owner, name: str, doc: str, converter=TypeConverters.identity) -> Param:
    return Param(owner, name, doc, typeConverter=converter)


class _Stage(DefaultParamsReadable, DefaultParamsWritable):
    """Keyword parameters as a stage takes them."""

    def setParams(self, **kw):
        return self._set(**kw)

    def _get(self, name: str):
        return self.getOrDefault(self.getParam(name))

    def _settings(self, *names: str) -> dict:
        return {n: self._get(n) for n in names}


class _FeatureParams(Params):
    asOf = _param(Params._dummy(), "asOf", "date that tenure counts to", TypeConverters.toString)
    numeric = _param(Params._dummy(), "numeric", "numeric feature columns", TypeConverters.toListString)
    categorical = _param(Params._dummy(), "categorical", "category columns", TypeConverters.toListString)
    numberStyle = _param(Params._dummy(), "numberStyle", "style of numbers in text columns", TypeConverters.toString)
    featuresCol = _param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(numeric=list(spec.FEATURES), categorical=list(spec.CATEGORICAL), numberStyle="br", featuresCol="features")


class FeaturePreparation(_FeatureParams, Estimator, _Stage):
    """Learns medians, category levels and scaling of a table of clients."""

    @keyword_only
    def __init__(self, *, asOf=None, numeric=None, categorical=None, numberStyle=None, featuresCol=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> FeaturePreparationModel:
        f = prepare_features(dataset, self._get("asOf"), numeric=self._get("numeric"), categorical=self._get("categorical"),
                             number_style=self._get("numberStyle"), vector=self._get("featuresCol"))
        learned = dict(medians=f.medians, levels=f.levels, scaling={c: list(v) for c, v in f.scaling.items()}, names=f.names)
        return self._copyValues(FeaturePreparationModel()._set(**learned))


class FeaturePreparationModel(_FeatureParams, Model, _Stage):
    """Fills, encodes and scales rows by what was learned. A column that the rows do not have counts as
    NULL, and a category that was not there to learn from as no category."""

    medians = _param(Params._dummy(), "medians", "{column: median}")
    levels = _param(Params._dummy(), "levels", "{column: sorted categories}")
    scaling = _param(Params._dummy(), "scaling", "{feature: [mean, deviation]}")
    names = _param(Params._dummy(), "names", "features in model order", TypeConverters.toListString)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        medians, levels, scaling, names = (self._get(n) for n in ("medians", "levels", "scaling", "names"))
        df = typed_features(dataset, self._get("asOf"), self._get("numeric"), self._get("numberStyle"))
        for c in [*medians, *levels]:
            if c not in df.columns:
                df = df.withColumn(c, F.lit(None).cast("double" if c in medians else "string"))
        df = df.select(*[F.coalesce(F.col(c), F.lit(medians[c])).alias(c) if c in medians else F.col(c) for c in df.columns])
        df, _ = one_hot(df, list(levels), levels=levels)
        df = scale(df, {c: scaling[c] for c in names}, "__z")
        scaled = [c + "__z" for c in names]
        return assemble(df, scaled, self._get("featuresCol")).drop(*scaled)


class _CohortParams(Params):
    featuresCol = _param(Params._dummy(), "featuresCol", "vector column", TypeConverters.toString)
    predictionCol = _param(Params._dummy(), "predictionCol", "cohort column made", TypeConverters.toString)

    def __init__(self):
        super().__init__()
        self._setDefault(featuresCol="features", predictionCol=spec.CLUSTER)


class CohortModel(_CohortParams, Model, _Stage):
    """The nearest of the learned centres, by squared Euclidean distance; the smaller label among equals."""

    labels = _param(Params._dummy(), "labels", "cohort labels in ascending order", TypeConverters.toListInt)
    centres = _param(Params._dummy(), "centres", "a list of coordinates per label")
    scores = _param(Params._dummy(), "scores", "what the fit tried: k, silhouette, cost")

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x = vector_to_array(self._get("featuresCol"))

        def far(centre: list[float]) -> Column:
            return F.aggregate(F.zip_with(x, F.lit(centre), lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda t, d: t + d)

        near = F.array_min(F.array(*[F.struct(far(c).alias("d"), F.lit(label).alias("c"))
                                     for label, c in zip(self._get("labels"), self._get("centres"))]))
        return dataset.withColumn(self._get("predictionCol"), near["c"])


class KMeansCohorts(_CohortParams, Estimator, _Stage):
    """K-means centres for the k of ``ks`` with the best silhouette."""

    keyCol = _param(Params._dummy(), "keyCol", "key column", TypeConverters.toString)
    ks = _param(Params._dummy(), "ks", "numbers of cohorts to try", TypeConverters.toListInt)
    seed = _param(Params._dummy(), "seed", "seed", TypeConverters.toInt)
    maxIter = _param(Params._dummy(), "maxIter", "Lloyd steps", TypeConverters.toInt)
    nStarts = _param(Params._dummy(), "nStarts", "starts per k", TypeConverters.toInt)
    silhouette = _param(Params._dummy(), "silhouette", "'squared' or 'euclidean'", TypeConverters.toString)
    points = _param(Params._dummy(), "points", "taken for stages saved before; the Euclidean one counts all rows", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featuresCol=None, predictionCol=None, keyCol=None, ks=None, seed=None, maxIter=None, nStarts=None,
                 silhouette=None, points=None):
        super().__init__()
        self._setDefault(keyCol=spec.KEY, ks=list(spec.K_GRID), seed=spec.SEED, maxIter=100, nStarts=1, silhouette="squared",
                         points=spec.SILHOUETTE_POINTS)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> CohortModel:
        best = fit_best_k(dataset, self._get("keyCol"), self._get("featuresCol"), self._get("ks"), self._get("seed"),
                          max_iter=self._get("maxIter"), n_starts=self._get("nStarts"), cluster_col=self._get("predictionCol"),
                          silhouette=self._get("silhouette"), points=self._get("points"))
        centres = [[float(v) for v in c] for c in best.centres]
        scores = [{n: s.get(n) for n in ("k", "silhouette", "cost", "skipped")} for s in best.scores]
        return self._copyValues(CohortModel()._set(labels=list(range(best.k)), centres=centres, scores=scores))


class GivenCohorts(_CohortParams, Estimator, _Stage):
    """Centres of cohorts that are given for the rows to learn from: the means of their vectors."""

    labelCol = _param(Params._dummy(), "labelCol", "given cohort, an integer; rows without one are left out", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol=None, predictionCol=None, labelCol=None):
        super().__init__()
        self._setDefault(labelCol=spec.CLUSTER)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> CohortModel:
        label = self._get("labelCol")
        rows = (dataset.where(F.col(label).isNotNull()).groupBy(label).agg(Summarizer.mean(F.col(self._get("featuresCol"))).alias("m"))
                .orderBy(label).collect())  # a row per cohort
        if not rows:
            raise ValueError("no row has a cohort")
        return self._copyValues(CohortModel()._set(labels=[int(r[label]) for r in rows], centres=[r["m"].tolist() for r in rows], scores=[]))
