"""Cohort models that are saved, read again and used on other rows."""

import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array

from cohortkit import spec
from cohortkit.operators.cluster import fit_best_k
from cohortkit.operators.features import prepare_features
from cohortkit.operators.model import FeaturePreparation, GivenCohorts, KMeansCohorts
from cohortkit.plans.cohort_run import driver_etl

SF = "/root/testdata/sf0.001"
AS_OF = "2002-01-01"


@pytest.fixture(scope="module")
def base(spark):
    from cohortkit.session import materialize
    return materialize(driver_etl(spark, SF).base, "test-base")


def vectors(df):
    return {r[0]: np.array(r[1]) for r in df.select(spec.KEY, vector_to_array("features")).collect()}


def test_features_are_those_of_the_fit(spark, base, tmp_path):
    model = FeaturePreparation(asOf=AS_OF).fit(base)
    model.write().save(str(tmp_path / "m"))
    again = type(model).load(str(tmp_path / "m"))
    want = vectors(prepare_features(base, AS_OF).frame)
    for m in (model, again):
        got = vectors(m.transform(base))
        assert got.keys() == want.keys() and all((got[k] == want[k]).all() for k in want)


def test_rows_with_other_columns_and_categories(spark, base):
    model = FeaturePreparation(asOf=AS_OF).fit(base)
    names = model.getOrDefault("names")
    row = spark.createDataFrame([(1, "NEW SEGMENT", "1.234,5")], "CD_CLIENTE long, DS_SEGMENTO string, MRR_12M string")
    got = vectors(model.transform(row))[1]
    scaling, medians = model.getOrDefault("scaling"), model.getOrDefault("medians")
    want = {c: medians.get(c, 0.0) for c in names} | {"MRR_12M": 1234.5}
    assert np.allclose(got, [(want[c] - scaling[c][0]) / scaling[c][1] if scaling[c][1] else 0.0 for c in names])


def test_kmeans_pipeline_saved_and_read(spark, base, tmp_path):
    path = str(tmp_path / "cohorts")
    pipeline = Pipeline(stages=[FeaturePreparation(asOf=AS_OF), KMeansCohorts(ks=[2, 3], silhouette="euclidean")])
    pipeline.write().save(str(tmp_path / "unfitted"))
    model = Pipeline.load(str(tmp_path / "unfitted")).fit(base)
    model.write().save(path)
    best = fit_best_k(prepare_features(base, AS_OF).frame, ks=[2, 3], silhouette="euclidean")
    want = {r[0]: r[1] for r in best.assignments.collect()}
    again = PipelineModel.load(path)
    for m in (model, again):
        assert {r[0]: r[1] for r in m.transform(base).select(spec.KEY, spec.CLUSTER).collect()} == want
    assert [s["k"] for s in again.stages[1].getOrDefault("scores")] == [2, 3]


def test_another_process_scores_with_it(spark, base, tmp_path):
    path, table, out = (str(tmp_path / n) for n in ("model", "base", "out"))
    base.write.parquet(table)
    labelled = base.selectExpr("*", "cast(CD_CLIENTE % 3 AS int) AS given")
    model = Pipeline(stages=[FeaturePreparation(asOf=AS_OF), GivenCohorts(labelCol="given")]).fit(labelled)
    model.write().save(path)
    code = ("from cohortkit.session import local_session\nfrom pyspark.ml import PipelineModel\ns = local_session(2)\n"
            f"PipelineModel.load({path!r}).transform(s.read.parquet({table!r})).select('CD_CLIENTE', 'cluster').write.parquet({out!r})\n")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=Path(__file__).resolve().parents[1], capture_output=True, timeout=300)
    want = sorted(map(tuple, model.transform(base).select(spec.KEY, spec.CLUSTER).collect()))
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == want and len({c for _, c in want}) > 1


def test_no_cohort_to_learn_from(spark, base):
    with pytest.raises(ValueError):
        Pipeline(stages=[FeaturePreparation(asOf=AS_OF), GivenCohorts(labelCol="given")]).fit(base.selectExpr("*", "cast(null AS int) AS given"))
