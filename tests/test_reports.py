from cohortkit.operators.reports import (box_stats, cluster_sizes, personas, segment_mix,
                                         top_features)


def test_box_stats(spark):
    df = spark.createDataFrame([(i, 0, v) for i, v in enumerate([1.0, 2.0, 3.0, 4.0, 100.0])] + [(9, 1, None)],
                               "CD_CLIENTE long, cluster int, MRR_12M double")
    r = box_stats(df).collect()
    assert len(r) == 1
    r = r[0]
    assert (r.q1, r.median, r.q3, r.whisker_low, r.whisker_high, r.n) == (2.0, 3.0, 4.0, 1.0, 4.0, 5)


def test_personas_levels(spark):
    base = spark.createDataFrame(
        [(1, 10.0, 1.0, 5.0), (2, 20.0, None, 5.0), (3, 30.0, 3.0, 5.0), (4, 40.0, 4.0, 5.0)],
        "CD_CLIENTE long, MRR_12M double, NPS_MEDIO double, QTD_CONTRATACOES_12M double")
    clusters = spark.createDataFrame([(1, 0), (2, 1), (3, 2)], "CD_CLIENTE long, cluster int")
    got = {r.CD_CLIENTE: r.cluster_label for r in personas(base, clusters).collect()}
    assert got[1] == "Receita Baixo, Satisfação Baixo, Aquisição Baixo"
    assert got[2] == "Receita Médio, Satisfação Médio, Aquisição Baixo"
    assert got[3] == "Receita Alto, Satisfação Alto, Aquisição Baixo"
    assert got[4] is None  # no cluster, no label


def test_sizes_mix_and_top_features(spark):
    df = spark.createDataFrame([(1, 0, "A"), (2, 0, "B"), (3, 0, "A"), (4, 1, "B"), (5, None, "A")],
                               "CD_CLIENTE long, cluster int, DS_SEGMENTO string")
    assert [tuple(r) for r in cluster_sizes(df).collect()] == [(0, 3), (1, 1)]
    mix = {(r.cluster, r.DS_SEGMENTO): r.share for r in segment_mix(df).collect()}
    assert abs(mix[(0, "A")] - 2 / 3) < 1e-12 and mix[(1, "B")] == 1.0
    wide = {r.cluster: (r.A, r.B) for r in segment_mix(df, wide=True).collect()}
    assert wide[1] == (0.0, 1.0)
    prof = spark.createDataFrame([(0, 1.0, 10.0, 5.0), (1, 2.0, 30.0, 5.0)], "cluster int, a double, b double, c double")
    assert [r.feature for r in top_features(prof, ["a", "b", "c"], n=2).collect()] == ["b", "a"]


def test_run_reports_recomputes_profile_when_missing(spark):
    from cohortkit.plans.cohort_run import driver_etl, run_reports
    from cohortkit.operators.recommend import popularity
    from cohortkit.sources import tables as T
    sf = "/root/testdata/sf0.001"
    base = driver_etl(spark, sf).base
    clusters = T.region_cohorts(spark, sf)
    ranking = popularity(clusters, T.ownership_rows(spark, sf))
    out = run_reports(base, clusters, ranking, profile=None)
    feats = {r.feature for r in out["top_features"].collect()}
    # numeric columns of the base only: text, date and key columns are not features
    assert feats <= {"VL_TOTAL_CONTRATO", "MRR_12M", "QTD_CONTRATACOES_12M",
                     "VLR_CONTRATACOES_12M", "NPS_MEDIO"} and len(feats) == 5
    assert out["cluster_sizes"].count() == 5
    assert {r.cluster for r in out["personas"].collect()} == {0, 1, 2, 3, 4}


def test_whiskers_end_at_the_box(spark):
    from cohortkit.operators.reports import box_stats
    df = spark.createDataFrame([(0, float(v)) for v in (0, 10, 10, 10)], "cluster int, MRR_12M double")
    r = box_stats(df, "MRR_12M").first()
    assert (r.q1, r.whisker_low, r.whisker_high) == (7.5, 7.5, 10.0)
