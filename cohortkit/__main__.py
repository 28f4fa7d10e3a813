"""Command line: the three stages as Spark jobs.

    python -m cohortkit etl RAW_ROOT OUT_ROOT
        every extract under RAW_ROOT -> cleaned tables + analytic base under OUT_ROOT
    python -m cohortkit cohorts BASE_PATH CLIENTS_PATH OUT_ROOT --as-of 2002-01-01
        analytic base + cleaned clients table -> clusters, recommendations, reports
    python -m cohortkit driver SF_DIR OUT_ROOT
        the same end to end from the driver parquet tables

Paths may be local, HDFS or s3a://. With --master unset the session comes
from the environment (spark-submit / cluster defaults).
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from . import spec


def _session(master: str | None) -> SparkSession:
    if master:
        from .session import local_session
        return local_session(master.removeprefix("local[").removesuffix("]") or "*")
    from .session import ensure_checkpoint_dir
    spark = SparkSession.builder.appName("cohortkit").getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="cohortkit")
    p.add_argument("--master", help="e.g. local[8]; default: the environment's")
    sub = p.add_subparsers(dest="cmd", required=True)
    e = sub.add_parser("etl")
    e.add_argument("raw_root")
    e.add_argument("out_root")
    e.add_argument("--file-order", action="store_true", help="keep the first row of a client as the extracts have them")
    c = sub.add_parser("cohorts")
    c.add_argument("base_path")
    c.add_argument("clients_path")
    c.add_argument("out_root")
    c.add_argument("--tables", help="folder of vendas_tratado and nps_tratado: builds BASE_PATH where it is absent or they have changed")
    d = sub.add_parser("driver")
    d.add_argument("sf_dir")
    d.add_argument("out_root")
    for q in (c, d):
        q.add_argument("--as-of", required=q is c, default=None)
        q.add_argument("--ks", default=",".join(map(str, spec.K_GRID)))
        q.add_argument("--seed", type=int, default=spec.SEED)
    a = p.parse_args(argv)
    spark = _session(a.master)

    if a.cmd == "etl":
        from .plans.jobs import run_etl
        out = run_etl(spark, a.raw_root, a.out_root, file_order=a.file_order)
    elif a.cmd == "driver":
        from .plans.cohort_run import run_all
        from .sources.tables import AS_OF
        out = run_all(spark, a.sf_dir, a.out_root, as_of=a.as_of or AS_OF,
                      ks=tuple(int(k) for k in a.ks.split(",")), seed=a.seed)
    else:
        from .plans.cohort_run import run_clustering, run_reports, stored_profile, write_cohorts
        from .plans.jobs import analytic_base, load_or_build
        from .sources.sinks import write_table
        clients = spark.read.parquet(a.clients_path)

        def build():
            side = lambda name: spark.read.parquet(f"{a.tables.rstrip('/')}/{name}")
            return analytic_base(clients, side("vendas_tratado"), side("nps_tratado"))

        made_from = [a.clients_path, *(f"{(a.tables or '').rstrip('/')}/{name}" for name in ("vendas_tratado", "nps_tratado"))]
        base = load_or_build(spark, a.base_path, build, inputs=made_from) if a.tables else spark.read.parquet(a.base_path)
        run = run_clustering(base, clients, a.as_of, ks=tuple(int(k) for k in a.ks.split(",")),
                             seed=a.seed)
        root = a.out_root.rstrip("/")
        out = write_cohorts(run, root)
        profile = stored_profile(spark, out["metricas_medias"])
        for name, df in run_reports(base, run.clusters, run.ranking, profile).items():
            out[name] = write_table(df, f"{root}/reports/{name}")
    print(json.dumps(out, indent=2))


if __name__ == "__main__":
    main()
