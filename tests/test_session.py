from pathlib import Path

from cohortkit.session import ensure_checkpoint_dir, materialize


def test_checkpoint_folder_from_session_and_materialize(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    path = ensure_checkpoint_dir(spark)
    if configured:
        assert path == configured  # a configured folder is used as is
    assert ensure_checkpoint_dir(spark) == path  # stable
    root = Path(path.removeprefix("file:"))
    before = set(root.glob("cohortkit-*/table-*"))
    df = materialize(spark.range(10).withColumnRenamed("id", "k"))
    assert df.count() == 10
    new = set(root.glob("cohortkit-*/table-*")) - before
    assert len(new) == 1 and any(next(iter(new)).glob("*.parquet"))
