from types import SimpleNamespace

import pytest

from tierflow.session import build_session, measured, shared_dir


def fake(application="app-1", **conf):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default=None: conf.get(key, default)),
        sparkContext=SimpleNamespace(applicationId=application),
    )


def test_configured_folder_is_used():
    session = fake(**{"spark.checkpoint.dir": "hdfs://x/shared/", "spark.master": "yarn"})
    assert shared_dir(session) == "hdfs://x/shared"


def test_local_session_gets_one_folder_of_its_own():
    session = fake(**{"spark.master": "local[4]"})
    assert shared_dir(session) == shared_dir(session)
    assert shared_dir(session) != shared_dir(fake("app-2", **{"spark.master": "local[4]"}))


def test_cluster_without_shared_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(fake(**{"spark.master": "yarn"}))


def test_measured_keeps_rows_and_types(spark):
    df = spark.sql("select cast(1.5 as decimal(38,9)) d, timestamp'2024-01-01 00:00:00' t, 'x' s")
    got = measured(df)
    assert got.dtypes == df.dtypes and got.collect() == df.collect()


def test_session_defaults(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    assert build_session() is not None
