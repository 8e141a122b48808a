"""The shared folder on clusters, with and without the setting."""

import os
import subprocess
import sys

import pyspark
import pytest

from windward import session

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
JOB = """
import sys
from windward.session import build_session, shared_dir, stage
spark = build_session("cluster", "local-cluster[2,1,1024]", 4, dict(x.split("=", 1) for x in sys.argv[1:]))
print("rows", stage(spark.range(0, 1000, 1, 8), "numbers").where("id >= 0").count(), shared_dir(spark))
spark.stop()
"""


@pytest.mark.parametrize("named", [False, True])
def test_cluster_stages_with_and_without_the_setting(tmp_path, named):
    conf = {"spark.sql.warehouse.dir": f"file://{tmp_path}/tables", "spark.driver.host": "127.0.0.1", "spark.executor.memory": "1g"}
    if named:
        conf["spark.checkpoint.dir"] = f"file://{tmp_path}/kept"
    out = subprocess.run([sys.executable, "-c", JOB, *[f"{k}={v}" for k, v in conf.items()]], cwd=tmp_path, capture_output=True, text=True,
                         timeout=300, env=os.environ | {"PYTHONPATH": ROOT, "SPARK_CONF_DIR": str(tmp_path)})
    told = next((line for line in out.stdout.splitlines() if line.startswith("rows ")), out.stderr[-2000:])
    assert told.replace("file:///", "file:/") == f"rows 1000 file:{tmp_path}/" + ("kept" if named else "tables/windward-staged")


class _Cluster:
    """A session that says it runs on a cluster."""

    def __init__(self, spark, name, **conf):
        self.inner = spark
        self.sparkContext = type("C", (), {"master": "spark://there:7077", "applicationId": name, "getCheckpointDir": lambda _: None,
                                           "defaultParallelism": spark.sparkContext.defaultParallelism})()
        self.conf = type("F", (), {"get": lambda _, key, other=None: conf.get(key, other)})()

    def __getattr__(self, name):
        return getattr(self.inner, name)


@pytest.mark.parametrize("scheme", ["", "file://"])
def test_a_mounted_folder_serves_a_cluster(spark, tmp_path, scheme):
    path = f"{scheme}{tmp_path}/mounted"
    cluster = _Cluster(spark, f"mounted {scheme}", **{"spark.checkpoint.dir": path, "spark.sql.warehouse.dir": f"file://{tmp_path}/tables"})
    assert session.shared_dir(cluster) == path
    assert os.listdir(tmp_path / "mounted") == []  # the trial is gone


def test_a_folder_that_loses_rows_is_not_used(spark, tmp_path, monkeypatch):
    conf = {"spark.checkpoint.dir": f"{tmp_path}/own", "spark.sql.warehouse.dir": f"{tmp_path}/tables"}
    monkeypatch.setattr(session, "_lost_rows", lambda _, path: 3 if path.endswith("own") else 0)
    assert session.shared_dir(_Cluster(spark, "one lost", **conf)) == f"{tmp_path}/tables/windward-staged"
    monkeypatch.setattr(session, "_lost_rows", lambda *_: 3)
    with pytest.raises(ValueError, match="all executors share"):
        session.shared_dir(_Cluster(spark, "both lost", **conf))


def test_a_folder_the_executors_cannot_write_is_not_used(spark, tmp_path):
    conf = {"spark.checkpoint.dir": "/proc/none/kept", "spark.sql.warehouse.dir": f"{tmp_path}/tables"}
    assert session.shared_dir(_Cluster(spark, "one closed", **conf)) == f"{tmp_path}/tables/windward-staged"
    assert os.listdir(tmp_path / "tables/windward-staged") == []
    with pytest.raises(ValueError, match="cannot write there"):
        session.shared_dir(_Cluster(spark, "both closed", **conf | {"spark.sql.warehouse.dir": "/proc/none/tables"}))


def test_executors_of_their_own_pass_over_a_folder_that_each_has_for_itself(tmp_path):
    (tmp_path / "home").mkdir()
    for part in os.listdir(os.path.dirname(pyspark.__file__)):
        if part != "work":  # executors work in Spark's home
            (tmp_path / "home" / part).symlink_to(os.path.join(os.path.dirname(pyspark.__file__), part))
    conf = {"spark.sql.warehouse.dir": f"file://{tmp_path}/tables", "spark.driver.host": "127.0.0.1", "spark.executor.memory": "1g",
            "spark.checkpoint.dir": "/proc/self/cwd/kept"}
    out = subprocess.run([sys.executable, "-c", JOB, *[f"{k}={v}" for k, v in conf.items()]], cwd=tmp_path, capture_output=True, text=True, timeout=300,
                         env=os.environ | {"PYTHONPATH": ROOT, "SPARK_CONF_DIR": str(tmp_path), "SPARK_HOME": str(tmp_path / "home"), "SPARK_SCALA_VERSION": "2.13"})
    told = next((line for line in out.stdout.splitlines() if line.startswith("rows ")), out.stderr[-2000:])
    assert told.replace("file:///", "file:/") == f"rows 1000 file:{tmp_path}/tables/windward-staged"
