import os

import pytest

from twintally import storage
from twintally.catalogue import QUERIES


class Session:
    """A session with settings and a master, as far as ``shared_folder`` looks."""

    def __init__(self, master, checkpoints=None, warehouse=None, default="hdfs://nn"):
        named = {"spark.checkpoint.dir": checkpoints, "spark.sql.warehouse.dir": warehouse}
        self.conf = {name: folder for name, folder in named.items() if folder}
        settings = type("Settings", (), {"get": lambda self, name, other: default if name == "fs.defaultFS" else other})
        java = type("Java", (), {"hadoopConfiguration": lambda self: settings()})()
        self.sparkContext = type("Context", (), {"master": master, "_jsc": java})


def test_the_cluster_names_the_folder():
    assert storage.shared_folder(Session("spark://host:7077", "hdfs://nn/shared/", "hdfs://nn/w")) == "hdfs://nn/shared"
    assert storage.shared_folder(Session("yarn", None, "hdfs://nn/warehouse")) == "hdfs://nn/warehouse"


def test_a_folder_of_one_machine_is_for_local_sessions():
    for master, folder in (("yarn", "file:/tmp/x"), ("spark://h:7077", "file:///tmp/x"), ("yarn", None)):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            storage.shared_folder(Session(master, folder))
    assert storage.shared_folder(Session("local[2]", None, "file:/w/")) == "file:/w"
    # Without a scheme it is the default file system that decides.
    assert storage.shared_folder(Session("yarn", "/shared:a/x")) == "/shared:a/x"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.shared_folder(Session("yarn", "/tmp/here", default="file:///"))
    assert storage.shared_folder(Session("local[2]", "/tmp/here", default="file:///")) == "/tmp/here"


def test_fresh_folders_of_a_real_session(spark):
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert storage.shared_folder(spark) == shared
    first, second = (storage.fresh_folder(spark, "log") for _ in range(2))
    assert first.startswith(f"{shared}/log-") and first != second
    assert os.path.isdir(os.path.dirname(first)) and not os.path.exists(first)


def test_a_folder_that_all_machines_have_serves_a_cluster(spark, monkeypatch):
    mount = Session("spark://h:7077", "file:///mnt/shared")
    assert storage.shared_folder(mount, lambda session, folder: folder == "file:///mnt/shared") == "file:///mnt/shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        storage.shared_folder(mount, lambda session, folder: False)
    # The session's folder is one that all of its executors see, whatever its master is called.
    monkeypatch.setattr(spark.sparkContext, "master", "spark://h:7077")
    monkeypatch.setattr(storage, "_seen", set())
    folder = storage.fresh_folder(spark, "cluster")
    spark.range(9).write.parquet(folder)
    assert spark.read.parquet(folder).count() == 9
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert not [name for name in os.listdir(shared) if name.startswith("trial-")]


@pytest.mark.parametrize(
    "name",
    [
        "content_check_stored_typed", "content_check_tree", "content_check_tree_documents", "content_check_tree_typed",
        "content_rows_with_counts", "scan_csv", "scan_csv_malformed", "scan_csv_multiline",
    ],
)
def test_queries_that_write_run_on_a_cluster(name, spark, small_dir, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://h:7077")
    assert QUERIES[name](spark, small_dir).collect()


def test_a_trial_that_loses_files_shows_a_folder_of_one_machine(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "_seen", set())
    assert storage.seen_by_all(spark, str(tmp_path))
    read = spark.read.schema("id long")
    monkeypatch.setattr(type(read), "parquet", lambda reader, path: spark.range(3))
    assert storage.seen_by_all(spark, str(tmp_path))  # once per session
    monkeypatch.setattr(storage, "_seen", set())
    assert not storage.seen_by_all(spark, str(tmp_path))
