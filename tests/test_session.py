from types import SimpleNamespace

import pytest

from gradus import session


def fake(master, warehouse, named=None):
    settings = {"spark.sql.warehouse.dir": warehouse, "spark.checkpoint.dir": named}
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default=None: settings.get(name) or default),
        sparkContext=SimpleNamespace(master=master, getCheckpointDir=lambda: None),
    )


def test_copies_need_a_folder_that_executors_see():
    assert session.shared_folder(fake("spark://a:7077", "file:/x", "hdfs://n/shared/")) == "hdfs://n/shared"
    assert session.shared_folder(fake("spark://a:7077", "hdfs://n/house")) == "hdfs://n/house/gradus-copies"
    assert session.shared_folder(fake("local[4]", "file:/x")) == "file:/x/gradus-copies"
    for warehouse in ("file:/x", "/x"):
        with pytest.raises(ValueError, match="checkpoint"):
            session.shared_folder(fake("yarn", warehouse))


def test_copies_are_deleted_one_by_one(spark):
    before = set(session.written_copies(spark))
    one, path = session.materialise_at(spark.range(3))
    two = session.materialise(spark.range(4))
    assert len(set(session.written_copies(spark)) - before) == 2 and one.count() == 3
    session.drop_path(spark, path)
    assert path not in session.written_copies(spark) and two.count() == 4


def test_scans_are_split_unless_they_are_split_finer(spark):
    from gradus import session

    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    try:
        for given, kept in (("128m", session.SCAN_BYTES), ("134217728b", session.SCAN_BYTES), ("1g", session.SCAN_BYTES), ("1m", 1 << 20)):
            spark.conf.set(name, given)
            session.configure(spark)
            assert session._plain_bytes(spark.conf.get(name)) == kept
    finally:
        spark.conf.set(name, before)
