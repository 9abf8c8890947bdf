from types import SimpleNamespace

from highwater.functions.lineage import materialise, shared_folder
from tests.conftest import rows


def session(master, folder):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder), sparkContext=SimpleNamespace(master=master)
    )


def test_folder_of_the_session_is_used():
    path = shared_folder(session("yarn", "s3://shared/run/"), "x")
    assert path.startswith("s3://shared/run/x-")
    assert path != shared_folder(session("yarn", "s3://shared/run/"), "x")


def test_a_session_without_one_gets_a_folder_below_its_warehouse():
    conf = {"spark.sql.warehouse.dir": "file:/data/warehouse"}
    named = SimpleNamespace(conf=SimpleNamespace(get=lambda key, *default: conf.get(key, *default)))
    assert shared_folder(named, "x").startswith("file:/data/warehouse/_shared/x-")


def test_materialised_rows_come_from_files(spark):
    df = spark.range(5).selectExpr("id", "array(id) AS items")
    written = materialise(df, "ids")
    assert rows(written) == rows(df)
    assert written.inputFiles()
