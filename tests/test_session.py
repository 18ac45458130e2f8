import zipfile

from marketlane.session import ship


def test_the_package_is_sent_to_the_workers(spark):
    archive = ship(spark)
    names = zipfile.ZipFile(archive).namelist()
    assert {"marketlane/session.py", "marketlane/sources/split_csv.py", "marketlane/operators/heavy_hitters.py"} <= set(names)
    assert any(archive.rsplit("/", 1)[1] in f for f in spark.sparkContext.listFiles)
