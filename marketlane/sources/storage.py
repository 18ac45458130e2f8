"""Path questions answered by the file system Spark itself uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _fs(spark, path)
    return fs.exists(hadoop)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that fit a glob pattern, by one listing."""
    fs, hadoop = _fs(spark, pattern)
    return sorted(status.getPath().toString() for status in fs.globStatus(hadoop) or [])


def children(spark: SparkSession, path: str) -> list[str]:
    fs, hadoop = _fs(spark, path)
    if not fs.exists(hadoop):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop))


def delete(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _fs(spark, path)
    return fs.delete(hadoop, True)


def files(spark: SparkSession, paths) -> list[tuple[str, int]]:
    """Name and size of every file under the given files, folders or glob patterns."""
    out = []
    for path in paths:
        fs, hadoop = _fs(spark, path)
        for status in fs.globStatus(hadoop) or []:
            found = fs.listFiles(status.getPath(), True)
            while found.hasNext():
                file = found.next()
                if not file.getPath().getName().startswith(("_", ".")):
                    out.append((file.getPath().toString(), file.getLen()))
    return out
