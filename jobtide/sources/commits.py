"""A log of commits beside the data they publish.

Writers stage a folder that nobody reads, then publish it by one numbered entry. Only one writer can
create the entry of a number; the other sees what was published meanwhile and tries the next. A
write that ends halfway leaves a folder without an entry.
"""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "_commits"
SCHEMA = "version long, load string, parts map<string,string>"


def entries(spark: SparkSession, path: str) -> DataFrame:
    """All published entries; none before the first. An entry that is still being written has no
    row yet."""
    try:
        found = spark.read.schema(SCHEMA).option("mode", "DROPMALFORMED").json(f"{path}/{LOG}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], SCHEMA)
    return found.where(F.col("version").isNotNull())


def last(spark: SparkSession, path: str) -> int:
    """Number of the newest entry, -1 before the first."""
    found = entries(spark, path).agg(F.max("version")).first()[0]
    return -1 if found is None else found


def publish(spark: SparkSession, path: str, version: int, load: str, parts: dict[str, str] | None = None) -> bool:
    """Create entry `version`; False if it is there already. The file system decides: HDFS and stores
    with conditional writes let exactly one writer through."""
    name = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{LOG}/{version:012d}.json")
    files = name.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        out = files.create(name, False)
    except Py4JJavaError as error:
        if files.exists(name):
            return False
        raise error
    out.write(bytearray(json.dumps({"version": version, "load": load, "parts": parts or {}}).encode() + b"\n"))
    out.close()
    return True


def loads(spark: SparkSession, path: str, version: int | None = None) -> list[str]:
    """Published loads up to a version, in order: as many as there were loads."""
    found = entries(spark, path)
    if version is not None:
        found = found.where(F.col("version") <= version)
    return [r.load for r in found.select("version", "load").orderBy("version").collect()]
