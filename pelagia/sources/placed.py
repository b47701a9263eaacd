"""Snapshots stored by key: bucketed and sorted, so that joins on the key move no rows.

A placed snapshot is a version and a pointer like any other (:mod:`.snapshot`), and its folder also
holds ``layout``: the key, the number of buckets and the columns. To Spark it is a bucketed table;
the session's own catalog is enough to say so, and reading registers it under a name made from its
version, so no metastore server is needed and another session can read what this one wrote.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .snapshot import read_pointer, turn_pointer


def _name(version: str) -> str:
    return f"placed_{version}"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def write_placed(df: DataFrame, path: str, key: str, buckets: int, keep: int = 2) -> DataFrame:
    """Write the next version with the rows of a bucket together, sorted by key, one file a bucket.

    Rows that were already shuffled by the key into as many partitions are not shuffled again.
    """
    spark, version = df.sparkSession, uuid.uuid4().hex
    placed = df.repartition(buckets, key)
    writer = placed.write.format("parquet").bucketBy(buckets, key).sortBy(key)
    writer.option("path", f"{path}/version/{version}").saveAsTable(_name(version))
    layout = json.dumps({"key": key, "buckets": buckets, "schema": df.schema.jsonValue()})
    spark.createDataFrame([(layout,)], "value string").coalesce(1).write.text(f"{path}/layout/{version}")
    for gone in turn_pointer(spark, path, version, keep):
        spark.sql(f"DROP TABLE IF EXISTS {_name(gone)}")
    return spark.table(_name(version))


def read_placed(spark: SparkSession, path: str) -> DataFrame:
    """The current version, known to the planner as bucketed and sorted by its key."""
    version = read_pointer(spark, path)
    if not spark.catalog.tableExists(_name(version)):
        layout = json.loads(spark.read.text(f"{path}/layout/{version}", wholetext=True).first()[0])
        schema = T.StructType.fromJson(layout["schema"])
        columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
        key = _quoted(layout["key"])
        place = f"{path}/version/{version}".replace("'", "\\'")
        spark.sql(f"CREATE TABLE {_name(version)} ({columns}) USING parquet CLUSTERED BY ({key}) SORTED BY ({key}) INTO {int(layout['buckets'])} BUCKETS LOCATION '{place}'")
    return spark.table(_name(version))
