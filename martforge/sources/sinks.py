"""Materialisations (SINK1-SINK4).

* view      — a lazy DataFrame, optionally a temp view for SQL users;
* ephemeral — a DataFrame function inlined into its consumers;
* table     — written in full to a new folder and made current by a commit
              file (``snapshots``): alone (``write_table``), or together with
              the other tables of its layer (``layer``).

Tables live under ``<root>/<env>_<layer>/<model>`` (e.g. ``dev_marts``); the
commits of a layer are in ``<root>/_commits/<env>_<layer>``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from martforge.sources.snapshots import KEEP, NotPublishedError, TableSet


def layer_path(root: str, env: str, layer: str, model: str) -> str:
    """SINK4: where a model of a layer is stored."""
    return f"{root.rstrip('/')}/{env}_{layer}/{model}"


def folder_set(spark: SparkSession, folder: str) -> TableSet:
    """The set of tables in a folder of a lake; its commits stand beside the folder, in ``_commits``."""
    parent, _, name = folder.rstrip("/").rpartition("/")
    return TableSet(spark, folder, f"{parent}/_commits/{name}")


def layer(spark: SparkSession, root: str, env: str, name: str) -> TableSet:
    """SINK4: the tables of a layer, replaced together."""
    return folder_set(spark, f"{root.rstrip('/')}/{env}_{name}")


def as_view(df: DataFrame, name: str) -> DataFrame:
    """SINK1: register a lazy model for SQL access."""
    df.createOrReplaceTempView(name)
    return df


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_within: Sequence = (),
                files: int | None = None, keep: int = KEEP) -> None:
    """SINK3: full replace of one table; the last ``keep`` versions stay readable."""
    alone = TableSet(df.sparkSession, path)
    with alone.begin() as new:
        new.write(df, "", partition_by, sort_within, files)
        new.commit()
    alone.expire(keep)


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table ``write_table`` made current (or an earlier ``version`` that is still kept).
    A plain Parquet folder without commits is read as it is."""
    try:
        return TableSet(spark, path).read("", version)
    except NotPublishedError:
        if version is not None or not exists(spark, f"{path.rstrip('/')}/_SUCCESS"):
            raise
        return spark.read.parquet(path)


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)
