"""Written tables in the folder that every executor of the cluster can reach.

The folder is the session's ``spark.checkpoint.dir``.  A table written there
outlives executors and cuts lineage, so a value that is only stable once
computed (such as a partition number) is computed exactly once.
"""

import atexit
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"
_SESSION_FOLDER = "roadstream.sharedFolder"
_SHIPPED = "roadstream.shipped"


def shared_folder(spark: SparkSession) -> str:
    """This session's own folder below ``spark.checkpoint.dir``."""
    known = spark.conf.get(_SESSION_FOLDER, None)
    if known:
        return known
    root = spark.conf.get(_SETTING, None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError(f"set {_SETTING} to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="roadstream-")
    folder = f"{root.rstrip('/')}/roadstream-{uuid.uuid4().hex}"
    spark.conf.set(_SESSION_FOLDER, folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def freeze(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def frozen(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``freeze`` for a table that is not needed any more after the block, such as a micro-batch's."""
    path = new_path(df.sparkSession, name)
    try:
        df.write.option("compression", "zstd").parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        delete(df.sparkSession, path)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and ``path`` as its own kind of path."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def delete(spark: SparkSession, path: str) -> None:
    files, place = file_system(spark, path)
    files.delete(place, True)


def release(spark: SparkSession) -> None:
    """Delete this session's tables once no result still reads them."""
    folder = spark.conf.get(_SESSION_FOLDER, None)
    if folder:
        delete(spark, folder)
        spark.conf.unset(_SESSION_FOLDER)


def ship_package(spark: SparkSession) -> None:
    """Let the executors import this package, wherever the driver was started."""
    if spark.conf.get(_SHIPPED, None) == spark.sparkContext.applicationId:
        return
    root = Path(__file__).resolve().parent
    if root.is_dir():
        folder = tempfile.mkdtemp(prefix="roadstream-code-")  # the driver serves it as long as it runs
        atexit.register(shutil.rmtree, folder, True)
        archive = Path(folder, f"{root.name}.zip")
        with zipfile.ZipFile(archive, "w") as file:
            for source in sorted(root.rglob("*.py")):
                file.write(source, source.relative_to(root.parent))
        spark.sparkContext.addPyFile(str(archive))
    spark.conf.set(_SHIPPED, spark.sparkContext.applicationId)
