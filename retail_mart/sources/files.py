"""Small Hadoop file-system calls of the driver (any scheme Spark can write)."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType


def fs(spark: SparkSession, path: str):
    """(file system, Path) of ``path``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    system, p = fs(spark, path)
    return bool(system.exists(p))


def delete(spark: SparkSession, path: str) -> None:
    system, p = fs(spark, path)
    if system.exists(p):
        system.delete(p, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; a missing folder has none."""
    system, p = fs(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(p)) if system.exists(p) else []


def data_folders(spark: SparkSession, folder: str, schema: StructType) -> list[str]:
    """Folders below ``folder`` that hold data files of a table, relative to it (one call, however many)."""
    table = spark.read.schema(schema).parquet(folder)
    urls = spark.sparkContext._jvm.org.apache.hadoop.util.StringUtils.join("\n", table._jdf.inputFiles())
    mark = f"/{folder.rstrip('/').rpartition('/')[2]}/"
    return sorted({unquote(u).partition(mark)[2].rpartition("/")[0] for u in urls.split("\n") if u})


def read_text(spark: SparkSession, path: str) -> str:
    system, p = fs(spark, path)
    f = system.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(f, "UTF-8")
    finally:
        f.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    system, p = fs(spark, path)
    f = system.create(p, True)
    try:
        f.write(bytearray(text.encode()))
    finally:
        f.close()


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file that nobody else has created; False if it is there."""
    system, p = fs(spark, path)
    if not system.createNewFile(p):
        return False
    write_text(spark, path, text)
    return True


def rename_new(spark: SparkSession, old: str, new: str) -> bool:
    """Rename a file in one step; False if ``new`` is there already."""
    sc = spark.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs
    _, src = fs(spark, old)
    _, dst = fs(spark, new)
    plain = sc._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        hadoop.FileContext.getFileContext(src.toUri(), sc._jsc.hadoopConfiguration()).rename(src, dst, plain)
    except Exception as e:  # the JVM's class is not a Python one
        if "FileAlreadyExistsException" in str(e):
            return False
        raise
    return True
