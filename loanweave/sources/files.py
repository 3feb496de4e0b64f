"""Small file-system actions through Hadoop's API, so any store Spark reads works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def fs_path(spark: SparkSession, path: str):
    """(file system, path object) of ``path``."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = fs_path(spark, path)
    return bool(fs.exists(p))


def children(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, modification time in ms) of what lies directly under ``path``; none if absent."""
    fs, p = fs_path(spark, path)
    if not fs.exists(p):
        return []
    return [(st.getPath().getName(), st.getModificationTime()) for st in fs.listStatus(p)]


def data_files(spark: SparkSession, path: str) -> list[int]:
    """Bytes of each data file anywhere under ``path``."""
    fs, p = fs_path(spark, path)
    out, found = [], fs.listFiles(p, True)
    while found.hasNext():
        st = found.next()
        if not st.getPath().getName().startswith(("_", ".")):
            out.append(st.getLen())
    return out


def delete(spark: SparkSession, path: str) -> None:
    fs, p = fs_path(spark, path)
    fs.delete(p, True)


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create ``path`` with ``text``, whole or not at all; False if it exists already.

    Written beside under a hidden name, then renamed without overwriting, so a
    reader never meets half a file and two writers never share one."""
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs
    fs, final = fs_path(spark, path)
    draft = hadoop.Path(final.getParent(), f".{final.getName()}.{jvm.java.util.UUID.randomUUID()}")
    out = fs.create(draft, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    keep = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(draft, final, keep)
        return True
    except Exception:
        fs.delete(draft, False)
        if fs.exists(final):
            return False
        raise
