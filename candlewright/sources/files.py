"""Path questions answered by the session's own file system."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _fs(spark, path)
    fs.delete(where, True)


def swap_in(spark: SparkSession, staged: str, path: str) -> None:
    """Put a completely written table in the place of an older one."""
    fs, new = _fs(spark, staged)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "__replaced")
    if fs.exists(target):
        fs.delete(aside, True)
        if not fs.rename(target, aside):
            raise OSError(f"cannot move {path} aside")
    if not fs.rename(new, target):
        if fs.exists(aside):
            fs.rename(aside, target)  # the older table stays
        raise OSError(f"cannot move {staged} to {path}")
    fs.delete(aside, True)


def heal(spark: SparkSession, path: str) -> None:
    """Undo a swap whose driver was lost between its two renames."""
    fs, target = _fs(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "__replaced")
    if not fs.exists(target) and fs.exists(aside):
        fs.rename(aside, target)
    if fs.exists(target):
        for status in fs.listStatus(target):
            name = status.getPath().getName()
            part = spark._jvm.org.apache.hadoop.fs.Path(target, name.removeprefix(_ASIDE))
            if name.startswith(_ASIDE) and not fs.exists(part):
                fs.rename(status.getPath(), part)


#: Readers pass over names that begin with a point.
_ASIDE = ".replaced-"


def swap_partitions(spark: SparkSession, staged: str, path: str) -> None:
    """Put every partition folder of ``staged`` in the place of its namesake in ``path``; other partitions stay."""
    fs, new = _fs(spark, staged)
    heal(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    within = lambda name: spark._jvm.org.apache.hadoop.fs.Path(target, name)
    for status in fs.listStatus(new):
        name = status.getPath().getName()
        if "=" not in name:
            continue
        fs.delete(within(_ASIDE + name), True)
        if fs.exists(within(name)) and not fs.rename(within(name), within(_ASIDE + name)):
            raise OSError(f"cannot move {name} of {path} aside")
        if not fs.rename(status.getPath(), within(name)):
            raise OSError(f"cannot move {name} to {path}")
        fs.delete(within(_ASIDE + name), True)
    fs.delete(new, True)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, where = _fs(spark, path)
    fs.mkdirs(where)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of a top-level partition column, from the directory names."""
    if not exists(spark, path):
        return []
    fs, where = _fs(spark, path)
    names = [status.getPath().getName() for status in fs.listStatus(where)]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{column}="))
