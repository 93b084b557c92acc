"""Writers for delimited landing files (used to stage inputs and by tests)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_delimited(df: DataFrame, path: str, sep: str = "|", header: bool = True,
                    quoted: bool = False, num_files: int | None = None) -> str:
    """Write ``df`` as delimited text, one file per partition.

    ``quoted``: fields holding the separator, a quote or a line break are
    wrapped in ``"`` with ``""`` for an embedded quote.  Otherwise nothing is
    quoted (the strict dialect)."""
    out = df.repartition(num_files) if num_files else df
    writer = (out.write.mode("overwrite")
                 .option("sep", sep)
                 .option("header", header)
                 .option("ignoreLeadingWhiteSpace", False)
                 .option("ignoreTrailingWhiteSpace", False))
    if quoted:
        writer = writer.option("quote", '"').option("escape", '"')
    else:
        writer = writer.option("quote", "").option("escapeQuotes", False)
    writer.csv(path)
    return path


def write_lines(lines: DataFrame, path: str, num_files: int | None = None) -> str:
    """Write a single string column as raw lines."""
    out = lines.repartition(num_files) if num_files else lines
    out.select(F.col(lines.columns[0]).alias("value")).write.mode("overwrite").text(path)
    return path


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path in its own type (local,
    HDFS and object stores alike)."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def delete_path(spark: SparkSession, path: str) -> bool:
    """Recursively delete ``path``; False if there was nothing."""
    fs, hpath = file_system(spark, path)
    return bool(fs.delete(hpath, True))


def exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = file_system(spark, path)
    return bool(fs.exists(hpath))


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file within one file system; the target must not be there."""
    fs, hpath = file_system(spark, source)
    target_path = file_system(spark, target)[1]
    if fs.exists(target_path):
        raise FileExistsError(target)
    if not fs.rename(hpath, target_path):
        raise OSError(f"could not rename {source} to {target}")


def make_parent(spark: SparkSession, path: str) -> None:
    fs, hpath = file_system(spark, path)
    fs.mkdirs(hpath.getParent())


def list_files(spark: SparkSession, folder: str) -> list[str]:
    """Names, relative to ``folder``, of all files in it and below; none if
    it is not there."""
    fs, hpath = file_system(spark, folder)
    if not fs.exists(hpath):
        return []
    root = fs.makeQualified(hpath).toUri().getPath().rstrip("/") + "/"
    found, files = [], fs.listFiles(hpath, True)
    while files.hasNext():
        found.append(files.next().getPath().toUri().getPath()[len(root):])
    return found


def list_folders(spark: SparkSession, folder: str) -> list[str]:
    """Names of the folders directly in ``folder``; none if it is not there."""
    fs, hpath = file_system(spark, folder)
    return [f.getPath().getName() for f in fs.listStatus(hpath) if f.isDirectory()] if fs.exists(hpath) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, or replace it: under another name first, then renamed."""
    fs, part = file_system(spark, f"{path}.part")
    out = fs.create(part, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    delete_path(spark, path)
    rename(spark, f"{path}.part", path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, hpath = file_system(spark, path)
    source = fs.open(hpath)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode()
    finally:
        source.close()


def write_version(spark: SparkSession, folder: str, text: str) -> int:
    """Write the next version of a small text.  Until it is whole the last
    version is in force, so there is always one; the one before is deleted."""
    last = _versions(spark, folder)
    number = last[-1] + 1 if last else 1
    write_text(spark, f"{folder}/v{number}", text)
    for old in last[:-1]:
        delete_path(spark, f"{folder}/v{old}")
    return number


def read_version(spark: SparkSession, folder: str) -> tuple[int, str] | None:
    """Number and text of the last version; None if there is none."""
    found = _versions(spark, folder)
    return (found[-1], read_text(spark, f"{folder}/v{found[-1]}")) if found else None


def _versions(spark: SparkSession, folder: str) -> list[int]:
    return sorted(int(name[1:]) for name in list_files(spark, folder) if name[:1] == "v" and name[1:].isdigit())
