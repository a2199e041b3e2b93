"""Small file-system helpers over Hadoop's FileSystem API (works for file:,
hdfs:, s3a: ... alike), used for commit markers next to Parquet tables."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> None:
    """Create ``path`` with ``text``. With ``overwrite=False`` an existing file
    makes this fail, which turns a second concurrent writer into an error."""
    fs, p = _fs(spark, path)
    out = fs.create(p, overwrite)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


def list_files(spark: SparkSession, path: str, suffix: str = ".parquet") -> dict[str, int]:
    """Names below ``path`` (folders included) and lengths of the data files in it."""
    fs, p = _fs(spark, path)
    root, out, todo = fs.makeQualified(p).toString().rstrip("/"), {}, [p]
    while todo:
        for s in fs.listStatus(todo.pop()):
            name = s.getPath().getName()
            if s.isDirectory() and not name.startswith(("_", ".")):
                todo.append(s.getPath())
            elif name.endswith(suffix) and not name.startswith(("_", ".")):
                out[s.getPath().toString()[len(root) + 1:]] = s.getLen()
    return dict(sorted(out.items()))


def file_lengths(spark: SparkSession, files: list[str]) -> list[int]:
    """Lengths of the files of a table (URIs as ``DataFrame.inputFiles`` gives them)."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)) for f in files]
    return [p.getFileSystem(conf).getFileStatus(p).getLen() for p in paths]


def stamp(spark: SparkSession, path: str) -> tuple:
    """Names, lengths and times of what lies in a folder (one level; a table's folder changes its time with its files)."""
    fs, p = _fs(spark, path)
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(p)))
