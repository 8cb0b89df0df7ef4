"""Finding source documents among files."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.functions import text

# Extensions of source documents.
SUPPORTED = (".pdf", ".png", ".jpg", ".jpeg", ".gif", ".webp", ".tiff", ".bmp")
WORK_FOLDER = ".partial"
CHUNKS_FILE = "chunks.jsonl"


def _is_glob(path: str) -> bool:
    return any(c in path for c in "*?[")


def list_files(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """All files at or under a path: path, length, modification_time. Contents aren't read, and nothing is collected."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    return read.load(path).select("path", "length", F.col("modificationTime").alias("modification_time"))


def output_folders(files: DataFrame) -> DataFrame:
    """Folders that hold an assembled document; sources are never looked for below them."""
    parent = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    own_markdown = F.regexp_extract("path", r"([^/]+)/\1\.md$", 1) != ""
    return files.where(own_markdown | (text.file_name(F.col("path")) == CHUNKS_FILE)).select(parent.alias("folder")).distinct()


def work_folders(spark: SparkSession, path: str, depth: int) -> DataFrame:
    """Folders below ``path``, down to ``depth`` levels, with work in progress. Spark's listing leaves hidden ones out."""
    system, place = _hadoop(spark, path)
    found = []
    for level in range(depth + 1):
        pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(place, "/".join(["*"] * level + [WORK_FOLDER]))
        found += [(str(status.getPath().getParent().toString()),) for status in system.globStatus(pattern) or ()]
    return spark.createDataFrame(found, "folder string")


def supported(files: DataFrame) -> DataFrame:
    """Files with the extension of a source document, in any case."""
    return files.where(text.suffix(F.col("path")).isin(*SUPPORTED))


def outside(files: DataFrame, folders: DataFrame) -> DataFrame:
    """``files`` (path) but for those anywhere below one of ``folders`` (folder). Only paths are joined."""
    parts = F.split("path", "/")
    ancestors = F.transform(F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    inside = files.select("path", F.explode(ancestors).alias("folder")).join(folders, "folder", "left_semi").select("path").distinct()
    return files.join(inside, "path", "left_anti")


def discover(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """Source documents at a path, a folder or a pattern: doc_id, stem, path, length, modification_time.

    Folders that hold outputs are left out with all below them, but not where a pattern names them. ``doc_id`` is made
    of the whole path, so files of the same name in different folders are different documents. A single file of
    another kind and a path that doesn't exist raise ``ValueError``.
    """
    if not _is_glob(path) and PurePosixPath(path).suffix and PurePosixPath(path).suffix.lower() not in SUPPORTED and not _is_folder(spark, path):
        if _exists(spark, path):
            raise ValueError(f"unsupported file type: {PurePosixPath(path).suffix}")
    if not _is_glob(path) and not _exists(spark, path):
        raise ValueError(f"path does not exist: {path}")
    files = list_files(spark, path, recursive)
    if recursive and not _is_glob(path) and _is_folder(spark, path):
        # What a call that isn't recursive lists lies in no folder but the one it names.
        depth = (files.agg(F.max(F.size(F.split("path", "/")))).first()[0] or 0) - len(_uri(spark, path).split("/"))
        folders = output_folders(files).unionByName(work_folders(spark, path, max(0, depth)))
        files = outside(files, folders.where(F.col("folder") != F.lit(_uri(spark, path))))
    found = supported(files)
    return found.select(F.md5("path").alias("doc_id"), text.stem(F.col("path")).alias("stem"), "path", "length", "modification_time")


def _hadoop(spark: SparkSession, path: str):  # noqa: ANN202
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _exists(spark: SparkSession, path: str) -> bool:
    system, place = _hadoop(spark, path)
    return bool(system.exists(place))


def _is_folder(spark: SparkSession, path: str) -> bool:
    system, place = _hadoop(spark, path)
    return bool(system.exists(place)) and bool(system.getFileStatus(place).isDirectory())


def _uri(spark: SparkSession, path: str) -> str:
    system, place = _hadoop(spark, path)
    return str(system.makeQualified(place).toString()).rstrip("/")


def read_markdown(spark: SparkSession, path: str) -> DataFrame:
    """Markdown files, one row each: doc_id (the path), text."""
    return spark.read.format("text").option("wholetext", "true").load(path).select(F.input_file_name().alias("doc_id"), F.col("value").alias("text"))


def check_upload(file_name: str | None, page_number: object = 0) -> int:
    """Page number, from 0, of a valid request for one page of an uploaded file; else ``ValueError`` says why not."""
    if not file_name:
        raise ValueError("there is no file")
    if PurePosixPath(file_name).suffix.lower() not in SUPPORTED:
        raise ValueError(f"unsupported file type {PurePosixPath(file_name).suffix!r}")
    try:
        number = int(str(page_number))
    except ValueError:
        raise ValueError("the page number must be a whole number") from None
    if number < 0:
        raise ValueError("the page number must be 0 or more")
    return number
