"""Looking at dataset directories through the file system Spark itself uses."""

import json
import re

from pyspark.sql import SparkSession

# What writers leave beside their parts.
_DONE = "_SUCCESS"
_COMMITTED = re.compile("_committed_[0-9]+")


def _opened(spark: SparkSession, directory: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(directory)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), path


def stored_bytes(spark: SparkSession, directory: str) -> int:
    """Total size of the files in a directory and those below it."""
    fs, path = _opened(spark, directory)
    return fs.getContentSummary(path).getLength()


def file_names(spark: SparkSession, directory: str) -> list[str] | None:
    """Names of the entries of one directory; ``None`` if it does not exist."""
    fs, path = _opened(spark, directory)
    if not fs.exists(path) or not fs.getFileStatus(path).isDirectory():
        return None
    return sorted(entry.getPath().getName() for entry in fs.listStatus(path))


def files_below(spark: SparkSession, directory: str) -> list[str]:
    """Paths of all files in a directory and those below it, relative to it."""
    fs, path = _opened(spark, directory)
    root, found = fs.resolvePath(path).toString().rstrip("/") + "/", []
    listing = fs.listFiles(path, True)
    while listing.hasNext():
        found.append(listing.next().getPath().toString().removeprefix(root))
    return sorted(found)


def same_place(spark: SparkSession, one: str, other: str) -> bool:
    """Whether the escaped URI ``one`` and the path ``other`` name one place."""
    fs, b = _opened(spark, other)
    a = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(one))
    return fs.makeQualified(a).toString() == fs.makeQualified(b).toString()


def _text(spark: SparkSession, file: str) -> str:
    fs, path = _opened(spark, file)
    stream = fs.open(path)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def promised_parts(spark: SparkSession, directory: str) -> set[str] | None:
    """The part files that the commit markers of a dataset promise, relative to it.

    Some writers leave a marker ``_committed_<number>`` for each write, which
    names the parts it added and those it removed. A part that any marker
    removes is promised by none. ``None`` without markers; an error where a
    marker cannot be read.
    """
    added, removed, found = set(), set(), False
    for name in files_below(spark, directory):
        folder, _, marker = name.rpartition("/")
        if not _COMMITTED.fullmatch(marker):
            continue
        found = True
        said = json.loads(_text(spark, f"{directory}/{name}"))
        inside = f"{folder}/" if folder else ""
        added |= {inside + part for part in said["added"]}
        removed |= {inside + part for part in said["removed"]}
    return added - removed if found else None


def is_complete(spark: SparkSession, directory: str) -> bool:
    """Whether a writer finished ``directory``: success mark and Parquet files.

    Where there are commit markers, every part they promise must be there, and
    at least one must be; a marker that cannot be read promises nothing that
    could be checked, so the directory is not complete. Without markers any
    Parquet file will do. A directory partitioned by column counts as well: it
    holds ``column=value`` entries in place of files.
    """
    names = file_names(spark, directory) or []
    if _DONE not in names:
        return False
    try:
        promised = promised_parts(spark, directory)
    except (ValueError, KeyError, TypeError):
        return False
    if promised is not None:
        return bool(promised) and promised <= set(files_below(spark, directory))
    visible = [n for n in names if n[0] not in "._"]
    return any(n.endswith(".parquet") or "=" in n for n in visible)
