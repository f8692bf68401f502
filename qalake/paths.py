"""Files on any Hadoop path, handled by the driver (a few small files and folders at a time)."""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    name: str
    is_folder: bool
    length: int
    modified_ms: int


def _at(spark: SparkSession, path: str):
    """(file system, path object) of a plain, ``file:`` or other Hadoop path."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[Entry]:
    """The entries of a folder by name, hidden ones included; none if it does not exist."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return []
    found = [Entry(s.getPath().getName(), s.isDirectory(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(p)]
    return sorted(found, key=lambda e: e.name)


def walk(spark: SparkSession, root: str) -> Iterator[tuple[str, str, int]]:
    """(path, path below the root, length) of all files below a folder, as the file system lists them."""
    local = local_folder(spark, root)
    if local and os.path.isdir(local):
        yield from _walk_local(local + "/")
        return
    fs, p = _at(spark, root)
    base = fs.makeQualified(p).toUri().getPath().rstrip("/") + "/"
    files = fs.listFiles(p, True)
    while files.hasNext():
        f = files.next()
        at = f.getPath()
        yield at.toString(), at.toUri().getPath().removeprefix(base), f.getLen()


def local_folder(spark: SparkSession, path: str) -> str | None:
    """A path of the local file system without its scheme; None on any other."""
    fs, p = _at(spark, path)
    return fs.makeQualified(p).toUri().getPath().rstrip("/") if fs.getUri().getScheme() == "file" else None


def _walk_local(base: str) -> Iterator[tuple[str, str, int]]:
    """The same for a folder on a local file system, where Hadoop's listing starts a process for each file's rights."""
    def below(folder: str) -> Iterator[tuple[str, str, int]]:
        with os.scandir(folder) as entries:  # read as they are asked for: a folder may hold a folder a file
            for e in entries:
                if e.is_dir():
                    yield from below(e.path)
                elif not (e.name.startswith(".") and e.name.endswith(".crc")):  # checksums, which the file system hides
                    yield f"file:{e.path}", e.path.removeprefix(base), e.stat().st_size

    yield from below(base)


def total_bytes(spark: SparkSession, path: str) -> int | None:
    """Bytes of a file, or of all files below a folder; None if it does not exist."""
    fs, p = _at(spark, path)
    return fs.getContentSummary(p).getLength() if fs.exists(p) else None


def stamp(spark: SparkSession, path: str) -> str | None:
    """Names, sizes and times of a file, or of the files of a folder and its folders, in short; None if there is none."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return None
    files, n = fs.listFiles(p, True), 0
    while files.hasNext():  # in the file system's order, which need not be that of names
        f = files.next()
        line = f"{f.getPath().toUri().getPath()}:{f.getLen()}:{f.getModificationTime()}"
        n = (n + int.from_bytes(hashlib.sha256(line.encode()).digest()[:16], "big")) % (1 << 128)
    return f"{n:032x}"


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as Spark reports files."""
    fs, p = _at(spark, path)
    return fs.makeQualified(p).toString()


def read_text(spark: SparkSession, path: str) -> str:
    """The text of a small file."""
    fs, p = _at(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def _put(fs, p, text: str) -> None:
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, replacing what is there."""
    _put(*_at(spark, path), text)


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file whole or not at all; False if there is one already.

    The text goes to a file beside it, which is renamed without replacing: one call of the file system.
    """
    fs, p = _at(spark, path)
    fs.mkdirs(p.getParent())
    jvm = spark._jvm
    beside = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}.tmp")
    _put(fs, beside, text)
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(beside), fs.makeQualified(p), how)
    except Py4JJavaError as e:
        fs.delete(beside, False)
        if "FileAlreadyExistsException" not in e.java_exception.getClass().getName():
            raise
        return False
    return True


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a file, or a folder with what it holds; False if there was none."""
    fs, p = _at(spark, path)
    return fs.delete(p, True)


def replace(spark: SparkSession, path: str, at: str) -> None:
    """Move a folder to ``at`` on the same file system; what is there is deleted first."""
    fs, p = _at(spark, path)
    _, to = _at(spark, at)
    fs.delete(to, True)
    fs.mkdirs(to.getParent())
    if not fs.rename(p, to):
        raise OSError(f"{path} could not be moved to {at}")
