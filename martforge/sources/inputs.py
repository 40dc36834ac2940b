"""The files behind a raw input and their headers (IO4, SRC1).

Every part file's first line is read before the load, side by side, through
the session's file system: 64 KB a file at most in one call.  Files are then
grouped by header, and each group is read by its own, so part files may order
their columns differently.  A file whose header is not the declared columns is
named and left out; the others load.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

READERS = 16


def clean_name(name: str) -> str:
    return name.replace("﻿", "").strip()


@dataclass(frozen=True)
class InputFile:
    path: str
    length: int
    modified: int


def list_files(spark: SparkSession, path: str) -> list[InputFile]:
    """The data files of a path (a file, a folder with its subfolders, or a glob), in name order; hidden ones (``_``, ``.``) are none."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for top in fs.globStatus(p) or []:
        base = top.getPath().toString()
        if top.isDirectory():
            entries = fs.listFiles(top.getPath(), True)
            while entries.hasNext():
                status = entries.next()
                found.append((status, status.getPath().toString()[len(base):].split("/")))
        else:
            found.append((top, [top.getPath().getName()]))
    files = [InputFile(s.getPath().toString(), s.getLen(), s.getModificationTime()) for s, below in found
             if not any(part.startswith(("_", ".")) for part in below)]
    return sorted(files, key=lambda f: f.path)


def first_line(spark: SparkSession, path: str) -> str | None:
    """A file's first line without its end; None for an empty file.  Compressed files are read through their codec."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(conf).open(p)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
        source = codec.createInputStream(stream) if codec is not None else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(source, "UTF-8"), 65536).readLine()
    finally:
        stream.close()


def header_names(line: str) -> tuple[str, ...]:
    """Column names as written in a header line."""
    return tuple(next(csv.reader([line]), ()))


@dataclass
class Inventory:
    """An input's files by what their headers say."""

    groups: dict[tuple[str, ...], list[InputFile]] = field(default_factory=dict)  # names as written -> files
    deviating: list[tuple[InputFile, tuple[str, ...]]] = field(default_factory=list)
    empty: list[InputFile] = field(default_factory=list)


def inventory(spark: SparkSession, files: Sequence[InputFile], declared: Sequence[str]) -> Inventory:
    """Files grouped by header; those whose cleaned names are not exactly the declared columns deviate."""
    out = Inventory()
    with ThreadPoolExecutor(max_workers=READERS) as pool:
        lines = list(pool.map(lambda f: first_line(spark, f.path) if f.length else None, files))
    for file, line in zip(files, lines):
        names = header_names(line) if line else ()
        if not names:
            out.empty.append(file)
        elif sorted(clean_name(n) for n in names) == sorted(declared):
            out.groups.setdefault(names, []).append(file)
        else:
            out.deviating.append((file, names))
    return out
