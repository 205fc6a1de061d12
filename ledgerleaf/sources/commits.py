"""Tables that grow by runs and are replaced by versions: a folder counts when its entry is committed, and not before.

Under path/_commits/<name>/ stands one small file per commit, numbered, put there by a rename as the last step of a write. A
reader takes, of each name, the folder of the greatest number. So a run that fails leaves nothing that is read, one that is
repeated under its name takes the place of what it wrote before, and a table that is being read can be replaced: the version
that is read stays until a later write tidies up.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import SparkSession

_NAME = re.compile(r"[A-Za-z0-9_.=-]+")
#: Versions of a name that stay when older ones are deleted.
KEPT = 2


def _files(spark: SparkSession, path: str) -> tuple:
    at = spark._jvm.org.apache.hadoop.fs.Path
    return at, at(path).getFileSystem(spark._jsc.hadoopConfiguration())


def new_folder(name: str) -> str:
    """A folder for one attempt to write what `name` stands for."""
    if not _NAME.fullmatch(name):
        raise ValueError(f"not a name for a run: {name!r}")
    return f"{name}/{uuid.uuid4().hex}"


def versions(spark: SparkSession, path: str, name: str) -> list[dict]:
    """All entries of a name, oldest first; each has its number as n."""
    at, files = _files(spark, path)
    folder = at(f"{path}/_commits/{name}")
    if not files.exists(folder):
        return []
    found = []
    for status in files.listStatus(folder):
        if status.getPath().getName().isdigit():
            stream = files.open(status.getPath())
            try:
                found.append(json.loads(bytes(stream.readAllBytes())) | {"n": int(status.getPath().getName())})
            finally:
                stream.close()
    return sorted(found, key=lambda e: e["n"])


def committed(spark: SparkSession, path: str) -> dict[str, dict]:
    """The entry that counts of each name."""
    at, files = _files(spark, path)
    folder = at(f"{path}/_commits")
    names = [s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory()] if files.exists(folder) else []
    return {name: found[-1] for name in sorted(names) if (found := versions(spark, path, name))}


def commit(spark: SparkSession, path: str, name: str, entry: dict) -> dict:
    """Makes entry (with its folder, below path) the one that counts of name. Folders before the last KEPT are deleted."""
    at, files = _files(spark, path)
    before = versions(spark, path, name)
    n = before[-1]["n"] + 1 if before else 0
    draft, final = at(f"{path}/_commits/{name}/.{uuid.uuid4().hex}"), at(f"{path}/_commits/{name}/{n:08d}")
    stream = files.create(draft)
    try:
        stream.write(bytearray(json.dumps(entry).encode()))
    finally:
        stream.close()
    if files.exists(final) or not files.rename(draft, final):
        raise OSError(f"another job has committed {name} to {path}")
    for old in before[: 1 - KEPT]:
        if old["folder"] != entry["folder"]:
            files.delete(at(f"{path}/{old['folder']}"), True)
        files.delete(at(f"{path}/_commits/{name}/{old['n']:08d}"), False)
    return entry | {"n": n}
