"""The log of published runs: which run is the current one, decided between racing publishers.

``<base>/_log`` holds one small file for every version, ``00000001.json`` and so on, and the last
one names the current run. A version is written by put-if-absent: of two publishers that started
from the same version one gets the next number, the other a ``PublishConflict``. Nothing is ever
renamed over or changed, so a reader sees a whole version or does not see it.

Put-if-absent is the store's own: a hard link on a machine's file system, a conditional write
where the store offers it (object stores), else a rename that refuses to overwrite (HDFS).

The folder of a run is claimed the same way before anything is written into it. A run_id that is
used again gets a folder of its own, so tables that readers hold open are never written over.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import re
import uuid
from typing import List, NamedTuple, Optional

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

LOG = "_log"
CLAIM = "_claim"
CONDITIONAL = "fs.option.create.conditional.overwrite"


class PublishConflict(RuntimeError):
    """Another publisher committed first; nothing of this run was published."""


class Commit(NamedTuple):
    version: int
    run_id: str
    folder: str         # of the run, under the base


def hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def file_system(spark: SparkSession, path: str):
    p = hadoop_path(spark, path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _write(fs, path, text: str) -> None:
    out = fs.create(path, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with all its text, or return False because the path is taken."""
    fs, p = file_system(spark, path)
    p = fs.makeQualified(p)
    if fs.hasPathCapability(p, CONDITIONAL):
        try:
            out = fs.createFile(p).recursive().overwrite(False).must(CONDITIONAL, True).build()
            out.write(bytearray(text.encode("utf-8")))
            out.close()
        except Py4JJavaError:
            return _taken(fs, p)
        return True
    fs.mkdirs(p.getParent())
    tmp = hadoop_path(spark, f"{p.getParent()}/.{p.getName()}.{uuid.uuid4().hex}")
    if p.toUri().getScheme() == "file":
        _write(fs.getRawFileSystem(), tmp, text)
        try:
            os.link(tmp.toUri().getPath(), p.toUri().getPath())
        except FileExistsError:
            return False
        finally:
            fs.delete(tmp, False)
        return True
    _write(fs, tmp, text)
    kind = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(tmp, p, spark.sparkContext._gateway.new_array(kind, 0))
    except Py4JJavaError:
        return _taken(fs, p)
    finally:
        fs.delete(tmp, False)
    return True


def _taken(fs, p) -> bool:
    """False for a path that another writer has taken; other errors go on."""
    if not fs.exists(p):
        raise
    return False


def read_text(spark: SparkSession, path: str) -> Optional[str]:
    fs, p = file_system(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def versions(spark: SparkSession, base: str) -> List[int]:
    """The committed versions, in order."""
    fs, p = file_system(spark, f"{base}/{LOG}")
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[:-5]) for n in names if re.fullmatch(r"\d{8,}\.json", n))


def _file(base: str, version: int) -> str:
    return f"{base}/{LOG}/{version:08d}.json"


def commit_of(spark: SparkSession, base: str, version: int) -> Commit:
    entry = json.loads(read_text(spark, _file(base, version)))
    return Commit(version, entry["run_id"], entry["folder"])


def latest(spark: SparkSession, base: str) -> Optional[Commit]:
    """The current version; None where nothing was committed."""
    known = versions(spark, base)
    return commit_of(spark, base, known[-1]) if known else None


def find_run(spark: SparkSession, base: str, run_id: str) -> Optional[Commit]:
    """The last commit of a run_id, from the newest version back."""
    for v in reversed(versions(spark, base)):
        commit = commit_of(spark, base, v)
        if commit.run_id == run_id:
            return commit
    return None


def claim_folder(spark: SparkSession, base: str, run_id: str) -> str:
    """A new folder under ``base`` that only the caller writes to: ``run_id=<id>``, and
    ``run_id=<id>.2`` and so on where that was claimed before."""
    n = 1
    while True:
        folder = f"run_id={run_id}" + (f".{n}" if n > 1 else "")
        if put_if_absent(spark, f"{base}/{folder}/{CLAIM}", dt.datetime.now(dt.timezone.utc).isoformat()):
            return folder
        n += 1


def append(spark: SparkSession, base: str, based_on: int, run_id: str, folder: str) -> Commit:
    """Commit a finished folder as the version after ``based_on``, the version its writer started
    from (0: none); ``PublishConflict`` if that number is taken."""
    entry = {"run_id": run_id, "folder": folder, "based_on": based_on,
             "committed_at": dt.datetime.now(dt.timezone.utc).isoformat()}
    if not put_if_absent(spark, _file(base, based_on + 1), json.dumps(entry)):
        other = commit_of(spark, base, based_on + 1)
        raise PublishConflict(f"run {other.run_id} was published to {base} since run {run_id} began")
    return Commit(based_on + 1, run_id, folder)


def delete_folder(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)
