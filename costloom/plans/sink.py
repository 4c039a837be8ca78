"""SNK1: replace one invoice month of a target by publishing a new version of it.

A target holds, under names that plain readers of the folder skip,

* ``_data/invoice_month=202401/<version>/``: the rows of one version, never changed once written;
* ``_months/invoice_month=202401/<number>.json``: one manifest a commit, naming its version. The
  highest number that can be read is the month.

A commit is one put of a small new file: nothing is renamed, moved or overwritten, so it holds on object
stores, whose renames are copies, as on file systems. Until the put, and after a put that fails or
breaks off (its manifest is no whole JSON object), readers see the month as it was; there is no
moment without a month. Two writers that take the same number are told apart by the exclusive
create: the later one takes the next. The version before the current one stays for readers that have begun;
older ones go after a commit, and a clean-up that fails fails nothing else. ``remove_abandoned`` deletes what
writers that died have left.

``read_target`` resolves the months. An empty result is a version without rows."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

KEPT_VERSIONS = 2


@dataclass(frozen=True)
class Version:
    month: int
    number: int
    name: str
    facts: dict


def file_system(spark: SparkSession, path: str):
    """(Hadoop file system, path object) of a location on any store."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _month_dir(month: int) -> str:
    return f"invoice_month={int(month)}"


def data_path(target: str, month: int, version: str) -> str:
    return f"{target.rstrip('/')}/_data/{_month_dir(month)}/{version}"


def manifest_folder(target: str, month: int | None = None) -> str:
    root = f"{target.rstrip('/')}/_months"
    return root if month is None else f"{root}/{_month_dir(month)}"


def _listed(spark: SparkSession, folder: str) -> list[str]:
    fs, p = file_system(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def _numbers(spark: SparkSession, target: str, month: int) -> list[int]:
    names = _listed(spark, manifest_folder(target, month))
    return sorted((int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n.removesuffix(".json").isdigit()), reverse=True)


def _manifest_path(target: str, month: int, number: int) -> str:
    return f"{manifest_folder(target, month)}/{number:020d}.json"


def _read_manifest(spark: SparkSession, target: str, month: int, number: int) -> Version | None:
    """None for a manifest whose put broke off."""
    fs, p = file_system(spark, _manifest_path(target, month, number))
    stream = fs.open(p)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        found = json.loads(text)
        return Version(int(month), number, found["version"], found["facts"])
    except (ValueError, KeyError, TypeError):
        return None


def versions(spark: SparkSession, target: str, month: int) -> list[Version]:
    """Readable versions of a month, the current one first."""
    found = (_read_manifest(spark, target, month, n) for n in _numbers(spark, target, month))
    return [v for v in found if v]


def current(spark: SparkSession, target: str, month: int) -> Version | None:
    """The month's version that readers see; None if it was never written."""
    return next((v for n in _numbers(spark, target, month) if (v := _read_manifest(spark, target, month, n))), None)


def months(spark: SparkSession, target: str) -> list[int]:
    return [int(n.split("=")[1]) for n in _listed(spark, manifest_folder(target)) if n.startswith("invoice_month=")]


def read_target(spark: SparkSession, target: str, wanted: list[int] | None = None) -> DataFrame:
    """The target's months (all, or those of ``wanted``) as one frame with the partition column
    ``invoice_month``; a filter on it reads only that month's files."""
    found = [v for m in (months(spark, target) if wanted is None else wanted) if (v := current(spark, target, m))]
    if not found:
        raise ValueError(f"no month was written to {target}")
    paths = [data_path(target, v.month, v.name) for v in found]
    return spark.read.option("basePath", f"{target.rstrip('/')}/_data").parquet(*paths)


def put_new(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a file that must not exist yet; False if it does."""
    fs, p = file_system(spark, path)
    if fs.exists(p):
        return False
    try:
        stream = fs.create(p, False)
    except Exception as failed:  # another writer was first, or the store refused
        if fs.exists(p):
            return False
        raise failed
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True


def replace_month(df: DataFrame, target: str, month: int, check: Callable[[DataFrame], None] | None = None,
                  facts: Callable[[], dict] | None = None) -> Version:
    """Writes the month's rows beside the others and publishes them. Every job emits rows of its
    one month only (the scan is restricted to it), so the partition column is implied by the
    folder. ``check`` gets the written rows before they are published and stops the commit by
    raising; ``facts`` (read after the write) go into the manifest."""
    spark, name = df.sparkSession, uuid.uuid4().hex
    place = data_path(target, month, name)
    try:
        df.drop("invoice_month").write.mode("errorifexists").parquet(place)
        if check is not None:
            check(spark.read.parquet(place))
        text = json.dumps({"version": name, "written": time.time(), "facts": facts() if facts else {}}, default=str)
        number = max(_numbers(spark, target, month), default=0) + 1
        while not put_new(spark, _manifest_path(target, month, number), text):
            number += 1
    except BaseException:
        _try_remove(spark, place)
        raise
    for old in versions(spark, target, month)[KEPT_VERSIONS:]:
        if _try_remove(spark, data_path(target, month, old.name)):
            _try_remove(spark, _manifest_path(target, month, old.number))
    return Version(int(month), number, name, {})


def _try_remove(spark: SparkSession, path: str) -> bool:
    """Clean-up, which may be tried again at the next commit."""
    try:
        fs, p = file_system(spark, path)
        return fs.delete(p, True) or not fs.exists(p)
    except Exception:
        return False


def remove_abandoned(spark: SparkSession, target: str, older_than_hours: float = 168.0) -> int:
    """Deletes version folders that no manifest names and that are older than any run can last."""
    gone, limit = 0, (time.time() - older_than_hours * 3600) * 1000
    for month in (int(n.split("=")[1]) for n in _listed(spark, f"{target.rstrip('/')}/_data") if n.startswith("invoice_month=")):
        named = {v.name for v in versions(spark, target, month)}
        for name in _listed(spark, f"{target.rstrip('/')}/_data/{_month_dir(month)}"):
            fs, p = file_system(spark, data_path(target, month, name))
            if name not in named and fs.getFileStatus(p).getModificationTime() < limit:
                gone += _try_remove(spark, data_path(target, month, name))
    return gone
