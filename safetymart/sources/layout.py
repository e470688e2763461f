"""The dated folder layout, and the few file-system calls it needs.

Paths go through Hadoop's file-system API, so that local folders, HDFS and
object stores work alike.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from datetime import date, datetime, timezone

from pyspark.sql import SparkSession

_DAY = re.compile(r"year=(\d{4})/month=(\d{2})/day=(\d{2})/?$")


class MissingFeedError(FileNotFoundError):
    """A feed has no data for the day asked for."""


def as_day(day: date | str | None) -> date:
    """A date from a date or ISO text; today in UTC when nothing is given."""
    if day is None:
        return datetime.now(timezone.utc).date()
    return date.fromisoformat(day) if isinstance(day, str) else day


def feed_dir(base: str, feed: str) -> str:
    return f"{base.rstrip('/')}/raw/{feed}"


def silver_dir(base: str, dataset: str = "recalls") -> str:
    return f"{base.rstrip('/')}/silver/{dataset}"


def day_dir(folder: str, day: date | str | None) -> str:
    return f"{folder}/{as_day(day):year=%Y/month=%m/day=%d}"


def _fs(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    return fs, hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _fs(spark, path)
    return fs.exists(hadoop_path)


def delete_dir(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _fs(spark, path)
    fs.delete(hadoop_path, True)


def empty_files(spark: SparkSession, path: str | list[str]) -> list[str]:
    """Files without a byte at or directly below ``path``; Spark's own marks aside."""
    found = []
    for one in [path] if isinstance(path, str) else path:
        fs, pattern = _fs(spark, one)
        for top in fs.globStatus(pattern) or []:
            for s in fs.listStatus(top.getPath()) if top.isDirectory() else [top]:
                hidden = s.getPath().getName().startswith(("_", "."))
                if s.isFile() and s.getLen() == 0 and not hidden:
                    found.append(s.getPath().toString())
    return found


def list_days(spark: SparkSession, folder: str) -> list[date]:
    """Days present below ``folder``, oldest first, from a listing of folders only."""
    fs, pattern = _fs(spark, f"{folder}/year=*/month=*/day=*")
    found = [_DAY.search(s.getPath().toString()) for s in fs.globStatus(pattern) or []]
    return sorted(date(*map(int, m.groups())) for m in found if m)


def resolve_day(
    spark: SparkSession, folder: str, day: date | str | None, as_of: bool = False
) -> date:
    """The day to read: exactly ``day``, or with ``as_of`` the latest up to it."""
    wanted = as_day(day)
    if not as_of:
        if exists(spark, day_dir(folder, wanted)):
            return wanted
        raise MissingFeedError(f"no data for {wanted} in {folder}")
    earlier = [d for d in list_days(spark, folder) if d <= wanted]
    if not earlier:
        raise MissingFeedError(f"no data up to {wanted} in {folder}")
    return earlier[-1]


def hidden_beside(path: str) -> tuple[str, str]:
    """Two new names next to ``path``, for its next and its previous content.

    Names that start with a dot are invisible to Spark's readers.
    """
    head, slash, name = path.rstrip("/").rpartition("/")
    run = uuid.uuid4().hex
    return f"{head}{slash}.{name}.new-{run}", f"{head}{slash}.{name}.old-{run}"


def replace_dir(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Let ``write`` fill a new folder beside ``path``, then swap it in.

    A job that fails half-way leaves the old data alone, and the data being
    replaced may be read while the new is written. The swap is two renames; on
    an object store a rename is a copy, and a table format with atomic commits
    is the better target there.
    """
    fresh, retired = hidden_beside(path)
    try:
        write(fresh)
        swap_in(spark, fresh, path, retired)
    except BaseException:
        delete_dir(spark, fresh)
        raise


def swap_in(spark: SparkSession, fresh: str, path: str, retired: str) -> None:
    """Make ``fresh`` the content of ``path``; a failed swap is undone."""
    had_data = exists(spark, path)
    if had_data:
        _rename(spark, path, retired)
    try:
        _rename(spark, fresh, path)
    except BaseException:
        if had_data:
            _rename(spark, retired, path)
        raise
    if had_data:
        delete_dir(spark, retired)


# Empty files in this folder say which version of a dataset readers are to use.
PUBLISHED = "_published"
_MARK = re.compile(r"^(\d{12})-(.+)$")


def _marks(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    fs, path = _fs(spark, f"{folder}/{PUBLISHED}")
    if not fs.exists(path):
        return []
    found = [_MARK.match(s.getPath().getName()) for s in fs.listStatus(path)]
    return sorted((int(m[1]), m[2]) for m in found if m)


def new_version(folder: str) -> tuple[str, str]:
    """A name for the next content of ``folder`` and its path; no reader sees it yet."""
    version = f"version-{uuid.uuid4().hex}"
    return version, f"{folder.rstrip('/')}/{version}"


def published(spark: SparkSession, folder: str) -> str:
    """The path of the version of ``folder`` that was published last."""
    folder = folder.rstrip("/")
    marks = _marks(spark, folder)
    if not marks:
        raise MissingFeedError(f"nothing is published in {folder}")
    return f"{folder}/{marks[-1][1]}"


def publish(spark: SparkSession, folder: str, version: str, keep: int = 2) -> None:
    """Make ``version`` what readers of ``folder`` get, by one new empty file.

    A file is there or not, on object stores as well; nothing is renamed or copied. A
    publication at the same time that took this number makes this one take the next.
    The last ``keep`` versions stay, for those who still read them.
    """
    folder = folder.rstrip("/")
    while True:
        marks = _marks(spark, folder)
        number = marks[-1][0] + 1 if marks else 1
        fs, mark = _fs(spark, f"{folder}/{PUBLISHED}/{number:012d}-{version}")
        fs.mkdirs(mark.getParent())
        fs.create(mark, False).close()
        if [v for n, v in _marks(spark, folder) if n == number] == [version]:
            break
        fs.delete(mark, False)
    for n, old in _marks(spark, folder)[:-keep]:
        delete_dir(spark, f"{folder}/{old}")
        delete_dir(spark, f"{folder}/{PUBLISHED}/{n:012d}-{old}")


def _rename(spark: SparkSession, source: str, target: str) -> None:
    fs, target_path = _fs(spark, target)
    fs.mkdirs(target_path.getParent())
    if not fs.rename(_fs(spark, source)[1], target_path):
        raise OSError(f"could not rename {source} to {target}")
