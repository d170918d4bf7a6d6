"""Exchange some files of a folder; the others stay where they are.

New files are written to a folder below the table's, whose name readers pass over.  A marker there names the files
that go; with the rename that gives the marker its name the change is decided.  ``finish`` then moves the new files in and
deletes the old ones.  Whatever interrupts it, the next ``finish`` goes on: decided changes are completed, others are
dropped.  One writer at a time.  A reader that listed the folder before has to list it again, and one that lists it
during the moves may see both old and new files: a table that is read meanwhile is better replaced by a new version.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

from tableferry.sinks.files import _path, delete_path

CHANGES = "_changes_"
_DECIDED, _FILES = "decided", "files"
# Renames and deletions that are under way at once.
AT_ONCE = 16


def begin(spark: SparkSession, folder: str) -> str:
    """A new change of a folder; write its files to ``new_files`` of it."""
    return f"{folder.rstrip('/')}/{CHANGES}{uuid.uuid4().hex}"


def new_files(change: str) -> str:
    return f"{change}/{_FILES}"


def decide(spark: SparkSession, change: str, removed: Sequence[str]) -> None:
    """From here on the change takes place; ``removed`` are the files that go, as paths below the folder."""
    draft, system = _path(spark, f"{change}/{_DECIDED}.draft")
    out = system.create(draft, True)
    out.write("".join(f"{name}\n" for name in removed).encode())
    out.close()
    if not system.rename(draft, _path(spark, f"{change}/{_DECIDED}")[0]):
        raise OSError(f"{change} could not be decided")


def files_below(spark: SparkSession, folder: str) -> Iterator[str]:
    """The data files below a folder, as paths below it; names that readers pass over are left out, but for the first level's."""
    root, system = _path(spark, folder)
    if not system.exists(root):
        return
    prefix = root.toString().rstrip("/") + "/"
    found = system.listFiles(root, True)
    while found.hasNext():
        path = found.next().getPath().toString().removeprefix(prefix)
        if not path.rsplit("/", 1)[-1].startswith(("_", ".")):
            yield path


def _lines(spark: SparkSession, path: str) -> list[str]:
    found, system = _path(spark, path)
    stream = system.open(found)
    try:
        return bytes(stream.readAllBytes()).decode().splitlines()
    finally:
        stream.close()


def finish(spark: SparkSession, folder: str) -> int:
    """Complete the decided changes of a folder and drop the others; the number completed."""
    root, system = _path(spark, folder)
    if not system.exists(root):
        return 0
    changes = [s.getPath().toString() for s in system.listStatus(root) if s.getPath().getName().startswith(CHANGES)]
    completed = 0
    for change in changes:
        if system.exists(_path(spark, f"{change}/{_DECIDED}")[0]):
            moves = list(files_below(spark, new_files(change)))
            for parent in {m.rpartition("/")[0] for m in moves}:
                system.mkdirs(_path(spark, f"{folder}/{parent}" if parent else folder)[0])

            def move(name: str, change: str = change) -> None:
                if not system.rename(_path(spark, f"{new_files(change)}/{name}")[0], _path(spark, f"{folder}/{name}")[0]):
                    raise OSError(f"{new_files(change)}/{name} could not be moved to {folder}")

            with ThreadPoolExecutor(AT_ONCE) as pool:
                list(pool.map(move, moves))
                list(pool.map(lambda name: delete_path(spark, f"{folder}/{name}"), _lines(spark, f"{change}/{_DECIDED}")))
            completed += 1
        delete_path(spark, change)
    return completed
