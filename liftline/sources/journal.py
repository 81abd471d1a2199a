"""Folders that change together: a journal is written before the first move and a commit mark after the last.

``publish`` moves staged folders to their places under a root. Until the mark is there, ``recover`` takes every move back; from then on it
only cleans up. So whenever a driver dies, the next start finds all folders old or all new.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

JOURNAL, STAGED, PREVIOUS = "_journal", "_staged", "_previous"


class Folders:
    """The few file system calls a load needs, on paths below one root."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm, self.root = spark.sparkContext._jvm, root.rstrip("/")
        self._path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, path: str):
        return self._path(f"{self.root}/{path}")

    def exists(self, path: str) -> bool:
        return self._fs.exists(self.at(path))

    def names(self, path: str) -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self.at(path))) if self.exists(path) else []

    def size(self, path: str) -> int:
        return self._fs.getContentSummary(self.at(path)).getLength()

    def delete(self, path: str) -> None:
        self._fs.delete(self.at(path), True)

    def move(self, source: str, target: str) -> None:
        self._fs.mkdirs(self.at(target).getParent())
        if not self._fs.rename(self.at(source), self.at(target)):
            raise OSError(f"could not move {source} to {target} under {self.root}")

    def write(self, path: str, text: str) -> None:
        """The whole text or no file: written beside its place and moved there."""
        out = self._fs.create(self.at(f"{path}.part"), True)
        out.write(bytearray(text.encode()))
        out.close()
        self.move(f"{path}.part", path)

    def read(self, path: str) -> str:
        stream = self._fs.open(self.at(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()


def publish(folders: Folders, run: str, paths: list[str]) -> None:
    """Move the folders staged by a run into place, all or none. A move that fails takes the others back and raises."""
    moves = [[path, folders.exists(path)] for path in paths]
    folders.write(f"{JOURNAL}/{run}.json", json.dumps(moves))
    try:
        for path, existed in moves:
            if existed:
                folders.move(path, f"{PREVIOUS}/{run}/{path}")
            folders.move(f"{STAGED}/{run}/{path}", path)
    except Exception:
        _take_back(folders, run)
        raise
    folders.write(f"{JOURNAL}/{run}.done", "")
    _clean(folders, run)


def _take_back(folders: Folders, run: str) -> list[str]:
    """Undo the moves of a run that never got its mark. May itself be cut short and begun again."""
    back = []
    for path, existed in reversed(json.loads(folders.read(f"{JOURNAL}/{run}.json"))):
        if existed and folders.exists(f"{PREVIOUS}/{run}/{path}"):
            folders.delete(path)
            folders.move(f"{PREVIOUS}/{run}/{path}", path)
            back.append(path)
        elif not existed and not folders.exists(f"{STAGED}/{run}/{path}"):
            folders.delete(path)  # it was new and had been put in place
            back.append(path)
    # the journal goes before what it needs to tell a new folder in place from one still staged
    folders.delete(f"{JOURNAL}/{run}.json")
    _clean(folders, run)
    return back


def _clean(folders: Folders, run: str) -> None:
    for path in (f"{PREVIOUS}/{run}", f"{STAGED}/{run}", f"{JOURNAL}/{run}.json", f"{JOURNAL}/{run}.done"):
        folders.delete(path)


def recover(folders: Folders) -> list[str]:
    """End what a dead driver began: take back runs without a mark, clean up after those with one. Gives the paths taken back."""
    back = []
    there = folders.names(JOURNAL)
    for name in there:
        run, kind = name.rsplit(".", 1)
        if kind == "json":
            if f"{run}.done" in there:
                _clean(folders, run)
            else:
                back += _take_back(folders, run)
    # no journal is left: the rest was staged and never moved, or belongs to runs that ended
    for path in (PREVIOUS, STAGED, JOURNAL):
        folders.delete(path)
    return back
