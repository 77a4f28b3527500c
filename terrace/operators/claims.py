"""One writer at a time at the switch of a table, also across drivers, and switches that a crash cut short."""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

CLAIM = "_claim"  # a file below the table's path; Spark reads no files whose names start so
TAKEN = "_taken-"  # claims of writers that are taken for dead
WAIT = 120.0  # seconds to wait for another writer
STALE = 600.0  # seconds after which the writer of a claim is taken for dead
POLL = 0.05


_creating = threading.Lock()


class TableBusy(RuntimeError):
    """Another writer has kept its claim on the table for too long; nothing was switched."""


class Folder:
    """A folder on a file system that all drivers see."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.path = spark._jvm, path
        self.fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def create(self, name: str, text: str) -> bool:
        """Write a new file; False if there is one."""
        with _creating:  # a local file system looks first and creates then
            try:
                out = self.fs.create(self._at(name), False)
            except Py4JJavaError as error:
                if "AlreadyExists" in error.java_exception.getClass().getName():
                    return False
                raise
        out.write(text.encode())
        out.close()
        return True

    def read(self, name: str) -> str | None:
        """The text of a file; None if there is none."""
        try:
            file = self.fs.open(self._at(name))
        except Py4JJavaError:
            return None
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(file, "UTF-8")
        finally:
            file.close()

    def age(self, name: str) -> float | None:
        """Seconds since a file was written; None if there is none."""
        try:
            return time.time() - self.fs.getFileStatus(self._at(name)).getModificationTime() / 1000
        except Py4JJavaError:
            return None

    def rename(self, name: str, new: str) -> bool:
        try:
            return self.fs.rename(self._at(name), self._at(new))
        except Py4JJavaError:
            return False

    def delete(self, name: str) -> None:
        self.fs.delete(self._at(name), True)

    def names(self, inner: str = "") -> list[str]:
        """What lies in the folder, or in one of its folders."""
        if not self.fs.exists(self._at(inner)):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self._at(inner)))

    def is_folder(self, name: str) -> bool:
        return self.fs.exists(self._at(name)) and self.fs.getFileStatus(self._at(name)).isDirectory()


def settle(spark: SparkSession, path: str, finish: Callable[[dict], None]) -> None:
    """Finish the switch of a writer that died on the way, if there is one."""
    folder = Folder(spark, path)
    names = folder.names()
    stale = CLAIM in names and (folder.age(CLAIM) or 0.0) > STALE
    if stale or any(n.startswith(TAKEN) for n in names):
        with claim(spark, path, {}, finish):
            pass


@contextmanager
def claim(spark: SparkSession, path: str, intent: dict, finish: Callable[[dict], None]) -> Iterator[Callable[[], bool]]:
    """Hold the claim on a table's path; yields a function that tells whether it is still held.

    The claim is a file that only one writer can create, and names what its writer is
    about to switch. A claim older than ``STALE`` seconds is moved aside, and
    whoever holds the next one first calls ``finish`` with the intent found in
    it, before looking at the table for itself.
    """
    folder, mine = Folder(spark, path), json.dumps({"writer": uuid4().hex, "intent": intent})
    until = time.monotonic() + WAIT
    while not folder.create(CLAIM, mine):
        age = folder.age(CLAIM)
        if age is not None and age > STALE:
            folder.rename(CLAIM, f"{TAKEN}{uuid4().hex}")  # one of several that try this succeeds
        elif time.monotonic() > until:
            raise TableBusy(f"another writer holds {path}/{CLAIM}")
        else:
            time.sleep(POLL)
    try:
        for name in folder.names():
            if name.startswith(TAKEN):
                found = json.loads(folder.read(name) or "{}").get("intent")  # empty: its writer died at once
                if found:
                    finish(found)
                folder.delete(name)
        yield lambda: folder.read(CLAIM) == mine
    finally:
        if folder.read(CLAIM) == mine:
            folder.delete(CLAIM)
