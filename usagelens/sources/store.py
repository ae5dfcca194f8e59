"""Small files on the shared store, and a lease that lets one run work at a time."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

LEASE_SECONDS = 3600  # --- fixed value: how long a run may take


def _at(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The file system that holds a path, and the path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly under a folder; none if there is no such folder."""
    fs, where = _at(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(where)) if fs.exists(where) else []


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file that must not be there yet; False if it is. Of several callers one succeeds."""
    fs, where = _at(spark, path)
    try:
        out = fs.create(where, False)
    except Py4JJavaError as error:
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def read(spark: SparkSession, path: str) -> str:
    fs, where = _at(spark, path)
    stream = fs.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)


@dataclass(frozen=True)
class Lease:
    """The right to work on a folder until a time."""

    spark: SparkSession
    folder: str
    number: int

    def is_mine(self) -> bool:
        """Whether no later run has taken over; to be asked before results become visible."""
        return _latest(self.spark, self.folder) == self.number

    def release(self) -> None:
        create(self.spark, f"{self.folder}/{self.number:012d}.released", "")


def _latest(spark: SparkSession, folder: str) -> int:
    return max((int(n) for n in names(spark, folder) if n.isdigit()), default=0)


def acquire(spark: SparkSession, folder: str, seconds: float = LEASE_SECONDS, now: float | None = None) -> Lease | None:
    """A lease on a folder, or None while another run has it.

    Leases are numbered files. The next number may be taken when the last is
    released or past its time, and only one caller can create it, so that two runs
    that both find a lease expired do not both get the next one.
    """
    now = time.time() if now is None else now
    last = _latest(spark, folder)
    if last:
        text = read(spark, f"{folder}/{last:012d}")
        held = f"{last:012d}.released" not in names(spark, folder)
        # A file that is still empty belongs to a run that has just begun.
        if held and (not text or json.loads(text)["until"] > now):
            return None
    told = json.dumps({"owner": uuid.uuid4().hex, "until": now + seconds})
    return Lease(spark, folder, last + 1) if create(spark, f"{folder}/{last + 1:012d}", told) else None


@contextmanager
def one_at_a_time(spark: SparkSession, folder: str, seconds: float = LEASE_SECONDS) -> Iterator[Lease | None]:
    """The lease for the length of a block; None if another run has it, in which case the block should do nothing."""
    lease = acquire(spark, folder, seconds)
    try:
        yield lease
    finally:
        if lease:
            lease.release()
