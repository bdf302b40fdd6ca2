"""One writer at a time over a shared folder: a lease with an owner and an end.

The lease is a folder that holds its owner.  It comes into being by the rename of
a folder that was written before, which a file system does in one step and for one
of several writers; who got it is then read back from the folder itself, so a
writer that lost finds another owner.  A lease that ran out is first moved aside,
again by a rename, and then taken like a free one.  Object stores without an
atomic rename of folders need a lock service instead.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Held(RuntimeError):
    """Another writer holds the lease."""


@dataclass
class Lease:
    """A lease on ``folder`` for ``seconds`` at a time; ``clock`` gives the time in seconds."""

    spark: SparkSession
    folder: str
    seconds: float = 600.0
    owner: str = field(default_factory=lambda: uuid.uuid4().hex)
    clock: object = time.time

    def __post_init__(self) -> None:
        jvm = self.spark._jvm
        self._path = lambda name: jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        self._fs = self._path("_lease").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _write(self, name: str, content: dict) -> None:
        out = self._fs.create(self._path(name), True)
        try:
            out.write(bytearray(json.dumps(content).encode()))
        finally:
            out.close()

    def _read(self, name: str) -> dict | None:
        path = self._path(name)
        if not self._fs.exists(path):
            return None
        stream = self._fs.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode() or "null")
        finally:
            stream.close()

    def _renamed(self, name: str, to: str) -> bool:
        try:
            return self._fs.rename(self._path(name), self._path(to))
        except Py4JJavaError:  # another writer moved one of them meanwhile
            return False

    def holder(self) -> tuple[str, float] | None:
        """(owner, end) of the lease as it stands; a renewal counts from its owner only."""
        first = self._read("_lease/owner")
        if first is None:
            return None
        renewed = self._read(f"_lease/renewed-{first['owner']}") or first
        return first["owner"], renewed["end"]

    def acquire(self) -> Lease:
        """Take the lease or raise ``Held``."""
        now = self.clock()
        found = self.holder()
        if found and found[0] == self.owner and found[1] > now:
            return self
        if found and found[1] > now:
            raise Held(f"{found[0]} holds {self.folder} for {found[1] - now:.0f} seconds more")
        if found:
            # One of several writers moves it; a folder that was just taken again isn't the one that ran out, so it goes back.
            aside = f"_ended/{uuid.uuid4().hex}"
            self._fs.mkdirs(self._path("_ended"))
            if self._renamed("_lease", aside):
                moved = self._read(f"{aside}/owner")
                if moved and moved["owner"] != found[0]:
                    self._renamed(aside, "_lease")
                else:
                    self._fs.delete(self._path(aside), True)
        fresh = f"_wanted/{self.owner}-{uuid.uuid4().hex}"
        self._write(f"{fresh}/owner", {"owner": self.owner, "end": now + self.seconds})
        if not self._fs.exists(self._path("_lease")):
            self._renamed(fresh, "_lease")
        self._fs.delete(self._path(fresh), True)
        found = self.holder()
        if not found or found[0] != self.owner:
            raise Held(f"{found[0] if found else 'another writer'} took {self.folder} first")
        return self

    def renew(self) -> None:
        """Hold on for another term; raises ``Held`` if the lease ran out and went to another."""
        self.check()
        self._write(f"_lease/renewed-{self.owner}", {"owner": self.owner, "end": self.clock() + self.seconds})
        self.check()

    def check(self) -> None:
        """Raise ``Held`` unless this writer's term still runs."""
        found = self.holder()
        if not found or found[0] != self.owner:
            raise Held(f"the lease on {self.folder} is lost")
        if found[1] <= self.clock():
            raise Held(f"the lease on {self.folder} ran out")

    def release(self) -> None:
        found = self.holder()
        if found and found[0] == self.owner:
            self._fs.delete(self._path("_lease"), True)

    @contextmanager
    def held(self) -> Iterator[Lease]:
        self.acquire()
        try:
            yield self
        finally:
            self.release()
