"""Staged publish of lake partitions: written beside the lake, swapped under a journal, resumed or undone.

A plain overwrite of many partitions that stops half-way leaves some days old and some new, and nothing says which. Here a
run works in a folder of its own below ``<lake>/_staging`` (readers skip names with an underscore):

1. the new partitions are written below the run's folder; the lake is not touched;
2. a journal names every swap: the folder to replace, where its new content is, where its old content goes. It is
   written to a temporary name and renamed, so it is there whole or not at all;
3. each swap renames the old folder into the run's folder and the new one into its place. Both are metadata operations, and which
   of them are done can be read off the folders, so no step needs a record of its own;
4. the journal is renamed to say that all is done, and the run's folder is removed.

``recover`` looks at what runs have left: without a journal nothing was published and the staged files go; with one, the swaps
are carried on from where they stopped (``"resume"``) or all taken back (``"undo"``); with a journal that says done, only the
clean-up is left. It may itself be stopped anywhere and run again. One journal can cover several roots (a lake and its
key index), which then change together.

Folders are swapped one after the other by the driver, two renames each: their number is that of the affected days (and
index buckets), not of the rows. While a folder is swapped, a reader may find it missing for the moment between two
renames. Renaming a folder must be atomic, as on HDFS and local disks; object stores without it give no such guarantee.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import asdict, dataclass

from pyspark.sql import SparkSession

from .lake import hadoop_fs

STAGING = "_staging"
JOURNAL, DONE = "journal.json", "done.json"


@dataclass(frozen=True)
class Swap:
    """One folder to replace; without ``new`` it is only removed."""

    target: str
    old: str
    had_old: bool
    new: str | None = None


class Files:
    """The folder operations needed, on any Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.fs, _ = hadoop_fs(spark, path)
        self.path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.path(path))

    def folders(self, path: str) -> list[str]:
        """Names of the folders in a folder, none if it does not exist."""
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(path)) if s.isDirectory())

    def rename(self, source: str, target: str) -> None:
        to = self.path(target)
        self.fs.mkdirs(to.getParent())
        if not self.fs.rename(self.path(source), to):
            raise OSError(f"could not rename {source} to {target}")

    def remove(self, path: str) -> None:
        self.fs.delete(self.path(path), True)

    def remove_empty(self, path: str) -> None:
        """Remove a folder unless something is in it, also if that comes in just now."""
        p = self.path(path)
        try:
            if self.fs.exists(p) and not self.fs.listStatus(p):
                self.fs.delete(p, False)
        except Exception:  # noqa: BLE001 - another run has begun to use it, or has removed it
            pass

    def sizes(self, path: str, suffix: str = ".parquet") -> dict[str, int]:
        """Bytes of each data file in a folder, by name."""
        if not self.exists(path):
            return {}
        found = [(s.getPath().getName(), s.getLen()) for s in self.fs.listStatus(self.path(path)) if s.isFile()]
        return {n: size for n, size in found if n.endswith(suffix) and not n.startswith(("_", "."))}

    def prune(self, path: str, root: str) -> None:
        """Remove the empty folders above ``path``, up to ``root``."""
        p = self.path(path).getParent()
        while str(p.toString()).startswith(root.rstrip("/") + "/") and self.fs.exists(p) and not self.fs.listStatus(p):
            self.fs.delete(p, False)
            p = p.getParent()

    def read(self, path: str) -> str:
        stream = self.fs.open(self.path(path))
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """The whole file or nothing: written under another name, then renamed."""
        part = f"{path}.{uuid.uuid4().hex}.part"
        out = self.fs.create(self.path(part))
        out.write(bytearray(text.encode()))
        out.close()
        self.remove(path)
        self.rename(part, path)


def partition_folders(files: Files, root: str, depth: int) -> list[str]:
    """Relative folders ``a=1/b=2/..`` of the given depth below ``root``."""
    found = [""]
    for _ in range(depth):
        found = [f"{f}/{n}".lstrip("/") for f in found for n in files.folders(f"{root}/{f}") if "=" in n]
    return found


class Run:
    """One publish below a root folder. ``step`` is called before every change, with its name (for tests)."""

    def __init__(self, spark: SparkSession, root: str, name: str | None = None, step: Callable[[str], None] | None = None):
        self.root = root.rstrip("/")
        self.files = Files(spark, self.root)
        self.name = name or uuid.uuid4().hex
        self.folder = f"{self.root}/{STAGING}/{self.name}"
        self.step = step or (lambda _: None)
        self.swaps: list[Swap] = []

    def stage(self, root: str | None = None) -> str:
        """Where the new partitions of a root go (by default the run's own root)."""
        return f"{(root or self.root).rstrip('/')}/{STAGING}/{self.name}/new"

    def replace(self, partitions: Iterable[str], depth: int, root: str | None = None) -> tuple[list[str], list[str]]:
        """Plan to put each of the partitions' staged content in place, and to remove those without any.

        Returns the partitions (relative folders) that get content, and those that do not.
        """
        root = (root or self.root).rstrip("/")
        staged = set(partition_folders(self.files, self.stage(root), depth))
        asked = set(partitions)
        if staged - asked:
            raise ValueError(f"staged partitions outside the asked ones: {sorted(staged - asked)[:3]}")
        for p in sorted(asked):
            target = f"{root}/{p}"
            had = self.files.exists(target)
            if had or p in staged:
                self.swaps.append(Swap(target, f"{root}/{STAGING}/{self.name}/old/{p}", had, f"{self.stage(root)}/{p}" if p in staged else None))
        return sorted(staged), sorted(asked - staged)

    def add(self, folder: str, names: str) -> list[str]:
        """Plan to put the staged data files of a partition beside those it has, as ``<names>-<number>.parquet``."""
        added = []
        for i, name in enumerate(sorted(self.files.sizes(f"{self.stage()}/{folder}"))):
            target = f"{folder}/{names}-{i:05d}.parquet"
            self.swaps.append(Swap(f"{self.root}/{target}", f"{self.root}/{STAGING}/{self.name}/old/{target}", False, f"{self.stage()}/{folder}/{name}"))
            added.append(target)
        return added

    def drop(self, paths: Iterable[str]) -> None:
        """Plan to remove files (relative to the root)."""
        self.swaps += [Swap(f"{self.root}/{p}", f"{self.root}/{STAGING}/{self.name}/old/{p}", True) for p in paths]

    def publish(self) -> None:
        self.step("journal")
        roots = sorted({s.target.rpartition(f"/{p}")[0] for s in self.swaps for p in [_relative(s, self.name)]} | {self.root})
        self.files.write(f"{self.folder}/{JOURNAL}", json.dumps({"roots": roots, "swaps": [asdict(s) for s in self.swaps]}))
        self._forward(self.swaps, roots)

    def _forward(self, swaps: list[Swap], roots: list[str]) -> None:
        for s in swaps:
            if s.had_old and not self.files.exists(s.old) and self.files.exists(s.target):
                self.step(f"set aside {s.target}")
                self.files.rename(s.target, s.old)
            if s.new and self.files.exists(s.new):
                self.step(f"put in place {s.target}")
                self.files.rename(s.new, s.target)
            elif not s.new:
                self.files.prune(s.target, next(r for r in roots if s.target.startswith(r + "/")))
        self.step("done")
        self.files.rename(f"{self.folder}/{JOURNAL}", f"{self.folder}/{DONE}")
        self._clean(roots)

    def _back(self, swaps: list[Swap], roots: list[str]) -> None:
        for s in reversed(swaps):
            if s.new and not self.files.exists(s.new) and self.files.exists(s.target):
                self.step(f"take back {s.target}")
                self.files.rename(s.target, s.new)
            if s.had_old and self.files.exists(s.old):
                self.step(f"restore {s.target}")
                self.files.rename(s.old, s.target)
            if not s.had_old:
                self.files.prune(s.target, next(r for r in roots if s.target.startswith(r + "/")))
        self.step("undone")
        self.files.rename(f"{self.folder}/{JOURNAL}", f"{self.folder}/{DONE}")
        self._clean(roots)

    def _clean(self, roots: list[str]) -> None:
        # the folder with the journal last: while it is there, a stopped clean-up is found again
        for root in [r for r in roots if r != self.root] + [self.root]:
            self.step(f"clean {root}")
            self.files.remove(f"{root}/{STAGING}/{self.name}")
            self.files.remove_empty(f"{root}/{STAGING}")

    def recover(self, mode: str) -> str:
        if self.files.exists(f"{self.folder}/{DONE}"):
            self._clean(json.loads(self.files.read(f"{self.folder}/{DONE}"))["roots"])
            return "cleaned"
        if not self.files.exists(f"{self.folder}/{JOURNAL}"):
            self._clean([self.root])
            return "discarded"
        entry = json.loads(self.files.read(f"{self.folder}/{JOURNAL}"))
        swaps = [Swap(**s) for s in entry["swaps"]]
        if mode == "resume":
            self._forward(swaps, entry["roots"])
            return "resumed"
        self._back(swaps, entry["roots"])
        return "undone"


def _relative(swap: Swap, run: str) -> str:
    return swap.old.partition(f"/{STAGING}/{run}/old/")[2]


def pending(spark: SparkSession, root: str) -> list[str]:
    """Names of the runs that have left something below ``root``."""
    return Files(spark, root).folders(f"{root.rstrip('/')}/{STAGING}")


def recover(spark: SparkSession, root: str, mode: str = "resume", also: Iterable[str] = (),
            step: Callable[[str], None] | None = None, prefix: str = "") -> dict[str, str]:
    """Bring what earlier runs have left below ``root`` to an end: run -> resumed, undone, discarded or cleaned.

    ``also``: other roots that runs of this one stage in (a key index); what a run without a journal staged there goes
    as well. Not for use while such a run is at work: with ``prefix``, only runs of that name are looked at, so that
    jobs which change different files may work side by side.
    """
    if mode not in ("resume", "undo"):
        raise ValueError(f"unknown mode {mode!r}: resume or undo")
    out = {name: Run(spark, root, name, step).recover(mode) for name in pending(spark, root) if name.startswith(prefix)}
    for other in also:
        for name in (n for n in pending(spark, other) if n.startswith(prefix)):
            Run(spark, other, name, step).recover(mode)
    return out
