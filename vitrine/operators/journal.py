"""Changes of several tables that take place together or not at all, over plain folders of files.

A change is written beside the tables first. Its commit is one small file, the journal, that lists which folders move where and which go; from then on
it is carried through by whoever comes next, however often its writer dies. Whatever a dead writer had staged without a journal is thrown away.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession


class Files:
    """The few calls that change a store; tests count them and break off at each."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.fs = self.path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)

    def exists(self, name: str) -> bool:
        return self.fs.exists(self.path(name))

    def step(self, what: str) -> None:
        """Called before each change of the store."""

    def delete(self, name: str) -> None:
        if self.exists(name):
            self.step(f"delete {name}")
            self.fs.delete(self.path(name), True)

    def rename(self, old: str, new: str) -> None:
        self.step(f"rename {old}")
        parent = self.path(new).getParent()
        self.fs.mkdirs(parent)
        if not self.fs.rename(self.path(old), self.path(new)):
            raise OSError(f"cannot move {old} to {new}")

    def write(self, name: str, text: str) -> None:
        """The file appears whole or not at all."""
        self.step(f"write {name}")
        out = self.fs.create(self.path(f"{name}.part"), True)
        out.write(bytearray(text.encode()))
        out.close()
        self.rename(f"{name}.part", name)

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def names(self, folder: str) -> list[str]:
        """Names in a folder, in order; none if it isn't there."""
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(folder))) if self.exists(folder) else []

    def leaves(self, folder: str, depth: int) -> list[str]:
        """Folders so many levels below, relative to it."""
        found = self.fs.globStatus(self.path(folder + "/*" * depth))
        names = ["/".join(s.getPath().toString().rsplit("/", depth)[1:]) for s in found]
        return sorted(n for n in names if not n.startswith(("_", ".")))


class Journal:
    """The changes below ``root``, one writer at a time. On stores without renames (object stores) each move is a copy."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark, root)

    def recover(self) -> None:
        """Carries committed changes through, and throws staged ones away."""
        for name in self.files.names(f"{self.root}/_journal"):
            if name.endswith(".json"):
                self.carry_out(f"{self.root}/_journal/{name}")
            else:
                self.files.delete(f"{self.root}/_journal/{name}")
        self.files.delete(f"{self.root}/_staged")

    def pending(self) -> bool:
        return bool(self.files.names(f"{self.root}/_journal"))

    def carry_out(self, journal: str) -> None:
        """Each step may have been done before: a folder that is no longer staged stands in its place."""
        change = json.loads(self.files.read(journal))
        for old, new in change["moves"]:
            if self.files.exists(old):
                self.files.delete(new)
                self.files.rename(old, new)
        for path in change["drops"]:
            self.files.delete(path)
        self.files.delete(journal)

    def begin(self) -> Change:
        self.recover()
        return Change(self)


class Change:
    """What one commit will do."""

    def __init__(self, journal: Journal):
        self.journal, self.moves, self.drops = journal, {}, []
        self.stage = f"{journal.root}/_staged/{uuid.uuid4().hex}"

    def folder(self, name: str) -> str:
        """A staged folder for what is to be moved later."""
        return f"{self.stage}/{name}"

    def move(self, staged: str, path: str) -> None:
        """``path`` is replaced by the staged folder."""
        self.moves[path] = staged

    def drop(self, path: str) -> None:
        self.drops.append(path)

    def replace(self, df: DataFrame, path: str) -> DataFrame:
        """Stages a whole table; returns what is staged."""
        staged = self.folder(f"table-{len(self.moves)}-{uuid.uuid4().hex[:8]}")
        df.write.parquet(staged)
        self.move(staged, path)
        return self.journal.spark.read.schema(df.schema).parquet(staged)

    def replace_partitions(self, df: DataFrame, path: str, by: Iterable[str], dropped: Iterable[str] = (), rows_per_file: int = 1_000_000) -> str:
        """Stages the partitions that ``df`` has rows for, whole; each replaces that of the table, others keep their files. ``dropped`` names folders
        (like ``a=1/b=2``) that go if ``df`` has nothing for them. Returns the staged folder.

        ``rebalance`` brings a partition's rows together without pinning a large one to one task."""
        by, staged = list(by), self.folder(f"parts-{uuid.uuid4().hex[:8]}")
        df.hint("rebalance", *by).write.option("maxRecordsPerFile", rows_per_file).partitionBy(*by).parquet(staged)
        new = self.journal.files.leaves(staged, len(by))
        for leaf in new:
            self.move(f"{staged}/{leaf}", f"{path}/{leaf}")
        self.drops += [f"{path}/{leaf}" for leaf in sorted(set(dropped) - set(new))]
        return staged

    def commit(self) -> None:
        journal = f"{self.journal.root}/_journal/{uuid.uuid4().hex}.json"
        self.journal.files.write(journal, json.dumps({"moves": [[old, new] for new, old in self.moves.items()], "drops": self.drops}))
        self.journal.carry_out(journal)
        self.journal.files.delete(self.stage)
