"""A versioned table in hash buckets whose state is named by a chain of commits.

Layout under the table's root::

    data/<batch>-<id>/open/bucket=<b>/   open versions of the buckets the batch touched
    data/<batch>-<id>/closed/            versions the batch closed
    data/<batch>-<id>/before/            the same versions as they were: before-images
    commits/<number>.json                the state after one batch

A commit names its parent, the folder that holds each bucket's open versions and the folders of closed
versions in force.  A batch reads and rewrites only the buckets that hold its keys; all
other buckets are taken over from the parent by name.  Readers see what the newest commit names and
nothing else, so data of a run that died before its commit is never read, whatever its batch id,
and publishing is the appearance of one small file.

* A batch that the chain holds already is a rerun: nothing is written.
* A batch older than the newest one is refused (``LateBatchError``): it would put former
  values over newer ones.
* A rollback takes back the newest batch by a commit that names the state of its parent; it is checked
  against the before-images first.

One writer per table at a time.  The commit holds one name per bucket and batch,
so its size depends on neither the rows nor the keys.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dimforge.operators.schema import align_to_schema

BUCKET = "bucket"


class LateBatchError(RuntimeError):
    """The batch is older than the newest one of the table."""


class CommitError(RuntimeError):
    """The chain of commits does not allow the step."""


@dataclass(frozen=True)
class Commit:
    number: int
    batch_id: int
    parent: int | None
    open: dict[str, str]        # bucket -> data folder with its open versions
    closed: tuple[str, ...]     # data folders whose closed versions are in force
    high_water: int
    batches: tuple[int, ...]    # batches in force, oldest first
    undone: int | None = None   # the batch this commit takes back

    def to_json(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    @staticmethod
    def from_json(text: str) -> Commit:
        got = json.loads(text)
        return Commit(**{**got, "closed": tuple(got["closed"]), "batches": tuple(got["batches"])})


@dataclass(frozen=True)
class Staged:
    """Written data of a batch that no commit names yet."""

    batch_id: int
    folder: str
    touched: tuple[int, ...]
    filled: tuple[int, ...]  # touched buckets that still hold open versions
    has_closed: bool
    high_water: int


class VersionedTable:
    """One table.  ``is_open`` is a SQL condition on its columns that holds for open versions."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, keys: Sequence[str], sk: str,
                 is_open: str, buckets: int = 64):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.keys, self.sk, self.is_open, self.buckets = tuple(keys), sk, is_open, buckets

    # ------------------------------------------------------------------ commits

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")

    def _fs(self):
        return self._path("commits").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        fs, folder = self._fs(), self._path("commits")
        if not fs.exists(folder):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def commit_at(self, number: int) -> Commit:
        stream = self._fs().open(self._path(f"commits/{number:012d}.json"))
        try:
            return Commit.from_json(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def head(self) -> Commit | None:
        numbers = self._numbers()
        return self.commit_at(numbers[-1]) if numbers else None

    def _append(self, commit: Commit) -> Commit:
        """Write the commit beside its place and rename it: it appears whole or not at all."""
        fs = self._fs()
        final, draft = self._path(f"commits/{commit.number:012d}.json"), self._path(f"commits/.{uuid.uuid4().hex}")
        stream = fs.create(draft, False)
        try:
            stream.write(bytearray(commit.to_json().encode("utf-8")))
        finally:
            stream.close()
        if fs.exists(final) or not fs.rename(draft, final):
            fs.delete(draft, False)
            raise CommitError(f"commit {commit.number} is taken: the table has another writer")
        return commit

    # ------------------------------------------------------------------ reading

    def bucket_of(self):
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _frame(self, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return align_to_schema(self.spark.read.schema(self.schema).parquet(*[f"{self.root}/data/{f}" for f in folders]), self.schema)

    def read_open(self, commit: Commit | None, buckets: Sequence[int] | None = None) -> DataFrame:
        """Open versions, of the given buckets only if there are any."""
        named = {} if commit is None else commit.open
        wanted = sorted(named, key=int) if buckets is None else [str(b) for b in sorted(buckets) if str(b) in named]
        return self._frame([f"{named[b]}/open/{BUCKET}={b}" for b in wanted])

    def read_closed(self, commit: Commit | None) -> DataFrame:
        return self._frame([f"{f}/closed" for f in commit.closed] if commit else [])

    def read(self, commit: Commit | None = None) -> DataFrame:
        """The whole table as the newest commit (or the given one) names it."""
        commit = commit or self.head()
        return self.read_open(commit).unionByName(self.read_closed(commit))

    def before_images(self, folder: str) -> DataFrame:
        return self._frame([f"{folder}/before"])

    # ------------------------------------------------------------------ writing

    def touched_buckets(self, rows: DataFrame) -> tuple[int, ...]:
        """Buckets that hold the keys of ``rows``; at most one number per bucket reaches the driver."""
        return tuple(sorted(r[0] for r in rows.select(self.bucket_of().alias(BUCKET)).distinct().collect()))

    def accepts(self, batch_id: int) -> bool:
        """Whether the batch is new; False for a rerun, an error for a late one."""
        head = self.head()
        if head is None or not head.batches:
            return True
        if batch_id in head.batches:
            return False
        if batch_id < head.batches[-1]:
            raise LateBatchError(f"batch {batch_id} is older than batch {head.batches[-1]} of {self.root}")
        return True

    def stage(self, batch_id: int, touched: Sequence[int], after: DataFrame, high_water: int,
              before: DataFrame | None = None) -> Staged:
        """Write a batch's data.  ``after`` holds the touched buckets after the batch, ``before`` their open
        versions before it; rows of ``after`` that are not open are the ones the batch closed."""
        folder = f"{batch_id}-{uuid.uuid4().hex[:12]}"
        at = f"{self.root}/data/{folder}"
        rows = align_to_schema(after, self.schema)
        opened = F.expr(self.is_open)
        # one task per bucket: a bucket's rows go to few files
        rows.where(opened).withColumn(BUCKET, self.bucket_of()).repartition(max(len(touched), 1), BUCKET).write.partitionBy(
            BUCKET).parquet(f"{at}/open")
        rows.where(F.coalesce(~opened, F.lit(True))).write.parquet(f"{at}/closed")
        closed = self._frame([f"{folder}/closed"])
        has_closed = not closed.isEmpty()
        if before is not None and has_closed:
            before.join(closed.select(self.sk), self.sk, "left_semi").select(*self.schema.names).write.parquet(f"{at}/before")
        fs, opened_at = self._fs(), self._path(f"data/{folder}/open")
        filled = sorted(int(n.split("=")[1]) for n in (s.getPath().getName() for s in fs.listStatus(opened_at)) if n.startswith(f"{BUCKET}="))
        return Staged(batch_id, folder, tuple(touched), tuple(filled), has_closed, high_water)

    def commit(self, staged: Staged) -> Commit:
        """Put a staged batch in force, on top of the newest commit."""
        if not self.accepts(staged.batch_id):
            return self.head()
        head = self.head()
        named = dict(head.open) if head else {}
        for b in staged.touched:
            named.pop(str(b), None)
        named.update({str(b): staged.folder for b in staged.filled})
        closed = (head.closed if head else ()) + ((staged.folder,) if staged.has_closed else ())
        return self._append(Commit(
            number=head.number + 1 if head else 0, batch_id=staged.batch_id, parent=head.number if head else None, open=named,
            closed=closed, high_water=staged.high_water, batches=(head.batches if head else ()) + (staged.batch_id,)))

    def create(self, batch_id: int, state: DataFrame) -> Commit:
        """The first commit, from a whole state."""
        if self.head() is not None:
            raise CommitError(f"{self.root} holds a table already")
        high = state.agg(F.coalesce(F.max(self.sk), F.lit(0)).cast("long")).first()[0]
        return self.commit(self.stage(batch_id, range(self.buckets), state, high))

    def rollback(self, batch_id: int) -> Commit:
        """Take back the newest batch: the state of the commit before it is in force again, bit for bit.

        The before-images must be the open versions that the state before holds under the same keys.
        """
        head = self.head()
        if head is None or head.undone is not None or head.batch_id != batch_id or head.parent is None:
            raise CommitError(f"batch {batch_id} is not the newest batch of {self.root}, or the first")
        parent = self.commit_at(head.parent)
        mine = set(head.closed) - set(parent.closed)
        for folder in mine:
            images = self.before_images(folder)
            changed = [b for b, f in head.open.items() if parent.open.get(b) != f] + [b for b in parent.open if b not in head.open]
            if not images.exceptAll(self.read_open(parent, [int(b) for b in changed])).isEmpty():
                raise CommitError(f"before-images of batch {batch_id} are not part of commit {parent.number}")
        return self._append(replace(parent, number=head.number + 1, parent=head.number, batch_id=batch_id, undone=batch_id,
                                    high_water=head.high_water))
