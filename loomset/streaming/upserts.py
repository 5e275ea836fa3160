"""A table of the latest row per key, kept by micro-batches: one snapshot, a few deltas, and manifests that name them."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def latest(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The last row of every key, as an aggregate."""
    rest = F.struct(*[F.col(c) for c in df.columns if c not in keys])
    return df.groupBy(*keys).agg(F.max_by(rest, order).alias("r")).select(*keys, "r.*")


class UpsertLog:
    """The table below ``path``.

    A batch writes its own latest rows as a delta; every ``compact_every`` deltas are merged with the snapshot
    into a new one, so reading costs one snapshot and a few deltas however many batches there were. What
    belongs to the table is what the newest manifest lists; it is written last, under a new number and never
    over another one. A batch that is repeated after its manifest was written finds its number there and
    changes nothing; files of a batch that failed before are listed nowhere. Folders that neither the newest
    manifest nor the one before it lists are removed, so a reader has until the next batch but one.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], order: list[str], compact_every: int = 8):
        self.spark, self.path, self.keys, self.order, self.compact_every = spark, path.rstrip("/"), keys, order, compact_every
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._utils = jvm.org.apache.commons.io.IOUtils

    def _names(self, below: str) -> list[str]:
        folder = self._path(f"{self.path}/{below}")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(folder)) if self._fs.exists(folder) else []

    def _manifests(self, most: int) -> Iterator[dict]:
        """The newest manifests, newest first."""
        for name in sorted((n for n in self._names("manifests") if n.endswith(".json")), reverse=True)[:most]:
            stream = self._fs.open(self._path(f"{self.path}/manifests/{name}"))
            try:
                yield json.loads(self._utils.toString(stream, "UTF-8"))
            finally:
                stream.close()

    def manifest(self) -> dict:
        return next(self._manifests(1), {"version": 0, "batch": -1, "snapshot": None, "deltas": []})

    def _commit(self, manifest: dict) -> None:
        """Write a manifest beside its place and move it there; a half-written one is never read."""
        name = f"{self.path}/manifests/{manifest['version']:012d}.json"
        draft = self._path(f"{name}.{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(manifest), "utf-8"))
        finally:
            out.close()
        if self._fs.exists(self._path(name)) or not self._fs.rename(draft, self._path(name)):
            raise RuntimeError(f"another writer has committed {name}")

    def _remove_old(self) -> None:
        kept = list(self._manifests(2))
        listed = {f for m in kept for f in (m["snapshot"], *m["deltas"]) if f}
        for name in self._names("data"):
            if name not in listed:
                self._fs.delete(self._path(f"{self.path}/data/{name}"), True)
        oldest = f"{kept[-1]['version']:012d}.json"
        for name in self._names("manifests"):
            if name < oldest:
                self._fs.delete(self._path(f"{self.path}/manifests/{name}"), False)

    def _frame(self, manifest: dict) -> DataFrame | None:
        folders = [f"{self.path}/data/{f}" for f in (manifest["snapshot"], *manifest["deltas"]) if f]
        return self.spark.read.parquet(*folders) if folders else None

    def read(self) -> DataFrame:
        """The latest row of every key."""
        frame = self._frame(self.manifest())
        if frame is None:
            raise FileNotFoundError(f"{self.path} holds no batch")
        return latest(frame, self.keys, F.struct(*self.order))

    def append(self, batch: DataFrame, number: int) -> None:
        """Take in micro-batch ``number``; numbers grow."""
        now = self.manifest()
        if number <= now["batch"]:
            return
        made = f"delta-{number:012d}-{uuid.uuid4().hex}"
        latest(batch, self.keys, F.struct(*self.order)).write.parquet(f"{self.path}/data/{made}")
        after = {"version": now["version"] + 1, "batch": number, "snapshot": now["snapshot"], "deltas": [*now["deltas"], made]}
        if len(after["deltas"]) >= self.compact_every:
            whole = f"snapshot-{number:012d}-{uuid.uuid4().hex}"
            latest(self._frame(after), self.keys, F.struct(*self.order)).write.parquet(f"{self.path}/data/{whole}")
            after["snapshot"], after["deltas"] = whole, []
        self._commit(after)
        self._remove_old()
