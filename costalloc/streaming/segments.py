"""Results of micro-batches, merged in levels.

Every batch is a folder of its own. When enough of them have gathered they are merged into one segment, enough segments
of a level into one of the next, so that after n batches readers meet about log(n) folders, and each row has been written
again about log(n) times. Which folders count is said by the newest version file, which appears at once: readers see the
folders of before or those of after. What a merge that broke off has left behind is in no version.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costalloc.functions.timeparts import moment
from costalloc.sources import files

DAY_PARTITION = "WindowDate"
FANOUT = 8
VERSIONS_KEPT = 2  # how many versions a reader may be behind before vacuum takes its folders

Merge = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Segment:
    """Merged batches `first` to `last`, both included."""

    level: int
    first: int
    last: int
    name: str


class Segments:
    """A store of micro-batches below `base`, in folders by day or by another column.

    layout: the columns of a row, `partition` among them. merge: makes of rows of several batches the rows that stand for them; merging
    in any order of levels must give the same in the end.
    """

    def __init__(
        self, spark: SparkSession, base: str, layout: T.StructType, merge: Merge, fanout: int = FANOUT, partition: str = DAY_PARTITION
    ):
        self.partition = partition
        self.spark, self.base, self.merge, self.fanout = spark, base.rstrip("/"), merge, fanout
        self.columns = layout.fieldNames()
        self.layout = T.StructType([*layout.fields, T.StructField("Segment", T.StringType())])

    # Which folders count

    def _version(self) -> tuple[int, list[Segment]]:
        found = files.names(self.spark, f"{self.base}/versions/*.json")
        if not found:
            return 0, []
        told = json.loads(files.read_text(self.spark, f"{self.base}/versions/{found[-1]}"))
        return told["version"], [Segment(**s) for s in told["segments"]]

    @staticmethod
    def _last_merged(segments: list[Segment]) -> int:
        return max([s.last for s in segments], default=-1)

    def _path(self, name: str) -> str:
        return f"{self.base}/data/Segment={name}"

    def _batches(self) -> list[int]:
        """Batches that are written whole."""
        done = files.folders(self.spark, f"{self.base}/data/Segment=b*/_SUCCESS")
        return [int(path.split("/")[-2].split("=b")[1]) for path in done]

    def live(self) -> list[str]:
        """Names of the folders that count now."""
        _, segments = self._version()
        merged = self._last_merged(segments)
        return [s.name for s in segments] + [f"b{b:012d}" for b in self._batches() if b > merged]

    # Writing and reading

    def is_merged(self, batch_id: int) -> bool:
        return batch_id <= self._last_merged(self._version()[1])

    def write(self, rows: DataFrame, batch_id: int) -> bool:
        """Store a batch; the same batch again replaces itself, or is left out if it was merged already."""
        if self.is_merged(batch_id):
            return False
        rows.select(self.columns).write.mode("overwrite").partitionBy(self.partition).parquet(self._path(f"b{batch_id:012d}"))
        return True

    def _read(self, names: list[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], self.layout)
        reader = self.spark.read.schema(self.layout).option("basePath", f"{self.base}/data")
        return reader.parquet(*[self._path(name) for name in names])

    def _held(self) -> list[str]:
        """Of the folders that count now, those that hold rows: a batch that changed nothing leaves none."""
        return [name for name in self.live() if files.folders(self.spark, f"{self._path(name)}/{self.partition}=*")]

    def read(self, start=None, end=None) -> DataFrame:
        """The rows of all that counts, merged; of the days of a half-open range of time only, if one is given.

        What lies in one merged folder alone was merged when it was written, and is not shuffled again.
        """
        held = self._held()
        rows = self._read(held)
        if start is not None:
            rows = rows.where(F.col(DAY_PARTITION) >= F.to_date(moment(start)))
        if end is not None:
            rows = rows.where(F.col(DAY_PARTITION) <= F.to_date(moment(end)))
        merged = self.merge(rows.select(self.columns))
        return rows.select(merged.columns) if len(held) == 1 and held[0].startswith("m") else merged

    def before(self, batch_id: int) -> DataFrame:
        """The rows that were there before a batch, not merged: what the batch was, if it is done again, does not count."""
        own = f"b{batch_id:012d}"
        return self._read([name for name in self.live() if not (name.startswith("b") and name >= own)]).select(self.columns)

    # Merging

    def compact(self) -> int:
        """Merge wherever `fanout` folders of a level have gathered; returns how many merges were published."""
        done = 0
        while True:
            version, segments = self._version()
            level, parts = 0, [Segment(0, b, b, f"b{b:012d}") for b in sorted(self._batches()) if b > self._last_merged(segments)]
            while len(parts) < self.fanout:
                level += 1
                if level > max([s.level for s in segments], default=0):
                    return done
                parts = [s for s in segments if s.level == level]
            try:
                self._publish(version, segments, parts)
            except FileExistsError:  # somebody else has merged meanwhile; what was written here is in no version
                return done
            done += 1

    def _publish(self, version: int, segments: list[Segment], parts: list[Segment]) -> None:
        first, last, level = min(p.first for p in parts), max(p.last for p in parts), parts[0].level + 1
        new = Segment(level, first, last, f"m{level}-{first:012d}-{last:012d}-{uuid.uuid4().hex[:8]}")
        rows = self.merge(self._read([p.name for p in parts]).select(self.columns)).select(self.columns)
        rows.hint("rebalance", self.partition).write.partitionBy(self.partition).parquet(self._path(new.name))
        left = [s for s in segments if s.name not in {p.name for p in parts}]
        told = {"version": version + 1, "segments": [asdict(s) for s in sorted([*left, new], key=lambda s: s.first)]}
        files.put_text(self.spark, f"{self.base}/versions/{version + 1:012d}.json", json.dumps(told))

    def vacuum(self, versions_kept: int = VERSIONS_KEPT) -> int:
        """Remove folders that none of the newest versions names, and older versions; returns how many folders went."""
        found = files.names(self.spark, f"{self.base}/versions/*.json")
        if not found:
            return 0
        kept = [json.loads(files.read_text(self.spark, f"{self.base}/versions/{n}"))["segments"] for n in found[-versions_kept:]]
        named = {s["name"] for segments in kept for s in segments}
        merged = max([s["last"] for s in kept[0]], default=-1) if len(found) >= versions_kept else -1
        gone = 0
        for name in (n.split("=")[1] for n in files.names(self.spark, f"{self.base}/data/Segment=*")):
            if (name.startswith("b") and int(name[1:]) <= merged) or (name.startswith("m") and name not in named and int(name.split("-")[2]) <= merged):
                files.delete(self.spark, self._path(name))
                gone += 1
        for old in found[:-versions_kept]:
            files.delete(self.spark, f"{self.base}/versions/{old}")
        return gone

    def keep_small(self) -> None:
        """Merge what has gathered, and remove what nobody reads any more."""
        if self.compact():
            self.vacuum()
