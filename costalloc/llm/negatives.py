"""Hard negatives of anchor vectors: rows of another label that score nearly as high as a row of the anchor's own.

Scores are inner products of whole numbers. Each vector keeps its angles to a few reference directions. The angle between
an anchor and a row lies between the difference and the sum of their angles to any reference, so every reference gives an
interval of the cosine; the narrowest, times both norms, with room for rounding, bounds the score. Rows are sorted by label and angle: stretches of them, and
in these single rows, whose interval does not overlap the window that the anchor still looks for are never scored.

Anchors are sent to all tasks in blocks of bounded size, one pass over the rows each; a task keeps the best few of each
anchor and window.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from costalloc.llm.common import buffers, materialize
from costalloc.session import run_dir

SCALE = 256
LARGEST = 1 << 23  # whole numbers beyond are set to it, so that no score leaves 64 bits
REFERENCES = 8
SAMPLE = 2048  # rows from which the reference directions are chosen; they change the work, not the result
SAMPLE_PLACES = 4096
ANCHOR_EVERY = 100
POSITIVES = NEGATIVES = 5
LOW, HIGH = 80, 100  # per cent of the positive's score
BLOCK_BYTES = 8 << 20  # of anchors that are sent to all tasks at once
STRETCH, STRETCH_BYTES = 256, 4 << 20  # rows that are judged together
HELD = 1 << 18  # scored pairs that a task holds before it keeps the best
ROOM = 1e-6  # of the product of the norms: above the error of cosines and sines near their ends
S = np.int64

ROW = "label bigint, n_places int, home int, angle double, vec_id bigint, vec binary, norm double, cosines binary"
VECTOR = "row bigint, label bigint, n_places int, vec_id bigint, vec binary, norm double, cosines binary"


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, embedding) of rows with an id, a label, and a vector of finite numbers only."""
    x = F.col("embedding").cast("array<double>")
    fine = F.forall(x, lambda e: F.coalesce(~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))), F.lit(False)))
    rows = embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & fine)
    return rows.select(F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"), x.alias("embedding"))


def whole_numbers(values: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(values * SCALE), -LARGEST, LARGEST).astype("<i4")


def directions(rows: DataFrame, n: int = REFERENCES, sample: int = SAMPLE) -> np.ndarray:
    """n unit vectors: rows of a sample of fixed size, each as far as can be from those before."""
    first = F.slice("embedding", 1, SAMPLE_PLACES).alias("embedding")
    drawn = rows.select(F.xxhash64("vec_id").alias("h"), "vec_id", first).orderBy("h", "vec_id", "embedding").limit(sample).collect()
    width = max([1, *(len(r.embedding) for r in drawn)])
    points = np.zeros((max(1, len(drawn)), width))
    for k, r in enumerate(drawn):
        points[k, : len(r.embedding)] = whole_numbers(np.array(r.embedding))
    norms = np.linalg.norm(points, axis=1)
    points = points[norms > 0] / norms[norms > 0, None]
    if not len(points):
        points = np.eye(1, width)
    chosen, nearest = [points[0]], points @ points[0]
    while len(chosen) < n:
        k = int(np.argmin(nearest))
        chosen.append(points[k])
        nearest = np.maximum(nearest, points @ points[k])
    return np.array(chosen)


def _measured(references: np.ndarray):
    """Batches of (vec_id, label, embedding) to rows of ROW; rows of a batch that are alike become one."""
    width = references.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels = (batch.column(k).to_numpy() for k in (0, 1))
            lists = batch.column(2)
            values = lists.flatten().to_numpy(zero_copy_only=False)
            ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False).astype(S)) if len(lists) else np.empty(0, S)
            starts = np.concatenate([[0], ends[:-1]]).astype(S) if len(ends) else ends
            sizes, seen, out = ends - starts, set(), []
            for size in np.unique(sizes).tolist():
                some = np.flatnonzero(sizes == size)
                whole = whole_numbers(values[starts[some][:, None] + np.arange(size)])
                wide = whole.astype(float)
                norm = np.sqrt((wide**2).sum(axis=1))
                cosines = wide[:, :width] @ references[:, :size].T / np.maximum(norm, 1e-300)[:, None]
                cosines = np.where(norm[:, None] > 0, np.clip(cosines, -1.0, 1.0), 0.0)
                home = cosines.argmax(axis=1)
                for k, i in enumerate(some.tolist()):
                    vec = whole[k].tobytes()
                    if (key := (labels[i], ids[i], vec)) not in seen:
                        seen.add(key)
                        out.append((int(labels[i]), size, int(home[k]), -float(cosines[k, home[k]]), int(ids[i]), vec, float(norm[k]), cosines[k].tobytes()))
            if out:
                types = [pa.int64(), pa.int32(), pa.int32(), pa.float64(), pa.int64(), pa.binary(), pa.float64(), pa.binary()]
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in ROW.split(", ")])

    return run


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (of ROW and the task) with a number each; rows alike stand together and become one."""
    before, n = None, 0
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("label", "vec_id", "vec")), strict=True))
        new = [key != other for key, other in zip(keys, [before, *keys[:-1]], strict=True)]
        if keys:
            before = keys[-1]
        kept = batch.filter(pa.array(new))
        number = pa.array((kept.column("task").to_numpy().astype(S) << 32) + n + np.arange(kept.num_rows))
        n += kept.num_rows
        names = [f.split()[0] for f in VECTOR.split(", ")][1:]
        yield pa.RecordBatch.from_arrays([number, *[kept.column(c) for c in names]], names=["row", *names])


def vectors(rows: DataFrame, references: np.ndarray) -> DataFrame:
    """VECTOR for each different row, sorted in ranges by label, length, nearest reference and angle to it."""
    order = ["label", "n_places", "home", "angle", "vec_id", "vec"]
    measured = rows.mapInArrow(_measured(references), ROW)
    ordered = measured.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("task", F.spark_partition_id())
    return materialize(ordered.mapInArrow(_numbered, VECTOR), "vectors")


class Stretch:
    """Some rows of VECTOR of one length, as arrays."""

    def __init__(self, batch: pa.RecordBatch):
        self.row, self.label, self.id = (batch.column(c).to_numpy() for c in ("row", "label", "vec_id"))
        self.norm = batch.column("norm").to_numpy()
        self.vec = self._matrix(batch.column("vec"), "<i4").astype(float)
        cos = self._matrix(batch.column("cosines"), "<f8")
        self.cos, self.sin = cos, np.sqrt(np.maximum(0.0, 1.0 - cos**2))
        self.largest = float(np.abs(self.vec).max(initial=0.0))

    @staticmethod
    def _matrix(column: pa.Array, kind: str) -> np.ndarray:
        data, offsets = buffers(column)
        return np.frombuffer(data[offsets[0] : offsets[-1]].tobytes(), kind).reshape(len(column), -1) if len(column) else np.empty((0, 0), kind)


def stretches(batch: pa.RecordBatch, most: int = STRETCH) -> Iterator[pa.RecordBatch]:
    """Slices of rows of one label and length, up to `most` rows and a few MB."""
    if not batch.num_rows:
        return
    label, places = batch.column("label").to_numpy(), batch.column("n_places").to_numpy()
    cut = np.flatnonzero((label[1:] != label[:-1]) | (places[1:] != places[:-1])) + 1
    edges = [0, *cut.tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:], strict=False):
        step = int(max(1, min(most, STRETCH_BYTES // (8 * max(1, int(places[a]))))))
        for i in range(a, b, step):
            yield batch.slice(i, min(step, b - i))


def products(a: Stretch, which: np.ndarray, b: Stretch) -> np.ndarray:
    """Exact scores of some rows of a with all of b; what the shorter vectors lack counts as 0."""
    width = min(a.vec.shape[1], b.vec.shape[1])
    x, y = a.vec[which, :width], b.vec[:, :width]
    if a.largest * b.largest * max(1, width) < 2.0**53:  # sums of doubles are exact
        return (x @ y.T).astype(S)
    return x.astype(S) @ y.astype(S).T


def bounds(a: Stretch, which: np.ndarray, b: Stretch) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that some rows of a can have with each row of b, by the angles alone."""
    low = np.full((len(which), len(b.row)), -1.0)
    high = np.full((len(which), len(b.row)), 1.0)
    for k in range(a.cos.shape[1]):
        both = np.multiply.outer(a.cos[which, k], b.cos[:, k])
        across = np.multiply.outer(a.sin[which, k], b.sin[:, k])
        np.minimum(high, both + across, out=high)  # cosine of the difference of the angles
        np.maximum(low, both - across, out=low)  # cosine of their sum
    norms = np.multiply.outer(a.norm[which], b.norm)
    room = ROOM * norms + 1.0
    return low * norms - room, high * norms + room


def far_bound(a: Stretch, which: np.ndarray, b: Stretch) -> np.ndarray:
    """The greatest score that some rows of a can have with any row of the stretch b, by its ranges of angles."""
    angle, least, most = np.arccos(a.cos[which]), np.arccos(b.cos.max(axis=0)), np.arccos(b.cos.min(axis=0))
    apart = np.maximum(0.0, np.maximum(least - angle, angle - most)).max(axis=1)
    norms = a.norm[which] * b.norm.max()
    cosine = np.cos(np.minimum(np.pi, apart))
    return np.where(cosine > 0, cosine * norms, cosine * a.norm[which] * b.norm.min()) + ROOM * norms + 1.0


class Best:
    """The best few rows of each window (a number below n) so far, and the score that a row must reach to be among them."""

    def __init__(self, least: np.ndarray, few: int):
        self.least, self.few = least.astype(float), few
        self.held: list[tuple[np.ndarray, ...]] = []
        self.count = 0

    def add(self, window: np.ndarray, score: np.ndarray, ids: np.ndarray, row: np.ndarray) -> None:
        self.held.append((window, score, ids, row))
        self.count += len(window)
        if self.count > HELD:
            self.keep()

    def keep(self) -> tuple[np.ndarray, ...]:
        """Forget all but the best few of each window: by score, then by id."""
        if not self.held:
            return tuple(np.empty(0, S) for _ in range(4))
        window, score, ids, row = (np.concatenate(x) for x in zip(*self.held, strict=True))
        order = np.lexsort((row, ids, -score, window))
        window, score, ids, row = (x[order] for x in (window, score, ids, row))
        first = np.flatnonzero(np.r_[True, window[1:] != window[:-1]]) if len(window) else np.empty(0, S)
        place = np.arange(len(window)) - np.repeat(first, np.diff(np.append(first, len(window))))
        last = place == self.few - 1
        np.maximum.at(self.least, window[last], score[last])
        good = place < self.few
        self.held = [(window[good], score[good], ids[good], row[good])]
        self.count = int(good.sum())
        return self.held[0]


ANCHOR = VECTOR + ", reach bigint"


def _anchors(every: int, few: int):
    """Anchor rows, with the score of their few-th best neighbour of the same label in their own stretch, if there are so many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in stretches(batch, 16 * STRETCH):
                here = Stretch(part)
                which = np.flatnonzero(here.id % every == 0)
                if not len(which):
                    continue
                reach, known = np.zeros(len(which), S), np.zeros(len(which), bool)
                if len(here.row) > few:
                    for k, i in enumerate(which.tolist()):
                        score = np.delete(products(here, np.array([i]), here)[0], i)
                        reach[k], known[k] = np.partition(score, len(score) - few)[len(score) - few], True
                kept = part.take(pa.array(which))
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(reach, mask=~known)], names=[f.split()[0] for f in ANCHOR.split(", ")])

    return run


class Anchors:
    """A block of anchors: stretches of equal length, each with its windows."""

    def __init__(self, rows: list, windows: dict[int, list[int]] | None):
        """windows: for negatives the different positive scores of each anchor row; None when positives are looked for."""
        self.parts = []
        fields = [f.split() for f in VECTOR.split(", ")]
        kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "double": pa.float64()}
        for size in sorted({r.n_places for r in rows}):
            some = [r for r in rows if r.n_places == size]
            batch = pa.RecordBatch.from_arrays([pa.array([r[n] for r in some], kinds[k]) for n, k in fields], names=[n for n, _ in fields])
            if windows is None:
                least = np.array([[-np.inf if r.reach is None else r.reach] for r in some])
                most = np.full((len(some), 1), np.inf)
            else:
                slots = max(len(windows[r.row]) for r in some)
                scores = np.array([windows[r.row] + [-1] * (slots - len(windows[r.row])) for r in some], S)
                least, most = -(-LOW * scores // HIGH), scores.astype(float)
                least = np.where(scores < 0, np.inf, least)  # no score is 80 to 100 per cent of a negative one
            self.parts.append((Stretch(batch), least, most))


def _search(sent, same_label: bool, few: int):
    """The best few rows of the task for each window of the anchors that were sent: (anchor, slot, vec_id, row, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(a, low, high, Best(low.ravel(), few)) for a, low, high in sent.value.parts]
        for batch in batches:
            for piece in stretches(batch):
                here = Stretch(piece)
                for a, _, high, best in parts:
                    alike = a.label == here.label[0]
                    which = np.flatnonzero(alike if same_label else ~alike)
                    if not len(which):
                        continue
                    wanted = best.least.reshape(high.shape)
                    which = which[far_bound(a, which, here) >= wanted[which].min(axis=1)]
                    least, most = wanted[which].min(axis=1), high[which].max(axis=1)
                    if not len(which):
                        continue
                    below, above = bounds(a, which, here)
                    overlap = (above >= least[:, None]) & (below <= most[:, None])
                    if same_label:
                        overlap &= a.row[which][:, None] != here.row
                    some = overlap.any(axis=1)
                    which, overlap = which[some], overlap[some]
                    if not len(which):
                        continue
                    score = products(a, which, here)
                    for slot in range(high.shape[1]):
                        fits = overlap & (score >= wanted[which, slot][:, None]) & (score <= high[which, slot][:, None])
                        i, j = np.nonzero(fits)
                        if len(i):
                            best.add(which[i] * high.shape[1] + slot, score[i, j], here.id[j], here.row[j])
        for a, _, high, best in parts:
            window, score, ids, row = best.keep()
            if len(window):
                slot = high[window // high.shape[1], window % high.shape[1]]
                aim = np.where(np.isfinite(slot), slot, 0).astype(S)
                columns = [a.row[window // high.shape[1]], aim, ids, row, score]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=FOUND_NAMES)

    return run


FOUND = "anchor bigint, aim bigint, vec_id bigint, row bigint, score bigint"
FOUND_NAMES = [f.split()[0] for f in FOUND.split(", ")]


def _best_of_all(found: DataFrame, few: int) -> DataFrame:
    """The best few per anchor and window, with their rank; a task told at most so many of each."""
    order = Window.partitionBy("anchor", "aim").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= few)


def _passes(rows: DataFrame, anchors: DataFrame, name: str, windows: DataFrame | None, few: int) -> DataFrame:
    """Search all rows for the anchors, block by block; each block's finds are written before the next is sent."""
    spark = rows.sparkSession
    path = run_dir(spark, name)
    for block in [r[0] for r in anchors.select("block").distinct().orderBy("block").collect()]:
        some = anchors.where(F.col("block") == block)
        aims = None
        if windows is not None:
            told = some.select("row").join(windows, "row").select("row", "score").distinct()  # at most POSITIVES each
            aims = {}
            for r in told.collect():
                aims.setdefault(r.row, []).append(r.score)
        held = [r for r in some.collect() if aims is None or r.row in aims]
        if not held and aims is not None:
            continue
        sent = spark.sparkContext.broadcast(Anchors(held, aims))
        rows.mapInArrow(_search(sent, windows is None, few), FOUND).write.parquet(f"{path}/block={block}")
        sent.destroy()
    spark.createDataFrame([], FOUND).write.mode("append").parquet(f"{path}/block=-1")  # so that there is something to read
    return spark.read.schema(FOUND).parquet(path)


def hard_negatives(rows: DataFrame, every: int = ANCHOR_EVERY, block_bytes: int = BLOCK_BYTES, n_references: int = REFERENCES) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): the first negatives of each anchor and positive.

    rows: vec_id, label, embedding. Anchors are rows whose vec_id is divisible by `every`; positives the best
    POSITIVES other rows of their label; negatives the best NEGATIVES rows of other labels whose score is LOW to HIGH per
    cent of the positive's. Higher scores come first, ties by smaller vec_id. A component counts as
    floor(256 * x), at most LARGEST either way. Rows without id, label or vector, or with a null or non-finite component,
    take no part. Of vectors of different length the shorter is filled up with zeros; an empty one scores 0. Repeated
    rows count once; different rows under one vec_id are rows of their own, also as anchors. An anchor without positives, or a
    positive without negatives (always so below a score of 0), has no row. An empty table gives none. Other columns are ignored.
    """
    fine = usable(rows)
    table = vectors(fine, directions(fine, n_references))
    anchors = materialize(table.mapInArrow(_anchors(every, POSITIVES), ANCHOR), "anchors")
    size = anchors.agg(F.sum(F.octet_length("vec") + F.octet_length("cosines") + 64)).first()[0] or 0
    n_blocks = max(1, -(-int(size) // block_bytes))
    anchors = anchors.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(n_blocks)).cast("int"))
    found = _passes(table, anchors, "positives", None, POSITIVES)
    positives = materialize(_best_of_all(found, POSITIVES).select(F.col("anchor").alias("row"), F.col("vec_id").alias("positive_id"), "score"), "positive")
    found = _passes(table, anchors, "negatives", positives.where("score >= 0"), NEGATIVES)
    best = _best_of_all(found, NEGATIVES).select(
        F.col("anchor").alias("row"), F.col("aim").alias("score"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")
    )
    named = positives.join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
    return named.join(best, ["row", "score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", F.col("score").alias("positive_score"), "negative_score"
    )


def shifted_labels(embeddings: DataFrame, every: int = 7, n_labels: int = 10) -> DataFrame:
    """Rows whose vec_id is divisible by `every` get the next label: neighbours under a wrong label."""
    label = F.when(F.col("vec_id") % every == 0, (F.col("label").cast("bigint") + 1) % n_labels).otherwise(F.col("label").cast("bigint"))
    return embeddings.select("vec_id", label.alias("label"), "embedding")
