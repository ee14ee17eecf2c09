"""SimHash near-duplicates over an index sorted by Gray rank.

Fingerprints that differ in at most d of 64 bits agree on at least one of d+1 bit ranges. The upper nodes of the
index are these masked bit patterns: all fingerprints with one pattern in one range. They are dealt over the tasks.
Below, a node's fingerprints are sorted by Gray rank, so that neighbours differ in few bits, and grouped; every group
keeps the bits that all its members share. Two groups whose shared bits already differ in more than d places are
dropped together with everything below them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costalloc.llm.common import IS_SPACE, U, materialize, semi_join, text_or_empty, whole_groups
from costalloc.llm.graph import components

SEED = 42
FAN_OUT = 8
HOT = 200_000  # fingerprints below one masked pattern beyond which it is divided by further ranges
FLUSH = 400_000  # rows searched at once in a task, if the patterns allow it
EXPAND = 1_000_000  # pairs of groups looked at in one step


def fingerprint_bits(texts: list[bytes], shingle: int) -> np.ndarray:
    """The SimHash of each text as an unsigned 64-bit number."""
    digest = xxhash.xxh64_digest
    out = np.zeros(len(texts), U)
    for i, text in enumerate(texts):
        words = text.lower().split()
        if not words:
            continue
        joined = b" ".join(words)
        gaps = np.flatnonzero(IS_SPACE[np.frombuffer(joined, np.uint8)])
        starts = np.concatenate([[0], gaps + 1])
        ends = np.concatenate([gaps, [len(joined)]])
        n = max(1, len(words) - shingle + 1)
        spans = zip(starts[:n].tolist(), ends[-n:].tolist(), strict=True)
        hashes = np.frombuffer(b"".join([digest(joined[s:e], SEED) for s, e in spans]), np.uint8)
        ones = np.zeros(64, np.int64)
        for k in range(0, n, 8192):
            bits = np.unpackbits(hashes[8 * k : 8 * (k + 8192)]).reshape(-1, 64)
            ones += bits.sum(axis=0, dtype=np.int32)
        out[i] = np.packbits(2 * ones > n).view(">u8")[0]
    return out


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp): fp is the fingerprint as a signed bigint.

    Lower-cases A-Z; shingles of `shingle` words, repeats included (fewer words: the whole sequence; null or no
    words: fingerprint zero); their XXH64 with seed 42; a bit is 1 if it is set in over half the hashes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = fingerprint_bits(batch.column(1).to_pylist(), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], names=["doc_id", "fp"])

    texts = docs.select(F.col("doc_id").cast("bigint"), text_or_empty().cast("binary").alias("text"))
    return texts.mapInArrow(run, "doc_id bigint, fp bigint")


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """The place of a code word in the reflected binary code."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp ^ (fp >> U(shift))
    return fp


def _levels(key: np.ndarray, fp: np.ndarray) -> list[tuple]:
    """From the leaves up: (first child, end child, shared-bit mask, shared bits, group) per node."""
    n = len(fp)
    levels = [(np.arange(n), np.arange(n) + 1, np.full(n, ~U(0)), fp, key)]
    ones, anys = fp, fp
    while True:
        key = levels[-1][4]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        begin = np.flatnonzero(new)
        if len(begin) == len(key):
            return levels
        place = np.arange(len(key)) - np.repeat(begin, np.diff(np.concatenate([begin, [len(key)]])))
        first = np.flatnonzero(place % FAN_OUT == 0)
        ones, anys = np.bitwise_and.reduceat(ones, first), np.bitwise_or.reduceat(anys, first)
        mask = ~(ones ^ anys)
        levels.append((first, np.concatenate([first[1:], [len(key)]]), mask, ones & mask, key[first]))


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the classes of a[i] and b[i]; label[x] is the smallest member of x's class."""
    while True:
        la, lb = label[a], label[b]
        open_ = la != lb
        if not open_.any():
            return
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        low = np.minimum(la, lb)
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label[:] = jumped


def linked(key: np.ndarray, fp: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows (x, root) for fingerprints of the same key that chains of at most `distance` bits connect.

    Only one link per member leaves, so a group of near copies doesn't turn into all its pairs.
    """
    order = np.lexsort((gray_rank(fp), key))
    levels = _levels(key[order], fp[order])
    label = np.arange(len(fp))
    top = np.flatnonzero(levels[-1][1] - levels[-1][0] > 0)
    stack = [(len(levels) - 1, top, top)]
    while stack:
        level, a, b = stack.pop()
        first, end, mask, bits, _ = levels[level]
        differ = np.bitwise_count((bits[a] ^ bits[b]) & mask[a] & mask[b])
        near = differ <= distance
        a, b = a[near], b[near]
        if level == 0:
            _merge(label, a, b)
            continue
        wide_a, wide_b = end[a] - first[a], end[b] - first[b]
        pairs = wide_a * wide_b
        cuts = np.searchsorted(np.cumsum(pairs), np.arange(EXPAND, int(pairs.sum()) + EXPAND, EXPAND)) + 1
        begin = 0
        for cut in np.unique(np.minimum(cuts, len(a))):
            part = slice(begin, cut)
            begin = cut
            count = pairs[part]
            which = np.repeat(np.arange(len(count)), count)
            place = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
            x = first[a[part]][which] + place // wide_b[part][which]
            y = first[b[part]][which] + place % wide_b[part][which]
            own = x < y if level == 1 else x <= y
            stack.append((level - 1, x[own], y[own]))
    moved = np.flatnonzero(label != np.arange(len(fp)))
    return order[moved], order[label[moved]]


def _search(distance: int):
    def flush(rows: pa.Table) -> pa.RecordBatch:
        key, fp, node = (rows.column(i).to_numpy() for i in range(3))
        x, root = linked(key, fp.view(U), distance)
        return pa.RecordBatch.from_arrays([pa.array(node[x]), pa.array(node[root])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, FLUSH):  # sorted by key
            yield flush(rows)

    return run


def _masks(bits: list[int], parts: int) -> list[int]:
    """The given bit places cut into `parts` masks."""
    edges = [len(bits) * i // parts for i in range(parts + 1)]
    return [sum(1 << bit for bit in bits[s:e]) for s, e in zip(edges, edges[1:], strict=False)]


def _signed(mask: int) -> Column:
    return F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("bigint")


def _keys(masks: list[int], *more: str) -> Column:
    """One key per mask: a hash of its number and the bits below it."""
    return F.array(*[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(_signed(m)), *more) for i, m in enumerate(masks)])


def links(fps: DataFrame, distance: int = 3, hot: int = HOT) -> DataFrame:
    """(a, b): enough links to connect all fingerprints at most `distance` bits apart.

    fps: fp (distinct), node. A masked pattern shared by over `hot` fingerprints is divided once more, by masks over
    the bits that it leaves open, before any task searches it; nothing is left out.
    """
    upper = _masks(list(range(64)), distance + 1)
    keyed = fps.select("fp", "node", F.posexplode(_keys(upper)).alias("part", "key"))
    crowded = keyed.groupBy("key").count().where(F.col("count") > hot).select("key")
    if crowded.limit(1).collect():
        crowded = materialize(crowded, "crowded-patterns")
        open_bits = [[bit for bit in range(64) if not mask >> bit & 1] for mask in upper]
        lower = F.array(*[_keys(_masks(bits, distance + 1), "part", "key") for bits in open_bits])
        split = keyed.join(crowded, "key", "left_semi").select(
            "fp", "node", "part", F.explode(lower[F.col("part")]).alias("key")
        )
        keyed = keyed.join(crowded, "key", "left_anti").select(split.columns).unionByName(split)
    dealt = keyed.select("key", "fp", "node").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(_search(distance), "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row.

    Two texts are linked if their fingerprints differ in at most `distance` bits; component_id is the smallest
    doc_id reachable. Null or empty texts have fingerprint zero and are linked like others. Rows without doc_id
    get a fingerprint, and the component of the rows with the same one (null if there are none); they link
    nothing. Repeated rows come back as often as they came in. Other columns are ignored.
    """
    return _classed(docs, shingle, distance).select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def _classed(docs: DataFrame, shingle: int, distance: int) -> DataFrame:
    """(doc_id, fp, root, component_id) for every row; root is the same for all fingerprints of a component.

    Fingerprints are linked, not doc_ids: two texts under one doc_id belong together only if they are near.
    """
    own = materialize(fingerprints(docs, shingle), "fingerprints")
    reps = materialize(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "representatives")
    named = reps.where("least IS NOT NULL").select("fp", F.col("fp").alias("node"))
    roots = components(links(named, distance)).select(F.col("node").alias("fp"), "root")
    rooted = materialize(reps.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "rooted")
    classes = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return own.join(rooted.join(classes, "root").select("fp", "root", "component_id"), "fp")


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """One row of each component, that with the smallest doc_id; all columns of docs.

    If the component has several rows with that doc_id, the one with the smallest fingerprint stays, then the one
    whose columns, written as JSON, are the smallest text; so columns of any type will do. Rows with one doc_id whose texts
    are not near all stay. Rows without doc_id stay.
    """
    found = materialize(_classed(docs, shingle, distance).where("doc_id IS NOT NULL"), "classed")
    best = found.where("doc_id = component_id").groupBy("doc_id", "root").agg(F.min("fp").alias("fp"))
    rows = found.groupBy("doc_id").agg(F.count("*").alias("rows"))
    best = materialize(best.join(rows, "doc_id"), "best")
    once = semi_join(docs, best.where("rows = 1"))
    # of an id with several rows, the text tells which of them is meant
    several = semi_join(docs, best.where("rows > 1")).select(F.struct("*").alias("row"))
    marked = _with_fingerprint(several, shingle).join(best.where("rows > 1").select("doc_id", "fp"), ["doc_id", "fp"])
    one = marked.groupBy("doc_id", "fp").agg(F.min_by("row", F.to_json("row")).alias("row")).select("row.*")
    return once.unionByName(one).unionByName(docs.where("doc_id IS NULL"))


def _with_fingerprint(rows: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, fp, row) of rows (row), a struct with doc_id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = fingerprint_bits(batch.column(1).to_pylist(), shingle).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp), batch.column(2)], names=["doc_id", "fp", "row"])

    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("fp", T.LongType()), rows.schema["row"]])
    texts = rows.select(F.col("row.doc_id").cast("bigint").alias("doc_id"), text_or_empty("row.text").cast("binary").alias("text"), "row")
    return texts.mapInArrow(run, schema)
