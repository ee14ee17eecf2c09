"""Prefix tree of conversations, in double arrays.

Every distinct beginning of a conversation is a node. A turn is known by 128 hash bits of its role and text, a node by its
depth and the exclusive or of hashes of its turns and their places, which can be rolled on by one turn. Texts are not
shuffled.

Equal conversations are one path with a count. Each path is cut where few enough turns lie below: from there on it belongs
to a shard, whose task packs the subtrees into the BASE and CHECK arrays of a double-array trie over dense turn ids and
traverses them. What lies above the cuts, the nodes that many shards share, is put together by aggregates, and the sums
of subtrees are carried up to them by doubling steps, as many as the logarithm of their depth. So neither a beginning that
many conversations share nor a conversation of very many turns has to fit one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from costalloc.llm.common import U, fmix, materialize, whole_groups

GROUP = 20  # conversations c - c % GROUP to the next one may start with turns of the first of them
HEADS = 4  # how many turns at most: below this
SHARD_TURNS = 1 << 10  # turns that may lie below a cut
TABLE_TURNS = 1 << 16  # turns of several shards that are packed into one trie
CHUNK = 1 << 12  # ids put into one piece of an end list
KEY = ["depth", "k1", "k2"]
EMPTY = hashlib.sha256(b"").hexdigest()
S = np.int64


def hashed_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, t1, t2, words): the turns by 128 hash bits of role and text; rows without conv_id go."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    bits = [F.xxhash64(F.lit(k), role, text).alias(f"t{k}") for k in (1, 2)]
    words = F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("bigint").alias("words")
    rows = conversations.where("conv_id IS NOT NULL")
    return rows.select(F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), *bits, words)


# Running values over sorted rows, a conversation's rows possibly in several tasks -----------------------------------


def _running(batches: Iterator[pa.RecordBatch], step, n_out: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """step gives for a batch the values to accumulate (a list of arrays, and the ufunc of each); sums start anew at a conversation."""
    last, carry = None, [S(0)] * n_out
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column(0).to_numpy()
        new = np.ones(len(conv), bool)
        new[1:] = conv[1:] != conv[:-1]
        first = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        out = []
        for k, (values, ufunc, inverse) in enumerate(step(batch)):
            total = ufunc.accumulate(values)
            before = np.where(first > 0, total[first - 1], 0)[group]
            so_far = inverse(total, before)
            if conv[0] == last:
                so_far[: first[1] if len(first) > 1 else len(conv)] = ufunc(so_far[: first[1] if len(first) > 1 else len(conv)], carry[k])
            carry[k] = so_far[-1]
            out.append(so_far)
        last = conv[-1]
        yield batch, out


def _with_carry(rows: DataFrame, totals: dict[str, Column], how) -> DataFrame:
    """Add c_<name> to rows: the totals of the same conversation in earlier tasks (0 if there are none).

    Only the first and the last conversation of a task can lie in other tasks as well, so what is sent to all tasks has
    at most two rows a task.
    """
    edges = rows.groupBy("task").agg(F.array(F.min("conv_id"), F.max("conv_id")).alias("e")).select("task", F.explode("e").alias("conv_id"))
    split = edges.distinct().groupBy("conv_id").agg(F.count("*").alias("n_tasks")).where("n_tasks > 1").select("conv_id")
    parts = rows.join(F.broadcast(split), "conv_id").groupBy("task", "conv_id").agg(*[c.alias(n) for n, c in totals.items()])
    before = Window.partitionBy("conv_id").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select("task", "conv_id", *[F.coalesce(how(n).over(before), F.lit(0)).cast("bigint").alias(f"c_{n}") for n in totals])
    joined = rows.join(F.broadcast(materialize(carried, "carried")), ["task", "conv_id"], "left")
    return joined.withColumns({f"c_{n}": F.coalesce(F.col(f"c_{n}"), F.lit(0)) for n in totals})


def _sorted(rows: DataFrame, *order: str) -> DataFrame:
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("task", F.spark_partition_id())


PLACED = "conv_id bigint, t1 bigint, t2 bigint, words bigint, task int, local bigint"


def placed(turns: DataFrame) -> DataFrame:
    """(conv_id, place, t1, t2, words): turns numbered from 1 in each conversation, null turns first, ties by their hash.

    Rows are range-sorted, so that a conversation may lie in several tasks; each numbers its own and adds what came before.
    """

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ones = lambda batch: [(np.ones(batch.num_rows, S), np.add, np.subtract)]
        for batch, (local,) in _running(batches, ones, 1):
            columns = [batch.column(c) for c in ("conv_id", "t1", "t2", "words", "task")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(local)], names=["conv_id", "t1", "t2", "words", "task", "local"])

    rows = materialize(_sorted(turns, "conv_id", "turn", "t1", "t2").mapInArrow(number, PLACED), "placed")
    numbered = _with_carry(rows, {"n": F.count("*")}, F.sum)
    return numbered.select("conv_id", (F.col("local") + F.col("c_n")).alias("place"), "t1", "t2", "words")


ROLLED = "conv_id bigint, depth bigint, t1 bigint, t2 bigint, words bigint, task int, r1 bigint, r2 bigint, x1 bigint, x2 bigint"


def rolled(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, t1, t2, words, k1, k2, p1, p2): for each turn the keys of its node and of the node above.

    turns: conv_id, depth (from 1, no gaps), t1, t2, words. The key of a node is the exclusive or of a hash of each turn
    and its depth, so the key of the node above is one operation away.
    """

    def roll(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def bits(batch: pa.RecordBatch) -> list:
            depth = fmix(batch.column(1).to_numpy().view(U) * U(0x9E3779B97F4A7C15))
            turns = [fmix(batch.column(k).to_numpy().view(U) + depth).view(S) for k in (2, 3)]
            return [(x, np.bitwise_xor, np.bitwise_xor) for x in turns]

        for batch, keys in _running(batches, bits, 2):
            columns = [*batch.columns, *map(pa.array, keys), *[pa.array(x) for x, _, _ in bits(batch)]]
            yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in ROLLED.split(", ")])

    ordered = _sorted(turns.select("conv_id", "depth", "t1", "t2", "words"), "conv_id", "depth")
    rows = materialize(ordered.mapInArrow(roll, ROLLED), "rolled")
    keyed = _with_carry(rows, {"x1": F.bit_xor("x1"), "x2": F.bit_xor("x2")}, F.bit_xor)
    keys = [F.col(f"r{i}").bitwiseXOR(F.col(f"c_x{i}")) for i in (1, 2)]
    above = [k.bitwiseXOR(F.col(f"x{i}")).alias(f"p{i}") for i, k in zip((1, 2), keys, strict=True)]
    return keyed.select("conv_id", "depth", "t1", "t2", "words", *[k.alias(f"k{i}") for i, k in zip((1, 2), keys, strict=True)], *above)


# Rebuilding ----------------------------------------------------------------------------------------------------------


def rebuilt(turns: DataFrame, group: int = GROUP, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first turns of the first one of their group.

    turns: as `placed` gives them. Gives the conversations (conv_id, n_turns), those without turns included, and the
    turns (conv_id, depth, t1, t2, words). Conversation c takes the first h turns of c - c % group, h = crc32(c) % heads,
    or as many as there are, and its own from the one after h on.
    """
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(heads))
    convs = turns.groupBy("conv_id").agg(F.max("place").alias("n")).withColumn("h", h)
    turn = F.struct("place", "t1", "t2", "words")
    first = turns.where((F.col("place") < heads) & (F.col("conv_id") % group == 0))
    first = first.groupBy(F.col("conv_id").alias("base")).agg(F.array_sort(F.collect_list(turn)).alias("first"))  # below `heads` each
    convs = convs.withColumn("base", F.col("conv_id") - F.col("conv_id") % group).join(first, "base", "left")
    taken = F.coalesce(F.slice("first", F.lit(1), F.col("h").cast("int")), F.array().cast("array<struct<place:bigint,t1:bigint,t2:bigint,words:bigint>>"))
    convs = convs.select("conv_id", "n", "h", taken.alias("first"), F.size(taken).cast("bigint").alias("k"))
    convs = materialize(convs, "conversations")
    own = turns.join(convs.select("conv_id", "h", "k"), "conv_id").where("place > h")
    own = own.select("conv_id", (F.col("k") + F.col("place") - F.col("h")).alias("depth"), "t1", "t2", "words")
    shared = convs.select("conv_id", F.inline("first")).withColumnRenamed("place", "depth")
    n_turns = (F.col("k") + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("n_turns")
    return convs.select("conv_id", n_turns), own.unionByName(shared)


# Equal conversations, and the lists of those that end at a node -----------------------------------------------------

PIECE = "depth bigint, k1 bigint, k2 bigint, first bigint, n bigint, ids binary"


def end_lists(ends: DataFrame) -> DataFrame:
    """(depth, k1, k2, conv_id, n, ends_sha256) of every node where conversations end: the smallest id, how many, and the hash.

    A hash of ids in order can only be made one after the other, in one task. So ids are sorted by ranges, which cut
    through large lists, and joined to pieces of text there; the task of a list streams through its pieces.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in chunks(batches):
            depth, k1, k2, ids = (rows.column(i).to_numpy() for i in range(4))
            new = np.ones(len(ids), bool)
            new[1:] = (depth[1:] != depth[:-1]) | (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
            cuts = np.flatnonzero(new)
            stops = np.append(cuts[1:], len(ids))
            told = [",".join(map(str, ids[a:b].tolist())).encode() for a, b in zip(cuts, stops, strict=True)]
            columns = [pa.array(depth[cuts]), pa.array(k1[cuts]), pa.array(k2[cuts]), pa.array(ids[cuts]), pa.array(stops - cuts), pa.array(told, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["depth", "k1", "k2", "first", "n", "ids"])

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, CHUNK):
                yield batch.slice(i, CHUNK)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, n, sha = None, 0, 0, None
        out: list[tuple] = []

        def told() -> pa.RecordBatch:
            names = [*KEY, "conv_id", "n", "ends_sha256"]
            types = [pa.int64()] * 5 + [pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)

        for batch in batches:
            for depth, k1, k2, low, count, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (depth, k1, k2) != now:
                    if now:
                        out.append((*now, first, n, sha.hexdigest()))
                    now, first, n, sha = (depth, k1, k2), low, 0, hashlib.sha256()
                else:
                    sha.update(b",")
                n += count
                sha.update(ids)
            if len(out) >= CHUNK:
                yield told()
                out = []
        if now:
            out.append((*now, first, n, sha.hexdigest()))
            yield told()

    ordered = ends.select(*KEY, "conv_id").repartitionByRange(*KEY, "conv_id").sortWithinPartitions(*KEY, "conv_id")
    pieces = ordered.mapInArrow(join, PIECE)
    together = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "first")
    return together.mapInArrow(digest, "depth bigint, k1 bigint, k2 bigint, conv_id bigint, n bigint, ends_sha256 string")


# Double arrays -------------------------------------------------------------------------------------------------------


class DoubleArray:
    """A trie in two arrays: a child of slot s by code c lies at BASE[s] + c, and CHECK there is s. Slot 0 is the root."""

    def __init__(self, sequences: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
        """sequences: dense codes from 0; sequence i is the `lengths[i]` codes from `starts[i]` on, its first code its subtree."""
        self.base, self.check = np.zeros(1024, S), np.full(1024, -1, S)
        self.check[0] = 0
        self.free, self.end = 1, 1  # no free slot before; no used slot from there on
        self.slot = np.empty(len(sequences), S)  # where each code leads
        self.levels: list[np.ndarray] = []
        at = np.zeros(len(starts), S)
        alive = np.arange(len(starts))
        depth = 0
        while len(alive := alive[lengths[alive] > depth]):
            place = starts[alive] + depth
            order = np.lexsort((sequences[place], at[alive]))
            state, code = at[alive][order], sequences[place][order]
            new = np.ones(len(state), bool)
            new[1:] = (state[1:] != state[:-1]) | (code[1:] != code[:-1])
            states, codes = state[new], code[new]
            cut = np.flatnonzero(np.r_[True, states[1:] != states[:-1]])
            for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(states)], strict=True):
                self._place(int(states[a]), codes[a:b])
            at[alive] = self.step(at[alive], sequences[place])
            self.slot[place] = at[alive]
            self.levels.append(np.unique(at[alive]))
            depth += 1

    def _place(self, state: int, codes: np.ndarray) -> None:
        """Find a base at which all codes of a state meet free slots: the first free slots are tried, then the open end."""
        while self.free < self.end and self.check[self.free] != -1:
            self.free += 1
        low, span = int(codes[0]), int(codes[-1] - codes[0])
        base, slot = None, self.free
        for _ in range(16):
            if slot + span + 1 >= len(self.check):
                self._grow(slot + span + 2)
            if (self.check[slot - low + codes] == -1).all():
                base = slot - low
                break
            slot += 1
        if base is None:
            base = self.end - low
            self._grow(self.end + span + 2)
        self.base[state] = base
        self.check[base + codes] = state
        self.end = max(self.end, base + int(codes[-1]) + 1)

    def _grow(self, least: int) -> None:
        if least > len(self.check):
            more = max(least, 2 * len(self.check)) - len(self.check)
            self.base = np.r_[self.base, np.zeros(more, S)]
            self.check = np.r_[self.check, np.full(more, -1, S)]

    def step(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """The slots that codes lead to; a step that the trie lacks is an error."""
        to = self.base[states] + codes
        if len(to) and not ((to > 0) & (to < len(self.check))).all() or (self.check[to] != states).any():
            raise ValueError("not in the trie")
        return to


SHARD = ["shard", "u1", "u2", "conv_id", "depth", "k1", "k2", "p1", "p2", "t1", "t2", "words", "n", "ends"]
NODE = (
    "depth bigint, k1 bigint, k2 bigint, p1 bigint, p2 bigint, conv_id bigint, n_convs bigint, n_children bigint, "
    "n_leaves bigint, saved_tokens bigint, ends_sha256 string, top boolean, parent_conv_id bigint"
)


def _dense(*columns: np.ndarray) -> np.ndarray:
    """Numbers from 0 without gaps for the distinct rows."""
    order = np.lexsort(columns)
    new = np.zeros(len(order), bool)
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    out = np.empty(len(order), S)
    out[order] = np.cumsum(new)
    return out


def shard_nodes(rows: pa.Table) -> pa.RecordBatch:
    """The nodes of whole subtrees. rows: columns of SHARD, sorted by subtree, conversation and depth."""
    col = {name: rows.column(name).to_numpy() for name in SHARD if name not in ("shard", "ends")}
    conv, unit1, unit2 = col["conv_id"], col["u1"], col["u2"]
    new = np.ones(len(conv), bool)
    new[1:] = (conv[1:] != conv[:-1]) | (unit1[1:] != unit1[:-1]) | (unit2[1:] != unit2[:-1])
    starts = np.flatnonzero(new)
    lengths = np.diff(np.append(starts, len(conv)))
    codes = _dense(col["t1"], col["t2"])
    # the first step of a path is its subtree, by the key of its top
    codes[starts] = _dense(col["k1"][starts], col["k2"][starts], col["depth"][starts])
    trie = DoubleArray(codes, starts, lengths)
    slots, some = np.unique(trie.slot, return_index=True)  # one row of each node tells what its rows share
    size = len(trie.check)
    count, least = np.zeros(size, S), np.full(size, np.iinfo(S).max)
    np.add.at(count, trie.slot, col["n"])
    np.minimum.at(least, trie.slot, conv)
    words = np.zeros(size, S)
    words[slots] = col["words"][some]
    children = np.bincount(trie.check[slots], minlength=size)
    leaves = (children == 0).astype(S)
    saved = (count - 1) * words
    for level in reversed(trie.levels[1:]):
        np.add.at(leaves, trie.check[level], leaves[level])
        np.add.at(saved, trie.check[level], saved[level])
    ends = np.full(size, EMPTY, object)
    told = rows.combine_chunks().column("ends").chunk(0)
    has = np.flatnonzero(told.is_valid().to_numpy(zero_copy_only=False))
    ends[trie.slot[has]] = told.take(pa.array(has)).to_pylist()
    top = trie.check[slots] == 0
    parent = pa.array(least[trie.check[slots]], mask=top)
    out = [col[c][some] for c in ("depth", "k1", "k2", "p1", "p2")] + [x[slots] for x in (least, count, children, leaves, saved)]
    columns = [*map(pa.array, out), pa.array(ends[slots].tolist(), pa.string()), pa.array(top), parent]
    return pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in NODE.split(", ")])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in whole_groups(batches, TABLE_TURNS):
        yield shard_nodes(rows)


# The whole tree ------------------------------------------------------------------------------------------------------


def _carried_up(nodes: DataFrame) -> DataFrame:
    """nodes: key, parent key, leaves, saved. Sums over subtrees by doubling: after k steps a node has all that lies fewer than 2**k below."""
    steps = int(nodes.agg(F.max("depth")).first()[0] or 0)
    now = nodes.select(*KEY, F.col("p1").alias("a1"), F.col("p2").alias("a2"), (F.col("depth") - 1).alias("a"), "leaves", "saved")
    reach = 1
    while reach <= steps:
        sent = now.where("a >= 0").groupBy(F.col("a").alias("depth"), F.col("a1").alias("k1"), F.col("a2").alias("k2"))
        sent = sent.agg(F.sum("leaves").alias("more"), F.sum("saved").alias("more_saved"))
        above = now.select(F.col("depth").alias("a"), F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.col("a").alias("b"), F.col("a1").alias("b1"), F.col("a2").alias("b2"))
        joined = now.join(sent, KEY, "left").join(above, ["a", "a1", "a2"], "left")
        now = materialize(
            joined.select(
                *KEY, F.col("b1").alias("a1"), F.col("b2").alias("a2"), F.coalesce("b", F.lit(-1)).alias("a"),
                (F.col("leaves") + F.coalesce("more", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            ),
            "upper",
        )
        reach *= 2
    return now.select(*KEY, "leaves", "saved")


def prefix_tree(conversations: DataFrame, group: int = GROUP, heads: int = HEADS, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node of the prefix tree of the rebuilt conversations.

    conversations: conv_id, turn, role, text. conv_id: the smallest member; depth; parent_conv_id: that of the node above
    (null at the root); n_convs: members; n_children; n_leaves: childless nodes in the subtree, itself included;
    saved_tokens: words that need not be stored twice, over the subtree; ends_sha256: hash of the ids, in order, of the
    conversations that end here. Turns are taken in the order of `turn`, null first, those with one number in the
    order of their hash; gaps in the numbers don't matter, and a repeated row is a turn like any other. Null roles and
    texts are empty. Rows without conv_id belong to no conversation. A conversation without turns ends at the root.
    An empty table gives no rows. Other columns are ignored. shard_turns: how many turns may lie below a cut; it changes
    the layout, not the result.
    """
    turns = placed(hashed_turns(conversations))
    convs, built = rebuilt(turns, group, heads)
    paths = materialize(rolled(built), "paths")
    at_end = paths.select("conv_id", F.col("depth").alias("n_turns"), "k1", "k2")
    ends = convs.join(at_end, ["conv_id", "n_turns"], "left").select(
        "conv_id", F.col("n_turns").alias("depth"), *[F.coalesce(k, F.lit(0)).cast("bigint").alias(k) for k in ("k1", "k2")]
    )
    alone = materialize(end_lists(ends), "ends")  # equal conversations by the smallest
    total = F.col("depth").alias("n_turns")
    paths = paths.join(alone.select("conv_id", "n", total, "ends_sha256"), "conv_id")
    paths = materialize(paths.withColumn("ends", F.when(F.col("depth") == F.col("n_turns"), F.col("ends_sha256"))).drop("ends_sha256"), "distinct")

    # where a path is cut: the first depth that is a power of two below which few turns lie
    marks = paths.where(F.col("depth").bitwiseAND(F.col("depth") - 1) == 0)
    below = marks.groupBy(*KEY).agg(F.sum(F.col("n_turns") - F.col("depth") + 1).alias("below"))
    light = marks.join(below.where(F.col("below") <= shard_turns), KEY, "left_semi")
    cut = light.groupBy("conv_id").agg(F.min(F.struct("depth", "k1", "k2")).alias("cut"))
    dealt = paths.join(cut.select("conv_id", F.col("cut.depth").alias("cut"), F.col("cut.k1").alias("u1"), F.col("cut.k2").alias("u2")), "conv_id", "left")

    lower = dealt.where("depth >= cut").withColumn("shard", F.xxhash64("cut", "u1", "u2")).select(*SHARD)
    lower = lower.repartition("shard").sortWithinPartitions("shard", "u1", "u2", "conv_id", "depth")
    lower = materialize(lower.mapInArrow(_shards, NODE), "lower")

    root = alone.select(
        "conv_id", F.lit(0).cast("bigint").alias("depth"), *[F.lit(0).cast("bigint").alias(k) for k in ("k1", "k2", "p1", "p2")],
        F.lit(0).cast("bigint").alias("words"), "n", F.when(F.col("depth") == 0, F.col("ends_sha256")).alias("ends"),
    )
    upper = dealt.where("cut IS NULL OR depth < cut").select(root.columns).unionByName(root)
    upper = upper.groupBy(*KEY).agg(
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("words").alias("words"),
        F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("ends").alias("ends"),
    )
    upper = materialize(upper, "upper")
    tops = lower.where("top")
    child = upper.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"), F.lit(0).alias("leaves"), F.lit(0).alias("saved"))
    child = child.unionByName(tops.select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved")))
    child = child.groupBy(*KEY).agg(F.count("*").alias("n_children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    own = upper.join(child, KEY, "left").select(
        *upper.columns, F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.when(F.col("n_children").isNull(), 1).otherwise(F.col("leaves")).cast("bigint").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words") + F.coalesce("saved", F.lit(0))).alias("saved"),
    )
    own = materialize(own, "upper")
    summed = own.drop("leaves", "saved").join(_carried_up(own), KEY)

    names = upper.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    result = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    ended = F.coalesce("ends", F.lit(EMPTY)).alias("ends_sha256")
    high = summed.join(names, ["depth", "p1", "p2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), ended
    )
    first = tops.drop("parent_conv_id").join(names, ["depth", "p1", "p2"], "left").select(result)
    return high.unionByName(first).unionByName(lower.where("NOT top").select(result))
