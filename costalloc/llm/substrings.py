"""Substring deduplication by suffix automata.

A word goes if a run of SIZE words around it also stands in a document with a smaller doc_id. Suffix automata of the
reference texts tell, for every place of a document that is streamed through them, the first document in which the
last SIZE words occur; runs of such places are the maximal spans to remove.

Automata of a whole corpus would have to meet every document. Instead, the corpus is cut into reference shards in
such a way that a document has to meet only shards it can share something with: every run of SIZE words has an anchor,
the ANCHOR words in it with the smallest hash, and equal runs have equal anchors. Anchors that only one document has
are left out; for the others, the words around them are dealt by anchor, and a task builds the automaton of a shard of
anchors and streams the pieces of all documents that have them. So shards are shipped to the pieces that need them
instead of being broadcast to all, and each task's automaton is of bounded size.

An anchor that very many documents have, in texts that may all differ, is replaced by the runs around it, so that no
anchor gathers an unbounded group. In a block of documents equal pieces are sent once, however often they occur.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costalloc.llm.common import U, Words, block_of, buffers, fmix, n_blocks, slices, whole_groups, windows

SIZE, ANCHOR = 13, 4
HOT = 20_000  # documents beyond which an anchor is replaced by the runs around it
SHARD = 30_000  # words in an automaton, more only if one anchor's pieces need it
NONE = (1 << 63) - 1  # no document


# Anchors ------------------------------------------------------------------


class Runs:
    """The runs of SIZE words of some documents, by anchor: consecutive runs with one anchor form a piece."""

    def __init__(self, words: Words, size: int, anchor: int):
        self.words, self.size = words, size
        self.hashes = words.hashes()
        empty = np.empty(0, np.int64)
        self.start = self.end = empty  # first and last run of each piece, by first word
        self.anchor = np.empty(0, U)
        grams, _ = windows(self.hashes, words.doc, anchor)
        n = len(self.hashes) - size + 1
        if n <= 0:
            return
        span = size - anchor + 1  # grams in a run
        best = np.arange(len(grams))
        width = 1
        while width < span:  # the leftmost smallest gram of ever wider ranges
            step = min(width, span - width)
            left, right = best[: len(best) - step], best[step:]
            best = np.where(grams[left] <= grams[right], left, right)
            width += step
        runs = np.flatnonzero(words.doc[:n] == words.doc[size - 1 :])
        if not len(runs):
            return
        at = best[runs]
        new = np.concatenate([[True], (at[1:] != at[:-1]) | (np.diff(runs) != 1)])
        begin = np.flatnonzero(new)
        self.start, self.end = runs[begin], runs[np.concatenate([begin[1:], [len(runs)]]) - 1]
        self.anchor = grams[at[begin]]

    def doc_rows(self) -> np.ndarray:
        """The document of each piece."""
        return self.words.doc[self.start]

    def pieces(self, hot: np.ndarray, shared: np.ndarray | None = None) -> tuple:
        """(key, content hash, first run, last run) of the pieces of shared (or all) anchors; of hot ones run by run."""
        held = np.ones(len(self.anchor), bool) if shared is None else _among(self.anchor, shared)
        crowded = held & _among(self.anchor, hot)
        plain = held & ~crowded
        start, end, key = self.start[plain], self.end[plain], self.anchor[plain]
        n = (self.end - self.start + 1)[crowded]
        single = np.repeat(self.start[crowded], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        all_start, all_end = np.concatenate([start, single]), np.concatenate([end, single])
        content = self._content(all_start, all_end + self.size)
        key = np.concatenate([key, fmix(content[len(start) :])])
        return key, content, all_start, all_end

    def _content(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hash of the words first..last-1."""
        n = len(self.hashes)
        sums = np.zeros(n + 1, U)
        power = np.full(n + 1, U(0x9E3779B97F4A7C15))
        power[0] = 1
        power = np.multiply.accumulate(power)
        np.cumsum(self.hashes * power[:n], out=sums[1:])
        inverse = np.full(n + 1, U(pow(0x9E3779B97F4A7C15, -1, 1 << 64)))
        inverse[0] = 1
        inverse = np.multiply.accumulate(inverse)
        return fmix((sums[last] - sums[first]) * inverse[first] + (last - first).astype(U))


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


def _ids(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    return column.fill_null(NONE).to_numpy(), column.is_valid().to_numpy()


# Automaton ----------------------------------------------------------------


class Automaton:
    """Suffix automaton of several word sequences; each state knows the smallest document it occurs in."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.first = [-1], [0], [NONE]

    def _clone(self, of: int, length: int) -> int:
        self.next.append(self.next[of].copy())
        self.link.append(self.link[of])
        self.length.append(length)
        self.first.append(NONE)
        return len(self.length) - 1

    def _split(self, p: int, c, q: int) -> int:
        """The state of p's words followed by c, taken out of the longer state q."""
        following, link = self.next, self.link
        clone = self._clone(q, self.length[p] + 1)
        while p >= 0 and following[p].get(c) == q:
            following[p][c] = clone
            p = link[p]
        link[q] = clone
        return clone

    def add(self, sequence: list, doc: int) -> None:
        following, link, length, first = self.next, self.link, self.length, self.first
        last = 0
        for c in sequence:
            q = following[last].get(c)
            if q is not None:  # known from another sequence
                last = q if length[q] == length[last] + 1 else self._split(last, c, q)
            else:
                new = len(length)
                following.append({})
                link.append(0)
                length.append(length[last] + 1)
                first.append(NONE)
                p = last
                while p >= 0 and c not in following[p]:
                    following[p][c] = new
                    p = link[p]
                if p >= 0:
                    q = following[p][c]
                    link[new] = q if length[q] == length[p] + 1 else self._split(p, c, q)
                last = new
            if doc < first[last]:
                first[last] = doc

    def finish(self) -> None:
        """What occurs at the end of a longer text occurs in its document."""
        first, link = self.first, self.link
        for state in sorted(range(1, len(first)), key=self.length.__getitem__, reverse=True):
            up = link[state]
            if first[state] < first[up]:
                first[up] = first[state]

    def statistics(self, sequence: list, size: int) -> list[int]:
        """Stream a sequence: for each place where its last `size` words match, the smallest document with them."""
        following, link, length, first = self.next, self.link, self.length, self.first
        state = matched = 0
        out = []
        for c in sequence:
            while state and c not in following[state]:
                state = link[state]
                matched = length[state]
            if c in following[state]:
                state = following[state][c]
                matched += 1
            while state and length[link[state]] >= size:  # only the last `size` words matter
                state = link[state]
                matched = length[state]
            out.append(first[state] if matched >= size else NONE)
        return out


def first_documents(rows: list[tuple], size: int) -> list[bytes]:
    """For pieces (content id, text, document): the smallest document of each run in it, as 64-bit numbers.

    Equal pieces are put into the automaton once, with their smallest document.
    """
    docs: dict = {}
    texts: dict = {}
    for content, text, doc in rows:
        if doc < docs.get(content, NONE + 1):
            docs[content] = doc
        texts.setdefault(content, text)
    automaton, numbers, told = Automaton(), {}, {}
    for content, text in texts.items():
        told[content] = [numbers.setdefault(w, len(numbers)) for w in text.split()]
        automaton.add(told[content], docs[content])
    automaton.finish()
    found = {c: np.array(automaton.statistics(s, size)[size - 1 :], "<i8").tobytes() for c, s in told.items()}
    return [found[content] for content, _, _ in rows]


# Spark --------------------------------------------------------------------

SEEN = "anchor bigint, block int, n_docs bigint, first_doc bigint"
SHARED = "block int, anchor bigint, hot boolean"
PIECE = "key bigint, content bigint, block int, doc_id bigint, several boolean, piece binary"
FIRST = "block int, content bigint, first_docs binary"


def _arrow(schema: str, *columns) -> pa.Table:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    arrays = [c if isinstance(c, pa.Array | pa.ChunkedArray) else pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)]
    return pa.table(arrays, names=[n for n, _ in fields])


def _parts(texts: pa.ChunkedArray) -> Iterator[tuple[int, int, Words]]:
    data, offsets = buffers(texts)
    for i, j in slices(offsets, 1 << 22):
        yield i, j, Words(data, offsets[i : j + 1])


def _seen(size: int, anchor: int):
    """Block (block, doc_id, text): each anchor once, with the number of documents and the smallest."""

    def run(key, rows):
        ids, named = _ids(rows["doc_id"])
        found, docs = [np.empty(0, U)], [np.empty(0, np.int64)]
        for i, _, words in _parts(rows["text"]):
            runs = Runs(words, size, anchor)
            row = runs.doc_rows() + i
            found.append(runs.anchor[named[row]])
            docs.append(ids[row[named[row]]])
        anchors, doc = np.concatenate(found), np.concatenate(docs)
        order = np.lexsort((doc, anchors))
        anchors, doc = anchors[order], doc[order]
        new = np.concatenate([[True], anchors[1:] != anchors[:-1]])[: len(anchors)]
        other = new | np.concatenate([[True], doc[1:] != doc[:-1]])[: len(anchors)]
        begin = np.flatnonzero(new)
        n_docs = np.add.reduceat(other.astype(np.int64), begin) if len(begin) else np.empty(0, np.int64)
        block = np.full(len(begin), key[0].as_py(), np.int32)
        return _arrow(SEEN, anchors[begin].view(np.int64), block, n_docs, doc[begin])

    return run


def _shared(hot: int):
    """Rows sorted by anchor: those of anchors that two documents have, with whether over `hot` have them."""

    def flush(rows: pa.Table) -> pa.Table:
        anchor, block, n_docs, first = (rows.column(i).to_numpy() for i in range(4))
        begin = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        width = np.diff(np.concatenate([begin, [len(anchor)]]))
        total = np.repeat(np.add.reduceat(n_docs, begin), width)
        single = np.repeat(np.minimum.reduceat(first, begin) == np.maximum.reduceat(first, begin), width)
        # a document may be repeated in two blocks: it is one document
        keep = (total > 1) & ~(single & (total == np.repeat(width, width)))
        return _arrow(SHARED, block[keep], anchor[keep], (total > hot)[keep])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, 500_000):
            yield from flush(rows).to_batches()

    return run


def _cut(size: int, anchor: int):
    """Block and its shared anchors: each different piece once, with its smallest document, and whether it has more."""

    def run(key, rows, shared):
        wanted = shared["anchor"].to_numpy().view(U)
        hot = np.sort(wanted[shared["hot"].to_numpy()])
        wanted = np.sort(wanted)
        ids, named = _ids(rows["doc_id"])
        keys, contents, docs, more, texts = [], [], [], [], []
        for i, _, words in _parts(rows["text"]) if len(wanted) else ():
            runs = Runs(words, size, anchor)
            k, content, start, end = runs.pieces(hot, wanted)
            row = words.doc[start] + i
            order = np.lexsort((ids[row], content))
            order = order[named[row][order]]
            new = np.concatenate([[True], content[order][1:] != content[order][:-1]])[: len(order)]
            last = ids[row[order]][np.concatenate([np.flatnonzero(new)[1:], [len(order)]]) - 1] if len(order) else ids[:0]
            order = order[new]
            more.append(last > ids[row[order]])
            keys.append(k[order])
            contents.append(content[order])
            docs.append(ids[row[order]])
            data = words.data.tobytes()
            low, high = words.starts[start[order]], words.ends[end[order] + size - 1]
            texts += [data[s:e] for s, e in zip(low.tolist(), high.tolist(), strict=True)]
        if not keys:
            return _arrow(PIECE, [], [], [], [], [], [])
        k, content = np.concatenate(keys).view(np.int64), np.concatenate(contents).view(np.int64)
        return _arrow(PIECE, k, content, np.full(len(k), key[0].as_py(), np.int32), np.concatenate(docs), np.concatenate(more), texts)

    return run


def _match(size: int):
    """Pieces sorted by key: automata of whole keys, about SHARD words each, and what streaming the pieces tells."""

    def flush(keys, contents, blocks, docs, several, texts) -> pa.Table:
        rows = [((k, c), t, d) for k, c, t, d in zip(keys, contents, texts, docs, strict=True)]
        found = first_documents(rows, size)
        # a block need not hear of a piece that only one of its documents has, and that one first
        own = [d.to_bytes(8, "little", signed=True) for d in docs]
        told = [i for i, f in enumerate(found) if several[i] or f != own[i] * (len(f) // 8)]
        return _arrow(FIRST, [blocks[i] for i in told], [contents[i] for i in told], [found[i] for i in told])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, 5_000):
            columns = [c.to_pylist() for c in rows.columns]
            begin = total = 0
            keys, texts = columns[0], columns[5]
            for i in range(len(keys)):
                total += len(texts[i]) // 6
                if i + 1 == len(keys) or total >= SHARD and keys[i + 1] != keys[i]:
                    yield from flush(*(c[begin : i + 1] for c in columns)).to_batches()
                    begin, total = i + 1, 0

    return run


def covered_words(words: Words, first_row: int, ids: np.ndarray, named: np.ndarray, size: int, anchor: int,
                  hot: np.ndarray, found: tuple) -> np.ndarray:
    """Whether each word is in a run that a smaller document has."""
    n = len(words.starts)
    contents, begins, counts, firsts = found
    if not len(contents) or not n:
        return np.zeros(n, bool)
    runs = Runs(words, size, anchor)
    _, content, start, end = runs.pieces(hot)
    known = _among(content, contents)
    content, start, end = content[known], start[known], end[known]
    at = np.searchsorted(contents, content)
    wide = end - start + 1
    assert (counts[at] == wide).all()
    run = np.repeat(start, wide) + np.arange(wide.sum()) - np.repeat(np.cumsum(wide) - wide, wide)
    value = firsts[np.repeat(begins[at], wide) + run - np.repeat(start, wide)]
    row = words.doc[run] + first_row
    gone = run[named[row] & (value < ids[row])]
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, gone, 1)
    np.add.at(change, gone + size, -1)
    return np.cumsum(change[:n]) > 0


def _found(rows: pa.Table) -> tuple:
    """Sorted contents, where each one's numbers begin, how many they are, and the numbers."""
    content = rows["content"].to_numpy().view(U)
    told = rows["first_docs"].combine_chunks() if rows.num_rows else None
    if told is None:
        return content, content, content, content
    if isinstance(told, pa.ChunkedArray):
        told = pa.concat_arrays(told.chunks)
    data, offsets = buffers(told)
    numbers = np.frombuffer(data[offsets[0] : offsets[-1]].tobytes(), "<i8")
    begin = (offsets[:-1].astype(np.int64) - int(offsets[0])) // 8
    count = np.diff(offsets).astype(np.int64) // 8
    order = np.argsort(content, kind="stable")
    return content[order], begin[order], count[order], numbers


KEPT = "n_words bigint, n_removed bigint"


def _remove(size: int, anchor: int, columns: list[str], digest: bool):
    """Block, what the automata told and the block's hot anchors: the documents without repeated words."""

    def run(rows: pa.Table, told: pa.Table) -> pa.Table:
        split = told["first_docs"].is_valid()
        first = told.filter(split)
        hot = np.sort(told.filter(pc.invert(split))["content"].to_numpy().view(U))
        found = _found(first)
        ids, named = _ids(rows["doc_id"])
        n_words, n_removed, texts = [], [], []
        for i, j, words in _parts(rows["text"]):
            gone = covered_words(words, i, ids, named, size, anchor, hot, found)
            n_words += words.counts.tolist()
            removed = np.bincount(words.doc[gone], minlength=words.n_docs).tolist()
            n_removed += removed
            data, bounds = words.data.tobytes(), words.offsets.tolist()
            for d in range(j - i):
                text = data[bounds[d] : bounds[d + 1]]
                if removed[d]:
                    stay = (~gone[words.first[d] : words.first[d + 1]]).tolist()
                    text = b" ".join(compress(text.split(), stay))
                elif digest:
                    text = b" ".join(text.split())
                texts.append(hashlib.sha256(text).hexdigest().encode() if digest else text)
        text = pa.array(texts, pa.binary()).cast(pa.string())
        if digest:
            return pa.table([rows["doc_id"], text, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())],
                            names=["doc_id", "kept_sha256", "n_words", "n_removed"])
        out = {name: text if name == "text" else rows[place] for place, name in enumerate(columns)}
        table = pa.table(list(out.values()), names=list(out))
        return table.append_column("n_words", pa.array(n_words, pa.int64())).append_column("n_removed", pa.array(n_removed, pa.int64()))

    return run


def remove_repeats(docs: DataFrame, size: int = SIZE, digest: bool = False, anchor: int = ANCHOR, hot: int = HOT) -> DataFrame:
    """Documents without the words of runs of `size` words that also start in a document with a smaller doc_id.

    docs: doc_id, text. Runs are judged on the input. Returns all columns of docs, with n_words (before) and
    n_removed behind them; the text is unchanged if nothing is removed, else the words left, joined by one space.
    With `digest` instead (doc_id, kept_sha256, n_words, n_removed), the SHA-256 of the words left joined by one space.
    Null texts are empty; texts of fewer than `size` words are unchanged. Rows without doc_id lose nothing and cost
    others nothing. Rows repeated with one doc_id are one document. The texts are shuffled once, into blocks that
    every step reads again.
    """
    columns = [c for c in docs.columns if c not in ("n_words", "n_removed")]
    n = n_blocks(docs)
    kinds = dict(docs.dtypes)
    if kinds["doc_id"] != "bigint":
        docs = docs.withColumn("doc_id", F.col("doc_id").cast("bigint"))
    filled = docs.withColumn("text", F.coalesce(F.col("text"), F.lit("")))
    if digest:
        columns, filled = ["doc_id", "text"], filled.select("doc_id", "text")
    # by number, so that columns of any name don't clash
    names = {c: c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(columns)}
    blocks = filled.select(*columns).toDF(*names.values()).withColumn("block", block_of(n, "doc_id", "text"))
    schema = "doc_id bigint, kept_sha256 string, " + KEPT
    if not digest:  # nested types as they are, with what they say of nulls
        counts = [T.StructField(c, T.LongType()) for c in ("n_words", "n_removed")]
        schema = T.StructType([*[T.StructField(names[c], filled.schema[c].dataType) for c in columns], *counts])

    key_text = blocks.select("block", *names.values())
    grouped = key_text.groupBy("block")
    seen = grouped.applyInArrow(_seen(size, anchor), SEEN)
    dealt = seen.repartition("anchor").sortWithinPartitions("anchor")
    shared = dealt.mapInArrow(_shared(hot), SHARED)
    pieces = grouped.cogroup(shared.groupBy("block")).applyInArrow(_cut(size, anchor), PIECE)
    firsts = pieces.repartition("key").sortWithinPartitions("key").mapInArrow(_match(size), FIRST)
    crowded = shared.where("hot").select("block", F.col("anchor").alias("content"), F.lit(None).cast("binary").alias("first_docs"))
    told = firsts.unionByName(crowded)
    inner = [names[c] for c in columns]
    act = _remove(size, anchor, inner, digest)

    def finish(key, rows, answers):
        return act(rows.select(inner), answers)

    out = grouped.cogroup(told.groupBy("block")).applyInArrow(finish, schema)
    return out if digest else out.toDF(*columns, "n_words", "n_removed")
