"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items are sequences of tokens: runs of letters and digits, A-Z lower-cased, so that case and
punctuation don't hide a copy; in scripts without spaces each character. Runs of LEAST tokens of an item are its seeds,
and an item of fewer tokens is one seed, found only as a whole. A document that shares enough seeds with
an item is tiled against it: the longest common runs that don't overlap are marked again and again, found by running
Karp-Rabin hashes. The share of the item's tokens that the tiles cover decides. Tiles may come in any order, so a
reordered passage is found as well.
"""

from __future__ import annotations

import heapq
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costalloc.llm.common import U, Words, batched_words, block_of, materialize, n_blocks, text_or_empty, windows

LEAST = 5  # tokens in a tile
COVERAGE = 0.5
FIRST_LENGTH = 20
HITS = 1 << 20  # shared seeds that a task holds at once
BLOCK_BYTES = 16 << 20  # benchmark text sent to the tasks at once; more of it makes more passes
_FILTER = 1 << 20
_STEP = U(0x2545F4914F6CDD1D)

NOT_TOKEN = np.ones(256, bool)
for _low, _high in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    NOT_TOKEN[_low:_high] = False

# Scripts written without spaces: Thai, Lao, Myanmar, Khmer, Tai, Balinese and Javanese, Chinese and Japanese.
UNSPACED = (
    (0xE00, 0xF00), (0x1000, 0x10A0), (0x1780, 0x1800), (0x1950, 0x19E0), (0x1A20, 0x1AB0), (0x1B00, 0x1B80),
    (0x2E80, 0x2FE0), (0x3005, 0x3008), (0x3021, 0x302A), (0x3031, 0x3036), (0x3040, 0x3130), (0x31A0, 0x3200),
    (0x3400, 0x4DC0), (0x4E00, 0xA000), (0xA980, 0xAA00), (0xAA60, 0xAA80), (0xF900, 0xFB00), (0xFF66, 0xFFA0),
    (0x1AFF0, 0x1B170), (0x20000, 0x40000),
)
BREAK, INSIDE, ALONE = range(3)


@cache
def character_kinds() -> np.ndarray:
    """For each code point: whether it parts tokens, stands inside one, or is one."""
    kinds = np.full(0x110000, BREAK, np.uint8)
    kinds[:0x20000] = [INSIDE if unicodedata.category(chr(c))[0] in "LMN" else BREAK for c in range(0x20000)]
    for low, high in UNSPACED:
        part = kinds[low:high]
        part[(part == INSIDE) | (low >= 0x20000)] = ALONE
    return kinds


class Tokens(Words):
    """Words whose bytes from 0x80 up are judged as characters."""

    def mark(self, cut: np.ndarray) -> None:
        n = len(self.data)
        lead = np.flatnonzero(self.data >= 0xC0)
        if not len(lead):
            return
        first = self.data[lead].astype(np.int64)
        size = 2 + (first >= 0xE0) + (first >= 0xF0)
        code = first & (0x7F >> size)
        for k in range(1, 4):
            more = size > k
            code[more] = code[more] << 6 | self.data[np.minimum(lead[more] + k, n - 1)] & 0x3F
        kind = character_kinds()[np.minimum(code, 0x10FFFF)]
        for k in range(4):
            self.inside[np.minimum(lead[(kind == BREAK) & (size > k)] + k, n - 1)] = False
        lone, size = lead[kind == ALONE], size[kind == ALONE]
        cut[lone] = True
        cut[np.minimum(lone + size, n)] = True


def run_hashes(tokens: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hash of every run of `size` tokens, each from the running sum of the one before."""
    n = len(tokens)
    powers = np.full(n + 1, _STEP, U)
    powers[0] = 1
    powers = np.multiply.accumulate(powers)
    sums = np.zeros(n + 1, U)
    np.cumsum(tokens * powers[:n], out=sums[1:])
    # the run at i is weighted by powers[i]: bring all to the weight of the last one
    return (sums[size:] - sums[:-size]) * powers[n - size :: -1][: n - size + 1]


def _free(marked: np.ndarray, size: int) -> np.ndarray:
    """Places where a run of `size` unmarked tokens begins."""
    begun = np.concatenate([[0], np.cumsum(marked)])
    return begun[size:] == begun[:-size]


def _common_runs(item: np.ndarray, text: np.ndarray, used_i: np.ndarray, used_t: np.ndarray, size: int) -> list[tuple]:
    """(-length, place in item, place in text) of the maximal common unmarked runs of at least `size` tokens."""
    if min(len(item), len(text)) < size:
        return []
    at_i, at_t = np.flatnonzero(_free(used_i, size)), np.flatnonzero(_free(used_t, size))
    hash_i, hash_t = run_hashes(item, size)[at_i], run_hashes(text, size)[at_t]
    # the two sums end at other places, so their weights differ: bring the item's to the text's
    scale = pow(int(_STEP), len(text) - len(item), 1 << 64) if len(text) >= len(item) else pow(pow(int(_STEP), -1, 1 << 64), len(item) - len(text), 1 << 64)
    hash_i = hash_i * U(scale)
    order = np.argsort(hash_t, kind="stable")
    hash_t, at_t = hash_t[order], at_t[order]
    low, high = np.searchsorted(hash_t, hash_i, "left"), np.searchsorted(hash_t, hash_i, "right")
    n = high - low
    if not n.sum():
        return []
    i = np.repeat(at_i, n)
    t = at_t[np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
    order = np.lexsort((i, t - i))  # runs along one diagonal
    i, t = i[order], t[order]
    new = np.concatenate([[True], (np.diff(i) != 1) | (np.diff(t) != 1)])
    begin = np.flatnonzero(new)
    length = np.diff(np.concatenate([begin, [len(i)]])) + size - 1
    return list(zip((-length).tolist(), i[begin].tolist(), t[begin].tolist(), strict=True))


def tiles(item: np.ndarray, text: np.ndarray, least: int = LEAST) -> list[tuple[int, int, int]]:
    """(place in item, place in text, length) of the greedy tiling: longest first, no token in two tiles.

    Runs are sought at a length that adapts: the longest found if it is much longer, then halves of it down to `least`.
    """
    used_i, used_t = np.zeros(len(item), bool), np.zeros(len(text), bool)
    out, size = [], max(least, min(FIRST_LENGTH, len(item)))
    while True:
        runs = _common_runs(item, text, used_i, used_t, size)
        if runs and -min(runs)[0] > 2 * size:
            size = -min(runs)[0]
            continue
        heapq.heapify(runs)
        while runs:
            length, i, t = heapq.heappop(runs)
            taken = used_i[i : i - length] | used_t[t : t - length]
            if not taken.any():
                used_i[i : i - length] = used_t[t : t - length] = True
                out.append((i, t, -length))
                continue
            edges = np.flatnonzero(np.diff(np.concatenate([[1], taken, [1]])))
            for s, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
                if e - s >= size:
                    heapq.heappush(runs, (s - e, i + s, t + s))
        if size <= least:
            return out
        size = max(least, size // 2)


class Benchmark:
    """Items as token arrays, and an index of their seeds."""

    def __init__(self, ids: list[int], texts: list[bytes], least: int):
        data = np.frombuffer(b"".join(texts), np.uint8)
        words = Tokens(data, np.concatenate([[0], np.cumsum([len(t) for t in texts])]), NOT_TOKEN)
        hashes = words.hashes(lower=True)
        self.ids, self.full = ids, least
        self.items = [hashes[s:e] for s, e in zip(words.first[:-1], words.first[1:], strict=True)]
        self.sizes = words.counts
        self.least = np.minimum(least, words.counts)  # of each item, the tokens in a seed or tile
        self.index = {}  # by tokens in a seed: seeds, items, places, and a filter
        for size in np.unique(self.least[self.least > 0]).tolist():
            seeds, whole = windows(hashes, words.doc, size)
            at = np.flatnonzero(whole & (self.least[words.doc[: len(whole)]] == size))
            order = np.argsort(seeds[at], kind="stable")
            seeds, item = seeds[at][order], words.doc[at][order]
            likely = np.zeros(_FILTER, bool)
            likely[seeds >> U(44)] = True
            self.index[size] = seeds, item, at[order] - words.first[item], likely

    def shared_seeds(self, words: Words, hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(document, item, place in item) of every seed that a document shares, for some documents after the others.

        A seed counts once for a document, however often it stands there. Documents come in batches of about HITS such
        rows, so a seed that many documents and many items share fills no more memory than that.
        """
        found = [(np.empty(0, np.int64),) * 4]
        for size, (seeds, _, _, likely) in self.index.items():
            runs, whole = windows(hashes, words.doc, size)
            at = np.flatnonzero(likely[runs >> U(44)] & whole)
            low = np.searchsorted(seeds, runs[at], "left")
            at, low = at[low < len(seeds)], low[low < len(seeds)]
            same = seeds[low] == runs[at]
            pairs = np.unique(words.doc[at[same]] * len(seeds) + low[same])
            low = pairs % len(seeds)
            n = np.searchsorted(seeds, seeds[low], "right") - low
            found.append((pairs // len(seeds), low, n, np.full(len(low), size)))
        doc, low, n, size = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.argsort(doc, kind="stable")
        doc, low, n, size = doc[order], low[order], n[order], size[order]
        ends = np.flatnonzero(np.diff(doc, append=-1)) + 1  # after the last row of each document
        total = np.concatenate([[0], np.cumsum(n)])
        s = 0
        while s < len(doc):
            fits = ends[(ends > s) & (total[ends] <= total[s] + HITS)]
            e = int(fits[-1]) if len(fits) else int(ends[ends > s][0])
            parts = []
            for one, (_, item, place, _) in self.index.items():
                mine = np.flatnonzero(size[s:e] == one) + s
                hit = np.repeat(low[mine], n[mine]) + np.arange(n[mine].sum()) - np.repeat(np.cumsum(n[mine]) - n[mine], n[mine])
                parts.append((np.repeat(doc[mine], n[mine]), item[hit], place[hit]))
            yield tuple(np.concatenate(x) for x in zip(*parts, strict=True))
            s = e

    def judge(self, words: Words, coverage: float) -> list[tuple]:
        """(document, item, item tokens, covered tokens, tiles, longest tile, alone) of pairs covered enough.

        alone: whether the item is of full length for a tile, or is all that the document or one of its lines holds.
        """
        hashes = words.hashes(lower=True)
        out = []
        for doc, item, place in self.shared_seeds(words, hashes):
            out += self._tiled(words, hashes, doc, item, place, coverage)
        return out

    def _tiled(self, words: Words, hashes: np.ndarray, doc: np.ndarray, item: np.ndarray, place: np.ndarray, coverage: float) -> list[tuple]:
        if not len(doc):
            return []
        # Tiles are made of shared seeds, so the tokens under seeds bound what tiles can cover.
        sizes = self.sizes
        widest = int(sizes.max())
        key = np.unique((doc * len(sizes) + item) * widest + place)
        pair, place = key // widest, key % widest
        least = self.least[pair % len(sizes)]
        gap = np.minimum(np.diff(place, append=0), least)
        last = np.concatenate([pair[1:] != pair[:-1], [True]])
        pairs, begin = np.unique(pair, return_index=True)
        bound = np.add.reduceat(np.where(last, least, gap), begin)
        out = []
        for p in pairs[bound >= coverage * sizes[pairs % len(sizes)]].tolist():
            d, i = divmod(p, len(sizes))
            text = hashes[words.first[d] : words.first[d + 1]]
            found = tiles(self.items[i], text, int(self.least[i]))
            covered = sum(n for _, _, n in found)
            if covered >= coverage * len(self.items[i]):
                alone = len(self.items[i]) >= self.full or self._whole_line(words, d, text, self.items[i])
                out.append((d, i, len(self.items[i]), covered, len(found), max(n for _, _, n in found), alone))
        return out

    @staticmethod
    def _whole_line(words: Words, d: int, text: np.ndarray, item: np.ndarray) -> bool:
        """Whether some line of a document has the tokens of the item and no others."""
        n = len(item)
        at = np.flatnonzero(text[: len(text) - n + 1] == item[0])
        for k in range(1, n):
            at = at[text[at + k] == item[k]]
        low, high = words.offsets[d], words.offsets[d + 1]
        breaks = np.flatnonzero(words.data[low:high] == 0x0A) + low
        line = np.searchsorted(breaks, words.starts[words.first[d] : words.first[d + 1]])
        line = np.concatenate([[-1], line, [-1]])
        return bool(((line[at + 1] == line[at + n]) & (line[at] != line[at + 1]) & (line[at + n] != line[at + n + 1])).any())


def _benchmarks(benchmark: DataFrame, least: int) -> Iterator:
    """The benchmark in blocks of bounded size: (block, how many there are), each broadcast when its turn comes.

    A block's broadcast is removed when the next one is asked for: by then what was made with it must be written.
    """
    rows = benchmark.select(F.col("item_id").cast("bigint"), text_or_empty().cast("binary").alias("text"))
    blocks = n_blocks(rows, "text", BLOCK_BYTES)
    for b in range(blocks):
        block = rows if blocks == 1 else rows.where(block_of(blocks, "item_id", "text") == b)
        got = block.collect()
        if got:
            held = Benchmark([r.item_id for r in got], [bytes(r.text) for r in got], least)
            sent = rows.sparkSession.sparkContext.broadcast(held)
            yield sent, blocks
            if blocks > 1:
                sent.destroy()


LEAK = "doc_id bigint, item_id bigint, item_tokens bigint, covered bigint, n_tiles bigint, longest bigint"


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, least: int = LEAST) -> DataFrame:
    """A row for each document and item of which tiles cover at least the share `coverage`.

    docs: doc_id, text; benchmark: item_id, text. Null or empty texts share nothing. An item of fewer than `least`
    tokens is in the documents that have all of them in a row; an item without tokens is in none. Rows without doc_id, and repeated rows of either table, give rows of
    their own. Other columns are ignored. Documents are read once per BLOCK_BYTES of benchmark and not shuffled.
    """
    names = [field.split()[0] for field in LEAK.split(", ")]
    texts = docs.select(F.col("doc_id").cast("bigint"), text_or_empty().cast("binary").alias("text"))

    def search(held):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i, _, words in batched_words(batch.column(1), breaks=NOT_TOKEN, kind=Tokens):
                    found = held.value.judge(words, coverage)
                    if found:
                        at, items, *numbers, _ = zip(*found, strict=True)
                        ids = batch.column(0).take(pa.array([i + d for d in at]))
                        columns = [pa.array([held.value.ids[x] for x in items], pa.int64()), *(pa.array(n, pa.int64()) for n in numbers)]
                        yield pa.RecordBatch.from_arrays([ids, *columns], names=names)

        return run

    out = docs.sparkSession.createDataFrame([], LEAK)
    for k, (held, blocks) in enumerate(_benchmarks(benchmark, least)):
        found = texts.mapInArrow(search(held), LEAK)
        if blocks > 1:
            found = materialize(found, "leaks")
        out = out.unionByName(found) if k else found
    return out.withColumn("coverage", F.col("covered") / F.col("item_tokens"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, least: int = LEAST) -> DataFrame:
    """The documents in which no item is covered, with all their columns.

    An item of fewer than `least` tokens says little: a document goes for it only if the item is all that the document, or one
    of its lines, holds; `leaks` reports such items wherever they stand.
    """
    place = docs.columns.index("text")

    def keep(held):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                column = batch.column(place).fill_null("")
                for i, _, words in batched_words(column, breaks=NOT_TOKEN, kind=Tokens):
                    clean[[i + f[0] for f in held.value.judge(words, coverage) if f[-1]]] = False
                yield batch.filter(pa.array(clean))

        return run

    for held, blocks in _benchmarks(benchmark, least):
        docs = docs.mapInArrow(keep(held), docs.schema)
        if blocks > 1:
            docs = materialize(docs, "clean")
    return docs
