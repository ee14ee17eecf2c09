"""Language-model scores by logistic mixing of bit predictors in hashed contexts.

A token is coded in up to three steps. Where the two tokens before it stood earlier in the document, a bit says whether the same
token follows again; if so, it is coded. Else come the bits of its class, and the token within its class. The class is a
hash of the first bytes of the word, so words of one language and kind share classes. Each bit of it is predicted by
several contexts (none; the word before; the last short word; the document so far). The predictions are mixed in the
logistic domain with weights that a gate selects (place of the bit, and how often its context was seen), and the
weights are refined on each document while it is scored, by the error of the bits already coded. The bit of a repetition is
mixed likewise, from how often repetitions were right in the document and how rare the token is that would be repeated.
The token within its class has the probability of its training count; unknown words share one, as in the base score.
With `below`, the next bits of a known token are mixed as well, from its count in the class, the word before and the document's last
token of the class; only tokens alike in these bits, too, are told apart by their training counts.
All bits together give bits per byte.

Counts are taken from all training documents. Those of words and of contexts grow with the corpus and stay distributed:
they come back to each block of documents for the words and contexts it has. A block learns its start weights online on
all its training documents, each token predicted without its own count.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costalloc.llm.common import U, Words, buffers, fmix, hash_slices, n_blocks, slices, text_or_empty, whole_groups

CLASS_BITS, PREFIX = 8, 3  # classes of words by their first bytes
CLASSES = 1 << CLASS_BITS
KINDS = 2
SHORT = 4  # bytes of a word that tells language and style
BACK_OFF = 12.0  # weight of the prediction without context in that of a context
CHUNK = 64  # tokens of a document between two refinements
INPUTS = 2 + KINDS
LEVELS = (8, 64, 512)  # counts that part the gates
RARE = (1, 8, 64, 512)  # training counts of a token that would be repeated
START_RATE, RATE = 0.02, 0.004
START = 0.25  # weights before learning
LEAST_BUCKETS = 8  # a block's words and contexts travel in 2 ** 8 buckets, by their first bits, or as many as there are blocks
BLOCK_BYTES = 10 << 20
END = fmix(np.array([0x454E44], U))[0]
GATES = CLASS_BITS * (len(LEVELS) + 1)
WORD_BITS = 8  # bits of a token below its class
FIRST_EQUAL = (WORD_BITS - np.frexp(np.arange(1 << WORD_BITS))[1]).astype(np.int8)  # by the exclusive or of two tokens' bits
WORD_KINDS = 2
WORD_KEY = 40 + WORD_BITS
WORD_START = (0.5, 0.5, 0.5)  # weights of the count in the class, of that after the word before, and of the document's last token of the class
LEAST_SEEN = 4  # a context seen less often tells nothing
AGREED = (2, 4, 6)  # bits in which that token has agreed so far, which part the gates
WORD_GATES = (len(LEVELS) + 1) * (len(AGREED) + 2)


class Tokens:
    """The tokens of some documents, in order: hashes, classes, hashed contexts, and the document of each."""

    def __init__(self, words: Words):
        n = len(words.starts) + words.n_docs
        hashes, begins = hash_slices(words.data, words.starts, words.ends, lower=True, beginning=PREFIX)
        at = np.arange(len(words.starts)) + words.doc  # each document before has one end token
        self.counts = words.counts + 1
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        self.doc = np.repeat(np.arange(words.n_docs), self.counts)
        self.hash = np.full(n, END, U)
        self.hash[at] = hashes
        top = U(64 - CLASS_BITS)
        self.cls = np.full(n, int(END >> top), np.int32)
        self.cls[at] = (begins >> top).astype(np.int32)
        short = np.zeros(n, bool)
        short[at] = words.ends - words.starts <= SHORT
        self._told = short, begins, at

    @cached_property
    def contexts(self) -> np.ndarray:
        """KINDS rows of hashes: of the word before, and of the last short word."""
        short, begins, at = self._told
        n = len(self.hash)
        place, start = np.arange(n), self.first[self.doc]
        # a short word is known by itself, a longer one by its beginning
        told = np.full(n, U(3))
        told[at] = np.where(short[at], self.hash[at], begins)
        previous = np.empty(n, U)
        previous[1:] = told[:-1]
        previous[self.first[:-1]] = U(4)
        # among short words, the last one before each token
        shorts = np.flatnonzero(short)
        rank = np.cumsum(short) - short  # short words before each token
        held = np.concatenate([[U(1)], self.hash[shorts]])
        begun = rank[self.first[:-1]][self.doc]
        one = np.where(rank > begun, held[rank], U(1))
        return np.stack([fmix(k + U(i)) for i, k in enumerate((previous, one))])

    @cached_property
    def repeated(self) -> tuple[np.ndarray, np.ndarray]:
        """For each token the place of the token that would be a repetition (-1: none), and whether it is one.

        That is the token after the latest place in the document at which the same two tokens stood before.
        """
        n = len(self.hash)
        key = np.zeros(n, U)
        if n > 2:
            key[2:] = fmix(self.hash[1:-1] * U(3) + self.hash[:-2]) + self.doc[2:].astype(U) * U(0x9E3779B97F4A7C15)
        inside = np.arange(n) - self.first[self.doc] >= 2
        some = np.flatnonzero(inside)
        order = some[np.argsort(key[some], kind="stable")]
        before = np.full(n, -1, np.int64)
        same = (key[order[1:]] == key[order[:-1]]) & (self.doc[order[1:]] == self.doc[order[:-1]])
        before[order[1:][same]] = order[:-1][same]
        return before, (before >= 0) & (self.hash[before] == self.hash)

    @cached_property
    def below(self) -> np.ndarray:
        """The bits of each token below its class."""
        return (self.hash & U((1 << WORD_BITS) - 1)).astype(np.int32)

    @cached_property
    def agreed(self) -> np.ndarray:
        """In how many first bits below the class each token is like the document's last one of its class (-1: there is none)."""
        n = U(len(self.doc))
        key = (self.doc * CLASSES + self.cls).astype(U) * n + np.arange(len(self.doc), dtype=U)
        key.sort()
        group, order = key // n, (key % n).astype(np.int64)
        same = group[1:] == group[:-1]
        out = np.full(len(order), -1, np.int8)
        differs = self.below[order[1:][same]] ^ self.below[order[:-1][same]]
        out[order[1:][same]] = FIRST_EQUAL[differs]
        return out

    def word_keys(self, kind: int) -> np.ndarray:
        """The token's bits below its class, above them the kind, and above it its class (kind 0), or its class and the word before."""
        known = self.cls.astype(U) if kind == 0 else self.contexts[0] + self.cls.astype(U) * U(0x9E3779B97F4A7C15)
        return (fmix(known + U(kind + 5)) >> U(25) << U(1) | U(kind)) << U(WORD_BITS) | self.below.astype(U)

    def forget(self) -> None:
        """Free the contexts, once their keys are known."""
        del self.contexts, self._told

    def of(self, docs: np.ndarray) -> Tokens:
        """Those of some documents (a mask) alone, without contexts."""
        out = object.__new__(Tokens)
        out.counts = self.counts[docs]
        out.first = np.concatenate([[0], np.cumsum(out.counts)])
        out.doc = np.repeat(np.arange(len(out.counts)), out.counts)
        out.hash, out.cls = self.hash[docs[self.doc]], self.cls[docs[self.doc]]
        return out

    def keys(self, kind: int) -> np.ndarray:
        """Each token's context in the upper 56 bits, its class in the lower 8."""
        return self.contexts[kind] & ~U(CLASSES - 1) | self.cls.astype(U)


def node_counts(leaves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows of class counts, the counts of ones and of all at each node: node 1 is the first bit, 2n+b follows."""
    rows = leaves.reshape(-1, CLASSES).astype(np.float32)
    total = np.zeros_like(rows)
    ones = np.zeros_like(rows)
    now = rows
    for bit in range(CLASS_BITS - 1, -1, -1):
        ones[:, 1 << bit : 2 << bit] = now[:, 1::2]
        now = now[:, 0::2] + now[:, 1::2]
        total[:, 1 << bit : 2 << bit] = now
    return ones, total


def stretch(p: np.ndarray) -> np.ndarray:
    return np.log(p / (1 - p))


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different keys, ascending, and which of them each one is."""
    found, which = np.unique(keys, return_inverse=True)
    return found, which.astype(np.int32)


def union(parts: list[np.ndarray]) -> np.ndarray:
    """The different keys of all parts, ascending."""
    keys = np.concatenate([np.empty(0, U), *parts])
    keys.sort()
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys


class Block:
    """The tokens of a block of documents, a few MB at a time, and the words, contexts and classes they have.

    With `words` also the bits of tokens below their class, in the contexts that predict them.
    """

    def __init__(self, column, words: bool = False):
        self.tokens = list(_tokens(column, 1 << 20 if words else 1 << 21))
        self.found = []  # for each slice and kind: its different keys, and which of them each token has
        self.word_found = []  # for each slice: its different keys of bits below the class, and which of them each token has
        self.words = []  # for each slice: its different words, their classes, and which of them each token is
        for tokens in self.tokens:
            self.found.append([distinct(tokens.keys(kind)) for kind in range(KINDS)])
            word, which = distinct(tokens.hash)
            cls = np.empty(len(word), np.int32)
            cls[which] = tokens.cls
            self.words.append((word, cls, which))
            self.word_found.append([distinct(tokens.word_keys(kind)) for kind in range(WORD_KINDS)] if words else [])
            tokens.forget()
        self.key = union([key for kinds in self.found for key, _ in kinds])
        self.word = union([word for word, _, _ in self.words])
        self.cls = np.empty(len(self.word), np.int32)
        for word, cls, _ in self.words:
            self.cls[np.searchsorted(self.word, word)] = cls
        self.word_key = union([key for kinds in self.word_found for key, _ in kinds])
        self.word_at = [[np.searchsorted(self.word_key, key) for key, _ in kinds] for kinds in self.word_found]

    def counted(self, trained: np.ndarray) -> list[np.ndarray]:
        """Tokens of some documents (a mask) that are each word, that have each key, and each key of bits below the class."""
        out = [np.zeros(len(keys), np.uint32) for keys in (self.word, self.key, self.word_key)]
        done = 0
        for k, tokens in enumerate(self.tokens):
            mine = trained[done : done + len(tokens.counts)][tokens.doc]
            done += len(tokens.counts)
            word, _, which = self.words[k]
            for keys, n, pairs in zip((self.word, self.key, self.word_key), out, ([(word, which)], self.found[k], self.word_found[k]), strict=True):
                for found, which in pairs:
                    n[np.searchsorted(keys, found)] += np.bincount(which, mine, len(found)).astype(np.uint32)
        return out


def buckets(keys: np.ndarray, bits: int, width: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of sorted keys by their first bits, ascending, and where each begins and the last ends."""
    bucket = (keys >> U(width - bits)).astype(np.int32)
    begin = np.flatnonzero(np.diff(bucket, prepend=-1))
    return bucket[begin], np.append(begin, len(bucket))


class Predictors:
    """Bit predictors by the training counts of the contexts that a block has, and the weights to mix them by."""

    def __init__(self, plain: np.ndarray, block: Block, path: np.ndarray):
        """plain: training tokens of each class. path: for each key of the block, training tokens of its context whose
        class begins with its first 0, 1, ... CLASS_BITS bits."""
        ones, total = node_counts(plain)
        self.base = ((ones + 0.5) / (total + 1.0))[0].astype(np.float32)  # without context
        self.base_stretch = stretch(self.base).astype(np.float32)
        self.weights = np.full((GATES, INPUTS), START, np.float32)
        self.repeats = np.zeros((len(RARE) + 1, 2))  # of the repetition's bit: weights of its rate in the document, and of 1
        self.repeats[:, 0] = 1.0
        self.block, self.path = block, path

    def look_up(self, k: int, only: np.ndarray | None = None) -> Tokens:
        """The tokens of slice k, to be predicted next; `only`: of these documents, each token without its own count."""
        tokens, found = self.block.tokens[k], self.block.found[k]
        kept = slice(None)
        repeated = tokens.repeated
        if only is not None:
            kept = only[tokens.doc]
            place = np.cumsum(kept) - 1
            before, hit = repeated[0][kept], repeated[1][kept]
            tokens = tokens.of(only)
            repeated = np.where(before >= 0, place[before], -1), hit  # of the same document, so it is kept, too
        tokens.again = repeated
        self.rows, self.stretches = [], []
        for key, which in found:
            path = self.path.take(np.searchsorted(self.block.key, key), axis=0)
            if only is not None:
                path = np.maximum(path - 1, 0)
            cls = (key & U(CLASSES - 1)).astype(np.int32)[:, None]
            total, below = path[:, :-1], path[:, 1:]
            ones = np.where(cls >> (CLASS_BITS - 1 - _BITS) & 1, below, total - below)
            p = (ones + np.float32(BACK_OFF) * self.base[(1 << _BITS) | (cls >> (CLASS_BITS - _BITS))]) / (total + np.float32(BACK_OFF))
            self.rows.append(which[kept])
            self.stretches.append(stretch(np.clip(p, 1e-5, 1 - 1e-5)).astype(np.float32))
        self.levels = np.searchsorted(LEVELS, total, side="right").astype(np.int8)
        return tokens

    def told(self, at: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """The inputs of all kinds at the bits of the tokens `at` last looked up, and the levels of the last kind."""
        rows = [row[at] for row in self.rows]
        return [x.take(row, axis=0) for x, row in zip(self.stretches, rows, strict=True)], self.levels.take(rows[-1], axis=0)


def path_columns(key: np.ndarray, n: np.ndarray, of: int) -> Iterator[np.ndarray]:
    """For sorted keys, the sums of n over those that have the context and the first 0, then 1, ... of its last bits (the class)."""
    sums = np.concatenate([[0], np.cumsum(n)])
    for bits in range(of + 1):
        run = key >> U(of - bits)
        edges = np.append(np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]])) if len(key) else np.empty(0, np.int64), len(key))
        yield np.repeat(np.diff(sums[edges]), np.diff(edges))


def path_counts(key: np.ndarray, n: np.ndarray, of: int = CLASS_BITS) -> np.ndarray:
    """The `path_columns` side by side."""
    return np.stack(list(path_columns(key, n, of)), axis=1)


_BITS = np.arange(CLASS_BITS, dtype=np.int32)
_WORD_BITS = np.arange(WORD_BITS, dtype=np.int8)


def coded_log2(model: Predictors, tokens: Tokens, rare: np.ndarray, learn: bool = False) -> np.ndarray:
    """For each document the log2 probability of its repetition bits and of the classes of the tokens that are no repetition.

    rare: for each token how rare it is (0 to len(RARE)). Documents are coded side by side, a chunk of tokens each at a
    time. After a chunk, each document's own weights take a step down the gradient of the coding cost of its bits, and its
    counts are renewed; with `learn` the model's weights take a step too.
    """
    order = np.argsort(-tokens.counts, kind="stable")
    counts, first = tokens.counts[order], tokens.first[:-1][order]
    out = np.zeros(len(order))
    own_weights = np.zeros((len(order), INPUTS), np.float32)
    own_counts = np.zeros((len(order), CLASSES), np.float32)
    tried = np.zeros((len(order), 2))  # repetitions offered, and right
    before, hit = tokens.again
    done = 0
    while True:
        active = int(np.searchsorted(-counts, -done, side="left"))  # documents longer than `done`
        if not active:
            break
        n = np.minimum(counts[:active] - done, CHUNK)
        row = np.repeat(np.arange(active), n)
        at = np.repeat(first[:active] + done - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        classes = np.bincount(row * CLASSES + tokens.cls[at], minlength=active * CLASSES).reshape(active, CLASSES)

        offered = before[at] >= 0
        if offered.any():
            r, o = row[offered], at[offered]
            gate = rare[before[o]]
            right = hit[o].astype(float)
            rate = stretch((tried[r, 1] + 0.5) / (tried[r, 0] + 1.0))
            p = 1 / (1 + np.exp(-np.clip(model.repeats[gate, 0] * rate + model.repeats[gate, 1], -14, 14)))
            out[:active] += np.bincount(r, np.log2(np.where(hit[o], p, 1 - p)), active)
            tried[:active, 0] += np.bincount(r, minlength=active)
            tried[:active, 1] += np.bincount(r, right, active)
            if learn:
                seen = np.maximum(np.bincount(gate, minlength=len(RARE) + 1), 1) ** 0.75
                model.repeats[:, 0] += START_RATE * np.bincount(gate, (right - p) * rate, len(RARE) + 1) / seen
                model.repeats[:, 1] += START_RATE * np.bincount(gate, right - p, len(RARE) + 1) / seen

        new = ~hit[at]
        row, at = row[new], at[new]
        if not len(at):
            own_counts[:active] += classes
            done += CHUNK
            continue
        cls = tokens.cls[at]
        node = (1 << _BITS) | (cls[:, None] >> (CLASS_BITS - _BITS))  # (tokens, bits)
        bit = ((cls[:, None] >> (CLASS_BITS - 1 - _BITS)) & 1).astype(np.float32)
        told, level = model.told(at)
        inputs = [model.base_stretch.take(node), *told]
        if done:
            ones, seen = node_counts(own_counts[:active])
            p = (ones + BACK_OFF * model.base) / (seen + BACK_OFF)
            own = stretch(np.clip(p, 1e-5, 1 - 1e-5)).astype(np.float32).ravel()
            inputs.append(own.take(row.astype(np.int32)[:, None] * CLASSES + node))
        else:
            inputs.append(inputs[0])
        gate = _BITS * (len(LEVELS) + 1) + level
        z = np.zeros(node.shape, np.float32)
        for k, x in enumerate(inputs):
            weight = model.weights[:, k].take(gate)
            weight += own_weights[row, k][:, None]
            weight *= x
            z += weight
        np.clip(z, -14, 14, out=z)
        p = 1 / (1 + np.exp(-z))
        error = bit - p
        cost = np.log2(1 - np.abs(error)).sum(axis=1, dtype=np.float64)
        out[:active] += np.bincount(row, cost, active)
        steps = np.stack([np.bincount(row, np.einsum("ij,ij->i", error, x), active) for x in inputs], axis=1)
        own_weights[:active] += (RATE * steps / np.sqrt(n)[:, None]).astype(np.float32)
        np.clip(own_weights, -0.5, 0.5, out=own_weights)
        own_counts[:active] += classes
        if learn:
            seen = np.maximum(np.bincount(gate.ravel(), minlength=GATES), 1) ** 0.75
            for k, x in enumerate(inputs):
                model.weights[:, k] += START_RATE * np.bincount(gate.ravel(), (error * x).ravel(), GATES) / seen
        done += CHUNK
    scores = np.empty(len(order))
    scores[order] = out
    return scores


class WordPredictors:
    """Predictors of the bits below the class by the training counts of contexts, and the weights to mix them by."""

    def __init__(self, block: Block, path: np.ndarray):
        """path: for each key of the block, training tokens of its context whose bits begin with its first 0, 1, ... bits."""
        self.block, self.path = block, path
        self.weights = np.repeat(np.array(WORD_START, np.float32)[:, None], WORD_GATES, axis=1)

    def look_up(self, k: int, kept: np.ndarray, own: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the tokens of slice k that are `kept` (a mask), the places of those of which the word before or the document
        tells something, and their path counts in their class and after the word before; `own`: each without its own."""
        paths = []
        for (_, which), place in zip(self.block.word_found[k], self.block.word_at[k], strict=True):
            path = self.path.take(place, axis=0)
            if own:
                path -= 1
            paths.append((path, which))
        (plain, of_class), (after, of_word) = paths
        told = kept & ((self.block.tokens[k].agreed >= 0) | (after[:, 0] >= LEAST_SEEN)[of_word])
        at = np.flatnonzero(told)
        return at, plain.take(of_class[at], axis=0), after.take(of_word[at], axis=0)


def coded_words(
    model: WordPredictors, tokens: Tokens, at: np.ndarray, plain: np.ndarray, after: np.ndarray, agreed: np.ndarray, learn: bool = False
) -> np.ndarray:
    """For each document how much mixing changes the log2 probability of the bits below the class of its tokens `at` (ascending).

    plain, after: their path counts in the class, and after the word before. agreed: as in Tokens. A bit that all training
    tokens of the class share, whose earlier bits are the same, costs nothing. One of which neither the word before, seen LEAST_SEEN
    times there, nor the document tells anything has its rate in the class. The others are mixed, and documents refine
    their weights, as in `coded_log2`. All inputs are turned so that the bit that came is the one predicted.
    """
    out = np.zeros(len(tokens.counts))
    doc = tokens.doc[at]
    chunk = (at - tokens.first[doc]) // CHUNK
    # by chunk, within it by document, the longest document first
    place = np.argsort(-tokens.counts, kind="stable")
    rank = np.empty(len(place), np.int64)
    rank[place] = np.arange(len(place))
    order = np.argsort(chunk * len(place) + rank[doc], kind="stable")
    plain, after, agreed = plain.take(order, axis=0), after.take(order, axis=0), agreed[order]
    mixed = np.flatnonzero((plain[:, 1:] < plain[:, :-1]) & ((agreed[:, None] >= _WORD_BITS) | (after[:, :-1] >= LEAST_SEEN)))
    if not len(mixed):
        return out
    token = mixed // WORD_BITS
    bit, like = (mixed - token * WORD_BITS).astype(np.int8), agreed.take(token)
    row, ends = rank[doc[order]].astype(np.int32).take(token), np.cumsum(np.bincount(chunk[order].take(token))).tolist()
    mixed += token  # places in the path counts, which have a column more
    total, seen = plain.ravel().take(mixed), after.ravel().take(mixed)
    mixed += 1
    taken, hit = plain.ravel().take(mixed), after.ravel().take(mixed)
    del plain, after, mixed, token
    known = seen >= LEAST_SEEN
    seen *= known
    hit *= known
    rate = taken / total
    x = np.empty((len(WORD_START), len(row)), np.float32)
    x[0] = np.log(taken / (total - taken))
    x[1] = np.log((hit + np.float32(BACK_OFF) * rate) / (seen - hit + np.float32(BACK_OFF) * (1 - rate)))
    x[2] = (like > bit).astype(np.int8) - (like == bit)
    gate = (like >= bit) * (1 + np.searchsorted(AGREED, _WORD_BITS, side="right").astype(np.int32)).take(bit)
    for level in LEVELS:
        gate += (seen >= level) * np.int32(len(AGREED) + 2)
    own = np.zeros((len(WORD_START), len(place)), np.float32)
    gained = -np.log2(rate)
    start = 0
    for end in ends:
        if start == end:
            continue
        r, g, now = row[start:end], gate[start:end], x[:, start:end]
        first = np.flatnonzero(np.diff(r, prepend=-1))
        docs = r[first]
        z = np.zeros(len(r), np.float32)
        for weights, mine, value in zip(model.weights, own, now, strict=True):
            w = weights.take(g)
            w += mine.take(r)
            w *= value
            z += w
        np.clip(z, -14, 14, out=z)
        p = 1 / (1 + np.exp(-z))
        gained[start:end] += np.log2(p)
        slopes = (1 - p) * now
        n = np.sqrt(np.diff(first, append=len(r)))
        own[:, docs] = np.clip(own[:, docs] + RATE * np.add.reduceat(slopes, first, axis=1) / n, -0.5, 0.5)
        if learn:
            often = np.maximum(np.bincount(g, minlength=WORD_GATES), 1) ** 0.75
            for weights, slope in zip(model.weights, slopes, strict=True):
                weights += START_RATE * np.bincount(g, slope, WORD_GATES) / often
        start = end
    out[place] += np.bincount(row, gained, len(place))
    return out


def _tokens(column, limit: int = 1 << 21) -> Iterator[Tokens]:
    data, offsets = buffers(column)
    for i, j in slices(offsets, limit):
        yield Tokens(Words(data, offsets[i : j + 1]))


# Counts -------------------------------------------------------------------

SEEN = "bucket int, block int, keys binary, n binary, cls binary"
TOLD = "block int, bucket int, width int, counts binary, cls int, kinds bigint, tokens bigint"
CLASS = "cls int, kinds bigint, tokens bigint"


def planes(numbers: np.ndarray) -> bytes:
    """Whole numbers as bytes, the lowest bytes of all of them first: what is small packs well."""
    return numbers.view(np.uint8).reshape(len(numbers), numbers.dtype.itemsize).T.tobytes()


def from_planes(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8).reshape(size, -1).T.copy().view(kind).ravel()


def _seen(bits: int, below: bool = False):
    """Block (block, text, held_out): its words, with their class, and the classes in its contexts, with their count in
    training documents, by buckets; those of contexts come after those of words. `below`: then those of bits below the class."""

    def run(key, rows):
        block = Block(rows["text"], below)
        out: list[list] = [[], [], [], []]
        parts = zip((block.word, block.key, block.word_key), block.counted(~rows["held_out"].to_numpy()), (block.cls, None, None), (64, 64, WORD_KEY), strict=True)
        for part, (keys, counts, cls, width) in enumerate(parts):
            bucket, edges = buckets(keys, bits, width)
            for b, s, e in zip(bucket.tolist(), edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                told = ((part << bits) + b, planes(np.diff(keys[s:e], prepend=U(0))), planes(counts[s:e]), None if cls is None else cls[s:e].astype(np.uint8).tobytes())
                for column, value in zip(out, told, strict=True):
                    column.append(value)
        packed = [pa.array(column, pa.binary()) for column in out[1:]]
        return pa.table([pa.array(out[0], pa.int32()), pa.array([key[0].as_py()] * len(out[0]), pa.int32()), *packed], names=["bucket", "block", "keys", "n", "cls"])

    return run


def _groups(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[tuple[pa.Table, int, list, np.ndarray, np.ndarray]]:
    """Rows of SEEN, sorted by bucket: a table of whole buckets, what it is of (0 words, 1 contexts, 2 bits below the class), the
    ends of each row's keys, all keys and counts."""
    for table in whole_groups(batches, 300):
        of = table["bucket"].to_numpy()
        begin = np.flatnonzero(np.concatenate([[True], np.where(of[1:] >> bits == 2, of[1:] != of[:-1], of[1:] >> bits != of[:-1] >> bits)]))
        for first, end in zip(begin.tolist(), [*begin[1:].tolist(), len(of)], strict=True):
            rows, part = table.slice(first, end - first), int(of[first]) >> bits
            if rows.num_rows:
                keys = [np.cumsum(from_planes(x, "<u8"), dtype=U) for x in rows["keys"].to_pylist()]
                n = [from_planes(x, "<u4") for x in rows["n"].to_pylist()]
                edges = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).tolist()
                yield rows, part, edges, np.concatenate(keys), np.concatenate(n).astype(np.int64)


def _totals(bits: int):
    """For each block and bucket, the counts of its words (or the path counts of its contexts) in all blocks, in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, part, edges, keys, n in _groups(batches, bits):
            order = np.argsort(keys, kind="stable")
            of = (0, CLASS_BITS, WORD_BITS)[part]
            width = 4 if n.sum() < 1 << 32 else 8
            counts = np.empty((of + 1, len(keys)), f"<u{width}")
            for column, numbers in zip(counts, path_columns(keys[order], n[order], of), strict=True):
                column[order] = numbers
            if part == 2:  # what a context tells that was seen too seldom is not sent
                counts[1:][(counts[:-1] < LEAST_SEEN) & (keys >> U(WORD_BITS) & U(1) == 1)] = 0
            packs = [pa.compress(planes(counts[:, s:e].ravel()), "zstd", asbytes=True) for s, e in zip(edges, edges[1:], strict=False)]
            widths = [width] * len(packs)
            none = [pa.nulls(len(packs), kind) for kind in (pa.int32(), pa.int64(), pa.int64())]
            columns = [rows["block"].combine_chunks(), rows["bucket"].combine_chunks(), pa.array(widths, pa.int32()), pa.array(packs, pa.binary()), *none]
            yield from pa.table(columns, names=[f.split()[0] for f in TOLD.split(", ")]).to_batches()

    return run


def _classes(bits: int):
    """(cls, kinds, tokens): different words and tokens of each class in training, of the buckets that the task has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds, mass = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
        for rows, part, _, keys, n in _groups(batches, bits):
            if part == 0:
                cls = np.frombuffer(b"".join(rows["cls"].to_pylist()), np.uint8)
                order = np.argsort(keys, kind="stable")
                first = np.flatnonzero(np.concatenate([[True], keys[order][1:] != keys[order][:-1]]))
                total = np.add.reduceat(n[order], first)
                kinds += np.bincount(cls[order][first], total > 0, CLASSES).astype(np.int64)
                mass += np.bincount(cls[order][first], total, CLASSES).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES, dtype=np.int32)), pa.array(kinds), pa.array(mass)], names=["cls", "kinds", "tokens"])

    return run


def _put_back(told: pa.Table, keys: np.ndarray, bits: int, first: int, columns: int, key_bits: int = 64, kind: type = np.int64) -> np.ndarray:
    """The counts told for sorted keys of a block, whose buckets are numbered from `first` on."""
    out = np.zeros((len(keys), columns), kind)
    numbers, edges = buckets(keys, bits, key_bits)
    mine = told.filter(pa.compute.and_(pa.compute.greater_equal(told["bucket"], first), pa.compute.less(told["bucket"], first + (1 << bits))))
    for bucket, width, data in zip(*(mine[c].to_pylist() for c in ("bucket", "width", "counts")), strict=True):
        at = int(np.searchsorted(numbers, bucket - first))
        n = (edges[at + 1] - edges[at]) * columns
        out[edges[at] : edges[at + 1]] = from_planes(pa.decompress(data, n * width, "zstd", asbytes=True), f"<u{width}").reshape(columns, -1).T
    return out


class Told:
    """What a block is told: predictors, counts of its words, and tokens and different words of each class."""

    def __init__(self, block: Block, told: pa.Table, bits: int):
        stated = told.filter(told["cls"].is_valid())
        self.mass, self.kinds = np.zeros(CLASSES), np.zeros(CLASSES)
        cls = stated["cls"].to_numpy()
        self.mass[cls], self.kinds[cls] = stated["tokens"].to_numpy(), stated["kinds"].to_numpy()
        packed = told.filter(told["counts"].is_valid())
        path = _put_back(packed, block.key, bits, 1 << bits, CLASS_BITS + 1, kind=np.float32)
        self.model = Predictors(self.mass, block, path)
        self.count = _put_back(packed, block.word, bits, 0, 1)[:, 0]
        self.block = block
        path = _put_back(packed, block.word_key, bits, 2 << bits, WORD_BITS + 1, WORD_KEY, np.float32)
        self.words = WordPredictors(block, path)

    def of_slice(self, k: int) -> np.ndarray:
        """Training count of each token of slice k."""
        word, _, which = self.block.words[k]
        return self.count[np.searchsorted(self.block.word, word)][which]


SCORE = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, "
    "score double, bits_per_byte double"
)


def score_block(rows: pa.Table, told: pa.Table, bits: int, below: bool = False) -> pa.Table:
    """Learn the weights on the training documents of a block, in order, then score all of its documents."""
    rows = rows.sort_by([("doc_id", "ascending"), ("text", "ascending")])
    block = Block(rows["text"], below)
    trained = ~rows["held_out"].to_numpy()
    known = Told(block, told, bits)
    model, mass, kinds = known.model, known.mass, known.kinds
    done = 0
    for k, tokens in enumerate(block.tokens):
        only = trained[done : done + len(tokens.counts)]
        done += len(tokens.counts)
        if only.any():
            n = np.maximum(known.of_slice(k) - 1, 0)
            mine = only[tokens.doc]
            some = model.look_up(k, only)
            coded_log2(model, some, np.searchsorted(RARE, n, side="right")[mine], learn=True)
            if below:
                at, plain, after = known.words.look_up(k, mine & (n > 0) & ~tokens.repeated[1], own=True)
                coded_words(known.words, some, (np.cumsum(mine) - 1)[at], plain, after, tokens.agreed[at], learn=True)
    base_rest = np.log10(mass.sum() + 0.5 * (kinds.sum() + 1))
    class_rest = np.log10(mass + 0.5 * (kinds + 1))
    out: list[list[np.ndarray]] = [[], [], [], []]
    for k in range(len(block.tokens)):
        tokens, n = model.look_up(k), known.of_slice(k)
        own = np.log10(n + 0.5)
        sums = lambda x: np.bincount(tokens.doc, x, len(tokens.counts))  # noqa: B023, E731
        coded = coded_log2(model, tokens, np.searchsorted(RARE, n, side="right")) * np.log10(2)
        if below:
            # a known token: that it is known, and its share of its class, as the mixed bits change it; others share one probability
            mine = (n > 0) & ~tokens.again[1]
            at, plain, after = known.words.look_up(k, mine, own=False)
            coded += coded_words(known.words, tokens, at, plain, after, tokens.agreed[at]) * np.log10(2)
            cls = tokens.cls[mine]
            within = np.where(tokens.again[1], 0.0, np.log10(0.5) - class_rest[tokens.cls])
            within[mine] = np.log10(mass[cls] + 0.5 * kinds[cls]) - class_rest[cls] + np.log10(n[mine] / mass[cls])
        else:
            within = np.where(tokens.again[1], 0.0, own - class_rest[tokens.cls])
        for kept, column in zip(out, (tokens.counts, sums(n > 0).astype(np.int64), sums(own) - tokens.counts * base_rest, sums(within) + coded), strict=True):
            kept.append(column)
    n_tokens, n_known, base, score = (np.concatenate(x) if x else np.empty(0) for x in out)
    _, offsets = buffers(rows["text"])
    size = np.maximum(np.diff(offsets), 1)
    train = np.full(rows.num_rows, int(mass.sum()), np.int64)
    columns = [rows["doc_id"], rows["held_out"], n_tokens, n_known, train, base, score, -score / np.log10(2) / size]
    return pa.table(columns, names=[field.split()[0] for field in SCORE.split(", ")])


def fifth(doc_id: str = "doc_id") -> Column:
    """Whether a document is held out: the CRC-32 of its id as text leaves 1 when divided by 5; without id, no."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 1, F.lit(False))


def score(docs: DataFrame, held_out: Column | None = None, block_bytes: int = BLOCK_BYTES, below: bool = False) -> DataFrame:
    """Token counts, base score and model score (log10 probabilities of the text) of every document.

    docs: doc_id, text; held_out: a condition, true for documents the model does not learn from (default `fifth`).
    Tokens are words, A-Z lower-cased, and one end; a null or empty text is the end alone. Rows without doc_id are
    learned from and scored; repeated rows count as often as they stand there. Without training documents every token
    is unknown. Other columns are ignored. below: contexts predict the bits of a token below its class, too (else it has the
    probability of its training count there).

    The texts are shuffled once, into blocks of about block_bytes, which count and later are scored. Rows alike in id and text go
    to several blocks if they come from several partitions. What blocks tell each other grows with the words and contexts
    they have. Start weights belong to a block, so a score hangs a little on which documents share one.
    """
    plain = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text_or_empty().cast("binary").alias("text"),
        (fifth() if held_out is None else held_out).alias("held_out"),
    )
    n = n_blocks(plain, "text", block_bytes)
    bits = min(24, max(LEAST_BUCKETS, math.ceil(math.log2(n))))
    spread = F.xxhash64("doc_id", "text", F.spark_partition_id())
    blocks = plain.withColumn("block", F.pmod(spread, F.lit(n)).cast("int")).groupBy("block")
    seen = blocks.applyInArrow(_seen(bits, below), SEEN).repartition("bucket").sortWithinPartitions("bucket")
    classes = seen.mapInArrow(_classes(bits), CLASS).groupBy("cls").agg(F.sum("kinds").alias("kinds"), F.sum("tokens").alias("tokens"))
    for_all = classes.select(F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("block"), "cls", "kinds", "tokens")
    told = seen.mapInArrow(_totals(bits), TOLD).unionByName(for_all, allowMissingColumns=True)
    return blocks.cogroup(told.groupBy("block")).applyInArrow(lambda key, rows, told: score_block(rows, told, bits, below), SCORE)
