"""Quality rules: a hashed n-gram log-likelihood ratio beside plain text rules.

Words, pairs of words and the first STEM bytes of words (A-Z lower-cased) are hashed into a fixed number of buckets.
Two multinomials over the buckets are counted over all documents: the trusted target (documents labelled quality 1 and
not toxic) and the raw corpus. A document's score is the mean over its n-grams of log(target / raw), both at the
target's total and with PRIOR added; ratios above -EVIDENCE count as zero. So the score is length-normalised, n-grams
too rare to tell add no noise, and a copy of common text does not pay for what the target avoids. A document is judged
by the counts of all others, so that being labelled neither helps nor harms. The threshold is the score that best
separates all trusted from all distrusted documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costalloc.llm.common import U, Words, added_up, batched_words, fmix, hash_slices, materialize, text_or_empty, windows

BUCKETS = 1 << 20  # fixed: bounds the two count tables to 4 MB each, whatever the corpus
MOST_IDS = 8_000_000  # trusted ids that are broadcast, 64 MB
PRIOR = 5.0
EVIDENCE = 0.5
STEM = 6
BIN = 1e-4  # width of the score bins in which the threshold is sought
MIN_WORDS, REPEAT_PERCENT, REPEAT_SIZE = 20, 30, 8

SYMBOL = np.zeros(256, np.int64)
SYMBOL[list(b"#*$%&|<>")] = 1
CODE_POINT = (np.arange(256) & 0xC0 != 0x80).astype(np.int64)  # bytes that begin a character
CODE_POINT[[0x20, *range(0x09, 0x0E)]] = 0


def duplicate_lines(words: Words) -> np.ndarray:
    """Per document: \\n-split lines that hold a word and equal an earlier line of the document."""
    data, offsets = words.data, words.offsets
    breaks = np.flatnonzero(data == 10)
    # a document's lines begin at its start and after each line break in it
    starts = np.concatenate([offsets[:-1], breaks + 1])
    doc = np.concatenate([np.arange(words.n_docs), np.searchsorted(offsets, breaks, side="right") - 1])
    order = np.lexsort((starts, doc))
    starts, doc = starts[order], doc[order]
    ends = np.concatenate([np.where(doc[1:] == doc[:-1], starts[1:] - 1, offsets[doc[:-1] + 1]), offsets[-1:]])
    seen = np.concatenate([[0], np.cumsum(words.inside)])
    worded = seen[ends] > seen[starts]
    starts, ends, doc = starts[worded], ends[worded], doc[worded]
    lines = hash_slices(data, starts, ends)
    order = np.lexsort((lines, doc))
    again = (lines[order][1:] == lines[order][:-1]) & (doc[order][1:] == doc[order][:-1])
    return np.bincount(doc[order][1:][again], minlength=words.n_docs)


def repeated_words(words: Words, hashes: np.ndarray, size: int = REPEAT_SIZE) -> np.ndarray:
    """Per document: words in windows of `size` words that occur at least twice in the document."""
    runs, whole = windows(hashes, words.doc, size)
    n = len(words.starts)
    if not len(runs):
        return np.zeros(words.n_docs, np.int64)
    runs = fmix(runs ^ fmix(words.doc[: len(runs)].astype(U) + U(1)))
    ranked = np.sort(runs[whole])
    twice = np.unique(ranked[1:][ranked[1:] == ranked[:-1]])
    marked = np.zeros(len(runs), bool)
    if len(twice):
        at = np.minimum(np.searchsorted(twice, runs), len(twice) - 1)
        marked = (twice[at] == runs) & whole
    begun = np.concatenate([[0], np.cumsum(marked)])
    place = np.arange(n)
    covered = begun[np.minimum(place + 1, len(runs))] > begun[np.maximum(place + 1 - size, 0).clip(max=len(runs))]
    return np.bincount(words.doc[covered], minlength=words.n_docs)


def ngrams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of every word, every pair of words, and every word's beginning."""
    hashes, stems = hash_slices(words.data, words.starts, words.ends, lower=True, beginning=STEM)
    pairs, whole = windows(hashes, words.doc, 2)
    doc = np.concatenate([words.doc, words.doc[: len(pairs)][whole], words.doc])
    bucket = np.concatenate([hashes, pairs[whole], fmix(stems + U(STEM))]) >> U(65 - BUCKETS.bit_length())
    return doc, bucket.astype(np.int64)


def _count(ids=None):
    """Counts of (doc_id, text) whose trusted ids are broadcast, or of (trusted, text): raw, then target."""

    def run(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            flags = batch.column(0)
            trusted = flags.to_numpy(zero_copy_only=False) if ids is None else _is_trusted(flags, ids)
            for i, j, words in batched_words(batch.column(1)):
                doc, bucket = ngrams(words)
                counts[0] += np.bincount(bucket, minlength=BUCKETS)
                counts[1] += np.bincount(bucket[trusted[i:j][doc]], minlength=BUCKETS)
        return counts.ravel()

    return run


def sent_ids(trusted: DataFrame):
    """The trusted doc_ids as a broadcast array, if they are at most MOST_IDS (8 bytes each); else None."""
    if trusted.count() > MOST_IDS:
        return None
    ids = np.sort(trusted.toArrow().column(0).to_numpy())
    return trusted.sparkSession.sparkContext.broadcast(ids)


def _is_trusted(column: pa.Array, ids) -> np.ndarray:
    named = column.is_valid().to_numpy(zero_copy_only=False)
    return named & np.isin(column.fill_null(0).to_numpy(), ids.value)


def count_tables(texts: DataFrame, trusted: DataFrame, ids) -> tuple[np.ndarray, np.ndarray]:
    """Raw and target counts of all buckets, over all documents (doc_id, text) and the trusted doc_ids.

    With `ids`, which every task has, no text is shuffled; else the trusted ids are joined. What reaches the driver
    are two tables of BUCKETS numbers.
    """
    if ids is None:
        joined = texts.join(trusted.withColumn("trusted", F.lit(True)), "doc_id", "left")
        texts = joined.select(F.coalesce("trusted", F.lit(False)), "text")
    counts = added_up(texts, _count(ids), 2 * BUCKETS).reshape(2, BUCKETS).astype(float)
    return counts[0], counts[1]


def scores(words: Words, raw: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean log ratio per document by the counts of the others: as part of the raw corpus alone, and of both."""
    share = target.sum() / max(raw.sum(), 1.0)
    doc, bucket = ngrams(words)
    if not len(doc):
        return np.zeros(words.n_docs), np.zeros(words.n_docs)
    key, count = np.unique(doc * BUCKETS + bucket, return_counts=True)
    doc, bucket = key // BUCKETS, key % BUCKETS
    expected = np.log((raw[bucket] - count) * share + PRIOR)
    total = np.maximum(np.bincount(doc, count, words.n_docs), 1)
    out = []
    for own in (0, count):
        ratio = np.log(np.maximum(target[bucket] - own, 0) + PRIOR) - expected
        out.append(np.bincount(doc, count * np.where(ratio <= -EVIDENCE, ratio, 0), words.n_docs) / total)
    return out[0], out[1]


RULES = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "score_outside double, score_inside double"
)


def _rate(tables):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = tables.value
        for batch in batches:
            for i, j, words in batched_words(batch.column(1)):
                numbers = [
                    words.counts,
                    words.per_byte(CODE_POINT),
                    words.per_byte(SYMBOL),
                    duplicate_lines(words),
                    repeated_words(words, words.hashes()),
                    *scores(words, raw, target),
                ]
                names = [field.split()[0] for field in RULES.split(", ")]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), *map(pa.array, numbers)], names=names)

    return run


def best_threshold(rated: DataFrame) -> float:
    """The bin edge of the score that best separates trusted from distrusted documents, by all of them.

    The scores are binned, so that the driver sees a bounded histogram (ratios lie within a few tens).
    Without documents of both kinds nothing is rejected by score.
    """
    bins = (
        rated.where("trusted IS NOT NULL AND NOT base_failed")
        .groupBy(F.floor(F.col("score") / BIN).alias("bin"))
        .agg(F.count_if("trusted").alias("good"), F.count_if(~F.col("trusted")).alias("bad"))
        .orderBy("bin")
        .collect()
    )
    good, bad = sum(r.good for r in bins), sum(r.bad for r in bins)
    if not good or not bad:
        return float("-inf")
    best, edge, g, b = -1.0, float("-inf"), 0, 0
    for r in bins:  # all below the bin are rejected
        gain = (good - g) / good + b / bad
        if gain > best + 1e-12:
            best, edge = gain, r.bin * BIN
        g, b = g + r.good, b + r.bad
    return edge


def _base_failed(n_words, n_repeat_words):
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > REPEAT_PERCENT * n_words)


def _rated(docs: DataFrame, labels: DataFrame) -> tuple:
    """Every document's counts and score, written; with the tables, the trusted ids, and those sent to the tasks."""
    known = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.min(F.coalesce((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit(False))).alias("trusted")
    )
    texts = docs.select(F.col("doc_id").cast("bigint"), text_or_empty().cast("binary").alias("text"))
    trusted = known.where("trusted").select("doc_id")
    ids = sent_ids(trusted)
    tables = docs.sparkSession.sparkContext.broadcast(count_tables(texts, trusted, ids))
    rated = texts.mapInArrow(_rate(tables), RULES).join(known, "doc_id", "left")
    rated = rated.select(
        *[field.split()[0] for field in RULES.split(", ")[:-2]],
        _base_failed(F.col("n_words"), F.col("n_repeat_words")).alias("base_failed"),
        F.when(F.col("trusted"), F.col("score_inside")).otherwise(F.col("score_outside")).alias("score"),
        "trusted",
    )
    return materialize(rated, "rated"), tables, trusted, ids


def _with_verdict(rated: DataFrame, edge: float) -> DataFrame:
    return rated.select(
        "*", F.lit(edge).alias("threshold"), (~F.col("base_failed") & (F.col("score") >= edge)).alias("kept")
    )


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float | None = None) -> DataFrame:
    """One row per document: its counts, whether the base rules fail, its score, and whether it is kept.

    docs: doc_id, text; labels: doc_id, quality, toxic. A document is trusted if it is labelled, all its labels say
    quality 1 and none says toxic; a null label counts as not trusted. Null or empty texts have no words, score 0
    and fail the base rules. Repeated rows are each rated; rows without doc_id have no label. Scores at the
    threshold are kept. Without labels of both kinds the base rules alone decide. Other columns are ignored.
    """
    rated, *_ = _rated(docs, labels)
    return _with_verdict(rated, best_threshold(rated) if threshold is None else threshold)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float | None = None) -> DataFrame:
    """The rows of docs that the rules keep, with all their columns; each row is judged by its own text.

    The rows are judged where they are read, so that no text is shuffled; only if the trusted ids are too many to be
    sent, they are joined to the rows first. The same rows stay either way.
    """
    rated, tables, trusted_ids, ids = _rated(docs, labels)
    edge = best_threshold(rated) if threshold is None else threshold
    id_place, text_place, width = docs.columns.index("doc_id"), docs.columns.index("text"), len(docs.columns)
    rows = docs
    if ids is None:
        flag = "_".join(["trusted", *docs.columns])  # no column of docs
        flags = trusted_ids.select(F.col("doc_id").alias(f"{flag}_id"), F.lit(True).alias(flag))
        rows = docs.join(flags, docs["doc_id"].cast("bigint") == F.col(f"{flag}_id"), "left").drop(f"{flag}_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = np.zeros(batch.num_rows, bool)
            if ids is None:
                trusted = batch.column(width).is_valid().to_numpy(zero_copy_only=False)
            else:
                trusted = _is_trusted(batch.column(id_place), ids)
            for i, j, words in batched_words(batch.column(text_place).fill_null("")):
                outside, inside = scores(words, *tables.value)
                score = np.where(trusted[i:j], inside, outside)
                kept[i:j] = ~_base_failed(words.counts, repeated_words(words, words.hashes())) & (score >= edge)
            yield batch.select(range(width)).filter(pa.array(kept))

    return rows.mapInArrow(run, docs.schema)
