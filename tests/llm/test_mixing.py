"""Scores of the mixing model: base by plain counts, the mixer bit by bit, and held-out gain."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from costalloc.llm import mixing
from tests.conftest import SMALL

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
END = object()


def plain_tokens(text):
    return [w.lower() for w in WORD.findall((text or "").encode())] + [END]


def plain_base(rows):
    held = [zlib.crc32(str(d).encode()) % 5 == 1 if d is not None else False for d, _ in rows]
    counts = collections.Counter()
    for (_, text), out in zip(rows, held, strict=True):
        if not out:
            counts.update(plain_tokens(text))
    total, different = sum(counts.values()), len(counts)
    told = []
    for (d, text), out in zip(rows, held, strict=True):
        tokens = plain_tokens(text)
        base = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (different + 1))) for t in tokens)
        told.append((d, out, len(tokens), sum(counts[t] > 0 for t in tokens), total, base))
    return told


def tokens_of(texts):
    return next(iter(mixing._tokens(pa.array([t.encode() for t in texts], pa.binary()))))


def test_base(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    odd = [(5001, None), (5002, ""), (5003, " \n"), (None, "The thing"), (5004, "the the THE"), (5004, "the the THE"), (5005, "x " * 60_000)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    want = {w[0]: w for w in plain_base([tuple(r) for r in docs.collect()])}
    got = mixing.score(docs).collect()
    assert len(got) == docs.count()
    for r in got:
        assert (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[r.doc_id][:5]
        assert r.base_score == pytest.approx(want[r.doc_id][5], rel=1e-9)
        assert math.isfinite(r.score) and r.score < 0
    out = [r for r in got if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


class Plain:
    """The whole model over some documents of one block, token by token and bit by bit."""

    def __init__(self, rows):
        """rows: (doc_id, text, held_out)"""
        self.rows = sorted(rows, key=lambda r: (r[0], r[1]))
        self.docs = []
        for _, text, held in self.rows:
            tokens = tokens_of([text])
            keys = [[(k, int(c) >> 8) for c in tokens.contexts[k]] for k in range(mixing.KINDS)]
            self.docs.append(([int(h) for h in tokens.hash], tokens.cls.tolist(), keys, held))
        self.words, self.classes = collections.Counter(), {}
        self.contexts = collections.defaultdict(collections.Counter)
        for hashes, classes, keys, held in self.docs:
            if not held:
                self.words.update(hashes)
                for kind in range(mixing.KINDS):
                    for key, cls in zip(keys[kind], classes, strict=True):
                        self.contexts[key][cls] += 1
            self.classes.update(zip(hashes, classes, strict=True))
        self.mass, self.kinds = collections.Counter(), collections.Counter()
        for word, n in self.words.items():
            self.mass[self.classes[word]] += n
            self.kinds[self.classes[word]] += 1
        self.weights = np.full((mixing.GATES, mixing.INPUTS), mixing.START)
        self.repeats = np.zeros((len(mixing.RARE) + 1, 2))
        self.repeats[:, 0] = 1.0

    @staticmethod
    def below(counts, bits, first):
        return sum(n for c, n in counts.items() if c >> (8 - bits) == first)

    def base(self, j, first):
        return (self.below(self.mass, j + 1, 2 * first + 1) + 0.5) / (self.below(self.mass, j, first) + 1.0)

    def coded(self, learn):
        """log2 of the repetition bits and classes of each document; with learn only of training documents, each token without itself."""
        some = [i for i, d in enumerate(self.docs) if not (learn and d[3])]
        state = {i: dict(own=np.zeros(mixing.INPUTS), counts=collections.Counter(), tried=[0, 0], bits=0.0, pairs={}) for i in some}
        done = 0
        while any(len(self.docs[i][0]) > done for i in some):
            slopes, seen = np.zeros_like(self.weights), np.zeros(mixing.GATES)
            turns, offered = np.zeros_like(self.repeats), np.zeros(len(mixing.RARE) + 1)
            for i in some:
                hashes, classes, keys, _ = self.docs[i]
                own = state[i]
                step, tried = np.zeros(mixing.INPUTS), [0, 0]
                chunk = range(done, min(done + mixing.CHUNK, len(hashes)))
                for t in chunk:
                    again = own["pairs"].get((hashes[t - 1], hashes[t - 2])) if t >= 2 else None
                    if t >= 2:
                        own["pairs"][hashes[t - 1], hashes[t - 2]] = hashes[t]
                    if again is not None:
                        hit = again == hashes[t]
                        gate = sum(max(self.words[again] - learn, 0) >= r for r in mixing.RARE)
                        rate = math.log((own["tried"][1] + 0.5) / (own["tried"][0] + 1.0) / (1 - (own["tried"][1] + 0.5) / (own["tried"][0] + 1.0)))
                        p = 1 / (1 + math.exp(-max(-14, min(14, self.repeats[gate, 0] * rate + self.repeats[gate, 1]))))
                        own["bits"] += math.log2(p if hit else 1 - p)
                        tried[0] += 1
                        tried[1] += hit
                        offered[gate] += 1
                        turns[gate] += (hit - p) * np.array([rate, 1.0])
                        if hit:
                            continue
                    first = 0
                    for j in range(8):
                        bit = classes[t] >> (7 - j) & 1
                        b = self.base(j, first)
                        x = [math.log(b / (1 - b))]
                        for kind in range(mixing.KINDS):
                            counts = self.contexts[keys[kind][t]]
                            total = max(self.below(counts, j, first) - learn, 0)
                            taken = max(self.below(counts, j + 1, 2 * first + bit) - learn, 0)
                            ones = taken if bit else total - taken
                            p = min(max((ones + mixing.BACK_OFF * b) / (total + mixing.BACK_OFF), 1e-5), 1 - 1e-5)
                            x.append(math.log(p / (1 - p)))
                        if done:
                            p = (self.below(own["counts"], j + 1, 2 * first + 1) + mixing.BACK_OFF * b) / (self.below(own["counts"], j, first) + mixing.BACK_OFF)
                            p = min(max(p, 1e-5), 1 - 1e-5)
                            x.append(math.log(p / (1 - p)))
                        else:
                            x.append(x[0])
                        gate = j * (len(mixing.LEVELS) + 1) + sum(total >= v for v in mixing.LEVELS)
                        x = np.array(x)
                        p = 1 / (1 + math.exp(-max(-14, min(14, float(np.dot(self.weights[gate] + own["own"], x))))))
                        own["bits"] += math.log2(p if bit else 1 - p)
                        step += (bit - p) * x
                        slopes[gate] += (bit - p) * x
                        seen[gate] += 1
                        first = 2 * first + bit
                if len(chunk):
                    own["own"] = np.clip(own["own"] + mixing.RATE * step / math.sqrt(len(chunk)), -0.5, 0.5)
                    own["counts"].update(classes[t] for t in chunk)
                    own["tried"] = [own["tried"][0] + tried[0], own["tried"][1] + tried[1]]
            if learn:
                self.weights += mixing.START_RATE * slopes / np.maximum(seen, 1)[:, None] ** 0.75
                self.repeats += mixing.START_RATE * turns / np.maximum(offered, 1)[:, None] ** 0.75
            done += mixing.CHUNK
        return [state[i]["bits"] for i in some]

    def scores(self):
        self.coded(learn=1)
        out = {}
        for (doc_id, *_), (hashes, classes, _, _), bits in zip(self.rows, self.docs, self.coded(learn=0), strict=True):
            pairs, rest = {}, 0.0
            for t, (h, c) in enumerate(zip(hashes, classes, strict=True)):
                hit = t >= 2 and pairs.get((hashes[t - 1], hashes[t - 2])) == h
                if t >= 2:
                    pairs[hashes[t - 1], hashes[t - 2]] = h
                if not hit:
                    rest += math.log10((self.words[h] + 0.5) / (self.mass[c] + 0.5 * (self.kinds[c] + 1)))
            out[doc_id] = rest + bits * math.log10(2)
        return out


def test_scores_against_single_bits(spark):
    """The whole way, through counts, learning and scoring, for documents of real text, repeated lines, short and empty ones."""
    texts = [r.text[:1500] for r in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").limit(14).collect()]
    texts += ["", "one", "a b c d " * 60, "the cat sat on the mat . " * 30 + "the cat ran", texts[0], texts[1][:700] + texts[1][:700]]
    rows = [(i, t, zlib.crc32(str(i).encode()) % 5 == 1) for i, t in enumerate(texts)]
    assert 2 <= sum(h for *_, h in rows) < len(rows)
    got = {r.doc_id: r for r in mixing.score(spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string").coalesce(1)).collect()}
    want = Plain(rows).scores()
    for i, text in enumerate(texts):
        assert got[i].score == pytest.approx(want[i], rel=2e-4, abs=1e-3), i
        assert got[i].bits_per_byte == pytest.approx(-got[i].score / math.log10(2) / max(1, len(text.encode())))


def test_repeated_tokens():
    tokens = tokens_of(["a b c a b c a b d", "a b c", "x"])
    before, hit = tokens.repeated
    first = [before[i] for i in range(tokens.counts[0])]
    # after "a b" came c; after "b c" a; after "c a" b
    assert first == [-1, -1, -1, -1, -1, 2, 3, 4, 5, -1] and hit[:10].tolist() == [False] * 5 + [True] * 3 + [False] * 2
    assert (before[10:] == -1).all() and not hit[10:].any()  # nothing is known from other documents


def test_contexts():
    text = "The quick fox to a den then of wandering"
    tokens = tokens_of(["in", text, text])
    a, b = tokens.first[1], tokens.first[2]
    assert (tokens.contexts[:, a:b] == tokens.contexts[:, b:]).all()
    same = tokens_of(["say to a"]), tokens_of(["tell the to a"])
    assert same[0].contexts[1][-1] == same[1].contexts[1][-1]


def alone(texts, held=()):
    """Predictors and tokens of one block that is all there is."""
    block = mixing.Block(pa.array([t.encode() for t in texts], pa.binary()))
    n = np.zeros(len(block.key), np.int64)
    for key, which in block.found[0]:
        n[np.searchsorted(block.key, key)] += np.bincount(which, minlength=len(key))
    plain = np.bincount(block.tokens[0].cls, minlength=mixing.CLASSES)
    model = mixing.Predictors(plain, block, mixing.path_counts(block.key, n).astype(np.float32))
    return model, block


def test_classes_share_all_probability():
    """Whatever class comes next, in a known context, the probabilities of all classes add up to one."""
    model, block = alone(["the cat sat on the mat and the dog ran " * 20])
    model.look_up(0)
    total = 0.0
    for cls in range(mixing.CLASSES):
        node = (1 << np.arange(8)) | (cls >> (8 - np.arange(8)))
        p = model.base[node]
        total += float(np.prod(np.where(cls >> (7 - np.arange(8)) & 1, p, 1 - p)))
    assert total == pytest.approx(1.0, rel=1e-4)


@pytest.mark.parametrize("numbers", [[], [0], [5, 1 << 31, 7, (1 << 32) - 1]])
def test_planes(numbers):
    for kind in ("<u4", "<u8"):
        assert mixing.from_planes(mixing.planes(np.array(numbers, kind)), kind).tolist() == numbers


def test_learns_only_from_training(spark):
    rows = [(i, f"common words here number {i}") for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("score", F.lit("x"))
    plain = {r.doc_id: r.score for r in mixing.score(frame).collect()}
    held = [i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 1]
    changed = [(i, "something else entirely" if i == held[0] else t) for i, t in rows]
    again = {r.doc_id: r.score for r in mixing.score(spark.createDataFrame(changed, "doc_id bigint, text string")).collect()}
    assert {i: s for i, s in plain.items() if i != held[0]} == pytest.approx({i: s for i, s in again.items() if i != held[0]})
    assert mixing.score(frame.limit(0)).count() == 0
    alone = mixing.score(frame.where(F.col("doc_id") == held[0])).collect()
    assert alone[0].n_known == 0 and alone[0].train_tokens == 0


def test_counts_come_back_to_each_block(spark):
    """Words and contexts counted in several blocks: each block hears the counts of all for what it has."""
    texts = [" ".join(f"w{(i * 37 + j) % 3000}x {(i + j) % 9 * 7} of" for j in range(300)) for i in range(20)]
    held = [i % 5 == 1 for i in range(20)]
    rows = [(i // 7, t, h) for i, (t, h) in enumerate(zip(texts, held, strict=True))]
    blocks = spark.createDataFrame(rows, "block int, text string, held_out boolean")
    blocks = blocks.withColumn("text", F.col("text").cast("binary")).groupBy("block")
    seen = blocks.applyInArrow(mixing._seen(4), mixing.SEEN).repartition("bucket").sortWithinPartitions("bucket")
    told = seen.mapInArrow(mixing._totals(4), mixing.TOLD)
    classes = seen.mapInArrow(mixing._classes(4), mixing.CLASS).groupBy("cls").agg(F.sum("kinds").alias("kinds"), F.sum("tokens").alias("tokens"))
    plain = Plain([(i, t, h) for i, (t, h) in enumerate(zip(texts, held, strict=True))])
    got = {r.cls: (r.kinds, r.tokens) for r in classes.collect() if r.tokens}
    assert got == {c: (plain.kinds[c], n) for c, n in plain.mass.items()}
    for b in range(3):
        mine = list(range(7 * b, min(20, 7 * b + 7)))
        block = mixing.Block(pa.array([texts[i].encode() for i in mine], pa.binary()))
        known = mixing.Told(block, told.where(F.col("block") == b).toArrow(), 4)
        for word, n in zip(block.word.tolist(), known.count.tolist(), strict=True):
            assert n == plain.words[word]
        hashed = tokens_of([texts[i] for i in mine])
        for kind in range(mixing.KINDS):
            for t in range(0, len(hashed.hash), 13):
                context, cls = (kind, int(hashed.contexts[kind][t]) >> 8), int(hashed.cls[t])
                key = hashed.keys(kind)[t]
                path = known.model.path[np.searchsorted(block.key, key)]
                assert path.tolist() == [Plain.below(plain.contexts[context], j, cls >> (8 - j)) for j in range(9)]


def test_contexts_beyond_any_table(spark):
    """20,000 words, each followed by another of its own: no two of them may share counts (1.91 when they did)."""
    pairs = [f"{i:04x} {chr(97 + i % 25)}{chr(97 + i % 23)}{chr(97 + i % 19)}zzz" for i in range(20_000)]
    rows = [(i, " ".join(pairs[(i * 137 + j) * 7919 % 20_000] for j in range(500))) for i in range(400)]
    got = mixing.score(spark.createDataFrame(rows, "doc_id bigint, text string")).where("held_out").collect()
    assert got and sum(r.bits_per_byte for r in got) / len(got) < 1.6


def test_learns_from_long_documents(spark, monkeypatch):
    """Documents of any length fit the weights, and every training document takes part."""
    long = " ".join(f"word{i % 97} of {i % 13} {i}" for i in range(4000))
    rows = pa.table({"doc_id": [0, 1, 2], "text": [f"{long} {i}".encode() for i in range(3)], "held_out": [False] * 3})
    told = []

    def learned(held):
        table = rows.set_column(2, "held_out", pa.array(held))
        seen = mixing._seen(4)([pa.scalar(0)], table).sort_by("bucket")
        batches = list(mixing._totals(4)(iter(seen.to_batches())))
        classes = pa.Table.from_batches(list(mixing._classes(4)(iter(seen.to_batches()))))
        known = pa.concat_tables([pa.Table.from_batches(batches), classes], promote_options="default")
        kept = []
        real = mixing.coded_log2
        monkeypatch.setattr(mixing, "coded_log2", lambda model, *rest, **how: (kept.append(model), real(model, *rest, **how))[1])
        out = mixing.score_block(table, known, 4)
        monkeypatch.undo()
        assert out.num_rows == 3
        return kept[-1].weights

    told = learned([False] * 3), learned([False, False, True]), learned([True] * 3)
    assert len(long) > 16_384 and (told[0] != mixing.START).mean() > 0.3
    assert (told[1] != told[0]).any() and (told[2] == mixing.START).all()


def test_texts_are_shuffled_once(spark):
    """Counting and scoring read the same blocks."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = mixing.score(docs)
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange") >= 2


class PlainBelow(Plain):
    """The model that also mixes the bits of a token below its class."""

    def __init__(self, rows):
        super().__init__(rows)
        self.turned = np.tile(np.array(mixing.WORD_START), (mixing.WORD_GATES, 1))
        self.after = collections.defaultdict(collections.Counter)
        for hashes, classes, keys, held in self.docs:
            for t, (h, c) in enumerate(zip(hashes, classes, strict=True)):
                if not held:
                    self.after[c][self.low(h)] += 1
                    self.after[keys[0][t], c][self.low(h)] += 1

    @staticmethod
    def low(h):
        return h & (1 << mixing.WORD_BITS) - 1

    @staticmethod
    def path(counts, low, learn):
        bits = mixing.WORD_BITS
        return [max(0, sum(n for s, n in counts.items() if s >> (bits - j) == low >> (bits - j)) - learn) for j in range(bits + 1)]

    def changed(self, learn):
        """log2 of the mixed bits of each document, less that of their rates."""
        some = [i for i, d in enumerate(self.docs) if not (learn and d[3])]
        state = {i: dict(own=np.zeros(3), last={}, pairs={}, bits=0.0) for i in some}
        done = 0
        while any(len(self.docs[i][0]) > done for i in some):
            slopes, often = np.zeros_like(self.turned), np.zeros(mixing.WORD_GATES)
            for i in some:
                hashes, classes, keys, _ = self.docs[i]
                own, step, n = state[i], np.zeros(3), 0
                for t in range(done, min(done + mixing.CHUNK, len(hashes))):
                    h, c, low = hashes[t], classes[t], self.low(hashes[t])
                    hit = t >= 2 and own["pairs"].get((hashes[t - 1], hashes[t - 2])) == h
                    if t >= 2:
                        own["pairs"][hashes[t - 1], hashes[t - 2]] = h
                    last = own["last"].get(c)
                    own["last"][c] = low
                    if hit or self.words[h] - learn <= 0:
                        continue
                    agreed = -1 if last is None else mixing.WORD_BITS - (last ^ low).bit_length()
                    plain, after = self.path(self.after[c], low, learn), self.path(self.after[keys[0][t], c], low, learn)
                    for j in range(mixing.WORD_BITS):
                        total, taken, seen, same = plain[j], plain[j + 1], after[j], after[j + 1]
                        if taken == total or (seen < mixing.LEAST_SEEN and agreed < j):
                            continue
                        if seen < mixing.LEAST_SEEN:
                            seen = same = 0
                        rate = taken / total
                        p = (same + mixing.BACK_OFF * rate) / (seen + mixing.BACK_OFF)
                        x = np.array([math.log(rate / (1 - rate)), math.log(p / (1 - p)), 0 if agreed < j else 1 if agreed > j else -1])
                        level = sum(seen >= v for v in mixing.LEVELS)
                        gate = level * (len(mixing.AGREED) + 2) + (0 if agreed < j else 1 + sum(j >= v for v in mixing.AGREED))
                        p = 1 / (1 + math.exp(-max(-14, min(14, float(np.dot(self.turned[gate] + own["own"], x))))))
                        own["bits"] += math.log2(p / rate)
                        step += (1 - p) * x
                        slopes[gate] += (1 - p) * x
                        often[gate] += 1
                        n += 1
                if n:
                    own["own"] = np.clip(own["own"] + mixing.RATE * step / math.sqrt(n), -0.5, 0.5)
            if learn:
                self.turned += mixing.START_RATE * slopes / np.maximum(often, 1)[:, None] ** 0.75
            done += mixing.CHUNK
        return [state[i]["bits"] for i in some]

    def scores(self):
        self.coded(learn=1)
        self.changed(learn=1)
        out = {}
        for (doc_id, *_), (hashes, classes, _, _), bits, more in zip(self.rows, self.docs, self.coded(learn=0), self.changed(learn=0), strict=True):
            pairs, rest = {}, 0.0
            for t, (h, c) in enumerate(zip(hashes, classes, strict=True)):
                hit = t >= 2 and pairs.get((hashes[t - 1], hashes[t - 2])) == h
                if t >= 2:
                    pairs[hashes[t - 1], hashes[t - 2]] = h
                if not hit:
                    known = self.mass[c] + 0.5 * self.kinds[c]
                    rest += math.log10((known * self.words[h] / self.mass[c] if self.words[h] else 0.5) / (known + 0.5))
            out[doc_id] = rest + (bits + more) * math.log10(2)
        return out


def test_bits_below_the_class_against_single_bits(spark):
    """The whole way with the bits of a token below its class, for real text, words that follow others, and repeated ones."""
    texts = [r.text[:1500] for r in spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").limit(10).collect()]
    texts += ["", "one", " ".join(f"w{i % 7} word{i % 7}x word{i * i % 5}y" for i in range(150)), texts[0], "worda wordb worda wordb wordc"]
    rows = [(i, t, zlib.crc32(str(i).encode()) % 5 == 1) for i, t in enumerate(texts)]
    frame = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string").coalesce(1)
    got = {r.doc_id: r.score for r in mixing.score(frame, below=True).collect()}
    model = PlainBelow(rows)
    want = model.scores()
    assert (model.turned != np.array(mixing.WORD_START)).any()
    assert got == {i: pytest.approx(want[i], rel=2e-4, abs=1e-3) for i in want}


def test_a_word_tells_the_next_below_its_class(spark):
    """Words of one class, each after a word of its own: the count in the class takes six bits of each, the word before tells it."""
    dealt = random.Random(1)
    rows = [(i, " ".join(f"{k} same{k}" for k in dealt.choices(range(64), k=30))) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    bits = [sum(r.bits_per_byte for r in mixing.score(frame, below=b).where("held_out").collect()) for b in (False, True)]
    assert bits[1] < 0.75 * bits[0]


def test_words_of_a_class_share_its_probability():
    """Whichever word of the class comes next, after a known word and a token of the class, the probabilities add up to one."""
    words = [f"wor{c}{i}" for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")]
    texts = [" ".join(f"{'xy'[(i + j) % 2]} {words[(i * j + j) % 26]}" for j in range(200)) for i in range(4)] + [f"{words[3]} x {w}" for w in words]
    block = mixing.Block(pa.array([t.encode() for t in texts], pa.binary()), True)
    trained = np.arange(len(texts)) < 4
    n, _, below = block.counted(trained)
    model = mixing.WordPredictors(block, mixing.path_counts(block.word_key, below.astype(np.int64), mixing.WORD_BITS).astype(np.float32))
    model.weights += np.linspace(-0.3, 0.4, model.weights.size, dtype=np.float32).reshape(model.weights.shape)
    tokens = block.tokens[0]
    last = np.zeros(len(tokens.hash), bool)
    last[tokens.first[5:] - 2] = True
    assert len(set(tokens.cls[last])) == 1
    n = n[np.searchsorted(block.word, tokens.hash)][last].astype(float)
    at, plain, after = model.look_up(0, last, own=False)
    assert len(at) == 26 and (n > 0).all()
    changed = mixing.coded_words(model, tokens, at, plain, after, tokens.agreed[at])[4:]
    assert (abs(changed) > 0.01).any() and (n / n.sum() * 2**changed).sum() == pytest.approx(1.0, rel=1e-4)


def test_the_query_mixes_all_bits(spark):
    """The registered query codes the bits below the class in context."""
    from costalloc.llm import queries

    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    want = {r.doc_id: r.score for r in mixing.score(docs, below=True).collect()}
    got = {r.doc_id: r.score for r in queries.op2_lm_scoring(spark, SMALL).collect()}
    assert got == pytest.approx(want, rel=1e-6)
