"""Language-model scores by online logistic mixing of context predictors.

A text is its words, each as bytes with a blank behind it, and one end mark.
Bits are predicted one after the other.  Each predictor knows how often a 0 and
how often a 1 followed a context in the training texts: the last one to four
bytes of the word (hashed into tables of a fixed size) and the whole word so far
(counts that grow with the vocabulary).  A predictor's say is the log odds of
its counts; a gate (place of the bit, and how much the longest contexts have
seen) picks the weights that the log odds are summed with.  Weights follow the
coding cost online, by a Newton step after each block of bits; each occurrence
is predicted from all the others, never from itself.  What the mixed odds are off
by, by bit and by odds, is counted on the way and corrected (refinement).

Within a document the model keeps adapting.  Training rows may carry a group (a
language, a source): counts of known words within each group are experts beside
the whole corpus, and each has a say as far as it predicted the document so far.
A word that came before is mixed in by its count so far, at several strengths,
which share the document in the same way.  All of this is a probability of the
text: over all texts it sums to one.

How it runs: a batch of documents lists its distinct words once, so a word has at
most one row a batch.  Words are counted over all batches, dealt by their first
bytes and sorted, so that the words of a prefix are one run; each distinct word
is scored once.  Scores go back to the batches, where documents are numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.core.broadcast import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from .common import frugal, merged, ragged_take, tuned, word_table, written

#: Bytes of texts of a batch; a longer text is a batch of its own.  A batch's words
#: are listed once, so a larger batch lists fewer in all.
BATCH_BYTES = 64 << 20
#: Table slots of the contexts of one, two, three and four bytes, as powers of two.
SLOT_BITS = (16, 20, 21, 21)
SLOTS = np.concatenate([[0], np.cumsum([1 << b for b in SLOT_BITS])]).astype(np.int64)
#: Bytes of a word that the whole-word context follows.
PREFIX = 24
#: Words that share their first bytes and are laid out together.
GROUP = 1 << 17
#: Words evaluated together, bytes that one step learns from, and bytes of words
#: that are held so that each step sees words from all over them.
TOGETHER, BLOCK, HELD = 1 << 13, 1 << 13, 1 << 21
PRIOR, START, DAMP, FADE, OFTEN = 0.1, 0.3, 20.0, 0.95, 4
SEEN_STEPS, SHORT_STEPS = np.array([1, 2, 4, 16, 256]), np.array([1, 4, 32, 256, 4096])
INPUTS, PLACES = len(SLOT_BITS) + 2, 4
GATES = 8 * (PLACES + 7) * 6
#: Curvature and pull of a gate, in one row.
WIDE = INPUTS * INPUTS + INPUTS
#: Refinement: cells of log odds from -12 to 12 and how many bits a cell starts with.
CELLS, CELL_START = 33, 20.0
END = b"\n"
#: Words of documents that are laid out together.
PART = 1 << 17
#: How many words of evidence the model counts as, against those of the document.
STRENGTHS = np.array([16.0, 64.0, 256.0, 1024.0, 4096.0, np.inf])
TOKENS = "batch long, doc_ids array<long>, held_out array<boolean>, ends array<int>, bytes array<long>, codes binary, word binary, at int, learned array<long>"
#: Groups with counts of their own, by the number of their rows; others are one more.
GROUPS = 8


def token_batches(docs: DataFrame, learn: Column, held_out: Column, group: Column, groups: int) -> DataFrame:
    """Documents as numbers of their batch's words, and those words.

    A row with ``codes`` is a batch: its documents' ids, the ends of their
    tokens (words, then the end mark), and all tokens as compressed 32-bit
    numbers, the most frequent word first.  A row with ``word`` is a word of a
    batch, its number ``at`` and its occurrences in documents that ``learn``, by
    group (numbers below ``groups``).
    """
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.int32(), pa.list_(pa.int64())]
    names = [c.split()[0] for c in TOKENS.split(", ")]

    def rows(n: int, **values: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([values[c].cast(t) if c in values else pa.nulls(n, t) for c, t in zip(names, kinds)], schema=pa.schema(list(zip(names, kinds))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, k, held, size = TaskContext.get().partitionId(), 0, [], 0

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal k
            name, k = (task << 32) + k, k + 1
            texts = pa.Table.from_batches([b for b, *_ in held])
            spelled = pa.concat_arrays([w for _, w, *_ in held] + [pa.array([END], pa.large_binary())]).dictionary_encode()
            number = spelled.indices.to_numpy().astype(np.int64)
            starts = np.cumsum([0, *(len(w) for _, w, *_ in held)])
            codes = [np.insert(number[s + c], e[1:], number[-1]) for s, (_, _, c, e) in zip(starts, held)]
            sizes = np.concatenate([np.diff(e) + 1 for *_, e in held])
            codes, ends = np.concatenate(codes), np.cumsum(sizes)
            order = np.argsort(-np.bincount(codes), kind="stable")
            words, place = spelled.dictionary.take(pa.array(order)), np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            codes = place[codes]
            length = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64) + 1
            length[place[number[-1]]] = 1
            learned = np.repeat(texts.column(3).to_numpy(), sizes)
            own = np.repeat(texts.column(4).to_numpy(), sizes)[learned]
            times = np.bincount(codes[learned] * groups + own, minlength=len(words) * groups)
            bytes_ = np.add.reduceat(length[codes], ends - sizes)
            one = lambda a: pa.array([a])
            packed = pa.Codec("zstd").compress(codes.astype("<u4"), asbytes=True)
            yield rows(1, batch=one(name), doc_ids=one(texts.column(0).to_pylist()), held_out=one(texts.column(2).to_pylist()), ends=one(ends), bytes=one(bytes_), codes=one(packed))
            for i in range(0, len(words), 1 << 16):
                some = words.slice(i, 1 << 16)
                n = len(some)
                yield rows(n, batch=pa.array([name] * n), word=some, at=pa.array(np.arange(i, i + n)), learned=pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * groups, pa.int32()), pa.array(times[i * groups : (i + n) * groups])))

        for b in merged(frugal(batches), 1):
            words, codes, ends = word_table(b.column(1), lower=True)
            more = int(pc.sum(pc.binary_length(b.column(1))).as_py() or 0)
            if held and size + more > BATCH_BYTES:
                yield from out()
                held, size = [], 0
            held.append((b.drop_columns(["text"]).add_column(1, "text", pa.nulls(b.num_rows)), words.cast(pa.large_binary()), codes.astype(np.int32), ends))
            size += more
        if held:
            yield from out()

    return docs.select(F.col("doc_id").cast("long"), "text", held_out.alias("h"), F.coalesce(learn, F.lit(False)).alias("l"), group.cast("int").alias("g")).mapInArrow(run, TOKENS)


class Words:
    """Distinct words laid end to end, each with its blank behind it."""

    def __init__(self, words: pa.Array, counts: np.ndarray):
        words = words.cast(pa.large_binary())
        n = len(words)
        ends = np.frombuffer(words.buffers()[1], np.int64, n + 1, 8 * words.offset)
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[: ends[-1]] if n else np.zeros(0, np.uint8)
        self.data = np.insert(data[ends[0] :], ends[1:] - ends[0], 32) if n else data
        self.ends = ends - ends[0] + np.arange(n + 1)
        self.count = counts.astype(np.float64)

    def __len__(self) -> int:
        return len(self.count)

    def part(self, i: int, j: int) -> Words:
        out = Words.__new__(Words)
        out.data, out.ends, out.count = self.data[self.ends[i] : self.ends[j]], self.ends[i : j + 1] - self.ends[i], self.count[i:j]
        return out

    def places(self) -> tuple[np.ndarray, np.ndarray]:
        """The word of each byte and the byte's place in it."""
        owner = np.repeat(np.arange(len(self)), np.diff(self.ends))
        return owner, np.arange(len(self.data)) - self.ends[owner]

    @classmethod
    def joined(cls, parts: list[Words]) -> Words:
        out = cls.__new__(cls)
        out.data, out.count = np.concatenate([p.data for p in parts]), np.concatenate([p.count for p in parts])
        out.ends = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(p.ends) for p in parts]))])
        return out

    def take(self, rows: np.ndarray) -> Words:
        out = Words.__new__(Words)
        size = np.diff(self.ends)
        out.data, out.count = self.data[ragged_take(size, self.ends[:-1], rows)], self.count[rows]
        out.ends = np.concatenate([[0], np.cumsum(size[rows])])
        return out

    def bits(self) -> np.ndarray:
        return np.unpackbits(self.data)

    def entries(self) -> np.ndarray:
        """Entries of each word in ``prefix_counts``."""
        return np.minimum(np.diff(self.ends), PREFIX) * 8 + 1

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """Bytes whose bits have a context or a value of their own, and which of
        them each byte repeats.  A word repeats what it has in common with the
        one before, so sorted words give the edges of their tree of prefixes."""
        owner, place = self.places()
        new = place >= np.append(0, self._shared_bits() // 8)[owner] if len(self) else np.zeros(0, bool)
        # the latest byte of the same place that repeats none; beyond PREFIX none does
        order = np.argsort(np.minimum(place, PREFIX).astype(np.uint8), kind="stable")
        of = np.empty(len(order), np.int64)
        of[order] = order[np.maximum.accumulate(np.where(new[order], np.arange(len(order)), 0))]
        return np.flatnonzero(new), (np.cumsum(new) - 1)[of]

    def slots(self, some: np.ndarray | slice = slice(None)) -> list[np.ndarray]:
        """For each order the table slot of the context of every bit, or of the
        bits of ``some`` bytes."""
        data, place = self.data.astype(np.uint64), self.places()[1]
        node = ((np.uint64(1) << np.arange(8, dtype=np.uint64)) | (data[some, None] >> np.arange(8, 0, -1, dtype=np.uint64))).ravel()
        out, context = [], np.zeros(len(data), np.uint64)
        for k, size in enumerate(SLOT_BITS, 1):
            # the byte k places back; a blank stands before the word, nothing before that
            back = np.zeros(len(data), np.uint64)
            back[k:] = data[:-k] if k < len(data) else 0
            back[place < k] = 0
            back[place == k - 1] = 32
            context = context | (back << np.uint64(8 * (k - 1)))
            key = np.repeat(context[some] << np.uint64(8), 8) | node
            if k > 1:
                key = key * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - size)
            out.append(key.astype(np.int64) + SLOTS[k - 1])
        return out

    def prefix_counts(self, skip: int) -> np.ndarray:
        """Occurrences of the words that share each first part, bit by bit: an
        entry for every bit of the first ``PREFIX`` bytes and one more, end to
        end.  Words are sorted, so sharers are neighbours.  Entries within the
        first ``skip`` bytes are -1."""
        n, size = len(self), self.entries()
        starts = np.cumsum(size) - size
        out = np.repeat(self.count, size)
        if n > 1:
            shared = self._shared_bits()
            near = np.maximum(np.append(0, shared), np.append(shared, 0))
            alive = np.flatnonzero(near >= skip * 8)
            for d in range(skip * 8, PREFIX * 8 + 1):
                alive = alive[near[alive] >= d]
                if not len(alive):
                    break
                first = np.ones(len(alive), bool)
                # words of a run stay neighbours: all of them share d bits
                first[1:] = (shared[alive[1:] - 1] < d) | (np.diff(alive) > 1)
                run = np.cumsum(first) - 1
                out[starts[alive] + d] = np.bincount(run, weights=self.count[alive])[run]
        out[np.arange(len(out)) - np.repeat(starts, size) < skip * 8] = -1
        return out

    def _shared_bits(self) -> np.ndarray:
        """Leading bits that each word shares with the next, up to ``PREFIX`` bytes."""
        n = len(self)
        out, alive = np.zeros(n - 1, np.int64), np.arange(n - 1)
        size = np.diff(self.ends)
        for p in range(PREFIX):
            alive = alive[(size[alive] > p) & (size[alive + 1] > p)]
            if not len(alive):
                break
            differ = self.data[self.ends[alive] + p] ^ self.data[self.ends[alive + 1] + p]
            out[alive] += np.where(differ == 0, 8, 8 - np.frexp(differ.astype(np.float64))[1])
            alive = alive[differ == 0]
        return out


#: Counts in tables are 16-bit codes: exact up to 2,047, then 1,024 a doubling.
EXACT, OCTAVE = 2048, 1024
DECODED = np.where(np.arange(1 << 16) < EXACT, np.arange(1 << 16), EXACT * 2.0 ** ((np.arange(1 << 16) - EXACT) / OCTAVE)).astype(np.float32)


#: Log of each code's count, and with one occurrence less.
LOGS, LESS = np.log(DECODED + np.float32(PRIOR)), np.log(np.maximum(DECODED - 1, 0) + np.float32(PRIOR))


def _steps(steps: np.ndarray, n: np.ndarray) -> np.ndarray:
    """How many of a few steps each number has reached."""
    return sum((n >= s).astype(np.int32) for s in steps)


def coded(n: np.ndarray) -> np.ndarray:
    return np.where(n < EXACT, n, np.minimum(EXACT + np.round(OCTAVE * np.log2(np.maximum(n, EXACT) / EXACT)), (1 << 16) - 1)).astype(np.uint16)


@dataclass
class ContextModel:
    """Counts by table slot (``coded``), mixing weights by gate, refinement by
    bit and odds."""

    tables: np.ndarray | None
    skip: int
    weights: np.ndarray | None = None
    cells: np.ndarray | None = None

    def inputs(self, words: Words, counts: np.ndarray, leave_out: bool = False, some: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Log odds of a 1 by predictor (the last one constant), gate, bit, and
        the node within its byte, for each bit of ``words``, or of ``some`` of
        their bytes; ``counts`` are their ``prefix_counts``.  ``leave_out`` takes
        one occurrence of the word itself out of all counts."""
        owner, place = words.places()
        some = np.arange(len(owner)) if some is None else some
        owner, place, data = owner[some], place[some], words.data[some]
        bit = np.unpackbits(data)
        n, sign = len(bit), bit.astype(np.float32) * 2 - 1
        x = np.empty((INPUTS, n), np.float32)
        less, pairs = (LESS if leave_out else LOGS), self.tables.view(np.uint32).ravel()
        # a pair of codes is one number, the first in its lower half
        shift = bit.astype(np.uint32) << np.uint32(4)
        for k, slot in enumerate(words.slots(some)):
            pair = pairs[slot]
            same, other = (pair >> shift) & np.uint32(0xFFFF), (pair >> (shift ^ np.uint32(16))) & np.uint32(0xFFFF)
            x[k] = (less[same] - LOGS[other]) * sign
        seen = DECODED[same]
        long = _steps(SHORT_STEPS, (np.maximum(seen - 1, 0) if leave_out else seen) + DECODED[other])
        # each bit's entry, and the next one: of those, the words with the same bit
        size = words.entries()
        at = (((np.cumsum(size) - size)[owner] + np.minimum(place, PREFIX - 1) * 8)[:, None] + np.arange(8)).ravel()
        total, same = counts[at], counts[at + 1]
        known = (total >= 0) & np.repeat(place < PREFIX, 8)
        other = np.maximum(total - same, 0)
        same = np.maximum(same - 1, 0) if leave_out else np.maximum(same, 0)
        log = lambda c: np.log((c + PRIOR).astype(np.float32))
        x[-2] = np.where(known, (log(same) - log(other)) * sign, 0)
        x[-1] = 0.3
        seen = np.where(known, 1 + _steps(SEEN_STEPS, total - 1 if leave_out else total), 0)
        # the first bytes of a word have no count of the whole word, but gates of their own
        seen = np.where(np.repeat(place < PLACES, 8), np.repeat(place, 8), PLACES + seen)
        place = np.tile(np.arange(8), len(data))
        node = (1 << place) | (np.repeat(data, 8) >> (8 - place))
        return np.clip(x, -12, 12, out=x), ((place * (PLACES + 7) + seen) * 6 + long).astype(np.int32), bit, node.astype(np.int32)

    def mixed(self, x: np.ndarray, gate: np.ndarray) -> np.ndarray:
        t = np.zeros(len(gate))
        for k, w in enumerate(np.ascontiguousarray(self.weights.T)):
            t += x[k] * w[gate]
        return np.clip(t, -12, 12, out=t)

    def learn_all(self, words: Words, counts: np.ndarray, curve: np.ndarray, hits: np.ndarray) -> None:
        """Learn from sorted words in an order that runs through all of them
        again and again; the occurrences of frequent ones are spread over all
        steps, as they are in the texts."""
        size, steps = words.entries(), len(words.data) // BLOCK + 1
        starts = np.cumsum(size) - size
        often = np.flatnonzero(words.count * steps * OFTEN > words.count.sum())
        rest = np.delete(np.arange(len(words)), often)
        for k in range(steps):
            rows = np.concatenate([often, rest[k::steps]])
            if len(rows):
                some = words.take(rows)
                some.weight = np.concatenate([some.count[: len(often)] / steps, some.count[len(often) :]])
                self.learn(some, counts[ragged_take(size, starts, rows)], curve, hits)

    def learn(self, words: Words, counts: np.ndarray, curve: np.ndarray, hits: np.ndarray) -> None:
        """One online step: predict a block of words, then step down its cost by
        the curvature seen so far (``curve``, by gate)."""
        some, of = words.distinct()
        x, gate, bit, node = self.inputs(words, counts, leave_out=True, some=some)
        weight = np.repeat(np.bincount(of, weights=np.repeat(words.weight, np.diff(words.ends)), minlength=len(some)), 8)
        use = np.flatnonzero(weight > 0)
        hits *= FADE
        for i in np.split(use, range(8 * BLOCK, len(use), 8 * BLOCK)):
            g, w, xb = gate[i], weight[i], x[:, i].astype(np.float64)
            t = self.mixed(xb, g)
            p = 1 / (1 + np.exp(-t))
            slope = np.stack([np.bincount(g, weights=w * (bit[i] - p) * xb[k], minlength=GATES) for k in range(INPUTS)], axis=1)
            # the larger of expected and seen variance: early steps stay short
            bend = w * np.maximum(p * (1 - p), (bit[i] - p) ** 2)
            for k in range(INPUTS):
                for j in range(k + 1):
                    curve[:, k, j] += (more := np.bincount(g, weights=bend * xb[k] * xb[j], minlength=GATES))
                    if j < k:
                        curve[:, j, k] += more
            self.weights += np.linalg.solve(curve, slope[..., None])[..., 0]
            cell = node[i] * CELLS + np.round((t + 12) * (CELLS - 1) / 24).astype(np.int64)
            hits[:, 0] += np.bincount(cell, weights=w, minlength=len(hits))
            hits[:, 1] += np.bincount(cell, weights=w * bit[i], minlength=len(hits))

    def log10(self, words: Words, counts: np.ndarray) -> np.ndarray:
        """log10 probability of each word."""
        some, of = words.distinct()
        x, gate, bit, node = self.inputs(words, counts, some=some)
        t = self.mixed(x, gate)
        p = 1 / (1 + np.exp(-t))
        if self.cells is not None:
            at = (t + 12) * ((CELLS - 1) / 24)
            low = np.minimum(at.astype(np.int64), CELLS - 2)
            part, cell = at - low, node * CELLS + low
            p = (p + (1 - part) * self.cells[cell] + part * self.cells[cell + 1]) / 2
        # a bit has at least 1e-6, so eight of them are far from the smallest number
        cost = np.log10(np.where(bit, p, 1 - p).reshape(-1, 8).prod(axis=1))
        return np.add.reduceat(cost[of], words.ends[:-1]) if len(words) else np.zeros(0)


def context_tables(words: DataFrame) -> np.ndarray:
    """Zeros and ones by slot over all training words: at most one row a slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, SLOTS[-1]))
        for b in frugal(merged_words(batches)):
            w = Words(b.column(0), b.column(1).to_numpy())
            bit = w.bits()
            times = np.repeat(w.count, np.diff(w.ends) * 8)
            for slot in w.slots():
                for one in (0, 1):
                    hit = bit == one
                    np.add.at(total[one], slot[hit], times[hit])
        at = np.flatnonzero(total.any(axis=0))
        for k in range(0, len(at), 1 << 17):
            some = at[k : k + (1 << 17)]
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[0, some]), pa.array(total[1, some])], names=["slot", "n0", "n1"])

    sums = words.where("c > 0").select("word", "c").mapInArrow(run, "slot int, n0 double, n1 double").groupBy("slot").agg(F.sum("n0").cast("float").alias("n0"), F.sum("n1").cast("float").alias("n1"))
    out = np.zeros((SLOTS[-1], 2), np.uint16)
    got = sums.toArrow()
    at = got.column("slot").to_numpy()
    for k, c in enumerate(("n0", "n1")):
        out[at, k] = coded(got.column(c).to_numpy())
    return out


def merged_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut to ``TOGETHER`` words or 1 MB, so that a run of long words is
    laid out in parts; a longer word is alone."""
    for b in batches:
        ends = np.cumsum(np.array([len(w) for w in b.column(0).to_pylist()], np.int64) + 1)
        at = 0
        while at < b.num_rows:
            to = max(at + 1, min(at + TOGETHER, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + (1 << 20), side="right"))))
            yield b.slice(at, to - at)
            at = to


def key_bytes(words: DataFrame) -> int:
    """First bytes that words are dealt by: four, or as many more as it takes
    for no group of words to pass ``GROUP``."""
    k = len(SLOT_BITS)
    while k < PREFIX and (words.groupBy(_key(k)).count().agg(F.max("count")).first()[0] or 0) > GROUP:
        k += 1
    return k


def _key(k: int) -> Column:
    return F.substring(F.col("word"), 1, k)


def _runs(batches: Iterator[pa.RecordBatch], skip: int) -> Iterator[tuple[pa.Table, Words, np.ndarray]]:
    """Sorted words cut between groups, with their prefix counts, a bounded
    number at a time."""
    held: list[pa.RecordBatch] = []

    def out(rows: pa.Table) -> Iterator[tuple[pa.Table, Words, np.ndarray]]:
        rows = rows.combine_chunks()
        words = Words(rows.column("word").chunk(0), rows.column("c").to_numpy())
        counts, at = words.prefix_counts(skip), np.concatenate([[0], np.cumsum(words.entries())])
        i = 0
        while i < len(words):
            j = max(i + 1, min(i + TOGETHER, int(np.searchsorted(words.ends, words.ends[i] + (1 << 17), side="right")) - 1))
            yield rows.slice(i, j - i), words.part(i, j), counts[at[i] : at[j]]
            i = j

    for b in batches:
        held.append(b)
        if sum(h.num_rows for h in held) < TOGETHER:
            continue
        rows = pa.Table.from_batches(held)
        keys = [w[:skip] for w in rows.column("word").to_pylist()]
        cut = next((i for i in range(len(keys) - 1, 0, -1) if keys[i] != keys[i - 1]), 0)
        if cut:
            yield from out(rows.slice(0, cut))
        held = rows.slice(cut).to_batches()
    if held and sum(h.num_rows for h in held):
        yield from out(pa.Table.from_batches(held))


def train(words: DataFrame) -> tuple[ContextModel, Broadcast]:
    """Counts of all contexts over all training words of a written table (word,
    c); weights and refinement from all of them too.  Each task learns online from its words; weights
    are averaged by the curvature that each task saw, refinement counts add up.  Without training words every bit is even."""
    spark = words.sparkSession
    model = ContextModel(context_tables(words), key_bytes(words))
    shared, skip = spark.sparkContext.broadcast(model.tables), model.skip

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = ContextModel(shared.value, skip, np.full((GATES, INPUTS), START))
        curve, hits = np.tile(DAMP * np.eye(INPUTS), (GATES, 1, 1)), np.zeros((256 * CELLS, 2))
        held: list[tuple[Words, np.ndarray]] = []

        def flush() -> None:
            if held:
                m.learn_all(Words.joined([w for w, _ in held]), np.concatenate([c for _, c in held]), curve, hits)
                held.clear()

        some = False
        for rows, w, counts in _runs(frugal(batches), skip):
            if not len(rows):
                continue
            held.append((w, counts))
            some = True
            if sum(len(w.data) for w, _ in held) >= HELD:
                flush()
        flush()
        if some:
            pull = (curve @ m.weights[..., None])[..., 0]
            values = [*np.concatenate([curve.reshape(GATES, -1), pull], axis=1).tolist(), *np.pad(hits, ((0, 0), (0, WIDE - 2))).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values)), pa.int32()), pa.array(values, pa.list_(pa.float64()))], names=["at", "v"])

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), words.count() // (1 << 17) + 1)
    dealt = words.where("c > 0").select("word", "c").repartition(parts, _key(skip)).sortWithinPartitions("word")
    sums = dealt.mapInArrow(run, "at int, v array<double>").groupBy("at").agg(F.array(*(F.sum(F.col("v")[k]) for k in range(WIDE))).alias("v"))
    total = np.zeros((GATES + 256 * CELLS, WIDE))
    for at, v in sums.collect():  # a fixed number of gates and cells
        total[at] = v
    curve, hits = total[:GATES, :-INPUTS].reshape(GATES, INPUTS, INPUTS), total[GATES:, :2].reshape(256, CELLS, 2)
    none = ~curve.any(axis=(1, 2))
    curve[none] = np.eye(INPUTS)
    weights = np.where(none[:, None], START, np.linalg.solve(curve, total[:GATES, -INPUTS:, None])[..., 0])
    centre = 1 / (1 + np.exp(-np.linspace(-12, 12, CELLS)))
    cells = (hits[..., 1] + CELL_START * centre) / (hits[..., 0] + CELL_START)
    return replace(model, tables=None, weights=weights, cells=cells.ravel()), shared


def packed(groups: int) -> np.dtype:
    """Count, log10 probability and counts by group of a word."""
    return np.dtype([("c", "<i8"), ("p", "<f4"), ("g", "<f4", (groups,))])


def score_words(words: DataFrame, model: ContextModel, tables: Broadcast) -> DataFrame:
    """(word, c, g) to (word, log10p, v): the log10 probability of each word under
    the model, and all of it in ``packed`` bytes."""
    spark = words.sparkSession

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = replace(model, tables=tables.value)
        for rows, w, counts in _runs(frugal(batches), full.skip):
            found = full.log10(w, counts)
            rows = rows.combine_chunks()
            g = rows.column("g").chunk(0).flatten().to_numpy().reshape(len(found), -1)
            v = np.zeros(len(found), packed(g.shape[1]))
            v["c"], v["p"], v["g"] = rows.column("c").to_numpy(), found, g
            yield pa.RecordBatch.from_arrays([rows.column("word").chunk(0), pa.array(np.where(v["c"] > 0, found, np.nan), from_pandas=True), pa.FixedSizeBinaryArray.from_buffers(pa.binary(v.itemsize), len(v), [None, pa.py_buffer(v)]).cast(pa.binary())], names=["word", "log10p", "v"])

    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), words.count() // (1 << 17) + 1)
    dealt = words.select("word", "c", "g").repartition(parts, _key(model.skip)).sortWithinPartitions("word")
    return dealt.mapInArrow(run, "word binary, log10p double, v binary")


def expert_scores(c: np.ndarray, by_group: np.ndarray, log10p: np.ndarray, sums: np.ndarray, distinct: np.ndarray, known: float) -> np.ndarray:
    """log10 probability of words under the corpus and each group with words.

    A group shares out the mass ``known`` that the corpus gives to known words:
    by its own counts and, as far as its distinct words are many for its size,
    by the corpus.  Words that no group knows keep their probability.
    """
    out = [log10p]
    p = 10.0**log10p
    for k in np.flatnonzero(sums):
        own = (by_group[:, k] * known + distinct[k] * p) / (sums[k] + distinct[k])
        out.append(np.where(c > 0, np.log10(np.maximum(own, 1e-300)), log10p))
    return np.stack(out)


def document_scores(codes: np.ndarray, ends: np.ndarray, experts: np.ndarray) -> np.ndarray:
    """log10 probability of each document: words by number, end to end.

    The experts (rows of log10 probabilities by word) share each document evenly
    at its start, then by what they have given its words so far.  A word that
    came r times among the t before it has probability (r + s * p) / (t + s) at
    strength s; the strengths share the document evenly at its start.
    """
    sizes = np.diff(ends)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    t = np.arange(len(codes)) - ends[doc]
    if len(experts) > 1:
        each = experts[:, codes]
        before = np.cumsum(each, axis=1) - each
        before -= before[:, ends[:-1]][:, doc]
        before -= before.max(axis=0)
        weight = 10.0**before
        top = each.max(axis=0)
        own = top + np.log10((weight * 10.0 ** (each - top)).sum(axis=0) / weight.sum(axis=0))
    else:
        own = experts[0, codes]
    order = np.lexsort((codes, doc))  # stable: occurrences stay in their order
    d, c = doc[order], codes[order]
    first = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (c[1:] != c[:-1]))) if len(order) else order
    r = np.empty(len(codes), np.int64)
    r[order] = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    again = np.flatnonzero(r)
    p = 10.0 ** own[again]
    sums = []
    for s in STRENGTHS:
        each = own.copy()
        if np.isfinite(s):
            each += np.log10(s / (t + s))
            each[again] = np.log10((r[again] + s * p) / (t[again] + s))
        sums.append(np.add.reduceat(each, ends[:-1]))
    sums = np.array(sums)
    top = sums.max(axis=0)
    return top + np.log10((10.0 ** (sums - top)).mean(axis=0))


def score_documents(docs: DataFrame, learn: Column, held_out: Column, group: Column | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score,
    bits_per_byte of each whole text (doc_id, text), learning from the rows
    where ``learn`` is true; ``group`` names their groups, and is no input of a
    score.

    Only A-Z are lower-cased; null texts count as empty: one token, the end.
    ``base_score`` is the smoothed unigram score.  ``learn`` and ``held_out``
    may be null (a null doc_id): not learned from, and null in the result.  Null
    groups, and all but the ``GROUPS`` largest, count as one.  Every row has a
    row in the result, repeated ones too; empty tables give none.  Other columns
    are not read.  A batch holds ``BATCH_BYTES`` of texts, or one longer text.
    """
    spark = tuned(docs.sparkSession)
    named: list[str] = []
    if group is not None:
        sizes = docs.where(learn).groupBy(group.cast("string").alias("name")).count().where("name is not null")
        named = [r[0] for r in sizes.orderBy(F.desc("count"), "name").limit(GROUPS).collect()]
    groups, number = len(named) + 1, F.lit(len(named))
    for k, name in enumerate(named):
        number = F.when(group.cast("string") == name, F.lit(k)).otherwise(number)
    tokens = written(token_batches(docs, learn, held_out, number, groups), "lm-tokens", "zstd")
    listed = tokens.where("word is not null").select("batch", "word", "at", "learned")
    each = F.array(*(F.sum(F.col("learned")[k]) for k in range(groups)))
    words = listed.groupBy("word").agg(each.alias("g")).withColumn("c", F.aggregate("g", F.lit(0).cast("long"), lambda x, y: x + y))
    words = written(words, "lm-words")
    got = words.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0), F.array(*(F.coalesce(F.sum(F.col("g")[k]), F.lit(0)) for k in range(groups))), F.array(*(F.count_if(F.col("g")[k] > 0) for k in range(groups)))).first()
    total, distinct, sums, kinds = got[0], got[1], np.array(got[2]), np.array(got[3])
    sums = sums if groups > 1 else np.zeros(1)
    scored = written(score_words(words, *train(words)), "lm-scores", "zstd")
    # log10p is null where a word is not known
    known = scored.agg(F.coalesce(F.sum(F.pow(F.lit(10.0), "log10p")), F.lit(0.0))).first()[0]
    answers = listed.select(F.col("batch").alias("of"), "word", "at").join(scored.select("word", "v"), "word").select("of", "at", "v")
    rows = tokens.where("codes is not null").select("batch", "doc_ids", "held_out", "ends", "bytes", "codes")
    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"]

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        at = answers.column("at").to_numpy()
        v = np.empty(len(at), packed(groups))
        v[at] = np.frombuffer(b"".join(answers.column("v").to_pylist()), v.dtype)
        c, log10p = v["c"], v["p"].astype(np.float64)
        row = {k: docs.column(k).combine_chunks() for k in docs.column_names}
        row = {k: x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for k, x in row.items()}
        ends = np.append(0, row["ends"].values.to_numpy())
        codes = np.frombuffer(pa.Codec("zstd").decompress(row["codes"][0].as_py(), int(ends[-1]) * 4, asbytes=True), "<u4")
        base, known_word = np.log10((c + 0.1) / (total + 0.1 * (distinct + 1))), (c > 0).astype(np.int64)
        experts = expert_scores(c, v["g"].astype(np.float64), log10p, sums, kinds, known)
        found = []
        # a part at a time: experts have a number a token each
        at = 0
        while at < len(ends) - 1:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + PART, side="right")) - 1)
            some, cut = codes[ends[at] : ends[to]].astype(np.int64), ends[at : to + 1] - ends[at]
            found.append(np.stack([document_scores(some, cut, experts), np.add.reduceat(base[some], cut[:-1]), np.add.reduceat(known_word[some], cut[:-1])]))
            at = to
        score, based, seen = np.concatenate(found, axis=1)
        size = row["bytes"].values.to_numpy()
        return pa.table([row["doc_ids"].values, row["held_out"].values, pa.array(np.diff(ends).astype(np.int64)), pa.array(seen.astype(np.int64)), pa.array(np.full(len(size), total)), pa.array(based), pa.array(score), pa.array(-score * np.log2(10) / size)], names=names)

    out = rows.groupBy("batch").cogroup(answers.groupBy("of")).applyInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double")
    return out.select(*names)
