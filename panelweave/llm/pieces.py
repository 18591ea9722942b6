"""SentencePiece encoding and decoding by a batched Viterbi search.

The piece table (ids, scores, byte pieces) comes from a model file; a text is
cut into the piece sequence with the highest sum of scores.  Pieces never cross
a blank, so distinct words (a blank and what follows) are solved once.  Words
of equal length advance together, a position at a time: hashes of all their
substrings that end there probe the sorted hashes of the pieces, and a running
maximum keeps score and backpointer.  Characters that no piece covers become
byte pieces.  Of equal sums the longer last piece wins, as in the library.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frugal, merged, powers, ragged_take, tuned

BLANK = "▁"
#: Words of a generation of the cache; a worker holds two generations.
CACHE_WORDS = 50_000
#: Words of one length that are solved together, bounds the matrices.
TOGETHER = 20_000
UNKNOWN_PENALTY = 10.0
BASE = np.uint64(0x9E3779B97F4A7C15)


class PieceTable:
    def __init__(self, model_file: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = model.vocab_size()
        self.pieces = [model.id_to_piece(k) for k in range(n)]
        self.bytes = np.zeros(256, np.int64)
        normal, raw = [], []
        for k, p in enumerate(self.pieces):
            if model.is_byte(k):
                self.bytes[int(p[1:-1], 16)] = k
                raw.append(bytes([int(p[1:-1], 16)]))
            elif model.is_control(k) or model.is_unknown(k) or model.is_unused(k):
                raw.append(b"")
            else:
                normal.append(k)
                raw.append(p.encode())
        #: what an id decodes to
        self.raw = pa.array(raw, pa.large_binary())
        score = np.array([model.get_score(k) for k in normal])
        self.unknown = float(score.min() if len(score) else 0.0) - UNKNOWN_PENALTY
        self.longest = max((len(self.pieces[k]) for k in normal), default=1)
        hashes = np.array([self._hash(self.pieces[k]) for k in normal], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.scores, self.ids = hashes[order], score[order], np.array(normal, np.int64)[order]
        if (self.hashes[1:] == self.hashes[:-1]).any():
            raise ValueError("two pieces share a hash")
        #: low bits of the hashes that exist: most substrings end here
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.hashes & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @staticmethod
    def _hash(text: str) -> int:
        h = 0
        for c in text:
            h = (h * int(BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def _solve(self, words: list[str]) -> tuple[bytes, np.ndarray]:
        """Ids of words that all have the same length, end to end, and the
        number of ids of each word."""
        n, size = len(words), len(words[0])
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(n, size).astype(np.uint64)
        prefix = np.zeros((size + 1, n), np.uint64)
        power = powers(int(BASE), self.longest)
        best = np.full((size + 1, n), -np.inf)
        best[0] = 0
        back, used = np.zeros((size + 1, n), np.int32), np.full((size + 1, n), -1, np.int32)
        low = np.uint64(len(self.maybe) - 1)
        for t in range(1, size + 1):
            prefix[t] = prefix[t - 1] * BASE + points[:, t - 1] + np.uint64(1)
            for span in range(min(t, self.longest), 0, -1):
                code = prefix[t] - prefix[t - span] * power[span]
                rows = np.flatnonzero(self.maybe[(code & low).astype(np.int64)])
                at = np.minimum(np.searchsorted(self.hashes, code[rows]), len(self.hashes) - 1)
                found = self.hashes[at] == code[rows]
                rows, at = rows[found], at[found]
                covered = rows
                value = self.scores[at] + best[t - span][rows]
                better = value > best[t][rows]
                rows = rows[better]
                best[t][rows], back[t][rows], used[t][rows] = value[better], span, self.ids[at[better]]
                if span == 1:  # a character that no piece covers
                    alone = np.ones(n, bool)
                    alone[covered] = False
                    value = self.unknown + best[t - 1]
                    rows = np.flatnonzero(alone & (value > best[t]))
                    best[t][rows], back[t][rows], used[t][rows] = value[rows], 1, -1
        # backpointers of all words together, last piece first
        place, rows, steps = np.full(n, size), np.arange(n), []
        while len(rows):
            at = place[rows]
            steps.append((rows, used[at, rows], at))
            place[rows] = at - back[at, rows]
            rows = rows[place[rows] > 0]
        row, ids, at = (np.concatenate(x)[::-1] for x in zip(*steps))
        order = np.argsort(row, kind="stable")
        row, ids, at = row[order], ids[order], at[order]
        lost = np.flatnonzero(ids < 0)
        if len(lost):
            spelled = {c: self.bytes[np.frombuffer(chr(c).encode("utf-8", "replace"), np.uint8)] for c in np.unique(points[row[lost], at[lost] - 1]).tolist()}
            each = [spelled[c] for c in points[row[lost], at[lost] - 1].tolist()]
            long = np.ones(len(ids), np.int64)
            long[lost] = [len(x) for x in each]
            ids, row = np.repeat(ids, long), np.repeat(row, long)
            ids[ids < 0] = np.concatenate(each)
        return ids.astype("<i4").tobytes(), np.bincount(row, minlength=n)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, and the number of ids of each text."""
        words: list[str] = []
        count = np.zeros(len(texts), np.int64)
        for k, t in enumerate(texts):
            if t:
                parts = t.replace(BLANK, " ").split(" ")
                if "" in parts:  # blanks in a row belong to the word after them
                    held, joined = "", []
                    for p in parts:
                        held += BLANK
                        if p:
                            joined.append(held + p)
                            held = ""
                    parts = [*joined, held] if held else joined
                else:
                    parts = [BLANK + p for p in parts]
                words += parts
                count[k] = len(parts)
        if not words:
            return np.zeros(0, np.int32), count
        coded = pa.array(words, pa.large_string()).dictionary_encode()
        distinct, codes = coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)
        if len(self.known) > CACHE_WORDS:
            self.older, self.known = self.known, {}
        by_size: dict[int, list[str]] = {}
        for w in distinct:
            if w not in self.known:
                if w in self.older:
                    self.known[w] = self.older[w]
                else:
                    by_size.setdefault(len(w), []).append(w)
        for size, some in by_size.items():
            step = max(1, min(TOGETHER, 2_000_000 // size))
            for at in range(0, len(some), step):
                raw, sizes = self._solve(some[at : at + step])
                ends = (4 * np.cumsum(sizes)).tolist()
                for w, i, j in zip(some[at : at + step], [0, *ends], ends):
                    self.known[w] = raw[i:j]
        each = [self.known[w] for w in distinct]
        store = np.frombuffer(b"".join(each), "<i4")
        lengths = np.fromiter(map(len, each), np.int64, len(each)) // 4
        ids = store[ragged_take(lengths, np.cumsum(lengths) - lengths, codes)]
        before = np.concatenate([[0], np.cumsum(lengths[codes])])
        ends = np.cumsum(count)
        return ids, before[ends] - before[ends - count]

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of ids laid end to end."""
        ends = np.concatenate([[0], np.cumsum(counts)])
        raw = self.raw.take(pa.array(ids.astype(np.int64)))
        joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends), raw), pa.scalar(b"", pa.large_binary()))
        # the first blank is the one that encoding put there
        return [b.decode("utf-8", "replace").replace(BLANK, " ")[1:] for b in joined.to_pylist()]


@lru_cache(maxsize=2)
def _table(model_file: str) -> PieceTable:
    """One a worker process: what a task has learned helps the next one."""
    return PieceTable(model_file)


ENCODED = "doc_id long, piece_ids array<int>, n_pieces long, ids_crc32 long, round_trip boolean"


def encode_documents(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, piece_ids, n_pieces, ids_crc32 (of the ids as little-endian
    unsigned 32-bit integers), round_trip (decoding gave the text back).

    Null and empty texts have no pieces.  A text that holds U+2581 itself, which
    the format uses for the blank, decodes with blanks there (round_trip false).
    Only doc_id and text are read; rows keep their number.
    """
    tuned(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(model_file)
        for b in frugal(merged(batches, 1)):
            texts = [t or "" for t in b.column(1).to_pylist()]
            ids, counts = table.encode(texts)
            ends = np.concatenate([[0], np.cumsum(counts)])
            same = [a == b for a, b in zip(texts, table.decode(ids, counts))]
            raw = memoryview(np.ascontiguousarray(ids, "<u4").view(np.uint8))
            crc = [zlib.crc32(raw[4 * i : 4 * j]) for i, j in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32))), pa.array(counts), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())],
                names=["doc_id", "piece_ids", "n_pieces", "ids_crc32", "round_trip"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ENCODED)
