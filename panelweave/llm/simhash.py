"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints that differ in at most two of 64 bits agree in two of four 16-bit
blocks.  So each distinct fingerprint goes to the six groups named by its pairs
of blocks, with the pair moved to the front; sorted by Gray rank, a group is
contiguous and neighbours share most bits.  Within a group ``GrayIndex`` puts
``FAN`` neighbours under a node that holds the bits they all share (a masked
pattern), ``FAN`` of those under a further node, and so on.  A search compares
each node's own bits once, adds up the differences on the way down and drops a
whole subtree when they pass the limit.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import frugal, slices, tuned, written
from .components import components

FAN = 8
#: Searches that descend together: bounds the memory of a very large group.
BLOCK = 4096
#: Words of a group that one task takes without dealing them again.
SPLIT = 200_000
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: str | None, words: int = 3, seed: int = 42) -> np.ndarray:
    """XXH64 of each run of ``words`` words, repeats included."""
    each = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not each:
        return np.zeros(0, np.uint64)
    flat = b" ".join(each)
    if len(each) <= words:
        return np.array([xxhash.xxh64_intdigest(flat, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, each), np.int64, len(each)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    return np.array([digest(flat[i:j], seed) for i, j in zip(starts[: len(each) - words + 1].tolist(), ends[words - 1 :].tolist())], np.uint64)


_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_LANES = (np.arange(8) * 256).astype(np.int64)


def fingerprint(hashes: np.ndarray) -> int:
    """Bit k is set if it is set in over half the hashes; none: 0."""
    if not len(hashes):
        return 0
    bytes_ = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    if len(hashes) < 64:
        counts = np.unpackbits(bytes_, axis=1, bitorder="little").sum(axis=0)
    else:  # a histogram of each byte's values, then of their bits
        counts = (np.bincount((bytes_ + _LANES).ravel(), minlength=2048).reshape(8, 256) @ _BITS).ravel()
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3, seed: int = 42) -> DataFrame:
    """doc_id and fingerprint (a long with the 64 bits) of each whole text."""
    tuned(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in frugal(slices(batches, 1)):
            fp = np.fromiter((fingerprint(shingle_hashes(t.as_py(), words, seed)) for t in b.column(1)), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64))], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, fp long")


def gray_rank(code: Column) -> Column:
    """Place of a 64-bit word in Gray order, as a long that sorts like it."""
    for k in (1, 2, 4, 8, 16, 32):
        code = code.bitwiseXOR(F.shiftrightunsigned(code, k))
    return code.bitwiseXOR(F.lit(-(2**63)))


def _front(fp: Column, pair: tuple[int, int]) -> Column:
    """The word with two of its four 16-bit blocks moved to the front."""
    order = [*pair, *(k for k in range(4) if k not in pair)]
    block = [F.shiftrightunsigned(fp, 16 * k).bitwiseAND(F.lit(0xFFFF)) for k in order]
    out = F.shiftleft(block[0], 48)
    for k, b in enumerate(block[1:], 1):
        out = out.bitwiseOR(F.shiftleft(b, 48 - 16 * k))
    return out


def gray_order(codes: np.ndarray) -> np.ndarray:
    """Places of codes (rows of 64-bit words, the first one leads) in Gray order."""
    ranks, odd = [], np.zeros(len(codes), bool)
    for k in range(codes.shape[1]):
        rank = codes[:, k].copy()
        for shift in (1, 2, 4, 8, 16, 32):
            rank ^= rank >> np.uint64(shift)
        ranks.append(np.where(odd, ~rank, rank))
        odd = (ranks[-1] & np.uint64(1)).astype(bool)
    return np.lexsort(ranks[::-1])


class GrayIndex:
    """Groups of codes, each in Gray order, as a forest of masked patterns."""

    def __init__(self, codes: np.ndarray, groups: np.ndarray):
        """codes: unsigned words, or rows of several; groups: each code's group, 0, 1, ... in order."""
        self.codes, self.groups = codes.reshape(len(codes), -1), groups
        full = np.full(self.codes.shape, ONES)
        #: each level: pattern, mask of shared bits, first child, end of children
        self.levels = [(self.codes, full, None, None)]
        owner = groups
        while len(owner) and len(owner) > owner[-1] + 1:
            place = np.arange(len(owner)) - np.searchsorted(owner, owner)
            starts = np.flatnonzero(place % FAN == 0)
            ends = np.append(starts[1:], len(owner))
            pattern, mask = self.levels[-1][:2]
            both = np.bitwise_and.reduceat(pattern, starts)
            shared = np.bitwise_and.reduceat(mask, starts) & ~(np.bitwise_or.reduceat(pattern, starts) ^ both)
            self.levels.append((both & shared, shared, starts, ends))
            owner = owner[starts]

    def search(self, limit: int, queries: np.ndarray | None = None, block: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places (i, j) of codes of one group that differ in at most ``limit``
        bits: each pair once, i < j; or i from ``queries`` and any other j.
        ``block`` places descend together."""
        every = np.arange(len(self.codes)) if queries is None else queries
        for at in range(0, len(every), block):
            who = every[at : at + block]
            node = self.groups[who]  # a root for each group
            pattern, mask, _, _ = self.levels[-1]
            gone = _bits((self.codes[who] ^ pattern[node]) & mask[node])
            for level in range(len(self.levels) - 1, 0, -1):
                _, above, starts, ends = self.levels[level]
                pattern, mask, _, _ = self.levels[level - 1]
                size = ends[node] - starts[node]
                pick = np.repeat(np.arange(len(node)), size)
                child = np.repeat(starts[node] - (np.cumsum(size) - size), size) + np.arange(len(pick))
                own = mask[child] & ~above[node[pick]]
                diff = gone[pick] + _bits((self.codes[who[pick]] ^ pattern[child]) & own)
                keep = diff <= limit
                who, node, gone = who[pick[keep]], child[keep], diff[keep]
            keep = (node > who if queries is None else node != who) & (gone <= limit)
            yield who[keep], node[keep]


def _bits(words: np.ndarray) -> np.ndarray:
    """Bits set in each row of words."""
    return np.bitwise_count(words).sum(axis=1, dtype=np.int64)


class _Forest:
    """Union-find over what one task has seen of a group."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        up = self.up
        while (p := up.get(x, x)) != x:
            up[x] = x = up.get(p, p)
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)
        return x != y


def _links(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Links that connect all near fingerprints of each group; a group may span batches."""

    def flush(parts: list[np.ndarray]) -> pa.RecordBatch | None:
        rows = np.concatenate(parts)
        change = np.concatenate([[0], np.cumsum((rows[1:, :2] != rows[:-1, :2]).any(axis=1))])
        shared = np.bincount(change)[change] > 1
        rows, change = rows[shared], change[shared]
        if not len(rows):
            return None
        index = GrayIndex(rows[:, 3].astype(np.int64).view(np.uint64), np.unique(change, return_inverse=True)[1])
        a, b, seen = [], [], _Forest()
        for i, j in index.search(limit):
            for x, y in zip(rows[i, 2].tolist(), rows[j, 2].tolist()):
                if seen.join(x, y):
                    a.append(x)
                    b.append(y)
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    held: list[np.ndarray] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("pair", "key", "rep", "code")])
        last = rows[-1, :2]
        cut = len(rows) - int(np.argmax((rows[::-1, :2] != last).any(axis=1))) if (rows[:, :2] != last).any() else 0
        if cut:
            out = flush([*held, rows[:cut]])
            held = []
            if out is not None:
                yield out
        held.append(rows[cut:])
    if held and (out := flush(held)) is not None:
        yield out


def near_links(distinct: DataFrame, limit: int = 2, split: int = SPLIT) -> DataFrame:
    """(fp, rep) of distinct fingerprints to links (a, b) between reps.

    Exact for ``limit`` up to 2: every pair within the limit is connected by
    the links returned, though not every such pair is itself a link.  A group
    holds distinct words that share 32 given bits.  One of more than ``split``
    words is dealt again by thirds of the other 32 bits: words at most two bits
    apart agree in one of them.  So a task holds ``split`` words of a group, or
    at most the 2**22 that share 42 bits, whatever the corpus.
    """
    if limit > 2:
        raise ValueError("two of four blocks agree only for limits up to 2")
    codes = F.array(*(F.struct(F.lit(k).alias("pair"), _front(F.col("fp"), p).alias("code")) for k, p in enumerate(combinations(range(4), 2))))
    rows = distinct.select("rep", F.explode(codes).alias("c")).select("rep", "c.pair", "c.code")
    rows = rows.withColumn("key", F.shiftrightunsigned("code", 32))
    full = written(rows.groupBy("pair", "key").agg(F.count("*").alias("n")).where(F.col("n") > split).select("pair", "key"), "full-groups")
    if not full.isEmpty():
        low = F.col("code").bitwiseAND(F.lit(0xFFFFFFFF))
        thirds = F.array(*(F.struct(F.lit(k + 1).alias("third"), F.shiftright(low, at).bitwiseAND(F.lit((1 << size) - 1)).alias("part")) for k, (at, size) in enumerate(((0, 11), (11, 11), (22, 10)))))
        hot = rows.join(full, ["pair", "key"], "left_semi").select("rep", "pair", "code", "key", F.explode(thirds).alias("t"))
        # the third joins the pair's number, its bits the key
        hot = hot.select("rep", (F.col("pair") * 4 + F.col("t.third")).alias("pair"), "code", F.shiftleft("key", 11).bitwiseOR(F.col("t.part")).alias("key"))
        rows = rows.join(full, ["pair", "key"], "left_anti").select("rep", (F.col("pair") * 4).alias("pair"), "code", "key").unionByName(hot)
    # Gray order of the whole code; groups are made contiguous before it counts
    rows = rows.withColumn("rank", gray_rank(F.col("code")))
    dealt = rows.repartition("pair", "key").sortWithinPartitions("pair", "key", "rank").drop("rank")
    return dealt.mapInArrow(lambda batches: _links(batches, limit), "a long, b long")


def near_groups(docs: DataFrame, words: int = 3, limit: int = 2) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of each row of ``docs``.

    Fingerprints link at ``limit`` or fewer differing bits; component_id is the
    smallest doc_id reachable.  Null and blank texts have fingerprint zero and
    link like any other.  Rows with a null doc_id link like others and pass
    links on; their component is null only where no row with a doc_id is
    reachable.  Other columns are ignored; an empty table gives an empty result.
    """
    printed = written(fingerprints(docs, words), "fingerprints")
    # a fingerprint is its own node, so that rows without a doc_id link as well
    counted = written(printed.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "distinct-fingerprints")
    linked = written(components(near_links(counted.select("fp", F.col("fp").alias("rep")), limit)), "components")
    joined = counted.join(linked, counted.fp == linked.node).select("fp", "rep", "component")
    # the smallest doc_id of each component, summed up before it is shuffled
    least = joined.groupBy("component").agg(F.min("rep").alias("least"))
    linked_ids = joined.join(least, "component").select("fp", "least")
    # fingerprints of a single row without a link need no answer
    answers = counted.where("n > 1").join(linked_ids, "fp", "left_anti").select("fp", F.col("rep").alias("least")).unionByName(linked_ids)
    answers = answers.withColumn("known", F.lit(True))
    return printed.join(answers, "fp", "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("known"), F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
    )
