"""SimHash near-duplicates among texts whose word shingles are alike.

Fingerprints of texts with a Jaccard similarity t differ in about
64 arccos(2t / (1 + t)) / pi of 64 bits: ten at 0.8, which no choice of blocks
can name groups for.  So fingerprints have 256 bits here, and groups are named
by rare shingles: sets of similarity t or more share one of the first
n - ceil(t n) + 1 entries of either, in any order that all sets keep to.  Within
a group the Gray-order index finds fingerprints within ``LIMIT`` bits, and an
exact comparison of the shingles decides.

Work stays in proportion to large groups.  Each row is first compared with one
row of its group, which joins most copies of one text in a class.  Only rows
outside the largest class of a group are then compared with the others, dealt
by pairs of blocks, so no task holds more than two blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import frugal, mix64, part, remove, slices, text_key, tuned, word_table, written
from .components import components
from .simhash import GrayIndex, _Forest, fingerprint, gray_order

#: Entries of the table of counts; hashes share them, which only blurs the order.
COUNTS, SLICES = 1 << 20, 64
#: 64-bit words of a fingerprint.  Its bits differ with a chance of at most 0.19
#: (four shingles against five) where the similarity is 0.8; 84 of 256 are 5.7
#: standard deviations above the mean, so one such pair in 10**8 is missed.
PRINTS, LIMIT = 4, 84
#: Rows of a block of fingerprints, shingles of a block of texts.
WIDE, SHINGLES = 2000, 200_000
#: Rows of small groups that are searched together, and meetings of a step.
TOGETHER, MEET = 4000, 1 << 18
BASE = 0x9E3779B97F4A7C15


def shingle_sets(texts: pa.Array, words: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, end to end, and 0 and
    their ends.  Texts are lower-cased (A-Z); one with fewer words is a single
    shingle; null and blank texts hold the empty shingle, zero."""
    each, codes, offsets = word_table(texts, lower=True)
    flat = np.fromiter((xxhash.xxh64_intdigest(w, 42) for w in each.cast(pa.large_binary()).to_pylist()), np.uint64, len(each))[codes]
    size = np.diff(offsets)
    rows, hashes = [np.flatnonzero(size == 0)], [np.zeros(int((size == 0).sum()), np.uint64)]
    code = np.zeros(len(flat), np.uint64)
    for length in range(1, words + 1):
        code = code[: max(0, len(flat) - length + 1)] * np.uint64(BASE) + flat[length - 1 :]
        mine = np.flatnonzero(size >= words if length == words else size == length)
        n = size[mine] - length + 1
        at = np.repeat(offsets[mine] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        rows.append(np.repeat(mine, n))
        hashes.append(mix64(code[at] + np.uint64(length)))
    row, h = np.concatenate(rows), np.concatenate(hashes)
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (h[1:] != h[:-1])]) if len(row) else np.zeros(0, bool)
    return h[new], np.concatenate([[0], np.cumsum(np.bincount(row[new], minlength=len(texts)))])


def least_common(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Fewest entries that sets of n and m share at ``percent`` similarity or more."""
    return -(-percent * (n + m) // (100 + percent))


def shingle_counts(docs: DataFrame, words: int) -> np.ndarray:
    """Number of texts that hold a shingle of each entry, summed over tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTS, np.int64)
        for b in frugal(slices(batches, 0)):
            total += np.bincount((shingle_sets(b.column(0), words)[0] % np.uint64(COUNTS)).astype(np.int64), minlength=COUNTS)
        if total.any():
            parts = [p.astype(np.uint32).tobytes() for p in np.split(total, SLICES)]
            yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array(parts, pa.binary())], names=["slice", "n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for k, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                sums[k] = sums.get(k, 0) + np.frombuffer(n, np.uint32).astype(np.int64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["slice", "n"])

    kind = "slice int, n binary"
    out = np.zeros(COUNTS, np.int64)
    for k, n in docs.select("text").mapInArrow(run, kind).repartition("slice").mapInArrow(add, kind).collect():
        out[k * (COUNTS // SLICES) : (k + 1) * (COUNTS // SLICES)] = np.frombuffer(n, np.int64)
    return out


def prints(s: np.ndarray) -> list[int]:
    """The words of a set's fingerprint, as signed numbers."""
    return [int(np.uint64(fingerprint(mix64(s ^ np.uint64(k * BASE & 0xFFFFFFFFFFFFFFFF)))).view(np.int64)) for k in range(PRINTS)]


PRINT = [f"f{k}" for k in range(PRINTS)]
SETS = "doc_id long, h long, n int, s1 long, s2 long, " + ", ".join(f"{c} long" for c in PRINT) + ", tokens array<long>"


def _sets(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """A row a text: key, size, two sums that name the set, fingerprint, and
    the rarest shingles, of which similar texts share one."""
    counts = docs.sparkSession.sparkContext.broadcast(np.minimum(shingle_counts(docs, words), 0xFFFFFFFF).astype(np.uint32))  # 4 MB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in frugal(slices(batches, 2)):
            s, ends = shingle_sets(b.column(2), words)
            size = np.diff(ends)
            row = np.repeat(np.arange(len(size)), size)
            order = np.lexsort((s, counts.value[(s % np.uint64(COUNTS)).astype(np.int64)], row))
            few = size - -(-percent * size // 100) + 1
            first = s[order][np.arange(len(s)) - ends[:-1][row] < few[row]].view(np.int64)
            sums = [pa.array(np.add.reduceat(x, ends[:-1]).view(np.int64)) for x in (s, mix64(s ^ np.uint64(BASE)))]
            bits = zip(*(prints(s[i:j]) for i, j in zip(ends[:-1], ends[1:])))
            tokens = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(few)]).astype(np.int32)), pa.array(first))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(size.astype(np.int32)), *sums, *(pa.array(x, pa.int64()) for x in bits), tokens], names=["doc_id", "h", "n", "s1", "s2", *PRINT, "tokens"])

    return docs.select("doc_id", "h", "text").mapInArrow(run, SETS).withColumn("id", F.monotonically_increasing_id())


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose token comes more than once; rows are sorted by token."""
    held: tuple[int, int] | None = None  # the last row, if it is not out yet
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        tokens, ids = (b.column(k).to_numpy() for k in (0, 1))
        same = tokens[1:] == tokens[:-1]
        out = np.concatenate([[last is not None and tokens[0] == last], same]) | np.concatenate([same, [False]])
        first = held if held is not None and tokens[0] == held[0] else None
        held = None if out[-1] else (int(tokens[-1]), int(ids[-1]))
        last = tokens[-1]
        tokens, ids = tokens[out], ids[out]
        if first:
            tokens, ids = np.append(tokens, first[0]), np.append(ids, first[1])
        yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(ids)], names=["token", "id"])


def _apart(a: str, b: str) -> Column:
    """Bits that the fingerprints of two rows differ in."""
    return sum((F.bit_count(F.col(f"{a}{c}").bitwiseXOR(F.col(f"{b}{c}"))) for c in PRINT[1:]), F.bit_count(F.col(f"{a}{PRINT[0]}").bitwiseXOR(F.col(f"{b}{PRINT[0]}"))))


def dealt(rows: DataFrame, key: str, size: int) -> DataFrame:
    """key, lo, hi and the rows (key, id, cls, w, ...) once for each pair of
    blocks in which they are compared.

    The largest class of a key, by the sum of w, is its main one; its rows
    (``main``) meet the blocks of the others only, which meet all blocks.
    Blocks hold about ``size`` of w.  Keys with a single class vanish.
    """
    per = rows.groupBy(key, "cls").agg(F.sum("w").cast("long").alias("w"))
    sizes = per.groupBy(key).agg(F.max_by("cls", "w").alias("top"), F.max("w").alias("most"), F.sum("w").alias("all")).where(F.col("all") > F.col("most"))
    one = F.col("all") <= size
    sizes = sizes.select(key, "top", F.when(one, 1).otherwise(F.ceil((F.col("all") - F.col("most")) / size)).cast("int").alias("others"), F.when(one, 0).otherwise(F.ceil(F.col("most") / size)).cast("int").alias("mains"))
    rows = rows.join(sizes, key).withColumn("main", F.col("cls") == F.col("top"))
    mix = F.xxhash64("id")
    rows = rows.withColumn("block", F.when(F.col("main") & (F.col("mains") > 0), F.col("others") + F.pmod(mix, F.greatest("mains", F.lit(1)))).otherwise(F.pmod(mix, F.col("others"))).cast("int"))
    last = F.when(F.col("block") >= F.col("others"), F.col("others")).otherwise(F.col("others") + F.col("mains"))
    rows = rows.withColumn("o", F.explode(F.sequence(F.lit(0), last - 1)))
    return rows.withColumn("lo", F.least("block", "o")).withColumn("hi", F.greatest("block", "o")).drop("top", "others", "mains", "o", "block")


def _grouped(batches: Iterator[pa.RecordBatch], keys: int, rows: int = 0) -> Iterator[pa.RecordBatch]:
    """The rows of each value of the first ``keys`` columns, by which rows are
    sorted; or of as many values as make up ``rows``."""
    held: list[pa.RecordBatch] = []
    name, size = None, 0
    for b in batches:
        if not b.num_rows:
            continue
        k = np.column_stack([b.column(c).to_numpy().astype(np.int64) for c in range(keys)])
        starts = [0] if name is None or (k[0] != name).any() else []
        starts += (1 + np.flatnonzero((k[1:] != k[:-1]).any(axis=1))).tolist()
        at = 0
        for start in starts:
            if size + start - at < max(rows, 1):
                continue
            if start > at:
                held.append(part(b, at, start))
            if held:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size, at = [], 0, start
        held.append(part(b, at, b.num_rows))
        size += b.num_rows - at
        name = k[-1]
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _near(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Links between classes that may hold similar texts, from the groups
    (token, lo, hi) of (cls, main, n, fingerprint), by which rows are sorted.
    Groups are searched many at a time, each with an index of its own."""
    for g in _grouped(batches, 3, TOGETHER):
        key = np.column_stack([g.column(c).to_numpy().astype(np.int64) for c in range(3)])
        group = np.concatenate([[0], np.cumsum((key[1:] != key[:-1]).any(axis=1))])
        cls, main, n = (g.column(c).to_numpy(zero_copy_only=False) for c in (3, 4, 5))
        codes = np.column_stack([g.column(6 + k).to_numpy().view(np.uint64) for k in range(PRINTS)])
        order = gray_order(codes)
        order = order[np.argsort(group[order], kind="stable")]
        cls, main, n, codes, group = cls[order], main[order], n[order].astype(np.int64), codes[order], group[order]
        index, seen, a, b = GrayIndex(codes, group), _Forest(), [], []
        # rows that descend together meet ``MEET`` others at most
        asked = np.flatnonzero(~main)
        load = np.cumsum(np.bincount(group)[group[asked]])
        at = 0
        while at < len(asked):
            to = max(at + 1, int(np.searchsorted(load, (load[at - 1] if at else 0) + MEET, side="right")))
            for i, j in index.search(LIMIT, asked[at:to], to - at):
                good = (cls[i] != cls[j]) & (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j]))
                for x, y in np.unique(np.column_stack([cls[i[good]], cls[j[good]]]), axis=0).tolist():
                    if seen.join(x, y):
                        a.append(x)
                        b.append(y)
            at = to
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _verified(batches: Iterator[pa.RecordBatch], words: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Links between similar texts of each (key, lo, hi) of (id, cls, main,
    text): every row that is not a main one against all others, unless the
    classes and links so far connect the two."""
    for g in _grouped(batches, 3):
        ids, cls, main = (g.column(c).to_numpy(zero_copy_only=False) for c in (3, 4, 5))
        s, ends = shingle_sets(g.column(6), words)
        size = np.diff(ends)
        names, code = np.unique(s, return_inverse=True)
        mark, group, a, b = np.zeros(len(names), np.int32), np.unique(cls, return_inverse=True)[1], [], []
        for x in np.flatnonzero(~main).tolist():
            mark[code[ends[x] : ends[x + 1]]] = 1
            common = np.add.reduceat(mark[code], ends[:-1])
            mark[code[ends[x] : ends[x + 1]]] = 0
            hit = np.flatnonzero((common >= least_common(size, size[x], percent)) & (group != group[x]))
            # a link for each class that joins this one
            for y in hit[np.unique(group[hit], return_index=True)[1]].tolist():
                a.append(int(ids[x]))
                b.append(int(ids[y]))
                group[group == group[y]] = group[x]
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def _compared(groups: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links of the groups (key, lo, hi, id, cls, main), whose texts are joined."""
    rows = groups.hint("merge").join(texts.hint("merge"), "id").select("key", "lo", "hi", "id", "cls", "main", "text")
    rows = rows.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "id")
    return written(rows.mapInArrow(lambda x: _verified(x, words, percent), "a long, b long"), "verified")


def similar_groups(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, h, id, component of the rows of ``docs`` (doc_id, text) whose text
    is similar to another row's.

    component is the smallest id reachable over pairs whose sets of lower-cased
    ``words``-word shingles have a Jaccard similarity of ``percent`` or more;
    ids are numbers of this call, and (doc_id, h), with h = ``text_key()``, says
    which row is meant.  Shorter texts are one shingle; null and blank texts are
    equal; a null doc_id is a key like any other; repeated rows are similar.
    An empty table gives an empty result.  Other columns are ignored.
    """
    spark = tuned(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("h"), "text")
    sets = written(_sets(docs, words, percent), "shingle-sets")
    # texts with one and the same set: one of them, the head, goes on
    named = ["n", "s1", "s2"]
    several = sets.groupBy(*named).agg(F.min("id").alias("rep"), F.count("*").alias("k")).where("k > 1")
    twins = written(sets.select("id", *named).join(several, named).where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b")), "same-sets")
    heads = sets.join(twins.select(F.col("a").alias("id")), "id", "left_anti")
    tokens = heads.select(F.explode("tokens").alias("token"), "id").repartition("token").sortWithinPartitions("token")
    shared = written(tokens.mapInArrow(_shared, "token long, id long"), "shared")
    # only rows that share a token have a partner
    some = written(sets.drop("tokens").hint("merge").join(shared.select("id").distinct().hint("merge"), "id", "left_semi"), "candidates")
    texts = written(docs.hint("merge").join(some.select("doc_id", "h", "id", "n").hint("merge"), (docs.doc_id.eqNullSafe(some.doc_id)) & (docs.h == some.h)).select("id", "text").groupBy("id").agg(F.first("text").alias("text")), "candidate-texts")
    entries = written(shared.hint("merge").join(some.select("id", "n", *PRINT).hint("merge"), "id"), "entries")
    # a star for each token: its first row against the others
    centre = entries.groupBy("token").agg(F.min(F.struct("id", "n", *PRINT)).alias("c")).select("token", *(F.col(f"c.{c}").alias(f"c_{c}") for c in ("id", "n", *PRINT)))
    alike = (_apart("", "c_") <= LIMIT) & (100 * F.least("n", "c_n") >= percent * F.greatest("n", "c_n"))
    rays = written(entries.join(centre, "token").where(alike & (F.col("id") != F.col("c_id"))).select(F.col("c_id").alias("key"), "id", "n").distinct(), "stars")
    load = rays.groupBy("key").agg(F.ceil(F.sum("n") / SHINGLES).cast("int").alias("parts"))
    rays = rays.join(load, "key").select("key", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("lo"), F.lit(0).alias("hi"), "id", F.col("id").alias("cls"), F.lit(True).alias("main"))
    hubs = load.select("key", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("lo"), F.lit(0).alias("hi"), F.col("key").alias("id"), F.col("key").alias("cls"), F.lit(False).alias("main"))
    stars = _compared(rays.unionByName(hubs), texts, words, percent)
    classes = written(components(stars), "classes")
    named = entries.join(classes.withColumnRenamed("node", "id"), "id", "left").withColumn("cls", F.coalesce("component", "id"))
    # rows outside the largest class of their token, by the index
    rows = dealt(named.select("token", "id", "cls", F.lit(1).alias("w"), "n", *PRINT), "token", WIDE)
    rows = rows.select("token", "lo", "hi", "cls", "main", "n", *PRINT).repartition("token", "lo", "hi").sortWithinPartitions("token", "lo", "hi")
    maybe = written(components(written(rows.mapInArrow(lambda x: _near(x, percent), "a long, b long"), "near")), "near-classes")
    # and by their shingles, in the groups that the index connects
    members = some.select("id", "n").join(classes.withColumnRenamed("node", "id"), "id", "left").select("id", F.coalesce("component", "id").alias("node"), F.col("n").alias("w"))
    members = members.join(maybe, "node").select(F.col("component").alias("key"), "id", F.col("node").alias("cls"), "w")
    rest = _compared(dealt(members, "key", SHINGLES), texts, words, percent)
    groups = written(components(twins.union(stars).union(rest)), "similar")
    out = written(sets.select("doc_id", "h", "id").join(groups.withColumnRenamed("node", "id"), "id"), "similar-rows")
    remove(spark, sets, twins, shared, some, texts, entries, stars, classes, maybe, rest, groups)
    return out
