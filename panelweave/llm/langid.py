"""Language identification: the family first, then linear SVMs within it.

Words are scored by linear models over hashed character n-grams (1 to 4, with
word borders).  A text's vector is the mean over all its n-grams, so a model is
one weight an n-gram and a text's margin is a mean of weights.  The family is
chosen by one-versus-rest SVMs; within it every pair of languages has its own
SVM and the language with most wins (then the largest sum of margins) is taken.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .common import drawn, fresh, frugal, mix64, part, slices, sums_by_text, threshold, tuned, word_table

BUCKETS = 1 << 16
#: Labelled rows of each language that the models are fitted on.
TRAIN_ROWS = 800
#: Bytes of labelled texts, of all languages together, that they are fitted on.
TRAIN_BYTES = 96 << 20
#: Labelled texts whose n-grams a task lays out together, and their bytes.
TOGETHER, TOGETHER_BYTES = 32, 1 << 20
#: Bytes of distinct words, and words of a text, that are summed together.
WORD_BYTES, WORDS = 1 << 18, 1 << 16
#: Languages by family; any other language is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "fy", "lb", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr", "sl", "mk", "be", "bs"),
    "turkic": ("tr", "az", "kk", "uz", "ky", "tk", "tt"),
    "indic": ("hi", "bn", "mr", "gu", "pa", "ne", "ur", "or", "as", "si"),
    "semitic": ("ar", "he", "mt", "am"),
    "uralic": ("fi", "et", "hu"),
    "dravidian": ("ta", "te", "kn", "ml"),
}
FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs}
UNKNOWN = "und"


def _grams(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For n from 1 to 4 the buckets of all n-grams and the word of each.

    n-grams are runs of UTF-8 bytes of the lower-cased word between two spaces.
    Words without a letter have none.
    """
    words = words.cast(pa.large_string())
    lettered = pc.match_substring_regex(words, r"\p{L}").to_numpy(zero_copy_only=False)
    framed = pc.binary_join_element_wise(pa.scalar(" ", pa.large_string()), pc.if_else(pa.array(lettered), pc.utf8_lower(words), pa.scalar("", pa.large_string())), pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string()))
    ends = np.frombuffer(framed.buffers()[1], np.int64, len(framed) + 1, 8 * framed.offset)
    data = np.frombuffer(framed.buffers()[2] or b"", np.uint8)[: ends[-1]].astype(np.uint64) + np.uint64(1)
    owner = np.repeat(np.arange(len(framed)), np.diff(ends))
    left = ends[1:][owner] - np.arange(len(owner)) if len(owner) else ends[:0]  # bytes from here to the word's end
    code = np.zeros(len(data), np.uint64)
    for n in range(1, 5):
        code = code[: len(data) - n + 1] * np.uint64(257) + data[n - 1 :]
        fits = (left[: len(code)] >= n) & lettered[owner[: len(code)]]
        yield (mix64(code[fits] + np.uint64(n << 40)) % np.uint64(BUCKETS)).astype(np.int32), owner[: len(code)][fits]


def word_ngrams(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of each word, end to end, and each word's count."""
    grams, owners = (np.concatenate(x) for x in zip(*_grams(words)))
    order = np.argsort(owners, kind="stable")
    return grams[order], np.bincount(owners, minlength=len(words))


def word_sums(words: pa.Array, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of each model's weights over the n-grams of each word, and their
    number; words go by runs of ``WORD_BYTES``, weights a model at a time."""
    sums, counts = np.zeros((len(words), weights.shape[1])), np.zeros(len(words), np.int64)
    ends = np.cumsum(pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(words):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + WORD_BYTES, side="right")))
        for grams, owner in _grams(part(words, at, to)):
            counts[at:to] += np.bincount(owner, minlength=to - at)
            for m in range(weights.shape[1]):
                sums[at:to, m] += np.bincount(owner, weights=weights[grams, m], minlength=to - at)
        at = to
    return sums, counts


@dataclass
class SparseRows:
    """Rows of distinct columns ``at`` with values ``value``, end to end."""

    ends: np.ndarray  # 0, then the end of each row
    at: np.ndarray
    value: np.ndarray

    def __len__(self) -> int:
        return len(self.ends) - 1


def _svm(x: SparseRows, y: np.ndarray, c: float = 10.0, rounds: int = 40) -> np.ndarray:
    """Weights of a linear SVM by dual coordinate descent, and last the bias;
    y is -1 or 1, 0 leaves a row out."""
    rows = np.flatnonzero(y)
    alpha, w, bias = np.zeros(len(x)), np.zeros(BUCKETS, np.float32), 0.0
    at, value = ([v[i:j] for i, j in zip(x.ends[:-1], x.ends[1:])] for v in (x.at, x.value))
    norm = [float(v @ v) + 1 for v in value]
    rng = np.random.default_rng(7)
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(rows):
            step = min(max(alpha[i] - (y[i] * (value[i] @ w[at[i]] + bias) - 1) / norm[i], 0), c) - alpha[i]
            if step:
                alpha[i] += step
                w[at[i]] += np.float32(step * y[i]) * value[i]
                bias += step * y[i]
                moved = max(moved, abs(step))
        if moved < 1e-3 * c:
            break
    return np.append(w.astype(np.float64), bias)


@dataclass
class LanguageModel:
    """Weights of each n-gram: a column for each family, then for each pair."""

    families: list[str]
    members: list[list[str]]
    pairs: list[tuple[int, str, str]]
    weights: np.ndarray
    bias: np.ndarray

    @classmethod
    def fit(cls, x: SparseRows, langs: list[str]) -> LanguageModel:
        """x: mean n-gram vectors by row."""
        names = sorted(set(langs))
        family = [FAMILY_OF.get(n, n) for n in langs]
        families = sorted(set(family))
        members = [[n for n in names if FAMILY_OF.get(n, n) == f] for f in families]
        pairs = [(k, a, b) for k, m in enumerate(members) for a, b in combinations(m, 2)]
        sides = [np.where(np.array(family) == f, 1.0, -1.0) if len(families) > 1 else np.zeros(len(x)) for f in families]
        sides += [np.array([1.0 if n == a else -1.0 if n == b else 0.0 for n in langs]) for _, a, b in pairs]
        w = np.column_stack([_svm(x, y) for y in sides])
        return cls(families, members, pairs, w[:-1], w[-1])

    def choose(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and score in 0..1 from the margins of each text."""
        nf = len(self.families)
        best = np.argmax(margins[:, :nf], axis=1)
        chance = np.ones(len(margins))
        if nf > 1:
            rest = np.where(np.arange(nf) == best[:, None], -np.inf, margins[:, :nf]).max(axis=1)
            chance = 1 / (1 + np.exp(-np.clip(margins[np.arange(len(best)), best] - rest, -30, 30)))
        lang = np.empty(len(margins), object)
        for k, names in enumerate(self.members):
            rows = np.flatnonzero(best == k)
            wins, total = np.zeros((len(rows), len(names))), np.zeros((len(rows), len(names)))
            for p, (f, a, b) in enumerate(self.pairs):
                if f == k:
                    m, i, j = margins[rows, nf + p], names.index(a), names.index(b)
                    wins[:, i] += m >= 0
                    wins[:, j] += m < 0
                    total[:, i] += m
                    total[:, j] -= m
            first = np.lexsort((-total, -wins), axis=1)[:, 0] if len(rows) else np.zeros(0, int)
            lang[rows] = np.array(names, object)[first]
            if len(names) > 1:
                chance[rows] /= 1 + np.exp(-np.clip(total[np.arange(len(rows)), first] / (len(names) - 1), -30, 30))
        return lang, chance


def _vectors(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """n-grams of all texts end to end, and their counts by text."""
    words, codes, offsets = word_table(texts)
    grams, counts = word_ngrams(words)
    starts = np.cumsum(counts) - counts
    n = counts[codes]
    before = np.cumsum(n) - n
    take = np.repeat(starts[codes] - before, n) + np.arange(int(n.sum()))
    return grams[take], sums_by_text(n, offsets)


def sample_labelled(docs: DataFrame, label: str, per_label: int, where: Column, most_bytes: int = TRAIN_BYTES) -> DataFrame:
    """About ``per_label`` different rows of each label, and of all labels about
    ``most_bytes`` of text (a longer text counts once): doc_id, text, label.

    Rows are chosen by a hash of doc_id and text against a threshold from the
    labels' counts and bytes, so each label's rows are cut by a filter.  Rows
    that repeat both count once, folded in their own task before they meet:
    neither a doc_id nor a copied row with a third of the table passes the bound.
    """
    rows = docs.where(where & F.col(label).isNotNull()).select("doc_id", "text", label)
    counts = {r[0]: (r[1], r[2] or 0) for r in rows.groupBy(label).agg(F.count("*"), F.sum(F.octet_length("text").cast("long"))).collect()}
    if not counts:
        return rows.limit(0)
    most = F.lit(0).cast("long")
    for name, (n, size) in counts.items():
        share = min(1.0, per_label / n, most_bytes / len(counts) / max(1, size))
        most = F.when(F.col(label) == F.lit(name), F.lit(threshold(share))).otherwise(most)
    same = F.xxhash64("doc_id", "text", F.lit(11))
    some = rows.where(drawn(same) < most)
    return some.groupBy("doc_id", label, same.alias("same")).agg(F.first("text").alias("text")).select("doc_id", "text", label)


def train(docs: DataFrame, where: Column, per_lang: int = TRAIN_ROWS) -> LanguageModel | None:
    """Fit on a sample of about ``per_lang`` rows a language (a bound on the
    driver's memory, not on what is predicted).  None without labelled rows."""
    tuned(docs.sparkSession)
    chosen = sample_labelled(docs.select("doc_id", "text", "lang"), "lang", per_lang, where).select("text", "lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in frugal(slices(batches, 0, TOGETHER_BYTES)):
            for b in (part(whole, k, min(k + TOGETHER, whole.num_rows)) for k in range(0, whole.num_rows, TOGETHER)):
                grams, sizes = _vectors(b.column(0))
                ends = np.cumsum(sizes)
                found = [np.unique(grams[e - s : e], return_counts=True) for s, e in zip(sizes, ends)]
                yield pa.RecordBatch.from_arrays([b.column(1), *(pa.array([f[k].astype(np.int32) for f in found], pa.list_(pa.int32())) for k in (0, 1))], names=["lang", "at", "n"])

    got = chosen.mapInArrow(run, "lang string, at array<int>, n array<int>").toArrow().combine_chunks()
    langs = got.column("lang").to_pylist()
    at, n = (got.column(c).combine_chunks() for c in ("at", "n"))
    ends, at, n = at.offsets.to_numpy(), at.values.to_numpy(), n.values.to_numpy()
    # rows come in any order; the fit must not depend on it
    keys = [(langs[i], int(j - i0), zlib.crc32(at[i0:j]), zlib.crc32(n[i0:j]), i) for i, (i0, j) in enumerate(zip(ends[:-1], ends[1:])) if j > i0]
    order = [k[-1] for k in sorted(keys)]
    if not order:
        return None
    # sparse rows: every n-gram of every row has a weight, however rare
    sizes = np.diff(ends)[order]
    new = np.concatenate([[0], np.cumsum(sizes)])
    take = np.repeat(ends[:-1][order] - new[:-1], sizes) + np.arange(new[-1])
    at, count = at[take], n[take]
    value = (count / np.repeat(np.add.reduceat(count, new[:-1], dtype=np.int64), sizes)).astype(np.float32)
    langs = [langs[r] for r in order]
    del got, n, take, count
    pa.default_memory_pool().release_unused()
    scale = (1.0 / (np.sqrt(np.bincount(at, weights=value.astype(np.float64) ** 2, minlength=BUCKETS) / len(order)) + 1e-3)).astype(np.float32)
    value *= scale[at]
    again = np.float32(1.0 / np.sqrt(np.sum(value.astype(np.float64) ** 2) / len(order)))
    value *= again
    model = LanguageModel.fit(SparseRows(new, at, value), langs)
    model.weights *= (scale * again)[:, None]
    return model


def _guess(model: LanguageModel | None, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Language and score of each text: weights are summed over the n-grams of
    each distinct word, then over the words of each text."""
    words, codes, offsets = word_table(texts)
    lang, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
    if model is not None and len(codes):
        per_word, counts = word_sums(words, model.weights)
        size = sums_by_text(counts[codes], offsets)
        lettered = np.flatnonzero(size)
        total = np.zeros((len(texts), model.weights.shape[1]))
        for r in lettered.tolist():
            mine = codes[offsets[r] : offsets[r + 1]]
            for k in range(0, len(mine), WORDS):
                total[r] += per_word[mine[k : k + WORDS]].sum(axis=0)
        lang[lettered], score[lettered] = model.choose(total[lettered] / size[lettered, None] + model.bias)
    return lang, score


def predict(docs: DataFrame, model: LanguageModel | None) -> DataFrame:
    """doc_id, lang_pred, score: ``und`` with score 0 for a null text or one
    without a letter; else a learned language.  Only text is read."""
    shared = tuned(docs.sparkSession).sparkContext.broadcast(model)  # 65,536 weights a model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in frugal(slices(batches, 1)):
            lang, score = _guess(shared.value, b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def label(docs: DataFrame, model: LanguageModel | None, name: str | None = None) -> tuple[DataFrame, str]:
    """All columns of ``docs`` and, last, the predicted language; and the name
    of that column: ``name`` or lang_pred, with underscores added if ``docs``
    has one of that name.  Null texts, empty texts and those without a letter
    are ``und``; rows keep their number and order within a partition."""
    name = fresh(name or "lang_pred", docs)
    shared = tuned(docs.sparkSession).sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in frugal(slices(batches, at)):
            lang, _ = _guess(shared.value, b.column(at))
            yield b.append_column(name, pa.array(lang, pa.string()))

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(name, StringType())])), name
