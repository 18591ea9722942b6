"""Toxicity: a noisy channel is undone before the text is scored.

Disguised words (digits and signs for letters, letters spaced out, letters
repeated) become a lattice: every character has the letters it may stand for,
or nothing, each at a cost.  Viterbi picks the path that a character trigram
model, counted over the words of all documents, likes best.  The restored words
are scored by a boosted list of character n-grams; a text's margin is the sum
over the n-grams it holds, however often, so length does not matter.
"""

from __future__ import annotations

import os
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import frugal, mix64, powers, slices, tuned, word_table
from .langid import sample_labelled

#: Labelled rows of each class that the scorer is fitted on.
TRAIN_ROWS = 1500
#: Bytes of labelled texts, of both classes together, whose n-grams reach the
#: driver: ten times as many bytes at most.
TRAIN_BYTES = 24 << 20
ROUNDS = 120
#: Boosting ends when no rule explains more.
LEAST_EDGE = 0.03
#: Expected number of n-grams that join the rules by chance.
CHANCE = 0.01
#: Weight of clean rows against toxic ones where the cut is chosen.
CLEAN_WEIGHT = 6
#: Share of toxic texts that must hold such an n-gram.
COMMON = 0.05
#: Steps after which what all paths share is put out, which bounds their memory;
#: and how far around a letter its token counts as stretched.
WINDOW = 48
CACHE_WORDS = 200_000

#: What signs may stand for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "*": "aeiou", "#": "h"}
SEPARATORS = " .-_*~'/=\\"
LETTERS = "abcdefghijklmnopqrstuvwxyzäöüßéèêëàâçîïôûùñóíúáåøæœãõìòõý"
#: 0: word border, 1: any other letter
SYMBOL = {c: k for k, c in enumerate(dict.fromkeys(LETTERS), 2)}
N = 64

# channel costs in nats
COST_SIGN, COST_DROP_SEPARATOR, COST_DROP_REPEAT, COST_KEEP_REPEAT, COST_DROP_DOUBLE, COST_DROP_STRETCH = 0.5, 0.3, 0.2, 3.0, 5.0, 1.5

EMAIL = r"\pL@[\w-]+(\.[\w-]+)*\.\pL{2,}"
#: Of a trimmed token: a sign or digit that may stand for a letter, or a separator inside.
DISGUISED = r"[0-9@$!|+(€£*#]|[^\s][._\-*~'/=\\]+[^\s]"
TRIM = ".,;:?\"'()[]{}<>…“”„‘’‚«»‹›"


def _symbols(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _TABLE[np.minimum(points, len(_TABLE) - 1)]


_TABLE = np.zeros(0x250, np.int64)
for _c in map(chr, range(0x250)):
    _TABLE[ord(_c)] = SYMBOL.get(_c, 1) if _c.isalpha() else 0
_TABLE[-1] = 1


def trigram_counts(docs: DataFrame) -> np.ndarray:
    """Character trigrams of the words of all documents, summed over tasks:
    what reaches the driver is bounded by the alphabet."""
    tuned(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(N**3)
        for b in frugal(slices(batches, 0)):
            words, codes, _ = word_table(b.column(0))
            if not len(codes):
                continue
            times = np.bincount(codes, minlength=len(words))
            joined = "  ".join(pc.utf8_lower(words.cast(pa.large_string())).to_pylist())
            s = _symbols("  " + joined + " ")
            # each word with two borders before it
            size = pc.utf8_length(pc.utf8_lower(words.cast(pa.large_string()))).to_numpy(zero_copy_only=False) + 2
            weight = np.repeat(times, size)[: len(s) - 2]
            total += np.bincount(s[:-2] * N * N + s[1:-1] * N + s[2:], weights=weight, minlength=N**3)
        at = np.flatnonzero(total)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at].astype(np.int64))], names=["at", "n"])

    got = docs.select("text").mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(N**3)
    out[got.column("at").to_numpy()] = got.column("n").to_numpy()
    return out.reshape(N, N, N)


def log_model(counts: np.ndarray) -> np.ndarray:
    """log P(c | a, b), interpolated with shorter contexts."""
    uni = counts.sum(axis=(0, 1)) + 1
    bi = counts.sum(axis=0) + 3 * (uni / uni.sum())
    tri = counts + 3 * (bi / bi.sum(axis=1, keepdims=True))
    return np.log(tri / tri.sum(axis=2, keepdims=True))


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each character of a lower-case token what it may stand for.

    A double letter is mostly meant; in a token that stretches others as well
    it is dropped more readily.  A sign that comes again and again separates.
    """
    out, run = [], 0
    doubles, times = [0], Counter(token)
    for a, b in zip(token, token[1:]):
        doubles.append(doubles[-1] + (a == b))
    for k, c in enumerate(token):
        run = run + 1 if k and token[k - 1] == c else 1
        if c.isalpha():
            if run == 1:
                out.append([(c, 0.0)])
            elif run == 2 and token[k + 1 : k + 2] != c:
                stretched = doubles[min(k + WINDOW, len(token) - 1)] - doubles[max(k - WINDOW, 0)] >= 3
                out.append([(c, 0.0), ("", COST_DROP_STRETCH if stretched else COST_DROP_DOUBLE)])
            else:
                out.append([(c, COST_KEEP_REPEAT), ("", COST_DROP_REPEAT)])
            continue
        separates = c in SEPARATORS and (c not in LEET or times[c] >= 3)
        options = [] if separates else [(x, COST_SIGN) for x in LEET.get(c, "")]
        if separates:
            options += [("", COST_DROP_SEPARATOR), (" ", 0.0)]
        elif options and run > 1:
            options += [("", COST_DROP_REPEAT)]
        out.append(options or [(" ", 0.0)])
    return out


def decode(token: str, model: np.ndarray) -> str:
    """The most likely text behind a token, words separated by blanks.

    Paths run over the whole token; every ``WINDOW`` steps the beginning that
    all of them share is put out.
    """
    out: list[str] = []
    best: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
    for step, options in enumerate([*lattice(token), [(" ", 0.0)]], 1):
        new: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (a, b), (score, path) in best.items():
            for c, cost in options:
                if not c:
                    key, value = (a, b), score - cost
                else:
                    s = SYMBOL.get(c, 1) if c != " " else 0
                    key, value = (b, s), score - cost + (model[a, b, s] if s or b else 0.0)
                if key not in new or value > new[key][0]:
                    new[key] = value, (path, c) if c else path
        best = new
        if step % WINDOW == 0:
            told = {key: _spelled(path) for key, (_, path) in best.items()}
            shared = os.path.commonprefix(list(told.values()))
            out.append(shared)
            for key, text in told.items():
                path = ()
                for c in text[len(shared) :]:
                    path = path, c
                best[key] = best[key][0], path
    out.append(_spelled(max(best.values(), key=lambda x: x[0])[1]))
    return " ".join("".join(out).split())


def _spelled(path: tuple) -> str:
    chars = []
    while path:
        path, c = path
        chars.append(c)
    return "".join(chars[::-1])


class Restorer:
    """Restored words of a batch of texts."""

    def __init__(self, model: np.ndarray):
        self.model, self.known = model, {}

    def restore(self, token: str) -> list[str]:
        if token not in self.known:
            if len(self.known) > CACHE_WORDS:
                self.known.clear()
            self.known[token] = decode(token.lower().strip(TRIM).rstrip("!" + TRIM), self.model).split()
        return self.known[token]

    def words(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Distinct words after restoring, and (text, word) pairs of numbers.

        A disguised token gives its restored words; a run of three or more
        single letters gives the words it spells; any other token itself.
        """
        words, codes, offsets = word_table(texts)
        words = words.cast(pa.large_string())
        text = np.repeat(np.arange(len(texts)), np.diff(offsets))
        plain = words.to_pylist()
        core = pc.utf8_rtrim(pc.utf8_trim(words, TRIM), "!" + TRIM)
        signs = pc.and_not(pc.match_substring_regex(core, DISGUISED), pc.match_substring_regex(core, EMAIL)).to_numpy(zero_copy_only=False)
        suspect = signs | _stretched(words)
        single = np.fromiter((len(w) == 1 and (w.isalpha() or w in LEET) for w in plain), bool, len(plain))
        number = {w: k for k, w in enumerate(plain)}
        extra_text, extra_word = [], []

        def add(t: int, found: list[str]) -> None:
            for w in found:
                extra_text.append(t)
                extra_word.append(number.setdefault(w, len(number)))

        hit = suspect[codes]
        for t, c in zip(*np.unique(np.stack([text[hit], codes[hit]]), axis=1).tolist() if hit.any() else ((), ())):
            add(t, self.restore(plain[c]))
        alone = single[codes]
        if alone.any():
            border = np.flatnonzero(np.diff(np.concatenate([[0], alone, [0]]).astype(np.int8)) | np.concatenate([[0], np.diff(text) != 0, [0]]))
            for i, j in zip(border[:-1].tolist(), border[1:].tolist()):
                if alone[i] and j - i >= 3:
                    add(int(text[i]), self.restore(" ".join(plain[c] for c in codes[i:j])))
        return list(number), np.concatenate([text[~hit], np.array(extra_text, np.int64)]), np.concatenate([codes[~hit], np.array(extra_word, np.int64)])


def _stretched(words: pa.Array) -> np.ndarray:
    """Words with a letter three times running, or three letters doubled."""
    if not len(words):
        return np.zeros(0, bool)
    ends = np.frombuffer(words.buffers()[1], np.int64, len(words) + 1, 8 * words.offset)
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[: ends[-1]] | 32
    at = np.flatnonzero((data[1:] == data[:-1]) & (data[1:] >= 97) & (data[1:] <= 122))
    word = np.searchsorted(ends, at, side="right") - 1
    inside = at + 1 < ends[word + 1]
    at, word = at[inside], word[inside]
    out = np.bincount(word, minlength=len(words)) >= 3
    out[word[1:][(np.diff(at) == 1) & (np.diff(word) == 0)]] = True
    return out


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit keys of each whole word and of its 5- and 6-byte n-grams between
    borders, and the word of each.  Keys are not folded into buckets: a rare n-gram must not
    pass for one that a rule names."""
    cased = pc.utf8_lower(pa.array(words, pa.large_string()))
    core = pc.utf8_trim(cased, ".,;:?!\"'()[]{}<>*#%&$@|…-_=+~`")
    framed = pc.binary_join_element_wise(pa.scalar("^", pa.large_string()), core, pa.scalar("$", pa.large_string()), pa.scalar("", pa.large_string()))
    ends = np.frombuffer(framed.buffers()[1], np.int64, len(framed) + 1, 8 * framed.offset)
    data = np.frombuffer(framed.buffers()[2] or b"", np.uint8)[: ends[-1]].astype(np.uint64)
    owner = np.repeat(np.arange(len(framed)), np.diff(ends))
    left = ends[1:][owner] - np.arange(len(owner)) if len(owner) else ends[:0]
    grams, owners = [], []
    for n in (5, 6):
        m = max(0, len(data) - n + 1)
        code = np.full(m, n, np.uint64)
        for k in range(n):
            code = code * np.uint64(256) + data[k : k + m]
        fits = left[:m] >= n
        grams.append(mix64(code[fits]).view(np.int64))
        owners.append(owner[:m][fits])
    if len(data):
        place = np.arange(len(data)) - ends[:-1][owner]
        power = powers(0x9E3779B97F4A7C15, int(place.max()))
        grams.append(mix64(np.add.reduceat(data * power[place], ends[:-1]) + np.uint64(0x5BD1)).view(np.int64))
        owners.append(np.arange(len(framed)))
    return np.concatenate(grams), np.concatenate(owners)


#: Turns the key "holds this n-gram" into "holds it often": twice and once in
#: ``OFTEN`` words at least.  Stems that clean texts hold by chance need it.
OFTEN, OFTEN_KEY = 80, np.int64(0x2545F4914F6CDD1D)


def text_keys(grams: np.ndarray, owner: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Distinct keys of a text with the words numbered ``words`` (repeats
    included); grams are sorted by the word that owns them."""
    mine, times = np.unique(words, return_counts=True)
    i, j = np.searchsorted(owner, mine), np.searchsorted(owner, mine, side="right")
    n = j - i
    held = grams[np.repeat(i - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
    keys, at = np.unique(held, return_inverse=True)
    count = np.bincount(at, weights=np.repeat(times, n), minlength=len(keys))
    return np.concatenate([keys, keys[(count >= 2) & (count * OFTEN >= len(words))] ^ OFTEN_KEY])


@dataclass
class ToxicityModel:
    chars: np.ndarray  # log trigram model
    rules: np.ndarray  # keys of n-grams, ascending
    gains: np.ndarray
    bias: float

    def margins(self, restorer: Restorer, texts: pa.Array) -> np.ndarray:
        words, text, word = restorer.words(texts)
        out = np.full(len(texts), self.bias)
        if len(words):
            grams, owner = word_features(words)
            size = np.bincount(text, minlength=len(texts))
            for often in (False, True):
                key = grams ^ OFTEN_KEY if often else grams
                rule = np.minimum(np.searchsorted(self.rules, key), max(0, len(self.rules) - 1))
                told = self.rules[rule] == key if len(self.rules) else np.zeros(len(key), bool)
                if not told.any():
                    continue
                order = np.argsort(owner[told], kind="stable")
                rule, by = rule[told][order], owner[told][order]
                first, last = np.searchsorted(by, word), np.searchsorted(by, word, side="right")
                n = last - first
                take = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                pairs, count = np.unique(np.repeat(text, n) * len(self.rules) + rule[take], return_counts=True)
                if often:
                    pairs = pairs[(count >= 2) & (count * OFTEN >= size[pairs // len(self.rules)])]
                np.add.at(out, pairs // len(self.rules), self.gains[pairs % len(self.rules)])
        return out


def boost(rows: np.ndarray, keys: np.ndarray, toxic: np.ndarray, sketch: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, float]:
    """Confidence-rated boosting of one-sided rules "holds this n-gram".

    rows, keys: distinct pairs; toxic: 0 or 1 of each row.  A rule needs three
    toxic rows and a hundredth of all.  Weights are not scaled up again as rows
    are explained, so chance rules never get a say when little is left.  Then
    every n-gram joins that is as good as never held by other rows and by more
    toxic ones (``COMMON``) than chance allows (``CHANCE`` over all): a word is no
    less toxic for always coming with others.  Copies count once: rows with the
    same ``sketch`` are one, and a few of them must not make up most.
    Returns keys and gains of the rules, and the bias.
    """
    margin, none = np.zeros(len(toxic)), (np.zeros(0, np.int64), np.zeros(0))
    n_toxic = int(toxic.sum())
    if not n_toxic or n_toxic == len(toxic):
        return *none, (-2.0 if not n_toxic else 2.0)
    named, times = np.unique(keys[toxic[rows] == 1], return_counts=True)
    named = named[times >= max(3, 0.01 * n_toxic)]
    if not len(named):
        return *none, -2.0
    place = np.minimum(np.searchsorted(named, keys), len(named) - 1)
    useful = named[place] == keys
    rows, features, count = rows[useful], place[useful], len(named)
    gains = np.zeros(count)
    # both classes weigh the same
    weight = np.where(toxic == 1, 0.5 / n_toxic, 0.5 / (len(toxic) - n_toxic))
    w0 = weight.copy()
    sign = 2.0 * toxic - 1
    small = 0.25 / len(toxic)
    by_feature = np.argsort(features, kind="stable")
    of_feature = features[by_feature]
    for _ in range(rounds):
        bad = np.bincount(features, weights=(weight * toxic)[rows], minlength=count)
        good = np.bincount(features, weights=(weight * (1 - toxic))[rows], minlength=count)
        edge = np.sqrt(bad) - np.sqrt(good)
        k = int(np.argmax(edge))
        if edge[k] <= LEAST_EDGE:
            break
        gain = 0.5 * np.log((bad[k] + small) / (good[k] + small))
        gains[k] += gain
        i, j = np.searchsorted(of_feature, k), np.searchsorted(of_feature, k, side="right")
        held = rows[by_feature[i:j]]
        margin[held] += gain
        weight[held] *= np.exp(-gain * sign[held])
    bad = np.bincount(features, weights=(w0 * toxic)[rows], minlength=count)
    good = np.bincount(features, weights=(w0 * (1 - toxic))[rows], minlength=count)
    held = toxic[rows] == 1
    groups = np.unique(sketch, return_inverse=True)[1]
    pairs, times = np.unique(features[held] * (int(groups.max()) + 1) + groups[rows[held]], return_counts=True)
    of = pairs // (int(groups.max()) + 1)
    distinct = np.bincount(of, minlength=count)
    spread = np.bincount(of, weights=times, minlength=count) ** 2 / np.maximum(np.bincount(of, weights=times.astype(float) ** 2, minlength=count), 1)
    least = max(COMMON * n_toxic, np.log(count / CHANCE) / -np.log(n_toxic / len(toxic)))
    more = (gains == 0) & (good <= 0.02 * bad) & (distinct >= least) & (spread >= 5)
    gains[more] = 0.5 * np.log((bad[more] + small) / (good[more] + small))
    margin = np.bincount(rows, weights=gains[features], minlength=len(toxic))
    # the cut with the fewest errors, close above what it leaves below; as most
    # texts are clean, so is most of what a cut decides
    values = np.unique(margin)
    cuts = np.concatenate([values[:1] - 1, values[:-1] + np.minimum(np.diff(values) / 2, 1.0), values[-1:] + 1])
    worth = w0 * np.where(toxic == 1, 1, CLEAN_WEIGHT)
    right = [(worth * ((margin > c) == (toxic == 1))).sum() for c in cuts]
    return named[gains != 0], gains[gains != 0], -float(cuts[int(np.argmax(right))])


def train(docs: DataFrame, labels: DataFrame, where: Column, per_class: int = TRAIN_ROWS) -> ToxicityModel:
    """Fit on about ``per_class`` different labelled rows of each class and about
    ``TRAIN_BYTES`` of their texts (bounds on the driver's memory); the character
    model counts all documents.  Rows
    without a label of 0 or 1 are unlabelled, null texts have no words; without
    labelled rows, or with empty tables, no rule is learned.  Other columns are
    not read."""
    spark = tuned(docs.sparkSession)
    chars = log_model(trigram_counts(docs))
    marks = labels.select("doc_id", F.lit(None).cast("string").alias("text"), F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1)")
    marks = sample_labelled(marks, "toxic", per_class, where).select("doc_id", "toxic")
    # the sample is bounded, so the texts need not be shuffled to meet it; a
    # doc_id of many rows is cut again by its texts
    chosen = docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id")
    chosen = sample_labelled(chosen, "toxic", per_class, F.lit(True), TRAIN_BYTES).select("text", "toxic")
    shared = spark.sparkContext.broadcast(chars)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(shared.value)
        for b in frugal(slices(batches, 0)):
            words, text, word = restorer.words(b.column(0))
            grams, owner = word_features(words)
            order = np.argsort(owner, kind="stable")
            grams, owner = grams[order], owner[order]
            found = [text_keys(grams, owner, word[text == t]) for t in range(b.num_rows)]
            yield pa.RecordBatch.from_arrays([b.column(1), pa.array(found, pa.list_(pa.int64()))], names=["toxic", "at"])

    got = chosen.mapInArrow(run, "toxic int, at array<long>").toArrow().combine_chunks()
    if not got.num_rows:
        return ToxicityModel(chars, np.zeros(0, np.int64), np.zeros(0), -2.0)
    lists = got.column("at").combine_chunks()
    ends, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
    # two smallest hashes of a text's n-grams: near copies mostly share both
    some = np.flatnonzero(np.diff(ends))
    low = [np.minimum.reduceat(k, ends[:-1][some]) if len(some) else k for k in (flat, mix64(flat.view(np.uint64) ^ np.uint64(0x5851F42D4C957F2D)).view(np.int64))]
    sketch = np.zeros(got.num_rows, np.int64)
    sketch[some] = low[0] ^ (low[1] << 1)
    return ToxicityModel(chars, *boost(np.repeat(np.arange(got.num_rows), np.diff(ends)), flat, got.column("toxic").to_numpy(), sketch))


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id and score (0 to 1, higher: more likely toxic) of each whole text.

    Null and empty texts score as texts without any evidence.  Only doc_id and
    text are read.
    """
    spark = tuned(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        restorer = Restorer(model.chars)
        for b in frugal(slices(batches, 1)):
            margin = model.margins(restorer, b.column(1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(1 / (1 + np.exp(-2 * np.clip(margin, -20, 20))))], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")
