"""Token ids as Parquet list columns that can be read in part.

The file format: one row a document in ascending doc_id order, columns
``doc_id, part, local_start, n_tokens, token_ids``.  Token ids are dictionary
encoded (a vocabulary of 49k ids packs into 16 bits), the three counters are
delta encoded (data pages of version 2), row groups and pages are small enough
for page indexes to skip most of a file, and a ``manifest`` beside the data has
a row a file with the number of ids in all files before it.  A reader of
metadata never touches the ids; a reader of a doc_id range reads the pages that
hold it.
"""

from __future__ import annotations

import json
import os
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from .common import frugal, merged, ragged_take, tuned, word_table

ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 128 << 10
#: Words of a generation of the cache; a worker holds two generations.
CACHE_WORDS = 300_000

STORED = "doc_id long, part int, local_start long, n_tokens long, token_ids array<int>"


#: Signs around a word of letters, a piece of their own on either side.  The
#: apostrophe is none: it may begin an ending.
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Words, with signs or without, whose letters have one lower case and one
#: composed form.
LATIN = r"^[!-&(-/:-@\[-`{-~]*[A-Za-zÀ-ÖØ-öø-įĲ-ňŊ-ž]+[!-&(-/:-@\[-`{-~]*$"


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself
    if printable, else the next free one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


#: How the tokenizer has to treat texts for words to be encoded
#: apart, in the words of its own file.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}
BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}


def splits_words(config: dict) -> bool:
    """Whether a tokenizer's file says that its ids for a text are those of its words."""
    model, special = config.get("model", {}), config.get("added_tokens") or []
    return (
        config.get("normalizer") == NORMALIZER
        and config.get("pre_tokenizer") == {"type": "Sequence", "pretokenizers": [SPLIT, BYTES]}
        and model.get("type") == "BPE"
        and not (model.get("dropout") or model.get("continuing_subword_prefix") or config.get("truncation") or config.get("padding"))
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or any(c.isspace() for c in t["content"]) for t in special)
    )


class WordEncoder:
    """Encodes texts with a tokenizer that never merges across white space.

    Such a tokenizer's ids for a text are those of its words, end to end, so
    each distinct word is given to the library once.  A word of letters is one
    piece after lower casing and goes to the library's model directly, as do
    the signs around it; any other word goes through the whole tokenizer.  A
    file that does not say so (``splits_words``) has its texts encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = splits_words(json.loads(self.tokenizer.to_str()))
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _get(self, word: str) -> bytes | None:
        """Ids of a known word; one of the older generation joins the new one."""
        ids = self.known.get(word)
        if ids is None and (ids := self.older.get(word)) is not None:
            self.known[word] = ids
        return ids

    def _whole(self, word: str) -> bytes:
        ids = self._get(word)
        if ids is None:
            ids = self.known[word] = array("i", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()
        return ids

    def _word(self, word: str) -> bytes:
        if not word.isalpha():
            return self._whole(word)
        low = word.lower()
        ids = self._get(low)
        if ids is None:
            if not (low.isalpha() and unicodedata.is_normalized("NFC", word)) or "\u03a3" in word:
                return self._whole(word)
            ids = self.known[low] = self._piece(low)
        return ids

    def _piece(self, low: str) -> bytes:
        piece = low if low.isascii() else low.encode().decode("latin-1").translate(self.letters)
        return array("i", [t.id for t in self.model.tokenize(piece)]).tobytes()

    def _ids(self, words: pa.Array) -> list[bytes]:
        """Ids of distinct words.  Words of Latin letters are stripped and
        lower-cased by Arrow and looked up once for all their spellings."""
        plain = pc.match_substring_regex(words, LATIN)
        for special in self.special:  # one id wherever it stands
            plain = pc.and_not(plain, pc.match_substring(words, special))
        plain = plain.to_numpy(zero_copy_only=False)
        low = pc.utf8_lower(words)
        core = pc.ascii_trim(low, SIGNS)
        out = np.empty(len(words), object)
        coded = core.filter(pa.array(plain)).dictionary_encode()
        known, new, old = [], self.known, self.older
        for w in coded.dictionary.to_pylist():
            ids = new.get(w)
            if ids is None:
                ids = old.get(w)
                new[w] = ids = self._piece(w) if ids is None else ids
            known.append(ids)
        ids = np.empty(len(known), object)
        ids[:] = known
        out[plain] = ids[coded.indices.to_numpy()]
        length = lambda x: pc.binary_length(x).to_numpy(zero_copy_only=False)
        whole, size = length(low), length(core)
        first = whole - length(pc.ascii_ltrim(low, SIGNS))
        signed = np.flatnonzero(plain & (whole > size))
        signs: dict[str, bytes] = {"": b""}
        # signs are ASCII, so places counted from either end hold in characters
        for k, i, n, w in zip(signed.tolist(), first[signed].tolist(), (whole - size - first)[signed].tolist(), low.take(pa.array(signed)).to_pylist()):
            head, tail = w[:i], w[len(w) - n :]
            for x in (head, tail):
                if x not in signs:
                    signs[x] = self._whole(x)
            out[k] = signs[head] + out[k] + signs[tail]
        other = np.flatnonzero(~plain)
        for k, w in zip(other.tolist(), words.take(pa.array(other)).to_pylist()):
            out[k] = self._word(w)
        return out.tolist()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids end to end, and the number of ids of each text."""
        if not self.by_word:
            found = [self.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts.to_pylist()]
            return np.fromiter(chain.from_iterable(found), np.int32), np.fromiter(map(len, found), np.int64, len(found))
        words, codes, offsets = word_table(texts)
        if len(self.known) > CACHE_WORDS:
            self.older, self.known = self.known, {}
        each = self._ids(words)
        store = np.frombuffer(b"".join(each), "<i4")
        lengths = np.fromiter(map(len, each), np.int64, len(each)) // 4
        starts = np.cumsum(lengths) - lengths
        ids = store[ragged_take(lengths, starts, codes)] if len(codes) else store[:0]
        before = np.concatenate([[0], np.cumsum(lengths[codes])]) if len(codes) else np.zeros(1, np.int64)
        return ids, before[offsets[1:]] - before[offsets[:-1]]


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    """One a worker process: what a task has learned helps the next one."""
    return WordEncoder(path)


def encode_documents(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """(doc_id, text) to the stored columns, in ascending doc_id order.

    Null texts count as empty; a null doc_id sorts first; repeated doc_ids are
    stored as often as they come, in any order.  Ranges are cut within a doc_id
    that many rows share, so no doc_id is one file.  An empty table gives no
    rows.  Other columns of ``docs`` are not read, whatever their names.
    """
    tuned(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, at, part = _encoder(tokenizer_path), 0, TaskContext.get().partitionId()
        for b in frugal(merged(batches, 1)):
            ids, counts = encoder.encode(b.column(1))
            n = len(counts)
            if not n:
                continue
            out = np.full(len(ids) + n, end_id, np.int32)
            out[np.arange(len(ids)) + np.repeat(np.arange(n), counts)] = ids
            ends = np.cumsum(counts + 1)
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array(np.full(n, part, np.int32)),
                    pa.array(at + ends - counts - 1),
                    pa.array(counts + 1),
                    pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(out)),
                ],
                names=["doc_id", "part", "local_start", "n_tokens", "token_ids"],
            )
            at += int(ends[-1])

    # ranges before encoding: finding their bounds reads the input, which must
    # not encode it twice
    ordered = docs.select(F.col("doc_id").cast("long"), "text", F.monotonically_increasing_id().alias("tie")).repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    return ordered.mapInArrow(run, STORED)


def count_tokens(docs: DataFrame, tokenizer_path: str, name: str = "n") -> DataFrame:
    """Other columns of ``docs`` in place of ``text``, and its number of ids."""
    tuned(docs.sparkSession)
    rest = [c for c in docs.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path)
        for b in frugal(merged(batches, len(rest))):
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(encoder.encode(b.column(len(rest)))[1], pa.int64())], names=[*rest, name])

    kept = docs.select(*rest, "text")
    return kept.mapInArrow(run, StructType([*kept.schema.fields[:-1], StructField(name, LongType())]))


def write_token_table(docs: DataFrame, path: str, tokenizer_path: str, end_id: int) -> None:
    """Write ``docs`` in the file format, with its manifest."""
    spark = docs.sparkSession
    out = encode_documents(docs, tokenizer_path, end_id).write.option("compression", "zstd")
    for key, value in {
        "parquet.block.size": ROW_GROUP_BYTES,
        "parquet.page.size": PAGE_BYTES,
        "parquet.writer.version": "v2",
        "parquet.enable.dictionary": "true",
        "parquet.enable.dictionary#doc_id": "false",
        "parquet.enable.dictionary#local_start": "false",
        "parquet.enable.dictionary#n_tokens": "false",
        "parquet.page.write-checksum.enabled": "true",
    }.items():
        out = out.option(key, str(value))
    out.parquet(f"{path}/ids")
    # one row a file: its size is bounded by the number of files
    sizes = spark.read.parquet(f"{path}/ids").groupBy("part").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_ids"), F.min("doc_id").alias("first_doc")).orderBy("part").collect()
    starts = np.cumsum([0] + [r.n_ids for r in sizes]).tolist()
    rows = [(r.part, r.n_docs, r.n_ids, r.first_doc, s) for r, s in zip(sizes, starts)]
    spark.createDataFrame(rows, "part int, n_docs long, n_ids long, first_doc long, start long").coalesce(1).write.parquet(f"{path}/manifest")


def read_token_table(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and token_ids; only what is selected is read."""
    ids = spark.read.schema(STORED).parquet(f"{path}/ids")
    manifest = spark.read.schema("part int, start long").parquet(f"{path}/manifest")  # a row a file
    return ids.join(F.broadcast(manifest), "part").select("doc_id", (F.col("start") + F.col("local_start")).alias("start"), "n_tokens", "token_ids")


def with_crc(tokens: DataFrame) -> DataFrame:
    """Replace token_ids by the crc32 of the ids as little-endian unsigned 32-bit integers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in frugal(batches):
            lists = b.column(3)
            ends = lists.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(), "<u4").view(np.uint8))
            crc = [zlib.crc32(raw[4 * i : 4 * j]) for i, j in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.select("doc_id", "start", "n_tokens", "token_ids").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
