import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from panelweave.llm import token_store
from panelweave.llm.common import scratch
from panelweave.llm.queries import op1_token_store, tokenizer_file

FILE = tokenizer_file("word_bpe_49k.json")


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(FILE)


def test_words_encode_like_whole_texts(tokenizer):
    rng = random.Random(5)
    spans = [(32, 0x250), (32, 0x3000), (0x300, 0x400), (32, 127)]
    texts = ["".join(chr(rng.randrange(*rng.choice(spans))) for _ in range(200)) for _ in range(300)] + ["ΟΔΟΣ. σας! İI ǅ ﬁ é. É?", "<|startoftext|> x<|endoftext|> <|endoftext|>. <|EndOfText|> <|endoftext", "(a) 'b' c's \"d\" e** --f -g- h's' 's. 'sx i|j <k> l_m ß. ẞ Ŀ ŉ ĸ"]
    ids, counts = token_store.WordEncoder(FILE).encode(pa.array(texts))
    ends = np.cumsum(counts)
    for t, n, e in zip(texts, counts, ends):
        assert tokenizer.encode(t, add_special_tokens=False).ids == ids[e - n : e].tolist()


def check(spark, docs, tokenizer):
    path = scratch(spark, "t")
    token_store.write_token_table(docs, path, FILE, 2)
    table = token_store.read_token_table(spark, path)
    got = {r.doc_id: r for r in table.collect()}
    crc = {r.doc_id: r for r in token_store.with_crc(table).collect()}
    start = 0
    for r in sorted(docs.select("doc_id", "text").collect()):
        want = ids_of(tokenizer, r.text)
        assert got[r.doc_id].token_ids == want and got[r.doc_id].start == start
        assert crc[r.doc_id].ids_crc32 == zlib.crc32(np.array(want, "<u4").tobytes()) and crc[r.doc_id].n_tokens == len(want)
        start += len(want)
    assert len(got) == docs.count()
    return path


def test_edge_texts(spark, edge, nothing, tokenizer):
    path = check(spark, edge, tokenizer)
    check(spark, nothing, tokenizer)
    # ids are dictionary encoded, counters delta encoded, pages indexed
    import glob

    import pyarrow.parquet as pq

    for f in glob.glob(path.replace("file:", "").replace("//", "/") + "/ids/*.parquet"):
        columns = {c.path_in_schema: c for c in (pq.ParquetFile(f).metadata.row_group(0).column(k) for k in range(5))}
        ids = next(c for n, c in columns.items() if n.startswith("token_ids"))
        assert any("DICTIONARY" in e for e in ids.encodings) and ids.has_offset_index
        assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings and columns["doc_id"].has_column_index


def test_a_doc_range_reads_no_ids_when_only_metadata_is_asked(spark, docs):
    path = scratch(spark, "t")
    token_store.write_token_table(docs, path, FILE, 2)
    plan = token_store.read_token_table(spark, path).where("doc_id between 10 and 12").select("doc_id", "start")._jdf.queryExecution().toString()
    scan = next(x for x in plan.splitlines() if "FileScan" in x and "/ids" in x or "ids]" in x)
    assert "GreaterThanOrEqual(doc_id,10)" in scan and "token_ids" not in scan[scan.index("ReadSchema") :]


def test_query(spark, sf, docs, tokenizer):
    rows = {r.doc_id: r for r in op1_token_store(spark, sf).collect()}
    start = 0
    for r in sorted(docs.select("doc_id", "text").collect()):
        want = ids_of(tokenizer, r.text)
        assert (rows[r.doc_id].start, rows[r.doc_id].n_tokens) == (start, len(want))
        start += len(want)


def test_other_tokenizer_files_have_their_texts_encoded_whole():
    from tokenizers import Tokenizer

    path = tokenizer_file("byte_bpe_50k.json")
    encoder, plain = token_store.WordEncoder(path), Tokenizer.from_file(path)
    assert not encoder.by_word and token_store.WordEncoder(FILE).by_word
    texts = ["Two  words\n and more", None, "", "É é <|endoftext|>"]
    ids, counts = encoder.encode(pa.array(texts))
    want = [plain.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert counts.tolist() == list(map(len, want)) and ids.tolist() == sum(want, [])


def test_one_doc_id_with_most_rows_is_dealt_out(spark, tokenizer):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = [(7 if k % 3 else k, f"text {k}" if k % 2 else "same") for k in range(600)]
    path = scratch(spark, "t")
    token_store.write_token_table(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), path, FILE, 2)
    out = sorted((r.start, r.doc_id, r.n_tokens) for r in token_store.read_token_table(spark, path).collect())
    assert [r[1] for r in out] == sorted(r[0] for r in rows)
    assert all(a[0] + a[2] == b[0] for a, b in zip(out, out[1:])) and out[0][0] == 0
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = spark.read.parquet(f"{path}/ids").where("doc_id = 7").select("part").distinct().count()
    assert parts > 1


def test_query_crc_on_the_given_table(spark, sf, tokenizer):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op1_token_store(spark, sf).collect()
    assert len(rows) == len(docs)
    assert all(r.ids_crc32 == zlib.crc32(np.array(ids_of(tokenizer, docs[r.doc_id]), "<u4").tobytes()) for r in rows)
