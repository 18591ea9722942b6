import corpus_pipeline
from pyspark.sql import functions as F

from panelweave.llm.queries import table
from panelweave.llm.common import scratch

from .test_exact_dedup import UPPER
from .conftest import EDGE
from .test_similar import brute_similar


def test_stages_against_brute_force(spark, sf):
    docs = table(spark, sf, "documents")
    columns = docs.columns
    kept = {r.doc_id: r.text for r in docs.collect()}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = scratch(spark, name)
        stage(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        ids = [r.doc_id for r in docs.select("doc_id").collect()]
        if k < 4:
            assert docs.columns == columns
        if name == "language_id":
            kept = {i: t for i, t in kept.items() if any(c.isalpha() for c in t or "")}
            assert sorted(ids) == sorted(kept)
        elif name == "exact_dedup":
            best = {}
            for i, t in kept.items():
                n = (t or "").translate(UPPER)
                best[n] = max(best.get(n, -1), i)
            kept = {i: kept[i] for i in best.values()}
            assert sorted(ids) == sorted(kept)
        elif name == "simhash_near_dedup":
            order = sorted(kept)
            kept = {order[k]: kept[order[k]] for k in set(brute_similar([kept[i] for i in order]))}
            assert sorted(ids) == sorted(kept)
        elif name == "mixing":
            assert set(ids) <= set(kept)
            labels = table(spark, sf, "labels").where("quality = 1").select("doc_id").collect()
            assert {r.doc_id for r in labels} & set(kept) <= set(ids)
            before = ids
    assert sorted(ids) == sorted(before)
    assert docs.where(~F.col("round_trip")).count() == 0


def test_whole_run(spark, sf):
    out = corpus_pipeline.run(spark, sf)
    assert out.count() > 100 and {"doc_id", "piece_ids"} <= set(out.columns)


CLASH = "doc_id long, text string, lang string, lang_pred string, copies int, copy int, h long, id long, component long, rate double, p double, verdict_id int, verdict_h string, k int"


def with_clashes(spark, rows):
    return spark.createDataFrame([(i, t, "en", "zz", 7, 8, 9, 10, 11, 0.5, 0.5, 12, "v", k) for k, (i, t) in enumerate(rows)], CLASH).repartition(3)


def kept_rows(spark, stage, docs, sf):
    out = stage(spark, docs, sf)
    assert out.columns == docs.columns
    got = out.collect()
    whole = {r.k: r for r in docs.collect()}
    assert all(r.asDict() | {"lang": 0} == whole[r.k].asDict() | {"lang": 0} for r in got)
    return sorted((r.k for r in got))


def test_rows_are_known_by_doc_id_and_text(spark, sf):
    rows = [(5, "alpha A"), (9, "alpha a"), (5, "bravo"), (7, "charlie"), (7, "charlie"), (None, "delta"), (None, "delta"), (None, "echo"), (8, "echo"), (3, None), (4, ""), (6, "Foxtrot"), (6, "foxtrot")]
    docs = with_clashes(spark, rows)
    got = kept_rows(spark, corpus_pipeline.drop_exact_copies, docs, sf)
    assert [k for k in got if k in (0, 1, 2, 8, 10)] == [1, 2, 8, 10]
    # one each of the rows that repeat, and of the spellings of one doc_id
    assert len(got) == 7 and 7 not in got and 9 not in got and len({3, 4} & set(got)) == len({5, 6} & set(got)) == len({11, 12} & set(got)) == 1


def test_near_copies_of_one_doc_id(spark, sf):
    base = [f"w{k}" for k in range(60)]
    near = " ".join(["other", *base[1:]])
    rows = [(5, " ".join(base)), (5, near), (5, "bravo"), (None, near + " end"), (None, "charlie"), (2, "delta")]
    assert kept_rows(spark, corpus_pipeline.drop_near_copies, with_clashes(spark, rows), sf) in ([0, 2, 4, 5], [1, 2, 4, 5])


def test_language_and_mixing_keep_clashing_columns_and_null_ids(spark, sf):
    rows = [(None, "some words"), (None, "some words"), (1, "more words"), (1, None), (2, "!!! ***"), (2, "ok")]
    docs = with_clashes(spark, rows)
    assert kept_rows(spark, corpus_pipeline.identify_language, docs, sf) == [0, 1, 2, 5]
    got = kept_rows(spark, corpus_pipeline.mix_sources, docs.where("doc_id is null or doc_id > 99"), sf)
    assert set(got) == {0, 1}


def test_a_third_of_all_rows_on_one_doc_id_and_one_text(spark, sf):
    rows = [(7 if k % 3 else 1000 + k, "the same text" if k % 2 else f"text number {k} of many") for k in range(300)]
    docs = with_clashes(spark, rows)
    got = kept_rows(spark, corpus_pipeline.drop_exact_copies, docs, sf)
    assert len(got) == len({t for _, t in rows})
    texts = [rows[k][1] for k in got]
    near = kept_rows(spark, corpus_pipeline.drop_near_copies, docs.where(F.col("k").isin(got)), sf)
    assert len(near) == len(set(brute_similar(texts)))


def test_edge_documents_pass_every_stage(spark, edge, nothing, sf):
    for docs in (edge, nothing):
        columns = docs.columns
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            path = scratch(spark, name)
            stage(spark, docs, sf).write.parquet(path)
            docs = spark.read.parquet(path)
            assert k == 4 or docs.columns == columns
            if name == "language_id" and columns:
                left = {r.doc_id for r in docs.collect()}
                assert left in (set(), {k for k, t in enumerate(EDGE) if any(c.isalpha() for c in t or "")})
