import numpy as np
import pytest

from panelweave.llm import pieces
from panelweave.llm.queries import op8_sentencepiece, tokenizer_file

FILE = tokenizer_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def table():
    return pieces.PieceTable(FILE)


@pytest.fixture(scope="module")
def library():
    """The same pieces and scores, read by the library as a unigram model."""
    import sentencepiece

    raw = open(FILE, "rb").read()
    assert raw.count(b"\x18\x02 \x80\xfa\x01") == 1
    return sentencepiece.SentencePieceProcessor(model_proto=raw.replace(b"\x18\x02 \x80\xfa\x01", b"\x18\x01 \x80\xfa\x01"))


TEXTS = ["Hello world", "a  b", " lead", "trail ", "x", "日本語 é é naïve", "tab\there\nnewline", "unhappiness internationalization", "   ", "😀 emoji ok", "aaaaaaaaaaaaaaaaaaaa", "Zzzyxq..??!!"]


def split(ids, counts):
    ends = np.cumsum(counts)
    return [ids[e - n : e].tolist() for n, e in zip(counts, ends)]


def brute(table, text):
    """Best sum of scores by plain dynamic programming over one whole text."""
    score = {}
    for h, s, k in zip(table.hashes, table.scores, table.ids):
        score[table.pieces[k]] = s
    t = "▁" + text.replace(" ", "▁")
    best = [0.0] + [-np.inf] * len(t)
    for e in range(1, len(t) + 1):
        for b in range(max(0, e - 16), e):
            s = score.get(t[b:e], table.unknown if e - b == 1 else -np.inf)
            best[e] = max(best[e], best[b] + s)
    return best[-1]


def test_sums_are_the_best_possible(table, docs):
    texts = TEXTS + [r.text[:300] for r in docs.where("text is not null").limit(40).collect()]
    score = dict(zip(table.ids.tolist(), table.scores.tolist()))
    for t, ids in zip(texts, split(*table.encode(texts))):
        got, k = 0.0, 0
        while k < len(ids):
            if ids[k] in score:
                got, k = got + score[ids[k]], k + 1
            else:  # the bytes of one uncovered character
                first = int(table.pieces[ids[k]][1:-1], 16)
                got, k = got + table.unknown, k + (1 if first < 128 else 2 if first < 224 else 3 if first < 240 else 4)
        assert abs(got - brute(table, t)) < 1e-3, t


def test_same_ids_as_the_library(table, library, docs):
    """Against the library's exact lattice search; equal sums may be cut either way."""
    words = {w for r in docs.limit(60).collect() for w in (r.text or "").split()}
    texts = sorted(words)[:3000]
    total = lambda ids: sum(library.get_score(k) for k in ids)
    same = 0
    for t, ids in zip(texts, split(*table.encode(texts))):
        best = library.nbest_encode_as_ids(t, 2)[0]
        same += ids == best
        assert ids == best or abs(total(ids) - total(best)) < 1, t
    assert same > 0.99 * len(texts)


def test_round_trip(table, edge):
    texts = [t for t in TEXTS] + ["", "mixed\u0000nul", " "]
    assert table.decode(*table.encode(texts)) == texts
    rows = {r.doc_id: r for r in pieces.encode_documents(edge, FILE).collect()}
    assert rows[0].n_pieces == 0 and rows[1].n_pieces == 0 and rows[0].round_trip
    assert {k for k, r in rows.items() if not r.round_trip} == {10}  # it holds the blank's own sign
    assert len(rows) == edge.count()


def test_empty_table_and_query(spark, sf, nothing, docs):
    assert pieces.encode_documents(nothing, FILE).count() == 0
    out = op8_sentencepiece(spark, sf)
    assert out.count() == docs.count() and out.where("not round_trip").count() == 0
