import hashlib
import re

import pytest
from pyspark.sql import functions as F

from panelweave.llm import fim
from panelweave.llm.fim_queries import OP12_SQL, op12_fill_in_middle
from tests.oracle import assert_same, duck

#: The grammars once more, as Python expressions.
PLAIN = {
    "word": r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+",
    "line": r"[^\n]*\n|[^\n]+",
    "character": r"[\s\S]",
    "run": r"[^\W\d_]+|\d+|[ \t-\r]+|[^\w \t-\r]|_",
}
TEXTS = ["", " ", "a", " a", "a ", "  a\t\nb  ", "one two  three\n\nfour\x0bfive", "a b 　c", "😀😀 é é😀 x", "\n\n", "x\r\ny", "12ab, c_3!!  ß日本", "a<P> b c d e f g", "w " * 30000, "z" * 100000]


def python_version(doc_id, text):
    text = text or ""
    units = re.findall(PLAIN["word"], text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    if h[3] % 100 < 80:
        return n, "spm", p, m, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", p, m, f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("grammar", fim.GRAMMARS)
def test_units_are_those_of_the_grammar(spark, grammar):
    df = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    for t, got in df.select("t", fim.units(F.col("t"), grammar)).collect():
        assert "".join(got) == t and got == re.findall(PLAIN[grammar], t)


def test_border_of_words_is_one_pair_of_classes():
    assert fim.boundary(fim.GRAMMARS["word"]) == r"(?<=[^ \t-\r])(?![\uDC00-\uDFFF])(?=[ \t-\r])"


def test_every_form_against_plain_python_and_back(spark):
    rows = [(k, t) for k, t in enumerate(TEXTS * 12)] + [(None, "a b c d"), (None, None), (5, "again twice"), (5, "again twice"), (2**62, "ab <S> c"), (-3, "neg ative id")]
    got = fim.transform(spark.createDataFrame(rows, "doc_id long, text string"))
    out = got.withColumn("back", fim.restore(F.col("output"), F.col("form"))).collect()
    assert len(out) == len(rows) and {r.form for r in out} == {"plain", "psm", "spm"}
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "", r[2:])
    assert sorted(((r.doc_id, r.text, r.n, r.form, r.prefix, r.middle, r.output) for r in out), key=key) == sorted(((d, t, *python_version(d, t)) for d, t in rows), key=key)
    assert all(r.back == (r.text or "") for r in out)


def test_odd_tables(spark, edge, nothing):
    clash = edge.withColumns({"n": F.lit(1), "form": F.lit("f"), "output": F.lit("o"), "prefix": F.lit("p")})
    got = fim.transform(clash)
    assert got.columns == [*clash.columns, "n_", "form_", "prefix_", "middle", "suffix", "output_"]
    assert got.count() == edge.count() and fim.transform(nothing).count() == 0
    assert {r.n for r in got.collect()} == {1}


def test_no_shuffle_and_no_python(spark, docs):
    plan = fim.transform(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


def test_query(spark, sf):
    assert_same(op12_fill_in_middle(spark, sf), duck(sf).sql(OP12_SQL))
