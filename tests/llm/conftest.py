import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, fp long, run int, h long, keep_id long, node long, b long, rate double, p double, lang_pred string, copy int, copies int, domain string, w string, part int"


def doc_rows(texts, lang=None):
    out = []
    for k, t in enumerate(texts):
        out.append((k, t, lang[k] if lang else "en", "s", 0, 0.5, 1, 2, 3, 4, 5, 6, 0.5, 0.5, "zz", 1, 1, "x", "w", 0))
    return out


EDGE = [
    None,
    "",
    " \t\n ",
    "A",
    "a",
    "Same text of words here",
    "same TEXT of words here",
    "ÄÖ stays Ä",
    "äö stays ä",
    "!!! ... ***",
    "don't it's a<|endoftext|>b x²　y ▁u  two  blanks ",
    "日本語 mixed 한국어 é é",
    "word " * 5000,
    "x" * 3000,
    "nul\u0001 tab\tline\nvt\x0bff\x0ccr\r end",
]


@pytest.fixture(scope="module")
def edge(spark):
    """Nulls, blanks, ties, repeats, long texts; columns with the names that the
    operators use inside."""
    return spark.createDataFrame(doc_rows(EDGE), DOCS).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
