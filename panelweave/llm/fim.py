"""Fill-in-middle by lookaround splitting.

A unit grammar says what a unit of text looks like: alternatives, each a row of
character runs.  Where the runs of neighbouring characters decide on their own
whether a unit goes on, its border has no width: it lies between a character of
one class and one of another.  ``boundary`` translates the grammar to that
regular expression, Spark's ``split`` cuts at it and loses nothing, and a text
without characters, of which ``split`` would make one empty unit, has none.

DataFrame functions only; a text never leaves its row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh

SPACE, OTHER = r"[ \t-\r]", r"[^ \t-\r]"
#: Alternatives of a unit; a run is a character class and "*", "+" or "".
GRAMMARS = {
    "word": [[(SPACE, "*"), (OTHER, "+")], [(SPACE, "+")]],
    "line": [[(r"[^\n]", "*"), (r"\n", "")], [(r"[^\n]", "+")]],
    "character": [[(r"[\s\S]", "")]],
    "run": [[(r"\p{L}", "+")], [(r"\p{N}", "+")], [(SPACE, "+")], [(r"[^\p{L}\p{N} \t-\r]", "")]],
}
MARKS = PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


def boundary(grammar: list[list[tuple[str, str]]]) -> str:
    """The zero-width expression between two units of a grammar.

    The classes of a grammar are disjoint and cover all characters, and each
    pair of neighbours either may stand within a unit or may not, whatever is
    around it.  The border lies at the pairs that may not.
    """
    classes = list(dict.fromkeys(c for runs in grammar for c, _ in runs))
    inside = set()
    for runs in grammar:
        for k, (a, times) in enumerate(runs):
            if times:
                inside.add((a, a))
            for b, least in runs[k + 1 :]:
                inside.add((a, b))
                if least != "*":
                    break
    # a character of two UTF-16 units has no border within
    return "|".join(f"(?<={a})(?![\\uDC00-\\uDFFF])(?={b})" for a in classes for b in classes if (a, b) not in inside)


def units(text: Column, grammar: str = "word") -> Column:
    """The units of a text, end to end the text itself; none of null or ''."""
    return F.when(F.coalesce(text, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(text, boundary(GRAMMARS[grammar]), -1))


def draws(seed: int, doc_id: Column) -> list[Column]:
    """Four unsigned 32-bit numbers of a document: the first 32 hex digits of
    the SHA-256 of "seed:doc_id"; a null doc_id is written as nothing."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def transform(docs: DataFrame, grammar: str = "word", seed: int = 42, plain_from: int = 50, spm_below: int = 80) -> DataFrame:
    """Add n, form, prefix, middle, suffix, output to ``docs`` (doc_id, text).

    n counts units.  A third draw below ``plain_from`` (percent) makes a
    document "spm" or "psm", by the fourth, below ``spm_below`` percent; else it
    is "plain", as are null and empty texts and those that hold a mark.  Prefix
    and middle end after as many units as the first two draws say.  Of plain
    documents the output is the text and the three parts are null.

    Rows come back one for one, repeated ones alike, in no new order; rows of an
    empty table are none.  Null texts count as empty.  Other columns stay; an
    added column whose name is taken gets underscores.  A row is worked on
    alone, so neither keys nor lengths of texts are skewed between tasks.
    """
    names = [fresh(c, docs) for c in ("n", "form", "prefix", "middle", "suffix", "output")]
    own, cut = fresh("own_text", docs), fresh("unit_list", docs)
    h, marked = fresh("draw", docs), F.col(own).rlike("|".join(MARKS))
    rows = docs.withColumn(own, F.coalesce("text", F.lit(""))).withColumn(h, F.array(*draws(seed, F.col("doc_id"))))
    form = F.when((F.col(own) == "") | marked | (F.col(h)[2] % 100 >= plain_from), "plain").when(F.col(h)[3] % 100 < spm_below, "spm").otherwise("psm")
    rows = rows.withColumn(names[1], form).withColumn(cut, units(F.col(own), grammar))
    rows = rows.withColumn(names[0], F.size(cut).cast("long"))
    n, split = F.col(names[0]), F.col(names[1]) != "plain"
    ends = [(F.col(h)[k] % (n + 1)).cast("int") for k in (0, 1)]
    first, last = F.least(*ends), F.greatest(*ends)
    piece = lambda start, size: F.when(split, F.array_join(F.slice(cut, start + 1, size), ""))
    zero, all_units = F.lit(0), n.cast("int")
    rows = rows.withColumns({names[2]: piece(zero, first), names[3]: piece(first, last - first), names[4]: piece(last, all_units - last)})
    p, m, s = (F.col(c) for c in names[2:5])
    psm, spm = F.concat(F.lit(PREFIX), p, F.lit(SUFFIX), s, F.lit(MIDDLE), m), F.concat(F.lit(SUFFIX), s, F.lit(PREFIX), p, F.lit(MIDDLE), m)
    rows = rows.withColumn(names[5], F.when(F.col(names[1]) == "psm", psm).when(F.col(names[1]) == "spm", spm).otherwise(F.col(own)))
    return rows.select(*docs.columns, *names)


def restore(output: Column, form: Column) -> Column:
    """The text behind an output of that form; null where either is null."""
    parts = F.split(output, "|".join(MARKS), -1)
    psm, spm = F.concat(parts[1], parts[3], parts[2]), F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).when(form == "plain", output)
