"""Word, line and repetition counts of whole texts, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicewright.llm.common import GAP, WORD


def with_counts(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` and ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``.

    Each array is a column of its own, so that no lambda works it out anew.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda line: line.rlike(WORD))
    out = docs.withColumns(
        {
            "_words": F.expr(f"regexp_extract_all(coalesce(`{text}`, ''), r'{WORD}', 0)"),
            "_lines": lines,
            "word_chars": F.length(F.regexp_replace(body, GAP, "")).cast("long"),
            "n_symbols": (F.length(body) - F.length(F.translate(body, "#*$%&|<>", ""))).cast("long"),
        }
    )
    out = out.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_windows": _windows(F.col("_words")),
        }
    )
    out = out.withColumn("_sorted", F.array_sort("_windows"))
    out = out.withColumn("_again", _repeated(F.col("_sorted")))
    covered = F.size(F.array_distinct(F.flatten(F.transform("_again", lambda p: F.array(p, p + 1, p + 2)))))
    return out.withColumn("n_repeat_words", covered.cast("long")).drop("_words", "_lines", "_windows", "_sorted", "_again")


def _windows(words: Column) -> Column:
    """Three words in a row and their place; words hold no blank, so joining them is unambiguous."""
    second, third = F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), F.slice(words, 3, F.greatest(F.size(words), F.lit(1)))
    rows = F.filter(F.arrays_zip(words.alias("a"), second.alias("b"), third.alias("c")), lambda x: x["c"].isNotNull())
    return F.transform(rows, lambda x, i: F.struct(F.concat_ws(" ", x["a"], x["b"], x["c"]).alias("w"), i.alias("p")))


def _repeated(ordered: Column) -> Column:
    """Places of the windows that equal the one before or after them in sorted order."""
    texts = F.transform(ordered, lambda x: x["w"])
    after = F.concat(F.slice(texts, 2, F.greatest(F.size(texts), F.lit(1))), F.array(F.lit(None).cast("string")))
    before = F.concat(F.array(F.lit(None).cast("string")), texts)
    rows = F.arrays_zip(ordered.alias("x"), before.alias("b"), after.alias("a"))
    kept = F.filter(rows, lambda r: r["x"].isNotNull() & (r["x"]["w"].eqNullSafe(r["b"]) | r["x"]["w"].eqNullSafe(r["a"])))
    return F.transform(kept, lambda r: r["x"]["p"])
