"""

Fixed values: a word is a run of Unicode letters; a "word character" for the ``i`` -> ``I``
fix is a letter, digit, combining mark or underscore.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K

WORD_RE = r"(\p{L}+)"
LONE_I_RE = r"(?<![\p{L}\p{N}\p{M}_])" + K.LONE_LOWER_I + r"(?![\p{L}\p{N}\p{M}_])"
NEWLINE_RE = r"\r\n|\r|\n"


def top_words(docs: DataFrame, k: int = K.TOP_WORDS, text: str = "text") -> DataFrame:
    """(n, word) of the ``k`` commonest words, case-folded; ties by word desc.

    Counting is a partial + final hash aggregate, so a very common word costs one row per task
    before the shuffle."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit(WORD_RE), 1)).alias("word"))
    per = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return per.orderBy(F.col("n").desc(), F.col("word").desc()).limit(k).select("n", "word")


def sentences(docs: DataFrame, order: str, text: str = "text") -> DataFrame:
    """(order, pos, sentence): '.'-separated sentences, newlines as spaces, trimmed, empty ones dropped.
    A sentence never spans two documents (D21)."""
    flat = F.regexp_replace(F.col(text), NEWLINE_RE, " ")
    parts = docs.select(order, F.posexplode(F.split(flat, r"\.")).alias("pos", "sentence"))
    return (parts.select(order, (F.col("pos") + 1).alias("pos"), F.trim(F.col("sentence")).alias("sentence"))
            .filter(F.col("sentence") != ""))


def first_sentences(docs: DataFrame, order: str, n: int = K.FIRST_SENTENCES, text: str = "text") -> DataFrame:
    """The first ``n`` sentences of the book in order.

    Every document that has a sentence contributes at least one, so the first ``n`` sentences lie
    in the first ``n`` such documents: a top-n of one scan keeps them (``n`` texts a task), and only
    they are split."""
    first_docs = docs.filter(F.col(text).rlike("[^. \\r\\n]")).select(order, text).orderBy(order).limit(n)
    return sentences(first_docs, order, text).orderBy(order, "pos").limit(n)


def fix_lowercase_i(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every standalone word ``i`` replaced by ``I`` (D22); documents keep their order column."""
    return docs.withColumn(text, F.regexp_replace(F.col(text), LONE_I_RE, K.UPPER_I))
