"""Word count with separators and stop words.

Each line is split on any of the separator characters; every token is trimmed
(Java-style: all characters up to U+0020 at the ends) and lower-cased; empty
tokens and stop words are dropped; the rest are counted. Whole texts are
tokenized: no prefix, sample or cap.

Plan: scan -> cut long texts into pieces at separators -> explode(split) ->
partial count of the raw tokens per task -> shuffle on the token -> normalize
each distinct token once -> filter -> count per word. A frequent word costs one
partial row per task. Stop words are removed by one anti join; Spark chooses
how by their size.

A piece ends at a separator, so no token is cut and no text is too long for a
task. For input in few splits (one large file, one row group) the caller can name
the number of ``partitions`` to spread the pieces over before they are split:
one huge text then goes to many tasks, a piece to each. Plain text files are
better read by ``sources.read_text_pieces``, which cuts them while reading.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.functions.text import normalize_token, normalize_word, separator_pattern, text_pieces

# Default separators and stop words.
DEFAULT_SEPARATORS = " "
DEFAULT_STOP_WORDS = ("the",)

#: Characters of a text that one task splits at once, about.
PIECE_CHARS = 1 << 20


def word_count(
    lines: DataFrame,
    separators: str = DEFAULT_SEPARATORS,
    stop_words: Iterable[str] = DEFAULT_STOP_WORDS,
    text_col: str = "value",
    partitions: int | None = None,
    piece_chars: int = PIECE_CHARS,
) -> DataFrame:
    """``word string, count bigint`` over every line of ``text_col``.

    Texts are cut at separators into pieces of about ``piece_chars`` characters;
    ``partitions`` spreads the pieces evenly over that many tasks first.
    """
    stops = sorted({normalize_word(w) for w in stop_words})
    pieces = lines.select(F.explode(text_pieces(F.col(text_col), separators, piece_chars)).alias("text"))
    if partitions:
        pieces = pieces.repartition(partitions)
    # Tokens are counted as they are, and only distinct ones are normalized.
    tokens = pieces.select(F.explode(F.split("text", separator_pattern(separators))).alias("token"))
    raw = tokens.where(F.length("token") > 0).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    words = raw.select(normalize_token(F.col("token")).alias("word"), "n").where(F.length("word") > 0)
    if stops:
        stop_df = lines.sparkSession.createDataFrame([(w,) for w in stops], "word string")
        words = words.join(stop_df, "word", "left_anti")
    return words.groupBy("word").agg(F.sum("n").alias("count"))


def format_counts(counts: DataFrame) -> DataFrame:
    """``(word,count)`` text lines, the tuple form of the word-count output."""
    return counts.select(F.format_string("(%s,%d)", "word", "count").alias("value"))
