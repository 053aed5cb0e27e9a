"""Word count: separators, stop words and edge cases."""

from __future__ import annotations

from gridpulse.functions.text import separator_pattern
from gridpulse.operators.words import DEFAULT_STOP_WORDS, word_count
from gridpulse.plans.registry import TEST_SEPARATORS, TEST_STOP_WORDS


def _counts(spark, lines, **kw):
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    return {r.word: r["count"] for r in word_count(df, **kw).collect()}


# Input of the word-count test case.
LINES = ["How happy was the panda? You ask.", "Panda is the most happy panda in all the#!?ing land!"]


def test_separators_and_stop_words(spark):
    counts = _counts(spark, LINES, separators=TEST_SEPARATORS, stop_words=TEST_STOP_WORDS)
    once = dict.fromkeys(["all", "ask", "how", "ing", "is", "land", "most", "you"], 1)
    assert counts == once | {"happy": 2, "panda": 3}


def test_defaults_split_on_space_and_drop_the(spark):
    counts = _counts(spark, ["The cat saw the  dog.", "the"])
    assert DEFAULT_STOP_WORDS == ("the",)
    assert counts == {"cat": 1, "saw": 1, "dog.": 1}


def test_java_trim_inner_newline_and_upper_stop_word(spark):
    # a leading tab is trimmed (it is not a separator); an inner newline stays
    counts = _counts(spark, ["\tAlpha beta\ngamma  THE The"], stop_words=[" The "])
    assert counts == {"alpha": 1, "beta\ngamma": 1}


def test_regex_characters_as_separators(spark):
    counts = _counts(spark, ["a]b^c-d\\e[f&g"], separators="]^-\\[&", stop_words=())
    assert counts == {k: 1 for k in "abcdefg"}
    assert separator_pattern("]^") == "[\\]\\^]"


def test_null_and_empty_lines(spark):
    df = spark.createDataFrame([(None,), ("",), ("   ",), ("x x",)], "value string")
    assert {r.word: r["count"] for r in word_count(df).collect()} == {"x": 2}


def test_whole_long_text_is_counted(spark):
    text = " ".join(["tok"] * 20000 + ["end"])
    counts = _counts(spark, [text])
    assert counts == {"tok": 20000, "end": 1}


def test_long_stop_list(spark):
    counts = _counts(spark, ["keep drop w3 keep"], stop_words=[f"w{i}" for i in range(50_001)] + ["drop"])
    assert counts == {"keep": 2}


def test_building_the_plan_starts_no_job(spark):
    grouped = spark.range(1000).selectExpr("cast(id % 7 as string) word").groupBy("word").count()
    tracker = spark.sparkContext.statusTracker()
    before = set(tracker.getJobIdsForGroup(None))
    df = word_count(grouped, text_col="word", partitions=3)
    assert set(tracker.getJobIdsForGroup(None)) == before
    assert df.count() == 7


def test_text_column_names_do_not_clash(spark):
    df = spark.createDataFrame([("a b a", "x", 1)], "text string, word string, count int")
    assert {r.word: r["count"] for r in word_count(df, text_col="text").collect()} == {"a": 2, "b": 1}
    assert {r.word: r["count"] for r in word_count(df, text_col="word").collect()} == {"x": 1}
