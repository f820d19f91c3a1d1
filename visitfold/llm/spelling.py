"""Spelling variants: words one edit apart, found by asymmetric chunks, and the form they belong to.

The shorter word of a pair (of two equally long ones the smaller) is cut into two disjoint
chunks, its halves. The other gives its positional grams of the lengths that such halves
have. An edit of one code point leaves one half whole, moved by one place at most, so
chunks and grams that are equal and lie within one place of each other join every pair;
pairs are then verified by their edit distance. Grams further off can meet nothing and are
not made, nor are grams that no edit puts there: a half keeps its place between words of
equal length, and in a word that is one longer it keeps it or comes one later. Keys are
hashes, so a very long word has short ones.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitfold.llm.common import settle, utf8

# What the query states.
RUN = "[A-Za-zÀ-ÿ]+"
DAMAGED = 199
LEAST_LETTERS = 6
LEAST_COUNT = 5
FORM_TIMES = 5

#: Distinct words that a task counts before it hands them on.
HELD_WORDS = 200_000


def runs(text: bytes, number: int | None, damaged: int | None) -> Counter[str]:
    """Lower-cased runs of letters with their counts; one in ``damaged`` lacks a letter."""
    found = Counter(re.findall(RUN, text.lower().decode("utf-8", "replace")))
    if damaged is None or number is None:
        return found
    seed = zlib.crc32(b"%d:" % number)
    out: Counter[str] = Counter()
    for run, times in found.items():
        h = zlib.crc32(run.encode(), seed)
        at = h % len(run) if h % damaged == 0 else len(run)
        out[run[:at] + run[at + 1 :]] += times
    return out


def word_counts(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    damaged: int | None = None,
    least_letters: int = LEAST_LETTERS,
    least_count: int = LEAST_COUNT,
) -> DataFrame:
    """word, n: lower-cased runs of letters (A-Z only) of at least so many code points and occurrences.

    With ``damaged`` a run whose checksum with the document's id it divides lacks one letter;
    rows without an id have none of these. Null and empty texts have no words; repeated rows
    count as often as they are there.
    """

    def rows(counts: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
            names=["word", "n"],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for number, one in zip(batch.column("id"), batch.column("text")):
                for word, times in runs(one.as_py(), number.as_py(), damaged).items():
                    if len(word) >= least_letters:
                        held[word] += times
                if len(held) >= HELD_WORDS:
                    yield rows(held)
                    held = Counter()
        yield rows(held)

    slim = docs.select(docs[f"`{doc_id}`"].cast("long").alias("id"), utf8(docs[f"`{text}`"]).alias("text"))
    found = slim.mapInArrow(work, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _key(length: Column, half: int, gram: Column) -> Column:
    return F.xxhash64(length, F.lit(half), gram)


def chunks(words: DataFrame) -> DataFrame:
    """word, key, place: the two halves of every word."""
    size = F.char_length("word")
    middle = F.floor(size / 2).cast("int")
    return words.select(
        "word",
        F.inline(
            F.array(
                F.struct(_key(size, 0, F.substr("word", F.lit(1), middle)).alias("key"), F.lit(0).alias("place")),
                F.struct(_key(size, 1, F.substr("word", middle + 1)).alias("key"), middle.alias("place")),
            )
        ),
    )


def grams(words: DataFrame) -> DataFrame:
    """other, key, at: grams with the lengths of halves of words as long, or one shorter.

    Only places where an edit leaves such a half, within one of where it begins.
    """
    size = F.char_length("word")
    made = []
    for less in (0, 1):
        whole = size - less
        middle = F.floor(whole / 2).cast("int")
        for half, begin, length in ((0, F.lit(0), middle), (1, middle, whole - middle)):
            for shift in range(less + 1):
                at = begin + shift
                gram = F.substr("word", at + 1, length)
                made.append(F.struct(_key(whole, half, gram).alias("key"), at.alias("at")))
    return words.select(F.col("word").alias("other"), F.inline(F.array(*made)))


def near_words(words: DataFrame) -> DataFrame:
    """word, near: every two words of a table of distinct ones that differ by one code point, both ways."""
    within = (F.col("chunk.key") == F.col("gram.key")) & F.expr("abs(place - at) <= 1")
    shorter = F.expr("char_length(word) < char_length(other) OR word < other")
    met = chunks(words).alias("chunk").join(grams(words).alias("gram"), within).where(shorter)
    pairs = met.where(F.levenshtein("word", "other", 1) == 1).select("word", "other").distinct()
    return pairs.select(F.inline(F.expr("array(struct(word, other AS near), struct(other AS word, word AS near))")))


def forms(words: DataFrame, times: int = FORM_TIMES) -> DataFrame:
    """word, n, n_near, form, form_n, root for every row of a table of distinct words with n.

    ``form`` is the near word with the largest n (of equal ones the first in code-point
    order), null unless it has ``times`` the word's n or more; ``root`` is where following
    forms ends. A word without near words, or with rare ones only, is its own root. Counts
    grow along forms, so there are no rings. An empty table gives no rows.
    """
    words = settle(words.select("word", "n"), "words")
    near = near_words(words).join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = near.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    )
    enough = -F.col("best.less") >= times * F.col("n")
    judged = words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(enough, F.col("best.near")).alias("form"),
        F.when(enough, -F.col("best.less")).alias("form_n"),
    )
    judged = settle(judged, "forms")
    # each round follows twice as many forms: the number of rounds is the logarithm of the longest chain
    steps = judged.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        steps = settle(steps, "steps")
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if steps.join(onward, "root", "left_semi").isEmpty():
            break
        steps = steps.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
    return judged.join(steps, "word", "left").withColumn("root", F.coalesce("root", "word"))
