"""Passages of many words that occur twice, by rolling hashes of every window.

Every window of ``window`` words has a Rabin-Karp hash, counted in Spark; windows seen twice
merge into maximal intervals, which are removed. So that not every window has to be
shuffled, windows are first grouped by their least ``gram``: of all runs of ``gram`` words in
a window, that with the smallest hash. Equal windows have equal least grams, neighbouring
windows mostly the same one, and a window whose least gram occurs once in the corpus is
unique without being counted itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitfold.llm.common import carried, offsets, settle, sifted, utf8

# Fixed value: the window that the query states.
WINDOW = 35
GRAM = 16
#: Words whose hashes a task remembers.
MEMO_WORDS = 250_000

# Odd multipliers of the rolling hashes modulo 2^64, from the golden ratio, pi and e.
GRAM_BASE, WINDOW_BASE, CHECK_BASE = 0x9E3779B97F4A7C15, 0x3243F6A8885A308D, 0x2B7E151628AED2A7
CHECK_BITS = 24


class Words:
    """Hash codes of a text's words."""

    def __init__(self) -> None:
        self.memo: dict[bytes, int] = {}

    def codes(self, words: list[bytes]) -> np.ndarray:
        memo = self.memo
        if len(memo) > MEMO_WORDS:
            memo.clear()
        for word in set(words).difference(memo):
            memo[word] = xxhash.xxh64_intdigest(word)
        return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


class Powers:
    """Powers of a base and of its inverse modulo 2^64, as many as were needed so far."""

    def __init__(self, base: int) -> None:
        self.factors = [np.uint64(base), np.uint64(pow(base, -1, 1 << 64))]
        self.held = [np.ones(1, np.uint64)] * 2

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.held[0]) < n:
            size = 2 * n
            for k, factor in enumerate(self.factors):
                some = np.full(size, factor, np.uint64)
                some[0] = 1
                self.held[k] = np.cumprod(some)
        return self.held[0][:n], self.held[1][:n]


POWERS = {base: Powers(base) for base in (GRAM_BASE, WINDOW_BASE, CHECK_BASE)}


def rolling(codes: np.ndarray, width: int, base: int) -> np.ndarray:
    """A mixed polynomial hash of every ``width`` consecutive codes."""
    power, inverse = POWERS[base].upto(len(codes))
    before = np.concatenate((np.zeros(1, np.uint64), np.cumsum(codes * power)))
    out = (before[width:] - before[:-width]) * inverse[: len(codes) - width + 1]
    out ^= out >> np.uint64(31)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(29))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of every ``width`` consecutive values."""
    least, held = values, 1
    while 2 * held <= width:
        least = np.minimum(least[:-held], least[held:])
        held *= 2
    rest = width - held
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def least_grams(codes: np.ndarray, window: int, gram: int) -> np.ndarray:
    """The hash of the least gram of every window."""
    return sliding_least(rolling(codes, gram, GRAM_BASE), window - gram + 1)


def gram_places(codes: np.ndarray, window: int, gram: int) -> np.ndarray:
    """Least grams of a text, one for each run of windows that share it.

    A gram that the text has twice is given twice, as windows of one run may then be equal.
    """
    if len(codes) < window:
        return np.empty(0, np.uint64)
    grams = rolling(codes, gram, GRAM_BASE)
    least = sliding_least(grams, window - gram + 1)
    once = least[np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))]
    grams.sort()
    twice = grams[1:][grams[1:] == grams[:-1]]
    return np.concatenate((once, once[np.isin(once, twice)])) if len(twice) else once


def text_key(docs: DataFrame, text: str) -> list[Column]:
    """Two hashes that name a text; a null text is an empty one."""
    content = F.coalesce(docs[f"`{text}`"].cast("string"), F.lit(""))
    return [F.xxhash64(content).alias("t1"), F.xxhash64(F.lit(1), content).alias("t2")]


def _grams(docs: DataFrame, text: str, window: int, gram: int) -> DataFrame:
    """A row for each document: uid, t1, t2, grams. Numbers are given where rows are read."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, made = Words(), TaskContext.get().partitionId() << 36
        for batch in batches:
            raw = batch.column("text")
            for a in range(0, batch.num_rows, 500):
                found = [
                    gram_places(words.codes(raw[i].as_py().split()), window, gram)
                    for i in range(a, min(a + 500, batch.num_rows))
                ]
                n = len(found)
                ends = offsets(np.array([len(one) for one in found], np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(made, made + n)),
                        batch.column("t1").slice(a, n),
                        batch.column("t2").slice(a, n),
                        pa.ListArray.from_arrays(
                            pa.array(ends, pa.int32()), pa.array(np.concatenate(found).view(np.int64))
                        ),
                    ],
                    names=["uid", "t1", "t2", "grams"],
                )
                made += n

    rows = docs.select(*text_key(docs, text), utf8(docs[f"`{text}`"]).alias("text"))
    return rows.mapInArrow(work, "uid long, t1 long, t2 long, grams array<long>")


def _windows(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """uid, hash and place (24 further hash bits, then the start) of windows with a shared gram."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in batches:
            raw, grams, uid = batch.column("text"), batch.column("grams"), batch.column("uid")
            for i in range(batch.num_rows):
                codes = words.codes(raw[i].as_py().split())
                shared = grams[i].values.to_numpy().view(np.uint64)
                at = np.flatnonzero(np.isin(least_grams(codes, window, gram), shared))
                check = rolling(codes, window, CHECK_BASE)[at] >> np.uint64(64 - CHECK_BITS)
                found = rolling(codes, window, WINDOW_BASE)[at]
                place = (check.astype(np.int64) << 32) | at
                for b in range(0, len(at), 100_000):
                    some = slice(b, b + 100_000)
                    n = len(at[some])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.full(n, uid[i].as_py())),
                            pa.array(found[some].view(np.int64)),
                            pa.array(place[some]),
                        ],
                        names=["uid", "hash", "place"],
                    )

    return texts.select("uid", "grams", "text").mapInArrow(work, "uid long, hash long, place long")


def repeated_windows(
    docs: DataFrame, text: str = "text", window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """t1, t2, whole, starts for each text with a window that also starts elsewhere.

    ``starts`` are the word positions where such windows begin. A text that several rows have
    is ``whole``: each of its windows occurs in the other rows, so starts are not listed, and
    one row stands for all of them when others are compared.
    """
    rows = settle(_grams(docs, text, window, gram), "grams")
    texts = rows.groupBy("t1", "t2").agg(F.min("uid").alias("uid"), (F.count("*") > 1).alias("whole"))
    texts = settle(texts, "texts")
    each = rows.join(texts.select("uid"), "uid", "left_semi").select("uid", F.explode("grams").alias("least"))
    shared = each.groupBy("least").agg(F.count("*").alias("n")).where("n > 1").select("least")
    shared = settle(shared, "shared")  # a table of its own, so that a join splits a hot gram
    wanted = each.distinct().join(shared, "least").groupBy("uid").agg(F.collect_list("least").alias("grams"))
    wanted = settle(texts.select("uid", "t1", "t2").join(wanted, "uid"), "candidates")
    with_text = docs.select(*text_key(docs, text), utf8(docs[f"`{text}`"]).alias("text"))
    # copies meet inside each input task first, so a text that very many rows have is no burden
    once = sifted(with_text, wanted, ["t1", "t2"]).dropDuplicates(["t1", "t2"]).join(wanted, ["t1", "t2"])
    windows = settle(_windows(once, window, gram), "windows")
    key = windows.withColumn("check", F.shiftright("place", 32).cast("int"))
    repeated = key.groupBy("hash", "check").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    repeated = settle(repeated, "seen-twice")
    start = F.col("place").bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
    starts = (
        key.join(repeated, ["hash", "check"])
        .groupBy("uid")
        .agg(F.collect_list(start).alias("starts"))
    )
    none = F.array().cast("array<int>")
    found = (
        texts.join(starts, "uid", "left")
        .where("whole OR starts IS NOT NULL")
        .select("t1", "t2", "whole", F.when(F.col("whole"), none).otherwise(F.col("starts")).alias("starts"))
    )
    return settle(found, "repeated")


def keep(words: list[bytes], starts: np.ndarray | None, window: int) -> tuple[bytes, int]:
    """The words outside all windows, joined by spaces, and how many go; None is every window."""
    if starts is None:
        return (b"", len(words)) if len(words) >= window else (b" ".join(words), 0)
    marks = np.zeros(len(words) + 1, np.int64)
    marks[starts] += 1
    np.subtract.at(marks, starts + window, 1)
    gone = np.cumsum(marks[:-1]) > 0
    return b" ".join([word for word, out in zip(words, gone.tolist()) if not out]), int(gone.sum())


def remove_repeats(
    docs: DataFrame,
    text: str = "text",
    window: int = WINDOW,
    gram: int = GRAM,
    columns: list[str] | None = None,
) -> DataFrame:
    """Every row as ``doc`` with n_words, n_removed and ``kept``: its text without repeated windows.

    ``doc`` has all columns but the text, or those given.

    A word goes if a window of ``window`` words around it also starts anywhere else, in the
    same text too; that is judged on the texts as given. ``kept`` are the other words, joined
    by one space. Windows are equal if 88 bits of hash are. Null and empty texts have no
    words; shorter texts lose none; each of several rows with one text is elsewhere for the
    others, so they lose all their windows.
    """
    if not 1 <= gram <= window:
        raise ValueError("a gram has at least one word and fits a window")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, whole, starts = (batch.column(name) for name in ("text", "whole", "starts"))
            for a in range(0, batch.num_rows, 500):
                kept, removed, size = [], [], []
                for i in range(a, min(a + 500, batch.num_rows)):
                    words = raw[i].as_py().split()
                    size.append(len(words))
                    if not whole[i].is_valid:
                        kept.append(b" ".join(words))
                        removed.append(0)
                        continue
                    places = None if whole[i].as_py() else starts[i].values.to_numpy()
                    left, n = keep(words, places, window)
                    kept.append(left)
                    removed.append(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc").slice(a, len(size)),
                        pa.array(size, pa.int64()),
                        pa.array(removed, pa.int64()),
                        pa.array(kept, pa.binary()),
                    ],
                    names=["doc", "n_words", "n_removed", "kept"],
                )

    found = repeated_windows(docs, text, window, gram)
    rows = docs.select(
        carried(docs, columns, text).alias("doc"), *text_key(docs, text), utf8(docs[f"`{text}`"]).alias("text")
    )
    joined = rows.join(found, ["t1", "t2"], "left").select("doc", "text", "whole", "starts")
    doc_type = joined.schema["doc"].dataType.simpleString()
    out = joined.mapInArrow(work, f"doc {doc_type}, n_words long, n_removed long, kept binary")
    return out.withColumn("kept", F.col("kept").cast("string"))
