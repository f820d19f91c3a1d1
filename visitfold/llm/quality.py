"""Quality rules on repetition inside a text, from suffix arrays over words.

Texts of an Arrow batch are concatenated and their suffixes sorted together by prefix
doubling; ranks start with the document, so texts never meet. The longest match of a word
position is the larger of the common prefixes with its neighbours in suffix order: the
height of the innermost longest-common-prefix interval around it. Spans of at least
``min_words`` are the maximal repeated substrings; their union is the covered part.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from visitfold.llm.common import boxed, offsets

# The limits that the query states.
LEAST_WORDS = 50
MOST_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"

MIN_REPEAT_WORDS = 10
MOST_COVERED = 0.4
MOST_LONGEST = 0.2

#: Texts are taken together until they have so many words; a longer text goes alone.
CHUNK_WORDS = 100_000

METRICS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "longest_repeat long, n_covered long, base_failed boolean, kept boolean"
)


def suffix_ranks(words: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Ranks of the first 1, 2, 4, ... words of every suffix.

    Equal ranks mean equal words; a suffix cut short by its text's end (``ends``, for every
    position) equals no other. Positions whose rank is already unique are not sorted again.
    """
    n = len(words)
    _, first, counts = np.unique(words, return_inverse=True, return_counts=True)
    rank = offsets(counts)[:-1][first]
    levels, step, open_ = [rank], 1, np.flatnonzero(counts[first] > 1)
    while len(open_):
        after = open_ + step
        second = np.where(after < ends[open_], rank[np.minimum(after, n - 1)] + 1, 0)
        head = rank[open_]
        order = np.lexsort((second, head))
        head, second, at = head[order], second[order], open_[order]
        new_head = np.concatenate(([True], head[1:] != head[:-1]))
        new_pair = new_head | np.concatenate(([True], second[1:] != second[:-1]))
        # a cut suffix differs from all others, also from one cut at the same length elsewhere
        new_pair |= second == 0
        place = np.arange(len(at))
        start = np.maximum.accumulate(np.where(new_head, place, 0))
        group = np.maximum.accumulate(np.where(new_pair, place, 0))
        rank = rank.copy()
        rank[at] = head + group - start
        levels.append(rank)
        lone = new_pair & np.concatenate((new_pair[1:], [True]))
        open_ = np.sort(at[~lone])
        step *= 2
    return levels


def longest_matches(levels: list[np.ndarray], ends: np.ndarray) -> np.ndarray:
    """For every position, how many words from there occur at another position too."""
    order = np.argsort(levels[-1], kind="stable")
    left, right = order[:-1].copy(), order[1:].copy()
    common = np.zeros(len(left), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = (left + common + (1 << k) <= ends[left]) & (right + common + (1 << k) <= ends[right])
        pairs = np.flatnonzero(inside)
        same = levels[k][left[pairs] + common[pairs]] == levels[k][right[pairs] + common[pairs]]
        common[pairs[same]] += 1 << k
    best = np.zeros(len(order), np.int64)
    best[left] = common
    best[right] = np.maximum(best[right], common)
    return best


def covered(starts: np.ndarray, lengths: np.ndarray, n: int) -> np.ndarray:
    """Positions inside any span."""
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + lengths, -1)
    return np.cumsum(marks[:-1]) > 0


def measure(texts: list[list[bytes]], min_words: int) -> dict[str, np.ndarray]:
    """Repetition figures of tokenised texts."""
    sizes = np.array([len(words) for words in texts], np.int64)
    out = {name: np.zeros(len(texts), np.int64) for name in ("repeat", "longest", "covered")}
    n = int(sizes.sum())
    if not n:
        return out
    ids: defaultdict[bytes, int] = defaultdict(count().__next__)
    flat = np.fromiter((ids[word] for words in texts for word in words), np.int64, n)
    text = np.repeat(np.arange(len(texts)), sizes)
    ends = np.repeat(offsets(sizes)[1:], sizes)
    levels = suffix_ranks(text * len(ids) + flat, ends)
    best = longest_matches(levels, ends)
    bounds = offsets(sizes)[:-1][sizes > 0]
    total = lambda values: np.add.reduceat(values.astype(np.int64), bounds)
    starts = np.flatnonzero(best >= 3)
    out["repeat"][sizes > 0] = total(covered(starts, np.full(len(starts), 3), n))
    starts = np.flatnonzero(best >= min_words)
    out["covered"][sizes > 0] = total(covered(starts, best[starts], n))
    out["longest"][sizes > 0] = np.maximum.reduceat(best, bounds)
    return out


def repeated_lines(text: bytes) -> int:
    seen: set[bytes] = set()
    lines = [line for line in text.split(b"\n") if line.strip(b" \t\n\r\x0b\x0c")]
    seen.update(lines)
    return len(lines) - len(seen)


def quality(
    docs: DataFrame,
    text: str = "text",
    min_words: int = MIN_REPEAT_WORDS,
    most_covered: float = MOST_COVERED,
    most_longest: float = MOST_LONGEST,
    chunk_words: int = CHUNK_WORDS,
) -> DataFrame:
    """Every document as ``doc`` (its row) with its figures and ``kept``.

    ``longest_repeat`` is the longest run of words found twice, ``n_covered`` the words
    inside repeated runs of at least ``min_words``. A document fails the base with fewer
    than 50 words or more than half its words in repeated three-word windows; it fails the
    method if runs cover more than ``most_covered`` of it, or if one run of at least
    ``min_words`` is longer than ``most_longest`` of it.

    Whole texts are read. Null and empty texts have no words and fail the base. Repeated
    rows are judged alike. Memory follows the larger of a chunk and the longest text.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("doc").field(place)
            begin = 0
            while begin < batch.num_rows:
                texts: list[list[bytes]] = []
                lines, chars, symbols, held = [], [], [], 0
                while begin + len(texts) < batch.num_rows and (not texts or held < chunk_words):
                    one = (raw[begin + len(texts)].as_py() or "").encode()
                    words = one.split()
                    as_text = b"".join(words).decode("utf-8", "replace")
                    chars.append(len(as_text))
                    symbols.append(sum(map(as_text.count, SYMBOLS)))
                    lines.append(repeated_lines(one))
                    texts.append(words)
                    held += len(words)
                found = measure(texts, min_words)
                size = np.array([len(words) for words in texts], np.int64)
                failed = (size < LEAST_WORDS) | (100 * found["repeat"] > MOST_REPEAT_PERCENT * size)
                long_run = (found["longest"] >= min_words) & (found["longest"] > most_longest * size)
                kept = ~failed & ~(found["covered"] > most_covered * size) & ~long_run
                part = batch.slice(begin, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc"),
                        *map(pa.array, (size, chars, symbols, lines, found["repeat"])),
                        *map(pa.array, (found["longest"], found["covered"], failed, kept)),
                    ],
                    names=["doc", *(field.split()[0] for field in METRICS.split(", "))],
                )
                begin += len(texts)

    place = docs.columns.index(text)
    rows = docs.select(boxed(docs).alias("doc"))
    doc_type = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc {doc_type}, {METRICS}")
