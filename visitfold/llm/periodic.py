"""Runs of periodically repeated words, from Lyndon words of both orders.

Every run has Lyndon roots: in one of the two orders of the words (by number, or the other
way round; the end of a text is smaller than all), the longest Lyndon word that starts at
any full copy of a root is that copy. The first phase of Baier's suffix sorter groups the
suffixes by just that, their longest Lyndon prefix. So neighbouring copies of one group's
word are the core of a run, and comparing words onward from there, one period apart, in
both directions gives its bounds.

A run of at least four periods and six words consists of three-word windows that its text
has three times or more. Stretches of such windows, which are found first, hold all runs;
texts of ordinary prose have hardly any.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from fractions import Fraction
from itertools import count, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from visitfold.llm.common import carried, offsets, utf8

# What the query states.
LEAST_WORDS = 6
LEAST_PERIODS = 4

#: Texts are taken together until they have so many words; a longer text goes alone.
CHUNK_WORDS = 100_000

# Odd multipliers that mix three word numbers and the text's number into one, from the golden ratio and pi.
MIX = np.array([0x9E3779B97F4A7C15, 0x3243F6A8885A308D, 0x2545F4914F6CDD1D], np.uint64)

RUN = "struct<start:bigint,length:bigint,period:bigint>"


def lyndon_groups(codes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """For every position, the group and the length of the longest Lyndon word that starts there.

    Groups start as letters and are taken from the highest down. A position's predecessor is
    the nearest one before it in a lower group; when a group is taken, the words of its
    predecessors grow by the group's word, as many times as it follows, and predecessors of
    one group and one number of times become a group of their own, above what is left. Equal
    groups mean equal words. 0 has to be the smallest code and is not taken.
    """
    alphabet = sorted(set(codes))
    number = {code: at for at, code in enumerate(alphabet)}
    group = [number[code] for code in codes]
    members: list[list[int]] = [[] for _ in alphabet]
    for at, one in enumerate(group):
        members[one].append(at)
    size = [len(found) for found in members]
    rank = offsets(np.array(size))[:-1].tolist()
    length = [1] * len(alphabet)
    # groups in order, as a list that is linked both ways
    below, above = list(range(-1, len(alphabet) - 1)), list(range(1, len(alphabet) + 1))
    before = [-1] * len(codes)
    taken = len(alphabet) - 1
    while taken > 0:
        own, word = rank[taken], length[taken]
        predecessors = []
        for at in members[taken]:
            if group[at] == taken:
                seek = at - 1
                while rank[group[seek]] >= own:
                    seek = before[seek]
                before[at] = seek
                predecessors.append(seek)
        grown: dict[int, dict[int, list[int]]] = {}
        for seek, same in groupby(predecessors):
            if group[seek]:
                times = sum(1 for _ in same)
                grown.setdefault(group[seek], {}).setdefault(times, []).append(seek)
        for old, by_times in grown.items():
            size[old] -= sum(map(len, by_times.values()))
            under, over, place = old, above[old], rank[old] + size[old]
            for times in sorted(by_times):
                moved, new = by_times[times], len(members)
                members.append(moved)
                size.append(len(moved))
                rank.append(place)
                length.append(length[old] + times * word)
                below.append(under)
                above.append(over)
                above[under] = new
                for seek in moved:
                    group[seek] = new
                place += len(moved)
                under = new
            below[over] = under
        taken = below[taken]
    return np.array(group), np.array(length)[group]


def _equal_steps(codes: np.ndarray, one: int, two: int, step: int) -> int:
    """How many codes from places ``one`` and ``two`` on are equal, forwards or backwards.

    The code at one of both ends, a separator, is not met again before the other gets there.
    """
    done, block = 0, 64
    while True:
        if step > 0:
            block = min(block, len(codes) - max(one, two) - done)
            left, right = codes[one + done : one + done + block], codes[two + done : two + done + block]
        else:
            block = min(block, min(one, two) + 1 - done)
            left = codes[one - done - block + 1 : one - done + 1][::-1]
            right = codes[two - done - block + 1 : two - done + 1][::-1]
        unlike = np.flatnonzero(left != right)
        if len(unlike) or not block:
            return done + (int(unlike[0]) if len(unlike) else 0)
        done += block
        block *= 2


def runs(codes: np.ndarray, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS) -> np.ndarray:
    """start, length and period of every run of stretches of codes, each between zeros; sorted.

    ``least_periods`` is three or more.
    """
    found: set[tuple[int, int, int]] = set()
    top, last = int(codes.max(initial=0)), len(codes) - 1
    for order in (codes, np.where(codes > 0, top + 1 - codes, 0)):
        group, length = lyndon_groups(order.tolist())
        at = np.flatnonzero(codes > 0)
        size = length[at]
        copied = (at + 2 * size <= last) & (group[np.minimum(at + size, last)] == group[at])
        copied &= group[np.minimum(at + 2 * size, last)] == group[at]
        copied &= group[np.maximum(at - size, 0)] != group[at]  # the first copy only
        for begin, period in zip(at[copied].tolist(), size[copied].tolist()):
            start = begin - _equal_steps(codes, begin - 1, begin + period - 1, -1)
            end = begin + period + _equal_steps(codes, begin, begin + period, 1)
            if end - start >= max(least_words, least_periods * period):
                found.add((start, end - start, period))
    return np.array(sorted(found), np.int64).reshape(-1, 3)


def _stretches(words: np.ndarray, text: np.ndarray, least: int) -> np.ndarray:
    """Which words lie in three-word windows that their text has at least ``least`` times.

    Windows are told apart by hashes: two that share one are both taken, so nothing is missed.
    """
    inside = np.zeros(len(words), bool)
    if len(words) < 3:
        return inside
    one = words.astype(np.uint64)
    mixed = one[:-2] * MIX[0] + one[1:-1] * MIX[1] + one[2:] * MIX[2]
    mixed = (mixed ^ (mixed >> np.uint64(29))) * MIX[0] + text[:-2].astype(np.uint64) * MIX[1]
    starts = np.flatnonzero(text[:-2] == text[2:])
    order = np.argsort(mixed[starts], kind="stable")
    values = mixed[starts][order]
    head = np.concatenate(([True], values[1:] != values[:-1])) if len(values) else np.zeros(0, bool)
    sizes = np.diff(np.append(np.flatnonzero(head), len(values)))
    often = starts[order[np.repeat(sizes >= least, sizes)]]
    for shift in range(3):
        inside[often + shift] = True
    return inside


def text_runs(texts: list[list[bytes]]) -> list[np.ndarray]:
    """The runs of each text: rows of start, length and period, by start and then period."""
    ids: defaultdict[bytes, int] = defaultdict(count(1).__next__)
    sizes = np.array([len(words) for words in texts], np.int64)
    n, bounds = int(sizes.sum()), offsets(sizes)
    flat = np.fromiter((ids[word] for words in texts for word in words), np.int64, n)
    text = np.repeat(np.arange(len(texts)), sizes)
    at = np.flatnonzero(_stretches(flat, text, 3))
    if not len(at):
        return [np.zeros((0, 3), np.int64)] * len(texts)
    opens = np.concatenate(([True], (at[1:] != at[:-1] + 1) | (text[at[1:]] != text[at[:-1]])))
    stretch = np.cumsum(opens)
    # a zero before every stretch and one behind the last
    codes = np.zeros(len(at) + int(stretch[-1]) + 1, np.int64)
    place = np.arange(len(at)) + stretch
    codes[place] = flat[at]
    found = runs(codes)
    back = np.zeros(len(codes), np.int64)
    back[place] = at
    begin = back[found[:, 0]]
    owner = text[begin] if len(begin) else np.zeros(0, np.int64)
    local = np.column_stack((begin - bounds[owner], found[:, 1], found[:, 2]))
    cuts = np.searchsorted(owner, np.arange(len(texts) + 1))
    return [local[a:b] for a, b in zip(cuts[:-1], cuts[1:])]


def strongest(found: np.ndarray) -> tuple[int, int, int] | None:
    """The run with the most periods; of equal ones the first, then that of the shortest period."""
    if not len(found):
        return None
    rows = map(tuple, found.tolist())
    return min(rows, key=lambda run: (Fraction(-run[1], run[2]), run[0], run[2]))


def collapsed(words: list[bytes], found: np.ndarray) -> bytes:
    """The words that no run repeats, joined by one space."""
    if not len(found):
        return b" ".join(words)
    marks = np.zeros(len(words) + 1, np.int64)
    np.add.at(marks, found[:, 0] + found[:, 2], 1)
    np.add.at(marks, found[:, 0] + found[:, 1], -1)
    return b" ".join([words[at] for at in np.flatnonzero(np.cumsum(marks[:-1]) == 0).tolist()])


def periodic_runs(
    docs: DataFrame, text: str = "text", columns: list[str] | None = None, chunk_words: int = CHUNK_WORDS
) -> DataFrame:
    """Every row as ``doc`` with ``runs``, the strongest of them, and the text without repetition.

    ``doc`` has all columns but the text, or those given. A run is a stretch of words whose
    smallest period fits at least four times, six words at least, and that no neighbouring
    word extends; ``runs`` lists start (word number from 0), length and period by start, then
    period. ``start``, ``length`` and ``period`` are those of the run with the most periods
    (of equal ones the first, then the shortest period), null without runs. ``collapsed``
    keeps the words that no run contains after its first period, joined by one space.

    Whole texts are read. Null and empty texts have no words, no runs and an empty ``collapsed``.
    Repeated rows are treated alike; an empty table gives no rows. Memory follows the larger
    of a chunk and the longest text.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, begin = batch.column("text"), 0
            while begin < batch.num_rows:
                texts: list[list[bytes]] = []
                held = 0
                while begin + len(texts) < batch.num_rows and (not texts or held < chunk_words):
                    texts.append(raw[begin + len(texts)].as_py().split())
                    held += len(texts[-1])
                found = text_runs(texts)
                best = [strongest(one) or (None, None, None) for one in found]
                flat = np.concatenate(found)
                listed = pa.StructArray.from_arrays(
                    [pa.array(np.ascontiguousarray(flat[:, k])) for k in range(3)], ["start", "length", "period"]
                )
                ends = offsets(np.array([len(one) for one in found]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc").slice(begin, len(texts)),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), listed),
                        *(pa.array([one[k] for one in best], pa.int64()) for k in range(3)),
                        pa.array([collapsed(*one) for one in zip(texts, found)], pa.binary()),
                    ],
                    names=["doc", "runs", "start", "length", "period", "collapsed"],
                )
                begin += len(texts)

    rows = docs.select(carried(docs, columns, text).alias("doc"), utf8(docs[f"`{text}`"]).alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(
        work, f"doc {kind}, runs array<{RUN}>, start long, length long, period long, collapsed binary"
    )
