"""Gated recurrent language model over word classes, trained and run by Spark tasks.

The probability of a word is that of its class times that of the word in its class, both
given all words before it in the document. A small gated recurrent network in numpy gives
the two by softmax on its state; tasks train it by truncated backpropagation on their
training documents and the weights are averaged. The most frequent words have a place of
their own in the softmax of their class and a row of their own as input. The other words of
a class share one place, in which counts of all training words tell them apart, and one row.
Classes come from spelling (pairs of bytes), so a word's class needs no table, also if it
was never seen. Texts are split once; what the network takes of them, a number for each
word, is written down for training and scoring.

Counts of the most frequent words, up to a stated number, go to every task. The others are
joined by hash, so vocabulary may grow with the corpus.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, replace
from itertools import count, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitfold.llm.common import carried, offsets, settle, utf8

# Share of documents held out, and what is added to counts.
FOLDS = 10
ADDED = 0.1

#: Classes of words; the end of a text is one more.
CLASSES = 32
HIDDEN = 16
#: Frequent words whose spelling the classes are fitted on.
CLASS_WORDS = 4096
#: Frequent words with a place of their own in the softmax of their class, at most CLASS_WORDS.
NEAR_WORDS = 1024
#: Buckets of byte pairs.
PAIRS = 1024
#: Words whose counts every task holds: 16 bytes each.
HEAD_WORDS = 1 << 19
#: Steps of a truncated window; the state goes on to the next one.
STEPS = 16
#: Steps that are run together when nothing is learnt; no result depends on it.
SCORE_STEPS = 64
#: Texts that are run side by side, and words that a task takes at a time.
LANES = 512
CHUNK_WORDS = 4_000_000
#: Longer texts are cut for training only; the state starts anew there.
TRAIN_WORDS = 2048
RATE = 0.02
SEED = 11
#: Words a task remembers.
MEMO_WORDS = 400_000
#: Bytes of words that are counted at a time, and of texts that are split at a time; one text may have more.
SPLIT_BYTES = 1 << 25

END = b""


def held_out(doc_id: Column) -> Column:
    """Every tenth document by the CRC of its id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def pair_buckets(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte pairs of all words (with their borders), and where each word begins."""
    raw = np.frombuffer(b"\0" + b"\0\0".join(words) + b"\0", np.uint8).astype(np.uint32)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    starts = offsets(sizes + 1)[:-1]
    keep = np.ones(len(raw), bool)
    keep[starts + sizes] = False
    code = raw[:-1] * 256 + raw[1:]
    buckets = (code * 40503 >> 4) % PAIRS
    return buckets[keep[:-1]], offsets(sizes)[:-1]


def fit_classes(words: list[bytes], counts: np.ndarray, classes: int, rounds: int = 12) -> np.ndarray:
    """Log-probabilities of byte pairs in each class: a mixture fitted with hard assignments."""
    rng = np.random.default_rng(SEED)
    seen = np.zeros((len(words), PAIRS), np.float32)
    if words:
        buckets, starts = pair_buckets(words)
        row = np.repeat(np.arange(len(words)), np.diff(np.append(starts, len(buckets))))
        np.add.at(seen, (row, buckets), 1)
    weight = np.sqrt(np.asarray(counts, np.float32))
    place = rng.integers(0, classes, len(words))
    table = np.zeros((PAIRS, classes), np.float32)
    for _ in range(rounds if words else 0):
        hot = (place[:, None] == np.arange(classes)) * weight[:, None]
        sums = seen.T @ hot.astype(np.float32)
        share = np.log(np.bincount(place, weight, classes) + 1).astype(np.float32)
        table = np.log((sums + 0.5) / (sums + 0.5).sum(axis=0)).astype(np.float32)
        place = (seen @ table + 0.2 * share).argmax(axis=1)
        for empty in np.setdiff1d(np.arange(classes), place):
            place[rng.integers(0, len(words))] = empty
    return table


def classes_of(words: list[bytes], table: np.ndarray) -> np.ndarray:
    """The class of every word by its spelling; the end has the last number.

    Words of one length are scored together, pair by pair.
    """
    out = np.empty(len(words), np.uint8)
    for a in range(0, len(words), 20_000):
        some = words[a : a + 20_000]
        buckets, starts = pair_buckets(some)
        pairs = np.diff(np.append(starts, len(buckets)))
        for length in np.unique(pairs):
            at = np.flatnonzero(pairs == length)
            held = buckets[starts[at][:, None] + np.arange(length)]
            score = table.take(held[:, 0], axis=0)
            for k in range(1, length):
                score += table.take(held[:, k], axis=0)
            out[a + at] = score.argmax(axis=1) if length > 1 else table.shape[1]
    return out


def split(raw: pa.Array) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Lower-cased words of some texts, one after another, and how many each text has.

    Arrow's ASCII functions take bytes as they are: A-Z alone change, and the six characters
    of ``WORD`` separate, as with ``bytes.lower`` and ``bytes.split``.
    """
    ends = np.cumsum(pc.binary_length(raw).to_numpy(zero_copy_only=False).astype(np.int64))
    bounds = np.append(np.flatnonzero(np.diff(ends // SPLIT_BYTES, prepend=-1)), len(raw))
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        lists = pc.ascii_split_whitespace(pc.ascii_lower(raw.slice(a, b - a).cast(pa.string(), safe=False)))
        # white space at the border of a text leaves an empty word
        there = pc.greater(pc.binary_length(lists.values), 0)
        before = offsets(there.to_numpy(zero_copy_only=False))
        yield lists.values.filter(there), np.diff(before[lists.offsets.to_numpy()])


class Vocabulary:
    """Classes and symbols of words, and counts of frequent ones, remembered by a task."""

    def __init__(
        self,
        table: np.ndarray,
        head: tuple[np.ndarray, np.ndarray] | None = None,
        near: dict[bytes, int] | None = None,
    ) -> None:
        self.table = table
        self.head = head
        self.near = near or {}
        self._forget()

    def read(self, raw: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Numbers of the tokens of some texts, each with its end, and how many each text has.

        Numbers belong to this task's lists and are valid until the next texts are read.
        """
        for words, sizes in split(raw):
            coded = words.dictionary_encode()
            distinct = coded.dictionary.cast(pa.binary()).to_pylist()
            known = np.fromiter(map(self.number.__getitem__, distinct), np.int32, len(distinct))
            ends = np.cumsum(sizes + 1) - 1
            numbers = np.full(len(words) + len(sizes), self.number[END], np.int32)
            inside = np.ones(len(numbers), bool)
            inside[ends] = False
            numbers[inside] = known[coded.indices.to_numpy()]
            self._learn(list(islice(self.number, len(self.kinds), None)))
            yield numbers, sizes + 1
            if len(self.number) > MEMO_WORDS:
                self._forget()

    def _forget(self) -> None:
        self.number: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.kinds = np.empty(0, np.uint8)
        self.symbols = np.empty(0, np.uint16)
        self.codes = np.empty(0, np.int64)
        self.logs = np.empty(0, np.float64)

    def _learn(self, new: list[bytes]) -> None:
        if not new:
            return
        kinds = classes_of(new, self.table)
        self.kinds = np.concatenate((self.kinds, kinds))
        symbols = np.fromiter(map(self.near.get, new, kinds.tolist()), np.uint16, len(new))
        self.symbols = np.concatenate((self.symbols, symbols))
        if self.head is not None:
            codes = np.array([xxhash.xxh64_intdigest(word, 42) for word in new], np.uint64).view(np.int64)
            keys, logs = self.head
            known = np.full(len(codes), np.nan)
            if len(keys):
                at = np.minimum(np.searchsorted(keys, codes), len(keys) - 1)
                known = np.where(keys[at] == codes, logs[at], np.nan)
            self.codes = np.concatenate((self.codes, codes))
            self.logs = np.concatenate((self.logs, known))


def _row_sums(rows: np.ndarray) -> np.ndarray:
    """By a product with ones, which for short rows is faster than ``sum``."""
    return rows @ np.ones(rows.shape[1], rows.dtype)


def _by_columns(rows: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The product, laid out by columns: weights have few columns, and work on long ones is faster."""
    return (weights.T @ rows.T).T


def _rows_at(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Some rows of an array that lies in memory by columns, laid out in the same way."""
    return rows.T.take(at, axis=1, mode="clip").T


@dataclass
class Places:
    """Symbols, which are the classes and then the near words: the class of each and its place.

    The places of a class follow one another, near words first and the other words last.
    """

    kinds: np.ndarray
    place: np.ndarray
    first: np.ndarray

    @staticmethod
    def of(kinds: int, near: np.ndarray) -> Places:
        """``near`` has the class of every near word."""
        every = np.concatenate((np.arange(kinds), near)).astype(np.int64)
        order = np.lexsort((np.arange(len(every)) < kinds, every))
        place = np.empty(len(every), np.int64)
        place[order] = np.arange(len(every))
        return Places(every.astype(np.uint8), place, offsets(np.bincount(every, minlength=kinds)))


@dataclass
class Network:
    """Weights: of inputs by symbol, of the state, and of the output of classes and of places.

    Without ``places`` symbols are classes, and a class is all that is told of a word.
    """

    inputs: np.ndarray
    state: np.ndarray
    output: np.ndarray
    bias: np.ndarray
    word_output: np.ndarray | None = None
    word_bias: np.ndarray | None = None
    places: Places | None = None

    def with_words(self, places: Places, log_share: np.ndarray) -> Network:
        """The same probabilities with places for words, given the share of each in its class."""
        output = np.zeros((len(self.state), len(log_share)), np.float32)
        return Network(
            self.inputs[places.kinds], self.state, self.output, self.bias, output, log_share.astype(np.float32), places
        )

    @staticmethod
    def start(log_share: np.ndarray, hidden: int, seed: int = SEED) -> Network:
        rng = np.random.default_rng(seed)
        kinds = len(log_share)
        small = lambda *shape: (0.3 * rng.standard_normal(shape)).astype(np.float32)
        return Network(small(kinds, 3 * hidden), small(hidden, 3 * hidden), small(hidden, kinds), log_share.astype(np.float32))

    def parts(self) -> list[np.ndarray]:
        words = [] if self.places is None else [self.word_output, self.word_bias]
        return [self.inputs, self.state, self.output, self.bias, *words]

    def of(self, parts: list[np.ndarray]) -> Network:
        """Other weights in the same places."""
        return Network(*parts) if self.places is None else Network(*parts, self.places)

    def flat(self) -> np.ndarray:
        return np.concatenate([part.ravel() for part in self.parts()]).astype(np.float64)

    def like(self, flat: np.ndarray) -> Network:
        ends = np.cumsum([part.size for part in self.parts()])[:-1]
        split = zip(np.split(flat, ends), self.parts())
        return self.of([one.reshape(part.shape).astype(np.float32) for one, part in split])

    def step(self, before: np.ndarray, outer: np.ndarray) -> tuple[np.ndarray, ...]:
        """The next state given rows of ``inputs``, and what backpropagation needs of the way.

        Rows are lanes. All arrays lie in memory by columns, so that the gates of all lanes
        follow one another.
        """
        n = self.state.shape[0]
        inner = _by_columns(before, self.state)
        gates = inner[:, : 2 * n]
        gates += outer[:, : 2 * n]
        np.negative(gates, out=gates)
        np.exp(gates, out=gates)
        gates += 1
        np.reciprocal(gates, out=gates)
        keep, reset = gates[:, :n], gates[:, n:]
        new = reset * inner[:, 2 * n :]
        new += outer[:, 2 * n :]
        np.tanh(new, out=new)
        apart = before - new
        state = keep * apart
        state += new
        return state, keep, reset, new, apart, inner[:, 2 * n :]

    def logits(self, states: np.ndarray) -> np.ndarray:
        """States lie between -1 and 1, so these are bounded by the weights and need no shift."""
        found = _by_columns(states, self.output)
        found += self.bias
        return found

    def log_share(self, states: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """Log-probability of one class for each state."""
        logits = self.logits(states)
        own = logits[np.arange(len(kinds)), kinds]
        return own - np.log(_row_sums(np.exp(logits, out=logits)))

    def word_log_share(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Log-probability of each symbol's place in its class."""
        out = np.zeros(len(symbols), states.dtype)
        if self.places is not None:
            odds = Odds.of(self, states, symbols)
            out[odds.order] = odds.logits - np.log(odds.sums)
        return out


@dataclass
class Odds:
    """What each place of a word's class weighs for the word; divided by their sum, its probability.

    Words stand in the ``order`` of their classes. ``states`` has a column for each word, with a
    one below for the bias. ``parts`` has for each class its words, its places and the weights
    as (places, words); these lie one after another in ``flat``, a word's own place at ``own``.
    """

    order: np.ndarray
    states: np.ndarray
    parts: list[tuple[slice, slice, np.ndarray]]
    flat: np.ndarray
    own: np.ndarray
    logits: np.ndarray
    sums: np.ndarray

    @staticmethod
    def of(network: Network, states: np.ndarray, symbols: np.ndarray) -> Odds:
        kinds, first = network.places.kinds[symbols], network.places.first
        order = np.argsort(kinds, kind="stable")
        kinds, place = kinds[order], network.places.place[symbols[order]]
        counts, widths = np.bincount(kinds, minlength=len(first) - 1), np.diff(first)
        ends, bases = offsets(counts), offsets(counts * widths)
        own = (bases[:-1] - first[:-1] * counts - ends[:-1])[kinds] + place * counts[kinds] + np.arange(len(kinds))
        weights = np.column_stack((network.word_output.T, network.word_bias))
        held = np.ones((weights.shape[1], len(order)), states.dtype)
        states.T.take(order, axis=1, mode="clip", out=held[:-1])
        flat = np.empty(bases[-1], np.result_type(weights, held))
        sums, ones = np.empty(len(order), flat.dtype), np.ones(widths.max(), flat.dtype)
        parts = []
        for kind in np.flatnonzero(counts).tolist():
            words, places = slice(ends[kind], ends[kind + 1]), slice(first[kind], first[kind + 1])
            part = flat[bases[kind] : bases[kind + 1]].reshape(widths[kind], counts[kind])
            np.matmul(weights[places], held[:, words], out=part)
            parts.append((words, places, part))
        logits = flat[own]
        np.exp(flat, out=flat)
        for words, _, part in parts:
            np.matmul(ones[: len(part)], part, out=sums[words])
        return Odds(order, held, parts, flat, own, logits, sums)


def lanes(lengths: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Deal texts to lanes of like length: the order of texts, and each lane's words.

    Lanes are listed longest first.
    """
    heap = [(0, lane) for lane in range(count)]
    held: list[list[int]] = [[] for _ in range(count)]
    for text in np.argsort(-lengths, kind="stable").tolist():
        filled, lane = heapq.heappop(heap)
        held[lane].append(text)
        heapq.heappush(heap, (filled + int(lengths[text]), lane))
    total = np.array([int(lengths[one].sum()) if one else 0 for one in held])
    order = np.argsort(-total, kind="stable")
    return np.array([text for lane in order.tolist() for text in held[lane]], np.int64), total[order]


@dataclass
class Lanes:
    """Texts one after another in lanes: classes, the symbols before, and where a text begins."""

    kinds: np.ndarray
    symbols: np.ndarray
    before: np.ndarray
    fresh: np.ndarray
    place: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray

    @staticmethod
    def of(
        kinds: np.ndarray,
        lengths: np.ndarray,
        end: int,
        longest: int | None = None,
        symbols: np.ndarray | None = None,
    ) -> Lanes:
        """``kinds`` of whole texts; texts over ``longest`` words are cut. Symbols are kinds if not given."""
        symbols = kinds if symbols is None else symbols
        before = np.concatenate(([end], symbols[:-1])).astype(symbols.dtype)
        if longest:
            pieces = -(-lengths // longest)
            some = np.full(int(pieces.sum()), longest, np.int64)
            some[np.cumsum(pieces) - 1] = lengths - (pieces - 1) * longest
            lengths = some
        count = int(min(LANES, max(16, lengths.sum() // 8000), max(1, len(lengths))))
        order, sizes = lanes(lengths, count)
        starts, own = offsets(lengths)[:-1], lengths[order]
        place = np.arange(own.sum()) + np.repeat(starts[order] - offsets(own)[:-1], own)
        fresh = np.zeros(len(place), bool)
        fresh[offsets(own)[:-1]] = True
        return Lanes(kinds[place], symbols[place], before[place], fresh, place, offsets(sizes)[:-1], sizes)

    def active(self, t: int) -> int:
        return int(np.searchsorted(-self.sizes, -t, side="left"))


@dataclass
class Window:
    """Some steps of all lanes that reach the first of them: (steps, lanes) arrays.

    A lane that has ended repeats its last word and is not ``live``. Units of the states come
    last as an axis and first in memory. ``ways`` is what backpropagation needs of each step.
    """

    place: np.ndarray
    live: np.ndarray
    kinds: np.ndarray
    symbols: np.ndarray
    fresh: np.ndarray
    states: np.ndarray
    ways: list[tuple[np.ndarray, ...]]

    @staticmethod
    def run(network: Network, texts: Lanes, t0: int, steps: int, state: np.ndarray, learns: bool = True) -> Window:
        n = texts.active(t0)
        times = np.arange(t0, min(t0 + steps, int(texts.sizes[0])))[:, None]
        sizes = texts.sizes[:n]
        place = texts.starts[:n] + np.minimum(times, sizes - 1)
        fresh, inputs = texts.fresh[place], np.asfortranarray(network.inputs)
        symbols = texts.before[place].astype(np.intp)
        begins = fresh.any(axis=1)
        state = np.asfortranarray(state[:n])
        states = _units_first(len(place), n, network.state.shape[0], state.dtype)
        ways = []
        for t in range(len(place)):
            before = state * ~fresh[t, :, None] if begins[t] else state
            state, *way = network.step(before, _rows_at(inputs, symbols[t]))
            states[t] = state
            if learns:
                ways.append((before, *way))
        return Window(place, times < sizes, texts.kinds[place], texts.symbols[place], fresh, states, ways)


def _units_first(steps: int, lanes: int, units: int, dtype: np.dtype) -> np.ndarray:
    """A (steps, lanes, units) array that holds each unit's numbers together.

    Some room between the units keeps their starts from falling on the same lines of the cache.
    """
    room = np.empty((units, steps * lanes + 16), dtype)[:, : steps * lanes]
    return room.reshape(units, steps, lanes).transpose(1, 2, 0)


def log_likelihood(network: Network, texts: Lanes, steps: int = SCORE_STEPS) -> np.ndarray:
    """Natural log-probability of each word's class and its place there, in the order of the texts."""
    out = np.empty(len(texts.kinds), np.float32)
    state = np.zeros((len(texts.sizes), network.state.shape[0]), np.float32)
    for t0 in range(0, int(texts.sizes[0]) if len(texts.sizes) else 0, steps):
        window = Window.run(network, texts, t0, steps, state, learns=False)
        state = window.states[-1]
        kinds = window.kinds.ravel()
        states = window.states.reshape(len(kinds), -1)
        found = network.log_share(states, kinds) + network.word_log_share(states, window.symbols.ravel())
        live = window.live.ravel()
        out[texts.place[window.place.ravel()[live]]] = found[live]
    return out


def _sums_by(kinds: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
    """Sum of the rows of each class; rows and sums lie in memory by columns."""
    order = np.argsort(kinds, kind="stable")
    counts = np.bincount(kinds, minlength=count)
    there = np.flatnonzero(counts)
    out = np.zeros((rows.shape[1], count), rows.dtype)
    out[:, there] = np.add.reduceat(_rows_at(rows, order).T, offsets(counts)[there], axis=1)
    return out.T


def window_gradient(
    network: Network, texts: Lanes, t0: int, state: np.ndarray, steps: int = STEPS
) -> tuple[list[np.ndarray], np.ndarray]:
    """Gradient of the mean loss over one window, backpropagated to its start; the state after it."""
    window = Window.run(network, texts, t0, steps, state)
    size = window.kinds.size
    states = window.states.reshape(size, -1)
    kinds = window.kinds.ravel()
    slope = network.logits(states)
    np.exp(slope, out=slope)
    share = window.live.ravel() / window.live.sum(dtype=states.dtype)
    slope *= (share / _row_sums(slope))[:, None]
    slope[np.arange(size), kinds] -= share
    from_output = _by_columns(slope, network.output.T)
    from_words = _word_gradient(network, states, window.symbols.ravel(), share, from_output)
    from_output = from_output.reshape(window.states.shape)
    n = window.states.shape[2]
    befores = _units_first(*window.states.shape, states.dtype)
    # for each step what reaches the new state from outside, both gates, and the new state from inside
    slopes = _units_first(*window.kinds.shape, 4 * n, states.dtype)
    begins = window.fresh.any(axis=1)
    back = np.zeros_like(window.states[0])
    for t in range(len(window.ways) - 1, -1, -1):
        before, keep, reset, new, apart, inner = window.ways[t]
        befores[t], row = before, slopes[t]
        to_new, to_keep, to_reset, held = (row[:, k * n : (k + 1) * n] for k in range(4))
        back += from_output[t]
        kept = back * keep
        back -= kept
        np.multiply(new, new, out=to_new)
        np.subtract(1, to_new, out=to_new)
        to_new *= back
        np.subtract(1, keep, out=to_keep)
        to_keep *= kept
        to_keep *= apart
        np.multiply(to_new, reset, out=held)
        np.subtract(1, reset, out=to_reset)
        to_reset *= held
        to_reset *= inner
        back = _by_columns(row[:, n:], network.state.T)
        back += kept
        if begins[t]:
            back *= ~window.fresh[t, :, None]
    slopes = slopes.reshape(size, -1)
    outer = _sums_by(texts.before[window.place.ravel()], slopes[:, : 3 * n], len(network.inputs))
    grads = [
        np.asfortranarray(np.roll(outer, 2 * n, axis=1)),
        befores.reshape(size, n).T @ slopes[:, n:],
        states.T @ slope,
        slope.sum(axis=0),
        *from_words,
    ]
    return grads, window.states[-1]


def _word_gradient(
    network: Network, states: np.ndarray, symbols: np.ndarray, share: np.ndarray, from_output: np.ndarray
) -> list[np.ndarray]:
    """Gradient of the weights of places; what it means for the states is added to ``from_output``."""
    if network.places is None:
        return []
    odds = Odds.of(network, states, symbols)
    odds.flat[odds.own] -= odds.sums
    scale = share[odds.order] / odds.sums
    scaled = odds.states * scale
    found = np.empty((states.shape[1], len(symbols)), states.dtype)
    output = np.zeros((len(scaled), network.word_output.shape[1]), states.dtype)
    for words, places, part in odds.parts:
        np.matmul(network.word_output[:, places], part, out=found[:, words])
        np.matmul(scaled[:, words], part.T, out=output[:, places])
    found *= scale
    back = np.empty_like(odds.order)
    back[odds.order] = np.arange(len(back))
    from_output += _rows_at(found.T, back)
    return [output[:-1], output[-1]]


def train(network: Network, texts: Lanes, rate: float = RATE) -> Network:
    """One pass of Adam over all windows, the rate falling to a tenth."""
    parts = [part.copy() for part in network.parts()]
    parts[0] = np.asfortranarray(parts[0])
    network = network.of(parts)
    mean = [np.zeros_like(part) for part in parts]
    square = [np.zeros_like(part) for part in parts]
    state = np.zeros((len(texts.sizes), network.state.shape[0]), np.float32)
    windows = range(0, int(texts.sizes[0]) if len(texts.sizes) else 0, STEPS)
    for k, t0 in enumerate(windows):
        grads, state = window_gradient(network, texts, t0, state)
        now = rate * (1 - 0.9 * k / len(windows))
        for part, grad, m, v in zip(parts, grads, mean, square):
            change = grad - m
            change *= 0.1
            m += change
            np.multiply(grad, grad, out=change)
            change -= v
            change *= 0.01
            v += change
            np.divide(v, 1 - 0.99 ** (k + 1), out=change)
            np.sqrt(change, out=change)
            change += 1e-8
            np.divide(m, change, out=change)
            change *= now / (1 - 0.9 ** (k + 1))
            part -= change
    return network


def _texts(docs: DataFrame, doc_id: str, text: str, *more: Column) -> DataFrame:
    return docs.select(
        *more, held_out(docs[f"`{doc_id}`"]).alias("held_out"), utf8(docs[f"`{text}`"]).alias("text")
    )


def count_words(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """word, n over all training documents."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some: list[pa.Array] = []
        held = texts = 0

        def out() -> Iterator[pa.RecordBatch]:
            found = pa.chunked_array(some, pa.string()).value_counts()
            for a in range(0, len(found), 50_000):
                part = found.slice(a, 50_000)
                yield pa.RecordBatch.from_arrays([part.field(0).cast(pa.binary()), part.field(1)], names=["word", "n"])
            some.clear()

        for batch in batches:
            texts += batch.num_rows
            for words, _ in split(batch.column("text")):
                some.append(words)
                held += words.nbytes
                if held >= SPLIT_BYTES:
                    yield from out()
                    held = 0
        yield from out()
        if texts:
            ends = [pa.array([END], pa.binary()), pa.array([texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(ends, names=["word", "n"])

    rows = _texts(docs, doc_id, text).where("NOT held_out").select("text")
    return rows.mapInArrow(work, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def by_frequency(counts: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """The ``most`` most frequent words, of equal ones the first, and the others.

    Counts come from a histogram over their logarithm, which stays small; only the step that
    does not fit whole is put in order.
    """
    step = F.floor(F.log2(F.col("n").cast("double")) * 16).cast("int")
    held, least, last = 0, 1 << 30, None
    rows = counts.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect()
    for row in sorted(rows, key=lambda row: -row["step"]):
        if held + row["words"] > most:
            some = counts.where(step == row["step"]).orderBy(F.desc("n"), "word").limit(most - held)
            last = some.orderBy("n", F.desc("word")).first()
            break
        held += row["words"]
        least = row["step"]
    taken = step >= least
    if last:
        same = (F.col("n") == last["n"]) & (F.col("word") <= F.lit(bytes(last["word"])))
        taken = taken | (F.col("n") > last["n"]) | same
    return counts.where(taken), counts.where(~taken)


@dataclass
class Model:
    """``near`` are the symbols of near words, ``charge`` the log10 of the counts that a place stands for."""

    table: np.ndarray
    network: Network
    class_logs: np.ndarray
    words: int
    distinct: int
    near: dict[bytes, int]
    charge: np.ndarray


def start_model(counts: DataFrame, classes: int, hidden: int, near_words: int = NEAR_WORDS) -> Model:
    """Classes and near words, from the most frequent words; the network knows counts only."""
    top, _ = by_frequency(counts.where(F.length("word") > 0), CLASS_WORDS)
    top = top.orderBy(F.desc("n"), "word").toPandas()
    often = [bytes(word) for word in top["word"]]
    table = fit_classes(often, top["n"].to_numpy(), classes)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").to_pylist()
            kinds = classes_of(words, table) if words else np.empty(0, np.uint8)
            yield pa.RecordBatch.from_arrays([pa.array(kinds.astype(np.int32)), batch.column("n")], names=["kind", "n"])

    sums = (
        counts.mapInArrow(spell, "kind int, n long")
        .groupBy("kind")
        .agg(F.sum("n").alias("n"), F.count("*").alias("words"))
        .collect()
    )
    n, words = np.zeros(classes + 1), np.zeros(classes + 1)
    for row in sums:
        n[row["kind"]], words[row["kind"]] = row["n"], row["words"]
    mass = n + ADDED * (words + 1)
    mass[classes] = n[classes] + ADDED
    near = often[:near_words]
    own = top["n"].to_numpy(np.float64)[:near_words] + ADDED
    kinds = classes_of(near, table).astype(np.int64)
    # what a class has besides its near words: its other words and one unknown
    others = n + 0.0
    np.subtract.at(others, kinds, own - ADDED)
    others += ADDED * (words + 1 - np.bincount(kinds, minlength=classes + 1))
    others[classes] = mass[classes]
    held = np.concatenate((others, own))
    places = Places.of(classes + 1, kinds)
    shares = np.empty(len(held))
    shares[places.place] = np.log(held / mass[places.kinds])
    network = Network.start(np.log((n + 1) / (n + 1).sum()), hidden).with_words(places, shares)
    symbols = {word: classes + 1 + k for k, word in enumerate(near)}
    return Model(table, network, np.log10(mass), int(n.sum()), int(words.sum()), symbols, np.log10(held))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray, np.ndarray]]:
    """Rows of some batches together, the symbols of all their words, and how many each row has."""

    def joined() -> tuple[pa.Table, np.ndarray, np.ndarray]:
        rows = pa.Table.from_batches(some)
        symbols = [np.frombuffer(one.as_py(), np.uint16) for one in rows.column("symbols")]
        return rows, np.concatenate(symbols), np.fromiter(map(len, symbols), np.int64, len(symbols))

    some: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        if batch.num_rows:
            some.append(batch)
            held += batch.column("symbols").nbytes // 2
        if held >= CHUNK_WORDS:
            yield joined()
            some, held = [], 0
    if some:
        yield joined()


def learn(tokens: DataFrame, model: Model) -> Model:
    """One averaged pass over the training documents of ``_tokens``."""
    start = model.network

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network, seen = start, 0
        for _, symbols, sizes in _chunks(batches):
            texts = Lanes.of(start.places.kinds[symbols], sizes, len(start.bias) - 1, TRAIN_WORDS, symbols)
            network = train(network, texts, RATE if not seen else RATE / 4)
            seen += len(symbols)
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array([network.flat().tolist()]), pa.array([seen], pa.int64())], names=["weights", "words"]
            )

    trained = (
        tokens.where("NOT held_out")
        .select("symbols")
        .mapInArrow(work, "weights array<double>, words long")
        .select("words", F.posexplode("weights"))
        .groupBy("pos")
        .agg((F.sum(F.col("col") * F.col("words")) / F.sum("words")).alias("weight"))
        .toPandas()
        .sort_values("pos")
    )
    return replace(model, network=start.like(trained["weight"].to_numpy())) if len(trained) else model


def fit(docs: DataFrame, counts: DataFrame, doc_id: str, text: str, classes: int, hidden: int) -> Model:
    """Classes from the most frequent words, then one averaged pass over all training documents."""
    model = start_model(counts, classes, hidden)
    nothing = (np.empty(0, np.int64), np.empty(0))
    return learn(_tokens(docs, model, nothing, doc_id, text, F.lit(0)), model)


def _tokens(
    docs: DataFrame, model: Model, head: tuple[np.ndarray, np.ndarray], doc_id: str, text: str, along: Column
) -> DataFrame:
    """Each row's symbols, the counts of its frequent words, and its others (by hash)."""
    held = docs.sparkSession.sparkContext.broadcast(head)
    table, near = model.table, model.near

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, made = Vocabulary(table, held.value, near), TaskContext.get().partitionId() << 36
        for batch in batches:
            begin = 0
            for number, sizes in vocabulary.read(batch.column("text")):
                n = len(sizes)
                logs = vocabulary.logs[number]
                rare = np.flatnonzero(np.isnan(logs))
                texts, codes, times = _tally(np.repeat(np.arange(n), sizes)[rare], number[rare])
                ends = pa.array(offsets(np.bincount(texts, minlength=n)), pa.int32())
                bounds = offsets(sizes)
                symbols = vocabulary.symbols[number]
                total = lambda values: pa.array(np.add.reduceat(values, bounds[:-1]))  # noqa: E731,B023
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(made, made + n)),
                        batch.column("doc").slice(begin, n),
                        batch.column("held_out").slice(begin, n),
                        pa.array(sizes),
                        total((~np.isnan(logs)).astype(np.int64)),
                        total(np.nan_to_num(logs)),
                        pa.array([symbols[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])], pa.binary()),
                        pa.ListArray.from_arrays(ends, pa.array(vocabulary.codes[codes])),
                        pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int32))),
                    ],
                    names=["uid", "doc", "held_out", "n_tokens", "known", "logs", "symbols", "rare", "times"],
                )
                begin, made = begin + n, made + n

    rows = _texts(docs, doc_id, text, along.alias("doc"))
    doc_type = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(
        work,
        f"uid long, doc {doc_type}, held_out boolean, n_tokens long, known long, logs double, "
        "symbols binary, rare array<long>, times array<int>",
    )


def _chances(tokens: DataFrame, model: Model) -> DataFrame:
    """uid and ``chance``: log10 probability of all words' classes and places, less the counts of the places."""
    network, charge = model.network, model.charge

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, symbols, sizes in _chunks(batches):
            texts = Lanes.of(network.places.kinds[symbols], sizes, len(network.bias) - 1, symbols=symbols)
            found = log_likelihood(network, texts).astype(np.float64) / math.log(10) - charge[symbols]
            total = np.add.reduceat(found, offsets(sizes)[:-1])
            yield from pa.table({"uid": rows.column("uid"), "chance": total}).to_batches()

    return tokens.select("uid", "symbols").mapInArrow(work, "uid long, chance double")


def _tally(texts: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, number) pairs in order, and how often each occurs."""
    order = np.lexsort((numbers, texts))
    texts, numbers = texts[order], numbers[order]
    new = np.ones(len(texts), bool)
    new[1:] = (texts[1:] != texts[:-1]) | (numbers[1:] != numbers[:-1])
    first = np.flatnonzero(new)
    return texts[first], numbers[first], np.diff(np.append(first, len(texts)))


def score(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    columns: list[str] | None = None,
    classes: int = CLASSES,
    hidden: int = HIDDEN,
    head_words: int = HEAD_WORDS,
) -> DataFrame:
    """Every row as ``doc`` (``columns`` of it, all but the text if not given) with its scores.

    held_out, n_tokens, n_known, train_tokens, base_score (log10 of smoothed word counts) and
    score (log10 probability by the model). Tokens are lower-cased words and one end for each
    text; a null or empty text is the end alone. All documents that are not held out are
    learnt from, whole, and all are scored, whole, the state carried to the last word. Rows
    are scored one by one, so repeated rows are repeated. Without training documents every
    token has probability one in the base, and the network is as it starts.
    """
    counts = settle(count_words(docs, doc_id, text), "counts")
    model = start_model(counts, classes, hidden)
    common, others = by_frequency(counts, head_words)
    code, log_count = F.xxhash64("word").alias("code"), lambda n: F.log10(n + F.lit(ADDED))
    top = common.select(code, log_count(F.col("n")).alias("log")).toPandas().sort_values("code")
    head = (top["code"].to_numpy(np.int64), top["log"].to_numpy(np.float64))
    along = carried(docs, columns, text, doc_id)
    alone = settle(_tokens(docs, model, head, doc_id, text, along), "tokens")
    chances = settle(_chances(alone, learn(alone, model)), "chances")
    rare = alone.select("uid", F.explode(F.arrays_zip("rare", "times")).alias("one"))
    found = (
        rare.select("uid", F.col("one.rare").alias("code"), F.col("one.times").alias("times"))
        .join(others.select(code, "n"), "code", "left")
        .groupBy("uid")
        .agg(
            F.sum(F.when(F.col("n").isNull(), 0).otherwise(F.col("times"))).alias("rare_known"),
            F.sum(F.col("times") * log_count(F.coalesce("n", F.lit(0)))).alias("rare_logs"),
        )
    )
    zero = F.lit(0)
    logs = F.col("logs") + F.coalesce("rare_logs", zero)
    room = math.log10(model.words + ADDED * (model.distinct + 1))
    return alone.drop("symbols").join(chances, "uid").join(found, "uid", "left").select(
        "doc",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", zero)).alias("n_known"),
        F.lit(model.words).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * F.lit(room)).alias("base_score"),
        (logs + F.col("chance")).alias("score"),
    )
