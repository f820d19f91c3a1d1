"""Token sequences packed by best fit, up a tree of tasks.

Tasks tokenise whole texts and cut them into pieces. Pieces are dealt by hash, so that every
task has all kinds of lengths, and each task packs its own by best fit, longest first. Bins
that are nearly full are sequences. The others go up as items of their own, a few tasks' bins
to one, and are packed again, until a round that brings together all it can merges none. A
task never holds more than a stated number of items, and only their numbers and lengths.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from visitfold.llm.common import carried, settle

CAPACITY = 2048
END_ID = 0
#: Items that a task packs at a time.
TASK_ITEMS = 20_000
#: Tasks of a round whose bins come together in the next.
FAN = 8
#: Bins with less room than this part of a sequence are closed.
NEARLY_FULL = 0.005
#: Words whose ids a Python worker remembers.
MEMO_WORDS = 200_000

# Fixed value: the pieces into which byte-level BPE of this family cuts a text.
PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# A space starts a piece unless white space stands on both sides of it.
_RUN_OF_SPACES = re.compile(r"\s(?: \s| \Z)")


def _bytes_of_symbols() -> dict[str, int]:
    """Byte-level BPE writes each byte as a printable character."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [byte for byte in range(256) if byte not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Encoder:
    """Ids of whole texts as bytes, equal to those of ``tokenizers`` for the given file.

    Words are encoded once and remembered. A byte-level BPE file whose ids follow its
    merges is run by ``tiktoken``, which gives the same ids in less time.
    """

    def __init__(self, path: str) -> None:
        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            read = json.load(file)
        self.special = [token["content"] for token in read["added_tokens"]]
        self.plain = self._fast(read)
        self.starts: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}

    @staticmethod
    def _fast(read: dict) -> Callable[[str], list[int]] | None:
        cut = read["pre_tokenizer"] or {}
        if (
            read["normalizer"] is not None
            or cut.get("type") != "ByteLevel"
            or cut.get("add_prefix_space")
            or not cut.get("use_regex", True)
            or read["model"]["type"] != "BPE"
        ):
            return None
        special = {token["content"] for token in read["added_tokens"]}
        vocab = {word: at for word, at in read["model"]["vocab"].items() if word not in special}
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in read["model"]["merges"]]
        merged = [vocab["".join(pair)] for pair in pairs]
        if merged != sorted(merged):
            return None
        symbols = _bytes_of_symbols()
        ranks = {bytes(symbols[c] for c in word): at for word, at in vocab.items()}
        own = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        return own.encode_ordinary

    def _exact(self, text: str) -> list[int]:
        return self.whole.encode(text, add_special_tokens=False).ids

    def _some(self, text: str) -> bytes:
        ids = array("I", (self.plain or self._exact)(text))
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids, special strings included."""
        if any(map(text.count, self.special)):
            return np.array(self._exact(text), "<u4").tobytes()
        if self.plain is None or _RUN_OF_SPACES.search(text):
            return self._some(text)
        first, *rest = text.split(" ")
        if len(self.words) > MEMO_WORDS:
            self.words.clear()
            self.starts.clear()
        if first not in self.starts:
            self.starts[first] = self._some(first)
        words = self.words
        for word in set(rest).difference(words):
            words[word] = self._some(" " + word)
        return self.starts[first] + b"".join(map(words.__getitem__, rest))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One for each Python worker, kept from task to task."""
    return Encoder(path)


def cut_pieces(
    docs: DataFrame,
    tokenizer: str,
    text: str = "text",
    columns: list[str] | None = None,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """Pieces of documents: ``doc`` (all columns but the text, or those given), piece, start, length, ids.

    A document's tokens are its text's and then ``end_id``. Those longer than ``capacity``
    are cut into full pieces, after a first one that holds the rest. ``ids`` are
    little-endian unsigned 32-bit numbers. Null and empty texts are the end alone; repeated
    rows give repeated pieces. ``tokenizer`` is a file that every executor can open.
    """
    end = np.array([end_id], "<u4").tobytes()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode
        for batch in batches:
            raw = batch.column("text")
            for begin in range(0, batch.num_rows, 256):
                row, piece, start, length, ids = [], [], [], [], []
                for i in range(begin, min(begin + 256, batch.num_rows)):
                    tokens = encode(raw[i].as_py() or "") + end
                    n = len(tokens) // 4
                    cuts = [0, *range(n % capacity or capacity, n + 1, capacity)]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        row.append(i)
                        piece.append(k)
                        start.append(a)
                        length.append(b - a)
                        ids.append(tokens[4 * a : 4 * b])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc").take(pa.array(row, pa.int32())),
                        pa.array(piece, pa.int32()),
                        *(pa.array(values, pa.int64()) for values in (start, length)),
                        pa.array(ids, pa.binary()),
                    ],
                    names=["doc", "piece", "start", "length", "ids"],
                )

    rows = docs.select(carried(docs, columns, text).alias("doc"), docs[f"`{text}`"].alias("text"))
    doc_type = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(
        work, f"doc {doc_type}, piece int, start long, length long, ids binary"
    )


class Plan:
    """Best fit of items known by their lengths' counts, longest first, each into the fullest
    bin that has room.

    Bins with equal room are kept as runs of bin numbers, and the rooms in use are bits of one
    number. The fullest bin with room for an item stays that until it has no room for another,
    so a run takes as many items of a length as fit each of its bins, at once.
    """

    def __init__(self, counts: dict[int, int], capacity: int) -> None:
        self.shift = 62 - capacity.bit_length()
        by_room: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]
        used, self.bins, runs = 0, 0, []
        for size in sorted(counts, reverse=True):
            left, rank = counts[size], 0
            while left:
                fitting = used >> size
                if fitting:
                    room = size + (fitting & -fitting).bit_length() - 1
                    first, bins = by_room[room].pop()
                    if not by_room[room]:
                        used &= ~(1 << room)
                else:
                    room, first, bins = capacity, self.bins, -(-left // (capacity // size))
                    self.bins += bins
                each = room // size
                runs.append(((size << self.shift) + rank, each, first, capacity - room))
                whole = min(bins, left // each)
                some = left - whole * each if whole < bins else 0
                rest = whole + (some > 0)
                for at, n, taken in ((first, whole, each), (first + whole, rest - whole, some), (first + rest, bins - rest, 0)):
                    if n:
                        by_room[room - taken * size].append((at, n))
                        used |= 1 << (room - taken * size)
                left -= whole * each + some
                rank += whole * each + some
        runs.sort()
        self.runs = np.array(runs, np.int64).reshape(-1, 4).T.copy()

    def place(self, sizes: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bin and offset of items by their length and number within it."""
        begin, each, first, offset = self.runs
        key = (sizes << self.shift) + ranks
        run = np.searchsorted(begin, key, "right") - 1
        bin_, at = np.divmod(key - begin[run], each[run])
        return first[run] + bin_, offset[run] + at * sizes


def numbered(sizes: np.ndarray) -> np.ndarray:
    """The number of each item among those of its length."""
    order = np.argsort(sizes, kind="stable")
    _, starts, counts = np.unique(sizes[order], return_index=True, return_counts=True)
    out = np.empty(len(sizes), np.int64)
    out[order] = np.arange(len(sizes)) - np.repeat(starts, counts)
    return out


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each item, longest items first, each into the fullest bin that has room."""
    values, counts = np.unique(sizes, return_counts=True)
    plan = Plan(dict(zip(values.tolist(), counts.tolist())), capacity)
    return plan.place(sizes, numbered(sizes))


def _round(nodes: DataFrame, parts: int, number: int, capacity: int, most: int) -> DataFrame:
    """node, bin, at and fill (of the bin) for nodes of some size, packed in so many tasks."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # numbers of bins: the round, the task, and the bin in the task
        made = (number + 1 << 56) + (TaskContext.get().partitionId() << 32)
        held: list[pa.RecordBatch] = []

        def out(made: int) -> tuple[pa.RecordBatch, int]:
            table = pa.Table.from_batches(held)
            size = np.asarray(table.column("size"))
            bins, at = best_fit(size, capacity)
            fill = np.bincount(bins, size).astype(np.int64)
            columns = [table.column("node").combine_chunks(), *map(pa.array, (bins + made, at, fill[bins]))]
            return pa.RecordBatch.from_arrays(columns, names=["node", "bin", "at", "fill"]), made + len(fill)

        for batch in batches:
            for a in range(0, batch.num_rows, most):
                held.append(batch.slice(a, most))
                # numbers are dealt evenly, so this is for tasks that get several parts
                if sum(one.num_rows for one in held) >= 4 * most:
                    found, made = out(made)
                    held.clear()
                    yield found
        if held:
            yield out(made)[0]

    dealt = nodes.repartition(parts, F.xxhash64("node", F.lit(number)))
    return dealt.select("node", "size").mapInArrow(work, "node long, bin long, at long, fill long")


def pack(
    items: DataFrame,
    length: str = "length",
    capacity: int = CAPACITY,
    task_items: int = TASK_ITEMS,
    fan: int = FAN,
) -> DataFrame:
    """Columns of ``items`` with sequence_id and offset.

    Every item is in one sequence, at an offset without gaps. Lengths are 1 to ``capacity``;
    another one, or null, is an error that names it. Rows of a sequence need not be
    together; repeated rows are packed each for itself. Columns named like the added ones are
    replaced. An empty table gives no rows.
    """
    kept = [name for name in items.columns if name not in ("sequence_id", "offset")]
    size = items[f"`{length}`"].cast("long")
    wrong = F.raise_error(F.format_string("length %s is not 1 to " + str(capacity), F.coalesce(size.cast("string"), F.lit("null"))))
    rows = items.select(
        F.struct(*[items[f"`{name}`"] for name in kept]).alias("item"),
        F.when(size.between(1, capacity), size).otherwise(wrong.cast("long")).alias("size"),
        F.monotonically_increasing_id().alias("node"),
    )
    written = settle(rows, "items")
    parts = max(1, -(-written.count() // task_items))
    first = settle(_round(written, parts, 0, capacity, task_items), "bins")
    placed, rounds = first, []
    while True:
        open_ = placed.where((F.col("at") == 0) & (F.col("fill") < F.lit(capacity * (1 - NEARLY_FULL))))
        nodes = open_.select(F.col("bin").alias("node"), F.col("fill").alias("size"))
        count, fewer = nodes.count(), parts
        if count < 2:
            break
        fewer = max(1, -(-parts // fan), -(-count // task_items))
        placed = settle(_round(nodes, fewer, len(rounds) + 1, capacity, task_items), "bins")
        merged = count - placed.where("at = 0").count()
        rounds.append(placed)
        if not merged and fewer >= parts:
            break
        parts = fewer
    found = first.select("node", F.col("bin").alias("sequence_id"), F.col("at").alias("offset"))
    for placed in rounds:
        up = placed.select(F.col("node").alias("sequence_id"), F.col("bin").alias("up"), F.col("at").alias("shift"))
        found = found.join(up, "sequence_id", "left").select(
            "node",
            F.coalesce("up", "sequence_id").alias("sequence_id"),
            (F.col("offset") + F.coalesce("shift", F.lit(0))).alias("offset"),
        )
    found = settle(found, "places")
    return written.join(found, "node").select("item.*", "sequence_id", "offset")
