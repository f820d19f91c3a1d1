"""Lines that repeat an earlier line up to one word, found by deletion neighbourhoods.

A line is a sequence of words. Two lines are within one edit (a word put in, left out or
replaced) if deleting the same position makes them equal, or deleting a word of one gives
the other. Lines emit the hashes of themselves and of their variants with one word deleted;
equal hashes meet in a join, position and length tell a replaced word from two edits, and a
line is removed if the earliest line it meets comes before it and is, word by word, within
one edit. Lines of few words are removed only if they are equal to an earlier one.

Variants are emitted only where they can matter: two lines within one edit agree in their
first or their second half, so a line none of whose halves occurs in another line has no
partner, and otherwise only the other half's words are deleted.

Few lines have a partner. Joins that keep only such lines are preceded by a bitmap of what is
wanted (``sifted``), so that the rest of the larger side is not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitfold.llm.common import boxed, discard, offsets, settle, sifted, utf8

#: Shorter lines have to be equal: one word is too much of them.
MIN_WORDS = 5
HALVES = 3
#: Variants in a batch for Spark: a line has one a word, so lines alone do not bound it.
VARIANT_ROWS = 1 << 16

# Two odd numbers from which the multipliers of places are made, from the golden ratio and from pi.
SEEDS = (0x9E3779B97F4A7C15, 0x3243F6A8885A308D)


def document_key(docs: DataFrame, doc_id: str, text: str) -> Column:
    return F.xxhash64(docs[f"`{doc_id}`"], docs[f"`{text}`"])


def halves(words: list[bytes]) -> list[int]:
    """Hashes of the halves that a line shares with one of its length, one shorter or longer.

    For the shorter length m of a pair: the first m // 2 words, the last m - m // 2. Of the
    two lengths that a line can have the role of, one of these four is always the same.
    """
    n = len(words)
    parts = [b"P " + b" ".join(words[: n // 2])]
    if n % 2:
        parts += [b"S " + b" ".join(words[n // 2 :]), b"S " + b" ".join(words[n // 2 + 1 :])]
    else:
        parts += [b"P " + b" ".join(words[: n // 2 - 1]), b"S " + b" ".join(words[n // 2 :])]
    return [xxhash.xxh64_intdigest(part) for part in parts]


def positions(n: int, mask: int) -> np.ndarray:
    """Words to delete, given which of a line's ``halves`` occur elsewhere."""
    first, last = n, 0
    shared = [n // 2, -(n - n // 2), -(n - n // 2 - 1)] if n % 2 else [n // 2, n // 2 - 1, -(n // 2)]
    for bit, words in enumerate(shared):
        if mask >> bit & 1:
            if words >= 0:
                first = min(first, words)
            else:
                last = max(last, n + words)
    if first <= last:
        return np.arange(n)
    return np.concatenate((np.arange(last), np.arange(first, n)))


def _as_long(values: list[int]) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def _digests(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.frombuffer(b"".join(raw), "<i8").reshape(-1, 2)
    return np.ascontiguousarray(pairs[:, 0]), np.ascontiguousarray(pairs[:, 1])


def _lines(docs: DataFrame, doc_id: str, text: str, min_words: int) -> DataFrame:
    """A row for each line that has a word, and one for each document at line -1.

    Lines under ``min_words`` have no halves: only equal ones meet. The document's row has the
    number of its lines that have a word in ``n``.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("text")
            for a in range(0, batch.num_rows, 500):
                row, line, size, digest, half, count = [], [], [], [], [], []
                for i in range(a, min(a + 500, batch.num_rows)):
                    filled = 0
                    for at, one in enumerate(raw[i].as_py().split(b"\n")):
                        words = one.split()
                        filled += bool(words)
                        near = len(words) >= min_words
                        if words:
                            row.append(i)
                            line.append(at)
                            size.append(len(words))
                            digest.append(xxhash.xxh3_128_digest(b" ".join(words)))
                            half += halves(words) if near else []
                            count.append(HALVES if near else 0)
                    row.append(i)
                    line.append(-1)
                    size.append(filled)
                    digest.append(bytes(16))
                    count.append(0)
                at = pa.array(row, pa.int32())
                h1, h2 = _digests(digest)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(at),
                        batch.column("key").take(at),
                        pa.array(line, pa.int32()),
                        pa.array(size, pa.int32()),
                        pa.array(h1),
                        pa.array(h2),
                        pa.ListArray.from_arrays(
                            pa.array(offsets(np.array(count, np.int64)), pa.int32()), pa.array(_as_long(half))
                        ),
                    ],
                    names=["doc_id", "key", "line", "n", "h1", "h2", "halves"],
                )

    rows = docs.select(
        docs[f"`{doc_id}`"].cast("long").alias("doc_id"),
        document_key(docs, doc_id, text).alias("key"),
        utf8(docs[f"`{text}`"]).alias("text"),
    )
    return rows.mapInArrow(
        work, "doc_id long, key long, line int, n int, h1 long, h2 long, halves array<long>"
    )


def _line_texts(docs: DataFrame, text: str, min_words: int) -> DataFrame:
    """h1, h2 and the words of all lines of so many words."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("text")
            for a in range(0, batch.num_rows, 500):
                found: dict[bytes, bytes] = {}
                for i in range(a, min(a + 500, batch.num_rows)):
                    for one in raw[i].as_py().split(b"\n"):
                        words = one.split()
                        if len(words) >= min_words:
                            line = b" ".join(words)
                            found[xxhash.xxh3_128_digest(line)] = line
                h1, h2 = _digests(list(found))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h1), pa.array(h2), pa.array(list(found.values()), pa.binary())],
                    names=["h1", "h2", "words"],
                )

    return docs.select(utf8(docs[f"`{text}`"]).alias("text")).mapInArrow(
        work, "h1 long, h2 long, words binary"
    )


def _multipliers(count: int, seed: int) -> np.ndarray:
    """An odd number for every place of a sequence, by the SplitMix64 mixer."""
    z = np.arange(1, count + 1, dtype=np.uint64) * np.uint64(seed)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (z ^ (z >> np.uint64(31))) | np.uint64(1)


def variants(words: list[bytes], at: np.ndarray) -> list[np.ndarray]:
    """Two hashes of the whole line and of it with each word of ``at`` deleted.

    Sums of the words' codes, each times a number that its place alone decides.
    """
    codes = np.array([xxhash.xxh64_intdigest(word) for word in words], np.uint64)
    zero = np.zeros(1, np.uint64)
    out = []
    for seed in SEEDS:
        by_place = _multipliers(len(codes), seed)
        before = np.concatenate((zero, np.cumsum(by_place * codes)))
        # words behind the deleted one move up by one place
        moved = np.concatenate((zero, np.cumsum(by_place[:-1] * codes[1:])))
        out.append(np.concatenate((before[-1:], before[at] + (moved[-1] - moved[at]))))
    return out


def variant_batches(batch: pa.RecordBatch, most: int = VARIANT_ROWS) -> Iterator[pa.RecordBatch]:
    """Variants of a batch of lines, ``most`` and one line's at once."""
    masks = batch.column("mask").to_pylist()
    raw = batch.column("words")
    one, two, place, count, held, begin = [], [], [], [], 0, 0
    for i in range(batch.num_rows):
        words = raw[i].as_py().split()
        at = positions(len(words), masks[i])
        v1, v2 = variants(words, at)
        one.append(v1)
        two.append(v2)
        place.append(np.concatenate(([-1], at)))
        count.append(len(v1))
        held += len(v1)
        if held >= most or i + 1 == batch.num_rows:
            row = pa.array(np.repeat(np.arange(begin, i + 1), count))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(one).view(np.int64)),
                    pa.array(np.concatenate(two).view(np.int64)),
                    pa.array(np.concatenate(place).astype(np.int32)),
                    batch.column("h1").take(row),
                    batch.column("h2").take(row),
                ],
                names=["v1", "v2", "at", "h1", "h2"],
            )
            one, two, place, count, held, begin = [], [], [], [], 0, i + 1


def _variants(lines: DataFrame) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from variant_batches(batch)

    return lines.mapInArrow(work, "v1 long, v2 long, at int, h1 long, h2 long")


def _partners(lines: DataFrame, docs: DataFrame, text: str, min_words: int) -> tuple[DataFrame, DataFrame]:
    """Variants (v1, v2, at, h1, h2) that occur in more than one line, and the words of such lines."""
    each = lines.select("h1", "h2", F.posexplode("halves").alias("bit", "half"))
    differ = (F.min("h1") < F.max("h1")).alias("differ")
    shared = each.groupBy("half").agg(differ).where("differ").select("half")
    shared = settle(shared, "halves")  # a table of its own, so that a join splits a hot half
    masks = sifted(each, shared, ["half"]).join(shared, "half").groupBy("h1", "h2").agg(F.bit_or(F.expr("shiftleft(1, bit)")).alias("mask"))
    masks = settle(masks, "candidates")
    needed = sifted(_line_texts(docs, text, min_words), masks, ["h1", "h2"])
    texts = settle(needed.join(masks, ["h1", "h2"]).dropDuplicates(["h1", "h2"]), "texts")
    discard(shared, masks)
    emitted = settle(_variants(texts.select("h1", "h2", "mask", "words")), "variants")
    met = emitted.groupBy("v1", "v2").agg(differ).where("differ").select("v1", "v2")
    met = settle(met, "met")
    partners = settle(sifted(emitted, met, ["v1", "v2"]).join(met, ["v1", "v2"]), "partners")
    discard(emitted, met)
    return partners, texts


def within_one_word(one: list[bytes], two: list[bytes]) -> bool:
    """Whether a word put in, left out or replaced makes one line the other."""
    same = 0
    while same < min(len(one), len(two)) and one[same] == two[same]:
        same += 1
    a, b = one[same:], two[same:]
    return a[1:] == b[1:] or a[1:] == b or a == b[1:]


def _verified(pairs: DataFrame) -> DataFrame:
    """h1, h2 of lines whose ``words`` are within one word of ``others``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column("words"), batch.column("others"))
            holds = [within_one_word(one.as_py().split(), two.as_py().split()) for one, two in both]
            yield batch.filter(pa.array(holds, pa.bool_())).select(["h1", "h2"])

    return pairs.select("h1", "h2", "words", "others").mapInArrow(work, "h1 long, h2 long")


def _earlier(partners: DataFrame, texts: DataFrame, firsts: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Lines (h1, h2) with an earlier line within one edit, and the tables to discard after them.

    A line with a word deleted meets others with the word at the same place deleted (it is
    replaced there) and the line that is the rest (the word is put in). Minima are a table
    before they are joined, so that a join splits a variant that very many lines have. A
    variant has as many minima as its line has words, so a window over them stays small.
    """
    ordered = settle(partners.join(sifted(firsts, partners, ["h1", "h2"]), ["h1", "h2"]), "ordered")
    whole = F.col("at") < 0
    places = ordered.groupBy("v1", "v2", "at").agg(F.min("first").alias("least"))
    variant = Window.partitionBy("v1", "v2")
    rest = F.min(F.when(whole, F.col("least"))).over(variant)
    longer = F.min(F.when(~whole, F.col("least"))).over(variant)
    before = F.when(whole, longer).otherwise(F.least("least", rest))
    minima = settle(places.select("v1", "v2", "at", before.alias("before")), "minima")
    met = (
        ordered.join(minima, ["v1", "v2", "at"])
        .where("before < first")
        .groupBy("h1", "h2")
        .agg(F.min("before").alias("before"))
    )
    own = texts.select("h1", "h2", "words")
    other = texts.select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), F.col("words").alias("others"))
    earlier = (F.col("before.h1") == F.col("g1")) & (F.col("before.h2") == F.col("g2"))
    repeats = _verified(met.join(own, ["h1", "h2"]).join(other, earlier)).withColumn("repeats", F.lit(True))
    return repeats, [ordered, minima]


def repeated_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """For every row: doc_id, key, n_lines (with a word) and removed, the numbers of its lines to go.

    Lines are cut at line feeds and numbered from 0; words decide, not the white space
    between them. A line goes if an equal line is earlier in (doc_id, key, line), a null doc_id
    last; one of ``min_words`` or more goes also if a line within one word of it is. Of the
    lines that a line meets only the earliest is compared word by word. That is decided on all
    lines as given: a line may go because of one that goes itself. Rows equal in doc_id and
    text count once and are treated alike. Null and empty texts have no lines.
    """
    lines = settle(_lines(docs, doc_id, text, min_words), "lines")
    real = lines.where("line >= 0")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key", "line", "h1", "h2")
    several = (F.count(F.lit(1)) > 1).alias("several")
    firsts = settle(real.groupBy("h1", "h2").agg(F.min(place).alias("first"), several), "firsts")
    partners, texts = _partners(real, docs, text, min_words)
    repeats, spent = _earlier(partners, texts, firsts.drop("several"))
    # a line that occurs once stays unless it repeats another
    judged = firsts.where("several").drop("several").join(repeats, ["h1", "h2"], "full")
    judged = settle(judged, "judged")
    discard(firsts, partners, texts, *spent)
    goes = F.col("repeats").isNotNull() | (place != F.col("first"))
    gone = (
        real.select("doc_id", "key", "line", "h1", "h2")
        .join(judged, ["h1", "h2"])
        .where(goes)
        .groupBy(F.col("doc_id").alias("id"), F.col("key").alias("code"))
        .agg(F.array_sort(F.collect_set("line")).alias("removed"))
    )
    gone = settle(gone, "gone")
    discard(judged)
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("code"))
    none = F.array().cast("array<int>")
    return (
        lines.where("line < 0")
        .join(gone, same, "left")
        .select("doc_id", "key", F.col("n").alias("n_lines"), F.coalesce("removed", none).alias("removed"))
    )


def drop_repeated_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS
) -> DataFrame:
    """Every row as ``doc``, with ``text`` without its repeated lines and ``changed``.

    ``text`` keeps the other lines as they are; a text that loses nothing stays, null too.
    """
    cuts = repeated_lines(docs, doc_id, text, min_words).where("size(removed) > 0")
    cuts = settle(cuts.select("doc_id", "key", "removed").dropDuplicates(["doc_id", "key"]), "cuts")
    rows = docs.select(
        boxed(docs).alias("doc"),
        docs[f"`{doc_id}`"].cast("long").alias("number"),
        document_key(docs, doc_id, text).alias("code"),
        docs[f"`{text}`"].alias("text"),
    )
    same = F.col("number").eqNullSafe(F.col("doc_id")) & (F.col("code") == F.col("key"))
    changed = F.col("removed").isNotNull()
    split = rows.join(cuts, same, "left").select(
        "doc", "text", "removed", F.when(changed, F.split("text", "\n", -1)).alias("lines")
    )
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("removed"))
    kept = F.array_join(F.transform(left, lambda at: F.element_at("lines", at + 1)), "\n")
    return split.select("doc", F.when(changed, kept).otherwise(F.col("text")).alias("text"), changed.alias("changed"))
