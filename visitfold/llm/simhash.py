"""Near-duplicates by fingerprints that differ in a few bits, found with a Golay code.

A 64-bit fingerprint is cut into three segments of at most 23 bits. The perfect binary Golay
code of length 23 maps a segment to the codewords within four bits of it: one, or six if the
nearest is three bits off. Segments that differ in two bits or fewer share such a codeword
(that nearest to a point between them). If fingerprints differ in at most two bits, one of
the three segments is equal, and the segment after it differs in at most two: the key of an
equal segment and a codeword index of the next one joins every such pair. Pairs are then
verified on all bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitfold.llm.common import boxed, carried, offsets, settle, utf8
from visitfold.llm.components import components

# What the query states.
SHINGLE_WORDS = 3
MOST_BITS = 2
HASH_SEED = 42

SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Fingerprints under one key that are still compared pair by pair.
PAIRWISE = 64

# Fixed value: generator polynomial of the binary Golay code, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011
LENGTH, CHECK_BITS = 23, 11


def shingle_hashes(text: bytes, shingle: int = SHINGLE_WORDS) -> np.ndarray:
    """Hashes of a text's lower-cased word shingles; a shorter text is one, without words there is none."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = offsets(sizes + 1)[:-1]
    count = max(1, len(words) - shingle + 1)
    ends = (starts + sizes)[len(words) - count :]
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(joined[a:b], HASH_SEED) for a, b in zip(starts[:count].tolist(), ends.tolist())),
        np.uint64,
        count,
    )


def fingerprint(text: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """Bits that are set in over half the hashes of a text's lower-cased word shingles."""
    hashes = shingle_hashes(text, shingle)
    count = len(hashes)
    ones = np.zeros(64, np.int64)
    for a in range(0, count, 8192):
        octets = hashes[a : a + 8192].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def fingerprints(
    docs: DataFrame, text: str = "text", shingle: int = SHINGLE_WORDS, columns: list[str] | None = None
) -> DataFrame:
    """Every row as ``doc`` (all columns but the text, or those given) with its fingerprint, a long."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("text")
            found = np.array([fingerprint(one.as_py(), shingle) for one in raw], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), pa.array(found.view(np.int64))], names=["doc", "fingerprint"]
            )

    rows = docs.select(carried(docs, columns, text).alias("doc"), utf8(docs[f"`{text}`"]).alias("text"))
    return rows.mapInArrow(work, f"doc {rows.schema['doc'].dataType.simpleString()}, fingerprint long")


def syndrome(words: np.ndarray) -> np.ndarray:
    """Remainder of 23-bit words by the generator; 0 for codewords."""
    rest = words.copy()
    for bit in range(LENGTH - 1, CHECK_BITS - 1, -1):
        rest ^= ((rest >> bit) & 1) * (GENERATOR << (bit - CHECK_BITS))
    return rest


@lru_cache(maxsize=1)
def nearby_errors() -> np.ndarray:
    """For each syndrome, the error patterns of weight four or less, padded with the lightest.

    2,048 x 6: the lightest first; only syndromes of weight three have the five others.
    """
    table = np.full((1 << CHECK_BITS, 6), -1, np.int64)
    filled = np.zeros(1 << CHECK_BITS, np.int64)
    for weight in range(5):
        patterns = [sum(1 << bit for bit in bits) for bits in combinations(range(LENGTH), weight)]
        errors = np.array(patterns, np.int64)
        for code, error in zip(syndrome(errors).tolist(), errors.tolist()):
            table[code, filled[code]] = error
            filled[code] += 1
    return np.where(table < 0, table[:, :1], table)


def codeword_indices(segments: np.ndarray) -> np.ndarray:
    """Message bits of the codewords within four bits of each segment, n x 6 with repeats."""
    words = segments[:, None] ^ nearby_errors()[syndrome(segments)]
    return words >> CHECK_BITS


def fuzzy_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) pairs: which segment, its bits, and an index of the next segment."""
    cut = [((prints >> np.uint64(a)) & np.uint64((1 << n) - 1)).astype(np.int64) for a, n in SEGMENTS]
    rows, keys = [], []
    for i, exact in enumerate(cut):
        index = np.sort(codeword_indices(cut[(i + 1) % len(cut)]), axis=1)
        new = np.ones(index.shape, bool)
        new[:, 1:] = index[:, 1:] != index[:, :-1]
        key = (np.int64(i) << 40) | (exact[:, None] << 12) | index
        rows.append(np.nonzero(new)[0])
        keys.append(key[new])
    return np.concatenate(rows), np.concatenate(keys)


def links(prints: DataFrame, pairwise: int = PAIRWISE) -> DataFrame:
    """Edges a, b between distinct fingerprints that keep all components of "differ in two bits".

    Keys of up to ``pairwise`` fingerprints join their pairs. Fingerprints under a fuller key
    are linked through the points one bit off: two that differ in at most two bits share such
    a point, and all that share one (65 at most) differ in at most two, so linking them to
    their smallest is exact and never compares pairs.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.asarray(batch.column("fingerprint")).view(np.uint64)
            row, key = fuzzy_keys(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found[row].view(np.int64)), pa.array(key)], names=["fingerprint", "key"]
            )

    keys = settle(prints.select("fingerprint").mapInArrow(work, "fingerprint long, key long"), "keys")
    sizes = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    sized = settle(keys.join(sizes, "key"), "keys")
    few = sized.where(F.col("n") <= pairwise)
    pairs = few.select("key", F.col("fingerprint").alias("a")).join(
        few.select(F.col("key").alias("other"), F.col("fingerprint").alias("b")),
        (F.col("key") == F.col("other"))
        & (F.col("a") < F.col("b"))
        & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MOST_BITS),
    )
    full = sized.where(F.col("n") > pairwise).select("fingerprint").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit((1 << i) - (1 << 64 if i == 63 else 0)) for i in range(64)])
    points = full.select("fingerprint", F.explode(flips).alias("flip"))
    around = (
        points.groupBy(F.col("fingerprint").bitwiseXOR(F.col("flip")).alias("point"))
        .agg(F.collect_list("fingerprint").alias("members"))
        .where(F.size("members") > 1)
    )
    stars = around.select(F.array_min("members").alias("a"), F.explode("members").alias("b"))
    return pairs.select("a", "b").unionByName(stars.where("a <> b"))


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE_WORDS,
    columns: list[str] | None = None,
) -> DataFrame:
    """Every row as ``doc`` with its fingerprint, group and component_id.

    ``doc`` has all columns but the text, or those given, the id among them. Rows whose
    fingerprints differ in at most two bits are linked; ``group`` names what is linked and
    component_id is the smallest doc_id in it. Equal fingerprints are one node, so groups
    of copies are never expanded. Null and empty texts have fingerprint zero and are linked
    like others; a null doc_id does not count, and a group without ids has a null one.
    Repeated rows are kept. An empty table gives no rows.
    """
    rows = settle(fingerprints(docs, text, shingle, columns), "fingerprints")
    number = F.col(f"doc.`{doc_id}`")
    nodes = settle(rows.groupBy("fingerprint").agg(F.min(number).alias("first")), "nodes")
    roots = components(links(nodes))
    rooted = nodes.join(roots, nodes["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("group")
    )
    smallest = rooted.groupBy("group").agg(F.min("first").alias("component_id"))
    named = settle(rooted.join(smallest, "group").select("fingerprint", "group", "component_id"), "components")
    return rows.join(named, "fingerprint").select("doc", "fingerprint", "group", "component_id")


def one_of_each(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE_WORDS
) -> DataFrame:
    """One row of each group of near-duplicates: that with the smallest doc_id, a null one last.

    Of rows equal in doc_id and text one stays.
    """
    key = F.xxhash64(docs[f"`{doc_id}`"], docs[f"`{text}`"])
    slim = docs.select(docs[f"`{doc_id}`"].alias("id"), key.alias("key"), docs[f"`{text}`"].alias("text"))
    found = near_duplicates(slim, "id", "text", shingle, ["id", "key"])
    order = F.struct(F.col("doc.id").isNull().alias("last"), F.col("doc.id").alias("id"), F.col("doc.key").alias("key"))
    stay = settle(found.groupBy("group").agg(F.min(order).alias("stay")).select("stay.id", "stay.key"), "stay")
    rows = docs.select(boxed(docs).alias("doc"), docs[f"`{doc_id}`"].alias("number"), key.alias("code"))
    same = F.col("number").eqNullSafe(F.col("id")) & (F.col("code") == F.col("key"))
    return rows.join(stay, same, "left_semi").dropDuplicates(["number", "code"]).select("doc.*")
