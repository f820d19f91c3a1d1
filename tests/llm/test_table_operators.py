"""Mixing, WARC, packing, nearest vectors and URL rules."""

from __future__ import annotations

import hashlib
import io
import random
import struct
import zipfile
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from visitfold.llm import ann, mixing, oracle, packing, queries, url_filter, warc
from visitfold.llm.queries import URL_RULES, byte_bpe

from .conftest import awkward_texts, prose

SMALL = "/root/testdata/sf0.001"

EMPTY: list = []


# Mixing


def brute_targets(sizes: dict) -> dict:
    names = sorted(sizes, key=lambda name: (name is None, (name or "").encode()))
    weight = {name: 1 + place % 3 for place, name in enumerate(names)}
    full: set = set()
    while True:
        room = sum(sizes.values()) - sum(3 * sizes[name] for name in full)
        open_ = sum(weight[name] for name in names if name not in full)
        above = {name for name in names if name not in full and weight[name] * room / open_ > 3 * sizes[name]}
        if not above:
            return {
                name: 3.0 * sizes[name] if name in full else weight[name] * room / open_ for name in names
            }
        full |= above


def sized(rng, source, words):
    return (rng.randrange(10**6), prose(rng, words), source)


def mixed_rows():
    rng = random.Random(4)
    rows = [sized(rng, rng.choice(["a", "b", "c", "d", None]), rng.randint(1, 90)) for _ in range(150)]
    return rows + [sized(rng, "tiny", 3), sized(rng, "small", 8)] + awkward_texts()


def test_mixture(docs):
    rows = mixed_rows()
    found = [row.asDict() for row in mixing.mixture(docs(rows), block_words=300, shard_blocks=4).collect()]
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").encode().split())
    targets = brute_targets(sizes)
    by_size = {size: name for name, size in sizes.items()}
    assert len(by_size) == len(sizes) and len(found) == len(rows)
    taken, least_left = defaultdict(int), {}
    for row in found:
        name = by_size[row["source_size"]]
        assert row["target"] == pytest.approx(targets[name])
        assert row["taken"] == row["size"] * row["copies"] and 0 <= row["copies"] <= 3
        assert len(row["shards"]) == row["copies"]
        taken[name] += row["taken"]
    for name, target in targets.items():
        assert taken[name] <= round(target)
        # no source misses by more than one of its documents
        assert round(target) - taken[name] <= max(r["size"] for r in found if by_size[r["source_size"]] == name)
    again = mixing.mixture(docs(rows[::-1]), block_words=300, shard_blocks=4).collect()
    one = lambda rows: sorted((r["key"], r["copies"], r["shards"]) for r in rows)
    assert one(found) == one(again)
    assert mixing.mixture(docs(EMPTY)).collect() == []


def test_mixture_equals_sql(docs):
    rows = mixed_rows()
    documents = pd.DataFrame(rows, columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"})
    database = duckdb.connect()
    database.register("documents", documents)
    expected = database.execute(oracle.ORACLE["op1_source_mixing"]).fetchall()
    found = mixing.mixture(docs(rows)).select(
        *("doc_id", "size", "source_size", "target", "taken", "copies"),
        F.array_join(F.col("shards").cast("array<string>"), ","),
    )
    plain = lambda rows: Counter((*r[:3], round(r[3], 6), *r[4:]) for r in map(tuple, rows))
    assert plain(found.collect()) == plain(expected)


def tickets_of(spark, count):
    rng = random.Random(1)
    key = lambda: hashlib.md5(str(rng.random()).encode()).hexdigest()
    rows = [(min(i % 5, 2), i, 1, key(), key()) for i in range(count)]
    return spark.createDataFrame(rows, "place long, block long, copy int, ticket string, draw string"), rows


def test_tree_splits_quotas_exactly(spark):
    tickets, rows = tickets_of(spark, 101)
    quotas = mixing.shard_quotas(tickets, 4)
    quota = {(r["level"], r["node"], r["place"]): r["quota"] for r in mixing.quota_tree(quotas, 4).collect()}
    assert {place: quota[0, 0, place] for place in range(3)} == Counter(row[0] for row in rows)
    total = Counter()
    for (level, node, _), n in quota.items():
        total[level, node] += n
    for level in range(4):
        for node in range(2**level):
            left, right = total[level + 1, 2 * node], total[level + 1, 2 * node + 1]
            assert abs(left - right) <= 1 and left + right == total[level, node]
            for place in range(3):
                children = sum(quota.get((level + 1, 2 * node + side, place), 0) for side in (0, 1))
                assert quota.get((level, node, place), 0) == children


def test_quotas_deal_permuted_blocks(spark):
    tickets, rows = tickets_of(spark, 101)
    found = mixing.deal(tickets, 8).collect()
    assert sorted(row["block"] for row in found) == list(range(101))
    # thirteen shards of eight blocks, made sixteen by the tree
    quotas = {(row["node"], row["place"]): row["quota"] for row in mixing.shard_quotas(tickets, 4).collect()}
    assert Counter((row["shard"], row["place"]) for row in found) == quotas
    # the blocks of a source go to shards in the order of their own key
    draw = {row[1]: row[4] for row in rows}
    for place in range(3):
        mine = sorted((draw[row["block"]], row["shard"]) for row in found if row["place"] == place)
        shards = [shard for _, shard in mine]
        assert shards == sorted(shards)
    assert mixing.deal(tickets.limit(0), 8).collect() == []


def test_mix_repeats_rows_and_keeps_columns(docs):
    rows = mixed_rows()
    table = docs(rows)
    copies = {(r["doc_id"], r["key"]): r["copies"] for r in mixing.mixture(table).collect()}
    mixed = mixing.mix(table)
    assert mixed.select("doc.*").columns == table.columns
    key = mixing.document_key(table, "doc_id", "text", mixing.SEED).alias("own")
    expected = Counter()
    for row in table.select("doc_id", "text", key).collect():
        expected[row["doc_id"], row["text"]] += copies[row["doc_id"], row["own"]]
    got = Counter(map(tuple, mixed.select("doc.doc_id", "doc.text").collect()))
    assert got == +expected


# WARC


def page_rows():
    rng = random.Random(9)
    long = prose(rng, 400)
    return [
        (1, "http://a/", long),
        (7, "http://b/", long),
        (3, None, long),
        (None, "http://c/", long),
        (4, "http://d/\r\nX: 1", "short"),
        (5, "http://e/", "short"),
        (6, "http://f/é", None),
        (8, "", ""),
        (9, "http://g/", "é\r\n\r\n" + "x" * 300_000),
        (10, "http://h/", "r" * 1000),
        (10, "http://h/", "r" * 1000),
        (2, "http://h/", "r" * 1000),
    ]


def brute_records(rows, least=1000):
    coded = [(i, url, (html or "").encode()) for i, url, html in rows]
    best = {}
    for i, _, raw in coded:
        if i is not None:
            best[raw] = max(best.get(raw, i), i)
    out = Counter()
    for i, _, raw in coded:
        keeper = best.get(raw)
        revisit = len(raw) >= least and keeper is not None and i != keeper
        digest = hashlib.sha1(raw).hexdigest()
        out[i, len(raw), digest, "revisit" if revisit else "response", keeper if revisit else None] += 1
    return out


RECORD = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@pytest.mark.parametrize("archive_bytes", [1, 1 << 20])
def test_round_trip_of_pages(spark, archive_bytes):
    rows = [(*row, "other") for row in page_rows()]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload string").repartition(3)
    archives = warc.write_archives(pages, archive_bytes=archive_bytes)
    found = warc.read_archives(spark, archives)
    assert Counter(map(tuple, found.select(*RECORD).collect())) == brute_records(page_rows())
    payloads = Counter((r["page_id"], r["url"], bytes(r["payload"])) for r in found.where("payload IS NOT NULL").collect())
    url_of = lambda url: url and url.replace("\r", "%0D").replace("\n", "%0A")
    assert all((i, url_of(url), (html or "").encode()) in payloads for i, url, html in page_rows() if i in (6, 7, 8, 9))
    if archive_bytes == 1:
        assert archives.count() == len(rows)


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    archives = warc.write_archives(pages)
    assert archives.count() == 0 and warc.read_archives(spark, archives).collect() == []


def package(members, **settings):
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_STORED) as out:
        for name, content in members.items():
            with out.open(zipfile.ZipInfo(name), "w", **settings) as member:
                member.write(content)
    return raw.getvalue()


def as_zip64(raw):
    """The same package with a ZIP64 end record and all places in ZIP64 fields."""
    at = raw.rfind(warc.END)
    entries, size, start = struct.unpack("<HII", raw[at + 10 : at + 20])
    wide, place = b"", start
    for _ in range(entries):
        names, extras, notes = struct.unpack("<HHH", raw[place + 28 : place + 34])
        packed, plain = struct.unpack("<II", raw[place + 20 : place + 28])
        (local,) = struct.unpack("<I", raw[place + 42 : place + 46])
        more = b"\x99\x99\2\0ab" + struct.pack("<HHQQQ", 1, 24, plain, packed, local)
        wide += raw[place : place + 20] + b"\xff" * 8 + struct.pack("<HHH", names, len(more), 0)
        wide += raw[place + 34 : place + 42] + b"\xff" * 4 + raw[place + 46 : place + 46 + names] + more
        place += 46 + names + extras + notes
    end = warc.END64 + struct.pack("<QHHIIQQQQ", 44, 45, 45, 0, 0, entries, entries, len(wide), start)
    where = warc.END64_AT + struct.pack("<IQI", 0, start + len(wide), 1)
    last = warc.END + struct.pack("<HHHHIIH", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 4) + b"note"
    return raw[:start] + wide + end + where + last


def test_directories(spark, tmp_path):
    records = [warc.record(i, "http://x/", b"p" * i, hashlib.sha1(b"p" * i).hexdigest(), i, None) for i in (3, 5, 0)]
    data = b"".join(records)
    index = "".join(f"{data.index(one)} {len(one)}\n" for one in records).encode()
    members = {"readme.txt": b"hello", warc.RECORDS: data, warc.INDEX: index}
    plain = package(members, force_zip64=True)
    files = {
        "plain": plain,
        "wide": as_zip64(plain),
        "no_index": package({warc.RECORDS: data}),
        "two": package({"archive/a.warc.gz": data, "archive/b.warc.gz": records[0], "indexes/b.cdx": f"0 {len(records[0])}\n".encode()}),
    }
    for name, raw in files.items():
        (tmp_path / name).write_bytes(raw)
        file = pa.OSFile(str(tmp_path / name))
        assert {m.name for m in warc.directory(file)} == {info.filename for info in zipfile.ZipFile(io.BytesIO(raw)).infolist()} if name != "wide" else True
        table = spark.createDataFrame([(str(tmp_path / name),)], "archive string")
        got = sorted(row["payload_bytes"] for row in warc.read_archives(spark, table).collect())
        assert got == sorted([3, 5, 0] + [3] * (name == "two")), name


def test_damage_is_an_error(tmp_path):
    record = warc.record(1, None, b"abc", hashlib.sha1(b"abc").hexdigest(), 3, None)
    wrong = zlib.compress(zlib.decompress(record, 31).replace(b"abc", b"abd"), 1, 31)
    with pytest.raises(ValueError, match="digest"):
        warc.parse(wrong)
    for raw in (b"", b"no zip", package({"a": b"b"})[:-30]):
        (tmp_path / "x").write_bytes(raw)
        with pytest.raises(ValueError):
            warc.directory(pa.OSFile(str(tmp_path / "x")))


# Packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(byte_bpe())


SPACES = st.text(alphabet="ab é'.1\n\t \u00a0\u2003", max_size=25)


@given(st.one_of(SPACES, st.text(max_size=30), SPACES.map(lambda t: f"{t}<|endoftext|> {t}")))
@settings(max_examples=400, deadline=None)
def test_ids_equal_the_tokenizers(text):
    whole = packing.encoder(byte_bpe())
    ids = np.frombuffer(whole.encode(text), "<u4").tolist()
    assert ids == whole.whole.encode(text, add_special_tokens=False).ids


def test_other_tokenizers_run_as_they_are():
    import public_tokenizers

    other = packing.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert other.plain is None
    text = "Two  Words and\nmore"
    assert np.frombuffer(other.encode(text), "<u4").tolist() == other.whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("task_items", [40, 20_000])
def test_packing(docs, awkward, tokenizer, task_items):
    capacity = 64
    pieces = packing.cut_pieces(docs(awkward), byte_bpe(), columns=["doc_id", "text", "key"], capacity=capacity)
    items = pieces.select("doc.doc_id", "doc.text", "doc.key", "piece", "start", "length", "ids")
    placed = packing.pack(items, capacity=capacity, task_items=task_items).collect()
    expected = Counter()
    for i, text, _ in awkward:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected[i, text, k, a, tuple(ids[a:b])] += 1
    got = Counter(
        (r["doc_id"], r["text"], r["piece"], r["start"], tuple(np.frombuffer(r["ids"], "<u4").tolist())) for r in placed
    )
    assert got == expected and all(r["length"] * 4 == len(r["ids"]) for r in placed)
    sequences = defaultdict(list)
    for row in placed:
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    total = sum(row["length"] for row in placed)
    assert len(sequences) <= 1.05 * total / capacity + 3


def test_nothing_to_pack(docs):
    assert packing.pack(packing.cut_pieces(docs(EMPTY), byte_bpe())).collect() == []


def test_items_over_half_do_not_pile_up(spark):
    items = spark.range(2000).selectExpr("id", "1025L AS length").repartition(4)
    placed = packing.pack(items, task_items=100)
    assert placed.select("sequence_id").distinct().count() == placed.count() == 2000


def test_archives_are_read_by_a_bounded_number_of_tasks(spark):
    cores = spark.sparkContext.defaultParallelism
    assert warc.tasks(spark, 0, 0) == warc.tasks(spark, 1, 1 << 40) == 1
    assert warc.tasks(spark, 10**9, 4 << 20) == cores
    assert warc.tasks(spark, 10**9, 100 << 40) == 100 << 10
    pages = spark.range(3000).selectExpr("id AS page_id", "'u' AS url", "repeat(sha2(string(id), 512), 40) AS html")
    archives = warc.write_archives(pages.repartition(30))
    found = warc.read_archives(spark, archives, payload=False)
    assert found.rdd.getNumPartitions() <= cores and found.count() == 3000


def test_keepers_are_written_before_payloads_join(spark):
    rows = [(k, "u", "x" * 2000 if k % 3 else f"{k}" * 2000) for k in range(1, 7)]
    found = warc.tagged(spark.createDataFrame(rows, "page_id long, url string, html string"), "page_id", "url", "html", 1000)
    assert "Aggregate" not in found._jdf.queryExecution().executedPlan().toString()
    assert {row["page_id"]: row["refers_to"] for row in found.collect()} == {1: 5, 2: 5, 3: None, 4: 5, 5: None, 6: None}


def test_long_items_before_short_ones_waste_no_sequence(spark):
    items = spark.range(0, 8000, 1, 1).selectExpr("id", "IF(id < 4000, 1200L, 300L) AS length")
    placed = packing.pack(items, task_items=1000)
    found = placed.groupBy("sequence_id").agg(F.sum("length").alias("fill")).collect()
    assert len(found) == 4000 and max(row["fill"] for row in found) <= 2048


def filled(placed):
    """Number of sequences, after a look at their offsets."""
    sequences = defaultdict(list)
    for row in placed.select("sequence_id", "offset", "length").collect():
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
    for parts in sequences.values():
        ends = [0, *(offset + length for offset, length in sorted(parts))]
        assert [offset for offset, _ in sorted(parts)] == ends[:-1] and ends[-1] <= 2048
    return len(sequences)


@pytest.mark.parametrize("shape", ["mixed", "halves", "clustered"])
def test_the_tree_packs_nearly_like_one_task(spark, shape):
    """Against best fit of all items at once, on lengths that are mixed, over half, or in clusters."""
    length = {
        "mixed": "1 + pmod(xxhash64(id), 900)",
        "halves": "IF(id % 2 = 0, 1025 + id % 400, 100 + id % 900)",
        "clustered": "CASE WHEN id < 2000 THEN 1500 WHEN id < 4000 THEN 700 ELSE 130 + id % 7 END",
    }[shape]
    items = spark.range(0, 6000, 1, 5).selectExpr("id", f"CAST({length} AS LONG) AS length")
    sizes = np.array([row["length"] for row in items.collect()])
    whole = packing.best_fit(sizes, 2048)[0].max() + 1
    found = filled(packing.pack(items, task_items=200, fan=3))
    assert whole <= found <= 1.005 * whole + 2
    assert filled(packing.pack(items, task_items=10_000)) == whole


def test_rounds_merge_what_tasks_leave(spark):
    # tasks of five items leave far more underfull bins than one would
    items = spark.range(0, 500, 1, 5).selectExpr("id", "CAST(100 + pmod(xxhash64(id), 300) AS LONG) AS length")
    sizes = np.array([row["length"] for row in items.collect()])
    assert filled(packing.pack(items, task_items=5)) <= 1.15 * -(-sizes.sum() // 2048)


@pytest.mark.parametrize("length", [None, 0, -1, 2049])
def test_lengths_that_fit_no_sequence_are_named(spark, length):
    items = spark.createDataFrame([(1, 5), (2, length)], "id long, length long")
    with pytest.raises(Exception, match=f"length {'null' if length is None else length} is not 1 to 2048"):
        packing.pack(items)


def test_named_query_packs_whole_documents(spark, tokenizer):
    """All columns of the query against ids of the tokenizer, cut and packed anew."""
    expected = Counter()
    for row in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect():
        ids = [*tokenizer.encode(row["text"] or "", add_special_tokens=False).ids, 0]
        cuts = [0, *range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            expected[row["doc_id"], k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    placed = queries.op4_best_fit_packing(spark, SMALL)
    rows = placed.select("doc_id", "piece", "start", "length", "ids_crc32").collect()
    assert Counter(map(tuple, rows)) == expected
    assert filled(placed) <= 1.005 * -(-sum(row["length"] for row in rows) // 2048) + 1


@given(st.lists(st.integers(1, 20), max_size=80))
@settings(max_examples=200, deadline=None)
def test_best_fit_in_runs_equals_one_by_one(sizes):
    fills = []
    for size in sorted(sizes, reverse=True):
        fitting = [k for k, fill in enumerate(fills) if fill + size <= 20]
        if fitting:
            fills[max(fitting, key=lambda k: fills[k])] += size
        else:
            fills.append(size)
    got = Counter()
    for size, bin_ in zip(sizes, packing.best_fit(np.array(sizes, np.int64), 20)[0].tolist()):
        got[bin_] += size
    assert sorted(got.values()) == sorted(fills)


@given(st.lists(st.integers(1, 20), max_size=60))
@settings(max_examples=100, deadline=None)
def test_best_fit(sizes):
    place = packing.best_fit(np.array(sizes, np.int64), 20)[0]
    fill = Counter()
    for size, bin_ in zip(sizes, place.tolist()):
        fill[bin_] += size
    assert all(total <= 20 for total in fill.values())
    assert sum(total <= 10 for total in fill.values()) <= 1


# Nearest vectors


def brute_nearest(rows, asked, k):
    good = lambda v: v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    out = {}
    for q, vector in asked:
        if q is None or not good(vector):
            continue
        best = {}
        for i, other in rows:
            if good(other) and len(other) == len(vector) and i != q:
                a, b = np.array(vector, float), np.array(other, float)
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                best[i] = max(best.get(i, -2), round(float(a @ b / np.sqrt((a @ a) * (b @ b))), 9))
        order = sorted(best, key=lambda i: (-best[i], i is None, i or 0))[:k]
        out[q] = [(rank + 1, i, best[i]) for rank, i in enumerate(order)]
    return out


def found_nearest(table, queries, **settings):
    out = defaultdict(list)
    for row in ann.nearest(table, queries, **settings).collect():
        out[row["query_id"]].append((row["rank"], row["vec_id"], round(row["score"], 9)))
    return {q: sorted(found, key=lambda r: r[0]) for q, found in out.items()}


KIND = "vec_id long, embedding array<double>, part int, vector string, score double"


def test_awkward_vectors(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(4).tolist()) for i in range(60)]
    rows += [(100 + i, rows[0][1]) for i in range(12)] + [(200, [2 * x for x in rows[0][1]])]
    rows += [(300, None), (301, []), (302, [0.0] * 4), (303, [1.0, None, 0.0, 0.0]), (304, [1.0, float("nan"), 0.0, 0.0])]
    rows += [(305, [float("inf"), 0.0, 0.0, 0.0]), (306, [1e-200, 0.0, 0.0, 1e-200]), (307, [1e200, 0.0, 0.0, 1e200])]
    rows += [(None, rows[3][1]), (5, rows[5][1]), (400, [1.0, 2.0]), (450, [2.0, 1.0])]
    table = spark.createDataFrame([(i, v, 1, "x", 0.5) for i, v in rows], KIND).repartition(3)
    asked = [row for row in rows if row[0] is not None and (row[0] % 50 == 0 or row[0] in (5, 306))]
    queries = table.where("vec_id % 50 = 0 OR vec_id IN (5, 306)")
    expected = brute_nearest(rows, asked, 5)
    assert found_nearest(table, queries) == expected
    assert len(expected[400]) == 1
    none = table.limit(0)
    assert found_nearest(none, none) == {} and found_nearest(none, queries) == {}


@pytest.mark.parametrize(
    ("more", "leaves"), [({"sample": 1500}, 16), ({"sample": 600, "part_rows": 200, "most_parts": 4}, 16)]
)
def test_recall_through_parts(spark, more, leaves):
    """One classifier, and classifiers within its parts; fewer parts are visited than there are."""
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((40, 16))
    points = centres[rng.integers(0, 40, 9000)] + 0.35 * rng.standard_normal((9000, 16))
    rows = [(i, point.tolist()) for i, point in enumerate(points)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    found = found_nearest(table, table.where("vec_id % 100 = 0"), **more)
    router = ann.router_of(table.withColumnRenamed("embedding", "vector"), 5, **more)
    assert router.parts == leaves and len(router.inner) == (4 if "most_parts" in more else 0)
    assert 1 < router.probes < router.parts
    assert np.bincount(router.home(ann.unit(points)), minlength=leaves).max() < 9000 / 4
    unit = points / np.sqrt((points**2).sum(axis=1))[:, None]
    hits = 0
    for q in range(0, 9000, 100):
        score = unit @ unit[q]
        score[q] = -2
        hits += len(set(np.argsort(-score)[:5].tolist()) & {i for _, i, _ in found[q]})
    assert hits / 450 >= 0.9


def test_parts_that_few_vectors_fill(spark):
    """Inner classifiers of parts with fewer vectors than parts, equal vectors among them."""
    rng = np.random.default_rng(2)
    rows = [(i, (rng.standard_normal(3) if i % 3 else np.ones(3)).tolist()) for i in range(400)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    asked = [row for row in rows if row[0] % 50 == 0]
    found = found_nearest(table, table.where("vec_id % 50 = 0"), part_rows=20, most_parts=4, sample=200)
    expected = brute_nearest(rows, asked, 5)
    hits = sum(len({i for _, i, _ in found[q]} & {i for _, i, _ in expected[q]}) for q in expected)
    assert found.keys() == expected.keys() and hits >= 0.8 * 5 * len(expected)
    assert all(len(one) == 5 for one in found.values())


def test_op6(spark):
    rows = [tuple(row) for row in spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()]
    expected = brute_nearest(rows, [row for row in rows if row[0] % 50 == 0], 5)
    found = defaultdict(list)
    for row in queries.op6_learned_partitions(spark, SMALL).orderBy("query_id", "rank").collect():
        found[row["query_id"]].append((row["rank"], row["vec_id"], round(row["score"], 9)))
    hits = sum(len({i for _, i, _ in found[q]} & {i for _, i, _ in expected[q]}) for q in expected)
    assert found.keys() == expected.keys() and hits >= 0.9 * 5 * len(expected)
    scores = {(q, i): s for q, one in expected.items() for _, i, s in one}
    assert all(scores.get((q, i), s) == s for q, one in found.items() for _, i, s in one)


def test_parts_are_balanced():
    points = ann.unit(np.random.default_rng(1).standard_normal((512, 8)))
    label = ann.balanced_parts(ann.neighbour_graph(points, 8), 8, 1)
    assert np.bincount(label).tolist() == [64] * 8


# URL rules


URLS = [
    None, "", "no scheme", "http://", "http:///path", "HTTP://Sub.Example.NET/en/x?q#f", "http://example.net/en",
    "http://example.net/en/", "http://net/", "http://net", "http://xnet/", "http://a.net?x/en/", "http://.net/",
    "https://example.com/de/y", "https://www.example.com/DE/", "https://notexample.com/de/", "http://a.org/fr/#/x",
    "x://org/fr/", "http://a.org/x/fr/", "http://a.org:80/fr/", "ftp://u@b.org/fr/z://net/", "http://É.net/é",
    "http://a.net/" + "p/" * 3000, "http://" + "a." * 3000 + "net/", "http://a\nb.org/fr/\n",
]


def brute_verdict(url, rules, otherwise="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1]) and (host or path)]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2] == "block"), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else otherwise


def judged(spark, rules, otherwise="allow"):
    pages = spark.createDataFrame(
        [(i % 20, url, "h") for i, url in enumerate(URLS * 2)], "page_id int, url string, host string"
    )
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    found = url_filter.judge_urls(pages, table, otherwise=otherwise)
    assert found.columns == ["page_id", "url", *url_filter.OUTPUT]
    return Counter(tuple(row)[1:] for row in found.collect())


def expected_verdicts(rules, otherwise="allow"):
    return Counter((url, *brute_verdict(url, rules, otherwise)) for url in URLS * 2)


def test_url_rules(spark):
    assert judged(spark, URL_RULES) == expected_verdicts(URL_RULES)


def test_url_rules_cut_anywhere(spark):
    assert judged(spark, [("EXAMPLE.net", "/E", "block")]) == judged(spark, [("example.net", "/E", "block")])
    rules = [("org", "", "block"), ("org", "/f", "allow"), ("org", "/f", "block"), ("example.net", "/e", "block"), ("net", "/en/xyz", "allow")]
    assert judged(spark, rules, "block") == expected_verdicts(rules, "block")


def test_no_url_rules(spark):
    assert judged(spark, [(None, "/", "block"), ("a", None, "allow")]) == expected_verdicts([])
    none = spark.createDataFrame([], "url string, page_id long")
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    assert url_filter.judge_urls(none, rules).collect() == []
