"""The language model, the pipeline, and all named queries over the given tables."""

from __future__ import annotations

import hashlib
import math
import random
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from visitfold.llm import line_dedup, lm, oracle, quality, queries
from visitfold.llm.common import settle
from workload.check import compare

from .conftest import prose
from .test_text_operators import brute_groups, brute_lines, brute_print, brute_quality, brute_windows, left_of

SMALL = "/root/testdata/sf0.001"


# Language model


def test_gradient():
    rng = np.random.default_rng(0)
    kinds = rng.integers(0, 5, 60).astype(np.uint8)
    texts = lm.Lanes.of(kinds, np.array([20, 7, 33]), 4)
    network = lm.Network(*[part.astype(np.float64) for part in lm.Network.start(np.log(np.full(5, 0.2)), 4).parts()])
    grads, _ = lm.window_gradient(network, texts, 0, np.zeros((len(texts.sizes), 4)), steps=40)
    loss = lambda: -lm.log_likelihood(network, texts).astype(np.float64).mean()
    for part, grad in zip(network.parts(), grads):
        for at in list(np.ndindex(part.shape))[::3]:
            was = part[at]
            part[at] = was + 1e-3
            more = loss()
            part[at] = was - 1e-3
            less = loss()
            part[at] = was
            assert grad[at] == pytest.approx((more - less) / 2e-3, abs=2e-4)


def with_places(seed, near=(0, 0, 2, 2, 2), kinds=5, hidden=4):
    """A network whose classes 0 and 2 have places for words, all weights random."""
    rng = np.random.default_rng(seed)
    places = lm.Places.of(kinds, np.array(near))
    start = lm.Network.start(np.log(np.full(kinds, 1 / kinds)), hidden).with_words(places, np.zeros(kinds + len(near)))
    return start.of([0.5 * rng.standard_normal(part.shape) for part in start.parts()])


def test_gradient_with_places_of_words():
    network = with_places(3)
    symbols = np.random.default_rng(4).integers(0, 10, 60).astype(np.uint16)
    texts = lm.Lanes.of(network.places.kinds[symbols], np.array([20, 7, 33]), 4, symbols=symbols)
    grads, _ = lm.window_gradient(network, texts, 0, np.zeros((len(texts.sizes), 4)), steps=40)
    assert [grad.shape for grad in grads] == [part.shape for part in network.parts()]
    loss = lambda: -lm.log_likelihood(network, texts).astype(np.float64).mean()
    for part, grad in zip(network.parts(), grads):
        for at in list(np.ndindex(part.shape))[::3]:
            was = part[at]
            part[at] = was + 1e-3
            more = loss()
            part[at] = was - 1e-3
            less = loss()
            part[at] = was
            assert grad[at] == pytest.approx((more - less) / 2e-3, abs=2e-4)


def test_words_of_a_class_are_told_by_the_state():
    """A plain forward pass; words of equal classes, exchanged, change the words after them."""
    network, symbols = with_places(5), np.array([5, 1, 7, 8, 6, 0, 9, 2, 4], np.uint16)
    places = network.places
    run = lambda some: lm.log_likelihood(network, lm.Lanes.of(places.kinds[some], np.array([len(some)]), 4, symbols=some))
    state, before = np.zeros((1, 4)), 4
    for at, symbol in enumerate(symbols):
        state, before = network.step(state, network.inputs[[before]])[0], symbol
        kind = places.kinds[symbol]
        of_class = state[0] @ network.output + network.bias
        held = np.flatnonzero([places.kinds[other] == kind for other in range(10)])
        of_word = {other: state[0] @ network.word_output[:, places.place[other]] + network.word_bias[places.place[other]] for other in held}
        expected = of_class[kind] - np.log(np.exp(of_class).sum()) + of_word[symbol] - np.log(sum(map(np.exp, of_word.values())))
        assert run(symbols)[at] == pytest.approx(expected, abs=1e-4)
    other = np.array([6, 1, 7, 8, 6, 0, 9, 2, 4], np.uint16)
    assert abs(run(symbols) - run(other))[1:].max() > 1e-3


def test_windows_lie_by_units_and_keep_what_is_needed():
    """Each unit's numbers of a step follow one another; scoring keeps nothing for backpropagation."""
    network, sizes = with_places(6), np.array([9, 30, 4, 17])
    symbols = np.random.default_rng(7).integers(0, 10, sizes.sum()).astype(np.uint16)
    texts = lm.Lanes.of(network.places.kinds[symbols], sizes, 4, symbols=symbols)
    state = np.zeros((len(texts.sizes), 4))
    learnt, scored = (lm.Window.run(network, texts, 0, 8, state, learns=learns) for learns in (True, False))
    assert len(learnt.ways) == 8 and scored.ways == [] and (learnt.states == scored.states).all()
    assert all(part.strides[0] == part.itemsize for way in learnt.ways for part in way)
    assert all(learnt.states[t].strides[0] == learnt.states.itemsize for t in range(8))
    assert np.shares_memory(scored.states.reshape(-1, 4), scored.states)


@pytest.mark.parametrize("symbols", [[5, 1, 7, 8, 6, 0, 9, 2, 4], [4, 3, 1], [7], [6, 6, 5, 5, 0, 2]])
def test_odds_of_places(symbols):
    """Against a plain softmax word by word, also for classes of one place and classes without a word."""
    network, symbols = with_places(8), np.array(symbols, np.uint16)
    places, rng = network.places, np.random.default_rng(9)
    states = np.asfortranarray(rng.standard_normal((len(symbols), 4)))
    odds = lm.Odds.of(network, states, symbols)
    assert sorted(odds.order) == list(range(len(symbols)))
    for at, symbol in enumerate(symbols):
        held = slice(places.first[places.kinds[symbol]], places.first[places.kinds[symbol] + 1])
        weights = np.exp(states[at] @ network.word_output[:, held] + network.word_bias[held])
        row = int(np.flatnonzero(odds.order == at)[0])
        (part,) = [part[:, row - words.start] for words, places_of, part in odds.parts if words.start <= row < words.stop]
        assert part == pytest.approx(weights, rel=1e-5) and odds.sums[row] == pytest.approx(weights.sum(), rel=1e-5)
        assert odds.flat[odds.own[row]] == pytest.approx(weights[places.place[symbol] - held.start], rel=1e-5)
        share = network.word_log_share(states, symbols)[at]
        assert share == pytest.approx(math.log(weights[places.place[symbol] - held.start] / weights.sum()), abs=1e-5)


def test_sums_by_symbol():
    rng = np.random.default_rng(10)
    kinds, rows = rng.integers(0, 20, 50) // 2 * 2, np.asfortranarray(rng.standard_normal((50, 6)))
    expected = [rows[kinds == kind].sum(axis=0) for kind in range(21)]
    assert lm._sums_by(kinds, rows, 21) == pytest.approx(np.array(expected))


@pytest.mark.parametrize("most", [1, 40, 1 << 25])
def test_words_are_split_as_bytes(monkeypatch, most):
    monkeypatch.setattr(lm, "SPLIT_BYTES", most)
    texts = [b"", b" \x0b A\xff\xfe\x1c\x85b\xc2\xa0C\x00d \r\n", "\u2003x\u0130Y \x1f\u00c0".encode(), b" \t", b"Z" * 90, b"a b\fA"]
    for raw in (pa.array(texts, pa.binary()), pa.array([b"other", *texts], pa.binary()).slice(1), pa.array([], pa.binary())):
        wanted = [one.lower().split() for one in raw.to_pylist()]
        found = list(lm.split(raw))
        assert [bytes(w) for words, _ in found for w in words.cast(pa.binary()).to_pylist()] == sum(wanted, [])
        assert [n for _, sizes in found for n in sizes] == list(map(len, wanted))
        vocabulary, got = lm.Vocabulary(np.zeros((lm.PAIRS, 2), np.float32), near={b"a": 7}), []
        for numbers, sizes in vocabulary.read(raw):
            listed = list(vocabulary.number)
            ends = np.cumsum(sizes)
            got += [[listed[k] for k in numbers[a:b]] for a, b in zip(ends - sizes, ends)]
        assert got == [[*words, lm.END] for words in wanted]


def test_classes_of_awkward_words():
    """Against pairs looked up one by one."""
    table = np.random.default_rng(11).standard_normal((lm.PAIRS, 5)).astype(np.float32)
    words = [b"a", b"\xff\xff\xff", b"a\0\0b", b"\0", b"", b"word" * 50, b"caf\xc3\xa9"]
    for word, kind in zip(words, lm.classes_of(words, table)):
        whole = b"\0" + word + b"\0"
        pairs = [((a * 256 + b) * 40503 >> 4) % lm.PAIRS for a, b in zip(whole, whole[1:])]
        assert kind == (table[pairs].sum(axis=0).argmax() if word else 5)


def test_near_words_share_out_their_class(spark, docs, awkward):
    """The network begins as the counts; places of a class sum to one."""
    counts = lm.count_words(docs(awkward), "doc_id", "text")
    model = lm.start_model(counts, 8, 4, near_words=20)
    network, places = model.network, model.network.places
    assert len(model.near) == 20 and sorted(places.place) == list(range(29))
    number = {bytes(r["word"]): r["n"] for r in counts.collect()}
    for word, symbol in model.near.items():
        expected = math.log10(number[word] + lm.ADDED) - model.class_logs[places.kinds[symbol]]
        assert network.word_bias[places.place[symbol]] / math.log(10) == pytest.approx(expected, abs=1e-5)
    assert np.add.reduceat(np.exp(network.word_bias), places.first[:-1]) == pytest.approx(np.ones(9), abs=1e-4)


def test_lanes_keep_every_word_in_order():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 90, 70)
    kinds = rng.integers(0, 9, sizes.sum()).astype(np.uint8)
    for longest in (None, 20):
        texts = lm.Lanes.of(kinds, sizes, 9, longest)
        assert sorted(texts.place) == list(range(len(kinds)))
        assert (texts.kinds == kinds[texts.place]).all() and texts.sizes.sum() == len(kinds)
        starts = set(np.concatenate(([0], np.cumsum(sizes)[:-1])).tolist())
        fresh = set(texts.place[texts.fresh].tolist())
        assert fresh >= starts and (longest or fresh == starts)
        goes_on = ~texts.fresh[1:]
        inside = np.flatnonzero(goes_on) + 1
        assert (texts.place[inside] == texts.place[inside - 1] + 1).all()


def test_state_is_carried_to_the_end():
    rng = np.random.default_rng(2)
    network = lm.Network.start(np.log(np.full(5, 0.2)), 6)
    kinds = rng.integers(0, 5, 300).astype(np.uint8)
    alone = lm.log_likelihood(network, lm.Lanes.of(kinds, np.array([300]), 4))
    state, before = np.zeros((1, 6), np.float32), 4
    for at, kind in enumerate(kinds):
        state = network.step(state, network.inputs[[before]])[0]
        assert alone[at] == pytest.approx(network.log_share(state, np.array([kind]))[0], abs=1e-4)
        before = kind


def test_learns_what_follows_what():
    kinds = np.tile(np.array([0, 1, 2, 3], np.uint8), 20000)
    texts = lm.Lanes.of(kinds, np.full(800, 100), 3)
    start = lm.Network.start(np.log(np.full(4, 0.25)), 8)
    trained = lm.train(start, texts)
    assert lm.log_likelihood(trained, texts).mean() > -0.2 > lm.log_likelihood(start, texts).mean()


def test_probabilities_sum_to_one(spark, docs, awkward):
    """Over all known words, the end, and one unknown word in each class."""
    table = docs(awkward)
    counts = {bytes(r["word"]): r["n"] for r in lm.count_words(table, "doc_id", "text").collect()}
    model = lm.fit(table, lm.count_words(table, "doc_id", "text"), "doc_id", "text", 8, 4)
    words = list(counts)
    kinds = lm.classes_of(words, model.table)
    mass = np.bincount(kinds, [counts[w] + lm.ADDED for w in words], 9) / 10**model.class_logs
    unknown = lm.ADDED / 10 ** model.class_logs[:8]
    assert mass[:8] + unknown == pytest.approx(np.ones(8)) and mass[8] == pytest.approx(1)


def brute_base(rows):
    tokens = [[*(text or "").encode().lower().split(), b""] for _, text, _ in rows]
    held = [zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0 for i, _, _ in rows]
    count = Counter(word for words, out in zip(tokens, held) if not out for word in words)
    total, room = sum(count.values()), sum(count.values()) + 0.1 * (len(count) + 1)
    return [
        (i, out, len(words), sum(count[w] > 0 for w in words), total, sum(math.log10((count[w] + 0.1) / room) for w in words))
        for (i, _, _), words, out in zip(rows, tokens, held)
    ]


@pytest.mark.parametrize("head_words", [0, 40, 1 << 19])
def test_base_scores(docs, awkward, head_words):
    found = lm.score(docs(awkward), classes=8, hidden=4, head_words=head_words)
    assert "text" not in found.select("doc.*").columns and "key" in found.select("doc.*").columns
    plain = lambda rows: Counter((*r[:5], round(r[5], 6)) for r in rows)
    got = found.select("doc.doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score").collect()
    assert plain(got) == plain(brute_base(awkward))
    assert all(np.isfinite(row["score"]) and row["score"] < 0 for row in got)


def test_score_does_not_depend_on_the_frequent_words(docs, awkward):
    table = docs(awkward)
    scores = [
        sorted((r["doc"]["doc_id"] or 0, round(r["score"], 5)) for r in lm.score(table, classes=8, hidden=4, head_words=n).collect())
        for n in (0, 1 << 19)
    ]
    assert scores[0] == scores[1]


def test_nothing_to_learn_or_score(docs):
    assert lm.score(docs([])).collect() == []
    only_held = [row for row in ((i, "a b c", "x") for i in range(200)) if zlib.crc32(str(row[0]).encode()) % 10 == 0]
    rows = lm.score(docs(only_held)).collect()
    assert {(r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in rows} == {(True, 4, 0, 0, 0.0)}


def test_beats_the_base_on_held_out_documents(spark):
    scored = queries.op10_lm_scoring(spark, "/root/testdata/sf0.01").where("held_out")
    row = scored.agg(F.sum("score").alias("score"), F.sum("base_score").alias("base"), F.sum("n_tokens").alias("n")).first()
    assert row["score"] - row["base"] > 0.1 * row["n"]


@pytest.mark.parametrize("most", [0, 3, 5, 7, 20])
def test_most_frequent_words_of_flat_counts(spark, most):
    rows = [(b"w%02d" % k, 1000 + k % 3) for k in range(12)] + [(b"often", 9000)]
    common, others = lm.by_frequency(spark.createDataFrame(rows, "word binary, n long"), most)
    order = sorted(rows, key=lambda row: (-row[1], row[0]))
    assert {bytes(row["word"]) for row in common.collect()} == {word for word, _ in order[:most]}
    assert {bytes(row["word"]) for row in others.collect()} == {word for word, _ in order[most:]}


# Pipeline


def test_quality_stage_keeps_rows_as_they_are(spark, docs, awkward):
    table = docs([*awkward, (500, "w " * 60 + " ".join(f"v{i}" for i in range(200)), "a")])
    kept = corpus_pipeline.quality_rules(spark, table, SMALL)
    assert kept.columns == table.columns
    expected = Counter((i, text) for i, text, _ in awkward if len((text or "").split()) < 400 and brute_quality(text)[-1])
    got = Counter(map(tuple, kept.select("doc_id", "text").collect()))
    assert expected == Counter({row: n for row, n in got.items() if len((row[1] or "").split()) < 400})
    assert (6, awkward[5][1]) in got


def test_line_stage(spark, docs, awkward):
    rows = [row for row in awkward if row[0] not in (None, 11)]
    table = docs(rows).withColumn("n_chars", F.lit(-1).cast("long"))
    found = corpus_pipeline.repeated_lines(spark, table, SMALL)
    assert found.columns == table.columns
    removed = brute_lines(rows)
    expected = Counter()
    for i, text, _ in rows:
        gone = removed[i, text or ""]
        left = left_of(text, gone)
        if not gone or left.encode().split():
            expected[i, left, len(left) if gone else -1] += 1
    assert Counter(map(tuple, found.select("doc_id", "text", "n_chars").collect())) == expected


def test_near_duplicate_stage_leaves_one(spark, docs, awkward):
    kept = corpus_pipeline.near_duplicates(spark, docs(awkward), SMALL)
    groups = set(brute_groups([brute_print(text) for _, text, _ in awkward]))
    assert kept.count() == len(groups) and kept.columns == docs([]).columns


def test_near_duplicate_stage_takes_three_words_and_two_bits(spark, docs):
    """Texts on which other shingle lengths would decide otherwise."""
    rng = random.Random(4)
    rows = []
    while len(rows) < 40:
        words = prose(rng, rng.randint(150, 500)).split()
        other = list(words)
        other[rng.randrange(len(words))] = "changed"
        rows += [(len(rows), " ".join(words), "a"), (len(rows) + 1, " ".join(other), "b")]
    expected = {}
    for (i, *_), group in zip(rows, brute_groups([brute_print(text) for _, text, _ in rows])):
        expected[group] = min(i, expected.get(group, i))
    other = brute_groups([brute_print(text, 5) for _, text, _ in rows])
    assert len(set(other)) != len(expected) < len(rows)
    kept = corpus_pipeline.near_duplicates(spark, docs(rows), SMALL)
    assert sorted(row["doc_id"] for row in kept.collect()) == sorted(expected.values())


def test_stages_take_awkward_rows(spark, docs, awkward):
    """All stages after one another on nulls, empty and long texts, ties, repeated rows and clashing columns."""
    table = docs(awkward)
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        rows = stage(spark, table, SMALL)
        assert rows.columns == table.columns, name
        before = table.count()
        table = settle(rows, name)
        assert 0 < table.count() <= before * (3 if name == "source_mixing" else 1), name
    packed = corpus_pipeline.STAGES[-1][1](spark, table, SMALL).collect()
    pieces = Counter((row["doc_id"], row["piece"]) for row in packed)
    wanted = Counter(row["doc_id"] for row in table.select("doc_id").collect())
    assert {i: n for (i, piece), n in pieces.items() if piece == 0} == wanted


def test_stages_on_an_empty_table(spark, docs):
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs([]), SMALL)
        assert rows.collect() == [], name
        assert name == "best_fit_packing" or rows.columns == docs([]).columns


def test_mixing_stage_keeps_the_weights(spark, docs):
    rows = [(i, f"w{i} " * 50, "abc"[i % 3]) for i in range(300)]
    taken = corpus_pipeline.source_mixing(spark, docs(rows), SMALL).groupBy("source").count().collect()
    assert {row["source"]: row["count"] for row in taken} == {"a": 50, "b": 100, "c": 150}


def test_pipeline_on_the_small_tables(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "simhash_near_dedup", "source_mixing", "best_fit_packing",
    ]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = docs.select("doc_id", "text", "source").collect()
    good = [tuple(r) for r in rows if brute_quality(r["text"])[-1]]
    removed = brute_lines(good)
    lines = [(i, left_of(t, removed[i, t or ""]), s) for i, t, s in good]
    lines = [(i, t, s) for i, t, s in lines if t is not None and t.encode().split()]
    first = {}
    for row, group in sorted(zip(lines, brute_groups([brute_print(t) for _, t, _ in lines]))):
        first.setdefault(group, row)
    texts = {i: t for i, t, _ in first.values()}
    packed = corpus_pipeline.run(spark, SMALL).collect()
    # every kept document is there whole, as often as mixed, and no other is
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {i: [*tokenizer.encode(t, add_special_tokens=False).ids, 0] for i, t in texts.items()}
    pieces = Counter()
    for row in packed:
        piece = np.frombuffer(row["ids"], "<u4").tolist()
        assert piece == ids[row["doc_id"]][row["start"] : row["start"] + row["length"]]
        pieces[row["doc_id"], row["piece"]] += 1
    copies = defaultdict(set)
    for (i, piece), n in pieces.items():
        copies[i].add(n)
        assert piece < -(-len(ids[i]) // 2048)
    assert all(len(n) == 1 and max(n) <= 3 for n in copies.values())
    assert all(sum(1 for i2, _ in pieces if i2 == i) == -(-len(ids[i]) // 2048) for i in copies)
    words, taken = defaultdict(int), defaultdict(int)
    for i, t, s in first.values():
        words[s] += len(t.encode().split())
        taken[s] += max(copies[i], default=0) * len(t.encode().split())
    assert sum(taken.values()) == pytest.approx(sum(words.values()), rel=0.05)
    places = defaultdict(list)
    for row in packed:
        places[row["sequence_id"]].append((row["offset"], row["length"]))
    for parts in places.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


# Named queries


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in ("documents", "pages", "embeddings"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", oracle.ORACLE)
def test_query_equals_sql(spark, database, name):
    result = compare(queries.QUERIES[name](spark, SMALL), database, oracle.ORACLE[name])
    assert result.startswith("ok"), result


@pytest.fixture(scope="module")
def documents(database):
    return database.execute("SELECT doc_id, text, source FROM documents").fetchall()


def rows_of(spark, name, *columns):
    return Counter(map(tuple, queries.QUERIES[name](spark, SMALL).select(*columns).collect()))


def test_op2(spark, documents):
    prints = [brute_print(text) for _, text, _ in documents]
    groups = brute_groups(prints)
    least = {}
    for (i, *_), group in zip(documents, groups):
        least[group] = min(i, least.get(group, i))
    assert rows_of(spark, "op2_simhash", "doc_id", "fingerprint", "component_id") == Counter(
        (i, f"{one:016x}", least[group]) for (i, *_), one, group in zip(documents, prints, groups)
    )


def test_op5(spark, documents):
    removed = brute_lines(documents)
    assert rows_of(spark, "op5_line_dedup", "doc_id", "n_removed", "removed_lines") == Counter(
        (i, len(removed[i, text or ""]), ",".join(map(str, removed[i, text or ""]))) for i, text, _ in documents
    )


def test_op7(spark, documents):
    names = "n_words word_chars n_symbols n_dup_lines n_repeat_words longest_repeat n_covered base_failed kept".split()
    short = [(i, text) for i, text, _ in documents if len(text.split()) < 500]
    got = rows_of(spark, "op7_quality_rules", "doc_id", *names)
    wanted = {i for i, _ in short}
    assert sum(got.values()) == len(documents)
    assert Counter({row: n for row, n in got.items() if row[0] in wanted}) == Counter(
        (i, *brute_quality(text)) for i, text in short
    )


def test_op8(spark, documents):
    expected = brute_windows([text for _, text, _ in documents], 35)
    assert rows_of(spark, "op8_substring_dedup", "doc_id", "n_words", "n_removed", "kept_sha256") == Counter(
        (i, n, gone, hashlib.sha256(left.encode()).hexdigest())
        for (i, *_), (n, gone, left) in zip(documents, expected)
    )


def test_op10(spark, documents):
    got = queries.op10_lm_scoring(spark, SMALL).collect()
    plain = lambda rows: Counter((*r[:5], round(r[5], 5)) for r in rows)
    assert plain(got) == plain(brute_base(documents))


def test_entry_works_without_this_subpackage(tmp_path):
    """The other queries are registered where these folders are absent."""
    import shutil
    import subprocess

    root = Path(__spark_entry__.__file__).parent
    for name in ("visitfold", "workload"):
        shutil.copytree(root / name, tmp_path / name, ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'pipeline' in e.queries())"
    said = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    whole = __spark_entry__.queries()
    ours = len(queries.QUERIES) + 1
    assert said.stdout.split()[0] == str(len(whole) - ours) and said.stdout.split()[2] == "False"
    assert "pipeline" in whole and len([n for n in whole if n.startswith("op")]) == 13


def test_thresholds_are_those_of_the_module():
    assert (quality.LEAST_WORDS, line_dedup.MIN_WORDS) == (50, 5)
