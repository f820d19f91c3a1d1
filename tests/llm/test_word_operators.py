"""Spelling variants, the n-gram join and periodic runs against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from visitfold.llm import ngram_join, periodic, queries, spelling

from .conftest import CLASHING, prose

EMPTY: list = []
SMALL = "/root/testdata/sf0.001"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


# Spelling variants


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute_words(rows, damaged, letters=6, least=5):
    counts = Counter()
    for number, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{number}:{run}".encode())
            if damaged and number is not None and h % damaged == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {word: n for word, n in counts.items() if len(word) >= letters and n >= least}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_forms(words, times=5):
    out = {}
    near = {word: [other for other in words if one_edit(word, other)] for word in words}
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda other: (-words[other], other), default=None)
        if best is not None and words[best] >= times * words[word]:
            form[word] = best
    for word in words:
        root = word
        while root in form:
            root = form[root]
        to = form.get(word)
        out[word] = (to, root, words[word], len(near[word]), words.get(to))
    return out


def forms_of(rows):
    names = ["form", "root", "n", "n_near", "form_n"]
    return {row["word"]: tuple(row[name] for name in names) for row in rows.select("word", *names).collect()}


@given(st.lists(st.text("abé", min_size=1, max_size=7), min_size=2, max_size=12, unique=True))
@settings(max_examples=20, deadline=None)
def test_near_words(spark, words):
    table = spark.createDataFrame([(word,) for word in words], "word string").repartition(2)
    found = Counter(map(tuple, spelling.near_words(table).collect()))
    assert found == Counter((a, b) for a in words for b in words if one_edit(a, b))


def test_forms_and_their_chains(spark):
    rng = random.Random(2)
    words = {}
    for _ in range(25):
        base = "".join(rng.choice("abcdeé") for _ in range(rng.randint(6, 9)))
        n = rng.choice([700, 3000])
        while n >= 1:
            words[base] = n
            at = rng.randrange(len(base))
            base = base[:at] + rng.choice(["", "x", base[at] + "y"]) + base[at + 1 :]
            n = rng.choice([n, n // 5, n // 6])
            if rng.random() < 0.2:
                break
    words |= {"tiedone": 50, "tiedtwo": 50, "tiedxone": 10, "w" * 3000: 9, "w" * 3001: 45}
    words |= {"tietest": 10, "tietesta": 50, "tietestb": 50}
    chain = ["chainaaa", "chainaab", "chainabb", "chainbbb", "chaicbbb"]
    words |= {word: 5 ** (k + 1) for k, word in enumerate(chain)}
    table = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    expected = brute_forms(words)
    assert forms_of(spelling.forms(table)) == expected
    assert expected["chainaaa"][:2] == ("chainaab", "chaicbbb") and expected["tietest"][0] == "tietesta"
    assert forms_of(spelling.forms(table.limit(0))) == {}


@pytest.mark.parametrize("damaged", [None, 3])
def test_words_of_awkward_texts(docs, awkward, damaged):
    rows = [*awkward, (70, "Élan élan ÉLAN élan×÷élan élan " * 3, "a"), (71, "Naïveté naïveté_naïveté9naïveté naïveté", None)]
    found = spelling.word_counts(docs(rows), damaged=damaged, least_letters=4)
    got = {row["word"]: row["n"] for row in found.collect()}
    assert got == brute_words([row[:2] for row in rows], damaged, letters=4)
    assert damaged or {"Élan", "élan"} <= got.keys()
    assert spelling.word_counts(docs(EMPTY)).collect() == []


def test_op11(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    found = queries.op11_spelling_variants(spark, SMALL)
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert forms_of(found) == brute_forms(brute_words([tuple(row) for row in rows], 199))


# N-gram Jaccard join


def brute_set(text, shingle=4):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1)) if words)


def brute_components(rows, shingle=4):
    """(doc_id, set size, component) of each row, by all pairs."""
    sets = [brute_set(text, shingle) for _, text in rows]
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and group[i] != group[j]:
                both = len(a & b)
                if 100 * both >= 85 * (len(a) + len(b) - both):
                    old, new = group[i], group[j]
                    group = [new if one == old else one for one in group]
    least = {}
    for (number, _), one in zip(rows, group):
        if number is not None:
            least[one] = min(number, least.get(one, number))
    return Counter((number, len(s), least.get(one)) for (number, _), s, one in zip(rows, sets, group))


def joined(table, **more):
    found = ngram_join.similar_texts(table, **more)
    return Counter(map(tuple, found.select("doc.doc_id", "n_shingles", "component_id").collect()))


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words))
        words[at : at + rng.choice([0, 1, 1])] = [prose(rng, 1, "xyz")] * rng.choice([0, 1, 1])
    return words


def families(rng, count, size, passage):
    rows = []
    for _ in range(count):
        texts = [prose(rng, rng.randint(30, 120)).split()]
        texts += [edited(rng, rng.choice(texts), rng.choice([0, 1, 1, 2, 3])) for _ in range(size)]
        rows += [" ".join(words).title() for words in texts]
    # unlike texts that share a passage, among them some that hardly have anything else
    rows += [f"{prose(rng, rng.randint(1, 60))} {passage} {prose(rng, rng.randint(0, 20))}" for _ in range(25)]
    rows += ["", "  ", "a b", "A  b", "a c", rows[0], rows[0], "a b c d", "A B C D"]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("block", [ngram_join.BLOCK_SHINGLES, 400])
def test_ngram_join_equals_all_pairs(docs, block):
    rng = random.Random(block)
    rows = families(rng, 8, 8, prose(rng, 12))
    table = docs([(number, text, "a") for number, text in rows])
    assert joined(table, block_shingles=block) == brute_components(rows)


def test_one_large_family_in_many_blocks(docs):
    """Links that only sets of different blocks have, and chains from text to text."""
    rng = random.Random(6)
    base = prose(rng, 220).split()
    rows, words = [], base
    for _ in range(60):
        words = edited(rng, words, 3)
        rows.append(" ".join(words))
    rows += [" ".join(edited(rng, base, rng.choice([1, 4, 7]))) for _ in range(60)]
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    expected = brute_components(rows)
    assert 1 < len({component for _, _, component in expected}) < 60
    table = docs([(number, text, "a") for number, text in rows])
    for block in (2000, 9000):
        assert joined(table, block_shingles=block) == expected


def test_awkward_ngram_join(docs, awkward):
    rows = [row[:2] for row in awkward]
    found = ngram_join.similar_texts(docs(awkward))
    assert set(CLASHING) <= set(found.select("doc.*").columns)
    got = Counter(map(tuple, found.select("doc.doc_id", "n_shingles", "component_id").collect()))
    # a row without an id and without a partner has no component
    assert got == brute_components(rows)
    blank = {tuple(row) for row in found.where("n_shingles = 0").select("doc.doc_id", "component_id", "group").collect()}
    assert blank == {(1, 1, None), (2, 2, None), (3, 3, None)}
    assert joined(docs(EMPTY)) == Counter()


@given(st.lists(st.sets(st.integers(0, 30), max_size=12).map(sorted), max_size=9), st.integers(1, 9))
@settings(max_examples=300, deadline=None)
def test_occurrences(lists, least):
    counts = Counter(one for ids in lists for one in ids)
    found = dict(ngram_join.occurrences([ids for ids in lists if ids], least))
    assert found == {one: n for one, n in counts.items() if n >= least}
    wanted = dict(ngram_join.occurrences([ids for ids in lists if ids], least, lambda one: one % 2 == 0))
    assert wanted == {one: n for one, n in found.items() if one % 2 == 0}


def test_a_common_passage_costs_no_pairs(docs, monkeypatch):
    """What is looked at grows with the texts, not with their square."""
    rng = random.Random(3)
    passage = prose(rng, 30)
    looked = []
    for count in (50, 100, 200):
        texts = [f"{prose(rng, 60, 'mnopqrst')} {passage} {prose(rng, 40, 'mnopqrst')}" for _ in range(count)]
        sets = [ngram_join.shingle_set(text.encode()).tolist() for text in texts]
        often = Counter(one for members in sets for one in members)
        sets = [sorted((one for one in members if often[one] > 1), key=lambda one: (often[one], one)) for members in sets]
        steps = 0

        def pop(heap, real=ngram_join.heappop):
            nonlocal steps
            steps += 1
            return real(heap)

        with monkeypatch.context() as patch:
            patch.setattr(ngram_join, "heappop", pop)
            assert ngram_join.connect([130] * count, sets) == []
        looked.append(steps)
    assert looked[2] <= 5 * looked[0] + 100


def test_op12(spark):
    rows = [tuple(row) for row in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = Counter(map(tuple, queries.op12_ngram_jaccard(spark, SMALL).select("doc_id", "n_shingles", "component_id").collect()))
    assert got == brute_components(rows)


# Periodic runs


def brute_lyndon(codes):
    def is_lyndon(word):
        return all(word < word[k:] for k in range(1, len(word)))

    return [max(n for n in range(1, len(codes) - i + 1) if is_lyndon(codes[i : i + n])) for i in range(len(codes))]


@given(st.lists(st.integers(1, 4), min_size=1, max_size=22))
@settings(max_examples=400, deadline=None)
def test_lyndon_groups(codes):
    group, length = periodic.lyndon_groups([0, *codes])
    assert length[1:].tolist() == brute_lyndon(codes)
    words = [tuple(codes[i : i + n]) for i, n in enumerate(length[1:])]
    assert all((words[i] == words[j]) == (group[i + 1] == group[j + 1]) for i in range(len(codes)) for j in range(i))


def brute_runs(words):
    out = []
    for period in range(1, len(words) // 4 + 1):
        at = 0
        while at + period < len(words):
            begin = at
            while at + period < len(words) and words[at] == words[at + period]:
                at += 1
            run = words[begin : at + period]
            if at > begin and len(run) >= max(6, 4 * period):
                if not any(run[q:] == run[:-q] for q in range(1, period)):
                    out.append((begin, len(run), period))
            at = max(at, begin + 1)
    return sorted(out)


def brute_collapsed(words, runs):
    gone = {at for start, length, period in runs for at in range(start + period, start + length)}
    return " ".join(word for at, word in enumerate(words) if at not in gone)


repeats = st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=5), st.integers(1, 7))


@given(st.lists(st.lists(repeats, max_size=5), min_size=1, max_size=3))
@settings(max_examples=300, deadline=None)
def test_runs_of_several_texts(texts):
    texts = [[word.encode() for block, times in parts for word in block * times] for parts in texts]
    for words, found in zip(texts, periodic.text_runs(texts)):
        assert [tuple(run) for run in found.tolist()] == brute_runs(words)


def test_runs_at_the_limits():
    def runs(text):
        return [tuple(run) for run in periodic.text_runs([text.encode().split()])[0].tolist()]

    assert runs("a a a a a") == [] and runs("a a a a a a") == [(0, 6, 1)]
    assert runs("a b a b a b a") == [] and runs("x a b a b a b a b") == [(1, 8, 2)]
    assert runs("a b c a b c a b c a b") == [] and runs("a b c a b c a b c a b c") == [(0, 12, 3)]
    assert runs("") == [] and periodic.text_runs([]) == []
    assert periodic.strongest(np.array([(0, 8, 2), (3, 12, 3), (9, 9, 2)])) == (9, 9, 2)
    assert periodic.strongest(np.array([(5, 8, 2), (3, 12, 3), (3, 16, 4)])) == (3, 12, 3)
    assert periodic.strongest(np.zeros((0, 3), np.int64)) is None


@pytest.mark.parametrize("chunk", [1, 50, periodic.CHUNK_WORDS])
def test_awkward_runs(docs, awkward, chunk):
    rows = [row[:2] for row in awkward if len(words_of(row[1])) <= 4000]
    rows += [(80, "so it goes so it goes so it goes so it goes on", ), (81, "la " * 40), (81, "la " * 40)]
    found = periodic.periodic_runs(docs([(*row, "a") for row in rows]), chunk_words=chunk).collect()
    got = Counter((row["doc"]["doc_id"], tuple(map(tuple, row["runs"])), bytes(row["collapsed"]).decode()) for row in found)
    expected = Counter()
    for number, text in rows:
        words = words_of(text)
        runs = brute_runs(words)
        expected[number, tuple(runs), brute_collapsed(words, runs)] += 1
    assert got == expected
    assert all((row["start"] is None) == (not row["runs"]) for row in found)
    assert set(CLASHING) <= set(found[0]["doc"].asDict())
    assert periodic.periodic_runs(docs(EMPTY)).collect() == []


def test_long_repetitive_texts(docs):
    text = "Word " * 9000 + "and " + "one two three " * 3000
    (row,) = periodic.periodic_runs(docs([(1, text, "a")])).collect()
    assert [tuple(run) for run in row["runs"]] == [(0, 9000, 1), (9001, 9000, 3)]
    assert bytes(row["collapsed"]).decode() == "Word and one two three"


def test_op13(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    expected = Counter()
    for number, text in rows:
        words = with_repeats(number, text)
        runs = brute_runs(words)
        best = min(runs, key=lambda run: (Fraction(-run[1], run[2]), run[0], run[2]), default=(None,) * 3)
        listed = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
        expected[
            number, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(brute_collapsed(words, runs).encode()).hexdigest(),
        ] += 1
    names = "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256".split()
    assert Counter(map(tuple, queries.op13_periodic_runs(spark, SMALL).select(*names).collect())) == expected
    assert sum(with_repeats(*row) != words_of(row[1]) for row in rows) > 5


def with_repeats(number, text):
    words = words_of(text)
    n, h = len(words), zlib.crc32(str(number).encode())
    g = h // 10
    if number is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_planted_repeats(spark):
    rows = [(None, "a b c"), (1, None), (2, ""), (3, " \t"), *((n, "u x y z v w " * 4) for n in range(10, 60))]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = {row["doc_id"]: words_of(row["text"]) for row in queries.with_planted_repeats(table).collect()}
    assert found == {number: with_repeats(number, text) for number, text in rows}
    assert any(found[n] != words_of("u x y z v w " * 4) for n in range(10, 60))
