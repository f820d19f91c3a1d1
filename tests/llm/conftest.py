"""Awkward rows that every operator has to take."""

from __future__ import annotations

import random

import pytest

# Names that operators use inside; as columns of the input they must not get in the way.
CLASHING = ["key", "size", "doc", "n", "kept", "uid", "hash", "fingerprint", "text_1"]


def prose(rng: random.Random, words: int, letters: str = "abcdefgh") -> str:
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 4))) for _ in range(words))


def awkward_texts() -> list[tuple[int | None, str | None, str | None]]:
    """(doc_id, text, source): nulls, empty and long texts, repeated rows, ties, odd characters."""
    rng = random.Random(5)
    passage, line = prose(rng, 60), prose(rng, 12)
    rows: list[tuple[int | None, str | None, str | None]] = [
        (1, None, "a"),
        (2, "", "a"),
        (3, " \t\n\x0b\x0c\r ", None),
        (4, "one", "b"),
        (5, "Word " * 9000, "b"),
        (6, prose(rng, 3000), "c"),
        (7, "z" * 40_000, "c"),
        (None, prose(rng, 80), "a"),
        (None, prose(rng, 80), None),
        (8, f"{prose(rng, 50)}\n{passage}\n{prose(rng, 20)}", "a"),
        (9, f"{passage} {prose(rng, 40)}", "a"),
        (10, f"Été naïve mot  fin\n{line}\n{line} more\n\n{line}", "é"),
        (11, prose(rng, 100), "a"),
        (11, prose(rng, 100), "a"),
        (12, "a  b   c \n \n d\t\te <|endoftext|> f", ""),
    ]
    rows += [(20 + i, f"{prose(rng, 60)}\n{line}", rng.choice("abc")) for i in range(12)]
    copy = prose(rng, 70)
    rows += [(40 + i, copy, "a") for i in range(6)]
    rows += [rows[10], rows[10], (40, copy, "a")]
    return rows


@pytest.fixture(scope="session")
def awkward():
    return awkward_texts()


@pytest.fixture(scope="session")
def docs(spark):
    """A table of (doc_id, text, source) rows with further columns of clashing names."""

    def build(rows):
        extra = ", ".join(f"{name} string" for name in CLASHING)
        full = [(*row, *(f"{name}!" for name in CLASHING)) for row in rows]
        return spark.createDataFrame(full, f"doc_id long, text string, source string, {extra}").repartition(3)

    return build
