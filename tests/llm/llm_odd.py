"""Awkward documents that all operators are tried on."""

from __future__ import annotations

import pytest

from tallyspark.llm.common import written

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "score string, fingerprint string, n_words string, ids string, decoded string, shard string, "
    "lang_pred string, log_weight string, Size string, items string, predicted string"
)
ENGLISH = "the cat and the dog went over to the house and then they all had some of the food that was there"
FRENCH = "le chat et le chien sont dans la maison avec les enfants et ils mangent tous une pomme de terre"


def odd_texts() -> list[tuple[int | None, str | None]]:
    """Ids and texts: NULL, empty, blank, very long, repeated, without letters, odd characters."""
    return [
        (1, ENGLISH),
        (2, FRENCH),
        (3, None),
        (4, ""),
        (5, " \t\n "),
        (6, "x" * 150_000),
        (7, " ".join(f"word{i % 977} {ENGLISH}" for i in range(2500))),
        (8, ENGLISH),
        (8, ENGLISH),
        (None, ENGLISH.upper()),
        (None, None),
        (9, "12345 ... !!! 67"),
        (10, "a"),
        (11, "  two  spaces ▁ and\n\nlines\r\n\x00 é日本𝒳 ﬁ① "),
        (12, "0"),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Awkward documents with further columns that are named like results."""
    rows = [
        (i, t, "en" if n % 3 else None, f"src{n % 2}" if n % 5 else None, None if t is None else len(t), *["x"] * 11)
        for n, (i, t) in enumerate(odd_texts())
    ]
    return written(spark.createDataFrame(rows, SCHEMA).repartition(3), "odd")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.filter("1 = 0")
