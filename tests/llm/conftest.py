from __future__ import annotations

import public_tokenizers
import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def documents(spark):
    """Rows of (doc_id, text[, lang]) as a documents table; columns that operators use inside are there as well."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", None if r[1] is None else len(r[1]), 1.0, "k", 7) for r in rows]
        return spark.createDataFrame(full, DOCS + ", score double, key string, _n int")

    return make


@pytest.fixture(scope="session")
def vocabularies():
    return {n: public_tokenizers.path(f"{n}.json") for n in ("word_bpe_49k", "byte_bpe_50k")}


#: Nulls, empty, blank, letterless, very long, a tie and a repeated row.
ODD = [(1, None), (2, ""), (3, "  \n\t "), (4, "12 34 !!"), (5, "word " * 60_000), (6, "same old text here again"), (7, "same old text here again"), (7, "same old text here again"), (None, "no id but some words in it")]
