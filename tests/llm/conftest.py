from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a table of documents from (id, text) or (id, text, source) with clashing extra columns."""

    def make(rows, extra: bool = True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS).repartition(3)
        if extra:  # names the operators use themselves
            for name in ("key", "size", "node", "w", "id", "bucket", "covered", "score", "target", "rank", "_key", "_id"):
                df = df.selectExpr("*", f"'x' AS {name}")
        return df

    return make


@pytest.fixture(scope="session")
def bpe_path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="session")
def library(bpe_path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe_path)
