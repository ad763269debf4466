"""BPE encoding and decoding of a table of documents by the tokenization automaton.

Null text counts as empty and has no ids.  Special tokens in a text are encoded as such, as
the library does by default.  Rows are independent: repeated rows, ties and missing ids keep
their place.  Very long texts are encoded piece by piece.  Columns named in ``keep`` are
carried under their names; all others are left out, so no name can clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .automaton import TokenAutomaton
from .encoding import TextEncoder, over_texts, shared_spec


@lru_cache(maxsize=2)
def automaton_encoder(spec: str) -> TextEncoder:
    """One per worker and tokenizer, compiled on first use."""
    return TextEncoder(spec, TokenAutomaton(spec))


def _mapped(docs: DataFrame, keep: list[str], made: str, fields: list[pa.Field], rows) -> DataFrame:
    plain = docs.select(*[F.col(c) for c in keep], F.col("text").cast("string").alias("text"))
    plain = plain.toDF(*[f"k{i}" for i in range(len(keep))], "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [batch.schema.field(n) for n in batch.schema.names if n != "text"]
            yield from over_texts(iter([batch]), pa.schema([*kept, *fields]), rows)

    schema = ", ".join([f"k{i} {plain.schema[i].dataType.simpleString()}" for i in range(len(keep))] + [made])
    return plain.mapInArrow(run, schema).toDF(*keep, *[f.name for f in fields])


def encode(docs: DataFrame, tokenizer: str, keep: list[str]) -> DataFrame:
    """Columns ``keep``, ``ids`` (array of int) and ``decoded``, the text got back from the ids."""
    spec = shared_spec(docs.sparkSession, tokenizer)

    def rows(texts: list[str]) -> dict:
        encoder = automaton_encoder(spec.value)
        found = list(encoder.encode(texts))
        offsets = np.cumsum([0, *[len(x) // 4 for x in found]]).astype(np.int32)
        ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(found), "<i4")))
        return {"ids": ids, "decoded": pa.array([encoder.cache.text(x) for x in found], pa.string())}

    fields = [pa.field("ids", pa.list_(pa.int32())), pa.field("decoded", pa.string())]
    return _mapped(docs, keep, "ids array<int>, decoded string", fields, rows)


def digests(docs: DataFrame, tokenizer: str, keep: list[str]) -> DataFrame:
    """Columns ``keep``, ``n_tokens``, and SHA-256 of the ids and of the text decoded from them."""
    spec = shared_spec(docs.sparkSession, tokenizer)

    def rows(texts: list[str]) -> dict:
        encoder = automaton_encoder(spec.value)
        counts, of_ids, of_text = [], [], []
        for ids in encoder.encode(texts):
            counts.append(len(ids) // 4)
            of_ids.append(hashlib.sha256(ids).hexdigest())
            of_text.append(hashlib.sha256(encoder.cache.text(ids).encode()).hexdigest())
        return {"n_tokens": counts, "ids_sha256": of_ids, "decoded_sha256": of_text}

    fields = [pa.field("n_tokens", pa.int64()), pa.field("ids_sha256", pa.string()), pa.field("decoded_sha256", pa.string())]
    return _mapped(docs, keep, "n_tokens long, ids_sha256 string, decoded_sha256 string", fields, rows)
