"""Operator 3: encode and decode every document with a byte-pair vocabulary.

Rows with a null text count as empty. The transducer and its decoder are in `bpe`: the query
feeds the ids of a text, segment by segment, into the decoder and both into digests, so that
beside the text itself memory depends on the segment and its longest run without white space.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import Decoder, encoder
from .spark_io import each_batch, texts

#: Ids that are decoded together.
PIECE = 1 << 14
DIGESTS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def tokenize(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and the token ids of every text."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column("text").to_pylist()
        pieces: list[list[bytes]] = [[] for _ in texts]
        for place, packed in encoder(path).encoded(texts):
            pieces[place].append(packed)
        ids = [np.frombuffer(b"".join(x), "<u4").astype(np.int32) for x in pieces]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return each_batch(texts(docs), work, "doc_id bigint, ids array<int>")


def detokenize(tokens: DataFrame, path: str) -> DataFrame:
    """doc_id and the plain text of the ids; a null list gives a null text."""

    def work(batches):
        machine = encoder(path)
        for batch in batches:
            found = []
            for ids in batch.column("ids").to_pylist():
                decoder = Decoder(machine, as_bytes=True)
                found.append(None if ids is None else decoder.feed(ids) + decoder.end())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.string())], ["doc_id", "text"])

    return tokens.select("doc_id", "ids").mapInArrow(work, "doc_id bigint, text string")


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    """Number and digest of the ids of every text, and digest of the text decoded from them."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        machine = encoder(path)
        texts = batch.column("text").to_pylist()
        counts = [0] * len(texts)
        ids, decoded = [hashlib.sha256() for _ in texts], [hashlib.sha256() for _ in texts]
        at, decoder = -1, Decoder(machine)
        for place, packed in machine.encoded(texts):
            if place != at:
                at, decoder = place, Decoder(machine)
            counts[place] += len(packed) // 4
            ids[place].update(packed)
            for first in range(0, len(packed), 4 * PIECE):
                part = np.frombuffer(packed[first : first + 4 * PIECE], "<u4").tolist()
                decoded[place].update(decoder.feed(part).encode())
        ids, decoded = ([x.hexdigest() for x in xs] for xs in (ids, decoded))
        columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return each_batch(texts(docs), work, DIGESTS)
