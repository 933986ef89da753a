"""op8: BPE encoding and decoding of whole texts by the merge automaton."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import documents, tidy
from .merges import MergeAutomaton, TextEncoder

_compiled: dict[int, TextEncoder] = {}


def encoder(spec: str) -> TextEncoder:
    """The encoder of a tokenizers file's content; compiled once in a process."""
    key = hash(spec)
    if key not in _compiled:
        _compiled[key] = TextEncoder(MergeAutomaton.from_json(spec))
    return _compiled[key]


def read_vocabulary(path: str) -> str:
    """The file's content. A vocabulary's size is fixed (some MB), so tasks may carry it."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encode_decode(docs: DataFrame, vocabulary: str, ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 (and ids, decoded if asked for) of each document.

    Null and empty texts have no ids and decode to the empty text. Strings of added tokens in a text are their
    one id, as in the library. One map over the documents: no shuffle; any text length.
    """
    docs = documents(docs)
    held = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def run(batches):
        code = encoder(held.value)
        decimal = list(map(str, range(len(code.automaton.labels))))
        for batch in batches:
            texts, lo = batch.column("text").to_pylist(), 0
            out = {"doc_id": batch.column("doc_id"), "n_tokens": [], "ids_sha256": [], "decoded_sha256": []} | ({"ids": [], "decoded": []} if ids else {})
            while lo < len(texts):
                hi, size = lo, 0
                while hi < len(texts) and (hi == lo or size + len(texts[hi]) < 2_000_000):
                    size += len(texts[hi])
                    hi += 1
                for found in code.encode(texts[lo:hi]):
                    own = found.tolist()
                    decoded = code.automaton.decode(own)
                    out["n_tokens"].append(len(own))
                    out["ids_sha256"].append(hashlib.sha256(",".join(map(decimal.__getitem__, own)).encode()).hexdigest())
                    out["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
                    if ids:
                        out["ids"].append(own)
                        out["decoded"].append(decoded)
                lo = hi
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    schema = pa.schema(fields + ([("ids", pa.list_(pa.int32())), ("decoded", pa.string())] if ids else []))
    return docs.mapInArrow(tidy(run), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>, decoded string" if ids else ""))
