"""op10: how many word pieces a text has, by a linear longest-match automaton.

The vocabulary's trie gets failure links: a node's link leads to where the match stands once the pieces that the
greedy longest match must emit by then are popped, and the node keeps only how many those are. Each byte of a
word then costs one transition, and each link is followed at most once for a byte read: no backtracking, and no
piece is ever built.
"""

from __future__ import annotations

import json

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import documents, tidy
from .encoding import read_vocabulary
from .merges import SPLIT, byte_symbols

WORDS_KEPT = 600_000


class LongestMatch:
    """Counts the pieces of words; a word that the pieces can't spell is one unknown piece."""

    def __init__(self, pieces: list[bytes]):
        goto: dict[int, int] = {}
        depth = [0]
        parent, byte, whole = [-1], [-1], [False]
        for piece in pieces:
            node = 0
            for b in piece:
                nxt = goto.get(node << 8 | b)
                if nxt is None:
                    nxt = goto[node << 8 | b] = len(parent)
                    parent.append(node)
                    byte.append(b)
                    whole.append(False)
                    depth.append(depth[node] + 1)
                node = nxt
            whole[node] = node > 0
        link, popped = [-1] * len(parent), [0] * len(parent)
        for node in sorted(range(1, len(parent)), key=depth.__getitem__):
            if whole[node]:
                link[node], popped[node] = 0, 1
                continue
            at, count = link[parent[node]], popped[parent[node]]
            while at >= 0 and (nxt := goto.get(at << 8 | byte[node])) is None:
                at, count = link[at], count + popped[at]
            if at >= 0:
                link[node], popped[node] = nxt, count
        self.goto, self.link, self.popped = goto, link, popped

    def count(self, word: bytes) -> int:
        """The number of pieces; 0 if there is no way to spell the word greedily."""
        goto, link, popped = self.goto, self.link, self.popped
        node = total = 0
        for b in word:
            while (nxt := goto.get(node << 8 | b)) is None:
                total += popped[node]
                node = link[node]
                if node < 0:
                    return 0
            node = nxt
        while node:
            total += popped[node]
            node = link[node]
            if node < 0:
                return 0
        return total


def byte_pieces(spec: str) -> list[bytes]:
    """The pieces of a byte-level vocabulary."""
    symbols = byte_symbols()
    return [bytes(symbols[c] for c in s) for s in json.loads(spec)["model"]["vocab"] if all(c in symbols for c in s)]


_compiled: dict[int, tuple[LongestMatch, dict[str, int]]] = {}


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_words, n_tokens, n_unknown of each document: greedy longest-match pieces of its pre-split words.

    Null and empty texts have no words. An unknown word counts as one token. One map, no shuffle, any text length.
    """
    docs = documents(docs)
    held = docs.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))

    def run(batches):
        spec = held.value
        if hash(spec) not in _compiled:
            _compiled[hash(spec)] = LongestMatch(byte_pieces(spec)), {}
        match, known = _compiled[hash(spec)]
        split = regex.compile(SPLIT)
        for batch in batches:
            out: dict[str, list] = {"doc_id": batch.column("doc_id"), "n_words": [], "n_tokens": [], "n_unknown": []}
            for text in batch.column("text").to_pylist():
                if len(known) > WORDS_KEPT:
                    known.clear()
                words = split.findall(text)
                for w in set(words):
                    if w not in known:
                        known[w] = match.count(w.encode())
                counts = list(map(known.__getitem__, words))
                unknown = counts.count(0)
                out["n_words"].append(len(words))
                out["n_tokens"].append(sum(counts) + unknown)
                out["n_unknown"].append(unknown)
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_tokens", pa.int64()), ("n_unknown", pa.int64())])
    return docs.mapInArrow(tidy(run), "doc_id long, n_words long, n_tokens long, n_unknown long")
