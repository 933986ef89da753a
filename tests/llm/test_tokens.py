"""Encoding, packing and counting against the library and against brute force."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lifemart.llm import encoding, packing, tokencount
from lifemart.llm.merges import MergeAutomaton, TextEncoder

PATH = public_tokenizers.path("byte_bpe_50k.json")
ROWS = [(1, None), (None, "b"), (2, "x"), (2, "x"), (3, ""), (4, "the  thing\n\n Thé <|endoftext|> " * 900), (5, "a" * 4000)]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def odd_texts():
    draw = random.Random(5)
    alphabet = "ab  \n\t thehe'sS'll0129é漢字\u00a0\u2003\x1c!?.😀ाΩ²Ⅷ"
    return ["", " ", "<|endoftext|>", " <|endoftext|>a", "a" * 300, " " * 200, *("".join(draw.choice(alphabet) for _ in range(draw.randrange(60))) for _ in range(1500)), *("".join(chr(draw.choice([draw.randrange(32, 0x250), draw.randrange(0x3000, 0x9FFF)])) for _ in range(15)) for _ in range(500))]


def test_automaton_and_ranks_equal_the_library(library, odd_texts):
    spec = open(PATH, encoding="utf-8").read()
    own, ranks = TextEncoder(MergeAutomaton.from_json(spec)), packing.LibraryEncoder(spec)
    for text, ids, theirs in zip(odd_texts, own.encode(odd_texts), library.encode_batch(odd_texts, add_special_tokens=False), strict=True):
        assert ids.tolist() == theirs.ids == ranks.encode(text)
        assert own.automaton.decode(ids.tolist()) == library.decode(theirs.ids, skip_special_tokens=False)


def test_gadgets_on_small_merge_lists():
    """Random merge lists over three letters against merging by rank."""
    draw = random.Random(3)
    for _ in range(60):
        labels, merges = [b"a", b"b", b"c"], []
        while len(merges) < 12:
            u, v = draw.randrange(len(labels)), draw.randrange(len(labels))
            if labels[u] + labels[v] not in labels:
                labels.append(labels[u] + labels[v])
                merges.append((u, v, len(labels) - 1))
        ranks, automaton = {(u, v): w for u, v, w in merges}, MergeAutomaton(labels, merges, {})
        for _ in range(30):
            word = bytes(draw.choice(b"abc") for _ in range(draw.randrange(1, 14)))
            ids = [labels.index(bytes([b])) for b in word]
            while pairs := [ranks[p] for p in zip(ids, ids[1:]) if p in ranks]:
                low, out, i = min(pairs), [], 0
                while i < len(ids):
                    if i + 1 < len(ids) and ranks.get((ids[i], ids[i + 1])) == low:
                        out, i = [*out, low], i + 2
                    else:
                        out, i = [*out, ids[i]], i + 1
                ids = out
            assert automaton.encode_word(word) == ids == automaton.encode_words([word])[0].tolist()


def test_encode_decode(spark, library):
    rows = encoding.encode_decode(spark.createDataFrame(ROWS, "doc_id long, text string"), PATH, ids=True).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        text = next(t for i, t in ROWS if i == r["doc_id"]) or ""
        ids = library.encode(text, add_special_tokens=False).ids
        assert (r["ids"], r["n_tokens"]) == (ids, len(ids))
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_packing(spark, library):
    rows = packing.pack(spark.createDataFrame([*ROWS, *((10 + i, "word " * (i * 7 % 90)) for i in range(200))], "doc_id long, text string"), PATH, capacity=64, ids=True).collect()
    by_document, by_sequence = {}, {}
    for r in rows:
        by_document.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for doc_id, text in ROWS:
        if doc_id == 2:
            continue
        ids = library.encode(text or "", add_special_tokens=False).ids + [2]
        own = sorted(by_document[doc_id], key=lambda r: r["piece"])
        assert [x for r in own for x in r["ids"]] == ids
        assert [r["start"] for r in own] == list(np.cumsum([0, *(r["length"] for r in own)])[:-1])
        assert all(r["length"] == 64 for r in own[1:])
        assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in own)
    for own in by_sequence.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == list(np.cumsum([0, *(r["length"] for r in own)])[:-1])
        assert sum(r["length"] for r in own) <= 64
    assert len(by_sequence) <= 1.02 * -(-sum(r["length"] for r in rows) // 64) + 1


def test_plan_is_best_fit():
    draw = random.Random(1)
    for _ in range(30):
        counts = {draw.randrange(1, 33): draw.randrange(1, 40) for _ in range(8)}
        bins = []  # of one piece at a time
        for length in sorted(counts, reverse=True):
            for _ in range(counts[length]):
                fits = [i for i, free in enumerate(bins) if free >= length]
                if fits:
                    bins[min(fits, key=lambda i: bins[i])] -= length
                else:
                    bins.append(32 - length)
        rows = packing.plan(counts, 32)
        ends = {}
        for length, rank, first, _ in rows:
            later = [r for n, r, *_ in rows if n == length and r > rank]
            ends[length, rank] = first + (min(later) if later else counts[length]) - rank
        assert max(ends.values()) == len(bins)


def test_token_counts(spark):
    pieces = [b"a", b"b", b"ab", b"abc", b"bcd", b"cc"]
    match, known = tokencount.LongestMatch(pieces), set(pieces)
    draw = random.Random(2)
    for _ in range(500):
        word = bytes(draw.choice(b"abcd") for _ in range(draw.randrange(12)))
        at = total = 0
        while at < len(word):
            end = next((e for e in range(len(word), at, -1) if word[at:e] in known), None)
            if end is None:
                total = 0
                break
            at, total = end, total + 1
        assert match.count(word) == total
    rows = {r["doc_id"]: r for r in tokencount.token_counts(spark.createDataFrame(ROWS, "doc_id long, text string"), PATH).collect()}
    assert (rows[1]["n_words"], rows[1]["n_tokens"]) == (0, 0)
    assert rows[5]["n_tokens"] >= 4000 // 128


def greedy(word: bytes, known: set, longest: int) -> int:
    """How many pieces, taking the longest first; 0 where there is none."""
    at = total = 0
    while at < len(word):
        end = next((e for e in range(min(len(word), at + longest), at, -1) if word[at:e] in known), None)
        if end is None:
            return 0
        at, total = end, total + 1
    return total


def test_token_counts_of_documents(spark):
    """The query's counts over whole texts, against greedy matching with the real vocabulary."""
    import regex

    from lifemart.llm import queries
    from lifemart.llm.merges import SPLIT

    folder = "/root/testdata/sf0.001"
    known, split = set(tokencount.byte_pieces(open(PATH, encoding="utf-8").read())), regex.compile(SPLIT)
    longest, found = max(map(len, known)), {r["doc_id"]: r for r in queries.op10_token_counts(spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(rows) == len(found)
    for r in rows:
        words = split.findall(r["text"] or "")
        counts = [greedy(w.encode(), known, longest) for w in words]
        got = found[r["doc_id"]]
        assert (got["n_words"], got["n_unknown"], got["n_tokens"]) == (len(words), counts.count(0), sum(counts) + counts.count(0))


def test_empty_tables_and_other_columns(spark, library):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert encoding.encode_decode(none, PATH).count() == packing.pack(none, PATH).count() == tokencount.token_counts(none, PATH).count() == 0
    odd = spark.createDataFrame([(i, t, 5, "x", [1]) for i, t in ROWS], "doc_id int, text string, n_tokens int, block string, ids array<int>")
    want = sorted(len(library.encode(t or "", add_special_tokens=False).ids) for _, t in ROWS)
    assert sorted(r["n_tokens"] for r in encoding.encode_decode(odd, PATH).collect()) == want
    packed = packing.pack(odd, PATH).collect()
    assert sum(r["length"] for r in packed) == sum(want) + len(ROWS) and {r["doc_id"] for r in packed} == {i for i, _ in ROWS}
