"""op9: exact Jaccard self-join of documents on word shingles, by partitions of the universe.

Documents are put into bands of set sizes. In a band the universe of shingles is hashed into m segments, and a
document's signature of a segment is a hash of its shingles there. Two linked sets differ in few shingles
(at most a ninth of their joint size), so a document with more filled segments than that has one in common
with each of its partners. A document goes into its own band and, if a partner could be there, into the next.
A segment counts as filled from FILL shingles on: single shingles are what unlike documents share most often.
m is the least that leaves documents enough filled segments; the price of raising m is weighed against that of
promoting segments, for which a document also shows its one-deletion neighbours (the segment's shingles without
one), so that such a segment bears one difference and counts twice. What a document is short of in spite of
that, it makes up for by showing each of its shingles. All this is exact: no frequent signature is dropped.

Signatures meet in hash buckets. Copies (equal sets) are one there. Signatures of very many sets, which a sample of the
documents tells, are dealt to buckets by document as well, and their sets meet as rows of one group. A group of documents that share signatures is first
linked to its smallest member; only groups that the verified links leave in several components have their other
pairs looked at, in blocks, and parity sketches (which never differ in more bits than the sets do in shingles)
keep the pairs few that have to be verified. Verification compares the whole sets.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import IdFilter, documents, materialise, mix, tidy
from .components import components
from .words import CHUNK, folded, words_of

WIDTH, SHARE = 5, 80
SMALL, STEP, FILL = 20, 1.25, 2
BUCKET_ENTRIES, BLOCK, BUNDLE, SKETCH_BITS = 2_000_000, 2048, 10_000, 2048
#: One document of so many is looked at for frequent signatures; those of so many sets (more, where there would be over MOST_FREQUENT of them) count as such.
RATE, FREQUENT, MOST_FREQUENT = 64, 20_000, 1_000_000
_FACTORS = mix(np.arange(1, WIDTH + 1, dtype=np.uint64)) | np.uint64(1)


def shingle_sets(texts: list[str], width: int = WIDTH):
    """Of each text, in order, the sorted 64-bit hashes of its distinct shingles; of its whole sequence if that is shorter than one."""
    group, size = [], 0
    for text in texts:
        group.append(folded(text))
        size += len(group[-1])
        if size >= 2 * CHUNK:
            yield from _sets_of(group, width)
            group, size = [], 0
    yield from _sets_of(group, width)


def _sets_of(texts: list[bytes], width: int):
    words = list(words_of(texts)) or [(np.zeros(0, np.int64), np.zeros(0, np.uint64))]
    owner, h = (np.concatenate(x) for x in zip(*words, strict=True))
    starts = np.searchsorted(owner, np.arange(len(texts) + 1))
    last = max(0, len(h) - width + 1)
    acc = np.zeros(last, np.uint64)
    for k in range(width):
        acc += h[k : k + last] * _FACTORS[k]
    acc = mix(acc)
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
        if b - a >= width:
            found = np.sort(acc[a : b - width + 1])
            yield found[np.append(True, found[1:] != found[:-1])]
        elif b > a:
            yield mix(np.array([(h[a:b] * _FACTORS[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)]))
        else:
            yield np.zeros(0, np.uint64)


def shingles(text: str, width: int = WIDTH) -> np.ndarray:
    return next(shingle_sets([text], width))


def differences(a: int, b: int, share: int = SHARE) -> int:
    """In how many shingles sets of these sizes may differ if they are linked."""
    return (100 - share) * (a + b) // (100 + share)


def band_tops(largest: int) -> list[int]:
    tops = [SMALL]
    while tops[-1] < largest:
        tops.append(int(tops[-1] * STEP))
    return [*tops, int(tops[-1] * STEP)]


def allocate(low: int, top: int) -> tuple[int, int]:
    """(segments, promoted segments) of a band, by the expected number of signatures.

    Sizes from low to top must expect enough filled segments, and promoted ones with one shingle more, with three
    deviations to spare.
    """
    best = (math.inf, 0, 0)
    sizes = sorted({low, (low + top) // 2, top})
    least = differences(top, top) + 1
    for m in sorted({int(least * f) + c for f in (1, 1.02, 1.04, 1.07, 1.1, 1.15, 1.2, 1.25, 1.3, 1.4, 1.5, 1.8, 2.5) for c in (0, 2, 5)}):
        for promoted in sorted({0, m // 50, m // 20, m // 8, m // 3}):
            cost = 0.0
            for n in sizes:
                with_k = [math.comb(n, k) * (1 / m) ** k * (1 - 1 / m) ** (n - k) if m > 1 else float(n == k) for k in range(FILL + 1)]
                filled, more = 1 - sum(with_k[:FILL]), 1 - sum(with_k)
                spread = 3 * math.sqrt(m * filled * (1 - filled) + 1)
                if m * filled + promoted * more - spread < differences(n, min(n * 100 // SHARE, top)) + 1:
                    cost = math.inf
                cost = max(cost, m * filled + promoted * n / m)
            best = min(best, (cost, m, promoted))
    return (best[1], best[2]) if best[0] < math.inf else (4 * top, 0)


def signatures(found: np.ndarray, band: int, low: int, top: int, spread: tuple[int, int]) -> np.ndarray:
    """What a set shows in a band."""
    n, tag = len(found), np.uint64(band * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    alone = lambda: mix(found ^ tag) ^ np.uint64(0x5BD1E995)
    if band == 0:
        return alone()
    m, promoted = spread
    part = mix(found + tag) % np.uint64(m)
    order = np.argsort(part.astype(np.uint16) if m < 1 << 16 else part, kind="stable")
    part, inside = part[order], mix(found[order] + np.uint64(band))
    first = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
    sums, count = np.add.reduceat(inside, first), np.diff(np.append(first, n))
    key = mix(part[first] * np.uint64(0xC2B2AE3D27D4EB4F) + tag)
    filled = count >= FILL
    shown = [mix(sums ^ key)[filled]]
    more = (part[first] < promoted) & (count > FILL)
    if more.any():
        at = np.repeat(more, count)
        shown.append(mix((np.repeat(sums, count)[at] - inside[at]) ^ np.repeat(key, count)[at]))
    if int(filled.sum()) + int(more.sum()) <= differences(n, min(n * 100 // SHARE, top)):
        shown.append(alone())
    return np.concatenate(shown)


def _sets(docs: DataFrame) -> DataFrame:
    """doc_id, n, d1, d2, sketch: the size of each set, a 128-bit digest of it and its parity sketch."""

    def run(batches):
        for batch in batches:
            made = list(shingle_sets(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(x) for x in made], pa.int64()), *(pa.array([int(mix(x + np.uint64(k)).sum(dtype=np.uint64)) - (1 << 63) for x in made], pa.int64()) for k in (1, 2)), pa.array([_sketch(x) for x in made], pa.binary())], ["doc_id", "n", "d1", "d2", "sketch"])

    return docs.mapInArrow(tidy(run), "doc_id long, n long, d1 long, d2 long, sketch binary")


class Bands:
    """What sets of each size show."""

    def __init__(self, largest: int):
        self.tops = band_tops(max(largest, SMALL))
        self.lows = [1, *(t + 1 for t in self.tops)]
        self.spreads = [(0, 0), *(allocate(max(1, self.lows[k] * SHARE // 100), self.tops[k]) for k in range(1, len(self.tops)))]

    def shown(self, found: np.ndarray) -> np.ndarray:
        """In the own band and, if a partner could be there, in the next."""
        band = int(np.searchsorted(self.tops, len(found)))
        own = [signatures(found, k, self.lows[k], self.tops[k], self.spreads[k]) for k in (band, band + 1) if k == band or len(found) * 100 // SHARE >= self.lows[k]]
        return np.concatenate(own)


def _frequent(docs: DataFrame, bands: Bands, entries: int) -> np.ndarray:
    """The sorted signatures that more than FREQUENT different sets are expected to show, MOST_FREQUENT at most: there are entries in all."""

    def run(batches):
        for batch in batches:
            for found in shingle_sets(batch.column("text").to_pylist()):
                if len(found):
                    sigs = np.unique(bands.shown(found)).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(sigs), pa.array(np.full(len(sigs), mix(found).sum(dtype=np.uint64)).view(np.int64))], ["signature", "digest"])

    least = max(FREQUENT, entries // MOST_FREQUENT) / RATE
    sample = docs.where(F.pmod(F.xxhash64("doc_id", F.lit("frequent")), F.lit(RATE)) == 0)
    shown = sample.mapInArrow(tidy(run), "signature long, digest long").distinct()
    found = shown.groupBy("signature").agg(F.count("*").alias("n")).where(F.col("n") > least).select("signature").toArrow()
    return np.sort(found.column("signature").to_numpy().view(np.uint64))


def _shown(docs: DataFrame, bands: Bands, frequent: np.ndarray, buckets: int) -> DataFrame:
    """bucket, ids, digests, counts, signatures: of a batch, what each document shows in each bucket, copies once."""
    held = docs.sparkSession.sparkContext.broadcast(frequent)  # MOST_FREQUENT at most

    def run(batches):
        for batch in batches:
            ids, digests, kept, seen = [], [], [], {}
            for doc_id, found in zip(batch.column("doc_id").to_pylist(), shingle_sets(batch.column("text").to_pylist()), strict=True):
                if doc_id is None or not len(found):
                    continue
                digest = int(mix(found).sum(dtype=np.uint64)) - (1 << 63)
                if digest in seen:
                    ids[seen[digest]] = min(ids[seen[digest]], doc_id)
                    continue
                seen[digest] = len(ids)
                ids.append(doc_id)
                digests.append(digest)
                kept.append(bands.shown(found))
            if not ids:
                continue
            every, owner = np.concatenate(kept), np.repeat(np.arange(len(ids)), [len(x) for x in kept])
            del kept
            id_of, digest_of = np.array(ids), np.array(digests)
            bucket = (every % np.uint64(buckets)).astype(np.int32)
            if len(held.value):
                hot = np.flatnonzero(held.value[np.minimum(np.searchsorted(held.value, every), len(held.value) - 1)] == every)
                bucket[hot] = buckets + (mix(every[hot] + mix(id_of)[owner[hot]]) % np.uint64(buckets)).astype(np.int32)
            order = np.argsort(bucket, kind="stable")
            every, owner, cut = every[order], owner[order], np.searchsorted(bucket[order], np.arange(2 * buckets + 1))
            out: dict[str, list] = {name: [] for name in ("bucket", "ids", "digests", "counts", "signatures")}
            for b in np.flatnonzero(np.diff(cut)):
                docs_in, counts = np.unique(owner[cut[b] : cut[b + 1]], return_counts=True)
                for name, x in (("ids", id_of[docs_in]), ("digests", digest_of[docs_in]), ("counts", counts.astype(np.uint32)), ("signatures", every[cut[b] : cut[b + 1]])):
                    out[name].append(x.tobytes())
                out["bucket"].append(int(b))
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("bucket", pa.int32()), *((n, pa.binary()) for n in list(out)[1:])]))

    return docs.mapInArrow(tidy(run), "bucket int, ids binary, digests binary, counts binary, signatures binary")


def _groups(buckets: int):
    return lambda bucket: _group_rows(bucket, bucket.column("bucket")[0].as_py() >= buckets)


def _group_rows(bucket: pa.Table, frequent: bool) -> pa.Table:
    """gid, doc: the sets of two or more documents (no two of them copies) that share a signature; equal sets once. Of frequent signatures, all documents, as others are elsewhere."""
    ids, digests, counts, sigs = (np.frombuffer(b"".join(bucket.column(n).to_pylist()), t) for n, t in (("ids", np.int64), ("digests", np.int64), ("counts", np.uint32), ("signatures", np.uint64)))
    _, first, same = np.unique(digests, return_index=True, return_inverse=True)
    low = np.full(len(first), np.iinfo(np.int64).max)
    np.minimum.at(low, same, ids)
    once = np.zeros(len(ids), bool)
    once[first] = True
    keep = np.repeat(once, counts)
    sigs, doc = sigs[keep], np.repeat(low[same], counts)[keep]
    order = np.lexsort((doc, sigs))
    sigs, doc = sigs[order], doc[order]
    new = np.append(True, (sigs[1:] != sigs[:-1]) | (doc[1:] != doc[:-1])) if len(sigs) else np.zeros(0, bool)
    sigs, doc = sigs[new], doc[new]
    if frequent:
        return pa.table({"gid": mix(sigs + np.uint64(1)).view(np.int64), "doc": doc})
    start = np.flatnonzero(np.append(True, sigs[1:] != sigs[:-1])) if len(sigs) else np.zeros(0, np.int64)
    size = np.diff(np.append(start, len(sigs)))
    start, size = start[size > 1], size[size > 1]
    if not len(start):
        return pa.table({"gid": pa.array([], pa.int64()), "doc": pa.array([], pa.int64())})
    inside = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(doc), dtype=np.uint64)])
    gid, at = np.unique(inside[start + size] - inside[start], return_index=True)
    start, size = start[at], size[at]
    place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(start, size)
    return pa.table({"gid": np.repeat(gid.astype(np.int64), size), "doc": doc[place]})


def _sketch(found: np.ndarray) -> bytes:
    odd = np.bincount((mix(found ^ np.uint64(77)) % np.uint64(SKETCH_BITS)).astype(np.int64), minlength=SKETCH_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _whole(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """doc, n, shingles of the wanted documents (and of few others)."""
    kept = IdFilter(wanted)

    def run(batches):
        for batch in batches:
            batch = batch.filter(batch.column("doc_id").is_valid())
            batch = batch.filter(pa.array(kept.may_hold(batch.column("doc_id").to_numpy()), pa.bool_()))
            made = list(shingle_sets(batch.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(x) for x in made], pa.int64()), pa.array([x.tobytes() for x in made], pa.binary())], ["doc", "n", "shingles"])

    return docs.mapInArrow(tidy(run), "doc long, n long, shingles binary")


def _possible(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that sizes and sketches allow."""

    def run(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(len(batch), -1) for c in ("x", "y"))
            apart = np.bitwise_count(x ^ y).sum(1, dtype=np.int64)
            yield batch.select(["a", "b"]).filter(pa.array(apart <= batch.column("most").to_numpy(), pa.bool_()))

    own = lambda c, n, s: sets.where("n > 0").select(F.col("doc_id").alias(c), F.col("n").alias(n), F.col("sketch").alias(s))
    both = pairs.join(own("a", "na", "x"), "a").join(own("b", "nb", "y"), "b").where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * SHARE)
    most = F.floor((100 - SHARE) * (F.col("na") + F.col("nb")) / (100 + SHARE)).cast("long")
    return both.select("a", "b", "x", "y", most.alias("most")).mapInArrow(tidy(run), "a long, b long").distinct()


def _verified(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are linked; the sets of their documents are made once more and travel to them."""

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = np.concatenate([x, y])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= SHARE * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    wanted = materialise(pairs.select(F.explode(F.array("a", "b")).alias("doc")).distinct(), "wanted")
    sets = materialise(_whole(docs, wanted), "whole").select("doc", "shingles")
    left = pairs.join(sets.select(F.col("doc").alias("a"), F.col("shingles").alias("x")), "a")
    both = left.join(sets.select(F.col("doc").alias("b"), F.col("shingles").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(tidy(run), "a long, b long")


def _apart(block: pa.Table) -> pa.Table:
    """Pairs across components that sizes and sketches allow: in each group of a bundle, or between two parts of one group."""
    block = block.sort_by("gid")
    gid, doc, n, group, part, first, second = (block.column(c).to_numpy() for c in ("gid", "doc", "n", "component", "part", "first", "second"))
    sketch = np.frombuffer(b"".join(block.column("sketch").to_pylist()), np.uint64).reshape(len(doc), -1)
    cuts = [*np.flatnonzero(np.append(True, gid[1:] != gid[:-1])).tolist(), len(gid)]
    found = []
    for lo, hi in zip(cuts, cuts[1:]):
        at = np.arange(lo, hi)
        left, right = at[part[at] == first[lo]], at[part[at] == second[lo]]
        step = max(1, 32_768 // max(1, len(right)))
        for k in range(0, len(left), step):
            i, j = np.repeat(left[k : k + step], len(right)), np.tile(right, len(left[k : k + step]))
            keep = (group[i] != group[j]) & (np.minimum(n[i], n[j]) * 100 >= np.maximum(n[i], n[j]) * SHARE)
            if first[lo] == second[lo]:
                keep &= doc[j] < doc[i]
            i, j = i[keep], j[keep]
            keep = np.bitwise_count(sketch[j] ^ sketch[i]).sum(1, dtype=np.int64) <= (100 - SHARE) * (n[j] + n[i]) // (100 + SHARE)
            found.append(np.stack([np.maximum(doc[i[keep]], doc[j[keep]]), np.minimum(doc[i[keep]], doc[j[keep]])]))
    pairs = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((2, 0), np.int64)
    return pa.table({"a": pairs[0], "b": pairs[1]})


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of each document.

    Two documents link when 100 * intersection >= 80 * union of their sets. Null or empty texts have empty sets
    and link with nothing; a row with a null id links with nothing and has no component. Rows that repeat an id
    are one document: a link of any is a link of all. component_id is the smallest doc_id reachable by links.
    """
    docs = documents(docs)
    sets = materialise(_sets(docs), "sets")
    size = sets.agg(F.max("n").alias("largest"), F.sum("n").alias("all")).first()
    buckets = max(24, (size["all"] or 0) * 6 // 10 // BUCKET_ENTRIES)
    shape = "gid long, doc long"
    bands = Bands(size["largest"] or 0)
    frequent = _frequent(docs, bands, (size["all"] or 0) * 6 // 10)
    groups = materialise(_shown(docs, bands, frequent, buckets).groupBy("bucket").applyInArrow(_groups(buckets), shape).distinct(), "groups")
    stars = materialise(groups.join(groups.groupBy("gid").agg(F.min("doc").alias("b")), "gid").where("doc <> b").select(F.col("doc").alias("a"), "b").distinct(), "stars")
    links = materialise(_verified(materialise(_possible(stars, sets), "possible"), docs), "links")
    known = materialise(components(links), "components")
    placed = groups.join(known, F.col("doc") == F.col("id"), "left").select("gid", "doc", F.coalesce("component", "doc").alias("component"))
    placed = materialise(placed, "placed")
    mixed = placed.groupBy("gid").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("size")).where("lo < hi and size > 2").select("gid", "size", F.ceil(F.col("size") / BLOCK).cast("int").alias("parts"))
    mixed = materialise(mixed, "mixed")
    spread = placed.join(mixed.drop("size"), "gid").join(sets.select(F.col("doc_id").alias("doc"), "n", "sketch").where("n > 0"), "doc")
    spread = spread.withColumn("part", F.pmod(F.xxhash64("doc"), F.col("parts")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    blocks = spread.select("gid", "parts", "doc", "component", "n", "sketch", "part", F.least("part", "other").alias("first"), F.greatest("part", "other").alias("second"))
    bundles = max(1, (mixed.agg(F.sum("size")).first()[0] or 0) // BUNDLE)
    bundle = F.when(F.col("parts") == 1, F.pmod(F.xxhash64("gid"), F.lit(bundles))).otherwise(-1)
    alone = F.when(F.col("parts") == 1, 0).otherwise(F.col("gid"))
    rest = materialise(blocks.groupBy(bundle.alias("bundle"), alone.alias("alone"), "first", "second").applyInArrow(_apart, "a long, b long").distinct().join(stars, ["a", "b"], "left_anti"), "pairs")
    sets = sets.drop("sketch")
    reps = materialise(sets.where("n > 0 and doc_id is not null").groupBy("d1", "d2", "n").agg(F.min("doc_id").alias("rep")), "reps")
    one = F.struct("n", "d1", "d2")
    unlike = sets.where("doc_id is not null").groupBy("doc_id").agg(F.min(one).alias("lo"), F.max(one).alias("hi")).where("lo < hi").select("doc_id")
    same_id = sets.join(unlike, "doc_id").join(reps, ["d1", "d2", "n"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    every = materialise(components(links.unionByName(_verified(rest, docs)).unionByName(same_id)), "every")
    classes = materialise(reps.join(every, F.col("rep") == F.col("id"), "left").select("d1", "d2", "n", F.coalesce("component", "rep").alias("component")), "classes")
    placed = sets.where("n > 0").join(classes, ["d1", "d2", "n"], "left").select("doc_id", "n", "component")
    placed = placed.unionByName(sets.where("n = 0").join(every, F.col("doc_id") == F.col("id"), "left").select("doc_id", "n", "component"))
    return placed.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
