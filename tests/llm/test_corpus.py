"""Operators on whole corpora against brute force on small ones."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lifemart.llm import components, embeddings, fingerprint, jaccard, lmscore, passages, quality, urlgraph

EDGE = [(1, None), (None, "b"), (2, "x"), (2, "x"), (3, ""), (4, "Ab  é ﬁ"), (5, "aB é fi"), (6, "z" * 50_000)]
FOLDER = "/root/testdata/sf0.001"


def frame(spark, rows, more=""):
    return spark.createDataFrame(rows, "doc_id long, text string" + more)


def groups(links, ids):
    top = {i: i for i in ids}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        top[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components(spark):
    draw = random.Random(2)
    links = [(draw.randrange(200), draw.randrange(200)) for _ in range(150)] + [(5000 + i, 5001 + i) for i in range(30)] + [(9000, 8000 + i) for i in range(30)]
    found = {r["id"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    ids = {x for a, b in links if a != b for x in (a, b)}
    assert found == groups(links, ids)
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_ppm(rows, order):
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    seen, words = defaultdict(Counter), Counter()
    spell = lambda t: [257] * order + list((t or "").encode().lower()) + [256]
    for i, t in rows:
        if not held(i):
            b = spell(t)
            for p in range(order, len(b)):
                for k in range(order + 1):
                    seen[tuple(b[p - k : p])][b[p]] += 1
            words.update([*(t or "").encode().lower().split(), b""])
    n, v, out = sum(words.values()), len(words), []
    for i, t in rows:
        b, total = spell(t), 0.0
        for p in range(order, len(b)):
            barred = set()
            for k in range(order, -1, -1):
                counts = {x: c for x, c in seen.get(tuple(b[p - k : p]), {}).items() if x not in barred}
                if not counts:
                    continue
                if b[p] in counts:
                    total += math.log10((2 * counts[b[p]] - 1) / (2 * sum(counts.values())))
                    break
                total += math.log10(len(counts) / (2 * sum(counts.values())))
                barred |= set(counts)
            else:
                total += math.log10(1 / (257 - len(barred)))
        own = [*(t or "").encode().lower().split(), b""]
        out.append((str(i), held(i), len(own), sum(words[w] > 0 for w in own), n, sum(math.log10((words[w] + 1) / (n + v + 1)) for w in own), total))
    return sorted(out)


def test_language_model(spark, monkeypatch):
    monkeypatch.setattr(lmscore, "CHUNK", 700)  # texts are cut within and between chunks
    table = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60)
    for rows in ([(r["doc_id"], r["text"]) for r in table.collect()] + EDGE[:5], EDGE[:5]):
        found = sorted((str(r[0]), *r[1:]) for r in lmscore.score_texts(frame(spark, rows), order=3).collect())
        for a, b in zip(found, brute_ppm(rows, 3), strict=True):
            assert a[:5] == b[:5]
            assert abs(a[5] - b[5]) < 1e-6 and abs(a[6] - b[6]) < 1e-6
    assert lmscore.score_texts(frame(spark, [])).count() == 0


def test_fingerprints(spark):
    edge = [(i, t) for i, t in EDGE if i not in (None, 2)]
    more = [(100 + r["doc_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60).collect()]
    for rows, one_range in ((edge, "true"), (edge + more, "false"), (edge[:1], "false")):
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", one_range)
        found = {r["doc_id"]: r for r in fingerprint.fingerprints(frame(spark, rows)).collect()}
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        order = sorted(rows, key=lambda r: -r[0])
        for at, (i, text) in enumerate(order):
            text, following = text or "", order[(at + 1) % len(order)][1] or ""
            cut = len(text) // 3
            edited = text[: len(text) - cut] + following[:cut]
            r = found[i]
            assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
            assert (r["near_edited"] == 1) == (fingerprint.canonical(edited) == fingerprint.canonical(text)) == (r["fingerprint"] == r["edited_fingerprint"])
            assert (r["near_next"] == 1) == (fingerprint.canonical(following) == fingerprint.canonical(text))
        if len(rows) > 1:
            assert found[4]["fingerprint"] == found[5]["fingerprint"] != found[6]["fingerprint"]
    odd = [*EDGE, (None, None), (None, "b"), (2, "y")]
    assert Counter(r["doc_id"] for r in fingerprint.fingerprints(spark.createDataFrame([(*r, 1, 2.0) for r in odd], "doc_id long, text string, part int, kind double")).collect()) == Counter(i for i, _ in odd)
    assert fingerprint.fingerprints(frame(spark, [])).count() == 0


def test_embeddings(spark):
    draw = np.random.default_rng(4)
    x = draw.normal(size=(3000, 16))
    x[1000:1400] = x[:400] + draw.normal(size=(400, 16)) * 0.12
    x[2000:2300] = x[7] + draw.normal(size=(300, 16)) * 0.1
    x[2900:] = x[9]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    found = embeddings.link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("vec_id").toPandas()
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    assert (found["n_links"].to_numpy() <= near.sum(1)).all()
    assert found["n_links"].sum() >= 0.99 * near.sum()
    assert (found["kept"] == (found["vec_id"] == found["component_id"])).all()
    odd = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [None, 1.0]), (6, [math.nan, 1.0]), (7, [1.0, 0.0, 0.0]), (8, []), (None, [1.0, 0.0]), (9, [1.0, 0.1]), (9, [1.0, 0.1])]
    rows = [tuple(r) for r in embeddings.link_vectors(spark.createDataFrame(odd, "vec_id long, embedding array<float>")).collect()]
    assert sorted(rows, key=str) == sorted([(1, 3, 1, True), (2, 3, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True), (8, 0, 8, True), (None, 0, None, False), (9, 3, 1, False), (9, 3, 1, False)], key=str)


def test_embeddings_in_parted_cells(spark, monkeypatch):
    """Few centres for many vectors, as in a large table: cells are parted again, dense ones stay whole."""
    for name, value in (("MOST_CELLS", 12), ("CELL_SIZE", 64), ("SPLIT", 256), ("FINE_SAMPLE", 1024), ("BLOCK", 100)):
        monkeypatch.setattr(embeddings, name, value)
    draw = np.random.default_rng(5)
    x = draw.normal(size=(6000, 24))
    x[1000:2500] = x[:1500] + draw.normal(size=(1500, 24)) * 0.12
    x[3000:3900] = x[7] + draw.normal(size=(900, 24)) * 0.1
    placed = []
    part = embeddings.part_large_cells
    monkeypatch.setattr(embeddings, "part_large_cells", lambda df: placed.append((df, part(df))) or placed[-1][1])
    found = embeddings.link_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).orderBy("vec_id").toPandas()
    before, after = (df.selectExpr("explode(cells) c").groupBy("c").count().toPandas()["count"] for df in placed[0])
    assert len(after) > 3 * len(before)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    assert (found["n_links"].to_numpy() <= near.sum(1)).all()
    dense = np.zeros(6000, bool)
    dense[3000:3900] = dense[7] = True
    counts = found["n_links"].to_numpy()
    assert counts[dense].sum() >= 0.99 * near[dense].sum() and counts[~dense].sum() >= 0.95 * near[~dense].sum()


def brute_jaccard(rows):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    top = groups(links, ids)
    return {i: (len(sets[i]), top[i]) for i in ids}


@pytest.mark.parametrize("frequent", [False, True])
def test_jaccard(spark, monkeypatch, frequent):
    if frequent:  # nearly all signatures are dealt by document, and groups are cut into parts
        for name, value in (("RATE", 1), ("FREQUENT", 1), ("BLOCK", 2)):
            monkeypatch.setattr(jaccard, name, value)
    draw = random.Random(3)
    words, rows = [str(i) for i in range(3000)], [(0, None), (1, ""), (2, "a b"), (3, "A B"), (4, "a b c d e"), (5, "a b c d e f")]
    for _ in range(60):
        base = [draw.choice(words) for _ in range(draw.choice([7, 12, 20, 25, 40, 80, 160]))]
        for _ in range(draw.choice([1, 2, 3, 8])):
            text = list(base)
            for _ in range(draw.randrange(1 + len(text) // 40)):
                at = draw.randrange(len(text))
                text[at : at + draw.randrange(2)] = [draw.choice(words)]
            rows.append((len(rows), " ".join(text)))
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(frame(spark, rows)).collect()}
    assert found == brute_jaccard(rows)
    assert jaccard.near_duplicates(frame(spark, [])).count() == 0
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in jaccard.near_duplicates(frame(spark, [(None, "a b"), (7, "a b"), (7, "a b")])).collect()) == [("7", "7"), ("7", "7"), ("None", "None")]


def brute_passages(rows, least=passages.MIN_WORDS):
    first, out = {}, []
    rank = lambda i: 1 << 70 if i is None else i
    for i, t in rows:
        cuts = passages.units(t or "")
        for a, b in zip(cuts, cuts[1:]):
            form = " ".join(t[a:b].lower().split())
            first[form] = min(first.get(form, (1 << 71, 0)), (rank(i), a))
    for i, t in rows:
        cuts, run, kept = passages.units(t or ""), [], []
        for a, b in [*zip(cuts, cuts[1:]), (None, None)]:
            form = None if a is None else " ".join(t[a:b].lower().split())
            if a is not None and (form == "" and run or form and first[form] != (rank(i), a)):
                run.append(t[a:b])
                continue
            if sum(len(x.split()) for x in run) < least:
                kept += run
            run = []
            if a is not None:
                kept.append(t[a:b])
        out.append((str(i), t if t is None else "".join(kept)))
    return sorted(out, key=str)


def test_passages(spark):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in table.collect()] + [(-3, None), (None, "B."), (9001, ""), (9002, "One two three four five six seven eight nine ten eleven. One two three four five six seven eight nine. A b"), (9003, "z. one two three  four five six seven eight nine ten ELEVEN. One two three four five six seven eight nine.  A c\n\n"), (9004, "q " * 200_000 + ". x\n" + "r " * 30)]
    rows += [(9005, rows[-1][1]), (9006, "a b")]
    result = passages.remove_repeats(frame(spark, [(*r, 1) for r in rows], ", packet int"), spans=True).collect()
    assert sorted([(str(r["doc_id"]), r["text"]) for r in result], key=str) == brute_passages(rows)
    texts = dict(rows)
    for r in result:
        at, kept = 0, ""
        for s in r["removed_spans"]:
            kept, at = kept + texts[r["doc_id"]][at : s["start"]], s["end"]
        assert r["text"] is None or kept + texts[r["doc_id"]][at:] == r["text"]
    assert passages.remove_repeats(frame(spark, [])).count() == 0
    odd = spark.createDataFrame([(r[0], r[1], 7, "s", "d") for r in rows[-4:]], "doc_id int, text string, n_chars int, removed_spans string, digest string")
    again = {r["doc_id"]: r for r in passages.remove_repeats(odd, spans=True).collect()}
    assert again[9005]["text"] == "" and again[9005]["n_chars"] == 0 and again[9006]["removed_spans"] == [] and again[9004]["digest"] == "d"
    assert again[9005]["removed_spans"] == [(0, len(rows[-2][1]))]


def test_passages_of_rows_with_one_id(spark):
    """What rows of one id, or without one, share stays once, wherever it stands in them."""
    passage = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty."
    own = [f"Text {w} is here." for w in ("red", "blue", "green", "grey")]
    rows = [(1, passage), (1, passage), (1, f"{own[0]} {passage}"), (None, f"{own[1]} {passage}"), (None, f"{passage} {own[2]}"), (2, f"{own[3]} {passage}")]
    for parts in (1, 3):
        found = [(r["doc_id"], r["text"]) for r in passages.remove_repeats(frame(spark, rows).repartition(parts)).collect()]
        assert sum(passage in t for _, t in found) == 1 and next(i for i, t in found if passage in t) == 1
        assert all(sum(w in t for _, t in found) == 1 for w in own) and len(found) == len(rows)


def test_quality(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    model = quality.train(docs, labels)
    rows = quality.classify(docs, model).where("held_out").join(labels, "doc_id").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.9
    moved = quality.train(docs, labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 4 = 2 then 1 - quality else quality end as quality"))
    assert moved.base == model.base and all((a == b).all() for a, b in zip(model.tables, moved.tables))
    edge = quality.classify(frame(spark, EDGE), model)
    assert edge.count() == len(EDGE) and edge.where("score between 0 and 1").count() == len(EDGE)
    assert quality.keep_good(frame(spark, EDGE), quality.train(docs, labels.limit(0))).count() == len(EDGE)


def test_url_rules_and_ranks(spark):
    rows = [(1, "HTTP://WWW.Example.COM/en/x?q", "<a href='http://bad.net/fr/'>"), (2, None, None), (3, "nourl", "x"), (4, "x://bad.net/fr/1", "<p>"), (6, "a://h.org?x", "<img src=//u@Bad.net:80/z>"), (7, "a://exaMple.com/en/", ""), (8, "a://com", "")]
    found = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in urlgraph.judge(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found[1] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert found[2] == found[3] == ("", "", None, "allow")
    assert found[4][2:] == ("net/fr/", "block") and found[7][2:] == ("example.com/en/", "block") and found[8] == ("com", "", None, "allow")
    assert urlgraph.judge(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
    hosts = [f"h{i}" for i in range(12)]
    draw = random.Random(1)
    edges = {(a, b): draw.randrange(1, 4) for a in hosts for b in hosts if a != b and draw.random() < 0.2}
    seeds = {h: (draw.random() * (draw.random() < 0.4), draw.random() * (draw.random() < 0.4)) for h in hosts}
    got = {r["host"]: (r["trust"], r["distrust"]) for r in urlgraph.propagate(spark.createDataFrame([(h, *v) for h, v in seeds.items()], "host string, trust double, distrust double"), spark.createDataFrame([(*k, n) for k, n in edges.items()], "src string, dst string, n long"), rounds=4, tolerance=0.0).collect()}
    trust, distrust = brute_walks(seeds, edges, 4)
    assert all(abs(got[h][0] - trust[h]) + abs(got[h][1] - distrust[h]) < 1e-9 for h in hosts)


def brute_walks(seeds, edges, rounds):
    """Shares of the rank with all hosts as seeds, of trust along the edges and of distrust against them."""
    out = []
    for kind, way in ((0, edges), (1, {(b, a): n for (a, b), n in edges.items()})):
        total, hosts = Counter(), {*seeds, *(h for e in edges for h in e)}
        for (a, _), n in way.items():
            total[a] += n
        walks = []
        for start in ({h: seeds.get(h, (0, 0))[kind] for h in hosts}, dict.fromkeys(hosts, 1.0)):
            rank = start
            for _ in range(rounds):
                new = dict(start)
                for (a, b), n in way.items():
                    new[b] += 0.85 * rank[a] * n / total[a]
                rank = new
            walks.append(rank)
        out.append({h: walks[0][h] / walks[1][h] for h in hosts})
    return out


def test_graph_verdicts(spark):
    bad = [*((i, f"http://bad.net/fr/{i}", None) for i in range(20)), (20, "http://u@bad.net:80/en", None)]
    rows = [*bad, (30, "http://links.org/1", "<a href=//BAD.net:8080/x> <a href='http://bad.net'>"), (31, "http://plain.org/1", "<a href='/x'>"), (32, "http://shop.farm.net/en/", "<p>"), (33, "http://farm.net/fr/1", ""), (34, "http://a.farm.net/es/1", ""), (35, "http://ok.com/fr", "<a href=http://other.org>"), (35, "http://plain.org:99/2", "x" * 300_000 + " href=//links.org")]
    found = sorted((r["page_id"], r["host"], r["verdict"]) for r in urlgraph.judge(spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, node int, said string")).collect())
    assert found[:21] == [*((i, "bad.net", "block") for i in range(20)), (20, "u@bad.net:80", "block")]
    assert found[21:] == [(30, "links.org", "block"), (31, "plain.org", "allow"), (32, "shop.farm.net", "block"), (33, "farm.net", "block"), (34, "a.farm.net", "block"), (35, "ok.com", "allow"), (35, "plain.org:99", "allow")]


def test_graph_on_pages(spark):
    """All verdicts of sf0.1, whose pages have no links, against the walks over the hosts and those above them."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    found = urlgraph.judge(pages).collect()
    hosts = defaultdict(list)
    for r in found:
        hosts[r["host"]].append({"net/es/": "block", "net/fr/": "block", "example.com/en/": "block", None: None}.get(r["rule"], "allow"))
    assert any(r["rule"] is None and r["verdict"] == "block" for r in found) and any(r["rule"] is None and r["verdict"] == "allow" for r in found)
    edges = {}
    for h in hosts:
        names = h.split(".")
        while len(names) > 2:
            edges[".".join(names), ".".join(names[1:])] = edges[".".join(names[1:]), ".".join(names)] = 1
            names = names[1:]
    assert edges
    judged = {h: max(1, len(v) - v.count(None)) for h, v in hosts.items()}
    trust, distrust = brute_walks({h: (v.count("allow") / judged[h], v.count("block") / judged[h]) for h, v in hosts.items()}, edges, 60)
    said = {"allow": "allow", "block": "block"}
    for r in found:
        own = "block" if distrust[r["host"]] - trust[r["host"]] > urlgraph.THRESHOLD else "allow"
        assert abs(distrust[r["host"]] - trust[r["host"]] - urlgraph.THRESHOLD) > 0.01
        assert r["verdict"] == (own if r["rule"] is None else said["block" if r["rule"] in ("net/es/", "net/fr/", "example.com/en/") else "allow"])
    edge_rows = urlgraph.host_edges(pages, urlgraph.host_and_path(F.col("url"))[0]).collect()
    assert {(r["src"], r["dst"]): r["n"] for r in edge_rows} == edges


def test_pipeline(spark):
    import corpus_pipeline
    from lifemart.llm import packing
    from lifemart.llm.queries import BYTE_BPE

    folder = FOLDER
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    scored = quality.classify(docs, quality.train(docs, labels)).where("predicted = 1").collect()
    good = {r["doc_id"] for r in scored}
    rows = sorted((r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] in good)
    top = brute_jaccard(rows)
    cleaned = brute_passages([r for r in rows if top[r[0]][1] == r[0]])
    code = packing.LibraryEncoder(open(BYTE_BPE, encoding="utf-8").read())
    found = defaultdict(int)
    for r in corpus_pipeline.run(spark, folder).collect():
        found[str(r["doc_id"])] += r["length"]
    assert found == {i: len(code.encode(t)) + 1 for i, t in cleaned}


def test_jaccard_ids_that_repeat(spark):
    a, b = "a b c d e f g h", "m n o p q r s t"
    rows = [(1, a), (2, b), (5, a), (5, b), (6, a), (7, b), (7, ""), (7, "zz"), (8, ""), (9, "zz")]
    found = sorted((r["doc_id"], r["component_id"]) for r in jaccard.near_duplicates(frame(spark, rows)).collect())
    assert found == sorted((i, 8 if i == 8 else 1) for i, _ in rows)


def test_pipeline_rows_that_repeat(spark):
    import corpus_pipeline

    kept = lambda rows: Counter(tuple(r) for r in corpus_pipeline.one_of_near_duplicates(spark, frame(spark, rows), FOLDER).collect())
    a, b, c = "a b c d e f g h", "m n o p q r s t", "only here is this text kept"
    assert kept([(1, a), (5, a), (5, c), (6, b), (6, b), (7, b)]) == Counter([(1, a), (5, c), (6, b)])
    assert kept([(None, c), (None, c), (None, a), (3, a), (None, ""), (None, None), (4, ""), (4, None), (5, "")])[(3, a)] == 1
    assert sum(kept([(None, c), (None, c), (None, a), (3, a), (None, ""), (None, None), (4, ""), (4, None), (5, "")]).values()) == 5
    rows = [(i, f"{a} {i} {i % 3} x") for i in range(9)] + [(20 + i, f"{i} " * 9) for i in range(9)]
    assert kept(rows * 2) == kept(rows)
    assert kept([(1, a), (1 << 62, a), (1 << 62, c)]) == Counter([(1, a), (1 << 62, c)])
    assert kept([]) == Counter()


def test_pipeline_edges(spark, tmp_path):
    """Null, empty, very long and repeated texts, missing ids and an empty table through all stages."""
    import corpus_pipeline
    from lifemart.llm.common import materialise

    fields = "doc_id long, text string, lang string, source string, n_chars long"
    long = " ".join(f"w{i % 977} and{i % 89}," for i in range(60_000))
    rows = [(1, None), (None, "b"), (2, "x y z"), (2, "x y z"), (2, "other words of this id stay here"), (3, ""), (7, long), (8, long), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", None, None) for i, t in rows], fields)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")  # nothing to learn: all stay
    for table, kept in ((docs, 7), (docs.limit(0), 0)):
        for name, stage in corpus_pipeline.STAGES:
            assert name == "quality" or table.columns == docs.columns
            table = materialise(stage(spark, table, str(tmp_path)), name)
            if name == "near_duplicates":
                assert table.count() == kept and table.where("doc_id = 8").isEmpty()
        assert (table.select("doc_id", "piece").count() >= kept) and table.where("offset < 0 or length < 1").isEmpty()
