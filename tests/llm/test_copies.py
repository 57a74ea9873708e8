"""Exact, near and substring deduplication against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadstream.llm import chunks, exact, neardup
from roadstream.llm.graph import components
from tests.llm.conftest import ODD, words


def equal_groups(rows):
    def normal(t):
        return re.sub("[\x20\x09-\x0d]", "", t or "")

    out = []
    for k, t in rows:
        same = [(-len(u or ""), i is not None, i, u) for i, u in rows if normal(u) == normal(t)]
        best = min(same, key=lambda x: (x[0], x[1], x[2] or 0))
        out.append((k, best[2], len(same)))
    return sorted(out, key=repr)


COPIES = ODD + [(20, "a b"), (21, "ab "), (22, "ab"), (23, "a b"), (24, "A b"), (19, "a\tb")] + [(100 + k, "hot copy") for k in range(60)]


@pytest.mark.parametrize("short", [False, True])
def test_exact(docs, short):
    """short: digests of one hexadecimal digit, so that different texts meet and bytes have to decide."""
    digest = (lambda text: F.substring(F.sha2(text, 256), 1, 1)) if short else exact.digest_of
    _, found = exact.groups(docs(COPIES, 7), digest=digest, batch_bytes=2000)
    found = found.collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size) for r in found), key=repr) == equal_groups(COPIES)
    assert sum(r.kept for r in found) == len({(r.digest, r.keep_row) for r in found})
    assert all(r.keep_id == r.doc_id for r in found if r.kept)


def test_exact_keep_first(docs):
    table = docs(COPIES)
    kept = exact.keep_first(table)
    assert kept.columns == table.columns and kept.schema == table.schema
    want = {(k, n) for _, k, n in equal_groups(COPIES)}
    assert kept.count() == len(want)


def test_exact_empty_table(docs):
    _, found = exact.groups(docs([]))
    assert found.collect() == []


def near_rows():
    pick, rows = random.Random(11), []
    for k in range(40):
        rows.append((10 * k, " ".join(words(k, 120))))
    for k in range(12):  # near copies with one to sixty words changed
        for n, changes in enumerate((1, 2, 3, 4, 12, 60)):
            body = words(k, 120)
            for at in pick.sample(range(120), changes):
                body[at] = f"new{k}{n}{at}"
            rows.append((1000 + 10 * k + n, " ".join(body).upper() if n % 2 else " ".join(body)))
    for n in range(80):  # a large group around one text
        body = words("hot", 150)
        for at in pick.sample(range(150), n % 3):
            body[at] = f"hot{n}{at}"
        rows.append((3000 + n, ", ".join(body)))
    return rows + [(5000, "short one"), (5001, "Short ONE!"), (5002, "short two"), *ODD]


def brute_classes(rows):
    texts = [t or "" for _, t in rows]
    doc, shingle, _ = neardup._per_text(*neardup.Words(texts).shingles())
    heavy, df = np.unique(shingle, return_counts=True)
    floor = max(2.0, len(shingle) / neardup.HEAVY)
    weights = neardup.Weights(heavy[df >= floor], df[df >= floor].astype(float), len(shingle))
    vectors = neardup.weighted(texts, weights)
    top = list(range(len(rows)))
    for i, left in enumerate(vectors):
        for j in range(i):
            if len(left[0]) and len(vectors[j][0]) and neardup.similarity(left, vectors[j]) >= neardup.SIMILAR:
                top = [top[i] if x == top[j] else x for x in top]
    least = {}
    for place, (k, _) in enumerate(rows):
        least[top[place]] = min(least.get(top[place], k), k)
    return sorted((k, least[top[place]]) for place, (k, _) in enumerate(rows))


def test_near(docs):
    rows = [(k, t) for k, t in near_rows() if k is not None]
    got = sorted(tuple(r) for r in neardup.classes(docs(rows)).collect())
    assert got == brute_classes(rows)
    assert len({c for _, c in got}) < len({k for k, _ in got})


def test_near_keep_one(docs):
    rows = [(k, t) for k, t in near_rows() if k is not None]
    table = docs(rows)
    kept = neardup.keep_one(table)
    assert kept.columns == table.columns
    assert {r.doc_id for r in kept.collect()} == {c for _, c in brute_classes(rows)}


def test_near_with_repeated_keys(docs):
    """Two texts of one key are two rows: one is in a class, the other alone."""
    a, b = " ".join(words("one", 80)), words("two", 80)
    rows = [(10, a), (10, " ".join(b)), (5, " ".join([*b[:-1], "other"])), (None, " ".join(b)), (7, None), (7, "")]
    got = [tuple(r) for r in neardup.classes(docs(rows)).collect()]
    assert sorted(got, key=repr) == sorted([(5, 5), (None, 5), (7, 7), (7, 7), (10, 5), (10, 10)], key=repr)
    kept = neardup.keep_one(docs(rows)).collect()
    assert sorted((r.doc_id, r.text or "") for r in kept) == sorted([(10, a), rows[2], (7, ""), (7, "")])
    assert {r.text for r in kept if r.doc_id == 7} == {None, ""}


def test_fresh_bands_find_pairs(docs):
    """Of samples that agree as often as texts of similarity 0.8, nearly all pairs share a band; far ones seldom do."""
    pick = np.random.default_rng(9)
    for share, low, high in ((0.8, 0.97, 1), (0.5, 0, 0.35)):
        left = pick.integers(0, 1 << 16, (300, neardup.SAMPLES), dtype=np.uint16)
        right = np.where(pick.random(left.shape) < share, left, pick.integers(0, 1 << 16, left.shape, dtype=np.uint16))
        rows = [(n, m, x.tobytes()) for m, side in enumerate((left, right)) for n, x in enumerate(side)]
        table = docs([]).sparkSession.createDataFrame([(int(n), m, bytearray(x)) for n, m, x in rows], "doc long, side int, sketch binary")
        dealt = neardup.fresh_bands(table.select("doc", "side", "sketch"))
        met = dealt.groupBy("bucket", "doc").agg(F.count_distinct("side").alias("sides")).filter("sides = 2").select("doc").distinct().count()
        assert low <= met / 300 <= high


def test_near_pairs_in_wide_buckets(docs):
    """A family around one passage, all just below the bound but for pairs that no leader is near."""
    passage, rows = words("passage", 200), []
    for k in range(140):
        own = words(f"own {k}", 22)
        if k % 4 == 1:
            own[:3] = words(f"own {k - 1}", 22)[:3]
        rows.append((k, " ".join(passage + own)))
    want = brute_classes(rows)
    assert len({c for _, c in want}) == 105
    assert sorted(tuple(r) for r in neardup.classes(docs(rows)).collect()) == want


def test_near_without_words(docs):
    got = sorted((tuple(r) for r in neardup.classes(docs([(1, None), (2, ""), (3, "?!"), (None, "a"), (4, "a")])).collect()), key=repr)
    assert got in ([(1, 1), (2, 2), (3, 3), (4, 4), (None, 4)], [(1, 1), (2, 2), (3, 3), (4, None), (None, None)])
    assert neardup.classes(docs([])).collect() == []


def test_samples_agree_as_often_as_texts_are_similar():
    pick = np.random.default_rng(5)
    shared, left, right = (pick.integers(1, 1 << 63, n, dtype=np.uint64) for n in (400, 60, 140))
    weight = {int(x): w for x, w in zip(np.concatenate([shared, left, right]), pick.choice([1.0, 2.0, neardup.TOP, 6.0], 600))}
    sides = [np.sort(np.concatenate([shared, x])) for x in (left, right)]
    vectors = [(x, np.array([weight[int(y)] for y in x])) for x in sides]
    doc = np.repeat([0, 1], [len(x) for x in sides])
    hashes = neardup.samples(doc, np.concatenate(sides), np.concatenate([v[1] for v in vectors]), bands=3000, rows=1)
    assert abs((hashes[0] == hashes[1]).mean() - neardup.similarity(*vectors)) < 0.03


def test_components(spark):
    pick = random.Random(2)
    edges = [(pick.randint(0, 400), pick.randint(0, 400)) for _ in range(220)] + [(500, k) for k in range(501, 560)] + [
        (k, k + 1) for k in range(600, 640)]
    top = {x: x for e in edges for x in e}
    for _ in range(len(top)):
        for a, b in edges:
            top[a] = top[b] = min(top[a], top[b])
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: r for x, r in top.items() if any(a != b and x in (a, b) for a, b in edges)}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_chunks_resist_insertions():
    body = " ".join(words(1, 3000))

    def pieces(text):
        codes, number, start, end = chunks.cuts(["other", text])
        return ["".join(map(chr, codes[a:b])) for a, b, n in zip(start, end, number) if n == 1]

    whole, moved = pieces(body), pieces("inserted here, " + body)
    assert "".join(whole) == body
    assert all(len(x) <= chunks.MOST for x in whole) and all(len(x) >= chunks.LEAST for x in whole[:-1])
    assert len(set(whole) - set(moved)) <= 6
    assert 30 < len(body) / len(whole) < 70
    assert chunks.cuts(["", ""])[1].size == 0


def shared_rows():
    passage = " ".join(words("passage", 60))
    rows = [(k, " ".join(words(k, 200 + k))) for k in range(30, 60)]
    rows += [(100 + k, " ".join(words(100 + k, 40 + k)) + " " + passage + " " + " ".join(words(200 + k, 50))) for k in range(12)]
    line = "all rights reserved by the owner of this page."
    rows += [(300 + k, " ".join(words(300 + k, 40)) + "\n" + line) for k in range(20)]
    return rows + [(400, "again " * 500), *ODD[:3], *ODD[6:]], passage


def test_shared_spans(docs):
    rows, passage = shared_rows()
    texts = dict(rows)
    found = chunks.shared_spans(docs(rows)).collect()
    assert {r.doc_id for r in found} == {100 + k for k in range(12)}
    for r in found:
        covered = texts[r.doc_id][r.start:r.end]
        assert covered.strip() in f" {passage} " and r.first_doc_id == 100 and r.kept == (r.doc_id == 100)
        assert len(covered) > len(passage) - 2 * chunks.MOST
    assert chunks.shared_spans(docs([])).collect() == []


def test_passages_of_51_words(docs):
    """Each of many passages is found, wherever its ends fall, although only two documents share it."""
    rows = []
    for k in range(600):
        passage = words(f"passage {k}", 51)
        rows += [(2 * k + n, " ".join(words(f"before {k} {n}", 30) + passage + words(f"after {k} {n}", 30))) for n in (0, 1)]
    found = chunks.shared_spans(docs(rows), span=0).collect()
    assert {r.doc_id for r in found} == set(range(1200))
    texts = dict(rows)
    assert all(texts[r.doc_id][r.start:r.end] in texts[r.doc_id ^ 1] for r in found if r.n_chunks == 1 and r.end - r.start > 15)


def test_remove_shared(docs):
    rows, passage = shared_rows()
    table = docs(rows)
    left = chunks.remove_shared(table)
    assert left.columns == table.columns
    texts = {r.doc_id: r.text for r in left.collect()}
    assert left.count() == len(rows) and passage in texts[100]
    assert all(passage not in texts[100 + k] and len(texts[100 + k]) < len(dict(rows)[100 + k]) for k in range(1, 12))
    assert texts[1] is None and texts[2] == "" and texts[310] == dict(rows)[310]


def test_a_cloud_below_the_bound_makes_no_rows_of_pairs(spark, monkeypatch):
    """All pairs of a cluster are compared, in several tiles, and only links that join parts become rows."""
    monkeypatch.setattr(neardup, "TILE_ROWS", 16)
    pick, base, rows = random.Random(5), words("cloud", 120), []
    for k in range(90):
        body = list(rows[-1][1].split() if k % 9 == 8 else base)
        for at in pick.sample(range(120), 2 if k % 9 == 8 else 5):
            body[at] = f"cloud{k}{at}"
        rows.append((k, " ".join(body)))
    weights = neardup.Weights(np.empty(0, np.uint64), np.empty(0), 0)
    vectors = neardup.weighted([t for _, t in rows], weights)
    near = {(i, j) for j in range(90) for i in range(j) if neardup.similarity(vectors[i], vectors[j]) >= neardup.SIMILAR}
    assert {(min(p), max(p)) for p in neardup.near_places(vectors, vectors) if p[0] != p[1]} == near
    texts = spark.createDataFrame(rows, "doc long, text string")
    members = texts.select("doc", F.col("doc").alias("part"))
    buckets = members.select(F.lit(7).alias("bucket"), "doc")
    clustered = neardup.clusters(members, buckets)
    assert {r.cluster for r in clustered.collect()} == {0}
    links = [tuple(r) for r in neardup.close_links(clustered, texts, weights).collect()]
    assert set(links) <= near and 0 < len(links) < 90

    def parts(pairs):
        top = list(range(90))
        for a, b in pairs:
            top = [top[a] if x == top[b] else x for x in top]
        return {frozenset(x for x in range(90) if top[x] == y) for y in top}

    assert parts(links) == parts(near)
    assert neardup.close_links(clustered.withColumn("part", F.lit(1).cast("long")), texts, weights).collect() == []


def _rows_of_joins(plan):
    """Rows that the joins of an executed plan have made."""
    own = plan.metrics().get("numOutputRows").get().value() if "Join" in plan.nodeName() else 0
    inner = {"AdaptiveSparkPlan": lambda: [plan.executedPlan()], "ShuffleQueryStage": lambda: [plan.plan()],
             "BroadcastQueryStage": lambda: [plan.plan()]}.get(plan.nodeName())
    children = inner() if inner else [plan.children().apply(k) for k in range(plan.children().size())]
    return own + sum(map(_rows_of_joins, children))


def test_pairs_of_small_buckets_are_no_rows_of_a_join(spark, docs, monkeypatch):
    """Members of many buckets, of which a few pairs agree, also where a bucket goes on in the next batch or chunk."""
    docs([])
    monkeypatch.setattr(neardup, "CHUNK_ROWS", 50, raising=False)
    pick = np.random.default_rng(4)
    sketch = pick.integers(0, 1 << 16, (300, neardup.SAMPLES), dtype=np.uint16)
    for k in range(0, 300, 7):
        sketch[k, :neardup.AGREE - k % 2] = sketch[(k + 3) % 300, :neardup.AGREE - k % 2]
    buckets = {b: sorted(pick.choice(300, 1 + b % neardup.SMALL, replace=False).tolist()) for b in range(-30, 30)}
    buckets |= {100 + k: [k, (k + 3) % 300] for k in range(0, 300, 7)}
    part = {k: k - k % 2 for k in range(300)}
    rows = [(b, k, 1.0, bytearray(sketch[k].tobytes()), part[k], len(held)) for b, held in buckets.items() for k in held]
    live = spark.createDataFrame(rows, "bucket long, doc long, score double, sketch binary, part long, n long")
    live = live.withColumn("best", F.struct(*neardup._MEMBER))
    found = neardup._crossing(live)
    got = {(min(r.leader, r.doc), max(r.leader, r.doc)) for r in found.collect()}
    agree = {(i, j) for held in buckets.values() for i in held for j in held
             if i < j and part[i] != part[j] and (sketch[i] == sketch[j]).sum() >= neardup.AGREE}
    assert agree and got == agree
    assert _rows_of_joins(found._jdf.queryExecution().executedPlan()) <= len(rows)
