"""Personal data, quality, toxicity and the pipeline."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadstream.llm import boosting, catalog, pii, quality, toxicity
from tests.llm.conftest import FOLDER, ODD, PROSE, words

PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
            ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def plain_spans(text):
    """The kinds as their patterns say, without any short cut."""
    def valid(kind, body):
        digits = re.sub("[^0-9]", "", body)
        if kind == "ip":
            return all(int(x) <= 255 for x in body.split("."))
        if kind == "card":
            twice = [int(x) * (1 + k % 2) for k, x in enumerate(reversed(digits))]
            return 14 <= len(digits) <= 19 and sum(x - 9 * (x > 9) for x in twice) % 10 == 0
        return kind == "email" or 10 <= len(digits) <= 15

    return sorted((m.start(), n, m.end()) for n, (kind, pattern) in enumerate(PATTERNS)
                  for m in re.finditer(pattern, text) if valid(kind, m[0]))


def test_base_spans():
    pick = random.Random(8)
    pieces = ["a@b.c", "@", "x.y+z@mail.example.org", ".", "1.2.3.4", "256.1.1.1", "001.02.3.4", "4111 1111 1111 1111", "+1 (555) 010-9999",
              "+", "12", "-", " ", "a@b", "a@b@c.d", "4111-1111-1111-1112", "7", "é", "1.2.3.4.5.6.7.8.9", "\n", "+44 20 7946 0958", "_%", "۳"]
    for _ in range(3000):
        text = "".join(pick.choices(pieces, k=pick.randint(0, 14)))
        assert pii.base_spans(text) == plain_spans(text), text
    assert pii.base_spans("1" * 200_000 + "a" * 200_000 + "@") == []


def leaking(n=60):
    """Rows in which one rare word stands by one address only, and common words by all."""
    rows = []
    for k in range(n):
        body = words(k, 30)
        if k % 10 == 0:
            body[10:10] = ["zebrafish", "mail", "boss@corp.example.com", "today"]
        elif k % 3 == 0:
            body[10:10] = ["mail", f"user{k}@corp.example.com", "today"]
        rows.append((k, " ".join(body)))
    return rows + ODD


def test_spans(docs):
    rows = leaking()
    got = pii.spans(docs(rows)).select("doc_id", pii.written(F.col("base")).alias("base"), pii.written(F.col("spans")).alias("spans"))
    found = sorted(map(tuple, got.collect()), key=repr)
    assert sorted(((k, b) for k, b, _ in found), key=repr) == sorted(
        ((k, ",".join(f"{pii.KINDS[n]}:{a}:{b}" for a, n, b in plain_spans(t or ""))) for k, t in rows), key=repr)
    texts = dict(rows)
    for k, base, spans in found:
        added = set(spans.split(",")) - set(base.split(",")) - {""}
        assert {texts[k][int(a):int(b)] for _, a, b in (x.split(":") for x in added)} == (
            {"zebrafish"} if k is not None and k < 60 and k % 10 == 0 else set())
    assert pii.spans(docs([])).collect() == []


def test_terms_far_from_their_entity(docs):
    """A term that discloses an entity goes wherever it stands, and need not stand near it."""
    rows = [(k, f"zebrafish {t} {PROSE} zebrafish" if k % 10 == 0 else f"{t} {PROSE}") for k, t in leaking()[:60]]
    rows.append((60, f"the zebrafish alone {PROSE}"))
    rows += [(61 + k, f"{' '.join(words(70 + k, 20))} far@corp.example.com {' '.join(words(80 + k, 20))} axolotl") for k in range(4)]
    clean = {r.doc_id: r.text for r in pii.sanitise(docs(rows)).collect()}
    assert len(clean) == 65 and not any(re.search("zebrafish|axolotl|boss@|far@", t) for t in clean.values())
    assert clean[1] == dict(rows)[1] and clean[60] == f"the <TERM> alone {PROSE}"


def test_sanitise(docs):
    rows = [*leaking(), (70, "call +1 555 010 9999 or a@b.cd"), (70, "call +1 555 010 9999 or a@b.cd")]
    table = docs(rows)
    clean = pii.sanitise(table)
    assert clean.columns == table.columns and clean.count() == len(rows)
    texts = {}
    for r in clean.collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    assert texts[70] == ["call <PHONE> or <EMAIL>"] * 2 and texts[1].count(None) == 1 and texts[2].count("") == 1
    assert not any(re.search("boss@|zebrafish", t or "") for x in texts.values() for t in x)
    assert texts[11] == [dict(rows)[11]]


def test_trees_and_arrays():
    pick = np.random.default_rng(1)
    rows = pick.normal(size=(3000, 6))
    labels = ((rows[:, 0] > 0) ^ (rows[:, 3] > 0.5)).astype(float)
    model = boosting.fit(rows[:2000], labels[:2000])
    assert ((model.score(rows[2000:]) > 0.5) == labels[2000:]).mean() > 0.95

    def walk(row):
        total = model.base
        for node in model.roots:
            while model.left[node] != node:
                node = model.left[node] if row[model.feature[node]] <= model.threshold[node] else model.right[node]
            total += model.value[node]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(model.score(rows[:50]), [walk(x) for x in rows[:50]])
    assert boosting.fit(np.empty((0, 3)), np.empty(0)).score(np.zeros((1, 3))) == pytest.approx(0.5)
    assert 0 < boosting.fit(rows, np.ones(3000)).score(rows[:1])[0] < 1


def test_statistics():
    table = quality.statistics([t or "" for _, t in ODD])
    assert np.isfinite(table).all()
    assert np.allclose(table[3], quality.statistics([PROSE])[0])  # no text depends on its neighbours
    assert quality.statistics([]).shape[0] == 0


def training(docs, spark, n=240):
    rows = [(k, " ".join(words(k, 40)) if k % 3 else " | ".join(["SPAM!!"] * 40)) for k in range(n)]
    labels = spark.createDataFrame([(k, int(k % 3 > 0), 0, "x") for k in range(n)] + [(5, None, None, "x"), (None, 1, 1, "x"), (9999, 1, 1, "x")],
                                   "doc_id long, quality int, toxic int, text string")
    return docs(rows + ODD), labels


def test_quality(docs, spark):
    table, labels = training(docs, spark)
    model = quality.learn(table, labels)
    rows = quality.scores(table, model).collect()
    assert len(rows) == table.count() and all(0 <= r.score <= 1 for r in rows)
    assert all((r.score >= 0.3) == bool(r.doc_id % 3) for r in rows if r.doc_id is not None and 10 <= r.doc_id < 240)
    kept = quality.accept(table, model)
    assert kept.schema == table.schema
    assert kept.count() == sum(r.score >= quality.ACCEPT for r in rows)
    assert quality.scores(docs([]), model).collect() == []


def test_labels_of_held_out_rows_are_not_learned(docs, spark):
    table, labels = training(docs, spark)
    lying = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    first, second = (quality.learn(table, x) for x in (labels, lying))
    assert (first.value == second.value).all()
    none = quality.learn(table, labels.limit(0))
    assert set(r.score for r in quality.scores(table, none).collect()) == {0.5}


def test_held_out(spark):
    got = {r.id: r.out for r in spark.range(200).select("id", quality.held_out(F.col("id")).alias("out")).collect()}
    assert got == {k: zlib.crc32(str(k).encode()) % 5 == 0 for k in range(200)}


@pytest.mark.parametrize("text, pattern, scope", [
    ("You idiot", "directed", "plain"), ("What an idiot", "insult", "plain"), ("An idiot and a moron", "further", "plain"),
    ("idiot, you", "turned", "plain"), ("I will kill you", "intended", "plain"), ("kill them", "threat", "plain"),
    ("not an idiot", "insult", "negated"), ("he said the idiot", "directed", "reported"), ("kill. You", None, None), ("a nice day", None, None)])
def test_grammar(text, pattern, scope):
    scope = {"negated": toxicity.DENIED, "reported": toxicity.QUOTED}.get(scope, scope)
    count, *_ = toxicity.matches(["before it", text, ""], np.empty(0, np.uint64))
    found = {toxicity._EVENTS[k] for k in np.flatnonzero(count[1])}
    assert ((pattern, scope) in found) if pattern else not found
    assert not count[0].any() and not count[2].any()


def test_toxicity(docs, spark):
    pick, rows, labels = random.Random(3), [], []
    for k in range(400):
        body = words(k, 60)
        bad = k % 8 == 0
        for _ in range(5 if bad else 1 if k % 8 == 1 else 0):
            body.insert(pick.randrange(60), pick.choice(["idiot", "moron"]) if k % 16 < 8 else "grobla" + pick.choice(words(1, 30)))
        rows.append((k, " ".join(body)))
        labels.append((k, 1, int(bad)))
    table = docs(rows + ODD)
    label = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    scored = quality.scores(table, *toxicity.learn(table, label)).collect()
    held = [r for r in scored if r.doc_id is not None and 10 <= r.doc_id < 400 and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert len(scored) == table.count() and all(0 <= r.score <= 1 for r in scored)
    assert np.mean([(r.score >= toxicity.ALERT) == (r.doc_id % 8 == 0) for r in held]) > 0.95
    assert all(r.score < 0.7 for r in held if r.doc_id % 8 > 1)
    none = quality.scores(table, *toxicity.learn(table, label.limit(0)))
    assert set(r.score for r in none.collect()) == {0.5}


def test_stems_of_one_hot_clean_text(docs, spark):
    """A third of the labelled rows is one clean text with the lowest hash."""
    common = ["ordinary", "everyday", "familiar"]
    toxic = [" ".join(words(f"t{k}", 30) + common + ["grobla"] * 2) for k in range(60)]
    clean = [" ".join(words(f"c{k}", 30) + common * 2) for k in range(140)]
    plain = [" ".join(words(f"hot{k}", 30)) for k in range(400)]
    frame = spark.createDataFrame([(x,) for x in clean + plain], "text string").select("text", F.xxhash64("text").alias("h"))
    hashes = {r.text: r.h for r in frame.collect()}
    hot = min(plain, key=hashes.get)
    clean = [x for x in clean if hashes[x] > hashes[hot]]
    rows = [(x, 1) for x in toxic] + [(x, 0) for x in clean + [hot] * 100]
    stems = toxicity.learn_stems(spark.createDataFrame(rows, "text string, label int"), clean=100)
    every = {int(toxicity.Words([x]).stems(n)[0]) & ~1 for x in common for n in toxicity.STEMS}
    assert len(stems) and not every & set(map(int, stems))


@pytest.mark.parametrize("name, label, least", [("op8_quality", "quality", 0.9), ("op9_toxicity", "toxic", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    folder = FOLDER.replace("0.001", "0.01")
    rows = catalog.QUERIES[name](spark, folder).filter("held_out").join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    assert rows.filter(F.col("predicted") == F.col(label)).count() >= least * rows.count() > 0


def test_pii_query(spark, documents):
    rows = {r.doc_id: r for r in catalog.QUERIES["op7_pii"](spark, FOLDER).collect()}
    for r in documents.collect():
        want = plain_spans(r.text)
        body = ",".join(f"{pii.KINDS[n]}:{a}:{b}" for a, n, b in want)
        assert rows[r.doc_id].base_sha256 == hashlib.sha256(body.encode()).hexdigest()
        assert rows[r.doc_id].n_email == sum(n == 0 for _, n, _ in want)


def test_labelled_sample_is_bounded_by_keys(spark, docs):
    """A labelled key that stands in many rows gives one text."""
    table = docs([(1, "b")] * 300 + [(1, "a"), (2, "c"), (3, "d"), (2, None)])
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    found = quality.labelled_sample(table, labels, "quality", F.lit(True), 10)
    assert sorted(tuple(r) for r in found.collect()) == [("", 0), ("a", 1)]
