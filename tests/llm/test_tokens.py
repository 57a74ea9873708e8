"""Byte-level BPE, packing and token files against the libraries."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
import tiktoken
from tokenizers import Tokenizer

from roadstream.llm import bpe, packing, token_files
from roadstream.llm.vocabulary import WordTokens
from roadstream.shared import freeze, new_path
from tests.llm.conftest import ODD, words

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(WORDS)


def mixed(seed, n):
    """Text with runs of every kind of character around chunk edges."""
    pick = random.Random(seed)
    kinds = [" ", "  ", "\n\n", "\t \n", "a", "word", "'re", "'s", "42", "中文", "!?", "é", "…", "'", "x" * 70, "9" * 50, " " * 40]
    return "".join(pick.choice(kinds) for _ in range(n))


CHUNKED = [(10, mixed(1, 900)), (11, mixed(2, 900)), (11, mixed(2, 900)), (12, "y" * 5000), (13, " " * 4000 + "z"), (14, "'re" * 900)]


@pytest.mark.parametrize("chunk, overlap", [(1 << 15, 512), (200, 32), (64, 48), (50, 2)])
def test_byte_bpe(docs, library, chunk, overlap):
    rows = ODD[:8] + ODD[9:] + CHUNKED
    encoded = bpe.encode(docs(rows), RANKS, PATTERN, chunk=chunk, overlap=overlap)
    found = bpe.decode(encoded, RANKS).collect()
    want = [(k, np.array(library.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for k, t in rows]
    assert sorted(((r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in found), key=repr) == sorted(want, key=repr)


def test_byte_bpe_empty_table(docs):
    assert bpe.decode(bpe.encode(docs([]), RANKS, PATTERN), RANKS).collect() == []


def test_word_tokens(documents, tokenizer):
    texts = [t or "" for _, t in ODD] + [r.text for r in documents.select("text").collect()] + [
        "Σας ΟΔΟΣ İ", "A'S I'LLx 'tis ÀÉ'Tß..,, 1,000.5", "a\xa0b \x85q", "x<|endoftext|>y <| |>", mixed(3, 500)]
    with open(WORDS, "rb") as file:
        mine = WordTokens(file.read())
    want = [x.ids for x in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, "<u4").tolist() for x in mine.encode(texts)] == want


def packed(items, **more):
    rows = packing.pack(items, **more).collect()
    fills = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == fills.get(r.sequence_id, 0)
        fills[r.sequence_id] = r.offset + r.length
    return rows, fills


def test_packing(docs, tokenizer):
    items = freeze(packing.pieces(docs(ODD), WORDS, capacity=512), "pieces")
    rows, fills = packed(items, capacity=512)
    want = []
    for k, t in ODD:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [0]
        for start in range(0, len(ids), 512):
            body = np.array(ids[start:start + 512], "<u4")
            want.append((k, start // 512, start, len(body), zlib.crc32(body.tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=repr) == sorted(want, key=repr)
    assert max(fills.values()) <= 512


@pytest.mark.parametrize("block", [10_000, 200, 100])
def test_packing_rounds(spark, block):
    pick = random.Random(5)
    lengths = [pick.randint(1, 2048) if pick.random() < 0.6 else pick.randint(1, 200) for _ in range(3000)]
    items = freeze(spark.createDataFrame([(k, x, "s") for k, x in enumerate(lengths)], "name long, length long, fill string"), "items")
    rows, fills = packed(items, block=block)
    assert sorted(r.name for r in rows) == list(range(3000))
    assert len(fills) <= 1.03 * -(-sum(lengths) // 2048) + 3000 / block


def test_packing_of_blocks_that_fit_only_one_another(spark):
    """Half of the blocks hold long pieces alone, half of them short ones: nothing is done before blocks meet."""
    items = freeze(spark.range(0, 6000, 1, 2).select(F.col("id").alias("name"), F.when(F.col("id") < 3000, 1500).otherwise(540).cast("long").alias("length")), "items")
    rows, fills = packed(items, block=500)
    assert len(rows) == 6000 and len(fills) <= 1.01 * 3000


def test_packing_empty_table(docs):
    assert packing.pack(freeze(packing.pieces(docs([]), WORDS), "pieces")).collect() == []


def test_best_fit():
    sequence, offset, fills = packing.best_fit([5, 4, 6, 5, 10], 10)
    assert sorted(fills) == [10, 10, 10]
    assert packing.best_fit([], 10) == ([], [], [])


def test_token_files(spark, docs, tokenizer):
    rows = [(k, t) for k, t in ODD if k is not None]
    found = token_files.round_trip(docs(rows), WORDS).collect()
    start, want = 0, []
    for k, t in sorted(rows, key=lambda x: (x[0], len(x[1] or ""))):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        want.append((k, start, len(ids), np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert sorted((r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in found) == sorted(want)


def test_token_files_many_blocks(spark, monkeypatch):
    pick = random.Random(3)
    rows = [(k, np.array([int(pick.paretovariate(0.4)) % 5000 for _ in range(pick.randint(0, 900))], "<u4")) for k in range(400)]
    tokens = freeze(spark.createDataFrame([(k, bytearray(x.tobytes())) for k, x in rows], "doc_id long, ids binary").repartition(5), "ids")
    path = new_path(spark, "files")
    token_files.write(tokens, path, limit=13, tasks=3)
    assert spark.read.parquet(f"{path}/codebook").agg({"bits": "max"}).first()[0] <= 13
    start = 0
    found = {r.doc_id: r for r in token_files.read(spark, path).collect()}
    for k, ids in rows:
        assert (found[k].start, found[k].n_tokens, bytes(found[k].ids)) == (start, len(ids), ids.tobytes())
        start += len(ids)


def test_token_files_empty_table(docs):
    assert token_files.round_trip(docs([]), WORDS).collect() == []


def test_short_texts_are_counted_together(monkeypatch):
    documents, calls, counted = [np.array([k, 40_000], "<u4").tobytes() for k in range(300)], [], np.bincount
    monkeypatch.setattr(np, "bincount", lambda x: calls.append(len(x)) or counted(x))
    for step in (1 << 20, 100):
        total = token_files.add_counts(np.ones(7, np.int64), [*documents, b""], step)
        assert (total[0], total[299], total[40_000], total.sum()) == (2, 1, 300, 607)
    assert calls == [600] + [100] * 6


@pytest.mark.parametrize("counts, limit, want", [([1, 1, 2, 4], 3, [3, 3, 2, 1]), ([1, 1, 2, 4], 2, [2, 2, 2, 2]), ([7], 4, [1]), ([], 4, [])])
def test_code_lengths(counts, limit, want):
    assert token_files.code_lengths(np.array(counts, np.int64), limit).tolist() == want


def test_code_is_decoded_from_any_checkpoint():
    ids = np.array([3, 1, 1, 2, 9, 1] * 200, np.uint32)
    names, counts = np.unique(ids, return_counts=True)
    code = token_files.Code(names.astype(np.int64), token_files.code_lengths(counts, 8))
    (body, none), (marks, no_marks) = code.encode([ids, ids[:0]])
    assert (none, len(no_marks)) == (b"", 0)
    lane = np.minimum(len(ids) - np.arange(len(marks)) * token_files.STEP, token_files.STEP)
    assert code.decode(body, marks, lane).tolist() == ids.tolist()
    assert code.decode(body, marks[2:3], lane[2:3]).tolist() == ids[512:768].tolist()


def test_digests(spark, documents):
    from roadstream.llm import catalog
    from tests.llm.conftest import FOLDER

    one = {r.doc_id: r for r in catalog.QUERIES["op1_byte_bpe"](spark, FOLDER).collect()}
    five = {r.doc_id: r for r in catalog.QUERIES["op5_token_files"](spark, FOLDER).collect()}
    for r in documents.collect():
        assert one[r.doc_id].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()
    assert len(one) == len(five) == documents.count()
    assert words(1, 3) == words(1, 3)
