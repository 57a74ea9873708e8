"""Alignment against whole-text tokens and plain loops over their bytes."""

import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from roadstream.llm import alignment
from tests.llm.conftest import ODD, words

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ORDER = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]


@pytest.fixture(scope="session")
def libraries():
    a = tokenizers.Tokenizer.from_file(A)
    a.encode_special_tokens = True
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in plain} | {chr(256 + n): x for n, x in enumerate(x for x in range(256) if x not in plain)}
    return a, letters, sentencepiece.SentencePieceProcessor(model_file=B)


def tokens(text, libraries):
    a, letters, b = libraries
    found = a.encode(" " + text, add_special_tokens=False)
    left = [(i, bytes(letters[x] for x in token)) for i, token in zip(found.ids, found.tokens)]
    right = [(i, bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()) for i in b.encode(text)]
    return left, right


def places(side):
    out, at = [], 0
    for number, body in side:
        out.append((at, at + len(body), number))
        at += len(body)
    return out


def expected(rows, libraries):
    found, held = [], Counter()
    for key, text in rows:
        body = (" " + (text or "")).encode()
        left, right = tokens(text, libraries) if text else ([], [])
        if not text or any(b"".join(x for _, x in side) != body for side in (left, right)):
            found.append((key, 0, 0, 0, "", []))
            continue
        x, y = places(left), places(right)
        links = [(i, j) for a, b, i in x for c, d, j in y if a < d and c < b]
        cuts = sorted({e for _, e, _ in x} & {e for _, e, _ in y})
        groups = [[",".join(str(i) for _, e, i in side if low < e <= high) for side in (x, y)] for low, high in zip([0, *cuts], cuts)]
        digest = hashlib.sha256(";".join("|".join(g) for g in groups).encode()).hexdigest()
        found.append((key, len(x), len(y), len(cuts), digest, links))
        held.update(set(links))
    most = Counter()
    for (i, _), n in held.items():
        most[i] = max(most[i], n)
    return sorted(map(repr, [(key, a, b, n, len(links), digest, sum(held[x] == most[x[0]] for x in links), sum(held[x] for x in links))
                             for key, a, b, n, digest, links in found]))


ROWS = [*ODD, (20, " lead"), (21, "trail "), (22, "two  blanks   three"), (23, "a\n b \n\nc\t d"), (24, "  "), (25, "x▁y"), (26, "▁"),
        (27, "€uro 𐍈 𐍈𐍈 ẞ ߷ ꙮ 한국어 ไทย"), (28, "it's we'll 'tis 1234567 x1y2 <s></s><unk><0x41>"), (29, "a  b\0c �"),
        (30, "中文 没有 空格的很长的一段文字，标点。"), (31, " non break em "), (32, "🙂🙂 👩‍👩‍👧 x"), (20, " lead"), (33, "\n"), (34, "é́ x"),
        (35, "w" * 500 + " " + "é" * 200)]


def test_every_text(docs, libraries):
    rows = ROWS + [(100 + k, " ".join(words(k % 40, 30))) for k in range(60)]
    # The long text of few letters is left out: plain loops over all pairs take too long.
    rows = [(k, x if x is None or len(x) < 20000 else x[:6000]) for k, x in rows]
    want = expected(rows, libraries)
    for held in (alignment.HELD_PAIRS, 0):
        got = alignment.align(docs(rows), A, B, held=held).select(ORDER).collect()
        assert sorted(repr(tuple(r)) for r in got) == want


def test_empty_table(docs):
    assert alignment.align(docs([]), A, B).collect() == []


def test_given_texts(documents, libraries):
    some = documents.filter(F.length("text") < 1500).orderBy("doc_id").limit(80)
    want = expected([(r.doc_id, r.text) for r in some.collect()], libraries)
    assert sorted(repr(tuple(r)) for r in alignment.align(some, A, B).select(ORDER).collect()) == want


def test_words_forget_old_ones(monkeypatch, libraries):
    for name in ("KEPT_WORDS", "KEPT_PARTS"):
        monkeypatch.setattr(alignment, name, 3)
    with open(A, "rb") as a, open(B, "rb") as b:
        aligner = alignment.Aligner(alignment.ByteTokens(a.read()), alignment.PieceTokens(b.read()))
    for k in range(6):
        assert {f"w{k}", "same"} <= aligner.words({f"w{k}", "same"}).keys()
    assert all(len(x) + len(x.old) < 12 for x in (aligner.words_kept, aligner.parts_kept))
