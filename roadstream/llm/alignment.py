"""Alignment of two tokenizers' tokens over the same bytes, and how often their ids meet.

A text is cut where both tokenizers start a token whatever stands around: before a single blank between two other
characters, and between a Latin letter and a plain mark, digit or line end that no piece of the vocabulary joins with
letters (vocabularies for which that cannot hold are refused).  Parts between the cuts are aligned once per worker and
kept while they recur.  The one library's character offsets and the other's spans are coarse cuts: a token ends there
unless the next one begins inside the same character or it has no span of its own; such tokens of characters split over
tokens and of byte fallback are placed by their decoded bytes.  (In ASCII parts offsets and spans are the tokens' lengths,
which are known, so the libraries are asked for ids alone.)

Byte offsets where tokens of both sides end make the groups.  Between neighbouring ends of either side exactly one token
of A overlaps one of B, which gives the links; both are found for thousands of parts at a time.  Links are counted per
document and id pair; documents that hold a pair are summed with partial sums per task, and the counts go back to the
documents: as sorted arrays while they are few (measured), else by a join.

A is a byte-level BPE over a blank and the text, B a sentencepiece model over the text, to which it adds the blank.  Texts
null, empty or not equal to their tokens' joined bytes on either side have no tokens: zeros and an empty digest.  Every
row gives one row and counts as a document of its own, equal rows and repeated keys too.  An empty table gives no rows.
"""

import hashlib
import json
import os
import re
import struct
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from roadstream.llm.texts import BATCH_CHARS, keyed_texts, split_rows
from roadstream.llm.vocabulary import File
from roadstream.shared import freeze

KEPT_WORDS, KEPT_PARTS = 200_000, 500_000
LONGEST_KEPT = 64
#: Rows of pair counts that tasks may hold as arrays.
HELD_PAIRS = 3_000_000
PARTIAL_CODES = 1 << 21

_HEAD = struct.Struct("qq")
_BLANK = re.compile("(?<=[^ ]) (?=[^ ])")
_STAND_IN = "▁"
_LETTERS = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f"
#: Marks at which parts are cut; an apostrophe can belong to the letters after it.
_MARKS = ".,;:!?|()\"<>/0123456789"
_PART = re.compile(f"(?<=[{_LETTERS}])(?=[{_MARKS}\n])|(?<=[{_MARKS}])(?=[{_LETTERS}])|(?<=[^\\s]\n)(?=[{_LETTERS}])")


class ByteTokens:
    """A: a byte-level tokenizer of the ``tokenizers`` library."""

    def __init__(self, content: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        if json.loads(content)["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("a byte-level vocabulary is needed")
        self.library = Tokenizer.from_buffer(content)
        self.library.encode_special_tokens = True
        alphabet = set(pre_tokenizers.ByteLevel.alphabet())
        others = iter(sorted(x for x in alphabet if ord(x) > 255))
        letters = {chr(byte) if chr(byte) in alphabet else next(others): byte for byte in range(256)}
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            self.bytes[number] = bytes(letters[x] for x in token) if all(x in letters for x in token) else token.encode()

    def ids(self, parts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.library.encode_batch_fast(parts, add_special_tokens=False)]

    def placed(self, parts: list[str]):
        """(ids, lengths in bytes) of the tokens of each part, by character offsets."""
        for part, found in zip(parts, self.library.encode_batch(parts, add_special_tokens=False)):
            place = [0, *accumulate(len(x.encode()) for x in part)]
            starts, ends = zip(*found.offsets)
            cuts = [place[end] if end <= start else None for end, start in zip(ends, [*starts[1:], len(part)])]
            yield found.ids, _refined(cuts, found.ids, self.bytes)


class PieceTokens:
    """B: a sentencepiece model that adds a blank in front."""

    def __init__(self, content: bytes):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_proto=content)
        self.bytes = []
        for number in range(self.library.get_piece_size()):
            piece = self.library.id_to_piece(number)
            byte = self.library.is_byte(number)
            if _STAND_IN in piece.lstrip(_STAND_IN):
                raise ValueError("a piece holds a blank after another character")
            if not byte and not self.library.is_control(number) and not self.library.is_unknown(number):
                if any(x in _MARKS + "\n" for x in piece) and any(map(str.isalpha, piece)):
                    raise ValueError("a piece joins marks and letters")
            self.bytes.append(bytes([int(piece[3:-1], 16)]) if byte else piece.replace(_STAND_IN, " ").encode())

    @staticmethod
    def _given(parts: list[str]) -> list[str]:
        """The model adds a blank: a part that begins with one goes without it, any other one stands behind a line end."""
        return [x[1:] if x[0] == " " else "\n" + x for x in parts]

    def ids(self, parts: list[str]) -> list[list[int]]:
        found = self.library.encode(self._given(parts), out_type=int, num_threads=1)
        return [y if x[0] == " " else y[2:] for x, y in zip(parts, found)]

    def placed(self, parts: list[str]):
        """(ids, lengths in bytes) of the tokens of each part, by the spans of the library's immutable result."""
        for part, proto in zip(parts, self.library.encode(self._given(parts), return_type="proto", num_threads=1)):
            added, skipped = (1, 0) if part[0] == " " else (-1, 2)
            pieces = list(proto.pieces)[skipped:]
            ids = [x.id for x in pieces]
            # An inner byte of a character, and an added blank alone, have no span.
            yield ids, _refined([x.end + added if x.end > x.begin else None for x in pieces], ids, self.bytes)


def _refined(cuts: list[int | None], ids: list[int], tokens: list[bytes]) -> list[int]:
    """Lengths of tokens that end at ``cuts``; those without a cut have the length of their decoded bytes."""
    lengths, at = [], 0
    for cut, number in zip(cuts, ids):
        lengths.append(len(tokens[number]) if cut is None else cut - at)
        at += lengths[-1]
    return lengths


class Aligner:
    """Alignments of words, kept in two generations, and those of the texts made of them.

    An alignment is (tokens of A << 32 | tokens of B, groups as text, codes of links), or None where bytes differ.
    """

    def __init__(self, a: ByteTokens, b: PieceTokens):
        self.sides, self.base = (a, b), len(b.bytes)
        self.code = np.uint64 if len(a.bytes) * len(b.bytes) > 1 << 32 else np.uint32
        self.shown = [b"%d%c" % (x, y) for x in range(max(len(a.bytes), len(b.bytes))) for y in b",|;"]
        self.lengths = [np.fromiter(map(len, x.bytes), np.int64) for x in (a, b)]
        self.words_kept, self.parts_kept = _Kept(KEPT_WORDS), _Kept(KEPT_PARTS)

    def _tokens(self, side: int, parts: list[str]):
        """Ids per part, all lengths in one array, and the parts whose bytes the tokens are not."""
        tokens = self.sides[side]
        plain = [n for n, x in enumerate(parts) if x.isascii()]
        rich = [n for n, x in enumerate(parts) if not x.isascii()]
        ids: list[list[int]] = [[]] * len(parts)
        for n, own in zip(plain, tokens.ids([parts[n] for n in plain])):
            ids[n] = own
        placed = {}
        for n, (own, lengths) in zip(rich, tokens.placed([parts[n] for n in rich])):
            ids[n], placed[n] = own, lengths
        length = self.lengths[side][np.fromiter(chain.from_iterable(ids), np.int64)]
        if rich:
            first = np.cumsum([0, *map(len, ids)]).tolist()
            for n, lengths in placed.items():
                length[first[n]:first[n + 1]] = lengths
        wrong = []
        if b"".join([tokens.bytes[x] for x in chain.from_iterable(ids)]) != "".join(parts).encode():
            wrong = [n for n, (own, part) in enumerate(zip(ids, parts)) if b"".join([tokens.bytes[x] for x in own]) != part.encode()]
        return ids, length, wrong

    def _align(self, parts: list[str]):
        """(part, alignment as one string of bytes) of each part."""
        if not parts:
            return
        (a, length_a, wrong_a), (b, length_b, wrong_b) = (self._tokens(side, parts) for side in (0, 1))
        wrong = {parts[n] for n in (*wrong_a, *wrong_b)}
        if wrong:
            yield from ((x, None) for x in wrong)
            yield from self._align([x for x in parts if x not in wrong])
            return
        count_a, count_b = (np.fromiter(map(len, x), np.int64, len(parts)) for x in (a, b))
        a, b = (np.fromiter(chain.from_iterable(x), self.code) for x in (a, b))
        ends_a, ends_b = np.cumsum(length_a), np.cumsum(length_b)
        mark = np.zeros(ends_a[-1] + 1, np.uint8)
        mark[ends_a] = 1
        mark[ends_b] += 2
        cuts = np.flatnonzero(mark == 3)
        # Tokens of each side up to each cut, and where each token stands: groups in order, those of A first.
        upto_a, upto_b = (np.searchsorted(x, cuts) + 1 for x in (ends_a, ends_b))
        held_a, held_b = (np.diff(x, prepend=0) for x in (upto_a, upto_b))
        after_a, after_b = (np.zeros(len(x), self.code) for x in (a, b))
        after_a[upto_a - 1], after_b[upto_b - 1] = 1, 2
        shown = np.empty(len(a) + len(b), np.int64)
        shown[np.arange(len(a)) + np.repeat(upto_b - held_b, held_a)] = 3 * a + after_a
        shown[np.arange(len(b)) + np.repeat(upto_a, held_b)] = 3 * b + after_b
        table = self.shown
        texts = [table[x] for x in shown.tolist()]
        ends = np.flatnonzero(mark)
        codes = (a[np.searchsorted(ends_a, ends)] * self.code(self.base) + b[np.searchsorted(ends_b, ends)]).tobytes()
        size = np.dtype(self.code).itemsize
        last = np.cumsum(count_a + count_b).tolist()
        links = (np.searchsorted(ends, ends_a[np.cumsum(count_a) - 1]) + 1) * size
        places = zip(parts, (count_a << 32 | count_b).tolist(), [0, *last], last, [0, *links.tolist()], links.tolist())
        for part, n, x, y, low, high in places:
            yield part, _HEAD.pack(n, high - low) + codes[low:high] + b"".join(texts[x:y])[:-1]

    def words(self, words: set[str]) -> dict[str, tuple | None]:
        """Alignments of all ``words``, each with a blank in front."""
        cut = {x: _PART.split(" " + x) for x in self.words_kept.missing(words)}
        absent = self.parts_kept.missing(set().union(*cut.values()))
        known = self.parts_kept
        for at in range(0, len(absent), 8192):
            known.add(self._align(absent[at:at + 8192]))
        self.words_kept.add((word, _together([_opened(known[x]) for x in parts])) for word, parts in cut.items())
        return self.words_kept

    def text(self, text: str, known: dict[str, tuple | None], words: list[str]):
        """(n_a, n_b, n_groups, digest, codes of links, their numbers) of one text."""
        whole = _together([known[x] for x in words]) if text else None
        if whole is None:
            return 0, 0, 0, "", np.empty(0, self.code), np.empty(0, np.int64)
        n, shown, codes = whole
        return (n >> 32, n & 0xFFFFFFFF, shown.count(b"|"), hashlib.sha256(shown).hexdigest(),
                *np.unique(np.frombuffer(codes, self.code), return_counts=True))


def _opened(packed: bytes | None) -> tuple | None:
    if packed is None:
        return None
    n, links = _HEAD.unpack_from(packed)
    return n, packed[_HEAD.size + links:], packed[_HEAD.size:_HEAD.size + links]


def _together(parts: list[tuple | None]) -> tuple | None:
    if len(parts) == 1:
        return parts[0]
    if None in parts:
        return None
    return sum([x[0] for x in parts]), b";".join([x[1] for x in parts]), b"".join([x[2] for x in parts])


class _Kept(dict):
    """What was made for texts, in two generations; long texts only as long as they are needed."""

    def __init__(self, most: int):
        super().__init__()
        self.most = most
        self.old: dict = {}
        self.long: list[str] = []

    def missing(self, wanted: set[str]) -> list[str]:
        """Those of ``wanted`` that have to be made; the others are in the newer generation now."""
        for x in self.long:
            del self[x]
        self.long = []
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()
        absent = wanted - self.keys()
        for x in absent & self.old.keys():
            self[x] = self.old[x]
        return list(absent - self.old.keys())

    def add(self, made) -> None:
        for x, value in made:
            self[x] = value
            if len(x) > LONGEST_KEPT:
                self.long.append(x)


def words_of(text: str) -> list[str]:
    if "  " in text or text[:1] == " " or text[-1:] == " ":
        return _BLANK.split(text)
    return text.split(" ")


_aligners: dict = {}


def _aligner(a: File, b: File) -> Aligner:
    key = a.digest, b.digest
    if key not in _aligners:
        _aligners[key] = Aligner(a.open(ByteTokens), b.open(PieceTokens))
    return _aligners[key]


_ROW = "row long, doc_id {}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, codes binary, times binary"


def aligned(docs: DataFrame, a: str, b: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: its number, token and group counts, digest, and the different links as id codes (A times the size of B plus
    B; sorted) with their numbers."""
    files = File(docs.sparkSession, a), File(docs.sparkSession, b)
    rows = keyed_texts(docs, key, text).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches):
        aligner = _aligner(*files)
        for batch in batches:
            for part, texts in split_rows(batch, most=4 * BATCH_CHARS):
                words = [words_of(x) for x in texts]
                known = aligner.words(set().union(*words))
                found = [aligner.text(x, known, y) for x, y in zip(texts, words)]
                numbers = [pa.array([x[n] for x in found], pa.int64()) for n in range(3)]
                links = pa.array([int(x[5].sum()) for x in found], pa.int64())
                binary = [pa.array([x[4].tobytes() for x in found], pa.binary()),
                          pa.array([x[5].astype(np.uint32).tobytes() for x in found], pa.binary())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *numbers, links, pa.array([x[3] for x in found], pa.string()), *binary],
                    ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "codes", "times"])

    return rows.mapInArrow(run, _ROW.format(kind))


def _codes(codes: bytes, times: bytes) -> tuple[np.ndarray, np.ndarray]:
    times = np.frombuffer(times, np.uint32)
    wide = len(codes) == 8 * len(times) and len(times)
    return np.frombuffer(codes, np.uint64 if wide else np.uint32).astype(np.int64), times


def pair_counts(rows: DataFrame, base: int) -> DataFrame:
    """(code, n, best): documents that hold a pair linked, and whether no pair of its A id has more."""
    def count(batches):
        held, size = [], 0
        for batch in batches:
            for codes, times in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                held.append(_codes(codes, times)[0])
                size += len(held[-1])
            if size > PARTIAL_CODES:
                yield partial(held)
                held, size = [], 0
        yield partial(held)

    def partial(held):
        code, n = np.unique(np.concatenate([np.empty(0, np.int64), *held]), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(code), pa.array(n, pa.int64())], ["code", "n"])

    counts = rows.select("codes", "times").mapInArrow(count, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))
    counts = freeze(counts, "pairs")
    first = F.call_function("div", F.col("code"), F.lit(base))
    most = counts.groupBy(first.alias("a")).agg(F.max("n").alias("most"))
    return freeze(counts.withColumn("a", first).join(most, "a").select("code", "n", (F.col("n") == F.col("most")).alias("best")), "counts")


def scored(rows: DataFrame, counts: DataFrame, held: int = HELD_PAIRS) -> DataFrame:
    """``rows`` (as from ``aligned``) with n_best (links whose pair is the most frequent of its A id) and count_sum."""
    shown = [x for x in rows.columns if x not in ("row", "codes", "times")]
    if counts.count() > held:
        return _joined(rows, counts, shown)
    table = counts.toPandas().sort_values("code")  # ``held`` rows at most
    sent = rows.sparkSession.sparkContext.broadcast((table["code"].to_numpy(np.int64), table["n"].to_numpy(np.int64), table["best"].to_numpy(bool)))

    def run(batches):
        code, n, best = sent.value
        for batch in batches:
            sums = [], []
            for codes, times in zip(*(batch.column(batch.schema.get_field_index(x)).to_pylist() for x in ("codes", "times"))):
                codes, times = _codes(codes, times)
                at = np.searchsorted(code, codes)
                sums[0].append(int(times[best[at]].sum()) if len(at) else 0)
                sums[1].append(int((times * n[at]).sum()) if len(at) else 0)
            yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(x)) for x in shown), *(pa.array(x, pa.int64()) for x in sums)],
                                             [*shown, "n_best", "count_sum"])

    schema = ", ".join(f"{x} {rows.schema[x].dataType.simpleString()}" for x in shown)
    return rows.mapInArrow(run, f"{schema}, n_best long, count_sum long")


def _joined(rows: DataFrame, counts: DataFrame, shown: list[str]) -> DataFrame:
    def links(batches):
        for batch in batches:
            for row, codes, times in zip(*(x.to_pylist() for x in batch.columns)):
                codes, times = _codes(codes, times)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(codes), row)), pa.array(codes), pa.array(times.astype(np.int64))],
                                                 ["row", "code", "times"])

    met = rows.select("row", "codes", "times").mapInArrow(links, "row long, code long, times long").join(counts, "code")
    sums = met.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                  F.sum(F.col("times") * F.col("n")).alias("count_sum"))
    zero = [F.coalesce(F.col(x), F.lit(0)).alias(x) for x in ("n_best", "count_sum")]
    return rows.select("row", *shown).join(sums, "row", "left").select(*shown, *zero)


def align(docs: DataFrame, a: str, b: str, key: str = "doc_id", text: str = "text", held: int = HELD_PAIRS) -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum."""
    with open(b, "rb") as file:
        base = len(PieceTokens(file.read()).bytes)
    rows = freeze(aligned(docs, a, b, key, text), "aligned")
    return scored(rows, pair_counts(rows, base), held)
