"""Texts inside tasks: bounded Arrow batches, and words of many texts at once as numpy arrays.

Offsets are code points.  A word is a maximal run of letters, digits and marks; it is compared in lower case.
"""

import functools
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ARROW_ROWS = 500
BATCH_CHARS = 1 << 20
_MULTIPLIER = 0x9E3779B97F4A7C15


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small: a batch of long texts has to fit beside the JVM."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) > ARROW_ROWS:
        spark.conf.set(name, str(ARROW_ROWS))


def text_of(docs: DataFrame, text: str = "text") -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(docs[text], F.lit(""))


def keyed_texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Only (key, text), whatever else the table holds."""
    small_batches(docs.sparkSession)
    return docs.select(docs[key].alias("doc_id"), text_of(docs, text).alias("text"))


def split_rows(batch: pa.RecordBatch, column: str = "text", most: int = BATCH_CHARS):
    """Slices of a batch whose texts have about ``most`` code points together, as (slice, texts)."""
    texts = batch.column(batch.schema.get_field_index(column)).to_pylist()
    start, size = 0, 0
    for place, text in enumerate(texts):
        if size and size + len(text or "") > most:
            yield batch.slice(start, place - start), texts[start:place]
            start, size = place, 0
        size += len(text or "")
    if start < len(texts):
        yield batch.slice(start), texts[start:]


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per code point below 2^16: lower case, whether it belongs to words, a hash."""
    lower = np.arange(1 << 16, dtype=np.uint32)
    word = np.zeros(1 << 16, dtype=bool)
    for point in range(1 << 16):
        char = chr(point)
        word[point] = unicodedata.category(char)[0] in "LNM"
        small = char.lower()
        if len(small) == 1 and ord(small) < 1 << 16:
            lower[point] = ord(small)
    return lower, word, mix(lower.astype(np.uint64) + np.uint64(1))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers (a finaliser of multiplications and shifts)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


@functools.lru_cache(maxsize=4)
def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.cumprod(np.full(n, _MULTIPLIER, dtype=np.uint64))


class Words:
    """The words of several texts.

    codes: all texts as code points, each followed by a zero; first: where each text starts in it, with the end;
    start, end: of each word in ``codes``; doc: the text a word belongs to; hash: of the lower-cased word.
    """

    def __init__(self, texts: list[str]):
        self.codes = np.frombuffer("\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        self.first = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)])
        lower, word, hashed = _tables()
        low = np.minimum(self.codes, 0xFFFF)
        inside = word[low] | (self.codes > 0xFFFF)
        edges = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).view(np.int8)))
        self.start, self.end = edges[::2], edges[1::2]
        self.doc = np.searchsorted(self.first, self.start, side="right") - 1
        self.hash = np.empty(0, dtype=np.uint64)
        if len(self.start):
            value = hashed[low]
            high = self.codes > 0xFFFF
            if high.any():
                value[high] = mix(self.codes[high].astype(np.uint64))
            length = self.end - self.start
            at = np.flatnonzero(inside)
            offset = np.arange(len(at)) - np.repeat(np.cumsum(length) - length, length)
            value = value[at] * _powers(1 << int(length.max()).bit_length())[offset]
            self.hash = mix(np.add.reduceat(value, np.cumsum(length) - length))

    def stems(self, n: int) -> np.ndarray:
        """A hash of the first ``n`` characters of each word; 0 for shorter words."""
        lower, _, hashed = _tables()
        found = np.zeros(len(self.start), dtype=np.uint64)
        long = np.flatnonzero(self.end - self.start >= n)
        start, power = self.start[long], _powers(1 << n.bit_length())
        for k in range(n):
            found[long] += hashed[np.minimum(self.codes[start + k], 0xFFFF)] * power[k]
        found[long] = mix(found[long] + np.uint64(n))
        return found

    def shingles(self, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
        """(doc, hash) of each run of ``n`` words; a shorter text with words is one shingle."""
        count = np.bincount(self.doc, minlength=len(self.first) - 1)
        begin = np.cumsum(count) - count
        size = len(self.hash)
        if not size:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        factor = _powers(2 * n)[n:]
        rolled = np.zeros(size, dtype=np.uint64)
        left = (begin + count)[self.doc] - np.arange(size)
        for k in range(n):
            part = np.zeros(size, dtype=np.uint64)
            part[: size - k] = self.hash[k:] * factor[k]
            rolled += np.where(left > k, part, np.uint64(0))
        full = left >= n
        short = (count[self.doc] < n) & (left == count[self.doc])
        keep = full | short
        return self.doc[keep], mix(rolled[keep])


def word_hash(word: str) -> int:
    """The hash that ``Words`` gives a single word."""
    return int(Words([word]).hash[0])
