"""Public vocabularies inside tasks.  The driver reads a file once and broadcasts its bytes (a few megabytes)."""

import array
import base64
import functools
import hashlib
import os
import re

import numpy as np
from pyspark.sql import SparkSession

CACHED_WORDS = 400_000
_objects: dict = {}


class File:
    """A vocabulary file that tasks can open; the content travels as a broadcast."""

    def __init__(self, spark: SparkSession, path: str):
        with open(path, "rb") as file:
            content = file.read()
        self.digest = hashlib.sha256(content).hexdigest()
        self._sent = spark.sparkContext.broadcast(content)

    def open(self, kind):
        """``kind`` built from the content, once per worker process."""
        key = kind, self.digest
        if key not in _objects:
            _objects[key] = kind(self._sent.value)
        return _objects[key]


class Ranks:
    """Byte-level BPE ranks (one base64 token and its id a line) under a pre-token pattern."""

    def __init__(self, content: bytes, pattern: str):
        import tiktoken

        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, content.splitlines())}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        return np.array(self.encoding.encode_ordinary(text), dtype="<u4").tobytes()


class TokenBytes:
    """The bytes of all tokens of a ranks file as one array, to decode with."""

    def __init__(self, content: bytes):
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, content.splitlines())}
        tokens = [ranks.get(x, b"") for x in range(max(ranks, default=-1) + 1)]
        self.body = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.length = np.fromiter(map(len, tokens), np.int32, len(tokens))
        self.start = np.cumsum(self.length, dtype=np.int32) - self.length

    def decode(self, ids: bytes, step: int = 1 << 16) -> bytes:
        """The tokens' bytes in order, found for ``step`` ids at a time."""
        found = np.frombuffer(ids, dtype="<u4")
        return b"".join(self._decoded(found[at:at + step]) for at in range(0, len(found), step))

    def _decoded(self, ids: np.ndarray) -> bytes:
        length = self.length[ids]
        end = np.cumsum(length, dtype=np.int32)
        return self.body[np.repeat(self.start[ids] - (end - length), length) + np.arange(end[-1], dtype=np.int32)].tobytes()


@functools.cache
def ranks_under(pattern: str):
    return functools.partial(Ranks, pattern=pattern)


class _Merged(dict):
    """Ids of pre-tokens, merged when first met."""

    def __init__(self, merge, letters: dict[int, int]):
        super().__init__()
        self.merge, self.letters = merge, letters

    def __missing__(self, part: str) -> bytes:
        tokens = self.merge(part.encode().decode("latin-1").translate(self.letters))
        ids = self[part] = array.array("I", [x.id for x in tokens]).tobytes()
        return ids


class WordTokens:
    """A tokenizer of the ``tokenizers`` library whose pre-tokens never span white space, with a cache of them.

    Blank, tab and line ends separate words for the library too (its pattern drops white space and no match holds
    any; composition never joins a blank with what follows), so a text's ids are those of its words in order.
    In plain Latin text, lower case and pre-tokens are found here and only their merges are asked of the library;
    any other word goes through the library whole.
    """

    PLAIN = re.compile("[\t\n\r\x20-\x7e\xc0-\xd6\xd8-\xf6\xf8-\xff]*").fullmatch
    PROSE = re.compile("[\t\n\r ,.a-z\xdf-\xf6\xf8-\xff]*").fullmatch
    #: The pattern of the vocabulary file, for plain Latin text.
    PARTS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^\\sa-z\xdf-\xf6\xf8-\xff0-9]+").findall

    def __init__(self, content: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_buffer(content)
        self.size = self.library.get_vocab_size(with_added_tokens=True)
        alphabet = set(pre_tokenizers.ByteLevel.alphabet())
        others = iter(sorted(x for x in alphabet if ord(x) > 255))
        self.letters = {byte: byte if chr(byte) in alphabet else ord(next(others)) for byte in range(256)}
        self.parts = _Merged(self.library.model.tokenize, self.letters)
        self.words: dict[str, bytes] = {}

    def _split(self, text: str) -> list[str] | None:
        """The pre-tokens of a plain text."""
        if not self.PLAIN(text) or "<|" in text:
            return None
        low = text.lower()
        if self.PROSE(low) and not any(x in low for x in ("..", ".,", ",.", ",,")):
            return low.replace(".", " . ").replace(",", " , ").split()
        return self.PARTS(low)

    def _other(self, text: str) -> bytes:
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        if len(self.words) > CACHED_WORDS:
            self.words = {}
        if missing := list(set(words) - self.words.keys()):
            found = self.library.encode_batch(missing, add_special_tokens=False)
            self.words.update((w, np.array(x.ids, dtype="<u4").tobytes()) for w, x in zip(missing, found))
        return b"".join(map(self.words.__getitem__, words))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian 32-bit numbers."""
        if len(self.parts) > CACHED_WORDS:
            self.parts.clear()
        get = self.parts.__getitem__
        split = map(self._split, texts)
        return [self._other(text) if parts is None else b"".join(map(get, parts)) for text, parts in zip(texts, split)]
