"""Token counts: batch encoding in Arrow functions that return lengths only.

The text is cut at spaces between two non-space characters, where no pre-token of a byte-level BPE can reach across,
so the count of a text is the sum over its chunks. Chunks are encoded once a worker, in batches balanced by bytes, and
their lengths are kept in a bounded memo; long texts are worked off in pieces of about ``PIECE`` characters.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read

#: Characters of text that are worked off at once, bytes of one encoded batch.
PIECE, BATCH_BYTES = 1 << 19, 1 << 20
#: About how many bytes each half of a worker's memo holds, chunks and their words, what an entry takes beside its
#: characters, and the longest chunk, in characters, that is kept from one group of texts to the next.
MEMO_BYTES, ENTRY_BYTES, LONGEST = 3 << 25, 200, 200


def byte_batches(items: list[str], limit: int = BATCH_BYTES) -> Iterator[list[str]]:
    """Runs of ``items`` of about ``limit`` UTF-8 bytes each."""
    run, size = [], 0
    for x in items:
        run.append(x)
        size += len(x.encode())
        if size >= limit:
            yield run
            run, size = [], 0
    if run:
        yield run


@lru_cache(maxsize=4)
def tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _encode(tok, texts: list[str]) -> Iterator[list[int]]:
    for run in byte_batches(texts):
        for e in tok.encode_batch_fast(run, add_special_tokens=False):
            yield e.ids


def safe_pieces(text: str, limit: int = PIECE) -> Iterator[str]:
    """Cut before a space that has a non-space on either side; the pieces joined are the text."""
    at = 0
    while len(text) - at > limit:
        cut = text.find(" ", at + limit)
        while cut != -1 and (cut + 1 >= len(text) or text[cut - 1].isspace() or text[cut + 1].isspace()):
            cut = text.find(" ", cut + 1)
        if cut == -1:
            break
        yield text[at:cut]
        at = cut
    yield text[at:]


@lru_cache(maxsize=1)
def byte_alphabet() -> list[str]:
    """The visible character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = (0x100 + i for i in range(256))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


#: Words of Latin letters, each with marks behind it or none, on one or two lines: a pre-token for each group.
_WORD = "([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([.,!#$%&*]*)"
PLAIN = re.compile(f"{_WORD}(?:(\n){_WORD})?")
#: White space that is neither a space nor a line end.
EXOTIC = re.compile(r"[^\S \n]")


class Memo:
    """What chunks of text encode to under one tokenizer file, as ``value`` of their ids; a chunk has no space in it."""

    spaced, fold = False, False

    def __init__(self, path: str):
        self.tok, self.known, self.words = tokenizer(path), {}, {}
        self.held, self.held_words, self.passing = 0, 0, []
        self.model, self.alphabet = self.tok.model, byte_alphabet()

    def value(self, ids: list[int]):
        raise NotImplementedError

    def word(self, word: str):
        """The value of one pre-token, by the model alone."""
        if self.fold:
            word = word.lower()
        if not word.isascii() or word[0] < "!":
            word = "".join([self.alphabet[b] for b in word.encode()])
        return self.value([t.id for t in self.model.tokenize(word)])

    def marks(self, marks: str):
        found = self.words.get(marks)
        if found is None:
            found = self.word(marks)
            if len(marks) <= LONGEST:
                self.words[marks] = found
                self.held_words += len(marks) + ENTRY_BYTES
        return found

    def chunk(self, chunk: str, lead: str = ""):
        """The value of a chunk, if it is made of plain words; else None."""
        m = PLAIN.fullmatch(chunk)
        if not m:
            return None
        first, after, end, second, last = m.groups()
        found = self.marks(lead + first)
        if after:
            found += self.marks(after)
        if end:
            if self.spaced:
                found += self.marks(end)
            found += self.marks(second)
            if last:
                found += self.marks(last)
        return found

    def learn(self, chunks: set[str]) -> None:
        """Make all of ``chunks`` known, the long ones until the next call. What is held is bounded by bytes."""
        for c in self.passing:
            self.known.pop(c, None)
        if self.held > MEMO_BYTES:
            self.known.clear()
            self.held = 0
        if self.held_words > MEMO_BYTES:
            self.words.clear()
            self.held_words = 0
        known, other, lead = self.known, [], " " if self.spaced else ""
        new = chunks.difference(known)
        self.passing = [c for c in new if len(c) > LONGEST]
        self.held += sum(map(len, new)) - sum(map(len, self.passing)) + ENTRY_BYTES * (len(new) - len(self.passing))
        for c in new:
            if (found := self.chunk(c, lead)) is None:
                other.append(c)
            else:
                known[c] = found
        for c, ids in zip(other, _encode(self.tok, [lead + c for c in other]), strict=True):
            known[c] = self.value(ids)


class LengthMemo(Memo):
    """Token counts under a byte-level tokenizer whose pre-tokens take the space before them."""

    spaced = True

    def value(self, ids: list[int]) -> int:
        return len(ids)

    def counts(self, texts: list[str | None]) -> list[int]:
        pieces = [(k, p) for k, t in enumerate(texts) if t for p in safe_pieces(t)]
        # Pieces with other white space beside a space are encoded whole, as is what stands before the first space.
        split = [[p] if "  " in p or " \n" in p or "\n " in p or p[-1] == " " or EXOTIC.search(p) else p.split(" ") for _, p in pieces]
        self.learn(set(chain.from_iterable(x[1:] for x in split)))
        out, known, whole = [0] * len(texts), self.known, []
        for (k, _), x in zip(pieces, split, strict=True):
            out[k] += sum(map(known.__getitem__, x[1:]))
            if (head := self.chunk(x[0]) if x[0] else 0) is None:
                whole.append((k, x[0]))
            else:
                out[k] += head
        for (k, _), ids in zip(whole, _encode(self.tok, [x for _, x in whole]), strict=True):
            out[k] += len(ids)
        return out


def grouped(texts: list[str | None], limit: int = PIECE) -> Iterator[list[str | None]]:
    """Runs of ``texts`` of about ``limit`` characters each; a longer text is a run of its own."""
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t) if t else 0
        if size >= limit:
            yield run
            run, size = [], 0
    if run:
        yield run


@lru_cache(maxsize=4)
def _memo(path: str) -> LengthMemo:
    return LengthMemo(path)


def count_tokens(docs: DataFrame, path: str, text: str = "text", limit: int = 1024) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit (n_tokens > ``limit``), replacing columns of these names.

    Counts are those of the tokenizer file's library over the whole text, special strings as it treats them by default,
    nothing added, truncated or padded. A null text counts as empty: 0 bytes, 0 tokens. Repeated rows, nulls in other
    columns and an empty table pass through. There is no shuffle, and one row is one row.
    """
    @F.pandas_udf("long")
    def lengths(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memo = _memo(path)
        for s in batches:
            yield pd.Series([n for run in grouped(s.tolist()) for n in memo.counts(run)], dtype="int64")

    counted = docs.withColumn("n_tokens", lengths(F.col(text)))
    return counted.withColumns({
        "n_bytes": F.coalesce(F.octet_length(text), F.lit(0)).cast("long"),
        "over_limit": F.col("n_tokens") > limit,
    })


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")).select("doc_id", "n_bytes", "n_tokens", "over_limit")


class IdMemo(Memo):
    """Little-endian unsigned 32-bit ids under a lower-casing tokenizer that drops white space between words."""

    fold = True

    def value(self, ids: list[int]) -> bytes:
        return array("I", ids).tobytes() if sys.byteorder == "little" else b"".join(x.to_bytes(4, "little") for x in ids)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        pieces = [(k, p.replace("\n", " ").split(" ")) for k, t in enumerate(texts) if t for p in safe_pieces(t)]
        self.learn(set(chain.from_iterable(x for _, x in pieces)))
        out, known = [[] for _ in texts], self.known
        for k, x in pieces:
            out[k].append(b"".join(map(known.__getitem__, x)))
        return [b"".join(x) for x in out]


@lru_cache(maxsize=4)
def id_memo(path: str) -> IdMemo:
    return IdMemo(path)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op3_token_counts": op3_token_counts}
ORACLE: dict[str, str] = {}
