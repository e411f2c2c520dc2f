"""Byte-level BPE: texts to token ids with places, and ids back to bytes and texts.

The vocabulary file writes every byte as one printable character. Ids become bytes again by
reversing that table; bytes are joined before they are read as UTF-8, so a character that is
split over tokens comes back whole.

Texts are cut where a single space stands between two characters that are not white space: the
pattern of the vocabulary always cuts there, so the ids of a text are the ids of its cuts one
after the other, and each different cut of a batch is encoded once.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .arrow import add_columns

# Different cuts a worker remembers at least, and their longest length; longer ones are encoded with their
# batch. Bounds memory, never results.
REMEMBERED, REMEMBERED_LENGTH = 250_000, 64
# Cuts encoded as one text.
TOGETHER = 4_096
_CUT = re.compile(r"(?<=\S) (?=\S)")
_NEEDS_CARE = re.compile(r"\s\s|^\s|\s\Z")


def byte_characters() -> dict[str, int]:
    """Printable character of the vocabulary file to the byte it stands for.

    Printable Latin-1 bytes stand for themselves, the others for 256, 257, ... in byte order.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    table = {chr(b): b for b in own}
    table |= {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(own)))}
    return table


@functools.cache
def _tokenizer(vocabulary: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(vocabulary)
    tokenizer.encode_special_tokens = True      # their strings in a text are ordinary text
    return tokenizer


@functools.cache
def token_bytes(vocabulary: str) -> list[bytes]:
    """The bytes of every token id."""
    table, by_text = byte_characters(), _tokenizer(vocabulary).get_vocab(with_added_tokens=True)
    out = [b""] * (max(by_text.values()) + 1)
    for text, i in by_text.items():
        # A special token is written as it is read, not in byte characters.
        out[i] = bytes(map(table.__getitem__, text)) if all(c in table for c in text) else text.encode()
    return out


def cuts(text: str) -> list[str]:
    """The text in parts that are encoded apart; all but the first stand after one space."""
    return _CUT.split(text) if _NEEDS_CARE.search(text) else text.split(" ")


class _Encoder:
    """Ids of texts; each different cut of a batch is encoded once, and short ones are remembered.

    Ids are kept as the bytes of 32-bit integers, by cuts without the space before them. A cut that was
    not met while ``REMEMBERED`` others were is forgotten.
    """

    def __init__(self, vocabulary: str):
        self.tokenizer = _tokenizer(vocabulary)
        self.sizes = np.array([len(b) for b in token_bytes(vocabulary)])
        self.recent: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encoded(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learned(self, parts: list[str]) -> Iterator[tuple[str, bytes]]:
        """Cuts that follow a space and their ids; they are encoded as one text, which is parted by its bytes."""
        for k in range(0, len(parts), TOGETHER):
            some = parts[k:k + TOGETHER]
            ids, = self.encoded([" " + " ".join(some)])
            ends = np.cumsum([1 + len(p.encode()) for p in some])
            stops = np.searchsorted(np.cumsum(self.sizes[ids]), ends) + 1
            for part, start, stop in zip(some, [0, *stops[:-1].tolist()], stops.tolist()):
                yield part, ids[start:stop].tobytes()

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        split = [cuts(t) if t else [""] for t in texts]
        needed = set(chain.from_iterable(c[1:] for c in split))
        if len(self.recent) > REMEMBERED:
            self.recent, self.older = {}, self.recent
        new = needed.difference(self.recent)
        again = new.intersection(self.older)
        self.recent.update((p, self.older[p]) for p in again)
        known, passing = self.recent, {}
        for part, own in self.learned(sorted(new - again)):
            (known if len(part) <= REMEMBERED_LENGTH else passing)[part] = own
        if passing:
            known = known | passing
        firsts = self.encoded([c[0] for c in split])
        return [np.frombuffer(b"".join([first.tobytes(), *map(known.__getitem__, c[1:])]), np.int32)
                for first, c in zip(firsts, split)]


@functools.cache
def _encoder(vocabulary: str) -> _Encoder:
    return _Encoder(vocabulary)


def places(text: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First character and character after the last of each token, given the tokens' bytes.

    A token that holds only part of a character gets that character whole.
    """
    is_start = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
    character = np.cumsum(is_start) - 1
    ends = np.cumsum(lengths)
    return character[ends - lengths], character[ends - 1] + 1


def _lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    sizes = np.fromiter((len(r) for r in rows), np.int64, len(rows))
    flat = np.concatenate([np.asarray(r, np.int32) for r in rows]) if rows else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()),
                                    pa.array(flat, kind))


def encode(df: DataFrame, vocabulary: str, text: str = "text", offsets: bool = False,
           decoded: bool = False) -> DataFrame:
    """``df`` with ``ids`` (array<int>) of the whole text; a null text counts as empty.

    ``offsets`` adds ``starts`` and ``ends``, the characters of each token; ``decoded`` adds the
    bytes that the ids decode to. No tokens: empty arrays. Rows are kept as they are, repeated ones
    too; columns of ``df`` with the names of the new ones are replaced.
    """
    ints = T.ArrayType(T.IntegerType())
    fields = [T.StructField("ids", ints)]
    fields += [T.StructField("starts", ints), T.StructField("ends", ints)] if offsets else []
    fields += [T.StructField("decoded", T.BinaryType())] if decoded else []

    def make(values: list[bytes | None]) -> list[pa.Array]:
        encoder, as_bytes = _encoder(vocabulary), token_bytes(vocabulary)
        ids = encoder.ids([(v or b"").decode() for v in values])
        out = [_lists(ids, pa.int32())]
        if offsets:
            spans = [places(v, np.fromiter((len(as_bytes[i]) for i in own.tolist()), np.int64, len(own)))
                     if len(own) else ([], []) for v, own in zip(values, ids)]
            out += [_lists([s[k] for s in spans], pa.int32()) for k in (0, 1)]
        if decoded:
            out.append(pa.array([b"".join(map(as_bytes.__getitem__, own.tolist())) for own in ids], pa.binary()))
        return out

    return add_columns(df, text, fields, make)


def decode(df: DataFrame, vocabulary: str, ids: str = "ids", errors: str = "replace") -> DataFrame:
    """``df`` with ``decoded`` (bytes) and ``decoded_text``; null ids give nulls.

    Bytes that are no UTF-8 (ids cut inside a character) are read by ``errors``. An id that the
    vocabulary lacks, or a null one, stands for no bytes.
    """
    names = ("decoded", "decoded_text")
    kept = df.select(*[df[f"`{c}`"] for c in df.columns if c not in names])
    schema = T.StructType(kept.schema.fields + [T.StructField("decoded", T.BinaryType()),
                                                T.StructField("decoded_text", T.StringType())])

    def run(batches):
        as_bytes = token_bytes(vocabulary)
        known = range(len(as_bytes))
        for batch in batches:
            rows = batch.column(batch.schema.get_field_index(ids)).to_pylist()
            found = [None if r is None else b"".join(as_bytes[i] for i in r if i is not None and i in known)
                     for r in rows]
            texts = [None if b is None else b.decode("utf-8", errors) for b in found]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.binary()), pa.array(texts, pa.string())],
                names=schema.names)

    return kept.mapInArrow(run, schema)


def ids_digest(ids: str = "ids") -> Column:
    """Lower-case hex SHA-256 of the decimal ids joined by one space."""
    return F.sha2(F.array_join(F.col(ids).cast("array<string>"), " "), 256)
