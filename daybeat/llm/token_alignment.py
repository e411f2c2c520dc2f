"""Alignment of two tokenizers' tokens over the same bytes, and how usual each link is in the corpus.

A byte-level vocabulary (A) and a piece vocabulary (B) cut a text, with one space before it, into tokens.
Byte offsets where tokens of both end are shared cuts; they part the text into groups. They are found by
divide and conquer: a shared cut near the middle of an interval is looked for by bisection among the
other side's ends, both halves follow, and an interval without a cut is a group.

Neither vocabulary has a token that goes on after a single space between other characters, so a text is
first parted there, and each different part is cut and aligned once per worker.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..session import keep, one_row
from .arrow import add_columns
from .byte_bpe import _tokenizer, cuts, token_bytes

REMEMBERED_BYTES = 128 << 20    # memory of a worker for known parts, roughly; bounds memory, never results
LONGEST = 64                    # longer parts are not remembered
TOGETHER, AT_ONCE = 256, 8192   # parts given to the tokenizers as one text, and parts aligned at once
HOT_PAIRS = 1 << 16             # at most so many id pairs can each hold this part of all pairs of documents
_SPACE = "▁"

class Part(NamedTuple):
    """Tokens, groups and links of one part of a text; ``pairs`` are the 64-bit keys of the linked ids."""
    n_a: int
    n_b: int
    n_groups: int
    form: str
    pairs: bytes


def _cuts_near_middle(ends_a: np.ndarray, ends_b: np.ndarray, intervals: np.ndarray) -> np.ndarray:
    """For each interval the A token that ends at a shared cut inside it, nearest to its middle, or -1.

    Ever more A ends on both sides of the middle are looked up among the ends of B by bisection.
    """
    first, last = intervals[0], intervals[1] - 1         # the last token ends at the interval's own end
    middle, found = (first + last) // 2, np.full(len(first), -1)
    open_, far, width = np.arange(len(first)), 0, 1
    while len(open_):
        steps = np.arange(far, far + width)
        at = np.stack([middle[open_, None] - steps, middle[open_, None] + 1 + steps], axis=2).reshape(len(open_), -1)
        inside = (at >= first[open_, None]) & (at < last[open_, None])
        ends = ends_a[np.where(inside, at, 0)]
        hit = inside & (ends_b[np.searchsorted(ends_b, ends)] == ends)
        some = hit.any(axis=1)
        found[open_[some]] = at[some, hit[some].argmax(axis=1)]
        far += width
        more = (middle - far >= first) | (middle + 1 + far < last)
        open_, width = open_[~some & more[open_]], min(2 * width, 1 << 14)
    return found


def leaves(ends_a: np.ndarray, ends_b: np.ndarray, after_a: np.ndarray, after_b: np.ndarray) -> np.ndarray:
    """First and after-last token of A and of B of every group, one column each, in order.

    The ends rise; ``after_a`` and ``after_b`` count the tokens up to known shared cuts, the last
    of them the end. All intervals of one depth are parted together.
    """
    todo = np.stack([np.concatenate([[0], after_a[:-1]]), after_a, np.concatenate([[0], after_b[:-1]]), after_b])
    done = []
    while todo.shape[1]:
        # One token on a side leaves no place for a cut.
        open_ = (todo[1] - todo[0] > 1) & (todo[3] - todo[2] > 1)
        done.append(todo[:, ~open_])
        todo = todo[:, open_]
        at = _cuts_near_middle(ends_a, ends_b, todo)
        done.append(todo[:, at < 0])
        todo, at = todo[:, at >= 0], at[at >= 0]
        there = np.searchsorted(ends_b, ends_a[at])
        todo = np.concatenate([[todo[0], at + 1, todo[2], there + 1], [at + 1, todo[1], there + 1, todo[3]]], axis=1)
    found = np.concatenate(done, axis=1)
    return found[:, np.argsort(found[0], kind="stable")]


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of A and of B that share bytes: one pair for every stretch between neighbouring ends."""
    ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")      # two rising runs
    ends = ends[np.concatenate([ends[1:] != ends[:-1], [True]])]
    return np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)


class _Aligner:
    def __init__(self, vocabulary: str, pieces: str):
        from sentencepiece import SentencePieceProcessor
        self.a, self.bytes_a = _tokenizer(vocabulary), token_bytes(vocabulary)
        self.b = SentencePieceProcessor(model_file=pieces)
        texts = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(t[3:5], 16)]) if self.b.is_byte(k) else t.replace(_SPACE, " ").encode()
                        for k, t in enumerate(texts)]
        # Ids of A before another one and before those of B, then ids of B before another one, the next group, the next part.
        self.names = [f"{k}{end}" for own, ends in ((self.bytes_a, ",|"), (self.bytes_b, ",;\n")) for end in ends
                      for k in range(len(own))]
        self.sizes_a, self.sizes_b = (np.array([len(t) for t in own], np.int64) for own in (self.bytes_a, self.bytes_b))
        # A piece that goes on after a space would join two parts.
        self.apart = not any(_SPACE in t.lstrip(_SPACE) for t in texts)
        self.known: dict[str, Part | None] = {}
        self.older: dict[str, Part | None] = {}
        self.size = 0

    def learn(self, parts: list[str], out: dict[str, Part | None]) -> None:
        """Puts the alignment of each part into ``out``; None where A or B do not give the part's bytes back.

        Parts without white space at their ends are put together again for the tokenizers, some at a
        time: known shared cuts stand between them.
        """
        joint = [p for p in parts if len(p.strip()) == len(p)] if self.apart else []
        alone = set(parts).difference(joint) if len(joint) < len(parts) else ()
        groups = [[p] for p in alone] + [joint[k:k + TOGETHER] for k in range(0, len(joint), TOGETHER)]
        failed = self._learn(groups, out)
        for p in self._learn([[p] for g in failed if len(g) > 1 for p in g], out) + [g for g in failed if len(g) == 1]:
            out[p[0]] = None

    def _learn(self, groups: list[list[str]], out: dict[str, Part | None]) -> list[list[str]]:
        """Puts the parts of all groups into ``out``, but for groups that do not come back byte for byte."""
        texts, failed, tokens_a, tokens_b, kept = [" ".join(g) for g in groups], [], [], [], []
        found_a = self.a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        for group, text, found, ids_b in zip(groups, texts, found_a, self.b.encode(texts, num_threads=1)):
            ids_a, whole = found.ids, (" " + text).encode()
            if (b"".join(map(self.bytes_a.__getitem__, ids_a)) == whole
                    == b"".join(map(self.bytes_b.__getitem__, ids_b))):
                tokens_a += ids_a
                tokens_b += ids_b
                kept += group
            else:
                failed.append(group)
        if kept:
            self._align(kept, tokens_a, tokens_b, out)
        return failed

    def _align(self, parts: list[str], tokens_a: list[int], tokens_b: list[int], out: dict[str, Part | None]) -> None:
        ids_a, ids_b = np.array(tokens_a, np.int64), np.array(tokens_b, np.int64)
        ends_a, ends_b = np.cumsum(self.sizes_a[ids_a]), np.cumsum(self.sizes_b[ids_b])
        borders = np.cumsum([len(p.encode()) + 1 for p in parts])
        after_a, after_b = np.searchsorted(ends_a, borders) + 1, np.searchsorted(ends_b, borders) + 1
        groups = leaves(ends_a, ends_b, after_a, after_b)
        link_a, link_b = overlaps(ends_a, ends_b)
        pairs = (ids_a[link_a] << 32 | ids_b[link_b]).tobytes()
        # Groups and links up to the end of each part.
        after_groups = np.searchsorted(groups[1], after_a) + 1
        after_links = np.searchsorted(link_a, after_a)
        forms = self._forms(ids_a, ids_b, groups, after_groups)
        cut = [0, *(8 * after_links).tolist()]
        own = (pairs[x:y] for x, y in zip(cut, cut[1:]))
        counts = (np.diff(after, prepend=0).tolist() for after in (after_a, after_b, after_groups))
        out.update(zip(parts, map(Part._make, zip(*counts, forms, own))))

    def _forms(self, ids_a: np.ndarray, ids_b: np.ndarray, groups: np.ndarray, after_groups: np.ndarray) -> list[str]:
        """The groups of every part as text: ids of A, then of B, each with the sign behind it."""
        n_a, n_b = len(self.bytes_a), len(self.bytes_b)
        names_a, names_b = ids_a.copy(), ids_b + 2 * n_a
        names_a[groups[1] - 1] += n_a
        names_b[groups[3] - 1] += n_b
        names_b[groups[3][after_groups - 1] - 1] += n_b
        # A token's place: those of its own side before it, and those of the other side before its group, or up to its end.
        names = np.empty(len(ids_a) + len(ids_b), np.int64)
        names[np.arange(len(ids_a)) + np.repeat(groups[2], groups[1] - groups[0])] = names_a
        names[np.arange(len(ids_b)) + np.repeat(groups[1], groups[3] - groups[2])] = names_b
        return "".join(map(self.names.__getitem__, names.tolist())).split("\n")[:-1]

    def texts(self, values: list[bytes | None]) -> Iterator[list[Part]]:
        """The parts of every text; none for a text that is null, empty or not given back whole."""
        split = [(v or b"").decode() for v in values]
        split = [(cuts(t) if self.apart else [t]) if t else [] for t in split]
        # A part that was not met while others filled half of the memory is forgotten.
        if 2 * self.size > REMEMBERED_BYTES:
            self.older, self.known, self.size = self.known, {}, 0
        known, older, passing = self.known, self.older, {}
        new = set().union(*split).difference(known)
        again = new.intersection(older)
        known.update(zip(again, map(older.__getitem__, again)))
        self.size += 480 * len(again)
        new = list(new.difference(again))
        for start in range(0, len(new), AT_ONCE):
            some = new[start:start + AT_ONCE]
            short = [p for p in some if len(p) <= LONGEST]
            self.learn(short, known)
            self.learn([p for p in some if len(p) > LONGEST], passing)
            self.size += 480 * len(short)
        for own in split:
            parts = list(map(known.get, own))
            if not all(parts):      # some are not remembered, or not given back
                parts = [known[p] if p in known else passing[p] for p in own]
            yield parts if all(parts) else []


@functools.cache
def _aligner(vocabulary: str, pieces: str) -> _Aligner:
    return _Aligner(vocabulary, pieces)


def _links(pairs: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Different id pairs of a text, by the pairs of its parts, and how often each is linked."""
    keys = np.sort(np.frombuffer(b"".join(pairs), np.int64))
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.diff(np.concatenate([starts, [len(keys)]]))


def _list_of(sizes: list[int], values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), values)


def align(df: DataFrame, vocabulary: str, pieces: str, text: str = "text") -> DataFrame:
    """``df`` with the alignment of every whole text.

    ``n_a`` and ``n_b`` count the tokens, ``n_groups`` the groups, ``n_links`` the overlapping tokens of A
    and B; ``groups`` is the text ``a1,a2|b1;a3|b2,b3`` of their ids; ``links`` holds each different id
    pair (A id times 2^32, plus B id) once and how often it is linked. Special tokens inside a text are
    plain text. Null and empty texts, and texts that the tokens of A or B do not give back byte for byte,
    have no tokens: zeros, an empty text, no links. Rows stay as they are, repeated ones too; columns with
    the new names are replaced.
    """
    link = T.StructType([T.StructField("pair", T.LongType()), T.StructField("times", T.LongType())])
    fields = [T.StructField(n, T.LongType()) for n in ("n_a", "n_b", "n_groups", "n_links")]
    fields += [T.StructField("groups", T.StringType()), T.StructField("links", T.ArrayType(link))]

    def make(values: list[bytes | None]) -> list[pa.Array]:
        n_a, n_b, n_groups, n_links, form, found = [], [], [], [], [], []
        for parts in _aligner(vocabulary, pieces).texts(values):
            *counts, forms, own = zip(*parts) if parts else [()] * len(Part._fields)
            for column, values_of_parts in zip((n_a, n_b, n_groups), counts):
                column.append(sum(values_of_parts))
            found.append(_links(own))
            n_links.append(int(found[-1][1].sum()))
            form.append(";".join(forms))
        pairs, times = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, np.int64) for k in (0, 1))
        links = pa.StructArray.from_arrays([pa.array(pairs), pa.array(times)], ["pair", "times"])
        return [*(pa.array(c, pa.int64()) for c in (n_a, n_b, n_groups, n_links)), pa.array(form, pa.string()),
                _list_of([len(f[0]) for f in found], links)]

    return add_columns(df, text, fields, make)


def group_ids(groups: str = "groups") -> Column:
    """The groups as an array of the ids of A and of B, from the text that ``align`` gives."""
    def ids(side: Column) -> Column:
        return F.split(side, ",").cast("array<int>")

    each = F.transform(F.split(F.col(groups), ";"), lambda g: F.struct(
        ids(F.split(g, r"\|")[0]).alias("a"), ids(F.split(g, r"\|")[1]).alias("b")))
    return F.when(F.col(groups) != "", each).otherwise(F.array().cast("array<struct<a:array<int>,b:array<int>>>"))


def pair_counts(links: DataFrame) -> DataFrame:
    """Every id pair with the rows that hold it (``n``), and whether no pair of its A id has more (``best``).

    ``links`` has one row for each row of the corpus and different pair in it. Counts are added before
    the shuffle; an A id has at most as many pairs as B has ids.
    """
    counts = keep(links.groupBy("pair").agg(F.count("*").alias("n"))
                  .withColumn("a", F.shiftright("pair", 32)))
    most = counts.groupBy(F.col("a").alias("a")).agg(F.max("n").alias("most"))
    return counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def weigh(aligned: DataFrame) -> DataFrame:
    """``aligned`` without ``links`` but with ``n_best`` and ``count_sum``, over all rows of the table.

    A pair's count is the number of rows that hold it linked. ``n_best`` counts the links whose pair has
    its A id's highest count, ties included; ``count_sum`` adds the counts over the links. No links: zeros.

    Pairs that hold a fixed part of all different pairs of rows are few, whatever the input, and are
    broadcast; the others are joined by pair, where none of them is more than that part of the rows.
    """
    names = [c for c in aligned.columns if c not in ("links", "n_best", "count_sum")]
    held = keep(aligned.select(*[aligned[f"`{c}`"].alias(f"c{k}") for k, c in enumerate(names)],
                               aligned["links"].alias("links"), F.monotonically_increasing_id().alias("row")))
    each = held.select("row", F.inline("links").alias("pair", "times"))
    counts = keep(pair_counts(each.select("pair")))
    total = one_row(counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"))).total
    is_hot = F.col("n") * HOT_PAIRS >= total
    met = each.join(F.broadcast(counts.filter(is_hot)), "pair", "left")
    rare = met.filter(F.col("n").isNull()).select("row", "pair", "times").join(counts.filter(~is_hot), "pair")
    columns = ["row", F.when(F.col("best"), F.col("times")).otherwise(0).alias("n_best"),
               (F.col("n") * F.col("times")).alias("count_sum")]
    sums = (met.filter(F.col("n").isNotNull()).select(*columns).unionByName(rare.select(*columns))
            .groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
    return (held.drop("links").join(sums, "row", "left")
            .select(*[F.col(f"c{k}").alias(c) for k, c in enumerate(names)],
                    F.coalesce("n_best", F.lit(0)).alias("n_best"),
                    F.coalesce("count_sum", F.lit(0)).alias("count_sum")))
