"""Language-model scores by stupid backoff over bigram and word counts of the whole corpus.

The counts of an n-gram and of the words in it meet in two joins by hash. A row of both joins is one
batch of texts in one partition of the hashes, its n-grams side by side in sorted arrays: that shuffles a
few bytes for an n-gram where a row for each would shuffle dozens.

1. Bigrams go to the partition of their first word, where their own and their context's counts are
   known. What other texts have seen is scored; the others ask for their second word.
2. These questions meet the word counts in the partition of the second word.
3. Parts of a text's score are summed per text.

A text is scored by the counts of all others: its own are taken off. Very frequent words (at least one
of HOT_SHARE words) would crowd one partition; their bigrams are dealt out by both words, and the exact
counts of these few words are known to every task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .arrow import pieces
from .shingles import mixed, word_hashes

BACKOFF = 0.4
# Count of a word that no other text has.
UNSEEN = 0.5
HOT_SHARE = 1000
# Words of one partition of the hashes.
PARTITION_WORDS = 2_000_000
# Bytes of text whose n-grams a task holds at once.
_TEXT_BYTES = 3 << 20
_BITS = np.uint64((1 << 48) - 1)
_PAIR = np.uint64(0x9E3779B97F4A7C15)       # fixed value: golden ratio

col = F.col
PAIRS, WORDS, QUESTIONS, SUMS = range(4)
# Arrays of a row: words as upper and lower parts, places of texts in ``texts``, counts and sums.
_ARRAYS = ("first_high", "first_low", "second_high", "second_low", "place", "n", "own_first", "own_second",
           "texts", "value", "backed", "ids", "has_id", "words")
SCHEMA = "kind byte, bucket int, " + ", ".join(f"{a} binary" for a in _ARRAYS)


def hashes(raw: bytes | None) -> np.ndarray:
    """48-bit hashes of the words of a text; A-Z count as a-z."""
    return word_hashes(raw) & _BITS


def _packed(x: np.ndarray) -> bytes:
    """Type, then the numbers compressed; whole numbers in the smallest type that holds them."""
    if x.dtype.kind != "f" and x.min(initial=0) >= 0:
        x = x.astype(np.min_scalar_type(int(x.max(initial=0))))
    return x.dtype.str[1:].encode() + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(x))


def _unpacked(packed: bytes) -> np.ndarray:
    x = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed[2:]), packed[:2].decode())
    return x.astype(np.int32) if x.dtype.kind == "u" and x.dtype.itemsize < 4 else x


def _row(kind: int, bucket: int, **arrays: np.ndarray) -> dict:
    return {"kind": kind, "bucket": int(bucket)} | {a: _packed(np.asarray(x)) for a, x in arrays.items()}


def _halves(name: str, words: np.ndarray) -> dict[str, np.ndarray]:
    return {f"{name}_high": words >> np.uint64(32), f"{name}_low": words & np.uint64(0xFFFFFFFF)}


def _arrays(row: dict) -> dict[str, np.ndarray]:
    out = {a: _unpacked(row[a]) for a in _ARRAYS if row.get(a) is not None}
    for name in ("first", "second"):
        if f"{name}_high" in out:
            low = out.pop(f"{name}_low").astype(np.uint64)
            out[name] = out.pop(f"{name}_high").astype(np.uint64) << np.uint64(32) | low
    return out


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = [pa.int8(), pa.int32(), *[pa.binary()] * len(_ARRAYS)]
    return pa.RecordBatch.from_arrays(
        [pa.array([r.get(c) for r in rows], k) for c, k in zip(("kind", "bucket", *_ARRAYS), kinds)],
        names=["kind", "bucket", *_ARRAYS])


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal rows of sorted keys."""
    change = np.ones(len(keys[0]), bool)
    if len(change):
        change[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
    return np.flatnonzero(change)


def bucket_of(words: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(words) % np.uint64(buckets)).astype(np.int64)


def exploded(uids: np.ndarray, ids: list[int | None], texts: list[np.ndarray], buckets: int,
             hot: np.ndarray) -> list[dict]:
    """Rows of the first join for some texts: distinct bigrams per text, word counts, starts of the sums.

    The starts hold the ids and sizes of the texts; all else is about ``uids``, one for each row.

    The first word of a text has no context: it asks for its word count straight away.
    """
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    words = np.concatenate(texts) if texts else np.zeros(0, np.uint64)
    place = np.repeat(np.arange(len(texts)), sizes)
    rows = [_row(SUMS, uids[0] % buckets if len(uids) else 0, texts=uids, value=np.zeros(len(uids)),
                 backed=np.zeros(len(uids), np.int64), words=sizes, has_id=np.array([i is not None for i in ids]),
                 ids=np.array([i or 0 for i in ids], np.int64))]
    if not len(words):
        return rows
    # Counts of words in their text, and as contexts there.
    last = np.zeros(len(words), bool)
    last[np.cumsum(sizes)[sizes > 0] - 1] = True
    order = np.lexsort((words, place))
    starts = _runs(place[order], words[order])
    own, context = np.empty(len(words), np.int64), np.empty(len(words), np.int64)
    lengths = np.diff(np.append(starts, len(words)))
    own[order] = np.repeat(lengths, lengths)
    context[order] = np.repeat(np.add.reduceat((~last[order]).astype(np.int64), starts), lengths)
    # Word counts of the batch.
    different, count = np.unique(words, return_counts=True)
    target = bucket_of(different, buckets)
    for b in np.unique(target):
        at = target == b
        rows.append(_row(WORDS, b, **_halves("second", different[at]), n=count[at]))
    # First words.
    head = np.cumsum(sizes)[sizes > 0] - sizes[sizes > 0]
    target = bucket_of(words[head], buckets)
    for b in np.unique(target):
        at = head[target == b]
        rows.append(_row(QUESTIONS, b, **_halves("second", words[at]), place=np.arange(len(at)), texts=uids[place[at]],
                         n=np.ones(len(at), np.int64), own_second=own[at], value=np.zeros(len(at))))
    # Distinct bigrams of each text.
    left = np.flatnonzero(~last)
    if len(left):
        first, second = words[left], words[left + 1]
        order = np.lexsort((place[left], second, first))
        left, first, second = left[order], first[order], second[order]
        starts = _runs(first, second, place[left])
        n = np.diff(np.append(starts, len(left)))
        left, first, second = left[starts], first[starts], second[starts]
        target = bucket_of(first, buckets)
        crowded = np.isin(first, hot)
        target[crowded] = bucket_of(first[crowded] * _PAIR ^ second[crowded], buckets)
        by_bucket = np.argsort(target, kind="stable")
        cuts = _runs(target[by_bucket])
        for at in np.split(by_bucket, cuts[1:]):
            here, back = np.unique(place[left[at]], return_inverse=True)
            # A context that is not crowded is whole in its partition: its count there tells its own.
            rows.append(_row(PAIRS, target[at[0]], **_halves("first", first[at]), **_halves("second", second[at]),
                             place=back, texts=uids[here], n=n[at], own_second=own[left[at] + 1],
                             own_first=np.where(crowded[at], context[left[at]], 0)))
    return rows


def _joined(rows: list[dict]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Arrays of several rows one after the other, places counted through; and the texts."""
    parts, base = [], 0
    for row in rows:
        own = _arrays(row)
        own["place"] = own["place"].astype(np.int32) + np.int32(base)
        base += len(own["texts"])
        parts.append(own)
    joined = {k: np.concatenate([p.pop(k) for p in parts]) for k in list(parts[0])}
    return joined, joined.pop("texts").astype(np.int64)


def _summed(bucket: int, place: np.ndarray, value: np.ndarray, backed: np.ndarray, texts: np.ndarray) -> dict:
    used, place = np.unique(place, return_inverse=True)
    return _row(SUMS, bucket, texts=texts[used], value=np.bincount(place, value, len(used)),
                backed=np.bincount(place, backed, len(used)).astype(np.int64))


def scored_pairs(bucket: int, rows: list[dict], buckets: int, hot: np.ndarray, hot_counts: np.ndarray) -> list[dict]:
    """First join: sums of the bigrams that other texts have, questions for the words of the others."""
    pairs, texts = _joined(rows)
    order = np.lexsort((pairs["second"], pairs["first"]))
    p = {k: pairs.pop(k)[order] for k in list(pairs)}
    del order
    spread = lambda x, starts: np.repeat(np.add.reduceat(x, starts), np.diff(np.append(starts, len(x))))
    both = (spread(p["n"], _runs(p["first"], p["second"])) - p["n"]).astype(np.int32)
    by_text = np.lexsort((p["place"], p["first"]))
    own = np.empty(len(by_text), np.int32)
    own[by_text] = spread(p["n"][by_text], _runs(p["first"][by_text], p["place"][by_text]))
    del by_text
    context = (spread(p["n"].astype(np.int64), _runs(p["first"])) - own)
    del own
    if len(hot):
        at = np.minimum(np.searchsorted(hot, p["first"]), len(hot) - 1)
        context = np.where(hot[at] == p["first"], hot_counts[at] - p["own_first"], context)
        del at
    seen = np.flatnonzero(both > 0)
    value = (np.log(both[seen]) - np.log(np.maximum(context[seen], 1))) * p["n"][seen]
    out = [_summed(bucket, p["place"][seen], value, np.zeros(len(seen)), texts)]
    del value, context, seen, p["first"]
    asked = np.flatnonzero(both <= 0)
    del both
    target = bucket_of(p["second"][asked], buckets).astype(np.int32)
    order = np.lexsort((p["second"][asked], target))
    asked, target = asked[order], target[order]
    del order
    for at in np.split(asked, _runs(target)[1:]) if len(asked) else []:
        here, back = np.unique(p["place"][at], return_inverse=True)
        out.append(_row(QUESTIONS, bucket_of(p["second"][at[:1]], buckets)[0], **_halves("second", p["second"][at]), place=back,
                        texts=texts[here], n=p["n"][at], own_second=p["own_second"][at],
                        value=np.full(len(at), np.log(BACKOFF))))
    return out


def answered(bucket: int, questions: list[dict], counts: list[dict]) -> list[dict]:
    """Second join: sums of the words that were asked for, without the division by the size of the corpus."""
    words = [_arrays(r) for r in counts]
    known, back = np.unique(np.concatenate([w["second"] for w in words]), return_inverse=True)
    total = np.bincount(back, np.concatenate([w["n"] for w in words]))
    q, texts = _joined(questions)
    others = total[np.searchsorted(known, q["second"])] - q["own_second"]
    value = (q["value"] + np.log(np.maximum(others, UNSEEN))) * q["n"]
    return [_summed(bucket, q["place"], value, q["n"], texts)]


def _join(rows: DataFrame, make) -> DataFrame:
    """Rows by bucket through ``make``, which gets the bucket and its rows and gives rows."""
    def run(key, group):
        return pa.Table.from_batches([_batch(make(key[0].as_py(), group.to_pylist()))])

    return rows.groupBy("bucket").applyInArrow(run, SCHEMA)


def _word_batches(batches, text: str):
    for batch in batches:
        for part in pieces(batch, text, _TEXT_BYTES):
            at = part.schema.get_field_index(text)
            yield part, [hashes(raw) for raw in part.column(at).cast(pa.binary()).to_pylist()]


def frequent_words(df: DataFrame, text: str = "text") -> tuple[int, np.ndarray, np.ndarray]:
    """Words of the corpus, and the hashes and context counts of the hot ones, ascending.

    A word with a share of 1/HOT_SHARE of all words has half that share in some batch, unless it is spread
    so evenly that its partition is not crowded by it: batches name candidates, then the exact counts of
    the candidates are taken. At most 2 x HOT_SHARE of them have that share overall.
    """
    def candidates(batches):
        for _, texts in _word_batches(batches, "text"):
            words = np.concatenate(texts) if texts else np.zeros(0, np.uint64)
            different, count = np.unique(words, return_counts=True)
            often = count * 2 * HOT_SHARE >= max(len(words), 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(different[often].view(np.int64), -1)), pa.array(np.append(count[often], len(words)))],
                names=["word", "n"])

    rows = df.select(col(f"`{text}`").alias("text"))
    found = rows.mapInArrow(candidates, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    size = found.filter("word = -1").first()
    size = int(size.n) if size else 0
    named = [r.word for r in found.filter((col("word") != -1) & (col("n") * 2 * HOT_SHARE >= size)).collect()]
    hot = np.sort(np.array(named, np.int64).view(np.uint64))

    def contexts(batches):
        for _, texts in _word_batches(batches, "text"):
            words = np.concatenate([t[:-1] for t in texts]) if texts else np.zeros(0, np.uint64)
            different, count = np.unique(words[np.isin(words, hot)], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(different.view(np.int64)), pa.array(count)], names=["word", "n"])

    counts = {r.word: r.n for r in rows.mapInArrow(contexts, "word long, n long").groupBy("word")
              .agg(F.sum("n").alias("n")).collect()} if len(hot) else {}
    return size, hot, np.array([counts.get(int(w), 0) for w in hot], np.int64)


def score(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_words, n_backed_off, log_score, mean_log_score) of every row of ``df``.

    The score of a word after another is the share of the pair among all pairs with the same first word;
    if no other text has the pair, BACKOFF times the word's share of all words, where a word that no other
    text has counts UNSEEN times. The first word has its share. ``log_score`` is the sum of the logarithms,
    ``mean_log_score`` that by ``n_words``. Null and empty texts have no words, score 0 and a null mean.
    Repeated rows are texts of their own and know each other. No rows give an empty table.
    """
    size, hot, hot_counts = frequent_words(df, text)
    buckets = max(1, -(-size // PARTITION_WORDS))
    rows = df.select(col(f"`{id}`").cast("long").alias("id"), col(f"`{text}`").alias("text"))
    rows = rows.withColumn("uid", F.monotonically_increasing_id())

    def explode(batches):
        for part, texts in _word_batches(batches, "text"):
            uids, ids = (part.column(part.schema.get_field_index(c)) for c in ("uid", "id"))
            yield _batch(exploded(uids.to_numpy(), ids.to_pylist(), texts, buckets, hot))

    def first(bucket: int, group: list[dict]) -> list[dict]:
        pairs = [r for r in group if r["kind"] == PAIRS]
        rest = [r for r in group if r["kind"] != PAIRS]
        return rest + (scored_pairs(bucket, pairs, buckets, hot, hot_counts) if pairs else [])

    def second(bucket: int, group: list[dict]) -> list[dict]:
        asked = [r for r in group if r["kind"] == QUESTIONS]
        counts = [r for r in group if r["kind"] == WORDS]
        return [r for r in group if r["kind"] == SUMS] + (answered(bucket, asked, counts) if asked else [])

    def sums(batches):
        for batch in batches:
            for found in map(_arrays, batch.to_pylist()):
                n = len(found["texts"])
                ids, words = found.get("ids", np.zeros(n)), found.get("words", np.zeros(n))
                missing = ~found["has_id"].astype(bool) if "has_id" in found else np.ones(n, bool)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found["texts"].astype(np.int64)), pa.array(found["value"].astype(np.float64)),
                     pa.array(found["backed"].astype(np.int64)), pa.array(ids.astype(np.int64), mask=missing),
                     pa.array(words.astype(np.int64))], names=["uid", "value", "backed", "id", "words"])

    parts = _join(_join(rows.mapInArrow(explode, SCHEMA), first), second)
    totals = parts.mapInArrow(sums, "uid long, value double, backed long, id long, words long").groupBy("uid").agg(
        F.sum("value").alias("value"), F.sum("backed").alias("backed"), F.max("id").alias("id"), F.sum("words").alias("n_words"))
    rest = F.greatest(F.lit(size) - col("n_words"), F.lit(1)).cast("double")
    return (totals.withColumn("log_score", col("value") - col("backed") * F.log(rest))
            .select(col("id").alias(id), "n_words", col("backed").alias("n_backed_off"), "log_score",
                    F.when(col("n_words") > 0, col("log_score") / col("n_words")).alias("mean_log_score")))
