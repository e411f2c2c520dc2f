"""Mixing sources to target weights by weighted sampling without replacement.

Every document gets an exponential key divided by its quality weight (Efraimidis and Spirakis):
in the order of these keys, documents come as if drawn one after the other with chances in
proportion to their weights. A source first gives all its documents as often as its target holds
it whole; the rest of the target is filled by documents in key order, by running sums of sizes.

Running sums never sort a source as a whole: keys fall into buckets, bucket sums show which bucket
holds the cut, that bucket is divided once more, and only what then lies on the cut is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import keep

# A source may be taken this many times over; its target stops there.
MOST_EPOCHS = 3
WEIGHTS = (1, 2, 3)
# Each of the two divisions of the keys of a source.
BUCKETS = 4096
WORDS = r"[^\x20\x09-\x0D]+"
_UNIT = float(1 << 52)

col = F.col


def words(text: str = "text") -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(col(text), F.lit(WORDS)), F.lit(0)).cast("long")


def symbol_weight(text: str = "text") -> Column:
    """Quality weight from the share of symbols: 1 without any, never below 0.05."""
    symbols = F.length(text) - F.length(F.translate(col(text), "#*$%&|<>!", ""))
    share = F.coalesce(F.try_divide(symbols, F.length(text)), F.lit(0.0))
    return F.greatest(F.lit(0.05), F.lit(1.0) - F.lit(4.0) * share)


def uniform(key: Column) -> Column:
    """A number in [0, 1) from the md5 of the key: the same in every run and every engine."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(_UNIT)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """Sources with ``source_size`` to their ``target``; ``sizes`` has one row per source.

    Sources by code point, null last, weigh ``weights`` in turn and share the sum of all sizes. What
    a source cannot take beyond ``most`` times its size goes to the others by weight, until none is
    above. With sources in order of what they can take per weight, that is: fill them one by one; what
    is left per weight of the others rises until the first that can take its share, and falls from
    there on, so the highest value is the level of all that are not full. The windows run over one row
    per source.
    """
    turn = (F.row_number().over(Window.orderBy(col("source").asc_nulls_last())) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1)
    can_take = (col("source_size") * most).cast("double")
    per_weight = Window.orderBy(col("cap") / col("weight"), col("source").asc_nulls_last())
    before = per_weight.rowsBetween(Window.unboundedPreceding, -1)
    after = per_weight.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    all_rows = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum(col("source_size").cast("double")).over(all_rows)
    level = (col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    return (sizes.withColumn("weight", weight).withColumn("cap", can_take).withColumn("total", total)
            .withColumn("level", level)
            .withColumn("level", F.max("level").over(all_rows))
            .select("source", "source_size", F.least(col("cap"), col("level") * col("weight")).alias("target")))


def _below(rows: DataFrame, by: list[str], level: str) -> DataFrame:
    """Per group of ``by``, the bucket of ``level`` that holds the cut and the sum before it."""
    run = Window.partitionBy(*by).orderBy(level)
    sums = (rows.groupBy(*by, level, "rest").agg(F.sum("size").alias("in_bucket"))
            .withColumn("upto", F.sum("in_bucket").over(run)))
    cut = col("upto") >= col("rest")
    return (sums.groupBy(*by).agg(
        F.min(F.when(cut, col(level))).alias(f"cut_{level}"),
        F.coalesce(F.max(F.when(~cut, col("upto"))), F.lit(0)).alias(f"before_{level}")))


def mix(df: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source",
        weight: Column | None = None, weights: tuple[int, ...] = WEIGHTS,
        most: int = MOST_EPOCHS, carried: tuple[str, ...] = ()) -> DataFrame:
    """(id, source, size, source_size, target, taken, epochs, extra) for every row of ``df``.

    Columns named in ``carried`` come along.
    ``taken`` are the words the mix takes of the row: its size times ``epochs`` complete passes, once
    more if ``extra``. The row on the cut is taken if that brings the source nearer to its target.
    Null and empty texts have size 0 and are taken 0 times; sources of size 0 have target 0; an empty
    table gives no rows. Rows with equal keys (repeated rows) come in order of id and size; equal
    rows may stand for each other. Other columns of ``df`` do not matter.
    """
    weight = symbol_weight(text) if weight is None else weight
    rows = df.select(col(f"`{id}`").alias("id"), col(f"`{source}`").alias("source"), words(text).alias("size"),
                     (-F.log(F.lit(1.0) - uniform(col(f"`{id}`"))) / weight).alias("key"),
                     *[col(f"`{c}`") for c in carried])
    # Keys of weight 1 fall evenly into (0, 1); of lower weights, more towards 1.
    place = F.lit(1.0) - F.exp(-col("key"))
    fine = F.least(F.floor(place * BUCKETS * BUCKETS), F.lit(BUCKETS * BUCKETS - 1)).cast("long")
    rows = keep(rows.withColumn("fine", fine).withColumn("b1", F.floor(col("fine") / BUCKETS))
                .withColumn("b2", col("fine") % BUCKETS).drop("fine")
                # Nulls join and group like any other source.
                .withColumn("source_key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("null"))))
    sizes = rows.groupBy("source_key", "source").agg(F.sum("size").alias("source_size"))
    aims = (targets(sizes.select("source", "source_size"), weights, most)
            .withColumn("source_key", F.coalesce(F.concat(F.lit("="), "source"), F.lit("null"))).drop("source")
            .withColumn("epochs", F.least(F.lit(most), F.coalesce(F.floor(
                F.try_divide("target", "source_size")), F.lit(0))).cast("long"))
            .withColumn("rest", F.greatest(col("target") - col("epochs") * col("source_size"), F.lit(0.0))))
    aims = keep(aims)
    first = _below(rows.join(aims, "source_key"), ["source_key"], "b1")
    found = keep(aims.join(first, "source_key", "left"))
    on_cut = (rows.join(found, "source_key").filter(col("b1") == col("cut_b1"))
              .withColumn("rest", col("rest") - col("before_b1")))
    second = _below(on_cut, ["source_key"], "b2")
    cuts = keep(found.join(second, "source_key", "left"))
    placed = rows.join(cuts, "source_key")
    # No bucket on the cut: the rest exceeds all sizes and every row below is taken once more.
    later = (col("b1") > col("cut_b1")) | ((col("b1") == col("cut_b1")) & (col("b2") > col("cut_b2")))
    at_cut = (col("b1") == col("cut_b1")) & (col("b2") == col("cut_b2"))
    run = (Window.partitionBy("source_key").orderBy("key", "id", "size")
           .rowsBetween(Window.unboundedPreceding, -1))
    so_far = col("before_b1") + col("before_b2") + F.coalesce(F.sum("size").over(run), F.lit(0))
    sharp = (placed.filter(F.coalesce(at_cut, F.lit(False)))
             .withColumn("extra", 2 * so_far + col("size") <= 2 * col("rest")))
    clear = (placed.filter(~F.coalesce(at_cut, F.lit(False)))
             .withColumn("extra", ~F.coalesce(later, F.lit(False)) & (col("rest") > 0)))
    taken = col("size") * (col("epochs") + col("extra").cast("long"))
    return clear.unionByName(sharp).select(
        col("id").alias(id), col("source").alias(source), "size", "source_size", "target",
        taken.alias("taken"), "epochs", "extra", *carried)


def mixed(df: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source",
          **options) -> DataFrame:
    """The rows of ``df`` as often as the mix takes them, with their columns unchanged.

    Rows of size 0 go. Equal rows share what the mix takes of them, the first ones once more.
    """
    row = F.xxhash64(*[col(c) for c in (id, text, source)])
    taken = (mix(df.withColumn("__row", row), id, text, source, carried=("__row",), **options)
             .groupBy("__row").agg(
                 F.sum(F.when(col("size") > 0, col("epochs") + col("extra").cast("long"))).alias("__all"),
                 F.count("*").alias("__equal")))
    nth = F.row_number().over(Window.partitionBy("__row").orderBy("__row"))
    times = F.floor(col("__all") / col("__equal")) + (col("__nth") <= col("__all") % col("__equal")).cast("long")
    return (df.withColumn("__row", row).join(taken, "__row").withColumn("__nth", nth)
            .withColumn("__times", times.cast("int")).filter(col("__times") > 0)
            .withColumn("__copy", F.explode(F.sequence(F.lit(1), col("__times"))))
            .select(*[col(f"`{c}`") for c in df.columns]))
