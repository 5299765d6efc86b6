"""Mixing sources to target weights by pivotal dependent rounding.

A source whose target is r times its size takes each of its documents r times on average: the whole part for certain, the
fraction at random. The fractions of two documents are settled together: words move from one to the other, in a random
direction that keeps both expectations, until one of the two is taken fully or not at all. The other one is the residual
that meets the next document, so the words that the source takes never drift from its target. Blocks of documents are
settled side by side, their residuals are blocked again, and so on in a tree until a source has one residual left.

All of it is DataFrame functions: blocks are short arrays, folded with `aggregate`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reclink.llm.common import WORD
from reclink.session import cut

# Weights of the sources in their order, repeating; the share of all words that is taken; the most copies of a document.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2

# Documents or residuals that are settled in one fold, on average.
BLOCK = 64


def item_size() -> Column:
    """Words of the text; a null text has none."""
    return F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")


def items(docs: DataFrame) -> DataFrame:
    """(doc_id, source, key, size, rows): equal rows are one item; only a fraction of one of them is settled."""
    read = docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), F.xxhash64("text").alias("key"), item_size().alias("size")
    )
    return read.groupBy("doc_id", "source", "key", "size").agg(F.count("*").alias("rows"))


def targets(found: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, n_open, target) of each source; n_open rows have words.

    Sources in the order of their code points, null last, take the weights in turn. Sources that their weight would lift
    above `most` times their size stop there, and the rest is shared among the others by weight. In the order of size by
    weight, the stopped sources come first, so running sums find them without repetition. The windows run over one row of
    each source, never over documents.
    """
    sized = F.col("size") * F.col("rows")
    totals = found.groupBy("source").agg(
        F.sum(sized).alias("source_size"),
        F.sum(F.when(sized > 0, F.col("rows")).otherwise(0)).alias("n_open"),
    )
    listed = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(listed) - 1) % len(weights) + 1
    weighed = totals.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn))
    weighed = weighed.withColumn("cap", F.col("source_size") * float(most))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.partitionBy()
    total = F.sum("source_size").over(whole) * float(share)
    left = total - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    marked = weighed.withColumn("stopped", F.col("cap") * F.sum("weight").over(after) <= left * F.col("weight"))
    marked = marked.withColumn("total", total)
    used = F.coalesce(F.sum(F.when(F.col("stopped"), F.col("cap"))).over(whole), F.lit(0.0))
    free = F.sum(F.when(~F.col("stopped"), F.col("weight"))).over(whole)
    target = F.when(F.col("stopped"), F.col("cap")).otherwise(
        F.least("cap", (F.col("total") - used) * F.col("weight") / free)
    )
    return marked.select("source", "source_size", "n_open", target.alias("target"))


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) that the parts decide."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 53)).cast("double") / float(1 << 53)


# Of the rows of an item, `certain` take one copy more than the others whatever is drawn.
IDENTITY = ["doc_id", "key", "size", "rows", "certain"]


def _settle(block: Column) -> Column:
    """Fold a block of items (place, u, identity, full, mass) into (carry, done): done items with the copies they take.

    carry and next hold `mass` of their `full` words. The carry gains a, the most that the next one can give and it can
    take, or loses b, the most the other way round; it gains with probability b / (a + b), which keeps both expectations.
    Either way one of the two ends at zero or at its full size and is done; the other one is the carry.
    """
    def merge(state: Column, nxt: Column) -> Column:
        carry = state["carry"]
        a = F.least(carry["full"] - carry["mass"], nxt["mass"])
        b = F.least(carry["mass"], nxt["full"] - nxt["mass"])
        gains = nxt["u"] * (a + b) < b
        carry_done = F.when(gains, carry["full"] - carry["mass"] <= nxt["mass"]).otherwise(
            carry["mass"] <= nxt["full"] - nxt["mass"]
        )
        # A carry that is done is full if it gained; a next one that is done is full if the carry lost.
        taken = (carry_done == gains).cast("int")
        ended = F.when(carry_done, carry).otherwise(nxt)
        stays = F.when(carry_done, nxt).otherwise(carry)
        mass = F.when(
            carry_done, F.when(gains, nxt["mass"] - a).otherwise(nxt["mass"] + b)
        ).otherwise(F.when(gains, carry["mass"] + a).otherwise(carry["mass"] - b))
        moved = stays.withField("mass", mass)
        record = F.struct(*[ended[c].alias(c) for c in IDENTITY], taken.alias("taken"))
        return F.struct(moved.alias("carry"), F.concat(state["done"], F.array(record)).alias("done"))

    first = F.element_at(block, 1)
    none = F.filter(
        F.array(F.struct(*[first[c].alias(c) for c in IDENTITY], F.lit(0).alias("taken"))), lambda x: F.lit(False)
    )
    rest = F.slice(block, 2, F.greatest(F.size(block) - 1, F.lit(0)))
    return F.aggregate(rest, F.struct(first.alias("carry"), none.alias("done")), merge)


def _tree(open_items: DataFrame, most: int, seed: int, block: int) -> tuple[list[DataFrame], DataFrame]:
    """Settle (source, n, item) rows, n items of a source, until each source has one: (done rows, residuals).

    A level takes the items of a source in about n / block blocks, chosen by hash, so a source of any size is many short
    groups. Each level is written out before the next one reads it. The items of a block come in the order of one hash, and
    another one decides.
    """
    done = []
    level = 0
    while True:
        parts = F.greatest(F.ceil(F.col("n") / block), F.lit(1)).cast("long")
        salt = F.lit(seed * 100 + level)
        spot = F.xxhash64("item.doc_id", "item.key", "item.size", salt)
        drawn = F.struct(
            F.xxhash64("item.doc_id", "item.key", "item.size", F.lit(seed * 100 + 25 + level)).alias("place"),
            _uniform(F.col("item.doc_id"), F.col("item.key"), F.col("item.size"), F.lit(seed * 100 + 50 + level)).alias("u"),
            *[F.col(f"item.{c}") for c in [*IDENTITY, "full", "mass"]],
        )
        grouped = (
            open_items.select("source", "n", F.pmod(spot, parts).alias("part"), drawn.alias("item"))
            .groupBy("source", "n", "part")
            .agg(F.array_sort(F.collect_list("item")).alias("block"))
        )
        settled = cut(grouped.select("source", "n", _settle(F.col("block")).alias("s")), f"mix-{seed}-{level}")
        done.append(settled.select("source", F.explode("s.done").alias("d")).select("source", "d.*"))
        open_items = settled.select("source", F.ceil(F.col("n") / block).cast("long").alias("n"), F.col("s.carry").alias("item"))
        if most <= 1 or -(-most // block) <= 1:
            return done, open_items
        most = -(-most // block)
        level += 1


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = 1, block: int = BLOCK) -> DataFrame:
    """Copies of each row: (doc_id, source, key, size, rows, source_size, target, copies), rows equal ones with so many copies.

    Sources share `share` of all words by weight, at most `most` times their size each (see targets). Every document is
    taken floor(r) or floor(r) + 1 times, r its source's target by size, r times on average. The sum of the words that a
    source takes is kept through every step. Documents longer than the mean of their source are settled first; the last
    one left is taken or not at random, and the words by which that misses are spread over the shorter documents before
    these are settled, so a source ends within about one short document of its target, as long as its short documents can
    take up the miss. Hashes of the rows stand for random numbers: reruns agree, whatever the partitions.

    Edge cases: a null text has no words, and a document without words takes nothing (copies are floor(r)). A null source
    is a source, which comes last. Null ids are ids. Of n equal rows (id, source, text) floor(n * r) copies are certain and
    the fraction of one row is settled, so their copies differ by one at most. If all texts are empty, all targets are 0. Other columns are not read; an empty table gives an empty result.
    """
    found = cut(items(docs), "items")
    sources = cut(targets(found, weights, share, most), "sources")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rated = sources.select(
        F.col("source").alias("_source"),
        "source_size",
        "target",
        F.floor(ratio).cast("int").alias("whole"),
        (ratio - F.floor(ratio)).alias("part"),
        (F.col("source_size") / F.greatest("n_open", F.lit(1))).alias("mean"),
    )
    placed = found.join(rated, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    full = F.col("size").cast("double")
    is_open = (full > 0) & (F.col("part") > 0)
    long = is_open & (full > F.col("mean"))
    short = is_open & ~long

    counted = cut(
        placed.groupBy("source").agg(
            F.sum(long.cast("long")).alias("n_long"),
            F.sum(short.cast("long")).alias("n_short"),
            F.sum(F.when(short, full * F.col("rows"))).alias("short_words"),
        ),
        "classes",
    )
    largest = counted.agg(F.max("n_long"), F.max("n_short")).first()

    def opened(kind: Column, count: str, chance: Column, extra: DataFrame) -> DataFrame:
        """One row of each item with what the certain ones leave of the item's words."""
        joined = placed.where(kind).join(extra.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")))
        joined = joined.withColumn("due", F.col("rows") * chance)
        joined = joined.withColumn("certain", F.least(F.floor("due"), F.col("rows") - 1).cast("long"))
        item = F.struct(*IDENTITY, full.alias("full"), (full * (F.col("due") - F.col("certain"))).alias("mass"))
        return joined.select("source", F.col(count).alias("n"), item.alias("item"))

    def rounded(residual: DataFrame, salt: int) -> DataFrame:
        u = _uniform(F.col("item.doc_id"), F.col("item.key"), F.col("item.size"), F.lit(seed * 1000 + salt))
        taken = (u * F.col("item.full") < F.col("item.mass")).cast("int")
        return residual.select("source", *[F.col(f"item.{c}").alias(c) for c in IDENTITY], taken.alias("taken"), "item.full", "item.mass")

    done, residual = _tree(opened(long, "n_long", F.col("part"), counted), largest[0] or 0, 2 * seed, block)
    ends = cut(rounded(residual, 1), "mix-long")
    done.append(ends.drop("full", "mass"))
    missed = ends.select("source", (F.col("mass") - F.col("taken") * F.col("full")).alias("missed")).withColumnRenamed("source", "_miss")
    shifted = counted.join(missed, F.col("source").eqNullSafe(F.col("_miss")), "left").select(
        "source", "n_short", (F.coalesce("missed", F.lit(0.0)) / F.greatest("short_words", F.lit(1.0))).alias("shift")
    )
    chance = F.least(F.greatest(F.col("part") + F.col("shift"), F.lit(0.0)), F.lit(1.0))
    more, residual = _tree(opened(short, "n_short", chance, cut(shifted, "shifted")), largest[1] or 0, 2 * seed + 1, block)
    done += [*more, rounded(residual, 2).drop("full", "mass")]

    settled = done[0]
    for other in done[1:]:
        settled = settled.unionByName(other)
    rest = placed.where(~is_open | is_open.isNull()).withColumn("certain", F.lit(0).cast("long"))
    every = settled.unionByName(rest.select("source", *IDENTITY, F.lit(0).alias("taken")))
    more = F.col("certain") + F.col("taken")
    kinds = F.array(
        F.struct(more.alias("rows"), (F.col("whole") + 1).alias("copies")),
        F.struct((F.col("rows") - more).alias("rows"), F.col("whole").alias("copies")),
    )
    split = every.join(rated.drop("mean", "part"), F.col("source").eqNullSafe(F.col("_source"))).withColumn("kind", F.explode(kinds))
    return split.where("kind.rows > 0").select(
        "doc_id", "source", "key", "size", "kind.rows", "source_size", "target", "kind.copies"
    )


def mixed_sizes(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of every row of docs: taken words count repeats. See mix."""
    found = mix(docs, **options)
    every = found.select("*", F.explode(F.array_repeat(F.lit(1), F.col("rows").cast("int"))))
    return every.select("doc_id", "source", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of docs, each as often as it is taken, with all their columns. See mix.

    Where equal rows take different copies, rows that agree in all columns are counted first, and the counts are dealt out
    in the order of the columns, so a row that is repeated very often is never gathered in one task.
    """
    found = cut(mix(docs, **options), "mixed")
    found = found.groupBy("doc_id", "source", "key").agg(
        F.min("copies").cast("int").alias("__copies"),
        F.when(F.min("copies") < F.max("copies"), F.max_by("rows", "copies")).otherwise(F.lit(0)).alias("__more"),
    )
    found = found.where("__copies > 0 or __more > 0").select(
        F.col("doc_id").alias("__doc"), F.col("source").alias("__source"), F.col("key").alias("__key"), "__copies", "__more"
    )
    same = (
        F.col("doc_id").eqNullSafe(F.col("__doc"))
        & F.col("source").cast("string").eqNullSafe(F.col("__source"))
        & (F.xxhash64("text") == F.col("__key"))
    )

    def repeated(rows: DataFrame, copies: Column) -> DataFrame:
        return rows.withColumn("__copy", F.explode(F.array_repeat(F.lit(1), copies.cast("int")))).select(*docs.columns)

    alike = docs.join(found.where("__more = 0"), same)
    counted = docs.join(found.where("__more > 0"), same).groupBy(*docs.columns, "__source", "__key", "__copies", "__more").agg(
        F.count("*").alias("__rows")
    )
    order = Window.partitionBy("doc_id", "__source", "__key").orderBy(*docs.columns)
    before = F.coalesce(F.sum("__rows").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    more = F.least(F.greatest(F.col("__more") - F.col("__before"), F.lit(0)), F.col("__rows"))
    unlike = counted.withColumn("__before", before)
    return repeated(alike, F.col("__copies")).unionByName(repeated(unlike, F.col("__copies") * F.col("__rows") + more))
