"""Mix sources to target weights by Sainte-Laguë apportionment of token blocks.

The whole of all sizes is cut into equal blocks. Blocks go to the sources one by
one, each to the source with the highest quotient weight / (2 k - 1) for its k-th
block, as long as the source's cap allows; a divisor search finds that result
without dealing out blocks singly. A source is split into shards by a seeded hash
of its documents, and its blocks into integer quotas per shard. Within a shard
the documents stand in seeded order on a circle of words; the quota's blocks are
taken from a seeded place onwards, so documents are taken whole but for those at
the two ends, and nothing more than ``cap`` times.

Sources are ordered by code point, null last, and weigh 1, 2, 3, repeating.
Documents without words (null or empty texts) have size and taken 0. Equal rows
count one by one. The same input and seed give the same result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ferrylog.llm.common import fresh, numbered, text_of, words_of
from ferrylog.session import written

WEIGHTS = (1, 2, 3)
#: No source or document is taken more often.
CAP = 3
#: Words of a block, at most; smaller when sources are small.
BLOCK_WORDS = 1_024
#: Words of a shard, about.
SHARD_WORDS = 4_000_000
SEED = 20_240_607
#: Divisors tried in one job.
TRIES = 48


def word_count(text: str = "text"):
    return F.size(words_of(text_of(text))).cast("long")


def weighed_sources(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """source, source_size, rank and weight of every source."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = numbered(totals, "rank", F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in weights])
    return ranked.withColumn("weight", F.get(cycle, (F.col("rank") % len(weights)).cast("int")))


def share(sources: DataFrame, cap: int = CAP) -> float:
    """Words per unit of weight once the excess over the caps is reshared."""
    whole, weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    if not whole:
        return 0.0
    each, capped = whole / weight, 0
    while True:
        above = cap * F.col("source_size") < F.lit(each) * F.col("weight")
        used, left, n = sources.agg(
            F.coalesce(F.sum(F.when(above, cap * F.col("source_size"))), F.lit(0)),
            F.sum(F.when(~above, F.col("weight"))),
            F.count_if(above),
        ).first()
        if n == capped or not left:
            return each
        each, capped = (whole - used) / left, n


def apportion(sources: DataFrame, seats: int) -> DataFrame:
    """``sources`` (weight, most, rank) with the seats that highest quotients give.

    With divisor d a source has round(weight / d) seats. Each job counts the seats
    of many divisors and narrows their range; what the last two divisors leave
    open goes to the highest remaining quotients, ties to the lower rank.
    """

    def at(d: float):
        return F.least(F.col("most"), F.floor(F.col("weight") / F.lit(d) + 0.5).cast("long"))

    n, weight, most, top = sources.agg(
        F.count(F.lit(1)), F.sum("weight"), F.sum("most"), F.max("weight")
    ).first()
    if not n or seats <= 0:
        return sources.withColumn("seats", F.lit(0).cast("long"))
    if most <= seats:
        return sources.withColumn("seats", F.col("most"))
    high = 2.0 * top + 1.0
    low = weight / (2.0 * seats + n) / 2.0
    low_seats, high_seats = None, 0
    while low_seats is None or low_seats < seats:
        low_seats = sources.agg(F.sum(at(low))).first()[0]
        if low_seats < seats:
            high, high_seats, low = low, low_seats, low / 4
    for _ in range(12):
        if low_seats - high_seats <= 2 * n or low_seats == seats:
            break
        grow = (high / low) ** (1 / (TRIES + 1))
        tried = [low * grow ** (k + 1) for k in range(TRIES)]
        found = sources.agg(*[F.sum(at(d)).alias(f"d{k}") for k, d in enumerate(tried)]).first()
        for d, s in zip(tried, found, strict=True):
            if s >= seats and d > low:
                low, low_seats = d, s
            elif s < seats and d < high:
                high, high_seats = d, s
                break
    if low_seats == seats:
        return sources.withColumn("seats", at(low))
    more = sources.filter(at(low) > at(high)).select(
        "rank", "weight", F.explode(F.sequence(at(high) + 1, at(low))).alias("k")
    )
    open_seats = (
        more.withColumn("quotient", F.col("weight") / (2 * F.col("k") - 1))
        .orderBy(F.col("quotient").desc(), "rank", "k")
        .limit(seats - high_seats)
        .groupBy("rank")
        .agg(F.count(F.lit(1)).alias("more"))
    )
    return (
        sources.withColumn("seats", at(high))
        .join(open_seats, "rank", "left")
        .withColumn("seats", F.col("seats") + F.coalesce("more", F.lit(0)))
        .drop("more")
    )


def mixed(
    docs: DataFrame,
    seed: int = SEED,
    cap: int = CAP,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """``docs`` (doc_id, source, text and others) with a struct ``mix``.

    It holds size, source_size, target and taken; its name gets underscores where
    ``docs`` has a column of that name.
    """
    size, order, out = fresh(docs, "_size", "_order", "mix")
    rows = docs.withColumn(size, word_count())
    key = F.xxhash64(F.lit(seed), F.col("doc_id"), text_of())
    rows = rows.withColumn(order, key)
    sizes = written(
        rows.select("source", F.col(size).alias("size"), F.col(order).alias("order")), "sizes"
    )
    sources = written(weighed_sources(sizes), "sources")
    each = share(sources, cap)
    whole, n, least = sources.agg(
        F.coalesce(F.sum("source_size"), F.lit(0)),
        F.count(F.lit(1)),
        F.min(F.when(F.col("source_size") > 0, F.col("source_size"))),
    ).first()
    block = max(1, min(block_words, whole // max(1, 1000 * n), (least or 1) // 16))
    capped = sources.withColumn("most", F.floor(cap * F.col("source_size") / block).cast("long"))
    quotas = apportion(capped, round(whole / block)).select(
        "source",
        "rank",
        "source_size",
        F.least(cap * F.col("source_size").cast("double"), F.lit(each) * F.col("weight")).alias("target"),
        F.col("seats"),
        F.ceil(F.col("source_size") / shard_words).cast("long").alias("shards"),
    )
    quotas = written(quotas, "quotas")

    def placed(df: DataFrame, order_col: str) -> DataFrame:
        """With the source's quota and the document's shard; sources match null to null."""
        named = quotas.withColumnRenamed("source", "_src")
        found = df.join(named, F.col("source").eqNullSafe(F.col("_src"))).drop("_src")
        return found.withColumn(
            "shard", F.pmod(F.col(order_col), F.greatest(F.col("shards"), F.lit(1)))
        )

    spans = placed(sizes, "order").groupBy("rank", "shard", "seats", "source_size").agg(
        F.sum("size").alias("shard_size")
    )
    upto = Window.partitionBy("rank").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    share_of = F.col("seats") / F.greatest(F.col("source_size"), F.lit(1))
    spans = (
        spans.withColumn("_upto", F.sum("shard_size").over(upto))
        .withColumn("_to", F.floor(F.col("_upto") * share_of + 0.5))
        .withColumn("_from", F.floor((F.col("_upto") - F.col("shard_size")) * share_of + 0.5))
        .withColumn("_words", (F.col("_to") - F.col("_from")) * block)
        .withColumn("words", F.least(F.col("_words"), cap * F.col("shard_size")).cast("long"))
    )
    spans = written(
        spans.select(
            "rank",
            "shard",
            "shard_size",
            "words",
            F.when(
                F.col("shard_size") > 0,
                F.pmod(F.xxhash64(F.lit(seed), "rank", "shard"), F.col("shard_size")),
            )
            .otherwise(0)
            .alias("offset"),
        ),
        "shards",
    )

    extra = {"rank", "shard", "seats", "shards", "shard_size", "words", "offset", "target", "source_size"}
    own = {c: fresh(docs, f"_own_{c}")[0] for c in docs.columns if c in extra}
    rows = rows.withColumnsRenamed(own)
    full = placed(rows, order).join(spans, ["rank", "shard"])
    line = Window.partitionBy("rank", "shard").orderBy(order, "doc_id", size)
    ahead = line.rowsBetween(Window.unboundedPreceding, -1)
    z, total = F.col(size), F.greatest(F.col("shard_size"), F.lit(1))
    start = F.coalesce(F.sum(size).over(ahead), F.lit(0))
    full = full.withColumn("_p", F.pmod(start - F.col("offset"), total))
    rounds, rest = F.floor(F.col("words") / total), F.col("words") % total
    p = F.col("_p")
    taken = (
        rounds * z
        + F.greatest(F.lit(0), F.least(p + z, rest) - p)
        + F.greatest(F.lit(0), F.least(p + z - total, rest))
    ).cast("long")
    mix = F.struct(z.alias("size"), "source_size", "target", taken.alias("taken"))
    return full.select(*[F.col(own.get(c, c)).alias(c) for c in docs.columns], mix.alias(out))


def mix_table(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """Per document its size, its source's size and target, and the words taken of it."""
    rows = mixed(docs.select("doc_id", "source", "text"), seed)
    return rows.select("doc_id", "mix.size", "mix.source_size", "mix.target", "mix.taken")


def mix_documents(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix as whole documents: each as often as the nearest number of rounds taken."""
    mix, copy = fresh(docs, "mix", "_copy")
    rows = mixed(docs, seed)
    size = F.greatest(F.col(f"{mix}.size"), F.lit(1))
    times = F.floor(F.col(f"{mix}.taken") / size + 0.5).cast("int")
    copies = rows.withColumn(copy, F.explode(F.array_repeat(F.lit(1), times)))
    return copies.select(*docs.columns)
