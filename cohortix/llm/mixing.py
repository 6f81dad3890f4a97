"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import hash_bucket, running_sums, size_buckets, stored, text_of, unit_hash, words


def source_targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), total_share: float = 1.5,
                   max_repeat: int = 2) -> DataFrame:
    """Target tokens of each source from (_none, _src, source_size).

    Sources in code point order, null last, get the weights in turn and share
    ``total_share`` of all tokens; no target exceeds ``max_repeat`` times its
    source, and what is above goes to the others by weight until none is
    above: in the order of size per weight, the sources before some point are
    at their limit and the rest share the remainder at one rate. The windows
    run over one row per source.
    """
    every = Window.partitionBy(F.lit(0))
    ranked = sizes.withColumn("_i", F.row_number().over(every.orderBy("_none", "_src")) - 1)
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (F.col("_i") % len(weights) + 1).cast("int"))
    t = ranked.withColumn("_w", w).withColumn("_cap", max_repeat * F.col("source_size"))
    order = every.orderBy(F.col("_cap") / F.col("_w"), "_i")
    t = t.select(
        "*",
        F.sum("source_size").over(every).alias("_all"),
        F.coalesce(F.sum("_cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_full"),
        F.sum("_w").over(order.rowsBetween(0, Window.unboundedFollowing)).alias("_left"),
        F.row_number().over(order).alias("_j"))
    rate = (F.lit(float(total_share)) * F.col("_all") - F.col("_full")) / F.col("_left")
    t = t.withColumn("_rate", rate)
    fits = F.col("_cap") / F.col("_w") >= F.col("_rate")
    t = t.withColumn("_k", F.min(F.when(fits, F.col("_j"))).over(every))
    t = t.withColumn("_r", F.max(F.when(F.col("_j") == F.col("_k"), F.col("_rate"))).over(every))
    target = F.when(F.col("_j") < F.coalesce(F.col("_k"), F.col("_j") + 1), F.col("_cap").cast("double")).otherwise(
        F.least(F.col("_r") * F.col("_w"), F.col("_cap").cast("double")))
    return t.select("_none", "_src", "source_size", "_i", target.alias("target"))


def apportion(targets: DataFrame, block: int, n_shards: int, max_repeat: int = 2) -> DataFrame:
    """Blocks of each source in each shard: (_none, _src, shard, quota, first_seat, blocks).

    Seat after seat goes to the source with the highest quotient
    target / (2 k + 1) for its k seats so far (Sainte-Lague), ties to the
    earlier source, until the targets' sum is filled; shard j holds the seats
    from j / n to (j + 1) / n of them, so its integer quotas follow the
    targets as well. A source has ``max_repeat`` times its blocks at most, and no target
    may be above ``max_repeat`` times its source (as :func:`source_targets` has it).

    No seat is dealt singly: all quotients down to a divisor that surely
    leaves seats over are counted at once, and only the few after it (about
    two per source) are ranked.
    """
    cap = max_repeat * F.ceil(F.col("source_size") / F.lit(int(block)))
    t = targets.where("target > 0").withColumn("_cap", cap.cast("bigint"))
    total = t.agg(F.sum("target").alias("_sum"), F.count(F.lit(1)).alias("_S"))
    cuts = total.select("*", F.explode(F.sequence(F.lit(1), F.lit(int(n_shards)))).alias("_end")).withColumn(
        "_seats", F.round(F.col("_sum") / F.lit(int(block)) * F.col("_end") / n_shards).cast("bigint"))
    # one row of totals, n_shards cuts: the table of cuts has n_shards rows
    x = t.crossJoin(F.broadcast(cuts))
    sure = F.col("_seats") - F.col("_S") / 2
    q0 = F.when(sure > 0, F.floor(F.col("target") * sure / F.col("_sum") + 0.5)).otherwise(0)
    x = x.withColumn("_q0", F.least(q0.cast("bigint"), F.col("_cap")))
    per = Window.partitionBy("_end")
    x = x.withColumn("_open", F.col("_seats") - F.sum("_q0").over(per))
    more = F.ceil((F.col("_open") + 2 * F.col("_S")) * F.col("target") / F.col("_sum")) + 2
    top = F.least(F.col("_q0") + more.cast("bigint"), F.col("_cap"))
    ks = F.when(top > F.col("_q0"), F.sequence(F.col("_q0"), top - 1)).otherwise(F.array().cast("array<bigint>"))
    c = x.select("_end", "_none", "_src", "_i", "target", "_open", F.explode(ks).alias("_k"))
    c = c.withColumn("_n", F.row_number().over(per.orderBy(
        (F.col("target") / (2 * F.col("_k") + 1)).desc(), "_i")))
    extra = c.where("_n <= _open").groupBy("_end", "_none", "_src").agg(F.count(F.lit(1)).alias("_x"))
    seats = x.join(extra, ["_end", "_none", "_src"], "left").select(
        "_none", "_src", "_end", "_cap", (F.col("_q0") + F.coalesce(F.col("_x"), F.lit(0))).alias("_to"))
    earlier = Window.partitionBy("_none", "_src").orderBy("_end")
    seats = seats.withColumn("first_seat", F.coalesce(F.lag("_to").over(earlier), F.lit(0)))
    return seats.select(
        "_none", "_src", (F.col("_end") - 1).alias("shard"), (F.col("_to") - F.col("first_seat")).alias("quota"),
        "first_seat", (F.col("_cap") / max_repeat).cast("bigint").alias("blocks"))


def mix(df: DataFrame, block: int = 64, n_shards: int = 8, seed: int = 42, weights: Sequence[int] = (5, 2, 1),
        total_share: float = 1.5, max_repeat: int = 2, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """(documents with the words the mix takes of them, quotas by shard and source).

    The documents of a source, in a seeded order, form one stream of words,
    cut into blocks of ``block`` words. The seats of a source go to its blocks
    from a seeded first block on, round after round, each shard selecting the
    blocks of its own seats, so every document is taken ``max_repeat`` times
    at most and only the documents at the ends of a shard's run are cut.

    Documents: doc_id, source, size (words), source_size, target (double),
    by_shard (shard, words: what each shard's quota selects of it), taken
    (their sum), rounds (how many rounds take a word of it), th (64-bit hash
    of the text). Null text: size 0,
    taken 0. Null source: a source of its own, weighed last. Repeated rows
    are documents of their own; rows that are equal in id and size are
    interchangeable. Empty table: no rows.

    Scale: one pass over the texts stores (id, source, size); the running
    sums rank rows in (source, bucket) groups of about sqrt(n) rows; quotas
    come from one row per source and travel with the bucket starts.
    """
    base = df.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        F.col(source_col).isNull().alias("_none"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("_src"),
        F.size(words(text_of(text_col))).cast("bigint").alias("size"),
        F.xxhash64(text_of(text_col)).alias("th"),
        unit_hash(F.lit(seed), F.col(id_col), F.md5(text_of(text_col))).alias("_h"))
    base = stored(base, "sizes")
    base = base.withColumn("_b", hash_bucket(F.col("_h"), size_buckets(base.count())))
    keys = ["_none", "_src"]
    targets = source_targets(base.groupBy(*keys).agg(F.sum("size").alias("source_size")), weights, total_share,
                             max_repeat)
    quotas = apportion(targets, block, n_shards, max_repeat)
    held = quotas.groupBy(*keys).agg(F.max("blocks").alias("_nb"), F.sort_array(F.collect_list(F.struct(
        "shard", F.col("first_seat").alias("a"), (F.col("first_seat") + F.col("quota")).alias("b")))).alias("_cuts"))
    per = targets.join(held, keys, "left").select(
        *keys, "source_size", "target", F.coalesce("_nb", F.lit(1)).alias("_nb"),
        F.coalesce("_cuts", F.array().cast("array<struct<shard:int,a:bigint,b:bigint>>")).alias("_cuts"),
    ).withColumn(
        "_at", F.conv(F.substring(unit_hash(F.lit(seed), F.lit("first"), F.col("_src")), 1, 12), 16, 10).cast("bigint")
        % F.col("_nb"))
    x = running_sums(base, keys, "_b", [F.col("_h"), F.col("size"), F.col("th")], {"_from": "size"}, per_key=per)
    b = F.lit(int(block))

    def within(lo, hi):
        """Words of the document between two places of the stream."""
        return F.greatest(F.lit(0), F.least(F.col("_from") + F.col("size"), hi) - F.greatest(F.col("_from"), lo))

    def rounds_and_rest(seats):
        """Whole rounds of the first ``seats`` seats, and the document's words in the round after them."""
        end = F.col("_at") + seats % F.col("_nb")
        rest = (within(F.col("_at") * b, F.least(end, F.col("_nb")) * b)
                + within(F.lit(0), F.greatest(end - F.col("_nb"), F.lit(0)) * b))
        return F.floor(seats / F.col("_nb")).cast("bigint"), rest

    def words_of(seats):
        full, rest = rounds_and_rest(seats)
        return (full * F.col("size") + rest).cast("bigint")

    cuts = F.transform("_cuts", lambda c: F.struct(
        c["shard"].alias("shard"), (words_of(c["b"]) - words_of(c["a"])).alias("words")))
    x = x.withColumn("by_shard", F.filter(cuts, lambda c: c["words"] > 0))
    seats = F.coalesce(F.get("_cuts", F.size("_cuts") - 1)["b"], F.lit(0).cast("bigint"))
    full, last = rounds_and_rest(seats)
    rounds = F.when(F.col("size") > 0, full + (last > 0).cast("int")).otherwise(0)
    docs = x.select(
        "doc_id", "source", "size", "source_size", "target",
        F.aggregate("by_shard", F.lit(0).cast("bigint"), lambda t, c: t + c["words"]).alias("taken"),
        rounds.cast("int").alias("rounds"), "by_shard", "th")
    named = quotas.select(F.when(~F.col("_none"), F.col("_src")).alias("source"), "shard", "quota", "first_seat")
    return docs, named


def mixed_rows(df: DataFrame, **options) -> DataFrame:
    """The rows of ``df`` as the mix has them: each as often as rounds take words of it.

    Documents stay whole, also those at the ends of a source's last round.
    Rows that are equal in id and text share the sum of their rounds.
    """
    docs, _ = mix(df, **options)
    often = docs.groupBy(F.col("doc_id").alias("_id"), F.col("th").alias("_th")).agg(
        F.sum("rounds").alias("often")).where("often > 0")
    x = df.select(F.struct(*df.columns).alias("row"), F.col(options.get("id_col", "doc_id")).alias("id"),
                  F.xxhash64(text_of(options.get("text_col", "text"))).alias("th"))
    x = x.join(often, x["id"].eqNullSafe(often["_id"]) & (x["th"] == often["_th"]))
    x = x.dropDuplicates(["id", "th"])
    return x.select("row", F.explode(F.sequence(F.lit(1), F.col("often").cast("int"))).alias("n")).select("row.*")
