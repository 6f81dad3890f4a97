"""Document fingerprints by spot signatures: content words that follow common words."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import hash_bucket, integer_ids, size_buckets, stored, text_of
from .components import components

#: Common words that start a spot (a parameter; four languages).
ANCHORS = (
    "a an and are as at be by for from in is it of on or that the this to was were with "
    "au aux avec dans de des du en est et la le les ou par pas pour que qui sur un une "
    "als auf das dem den der des die ein eine im ist mit nicht sich und von zu "
    "al como con del el es las los no para por se su una y"
).split()
GAP = "[^\\p{L}\\p{N}]+"


def name(*words: Column) -> Column:
    """64-bit name of a chain of words, missing ones left out."""
    return F.substring(F.md5(F.concat_ws(" ", *words)), 1, 16)


def signatures(text: Column | str, df: DataFrame, out: str, anchors: Sequence[str] = ANCHORS,
               chain: int = 3) -> DataFrame:
    """Add ``out``: the sorted set of spot signatures (16 hex digits each) of a text column.

    A spot is an anchor word with the ``chain`` content words after it (fewer
    at the end of the text, at least one); anchors in between are skipped.
    Because every word is an anchor or content, the j-th anchor at place i
    has i - j content words before it, which gives each chain by place.
    A text without spots has the runs of ``chain`` + 1 words instead (or all
    its words), one without words the empty set.
    """
    common = list(dict.fromkeys(anchors))
    w = df.withColumn("_w", F.array_remove(F.split(F.lower(text_of(text)), GAP), ""))
    w = w.withColumn("_a", F.filter(
        F.transform("_w", lambda x, i: F.when(x.isin(common), i)), lambda x: x.isNotNull()))
    w = w.withColumn("_c", F.filter("_w", lambda x: ~x.isin(common)))
    spots = F.filter(
        F.transform("_a", lambda i, j: F.when(
            i - j < F.size("_c"), name(
                F.get(F.col("_w"), i), *[F.get(F.col("_c"), i - j + k) for k in range(chain)]))),
        lambda x: x.isNotNull())
    runs = F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("_w") - chain - 1)),
        lambda i: name(*[F.get(F.col("_w"), i + k) for k in range(chain + 1)]))
    s = w.withColumn("_s", spots).withColumn(out, F.sort_array(F.array_distinct(
        F.when(F.size("_s") > 0, F.col("_s")).when(F.size("_w") > 0, runs).otherwise(
            F.array().cast("array<string>")))))
    return s.drop("_w", "_a", "_c", "_s")


def likeness(a: str, b: str) -> Column:
    """Jaccard likeness of two signature sets; 1 for two empty ones."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either.cast("double"))


def fingerprint(sigs: str) -> Column:
    """The signature set as text: 16 hex digits for each, in order."""
    return F.array_join(sigs, "")


def cut_points(df: DataFrame, col: str, cells: int = 256) -> list:
    """At most ``cells`` + 1 increasing places that split a number column evenly."""
    q = df.agg(F.min(col), F.percentile_approx(col, [i / cells for i in range(1, cells)], 10 * cells),
               F.max(col)).first()
    if q[0] is None:
        return []
    return sorted({q[0], *q[1], q[2] + 1})


def ordered_bucket(col: str, cuts: list, buckets: int) -> Column:
    """Bucket of a number, rising with it: even cells, each cut evenly again."""
    a = F.array(*[F.lit(x).cast("decimal(20,0)") for x in cuts])
    x = F.col(col).cast("decimal(20,0)")
    cell = F.size(F.filter(a, lambda y: y <= x))
    lo, hi = F.element_at(a, cell), F.element_at(a, cell + 1)
    # differences before doubles: neighbouring large numbers are one double
    within = F.least((x - lo).cast("double") / (hi - lo).cast("double"), F.lit(0.999999))
    return F.floor((cell - 1 + within) * F.lit(buckets / max(len(cuts) - 1, 1))).cast("bigint")


def with_next(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, _h, _b, _halo): rows in order buckets, each closed by the next bucket's first row.

    A window over (_b), ordered by (_halo, doc_id, _h), then sees every row's
    successor without sorting the whole table in one task and with one
    shuffle of the texts. Rows without an id come last, in the order of their
    texts' digests, and spread over buckets of their own. The halo rows are
    to be dropped after the window. The table of bucket heads has about
    sqrt(n) rows (64 bytes each: 20 MB for 1e11 documents) and is broadcast.
    """
    docs = df.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("text")).withColumn("_h", F.md5("text"))
    ids = docs.select("doc_id", "_h")
    cuts = cut_points(ids, "doc_id")
    n = ids.count()
    buckets = size_buckets(n)
    nulls = buckets + hash_bucket(F.col("_h"), buckets)
    place = (F.when(F.col("doc_id").isNull(), nulls).otherwise(ordered_bucket("doc_id", cuts, buckets))
             if cuts else nulls)
    heads = ids.select("doc_id", "_h", place.alias("_b")).groupBy("_b").agg(F.min(F.struct("doc_id", "_h")).alias("_first"))
    every = Window.partitionBy(F.lit(0)).orderBy("_b")
    whole = Window.partitionBy(F.lit(0))
    heads = heads.select(
        F.col("_b").alias("_hb"), "_first", F.coalesce(F.lag("_b").over(every), F.max("_b").over(whole)).alias("_to"))
    d = docs.withColumn("_b", place)
    d = d.join(F.broadcast(heads), (F.col("_b") == F.col("_hb")) & (F.col("_h") == F.col("_first._h"))
               & F.col("doc_id").eqNullSafe(F.col("_first.doc_id")), "left")
    own = F.struct(F.col("_b").alias("_b"), F.lit(0).alias("_halo"))
    copy = F.struct(F.col("_to").alias("_b"), F.lit(1).alias("_halo"))
    d = d.select("doc_id", "text", "_h", F.explode(
        F.when(F.col("_to").isNull(), F.array(own)).otherwise(F.array(own, copy))).alias("_x"))
    return d.select("doc_id", "text", "_h", "_x._b", "_x._halo")


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 anchors: Sequence[str] = ANCHORS, chain: int = 3) -> DataFrame:
    """Signature sets of every whole text, of its edited text and of the next text.

    Returns doc_id, n_chars, edited (text), sigs, edited_sigs, next_sigs. The
    edited text has the last quarter of the code points replaced by the first
    as many (or all) of the next document's, by ascending id; after the last
    comes the first. Null text: empty. Null ids come after all others; equal
    ids are ordered by the digests of their texts. Ids must be integers
    (TypeError). Empty table: no rows.
    """
    integer_ids(df, id_col)
    x = with_next(df, id_col, text_col)
    order = Window.partitionBy("_b").orderBy("_halo", F.col("doc_id").asc_nulls_last(), "_h")
    x = x.withColumn("_next", F.lead("text").over(order))
    x = signatures("text", x, "sigs", anchors, chain)
    x = x.withColumn("next_sigs", F.lead("sigs").over(order)).where("_halo = 0")
    n = F.char_length("text")
    k = F.floor(n / 4).cast("int")
    x = x.withColumn("n_chars", n.cast("bigint")).withColumn("edited", F.concat(
        F.substring(F.col("text"), F.lit(1), n - k), F.substring(F.col("_next"), F.lit(1), k)))
    x = signatures("edited", x.drop("_next", "_b", "_halo", "_h"), "edited_sigs", anchors, chain)
    return x.select("doc_id", "n_chars", "edited", "sigs", "edited_sigs", "next_sigs")


def match(df: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text",
          anchors: Sequence[str] = ANCHORS, chain: int = 3, block: int = 32) -> DataFrame:
    """(doc_id, class_id) of every row: the least id among the documents that it is linked to by
    signature sets of Jaccard likeness ``threshold`` or more, directly or through others.

    1. Documents with equal sets are one class. A text without a word has no
       set and matches none: its class is its own id, as for a null id.
    2. Sets are partitioned by their length, the bounds growing by
       1 / ``threshold``: two matching sets are in one partition or in
       neighbouring ones.
    3. In a partition a set is looked up by its rarest signatures, so many
       that two matching sets share one of them. The sets of one signature
       meet in pairs of blocks of ``block`` sets.
    4. In a pair of blocks only pairs whose lengths allow the likeness are
       intersected, and a spanning forest of the matches comes out, never
       all pairs. Components of these edges are the classes.

    All steps are DataFrame operations. Repeated rows are documents of their
    own; ids of any ordered type; empty table: no rows; further columns are
    not read.
    """
    s = signatures(F.col(text_col), df.select(F.col(id_col).alias("doc_id"), F.col(text_col)), "sigs", anchors, chain)
    docs = stored(s.select("doc_id", F.md5(F.array_join("sigs", "")).alias("cls"), "sigs"), "signatures")
    sets = stored(docs.where(F.size("sigs") > 0).groupBy("cls").agg(F.first("sigs").alias("sigs")), "sets")
    each = sets.select("cls", F.explode("sigs").alias("s"))
    often = each.groupBy("s").agg(F.count(F.lit(1)).alias("f")).where("f > 1")
    # rare signatures first; one that only this set has is looked up by nobody, but takes its place
    own = each.join(often, "s", "left").groupBy("cls").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("f", F.lit(1)).alias("f"), "s"))).alias("by"))
    n = F.size("by")
    width = n - F.ceil(F.lit(threshold) * n - 1e-9).cast("int") + 1
    part = F.floor(F.log(n.cast("double")) / F.log(F.lit(1 / threshold)) + 1e-9).cast("int")
    looked = own.select("cls", part.alias("part"), F.explode(F.slice("by", F.lit(1), width)).alias("x")).where("x.f > 1")
    at = looked.select("cls", F.col("x.s").alias("s"), F.explode(F.array(
        F.struct(F.col("part").alias("p"), F.lit(True).alias("member")),
        F.struct((F.col("part") + 1).alias("p"), F.lit(False).alias("member")))).alias("y")).select(
            "cls", "s", "y.p", "y.member")
    groups = at.groupBy("s", "p").agg(F.count(F.lit(1)).alias("m"), F.max("member").alias("_some")).where("m > 1 and _some")
    dealt = at.join(groups.drop("_some"), ["s", "p"])
    blocks = F.ceil(F.col("m") / F.lit(block)).cast("int")
    dealt = dealt.withColumn("k", blocks).withColumn("b", F.pmod(F.xxhash64("cls"), F.col("k")).cast("int"))
    dealt = dealt.withColumn("_pair", F.explode(F.transform(F.sequence(F.lit(0), F.col("k") - 1), lambda j: F.struct(
        F.least(j, F.col("b")).alias("lo"), F.greatest(j, F.col("b")).alias("hi")))))
    met = dealt.select("s", "p", "_pair.lo", "_pair.hi", "b", "member", "cls").join(sets, "cls")
    met = met.groupBy("s", "p", "lo", "hi").agg(F.sort_array(F.collect_list(F.struct("cls", "b", "member", "sigs"))).alias("g"))
    met = met.where(F.size("g") > 1)

    def linked(a, b):
        x, y = F.size(a["sigs"]), F.size(b["sigs"])
        both = F.size(F.array_intersect(a["sigs"], b["sigs"]))
        return (a["member"] | b["member"]) & ((F.col("lo") == F.col("hi")) | (a["b"] != b["b"])) & F.when(
            F.least(x, y) < threshold * F.greatest(x, y) - 1e-9, F.lit(False)).otherwise(
                both / (x + y - both) >= threshold)

    def add(labels, i):
        """Element i joins the trees of the earlier elements that it is linked to."""
        a = F.get(F.col("g"), i)
        hit = F.filter(F.transform(labels, lambda lab, j: F.when(linked(a, F.get(F.col("g"), j)), lab)),
                       lambda lab: lab.isNotNull())
        least = F.coalesce(F.array_min(hit), i)
        return F.concat(F.transform(labels, lambda lab: F.when(F.array_contains(hit, lab), least).otherwise(lab)),
                        F.array(least))

    labels = F.aggregate(F.sequence(F.lit(0), F.size("g") - 1), F.array().cast("array<int>"), add)
    edges = met.select(F.transform("g", lambda x: x["cls"]).alias("c"), F.posexplode(labels).alias("i", "root")).where(
        "i != root").select(F.get("c", F.col("i")).alias("u"), F.get("c", F.col("root")).alias("v"))
    near = components(stored(edges.distinct(), "matches"))
    named = docs.select("doc_id", F.when(F.size("sigs") > 0, F.col("cls")).alias("cls")).join(
        near.select(F.col("node").alias("cls"), "root"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    first = named.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("doc_id").alias("class_id"))
    return named.join(first, "root", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))
