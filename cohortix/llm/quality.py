"""Quality rules whose cutoffs carry a bound on the false rejections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored, text_of, words

#: Cutoffs tried for each rule; a document is rejected if its value is above.
CUTOFFS = {
    "symbols": [0.01, 0.02, 0.05, 0.1, 0.2, 0.3, 0.5],
    "dup_lines": [0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6],
    "repeats": [0.02, 0.05, 0.1, 0.15, 0.2, 0.25],
}


def tightenings() -> list[dict[str, float | None]]:
    """The steps of the test, each a cutoff for every rule (None: not used yet).

    From no rule at all, one rule a step is given its next stricter cutoff,
    rule after rule; the order does not depend on any data.
    """
    now: dict[str, float | None] = dict.fromkeys(CUTOFFS)
    out = []
    for i in range(max(map(len, CUTOFFS.values()))):
        for rule, cuts in CUTOFFS.items():
            if i < len(cuts):
                now = {**now, rule: cuts[-1 - i]}
                out.append(now)
    return out


#: Value of each rule from the counts of :func:`text_counts`.
VALUES = {
    "symbols": "n_symbols / greatest(word_chars, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
}


def text_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                keep: tuple[str, ...] = (), window: int = 8) -> DataFrame:
    """Counts of every whole text: words, code points in words, symbols, repeated
    lines and words inside ``window``-word windows that occur twice or more.

    Null text: the empty text, all counts 0. Windows are compared by a 64-bit
    hash within one document (a false match in 20,000 words has odds of 1e-11).
    A document costs a sort of its windows only if two of them are equal.
    ``keep`` names columns to carry along.
    """
    t = df.select(F.col(id_col).alias("doc_id"), *[F.col(c).alias(f"_k_{c}") for c in keep],
                  text_of(text_col).alias("_t"))
    w = t.select(
        *[c for c in t.columns if c != "_t"],
        words(F.col("_t")).alias("_w"),
        F.char_length(F.regexp_replace("_t", "[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
        F.filter(F.split("_t", "\n"), lambda x: x.rlike("[^ \\t-\\r]")).alias("_l"),
    )
    kept = [c for c in t.columns if c != "_t"]
    w = w.withColumn("_x", F.transform("_w", lambda x: F.xxhash64(x)))
    h = w.select(
        *kept, "n_symbols",
        F.size("_w").cast("bigint").alias("n_words"),
        F.char_length(F.array_join("_w", "")).cast("bigint").alias("word_chars"),
        F.size("_l").cast("bigint").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("bigint").alias("n_dup_lines"),
        F.when(F.size("_w") >= window, F.transform(
            F.sequence(F.lit(0), F.size("_w") - window),
            # single elements: slice() would copy the whole array for every window
            lambda i: F.xxhash64(*[F.get(F.col("_x"), i + k) for k in range(window)]))).otherwise(F.array().cast("array<bigint>")).alias("_h"),
    )
    s = h.select(
        *[c for c in h.columns if c != "_h"],
        F.when(F.size("_h") > F.size(F.array_distinct("_h")), F.sort_array(
            F.transform("_h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))).alias("_s"),
    )

    def repeated(x: Column, j: Column) -> Column:
        near = lambda k: F.get(F.col("_s"), k)["h"] == x["h"]
        return F.coalesce(near(j - 1), F.lit(False)) | F.coalesce(near(j + 1), F.lit(False))

    p = s.select(
        *[c for c in s.columns if c != "_s"],
        F.when(F.col("_s").isNotNull(), F.sort_array(F.transform(
            F.filter("_s", repeated), lambda x: x["i"]))).alias("_p"),
    )
    covered = F.aggregate(
        F.transform("_p", lambda x, j: F.least(
            F.lit(window), F.coalesce(F.get(F.col("_p"), j + 1) - x, F.lit(window)))),
        F.lit(0), lambda a, x: a + x)
    return p.select(
        "doc_id", *[F.col(f"_k_{c}").alias(c) for c in keep],
        "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines",
        F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def binomial_cdf(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p); 1 where k >= n * p (never near a level).

    Runs up the terms' ratios, keeping the sum in units of the last term and
    that term's logarithm, so it neither under- nor overflows.
    """
    start = F.struct((n * F.log1p(F.lit(-p))).alias("t"), F.lit(1.0).alias("s"))

    def step(a: Column, i: Column) -> Column:
        r = (n - i + 1) / i * F.lit(p / (1 - p))
        return F.struct((a["t"] + F.log(r)).alias("t"), (a["s"] / r + 1).alias("s"))

    steps = F.when(k > 0, F.sequence(F.lit(1).cast("bigint"), k)).otherwise(F.array().cast("array<bigint>"))
    done = F.aggregate(steps, start, step, lambda a: F.exp(a["t"]) * a["s"])
    return F.when(k >= n * p, F.lit(1.0)).otherwise(done)


def above_cutoff(cuts: dict[str, Column]) -> Column:
    """Does any rule reject the document? A rule without a cutoff (null) does not."""
    out = F.lit(False)
    for rule, cut in cuts.items():
        out = out | F.coalesce(F.expr(VALUES[rule]) > cut, F.lit(False))
    return out


def certified_cutoffs(counts: DataFrame, labels: DataFrame, stratum: str, max_false_reject: float = 0.01,
                      level: float = 0.05) -> DataFrame:
    """The strictest cutoffs of each stratum whose joint verdict has a proven false-rejection rate.

    Fixed-sequence test: for every stratum the steps of :func:`tightenings`
    are taken in turn. At each the exact binomial test on the labelled good
    documents asks whether the share of them that *any* rule rejects is below
    ``max_false_reject``; the first step that does not pass ends the sequence,
    so that no correction over steps is needed. Over strata the level is
    divided (Bonferroni): with probability 1 - ``level`` no stratum rejects
    more than ``max_false_reject`` of its good documents.

    Returns stratum, step, n_good, n_rejected, p_value and a column per rule
    with its cutoff (null: rejects nothing), one row per stratum that passes
    a step; that takes over ln(1 / level) / ``max_false_reject`` labelled
    documents, so the rows are few against the labels. Labels with a null id
    or quality do not count; a document labelled more than once is good if
    all its labels are.
    """
    good = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("_q")).where("_q = 1").select("_id")
    )
    steps = tightenings()
    tested = counts.where(~base_failed()).select(
        F.col("doc_id").alias("_id"), F.col(stratum).alias("_stratum"),
        F.array(*[above_cutoff({r: F.lit(c).cast("double") for r, c in s.items()}) for s in steps]).alias("_r"))
    per = tested.join(good, "_id").groupBy("_stratum").agg(
        F.count(F.lit(1)).alias("n_good"),
        *[F.count_if(F.col("_r")[i]).alias(f"_n_{i}") for i in range(len(steps))])
    tests = per.select("_stratum", "n_good", F.explode(F.array(*[
        F.struct(F.lit(i).alias("step"), F.col(f"_n_{i}").alias("n_rejected"),
                 *[F.lit(c).cast("double").alias(r) for r, c in s.items()])
        for i, s in enumerate(steps)])).alias("x")).select("_stratum", "n_good", "x.*")
    strata = per.agg(F.count(F.lit(1)).alias("_strata"))  # one row
    judged_ = tests.withColumn(
        "p_value", binomial_cdf(F.col("n_rejected"), F.col("n_good"), max_false_reject)
    ).crossJoin(F.broadcast(strata)).withColumn("_ok", F.col("p_value") * F.col("_strata") <= level)
    ends = judged_.groupBy("_stratum").agg(F.min(F.when(~F.col("_ok"), F.col("step"))).alias("_end"))
    passed = judged_.join(ends, "_stratum").where(F.col("_end").isNull() | (F.col("step") < F.col("_end")))
    return passed.groupBy("_stratum").agg(F.max_by(
        F.struct("step", "n_good", "n_rejected", "p_value", *CUTOFFS), "step").alias("x")).select(
            F.col("_stratum").alias("stratum"), "x.*")


def cutoffs(df: DataFrame, labels: DataFrame, stratum_col: str = "lang", max_false_reject: float = 0.01,
            level: float = 0.05) -> tuple[DataFrame, DataFrame]:
    """(stored counts of all documents with ``stratum``, certified cutoffs: one row per stratum)."""
    counts = stored(text_counts(with_stratum(df.select("doc_id", "text", stratum_col), stratum_col), keep=("_stratum",)).withColumnRenamed(
        "_stratum", "stratum"), "counts")
    cut = certified_cutoffs(counts, labels, "stratum", max_false_reject, level)
    # the file's size decides whether a join ships it
    return counts, stored(cut.select("stratum", *[F.col(r).alias(f"_c_{r}") for r in VALUES]), "cutoffs")


def with_stratum(df: DataFrame, stratum_col: str) -> DataFrame:
    return df.select("doc_id", "text", *[c for c in df.columns if c == "row"], F.coalesce(
        F.col(stratum_col).cast("string"), F.lit("(none)")).alias("_stratum"))


def judged(counts: DataFrame, cut: DataFrame) -> DataFrame:
    """Add ``base_failed`` and ``kept`` to counts with ``stratum``."""
    above = above_cutoff({r: F.col(f"_c_{r}") for r in VALUES})
    return counts.join(cut, "stratum", "left").withColumn("base_failed", base_failed()).withColumn(
        "kept", ~F.col("base_failed") & ~above).drop(*cut.columns[1:])


def quality_verdicts(df: DataFrame, labels: DataFrame, stratum_col: str = "lang",
                     max_false_reject: float = 0.01, level: float = 0.05) -> DataFrame:
    """Every document with its counts, ``base_failed`` and ``kept``.

    A document is kept if it passes the base rules (20 words or more; at most
    30 % of the words in repeated 8-word windows) and no certified cutoff of
    its stratum rejects it; the certificate is for that joint verdict (:func:`certified_cutoffs`). Strata are the values of ``stratum_col``, null
    being one. No rows in: no rows out; without labels only the base rules act.

    Scale: one pass over the texts writes the narrow counts; labels meet the
    counts, not the texts; the certified cutoffs (a row per stratum backed by
    hundreds of labels) are a stored table, which Spark ships if it is small.
    """
    counts, cut = cutoffs(df, labels, stratum_col, max_false_reject, level)
    return judged(counts, cut)


def keep_good(df: DataFrame, labels: DataFrame, stratum_col: str = "lang", max_false_reject: float = 0.01,
              level: float = 0.05) -> DataFrame:
    """The rows of ``df`` that :func:`quality_verdicts` keeps, with all their columns.

    The verdict is made again beside each text, which costs a second pass but
    no shuffle of the texts and no join on ids that may be null or repeated.
    """
    _, cut = cutoffs(df, labels, stratum_col, max_false_reject, level)
    whole = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("row"))
    x = whole.select("row", F.col(f"row.{stratum_col}").alias("lang"), F.col("row.doc_id").alias("doc_id"),
                     F.col("row.text").alias("text"))
    x = text_counts(with_stratum(x, "lang"), keep=("_stratum", "row")).withColumnRenamed("_stratum", "stratum")
    # a filter would be pushed below the counts, with all their expressions in it once for each use
    kept = judged(x, cut).select(F.explode_outer(F.when(F.col("kept"), F.array("row"))).alias("row"))
    return kept.where("row is not null").select("row.*")
