"""Mixing sources to target weights: Efraimidis-Spirakis sampling.

Every document gets an exponential key, -ln(u) divided by its quality weight,
with u drawn from a hash of its id (reruns agree); where an id is null or repeated,
of id, text and the number of the copy, so rows are drawn one by one.  Within a source, documents
sorted by key are a weighted sample without replacement at every prefix.  A
source's target is met by complete epochs first (each takes the whole source);
what is left is taken from the front of the key order until the prefix sum of
sizes meets it.  A document is in when the middle of its words lies within the
budget, so a source misses its target by half a document at most.

DataFrame functions only.  No source is sorted as a whole: keys are cut into
ranges whose number follows the source's rows, the ranges are summed, and only
rows of the one range that the budget ends in are ordered.

Defined cases: null text counts 0 words; the null source is a source, last in
order; a source without words gets target 0 and its documents are taken 0
words; rows alike in id, text and source are interchangeable: how many of them are
taken is the same in every run, which of them (their other columns, in ``remix``)
is not; an empty table gives no rows; other columns, whatever their names, are not
read by ``mix`` and are kept by ``remix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kollektiv.llm.common import WORD, stage_table

#: Weights of the sources in code point order, repeating.
WEIGHTS = (3, 1, 2)
#: Words of the mix per word of the input.
SHARE = 1.5
#: Most times that a source may be repeated.
MOST = 2
#: Rows of a source per key range.
RANGE_ROWS = 20_000
#: Per-source rows that may be broadcast.
BROADCAST_ROWS = 200_000
#: Stands for a null id.
LEAST_ID = -(1 << 62)


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(text: Column) -> Column:
    """1 for clean prose, falling with the share of symbol characters."""
    t = F.coalesce(text, F.lit(""))
    odd = F.length(t) - F.length(F.translate(t, "%&$#*!|", ""))
    return F.lit(1.0) / (F.lit(1.0) + F.lit(10.0) * odd / F.greatest(F.length(t), F.lit(1)))


def exponential_key(doc_id: Column, apart: Column, weight: Column, seed: int) -> Column:
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")), apart)
    u = (F.conv(F.substring(F.md5(name.cast("binary")), 1, 12), 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(1 << 48))
    return -F.ln(u) / weight


def told_apart(rows: DataFrame, id_col: str, source_col: str, digest: Column, p: str) -> DataFrame:
    """``rows`` with ``<p>apart``: empty where the id is the row's alone, else the
    text's digest and the number of the copy among rows alike in id, text and source.

    Only rows of null or repeated ids are staged and numbered: by the task that
    read them, plus a running sum over tasks, so any number of copies may be alike."""
    ids = stage_table(rows.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias(p + "id"))
                      .agg(F.count(F.lit(1)).alias(p + "n")).filter(F.col(p + "n") > 1).select(p + "id"), "mix-ids")
    apart = p + "apart"
    shared = ids.count()
    if not shared and not rows.filter(F.col(id_col).isNull()).limit(1).count():
        return rows.withColumn(apart, F.lit(""))
    repeated = F.broadcast(ids) if shared <= BROADCAST_ROWS else ids
    alike = F.col(id_col) == F.col(p + "id")
    once = rows.filter(F.col(id_col).isNotNull()).join(repeated, alike, "left_anti")
    many = rows.filter(F.col(id_col).isNull()).unionByName(rows.join(repeated, alike, "left_semi"))
    group = F.md5(F.concat_ws("|", *[F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in (id_col, source_col)],
                              F.col(p + "digest")).cast("binary"))
    many = stage_table(many.withColumn(p + "digest", digest).withColumn(p + "group", group)
                       .withColumn(p + "task", F.spark_partition_id()), "mix-copies")
    per_task = many.groupBy(p + "group", p + "task").agg(F.count(F.lit(1)).alias(p + "n"))
    earlier = Window.partitionBy(p + "group").orderBy(p + "task").rowsBetween(Window.unboundedPreceding, -1)
    per_task = per_task.withColumn(p + "before", F.coalesce(F.sum(p + "n").over(earlier), F.lit(0))).drop(p + "n")
    here = F.row_number().over(Window.partitionBy(p + "group", p + "task").orderBy(F.lit(0))) - 1
    many = (many.withColumn(p + "here", here).join(per_task, [p + "group", p + "task"])
            .withColumn(apart, F.concat(F.lit(":"), F.col(p + "digest"), F.lit(":"),
                                        (F.col(p + "before") + F.col(p + "here")).cast("string"))))
    return once.withColumn(apart, F.lit("")).select(*rows.columns, apart).unionByName(many.select(*rows.columns, apart))


def text_digest(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def sizes_and_keys(docs: DataFrame, seed: int, id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    text = F.col(text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), n_words(text).alias("size"),
                       quality_weight(text).alias("weight"), text_digest(text).alias("digest"))
    rows = told_apart(rows, "doc_id", "source", F.col("digest"), "_mix_")
    return rows.select("doc_id", "source", "size", F.col("_mix_apart").alias("apart"),
                       exponential_key(F.col("doc_id"), F.col("_mix_apart"), F.col("weight"), seed).alias("key"))


def targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One row per source: source, n, source_size, target.

    Capped shares, in closed form: with sources in order of the level at which
    they reach their cap (cap / weight), the level that all uncapped sources
    share is (what is left of the total) / (the weights left); the sources
    whose own level is below it sit at their cap.
    """
    per = sized.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1))
    per = per.withColumn("weight", w).withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    per = (per.withColumn("left", F.lit(share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
           .withColumn("weight_left", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
           .withColumn("level", F.col("left") / F.col("weight_left"))
           .withColumn("open", F.col("cap") >= F.col("level") * F.col("weight")))
    # the first source that stays under its cap sets the level; from there on
    # levels only fall
    level = F.max(F.when(F.col("open"), F.col("level"))).over(everything)
    return per.select("source", "n", "source_size",
                      F.when(level.isNull(), F.col("cap")).otherwise(F.least(F.col("cap"), level * F.col("weight"))).alias("target"))


def decisions(sized: DataFrame, **kw) -> DataFrame:
    """One row per source: target, complete epochs, and the last row (key, id,
    what tells it apart) that the fractional epoch takes (null: none)."""
    per = (targets(sized, **kw)
           .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)))
           .withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
           .withColumn("ranges", F.ceil(F.col("n") / F.lit(RANGE_ROWS))))
    per = stage_table(per.withColumnRenamed("source", "src"), "mix-sources")
    # keys of weight w are exponential, so 1 - exp(-key) cuts them about evenly
    ranged = sized.join(small(per), F.col("source").eqNullSafe(F.col("src"))).withColumn(
        "range", F.least(F.col("ranges") - 1, F.floor(F.col("ranges") * (F.lit(1.0) - F.exp(-F.col("key"))))))
    sums = ranged.groupBy("src", "range").agg(F.sum("size").alias("words"), F.first("budget").alias("budget"))
    upto = F.sum("words").over(Window.partitionBy("src").orderBy("range"))
    ends = (sums.withColumn("upto", upto).withColumn("start", F.col("upto") - F.col("words"))
            .filter((F.col("budget") > F.col("start")) & (F.col("budget") <= F.col("upto")) & (F.col("words") > 0))
            .select(F.col("src").alias("e_src"), F.col("range").alias("e_range"), "start"))
    inside = ranged.join(small(ends), F.col("src").eqNullSafe(F.col("e_src")) & (F.col("range") == F.col("e_range")))
    order = Window.partitionBy("src").orderBy("key", F.col("doc_id").asc_nulls_first(), "apart")
    middle = F.col("start") + F.sum("size").over(order) - F.col("size") / 2
    last = (inside.withColumn("middle", middle).filter(F.col("middle") <= F.col("budget"))
            .groupBy(F.col("src").alias("l_src"))
            .agg(F.max(_place(F.col("key"), F.col("doc_id"), F.col("apart"))).alias("in_range")))
    first = ends.select(F.col("e_src").alias("f_src"), "e_range")
    return (per.join(last, F.col("src").eqNullSafe(F.col("l_src")), "left")
            .join(first, F.col("src").eqNullSafe(F.col("f_src")), "left")
            .select("src", "source_size", "target", "epochs", "ranges", "e_range", "in_range"))


def _place(key: Column, doc_id: Column, apart: Column) -> Column:
    return F.struct(key.alias("key"), F.coalesce(doc_id, F.lit(LEAST_ID)).alias("id"), apart.alias("apart"))


def _times(key: Column, doc_id: Column, apart: Column, p: str) -> Column:
    """Times a document is taken: epochs, and 1 if the fraction has it.  The
    decision of its source is in columns with prefix ``p``."""
    d = {c: F.col(p + c) for c in ("epochs", "ranges", "e_range", "in_range")}
    here = F.least(d["ranges"] - 1, F.floor(d["ranges"] * (F.lit(1.0) - F.exp(-key))))
    within = _place(key, doc_id, apart) <= d["in_range"]
    part = F.coalesce((here < d["e_range"]) | ((here == d["e_range"]) & within), F.lit(False))
    return d["epochs"] + F.when(part, 1).otherwise(0)


def _with_prefix(per: DataFrame, p: str) -> DataFrame:
    return small(per.select(*[F.col(c).alias(p + c) for c in per.columns]))


def small(per_source: DataFrame) -> DataFrame:
    """Per-source rows, broadcast if their number is counted and small, so the
    rows of a hot source stay where they are; else left to a shuffled join."""
    return F.broadcast(per_source) if per_source.count() <= BROADCAST_ROWS else per_source


def mix(docs: DataFrame, seed: int = 7, **kw) -> DataFrame:
    """doc_id, size, source_size, target, taken (words, repeats counted)."""
    sized = stage_table(sizes_and_keys(docs, seed), "mix-sizes")
    per = _with_prefix(decisions(sized, **kw), "_mix_")
    return (sized.join(per, F.col("source").eqNullSafe(F.col("_mix_src")))
            .select("doc_id", "size", F.col("_mix_source_size").alias("source_size"), F.col("_mix_target").alias("target"),
                    (_times(F.col("key"), F.col("doc_id"), F.col("apart"), "_mix_") * F.col("size")).cast("long").alias("taken")))


def _free_prefix(columns: list[str]) -> str:
    """A prefix that no column has, upper or lower case."""
    p = "_mix_"
    while any(c.lower().startswith(p) for c in columns):
        p = "_" + p
    return p


def remix(docs: DataFrame, seed: int = 7, id_col="doc_id", text_col="text", source_col="source", **kw) -> DataFrame:
    """The mix itself: ``docs`` with each row as often as it is taken.  The
    texts stay where they are (but for rows of null or repeated ids); only
    per-source decisions are joined."""
    p = _free_prefix(docs.columns)
    sized = stage_table(sizes_and_keys(docs, seed, id_col, text_col, source_col), "mix-sizes")
    per = _with_prefix(decisions(sized, **kw), p)
    rows = told_apart(docs, id_col, source_col, text_digest(F.col(text_col)), p)
    key = exponential_key(F.col(id_col), F.col(p + "apart"), quality_weight(F.col(text_col)), seed)
    return (rows.join(per, F.col(source_col).eqNullSafe(F.col(p + "src"))).withColumn(p + "key", key)
            .withColumn(p + "times", _times(F.col(p + "key"), F.col(id_col), F.col(p + "apart"), p).cast("int"))
            .filter(F.col(p + "times") > 0)
            .withColumn(p + "copy", F.explode(F.sequence(F.lit(1), F.col(p + "times"))))
            .select(*docs.columns))
