"""Mixing sources to target weights by Pareto order sampling. DataFrame functions only.

Targets: sources share ``share`` times all words by weight; a target stops at ``most`` times its source's words and the
excess is shared again by weight. Each source's target is then divided among its documents by ``preference`` in the same
way, so that every document has an expected number of copies m between 0 and ``most``. floor(m) copies are certain; the
rest p = m - floor(m) is an inclusion probability, in general another one for each preference. Documents are ranked by
random odds over inclusion odds, u/(1-u) / (p/(1-p)), and the first ones are taken until the words still due to the source
are reached (a document counts when the middle of its words still fits): a sample of fixed size, in words.

u comes from a hash of seed, doc_id and text, so reruns agree. No source is ranked in one task: ranks are cut in ``BINS``
bins, words are added up per source and bin, and only the one bin in which a source reaches its target is ordered.

Cases: sources are told apart as they are, null is a source of its own and comes last. A null or empty text has size 0
and is taken 0 times; a source without words has target 0. Rows that repeat a document have the same u and are taken one
by one, as far as their words fit. A preference that is null counts as 1; it is rounded to two places, at least 0.01.
Other columns pass through; names that the operator adds (size, source_size, target, copies, taken) replace columns of
the same name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import stored

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2.0
SEED = 17
BINS = 1 << 16
# documents of fewer words are half as likely to be repeated
SHORT = 50


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def uniform(seed: int) -> Column:
    """A number between 0 and 1 from a hash of the document."""
    key = F.concat_ws(":", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                      F.coalesce("text", F.lit("")))
    return (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def short_texts_less(size: Column) -> Column:
    return F.when(size < SHORT, 0.5).otherwise(1.0)


def filled(frame: DataFrame, keys: list[str], total: Column, weight: Column, cap: Column, order: list[Column]) -> Column:
    """The share of ``total`` of each row of a group: by weight, none above its cap.

    Rows reach their caps in the order of cap over weight. With the first j rows at their caps the others get
    (total - their caps) / (weights of the others) for each unit of weight; the first j at which the next row stays
    below its cap is the solution, and its rate is the largest of all such j.
    """
    # rows without words have neither weight nor cap and come first
    ranked = Window.partitionBy(*keys).orderBy(F.try_divide(cap, weight).asc_nulls_first(), *order)
    before, after = (ranked.rowsBetween(Window.unboundedPreceding, -1), ranked.rowsBetween(0, Window.unboundedFollowing))
    rate = F.try_divide(total - F.coalesce(F.sum(cap).over(before), F.lit(0.0)), F.sum(weight).over(after))
    return F.when(rate * weight <= cap, rate)


def _level(frame: DataFrame, name: str, keys: list[str], total: Column, weight: Column, cap: Column,
           order: list[Column]) -> DataFrame:
    """``frame`` with the filled share of each row as ``name``."""
    rate = f"{name}_rate"
    found = frame.withColumn(rate, filled(frame, keys, total, weight, cap, order))
    whole = Window.partitionBy(*keys)
    return (found.withColumn(rate, F.max(rate).over(whole))
            .withColumn(name, F.when(cap == 0, 0.0).otherwise(F.least(F.coalesce(F.col(rate) * weight, cap), cap)))
            .drop(rate))


def plan(measured: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """For each source and preference: the source's size and target, certain copies and inclusion probability."""
    cells = measured.groupBy("source", "preference").agg(F.sum("size").alias("words"))
    sources = (cells.groupBy("source").agg(F.sum("words").alias("source_size"))
               .withColumn("all", F.lit(1))
               .withColumn("at", F.row_number().over(Window.partitionBy("all").orderBy(F.col("source").asc_nulls_last())))
               .withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                                                  ((F.col("at") - 1) % len(weights) + 1).cast("int")))
               .withColumn("total", F.sum("source_size").over(Window.partitionBy("all")) * F.lit(share)))
    sources = _level(sources, "target", ["all"], F.col("total"), F.col("weight"), F.col("source_size") * F.lit(most),
                     [F.col("at")]).select(F.col("source").alias("of"), "source_size", "target")
    cells = cells.join(sources, cells["source"].eqNullSafe(sources["of"])).drop("of")
    cells = _level(cells, "due", ["source"], F.col("target"), F.col("preference") * F.col("words"),
                   F.col("words") * F.lit(most), [F.col("preference").desc()])
    copies = F.when(F.col("words") > 0, F.col("due") / F.col("words")).otherwise(0.0)
    return (cells.withColumn("expected", copies).withColumn("certain", F.floor("expected"))
            .withColumn("p", F.col("expected") - F.col("certain"))
            .withColumn("rest", F.col("target") - F.sum(F.col("certain") * F.col("words")).over(Window.partitionBy("source")))
            .select("source", "preference", "source_size", "target", "certain", "p", "rest"))


def ranked(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """Rows with their plan and their rank v between 0 and 1 (null where no copy is left to chance)."""
    other = cells.withColumnsRenamed({"source": "of", "preference": "by"})
    joined = rows.join(other, rows["source"].eqNullSafe(other["of"]) & (rows["preference"] == other["by"])).drop("of", "by")
    odds = F.try_divide(F.col("u") / (1 - F.col("u")), F.try_divide(F.col("p"), 1 - F.col("p")))
    joined = joined.withColumn("odds", F.when((F.col("p") > 0) & (F.col("size") > 0), odds))
    return (joined.withColumn("v", F.col("odds") / (1 + F.col("odds")))
            .withColumn("bin", F.floor(F.col("v") * BINS)).drop("odds"))


def mixed(documents: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST,
          preference: Column | None = None, seed: int = SEED, keep_text: bool = True) -> DataFrame:
    """``documents`` with size, source_size, target (its source's), copies and taken words."""
    liking = short_texts_less(F.col("size")) if preference is None else preference
    names = [c for c in documents.columns if c not in ("size", "source_size", "target", "copies", "taken")]
    # the documents' own columns travel packed, so that none can clash with the working columns
    packed = documents.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), "doc_id", "source", "text")
    rows = (packed.withColumn("size", word_count(F.col("text"))).withColumn("u", uniform(seed))
            .withColumn("preference", F.greatest(F.round(F.coalesce(liking.cast("double"), F.lit(1.0)), 2), F.lit(0.01))))
    small = stored(rows.select("doc_id", "source", "size", "u", "preference"), "mix_sizes")
    cells = stored(plan(small, weights, share, most), "mix_plan")
    rows = rows.drop("text") if keep_text else small.withColumn("row", F.struct("doc_id", "source"))

    ordered = Window.partitionBy("source").orderBy("bin")
    bins = (ranked(small, cells).filter(F.col("bin").isNotNull()).groupBy("source", "bin")
            .agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
            .withColumn("upto", F.sum("words").over(ordered)))
    # the bin in which the words due are reached; below it every document is taken, above it none
    cut = (bins.filter(F.col("upto") > F.col("rest")).groupBy("source")
           .agg(F.min("bin").alias("cut"), F.min_by(F.col("rest") - F.col("upto") + F.col("words"), "bin").alias("left")))
    cut = stored(cut.withColumnRenamed("source", "cut_of"), "mix_cut")
    found = ranked(rows, cells)
    found = found.join(cut, found["source"].eqNullSafe(cut["cut_of"]), "left").drop("cut_of")
    at_cut = F.coalesce(F.col("bin") == F.col("cut"), F.lit(False))
    sure = found.filter(~at_cut).withColumn(
        "extra", F.when(F.col("bin").isNotNull() & (F.col("cut").isNull() | (F.col("bin") < F.col("cut"))), 1).otherwise(0))
    in_bin = Window.partitionBy("source").orderBy("v", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    close = found.filter(at_cut).withColumn("reached", F.sum("size").over(in_bin)).withColumn(
        "extra", F.when(F.col("reached") - F.col("size") / 2 <= F.col("left"), 1).otherwise(0)).drop("reached")
    return (sure.unionByName(close).withColumn("copies", (F.col("certain") + F.col("extra")).cast("long"))
            .withColumn("taken", F.col("copies") * F.col("size"))
            .select("row.*", "size", "source_size", "target", "copies", "taken"))


def op3_mix(documents: DataFrame) -> DataFrame:
    return mixed(documents.select("doc_id", "source", "text"), keep_text=False).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")
