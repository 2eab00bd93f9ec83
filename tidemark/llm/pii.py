"""Personal data by candidate gradient boosting. DataFrame functions and Spark's boosted trees.

Generators propose spans, high recall first: for every kind a base pattern and a wider one (``at`` and ``dot`` written out,
phones without plus, cards and addresses with loose separators), so spans of different generators overlap. A base match
that passes its check (parts, digits, Luhn) is personal data, always. All candidates become rows of format features
(length, kinds of characters, groups, checks) and context features (characters and cue words beside them). Boosted trees
learn base data against the other candidates; since a candidate that no base span touches is unlabelled rather than
clean, it weighs ``UNSURE``. On a fold kept out of training each kind gets the smallest threshold above which the
precision is ``PRECISION``. Candidates above it that touch no base span are added, the first of overlapping ones.

Patterns start at the beginning of a run or at the end of the last match and take runs whole (possessively), so a text
without blanks costs no quadratic search and no deep recursion. Offsets are running sums of the lengths between matches.
Texts without a digit, ``@`` or written-out ``at`` cannot hold a candidate and skip all of it. Trees and thresholds are learnt from every
candidate; a hash decides the fold of each.

Cases: a null or empty text has no spans. Every row is one result, repeated rows alike; a null doc_id is kept. With fewer
than ``FEWEST`` candidates of either class there is no model and only base spans are returned. Other columns are not read;
redaction keeps them.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import stored

KINDS = ("email", "ip", "card", "phone")
_LOCAL = "[A-Za-z0-9._%+-]"
GENERATORS = (
    # kind, is base, pattern; \G: a match may begin where the last one ended
    ("email", True, rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", True, r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"),
    ("card", True, r"[0-9]++(?:[\x20-][0-9]++)*+"),
    ("phone", True, r"\+[0-9][\x20().0-9-]+[0-9]"),
    ("email", False, rf"(?<!{_LOCAL}){_LOCAL}++ ?(?:@|[(\[](?:at|AT)[)\]]) ?[A-Za-z0-9-]++(?: ?(?:\.|[(\[](?:dot|DOT)[)\]]) ?[A-Za-z0-9-]++)++"),
    ("ip", False, r"(?<![0-9])[0-9]{1,3}(?: ?[.,] ?[0-9]{1,3}){3}(?![0-9])"),
    ("card", False, r"(?<![0-9])[0-9]{4}(?:[\x20._/-]{1,2}[0-9]{2,6}){2,4}(?![0-9])"),
    ("phone", False, r"(?<![0-9+])\(?[0-9]{2,5}\)?(?:[\x20./-]{1,2}\(?[0-9]{2,5}\)?){2,4}(?![0-9])"),
)
# every generator but the emails' asks for a digit, those for one of two signs
MAY_HOLD = r"[0-9@]|[(\[](?:at|AT)[)\]]"
CUES = {"email": "mail|e-mail|contact|write", "ip": r"\bip\b|host|server|address", "card": "card|visa|credit|pay|karte|tarjeta",
        "phone": "phone|tel|call|fax|mobile|anruf|ruf", "secret": "token|password|key|secret|=|\"", "version": "version|license|v\\."}
AROUND = 24
UNSURE, PRECISION, FEWEST, FOLD = 0.3, 0.95, 50, 4
TREES, DEPTH = 15, 4
BINS = 50


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the check sum."""
    def worth(i: Column) -> Column:
        d = F.substring(F.reverse(digits), i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + worth(i)) % 10 == 0


def proposed(documents: DataFrame) -> DataFrame:
    """uid, doc_id, doc_key (hash of the text), kind, base, m (the match), start, end, before and after (text beside it); one row with m null for each
    text and generator."""
    text = F.col("text")
    runs = [F.struct(F.lit(i).alias("gen"), F.arrays_zip(
        F.regexp_extract_all(text, F.lit(p), F.lit(0)).alias("m"), F.split(text, p, -1).alias("gap")).alias("found"))
        for i, (_, _, p) in enumerate(GENERATORS)]
    rows = (documents.filter(F.col("text").rlike(MAY_HOLD)).select("uid", "doc_id", F.xxhash64("text").alias("doc_key"), F.explode(F.array(*runs)).alias("run"))
            .select("uid", "doc_id", "doc_key", F.col("run.gen").alias("gen"), F.posexplode("run.found").alias("at", "hit"))
            .select("uid", "doc_id", "doc_key", "gen", "at", F.col("hit.m").alias("m"), F.length("hit.gap").alias("gap"),
                    F.right(F.col("hit.gap"), F.lit(AROUND)).alias("before"), F.left(F.col("hit.gap"), F.lit(AROUND)).alias("head")))
    order = Window.partitionBy("uid", "gen").orderBy("at")
    rows = (rows.withColumn("start", F.sum(F.col("gap") + F.coalesce(F.length("m"), F.lit(0)))
                            .over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.coalesce(F.length("m"), F.lit(0)))
            .withColumn("after", F.coalesce(F.lead("head").over(order), F.lit(""))))
    kind = F.element_at(F.array(*[F.lit(k) for k, _, _ in GENERATORS]), F.col("gen") + 1)
    base = F.element_at(F.array(*[F.lit(b) for _, b, _ in GENERATORS]), F.col("gen") + 1)
    return rows.select("uid", "doc_id", "doc_key", kind.alias("kind"), base.alias("base"), "m", "start",
                       (F.col("start") + F.length("m")).alias("end"), "before", "after")


def checked(rows: DataFrame) -> DataFrame:
    """Format and context features, and ``valid``: whether a base match passes its check."""
    digits = F.regexp_replace("m", "[^0-9]", "")
    parts = F.filter(F.split("m", "[^0-9]+"), lambda p: p != "")
    small = F.forall(parts, lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3)
                     & (F.coalesce(F.substring(p, -9, 9).cast("int"), F.lit(0)) <= 255))
    rows = rows.withColumn("digits", digits).withColumn("n_digits", F.length("digits"))
    fits = F.col("n_digits").between(13, 19)
    rows = rows.withColumn("luhn", F.when(fits, luhn(F.col("digits"))).otherwise(False)).withColumn("small", small)
    valid = (F.when(F.col("kind") == "email", True).when(F.col("kind") == "ip", F.col("small"))
             .when(F.col("kind") == "card", fits & F.col("luhn")).otherwise(F.col("n_digits").between(9, 15)))
    return rows.withColumn("valid", F.col("base") & F.col("m").isNotNull() & F.coalesce(valid, F.lit(False)))


def featured(rows: DataFrame) -> DataFrame:
    """``features``: the vector the trees see. It has no flag of the generator, so that wide matches can resemble base ones."""
    near, low = F.right(F.col("before"), F.lit(1)), F.lower(F.col("before"))
    columns = {
        **{f"f_{k}": F.col("kind") == k for k in KINDS}, "f_length": F.length("m"), "f_digits": F.col("n_digits"),
        "f_letters": F.length(F.regexp_replace("m", "[^A-Za-z]", "")), "f_blanks": F.length(F.regexp_replace("m", "[^ ]", "")),
        "f_dots": F.length(F.regexp_replace("m", "[^.]", "")), "f_signs": F.length(F.regexp_replace("m", "[A-Za-z0-9 .]", "")),
        "f_groups": F.size(F.split("m", "[^0-9]+")), "f_luhn": F.col("luhn"), "f_small": F.col("small"),
        "f_plus": F.startswith("m", F.lit("+")), "f_at": F.contains("m", F.lit("@")),
        "f_glued": near.rlike("[A-Za-z0-9]"), "f_glued_after": F.left(F.col("after"), F.lit(1)).rlike("[A-Za-z0-9]"),
        "f_blank_before": near.isin(" ", "\n", ""), **{f"f_cue_{k}": low.rlike(c) for k, c in CUES.items()}}
    rows = rows.withColumns({n: F.coalesce(c.cast("double"), F.lit(0.0)) for n, c in columns.items()})
    return VectorAssembler(inputCols=list(columns), outputCol="features").transform(rows).drop(*columns)


def touched(rows: DataFrame) -> DataFrame:
    """``rows`` with ``of_base``: whether a candidate overlaps a valid base span of its text."""
    # base spans of all kinds, merged by a running maximum of their ends
    by_start = Window.partitionBy("uid").orderBy("start", F.col("valid").desc(), "end")
    by_end = Window.partitionBy("uid").orderBy(F.col("start").desc(), F.col("valid").desc(), F.col("end").desc())
    reach = F.max(F.when(F.col("valid"), F.col("end"))).over(by_start.rowsBetween(Window.unboundedPreceding, 0))
    next_ = F.min(F.when(F.col("valid"), F.col("start"))).over(by_end.rowsBetween(Window.unboundedPreceding, 0))
    return (rows.withColumn("reach", reach).withColumn("next", next_)
            .withColumn("of_base", F.coalesce(F.col("reach") > F.col("start"), F.lit(False))
                        | F.coalesce(F.col("next") < F.col("end"), F.lit(False))).drop("reach", "next"))


def trained(rows: DataFrame) -> tuple[GBTClassificationModel, dict[str, float]] | None:
    """The trees and each kind's threshold, or nothing where there is too little to learn from."""
    same_kind = rows.withColumn("label", F.when(F.col("of_base"), 1.0).otherwise(0.0))
    fold = F.pmod(F.xxhash64("uid", "start", "end", "kind"), F.lit(FOLD))
    known = same_kind.select("label", "kind", fold.alias("fold"), "features", F.when(
        F.col("label") == 1, 1.0).otherwise(UNSURE).alias("weight"))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if min(counts.get(0.0, 0), counts.get(1.0, 0)) < FEWEST:
        return None
    trees = GBTClassifier(labelCol="label", weightCol="weight", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=5)
    model = trees.fit(known.filter("fold > 0"))
    held = probable(model, known.filter("fold = 0"))
    steps = (held.groupBy("kind", F.floor(F.col("p") * BINS).alias("bin"))
             .agg(F.sum("label").alias("good"), F.count("*").alias("n")).collect())
    limits = {}
    for kind in KINDS:
        good = n = 0.0
        for row in sorted((r for r in steps if r["kind"] == kind), key=lambda r: -r["bin"]):
            good, n = good + row["good"], n + row["n"]
            if good / n < PRECISION:
                break
            limits[kind] = max(row["bin"] / BINS, 0.5)
    return model, limits


def probable(model: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows).withColumn("p", vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction")


def numbered(documents: DataFrame) -> DataFrame:
    return documents.withColumn("uid", F.monotonically_increasing_id())


def spans(documents: DataFrame) -> DataFrame:
    """uid, doc_id, doc_key and ``spans`` (kind, start, end, base; by kind and start) of each text with candidates.

    ``documents``: with uid, a key of the row that need hold only within this job.
    """
    found = proposed(documents)
    # short runs of digits hold nothing of any kind; one row without a match stays for each text
    digits = F.length(F.regexp_replace("m", "[^0-9]", ""))
    found = found.filter((F.col("m").isNull() & (F.col("kind") == "email") & F.col("base"))
                         | (F.col("kind") == "email") & F.col("m").isNotNull() | (digits >= F.when(F.col("kind") == "ip", 4).otherwise(7)))
    rows = stored(featured(touched(checked(found))), "pii_candidates")
    base = rows.filter(F.col("valid"))
    keep = base.select("uid", "doc_id", "doc_key", "kind", "start", "end", "base")
    open_rows = rows.filter(F.col("m").isNotNull())
    if learnt := trained(open_rows):
        model, limits = learnt
        limit = F.coalesce(*[F.when(F.col("kind") == k, v) for k, v in limits.items()], F.lit(2.0))
        more = probable(model, open_rows.filter(~F.col("of_base"))).filter(F.col("p") >= limit)
        earlier = Window.partitionBy("uid").orderBy("start", F.col("p").desc(), "end").rowsBetween(Window.unboundedPreceding, -1)
        more = more.withColumn("reach", F.max("end").over(earlier)).filter(F.coalesce(F.col("reach") <= F.col("start"), F.lit(True)))
        keep = keep.unionByName(more.select("uid", "doc_id", "doc_key", "kind", "start", "end", F.lit(False).alias("base")))
    order = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    one = F.struct(order.alias("order"), "start", "end", "kind", "base")
    texts = rows.filter(F.col("m").isNull()).select("uid", "doc_id", "doc_key", F.lit(None).cast("string").alias("kind"), F.lit(None).cast(
        "long").alias("start"), F.lit(None).cast("long").alias("end"), F.lit(None).cast("boolean").alias("base"))
    return (keep.unionByName(texts).groupBy("uid", "doc_id", "doc_key")
            .agg(F.array_sort(F.collect_set(F.when(F.col("kind").isNotNull(), one))).alias("spans")))


def joined(found: Column) -> Column:
    return F.concat_ws(",", F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def redacted(documents: DataFrame) -> DataFrame:
    """``documents`` with every span replaced by its kind in brackets, and n_chars of changed texts renewed."""
    # own columns travel packed, so that none can clash with the working columns
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), "doc_id", "text")
    may = F.coalesce(F.col("text").rlike(MAY_HOLD), F.lit(False))
    found = (spans(numbered(documents.select("doc_id", "text"))).filter(F.size("spans") > 0)
             .select(F.col("doc_id").alias("found_id"), F.col("doc_key").alias("found_key"), "spans").dropDuplicates(["found_id", "found_key"]))
    begin = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(a: Column, s: Column) -> Column:
        fresh = s["start"] >= a["at"]
        gap = F.substring(F.col("text"), (a["at"] + 1).cast("int"), F.greatest(s["start"] - a["at"], F.lit(0)).cast("int"))
        return F.struct(F.when(fresh, F.concat(a["out"], gap, F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise(a["out"]).alias("out"),
                        F.greatest(a["at"], s["end"]).alias("at"))

    ordered = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    text = F.aggregate(ordered, begin, step, lambda a: F.concat(a["out"], F.substring(F.col("text"), (a["at"] + 1).cast("int"), F.lit(2**31 - 1))))
    held = rows.filter(may).withColumn("doc_key", F.xxhash64("text"))
    held = held.join(found, held["doc_id"].eqNullSafe(found["found_id"]) & (held["doc_key"] == found["found_key"]), "left")
    held = held.withColumn("clean", F.when(F.col("spans").isNotNull(), text))
    kinds = dict(documents.dtypes)
    changes = {"text": F.col("clean"), "n_chars": F.length("clean").cast(kinds.get("n_chars", "long"))}
    columns = [F.when(F.col("clean").isNotNull(), changes[c]).otherwise(F.col(f"row.`{c}`")).alias(c) if c in changes
               else F.col(f"row.`{c}`").alias(c) for c in documents.columns]
    return held.select(*columns).unionByName(rows.filter(~may).select("row.*"))


def op5_pii(documents: DataFrame) -> DataFrame:
    rows = numbered(documents.select("doc_id", "text"))
    may = F.coalesce(F.col("text").rlike(MAY_HOLD), F.lit(False))
    empty = F.array().cast("array<struct<order:int,start:bigint,end:bigint,kind:string,base:boolean>>")
    found = spans(rows).select("doc_id", F.col("spans").cast("array<struct<order:int,start:bigint,end:bigint,kind:string,base:boolean>>").alias("spans"))
    found = found.unionByName(rows.filter(~may).select("doc_id", empty.alias("spans")))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS), F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
