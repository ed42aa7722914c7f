"""Mixing sources to target weights by entropy balancing.

Document rates r minimise the token-weighted relative entropy to the natural
mix, sum(size * (r log r - r + 1)), under token constraints: for each value of each constraint column (source, language and so on)
the rated tokens of its documents meet a target. The convex dual has one multiplier per constraint, and a document's rate
is the exponential tilt r = exp(sum of its values' multipliers). Newton's method runs in Spark: each round sums gradient and curvature of a
column's constraints over the cells (the token sums of each combination of values, which are sufficient), and moves all
its multipliers at once; the values of one column share no document, so their block of the Hessian is diagonal. Rounds
go on over the columns until every constraint is met to a tolerance. Shares of sources are the case of one column. Rates are rounded
into whole copies: the whole part for every document, and one copy more for
the documents first in a hashed order until the source's target is met.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medlattice.llm.common import settle, word_count


def source_targets(sums: DataFrame, weights: list[float], max_rate: float) -> DataFrame:
    """Adds ``target`` to (source, source_size, ...): the sources share the sum of all
    sizes by ``weights``, dealt in code-point order (null last) and repeating; a target
    stops at ``max_rate`` times its source's size, and the excess is reshared by weight.

    The fixed point of the resharing is a common level: target = min(limit,
    level * weight). Sources sorted by limit / weight reach their limit first, so
    running sums give the level. One row per source goes through one window.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    t = sums.withColumn("weight", w).withColumn("limit", F.col("source_size") * F.lit(float(max_rate)))
    by_ratio = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    t = (t.withColumn("limits_before", F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
         .withColumn("weights_before", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
         .withColumn("total", F.sum("source_size").over(everything).cast("double"))
         .withColumn("total_weight", F.sum("weight").over(everything)))
    level = (F.col("total") - F.col("limits_before")) / (F.col("total_weight") - F.col("weights_before"))
    t = t.withColumn("level", level).withColumn("open", F.col("limit") >= F.col("level") * F.col("weight"))
    settled = F.min(F.when(F.col("open"), F.struct(F.col("limit") / F.col("weight"), F.col("level")))).over(everything)
    t = t.withColumn("common", settled["level"])
    target = F.least(F.col("limit"), F.coalesce(F.col("common") * F.col("weight"), F.col("limit")))
    return t.withColumn("target", target).select(*sums.columns, "target")


def entropy_multipliers(cells: DataFrame, targets: dict[str, DataFrame], tolerance: float = 1e-9, most_rounds: int = 200) -> dict[str, DataFrame]:
    """For each constraint column its values with ``target`` and the dual ``multiplier``.

    ``cells`` has the columns and ``size``, one row for each combination; ``targets[column]`` has (column, target). Null is a value like others. Values
    without tokens, or with target 0, have a null multiplier (rate 0). Newton steps are at most 1, as the dual is convex. The driver reads one
    number a step. Raises if the constraints are not met after ``most_rounds`` (crossed targets that contradict each other).
    """
    def same(column: str) -> Column:
        return F.col(f"c.{column}").eqNullSafe(F.col(f"m.{column}"))

    found = {}
    for column, target in targets.items():
        sums = cells.groupBy(column).agg(F.sum("size").alias("tokens"))
        start = target.alias("m").join(sums.alias("c"), same(column), "left").select(
            f"m.{column}", "target", F.when((F.col("tokens") > 0) & (F.col("target") > 0), F.lit(0.0)).alias("multiplier"))
        found[column] = settle(start, "multipliers")
    for _ in range(most_rounds):
        worst = 0.0
        for column in targets:
            tilted = cells.withColumn("tilt", F.lit(0.0))
            for other in targets:
                m = found[other].select(other, F.col("multiplier").alias("tilt_more"))
                tilted = tilted.alias("c").join(m.alias("m"), same(other)).select(
                    *[F.col(f"c.{c}").alias(c) for c in cells.columns], (F.col("tilt") + F.col("tilt_more")).alias("tilt"))
            # Gradient (rated tokens less target) and curvature (rated tokens) of each of the column's constraints.
            rated = tilted.where("tilt is not null").groupBy(column).agg(F.sum(F.col("size") * F.exp("tilt")).alias("rated"))
            step = (F.col("rated") - F.col("target")) / F.col("rated")
            moved = settle(found[column].alias("m").join(rated.alias("c"), same(column), "left").select(
                F.col(f"m.{column}").alias(column), "target",
                (F.col("multiplier") - F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.coalesce(step, F.lit(0.0))))).alias("multiplier"),
                F.abs(F.col("rated") / F.col("target") - 1).alias("off")), "multipliers")
            worst = max(worst, moved.agg(F.max("off")).first()[0] or 0.0)
            found[column] = moved.drop("off")
        if worst <= tolerance:
            return found
    raise ValueError("the token constraints cannot be met together")


def mix_sources(df: DataFrame, weights: list[float], max_rate: int = 3, id_col: str = "doc_id",
                source_col: str = "source", text_col: str = "text", bucket_bits: int = 12, picks: int = 3) -> DataFrame:
    """Every row of ``df`` with its columns plus ``mix_size`` (words), ``mix_source_size``,
    ``mix_target`` (its source's) and ``mix_copies`` (how often the mix takes it).

    Copies never exceed ``max_rate`` (an integer). The rows of a source are ordered by a
    hash of id and text; equal rows share it and are taken together. Sums over 2**bucket_bits ranges of the hash find
    the range in which the source's target is met; within it, hashes are taken one by one while
    they fit, and ``picks`` times the largest of the rest that still fits fills the gap; a last one is taken even if it
    is too large, if that comes nearer. So a source's words miss its target by at most half its smallest document
    left out, or by what ``picks`` documents could not fill.
    Null text: size 0. Null source: a source of its own, last in order. Null id: hashed by its text.
    Empty table: no rows. Sources of size 0 have target 0 and take nothing. Columns that clash
    with the added names are replaced.
    """
    names = ["mix_size", "mix_source_size", "mix_target", "mix_copies"]
    rows = (df.drop(*names)
            .withColumn("mix_size", word_count(F.col(text_col)))
            .withColumn("__hash", F.xxhash64(F.lit("mix"), F.col(id_col), F.col(text_col))))
    bucket = F.shiftrightunsigned("hash", 64 - bucket_bits)
    compact = settle(rows.groupBy(F.col(source_col).alias("source"), F.col("__hash").alias("hash"))
                     .agg(F.sum("mix_size").alias("words"))
                     .select("source", "hash", "words", bucket.alias("bucket")), "mix-sizes")
    histogram = settle(compact.groupBy("source", "bucket").agg(F.sum("words").alias("words")), "mix-histogram")
    sums = histogram.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = settle(source_targets(sums, weights, max_rate), "mix-targets")
    duals = entropy_multipliers(targets.select("source", F.col("source_size").alias("size")), {"source": targets.select("source", "target")})["source"]
    rate = F.least(F.lit(float(max_rate)), F.exp("multiplier"))
    targets = (targets.alias("t").join(duals.alias("d"), F.col("t.source").eqNullSafe(F.col("d.source"))).select("t.*", "multiplier")
               .withColumn("rate", F.coalesce(rate, F.lit(0.0))).drop("multiplier")
               # a rate within rounding of a whole number is that number
               .withColumn("whole", F.floor(F.col("rate") + F.lit(1e-9)))
               .withColumn("rest", F.greatest(F.lit(0.0), (F.col("rate") - F.col("whole")) * F.col("source_size"))))
    run = Window.partitionBy("source").orderBy("bucket")
    cut = (histogram.withColumn("up_to", F.sum("words").over(run))
           .join(targets.select(F.col("source").alias("key"), "rest"), F.col("source").eqNullSafe(F.col("key")))
           .where(F.col("up_to") > F.col("rest"))
           .groupBy("source").agg(F.min(F.struct("bucket", (F.col("up_to") - F.col("words")).alias("before"))).alias("cut")))
    plan = settle(targets.join(cut.withColumnRenamed("source", "key"), F.col("source").eqNullSafe(F.col("key")), "left")
                  .select(F.col("source").alias("key"), "source_size", "target", F.col("whole").cast("long").alias("whole"), "rest",
                          F.coalesce("cut.bucket", F.lit(1 << bucket_bits)).alias("cut"), F.coalesce("cut.before", "source_size").alias("before")),
                  "mix-plan")
    same = F.col("source").eqNullSafe(F.col("key"))
    edge = (compact.join(plan, same).where(F.col("bucket") == F.col("cut"))
            .withColumn("up_to", F.col("before") + F.sum("words").over(Window.partitionBy("source").orderBy("hash"))))
    fits = (edge.where(F.col("up_to") <= F.col("rest")).groupBy(F.col("source").alias("edge_key"))
            .agg(F.max("hash").alias("last"), F.max("up_to").alias("reached")))
    plan = (plan.join(fits, F.col("key").eqNullSafe(F.col("edge_key")), "left").drop("edge_key")
            .withColumn("gap", F.col("rest") - F.coalesce("reached", "before"))
            .withColumn("picked", F.lit(None).cast("array<bigint>")).drop("reached", "before"))
    plan = settle(plan, "mix-plan")
    for pick in range(picks + 1):
        free = F.when(F.col("bucket") == F.col("cut"), F.coalesce(F.col("hash") > F.col("last"), F.lit(True))).otherwise(F.col("bucket") > F.col("cut"))
        unpicked = ~F.array_contains(F.coalesce("picked", F.array().cast("array<bigint>")), F.col("hash"))
        most = F.col("gap") * F.lit(2.0 if pick == picks else 1.0)
        off = F.abs(F.col("gap") - F.col("words"))
        best = (compact.join(plan, same).where(free & unpicked & (F.col("words") > 0) & (F.col("words") <= most))
                .groupBy(F.col("source").alias("pick_key")).agg(F.min(F.struct(off.alias("off"), "words", "hash")).alias("best")))
        plan = settle(plan.join(best, F.col("key").eqNullSafe(F.col("pick_key")), "left")
                      .withColumn("gap", F.col("gap") - F.coalesce("best.words", F.lit(0)))
                      .withColumn("picked", F.concat(F.coalesce("picked", F.array().cast("array<bigint>")),
                                                     F.when(F.col("best").isNull(), F.array().cast("array<bigint>")).otherwise(F.array("best.hash"))))
                      .drop("best", "pick_key"), "mix-plan")
    plan = plan.select(*[F.col(c).alias(f"__{c}") for c in plan.columns])
    joined = rows.join(plan, F.col(source_col).eqNullSafe(F.col("__key")))
    at = F.shiftrightunsigned("__hash", 64 - bucket_bits)
    extra = ((at < F.col("__cut")) & (F.col("__rest") > 0)) | F.coalesce((at == F.col("__cut")) & (F.col("__hash") <= F.col("__last")), F.lit(False)) \
        | F.coalesce(F.array_contains("__picked", F.col("__hash")), F.lit(False))
    copies = F.least(F.col("__whole") + extra.cast("long"), F.lit(int(max_rate)).cast("long"))
    columns = [c for c in df.columns if c not in names]
    return joined.select(*columns, "mix_size", F.col("__source_size").alias("mix_source_size"),
                         F.col("__target").alias("mix_target"), copies.alias("mix_copies"))


def take_copies(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row as often as its copies say, without the added columns."""
    names = ["mix_size", "mix_source_size", "mix_target", "mix_copies"]
    return (mixed.where("mix_copies > 0")
            .withColumn("mix_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("mix_copies"))))
            .drop("mix_copy", *names))
