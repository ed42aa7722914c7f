"""Jaccard similarity join above a threshold, without all pairs of a common code.

Every code gets a global rank, rarest first; a patient's set is the ascending array of its ranks. Patients with the
same set are one class, so copies cost nothing. Two sets with similarity >= t share a code among their
first ones, and the smaller set needs fewer of them: only these prefixes are joined, with a length filter (sizes within t) and a position
filter (what is left after the shared code must be enough). Candidates are then confirmed on the whole sets. No code is dropped:
a common code is simply last in every set, so it is in a prefix only where a set has little else.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlattice.operators.graph import jaccard_of_counts, shared_counts
from medlattice.operators.indexing import dense_index
from medlattice.session import maybe_broadcast, written

# Prefix rows of one code per (code, salt) task on the indexed side.
SALT_TARGET = 2048
# Classes that hold a code whose pairs are all counted, at low thresholds.
RARE = 64


def ranked_sets(pairs: DataFrame, code_cols: tuple[str, ...] = ("kind", "code"), key: str = "patient_id") -> DataFrame:
    """key, codes: each key's distinct codes as ascending ranks (rarest first, ties by code). Rows with a null key or code are ignored."""
    cols = list(code_cols)
    e = written(pairs.select(key, *cols).dropna().distinct(), "key-codes")  # read twice: for the ranks and for the sets
    ranks = dense_index(e.groupBy(*cols).agg(F.count(F.lit(1)).alias("_d")), ["_d", *cols], "_rank")
    return (e.join(maybe_broadcast(ranks.drop("_d")), cols)
            .groupBy(key).agg(F.array_sort(F.collect_list("_rank")).alias("codes")))


def set_classes(pairs: DataFrame, code_cols: tuple[str, ...] = ("kind", "code"), key: str = "patient_id") -> tuple[DataFrame, DataFrame]:
    """(members, classes): key, class_id for every key with a code, and class_id, members, n, codes for every distinct
    set; class_id is the smallest key of the set. Keys without a code are in no class."""
    sets = written(ranked_sets(pairs, code_cols, key), "key-sets")
    classes = written(sets.groupBy("codes").agg(F.min(key).alias("class_id"), F.count(F.lit(1)).alias("members")).select(
        "class_id", "members", F.size("codes").cast("long").alias("n"), "codes"), "set-classes")
    # Written, since callers read the members more than once: the whole sets would be joined each time.
    members = written(sets.join(classes.select("codes", "class_id"), "codes").select(key, "class_id"), "class-members")
    return members, classes


def similar_classes(classes: DataFrame, threshold: tuple[int, int], salt_target: int = SALT_TARGET, rare: int = RARE) -> DataFrame:
    """G4/J15 above a threshold: class_1 < class_2, members_1, members_2, similarity for every two classes with
    similarity >= threshold (numerator, denominator; above 0). Members of one class have similarity 1.

    With sets ordered by size, the smaller one (size n) shares at least 2t/(1+t) * n codes with the larger one, which shares at
    least t * its own size; that many codes cannot all be behind the prefixes. A code with many indexed prefixes is split by salts.
    Up to a threshold of 1/3 prefixes are most of a set, and drop few pairs: there, the codes up to the first one of more than ``rare`` classes
    are counted whole for every two classes, and only the codes from it on go by prefixes. Sets are not moved for a count: a pair
    is confirmed on the codes from there on alone, if its count and these together can reach the threshold.
    """
    num, den = threshold
    if not 0 < num <= den:
        raise ValueError("the threshold must be above 0 and at most 1")

    def ceil(value, by):
        return F.floor((value + (by - 1)) / F.lit(by))

    first, rest = 0, True
    if 3 * num <= den:
        held = classes.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("d"))
        hot, last = held.agg(F.min(F.when(F.col("d") > rare, F.col("code"))), F.max("code")).first()
        first, rest = (hot, True) if hot is not None else ((-1 if last is None else last) + 1, False)

    def prefix(least):
        return F.posexplode(F.slice("codes", F.lit(1), (F.col("n") - least + 1).cast("int")))

    found = None
    if first:
        found = shared_counts(classes.select("class_id", F.explode("codes").alias("code")).where(F.col("code") < first), "class_id", ["code"], salt_target)
    if rest:
        small = classes.select(F.col("class_id").alias("a"), F.col("n").alias("na"), prefix(ceil(2 * num * F.col("n"), den + num)).alias("pa", "code")).where(F.col("code") >= first)
        large = classes.select(F.col("class_id").alias("b"), F.col("n").alias("nb"), prefix(ceil(num * F.col("n"), den)).alias("pb", "code")).where(F.col("code") >= first)
        ways = small.groupBy("code").agg(F.ceil(F.count(F.lit(1)) / F.lit(salt_target)).alias("ways")).where("ways > 1")
        salts = F.coalesce("ways", F.lit(1))
        small = small.join(maybe_broadcast(ways), "code", "left").withColumn("salt", F.pmod(F.xxhash64("a"), salts)).drop("ways")
        large = (large.join(maybe_broadcast(ways), "code", "left")
                 .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))).drop("ways"))
        most = 1 + F.least(F.col("na") - F.col("pa") - 1, F.col("nb") - F.col("pb") - 1)
        near = ((F.col("na") < F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("a") < F.col("b")))) & (den * F.col("na") >= num * F.col("nb"))
        met = (small.join(large, ["code", "salt"]).where(near & ((den + num) * most >= num * (F.col("na") + F.col("nb"))))
               .select(F.least("a", "b").alias("p1"), F.greatest("a", "b").alias("p2")).distinct().withColumn("i", F.lit(0).cast("long")))
        found = met if found is None else found.unionByName(met).groupBy("p1", "p2").agg(F.sum("i").alias("i"))
    tail = F.filter("codes", lambda c: c >= first)
    sizes = maybe_broadcast(written(classes.select("class_id", "members", "n", F.size(tail).cast("long").alias("tail")), "class-sizes"))
    both = found.join(sizes.toDF("p1", "m1", "n1", "t1"), "p1").join(sizes.toDF("p2", "m2", "n2", "t2"), "p2")
    both = both.where((den + num) * (F.col("i") + F.least("t1", "t2")) >= num * (F.col("n1") + F.col("n2")))
    if rest:
        tails = classes.select("class_id", tail.alias("x"))
        both = (both.join(tails.toDF("p1", "x1"), "p1").join(tails.toDF("p2", "x2"), "p2")
                .withColumn("i", F.col("i") + F.size(F.array_intersect("x1", "x2"))).where((den + num) * F.col("i") >= num * (F.col("n1") + F.col("n2"))))
    return both.select(F.col("p1").alias("class_1"), F.col("p2").alias("class_2"), F.col("m1").alias("members_1"), F.col("m2").alias("members_2"),
                       jaccard_of_counts("i", "n1", "n2").alias("similarity"))
