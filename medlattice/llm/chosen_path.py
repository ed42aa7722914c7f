"""Near-duplicates by a chosen-path set similarity join.

A text's set is its distinct shingles of words. Every tree starts with all
sets and branches recursively by minwise tokens (coordinates of the sets' minhash signatures). The first node branches by HEAD
tokens in a row, so that few sets meet by chance; a node below picks two tokens, and a set goes to the child named by its
token at each of them. A node that is small, that holds few sets outside its
main component, or a good part of which is one component, is compared exhaustively; the others branch once more, and what is large
then is compared as well: a set is in two children, so that a group that no token splits would double with every further level. Trees are independent and repeated until
the expected share of missed pairs at the threshold is below the target.

To stay linear within groups of copies: equal sets are one class; each set is first held against the smallest id
of one of its nodes, that which it shares most nodes with; links found so are joined into components, and afterwards nodes
compare only sets of different components. In large nodes, sets are compared by what parts them from the node's core, exactly.
In small nodes, candidates are filtered by 1-bit minwise sketches (allowance: 5.5 standard deviations), and then confirmed on full sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medlattice.llm.common import map_arrow, merged, mix64, settle, text_slices, word_hashes
from medlattice.llm.components import connected_components

HEAD = 3
# Levels. Rows below the first are at most 2 ** (DEPTH - 1) times its own.
DEPTH = 2
LEAF = 32
DENSE = 4
CORE_OF = 15
# Bitmaps of 32768 bits (4 KB) that texts are filtered by before they are shuffled: 4 MB at most, at every size.
BITMAPS = 1024
SKETCH_BITS = 256
# A bitmap of 512 KB, at every size: which hashed elements occur twice or more in a node.
REPEATED_BITS = 22


def shingle_sets(texts: list, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit shingle hashes of each text, sorted: (flat, offsets).

    ASCII letters are lower-cased; words are runs without ASCII white space. A text with fewer words than
    a shingle has its whole sequence as one; null or blank texts have none.
    """
    hashes, bounds = word_hashes(texts)
    out, sizes = [], []
    many = len(hashes) - words + 1
    if many > 0:
        grams = hashes[:many].copy()
        for j in range(1, words):
            grams = mix64(grams * np.uint64(0x9E3779B97F4A7C15) + hashes[j:j + many])
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= words:
            own = np.unique(grams[a:b - words + 1])
        elif b > a:
            h = np.uint64(b - a)
            whole = np.array([h], np.uint64)
            for w in hashes[a:b]:
                whole = mix64(whole * np.uint64(0x9E3779B97F4A7C15) + w)
            own = whole
        else:
            own = np.empty(0, np.uint64)
        out.append(own)
        sizes.append(len(own))
    return (np.concatenate(out) if out else np.empty(0, np.uint64)), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


@lru_cache(maxsize=None)
def trees_for(threshold: float, recall: float) -> int:
    """How many trees keep the chance to miss a pair at the threshold below 1 - recall:
    a pair survives the first level if all of its HEAD tokens agree, and each below if either child keeps it."""
    keeps = 1.0
    for _ in range(DEPTH - 1):
        keeps = 1 - (1 - threshold * keeps) ** 2
    keeps *= threshold ** HEAD
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - keeps)))


def signatures(flat: np.ndarray, offsets: np.ndarray, coordinates: int, seed: int = 20240607) -> np.ndarray:
    """Minhash values (uint32) of non-empty sets: sets x coordinates."""
    rng = np.random.default_rng(seed)
    a = rng.integers(1 << 62, size=coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    b = rng.integers(1 << 62, size=coordinates, dtype=np.uint64)
    out = np.empty((len(offsets) - 1, coordinates), np.uint32)
    for s in range(0, len(offsets) - 1, 64):  # blocks that stay in cache
        e = min(s + 64, len(offsets) - 1)
        x, at = flat[offsets[s]:offsets[e]], offsets[s:e] - offsets[s]
        for i in range(coordinates):
            out[s:e, i] = np.minimum.reduceat((x * a[i] + b[i]) >> np.uint64(32), at)
    return out


def _sketches(sig: np.ndarray) -> np.ndarray:
    """One bit of each of the first coordinates, as four longs."""
    bits = np.zeros((len(sig), SKETCH_BITS), np.uint8)
    n = min(SKETCH_BITS, sig.shape[1])
    # parity of the value: a bit that the minimum itself does not bias
    x = sig[:, :n].copy()
    for s in (16, 8, 4, 2, 1):
        x ^= x >> np.uint32(s)
    bits[:, :n] = x & np.uint32(1)
    return np.packbits(bits, axis=1).view("<i8")


# Rows without an id are documents of their own, named above all ids by their text.
NAMELESS = 1 << 62
SETS = "id long, own long, n_shingles long, s1 long, s2 long, b0 long, b1 long, b2 long, b3 long, keys array<long>"


def set_rows(df: DataFrame, words: int, trees: int) -> DataFrame:
    """(id, text, own) -> own, set size, 128-bit set hash, sketch, node of the first level in each tree."""
    coordinates = max(HEAD * trees, SKETCH_BITS)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, texts in text_slices(batch.column(1)):
                flat, offsets = shingle_sets(texts, words)
                sizes = np.diff(offsets)
                full = sizes > 0
                n = int(full.sum())
                starts = offsets[:-1][full]
                sig = signatures(flat, np.concatenate([starts, [len(flat)]]), coordinates)
                s1 = np.add.reduceat(mix64(flat ^ np.uint64(0xA5A5A5A5A5A5A5A5)), starts) if n else np.empty(0, np.uint64)
                s2 = np.add.reduceat(mix64(flat + np.uint64(0x1234567887654321)), starts) if n else np.empty(0, np.uint64)
                sketch = _sketches(sig)
                keys = np.broadcast_to(np.arange(1, trees + 1, dtype=np.uint64), (n, trees))
                for j in range(HEAD):
                    keys = mix64(keys * np.uint64(0x9E3779B97F4A7C15) + sig[:, j * trees:(j + 1) * trees])

                def spread(values, kind, full=full):
                    if len(full) == int(full.sum()):
                        return pa.array(values, kind)
                    out = np.zeros(len(full), values.dtype)
                    out[full] = values
                    return pa.array(out, kind, mask=~full)

                def lists(matrix, kind, full=full):
                    width = matrix.shape[1]
                    at = np.concatenate([[0], np.cumsum(full * width)]).astype(np.int32)
                    return pa.ListArray.from_arrays(pa.array(at), pa.array(np.ascontiguousarray(matrix).reshape(-1), kind))

                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(a, len(texts)), batch.column(2).slice(a, len(texts)), pa.array(sizes),
                    spread(s1.view(np.int64), pa.int64()), spread(s2.view(np.int64), pa.int64()),
                    *[spread(np.ascontiguousarray(sketch[:, i]), pa.int64()) for i in range(4)],
                    lists(keys.view(np.int64), pa.int64())],
                    names=["id", "own", "n_shingles", "s1", "s2", "b0", "b1", "b2", "b3", "keys"])

    return map_arrow(df.select("id", "text", "own"), build, SETS)


def full_sets(df: DataFrame, words: int) -> DataFrame:
    """(id, text) -> (id, shingles)."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, texts in text_slices(batch.column(1)):
                flat, offsets = shingle_sets(texts, words)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, len(texts)), pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat.view(np.int64)))],
                    names=["id", "shingles"])

    return map_arrow(df.select("id", "text"), build, "id long, shingles array<long>")


def _texts_of(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``texts`` with one of the distinct ``ids``. Only texts whose hashed id is marked in bitmaps of a fixed size are shuffled; the
    join decides. With far more ids than bits, all texts are shuffled."""
    marked = F.pmod(F.xxhash64("id"), F.lit(BITMAPS * 32768))
    marks = (ids.select(marked.alias("mark")).groupBy(F.expr("mark div 32768").alias("part"))
             .agg(F.bitmap_construct_agg(F.expr("mark % 32768")).alias("bits")))
    octet = F.expr("int(conv(hex(substring(bits, int(mark % 32768 div 8) + 1, 1)), 16, 10))")
    likely = (texts.withColumn("mark", marked).withColumn("part", F.expr("mark div 32768")).join(F.broadcast(marks), "part")
              .where(F.getbit(octet, F.expr("int(mark % 8)")) == 1))
    return likely.select(*texts.columns).join(merged(ids), "id")  # not a semi-join, which Spark would move below the filter


def deep_tokens(sets: DataFrame, coordinates: int) -> DataFrame:
    """(id, shingles) -> (id, deep): 16-bit tokens of the levels below the first, of independent coordinates."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets = batch.column(1).offsets.to_numpy().astype(np.int64)
            flat = batch.column(1).values.to_numpy(zero_copy_only=False).view(np.uint64)
            for a in range(0, len(batch), 1000):
                n = min(1000, len(batch) - a)
                sig = signatures(flat, offsets[a:a + n + 1], coordinates, 20250711).astype(np.uint16).view(np.int16)
                at = pa.array(np.arange(n + 1, dtype=np.int32) * coordinates)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, n), pa.ListArray.from_arrays(at, pa.array(sig.reshape(-1)))], names=["id", "deep"])

    return map_arrow(sets.select("id", "shingles"), build, "id long, deep array<short>")


def _sketch_test(percent: int, coordinates: int, a: str, b: str):
    """Condition: the sketches differ in no more bits than those of a pair at the threshold do, with 5.5 standard deviations more."""
    n = min(SKETCH_BITS, coordinates)
    p = (1 - percent / 100) / 2
    most = math.ceil(n * p + 5.5 * math.sqrt(n * p * (1 - p)))
    differ = sum((F.bit_count(F.col(f"{a}.b{i}").bitwiseXOR(F.col(f"{b}.b{i}"))) for i in range(4)), F.lit(0))
    return differ <= most


def _confirm(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are alike enough."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    sets = settle(full_sets(_texts_of(texts, settle(ids, "ids")), words), "sets")
    with_b = pairs.join(merged(sets.select(F.col("id").alias("b"), F.col("shingles").alias("set_b"))), "b")
    both = with_b.join(merged(sets.select(F.col("id").alias("a"), F.col("shingles").alias("set_a"))), "a")
    common = F.size(F.array_intersect("set_a", "set_b"))
    return both.where(100 * common >= percent * (F.size("set_a") + F.size("set_b") - common)).select("a", "b")


def _members(nodes: DataFrame) -> DataFrame:
    """Adds to (node, id, component, ...): ``outside``, the node's sets outside its main (largest)
    component, ``main``, and ``dense``: whether that has a good part of the node, which branching
    would hardly split then. Drops nodes of one component."""
    by = nodes.groupBy("node", "component").agg(F.count("*").alias("n"))
    by = (by.groupBy("node").agg(F.sum("n").alias("all"), F.max(F.struct("n", "component")).alias("top"))
          .select("node", (F.col("all") - F.col("top.n")).alias("outside"), F.col("top.component").alias("main"),
                  (F.col("top.n") * DENSE >= F.col("all")).alias("dense"))
          .where("outside > 0"))
    return nodes.join(merged(by), "node")


def _compare(members: DataFrame, sketch: DataFrame, percent: int, coordinates: int) -> DataFrame:
    """Pairs (a, b) of a small node's sets in different components that may be alike: a set outside the main component
    with any other. Their sizes and their sketches are near."""
    few = members.drop("tree", "heap").join(merged(sketch), "id")
    x, y = few.where("component != main").alias("x"), few.alias("y")
    most = F.least("x.n", "y.n")
    test = ((F.col("x.node") == F.col("y.node")) & (F.col("x.component") != F.col("y.component"))
            & ((F.col("y.component") == F.col("y.main")) | (F.col("x.id") < F.col("y.id")))
            & (100 * most >= percent * (F.col("x.n") + F.col("y.n") - most)) & _sketch_test(percent, coordinates, "x", "y"))
    differ = sum((F.bit_count(F.col(f"x.b{i}").bitwiseXOR(F.col(f"y.b{i}"))) for i in range(4)), F.lit(0)).alias("differ")
    return x.join(merged(y), test).select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"), differ)


def _apart(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """The pairs (a, b, ...) of different components, with these as ca and cb. ``known``: (node, component) of every set."""
    for x in ("a", "b"):
        pairs = pairs.join(merged(known.select(F.col("node").alias(x), F.col("component").alias(f"c{x}"))), x)
    return pairs.where("ca != cb")


def _united(known: DataFrame, links: DataFrame) -> DataFrame:
    """``known`` after further links (ca, cb) between its components."""
    above = connected_components(links.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct())
    above = above.select(F.col("node").alias("component"), F.col("component").alias("above"))
    return settle(known.join(merged(above), "component", "left").select("node", F.coalesce("above", "component").alias("component")), "components")


def _joining(pairs: DataFrame, known: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """``known`` (node, component) after the alike ones of the pairs (a, b, differ), without confirming all pairs of two components.

    Of the pairs between the same two components, the one whose sketches differ least is confirmed first. If it is alike, the two are one
    component and their other pairs are not needed; all pairs between components that are still apart then are confirmed.
    """
    pairs = settle(_apart(pairs, known), "apart")
    first = (pairs.groupBy(F.least("ca", "cb").alias("c"), F.greatest("ca", "cb").alias("d"))
             .agg(F.min(F.struct("differ", "a", "b")).alias("first")).select("first.a", "first.b"))
    first = settle(first, "pairs")
    known = _united(known, _apart(_confirm(first, texts, words, percent), known))
    rest = settle(_apart(pairs.select("a", "b").join(merged(first), ["a", "b"], "left_anti"), known).select("a", "b"), "pairs")
    return _united(known, _apart(_confirm(rest, texts, words, percent), known))


def _pooled(nodes: DataFrame) -> DataFrame:
    """(node, id, component) with the nodes that are connected by common sets as one: a set is in one of them only."""
    pivot = nodes.groupBy("node").agg(F.min("id").alias("b"))
    met = settle(nodes.join(merged(pivot), "node").select(F.col("id").alias("a"), "b").distinct(), "met")
    pools = connected_components(met).select(F.col("node").alias("id"), F.xxhash64(F.lit("pool"), "component").alias("node"))
    return nodes.select("id", "component").distinct().join(merged(pools), "id").select("node", "id", "component")


def _slots(nodes: pa.Array, lists: pa.ListArray) -> np.ndarray:
    """The bitmap's slot of each (node, element)."""
    own = np.repeat(nodes.to_numpy().view(np.uint64) * np.uint64(0x9E3779B97F4A7C15), lists.value_lengths().to_numpy(zero_copy_only=False))
    return (mix64(lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64) + own) >> np.uint64(64 - REPEATED_BITS)).astype(np.int64)


def _repeated_only(sets: DataFrame) -> DataFrame:
    """``sets`` without the elements of ``diff`` that surely no other set of the node has. Each task marks the slots that it has seen once and twice;
    these bitmaps merge by blocks. With far more elements than slots, more elements stay."""
    blocks, size = 64, 1 << REPEATED_BITS

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(size, bool), np.zeros(size, bool)
        for batch in batches:
            slot, n = np.unique(_slots(batch.column(0), batch.column(1)), return_counts=True)
            twice[slot] |= once[slot] | (n > 1)
            once[slot] = True
        bits = [[b.tobytes() for b in np.packbits(x).reshape(blocks, -1)] for x in (once, twice)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(blocks, dtype=np.int32)), pa.array(bits[0]), pa.array(bits[1])], names=["block", "once", "twice"])

    def merge(block: pa.Table) -> pa.Table:
        once, twice = np.zeros(size // blocks // 8, np.uint8), np.zeros(size // blocks // 8, np.uint8)
        for x, y in zip(block["once"].to_pylist(), block["twice"].to_pylist()):
            x, y = np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8)
            twice |= y | (once & x)
            once |= x
        return pa.table({"block": block["block"][:1], "twice": pa.array([twice.tobytes()])})

    marked = map_arrow(sets.select("node", "diff"), mark, "block int, once binary, twice binary").groupBy("block").applyInArrow(merge, "block int, twice binary")
    twice = np.zeros(size // 8, np.uint8).reshape(blocks, -1)
    for r in marked.collect():
        twice[r["block"]] = np.frombuffer(r["twice"], np.uint8)
    shared = sets.sparkSession.sparkContext.broadcast(twice.reshape(-1))
    names = sets.columns

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            diff = batch.column(names.index("diff"))
            stays = seen[_slots(batch.column(names.index("node")), diff)]
            ends = np.concatenate([[0], np.cumsum(diff.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(stays)])[ends].astype(np.int32)
            short = pa.ListArray.from_arrays(pa.array(ends), diff.flatten().filter(pa.array(stays)))
            yield pa.RecordBatch.from_arrays([short if c == "diff" else batch.column(i) for i, c in enumerate(names)], names=names)

    return map_arrow(sets, keep, sets.schema)


def _compare_by_difference(members: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components of large nodes, confirmed on full sets, without comparing all pairs.

    The core of a node is what most of up to CORE_OF of its sets, picked by hashed id, have in common (a passage that
    many documents share, for one). Any core gives the same links; a good one leaves little of a set. d(X) is what a set X and the core do not have in common. X and Y are linked if and only if
        2 * (100 + percent) * |d(X) & d(Y)| >= f(X) + f(Y), where f(X) = (100 + percent) * |d(X)| - (100 - percent) * |X|.
    The center is the set of least f. All sets are held against it; a set that is not linked with it
    needs something of d in common with any set that it is linked with, and how much follows from f and the
    center's f. Elements that no other set has are dropped by a bitmap, and sets that are left with too little of d.
    The rest are joined with the others on the rarest elements of d, as many as the need leaves.
    """
    keep, lose = 100 + percent, 100 - percent
    none = F.array().cast("array<long>")
    sets = settle(members.select("node", "id", "component").distinct().join(full, "id"), "compared")
    some = (sets.groupBy("node", F.pmod(F.xxhash64("id"), F.lit(CORE_OF)).alias("part")).agg(F.min("id").alias("id")).drop("part"))
    tokens = sets.join(some, ["node", "id"]).select("node", F.explode("shingles").alias("shingle"))
    core = (tokens.groupBy("node", "shingle").agg(F.count("*").alias("times")).join(some.groupBy("node").agg(F.count("*").alias("of")), "node")
            .where("2 * times > of").groupBy("node").agg(F.collect_list("shingle").alias("core")))
    core = settle(core, "cores")
    core_or_none = F.coalesce("core", none)
    apart = sets.join(core, "node", "left").select(
        "node", "id", "component", F.size("shingles").alias("n"),
        F.concat(F.array_except("shingles", core_or_none), F.array_except(core_or_none, "shingles")).alias("diff"))
    apart = settle(apart.withColumn("f", (keep * F.size("diff") - lose * F.col("n")).cast("long")), "differences")
    least = apart.groupBy("node").agg(F.min(F.struct("f", "id")).alias("least")).select("node", F.col("least.id").alias("id"))
    center = settle(apart.join(least, ["node", "id"]).select(
        "node", F.struct("id", "component", "f", "diff").alias("center")), "centers")
    held = apart.join(center, "node").withColumn(
        "linked", 2 * keep * F.size(F.array_intersect("diff", "center.diff")) >= F.col("f") + F.col("center.f"))
    held = settle(held.select(
        "node", "id", "component", "f", "diff", "linked", F.col("center.id").alias("center"),
        (~F.col("linked") & (F.col("component") != F.col("center.component"))).alias("probes"),
        # what a set has in common with any set that it may be linked with, where either is not linked with the center
        F.greatest(F.floor((F.col("f") - F.col("center.f")) / (2 * keep)) + 1, F.ceil((F.col("f") + F.col("center.f")) / (2 * keep))).alias("need"),
        F.greatest(F.lit(1), F.ceil((F.col("f") + F.col("center.f")) / (2 * keep))).alias("probe_need"),
        (F.col("component") != F.col("center.component")).alias("other")), "held")
    star = held.where("linked and other and id != center").select(F.least("id", "center").alias("a"), F.greatest("id", "center").alias("b"))

    own = ["node", "id", "component", "f", "need", "probe_need", "probes", "offers"]

    def able(sets: DataFrame) -> DataFrame:
        return (sets.withColumn("probes", F.col("probes") & (F.size("diff") >= F.col("probe_need")))
                .withColumn("offers", F.col("offers") & (F.size("diff") >= F.col("need"))).where("probes or offers"))

    rest = able(held.withColumn("offers", F.lit(True)).select(*own, "diff"))
    rest = able(_repeated_only(rest))
    tokens = settle(rest.select(*own, F.explode("diff").alias("token")), "tokens")
    useful = (tokens.groupBy("node", "token").agg(F.count("*").alias("n"), F.max("probes").alias("p"), F.max("offers").alias("o"))
              .where("n > 1 and p and o").select("node", "token", "n"))
    rest = (tokens.join(merged(useful), ["node", "token"]).groupBy(*own).agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("useful"))
            .withColumn("probes", F.col("probes") & (F.size("useful") >= F.col("probe_need")))
            .withColumn("offers", F.col("offers") & (F.size("useful") >= F.col("need"))).where("probes or offers"))
    rest = settle(rest.select(*own, "useful"), "rest")

    def prefix(need: str, role: str):
        """Rows of the first elements, each with the number of elements from it on."""
        first = F.slice("useful", F.lit(1), (F.size("useful") - F.col(need) + 1).cast("int"))
        return rest.where(role).select("node", "id", "component", "f", F.size("useful").alias("size"),
                           F.posexplode(F.transform(first, lambda t: t["token"])).alias("place", "token"))

    x, y = prefix("probe_need", "probes").alias("x"), prefix("need", "offers").alias("y")
    # at the first element in common, no more than those from there on can be in common
    most = F.least(F.col("x.size") - F.col("x.place"), F.col("y.size") - F.col("y.place"))
    pairs = x.join(merged(y), (F.col("x.node") == F.col("y.node")) & (F.col("x.token") == F.col("y.token"))
                   & (F.col("x.component") != F.col("y.component")) & (2 * keep * most >= F.col("x.f") + F.col("y.f")))
    pairs = pairs.select(F.col("x.node").alias("node"), F.col("x.id").alias("a"), F.col("y.id").alias("b"),
                         (F.col("x.f") + F.col("y.f")).alias("f")).distinct()
    tokens = rest.select("node", "id", F.col("useful.token").alias("tokens"))
    pairs = (pairs.join(merged(tokens.withColumnsRenamed({"id": "a", "tokens": "x"})), ["node", "a"])
             .join(merged(tokens.withColumnsRenamed({"id": "b", "tokens": "y"})), ["node", "b"])
             .where(2 * keep * F.size(F.array_intersect("x", "y")) >= F.col("f")))
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return star.union(pairs)


def _document(id_col: str, text_col: str) -> Column:
    own = F.col(id_col).cast("long")
    named = F.when(own < NAMELESS, own).otherwise(F.raise_error(F.lit("ids must be below 2**62")).cast("long"))
    return F.when(own.isNull(), F.lit(NAMELESS) + F.pmod(F.xxhash64(text_col), F.lit(NAMELESS // 2))).otherwise(named)


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80,
                    recall: float = 0.999999) -> DataFrame:
    """(id, n_shingles, component_id, kept), one row per input row.

    Sets with 100 * |A & B| >= percent * |A | B| are linked; component_id is the smallest id that links reach, and a row is
    kept if it has that id. Null, empty or blank texts have no set and are linked with nothing. Rows that
    share an id are one document for linking. Rows with a null id are linked like others, and never kept where links reach a row with an id;
    of linked texts that all lack ids one is kept, with its repeated rows (component null). Empty table: no rows. Other columns are ignored.
    """
    found = _components(df.select(_document(id_col, text_col).alias("id"), F.col(id_col).cast("long").alias("own"), F.col(text_col).alias("text")),
                        words, percent, recall)
    return found.select(F.col("own").alias(id_col), "n_shingles", F.when(F.col("component") < NAMELESS, F.col("component")).alias("component_id"),
                        (F.col("id") == F.col("component")).alias("kept"))


def _components(rows: DataFrame, words: int, percent: int, recall: float) -> DataFrame:
    """(id, own, text) -> (id, own, n_shingles, component), the smallest id that links reach."""
    trees = trees_for(percent / 100, recall)
    below = 2 ** DEPTH - 2
    coordinates = max(HEAD * trees, SKETCH_BITS)
    texts = rows.select("id", "text")
    sets = settle(set_rows(rows, words, trees), "sets")
    found = (sets.where("n_shingles > 0").groupBy("s1", "s2")
             .agg(F.min(F.struct("id", "n_shingles", "b0", "b1", "b2", "b3", "keys")).alias("x")))
    classes = settle(found.select("s1", "s2", "x.*"), "classes")
    sketch = classes.select("id", "b0", "b1", "b2", "b3")

    # First level. Each set and the pivot that it shares most nodes with.
    level = classes.select("id", F.posexplode("keys").alias("tree", "node"))
    pivots = level.groupBy("node").agg(F.count("*").alias("n"), F.min("id").alias("a")).where("n > 1").drop("n")
    level = settle(level.join(merged(pivots), "node"), "level")
    stars = level.where("id != a").groupBy(F.col("id").alias("b"), "a").agg(F.count("*").alias("nodes"))
    stars = stars.groupBy("b").agg(F.max(F.struct("nodes", F.bitwise_not("a").alias("a"))).alias("best")).select(F.bitwise_not("best.a").alias("a"), "b")
    stars = (stars.alias("p").join(merged(sketch.alias("x")), F.col("p.a") == F.col("x.id"))
             .join(merged(sketch.alias("y")), F.col("p.b") == F.col("y.id"))
             .where(_sketch_test(percent, coordinates, "x", "y")).select("a", "b"))
    edges = settle(_confirm(settle(stars, "stars"), texts, words, percent), "links")
    components = connected_components(edges)

    # Below: only sets of different components are compared.
    known = merged(components.withColumnRenamed("node", "id"))
    sizes = classes.join(known, "id", "left").select("id", F.coalesce("component", "id").alias("component"), F.col("n_shingles").alias("n"))
    nodes = level.join(merged(sizes), "id").select("node", "id", "component", "n", "tree", F.lit(1).alias("heap"))
    compared, links = [], [edges]
    for depth in range(1, DEPTH + 1):
        members = settle(_members(nodes), "members")
        small = F.col("outside") <= LEAF
        compared.append(settle(_compare(members.where(small), sketch, percent, coordinates), "pairs"))
        many = members.where(~small)
        if many.isEmpty():
            break
        if depth == 1:
            ids = settle(many.select("id").distinct(), "ids")
            full = settle(full_sets(_texts_of(texts, ids), words), "sets")
        ready = F.lit(True) if depth == DEPTH else F.col("dense")
        # Dense nodes of one main component hold much the same sets: they are compared as one. So are the last nodes that share sets.
        chosen = many.where("dense").select(F.xxhash64(F.lit("main"), "main").alias("node"), "id", "component")
        if depth == DEPTH:
            chosen = chosen.union(_pooled(many.where("not dense")))
        chosen = settle(chosen.distinct(), "chosen")
        if not chosen.isEmpty():
            links.append(settle(_compare_by_difference(chosen, full, percent), "links"))
        many = many.where(~ready)
        if depth == DEPTH or many.isEmpty():
            break
        if depth == 1:
            deep = settle(deep_tokens(full.join(settle(many.select("id").distinct(), "ids"), "id", "left_semi"), trees * below), "deep")
        child = F.explode(F.array(F.lit(0), F.lit(1)))
        branched = (many.drop("outside", "main", "dense").join(merged(deep), "id")
                    .withColumn("child", child).withColumn("heap", 2 * F.col("heap") + F.col("child")))
        token = F.element_at("deep", (F.col("tree") * below + F.col("heap") - 1).cast("int"))
        nodes = branched.select(F.xxhash64("node", "heap", token).alias("node"), "id", "component", "n", "tree", "heap")
    more = compared[0]
    for c in compared[1:]:
        more = more.union(c)
    more = settle(more.distinct(), "pairs")
    every = links[0]
    for found in links[1:]:
        every = every.union(found)
    known = connected_components(settle(every.distinct(), "links")).withColumnRenamed("node", "id")
    known = settle(classes.select("id").join(merged(known), "id", "left").select(F.col("id").alias("node"), F.coalesce("component", "id").alias("component")), "components")
    known = _joining(more, known, texts, words, percent)
    named = classes.select("s1", "s2", "id").join(merged(known.withColumnRenamed("node", "id")), "id").select("s1", "s2", "component")
    out = sets.select("id", "own", "n_shingles", "s1", "s2").join(merged(settle(named, "components")), ["s1", "s2"], "left")
    return out.select("id", "own", "n_shingles", F.coalesce("component", "id").alias("component"))


def drop_near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80,
                         recall: float = 0.999999) -> DataFrame:
    """The rows of ``df`` that stay, one document of each group, with all their columns."""
    document = _document(id_col, text_col)
    rows = df.select(document.alias("id"), F.col(id_col).cast("long").alias("own"), F.col(text_col).alias("text"))
    lost = settle(_components(rows, words, percent, recall).where("id != component").select("id").distinct(), "lost")
    name = "__document" + "_" * max((len(c) for c in df.columns), default=0)
    return df.withColumn(name, document).join(lost.withColumnRenamed("id", name), name, "left_anti").select(*df.columns)
