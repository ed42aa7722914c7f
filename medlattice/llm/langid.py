"""Language identification with language-bitmask n-gram filters.

Character n-grams (runs of letters, a space only at either end) of labelled texts are counted
by language. A gram belongs to every language in which it is frequent
enough next to the language that uses it most. One bit-sliced Bloom filter holds all languages: each of its slots is
a bitmask with one bit a language, and the AND over a gram's slots returns all
languages that contain the gram (and some that do not, by false positives). A text's count for a language is the number
of its grams with that bit, corrected for the language's false-positive rate; the largest count decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from medlattice.llm.common import map_arrow, mix64, settle, text_slices

UNDETERMINED = "und"
SIZES = (3, 4)
# Grams that a task holds while it counts.
_MOST_HELD = 1 << 20
_letters: np.ndarray | None = None


def _is_letter() -> np.ndarray:
    """For each code point, whether it is a letter (built once a worker)."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def grams(texts: list, sizes=SIZES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all n-grams of some texts: (hashes, start of each text's hashes, has letters).

    Null counts as empty. The grams of one size follow those of another, so the starts are given
    for each size: an array of len(sizes) rows and len(texts) + 1 columns.
    """
    low = [(t or "").lower() for t in texts]
    joined = " " + " ".join(low) + " "
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _is_letter()[points]
    c = np.where(letter, points, 32).astype(np.uint64)
    begins = np.concatenate([[0], np.cumsum([len(t) + 1 for t in low])])
    hashes, starts, total = [], [], 0
    for n in sizes:
        if len(c) < n:
            starts.append(np.full(len(texts) + 1, total))
            continue
        m = len(c) - n + 1
        inner = letter[1:1 + m].copy()
        for j in range(2, n - 1):
            inner &= letter[j:j + m]
        at = np.flatnonzero(inner)
        h = np.full(len(at), n, np.uint64)
        for j in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + c[at + j]
        starts.append(total + np.searchsorted(at, begins))
        hashes.append(mix64(h))
        total += len(at)
    counted = np.concatenate([[0], np.cumsum(letter)])
    edges = np.minimum(begins, len(points))
    return (np.concatenate(hashes) if hashes else np.empty(0, np.uint64), np.array(starts),
            counted[edges[1:]] > counted[edges[:-1]])


@dataclass
class LanguageFilter:
    languages: list[str]
    slots: np.ndarray  # a bitmask of languages for each slot; its length is a power of two
    hashes: int

    @property
    def false_positive(self) -> np.ndarray:
        """By language: the chance that a gram it lacks has its bit."""
        fill = np.array([np.mean((self.slots >> self.slots.dtype.type(i)) & self.slots.dtype.type(1))
                         for i in range(len(self.languages))])
        return fill ** self.hashes

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """For each gram hash, the bitmask of the languages that contain it."""
        bits = (len(self.slots) - 1).bit_length()
        out = None
        for i in range(self.hashes):
            got = self.slots[slot_of(hashes, i, bits)]
            out = got if out is None else out & got
        return out

    def scores(self, texts: list, sizes=SIZES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(corrected counts: texts x languages, grams of each text, whether it has letters)."""
        hashes, starts, letters = grams(texts, sizes)
        masks = self.lookup(hashes)
        counts = np.zeros((len(texts), len(self.languages)))
        n = np.zeros(len(texts))
        rates = self._rates if hasattr(self, "_rates") else self.false_positive
        self._rates = rates
        for row in starts:
            n += row[1:] - row[:-1]
        for i in range(len(self.languages)):
            run = np.concatenate([[0], np.cumsum((masks >> masks.dtype.type(i)) & masks.dtype.type(1), dtype=np.int64)])
            for row in starts:
                counts[:, i] += run[row[1:]] - run[row[:-1]]
        return np.maximum(0, (counts - n[:, None] * rates) / np.maximum(1e-9, 1 - rates)), n, letters


def slot_of(hashes: np.ndarray, i: int, bits: int) -> np.ndarray:
    """The i-th slot of a gram hash, by double hashing."""
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return ((hashes + np.uint64(i) * step) & np.uint64((1 << bits) - 1)).astype(np.int64)


def fit_language_filter(df: DataFrame, text_col: str, lang_col: str, id_col: str, docs_per_language: int = 3000,
                        least_docs: int = 3, least_share: float = 0.25, slot_bits: int = 18,
                        hashes: int = 3, sizes=SIZES) -> LanguageFilter:
    """Learn the filter from the rows of ``df`` with a non-null language.

    ``docs_per_language`` bounds the labelled sample: with more rows, a language
    takes about so many, those with the smallest hashed ids. A gram is put into a language's slice if at least
    ``least_docs`` of its sample documents (or a third of them, when it has few) have it, and if its share of documents there is at least
    ``least_share`` of the largest share over all languages. Languages are ordered by their number of rows, then by
    code point; at most 64 are allowed. The collected filter has at most 2**slot_bits rows.
    """
    spark = df.sparkSession
    known = df.where(F.col(lang_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(lang_col).alias("lang"),
        (F.xxhash64(F.lit("fit"), F.col(id_col), F.col(lang_col)) / F.lit(float(2 ** 64)) + 0.5).alias("u"))
    rows = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(65).collect()
    if len(rows) > 64:
        raise ValueError("more than 64 languages")
    languages = [r["lang"] for r in rows]
    kind = np.uint8 if len(rows) <= 8 else np.uint32 if len(rows) <= 32 else np.uint64
    if not rows:
        return LanguageFilter([], np.zeros(1 << slot_bits, kind), hashes)
    taken = F.lit(False)
    for r in rows:
        taken = taken | ((F.col("lang") == r["lang"]) & (F.col("u") < docs_per_language / r["count"]))
    sizes_by = {r["lang"]: min(r["count"], docs_per_language) for r in rows}
    index = {x: i for i, x in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, held = {}, 0

        def counts() -> Iterator[pa.RecordBatch]:
            for i, parts in seen.items():
                v, c = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v.view(np.int64)), pa.array(np.full(len(v), i, np.int32)), pa.array(c.astype(np.int64))],
                    names=["gram", "lang", "n"])

        for batch in batches:
            langs = batch.column(1).to_pylist()
            # Hashed in small slices, counted over many texts: fewer rows for the shuffle than from each slice.
            for a, texts in text_slices(batch.column(0)):
                h, starts, _ = grams(texts, sizes)
                for k in range(len(texts)):
                    own = np.unique(np.concatenate([h[row[k]:row[k + 1]] for row in starts]))
                    seen.setdefault(index[langs[a + k]], []).append(own)
                    held += len(own)
                if held >= _MOST_HELD:
                    yield from counts()
                    seen, held = {}, 0
        yield from counts()

    counted = map_arrow(known.where(taken).select("text", "lang"), count, "gram long, lang int, n long")
    shares = [F.sum(F.when(F.col("lang") == i, F.col("n")).otherwise(0)) / float(sizes_by[x]) for i, x in enumerate(languages)]
    by_gram = counted.groupBy("gram").agg(*[s.alias(f"s{i}") for i, s in enumerate(shares)])
    top = F.greatest(*[F.col(f"s{i}") for i in range(len(languages))]) if len(languages) > 1 else F.col("s0")
    mask: Column = F.lit(0).cast("long")
    for i, x in enumerate(languages):
        least = min(least_docs, max(1, sizes_by[x] // 3)) / sizes_by[x]
        here = (F.col(f"s{i}") >= F.lit(least) * 0.999) & (F.col(f"s{i}") >= F.lit(least_share) * top)
        bit = (1 << i) if i < 63 else -(1 << 63)
        mask = mask.bitwiseOR(F.when(here, F.lit(bit)).otherwise(F.lit(0)).cast("long"))
    members = by_gram.select("gram", mask.alias("mask")).where("mask != 0")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            g = batch.column(0).to_numpy().view(np.uint64)
            slot = np.concatenate([slot_of(g, i, slot_bits) for i in range(hashes)])
            yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(np.tile(batch.column(1).to_numpy(), hashes))],
                                             names=["slot", "mask"])

    placed = settle(map_arrow(members, place, "slot long, mask long").groupBy("slot").agg(F.expr("bit_or(mask)").alias("mask")), "slots").toPandas()
    slots = np.zeros(1 << slot_bits, kind)
    slots[placed["slot"].to_numpy(np.int64)] = placed["mask"].to_numpy(np.int64).view(np.uint64).astype(kind)
    return LanguageFilter(languages, slots, hashes)


def predict_language(df: DataFrame, model: LanguageFilter, text_col: str = "text", keep: list[str] | None = None,
                     sizes=SIZES) -> DataFrame:
    """``keep`` (default: all columns but clashing ones) plus lang_pred, score and coverage of every whole text.

    lang_pred: a learned language, or ``und`` if the text is null or has no letter (or
    nothing was learned). score: the winner's corrected count over that of all languages. coverage: the
    winner's corrected count over the text's grams. A tie goes to the language learned first;
    a text whose grams are all unknown gets that language too, with score 0.
    The filter (2**slot_bits slots) is broadcast; its size does not depend on the data.
    """
    added = ["lang_pred", "score", "coverage"]
    keep = [c for c in (keep if keep is not None else df.columns) if c not in added]
    shared = df.sparkSession.sparkContext.broadcast(model)
    source = df.select(*keep, F.col(text_col).alias("__text"))
    schema = df.select(*keep).schema.add("lang_pred", "string").add("score", "double").add("coverage", "double")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            lang, score, cover = [], [], []
            for _, texts in text_slices(batch.column(batch.num_columns - 1)):
                if not m.languages:
                    lang += [UNDETERMINED] * len(texts)
                    score += [0.0] * len(texts)
                    cover += [0.0] * len(texts)
                    continue
                counts, n, letters = m.scores(texts, sizes)
                best = counts.argmax(axis=1)
                top = counts[np.arange(len(texts)), best]
                lang += [m.languages[i] if ok else UNDETERMINED for i, ok in zip(best, letters)]
                score += np.where(letters, top / np.maximum(counts.sum(axis=1), 1e-9), 0.0).tolist()
                cover += np.where(letters, np.minimum(1, top / np.maximum(n, 1)), 0.0).tolist()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(cover, pa.float64())],
                names=[*keep, *added])

    return map_arrow(source, predict, schema)


def held_out(id_col: Column) -> Column:
    """Whether crc32 of the id as text is divisible by 5; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def identify_languages(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                       keep: list[str] | None = None) -> DataFrame:
    """Learn from the rows that are not held out, and predict every row.

    Returns ``keep`` (default: the id) plus held_out, lang_pred, score and coverage. An empty table gives no rows. Rows
    with a null language are predicted but not learned from; repeated rows are predicted alike.
    """
    model = fit_language_filter(df.where(~held_out(F.col(id_col))), text_col, lang_col, id_col)
    out = df.withColumn("held_out", held_out(F.col(id_col)))
    return predict_language(out, model, text_col, [*(keep or [id_col]), "held_out"])
