"""Best-fit packing of tokenized documents into sequences, by best-two-fit.

A bin is filled greedily, each time with the longest piece that fits. Then its smallest
piece is exchanged for two unpacked pieces if some two fill the gap that this opens more tightly. Pieces
as long as a sequence fill one alone. Pieces are dealt by a hash into groups of bounded expected size, each packed by
one task; the pieces of bins that stay far from full are dealt again, into fewer groups, until none is left or a
round saves nothing.
"""

from __future__ import annotations

import re
import struct
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from medlattice.llm.common import map_arrow, settle

# Words of plain ASCII or Latin-1 letters: their normal form is their lower case.
_MARKS = frozenset(bytes([c]) for c in range(33, 127) if not chr(c).isalnum())
_PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ]+")
# The tokenizer's own pre-token pattern, as it reads for lower-cased plain words (fixed value).
_PRE_TOKENS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
_tokenizers: dict[str, "WordTokenizer"] = {}


class WordTokenizer:
    """Ids of the tokenizers library, with the ids of words kept.

    The tokenizer's pre-tokens never span white space, so a text's ids are those of its words (runs without
    ASCII white space) in turn. A kept word costs one lookup. Texts with marks of special tokens go to the
    library whole. Memory is bounded: words and pre-tokens are kept in two generations of ``most`` entries each (some 200 bytes an
    entry, so 120 MB in all); the older one is dropped when the younger one is full, and what is still in use moves on. A task
    forgets them at its end, so that the stages after it have the room.
    """

    def __init__(self, path: str, most: int = 150_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = False
        self.most = most
        self.forget()
        self.letters = _byte_letters()
        self.model = self.tokenizer.model

    def forget(self) -> None:
        self.words: dict[bytes, bytes] = {}
        self.parts: dict[str, bytes] = {}
        self.old_words: dict[bytes, bytes] = {}
        self.old_parts: dict[str, bytes] = {}

    def _part(self, pre_token: str) -> bytes:
        """Ids of a pre-token of a plain word."""
        got = self.parts.get(pre_token)
        if got is not None:
            return got
        got = self.old_parts.get(pre_token)
        if got is None:
            ids = [t.id for t in self.model.tokenize(pre_token if pre_token.isascii() else pre_token.encode().decode("latin-1").translate(self.letters))]
            got = struct.pack(f"<{len(ids)}I", *ids)
        if len(self.parts) >= self.most:
            self.old_parts, self.parts = self.parts, {}
        if len(pre_token) <= 64:
            self.parts[pre_token] = got
        return got

    def word(self, word: bytes) -> bytes:
        got = self.words.get(word)
        if got is not None:
            return got
        got = self.old_words.get(word)
        if got is not None:
            pass
        elif word.isalpha():  # bytes: ASCII letters
            got = self._part(word.decode().lower())
        elif word[:-1].isalpha() and word[-1:] in _MARKS:
            got = self._part(word[:-1].decode().lower()) + self._part(word[-1:].decode())
        elif _PLAIN.fullmatch(text := word.decode("utf-8", "surrogatepass")):
            got = b"".join(map(self._part, _PRE_TOKENS.findall(text.lower())))
        else:
            got = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        if len(self.words) >= self.most:
            self.old_words, self.words = self.words, {}
        if len(word) <= 64:
            self.words[word] = got
        return got

    def encode(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit numbers."""
        if "<|" in text:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        words = text.encode("utf-8", "surrogatepass").split()
        got = list(map(self.words.get, words))
        if None in got:
            got = [self.word(w) if x is None else x for w, x in zip(words, got)]
        return b"".join(got)


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for the code points from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {**{b: chr(b) for b in shown}, **{b: chr(256 + i) for i, b in enumerate(hidden)}}


def _tokenizer(path: str) -> WordTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def token_pieces(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", length: int = 4096,
                 end_id: int = 1) -> DataFrame:
    """(doc_id, piece, start, length, ids): each text's ids and ``end_id``, cut into pieces of at most
    ``length``; ids are little-endian unsigned 32-bit numbers. Null text: empty (its end id alone)."""
    end = np.array([end_id], "<u4").tobytes()
    kind = df.schema[id_col].dataType
    from pyspark.sql.types import BinaryType, IntegerType, LongType, StructField, StructType

    schema = StructType([StructField("doc_id", kind), StructField("piece", IntegerType()), StructField("start", LongType()),
                         StructField("length", LongType()), StructField("ids", BinaryType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(tokenizer_path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                row, piece, pieces = [], [], []
                for i, text in enumerate(part.column(1).to_pylist()):
                    ids = tokenizer.encode(text or "") + end
                    for k, s in enumerate(range(0, len(ids), 4 * length)):
                        row.append(i)
                        piece.append(k)
                        pieces.append(ids[s:s + 4 * length])
                n = np.array([len(x) // 4 for x in pieces], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(np.array(piece, np.int64) * length),
                     pa.array(n), pa.array(pieces, pa.binary())], names=["doc_id", "piece", "start", "length", "ids"])
        tokenizer.forget()

    return map_arrow(df.select(id_col, text_col), cut, schema)


class _Lengths:
    """A multiset of lengths 1..capacity with its distinct members sorted."""

    def __init__(self, lengths: np.ndarray, capacity: int):
        self.left = np.bincount(lengths, minlength=capacity + 1).tolist()
        self.present = [i for i, n in enumerate(self.left) if n]

    def take(self, n: int) -> None:
        self.left[n] -= 1
        if not self.left[n]:
            del self.present[bisect_right(self.present, n) - 1]

    def put(self, n: int) -> None:
        if not self.left[n]:
            self.present.insert(bisect_right(self.present, n), n)
        self.left[n] += 1

    def largest(self, most: int) -> int:
        i = bisect_right(self.present, most)
        return self.present[i - 1] if i else 0

    def best_two(self, most: int) -> tuple[int, int]:
        """Two members whose sum is the largest up to ``most``; (0, 0) if none are."""
        best, pair = 0, (0, 0)
        p, i, j = self.present, 0, bisect_right(self.present, most) - 1
        while i <= j:
            total = p[i] + p[j]
            if total > most or (i == j and self.left[p[i]] < 2):
                if i == j:
                    break
                if total > most:
                    j -= 1
                    continue
            if total > best:
                best, pair = total, (p[i], p[j])
                if best == most:
                    break
            i += 1
        return pair


def best_two_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins of indices of ``lengths`` (each 1..capacity)."""
    rest = _Lengths(lengths, capacity)
    bins: list[list[int]] = []
    while rest.present:
        content: list[int] = []
        gap = capacity
        while gap and (n := rest.largest(gap)):
            rest.take(n)
            content.append(n)
            gap -= n
        if gap and rest.present:
            smallest = content[-1]
            a, b = rest.best_two(gap + smallest)
            if a + b > smallest:
                rest.take(a)
                rest.take(b)
                rest.put(smallest)
                content[-1:] = [a, b]
        bins.append(content)
    order = np.argsort(lengths, kind="stable")
    by_length = np.searchsorted(lengths[order], np.arange(capacity + 2))
    following = by_length[:-1].tolist()
    out = []
    for content in bins:
        own = []
        for n in content:
            own.append(int(order[following[n]]))
            following[n] += 1
        out.append(own)
    return out


PLACED = "row long, sequence_id long, offset long, fill long"


def _pack_groups(pieces: DataFrame, capacity: int, groups: int, turn: int) -> DataFrame:
    """(row, length) packed in ``groups`` groups dealt by hash. Numbers: 8 bits of turn, 31 of group, 24 of bin."""

    def pack(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(list(batches))
        rows, lengths = whole.column("row").to_numpy(), whole.column("length").to_numpy()
        order = np.lexsort((rows, lengths))
        rows, lengths = rows[order], lengths[order]
        out = ([], [], [], [])
        for k, content in enumerate(best_two_fit(lengths, capacity)):
            offset, fill = 0, int(lengths[content].sum())
            for i in content:
                for x, v in zip(out, (int(rows[i]), turn << 55 | key[0].as_py() << 24 | k, offset, fill)):
                    x.append(v)
                offset += int(lengths[i])
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()),
                                          pa.array(out[3], pa.int64())], names=["row", "sequence_id", "offset", "fill"])

    dealt = pieces.select("row", "length", F.pmod(F.xxhash64("row", F.lit(turn)), F.lit(groups)).alias("group"))
    return dealt.groupBy("group").applyInArrow(pack, PLACED)


def pack_lengths(pieces: DataFrame, capacity: int = 4096, group_pieces: int = 2048) -> DataFrame:
    """(row, length) with distinct rows -> (row, sequence_id, offset), in few sequences of at most ``capacity``.

    After each round the pieces of bins filled below 99 % are dealt again, until they were one group, or a round
    saves no bin (their bins then stay as they were; 256 rounds at most). Lengths must be 1..capacity. A piece as long as a
    sequence has a negative number, the others do not.
    """
    full = pieces.where(F.col("length") == capacity).select(
        "row", (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    done, open_ = [full], pieces.where(F.col("length") < capacity)
    poor = poor_bins = None
    good = F.col("fill") * 100 >= capacity * 99
    for r in range(256):
        groups = max(1, -(-open_.count() // group_pieces))
        placed = settle(_pack_groups(open_, capacity, groups, r), "placed")
        # each bin has one piece at its start
        bins, good_bins = placed.where("offset = 0").agg(F.count("*"), F.count_if(good)).first()
        if poor is not None and bins >= poor_bins:
            break
        if groups == 1:
            poor = placed
            break
        done.append(placed.where(good).drop("fill"))
        poor, poor_bins = placed.where(~good), bins - good_bins
        if not poor_bins:
            break
        open_ = settle(poor.select("row").join(pieces, "row"), "open")
    done.append(poor.drop("fill"))
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def pack_documents(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", length: int = 4096,
                   end_id: int = 1, keep_ids: bool = True) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset[, ids]), one row per piece.

    Texts are tokenized once; the pieces are a table in the shared folder, with their ids if ``keep_ids``. Every input row is packed,
    repeated rows as well. Null text: its end id alone. Null id: kept as null. Empty table: no rows. Other columns are ignored.
    """
    pieces = token_pieces(df, tokenizer_path, id_col, text_col, length, end_id).withColumn("ids_crc32", F.crc32("ids"))
    if not keep_ids:
        pieces = pieces.drop("ids")
    # numbered when written: the number stays the row's, whatever is computed again later
    pieces = settle(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    placed = pack_lengths(pieces.select("row", "length"), length)
    out = pieces.join(placed, "row")
    return out.select(F.col("doc_id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset",
                      *(["ids"] if keep_ids else []))


def packed_sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids): the pieces of :func:`pack_documents` joined, at most one sequence's tokens each."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), parts.alias("parts"))
            .select("sequence_id", "length", F.aggregate("parts", F.lit(b""), lambda s, p: F.concat(s, p["ids"])).alias("ids")))
