"""Personal data: base patterns, and candidate spans judged by boosted trees.

Base spans follow fixed formats (email, ip, card, phone) with their checks. Generators of high recall
propose further, overlapping spans. Gradient-boosted trees score a candidate free of base spans by its format and context.
Their labels do not come from the base formats: positives are free candidates with evidence of their own (a cue word
right before them, a checksum, a spelled-out "at"), and base spans rewritten into formats that the base does not know. Half of the
positives with evidence hide their cue words from the trees, which so learn more than the rule of the labels.
For each kind, the threshold is the lowest at which examples, scored by trees that have not seen them, have the
wanted precision; candidates without evidence count as wrong, however often they occur. A kind of which the corpus has no base span and no
evidence has no threshold. Accepted candidates that overlap no better one become spans, with their probability.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from medlattice.llm.boosting import ONE, BoostedTrees, binned, fit_folds
from medlattice.llm.common import map_arrow, settle, text_slices

KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_CHAIN = re.compile(r"[0-9]+(?:\.[0-9]+)+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NUMERIC = re.compile(r"\+?\(?[0-9][0-9 ()./:-]{4,}[0-9]")
# A spelled-out "at" in brackets and the domain after it; the name before it is found by walking left, so long runs cost no rescans.
_AT = re.compile(r"[(\[{] ?at ?[)\]}] ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|[(\[{] ?dot ?[)\]}]) ?[A-Za-z0-9-]{1,63}){1,8}", re.I)
_MOST_LOCAL = 64
_CUES = {"email": re.compile(r"mail|correo|courriel", re.I), "ip": re.compile(r"\bip\b|address|server|host", re.I),
         "card": re.compile(r"card|visa|konto|tarjeta|carte", re.I), "phone": re.compile(r"phone|tel|call|mobil|fax", re.I)}

# Right before a span: a word that names its kind, then filler words and signs at most.
_NAMED = {k: re.compile(rf"\b(?:{words})\b(?: (?:no|nr|number|address|me|us|to|at|on|is|of))*[\s.:#=,<(]*$", re.I) for k, words in (
    ("email", "e-?mails?|mail|write|contact|reach|correo|courriel"), ("ip", "ip|ipv4|address|server|host"),
    ("card", "card|visa|mastercard|amex|konto|tarjeta|carte"), ("phone", "phone|telephone|tel|mobile|mobil|fax|call|dial"))}
_YEARS = re.compile(r"(?:1[0-9]|20)[0-9]{2}(?:[ ./:-]+[0-9]{1,2}){2}|(?:[0-9]{1,2}[ ./:-]+){2}(?:1[0-9]|20)[0-9]{2}|(?:1[0-9]|20)[0-9]{2}[ ./:-]+(?:1[0-9]|20)[0-9]{2}")
CONTEXT = 24
_WINDOW = 64


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2]) + sum((0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for d in digits[-2::-2])
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        m = _DOMAIN.match(text, at + 1)
        if m:
            start = at
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                yield start, m.end()
                done = m.end()
        at = text.find("@", max(at + 1, done))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    # A chain of numbers matches four at a time from its start, whether or not they pass.
    for m in _CHAIN.finditer(text):
        parts, at = m[0].split("."), m.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k:k + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, end
            at = end + 1


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    if "+" not in text:
        return
    for m in _PHONE.finditer(text):
        if 9 <= sum(map(str.isdigit, m[0])) <= 15:
            yield m.span()


_BASE = {"email": _emails, "ip": _ips, "card": _cards, "phone": _phones}


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns' spans, by start, then kind in its listed order."""
    found = [(s, e, k) for k, f in _BASE.items() for s, e in f(text)]
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


def candidates(text: str) -> list[tuple[int, int, str]]:
    """Proposed spans of each kind; they overlap, and many are wrong."""
    out = []
    for m in _NUMERIC.finditer(text):
        out += [(*m.span(), kind) for kind in ("ip", "card", "phone")]
    at = text.find("@")
    while at >= 0:
        s, e = at, at + 1
        while s > 0 and at - s < 64 and not text[s - 1].isspace():
            s -= 1
        while e < len(text) and e - at < 256 and not text[e].isspace():
            e += 1
        out.append((s, e, "email"))
        at = text.find("@", at + 1)
    for m in _AT.finditer(text):
        e = m.start() - text.startswith(" ", max(0, m.start() - 1), m.start())
        s = e
        while s > 0 and e - s < _MOST_LOCAL and text[s - 1] in _LOCAL:
            s -= 1
        if s < e:
            out.append((s, m.end(), "email"))
    return out


def features(text: str, start: int, end: int, kind: str) -> list[float]:
    """Format of the span, and its context (24 characters to either side)."""
    span, left, right = text[start:end], text[max(0, start - CONTEXT):start], text[end:end + CONTEXT]
    groups = re.findall(r"[0-9]+", span)
    digits = "".join(groups)
    sizes = [len(g) for g in groups] or [0]
    n = max(1, len(span))
    return [KINDS.index(kind), len(span), len(digits), len(groups), max(sizes), min(sizes), sizes[0], sizes[-1],
            span.count("."), span.count("-"), span.count(" "), span.count("/") + span.count(":"), span.count("(") + span.count(")"),
            span.startswith("+"), span.count("@"), sum(map(str.isalpha, span)) / n, len(digits) > 1 and luhn(digits),
            all(len(g) <= 3 and int(g) <= 255 for g in groups), "." in span.partition("@")[2],
            left[-1:].isalnum(), left[-1:].isspace(), right[:1].isalnum(), right[:1].isspace(),
            sum(map(str.isdigit, left + right)), bool(_CUES[kind].search(left)), "\n" in left[-1:] + right[:1],
            bool(_NAMED[kind].search(left))]


def evident(text: str, start: int, end: int, kind: str) -> bool:
    """Whether something besides the base formats shows that a candidate is of its kind."""
    span = text[start:end]
    named = bool(_NAMED[kind].search(text[max(0, start - CONTEXT):start]))
    groups = re.findall(r"[0-9]+", span)
    digits = "".join(groups)
    if kind == "email":
        return bool(_AT.search(span) and "@" not in span and re.search(r"[A-Za-z]{2,}$", span) or named and re.fullmatch(r"[\w.%+-]+@[\w-]+", span))
    if kind == "ip":
        return named and len(groups) == 4 and all(len(g) <= 3 and int(g) <= 255 for g in groups)
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits) and (named or [len(g) for g in groups] == [4, 4, 4, 4])
    return named and 7 <= len(digits) <= 15 and not _YEARS.fullmatch(span)


def disguised(span: str, kind: str) -> str:
    """A base span in one of the formats that the base does not know, by a hash of the span."""
    digits = re.sub(r"[^0-9]", "", span)
    fours = [digits[i:i + 4] for i in range(0, len(digits), 4)]
    local, _, domain = span.partition("@")
    forms = {"email": (f"{local} (at) {domain}", f"{local} [at] {domain}", f"{local} (at) {domain.replace('.', ' (dot) ')}", f"{local}[at]{domain.replace('.', '[dot]')}"),
             "ip": (span.replace(".", "-"), span.replace(".", " . "), span.replace(".", ":")),
             "card": (".".join(fours), "/".join(fours), "  ".join(fours)),
             "phone": (span.lstrip("+"), "00" + span.lstrip("+"), "00 " + span.lstrip("+"))}[kind]
    return forms[zlib.crc32(span.encode("utf-8", "surrogatepass")) % len(forms)]


def examples(text: str) -> Iterator[tuple[int, str, int, int, str]]:
    """(stratum, text, start, end, kind) to learn from: 3 * kind + 0 for a free candidate without evidence, + 1 for one
    with evidence, + 2 for a base span in disguise (whose text is rewritten)."""
    base = base_spans(text)
    covered = _covered(base)
    for s, e, k in candidates(text):
        if not _overlaps(s, e, covered):
            yield 3 * KINDS.index(k) + evident(text, s, e, k), text, s, e, k
    for s, e, k in base:
        left, new = text[max(0, s - _WINDOW):s], disguised(text[s:e], k)
        twin, at = left + new + text[e:e + _WINDOW], len(left)
        taken = _covered(base_spans(twin))
        over = [(min(c[1], at + len(new)) - max(c[0], at), -c[0], c) for c in candidates(twin) if c[2] == k and not _overlaps(c[0], c[1], taken)]
        if over and max(over)[0] > len(new) // 2:
            yield 3 * KINDS.index(k) + 2, twin, *max(over)[2]


@dataclass
class SpanModel:
    trees: BoostedTrees
    thresholds: dict[str, float] = field(default_factory=dict)

    def added(self, text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int, str, float]]:
        """Accepted candidates with their probability, the most probable first where some overlap, apart from base spans."""
        if not self.thresholds:
            return []
        covered = _covered(base)
        proposed = [c for c in candidates(text) if c[2] in self.thresholds and not _overlaps(c[0], c[1], covered)]
        if not proposed:
            return []
        p = self.trees.probability(np.array([features(text, *c) for c in proposed], float))
        starts, taken = [], []
        for score, c in sorted(zip(p.tolist(), proposed), key=lambda x: (-x[0], x[1])):
            at = bisect_left(starts, c[1])  # spans taken before do not overlap: the last that starts before this one's end decides
            if score >= self.thresholds[c[2]] and not (at and taken[at - 1][1] > c[0]):
                starts.insert(at, c[0])
                taken.insert(at, (*c, score))
        return taken


def _covered(spans) -> tuple[list[int], list[int]]:
    """Starts of spans sorted by start, and the furthest end up to each."""
    return [s for s, _, _ in spans], list(accumulate((e for _, e, _ in spans), max))


def _overlaps(start: int, end: int, covered: tuple[list[int], list[int]]) -> bool:
    before = bisect_left(covered[0], end)
    return before > 0 and covered[1][before - 1] > start


def _mark(text: str, start: int, end: int, kind: str) -> int:
    """Hash of a span with its context."""
    seen = "\0".join((text[max(0, start - CONTEXT):start], text[start:end], text[end:end + CONTEXT]))
    return int.from_bytes(hashlib.blake2b(seen.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


_CUE_FEATURES = (24, 26)


_FEATURES = 27
_FOLDS = 5
_MOST_HELD = 20_000


def _examples(df: DataFrame) -> DataFrame:
    """(stratum, h, x, n): all examples of all texts, equal ones (by their hash of span and context) as one row with a count. x: features as doubles."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], list] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in held], pa.int32()), pa.array([h for _, h in held], pa.int64()),
                 pa.array([x for x, _ in held.values()], pa.binary()), pa.array([n for _, n in held.values()], pa.int64())],
                names=["stratum", "h", "x", "n"])

        for batch in batches:
            for _, texts in text_slices(batch.column(0)):
                for k, *x in (e for text in texts for e in examples(text)):
                    own = k, _mark(*x)
                    if own in held:
                        held[own][1] += 1
                        continue
                    held[own] = [np.array(features(*x), float).tobytes(), 1]
                    if len(held) >= _MOST_HELD:
                        yield out()
                        held = {}
        yield out()

    found = map_arrow(df, rows, "stratum int, h long, x binary, n long")
    return settle(found.groupBy("stratum", "h", "x").agg(F.sum("n").alias("n")), "examples")


def _features_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, stratum, hash) of rows of :func:`_examples`; half of the positives with evidence hide their cue words."""
    x = np.frombuffer(b"".join(batch.column(2).to_pylist()), float).reshape(-1, _FEATURES).copy()
    stratum, h = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    hidden = (stratum % 3 == 1) & (h // _FOLDS % 2 == 0)
    for j in _CUE_FEATURES:
        x[hidden, j] = 0
    return x, stratum, h


def _edges(seen: DataFrame, weights: np.ndarray, bins: int = 32) -> list[np.ndarray]:
    """For each feature the values at which its weighted examples part into ``bins`` equal shares."""
    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, stratum, _ = _features_of(batch)
                for j in range(_FEATURES):
                    v, at = np.unique(x[:, j], return_inverse=True)
                    w = np.zeros(len(v), np.int64)
                    np.add.at(w, at, weights[stratum])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), j, np.int32)), pa.array(v), pa.array(w)], names=["j", "v", "w"])

    counted = map_arrow(seen, values, "j int, v double, w long").groupBy("j", "v").agg(F.sum("w").alias("w"))
    run = (counted.withColumn("upto", F.sum("w").over(Window.partitionBy("j").orderBy("v")))
           .withColumn("total", F.sum("w").over(Window.partitionBy("j"))))
    parted = run.where(F.expr(f"least({bins - 1}, ({bins} * upto) div total) > ({bins} * (upto - w)) div total"))
    out: list[list[float]] = [[] for _ in range(_FEATURES)]
    for r in parted.select("j", "v").orderBy("j", "v").collect():
        out[r.j].append(r.v)
    return [np.array(v, float) for v in out]


def fit_span_model(df: DataFrame, text_col: str = "text", fit_rows: int = 4000, precision: float = 0.98, least: int = 20) -> SpanModel:
    """Trees and thresholds from all examples of all documents. Equal examples count once for the trees, and a stratum of more than
    ``fit_rows`` examples weighs as so many there, so that the few positives are heard. Five fits score each fifth by the others, and thresholds are
    from these scores of all examples, as often as they occur; scores less than 2**-16 apart may count as equal.
    A kind with fewer than ``least`` different positives (with evidence, or in disguise) has none."""
    seen = _examples(df.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")))
    totals, different = np.zeros(3 * len(KINDS)), np.zeros(3 * len(KINDS), np.int64)
    for r in seen.groupBy("stratum").agg(F.sum("n").alias("n"), F.count("*").alias("c")).collect():
        totals[r.stratum], different[r.stratum] = r.n, r.c
    known = [i for i in range(len(KINDS)) if different[3 * i + 1:3 * i + 3].sum() >= least]
    if not known:
        return SpanModel(BoostedTrees())
    weights = np.rint(np.minimum(1.0, fit_rows / np.maximum(1.0, totals)) * ONE).astype(np.int64)
    edges = _edges(seen, weights)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, stratum, h = _features_of(batch)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b.tobytes() for b in binned(x, edges)], pa.binary()), pa.array((h % _FOLDS).astype(np.int32)), batch.column(0),
                     pa.array(weights[stratum]), batch.column(3)], names=["bins", "fold", "stratum", "weight", "n"])

    rows = settle(map_arrow(seen, place, "bins binary, fold int, stratum int, weight long, n long").groupBy("bins", "fold", "stratum")
                  .agg(F.sum("weight").alias("weight"), F.sum("n").alias("n")), "binned")
    models = fit_folds(rows.withColumn("y", (F.col("stratum") % 3 > 0).cast("int")), edges, _FOLDS)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper = [np.append(e, np.inf) for e in edges]  # a bin's scores are those of its upper end
        for batch in batches:
            if batch.num_rows:
                bins = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(-1, _FEATURES)
                x = np.stack([e[bins[:, j]] for j, e in enumerate(upper)], axis=1)
                fold, p = batch.column(1).to_numpy(), np.zeros(len(bins))
                for k in range(_FOLDS):
                    p[fold == k] = models[k].probability(x[fold == k])
                yield pa.RecordBatch.from_arrays([batch.column(2), batch.column(3), pa.array(p)], names=["stratum", "n", "p"])

    scored = map_arrow(rows.select("bins", "fold", "stratum", "n"), score, "stratum int, n long, p double")
    cells = scored.groupBy(F.expr("stratum div 3").alias("kind"), F.floor(F.col("p") * 65536).alias("cell")).agg(
        F.min("p").alias("low"), F.max("p").alias("high"), F.sum(F.when(F.col("stratum") % 3 > 0, F.col("n")).otherwise(0)).alias("right"), F.sum("n").alias("n"))
    found, thresholds = cells.orderBy("kind", F.desc("cell")).toPandas(), {}
    for i in known:
        own = found[found.kind == i]
        good = np.flatnonzero((own.right.cumsum() / own.n.cumsum()).to_numpy() >= precision)
        if len(good):
            last, below = own.low.iloc[good[-1]], own.high.iloc[good[-1] + 1:good[-1] + 2]
            thresholds[KINDS[i]] = max(0.5, float(last + below.iloc[0]) / 2 if len(below) else 0.0)
    return SpanModel(models[-1], thresholds)


def find_personal_data(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", fit_rows: int = 4000, keep_text: bool = False) -> DataFrame:
    """(id, base array<struct<kind,start,end>>, spans likewise with probability [, text]), one row per input row.

    Base spans are by start, then kind as listed in KINDS, and have no probability; ``spans`` also has the accepted candidates. Places are code
    points, the end exclusive. Null text: empty, no spans. Null ids are kept. Empty table: no rows. Other columns are ignored. Time is linear in a text's
    length, with long runs of one sign as well. The model (trees and thresholds, some tens of KB at most) is broadcast.
    """
    model = df.sparkSession.sparkContext.broadcast(fit_span_model(df, text_col, fit_rows))
    kind = df.schema[id_col].dataType.simpleString()
    span = "array<struct<kind:string,start:bigint,end:bigint%s>>"
    parts = [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]
    arrow, scored = pa.list_(pa.struct(parts)), pa.list_(pa.struct([*parts, ("probability", pa.float64())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, spans = [], []
            for _, texts in text_slices(batch.column(1)):
                for text in texts:
                    found = base_spans(text)
                    more = sorted([(*x, None) for x in found] + model.value.added(text, found), key=lambda x: (x[0], KINDS.index(x[2])))
                    base.append([{"kind": k, "start": s, "end": e} for s, e, k in found])
                    spans.append([{"kind": k, "start": s, "end": e, "probability": p} for s, e, k, p in more])
            columns = [batch.column(0), pa.array(base, arrow), pa.array(spans, scored)] + ([batch.column(1)] if keep_text else [])
            yield pa.RecordBatch.from_arrays(columns, names=["id", "base", "spans", "text"][:len(columns)])

    out = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    out = map_arrow(out, find, f"id {kind}, base {span % ''}, spans {span % ',probability:double'}" + (", text string" if keep_text else ""))
    return out.withColumnRenamed("id", id_col)


def redact(found: DataFrame, mask: str = "#") -> DataFrame:
    """Adds ``redacted`` to :func:`find_personal_data` (with its text): every span's characters are ``mask``."""
    def cut(text: str, spans) -> str:
        out = list(text)
        for s in spans:
            out[s["start"]:s["end"]] = mask * (s["end"] - s["start"])
        return "".join(out)

    @F.pandas_udf("string")
    def masked(text, spans):  # noqa: ANN001
        import pandas as pd
        return pd.Series([cut(t, s) for t, s in zip(text, spans)])

    return found.withColumn("redacted", masked("text", "spans"))


def span_text(spans: Column) -> Column:
    """kind:start:end items, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
