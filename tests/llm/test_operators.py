"""Each operator against brute force on small tables with nulls, empty texts, ties, repeated and clashing columns."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("medlattice.llm")

from medlattice.llm import chosen_path, exact_dedup, langid, mixing, packing, pii, quality, url_trust, warc, winnowing  # noqa: E402
from medlattice.llm.queries import URL_RULES, tokenizer_path  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, words long"
WORDS = "alpha beta gamma delta omega sigma kappa lambda theta zeta".split()


def _text(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(WORDS[i] + str(rng.integers(50)) for i in rng.integers(len(WORDS), size=n))


@pytest.fixture(scope="module")
def docs(spark):
    long = _text(1, 4000)
    near = [" ".join(w if i != 7 * k else "edited" for i, w in enumerate(_text(2, 120).split())) for k in range(1, 9)]
    rows = [(1, "One two three.", "en", "a"), (2, None, None, None), (3, "", "de", "b"), (4, " \t\n", "en", "a"), (5, long, "en", "a"),
            (6, "One two three.", "en", None), (7, "one TWO three.", "en", "a"), (8, "Ünï códe wörter 日本語", "de", "b"),
            (8, "Ünï códe wörter 日本語", "de", "b"), (9, "x", "en", "c"), (None, "no id", "en", "c"), (10, "<|endoftext|> don't", "en", "c")]
    rows += [(20 + i, t, "en", "a") for i, t in enumerate(near)]
    return spark.createDataFrame([(*r, 1, 2, 3) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


def _words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def test_exact(docs, empty):
    out = exact_dedup.exact_duplicates(docs).toPandas()
    rows = docs.toPandas()
    assert len(out) == len(rows)
    by = {}
    for r in rows.itertuples():
        by.setdefault(r.text or "", []).append(r.doc_id)
    want = Counter((hashlib.sha256(t.encode()).hexdigest(), max([i for i in ids if i == i], default=None), len(ids)) for t, ids in by.items() for _ in ids)
    got = Counter((r.text_sha256, None if r.keep_id != r.keep_id else r.keep_id, r.group_size) for r in out.itertuples())
    assert got == want
    assert exact_dedup.exact_duplicates(empty).count() == 0
    kept = exact_dedup.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns and kept.select("text").distinct().count() == docs.select("text").distinct().count() - 1


def test_filters_merge_without_loss():
    rng = np.random.default_rng(3)
    parts = [np.unique(rng.integers(1 << 52, size=500, dtype=np.uint64), return_counts=True) for _ in range(3)]
    parts.append(parts[0])
    coded = [exact_dedup.decode_filter(*exact_dedup.encode_filter(v, c.astype(np.int64), 52), 52) for v, c in parts]
    values, counts = exact_dedup.merge_sorted(coded)
    want = Counter()
    for v, c in parts:
        for a, b in zip(v.tolist(), c.tolist()):
            want[a] += b
    assert dict(zip(values.tolist(), counts.tolist())) == dict(want)


@pytest.mark.parametrize(("words", "percent", "leaf"), [(3, 85, 32), (5, 80, 1)])
def test_near(docs, empty, words, percent, leaf, monkeypatch):
    monkeypatch.setattr(chosen_path, "LEAF", leaf)
    out = chosen_path.near_duplicates(docs, words=words, percent=percent).toPandas()
    rows = [r for r in docs.collect() if r.doc_id is not None]
    sets = {}
    for r in rows:
        w = _words(r.text)
        sets[r.doc_id] = {tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} - {()}
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                up[y] = x
    for r in out.itertuples():
        if r.doc_id == r.doc_id:
            assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), root(r.doc_id), r.doc_id == root(r.doc_id))
    assert len(out) == docs.count() and chosen_path.near_duplicates(empty).count() == 0


def test_near_copies_without_ids(spark):
    """Rows without an id are linked: they go where a row with an id stays, and one of them stays where there is none."""
    text, other = _text(3, 60), _text(4, 60)
    rows = [(None, text), (7, text + " end"), (None, other), (None, other + " end"), (None, other), (None, None), (None, ""), (8, None)]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, __lost int, __document string")
    out = chosen_path.near_duplicates(df).collect()
    got = Counter((r.doc_id, r.component_id, r.n_shingles, r.kept) for r in out)
    named = Counter({(7, 7, 57, True): 1, (None, 7, 56, False): 1, (8, 8, 0, True): 1, (None, None, 0, True): 2})
    assert got - named in [Counter({(None, None, 56, k): 2, (None, None, 57, not k): 1}) for k in (True, False)] and not named - got
    kept = chosen_path.drop_near_duplicates(df)
    assert kept.columns == df.columns
    texts = Counter((r.doc_id, r.text) for r in kept.collect())
    rest = Counter({(7, text + " end"): 1, (None, None): 1, (None, ""): 1, (8, None): 1})
    assert texts - rest in (Counter({(None, other): 2}), Counter({(None, other + " end"): 1})) and not rest - texts


@pytest.mark.parametrize(("words", "percent"), [(3, 85), (5, 80)])
def test_near_clusters(spark, words, percent, monkeypatch):
    """Large groups of near copies on both sides of the threshold, with edits that some share, in large nodes only."""
    monkeypatch.setattr(chosen_path, "LEAF", 2)
    rng = np.random.default_rng(7)
    rows = []
    for base in range(2):
        tokens = _text(100 + base, 90).split()
        for i in range(110):
            own = list(tokens)
            for place in rng.choice(90, size=rng.integers(0, 9), replace=False):
                kind = rng.integers(4)
                own[place] = f"new{rng.integers(10 ** 9)}" if kind < 2 else "shared" if kind == 2 else ""
            rows.append((1000 * base + i * 7 % 110, " ".join(own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: {tuple(w[k:k + words]) for k in range(len(w) - words + 1)} for i, w in ((i, _words(t)) for i, t in rows)}
    label = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while moved := [(a, b) for a, b in links if label[a] != label[b]]:
        for a, b in moved:
            label[a] = label[b] = min(label[a], label[b])
    assert len(set(label.values())) > 10
    out = chosen_path.near_duplicates(df, words=words, percent=percent).collect()
    assert {r.doc_id: r.component_id for r in out} == label
    # every link between different components, by difference alone and with no component known before
    texts = df.withColumnRenamed("doc_id", "id")
    full = chosen_path.full_sets(texts, words)
    members = texts.selectExpr("id div 1000 AS node", "id", "id AS component")
    found = {(r.a, r.b) for r in chosen_path._compare_by_difference(members, full, percent).collect()}
    assert found <= set(links)
    label = {i: i for i in sets}
    while moved := [(a, b) for a, b in found if label[a] != label[b]]:
        for a, b in moved:
            label[a] = label[b] = min(label[a], label[b])
    assert {r.doc_id: r.component_id for r in out} == label


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path())
    packed = packing.pack_documents(docs, tokenizer_path(), length=512)
    out = packed.toPandas()
    want = Counter()
    for r in docs.collect():
        ids = np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [1], "<u4")
        for k, s in enumerate(range(0, len(ids), 512)):
            want[(r.doc_id, k, s, len(ids[s:s + 512]), zlib.crc32(ids[s:s + 512].tobytes()))] += 1
    assert Counter((None if r.doc_id != r.doc_id else r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out.itertuples()) == want
    for _, g in out.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.length.sum() <= 512 and g.offset.tolist() == [0, *g.length.cumsum()[:-1]]
    whole = packing.packed_sequences(packed).collect()
    assert sum(len(r.ids) for r in whole) == 4 * out.length.sum()
    assert packing.pack_documents(empty, tokenizer_path()).count() == 0


def test_best_two_fit():
    rng = np.random.default_rng(0)
    lengths = rng.integers(1, 100, size=500)
    bins = packing.best_two_fit(lengths, 100)
    assert sorted(i for b in bins for i in b) == list(range(500)) and all(lengths[b].sum() <= 100 for b in bins)
    first_fit = []
    for n in sorted(lengths.tolist(), reverse=True):
        k = next((k for k, used in enumerate(first_fit) if used + n <= 100), None)
        if k is None:
            first_fit.append(n)
        else:
            first_fit[k] += n
    assert len(bins) <= len(first_fit) * 1.02 + 1


def test_pieces_are_dealt_until_nothing_is_saved(spark):
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 100, size=3000)
    pieces = spark.createDataFrame(list(enumerate(lengths.tolist())), "row long, length long")
    out = packing.pack_lengths(pieces, 100, group_pieces=16).join(pieces, "row").toPandas()
    assert sorted(out.row) == list(range(3000))
    for _, g in out.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.length.sum() <= 100 and g.offset.tolist() == [0, *g.length.cumsum()[:-1]]
    assert out.sequence_id.nunique() <= len(packing.best_two_fit(lengths, 100)) * 1.03


def test_mixing(docs, empty):
    out = mixing.mix_sources(docs, [5, 2, 1]).toPandas()
    size = {s: sum(len(_words(r.text)) for r in docs.collect() if r.source == s) for s in ("a", "b", "c", None)}
    total, weights = sum(size.values()), {"a": 5, "b": 2, "c": 1, None: 5}
    open_, target = set(size), {}
    while open_:
        left = total - sum(target.values())
        share = {s: left * weights[s] / sum(weights[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * size[s]}
        if not over:
            target |= share
            break
        target |= {s: 3.0 * size[s] for s in over}
        open_ -= over
    for r in out.itertuples():
        assert r.mix_target == pytest.approx(target[r.source if isinstance(r.source, str) else None]) and 0 <= r.mix_copies <= 3
    assert mixing.mix_sources(empty, [5, 2, 1]).count() == 0
    assert mixing.take_copies(mixing.mix_sources(docs, [5, 2, 1])).columns == docs.columns


def test_winnowing(docs, empty):
    out = winnowing.fingerprint_pairs(docs, k=2, window=4).collect()
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text or ""), reverse=True)
    want = Counter()
    for r, following in zip(rows, rows[1:] + rows[:1]):
        t, n = r.text or "", len(r.text or "")
        edited = t[:n - n // 2] + (following.text or "")[:n // 2]
        blank = not re.split(r"[\x20\x09-\x0D]+", t.strip(" \t\n\v\f\r"))[0]
        want[(r.doc_id, n, hashlib.sha256(edited.encode()).hexdigest(), blank)] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint == "") for r in out) == want
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)
    assert winnowing.fingerprint_pairs(empty).count() == 0


def test_winnowing_guarantee(spark):
    common = " ".join(f"c{i}" for i in range(5))  # k + window - 1 = 5 words
    df = spark.createDataFrame([(i, f"{_text(i, 40)} {common} {_text(100 + i, 30)}") for i in range(20)], "id long, t string")
    rows = winnowing.with_fingerprint(df, "t", "p", k=2, window=4).select(winnowing.gram_hashes("p").alias("h"), "t", "p").collect()
    assert set.intersection(*[set(r.h) for r in rows])
    for r in rows:  # at least one chosen gram in each window, positions ascending
        at = [2147483647 - (g & 2147483647) for g in r.p]
        assert at == sorted(at) and all(b - a <= 4 for a, b in zip(at, at[1:]))


def test_languages(docs, empty):
    out = langid.identify_languages(docs).toPandas()
    assert len(out) == docs.count() and out.score.between(0, 1).all()
    assert (out[out.doc_id.isin([2, 3, 4])].lang_pred == "und").all()
    assert langid.identify_languages(empty).count() == 0


def test_texts_go_to_workers_in_small_batches(spark):
    """Batches are bounded by bytes: whole batches of 10,000 texts took an executor of the pipeline beyond its memory."""
    import pyarrow as pa

    def measure(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["rows", "bytes"])

    df = spark.range(0, 3000, 1, 1).selectExpr("repeat('some text ', 1000) as text")
    langid.predict_language(df, langid.LanguageFilter([], np.zeros(4, np.uint8), 1)).count()  # operators set the bound
    got = df.mapInArrow(measure, "rows long, bytes long").collect()
    assert sum(r.rows for r in got) == 3000 and max(r.bytes for r in got) < 4_000_000


def test_personal_data(spark, empty):
    text = "mail a.b@x.org, ip 10.0.0.255 or 10.0.0.256, card 4111 1111 1111 1111, call +1 (555) 123-4567; a@b"
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "doc_id long, text string")
    out = {r.doc_id: r for r in pii.find_personal_data(df).collect()}
    assert [(s.kind, text[s.start:s.end]) for s in out[1].base] == [
        ("email", "a.b@x.org"), ("ip", "10.0.0.255"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (555) 123-4567")]
    assert set(map(tuple, out[1].base)) <= {tuple(x)[:3] for x in out[1].spans} and out[2].spans == [] == out[3].spans
    assert pii.find_personal_data(empty).count() == 0


def test_personal_data_beyond_base(spark):
    """Planted spans in formats that the base does not know are added; numbers without evidence are not."""
    rng = np.random.default_rng(5)
    rows, planted = [], {}

    def number(n):
        return str(rng.integers(10 ** (n - 1), 10 ** n))

    for i in range(600):
        a, b, c = number(3), number(3), number(4)
        name = WORDS[i % 10] + number(2)
        said = [("call me at ", f"{a} {b} {c}", "phone"), ("write to ", f"{name} (at) {name}.org", "email"), ("order ", number(12), None),
                ("call ", f"+1 {a} {b} {c}", None), ("mail ", f"{name}@x.org", None), ("in the years ", "1990-2000", None)][i % 6]
        before = f"{_text(i, 6)} {said[0]}"
        rows.append((i, f"{before}{said[1]}, {_text(i, 4)}"))
        planted[i] = {(said[2], len(before), len(before) + len(said[1]))} if said[2] else set()
    out = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    added = {r.doc_id: {tuple(x)[:3] for x in r.spans} - set(map(tuple, r.base)) for r in out}
    assert all({(*x, None) for x in map(tuple, r.base)} == {tuple(x) for x in r.spans if x.probability is None} for r in out)
    right = sum(len(added[i] & planted[i]) for i in planted)
    assert right >= 190 and sum(map(len, added.values())) - right <= 4


def test_personal_data_disguised_only(spark):
    """Without any cue word the trees learn from base spans in disguise: an address written like them is added, as it is rare without evidence; plain numbers are not."""
    rng = np.random.default_rng(6)
    rows, planted = [], {}
    for i in range(600):
        name, four = f"{WORDS[i % 10]}{i}", ".".join(str(rng.integers(1, 255)) for _ in range(4))
        said, kind = [(f"{name}@{name}.org", None), (four, None), (f"{rng.integers(10 ** 6, 10 ** 7)}", None), (four.replace(".", " . "), "ip")][3 if i == 300 else i % 3]
        before = f"{_text(i, 6)} so "
        rows.append((i, f"{before}{said} so {_text(i, 4)}"))
        if kind:
            planted[i] = (kind, len(before), len(before) + len(said))
    got = pii.find_personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    added = {r.doc_id: {tuple(x)[:3] for x in r.spans if x.probability is not None} for r in got}
    assert all(planted[i] in added[i] for i in planted) and not any(added[i] for i in added if i not in planted)
    assert all(0.5 <= x.probability <= 1 for r in got for x in r.spans if x.probability is not None)


def test_personal_data_learns_from_all_examples(spark):
    """``fit_rows`` is a weight, no cut: with few, all examples are still learned from."""
    rows, planted = [], {}
    for i in range(300):
        said, kind = [(f"call {200 + i} {300 + i} {4000 + i}", "phone"), (f"order {10 ** 11 + i * 7919}", None), (f"call +1 {200 + i} {300 + i} {4000 + i}", None)][i % 3]
        before = f"{_text(i, 6)} "
        rows.append((i, f"{before}{said}, {_text(i, 4)}"))
        if kind:
            planted[i] = (kind, len(before) + 5, len(before) + len(said))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = pii.find_personal_data(df, fit_rows=5).collect()
    added = {r.doc_id: {tuple(x)[:3] for x in r.spans if x.probability is not None} for r in got}
    assert all(planted[i] in added[i] for i in planted) and not any(added[i] for i in added if i not in planted)
    seen = pii._examples(df.select("text")).collect()
    assert sum(r.n for r in seen) == sum(1 for _, text in rows for _ in pii.examples(text))


def test_trees_of_a_table_are_those_of_its_rows(spark):
    from medlattice.llm import boosting

    rng = np.random.default_rng(3)
    x = rng.integers(0, 9, (3000, 4)).astype(float)
    y = ((x[:, 0] > 4) ^ (x[:, 1] > 2) | (rng.random(3000) < 0.1)).astype(int)
    edges = [np.arange(8.0) for _ in range(4)]
    fold = rng.integers(0, 2, 3000)
    rows = [(bytearray(b.tobytes()), int(f), int(t), boosting.ONE) for b, f, t in zip(boosting.binned(x, edges), fold, y)]
    got = boosting.fit_folds(spark.createDataFrame(rows, "bins binary, fold int, y int, weight long"), edges, 2, trees=10)
    for m, model in enumerate(got):
        use = fold != m
        want = boosting.BoostedTrees(trees=10).fit(x[use], y[use], edges)
        assert np.allclose(model.probability(x), want.probability(x), atol=1e-4)


_CONTRACT = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def _passes(kind, span):
    digits = re.sub("[^0-9]", "", span)
    if kind == "ip":
        return all(int(x) <= 255 for x in span.split("."))
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return kind == "email" or (9 <= len(digits) <= 15 if kind == "phone" else 12 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0)


def test_base_spans_as_the_expressions_say():
    rng = np.random.default_rng(8)
    pieces = ["a", "B9", "@", ".", "-", "+", " ", "(", ")", "1", "25", "300", "4111", "1111", "0", "x.y", "\n", "é", "%", "4111 1111 1111 1111", "@b.c", "10.0.0.1", "+1 555 123 4567"]
    for _ in range(20000):
        text = "".join(pieces[i] for i in rng.integers(len(pieces), size=rng.integers(1, 24)))
        want = [(*m.span(), k) for k, e in _CONTRACT.items() for m in re.finditer(e, text) if _passes(k, m[0])]
        assert pii.base_spans(text) == sorted(want, key=lambda x: (x[0], pii.KINDS.index(x[2]))), text


@pytest.mark.parametrize("text", ["at ( " + "a" * 1_000_000, "a" * 500_000 + " (at) " + "b" * 500_000, "a (at) b.c " * 60_000, "1 " * 400_000, "1" + " " * 900_000, "a@" * 50_000,
                                  "+1 (2) " * 100_000, "1.2." * 200_000, "x" * 500_000 + "@" + "y." * 200_000, "call 555 123 4567, " * 20_000])
def test_long_runs_take_linear_time(text):
    import time

    model = pii.SpanModel(pii.BoostedTrees(), {k: 0.0 for k in pii.KINDS})  # accepts what is free
    start = time.process_time()
    base = pii.base_spans(text)
    model.added(text, base)
    assert time.process_time() - start < 1 + 60 * len(text) / 1e6  # of a megabyte of nothing but candidates; far below that otherwise
    start = time.process_time()
    assert len(pii.candidates(text[:1000] + "a" * 1_000_000)) >= 0
    assert time.process_time() - start < 1


def test_quality(spark, docs, empty):
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 0), (7, 1, 1), (9, None, None)], "doc_id long, quality int, toxic int")
    out = quality.grade_documents(docs, labels).toPandas()
    assert len(out) == docs.count() and (out.p_ge_1 >= out.p_ge_2).all() and out.expected_grade.between(0, 2).all()
    assert quality.grade_documents(empty, labels).count() == 0 == quality.grade_documents(empty, labels.limit(0)).count()


def test_urls(spark):
    rows = [(1, "http://a.com/x", '<a href="http://b.org/">b</a>'), (2, "http://b.org/", None), (3, "https://EXAMPLE.com/en/q?x#y", ""), (4, None, "x"),
            (5, "no scheme", None), (6, "http://q.net/fr/1", ""), (7, "http://c.org/", '<a href=//q.net/>q</a>'), (8, "http://www.example.com/en/", "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = {r.page_id: r for r in url_trust.judge_urls(df, URL_RULES).collect()}
    assert [(out[i].host, out[i].path, out[i].rule, out[i].verdict) for i in range(1, 9)] == [
        ("a.com", "/x", "com/", "allow"), ("b.org", "/", None, "allow"), ("example.com", "/en/q", "example.com/en/", "block"), ("", "", None, "allow"),
        ("", "", None, "allow"), ("q.net", "/fr/1", "net/fr/", "block"), ("c.org", "/", None, "block"), ("www.example.com", "/en/", "www.example.com/en/", "allow")]
    assert out[2].trust == pytest.approx(0.85) and out[7].distrust == pytest.approx(0.85)


def test_url_farm(spark):
    """Many hosts that link to one blocked host, and a chain of hosts to it, against the fixed point of numpy."""
    links = {f"farm{i}.org": ["bad.net"] for i in range(100)} | {f"fair{i}.org": ["bad.net"] + ["fine.org"] * 9 for i in range(20)}
    links |= {f"c{i}.org": [f"c{i + 1}.org"] for i in range(30)} | {"c30.org": ["c0.org", "bad.net"], "bad.net": ["c0.org"], "fine.org": []}
    rows = [(i, f"http://{h}/fr/x", "".join(f'<a href="http://{d}/">x</a>' for d in out)) for i, (h, out) in enumerate(links.items())]
    got = {r.host: r for r in url_trust.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string"), URL_RULES).collect()}
    hosts = list(links)
    a = np.zeros((len(hosts), len(hosts)))
    for h, out in links.items():
        for d in out:
            a[hosts.index(h), hosts.index(d)] += 1 / len(out)
    want = np.linalg.solve(np.eye(len(hosts)) - 0.85 * a, [float(h == "bad.net") for h in hosts])
    assert [got[h].distrust for h in hosts] == pytest.approx(want.tolist(), abs=1e-5)
    assert {h for h in hosts if got[h].verdict == "block"} == {h for h, w in zip(hosts, want) if w >= 0.5 or h == "bad.net"} >= {f"farm{i}.org" for i in range(100)}
    assert got["fair3.org"].verdict == "allow"


def test_warc(spark, tmp_path):
    big = "é" * 700
    rows = [(1, "http://a/", big), (2, None, big), (3, "u", "small"), (4, "u", "small"), (5, "x", None), (None, "y", "z")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = {r.page_id: r for r in warc.archive_pages(df, path=str(tmp_path / "w")).collect()}
    assert len(out) == 6
    for i, _, html in rows:
        data = (html or "").encode()
        assert (out[i].payload_bytes, out[i].payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
    assert (out[1].record_type, out[1].refers_to, out[2].record_type) == ("revisit", 2, "response")
    assert {out[i].record_type for i in (3, 4, 5, None)} == {"response"}
    assert warc.archive_pages(df.limit(0), path=str(tmp_path / "e")).count() == 0


def test_warc_foreign_archives(tmp_path):
    import gzip

    records = [warc.format_record([("WARC-Type", t)], p) for t, p in (("warcinfo", b"i"), ("response", b"x" * 100_000), ("request", b"r"))]
    (tmp_path / "plain.warc").write_bytes(b"".join(records))
    (tmp_path / "zipped.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    for name in ("plain.warc", "zipped.warc.gz"):
        with open(tmp_path / name, "rb") as f:
            got = list(warc.read_records(f, lambda h: h["warc-type"] == "response"))
        assert [(len(p), set(p)) for _, p in got] == [(100_000, {ord("x")})]
