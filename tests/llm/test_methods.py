"""Methods against brute force: language filters, winnowing, ordinal likelihood, entropy balancing, and the pipeline stage by stage."""

import zlib
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("medlattice.llm")

from pyspark.sql import functions as F  # noqa: E402

import corpus_pipeline  # noqa: E402
from medlattice.llm import chosen_path, langid, mixing, quality, winnowing  # noqa: E402
from medlattice.llm.common import settle, table  # noqa: E402
from medlattice.llm.queries import MAX_RATE, SOURCE_WEIGHTS, tokenizer_path  # noqa: E402

SMALL = "/root/testdata/sf0.001"
SPOKEN = {"aa": "kala mita suru vane", "bb": "strom blick herz wald", "cc": "ojos calle nube rio", "dd": "kala strom ojos zug"}


def _grams(text):
    """Distinct n-grams of runs of letters, a space only at either end, and all of them in turn by size."""
    c = "".join(x if x.isalpha() else " " for x in f" {text.lower()} ")
    return [c[i:i + n] for n in (3, 4) for i in range(len(c) - n + 1) if all(x != " " for x in c[i + 1:i + n - 1])]


def test_language_filter_against_a_dictionary(spark):
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(w + "aeiou"[rng.integers(5)] for w in rng.choice(SPOKEN[lang].split(), size=30)), lang)
            for i, lang in enumerate(list(SPOKEN) * 40)] + [(900, "123 -- 4", "aa"), (901, None, "bb"), (902, "wald strom", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {r.doc_id: r for r in langid.identify_languages(df).collect()}
    model = langid.fit_language_filter(df.where(~langid.held_out(F.col("doc_id"))), "text", "lang", "doc_id")
    learned = [r for r in rows if r[2] and zlib.crc32(str(r[0]).encode()) % 5]
    docs = Counter(r[2] for r in learned)
    counts = Counter((r[2], g) for r in learned for g in set(_grams(r[1] or "")))
    known = {}
    for g in {g for _, g in counts}:
        share = {lang: counts[lang, g] / docs[lang] for lang in docs}
        known[g] = {lang for lang in docs if counts[lang, g] >= min(3, max(1, docs[lang] // 3)) * 0.999 and share[lang] >= 0.25 * max(share.values())}
    every = sorted(known)
    for g in every:  # no language is missed, and few are added
        (h, _, _), own = langid.grams([g.strip()] if " " not in g.strip() else [g]), None
        names = _grams(g.strip())
        mask = int(model.lookup(h)[names.index(g)])
        own = {lang for i, lang in enumerate(model.languages) if mask >> i & 1}
        assert known[g] <= own, g
    right = 0
    for i, text, lang in rows[:160]:
        votes = Counter(x for g in _grams(text) for x in known.get(g, ()))
        (first, n), (_, m) = (votes.most_common(2) + [(None, 0)] * 2)[:2]
        if n > 1.1 * m:
            assert out[i].lang_pred == first
        right += out[i].lang_pred == lang and out[i].held_out
    assert right >= 0.95 * sum(out[i].held_out for i in range(160))
    assert (out[900].lang_pred, out[901].lang_pred, out[902].lang_pred) == ("und", "und", "bb")
    assert all(out[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in out)


def _winnow(hashes, k, window):
    """(hash, position) chosen in plain steps: the least of each window, the rightmost among equals."""
    if not hashes:
        return []
    grams = []
    for i in range(max(1, len(hashes) - k + 1)):
        h = 0
        for x in hashes[i:i + k]:
            h = (h * winnowing.BASE + x) % winnowing.PRIME
        grams.append(h)
    chosen = []
    for i in range(max(1, len(grams) - window + 1)):
        part = grams[i:i + window]
        at = max(j for j, h in enumerate(part) if h == min(part)) + i
        if (grams[at], at) not in chosen:
            chosen.append((grams[at], at))
    return chosen


def test_winnowing_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"W{rng.integers(6)}" for _ in range(rng.integers(0, 60)))) for i in range(60)] + [(60, None), (61, "one"), (62, " \t"), (63, "W1 " * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in winnowing.fingerprint_pairs(df, k=4, window=8).collect()}
    edited, order = {}, sorted(out, reverse=True)
    texts = {i: t or "" for i, t in rows}
    following = dict(zip(order, order[1:] + order[:1]))
    for i, t in texts.items():
        edited[i] = t[:len(t) - len(t) // 2] + texts[following[i]][:len(t) // 2]
    words = sorted({w for t in [*texts.values(), *edited.values()] for w in t.lower().split()})
    known = {r.w: r.h for r in spark.createDataFrame([(w,) for w in words], "w string").select("w", F.pmod(F.xxhash64("w"), F.lit(winnowing.PRIME)).alias("h")).collect()}

    def prints(t):
        return _winnow([known[w] for w in t.lower().split()], 4, 8)

    def alike(a, b):
        a, b = {h for h, _ in a}, {h for h, _ in b}
        return len(a & b) / len(a | b) if a | b else 1.0

    for i in out:
        own, new, nxt = prints(texts[i]), prints(edited[i]), prints(texts[following[i]])
        assert out[i].fingerprint == ",".join(f"{h:x}@{p}" for h, p in own) and out[i].edited_fingerprint == ",".join(f"{h:x}@{p}" for h, p in new)
        assert out[i].near_edited == pytest.approx(alike(own, new)) and out[i].near_next == pytest.approx(alike(own, nxt))


def test_ordinal_likelihood_and_held_out_grades():
    """Small numerical gradients of the likelihood at the fit, and right grades of texts that it has not seen."""
    rng = np.random.default_rng(4)
    vocabulary = [[f"w{g}x{j}" for j in range(12)] for g in range(3)] + [[f"n{j}" for j in range(40)]]
    texts, grades = [], rng.integers(3, size=400)
    for g in grades:
        texts.append(" ".join(vocabulary[g if rng.random() < 0.3 else 3][rng.integers(12)] for _ in range(40)))
    columns, values, bounds, shapes = quality.text_features(texts[:300], 12)
    model = quality.fit_ordinal(columns, values, bounds, shapes, grades[:300], 3, bits=12, steps=3000, ridge=1e-2)
    guess = np.concatenate([np.ones((100, 1)), model.tails(texts[300:]), np.zeros((100, 1))], axis=1)
    assert (np.argmax(guess[:, :-1] - guess[:, 1:], axis=1) == grades[300:]).mean() >= 0.9
    x = (shapes - model.centre) / model.scale
    row = np.repeat(np.arange(300), np.diff(bounds))

    def loss(words, s, cuts):
        score = np.bincount(row, words[columns] * values, 300) + x @ s
        up = np.concatenate([np.ones((300, 1)), 1 / (1 + np.exp(cuts[None, :] - score[:, None])), np.zeros((300, 1))], axis=1)
        return -np.log(up[np.arange(300), grades[:300]] - up[np.arange(300), grades[:300] + 1]).mean() + 5e-3 * ((words ** 2).sum() + (s ** 2).sum())

    words, s, cuts = model.words.astype(float), model.shapes, model.thresholds
    used = [c for c in np.unique(columns) if (columns == c).sum() >= 8][:10]
    for part, places in ((words, used), (s, range(len(s))), (cuts, range(2))):
        for j in places:
            keep = part[j]
            part[j] = keep + 1e-4
            up = loss(words, s, cuts)
            part[j] = keep - 1e-4
            assert abs(up - loss(words, s, cuts)) / 2e-4 < 5e-3
            part[j] = keep
    assert np.all(np.diff(model.thresholds) > 0)


def test_crossed_constraints(spark):
    """Source and language constraints together, against a dense Newton method; null is a value; one column has its closed form."""
    rng = np.random.default_rng(6)
    cells = [(s, lang, int(rng.integers(50, 500))) for s in ("a", "b", "c", None) for lang in ("en", "de", None)]
    df = spark.createDataFrame(cells, "source string, lang string, size long")
    total = sum(c[2] for c in cells)
    want = {"source": {"a": 0.5, "b": 0.2, "c": 0.2, None: 0.1}, "lang": {"en": 0.6, "de": 0.3, None: 0.1}}
    targets = {c: spark.createDataFrame([(k, total * v) for k, v in own.items()], f"{c} string, target double") for c, own in want.items()}
    found = {c: {r[c]: r.multiplier for r in d.collect()} for c, d in mixing.entropy_multipliers(df, targets).items()}
    keys = [(c, k) for c in want for k in want[c]]
    a = np.array([[float(cell[0] == k if c == "source" else cell[1] == k) for c, k in keys] for cell in cells])
    size, t, x = np.array([c[2] for c in cells], float), np.array([total * want[c][k] for c, k in keys]), np.zeros(len(keys))
    for _ in range(100):
        r = size * np.exp(a @ x)
        x -= np.linalg.lstsq(a.T @ (a * r[:, None]), a.T @ r - t, rcond=None)[0].clip(-1, 1)
    rates = np.array([np.exp(found["source"][s] + found["lang"][lang]) for s, lang, _ in cells])
    assert rates == pytest.approx(np.exp(a @ x), rel=1e-6) and a.T @ (size * rates) == pytest.approx(t, rel=1e-6)
    one = {r.source: r.multiplier for r in mixing.entropy_multipliers(df, {"source": targets["source"]})["source"].collect()}
    own = {s: sum(c[2] for c in cells if c[0] == s) for s in one}
    assert all(np.exp(one[s]) == pytest.approx(total * want["source"][s] / own[s]) for s in one)
    clash = {"source": targets["source"], "lang": spark.createDataFrame([("en", 1.0), ("de", 1.0), (None, 1.0)], "lang string, target double")}
    with pytest.raises(ValueError):
        mixing.entropy_multipliers(df, clash, most_rounds=5)


def _words(t):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    return [w for w in low.replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if w]


def test_pipeline_stage_by_stage(spark):
    """Each stage's rows against plain Python on the rows of the stage before, and the whole against run()."""
    from tokenizers import Tokenizer

    docs = table(spark, SMALL, "documents")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        kept.append(settle(stage(spark, kept[-1], SMALL), "stage"))
        if name != "best-fit packing":
            assert kept[-1].columns == docs.columns
    rows = [[tuple(r) for r in d.collect()] for d in kept]
    by_id = {r[0]: r for r in rows[0]}

    # language ID: what is left out has no letters, or is mostly unlike any language of the labelled texts
    assert Counter(rows[1]) <= Counter(rows[0])
    grams = Counter(g for r in rows[0] if r[2] for g in set(_grams(r[1] or "")))
    for i in set(by_id) - {r[0] for r in rows[1]}:
        own = _grams(by_id[i][1] or "")
        assert not own or sum(grams[g] >= 3 for g in own) < 0.5 * len(own)
    clean = [r for r in rows[0] if r[2] and len(_words(r[1])) >= 20]
    assert len({r[0] for r in clean} - {r[0] for r in rows[1]}) <= 0.02 * len(clean)

    # exact dedup: the largest id of equal texts
    last = {}
    for r in rows[1]:
        last[r[1] or ""] = max(last.get(r[1] or "", -1), r[0])
    assert sorted(r[0] for r in rows[2]) == sorted(last.values())

    # near dedup: the smallest id of what links at 0.8 on five-word shingles reach
    sets = {r[0]: {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} - {()}) for r in rows[2] for w in [_words(r[1])]}
    label = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] & sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    while moved := [(a, b) for a, b in links if label[a] != label[b]]:
        for a, b in moved:
            label[a] = label[b] = min(label[a], label[b])
    assert links and sorted(r[0] for r in rows[3]) == sorted(i for i in label if label[i] == i)

    # mixing: words taken of each source are near its target, no row more than three times
    size = Counter()
    for r in rows[3]:
        size[r[3]] += len(_words(r[1]))
    weight = {s: SOURCE_WEIGHTS[i % 3] for i, s in enumerate(sorted(size, key=lambda s: (s is None, s)))}
    open_, target, total = set(size), {}, sum(size.values())
    while open_:
        left = total - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > MAX_RATE * size[s]}
        target |= {s: float(MAX_RATE * size[s]) for s in over} if over else share
        open_ = open_ - over if over else set()
    taken = Counter()
    for r in rows[4]:
        taken[r[3]] += len(_words(r[1]))
    copies = Counter(r[0] for r in rows[4])
    assert max(copies.values()) <= MAX_RATE and set(copies) <= {r[0] for r in rows[3]}
    for s in size:
        assert abs(taken[s] - target[s]) <= max(len(_words(r[1])) for r in rows[3] if r[3] == s)

    # packing: every token of every row once, sequences of at most 4096 without gaps
    tokenizer = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for r in rows[4]:
        ids = np.array(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [1], "<u4")
        want.update((r[0], k, s, len(ids[s:s + 4096]), zlib.crc32(ids[s:s + 4096].tobytes())) for k, s in enumerate(range(0, len(ids), 4096)))
    pieces = kept[5].toPandas()
    assert Counter(zip(pieces.doc_id, pieces.piece, pieces.start, pieces.length, pieces.ids_crc32)) == want
    for _, g in pieces.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.length.sum() <= 4096 and g.offset.tolist() == [0, *g.length.cumsum()[:-1]]
    whole = corpus_pipeline.run(spark, SMALL).toPandas()
    assert Counter(zip(whole.doc_id, whole.piece, whole.start, whole.length, whole.ids_crc32)) == want


def test_near_duplicates_of_a_whole_table(spark):
    """Every linked pair of sf0.01 is in one component, and no other row joins it (recall 1 measured)."""
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    out = {r.doc_id: r for r in chosen_path.near_duplicates(docs, words=3, percent=85).collect()}
    sets = {r.doc_id: {tuple(w[i:i + 3]) for i in range(len(w) - 2)} or ({tuple(w)} - {()}) for r in docs.collect() for w in [_words(r.text)]}
    having, label = {}, {i: i for i in sets}
    for i, own in sets.items():
        for s in own:
            having.setdefault(s, []).append(i)
    common = Counter((a, b) for ids in having.values() for k, a in enumerate(ids) for b in ids[k + 1:])
    links = [(a, b) for (a, b), n in common.items() if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n)]
    while moved := [(a, b) for a, b in links if label[a] != label[b]]:
        for a, b in moved:
            label[a] = label[b] = min(label[a], label[b])
    assert links and {i: (r.component_id, r.kept, r.n_shingles) for i, r in out.items()} == {i: (label[i], label[i] == i, len(sets[i])) for i in sets}


def test_near_duplicates_confirm_one_pair_per_two_components(spark, monkeypatch):
    """Two groups that all alike pairs join: one pair is confirmed, and the others are not needed; where it is not alike, the others decide."""
    words = [f"w{i}" for i in range(60)]
    texts = {i: " ".join(words + [f"x{i}"]) for i in range(12)} | {20: " ".join(words[:25] + [f"y{i}" for i in range(40)])}
    docs = spark.createDataFrame(list(texts.items()), "id long, text string")
    known = spark.createDataFrame([(i, 0 if i < 6 else 6) for i in range(12)] + [(20, 20)], "node long, component long")
    pairs = [(a, b, 1) for a in range(6) for b in range(6, 12)] + [(a, 20, 2) for a in range(6)]
    counts, plain = [], chosen_path._confirm

    def confirm(pairs, *args):
        counts.append(pairs.count())
        return plain(pairs, *args)

    monkeypatch.setattr(chosen_path, "_confirm", confirm)
    out = chosen_path._joining(spark.createDataFrame(pairs, "a long, b long, differ int"), known, docs, 3, 80)
    assert dict(map(tuple, out.collect())) == {**{i: 0 for i in range(12)}, 20: 20}
    assert counts == [2, 5]


def test_near_duplicates_rows_of_all_levels_stay_near_the_first(spark, monkeypatch):
    """Texts with a common passage that are no near-duplicates stay together at every level; each level doubled their rows."""
    common = " ".join(f"c{i}" for i in range(150))
    texts = {i: f"{common} " + " ".join(f"x{i}_{j}" for j in range(30)) for i in range(40)} | {50: f"{common} " + " ".join(f"x7_{j}" for j in range(28))}
    rows, plain = [], chosen_path._members

    def members(nodes):
        rows.append(nodes.count())
        return plain(nodes)

    monkeypatch.setattr(chosen_path, "_members", members)
    monkeypatch.setattr(chosen_path, "LEAF", 2)
    out = chosen_path.near_duplicates(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), words=3, percent=85)
    assert {r.doc_id: r.component_id for r in out.collect()} == {**{i: i for i in range(40)}, 50: 7}
    assert rows[0] > 200 and sum(rows) <= 3 * rows[0]
