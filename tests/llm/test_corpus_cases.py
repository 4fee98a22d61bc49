"""Odd rows, forced splits and second ways of each corpus operator."""

import random
import weakref
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snaphist.llm import (
    catalog, exact_dedup, graph, jaccard_join, license_rules, mixing, packing, personal_data,
    quality_lm, store, substring_dedup, topk, url_rules,
)
from snaphist.llm import words as W
from tests.llm import brute, odd
from tests.llm.test_corpus_queries import check_pieces

BASE = [(d, t) for d, t in odd.TEXTS if d is not None]
ONCE = list({d: (d, t) for d, t in BASE}.values())


def near_copies(n=60, words=120, seed=5):
    """A family of near copies, some unlike enough not to link, and unrelated texts."""
    draw = random.Random(seed)
    base = [f"v{draw.randrange(10_000)}" for _ in range(words)]
    out = []
    for i in range(n):
        w = list(base) if i % 3 else [f"u{draw.randrange(10_000)}" for _ in range(draw.randrange(1, 60))]
        for _ in range(draw.randrange(0, 6)):
            w[draw.randrange(len(w))] = f"n{draw.randrange(10_000)}"
        if draw.random() < 0.3:
            w = w[draw.randrange(3) :]
        out.append((i, " ".join(w)))
    return out


def test_word_helpers():
    column = pa.array(["a  bc\td", None, "", "é  x", "x" * 100 + " " + "y" * 8])
    t = W.texts(column)
    w = W.words(t)
    assert [t.buf[a:b].tobytes().decode() for a, b in zip(w.starts, w.ends)][:5] == ["a", "bc", "d", "é", "x"]
    assert w.counts().tolist() == [3, 0, 0, 2, 2]
    sliced = W.words(W.texts(column.slice(3)))
    assert sliced.counts().tolist() == [2, 2]
    spans = [f"{a}{b}" for a in ("cimente", "12345678", "") for b in ("ja", "ra", "j", "r")] + ["z" * 64, "z" * 65]
    t = W.texts(pa.array([" ".join(spans)]))
    w = W.words(t)
    assert len(set(W.hash_spans(t.buf, w.starts, w.ends).tolist())) == len(spans)


def test_hilbert_visits_each_cell_by_single_steps():
    grid = np.stack(np.meshgrid(*[np.arange(4)] * 3, indexing="ij"), -1).reshape(-1, 3)
    key = packing.hilbert(grid, 2)
    assert sorted(key) == list(range(64))
    assert (np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize("size", [8_000_000, 40_000])
def test_packing_odd(spark, size):
    texts = ONCE + [(100, "it's 'sun we're!!'s ÀB123,x—y é'll 42abc.de ¡! ΑΣ.Α x\u0300y don't!'t ''ll"), (101, "<|endoftext|> a")]
    rows = packing.pack(odd.documents(spark, texts), catalog.tokenizer_path(), range_tokens=size).collect()
    check_pieces(rows, texts, catalog.tokenizer_path())
    whole = packing.pack(odd.documents(spark, texts), catalog.tokenizer_path(), by_units=False, with_ids=True).collect()
    assert all(len(r.ids) == 4 * r.length for r in whole)
    assert Counter((r.doc_id, r.doc_tokens) for r in whole if r.start == 0) == Counter((r.doc_id, r.doc_tokens) for r in rows if r.start == 0)


def test_packing_repeats_and_empty(spark):
    rows = packing.pack(odd.documents(spark), catalog.tokenizer_path()).collect()
    assert sum(r.start == 0 for r in rows) == len(odd.TEXTS)
    assert packing.pack(odd.empty(spark), catalog.tokenizer_path()).count() == 0


@pytest.mark.parametrize("k, num", [(3, 90), (5, 80), (1, 50)])
def test_jaccard_join(spark, k, num, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_DOCS", 7)
    texts = ONCE + [(d + 1000, t) for d, t in near_copies()]
    rows = jaccard_join.join(odd.documents(spark, texts), k=k, num=num, den=100).collect()
    want = brute.components(texts, k, num, 100)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want


@settings(max_examples=300, deadline=None)
@given(st.sets(st.integers(0, 400), min_size=1, max_size=90), st.sets(st.integers(0, 1400)), st.data())
def test_similar_sets_share_a_first_column(a, often, data):
    """No pair that meets the bound lacks a common column, whatever counts as frequent."""
    gone = data.draw(st.sets(st.sampled_from(sorted(a)), max_size=max(0, len(a) // 8)))
    new = data.draw(st.sets(st.integers(1000, 1400), max_size=max(0, len(a) // 8)))
    b = (a - gone) | new
    sets = [np.sort(W.mix(np.array(sorted(s), np.uint64))) for s in (a, b)]
    columns = np.sort(W.mix(np.array(sorted(often), np.uint64)))
    known = columns, (columns % np.uint64(5)).astype(np.uint8)
    for num in (80, 90):
        columns, n = jaccard_join.first_columns([sets[0], np.zeros(0, np.uint64), sets[1]], num, 100, known)
        assert n[1] == 0 and len(columns) == n.sum()
        x, y = set(columns[: n[0]].tolist()), set(columns[n[0] :].tolist())
        assert x <= set(sets[0].tolist()) and y <= set(sets[1].tolist())
        if 100 * len(a & b) >= num * len(a | b):
            assert x & y


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 300), st.sampled_from([(75, 100), (80, 100), (90, 100), (19, 20)]), st.integers(0, 2**32))
def test_similar_sets_share_a_first_part(n, bound, seed):
    """No pair that meets the bound lacks a common part, whatever counts as frequent, and however many are empty."""
    num, den = bound
    draw = random.Random(seed)
    a = np.array([draw.getrandbits(64) for _ in range(n)], np.uint64)
    if draw.random() < 0.3:
        a >>= np.uint64(draw.randrange(1, 8))  # few parts have columns
    gone = draw.randrange(0, n - -(-num * n // den) + 1)
    new = [draw.getrandbits(64) for _ in range(max(0, den * (n - gone) // num - n))]
    b = np.concatenate([a[gone:], np.array(new[: draw.randrange(len(new) + 1)], np.uint64)])
    sets = [np.unique(x) for x in (a, np.zeros(0, np.uint64), b)]
    both = len(np.intersect1d(sets[0], sets[2]))
    assert den * both >= num * len(np.union1d(sets[0], sets[2]))
    keys, row, weight, owner, want = jaccard_join.parts_of(sets, num, den)
    often = np.unique([k for k in keys[weight > 0].tolist() if draw.random() < 0.5]).astype(np.uint64)
    keys, row = jaccard_join._first(keys, row, weight, want, (often, (often % np.uint64(5)).astype(np.uint8)))
    x, y = (set(keys[owner[row] == i].tolist()) for i in (0, 2))
    assert not (owner[row] == 1).any()
    assert x & y or (len(sets[0]) == len(sets[2]) == both)


def spread_out(row):
    """Sets that share single columns, most of theirs, with many others and are like none."""
    draw = random.Random(row)
    return " ".join(f"c{row}x{i}" if draw.random() < 0.1 else f"s{draw.randrange(4000)}" for i in range(150))


@pytest.mark.parametrize("num", [80, 90])
def test_single_common_columns_gather_nothing(spark, num):
    docs = spark.createDataFrame([(i, spread_out(i)) for i in range(400)], "doc_id long, text string")
    assert jaccard_join._clusters(docs, 1, True, num, 100).count() < 40


def test_blocks_of_unlike_sizes_are_not_multiplied(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_DOCS", 10)
    members = spark.range(400).select(
        F.lit(1).cast("long").alias("root"), "id", F.col("id").alias("d1"), F.col("id").alias("d2"),
        (F.lit(10) + 10 * (F.hash("id") % 100 + 100)).cast("long").alias("n"),
    )
    placed = jaccard_join._placements(members, 80, 100).collect()
    pairs = {(r.left, r.right) for r in placed}
    assert {(b, b) for b in range(40)} <= pairs and len(pairs) < 40 * 41 // 4
    n = {r.id: r.n for r in members.collect()}
    at = {r.id: r.left for r in placed if r.left == r.right}
    assert all(
        (min(at[x], at[y]), max(at[x], at[y])) in pairs
        for x in range(0, 400, 7) for y in range(400) if 80 * max(n[x], n[y]) <= 100 * min(n[x], n[y])
    )


def test_jaccard_join_ties_and_empty(spark):
    rows = jaccard_join.join(odd.documents(spark), k=3, num=90, den=100).collect()
    assert len(rows) == len(odd.TEXTS)
    assert {r.component_id for r in rows if r.n_shingles == 12} == {1}
    assert jaccard_join.join(odd.empty(spark)).count() == 0
    docs = odd.documents(spark)
    kept = jaccard_join.keep(docs, jaccard_join.join(docs))
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids[1] == 1 and ids[2] == ids[3] == 0 and ids[4] == ids[5] == ids[6] == 1


def test_components(spark):
    draw = random.Random(3)
    pairs = [(i, i + 1) for i in range(0, 40)] + [(draw.randrange(100, 160), draw.randrange(100, 160)) for _ in range(40)]
    found = graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    root = {r.node: r.root for r in found}
    assert {root.get(i, i) for i in range(41)} == {0}
    for a, b in pairs:
        assert root.get(a, a) == root.get(b, b)


def test_quality_odd(spark):
    rows = quality_lm.classify(odd.documents(spark), odd.labels(spark)).collect()
    assert len(rows) == len(odd.TEXTS)
    assert all(r.kept == (r.perplexity is not None and (r.limit is None or r.perplexity <= r.limit)) for r in rows)
    assert all(r.perplexity is None and not r.kept for r in rows if r.n_words == 0)
    nobody = odd.labels(spark).limit(0)
    rows = quality_lm.classify(odd.documents(spark), nobody).collect()
    assert all(r.kept == (r.n_words > 0) for r in rows)
    assert quality_lm.classify(odd.empty(spark), odd.labels(spark)).count() == 0
    docs = odd.documents(spark)
    assert quality_lm.keep(docs, nobody).columns == docs.columns


def test_quality_is_a_probability(spark):
    """Over all known words, the unknown and the end, probabilities after any words sum to one."""
    texts = [(i, " ".join(random.Random(i).choices("a b c d e f g".split(), k=40))) for i in range(60)]
    model = quality_lm.train(odd.documents(spark, texts), odd.labels(spark, range(60)))
    model.unknown_kinds = 0.0
    known = [*model.vocabulary.tolist(), int(quality_lm.UNKNOWN), int(quality_lm.END)]
    for a, b in [(quality_lm.BEGIN, quality_lm.BEGIN), tuple(model.vocabulary[:2]), (quality_lm.UNKNOWN, model.vocabulary[0])]:
        codes = np.array([[a, b, c] for c in known], np.uint64)
        total = sum(np.exp(quality_lm.trigram_scores(*codes.T.copy(), model)))
        assert total == pytest.approx(1.0, abs=0.02)


def test_quality_model_counts_the_whole_training_half(spark):
    texts = [(i, f"w{i} w{i}") for i in range(5000)]
    docs, labels = odd.documents(spark, texts), odd.labels(spark, range(5000))
    half = quality_lm.trusted(labels).where(quality_lm._fold(F.col("_id")) == 0).count()
    model = quality_lm.train(docs, labels)
    assert len(model.vocabulary) == half > 2000


def test_quality_shards_agree_with_one_table(spark):
    """Texts scored by way of the shards have the perplexity that the whole tables give."""
    texts = [(i, " ".join(random.Random(i // 2).choices("a b c d e f g h".split(), k=9 + i % 5))) for i in range(80)]
    docs = odd.documents(spark, texts)
    model = quality_lm.train(docs, odd.labels(spark, range(0, 80, 3)))
    rows = {r.doc_id: r.perplexity for r in quality_lm.score(docs, model).collect()}
    for i, text in texts[:20]:
        a, b, c, _ = quality_lm._trigrams(W.texts(pa.array([text])), model.hashes)
        assert rows[i] == pytest.approx(np.exp(-quality_lm.trigram_scores(a, b, c, model).mean()), rel=1e-5)


def test_quality_reads_texts_and_counts_few_times(spark, monkeypatch):
    """A round of scoring reads all texts, and by two shuffles all counts, whatever it scores of them."""
    docs = odd.documents(spark, [(i, f"a b c d{i % 3}") for i in range(40)])
    model = quality_lm.train(docs, odd.labels(spark, range(40)))
    gathered, calls = quality_lm._gathered, []
    monkeypatch.setattr(quality_lm, "_gathered", lambda dealt: calls.append(1) or gathered(dealt))
    assert all(r.perplexity > 0 for r in quality_lm.score(docs, model).collect())
    assert len(calls) <= 2 * 8


@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=40), st.lists(st.integers(0, 2**64 - 1), max_size=20))
def test_places_of_hashes(known, others):
    hashes = np.unique(np.array([*known, *(k >> 60 for k in known)], np.uint64))
    wanted = np.array([*known, *others, 0, 1, 2**64 - 1], np.uint64)
    at = quality_lm.places(hashes, quality_lm.starts_of(hashes), wanted)
    assert at.tolist() == np.minimum(np.searchsorted(hashes, wanted), len(hashes) - 1).tolist()


@pytest.mark.parametrize("n", [0, 1, 1000])
def test_packed_columns_come_back(n):
    draw = np.random.default_rng(n)
    whole = draw.integers(0, 2**32, n, dtype=np.uint32)
    columns = [whole, draw.random(n).astype(np.float32), draw.integers(-(2**62), 2**62, n), whole[::-1]]
    blob = quality_lm._pack(*columns)
    for given_column, column in zip(columns, quality_lm._unpack(blob, n, "u4f4i8u4"), strict=True):
        assert column.dtype == given_column.dtype and column.tolist() == given_column.tolist()


def test_quality_limits_follow_length(spark):
    """Wide scatter of short trusted texts does not let long junk through."""
    rows = [(i, "en", 5, 100.0 * i) for i in range(1000)] + [(i, "en", 900, 1.0 * i) for i in range(1000, 2000)]
    rows += [(5000, "en", 900, 50_000.0), (5001, "en", 5, 50_000.0)]
    scored = spark.createDataFrame(rows, "doc_id long, lang string, n_words long, perplexity double")
    limit = quality_lm.limits(scored, odd.labels(spark, range(2000)))
    kept = {r.doc_id: r.kept for r in quality_lm.judge(scored, limit).collect()}
    assert kept[5001] and not kept[5000]
    assert np.mean([kept[i] for i in range(2000)]) > 0.99


def test_exact_dedup_odd(spark):
    rows = exact_dedup.deduplicate(odd.documents(spark), max_files=1).collect()
    assert len(rows) == len(odd.TEXTS)
    same = [r for r in rows if r.group_size == 5]
    assert len(same) == 5 and {r.keep_id for r in same} == {3} and sum(r.kept for r in same) == 1
    none = [r for r in rows if r.group_size == 3]
    assert {r.doc_id for r in none} == {4, 5, None} and {r.keep_id for r in none} == {5}
    assert exact_dedup.deduplicate(odd.empty(spark)).count() == 0


def test_exact_dedup_compares_bytes(spark):
    docs = odd.documents(spark)
    weak = exact_dedup.deduplicate(docs, digest=lambda t: F.substring(exact_dedup.sha256(t), 1, 1))
    full = exact_dedup.deduplicate(docs)
    view = lambda df: Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in df.collect())
    assert view(weak) == view(full)
    kept = exact_dedup.keep(docs, full)
    assert kept.columns == docs.columns
    assert Counter(brute.lower(r.text) for r in kept.collect()) == Counter({brute.lower(t) for _, t in odd.TEXTS})


def test_url_rules_odd(spark):
    urls = [
        "http://a.b.example.net/en/x", "HTTP://A.Example.NET/de", "x://net", "x://net/", "nothing", None, "",
        "://org/fr/", "http://u@h:80.org/fr/a?b#c", "http://" + "a." * 3000 + "net/" + "en/" * 3000, "a://b://net/",
        "http://example.com/de", "http://example.com/de/", "http://example.comx/de/", "http://xnet/", "s://n\n.net/\n?q",
    ]
    rows = [(i, u, "own") for i, u in enumerate(urls)] + [(0, urls[0], "own"), (None, urls[0], None)]
    table = url_rules.rules(spark, [*catalog.URL_RULES, ("block", None, "/"), ("block", "net", "/en/exact")])
    out = url_rules.judge(spark.createDataFrame(rows, "page_id long, url string, rule string"), table).collect()
    assert len(out) == len(rows)

    def brute_rule(u):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = brute.lower(rest[:cut])
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
        fits = [
            (len(h + p), h + p, v) for v, h, p in catalog.URL_RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        best = max(fits, default=(0, None, "allow"))
        return host, path, best[1], best[2]

    for r in out:
        assert (r.host, r.path, r.rule, r.verdict) == brute_rule(r.url)


def vectors(spark):
    draw = random.Random(2)
    rows = [(i, [draw.choice([-1.0, 0.0, 0.5, 0.25]) for _ in range(6)]) for i in range(60)]
    rows += [(20, [1.0] * 6), (None, [1.0] * 6), (61, None), (62, [1.0, None]), (63, [float("nan")]), (64, []), (40, [1e300] + [0.0] * 5)]
    return rows, spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, v array<double>, score string")


@pytest.mark.parametrize("tile_rows, fan_in", [(4096, 16), (5, 2)])
def test_topk(spark, tile_rows, fan_in):
    rows, df = vectors(spark)
    got = topk.search(df, F.col("vec_id") % 20 == 0, "vec_id", "v", k=7, tile_rows=tile_rows, fan_in=fan_in)
    got = Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect())
    whole = [
        (i, d, [int(np.floor(64 * x)) for x in v])
        for i, (d, v) in enumerate(rows)
        if v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    want = Counter()
    for i, d, q in whole:
        if d is None or d % 20:
            continue
        scored = []
        for j, e, v in whole:
            if i != j:
                s = sum(a * b for a, b in zip(q, v))
                scored.append((-max(-(2**63), min(2**63 - 1, s)), e is None, e or 0, e))
        want.update((d, n + 1, e, -s) for n, (s, _, _, e) in enumerate(sorted(scored, key=lambda x: x[:3])[:7]))
    assert got == want
    assert topk.search(df.limit(0), F.lit(True), "vec_id", "v", k=3).count() == 0


def test_topk_broadcasts_nothing(spark):
    """Whatever the sizes of files say: packed tiles, dealt to many lanes, are far larger than their files."""
    _, df = vectors(spark)
    found = topk.search(df, F.col("vec_id") % 20 == 0, "vec_id", "v", k=7, tile_rows=5)
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_topk_lanes_hold_few_bytes(spark, monkeypatch):
    _, df = vectors(spark)
    want = topk.search(df, F.col("vec_id") % 20 == 0, "vec_id", "v", k=7, tile_rows=5).collect()
    monkeypatch.setattr(topk, "LANE_BYTES", 1, raising=False)
    got = topk.search(df, F.col("vec_id") % 20 == 0, "vec_id", "v", k=7, tile_rows=2).collect()
    assert sorted(map(str, got)) == sorted(map(str, want))


@pytest.mark.parametrize("most, size", [(127, 1), (-128, 2), (32_767, 2), (40_000, 4), (2.0**31, 8), (1e300, 8)])
def test_stored_components(most, size):
    data = np.array([[most, 0.0, -1.0], [1.0, 2.0, 3.0]])
    kept = topk.stored(data)
    assert len(kept) == 6 * size and (topk.loaded(kept, 2, 3) == data).all()
    assert topk.loaded(topk.stored(np.zeros((2, 0))), 2, 0).shape == (2, 0)


PIECES = st.sampled_from(["a", "b.c", "@", ".", "..", "-", " ", "+", "+1", "1", "23", "256", "4111", "111", "(", ")", "é", "://", "IBAN ", "x:y@h", "DE89 3704 0044 0532 0130 00"])


@settings(max_examples=300, deadline=None)
@given(st.lists(PIECES, max_size=40).map("".join))
def test_personal_data_equals_the_expressions(text):
    assert [s for s in personal_data.spans(text) if s[1] < personal_data.BASE] == brute.base_spans(text)


def test_personal_data_odd(spark):
    texts = [*odd.TEXTS, (50, "IBAN: DE89 3704 0044 0532 0130 00. ftp://me:secret@host.example/x"), (51, "9" * 20_000 + ".1.1.1")]
    rows = personal_data.scan(odd.documents(spark, texts)).collect()
    assert len(rows) == len(texts)
    by_id = {r.doc_id: r for r in rows}
    assert "account:6:33" in by_id[50].spans and "login:35:63" in by_id[50].spans
    assert (by_id[12].n_email, by_id[12].n_ip, by_id[12].n_card, by_id[12].n_phone) == (1, 1, 1, 1)
    assert personal_data.scan(odd.empty(spark)).count() == 0


WINDOWED = near_copies(40, 90, 9) + [(1000 + i, "p q " * i + " ".join(f"s{j}" for j in range(20)) + f" t{i}") for i in range(30)]


@pytest.mark.parametrize("group_rows, most", [(100_000, 4_000_000), (0, 4_000_000), (10, 0), (100_000, 0)])
def test_substring_dedup(spark, group_rows, most):
    texts = ONCE + [(d + 1000, t) for d, t in WINDOWED]
    rows = substring_dedup.remove(odd.documents(spark, texts), group_rows=group_rows, max_broadcast=most).collect()
    want = brute.kept_words(texts, 13)
    assert {r.doc_id: r.text for r in rows} == {d: " ".join(w) for d, w in want.items()}
    for r in rows:
        assert r.n_words - r.n_removed == len(want[r.doc_id])


@pytest.mark.parametrize("group_rows", [100_000, 3])
def test_substring_dedup_compares_words(spark, group_rows):
    """With four bits of each word's hash nearly everything collides, and the result is the same."""
    texts = ONCE[:7] + [(d + 1000, t) for d, t in WINDOWED]
    rows = substring_dedup.remove(odd.documents(spark, texts), group_rows=group_rows, bits=4).collect()
    assert {r.doc_id: r.text for r in rows} == {d: " ".join(w) for d, w in brute.kept_words(texts, 13).items()}


def test_ranks_are_in_the_order_of_words():
    draw = random.Random(6)
    words = [draw.choice(["a", "b", "ab", "é", "zz"]) for _ in range(400)]
    t = W.texts(pa.array([" ".join(words)]))
    for length in (1, 3, 13):
        rank = substring_dedup._ranks(t, W.words(t), length)[: 400 - length + 1]
        runs = [[w.encode() for w in words[i : i + length]] for i in range(len(rank))]
        assert np.argsort(rank, kind="stable").tolist() == sorted(range(len(rank)), key=lambda i: runs[i])
        assert len(set(rank.tolist())) == len({tuple(r) for r in runs})


def test_many_license_places_take_linear_work(spark):
    """Places beyond one piece, many detections over one another, and an early rule that holds late ones."""
    n = 3000
    text = "mit license " * n + "licensed under the mit license"
    made = [license_rules.Rule("long", "license", "license mit license"), license_rules.Rule("mit", "mit", "mit license"),
            license_rules.Rule("word", "license", "license")]
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = [(d.label, d.start, d.stop) for d in license_rules.detect(docs, made).first().detections]
    plain = []
    for rank, (label, pattern) in enumerate((("long", "license mit license"), ("mit", "mit license"), ("word", "license"))):
        at, words, size = 0, text.split(), len(pattern.split())
        while at <= len(words) - size:
            if words[at : at + size] == pattern.split():
                plain.append((rank, at, at + size, label))
                at += size
            else:
                at += 1
    longs = {s for r, s, _, _ in plain if r == 0}
    mits = {s for r, s, _, _ in plain if r == 1}
    inside = lambda r, s, e: (r > 0 and any(x <= s and e <= x + 3 for x in (s, s - 1, s - 2) if x in longs)) or (
        r > 1 and any(x <= s and e <= x + 2 for x in (s, s - 1) if x in mits))
    assert found == [(label, s, e) for r, s, e, label in sorted(plain) if not inside(r, s, e)]


def test_license_texts(spark):
    """Words of licences and notices, without their names."""
    lines = {
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software": "mit",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions": "bsd",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software": "bsd-3-clause",
        "You may not use this file except in compliance with the License.": "apache",
        "http://www.apache.org/licenses/LICENSE-2.0": "apache-2.0",
        "either version 3 of the License": "",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY": "gpl",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.": "mpl-2.0",
        "https://creativecommons.org/licenses/by-nc-sa/4.0/": "cc-by-nc-sa",
        "The origin of this software must not be misrepresented; you must not claim": "zlib",
        "The Software shall be used for Good, not Evil.": "json",
        "No part of this book may be reproduced": "proprietary",
        "warranty and permission are plain words, as software is": "",
    }
    rows = {r.doc_id: r.labels for r in license_rules.detect(odd.documents(spark, list(enumerate(lines)))).collect()}
    assert [rows[i] for i in range(len(lines))] == list(lines.values())
    texts = [r for r in license_rules.rules() if (r.label, r.keyword, r.pattern) in license_rules.TEXTS]
    assert len(texts) == len(license_rules.TEXTS) > 150
    for r in license_rules.rules():
        for way in r.pattern.split("|") if "(" not in r.pattern else [r.pattern]:
            assert r.anchor() in ("licen", *license_rules.STEMS) or r.anchor() == r.keyword, way


def test_substring_dedup_ties_and_empty(spark):
    rows = substring_dedup.remove(odd.documents(spark)).collect()
    assert len(rows) == len(odd.TEXTS)
    # 2 differs in one capital, 3 and the null id hold the windows of 1.
    assert sorted((r.doc_id or 99, r.n_removed) for r in rows if r.n_words == 14) == [(1, 0), (2, 13), (3, 14), (3, 14), (99, 14)]
    assert substring_dedup.remove(odd.empty(spark)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 1000), max_size=12))
def test_targets(sizes):
    """Equals resharing step by step."""
    got = mixing.targets(sizes)
    weight = [1 + i % 3 for i in range(len(sizes))]
    open_, want, left = set(range(len(sizes))), [0.0] * len(sizes), float(sum(sizes))
    while open_:
        total = sum(weight[i] for i in open_)
        for i in open_:
            want[i] = left * weight[i] / total
        over = {i for i in open_ if want[i] > 3 * sizes[i] + 1e-9}
        if not over:
            break
        for i in over:
            want[i] = 3.0 * sizes[i]
            left -= want[i]
        open_ -= over
    assert got == pytest.approx(want)


def test_mixing_odd(spark):
    docs = odd.documents(spark)
    mixed = mixing.mix(docs, block_words=50, shard_words=500)
    rows = mixed.collect()
    assert len(rows) == len(odd.TEXTS)
    taken, target, size = Counter(), {}, {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r["size"] and r.taken == sum(d.words for d in r.draws)
        taken[r.source] += r.taken
        target[r.source], size[r.source] = r.target, r.source_size
    assert all(abs(taken[s] - t) <= 2 for s, t in target.items())
    again = mixing.mix(docs.repartition(5), block_words=50, shard_words=500).collect()
    assert Counter((r.doc_id, r.text, r.taken) for r in again) == Counter((r.doc_id, r.text, r.taken) for r in rows)
    assert mixing.mix(odd.empty(spark)).count() == 0


def sources_of_words(spark, n=90, sources=3, seed=1):
    draw = random.Random(seed)
    rows = [(i, f"s{i % sources}", " ".join(f"w{draw.randrange(999)}" for _ in range(draw.randrange(1, 40)))) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, source string, text string")


def test_mixing_follows_its_tree(spark):
    """Another seed draws other blocks; sums stay, and what is taken is what the shards have drawn."""
    docs = sources_of_words(spark)
    found = {}
    for seed in (1, 2):
        rows = mixing.mix(docs, seed=seed, block_words=40, shard_words=200).collect()
        taken = Counter()
        for r in rows:
            taken[r.source] += r.taken
        assert all(abs(taken[r.source] - r.target) <= 1 for r in rows)
        assert len({d.shard for r in rows for d in r.draws}) > 5
        found[seed] = {r.doc_id: r.taken for r in rows}
    assert found[1] != found[2]


def test_draws_are_disjoint_and_complete(spark):
    plan = mixing.pd.DataFrame({"sid": [0, 1, 2], "quota": [70, 11, 0], "blocks": [30, 4, 5]})
    drawn = mixing._shards_of_blocks(spark, plan, 9, 3).collect()
    places = sorted((r._drawn_sid, d.epoch * b + r._drawn_at) for r in drawn for b in [[30, 4, 5][r._drawn_sid]] for d in r._dealt)
    assert places == [(0, j) for j in range(70)] + [(1, j) for j in range(11)]
    sizes = Counter(d.shard for r in drawn for d in r._dealt)
    assert sum(sizes.values()) == 81 and set(sizes.values()) == {9}


def test_dealt_texts_are_whole(spark):
    docs = sources_of_words(spark)
    mixed = mixing.mix(docs, block_words=40, shard_words=200)
    dealt = mixing.deal(mixed, docs.columns)
    assert dealt.columns == docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    words, target = Counter(), {r.source: r.target for r in mixed.collect()}
    for r in dealt.collect():
        assert r.text == texts[r.doc_id]
        words[r.source] += len(r.text.split())
    assert all(abs(words[s] - t) <= 20.5 for s, t in target.items())


def test_mixing_of_many_sources(spark):
    docs = spark.range(100_000).selectExpr("id AS doc_id", "concat('s', id) AS source", "repeat('w ', int(id % 5)) AS text")
    total = mixing.mix(docs, shard_words=1 << 17).agg(F.sum("size"), F.sum("taken"), F.count_if(F.col("taken") > 3 * F.col("size")), F.count("*")).first()
    assert total[2] == 0 and total[3] == 100_000
    assert abs(total[0] - total[1]) < 0.05 * total[0]


def test_splitting_tree_is_exact():
    quotas = np.array([7, 0, 100, 33])
    parts = [mixing._tree(quotas, 13, 4, a, b) for a, b in ((0, 5), (5, 13))]
    whole = mixing._tree(quotas, 13, 4, 0, 13)
    assert sorted(map(tuple, np.concatenate([p.to_numpy() for p in parts]))) == sorted(map(tuple, whole.to_numpy()))
    assert whole.groupby("sid")["n"].sum().to_dict() == {0: 7, 2: 100, 3: 33}
    for _, own in whole.groupby("sid"):
        own = own.sort_values("start")
        assert (own["start"].to_numpy() == np.cumsum(own["n"]) - own["n"]).all()
    assert whole.groupby("shard")["n"].sum().between(140 // 13, 140 // 13 + 1).all()


def test_licenses_odd(spark):
    texts = [
        *odd.TEXTS,
        (60, "MIT License\u2028x. mit license mit-license, MIT  LICENSE"),
        (61, "This work is licensed under the GNU General Public License, version 3. CC-BY 4.0 and CC BY-NC 4.0"),
        (62, "gnu general public license"),
    ]
    rows = {r.doc_id: r for r in license_rules.detect(odd.documents(spark, texts)).collect()}
    for d, t in texts:
        if d is not None:
            r = rows[d]
            assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.base_licenses(t)
            assert 0 <= r.score <= 1
    assert rows[61].labels == "cc-by,cc-by-4.0,cc-by-nc-4.0,gpl,gpl-3.0"
    assert rows[13].labels == "apache,apache-2.0,gpl"
    assert rows[62].score == 1.0
    assert len(license_rules.rules()) > 200
    assert license_rules.detect(odd.empty(spark)).count() == 0


def test_licenses_by_identifier_and_short_name(spark):
    lines = {
        "SPDX-License-Identifier: MIT": "mit", "SPDX-License-Identifier: MIT-0": "mit-0",
        "SPDX-License-Identifier: Apache-2.0": "apache-2.0", "SPDX-License-Identifier: GPL-3.0-only": "gpl-3.0",
        "SPDX-License-Identifier: LGPL-2.1-or-later": "lgpl-2.1", "SPDX-License-Identifier: BSD-3-Clause": "bsd",
        "SPDX-License-Identifier: MPL-2.0": "mpl-2.0", "SPDX-License-Identifier: PSF-2.0": "python-2.0",
        "SPDX-License-Identifier: CC-BY-SA-4.0": "cc-by,cc-by-sa-4.0", "code under GPLv3": "gpl-3.0",
        "see the LGPL 2.1 for more": "lgpl-2.1", "AGPL": "agpl", "released under MIT": "mit",
        "Open Data Commons Database License": "odbl", "fahrt mit dem bus": "",
    }
    rows = {r.doc_id: r.labels for r in license_rules.detect(odd.documents(spark, list(enumerate(lines)))).collect()}
    assert [rows[i] for i in range(len(lines))] == list(lines.values())
    for r in license_rules.rules():
        assert "spdx" not in r.pattern or "licen[cs]e" not in r.pattern


def test_earlier_rule_suppresses_what_it_contains(spark):
    made = [
        license_rules.Rule("long", "b", "a b c"), license_rules.Rule("inner", "b", "b"),
        license_rules.Rule("same", "b", "a b c"), license_rules.Rule("over", "c", "c d"),
        license_rules.Rule("gated", "zzz", "a"),
    ]
    docs = spark.createDataFrame([(1, "a b c d"), (2, "b"), (3, "x b a b c")], "doc_id long, text string")
    rows = {r.doc_id: [(d.label, d.start, d.stop) for d in r.detections] for r in license_rules.detect(docs, made).collect()}
    assert rows == {
        1: [("long", 0, 3), ("over", 2, 4)], 2: [("inner", 0, 1)], 3: [("long", 2, 5), ("inner", 1, 2)]
    }


def test_small_tables_only_are_broadcast(spark):
    few, other = store.table(spark.range(10).toDF("n"), "few"), spark.range(10).toDF("m")

    def plan(df):
        return other.join(df, F.col("m") == F.col("n"))._jdf.queryExecution().logical().toString()

    assert "broadcast" in plan(store.small(few)) and "broadcast" not in plan(store.small(few, 5))


def test_few_units_are_encoded_at_once(monkeypatch):
    texts = W.texts(pa.array(["one two three four five six seven", "", "eight one nine ten o'clock 5th"]))
    coder = packing.Encoder(catalog.tokenizer_path(), True)
    ids, counts = coder.encode(texts)
    monkeypatch.setattr(packing, "ENCODED_AT_ONCE", 3, raising=False)
    again = packing.Encoder(catalog.tokenizer_path(), True)
    sizes, tokenizer = [], again.tokenizer

    class Counted:
        def encode_batch_fast(self, spans, **options):
            sizes.append(len(spans))
            return tokenizer.encode_batch_fast(spans, **options)

    again.tokenizer = Counted()
    found, each = again.encode(texts)
    assert found.tolist() == ids.tolist() and each.tolist() == counts.tolist()
    assert len(sizes) > 1 and max(sizes) <= 3


def test_units_met_in_any_order_are_found_again():
    texts = ["one two three", "zero two four 5th", "", "ten three one eleven o'clock", "zero eleven"]
    coder, ids, counts = packing.Encoder(catalog.tokenizer_path(), True), [], []
    for text in texts:
        some, n = coder.encode(W.texts(pa.array([text])))
        ids += some.tolist()
        counts += n.tolist()
    found, each = packing.Encoder(catalog.tokenizer_path(), True).encode(W.texts(pa.array(texts)))
    assert found.tolist() == ids and each.tolist() == counts
    assert (np.diff(coder.keys.astype(object)) > 0).all()


def test_a_worker_gets_few_bytes_at_once(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], names=["size", "n"])

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    long = spark.range(0, 4000, 1, 1).select(F.repeat(F.lit("word "), 1000).alias("text"))
    found = store.table(long.mapInArrow(sizes, "size long, n long"), "sizes").collect()
    assert sum(r.n for r in found) == 4000 and max(r.size for r in found) <= 5 << 20
    assert spark.conf.get(key) == before


def test_memory_is_given_back_when_the_arrays_of_a_task_are_gone(monkeypatch):
    alive, at_end = [], []

    def read(batches):
        for batch in batches:
            array = np.arange(batch)
            alive.append(weakref.ref(array))
            yield len(array)

    monkeypatch.setattr(W, "give_back", lambda: at_end.extend(a() is not None for a in alive))
    assert list(W.giving_back(read)(iter([3, 5]))) == [3, 5]
    assert at_end == [False, False]


def test_workers_of_near_duplicates_give_memory_back(spark, monkeypatch):
    back = []
    plain = type(spark.range(1)).mapInArrow
    monkeypatch.setattr(W, "give_back", lambda: back.append(1))

    def mapped(df, read, *rest):
        back.clear()
        list(read(iter([])))
        assert back, read.__qualname__
        return plain(df, read, *rest)

    monkeypatch.setattr(type(spark.range(1)), "mapInArrow", mapped)
    docs = spark.createDataFrame([(1, "en", "a b c d e f"), (2, "en", "a b c d e g")], "doc_id long, lang string, text string")
    jaccard_join.incidence(docs, 5, True)
    jaccard_join._columns(docs, 5, True, 80, 100)
