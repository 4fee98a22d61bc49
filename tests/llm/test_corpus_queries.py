"""The corpus queries against SQL where there is any, else against brute force, over the small tables."""

import zlib
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from snaphist.llm import catalog
from snaphist.llm.oracle import oracle_sql
from tests.compare import compare, connect
from tests.conftest import SF_DIR
from tests.llm import brute

SQL = oracle_sql()


@pytest.fixture(scope="module")
def texts(spark):
    rows = catalog.documents(spark, SF_DIR).select("doc_id", "text").collect()
    return [(r.doc_id, r.text) for r in rows]


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, name):
    assert compare(catalog.queries()[name](spark, SF_DIR), connect(SF_DIR), SQL[name]) == []


def check_pieces(rows, texts, path, end=2, length=4096):
    """Pieces hold each id once, in order, and fill the sequences without a gap."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    want = defaultdict(list)
    for d, t in texts:
        want[d].append(tokenizer.encode(t or "", add_special_tokens=False).ids + [end])
    assert set(pieces) == set(want)
    for d, documents in want.items():
        if len(documents) > 1:
            continue
        ids, at = np.array(documents[0], "<u4"), 0
        for r in sorted(pieces[d], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert zlib.crc32(ids[at : at + r.length].tobytes()) == r.ids_crc32
            at += r.length
        assert at == len(ids)
    assert sum(r.length for r in rows) == sum(len(i) for x in want.values() for i in x)
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= length
    assert sum(sum(s for _, s in p) < length for p in sequences.values()) <= 1


def test_packing(spark, texts):
    rows = catalog.op1_packing(spark, SF_DIR).collect()
    check_pieces(rows, texts, catalog.tokenizer_path())


def test_personal_data(spark, texts):
    rows = {r.doc_id: r for r in catalog.op7_personal_data(spark, SF_DIR).collect()}
    for d, t in texts:
        r = rows[d]
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == brute.base_row(t)


def test_licenses(spark, texts):
    rows = {r.doc_id: r for r in catalog.op10_license_rules(spark, SF_DIR).collect()}
    for d, t in texts:
        r = rows[d]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.base_licenses(t)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert 0 <= r.score <= 1


def test_mixing(spark, texts):
    rows = catalog.op9_mixing(spark, SF_DIR).collect()
    sizes = {d: len(brute.WORD.findall(t or "")) for d, t in texts}
    assert {r.doc_id: r["size"] for r in rows} == sizes
    docs = catalog.documents(spark, SF_DIR)
    source = {r.doc_id: r.source for r in docs.select("doc_id", "source").collect()}
    taken, target = defaultdict(int), {}
    for r in rows:
        assert 0 <= r.taken <= 3 * r["size"]
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    assert sum(target.values()) == pytest.approx(sum(sizes.values()))
    assert all(abs(taken[s] - t) <= 1 for s, t in target.items())
    again = catalog.op9_mixing(spark, SF_DIR).collect()
    assert {(r.doc_id, r.taken) for r in again} == {(r.doc_id, r.taken) for r in rows}


def test_quality_keeps_clean_and_rejects_junk(spark):
    rows = catalog.op3_quality_lm(spark, SF_DIR).collect()
    label = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = {r.doc_id: r.kept for r in rows}
    assert len(rows) == len(kept) == catalog.documents(spark, SF_DIR).count()
    good = [kept[d] for d, q in label.items() if q == 1]
    bad = [kept[d] for d, q in label.items() if q == 0]
    assert np.mean(good) > 0.9 > np.mean(bad)


def test_pipeline(spark):
    docs = catalog.documents(spark, SF_DIR)
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "exact_duplicates", "near_duplicates", "mixture", "packed"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in docs.select("doc_id").collect()}
        docs = corpus_pipeline.table(stage(spark, docs, SF_DIR), name)
        assert docs.columns == columns
        rows = docs.select("doc_id", "text").collect()
        assert {r.doc_id for r in rows} <= before
        if name == "exact_duplicates":
            assert len({brute.lower(r.text) for r in rows}) == len(rows)
        if name == "near_duplicates":
            groups = brute.components([(r.doc_id, r.text) for r in rows], 5, 80, 100)
            assert all(d == low for d, (_, low) in groups.items())
    rows = docs.select("doc_id", "text").collect()
    pieces = corpus_pipeline.packed(spark, docs, SF_DIR).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in rows}
    assert sum(r.length == r.doc_tokens or r.start == 0 for r in pieces) >= len(rows)
    again = corpus_pipeline.run(spark, SF_DIR).collect()
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32)
    assert sum(r.length for r in again) == sum(r.length for r in pieces)
    assert {k[0] for k in map(key, again)} == {k[0] for k in map(key, pieces)}


@pytest.mark.parametrize("rows", ["odd", "empty"])
def test_pipeline_on_odd_tables(spark, tmp_path, rows):
    """Nulls, empty and very long texts, repeated rows and clashing columns go through every stage."""
    from tests.llm import odd

    docs = odd.documents(spark) if rows == "odd" else odd.empty(spark)
    odd.labels(spark).write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        docs = corpus_pipeline.table(stage(spark, docs, str(tmp_path)), name)
        assert docs.columns == before.columns
        assert docs.select("doc_id").subtract(before.select("doc_id")).isEmpty()
    pieces = corpus_pipeline.packed(spark, docs, str(tmp_path)).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in docs.select("doc_id").collect()}
    assert bool(pieces) == (rows == "odd")
