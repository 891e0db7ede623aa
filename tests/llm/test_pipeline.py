"""The pipeline stage by stage over the smallest supplied table, and the queries' results as registered."""

import collections
import zlib

import pytest
from test_near import components, shingles

import __spark_entry__ as entry
import corpus_pipeline
from tillroll.llm import mixing, pii
from tillroll.llm.jobs import write_stage
from tillroll.llm.queries import pseudonym_key

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        docs = write_stage(stage(spark, docs, SF), "test")
        out.append(docs)
    return [{i: r for i, r in enumerate(d.collect())} for d in out], [d.columns for d in out]


def texts(rows):
    return {r.doc_id: r.text for r in rows.values()}


def test_columns_stay_until_the_last_stage(stages):
    assert all(c == COLUMNS for c in stages[1][:-1])


def test_rejected_documents_go_and_labels_agree(spark, stages):
    (before, kept, *_), _ = stages
    assert texts(kept).items() <= texts(before).items()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    right = sum((d in texts(kept)) == bool(q) for d, q in labels.items())
    assert right >= 0.95 * len(labels)


def test_one_of_each_group_stays(stages):
    _, before, kept, *_ = stages[0]
    comp = components({d: shingles(t, 5) for d, t in texts(before).items()}, 80)
    assert set(texts(kept)) == {d for d, c in comp.items() if c == d}


def test_values_are_replaced(spark, stages):
    key = pseudonym_key(spark)
    _, _, before, done, *_ = stages[0]
    for d, t in texts(before).items():
        new = texts(done)[d]
        assert new == pii.replaced(t, key)[0]
        assert all(t[s:s + n] not in new for _, s, n, _ in pii.replaced(t, key)[1])
    assert all(r.n_chars == len(r.text) for r in done.values())


def test_mix_and_packing(stages):
    *_, before, mixed, packed = stages[0]
    taken = collections.Counter(r.doc_id for r in mixed.values())
    size, given = {}, collections.Counter()
    source = {r.doc_id: r.source for r in before.values()}
    for r in before.values():
        size[r.doc_id] = len(r.text.split())
        given[r.source] += size[r.doc_id]
    got = collections.Counter()
    for d, n in taken.items():
        assert n <= 2
        got[source[d]] += n * size[d]
    names = sorted(given)
    aim = mixing.targets([given[s] for s in names], [(3, 1, 2)[i % 3] for i in range(len(names))], mixing.Fraction(3, 2), 2)
    for s, t in zip(names, aim):
        assert abs(got[s] - t) <= max(size[d] for d in source if source[d] == s)
    pieces = collections.Counter(r.doc_id for r in packed.values() if r.piece == 0)
    assert pieces == taken
    held = collections.Counter()
    for r in packed.values():
        held[r.sequence_id] += r.length
    assert max(held.values()) <= 4096 and len(held) <= -(-sum(held.values()) // 4096) * 1.05 + 1


def test_run_gives_the_stages_rows(spark, stages):
    rows = corpus_pipeline.run(spark, SF).collect()
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert collections.Counter(map(key, rows)) == collections.Counter(key(r) for r in stages[0][-1].values())


def test_queries_are_registered():
    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1


@pytest.mark.parametrize("name", ["op2_lm_scores", "op5_quality"])
def test_held_out_rows(spark, name):
    mod = {"op2_lm_scores": 5, "op5_quality": 3}[name]
    rows = entry.queries()[name](spark, SF).collect()
    assert len(rows) == 200 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % mod == 1) for r in rows)


@pytest.mark.parametrize("name", ["op7_near_duplicates", "op8_top_k", "op12_spelling_variants", "op13_importance_resampling"])
def test_queries_equal_their_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = con.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in cur.description]
    df = entry.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(cols)
    assert sorted(map(tuple, df.select(*cols).collect()), key=repr) == sorted(cur.fetchall(), key=repr)
