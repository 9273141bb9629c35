"""op11: block-max search against a brute-force cosine top k; scores on odd rows; held-out quality."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import toxicity as T

CLASHES = "doc_id long, text string, lang string, source string, n_chars long, score string, vote int, evidence int"


def test_block_max_search_equals_brute_force():
    rng = np.random.default_rng(1)

    def vec():
        t = np.unique(rng.integers(0, 300, rng.integers(0, 40))).astype(np.int64)
        w = rng.random(len(t))
        return t, (w / np.linalg.norm(w) if len(w) else w)

    ex = [vec() for _ in range(700)]
    ex[5] = ex[6]                                       # tied examples: smaller id first
    ids = rng.permutation(2000)[:700].astype(np.int64)
    shard = T.Shard(ids, rng.integers(0, 2, 700), [e[0] for e in ex], [e[1] for e in ex], block=32)
    qs = ex[:50] + [vec() for _ in range(50)]
    qids = np.r_[ids[:50], np.arange(5000, 5050)].astype(np.int64)
    row, nid, _, sim = shard.search(qids, [q[0] for q in qs], [q[1] for q in qs], k=10)
    for qi, (t, w) in enumerate(qs):
        dq = np.zeros(300)
        dq[t] = w
        scored = []
        for j, (et, ew) in enumerate(ex):
            de = np.zeros(300)
            de[et] = ew
            s = dq @ de
            if s > 1e-12 and ids[j] != qids[qi]:
                scored.append((-round(s, 12), ids[j]))
        want = [i for _, i in sorted(scored)[:10]]
        mine = row == qi
        got = list(nid[mine][np.lexsort((nid[mine], -np.round(sim[mine], 12)))])
        assert got == want, qi


@pytest.fixture(scope="module")
def corpus():
    rng = np.random.default_rng(4)
    clean = [f"w{i}" for i in range(200)]
    rude = ["idiot", "moron", "clown", "worthless", "stupid"]
    rows, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        words = list(rng.choice(clean, 30)) + (list(rng.choice(rude, 4)) if toxic else [])
        rows.append((i, " ".join(words), "en", "s", 1, "x", 1, 2))
        labels.append((i, 1, int(toxic)))
    rows += [(600, None, "en", "s", 0, "x", 1, 2), (601, "", "en", "s", 0, "x", 1, 2), (602, "idiot moron clown " * 3000, "en", "s", 0, "x", 1, 2),
             (603, rows[0][1], "en", "s", 1, "x", 1, 2), (603, rows[0][1], "en", "s", 1, "x", 1, 2)]
    labels += [(600, 1, None), (9999, 1, 1)]
    return rows, labels


def test_scores_on_odd_rows(spark, corpus):
    rows, labels = corpus
    docs = spark.createDataFrame(rows, CLASHES).repartition(3)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = {r.doc_id: r for r in T.score(docs, marks).collect()}
    assert set(out) == {r[0] for r in rows}
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in out.items())
    assert out[600].evidence == [] and out[601].evidence == [] and out[600].score == out[601].score
    assert out[602].predicted == 1
    held = [(r.predicted, i % 4 == 0) for i, r in out.items() if r.held_out and i < 600]
    assert sum(p == t for p, t in held) / len(held) > 0.95
    assert all(e.doc_id != i for i, r in out.items() for e in r.evidence)


def test_scores_empty(spark):
    docs = spark.createDataFrame([], CLASHES)
    assert T.score(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_sample_cut_is_exact(spark):
    rng = np.random.default_rng(9)
    crc = rng.integers(0, 1 << 32, 3000)
    crc[:40] = crc[40]                                  # one crc value shared by many rows
    nnz = rng.integers(0, 50, 3000)
    meta = spark.createDataFrame([(int(c), int(n)) for c, n in zip(crc, nnz)], "crc long, nnz long")
    for bound in (0, 10, 5000, 40_000, 10 ** 9):
        cut = T._cut(meta, bound)
        assert nnz[crc < cut].sum() <= bound
        above = np.unique(crc[crc >= cut])
        if len(above):
            assert nnz[crc <= above[0]].sum() > bound   # the next crc value would not fit


def test_repeated_rows_scored_each(spark, corpus):
    rows, labels = corpus
    docs = spark.createDataFrame(rows, CLASHES)
    out = T.score(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert out.count() == len(rows) and out.where("doc_id = 603").select("score").distinct().count() == 1


def test_texts_do_not_meet_the_labels(spark, corpus):
    """Rows are measured below the join with the labels, so no text of a large corpus is shuffled for its size."""
    rows, marked = corpus
    docs, labels = spark.createDataFrame(rows, CLASHES), spark.createDataFrame(marked, "doc_id long, x int, toxic int")
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        marks = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("label"))
        idf = spark.sparkContext.broadcast(T.inverse_frequencies(docs))
        sizes = T.example_sizes(docs, marks, idf, "doc_id", "text")
        plan = sizes._jdf.queryExecution().executedPlan().toString()
        assert 0 < plan.index("SortMergeJoin") < plan.index("MapInArrow")
        assert sizes.count() == docs.where("crc32(cast(doc_id as string)) % 3 <> 1").join(marks, "doc_id").count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
