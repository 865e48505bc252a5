"""Verdicts on labelled rows that a fit did not see, exact neighbours with common terms, reading spread over tasks,
and the pipeline's toxicity stage."""

from __future__ import annotations

import os

import numpy as np
import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="module", autouse=True)
def workers_find_the_package(spark):
    spark.sparkContext.environment["PYTHONPATH"] = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_nearest_with_common_terms_matches_brute_force():
    """Clustered vectors whose terms are partly in most of them: bounds, loose queries and ties give the exact nearest."""
    from strata.llm.toxicity import BlockMaxIndex
    rng = np.random.default_rng(3)
    vectors = []
    for e in range(900):
        common = 10 * (e % 3) + rng.choice(10, 5, replace=False)
        v = {int(t): float(w) for t, w in zip(np.concatenate([common, 30 + rng.choice(300, 4, replace=False)]), rng.integers(1, 5, 9))}
        norm = sum(w * w for w in v.values()) ** 0.5
        vectors.append({t: w / norm for t, w in v.items()})
    vectors[17] = vectors[400] = dict(vectors[801])
    full = np.zeros((900, 330))
    for e, v in enumerate(vectors):
        full[e, list(v)] = list(v.values())
    queries = vectors[:30] + [vectors[400], {t: 0.1 for t in range(60)}, {329: 1.0}, {}]
    for loose in (0.0, 0.05, 1.0):
        index = BlockMaxIndex(vectors, 330)
        index.LOOSE = loose
        assert len(index.common) >= 30
        for q in queries:
            cosine = sum(w * full[:, t] for t, w in q.items()) if q else np.zeros(900)
            order = sorted(range(900), key=lambda e: (-round(float(cosine[e]), 5), e))
            got = index.nearest(q, 12)
            want = [e for e in order if cosine[e] > 0][:12]
            assert np.allclose([c for _, c in got], cosine[want], atol=1e-6)
            assert all(abs(cosine[e] - c) < 1e-6 for e, c in got) and len({e for e, _ in got}) == len(got)
    assert [e for e, _ in index.nearest(vectors[400], 3)][:3] == [17, 400, 801]


def test_quality_verdicts_hold_for_rows_left_out(spark):
    """A small corpus: good rows that were no labels are kept like those that were, poor ones are not."""
    from strata.llm.quality import quality
    rng = np.random.default_rng(5)
    words = {True: [f"good{i}" for i in range(150)], False: [f"poor{i}" for i in range(150)]}
    rows = [(i, " ".join(rng.choice(words[i % 4 != 0], 90))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    marks = spark.createDataFrame([(i, int(i % 4 != 0)) for i in range(400) if i % 3], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in quality(docs, marks).collect()}
    good = [i for i in got if i % 4]
    fitted, left_out = [i for i in good if i % 3], [i for i in good if not i % 3]
    share = lambda ids: np.mean([got[i]["kept"] for i in ids])
    assert share(fitted) >= 0.98 and share(left_out) >= share(fitted) - 0.05
    assert share([i for i in got if i % 4 == 0]) == 0
    again = {r["doc_id"]: r for r in quality(docs.repartition(7), marks).collect()}
    assert {i: (r["kept"], r["score"]) for i, r in again.items()} == {i: (r["kept"], r["score"]) for i, r in got.items()}


def test_lm_scores_and_gradients_hold_for_far_logits():
    """Attention and class logits beyond float32's exponentials, batches of several sizes on the same work arrays."""
    from strata.llm.lm_score import Attention
    rng = np.random.default_rng(1)
    m = Attention(6, 4, 5)
    for factor in (1, 40):
        m.p = {k: v * np.float32(factor if k in ("q", "k", "out") else 1) for k, v in Attention(6, 4, 5).p.items()}
        for n in (7, 2, 9):
            x, y, mask = rng.integers(0, 7, (n, 5)), rng.integers(0, 6, (n, 5)), rng.random((n, 5)) < 0.7
            mask[0, 0] = True
            full = np.take_along_axis(m.forward(x), y[..., None], 2)[..., 0]
            assert np.allclose(m.target_scores(x, y, mask), full[mask], rtol=1e-4, atol=1e-4)
            g = m.gradients(x, y, mask)
            assert all(v.shape == m.p[k].shape and np.isfinite(v).all() for k, v in g.items())
            d = np.exp(m.forward(x)[mask])
            d[np.arange(len(d)), y[mask]] -= 1
            assert np.allclose(g["bias"], d.sum(0) / mask.sum(), atol=1e-5)
            assert not m.gradients(x, y, np.zeros_like(mask))["q"].any()


def test_quality_learns_from_every_trusted_row(spark, monkeypatch):
    """More trusted rows than the 20,000 of a former bound: words that only some of them hold are known from all, and
    the threshold is the quantile of all scores."""
    from strata.llm import quality as Q
    n = 21_000
    rows = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), (F.col("id") % 50).cast("string")).alias("text"))
    marks = rows.select("doc_id", F.lit(1).alias("quality"))
    marks = marks.unionByName(spark.createDataFrame([(3, 0), (None, 1)], "doc_id long, quality int"))
    seen = []
    counts = Q.bucket_counts
    monkeypatch.setattr(Q, "bucket_counts", lambda *a: seen.append(counts(*a)) or seen[-1])
    got = Q.quality(rows, marks, min_words=1).collect()
    assert len(got) == n and [c.sum() for c in seen] == [n, n - 1]  # one word a text; id 3 has two labels
    scores = np.sort([r["score"] for r in got if r["doc_id"] != 3])
    low = np.quantile(scores, 0.002)
    assert all(r["kept"] == (r["score"] >= low - 1e-12) for r in got)
    values = spark.createDataFrame([(float(i * i),) for i in range(101)], "v double").repartition(3)
    assert Q.exact_quantile(values, "v", 0.125) == np.quantile([i * i for i in range(101)], 0.125)
    assert Q.exact_quantile(values, "v", 0.25) == 625 and Q.exact_quantile(values.limit(0), "v", 0.5) is None


def test_records_are_read_in_several_tasks(spark):
    from strata.llm.warc import read_packages, write_packages
    pages = spark.range(600).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h/"), F.col("id")).alias("url"),
                                    F.sha2(F.col("id").cast("string"), 512).alias("html")).repartition(2)
    manifest = write_packages(pages, roll_bytes=40_000)
    assert manifest.count() > 4
    got = read_packages(manifest, range_bytes=10_000)
    assert got.rdd.getNumPartitions() > 4
    listed = read_packages(manifest.select("path"), range_bytes=10_000)  # without the packages' bytes
    assert listed.rdd.getNumPartitions() > 4
    columns = ["page_id", "payload_digest", "payload_bytes", "record_type"]
    want = pages.select("page_id", F.sha1("html").alias("payload_digest"), F.octet_length("html").cast("long").alias("payload_bytes"),
                        F.lit("response").alias("record_type"))
    for read in (got, listed):
        assert sorted(map(tuple, read.select(columns).collect())) == sorted(map(tuple, want.collect()))


def test_postings_go_through_the_driver_in_the_smallest_integers():
    """Parts in any order give all postings by term; a posting takes as few bytes as its values need."""
    import pyarrow as pa

    from strata.llm.toxicity import _postings, merge_segments
    rng = np.random.default_rng(4)
    parts, want = [], []
    for lo, times in ((50, 3), (0, 900), (100, 2)):
        term, number = rng.integers(lo, lo + 40, 600), np.arange(600)
        n = rng.integers(1, times + 1, 600)
        want += zip(term.tolist(), number.tolist(), n.tolist())
        rows = pa.table({"terms": [term[:300], term[300:]], "numbers": pa.array([number[:300], number[300:]], pa.list_(pa.int32())),
                         "times": pa.array([n[:300], n[300:]], pa.list_(pa.int32()))})
        parts.append(merge_segments(rows))
    assert len(parts[0]["numbers"][0].as_py()) == 1200 and len(parts[0]["times"][0].as_py()) == 600
    assert len(parts[1]["times"][0].as_py()) == 1200
    parts.append(merge_segments(rows.slice(0, 0)))
    vocabulary, cut, example, code, values = _postings(pa.concat_tables(parts), 600)
    term = np.repeat(vocabulary, np.diff(cut)).tolist()
    got = zip(term, example.tolist(), np.rint(np.exp(values[code] - 1)).astype(int).tolist())
    assert list(got) == sorted(want) and (np.diff(vocabulary.astype(np.int64)) > 0).all()


def test_stage_drops_toxic_rows_by_id_and_text(spark, tmpdir_path):
    """Null ids, an id with two texts, repeated rows and extra columns (a map, a clashing name)."""
    from strata.llm import stages
    rows = [(i, f"plain words number {i % 7} here" + (" idiot scum" if i % 4 == 0 else "")) for i in range(400)]
    bad, fine = "plain words number 3 here idiot scum", "plain words number 3 here"
    rows += [(None, bad), (None, fine), (None, None), (7, bad), (7, bad), (1, ""), (9, fine)]
    docs = (spark.createDataFrame(rows, "doc_id long, text string").withColumn("toxic_id", F.lit(1))
            .withColumn("extra", F.create_map(F.lit("a"), F.lit(1))))
    spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(400) if i not in (7, 9)],
                          "doc_id long, quality int, toxic int").write.parquet(f"{tmpdir_path}/labels.parquet")
    out = stages.toxicity(spark, docs, tmpdir_path)
    assert out.columns == docs.columns
    want = sorted(((i, t) for i, t in rows if "idiot" not in (t or "")), key=str)
    assert sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str) == want
    assert stages.toxicity(spark, docs.limit(0), tmpdir_path).count() == 0
    # of rows with the same id and text one stays, the same one whatever the layout
    two = spark.createDataFrame([(1, fine, "a"), (1, fine, "b"), (2, "other words stay here too", "c")], "doc_id long, text string, source string")
    picks = {tuple(sorted(r["source"] for r in stages.near_dedup(spark, d, tmpdir_path).collect()))
             for d in (two.repartition(3), two.orderBy(F.desc("source")).coalesce(1))}
    assert len(picks) == 1 and len(next(iter(picks))) == 2


def test_toxicity_model_travels_small_and_scores_alike():
    import pickle

    from strata.llm import toxicity as TX
    r = np.random.default_rng(3)
    n, terms = 400, 5000
    sizes = r.integers(1, 20, terms)
    cut = np.append(0, np.cumsum(sizes))
    example = np.concatenate([np.sort(r.choice(n, s, False)) for s in sizes]).astype(np.uint16)
    code = np.minimum(r.geometric(0.3, len(example)), 299).astype(np.uint16)
    code[::997] = 299
    values = 1 + np.log(np.arange(1, 301, dtype=float))
    vocabulary = np.unique(r.integers(0, 1 << 63, terms + 50).astype(np.uint64))[:terms]
    found = np.concatenate([r.choice(vocabulary, 900, False), r.integers(0, 1 << 63, 4000).astype(np.uint64)])
    model = TX._model(np.arange(n), (np.arange(n) % 3 == 0).astype(float), vocabulary, cut, example, code, values, found,
                      r.integers(2, 300, len(found)), 1000, 2, 5.0, 16, 0.5)
    sent = pickle.dumps(model)
    index = model.index
    assert len(sent) < 0.75 * sum(v.nbytes for v in (model.keys, model.weight, model.number, index.cut, index.code, index.example, index.scale, index.column))
    back = pickle.loads(sent)
    for a, b in ((model.number, back.number), (index.cut, back.index.cut), (index.code, back.index.code), (index.scale, back.index.scale),
                 (index.column, back.index.column), (index.starts, back.index.starts)):
        assert np.array_equal(a, b)
    query = (np.zeros(30, np.int64), np.sort(r.choice(terms, 30, False)), np.ones(30), 1, 5)
    assert index.nearest_all(*query) == back.index.nearest_all(*query)
