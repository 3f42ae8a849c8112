"""Quality and toxicity: held-out accuracy, exact search, edges; and the pipeline."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from tidemark.llm import quality as Q
from tidemark.llm import toxicity as X
from tidemark.llm.labelled import held_out

DATA = "/root/testdata/sf0.01"


def auc(score, y):
    order = np.argsort(np.argsort(score)) + 1.0
    ones = sum(y)
    return (order[np.array(y) == 1].sum() - ones * (ones + 1) / 2) / (ones * (len(y) - ones))


def scored(spark, f, target):
    rows = {r.doc_id: r for r in f(spark, DATA).collect()}
    labels = {r.doc_id: r[target] for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{DATA}/documents.parquet").count()
    held = [(rows[i].score, y, rows[i].predicted) for i, y in labels.items() if rows[i].held_out]
    assert all(rows[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i in rows)
    assert all(0 <= r.score <= 1 for r in rows.values())
    return [h[0] for h in held], [h[1] for h in held]


def test_quality_held_out(spark):
    assert auc(*scored(spark, Q.op9_quality, "quality")) > 0.97


def test_toxicity_held_out(spark):
    assert auc(*scored(spark, X.op7_toxicity, "toxic")) > 0.88


def test_quality_edges(spark):
    df = spark.createDataFrame([(1, None, 5.0), (1, "", 5.0), (None, "words here", 5.0), (2, "x" * 500_000, 5.0)], "doc_id long, text string, score double")
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = Q.fit_from(df, none)
    assert [r.score for r in Q.quality_scores(df, model).collect()] == [0.5] * 4
    one = spark.createDataFrame([*((i, 1) for i in range(3, 12)), (1, None)], "doc_id long, quality int")
    more = df.unionByName(spark.createDataFrame([(i, "words", 0.0) for i in range(3, 12)], df.schema))
    assert Q.fit_from(more, one).bias > 0
    assert Q.quality_scores(df.where("doc_id = 9"), model).count() == 0
    assert df.where(held_out("doc_id")).where("doc_id is null").count() == 0


def test_toxicity_edges(spark):
    df = spark.createDataFrame([(1, None), (1, ""), (None, "words"), (2, "x " * 100_000)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = X.fit(df, none)
    rows = X.toxicity_scores(df, model).collect()
    assert len(rows) == 4 and all(r.score < 0.01 and not r.nearest for r in rows)
    assert X.toxicity_scores(df.where("doc_id = 9"), model).count() == 0


def test_nearest_is_exact():
    rng = np.random.default_rng(3)
    terms, n = 60, 700
    dense = rng.random((n, terms)) * (rng.random((n, terms)) < 0.1)
    dense[5] = dense[6] = dense[690]
    vectors = [(np.flatnonzero(r), r[np.flatnonzero(r)]) for r in dense]
    for order in (None, X.like_order(vectors, terms)):
        index = X.BlockMaxIndex(vectors, terms, order)
        queries = [rng.random(terms) * (rng.random(terms) < 0.08) for _ in range(100)] + [np.zeros(terms)]
        sparse = [(np.flatnonzero(q), q[np.flatnonzero(q)]) for q in queries]
        for k, skip in ((3, -1), (41, 6)):
            together = index.nearest_all(sparse, k, [skip] * len(sparse))
            for q, one, got in zip(queries, sparse, together, strict=True):
                cosines = dense @ q
                best = np.lexsort((np.arange(n), -np.round(cosines, 12)))
                want = [(round(float(cosines[e]), 9), int(e)) for e in best if cosines[e] > 0 and e != skip][:k]
                assert [(round(c, 9), e) for c, e in got] == want
                assert index.nearest(*one, k, skip) == got  # whatever other texts are searched for


def test_bounds_spare_blocks():
    rng = np.random.default_rng(5)
    dense = np.zeros((1280, 200))
    for i in range(1280):  # ten topics of twenty terms
        dense[i, rng.choice(20, 8, replace=False) + 20 * (i % 10)] = rng.random(8)
    vectors = [(np.flatnonzero(r), r[np.flatnonzero(r)]) for r in dense]
    index = X.BlockMaxIndex(vectors, 200, X.like_order(vectors, 200))
    index.nearest_all(vectors[:200], 5)
    assert index.scored < 200 * len(index.blocks) / 3


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, len(Q.FEATURES)))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0)).astype(float)
    m = Q.fit(x[:2000], y[:2000])
    assert ((m.score(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.9
    assert (3, 0) in m.pairs


@pytest.fixture(scope="module")
def tiny(spark, tmp_path_factory):
    rnd = random.Random(8)
    words = [f"word{i}" for i in range(300)]
    good = [" ".join(rnd.choice(words) for _ in range(60)) + "." for _ in range(60)]
    bad = [" ".join(w + "$$$" for w in t.split()) for t in good[:30]]
    leak = " ".join(rnd.choice(words) for _ in range(25))
    texts = [*good, *bad, good[0], good[1] + " end", good[2][:20] + " " + leak + " " + good[3], None]
    d = str(tmp_path_factory.mktemp("tiny"))
    spark.createDataFrame([(i, t, "en", "s", 1, "extra") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long, _score string").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, int(i < 60), 0) for i in range(90)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_pipeline(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    columns, seen = docs.columns, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, tiny)
        assert docs.columns == columns
        seen.append({r.doc_id for r in docs.collect()})
    good, copies, near, leaks = seen
    assert not good & set(range(60, 90)) and set(range(60)) <= good
    assert good - copies == {0}  # of equal texts the largest id stays
    assert copies - near == {91} and near - leaks == {92}
    ids = {r.doc_id for r in corpus_pipeline.run(spark, tiny).collect()}
    assert ids == leaks


def test_pipeline_edges(spark, tiny, tmp_path):
    rows = spark.read.parquet(f"{tiny}/documents.parquet").where("doc_id in (5, 6, 7, 91)")
    texts = {r.doc_id: r for r in rows.collect()}
    odd = [texts[5], texts[6]]
    kind = rows.schema
    make = lambda found: spark.createDataFrame(found, kind)
    # One id with a near copy of another text and with a text of its own; null ids.
    found = [tuple(odd[0]), (8, odd[0].text + " more", *tuple(odd[0])[2:]), (8, *tuple(odd[1])[1:]), (None, *tuple(texts[7])[1:]), (None, None, *tuple(texts[7])[2:])]
    docs = make(found)
    left = corpus_pipeline.drop_near_copies(spark, docs, tiny).collect()
    assert Counter((r.doc_id, r.text) for r in left) == Counter((f[0], f[1]) for k, f in enumerate(found) if k != 1)
    for table in ("labels", "benchmark"):
        spark.read.parquet(f"{tiny}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    docs.write.parquet(f"{tmp_path}/more/documents.parquet")
    for table in ("labels", "benchmark"):
        spark.read.parquet(f"{tiny}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/more/{table}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/more").count() == 4  # without labels nothing is rejected


def test_scores_from_text_to_probability(spark):
    """A second version by hand: terms, idf, cosines, left-out votes, the curve."""
    rnd = random.Random(2)
    plain = [f"{a}{b}{c}" for a in "abcdef" for b in "aeiou" for c in ("nt", "rk", "lm")]
    texts = [" ".join(rnd.choice(plain) for _ in range(30)) for _ in range(90)]
    texts += [" ".join(rnd.choice(plain) for _ in range(30)) + f" hateful{'ly' * (i % 2)} {rnd.choice(plain)}!" for i in range(30)]
    texts += ["ZYXW", "zyxwv, other", "", "unheard unknown"]
    docs = spark.createDataFrame([(i, t, "x", 0.5) for i, t in enumerate(texts)], "doc_id long, text string, score string, nearest double")
    ids = [i for i in range(122) if zlib.crc32(str(i).encode()) % 3 != 1]
    y = [int(90 <= i < 120) for i in ids]
    model = X.fit(docs, spark.createDataFrame(list(zip(ids, y, strict=True)), "doc_id long, toxic int"))
    rows = {r.doc_id: r for r in X.toxicity_scores(docs, model, evidence=X.NEAREST).collect()}

    counts = [Counter(w.strip(".,!").lower()[:4] for w in t.split()) for t in texts]
    idf = lambda t: np.log((1 + len(texts)) / (1 + sum(t in c for c in counts)))
    known = set().union(*(counts[i] for i in ids))
    vectors = [{t: (1 + np.log(n)) * idf(t) for t, n in c.items() if t in known} for c in counts]
    norms = [np.sqrt(sum(x * x for x in v.values())) or 1 for v in vectors]
    cosine = lambda a, b: sum(x * vectors[b].get(t, 0) for t, x in vectors[a].items()) / norms[a] / norms[b]

    def votes(a, but=None):
        near = sorted(((-round(cosine(a, e), 12), k) for k, e in enumerate(ids) if e != but and cosine(a, e) > 0))[: X.NEAREST]
        return [(-c, k) for c, k in near]

    def margin_of(near):
        votes = [c * len(y) / (2 * y.count(y[k])) * (1 if y[k] else -1) for c, k in near]
        return sum(votes) / (sum(map(abs, votes)) or 1)

    margins = np.array([margin_of(votes(e, e)) for e in ids])
    # The best curve by a plain descent, with the same light hold on its slope.
    hold = 0.01 * np.abs(margins).max() ** 2
    a = b = 0.0
    for _ in range(50_000):
        p = 1 / (1 + np.exp(-(a * margins + b)))
        ga, gb = ((np.array(y) - p) * margins).sum() - hold * a, (np.array(y) - p).sum()
        a, b = a + 0.1 * ga, b + 0.02 * gb
    for i in range(len(texts)):
        near = votes(i)
        assert [v.id for v in rows[i].nearest] == [str(ids[k]) for _, k in near] and [v.label for v in rows[i].nearest] == [y[k] for _, k in near]
        assert [v.cosine for v in rows[i].nearest] == pytest.approx([c for c, _ in near])
        assert rows[i].score == pytest.approx(1 / (1 + np.exp(-(a * margin_of(near) + b))), abs=0.005)
        assert rows[i].predicted == int(rows[i].score >= X.THRESHOLD)
    assert rows[120].nearest[0].cosine == pytest.approx(1.0) or 120 not in ids
    assert rows[122].nearest == rows[123].nearest == []


def test_toxicity_model_survives_its_way_to_workers():
    import pickle

    rng = np.random.default_rng(7)
    vocabulary = X.Vocabulary({f"t{i}": i for i in range(40)}, rng.random(40))
    counts = [(np.flatnonzero(r), r[r > 0]) for r in rng.integers(0, 3, (150, 40))]
    model = X.Model(vocabulary, counts, [str(i) for i in range(150)], rng.integers(0, 2, 150))
    again = pickle.loads(pickle.dumps(model))
    some = model.vectors()[:9]
    assert again.nearest(some) == model.nearest(some)
