"""Exact and near duplicates, components and hot groups against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tidemark.llm import near_dedup as N
from tidemark.llm.components import components, merged
from tidemark.llm.exact_dedup import BITS_A_ROW, BLOCK_BITS, LEAST_BLOCKS, MOST_BLOCKS, blocks_for, exact_dedup
from tidemark.llm.id_filter import only_ids, without_ids
from tidemark.llm.skew import join_groups


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, kept string, keep_id string")


def test_exact(spark):
    rnd = random.Random(2)
    texts = ["same"] * 300 + [None, "", "", " "] + [f"text {rnd.randint(0, 400)}" for _ in range(600)] + ["long " * 50_000] * 2
    groups = defaultdict(list)
    for i, t in enumerate(texts):
        groups[t or ""].append(i)
    for blocks in (1, 64):  # one block is full of false positives
        found = exact_dedup(frame(spark, texts), carry=["doc_id", "kept"], blocks=blocks).collect()
        assert len(found) == len(texts)
        for r in found:
            mine = groups[texts[r.doc_id] or ""]
            assert (r.keep_id, r.group_size, r.kept) == (max(mine), len(mine), r.doc_id == max(mine))
            assert r.text_sha256 == hashlib.sha256((texts[r.doc_id] or "").encode()).hexdigest()
            assert r.row.doc_id == r.doc_id and r.row.kept == "x"


def test_filter_grows_with_the_rows_up_to_its_bound():
    assert blocks_for(0) == blocks_for(1000) == LEAST_BLOCKS and blocks_for(10**12) == MOST_BLOCKS
    for rows in (10**6, 10**7, 10**8):
        assert BITS_A_ROW * rows <= blocks_for(rows) * BLOCK_BITS < 2 * BITS_A_ROW * rows


def test_exact_edges(spark):
    rows = [(None, "a"), (1, "a"), (1, "a"), (None, "b"), (2, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup(df).collect())
    assert got == Counter({(None, 1, 3, False): 1, (1, 1, 3, True): 2, (None, None, 1, True): 1, (2, 2, 1, True): 1})
    assert exact_dedup(df.where("doc_id = 9")).count() == 0


def brute(texts):
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets.append({tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)})
    up = list(range(len(texts)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                x, y = sorted((top(i), top(j)))
                up[y] = x
    return [(len(s), top(i)) for i, s in enumerate(sets)]


def test_near(spark, monkeypatch):
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    base = [rnd.choice(words) for _ in range(120)]
    texts: list = [None, "", "  \t", "One two", "one TWO", "one two three", "É é a b c d", "é é a b c d"]
    for _ in range(70):  # a group of near copies, some of which only others link
        w = list(base)
        for _ in range(rnd.randint(0, 5)):
            w[rnd.randrange(len(w))] = rnd.choice(words)
        texts.append(" ".join(w))
    for _ in range(25):
        w = [rnd.choice(words) for _ in range(rnd.randint(4, 80))]
        texts += [" ".join(w), " ".join(w[:-1]), " ".join(w) + " more words here"]
    texts += [texts[20]] * 40
    rnd.shuffle(texts)
    want = brute(texts)
    monkeypatch.setattr(N, "BLOCK", 8)
    monkeypatch.setattr(N, "RUN", 4)
    got = N.near_dedup(frame(spark, texts)).orderBy("doc_id").collect()
    assert [(r.n_shingles, r.component_id) for r in got] == want
    assert all(r.kept == (r.component_id == r.doc_id) for r in got)


def test_near_edges(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (5, "A b c d e f")], "doc_id long, text string")
    got = Counter(tuple(r) for r in N.near_dedup(df).collect())
    assert got == Counter({(None, 2, None, True): 1, (4, 2, 4, True): 2, (5, 2, 4, False): 1})
    assert N.near_dedup(df.where("doc_id = 9")).count() == 0


def test_near_with_repeated_ids(spark):
    rnd = random.Random(6)
    words = [f"w{i}" for i in range(500)]
    text = lambda: [rnd.choice(words) for _ in range(40)]
    a, b, c = text(), text(), text()
    rows = [(1, a), (1, b), (2, [*a, "x"]), (3, [*b, "y"]), (7, c), (7, a), (7, c), (6, [*c, "z"]), (9, text()), (9, text())]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in rows], "doc_id long, text string")
    want = Counter()
    for (i, t), (_, top) in zip(rows, brute([" ".join(t) for _, t in rows]), strict=True):
        same = [j for (j, _), (_, x) in zip(rows, brute([" ".join(u) for _, u in rows]), strict=True) if x == top]
        want[(i, len(t) - 4, min(same))] += 1
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in N.near_dedup(df).collect())
    assert got == want and (2, 37, 1) in got and (3, 37, 1) in got and (7, 36, 6) in got


def test_odd_sketches_let_links_pass_and_few_others():
    import numpy as np

    rng = np.random.default_rng(1)
    draw = lambda n: rng.integers(0, 2**64, n, dtype=np.uint64)
    for n in (30, 146, 500, 700, 5000):
        passed = {}
        for similar in (0.55, 0.752):
            sets = []
            for k in range(60):
                both = -int(-2 * n * similar // (1 + similar))
                extra = (n - both, n - both) if k % 2 else (0, 2 * (n - both))  # of one size, or one in the other
                common = draw(both)
                pair = [np.unique(np.append(common, draw(e))) for e in extra]
                sets.append(pair)
            found = []
            for pair in sets:
                sketch = [N.odd_sketch(s) for s in pair]
                all_ = N.Sketches(
                    np.array([len(s) for s in pair]), np.array([s[0] for s in sketch]), np.array([s[1] for s in sketch]), np.stack([s[2] for s in sketch])
                )
                found.append(bool(all_.pick(slice(0, 1)).likely(all_.pick(slice(1, 2)))[0]))
            passed[similar] = sum(found)
        assert passed[0.752] == 60, n
        assert passed[0.55] <= 20, n


def test_components(spark):
    rnd = random.Random(5)
    edges = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 440)] + [(500, i) for i in range(501, 700)]
    up = {n: n for e in edges for n in e}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    def want():
        return {n: top(n) for n in up if n not in alone or top(n) != n or any(top(m) == n for m in up if m != n)}

    for a, b in edges:
        x, y = sorted((top(a), top(b)))
        up[y] = x
    alone = {n for n in up if all(a == b for a, b in edges if n in (a, b))}
    df = spark.createDataFrame(edges, "a long, b long")
    first = components(df)
    assert {r.node: r.label for r in first.collect()} == want()
    more = [(3, 410), (410, 505), (900, 901)]
    for a, b in more:
        for n in (a, b):
            up.setdefault(n, n)
        x, y = sorted((top(a), top(b)))
        up[y] = x
    got = {r.node: r.label for r in merged(first, spark.createDataFrame(more, "a long, b long")).collect()}
    assert got == want()


def test_hot_join_and_filters(spark, monkeypatch):
    from tidemark.llm import skew

    monkeypatch.setattr(skew, "HOT_GROUPS", 2)
    rows = spark.range(500).select("id", F.when(F.col("id") < 300, 0).otherwise(F.col("id") % 20).alias("k"))
    groups = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("k <> 7")
    for kind in ("long", "string"):
        got = join_groups(rows.withColumn("k", F.col("k").cast(kind)), groups.withColumn("k", F.col("k").cast(kind)), "k", "n", "id")
        assert got.count() == 500 and got.where("n is null").count() == rows.where("k = 7").count()
        assert round(got.where("n is not null").agg(F.sum(F.lit(1) / F.col("n"))).first()[0], 6) == groups.count()
    ids = spark.createDataFrame([(3,), (4,), (999,)], "x long")
    assert {3, 4} <= {r.id for r in only_ids(rows, "id", ids).collect()}
    assert without_ids(rows, "id", ids).count() == 498
