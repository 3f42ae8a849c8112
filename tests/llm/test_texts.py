"""Pages, archives, benchmark overlaps, personal data: against brute force and round trips."""

import base64
import hashlib
import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontaminate as D
from tidemark.llm import pii as P
from tidemark.llm.html_text import main_text, page_texts
from tidemark.llm.warc import read_warc, write_warc


def slow_density(node, body):
    """A second version: the sums of a node worked out anew from the texts and tags below it."""

    def texts(n, linked=False):
        linked = linked or n.tag == "a"
        for p in n.parts:
            if isinstance(p, str):
                yield len(p.replace(" ", "").replace("\n", "")), linked
            elif not p.beside:
                yield from texts(p, linked)

    def tags(n):
        for p in n.parts:
            if not isinstance(p, str) and not p.beside:
                yield p.tag
                yield from tags(p)

    inside = list(texts(node))
    c, linked = sum(n for n, _ in inside), sum(n for n, a in inside if a)
    below = list(tags(node))
    t, lt = len(below) or 1, below.count("a") + (node.tag == "a") or 1
    whole = list(texts(body))
    ratio = sum(n for n, a in whole if a) / (sum(n for n, _ in whole) or 1)
    if not c:
        return 0.0
    base = max(2.0, math.log(c * linked / ((c - linked) or 1) + ratio * c + math.e))
    return c / t * max(0.0, math.log((c / (linked or 1)) * (t / lt), base))


def test_density_by_a_second_version():
    from tidemark.llm import html_text as H

    rnd = random.Random(4)
    some = ["<div>", "</div>", "<p>", "<a href=x>a link</a>", "<a href=y><b>other</b> link</a>", "<ul><li>", "</ul>", "some words ", "more, and more text. " * 5, "<b>x</b>"]
    for _ in range(60):
        page = f"<html><body>{''.join(rnd.choice(some) for _ in range(60))}</body></html>"
        nodes, twins = [H.tree(page)], [H.tree(page)]
        for all_ in (nodes, twins):
            for n in all_:
                all_ += [p for p in n.parts if not isinstance(p, str) and not p.beside]
        H.main_node(nodes[0])  # may put further nodes aside, once all are measured
        body = next(n for n in twins if n.tag == "body")
        for n, twin in zip(nodes, twins, strict=True):
            if n.tag not in ("a", "b"):
                assert n.density == pytest.approx(slow_density(twin, body))


@pytest.mark.parametrize("page, text", [
    ("", ""), ("plain", "plain"), ("<p>a<p>b", "a\nb"), ("<b>a <i>b</i></b>c", "a bc"),
    ("<nav>menu</nav><article><h1>T</h1><p>One &amp; two<br>three</p></article><footer>f</footer>", "T\nOne & two three"),
    ("<article><p><b>long.<p>next</p><p>more</p></article>", "long.\nnext\nmore"),
    ("<div id=sidebar><p>" + "aside words " * 30 + "</p></div><div class=content><p>" + "main text, " * 9 + "</p></div>", ("main text, " * 9).strip()),
    ("<body><div><p>" + "Text of the page. " * 9 + "</p><form>Name <input></form><div class='comments'><p>" + "reader says " * 40 + "</p></div></div>", ("Text of the page. " * 9).strip()),
    ("<script>if (a<b) '</p>'</script><style>p{}</style><p>x", "x"), ("<!-- <p>no</p> --><p>yes", "yes"), ("<p>a < b &lt; c &#233;", "a < b < c é"),
    ("<div class='page with-sidebar'><h1>Head</h1><p>Body text.</p></div>", "Head\nBody text."),
    ("<header><h1>Site</h1></header><div class='post'><header><h1>Title</h1></header><p>" + "A text. " * 9 + "</p></div>", "Title\n" + ("A text. " * 9).strip()),
    ("<article><p>" + "Main words. " * 9 + "</p></article><section class='comments'><article class='comment'><p>reader</p></article></section>", ("Main words. " * 9).strip()),
    ("<ul><li>one<li>two</ul>", "one\ntwo"), ("<p>cut off <a href='x", "cut off"),
])
def test_main_text(page, text):
    assert main_text(page) == text


def test_broken_pages_end():
    for page in ("<p" * 20_000, '<p ">' * 10_000, "<div>" * 20_000 + "x", "<" * 20_000, "<b>" * 9000 + "<p>" * 900, "<!--" * 9000, "&" * 9000):
        main_text(page)


def test_pages_frame(spark):
    df = spark.createDataFrame([(1, "u", None, "c"), (2, None, "<p>a", "c"), (2, None, "<p>a", "c")], "page_id long, url string, html string, text string")
    assert sorted((r.page_id, r.text, r.n_chars) for r in page_texts(df).collect()) == [(1, "", 0), (2, "a", 1), (2, "a", 1)]
    assert page_texts(df.where("page_id = 9")).count() == 0


@pytest.mark.parametrize("broadcast", [True, False])
def test_warc(spark, tmp_path, monkeypatch, broadcast):
    from tidemark.llm import warc

    if not broadcast:
        monkeypatch.setattr(warc, "BROADCAST_GROUPS", 0)
    pages = ["a\r\n\r\nWARC/1.1\r\n\r\nb", "é", "é", None, "", "\n", "x" * 300_000, "é", "é\r\n"]
    rows = [(10 - i, None if i == 3 else f"http://h/\r\nX: {i}", p, "clash") for i, p in enumerate(pages)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, record_type string")
    write_warc(df, str(tmp_path / "w"))
    got = {r.page_id: r for r in read_warc(spark, str(tmp_path / "w"), with_payload=True).collect()}
    assert len(got) == len(rows)
    for page_id, _, html, _ in rows:
        body = (html or "").encode()
        first = min(i for i, _, h, _ in rows if (h or "") == (html or ""))
        r = got[page_id]
        assert (r.payload_bytes, r.payload_digest) == (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode())
        assert (r.record_type, r.refers_to) == (("response", None) if page_id == first else ("revisit", first))
        assert r.payload == ("" if page_id != first else html or "")
    write_warc(df.where("page_id > 99"), str(tmp_path / "e"))
    assert read_warc(spark, str(tmp_path / "e")).count() == 0


def test_warc_sizes_repeats_and_null_ids(spark, tmp_path, monkeypatch):
    from tidemark.llm import warc

    monkeypatch.setattr(warc, "SIZES", ((10, 3), (1000, 2), (1 << 31, 1)))
    big = "long " * 4000
    rows = [(i, "u", "x" * (i % 14)) for i in range(40)] + [(50 + i, "u", "y" * (100 + i)) for i in range(7)]
    rows += [(70, "u", big), (71, "u", big), (72, "u", big + "!"), (71, "u", big), (None, "u", big), (None, "u", "none else"), (None, "u", "none else")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    write_warc(df.repartition(2), str(tmp_path / "w"))
    got = sorted((r.page_id is None, r.page_id or 0, r.record_type, r.refers_to) for r in read_warc(spark, str(tmp_path / "w")).collect())
    want = []
    for page_id, _, html in rows:
        same = [i for i, _, h in rows if h == html and i is not None]
        revisit = same and page_id != min(same)
        want.append((page_id is None, page_id or 0, "revisit" if revisit else "response", min(same) if revisit else None))
    assert got == sorted(want, key=lambda w: (w[0], w[1], w[2], w[3] is None, w[3] or 0))
    files = [f for f in (tmp_path / "w").rglob("part-*") if f.stat().st_size]
    assert all(f.read_bytes().count(b"WARC/1.1\r\n") <= (1 if "upto-2147483648" in str(f) else 3) for f in files)


def test_masks_catch_every_overlap():
    from itertools import combinations

    for gone in combinations(range(D.WINDOW), D.WINDOW - D.LEAST_EQUAL):
        left = set(range(D.WINDOW)) - set(gone)
        assert any(all(o + x in left for x in m) for m in D.MASKS for o in range(D.WINDOW - m[-1]))


def leaks(text, item):
    """Whether 13 words in a row of the item, laid anywhere on the text, have 10 equal ones; shorter items as documented."""
    words = [w for w in (p.strip(" ,.!?").lower() for p in text.split()) if w]
    size = min(13, len(item))
    least = 10 if size == 13 else size - size * 3 // 13 if size >= 7 else size
    for offset in range(-len(item), len(words)):
        same = [0 <= offset + k < len(words) and words[offset + k] == w for k, w in enumerate(item)]
        if any(sum(same[k : k + size]) >= least for k in range(len(item) - size + 1)):
            return True
    return False


def test_decontaminate(spark, monkeypatch):
    rnd = random.Random(6)
    words = [f"w{i}" for i in range(60)]
    items = [[rnd.choice(words) for _ in range(n)] for n in (1, 4, 5, 9, 10, 12, 13, 30, 30, 50)] + [[]]
    docs = [None, "", "w1 " * 3000, "!!! ???"]
    for _ in range(150):
        w = [rnd.choice(words) for _ in range(rnd.randint(0, 60))]
        item = list(rnd.choice(items))
        for k in range(len(item)):
            if rnd.random() < 0.2:
                item[k] = "other"
        at = rnd.randint(0, len(w))
        docs.append(" ".join([*w[:at], *(x.upper() + rnd.choice(["", ",", "."]) for x in item), *w[at:]]))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)] + [(99, None), (None, "w1 " * 20)], "item_id long, text string")
    docs += [docs[10]] * 50
    df = spark.createDataFrame([(i, t, "clash", {"a": i}) for i, t in enumerate(docs)], "doc_id long, text string, items string, m map<string,long>")
    want = [[i for i, w in enumerate(items) if w and leaks(t or "", w)] for t in docs]
    assert sum(map(bool, want)) > 20
    for size in (D.BLOCK_BYTES, 200):
        monkeypatch.setattr(D, "BLOCK_BYTES", size)
        for keep in (False, True):
            got = D.decontaminate(df, bench, keep_text=keep).orderBy("doc_id").collect()
            assert [list(r["items"]) for r in got] == want
            assert all(r.contaminated == bool(r["items"]) and r.m == {"a": r.doc_id} for r in got)
            assert not keep or [r.text for r in got] == docs
        assert D.decontaminate(df.where("doc_id < 0"), bench).count() == 0
    assert not any(r.contaminated for r in D.decontaminate(df, bench.where("item_id = 1000")).collect())


def base_spans(text):
    out = []
    for kind in P.KINDS:
        for m in re.finditer(P.PATTERNS[kind], text):
            digits = re.sub("[^0-9]", "", m[0])
            luhn = sum(int(c) if i % 2 == 0 else 2 * int(c) - 9 * (int(c) > 4) for i, c in enumerate(digits[::-1])) % 10 == 0
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")) or kind == "card" and not (13 <= len(digits) <= 19 and luhn):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


def test_pii(spark):
    rnd = random.Random(7)
    texts = ["".join(rnd.choice("ab1234567890.@-+ ()%_é\U0001f600") for _ in range(rnd.randint(0, 80))) for _ in range(600)]
    texts += ["".join(rnd.choice("4540 -1") for _ in range(rnd.randint(10, 60))) for _ in range(600)]
    texts += ["a@b.c_d@e.f", "1.2.3.4.5.6.7.8", "0001.2.3.255 1.2.3.256", "+1 (555) 123-4567.", "x@y..z a@b.c.", "1 " * 30_000, "a" * 60_000, ""]
    secret = 'é token = "908038b7daaf91e730d2f64001c52934d43d0011" and mail a@b.co'
    texts += [secret, "tel 555-123-4567 now", "thntbleerationtheninginganandre plain"]
    df = spark.createDataFrame([*enumerate(texts), (-1, None)], "doc_id long, text string")
    model = P.train(spark)
    found = P.find_pii(df, model).persist()
    got = {r.doc_id: r for r in found.collect()}
    for i, text in enumerate(texts):
        assert [(s.kind, s.start, s.end) for s in got[i].base] == base_spans(text)
    assert got[-1].base == [] and got[-1].added == []
    at = texts.index(secret)
    assert [(s.kind, s.start, s.end) for s in got[at].added] == [("secret", 11, 51)]
    assert [s.kind for s in got[at + 1].added] == ["number"] and got[at + 2].added == []
    clean = {r.doc_id: r.text for r in P.redacted(found).collect()}
    assert clean[at] == 'é token = "<secret>" and mail <email>'
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_pii_long_texts_and_tables(spark):
    model = P.train(spark)
    many = " ".join(f"user{i}@host{i % 7}.org, 10.0.{i % 256}.{i % 255}" for i in range(1500))
    df = spark.createDataFrame([(1, many, 5, "x"), (1, many, 5, "x"), (None, "a@b.co", 5, "x")], "doc_id long, text string, base int, added string")
    rows = P.find_pii(df, model).collect()
    assert len(rows) == 3
    for r in rows:
        assert [(s.kind, s.start, s.end) for s in r.base] == base_spans(r.text)
    assert P.find_pii(df.where("doc_id = 9"), model).count() == 0
    addresses = " ".join(f"u{i}@h.org" for i in range(200_000))
    began = time.time()
    sizes = P.find_pii(spark.createDataFrame([(1, addresses)], "doc_id long, text string"), model).select(F.size("base").alias("n")).collect()
    assert sizes[0].n == 200_000 and time.time() - began < 120


def test_pii_added_spans_of_long_texts(spark):
    rnd = random.Random(5)

    def one(i):
        return rnd.choice([
            f"tel 555-{i % 900 + 100}-4567", f"token={'%032x' % rnd.getrandbits(128)}", f"u{i}@{'%020x' % rnd.getrandbits(80)}.org",
            f"10.0.{i % 256}.7", f"call 4111 1111 1111 {i % 9000 + 1000}", f"+1 555 {i % 900 + 100} 4567", "plain words", f"{i}-{i + 1}-{i + 2} {i}",
        ])

    trees, least = model = P.train(spark)
    texts = [" ".join(one(i) for i in range(n)) for n in (0, 3, P.RUN, 2_500)]
    df = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    scores = F.expr(f"transform(found, c -> struct(c.kind, c.start, c.end, {trees.sql([f'c.x.{f}' for f in P.FEATURES])} as p))")
    proposed = {r.doc_id: r.found for r in df.withColumn("found", P.candidates(F.col("text"))).select("doc_id", scores.alias("found")).collect()}
    for r in P.find_pii(df, model).collect():
        base = base_spans(texts[r.doc_id])
        clear = [c for c in proposed[r.doc_id] if c.p >= float(f"{least:.6g}") and not any(s < c.end and c.start < e for _, s, e in base)]
        ranked = lambda c: (c.p, -c.start, c.kind)
        best = [c for c in clear if not any(d.start < c.end and c.start < d.end and ranked(d) > ranked(c) for d in clear)]
        assert [(s.kind, s.start, s.end) for s in r.added] == sorted((c.kind, c.start, c.end) for c in best)
        assert len(best) > P.RUN or r.doc_id < 3


def test_trees_hold_out():
    import numpy as np

    from tidemark.llm.boosting import boost

    rng = np.random.default_rng(0)
    x = rng.normal(size=(800, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    m = boost(x[:600], y[:600])
    assert ((m.probability(x[600:]) >= 0.5) == y[600:]).mean() > 0.9


def _paragraphs(n, size, word):
    return "".join(f"<p>{(word + ' ') * (size // (len(word) + 1))}{i}.</p>" for i in range(n))


@pytest.mark.parametrize(
    "inside",
    [
        f"<div class=content><section>{_paragraphs(10, 200, 'first')}</section><section>{_paragraphs(5, 200, 'second')}</section></div>",
        f"<div class=text><h1>second headline</h1>{_paragraphs(5, 400, 'second')}<ul>{_paragraphs(40, 100, 'first').replace('p>', 'li>')}</ul></div>",
        f"<section>{_paragraphs(10, 200, 'first')}</section><section>{_paragraphs(5, 200, 'second')}</section>",
    ],
)
def test_main_text_in_several_parts(inside):
    links = "".join(f"<li><a href=/{i}>elsewhere {i}</a></li>" for i in range(20))
    text = main_text(f"<html><body><div><ul>{links}</ul></div>{inside}<div>All rights kept</div></body></html>")
    assert text.count("first") > 300 and text.count("second") > 100
    assert ("headline" in text) == ("headline" in inside)
    assert "elsewhere" not in text


def test_short_items_are_tolerant():
    words = [f"q{i}" for i in range(12)]
    for n in range(1, 13):
        item = words[:n]
        block = D.make_block([(0, " ".join(item).encode())])
        for gone in range(n):
            one = " ".join(["before", *item[:gone], "other", *item[gone + 1 :], "after"]).encode()
            assert bool(block.matches([one])[0]) == (n >= 7), (n, gone)
            two = " ".join("other" if i in (gone, (gone + 4) % n) else w for i, w in enumerate(item)).encode()
            assert bool(block.matches([two])[0]) == (n >= 9), (n, gone)
        assert block.matches([" ".join(["x", *item, "y"]).encode(), b"x y"]) == [{0}, set()]
        # A text that begins or ends within the item has replaced words there.
        assert n < 7 or block.matches([" ".join(item[1:]).encode(), " ".join(item[:-1]).encode()]) == [{0}, {0}]
