"""BPE and token counts against the library."""

import hashlib
import random
import struct
import subprocess
import sys
from pathlib import Path

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.bpe import TrieEncoder, bpe_codes
from tidemark.llm.token_counts import token_counts

FILE = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def encoder():
    return TrieEncoder(FILE)


def check(library, encoder, texts):
    for text, (n, code, decoded) in zip(texts, encoder.encode([t.encode() for t in texts]), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert list(struct.unpack(f"<{n}I", code)) == want
        assert decoded.decode() == library.decode(want, skip_special_tokens=False)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=1, max_size=8))
def test_any_text(library, encoder, texts):
    check(library, encoder, texts)


def test_chosen_texts(library, encoder):
    rnd = random.Random(1)
    letters = "inthaer's <|endoftext|>\t\n\x85 éΣς1²!? ﬁ\U0001f600"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 80))) for _ in range(1500)]
    texts += ["a" * 3000, "in" * 2000, "<|endoftext|><|startoftext|>x<|ENDOFTEXT|>", " ", "", "I'LL don't 's"]
    texts += ["".join(rnd.choice("intha") for _ in range(rnd.randint(1, 90))) for _ in range(800)]
    check(library, encoder, texts)


def test_frames(spark, library):
    texts = ["Hello  world", None, "", "Hello  world", "<|endoftext|>x", "word " * 30_000]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string")
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    got = token_counts(df, FILE).orderBy("doc_id").collect()
    assert [(r.n_bytes, r.n_tokens, r.over_limit) for r in got] == [(len((t or "").encode()), len(w), len(w) > 2048) for t, w in zip(texts, want, strict=True)]
    coded = bpe_codes(df, FILE, with_ids=True, with_decoded=True).orderBy("doc_id").collect()
    for r, w in zip(coded, want, strict=True):
        assert list(r.ids) == w and r.n_tokens == len(w)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(w)}I", *w)).hexdigest()
        assert r.decoded == library.decode(w, skip_special_tokens=False)
        assert r.decoded_sha256 == hashlib.sha256(r.decoded.encode()).hexdigest()
    empty = df.where("doc_id < 0")
    assert token_counts(empty, FILE).count() == 0 and bpe_codes(empty, FILE).count() == 0


def test_null_ids_repeated_rows_and_forgetting(spark, library, monkeypatch):
    from tidemark.llm import bpe

    rnd = random.Random(9)
    texts = [" ".join("".join(rnd.choice("inthaer") for _ in range(rnd.randint(1, 9))) for _ in range(40)) for _ in range(60)]
    rows = [(None, t) for t in texts] + [(7, texts[0])] * 3
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(len(library.encode(t, add_special_tokens=False).ids) for _, t in rows)
    assert sorted(r.n_tokens for r in bpe_codes(df, FILE).collect()) == want
    assert sorted(r.n_tokens for r in token_counts(df, FILE).collect()) == want
    encoder = TrieEncoder(FILE)  # generations so small that they turn over all the time
    encoder.pieces.most = encoder.words.most = 50
    monkeypatch.setattr(bpe, "PAIRS", 20)
    for some in (texts[:20], texts[20:], texts):
        check(library, encoder, some)


def test_other_white_space_among_many_pieces(library):
    # As many pieces vanish as split, so the number of parts stays the same.
    texts = ["alpha", "\u3000", "beta", "prix\u00a0net", "gamma"]
    encoder = TrieEncoder(FILE)
    split = encoder._split_all([t.encode() for t in texts])
    assert split == [["alpha"], [], ["beta"], ["prix", "net"], ["gamma"]]
    rnd = random.Random(4)
    spaces = "\u00a0\u1680\u2003\u2028\u202f\u205f\u3000\x85\x1c\x1f\u200b\u180e\ufeff"
    check(library, TrieEncoder(FILE), [" ".join(texts), *(" ".join("".join(rnd.choice("ab" + spaces) for _ in range(rnd.randint(1, 4))) for _ in range(30)) for _ in range(300))])


def test_memory_of_a_worker_of_the_pipeline():
    """Megabytes of a process that tokenizes 3 MB of new words as the pipeline's workers do, besides its imports."""
    program = """if True:
        import inspect, random, re
        import pyarrow as pa
        import corpus_pipeline, public_tokenizers
        from tidemark.llm import bpe
        from tidemark.llm.pieces import bytes_of, slices

        def held():
            with open("/proc/self/status") as f:
                return int(re.search(r"VmRSS:\\s+(\\d+)", f.read())[1]) / 1024

        before = most = held()
        given = {"times": 1, "at_once": bpe.AT_ONCE} | getattr(corpus_pipeline, "TOKENIZER", {})
        encoder = bpe._encoder(public_tokenizers.path("word_bpe_49k.json"), given["times"])
        rnd = random.Random(3)
        for _ in range(5):
            texts = [" ".join("".join(rnd.choices("inthaerso", k=7)) for _ in range(1000)) for _ in range(75)]
            for part in slices(pa.record_batch([pa.array(texts)], ["text"]), "text", given["at_once"]):
                for _ in encoder.encode(bytes_of(part, "text")):
                    most = max(most, held())
        print(most - before)
    """
    if not Path("/proc/self/status").exists():
        pytest.skip("memory can't be read here")
    root = Path(__file__).parents[2]
    out = subprocess.run([sys.executable, "-c", program], cwd=root, capture_output=True, text=True, check=True).stdout
    assert float(out) < 175
