"""BPE encoding by prefix-sharing trie traversal, and decoding.

The encoding of a word is the chain of its prefixes' last tokens: the last token of a prefix is the
one token that is a suffix of the prefix and may stand after the last token of what precedes it. So
one state per prefix, its last token, is enough, and words with a common prefix share the states of
it. The distinct words of a batch form a trie; it is walked depth first in sorted order, holding only
the path from the root, and every shared prefix is worked out once.

Two tokens may stand side by side if merging their joined text gives them back. A merge across the
border happens if some piece on the right edge of the left token and some piece on the left edge of
the right one exist at the same time and have a merge that comes before the merges which end them.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.caches import Recent, claim, give_back
from tidemark.llm.pieces import bytes_of, per_text, small_batches

#: Pieces and words in a generation of what a worker remembers (there are two), and pairs of tokens whose
#: compatibility it remembers: about 170 MB in all.
REMEMBERED, REMEMBERED_WORDS, PAIRS = 150_000, 100_000, 300_000
#: Text bytes worked on at once.
AT_ONCE = 2 << 20
#: White space of Unicode, and the separators that only Python counts as such.
_SPACE = re.compile(r"\s")


class _Tails(dict):
    """By the last two letters (one of a single letter): sizes of the tokens that end so, longest first."""

    def __init__(self, tokens: Iterable[str]):
        super().__init__()
        singles = {t for t in tokens if len(t) == 1}
        sizes: dict[str, set[int]] = {}
        for t in tokens:
            sizes.setdefault(t[-2:], set()).add(len(t))
        for tail, found in sizes.items():
            self[tail] = tuple(sorted(found | ({1} if tail[-1] in singles else set()), reverse=True))

    def __missing__(self, tail: str) -> tuple[int, ...]:
        return (1,)


class Vocabulary:
    """Tokens, merge ranks and token edges of a word-level BPE with an end-of-word suffix."""

    most_pairs = PAIRS

    def __init__(self, model: dict):
        self.end: str = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.rank: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            pair = (self.ids[left], self.ids[right])
            self.rank[pair] = rank
            self.parts[self.ids[left + right]] = (*pair, rank)
        cut = -len(self.end)
        self.final = {t[:cut]: i for t, i in self.ids.items() if t.endswith(self.end)}
        self.inner = {t: i for t, i in self.ids.items() if not t.endswith(self.end)}
        self.inner_sizes, self.final_sizes = _Tails(self.inner), _Tails(self.final)
        self._right: dict[int, list[tuple[int, float]]] = {}
        self._left: dict[int, list[tuple[int, float]]] = {}
        #: By left << 32 | right.
        self.pairs: dict[int, bool] = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """Pieces on one edge of a token, each with the rank of the merge that ends it."""
        known = (self._left, self._right)[side]
        if token not in known:
            edge, ends = [], float("inf")
            at = token
            while True:
                edge.append((at, ends))
                if at not in self.parts:
                    break
                ends = self.parts[at][2]
                at = self.parts[at][side]
            known[token] = edge
        return known[token]

    def may_follow(self, left: int, right: int) -> bool:
        pair = left << 32 | right
        known = self.pairs.get(pair)
        if known is None:
            rank = self.rank
            # Of equal merges the left one comes first: hence < on the left edge, <= on the right.
            known = not any(
                (m := rank.get((a, b))) is not None and m < ends_a and m <= ends_b
                for a, ends_a in self._edge(left, 1)
                for b, ends_b in self._edge(right, 0)
            )
            if len(self.pairs) >= self.most_pairs:
                self.pairs.clear()
            self.pairs[pair] = known
        return known


def encode_words(vocabulary: Vocabulary, words: Iterable[str]) -> Iterator[tuple[str, list[int]]]:
    """Each distinct word with its token ids, by a depth-first walk of the trie of the words.

    The path holds, for each prefix, the last token and its length. A word's last letter carries the
    end-of-word suffix, so it is a leaf edge of its own and never part of another word's prefix.
    """
    inner, final = vocabulary.inner, vocabulary.final
    inner_sizes, final_sizes = vocabulary.inner_sizes, vocabulary.final_sizes
    pairs, may_follow = vocabulary.pairs, vocabulary.may_follow
    tokens: list[int] = []
    sizes: list[int] = []
    before = ""
    for word in sorted(set(words)):
        size = len(word)
        shared, most = 0, min(len(tokens), size - 1)
        if word[:most] == before[:most]:
            shared = most
        else:
            while before[shared] == word[shared]:
                shared += 1
        del tokens[shared:], sizes[shared:]
        for n in range(shared + 1, size + 1):
            if n < size:
                ids, by_tail = inner, inner_sizes
            else:
                ids, by_tail = final, final_sizes
            # Sizes of the tokens that end in the same two letters, longest first.
            for k in by_tail[word[max(0, n - 2) : n]]:
                if k > n:
                    continue
                token = ids.get(word[n - k : n])
                if token is None:
                    continue
                if k == n:
                    break
                left = tokens[n - k - 1]
                fits = pairs.get(left << 32 | token)
                if fits if fits is not None else may_follow(left, token):
                    break
            else:
                raise ValueError(f"no token ends {word[:n]!r}")
            if n < size:
                tokens.append(token)
                sizes.append(k)
        out, at = [token], size - k
        while at:
            out.append(tokens[at - 1])
            at -= sizes[at - 1]
        out.reverse()
        before = word
        yield word, out


class TrieEncoder:
    """Ids and decoded text of whole texts, as the library gives them for the same file."""

    def __init__(self, tokenizer_file: str, times: float = 1):
        from tokenizers import Tokenizer

        with open(tokenizer_file, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["model"]["type"] != "BPE" or not spec["model"]["end_of_word_suffix"] or spec["decoder"]:
            raise ValueError("a BPE with an end-of-word suffix and no decoder is needed")
        self.vocabulary = Vocabulary(spec["model"])
        self.vocabulary.most_pairs = int(times * PAIRS)
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: t for t, i in self.vocabulary.ids.items()}
        names |= {i: t for t, i in self.added.items()}
        self.names = [names.get(i, "").encode() for i in range(max(names) + 1)]
        self.codes = [i.to_bytes(4, "little") for i in range(max(names) + 1)]
        longest_first = sorted(self.added, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if self.added else None
        library = Tokenizer.from_file(tokenizer_file)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        #: Values are the number of tokens, their ids and their names.
        self.pieces, self.words = Recent(int(times * REMEMBERED)), Recent(int(times * REMEMBERED_WORDS))

    def _value(self, ids: list[int]) -> tuple[int, bytes, bytes]:
        codes, names = self.codes, self.names
        return len(ids), b"".join([codes[i] for i in ids]), b" ".join([names[i] for i in ids])

    def _split(self, piece: str) -> list[str | int]:
        """The pre-tokens of a piece without ASCII white space; an added token as its id."""
        out: list[str | int] = []
        for part in self.special.split(piece) if self.special else [piece]:
            if part in self.added:
                out.append(self.added[part])
            elif part:
                normal = self.normalizer.normalize_str(part)
                out.extend(w for w, _ in self.pre_tokenizer.pre_tokenize_str(normal))
        return out

    def _split_all(self, pieces: list[bytes]) -> list[list[str | int]]:
        """The same for many pieces, most of them in one call of the library.

        The normalizer makes other white space a plain space, so a piece that has any goes alone.
        """
        texts = b" ".join(pieces).decode().split(" ")
        if len(alone := [i for i, t in enumerate(texts) if not t.isascii() and _SPACE.search(t)]):
            split = dict(zip(alone, [self._split(texts[i]) for i in alone], strict=True))
            rest = iter(self._split_all([p for i, p in enumerate(pieces) if i not in split]))
            return [split[i] if i in split else next(rest) for i in range(len(pieces))]
        marks = {m for word in self.added for m in word[:2]} if self.added else set()
        out: list[list[str | int]] = [[] for _ in pieces]
        normal = self.normalizer.normalize_str(" ".join(texts)).split(" ")
        if len(normal) != len(texts):  # some other white space
            return [self._split(t) for t in texts]
        rest = []
        for i, text in enumerate(normal):
            if text.isascii() and text.isalpha():
                out[i].append(text)
            elif marks and all(m in text for m in marks):
                out[i] = self._split(texts[i])
            else:
                rest.append(i)
        ends, at = [], 0
        for i in rest:
            at += len(normal[i]) + 1
            ends.append(at)
        k = 0
        joined = " ".join([normal[i] for i in rest])
        for word, (start, _) in self.pre_tokenizer.pre_tokenize_str(joined) if joined else ():
            while start >= ends[k]:
                k += 1
            out[rest[k]].append(word)
        return out

    def learn(self, pieces: list[bytes]) -> None:
        words = self.words
        split = self._split_all(pieces)
        wanted = {w for ws in split for w in ws if isinstance(w, str)}
        words.turn(len(wanted))
        new = words.find(wanted)
        for word, ids in encode_words(self.vocabulary, new):
            words[word] = self._value(ids)
        for piece, found in zip(pieces, split, strict=True):
            if len(found) == 1 and isinstance(found[0], str):
                self.pieces[piece] = words[found[0]]
                continue
            values = [words[w] if isinstance(w, str) else self._value([w]) for w in found]
            self.pieces[piece] = (
                sum([v[0] for v in values]),
                b"".join([v[1] for v in values]),
                b" ".join([v[2] for v in values]),
            )

    def encode(self, texts: list[bytes]) -> Iterator[tuple[int, bytes, bytes]]:
        """Per text: the number of tokens, the ids as little-endian 32-bit integers, the decoded text."""
        split = [t.split() for t in texts]
        wanted = set().union(*split) if split else set()
        self.pieces.turn(len(wanted))
        new = self.pieces.find(wanted)
        if new:
            self.learn(new)
        look = self.pieces.__getitem__
        for pieces in split:
            if not pieces:
                yield 0, b"", b""
                continue
            counts, codes, names = zip(*map(look, pieces))
            text = b" ".join(names)
            if not all(counts):
                text = b" ".join([n for n in names if n])
            yield sum(counts), b"".join(codes), text


@functools.cache
def _encoder(tokenizer_file: str, times: float) -> TrieEncoder:
    """A worker process keeps one, with what it has learnt, from task to task."""
    encoder = TrieEncoder(tokenizer_file, times)
    give_back()  # some 40 MB of the parsed file
    return encoder


def bpe_codes(
    docs: DataFrame,
    tokenizer_file: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_ids: bool = False,
    with_decoded: bool = False,
    times: float = 1,
    at_once: int = AT_ONCE,
) -> DataFrame:
    """Per row: id, n_tokens, ids_sha256, decoded_sha256; and ids (array<int>) or decoded if wanted.

    Null and empty texts have no tokens and decode to the empty text. Repeated rows and null ids come back
    as they are; an empty table gives an empty result; other columns are not read. A worker holds one batch
    slice, of at_once bytes, and two generations of REMEMBERED pieces; `times` as many, more where nothing else needs
    its memory and less where much does. Neither changes the result.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids, *["decoded"] * with_decoded]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        claim("bpe", _encoder.cache_clear)
        encoder = _encoder(tokenizer_file, times)
        n, ids_sha, decoded_sha, codes, decoded = [], [], [], [], []
        for count, code, text in encoder.encode(bytes_of(batch, "_text")):
            n.append(count)
            ids_sha.append(hashlib.sha256(code).hexdigest())
            decoded_sha.append(hashlib.sha256(text).hexdigest())
            if with_ids:
                codes.append(code)
            if with_decoded:
                decoded.append(text)
        arrays = [batch.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())]
        if with_ids:  # the codes already are the values of the lists
            ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
            values = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(codes))])
            arrays.append(pa.ListArray.from_arrays(pa.array(ends), values))
        if with_decoded:
            arrays.append(pa.array(decoded, pa.binary()).cast(pa.string()))
        return pa.RecordBatch.from_arrays(arrays, names=names)

    source = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    schema = f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" * with_ids + ", decoded string" * with_decoded
    return small_batches(source).mapInArrow(per_text("_text", work, at_once), schema)


def op1_bpe(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return bpe_codes(docs, public_tokenizers.path("word_bpe_49k.json"), times=3)
