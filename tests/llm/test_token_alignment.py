"""Alignment of ids against whole texts encoded at once and plain loops."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cellwright.llm import queries, token_alignment

from ..conftest import DATA

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


class Plain:
    """Groups of a whole text, by sets of byte offsets."""

    def __init__(self):
        self.a = Tokenizer.from_file(A)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=B)
        # how byte-level files write bytes, from the tokenizer itself: each byte that ASCII text or two-byte characters have
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.alphabet = {chr(b): b for b in shown}
        self.alphabet |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in shown)}

    def bytes_a(self, i):
        return bytes(self.alphabet[c] for c in self.a.id_to_token(i))

    def bytes_b(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def groups(self, text):
        if not text:
            return None
        whole = (" " + text).encode()
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        parts = [list(map(self.bytes_a, a)), list(map(self.bytes_b, b))]
        if any(b"".join(p) != whole for p in parts):
            return None
        ends = [np.cumsum(list(map(len, p))).tolist() for p in parts]
        out, i, j = [], 0, 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            m, n = ends[0].index(cut, i) + 1, ends[1].index(cut, j) + 1
            out.append((a[i:m], b[j:n]))
            i, j = m, n
        return out


@pytest.fixture(scope="module")
def plain():
    return Plain()


def expected(plain, rows):
    found = [(i, plain.groups(t)) for i, t in rows]
    links = Counter((a[-1], b[-1]) for _, g in found for a, b in g or [])
    docs = Counter(p for _, g in found for p in {(a[-1], b[-1]) for a, b in g or []})
    most = Counter()
    for (_, b), c in links.items():
        most[b] = max(most[b], c)
    out = []
    for i, g in found:
        if not g:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        pairs = [(a[-1], b[-1]) for a, b in g]
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        best = sum(links[p] == most[p[1]] for p in pairs)
        out.append((
            i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(g), best, sum(links[p] for p in pairs),
            hashlib.sha256(text.encode()).hexdigest(),
        ))
    return sorted(out, key=str), {(*p, c, docs[p], c == most[p[1]]) for p, c in links.items()}


def rows_of(df):
    names = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def test_whole_table(spark, plain):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()]
    assert rows_of(queries.op13_token_alignment(spark, DATA)) == expected(plain, rows)[0]


ODD = [
    "the cat sat", "  two spaces  inside and behind ", "tab\t then \n lines\n\n x", "a ▁b", "▁", " ", "   ", "\n", None, "", "<|endoftext|> <s> <0x41>",
    "naïve 한국어 😀 \x00\x1f\x85　x  y", "it's we'll 'd 12345 3.14", "same words " * 300, "same words " * 300, "x" * 3000, "  end​", "ﬁ Å ① ",
]


def test_odd_rows_in_two_chunks_of_a_task(spark, plain):
    rows = [*enumerate(ODD), (None, "no id"), (3, "id again"), (None, None)] + [(100 + k, f"the cat sat {k % 7} times ") for k in range(4500)]
    docs = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, Pair string").repartition(1)
    out, pairs = token_alignment.align(docs, A, B, with_groups=True)
    want, counts = expected(plain, rows)
    assert rows_of(out) == want
    assert {tuple(r) for r in pairs.collect()} == counts
    for r in out.where("groups is not null and n_groups > 0").collect():
        assert hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    out, pairs = token_alignment.align(none, A, B)
    assert out.count() == 0 and pairs.count() == 0


@settings(deadline=None, max_examples=150)
@given(st.lists(st.text(st.sampled_from("ab'sT1. \n\t▁é한😀<|>　\x1c"), max_size=30), max_size=4))
def test_segments_align_as_in_their_text(texts):
    for text, parts in zip(texts, ALIGNER(texts)):
        groups = PLAIN.groups(text)
        if groups is None:
            assert not parts or None in parts
        else:
            assert ";".join(p[2] for p in parts) == ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)


ALIGNER, PLAIN = token_alignment.Aligner(A, B), Plain()


def test_bitmaps():
    rng = np.random.default_rng(3)
    sets = [np.sort(rng.choice(4096, n, replace=False)) for n in (0, 1, 5, 255, 256, 3000, 4096)]
    number, at = token_alignment.unpack([token_alignment.pack(s) for s in sets])
    for k, s in enumerate(sets):
        assert sorted(number[at == k]) == s.tolist()
    assert max(len(token_alignment.pack(s)) for s in sets) == 512
