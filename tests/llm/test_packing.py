"""Packing against the tokenizer library, and the packing's own rules."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from caelum.llm import packing

LIMIT = 4096
LIBRARY = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1]


def pieces_of(docs, limit=LIMIT):
    """(doc_id, piece, start, length, crc) of every piece, by the library on whole texts."""
    out = []
    for doc, text in docs:
        ids = ids_of(text)
        for k in range(0, len(ids), limit):
            own = ids[k : k + limit]
            out.append((doc, k // limit, k, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
    return sorted(out, key=str)


def check(rows, docs, limit=LIMIT):
    """The pieces are the library's and stand gapless in sequences that are no longer than the limit; their number."""
    assert sorted((tuple(r[:5]) for r in rows), key=str) == pieces_of(docs, limit)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= limit
    return len(sequences)


def bound(rows, limit=LIMIT):
    return -(-sum(r["length"] for r in rows) // limit)


def test_table(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    rows = packing.op12_packing(spark, sf_dir).collect()
    assert check(rows, docs) <= bound(rows) + 1


def test_blocks_are_joined(spark):
    """Small blocks need rounds, and lose next to nothing."""
    rng = random.Random(3)
    docs = [(k, "word " * rng.randint(1, 90)) for k in range(3000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = packing.pack(frame, limit=128, block_rows=100).collect()
    assert check(rows, docs, 128) <= bound(rows, 128) + 3


def test_odd_rows(spark):
    docs = [
        (1, None), (1, None), (2, ""), (2, " \n "), (None, "a null id"), (None, "a null id"), (3, "it's <|endoftext|> and <|ENDOFTEXT|> o'clock 'twas I'LL"),
        (4, "Ünïcödé ÀÉ été İstanbul ΣΑΣ ﬁ é Å K 中文字 😀 ½ ² ٣ a\x1cb\x1fc\x85d　e ̀x"), (5, "z" * 30_000), (6, "a b " * 40_000),
        (7, "x1y2 _a_ (b) [c] {d} e-f g/h i@j.k <l> m|n #o $p% ^q& *r+ =s~ `t` u'v' w\"x\" don't rock'n'roll"), (8, "word " * 4095), (9, "word " * 4096),
    ]
    docs += [(10, "the same text " * 700)] * 40
    frame = spark.createDataFrame([(*d, "z", 1) for d in docs], "doc_id long, text string, piece string, sequence_id int")
    rows = packing.pack(frame, block_rows=16).collect()
    check(rows, docs)
    assert packing.pack(frame.limit(0)).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abcXYZéÀß '’-_.,!<|>0159²½\t\n\x0b\x1c\x1f\x85\xa0᠎​  　́ͅΣσİK"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_encoder(text):
    if not hasattr(test_encoder, "encoder"):
        test_encoder.encoder = packing.Encoder(public_tokenizers.path("word_bpe_49k.json"), 10_000)
    for _ in range(2):  # unknown words, then known ones
        got = np.frombuffer(next(test_encoder.encoder.encode([text])), "<u4").tolist()
        assert got == ids_of(text)[:-1]


@given(st.text(alphabet="ab \n", max_size=80), st.integers(1, 9))
def test_slices(text, most):
    parts = [*packing.slices_of(text, most)]
    assert "".join(parts) == text and all(p[0].isspace() for p in parts[1:])


def fills(home, lengths):
    f = np.bincount(home, lengths)
    return f[f > 0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=60), st.integers(0, 5))
def test_search(lengths, seed):
    """Squares grow, no bin overflows, nothing is lost; also from a poor start."""
    lengths = np.array(lengths)
    poor = np.random.default_rng(seed).permutation(len(lengths))
    for start in (packing.best_fit(lengths, 60), poor):
        before = fills(start, lengths)
        after = fills(packing.Search(lengths, start.copy(), 60).run(), lengths)
        assert after.max() <= 60 and after.sum() == lengths.sum()
        assert (after**2).sum() >= (before**2).sum() and len(after) <= len(before)


def test_exchanges_empty_a_bin():
    """Each kind of exchange is needed by one of these, and best fit alone needs a bin more."""
    for lengths, home in (([5, 3, 2], [0, 1, 2]), ([6, 4, 5, 5], [0, 2, 1, 2]), ([7, 4, 3, 3, 3], [0, 1, 1, 0, 2])):
        lengths = np.array(lengths)
        found = packing.Search(lengths, np.array(home), 10).run()
        assert len(fills(found, lengths)) == -(-lengths.sum() // 10)


@pytest.mark.parametrize("n", [0, 1])
def test_best_fit_small(n):
    assert len(packing.best_fit(np.full(n, 3), 10)) == n
