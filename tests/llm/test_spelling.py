"""Spelling variants against a plain version, and the gram index's promise that near words meet."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from caelum.llm import spelling


def one_edit(a, b):
    """Whether two words differ by exactly one inserted, deleted or replaced letter."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + (len(a) == len(b)) :] == b[k + 1 :]


def brute(docs, least=7, misspelt=31):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % misspelt == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= least and n >= 2}
    by_rest = defaultdict(set)  # near words share a word with one letter left out, or are one
    for w in words:
        for v in {w, *(w[:k] + w[k + 1 :] for k in range(len(w)))}:
            by_rest[v].add(w)
    near = defaultdict(set)
    for own in by_rest.values():
        for a in own:
            near[a].update(b for b in own if one_edit(a, b))
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


def rows(df):
    return [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]


def test_table(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = rows(spelling.op11_spelling(spark, sf_dir))
    want = brute(docs)
    assert len(got) == len(want) and {*got} == want and sum(r[4] for r in got) > 0


def test_odd_rows_and_small_dictionary(spark):
    rng = random.Random(5)
    stems = ["separate", "separately", "abracadabra", "aaaaaaaa", "éÀÿ×÷çàè", "x" * 3000, "".join(rng.choices("ab", k=400))]
    docs = [(None, None), (1, ""), (1, ""), (2, "short words only"), (None, "separate " * 300), (None, "separate " * 300), (3, "SEPARATE Separàte")]
    for k in range(400):
        own = []
        for w in rng.choices(stems, k=6):
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                i = rng.randrange(len(w) + 1)
                w = rng.choice([w[:i] + w[i + 1 :], w[:i] + rng.choice("abé") + w[i:], w[:i] + rng.choice("abé") + w[i + 1 :]])
            own += [w] * rng.choice([1, 1, 1, 3, 40])
        docs.append((k if k % 7 else None, rng.choice([" ", ", ", "1", "\n"]).join(own)))
    frame = spark.createDataFrame([(*d, "z", 1) for d in docs], "doc_id long, text string, word string, n int")
    want = brute(docs)
    assert any(r[2] != r[1] for r in want if r[1])  # chains of forms
    for grams, listed in (((3, 6), 2), ((2, 5), 10)):
        got = rows(spelling.variants(frame, grams=grams, listed=listed))
        assert len(got) == len(want) and {*got} == want
    few = rows(spelling.variants(frame, grams=(2, 6), listed=1, most_grams=40))
    assert {*few} == want
    assert spelling.variants(frame.limit(0)).count() == 0 and spelling.variants(frame.limit(3)).count() == 0


def edits(word, letters):
    for i in range(len(word) + 1):
        for c in letters:
            yield word[:i] + c + word[i:]
        if i < len(word):
            yield word[:i] + word[i + 1 :]
            yield from (word[:i] + c + word[i + 1 :] for c in letters if c != word[i])


@settings(max_examples=80, deadline=None)
@given(
    st.text(alphabet="abc", min_size=7, max_size=14),
    st.sets(st.text(alphabet="abc", min_size=2, max_size=5), max_size=60),
    st.integers(2, 3),
    st.integers(0, 3),
    st.integers(0, 10**6),
)
def test_near_words_meet(word, chosen, shortest, more, seed):
    """All neighbours of a word share a list with it at some level, whatever the dictionary and the ranks of grams."""
    longest = shortest + more
    grams = {g for g in chosen if shortest <= len(g) < longest}
    ranks = np.random.default_rng(seed).integers(0, 4, spelling.CELLS)

    def lists(w):
        out = set()
        for level in range(longest, shortest - 1, -1):
            own = frozenset(g for g in grams if len(g) < level)
            found, sure = spelling.keys_of(w, own, spelling.tails(own), ranks, shortest, level)
            out |= {(level, *f) for f in found}
            if sure:
                return out
        raise AssertionError("a word is sure of its neighbours by the shortest grams")

    mine = lists(word)
    for other in edits(word, "abc"):
        if len(other) >= 7 and other != word:
            assert one_edit(word, other) or one_edit(other, word)
            assert mine & lists(other)


@given(st.text(alphabet="abcé", max_size=9), st.integers(0, 9), st.sampled_from("abcé"))
def test_odd_letters(word, i, c):
    for other in (word[:i] + word[i + 1 :], word[:i] + c + word[i:], word[:i] + c + word[i + 1 :]):
        assert bin((spelling.odd_letters(word) ^ spelling.odd_letters(other)) & (2**64 - 1)).count("1") <= 2
