"""Operators against plain Python, SQL or the libraries, and their defined results on odd rows."""

import glob
import hashlib
import html
import itertools
import json
import math
import random
import tracemalloc

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from caelum.llm import (
    common,
    decontaminate,
    exact_search,
    language_id,
    line_dedup,
    near_dup,
    quality,
    queries,
    quotes,
    sentence_pieces,
    token_counts,
    warc,
)
from tests.llm import brute

DOCS = "doc_id long, text string"


def rows(df):
    return [tuple(r) for r in df.collect()]


def documents(spark, sf_dir, name="documents"):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark, sf_dir):
    return rows(documents(spark, sf_dir).select("doc_id", "text"))


def in_sql(sql, **tables):
    """The rows of ``sql`` over tables given as parquet paths, columns by name."""
    con = duckdb.connect()
    for name, path in tables.items():
        con.execute(f"create view {name} as select * from '{path}'")
    found = con.execute(sql)
    order = sorted(range(len(found.description)), key=lambda k: found.description[k][0])
    return sorted(([r[k] for k in order] for r in found.fetchall()), key=str)


def by_name(df):
    return sorted(([r[c] for c in sorted(df.columns)] for r in df.collect()), key=str)


# ------------------------------------------------------------------ against SQL


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, sf_dir, name):
    tables = {t: f"{sf_dir}/{t}.parquet" for t in ("documents", "embeddings", "pages", "conversations")}
    assert by_name(queries.QUERIES[name](spark, sf_dir)) == in_sql(queries.ORACLES[name], **tables)


# ------------------------------------------------------------------ near-duplicates


def test_near_duplicates(spark, sf_dir):
    want = brute.groups(texts(spark, sf_dir), 4)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_dup.op8_near_dup(spark, sf_dir).collect()}
    assert got == {d: (n, c, d == c) for d, (n, c) in want.items()}


@pytest.mark.parametrize("block", [2048, 8])
def test_near_copies_of_one_text(spark, block):
    """A large group of copies with edits at random places, some beyond the limit: long lists, in one block and in many."""
    rnd = random.Random(1)
    base = [f"w{rnd.randrange(400)}" for _ in range(120)]
    docs = []
    for k in range(90):
        words = list(base)
        for _ in range(rnd.randrange(7)):
            words[rnd.randrange(len(words))] = f"x{k}"
        docs.append((k, " ".join(words)))
    docs += [(100 + k, " ".join(f"u{rnd.randrange(10_000)}" for _ in range(40))) for k in range(20)]
    docs += [(200, docs[0][1]), (201, "a b"), (202, "a  b"), (203, "a"), (204, "B A"), (205, "a B")]
    df = spark.createDataFrame(docs, DOCS)
    got = {r["_doc"]: (r["n"], r["component"]) for r in near_dup.near_duplicates(df, words=4, block=block).collect()}
    assert got == brute.groups(docs, 4)


def test_near_duplicates_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "  \n"), (None, "one two three four five six"), (4, "one two three four five six"), (4, "one two three four five six"), (None, "alone here")]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, component string")
    got = sorted(((r["_doc"], r["n"], r["component"]) for r in near_dup.near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (None, 2, 4), (4, 2, 4), (4, 2, 4), (None, 1, None)], key=str)
    kept = near_dup.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(rows(kept.select("doc_id", "text")), key=str) == sorted([docs[0], docs[1], docs[2], docs[4], docs[6]], key=str)
    assert near_dup.near_duplicates(df.limit(0)).count() == 0 and near_dup.one_of_each(df.limit(0)).count() == 0


def test_one_of_each_by_group(spark):
    """Null and shared doc_ids name no group: unrelated texts stay, near copies among them go."""
    a, b, c, d = (" ".join(f"{k}{n}" for n in range(40)) for k in "abcd")
    docs = [(None, a), (None, b), (None, a + " more"), (None, b), (7, c), (7, d), (7, c + " more"), (9, d), (None, d)]
    kept = rows(near_dup.one_of_each(spark.createDataFrame(docs, DOCS)))
    near = {a: a, a + " more": a, b: b, c: c, c + " more": c, d: d}
    assert sorted((i or 0, near[t]) for i, t in kept) == [(0, a), (0, b), (7, c), (7, d)]


@pytest.mark.parametrize("percent", [30, 50, 95])
def test_near_pairs_at_other_thresholds(spark, percent):
    """Planted pairs just at the threshold, and just below it, among texts of their own."""
    rnd = random.Random(percent)
    docs = []
    for k in range(60):
        size = 200
        shared = -(-2 * size * percent // (100 + percent)) - (k % 3 == 2) * 8  # of ``size`` shingles each
        head = [f"h{k}x{j}" for j in range(shared + 4)]
        for side in (0, 1):
            docs.append((2 * k + side, " ".join(head + [f"t{k}s{side}x{rnd.randrange(10**9)}" for _ in range(size - shared)])))
    want = {d: c for d, (_, c) in brute.groups(docs, 5, percent).items()}
    got = {r["_doc"]: r["component"] for r in near_dup.near_duplicates(spark.createDataFrame(docs, DOCS), percent=percent).collect()}
    assert got == want and sum(d != c for d, c in want.items()) == 40


def test_shared_values():
    assert near_dup.least_shared(80, 64) == 30 and near_dup.least_shared(30, 64) == 1
    with pytest.raises(ValueError):
        near_dup.least_shared(10, 64)


def test_components(spark):
    rnd = random.Random(2)
    edges = [(k, k + 1) for k in range(40)] + [(100 + rnd.randrange(60), 100 + rnd.randrange(60)) for _ in range(40)]
    label = {x: x for e in edges for x in e}
    for _ in label:
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    got = {r["id"]: r["component"] for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: v for k, v in label.items() if any(k in e and e[0] != e[1] for e in edges)}


# ------------------------------------------------------------------ lines


def test_line_runs(spark):
    """Random texts over few lines: runs overlap, nest and repeat themselves."""
    rnd = random.Random(3)
    kinds = ["a", "b b", "c c c", "", "d d d d d"]
    docs = [(k, "\n".join(rnd.choice(kinds) if rnd.random() < 0.85 else f"own {k} {n}" for n in range(rnd.randrange(1, 40)))) for k in range(25)]
    df = spark.createDataFrame(docs, DOCS)
    for min_words in (1, 4, 12):
        got = {r["doc_id"]: r["text"].split("\n") if r["text"] else [] for r in line_dedup.dedup_lines(df, min_words, drop_emptied=False).collect()}
        want = brute.lines_left(docs, min_words)
        assert got == {d: own if own != [""] else [] for d, own in want.items()}


def test_lines_odd_rows(spark):
    passage = "one two three four five six seven eight nine ten"
    docs = [(5, passage), (2, f"first\n{passage}\nlast"), (7, f"{passage}\nmore"), (1, None), (3, ""), (9, "own\n\nlines"), (9, "own\n\nlines"), (None, f"x\n{passage}")]
    df = spark.createDataFrame([(*d, "e") for d in docs], "doc_id long, text string, gone string")
    got = line_dedup.dedup_lines(df)
    assert got.columns == df.columns
    want = [(2, "first\nlast"), (7, "more"), (1, None), (3, ""), (9, "own\n\nlines"), (9, "own\n\nlines"), (None, f"x\n{passage}")]
    assert sorted(rows(got.select("doc_id", "text")), key=str) == sorted(want, key=str)
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0
    assert rows(line_dedup.dedup_lines(df.limit(1)).select("text")) == [(passage,)]


# ------------------------------------------------------------------ benchmark


def test_decontamination(spark, sf_dir):
    bench = rows(documents(spark, sf_dir, "benchmark").select("item_id", "text"))
    want = brute.contamination(texts(spark, sf_dir), bench)
    got = {r[0]: r[1:] for r in rows(decontaminate.op2_decontaminate(spark, sf_dir))}
    assert got == want and any(r[4] for r in want.values())


def test_decontamination_in_blocks(spark):
    bench = [(1, "A b c d e f g h i j k"), (2, "short item"), (3, None), (4, "..."), (None, "z y x w v u t s r q")]
    docs = [(1, "x, a B c. d e f g h i j k l"), (2, "a short item; A SHORT ITEM"), (3, None), (4, ""), (5, "z y x w v u t s r q p"), (6, "b c d e f g h i j"), (6, "short-item")]
    b = spark.createDataFrame(bench, "item_id long, text string")
    df = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, _found int")
    whole = sorted(rows(decontaminate.report(decontaminate.scan_benchmark(df, b))))
    assert whole == sorted(rows(decontaminate.report(decontaminate.scan_benchmark(df, b, block_bytes=25))))
    assert [r[:4] for r in whole] == [(1, 13, 11, 1), (2, 6, 4, 1), (3, 0, 0, 0), (4, 0, 0, 0), (5, 11, 10, 0), (6, 2, 2, 1), (6, 9, 0, 0)]
    assert [r for r in whole if r[0] != 5] == sorted((d, *brute.contamination([(d, t)], bench[:4])[d]) for d, t in docs if d != 5)
    kept = decontaminate.decontaminate(df, b)
    assert kept.columns == df.columns and sorted(rows(kept.select("doc_id", "text"))) == [(3, None), (4, ""), (6, "b c d e f g h i j")]
    cut = {r[0]: r[1] for r in rows(decontaminate.decontaminate(df, b, remove="spans").select("doc_id", "text")) if r[0] < 6}
    assert cut == {1: "x, l", 2: "a ; A", 3: None, 4: "", 5: "p"}
    assert decontaminate.decontaminate(df, b.limit(0)).count() == 7 and decontaminate.decontaminate(df.limit(0), b).count() == 0


# ------------------------------------------------------------------ tokens and pieces


def test_token_counts(spark, sf_dir):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    odd = [None, "", " ", "a  b\n\n c ", "it's we'll 12 3a", "x<|endoftext|> y <|endoftext|>", "é" * 50 + "   ñ 你好 世界", "word " * 20_000, "z" * 100_000, "a\tb \n c\r\n"]
    docs = texts(spark, sf_dir) + [(-k - 1, t) for k, t in enumerate(odd)] + [(None, "null id"), (1, "again")]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, n_tokens string")
    want = [(d, len((t or "").encode()), n := len(tokenizer.encode(t or "", add_special_tokens=False).ids), n > 1024) for d, t in docs]
    assert sorted(rows(token_counts.count_tokens(df)), key=str) == sorted(want, key=str)
    assert sorted(rows(token_counts.count_tokens(df, part_chars=100, batch_bytes=64, most_known=5)), key=str) == sorted(want, key=str)
    assert token_counts.count_tokens(df.limit(0)).count() == 0


@pytest.fixture(scope="module")
def pieces():
    import public_tokenizers

    return sentence_pieces.Pieces(public_tokenizers.path("piece_bpe_32k.model"))


def test_nbest_units(pieces):
    """All segmentations of short words, scored and sorted by the stated rule."""
    score = {p: pieces.scores[i] for p, i in pieces.ids.items()}
    units = ["▁the", "hello", "▁", "▁▁", "rere", "▁naïve", "\n", "a一b", "aaaaaa", "x☃☃y"]
    for unit in units:
        every = brute.segmentations(unit, score, pieces.unknown)
        every.sort(key=lambda s: (-s[0], tuple(-len(p) for p in reversed(s[1]))))
        for n in (1, 3, 1000):
            found = pieces.nbest(unit, n)
            assert [s for s, _ in found] == pytest.approx([s for s, _ in every[:n]])
            spell = lambda p: (pieces.ids[p],) if p in pieces.ids else tuple(pieces.bytes[b] for b in p.encode())
            assert [i for _, i in found] == [tuple(i for p in parts for i in spell(p)) for _, parts in every[:n]]
    easy = [u for u in units if all(c in pieces.ids for c in u)]
    best, gap, ids = sentence_pieces.solve(pieces, easy)
    for k, unit in enumerate(easy):
        two = pieces.nbest(unit, 2)
        assert best[k] == two[0][0] and tuple(ids[k]) == two[0][1]
        assert gap[k] == (two[0][0] - two[1][0] if len(two) > 1 else np.inf)


def test_pieces(spark, sf_dir, pieces):
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    odd = [(-1, None), (-2, ""), (-3, " "), (-4, "a  b\n\tc"), (-5, "☃ snow 你 好"), (-6, "▁under"), (None, "x"), (-7, "ab" * 3000)]
    docs = texts(spark, sf_dir)[:60] + odd
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, ids int")
    out = sentence_pieces.encode(df, n=3, all_ids=True).collect()
    given = {d: t for d, t in docs}
    for r in out:
        text = given[r["doc_id"]] or ""
        assert r["round_trip"] == ("▁" not in text)
        assert model.decode(r["ids"]) == text.replace("▁", " ") or not text
        assert r["nbest"][0] == r["ids"] and len({tuple(x) for x in r["nbest"]}) == len(r["scores"]) == len(r["nbest"]) <= 3
        assert r["scores"] == sorted(r["scores"], reverse=True)
        assert all(sentence_pieces.decode_ids(pieces.raw, x) == text.replace("▁", " ") for x in r["nbest"])
        assert r["nbest"] == [sentence_pieces.changed_ids(r["ids"], made) for made in r["changes"]]
        if text and all(c in pieces.ids for c in text.replace(" ", "▁")) and len(text) < 40:
            whole = pieces.nbest("▁" + text.replace(" ", "▁"), 3)  # one lattice over the whole text
            assert r["scores"] == pytest.approx([s for s, _ in whole])
    back = {r["doc_id"]: r["text"] for r in sentence_pieces.decode(spark.createDataFrame([(r["doc_id"], r["ids"]) for r in out], "doc_id long, ids array<int>")).collect()}
    assert back == {d: (t or "").replace("▁", " ") for d, t in docs}
    assert sentence_pieces.encode(df.limit(0)).count() == 0


def test_nbest_of_many(spark, pieces):
    """Ten and more of a text of many units, against one lattice over the whole text."""
    text = "the quick brown fox jumps over lazy dogs and so on"
    for n in (2, 10, 40):
        r = sentence_pieces.encode(spark.createDataFrame([(1, text)], DOCS), n=n, all_ids=True).first()
        whole = pieces.nbest("▁" + text.replace(" ", "▁"), n)
        assert r["scores"] == pytest.approx([s for s, _ in whole]) and len({tuple(x) for x in r["nbest"]}) == n
        assert [sum(pieces.scores[i] for i in x) for x in r["nbest"]] == pytest.approx(r["scores"])


def test_pieces_query(spark, sf_dir):
    """The query's changes and digest are those of the operator."""
    whole = {r["doc_id"]: r for r in sentence_pieces.encode(documents(spark, sf_dir), all_ids=True).collect()}
    for r in sentence_pieces.op10_sentence_pieces(spark, sf_dir).collect():
        own = whole[r["doc_id"]]
        made = [[(c["at"], c["length"], c["ids"]) for c in changes] for changes in json.loads(r["changes"])]
        assert [sentence_pieces.changed_ids(own["ids"], c) for c in made] == own["nbest"]
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, own["ids"])).encode()).hexdigest()


def test_long_units(spark, pieces):
    """Runs that no pair cuts: memory grows with their length, not with its square."""
    tracemalloc.start()
    pieces.nbest("▁" + "a" * 5000, 4)
    assert tracemalloc.get_traced_memory()[1] < 40e6
    tracemalloc.stop()
    rnd = random.Random(9)
    docs = [(1, "".join(rnd.choice("etaoinsrhld") for _ in range(100_000))), (2, " " * 100_000), (3, "a" * 100_000)]
    assert all(len(pieces.units(t)) == 1 for _, t in docs)
    out = sentence_pieces.encode(spark.createDataFrame(docs, DOCS), all_ids=True).collect()
    assert len(out) == 3
    for r in out:
        assert r["round_trip"] and r["nbest"][0] == r["ids"] and len({tuple(x) for x in r["nbest"]}) == len(r["scores"]) == 4


# ------------------------------------------------------------------ search


def test_search_ties_and_odd_vectors(spark):
    rnd = np.random.default_rng(4)
    vectors = [(k, [float(x) for x in rnd.normal(size=6)]) for k in range(300)]
    vectors += [(1000 + k, vectors[7][1]) for k in range(150)]  # many equal vectors
    vectors += [(2000, None), (2050, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2100, [float("nan")] * 6), (2150, [float("inf")] * 6), (2200, []), (2250, [1.0, 2.0]), (2251, [3.0, 4.0]), (None, [9.0] * 6), (2300, [3e38] * 6), (50, vectors[50][1])]
    df = spark.createDataFrame([(*v, 0) for v in vectors], "vec_id long, embedding array<float>, score int")
    # vectors of any length take part, scores that fit a long do
    vectors += [(3000, [1e7, 1.0, 0.5]), (3001, [1e7, 2.0, 0.0]), (3002, [3.0, 4.0, -1e7]), (3050, [3e15, -1.0, 0.0]), (3051, [0.25, 7e14, 1.0]), (3052, [-3e38, 0.0, 0.0])]
    df = df.union(spark.createDataFrame([(*v, 0) for v in vectors[-6:]], df.schema))
    got = sorted(rows(exact_search.top_k(df, F.col("vec_id") % 50 == 0, shard_rows=64, leaf=8, group=4)))
    whole = lambda v: [math.floor(256 * float(np.float32(x))) for x in v]
    good = {k: whole(v) for k, v in vectors if k is not None and v and None not in v and np.isfinite(v).all()}
    want = []
    for q in (k for k in good if k % 50 == 0):
        dots = ((sum(a * b for a, b in zip(good[q], v)), k) for k, v in good.items() if k != q and len(v) == len(good[q]))
        scored = sorted((-s, k) for s, k in dots if abs(s) < 1 << 63)[:5]
        want += [(q, r, k, -s) for r, (s, k) in enumerate(scored, 1)]
    assert got == sorted(want)
    assert exact_search.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_decontaminate_keeps_columns_named_like_its_own(spark):
    words = " ".join(f"w{k}" for k in range(12))
    docs = spark.createDataFrame([(1, words, "x", 5), (2, "clean", "y", 6)], "doc_id long, text string, _FOUND string, _found_ int")
    bench = spark.createDataFrame([(1, words)], "item_id long, text string")
    assert rows(decontaminate.decontaminate(docs, bench)) == [(2, "clean", "y", 6)]
    assert rows(decontaminate.decontaminate(docs, bench, remove="spans")) == [(1, "", "x", 5), (2, "clean", "y", 6)]


# ------------------------------------------------------------------ languages


def test_language(spark):
    sf = "/root/testdata/sf0.01"
    got = rows(language_id.op7_language_id(spark, sf).join(documents(spark, sf).select("doc_id", "lang"), "doc_id").select("doc_id", "held_out", "lang_pred", "lang", "score"))
    assert all(h == brute.held_out(d) and 0 <= s <= 1 for d, h, _, _, s in got)
    held = [p == w for _, h, p, w, _ in got if h]
    assert len(held) > 200 and sum(held) / len(held) > 0.97


def test_language_spans_and_odd_rows(spark):
    en, ru = "the house and the garden of the town ", "дом и сад у реки в городе "
    docs = [(k, en * 3, "en") for k in range(30)] + [(100 + k, ru * 3, "ru") for k in range(30)]
    docs += [(500, en * 2 + ru * 4, None), (501, None, "en"), (502, "123 ...", "ru"), (503, "", None), (None, ru, None), (504, "αβγ", None), (504, en, "en")]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, lang string, lang_pred string")
    got = {(r["doc_id"], r["lang_pred"]): r for r in language_id.identify(df).collect()}
    mixed = got[500, "ru"]
    assert [s["lang"] for s in mixed["spans"]] == ["en", "ru"] and 0.5 < mixed["score"] < 1
    assert {k for k in got if k[0] in (501, 502, 503)} == {(501, "und"), (502, "und"), (503, "und")}
    assert (None, "ru") in got and not got[None, "ru"]["held_out"] and (504, "en") in got
    assert all(r["score"] == 1 for k, r in got.items() if k[0] is not None and k[0] < 200)
    nothing = language_id.identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"} and language_id.identify(df.limit(0)).count() == 0


def test_no_language_is_lost(spark):
    """Equal texts are rows like others to the sample."""
    docs = [(k, "the house and the garden of the town", "en") for k in range(3000)] + [(5000 + k, "das haus und der garten der stadt", "de") for k in range(40)]
    docs += [(9000, "la maison et le jardin de la ville", "fr")] * 300
    got = language_id.identify(spark.createDataFrame(docs, "doc_id long, text string, lang string"), bound=20)
    assert {tuple(r) for r in got.select("lang_pred", F.col("doc_id") >= 9000, F.col("doc_id") >= 5000).distinct().collect()} == {("en", False, False), ("de", False, True), ("fr", True, True)}


def test_language_scores_and_path():
    """Scores are sums of the logarithms of a word's marked grams; the path is the best of all."""
    rng = np.random.default_rng(3)
    logs = rng.normal(size=(language_id.BUCKETS, 3)).astype(np.float32)
    written = np.zeros((len(language_id.NAMES), 3), bool)
    written[language_id.NAMES.index("Latin"), :2] = written[language_id.NAMES.index("Cyrillic"), 2] = True
    model = language_id.Model(["a", "b", "c"], logs, written)
    words = ["x", "été", "дом", "αβγ", "house"]
    got = model.scores(words)
    for word, row in zip(words, got):
        marked, total = f"\x02{word}\x03", np.zeros(3)
        for n in (1, 2, 3):
            for k in range(len(marked) - n + 1):
                h = 0
                for c in marked[k : k + n]:
                    h = (h * 0x100000001B3 ^ ord(c)) % 2**64
                total += logs[((h + n) * 0x9E3779B97F4A7C15 % 2**64) >> 49]
        if word == "αβγ":
            want = np.zeros(3)
        else:
            own = [2] if word == "дом" else [0, 1]
            want = np.where(np.isin(range(3), own), total, -1e4)
            want = want - want.max()
        assert np.abs(row - want).max() < 1e-2
    for _ in range(20):
        n = int(rng.integers(1, 7))
        scores = rng.normal(size=(1, n, 3)).astype(np.float32) * 3
        cost = lambda p: sum(scores[0, t, s] for t, s in enumerate(p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:]))  # noqa: B023, E731
        best = max(itertools.product(range(3), repeat=n), key=cost)
        assert abs(cost(language_id.viterbi(scores, np.array([n]), 2.0)[0]) - cost(best)) < 1e-4


# ------------------------------------------------------------------ quality


def test_quality(spark):
    rnd = random.Random(6)
    vocabulary = [f"w{k}" for k in range(300)]
    docs, labels = [], []
    for k in range(1200):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randrange(20, 400))]
        bad = k % 5 == 0
        if bad:
            for word in ("nasty", "awful"):
                words.insert(rnd.randrange(len(words)), word)
        docs.append((k, " ".join(words)))
        if k % 2 == 0:
            labels.append((k, 1, int(bad)))
    docs += [(-1, None), (-2, ""), (None, "w1 w2"), (1, docs[1][1])]
    labels += [(None, 1, 0), (99_999, 1, 0), (3, 1, None)]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, key string")
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    kept = quality.sample(df, lab)
    assert kept.columns == df.columns
    ids = [r[0] for r in kept.select("doc_id").collect()]
    assert not [d for d in ids if d and d > 0 and d % 5 == 0 and d < 1200]
    assert len(ids) >= 0.99 * (len(docs) - 240) and {-1, -2, None} <= set(ids)
    scored, _, last = quality.resample(df, lab, size=100)
    assert scored.where(F.col("key") >= last).count() == 100
    assert sorted(r[0] for r in scored.select("key").collect())[-100] == last
    assert quality.sample(df, lab.limit(0)).count() == len(docs) and quality.sample(df.limit(0), lab).count() == 0


@pytest.mark.parametrize("temperature, size", [(0.02, None), (1.0, 150), (5.0, 40)])
def test_quality_against_plain_version(spark, temperature, size):
    """Weights, floor, keys and the sampled rows; documents without repetition, so all slots are n-grams."""
    rnd = random.Random(12)
    docs = [(k, " ".join(rnd.sample([f"w{j}" for j in range(60)], rnd.randrange(2, 40)) + ["vile"] * (k % 7 == 0))) for k in range(400)]
    docs += [(400, ""), (401, docs[5][1])]
    verdict = {k: int(k % 7 > 0) for k in range(0, 300, 2)}
    lab = spark.createDataFrame([(k, good, 0) for k, good in verdict.items()], "doc_id long, quality int, toxic int")
    known = near_dup.WordHashes()
    slots = lambda t: quality.slots_of(quality.ids_of(t, known)).tolist()
    assert all(not quality.repeats_of(quality.ids_of(t, known), known) for _, t in docs)
    weights, floor, keys = brute.quality(docs, verdict, slots, 10_000.0, temperature, 3)
    scored, model, last = quality.resample(spark.createDataFrame(docs, DOCS), lab, size=size, temperature=temperature, seed=3)
    found = {r["_doc"]: r for r in scored.collect()}
    assert [found[d]["_weight"] for d, _ in docs] == pytest.approx(weights, abs=1e-9)
    assert math.isfinite(floor) and model.unit == pytest.approx(abs(floor))
    # A key is a weight over a small unit, so the last digits of sums show in it.
    assert all(abs(found[d]["key"] - k) <= 2 + 1e-9 * abs(k) for (d, _), k in zip(docs, keys))
    top = sorted(zip(keys, docs), reverse=True)[: size or sum(w >= floor for w in weights)]
    assert {d for d, r in found.items() if r["key"] >= last} == {d for _, (d, _) in top}
    if temperature > 1:
        assert {d for _, (d, _) in top} != {d for _, (d, _) in sorted(zip(weights, docs), reverse=True)[:size]}


def test_quality_old(spark):
    """Bad documents hold one or both of two words, three times in all."""
    rnd = random.Random(6)
    vocabulary = [f"w{k}" for k in range(300)]
    docs, labels = [], []
    for k in range(1200):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randrange(20, 400))]
        if k % 5 == 0:
            for _ in range(3):
                words.insert(rnd.randrange(len(words)), rnd.choice(["nasty", "awful"]))
        docs.append((k, " ".join(words)))
        if k % 2 == 0:
            labels.append((k, 1, int(k % 5 == 0)))
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    ids = [r[0] for r in quality.sample(spark.createDataFrame(docs, DOCS), lab).select("doc_id").collect()]
    assert not [d for d in ids if d % 5 == 0] and len(ids) >= 0.99 * 960


@pytest.mark.parametrize("n", [1000, 8000])
def test_quality_one_word_and_repeats(spark, n):
    """Bad documents hold one of four words once, or repeat words that differ from one document to the next."""
    rnd = random.Random(8)
    vocabulary = [f"w{k}" for k in range(2000)]
    docs, labels, kinds = [], [], {}
    for k in range(n):
        words = [rnd.choice(vocabulary) for _ in range(rnd.randrange(20, 400))]
        kinds[k] = {0: "toxic", 1: "repeats"}.get(rnd.randrange(10))
        if kinds[k] == "toxic":
            words.insert(rnd.randrange(len(words)), rnd.choice(["nasty", "awful", "horrid", "vile"]))
        elif kinds[k]:
            words = [w for _ in range(rnd.randrange(1, 6)) for w in [f"x{rnd.randrange(10**6)}"] * rnd.randrange(15, 40)]
        docs.append((k, " ".join(words)))
        if rnd.random() < 0.4:
            labels.append((k, int(kinds[k] != "repeats"), int(kinds[k] == "toxic")))
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    kept = [kinds[r[0]] for r in quality.sample(spark.createDataFrame(docs, DOCS), lab).select("doc_id").collect()]
    every = [*kinds.values()]
    assert kept.count("toxic") <= 0.05 * every.count("toxic") and kept.count("repeats") <= 0.05 * every.count("repeats")
    assert kept.count(None) >= 0.97 * every.count(None)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_quality_planted(spark, sf):
    """Of the given documents most of those with a planted insult go, and few of those labelled good."""
    docs = documents(spark, f"/root/testdata/{sf}")
    lab = documents(spark, f"/root/testdata/{sf}", "labels")
    bad = F.rlike("text", F.lit(r"(?i)\b(idiot|moron|worthless|stupid|scum|trash|loser|pathetic|disgusting|clown)\b"))
    kept = quality.sample(docs, lab)
    assert kept.where(bad).count() <= 0.05 * docs.where(bad).count()
    good = lab.where("quality = 1 and toxic = 0").select("doc_id")
    assert kept.join(good, "doc_id", "left_semi").count() >= 0.97 * docs.join(good, "doc_id", "left_semi").count()


# ------------------------------------------------------------------ archives


def test_warc(spark, tmp_path):
    page = (
        '<html lang="en"><head><title>A &amp; B</title><style>p{}</style></head><body><!-- c --><p>One&nbsp;two &lt;b&gt; &#233;&#x4e2d; &bogus; &#0;</p>'
        '<script>x("</p>")</script><a href="/x y">link</a><br>end</body></html>'
    )
    pages = [(1, "http://a/", page), (2, None, "plain"), (3, "http://c/", None), (None, "http://d/", ""), (1, "http://a/", page)]
    df = spark.createDataFrame([(*p, "z") for p in pages], "page_id long, url string, html string, record string")
    out = warc.derive(warc.responses(df))
    got = out.collect()
    assert len(got) == 10 and out.where("page_id = 1").distinct().count() == 2
    by = {(r["page_id"], r["warc_type"]): r for r in got}
    assert by[1, "conversion"]["block"] == "A & B\nOne two <b> é中 &bogus; &#0;\nlink\nend"
    about = by[1, "metadata"]["block"].split("\r\n")
    assert {"title: A & B", "language: en", "outlink: /x y", "source-header: HTTP/1.1 200 OK"} <= {*about}
    assert by[3, "conversion"]["block"] == "" and by[3, "conversion"]["content_length"] == 0
    source = {r["record_id"]: r for r in warc.responses(df).collect()}
    for r in got:
        assert r["refers_to"] in source and by[r["page_id"], "metadata" if r["warc_type"] == "conversion" else "conversion"]["record_id"] == r["concurrent_to"]
        assert f"WARC-Refers-To: <{r['refers_to']}>\r\n" in r["record"] and r["content_length"] == len(r["block"].encode())
    warc.write(out, str(tmp_path / "w"))
    back = warc.read(spark, str(tmp_path / "w")).select("warc_type", "record_id", "refers_to", "target_uri", "block", "content_length")
    assert sorted(rows(back), key=str) == sorted(((r["warc_type"], r["record_id"], r["refers_to"], r["target_uri"], r["block"], r["content_length"]) for r in got), key=str)
    assert warc.derive(warc.responses(df.limit(0))).count() == 0


def test_pages_of_other_quoting_and_length(spark):
    links = "<html lang=de><a href='/a b'>x</a><a class=k href=/c>y</a><A HREF=\"/d&amp;e\">z</A>"
    pages = [(1, "u", links), (2, "u", "&lt;" * 300_000 + "<p>" * 300_000 + "&oslash;&cent;&x;&" + "w" * 2_000_000)]
    got = {(r["page_id"], r["warc_type"]): r["block"] for r in warc.derive(warc.responses(spark.createDataFrame(pages, "page_id long, url string, html string"))).collect()}
    assert {"language: de", "outlink: /a b", "outlink: /c", "outlink: /d&amp;e"} <= {*got[1, "metadata"].split("\r\n")}
    assert got[1, "conversion"] == "xyz"
    assert got[2, "conversion"] == "<" * 300_000 + "\nø¢&x;&" + "w" * 2_000_000


def test_references(spark):
    names = " ".join(f"&{n};" for n in warc.NAMED) + " &amp;lt; &#8364; &#x1F600; &;"
    got = spark.createDataFrame([(names,)], "t string").select(warc.decoded(F.col("t"))).first()[0]
    assert got == html.unescape(names)


# ------------------------------------------------------------------ quotes


def test_quotes(spark, tmp_path):
    said = [
        (1, 0, "user", "How do I sort?\nI have many rows."),
        (1, 1, "assistant", "Use sort.\n\nIt is stable."),
        (1, 2, "user", "> Use  SORT.\nBut which?"),
        (1, 3, "user", "> I have many rows.\nHow many?"),
        (1, 4, "assistant", "> > How do I sort?\n> Use sort.\n>\nThis again."),
        (1, 5, "user", "> nobody said this\nok"),
        (1, 6, "user", ">> How do I sort?\n> How many?\n\n\n\nTwo\n\n\n\nparts"),
        (2, 10, "user", "> I have many rows.\nelsewhere"),
        (2, 3000, "user", "late\n> elsewhere"),
        (3, 0, None, None),
        (3, 1, "user", ""),
        (3, 1, "user", ""),
        (None, 1, "user", "> x"),
        (4, None, "user", "y"),
        (None, 1, "user", "> x"),
        (None, None, None, "z"),
        (5, 1, "b", "same turn"),
        (5, 1, "a", "same turn"),
        (5, 70, "a", "next part"),
    ]
    path = str(tmp_path / "conversations.parquet")
    df = spark.createDataFrame([(*r, "p") for r in said], "conv_id long, turn long, role string, text string, path string")
    df.coalesce(1).write.parquet(path)
    got = quotes.link_quotes(df)
    at = {(r["conv_id"], r["turn"]): r for r in got.collect()}
    assert len(got.collect()) == len(said)
    assert [at[1, t]["parent"] for t in range(7)] == [None, 0, 1, 0, 1, 4, 3]
    assert at[1, 3]["path"] == [0, 3] and at[1, 4]["path"] == [-1, 4] and at[1, 6]["path"] == [0, 3, -3, 6] and at[1, 2]["path"] == []
    assert at[1, 4]["content"] == "This again." and at[1, 6]["content"] == "Two\n\nparts" and at[3, 0]["content"] == ""
    assert (at[1, 4]["n_passages"], at[1, 4]["n_linked"], at[1, 4]["depth"]) == (2, 2, 2) and at[1, 5]["n_linked"] == 0
    assert at[2, 10]["n_linked"] == 0 and at[2, 3000]["parent"] == 10
    order = [r["turn"] for r in got.where("conv_id = 1").orderBy("path", "turn").collect()]
    for k, t in enumerate(order):
        assert at[1, t]["parent"] is None or at[1, t]["parent"] in order[:k]
    parts = quotes.conversations(got, 2).where("conv_id = 1").orderBy("path", "part").collect()
    assert "".join(p["text"] for p in parts) == "".join(f"<|{at[1, t]['role']}|>\n{at[1, t]['content']}\n" for t in order)
    every = [(r["conv_id"], r["part"], r["n_messages"], r["text"]) for r in quotes.conversations(got).collect()]
    assert sorted(x[1:] for x in every if x[0] == 3) == [(0, 3, "<||>\n\n<|user|>\n\n")]
    assert sorted(x[1:] for x in every if x[0] == 5) == [(0, 2, "<|a|>\nsame turn\n<|b|>\nsame turn\n"), (1, 1, "<|a|>\nnext part\n")]
    alone = sorted(x[2:] for x in every if x[1] is None)
    assert alone == [(1, "<|user|>\n\n"), (1, "<|user|>\n\n"), (1, "<|user|>\ny\n"), (1, "<||>\nz\n")]
    assert sum(x[2] for x in every) == len(said) and quotes.conversations(got.limit(0)).count() == 0
    assert quotes.link_quotes(df.limit(0)).count() == 0
    query = by_name(quotes.op9_quotes(spark, str(tmp_path)))
    assert query == in_sql(quotes.SQL, conversations=glob.glob(f"{path}/*.parquet")[0])
