"""Every stage of the pipeline against a plain version, on what the stage before it wrote."""

import corpus_pipeline
import duckdb
from caelum.llm import line_dedup, quality, sentence_pieces
from caelum.session import cut
from tests.llm import brute

SF = "/root/testdata/sf0.01"


def pairs(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = [pairs(docs)]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = cut(stage(spark, docs, SF), "test-stage")
        assert docs.columns == columns, name
        seen.append(pairs(docs))
        assert docs.count() == len(seen[-1])
    raw, good, lines, once, clean = seen
    scored, _, last = quality.resample(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    assert good == {r["_doc"]: raw[r["_doc"]] for r in scored.collect() if r["key"] >= last}
    left = brute.lines_left([*good.items()], 1) if len(good) < 50 else by_sql(good)
    assert lines == {d: t for d, t in left.items() if t.strip()}
    groups = brute.groups([*lines.items()], 5)
    assert once == {d: t for d, t in lines.items() if groups[d][1] == d}
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hits = brute.contamination([*once.items()], bench)
    assert clean == {d: t for d, t in once.items() if not hits[d][4]}
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    import public_tokenizers

    raw_pieces = sentence_pieces.Pieces(public_tokenizers.path("piece_bpe_32k.model")).raw
    assert {r["doc_id"]: sentence_pieces.decode_ids(raw_pieces, r["ids"]) for r in out} == clean


def by_sql(docs):
    """What the SQL of line dedup leaves of each text."""
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.executemany("insert into documents values (?, ?)", [*docs.items()])
    head, _, _ = line_dedup.SQL.rpartition("select d.doc_id, len(d.lines)")
    return dict(con.execute(head + "select d.doc_id, coalesce(w.text, '') from doc d left join kept w using (doc_id)").fetchall())


def test_run(spark):
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "ids", "n_tokens", "scores", "round_trip", "changes"] and 0 < out.count() <= 200
    assert out.where("not round_trip").count() == 0
