"""Token counts: batches of texts go to the tokenizer library inside Arrow functions; only lengths return."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caelum.llm.common import rows_of, table

#: Between two letters or digits, a single space or line break always begins a new pre-token, so
#: the tokens of the parts are the tokens of the whole.
SAFE = re.compile(r"(?<=[^\W_])[ \n](?=[^\W_])")

#: Spaces that do not stand alone between two other characters. Without any, each space begins a pre-token,
#: and the text may be cut at all of them.
UNSAFE = re.compile(r"(?:^|\s) | (?:\s|$)")


def parts_of(text: str, most: int) -> Iterator[str]:
    """``text`` in parts of about ``most`` characters, cut only at safe places; longer where there is none."""
    start = 0
    while len(text) - start > most:
        at = SAFE.search(text, start + most)
        if not at:
            break
        yield text[start : at.start()]
        start = at.start()
    yield text[start:]


def count_tokens(
    docs: DataFrame,
    model: str | None = None,
    text: str = "text",
    limit: int = 1024,
    part_chars: int = 1 << 15,
    batch_bytes: int = 1 << 18,
    most_known: int = 600_000,
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row, whole texts, in input order.

    ``model`` is a tokenizer file that every executor can read. A batch handed to the library
    holds about ``batch_bytes`` of text, whatever the number of rows. Texts are split at safe boundaries, at every
    lone space or else into parts of ``part_chars``, and the counts added; a part seen before in the task (up to
    ``most_known`` are remembered) is not encoded again. Null and empty texts have 0 bytes and tokens; a null doc_id stays null;
    repeated rows are counted each; other columns are left out; an empty table gives no rows.
    """
    path = model or public_tokenizers.path("byte_bpe_50k.json")

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        known: dict[str, int] = {}  # tokens of a space and this word

        def lengths(parts: list[str]) -> Iterator[int]:
            start = held = 0
            for k, part in enumerate(parts):
                held += len(part)
                if held >= batch_bytes or k == len(parts) - 1:
                    yield from map(len, tokenizer.encode_batch_fast(parts[start : k + 1], add_special_tokens=False))
                    start, held = k + 1, 0

        for batch in rows_of(batches):
            whole, owners, words = [], [], []
            for row, value in enumerate(batch.column(1)):
                text = value.as_py() or ""
                own = [] if UNSAFE.search(text) else text.split(" ")
                first, own = (own[0], own[1:]) if own else (text, [])
                words.append(own)
                for part in parts_of(first, part_chars):
                    whole.append(part)
                    owners.append(row)
            if len(known) > most_known:
                known.clear()
            new = [*set().union(*words).difference(known)]
            known.update(zip(new, lengths([f" {w}" for w in new])))
            totals = [sum(map(known.__getitem__, own)) for own in words]
            for row, n in zip(owners, lengths(whole)):
                totals[row] += n
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(totals, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    size = F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long").alias("n_bytes")
    return (
        docs.select(F.col("doc_id").cast("long"), F.col(text).cast("string").alias("text"), size)
        .mapInArrow(counts, "doc_id long, n_bytes long, n_tokens long")
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
