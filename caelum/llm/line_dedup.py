"""Line dedup: a suffix array over line ids by prefix doubling, and the repeated runs that its intervals show.

Documents in the order of (doc_id, text hash) make one long sequence of lines with an end mark after each document. Level k of
the suffix array holds every position whose next 2**k lines occur elsewhere too, with its rank in lexicographic
order of line ids: positions of equal rank form the interval of suffixes whose longest common prefix is 2**k
or more, and ``first`` is the earliest of them. Level k + 1 comes from pairs of ranks 2**k apart. Positions leave as soon
as nothing repeats there, so levels shrink and end at the longest repeated run.

Going down the levels again, each later copy finds the deepest interval with an earlier member: its maximal repeated run. Runs
that hold a word (or ``min_words``) are deleted. Groups of a rank are only ever aggregated and joined, never gathered, and sums over
ranks run in slots. A line that a third of all documents hold is a hot key of joins, whose tasks adaptive execution may split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caelum.llm.common import cut, row_key, table

SLOTS = 512


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def n_words(line: Column) -> Column:
    line = F.regexp_replace(line, "^\\s+|\\s+$", "")
    return F.when(line == "", 0).otherwise(F.size(F.split(line, "\\s+")))


def positions(docs: DataFrame, text: str) -> DataFrame:
    """``pos, at, h1, h2, words, _doc, _th``: every line, ``pos`` rising with document and line, one number free between documents."""
    seen = F.transform(
        lines_of(F.col(text)), lambda x: F.struct(F.xxhash64(x).alias("h1"), F.xxhash64(x, F.lit(1)).alias("h2"), n_words(x).alias("words"))
    )
    end = F.array(F.struct(F.lit(0).cast("long").alias("h1"), F.lit(0).cast("long").alias("h2"), F.lit(-1).alias("words")))
    rows = docs.where(F.col(text).isNotNull()).select(*row_key(text=text), F.concat(seen, end).alias("lines"))
    ordered = rows.dropDuplicates(["_doc", "_th"]).repartitionByRange("_doc", "_th").sortWithinPartitions("_doc", "_th")
    lines = ordered.select("_doc", "_th", F.posexplode("lines").alias("at", "line"))
    return lines.select(F.monotonically_increasing_id().alias("pos"), "at", "line.*", "_doc", "_th").where("words >= 0")


def _ranked(classes: DataFrame, group: str | None, slot: Column, order: list[str]) -> DataFrame:
    """``rank``: how many members (``n``) all classes before have, within ``group``; summed by slots, then within them."""
    keys = [group] if group else []
    classes = classes.withColumn("slot", slot)
    totals = classes.groupBy(*keys, "slot").agg(F.sum("n").alias("total"))
    before = Window.partitionBy(*keys).orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*keys, "slot", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy(*keys, "slot").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum("n").over(within), F.lit(0))
    return classes.withColumn("own", own).join(totals, [*keys, "slot"]).withColumn("rank", F.col("base") + F.col("own")).drop("own", "base", "slot")


def levels_of(lines: DataFrame) -> list[DataFrame]:
    """The suffix array's levels: ``pos, start, rank, first, words`` of all positions whose next 2**k lines repeat."""
    ids = lines.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("pos").alias("first")).where("n > 1")
    ids = _ranked(ids, None, F.shiftright("h1", 52), ["h1", "h2"]).select("h1", "h2", "rank", "first")
    level = lines.join(ids, ["h1", "h2"]).select("pos", (F.col("pos") - F.col("at")).alias("start"), "rank", "first", F.col("words").cast("long"))
    level = cut(level, "lines-level")
    levels, span = [], 1
    while size := level.count():
        levels.append(level)
        ahead = Window.partitionBy("start").orderBy("pos").rangeBetween(span, span)  # the lines of one document
        pairs = level.withColumn("next", F.max("rank").over(ahead)).withColumn("more", F.max("words").over(ahead)).where("next is not null")
        pairs = pairs.select("pos", "start", "rank", "next", (F.col("words") + F.col("more")).alias("words"))
        classes = pairs.groupBy("rank", "next").agg(F.count("*").alias("n"), F.min("pos").alias("first")).where("n > 1")
        slot = F.floor(F.col("next") / F.lit(-(-size // SLOTS)))
        order = _ranked(classes.withColumnRenamed("rank", "r"), "r", slot, ["next"])
        order = order.select(F.col("r").alias("rank"), "next", "first", (F.col("r") + F.col("rank")).alias("higher"))
        level = pairs.join(order, ["rank", "next"]).select("pos", "start", F.col("higher").alias("rank"), "first", "words")
        level, span = cut(level, "lines-level"), 2 * span
    return levels


def repeated_runs(levels: list[DataFrame]) -> DataFrame | None:
    """``pos, start, length, words``: at each later copy the longest run that also begins at an earlier position."""
    if not levels:
        return None
    later = [
        level.where("pos > first").select("pos", "start", F.lit(k).alias("k"), "first", "words") for k, level in enumerate(levels)
    ]
    every = later[0]
    for one in later[1:]:
        every = every.union(one)
    deepest = every.groupBy("pos", "start").agg(F.max("k").alias("k"), F.max_by("first", "k").alias("leader"), F.max_by("words", "k").alias("words"))
    deepest = cut(deepest.withColumn("length", F.expr("shiftleft(1L, k)")), "lines-runs")
    columns = ["pos", "start", "leader", "length", "words"]
    state = deepest.where(F.col("k") == len(levels) - 1).select(*columns)
    for k in range(len(levels) - 2, -1, -1):
        # Who shares ``length`` lines with the leader asks whether 2**k more are shared with the leader or with another that asks.
        asked = state.select(*columns, F.lit(True).alias("asks")).union(
            state.select(F.col("leader").alias("pos"), F.lit(0).cast("long"), "leader", "length", F.lit(0).cast("long"), F.lit(False)).distinct()
        )
        ahead = levels[k].select(F.col("pos").alias("then"), F.col("rank"), F.col("words").alias("more"))
        asked = cut(asked.withColumn("then", F.col("pos") + F.col("length")).join(ahead, "then", "left").drop("then"), "lines-ask")
        least = asked.where("rank is not null").groupBy("leader", "length", "rank").agg(F.min("pos").alias("least"))
        answer = asked.where("asks").join(least, ["leader", "length", "rank"], "left")
        longer = F.col("least") < F.col("pos")
        state = answer.select(
            "pos",
            "start",
            F.when(longer, F.col("least")).otherwise(F.col("leader")).alias("leader"),
            F.when(longer, F.col("length") + 2**k).otherwise(F.col("length")).alias("length"),
            F.when(longer, F.col("words") + F.col("more")).otherwise(F.col("words")).alias("words"),
        )
        state = cut(state.union(deepest.where(F.col("k") == k).select(*columns)), "lines-runs")
    return state.select("pos", "start", "length", "words")


def removed_lines(docs: DataFrame, min_words: int, text: str) -> DataFrame | None:
    """``_doc, _th, gone``: the line ranges [a, b) of each document that lie in later copies, in order; None if no line repeats."""
    lines = cut(positions(docs, text), "lines")
    runs = repeated_runs(levels_of(lines))
    if runs is None:
        return None
    order = Window.partitionBy("start").orderBy("pos")  # the runs of one document
    runs = runs.where(F.col("words") >= min_words).select("start", F.col("pos"), (F.col("pos") + F.col("length")).alias("end"))
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("part", F.when(F.col("pos") < reach, 0).otherwise(1)).withColumn("part", F.sum("part").over(order))
    ranges = runs.groupBy("start", "part").agg(F.min("pos").alias("a"), F.max("end").alias("b"))
    ranges = ranges.groupBy("start").agg(
        F.array_sort(F.collect_list(F.struct((F.col("a") - F.col("start")).cast("int").alias("a"), (F.col("b") - F.col("start")).cast("int").alias("b")))).alias("gone")
    )
    heads = lines.where("at = 0").select(F.col("pos").alias("start"), "_doc", "_th")
    return cut(heads.join(ranges, "start").select(F.col("_doc").alias("_d"), F.col("_th").alias("_t"), "gone"), "lines-gone")


def dedup_lines(docs: DataFrame, min_words: int = 1, text: str = "text", drop_emptied: bool = True) -> DataFrame:
    """``docs`` without later copies of repeated line runs of ``min_words`` words or more; its columns stay.

    By default every repeated run that holds a word goes, of one short line too; blank lines go only inside such a run.
    A run is a sequence of whole lines within a document. The first occurrence, by doc_id and line, stays (of documents that share a
    doc_id the one of smaller text hash is first, null doc_ids come first); every line in a later one goes, copies that overlap
    their original included. Runs of any number of lines count, and only lines that are equal byte by byte. With
    ``drop_emptied`` documents of which no word is left go too. Null and empty texts stay. Rows equal in doc_id and text are one
    document and all get its result. An empty table gives no rows.
    """
    gone = removed_lines(docs, min_words, text)
    if gone is None:
        return docs
    # Only a struct of the row goes through the join, so no column name can clash.
    keyed = docs.select(*row_key(text=text), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    both = keyed.join(gone, keyed["_doc"].eqNullSafe(gone["_d"]) & (keyed["_th"] == gone["_t"]), "left")
    lines = lines_of(F.col(f"_row.`{text}`"))
    # What stays lies between the ranges: from each one's end (or 0) to the next one's start (or the end).
    begins = F.concat(F.array(F.lit(0)), F.transform("gone", lambda g: g["b"]))
    ends = F.concat(F.transform("gone", lambda g: g["a"]), F.array(F.size("_lines")))
    both = both.withColumn("_lines", F.when(F.col("gone").isNotNull(), lines))
    kept = F.flatten(F.zip_with(begins, ends, lambda a, b: F.slice("_lines", a + 1, b - a)))
    both = both.withColumn("_text", F.when(F.col("gone").isNull(), F.col(f"_row.`{text}`")).otherwise(F.array_join(kept, "\n")))
    if drop_emptied:
        both = both.where(F.col("gone").isNull() | F.rlike("_text", F.lit("\\S")))
    columns = [F.col("_text").alias(c) if c == text else F.col(f"_row.`{c}`").alias(c) for c in docs.columns]
    return both.select(*columns)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines left of each document (all documents stay here, emptied ones with an empty text) and the digest of its text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.size(lines_of(F.col("text"))).cast("long").alias("n_lines"))
    left = F.when(F.col("text") == "", 0).otherwise(F.size(lines_of(F.col("text")))).cast("long")
    out = dedup_lines(docs, drop_emptied=False)
    return out.select("doc_id", "n_lines", left.alias("n_left"), F.sha2("text", 256).alias("text_sha256"))


SQL = r"""
with doc as (
  select doc_id, text, string_split(text, chr(10)) as lines from documents where text is not null),
line as (
  select doc_id, unnest(lines) as line, generate_subscripts(lines, 1) as k from doc),
counted as (
  select *, sum(words) over (partition by doc_id order by k) as total
  from (select *, case when regexp_matches(line, '\S') then len(string_split_regex(regexp_replace(line, '^\s+|\s+$', '', 'g'), '\s+')) else 0 end as words from line)),
span as (  -- the shortest windows that hold a word, from each first line and to each last line
  select a.doc_id, a.k as a, min(b.k) as b from counted a join counted b on a.doc_id = b.doc_id and b.k >= a.k and b.total - a.total + a.words >= 1 group by all
  union
  select b.doc_id, max(a.k), b.k from counted a join counted b on a.doc_id = b.doc_id and b.k >= a.k and b.total - a.total + a.words >= 1 group by b.doc_id, b.k),
known as (
  select s.*, first_value((s.doc_id, s.a)) over (partition by array_to_string(d.lines[s.a:s.b], chr(10)) order by s.doc_id, s.a) as origin
  from span s join doc d using (doc_id)),
gone as (
  select distinct doc_id, unnest(generate_series(a, b)) as k from known where (doc_id, a) <> origin),
kept as (
  select l.doc_id, string_agg(l.line, chr(10) order by l.k) as text, count(*) as n
  from line l anti join gone g on l.doc_id = g.doc_id and l.k = g.k group by 1)
select d.doc_id, len(d.lines) as n_lines, case when coalesce(w.text, '') = '' then 0 else w.n end as n_left,
  sha256(coalesce(w.text, '')) as text_sha256
from doc d left join kept w using (doc_id)
"""
