"""Chat formatting: quoted passages are linked to the messages they come from, and conversations follow the replies.

Everything is joins, groupings and windows; no window spans a whole conversation, since one may hold much of the table:
the turn before a message and the run it belongs to are looked up in blocks of turns, then over the blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caelum.llm.common import cut, table

MARKS = "^(?:[ \\t]*>)+"
QUOTING = "(?m)^[ \\t]*>"
BLOCK = 1024


def level_of(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), "[^>]", ""))


def bare(line: Column) -> Column:
    return F.regexp_replace(line, MARKS + " ?", "")


def normal(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, "\\s+", " ")))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\\r?\\n", -1)


def own_text(text: Column) -> Column:
    """The text without its quoted lines, blank lines at its ends and more than one blank line within."""
    own = F.filter(lines_of(text), lambda x: ~F.rlike(x, F.lit(MARKS)))
    return F.trim(F.regexp_replace(F.array_join(own, "\n"), "\\n\\s*\\n\\s*\\n", "\n\n"), F.lit(" \n\t"))


def hashes(value: Column) -> list[Column]:
    return [F.xxhash64(value).alias("h1"), F.xxhash64(value, F.lit(1)).alias("h2")]


def quote_links(messages: DataFrame) -> DataFrame:
    """``conv_id, turn, passage, level, n_lines, original, n_found`` of every quoted passage.

    A passage is a run of lines of one quote level; ``passage`` is its number within its message. Its normalised lines
    (lower case, white space as one space) are looked up among the unquoted lines of earlier turns of its conversation, each line at its first
    occurrence; ``original`` is the turn that has most of them, the earliest of several, or null.
    """
    row = ["conv_id", "turn", "_th"]
    texts = messages.where("conv_id is not null and turn is not null").select("conv_id", "turn", F.xxhash64("role", "text").alias("_th"), "text")
    quoting = texts.where(F.rlike("text", F.lit(QUOTING))).dropDuplicates(row)
    lines = quoting.select(*row, F.posexplode(lines_of(F.col("text"))).alias("at", "line")).withColumn("level", level_of(F.col("line")))
    order = Window.partitionBy(*row).orderBy("at")  # the lines of one text
    new = (F.col("level") != F.lag("level", 1, 0).over(order)) & (F.col("level") > 0)
    lines = lines.withColumn("passage", F.sum(new.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    quoted = lines.where("level > 0").withColumn("line", normal(bare(F.col("line"))))
    quoted = cut(quoted.where("line <> ''").select(*row, "passage", "level", *hashes(F.col("line"))), "quotes")
    wanted = quoted.select("conv_id", "h1", "h2").distinct()
    own = texts.select("conv_id", "turn", F.explode(lines_of(F.col("text"))).alias("line")).where(~F.rlike("line", F.lit(MARKS)))
    own = own.withColumn("line", normal(F.col("line"))).select("conv_id", F.col("turn").alias("first"), *hashes(F.col("line")))
    first = own.join(wanted, ["conv_id", "h1", "h2"], "left_semi").groupBy("conv_id", "h1", "h2").agg(F.min("first").alias("first"))
    found = quoted.join(first, ["conv_id", "h1", "h2"], "left").withColumn("first", F.when(F.col("first") < F.col("turn"), F.col("first")))
    votes = found.groupBy(*row, "passage", "level", "first").agg(F.count("*").alias("n"))
    best = F.max(F.when(F.col("first").isNotNull(), F.struct("n", -F.col("first"))))
    passages = votes.groupBy(*row, "passage", "level").agg(F.sum("n").alias("n_lines"), best.alias("best"))
    return passages.select(*row, "passage", "level", "n_lines", (-F.col("best.col2")).alias("original"), F.coalesce("best.n", F.lit(0)).alias("n_found"))


def _before(turns: DataFrame, value: Column, strict: bool) -> Column:
    """Over ``turns`` (conv_id, turn, block, hi): the largest ``value`` of earlier turns (or also of this one)."""
    inside = Window.partitionBy("conv_id", "block").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1 if strict else 0)
    return F.coalesce(F.max(value).over(inside), F.col("hi"))


def _carried(turns: DataFrame, value: Column) -> DataFrame:
    """``turns`` with ``hi``: the largest ``value`` in the blocks before each one's."""
    tops = turns.groupBy("conv_id", "block").agg(F.max(value).alias("top"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # one row a block
    return turns.join(tops.select("conv_id", "block", F.max("top").over(earlier).alias("hi")), ["conv_id", "block"])


def reply_runs(messages: DataFrame, links: DataFrame) -> DataFrame:
    """``conv_id, turn, parent, path`` of every turn, so that (path, turn) sorts a conversation by its replies.

    A turn replies to the original of most of its outermost quoted lines, without one to the turn before. Turns that reply to the turn
    before form a run with it; a run that replies to an earlier turn p follows everything that comes after p on p's
    own branch. ``path`` holds -p and the first turn of each such run from the root down.
    """
    block = F.floor(F.col("turn") / BLOCK)
    turns = messages.where("conv_id is not null and turn is not null").select("conv_id", "turn").distinct().withColumn("block", block)
    votes = links.where("level = 1 and original is not null").groupBy("conv_id", "turn", "original").agg(F.sum("n_found").alias("n"))
    linked = votes.groupBy("conv_id", "turn").agg(F.max(F.struct("n", -F.col("original"))).alias("best"))
    turns = _carried(turns, F.col("turn")).withColumn("previous", _before(turns, F.col("turn"), True)).drop("hi")
    turns = turns.join(linked, ["conv_id", "turn"], "left").withColumn("quoted", -F.col("best.col2")).drop("best")
    turns = turns.withColumn("begins", F.when(F.col("quoted") != F.col("previous"), F.col("turn")))
    turns = cut(turns, "quote-turns")
    turns = _carried(turns, F.col("begins")).withColumn("run", _before(turns, F.col("begins"), False))
    turns = cut(turns.select("conv_id", "turn", F.coalesce("quoted", "previous").alias("parent"), "run", "begins"), "quote-runs")
    runs = turns.where("begins is not null").select("conv_id", F.col("turn").alias("run"), "parent")
    at = turns.select("conv_id", F.col("turn").alias("parent"), F.col("run").alias("up"))
    step = F.array(-F.col("parent"), F.col("run"))
    paths = cut(runs.join(at, ["conv_id", "parent"]).select("conv_id", "run", "up", step.alias("path")), "quote-paths")
    while not paths.where("up is not null").isEmpty():  # each round doubles the length that is known
        above = paths.select("conv_id", F.col("run").alias("up"), F.col("up").alias("next"), F.col("path").alias("before"))
        paths = paths.join(above, ["conv_id", "up"], "left").select(
            "conv_id", "run", F.col("next").alias("up"), F.concat(F.coalesce("before", F.array().cast("array<bigint>")), "path").alias("path")
        )
        paths = cut(paths, "quote-paths")
    path = F.coalesce("path", F.array().cast("array<bigint>")).alias("path")
    return turns.join(paths.drop("up"), ["conv_id", "run"], "left").select("conv_id", "turn", "parent", path)


def link_quotes(messages: DataFrame) -> DataFrame:
    """Every row of ``messages`` (conv_id, turn, role, text) as a reply without quotes.

    ``conv_id, turn, role, content, parent, path, n_passages, n_linked, depth``: the unquoted text, the turn replied to, the
    key that sorts by replies (see ``reply_runs``), quoted passages, those with a known original, and the deepest quote level. Rows
    without conv_id or turn are kept, without links, parent or path; a null text gives an empty content; rows of one
    conversation and turn share parent and path and sort by role and text; repeated rows stay repeated; an empty
    table gives no rows. Other columns are left out.
    """
    rows = messages.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))
    links = cut(quote_links(rows), "quote-links")
    counts = links.groupBy("conv_id", "turn", "_th").agg(
        F.count("*").alias("n_passages"), F.count("original").alias("n_linked"), F.max("level").alias("depth")
    )
    keyed = rows.withColumn("_th", F.xxhash64("role", "text"))
    out = keyed.join(counts, ["conv_id", "turn", "_th"], "left").join(reply_runs(rows, links), ["conv_id", "turn"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return out.select("conv_id", "turn", "role", own_text(F.col("text")).alias("content"), "parent", "path", zero("n_passages"), zero("n_linked"), zero("depth"))


def said(role: Column, content: Column) -> Column:
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"), content, F.lit("\n"))


def conversations(linked: DataFrame, turns: int = 64) -> DataFrame:
    """``conv_id, path, part, n_messages, text``: formatted conversations in reply order, in parts of at most ``turns`` turns.

    Sorted by (conv_id, path, part) the texts make up each conversation; parts bound what one row holds. Rows of one turn come in the order of
    role and text, and rows that say the same at one turn are said once (``n_messages`` counts them all). A row
    without conv_id or turn is a part of its own, with a null ``part``; such rows are not grouped, however many there are.
    """
    named = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    own = said(F.col("role"), F.col("content"))
    parts = linked.where(named).groupBy("conv_id", "path", F.floor(F.col("turn") / turns).alias("part"))
    texts = F.array_sort(F.collect_set(F.struct("turn", own.alias("said"))))
    parts = parts.agg(F.count("*").alias("n_messages"), F.array_join(F.transform(texts, lambda m: m["said"]), "").alias("text"))
    alone = linked.where(~named).select("conv_id", "path", F.lit(None).cast("long").alias("part"), F.lit(1).cast("long").alias("n_messages"), own.alias("text"))
    return parts.union(alone)


def op9_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message with its links, and the number of messages and the digest of the formatted part of a conversation that it is in."""
    turns = 64
    linked = cut(link_quotes(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")), "quote-linked")
    parts = conversations(linked, turns).where("part is not null")
    parts = parts.select("conv_id", "path", "part", "n_messages", F.sha2("text", 256).alias("part_sha256"))
    rows = linked.withColumn("part", F.floor(F.col("turn") / turns)).join(parts, ["conv_id", "path", "part"], "left")
    return rows.select(
        "conv_id",
        "turn",
        "role",
        F.col("parent").alias("reply_to"),
        F.array_join("path", ",").alias("path"),
        "n_passages",
        "n_linked",
        "depth",
        F.sha2("content", 256).alias("content_sha256"),
        F.coalesce("n_messages", F.lit(1)).cast("long").alias("part_messages"),
        F.coalesce("part_sha256", F.sha2(said(F.col("role"), F.col("content")), 256)).alias("part_sha256"),
    )


SQL = r"""
with recursive msg as (
  select conv_id, turn, role, coalesce(text, '') as text, row_number() over () as id from conversations),
line as (
  select id, conv_id, turn, k, l.line,
    length(regexp_replace(regexp_extract(l.line, '^(?:[ \t]*>)+'), '[^>]', '', 'g')) as level
  from msg, lateral (select unnest(string_split_regex(text, '\r?\n')) as line, generate_subscripts(string_split_regex(text, '\r?\n'), 1) as k) l),
passage as (
  select *, sum(case when level <> before and level > 0 then 1 else 0 end) over (partition by id order by k) as passage,
    lower(trim(regexp_replace(regexp_replace(line, '^(?:[ \t]*>)+ ?', ''), '\s+', ' ', 'g'))) as said
  from (select *, lag(level, 1, 0) over (partition by id order by k) as before from line)),
origin as (select conv_id, said, min(turn) as first from passage where level = 0 group by 1, 2),
quoted as (
  select p.*, case when o.first < p.turn then o.first end as first
  from passage p left join origin o on p.conv_id = o.conv_id and p.said = o.said
  where level > 0 and p.said <> '' and p.conv_id is not null and p.turn is not null),
vote as (select id, conv_id, turn, passage, level, first, count(*) as n from quoted group by all),
link as (
  select id, conv_id, turn, passage, level, first(first order by n desc, first) filter (first is not null) as original,
    coalesce(max(n) filter (first is not null), 0) as n_found
  from vote group by id, conv_id, turn, passage, level),
count_ as (select id, count(*) as n_passages, count(original) as n_linked, max(level) as depth from link group by id),
turns as (
  select *, lag(turn) over (partition by conv_id order by turn) as previous
  from (select distinct conv_id, turn from msg where conv_id is not null and turn is not null)),
chosen as (
  select conv_id, turn, first(original order by n desc, original) as quoted from (
    select conv_id, turn, original, sum(n_found) as n from link where level = 1 and original is not null group by all) group by 1, 2),
reply as (
  select t.*, quoted, case when quoted <> previous then t.turn end as begins,
    max(case when quoted <> previous then t.turn end) over (partition by t.conv_id order by t.turn) as run
  from turns t left join chosen c on t.conv_id = c.conv_id and t.turn = c.turn),
path as (
  select conv_id, run, cast([] as bigint[]) as path from (select distinct conv_id, run from reply) where run is null
  union all
  select r.conv_id, r.turn, list_concat(p.path, [-r.quoted, r.turn])
  from reply r join reply a on a.conv_id = r.conv_id and a.turn = r.quoted
  join path p on p.conv_id = a.conv_id and p.run is not distinct from a.run
  where r.begins is not null),
row_ as (
  select m.conv_id, m.turn, m.role, coalesce(r.quoted, r.previous) as reply_to, array_to_string(p.path, ',') as path,
    coalesce(n_passages, 0) as n_passages, coalesce(n_linked, 0) as n_linked, cast(coalesce(depth, 0) as bigint) as depth,
    trim(regexp_replace(
      array_to_string(list_filter(string_split_regex(m.text, '\r?\n'), lambda x : not regexp_matches(x, '^(?:[ \t]*>)+')), chr(10)),
      '\n\s*\n\s*\n', chr(10) || chr(10), 'g'), chr(32) || chr(10) || chr(9)) as content,
    '<|' || coalesce(m.role, '') || '|>' || chr(10) || content || chr(10) as said, floor(m.turn / 64) as part
  from msg m left join count_ c on m.id = c.id
  left join reply r on r.conv_id = m.conv_id and r.turn = m.turn
  left join path p on p.conv_id = r.conv_id and p.run is not distinct from r.run),
part as (
  select conv_id, path, part, cast(sum(n) as bigint) as n, sha256(string_agg(said, '' order by turn, said)) as sha
  from (
    select conv_id, path, part, turn, said, count(*) as n from row_
    where conv_id is not null and turn is not null group by all)
  group by all)
select r.conv_id, r.turn, r.role, r.reply_to, r.path, r.n_passages, r.n_linked, r.depth, sha256(r.content) as content_sha256,
  coalesce(p.n, 1) as part_messages, coalesce(p.sha, sha256(r.said)) as part_sha256
from row_ r left join part p on p.conv_id = r.conv_id and p.path = r.path and p.part = r.part
"""
