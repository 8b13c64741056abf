"""Quotation linking: conversations in reply order, without their quotes.

A line that begins with ``>`` marks (each after at most three blanks) is quoted; the number of marks
is its level. A passage is a run of non-blank lines of one level. Passages and their lines are
normalised (lower case, single blanks), hashed and joined with what earlier messages of the same
conversation say themselves: their whole own text, its paragraphs and its lines. A unit is linked to
the latest earlier message that has it.

A message answers the message that most characters of its first-level quotes come from (the latest
on ties), else the message of the preceding turn. The answered message has a smaller turn, so the
order of turns is a reply order; ``reply_order`` numbers it from 0 in each conversation.

DataFrame functions only. Every look-back ("the latest before") runs over stretches of ``SPAN`` turns and over
one summary row for each stretch, so no conversation, however long, is gathered in a task; and it
never pairs a quote with all messages that say the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPAN = 512
_QUOTED_LINE = r"(?dm)^(?:[ \t]{0,3}>)[^\n]*(?:\n|\z)"
_MARKS = r"(?d)^((?:[ \t]{0,3}>)*)"


def _normal(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"[ \t\r\n]+", " ")))


def _latest_before(rows: DataFrame, keys: list[str], mark: Column, name: str) -> DataFrame:
    """``rows`` with ``name``: the greatest ``mark`` of the same keys at a smaller ``turn``.

    ``mark`` is null or the row's turn; ``rows`` have a column ``stretch``.
    """
    rows = rows.withColumn("_mark", mark)
    within = Window.partitionBy(*keys, "stretch").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    ends = rows.groupBy(*keys, "stretch").agg(F.max("_mark").alias("_end"))
    before = Window.partitionBy(*keys).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("stretch").alias("_stretch"), F.max("_end").over(before).alias("_carried"))
    same = [F.col(k) == F.col(f"_{k}") for k in [*keys, "stretch"]]
    seen = rows.withColumn("_here", F.max("_mark").over(within)).join(carried, same, "left")
    return seen.withColumn(name, F.coalesce("_here", "_carried")).drop("_mark", "_here", "_carried", *[f"_{k}" for k in [*keys, "stretch"]])


def reply_order(conversations: DataFrame) -> DataFrame:
    """Messages without quotes, each with the message it answers.

    Columns ``conv_id, turn, role, text, n_levels, n_quoted, n_linked, parent_turn, linked_by,
    reply_order``, a row per row of ``conversations``; other columns are ignored. ``n_levels`` is the
    deepest quote level, ``n_quoted`` counts passages and ``n_linked`` those with a linked unit;
    ``linked_by`` is ``quote``, ``previous`` or null for a first turn.

    A null text stays null and has no quotes; an empty one is a message like any other. Rows without
    conv_id or turn are linked with nothing and have no reply order. Repeated turns are separate messages
    in an order of their hash, and repeated rows follow one another. An empty table gives no rows.
    """
    placed = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    base = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    base = base.withColumn("row", F.xxhash64("role", "text"))
    base = base.withColumn("stretch", F.when(placed, F.floor(F.col("turn") / SPAN)).otherwise(F.col("row")))
    key = ["conv_id", "turn", "row"]

    quoting = base.where(placed & F.col("text").rlike(r"(?dm)^[ \t]{0,3}>")).dropDuplicates(key)
    lines = quoting.select(*key, "stretch", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    marks = F.regexp_extract("line", _MARKS, 1)
    lines = lines.withColumn("level", F.length(F.regexp_replace(marks, "[^>]", "")))
    lines = lines.withColumn("body", _normal(F.regexp_replace("line", _MARKS, "")))
    in_message = Window.partitionBy(*key).orderBy("pos")  # one message's lines
    kind = F.when((F.col("level") > 0) & (F.col("body") != ""), F.col("level")).otherwise(0)
    lines = lines.withColumn("kind", kind).withColumn("fresh", (F.col("kind") != F.coalesce(F.lag("kind").over(in_message), F.lit(0))).cast("int"))
    quoted = lines.withColumn("run", F.sum("fresh").over(in_message)).where("kind > 0")
    passages = quoted.groupBy(*key, "stretch", "run").agg(
        F.first("level").alias("level"), F.array_sort(F.collect_list(F.struct("pos", "body"))).alias("lines")
    )
    bodies = F.transform("lines", lambda x: x["body"])
    units = passages.select(
        *key, "stretch", "run", "level", F.explode(F.array_union(bodies, F.array(F.array_join(bodies, " ")))).alias("unit")
    )

    own = F.regexp_replace("text", _QUOTED_LINE, "")
    quoted_here = units.select("conv_id").distinct()
    originals = base.where(placed).join(quoted_here, "conv_id", "left_semi").withColumn("own", own)
    said = F.array_union(
        F.array_union(F.array(F.col("own")), F.split("own", r"\n[ \t]*\n")), F.split("own", "\n")
    )
    said = originals.select("conv_id", "turn", "stretch", F.explode(said).alias("unit")).withColumn("unit", _normal(F.col("unit")))
    said = said.where("unit <> ''").select("conv_id", "turn", "stretch", F.sha2("unit", 256).alias("hash")).distinct()
    asked = units.withColumn("hash", F.sha2("unit", 256)).withColumn("chars", F.length("unit")).drop("unit")
    both = asked.withColumn("is_quote", F.lit(True)).unionByName(said.withColumn("is_quote", F.lit(False)), allowMissingColumns=True)
    found = _latest_before(both, ["conv_id", "hash"], F.when(~F.col("is_quote"), F.col("turn")), "source").where("is_quote")

    summary = passages.groupBy(*key).agg(F.max("level").alias("n_levels"), F.count("*").alias("n_quoted"))
    linked = found.where("source is not null").groupBy(*key).agg(F.countDistinct("run").alias("n_linked"))
    answered = found.where("source is not null and level = 1").groupBy(*key, "source").agg(F.sum("chars").alias("chars"))
    answered = answered.groupBy(*key).agg(F.max(F.struct("chars", "source")).getField("source").alias("quoted_turn"))
    facts = summary.join(linked, key, "left").join(answered, key, "left")

    turns = base.where(placed)
    inside = Window.partitionBy("conv_id", "stretch").orderBy("turn", "row")
    sizes = turns.groupBy("conv_id", "stretch").count()
    ahead = Window.partitionBy("conv_id").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(F.col("conv_id").alias("_c"), F.col("stretch").alias("_s"), F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("_before"))
    ordered = _latest_before(turns, ["conv_id"], F.col("turn"), "previous_turn").withColumn("_n", F.row_number().over(inside) - 1)
    ordered = ordered.join(offsets, (F.col("conv_id") == F.col("_c")) & (F.col("stretch") == F.col("_s")))
    ordered = ordered.withColumn("reply_order", F.col("_before") + F.col("_n")).drop("_c", "_s", "_before", "_n")
    facts = facts.select(*[F.col(k).alias(f"_{k}") for k in key], "n_levels", "n_quoted", "n_linked", "quoted_turn")
    ordered = ordered.join(facts, [F.col(k) == F.col(f"_{k}") for k in key], "left")

    def shaped(frame: DataFrame) -> DataFrame:
        return frame.select(
            "conv_id",
            "turn",
            "role",
            own.alias("text"),
            F.coalesce(F.col("n_levels").cast("int"), F.lit(0)).alias("n_levels"),
            F.coalesce("n_quoted", F.lit(0)).cast("long").alias("n_quoted"),
            F.coalesce("n_linked", F.lit(0)).cast("long").alias("n_linked"),
            F.coalesce("quoted_turn", "previous_turn").alias("parent_turn"),
            F.when(F.col("quoted_turn").isNotNull(), "quote").when(F.col("previous_turn").isNotNull(), "previous").alias("linked_by"),
            F.col("reply_order").cast("long").alias("reply_order"),
        )

    nothing = {k: F.lit(None).cast("long") for k in ("previous_turn", "reply_order", "n_levels", "n_quoted", "n_linked", "quoted_turn")}
    return shaped(ordered).unionByName(shaped(base.where(~placed).withColumns(nothing)))


#: The same in SQL; turns of one conversation that repeat are ordered by role and text there.
ORACLE = r"""
WITH base AS (
  SELECT conv_id, turn, role, text,
         regexp_replace(text, '(?m)^(?:[ \t]{0,3}>)[^\n]*(?:\n|\z)', '', 'g') AS own
  FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
lines AS (
  SELECT conv_id, turn, text, pos, length(regexp_replace(regexp_extract(line, '^((?:[ \t]{0,3}>)*)', 1), '[^>]', '', 'g')) AS level,
         lower(trim(regexp_replace(regexp_replace(line, '^((?:[ \t]{0,3}>)*)', ''), '[ \t\r\n]+', ' ', 'g'))) AS body
  FROM (SELECT DISTINCT conv_id, turn, text, unnest(string_split(text, chr(10))) AS line,
               unnest(range(len(string_split(text, chr(10))))) AS pos FROM base)),
kinds AS (SELECT *, CASE WHEN level > 0 AND body <> '' THEN level ELSE 0 END AS kind FROM lines),
marked AS (
  SELECT *, CASE WHEN kind <> coalesce(lag(kind) OVER (PARTITION BY conv_id, turn, text ORDER BY pos), 0) THEN 1 ELSE 0 END AS fresh FROM kinds),
runs AS (SELECT *, sum(fresh) OVER (PARTITION BY conv_id, turn, text ORDER BY pos) AS run FROM marked),
passages AS (
  SELECT conv_id, turn, text, run, max(level) AS level, string_agg(body, ' ' ORDER BY pos) AS unit
  FROM runs WHERE kind > 0 GROUP BY conv_id, turn, text, run),
units AS (
  SELECT conv_id, turn, text, run, level, unit FROM passages
  UNION SELECT conv_id, turn, text, run, level, body FROM runs WHERE kind > 0),
said AS (
  SELECT DISTINCT conv_id, turn, lower(trim(regexp_replace(u, '[ \t\r\n]+', ' ', 'g'))) AS unit FROM (
    SELECT conv_id, turn, own AS u FROM base
    UNION ALL SELECT conv_id, turn, unnest(regexp_split_to_array(own, '\n[ \t]*\n')) FROM base
    UNION ALL SELECT conv_id, turn, unnest(string_split(own, chr(10))) FROM base)),
found AS (
  SELECT u.conv_id, u.turn, u.text, u.run, u.level, u.unit, max(s.turn) AS source
  FROM units u JOIN said s ON u.conv_id = s.conv_id AND u.unit = s.unit AND s.turn < u.turn GROUP BY ALL),
linked AS (SELECT conv_id, turn, text, count(DISTINCT run) AS n_linked FROM found GROUP BY ALL),
sources AS (
  SELECT conv_id, turn, text, source, sum(length(unit)) AS chars FROM found WHERE level = 1 GROUP BY ALL),
answered AS (
  SELECT conv_id, turn, text, source FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id, turn, text ORDER BY chars DESC, source DESC) AS n FROM sources) WHERE n = 1),
summary AS (SELECT conv_id, turn, text, max(level) AS n_levels, count(*) AS n_quoted FROM passages GROUP BY ALL),
ordered AS (
  SELECT *, max(turn) OVER (PARTITION BY conv_id ORDER BY turn RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous_turn,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS reply_order FROM base)
SELECT o.conv_id, o.turn, o.role, o.own AS text, coalesce(s.n_levels, 0)::INT AS n_levels, coalesce(s.n_quoted, 0)::BIGINT AS n_quoted,
       coalesce(l.n_linked, 0)::BIGINT AS n_linked, coalesce(a.source, o.previous_turn) AS parent_turn,
       CASE WHEN a.source IS NOT NULL THEN 'quote' WHEN o.previous_turn IS NOT NULL THEN 'previous' END AS linked_by,
       o.reply_order::BIGINT AS reply_order
FROM ordered o
LEFT JOIN summary s ON o.conv_id = s.conv_id AND o.turn = s.turn AND o.text = s.text
LEFT JOIN linked l ON o.conv_id = l.conv_id AND o.turn = l.turn AND o.text = l.text
LEFT JOIN answered a ON o.conv_id = a.conv_id AND o.turn = a.turn AND o.text = a.text
UNION ALL
SELECT conv_id, turn, role, regexp_replace(text, '(?m)^(?:[ \t]{0,3}>)[^\n]*(?:\n|\z)', '', 'g'), 0, 0, 0, NULL, NULL, NULL
FROM conversations WHERE conv_id IS NULL OR turn IS NULL
"""
