"""Operator 7, preference formatting of chosen and rejected conversations.

Native: DataFrame functions only.  The longest common turn prefix of a pair is
rendered once as its prompt; the turns after it become the two completions.
Prompt text is masked (no loss); of a completion only assistant turns train.

Everything happens at the grain of turns, so no conversation is ever gathered
and a conversation that holds a third of all turns is spread like any other:
turns that are equal on both sides are counted together (map-side combined),
the first turn whose counts differ ends the prefix, and each turn is then
rendered where it is.  ``seq`` puts a part's segments in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TEMPLATE = ("<|im_start|>", "\n", "<|im_end|>\n")
TRAINED_ROLE = "assistant"


def render(role: Column, text: Column, template=TEMPLATE) -> Column:
    a, b, c = template
    return F.concat(F.lit(a), F.coalesce(role, F.lit("")), F.lit(b), F.coalesce(text, F.lit("")), F.lit(c))


def preference_segments(turns: DataFrame, template=TEMPLATE) -> DataFrame:
    """``turns(pair_id, side, turn, role, text)``, side chosen or rejected ->
    one row per rendered turn: pair_id, part (prompt, chosen or rejected), turn, seq,
    role, segment, n_chars, trained (the mask: true where the loss counts).

    Turns are compared by number, role and text (null equals null).  The prefix
    ends before the smallest turn number at which the two sides differ in any turn, or that
    one side lacks.  Turns with a null number come after all others and are
    never part of a prefix that any difference ends.  Repeated turns (same number, role and text) stay:
    seq tells them apart; turns of one number are ordered by role and text.
    A pair with one side only has no prompt.  Equal sides are all prompt, with no completion.
    Extra columns play no part; empty input gives no rows.
    """
    one = turns.groupBy("pair_id", "turn", "role", "text").agg(
        F.count(F.when(F.col("side") == "chosen", 1)).alias("c"), F.count(F.when(F.col("side") == "rejected", 1)).alias("r"))
    last = F.lit((1 << 63) - 1)
    number = F.coalesce(F.col("turn").cast("long"), last)
    ends = (one.groupBy("pair_id").agg(F.min(F.when(F.col("c") != F.col("r"), number)).alias("stop"),
                                       F.count(F.when(F.col("c") != F.col("r"), 1)).alias("differ"))
            .withColumnRenamed("pair_id", "p"))
    j = one.join(ends, F.col("pair_id").eqNullSafe(F.col("p")))
    shared = (F.col("differ") == 0) | (number < F.col("stop"))
    part = lambda name, n: F.struct(F.lit(name).alias("part"), F.col(n).alias("n"))
    parts = F.when(shared, F.array(part("prompt", "c"))).otherwise(F.array(part("chosen", "c"), part("rejected", "r")))
    j = j.select("pair_id", "turn", "role", "text", F.explode(F.filter(parts, lambda x: x["n"] > 0)).alias("x"))
    segment = render(F.col("role"), F.col("text"), template)
    j = j.select("pair_id", F.col("x.part").alias("part"), "turn", "role", segment.alias("segment"),
                 F.explode(F.sequence(F.lit(0).cast("long"), F.col("x.n") - 1)).alias("copy"),
                 ((F.col("x.part") != "prompt") & F.coalesce(F.col("role") == TRAINED_ROLE, F.lit(False))).alias("trained"))
    # order within a part: turn number, then role and text, then copies
    return j.select("pair_id", "part", "turn", F.struct(
        F.coalesce(F.col("turn").cast("long"), last).alias("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.xxhash64("segment").alias("hash"), "copy").alias("seq"), "role", "segment",
        F.length("segment").cast("long").alias("n_chars"), "trained")


def preference_rows(segments: DataFrame) -> DataFrame:
    """One training row per pair with strings: prompt, chosen, rejected and the
    masks as arrays of (n_chars, trained) runs.  Each row is as long as its
    conversations are; use the segments themselves where a conversation may not fit a row."""
    run = F.struct("seq", "segment", "n_chars", "trained")
    got = segments.groupBy("pair_id").agg(*[F.sort_array(F.collect_list(F.when(F.col("part") == p, run))).alias(p)
                                            for p in ("prompt", "chosen", "rejected")])
    text = lambda p: F.array_join(F.transform(p, lambda s: s["segment"]), "").alias(p)
    mask = lambda p: F.transform(p, lambda s: F.struct(s["n_chars"].alias("n_chars"), s["trained"].alias("trained"))).alias(f"{p}_mask")
    return got.select("pair_id", text("prompt"), text("chosen"), text("rejected"), mask("chosen"), mask("rejected"))


SALTS = 8


def pair_by_id(conversations: DataFrame) -> DataFrame:
    """For tables that hold pairs: conversations 2k and 2k + 1 are pair k, the even one the chosen, the odd one the rejected one."""
    return conversations.select(F.expr("(conv_id - pmod(conv_id, 2)) div 2").alias("pair_id"),
                                F.when(F.expr("pmod(conv_id, 2)") == 0, "chosen").otherwise("rejected").alias("side"),
                                "turn", "role", "text")


def pairs_by_last_reply(conversations: DataFrame) -> DataFrame:
    """Preference pairs that share a prefix, for a table that has none: the chosen side is the conversation; the
    rejected side has the same turns before its last assistant turn and, in that turn's place, the last assistant turn of the
    conversation that shares all but the last bit of its number.

    Columns conv_id (which names the pair), turn, role, text.  The last assistant turn is the one with the greatest number,
    of several with that number the greatest text (a null text counts as empty).  Conversations without one, with no other
    conversation to take one from, or with a null number make no pair.  Turns with a null number are of the chosen side only.
    Turns meet their conversation's one row on (number, salt), so the turns of one that holds much of the table are spread."""
    says = F.col("role") == TRAINED_ROLE
    last = (conversations.where(says & F.col("turn").isNotNull()).groupBy("conv_id")
            .agg(F.max(F.struct(F.col("turn").alias("turn"), F.coalesce("text", F.lit("")).alias("text"))).alias("x"))
            .select("conv_id", F.col("x.turn").alias("last"), F.col("x.text").alias("reply")))
    other = last.select(F.col("conv_id").bitwiseXOR(F.lit(1).cast("long")).alias("conv_id"), F.col("reply").alias("other"))
    ends = last.drop("reply").join(other, "conv_id")
    salted = ends.select("conv_id", "last", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    turns = (conversations.select("conv_id", "turn", "role", "text", F.pmod(F.xxhash64("turn", "role", "text"), F.lit(SALTS)).cast("int").alias("salt"))
             .join(salted, ["conv_id", "salt"]))
    sides = F.when(F.col("turn") < F.col("last"), F.array(F.lit("chosen"), F.lit("rejected"))).otherwise(F.array(F.lit("chosen")))
    kept = turns.select(F.col("conv_id").alias("pair_id"), F.explode(sides).alias("side"), "turn", "role", "text")
    replies = ends.select(F.col("conv_id").alias("pair_id"), F.lit("rejected").alias("side"), F.col("last").alias("turn"),
                          F.lit(TRAINED_ROLE).alias("role"), F.col("other").alias("text"))
    return kept.unionByName(replies)


def query(conversations: DataFrame) -> DataFrame:
    """Within a part, segments are in order by seq_turn (null numbers last), role, segment, seq_copy."""
    s = preference_segments(pairs_by_last_reply(conversations.select(F.col("conv_id").cast("long"), "turn", "role", "text")))
    return s.select("pair_id", "part", "turn", F.col("seq.turn").alias("seq_turn"), F.col("seq.copy").alias("seq_copy"), "role", "segment", "n_chars", "trained")


ORACLE = """
WITH l AS (SELECT conv_id, turn AS last, max(coalesce(text, '')) AS reply FROM (
    SELECT *, rank() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back FROM conversations
    WHERE role = 'assistant' AND turn IS NOT NULL AND conv_id IS NOT NULL) WHERE back = 1 GROUP BY conv_id, turn),
e AS (SELECT l.conv_id, l.last, o.reply AS other FROM l JOIN l o ON o.conv_id = xor(CAST(l.conv_id AS BIGINT), 1)),
t AS (SELECT c.conv_id AS pair_id, 0 AS odd, c.turn, c.role, c.text FROM conversations c JOIN e USING (conv_id)
  UNION ALL SELECT c.conv_id, 1, c.turn, c.role, c.text FROM conversations c JOIN e USING (conv_id) WHERE c.turn < e.last
  UNION ALL SELECT conv_id, 1, last, 'assistant', other FROM e),
one AS (SELECT pair_id, turn, role, text, count(*) FILTER (odd = 0) AS c, count(*) FILTER (odd = 1) AS r
  FROM t GROUP BY ALL),
ends AS (SELECT pair_id AS p, min(coalesce(turn, 9223372036854775807)) FILTER (c <> r) AS stop FROM one GROUP BY pair_id),
j AS (SELECT one.*, stop IS NULL OR coalesce(turn, 9223372036854775807) < stop AS shared
  FROM one JOIN ends ON pair_id IS NOT DISTINCT FROM p),
parts AS (SELECT pair_id, 'prompt' AS part, turn, role, text, c AS n FROM j WHERE shared
  UNION ALL SELECT pair_id, 'chosen', turn, role, text, c FROM j WHERE NOT shared
  UNION ALL SELECT pair_id, 'rejected', turn, role, text, r FROM j WHERE NOT shared),
copies AS (SELECT *, unnest(range(n)) AS k FROM parts WHERE n > 0)
SELECT pair_id, part, turn, CAST(coalesce(turn, 9223372036854775807) AS BIGINT) AS seq_turn, CAST(k AS BIGINT) AS seq_copy, role,
  '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) AS segment,
  CAST(length('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10)) AS BIGINT) AS n_chars,
  part <> 'prompt' AND coalesce(role = 'assistant', false) AS trained
FROM copies
"""
