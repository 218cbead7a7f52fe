"""Preference formatting: what chosen and rejected conversations share is the prompt, the rest is trained on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import column

#: How a turn is written, and what keeps a text from looking like such a mark.
OPEN, SHUT, END = "<|", "|>\n", "<|end|>\n"
_ESCAPED = ("<|", "< |")


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(SHUT), turn["text"], F.lit(END))


def _all_rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def _trained(turns: Column) -> Column:
    """Start and end, in code points of the rendered turns, of what an assistant says, end mark included."""
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() AS array<struct<start:int,end:int>>)").alias("spans"))

    def add(state: Column, turn: Column) -> Column:
        head = F.length(F.concat(F.lit(OPEN), turn["role"], F.lit(SHUT)))
        end = state["at"] + F.length(_rendered(turn))
        span = F.struct((state["at"] + head).alias("start"), end.alias("end"))
        spans = F.when(turn["role"] == "assistant", F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, add, lambda state: state["spans"])


def preference_pairs(
    turns: DataFrame, pair: str, side: str = "side", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """Prompt and masked completions of each pair of conversations.

    turns: one row per turn; `side` is 'chosen' or 'rejected'. One row per pair: the pair's id,
    `n_prompt_turns`, `prompt`, `chosen`, `rejected`, `chosen_spans`, `rejected_spans`, `usable`. The
    longest prefix of turns with equal role and text is rendered once, as the prompt; what follows on
    either side is its completion, and the spans (code points, end exclusive) mark what is trained on:
    the assistant's turns. A pair is usable if both completions have such a span and they differ.

    Turns are in the order of their number, then role, then text; null numbers come first. A null role
    counts as 'user', a null text as empty; turns of any other side, or none, are left out; a pair
    without a turn on one side has an empty completion there. Turns without a pair id form one pair of
    their own. Repeated turns count as turns. Other columns are ignored, whatever their names.
    """
    given = turns.select(
        column(pair).alias("pair"),
        column(side).alias("side"),
        F.struct(
            column(turn).alias("turn"),
            F.coalesce(column(role), F.lit("user")).alias("role"),
            F.replace(F.coalesce(column(text), F.lit("")), *map(F.lit, _ESCAPED)).alias("text"),
        ).alias("said"),
    ).where("side IN ('chosen', 'rejected')")

    def of(name: str) -> Column:
        said = F.sort_array(F.collect_list(F.when(F.col("side") == name, F.col("said"))))
        return F.transform(said, lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text")))

    pairs = given.groupBy("pair").agg(of("chosen").alias("a"), of("rejected").alias("b"))
    shorter = F.least(F.size("a"), F.size("b"))
    same = F.transform(F.slice("a", F.lit(1), shorter), lambda x, i: x == F.element_at("b", i + 1))
    first_other = F.array_position(same, F.lit(False)).cast("int")  # 0: none
    pairs = pairs.withColumn("n", F.when(first_other == 0, shorter).otherwise(first_other - 1))
    rest_a, rest_b = (F.slice(c, F.col("n") + 1, F.greatest(F.size(c) - F.col("n"), F.lit(0))) for c in ("a", "b"))
    pairs = pairs.select("pair", "n", F.slice("a", F.lit(1), F.col("n")).alias("p"), rest_a.alias("a"), rest_b.alias("b"))
    done = pairs.select(
        F.col("pair").alias(pair),
        F.col("n").alias("n_prompt_turns"),
        _all_rendered(F.col("p")).alias("prompt"),
        _all_rendered(F.col("a")).alias("chosen"),
        _all_rendered(F.col("b")).alias("rejected"),
        _trained(F.col("a")).alias("chosen_spans"),
        _trained(F.col("b")).alias("rejected_spans"),
    )
    trained = (F.size("chosen_spans") > 0) & (F.size("rejected_spans") > 0)
    return done.withColumn("usable", trained & (F.col("chosen") != F.col("rejected")))


def against_neighbours(conversations: DataFrame) -> DataFrame:
    """Turns of pairs made from whole conversations (conv_id, turn, role, text), one pair per conversation.

    Chosen is the conversation up to its last assistant turn. Rejected is the same with the reply that
    ends its neighbour's (2k and 2k + 1 are neighbours) in the place of its own; the empty reply where
    the neighbour has none. Conversations in which no assistant speaks make no pair.
    """
    given = conversations.select("conv_id", "turn", "role", "text")
    last = (
        given.where("role = 'assistant'")
        .groupBy("conv_id")
        .agg(F.max("turn").alias("last"), F.max(F.struct("turn", "text"))["text"].alias("reply"))
    )
    other = last.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.col("reply").alias("other"))
    ends = last.join(other, "conv_id", "left")
    kept = given.join(ends.select("conv_id", "last"), "conv_id")
    chosen = kept.where("turn <= last").select("conv_id", F.lit("chosen").alias("side"), "turn", "role", "text")
    before = kept.where("turn < last").select("conv_id", F.lit("rejected").alias("side"), "turn", "role", "text")
    swapped = ends.select(
        "conv_id",
        F.lit("rejected").alias("side"),
        F.col("last").alias("turn"),
        F.lit("assistant").alias("role"),
        F.col("other").alias("text"),
    )
    return chosen.union(before).union(swapped)


def _as_text(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["start"], s["end"])), ",")


def digest(conversations: DataFrame) -> DataFrame:
    """The pairs of all conversations, spans as text."""
    pairs = preference_pairs(against_neighbours(conversations), "conv_id")
    return pairs.withColumns({c: _as_text(c) for c in ("chosen_spans", "rejected_spans")})


ORACLE_SQL = """
WITH last AS (
    SELECT conv_id, max(turn) AS last, max(struct_pack(t := turn, x := text)).x AS reply
    FROM conversations WHERE role = 'assistant' GROUP BY conv_id
), ends AS (
    SELECT a.conv_id, a.last, b.reply AS other FROM last a LEFT JOIN last b ON b.conv_id = xor(a.conv_id, 1)
), turns AS (
    SELECT c.conv_id, 'chosen' AS side, c.turn, c.role, c.text
    FROM conversations c JOIN ends e USING (conv_id) WHERE c.turn <= e.last
    UNION ALL
    SELECT c.conv_id, 'rejected', c.turn, c.role, c.text
    FROM conversations c JOIN ends e USING (conv_id) WHERE c.turn < e.last
    UNION ALL
    SELECT conv_id, 'rejected', last, 'assistant', other FROM ends
), placed AS (
    SELECT conv_id, side, row_number() OVER (PARTITION BY conv_id, side ORDER BY turn, role, text) AS place,
           coalesce(role, 'user') AS role, replace(coalesce(text, ''), '<|', '< |') AS text
    FROM turns
), aligned AS (
    SELECT a.conv_id, a.place, a.role = b.role AND a.text = b.text AS same
    FROM (SELECT * FROM placed WHERE side = 'chosen') a
    JOIN (SELECT * FROM placed WHERE side = 'rejected') b USING (conv_id, place)
), shared AS (
    SELECT conv_id, coalesce(min(place) FILTER (NOT same) - 1, count(*)) AS n FROM aligned GROUP BY conv_id
), rendered AS (
    SELECT p.conv_id, p.side, p.place, p.role, s.n, '<|' || p.role || '|>' || chr(10) AS head,
           '<|' || p.role || '|>' || chr(10) || p.text || '<|end|>' || chr(10) AS line
    FROM placed p JOIN shared s USING (conv_id)
), measured AS (
    SELECT *, sum(length(line)) OVER (PARTITION BY conv_id, side, place > n ORDER BY place) AS stop FROM rendered
), joined AS (
    SELECT conv_id, any_value(n) AS n,
           string_agg(line, '' ORDER BY place) FILTER (side = 'chosen' AND place <= n) AS prompt,
           string_agg(line, '' ORDER BY place) FILTER (side = 'chosen' AND place > n) AS chosen,
           string_agg(line, '' ORDER BY place) FILTER (side = 'rejected' AND place > n) AS rejected,
           string_agg((stop - length(line) + length(head)) || '-' || stop, ',' ORDER BY place)
               FILTER (side = 'chosen' AND place > n AND role = 'assistant') AS chosen_spans,
           string_agg((stop - length(line) + length(head)) || '-' || stop, ',' ORDER BY place)
               FILTER (side = 'rejected' AND place > n AND role = 'assistant') AS rejected_spans
    FROM measured GROUP BY conv_id
)
SELECT conv_id, CAST(n AS INTEGER) AS n_prompt_turns, coalesce(prompt, '') AS prompt,
       coalesce(chosen, '') AS chosen, coalesce(rejected, '') AS rejected,
       coalesce(chosen_spans, '') AS chosen_spans, coalesce(rejected_spans, '') AS rejected_spans,
       chosen_spans IS NOT NULL AND rejected_spans IS NOT NULL
           AND coalesce(chosen, '') <> coalesce(rejected, '') AS usable
FROM joined
"""
