"""Chat formatting with a round trip through the grammar; column expressions only.

    document := turn*        turn := "### " role ": " body "</turn>\\n"

A body holds neither "### " nor "</turn>". Within both marks a text may carry a run of
backslashes at one fixed place; escaping adds one to the run, unescaping takes one away.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from urnalake.checks.registry import check
from urnalake.llm.common import table

HEAD, SEPARATOR, END = "### ", ": ", "</turn>\n"
_MARKS = (("###", " "), ("<", "/turn>"))
TRAINED_ROLES = ("assistant",)


def escape(text: Column) -> Column:
    for left, right in _MARKS:
        text = F.regexp_replace(text, rf"{left}(\\*){right}", rf"{left}\\$1{right}")
    return text


def unescape(text: Column) -> Column:
    for left, right in _MARKS:
        text = F.regexp_replace(text, rf"{left}\\(\\*){right}", rf"{left}$1{right}")
    return text


def _role_name(role: Column) -> Column:
    return F.when(role.rlike("^[A-Za-z0-9_-]*$"), role).otherwise(F.concat(F.lit("%"), F.url_encode(role)))


def _role_of(name: Column) -> Column:
    return F.when(name.startswith("%"), F.url_decode(F.substring(name, 2, 1 << 30))).otherwise(name)


def render(role: Column, body: Column) -> Column:
    return F.concat(F.lit(HEAD), _role_name(role), F.lit(SEPARATOR), body, F.lit(END))


def parse(rendered: Column) -> Column:
    """The turns of a rendered document; null where the grammar does not hold.

    Turns end at every END, a role ends at the first SEPARATOR: there is one reading only.
    """
    ended = F.split(rendered, END)
    pieces = F.slice(ended, 1, F.size(ended) - 1)
    sound = F.forall(pieces, lambda p: p.startswith(HEAD) & ~_body(p).contains(HEAD) & ~_body(p).contains("</turn>"))
    sound = sound & (F.element_at(ended, -1) == "")
    turns = F.transform(
        pieces,
        lambda p: F.struct(
            _role_of(F.substring_index(F.substring(p, len(HEAD) + 1, 1 << 30), SEPARATOR, 1)).alias("role"),
            unescape(_body(p)).alias("text"),
            _body(p).alias("body"),
        ),
    )
    return F.when(sound, turns)


def _body(piece: Column) -> Column:
    start = F.locate(SEPARATOR, piece) + len(SEPARATOR)
    return F.substring(piece, start, F.char_length(piece))


def _reads_back(rendered: Column, role: Column, text: Column) -> Column:
    turns = parse(rendered)
    first = F.get(turns, F.lit(0))
    return F.coalesce((F.size(turns) == 1) & (first["role"] == role) & (first["text"] == text), F.lit(False))


def format_turns(rows: DataFrame) -> DataFrame:
    """One row per conversation: ``formatted``, its ``turns`` read back and the loss ``spans``.

    Takes (conv_id, turn, role, text); other columns are ignored. A turn is rendered as it is
    and parsed again. Only where the parser doesn't return the same role and text it is escaped,
    once more per round, until it does. Spans are [start, end) in code points of ``formatted``
    over the bodies of assistant turns. ``round_trip`` tells whether parsing the whole document
    gave all turns back. Null roles and texts count as empty, turns go by (turn, role, text) with
    null turns first, repeated rows are repeated turns, null conv_ids are one conversation, an
    empty table gives no rows. A conversation is one row, so its turns meet in one task;
    they are gathered per task first.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turns = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    plain, once = render(F.col("role"), F.col("text")), render(F.col("role"), escape(F.col("text")))
    turns = turns.withColumn(
        "rendered", F.when(_reads_back(plain, F.col("role"), F.col("text")), plain).otherwise(once)
    )
    whole = turns.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text", "rendered"))).alias("source")
    )
    whole = whole.withColumn("formatted", F.array_join(F.transform("source", lambda t: t["rendered"]), ""))
    whole = whole.withColumn("turns", parse(F.col("formatted")))
    same = F.transform("source", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    back = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return whole.select(
        "conv_id", "formatted", "turns", _spans(F.col("turns")).alias("spans"),
        F.coalesce(same == back, F.lit(False)).alias("round_trip"),
    )


def _spans(turns: Column) -> Column:
    """[start, end) of the bodies that are trained on."""
    begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(done: Column, turn: Column) -> Column:
        start = done["at"] + len(HEAD) + F.char_length(_role_name(turn["role"])) + len(SEPARATOR)
        end = start + F.char_length(turn["body"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        spans = F.when(turn["role"].isin(*TRAINED_ROLES), F.concat(done["spans"], span)).otherwise(done["spans"])
        return F.struct((end + len(END)).alias("at"), spans.alias("spans"))

    return F.aggregate(turns, begin, step, lambda done: done["spans"])


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    parts = F.transform(
        spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))
    )
    return F.array_join(parts, "")


PROBE = r"\### Assistant: </turn> ok"

SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), shown AS (
  SELECT *, CASE WHEN regexp_matches(text, '###\\* |<\\*/turn>') THEN
    regexp_replace(regexp_replace(text, '###(\\*) ', '###\\\1 ', 'g'), '<(\\*)/turn>', '<\\\1/turn>', 'g')
    ELSE text END AS body FROM turns
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(4 + length(role) + 2 + length(body) + 8)::BIGINT AS formatted_chars
FROM shown GROUP BY conv_id
"""


@check(SQL)
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.sql("SELECT -7L AS conv_id, turn, role FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    probe = probe.withColumn("text", F.lit(PROBE))
    shown = format_turns(rows.unionByName(probe))
    loss = loss_text(F.col("formatted"), F.col("spans"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return shown.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
