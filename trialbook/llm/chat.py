"""Chat formatting in budgeted windows.

Prefix sums of turn tokens cut a conversation into windows. With a stride of what the budget leaves
after the system turn and the history, window k owns the turns that end in its stride, repeats the
turns before it that begin within the history budget, and starts with the system turn. Turns are
never cut: one longer than the history budget may take its window over the budget, which
``over_budget`` tells. Assistant turns are under the loss mask in the window that owns them; repeated ones
are masked.

A turn is written as ``<|im_start|>role``, a line break, the text, ``<|im_end|>`` and a line break.
Control strings inside roles and texts are escaped by a tilde and a digit, tildes by ``~0``, so no text
can forge a turn and everything reads back.

Prefix sums run in ordered slices (``plans.scan``), so one conversation may hold any number of turns.
Nulls and edges: a null text or role is empty; a null conversation id is a conversation of its own;
turns of one number are ordered by role and text, a null number comes first; rows that repeat are turns
of their own. A conversation of a system turn alone has one window. An empty table gives no rows.
Other columns, of any name, are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trialbook.llm import query
from trialbook.llm.text import WORD, table, whole, words
from trialbook.plans.scan import running
from trialbook.session import stage

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
# Strings that chat templates give a meaning to, in the order of their escapes ~1 to ~9.
CONTROL = [OPEN, CLOSE, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>"]
BUDGET, HISTORY, TURN_TOKENS = 1024, 256, 4


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("~"), F.lit("~0"))
    for i, control in enumerate(CONTROL):
        out = F.replace(out, F.lit(control), F.lit(f"~{i + 1}"))
    return out


def unescape(text: Column) -> Column:
    out = text
    for i, control in enumerate(CONTROL):
        out = F.replace(out, F.lit(f"~{i + 1}"), F.lit(control))
    return F.replace(out, F.lit("~0"), F.lit("~"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("~n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("~n"), F.lit("\n")))


def windows(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
    budget: int = BUDGET, history: int = HISTORY, tokens: Column | None = None,
) -> DataFrame:
    """(conv_id, window, formatted, spans, tokens, over_budget).

    ``spans`` has for each turn of the window its position in the conversation, the place and length
    of its text in ``formatted`` in characters, whether it is under the loss, and whether it is repeated.
    """
    n = F.size(words(F.col("text"))) if tokens is None else tokens
    rows = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), whole(role).alias("role"), whole(text).alias("text"))
    rows = rows.withColumn("n", (n + TURN_TOKENS).cast("long"))
    placed = running(rows, ["conv_id"], ["turn", "role", "text"], {"position": ("count", F.lit(1)), "upto": ("sum", "n")})
    placed = stage(placed.drop("turn"), "turns")

    is_system = (F.col("position") == 1) & (F.col("role") == "system")
    system = placed.filter(is_system).select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("text").alias("_text"), F.col("n").alias("_n"))
    sizes = system.select("_conv", "_n")
    body = placed.filter(~is_system).join(sizes, F.col("conv_id").eqNullSafe(F.col("_conv")), "left")
    before = F.coalesce("_n", F.lit(0))
    stride = F.greatest(F.lit(budget) - before - history, F.lit(budget // 4)).cast("long")
    spread = body.withColumns({"_stride": stride, "_end": F.col("upto") - before, "_begin": F.col("upto") - F.col("n") - before})
    owned = F.floor((F.col("_end") - 1) / F.col("_stride")).cast("long")
    last = F.floor((F.col("_begin") + history) / F.col("_stride")).cast("long")
    spread = spread.withColumn("owned", owned).withColumn("window", F.explode(F.sequence("owned", F.greatest(F.col("owned"), last))))
    own = ["conv_id", "window", "position", "role", "text", "n"]
    members = spread.select(*own, (F.col("window") > F.col("owned")).alias("repeated"))
    # Windows that own a turn start with the system turn; window 0 owns it.
    owning = spread.filter(F.col("window") == F.col("owned")).select("conv_id", "window").union(placed.filter(is_system).select("conv_id", F.lit(0).cast("long"))).distinct()
    first = owning.join(system, F.col("conv_id").eqNullSafe(F.col("_conv"))).select(
        "conv_id", "window", F.lit(1).cast("long").alias("position"), F.col("_role").alias("role"), F.col("_text").alias("text"), F.col("_n").alias("n"), (F.col("window") > 0).alias("repeated"))

    written = members.unionByName(first).withColumns({"head": F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n")), "body": escape(F.col("text"))})
    entry = F.struct("position", "head", "body", "n", "repeated", ((F.col("role") == "assistant") & ~F.col("repeated")).alias("loss"))
    grouped = written.groupBy("conv_id", "window").agg(F.sort_array(F.collect_list(entry)).alias("t"))
    grouped = grouped.filter(F.exists("t", lambda x: ~x["repeated"]))
    tail = CLOSE + "\n"
    # Lengths before each turn: a fold over the turns of one window, which the budget bounds.
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    starts = F.aggregate("t", start, lambda a, x: F.struct(
        (a["at"] + F.length(x["head"]) + F.length(x["body"]) + len(tail)).alias("at"),
        F.array_append(a["starts"], a["at"] + F.length(x["head"])).alias("starts")), lambda a: a["starts"])
    with_starts = grouped.withColumn("starts", starts)
    spans = F.zip_with("t", "starts", lambda x, s: F.struct(
        x["position"].alias("position"), s.alias("start"), F.length(x["body"]).alias("length"), x["loss"].alias("loss"), x["repeated"].alias("repeated")))
    total = F.aggregate("t", F.lit(0).cast("long"), lambda a, x: a + x["n"])
    formatted = F.array_join(F.transform("t", lambda x: F.concat(x["head"], x["body"], F.lit(tail))), "")
    return with_starts.select("conv_id", "window", formatted.alias("formatted"), spans.alias("spans"), total.alias("tokens"), (total > budget).alias("over_budget"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, position, role, text, loss_text): every turn once, parsed from the windows; ``loss_text`` is what
    the mask covers, null where it covers nothing."""
    turns = F.split("formatted", rf"\Q{CLOSE}\E\n", -1)
    one = formatted.select("conv_id", "formatted", F.explode(F.arrays_zip("spans", F.slice(turns, 1, F.size("spans")).alias("turns"))).alias("x"))
    one = one.select("conv_id", "formatted", F.col("x.spans").alias("span"), F.substring(F.col("x.turns"), len(OPEN) + 1, 2**31 - 1).alias("turn"))
    one = one.filter("NOT span.repeated")
    cut = F.locate("\n", F.col("turn"))
    loss = F.when(F.col("span.loss"), unescape(F.substring(F.col("formatted"), F.col("span.start") + 1, F.col("span.length"))))
    return one.select(
        "conv_id", F.col("span.position").alias("position"), unescape_role(F.substring(F.col("turn"), F.lit(1), cut - 1)).alias("role"),
        unescape(F.substring(F.col("turn"), cut + 1, F.length("turn"))).alias("text"), loss.alias("loss_text"))


def digests(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) as read back."""
    turns = F.sort_array(F.collect_list(F.struct("position", "role", "text", "loss_text")))
    whole_ = read_back(formatted).groupBy("conv_id").agg(turns.alias("t"))
    loss = F.array_join(F.transform("t", lambda x: F.coalesce(x["loss_text"], F.lit(""))), "")
    text = F.array_join(F.transform("t", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    whole_ = whole_.select(
        F.col("conv_id"), F.size("t").cast("long").alias("n_turns"), F.sha2(text, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"))
    lengths = formatted.groupBy(F.col("conv_id").alias("_c")).agg(F.sum(F.length("formatted")).alias("formatted_chars"))
    return whole_.join(lengths, F.col("conv_id").eqNullSafe(F.col("_c"))).drop("_c")


def _sql() -> str:
    escaped = "replace({}, '~', '~0')"
    for i, control in enumerate(CONTROL):
        escaped = f"replace({escaped}, '{control}', '~{i + 1}')"
    fixed = len(OPEN) + len(CLOSE) + 2
    return f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (SELECT *, len(regexp_extract_all(text, '{WORD}')) + {TURN_TOKENS} AS n,
  {fixed} + len(replace({escaped.format('role')}, chr(10), '~n')) + len({escaped.format('text')}) AS chars FROM c),
p AS (SELECT *, row_number() OVER w AS position, sum(n) OVER (w ROWS UNBOUNDED PRECEDING) AS upto FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
s AS (SELECT conv_id, n AS sn, chars AS schars FROM p WHERE position = 1 AND role = 'system'),
b AS (SELECT p.*, coalesce(sn, 0) AS sn, greatest({BUDGET} - coalesce(sn, 0) - {HISTORY}, {BUDGET // 4}) AS stride FROM p LEFT JOIN s USING (conv_id) WHERE NOT (position = 1 AND role = 'system')),
o AS (SELECT conv_id, chars, (upto - sn - 1)::BIGINT // stride AS own, (upto - n - sn + {HISTORY})::BIGINT // stride AS last FROM b),
e AS (SELECT conv_id, chars, own, unnest(generate_series(own, greatest(own, last))) AS win FROM o),
k AS (SELECT DISTINCT conv_id, own AS win FROM o UNION SELECT conv_id, 0 FROM s),
f AS (SELECT conv_id, sum(chars) AS formatted_chars FROM (SELECT conv_id, chars FROM e SEMI JOIN k USING (conv_id, win) UNION ALL SELECT conv_id, schars FROM k JOIN s USING (conv_id)) GROUP BY conv_id)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY position)) AS turns_sha256,
  coalesce(sum(len(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY position) FILTER (role = 'assistant'), '')) AS loss_sha256,
  any_value(formatted_chars)::BIGINT AS formatted_chars FROM p JOIN f USING (conv_id) GROUP BY conv_id"""


@query("op6_chat_windows", sql=_sql())
def _(spark, folder):
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", probe), (-1, 1, "assistant", probe)], turns.schema)
    return digests(stage(windows(turns.union(extra)), "windows"))
