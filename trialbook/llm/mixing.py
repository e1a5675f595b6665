"""Mixing sources by temperature.

A source with share x of the tokens gets weight x**a / sum(x**a). The exponent a lies between 0
(all sources alike) and 1 (as they come) and is found by bisection, either for a target entropy of
the weights or for a limit on how often the tokens of one source are repeated. Sums over sources
are Spark aggregates; five levels of the bisection are evaluated in a pass, and only sums come back.

Weights become token budgets. Without a total the budget is the smallest one in which every
document appears at least once, so nothing is lost by mixing. A source is dealt into blocks by a
hash of its ids. Each epoch is a permutation of its blocks, and of the documents within a block;
the last epoch ends where the budget does: whole blocks first, then documents of one block. So no
window is larger than a block, except over block totals, which run in ordered slices.

Nulls and edges: a null source is a source of its own; a null text has no tokens. Documents without
tokens cost nothing and come once per epoch; a source without any token is drawn once. Rows that
repeat are drawn each. An empty table gives no rows. Other columns are ignored or passed on.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trialbook.llm import query
from trialbook.llm.text import table, whole, words
from trialbook.plans.scan import running
from trialbook.session import stage

LEVELS, PASSES, DIGITS = 5, 8, 6
BLOCK_TOKENS = 100_000


def source_tokens(drawn: DataFrame) -> DataFrame:
    """(source, n_tokens, share): one row per source, summed before it is shuffled."""
    sums = stage(drawn.groupBy("source").agg(F.sum("tokens").alias("n_tokens")), "sums")
    total = sums.agg(F.sum("n_tokens")).first()[0]
    return sums.select("source", "n_tokens", (F.col("n_tokens") / F.lit(total)).alias("share"))


def exponent(shares: DataFrame, target_entropy: float | None = None, most_repeats: float | None = None) -> float:
    """The exponent, rounded to ``DIGITS`` digits, at which the entropy (in nats) is the target, or the
    largest ratio of repetitions between two sources is the limit. Targets out of reach give 0 or 1."""
    if (target_entropy is None) == (most_repeats is None):
        raise ValueError("give a target entropy or a limit of repetitions")
    x = F.col("share")
    low, high = 0.0, 1.0
    some = shares.filter("n_tokens > 0")
    for _ in range(PASSES):
        step = (high - low) / 2**LEVELS
        tried = [low + step * k for k in range(1, 2**LEVELS)]
        if most_repeats is None:
            sums = [c for i, a in enumerate(tried) for c in (
                F.sum(F.pow(x, F.lit(a))).alias(f"z{i}"), F.sum(F.pow(x, F.lit(a)) * F.log(x) * a).alias(f"s{i}"))]
        else:
            sums = [F.max(x).alias("most"), F.min(x).alias("least")]
        row = some.agg(F.count(F.lit(1)).alias("n"), *sums).first()
        if not row["n"]:
            return 1.0

        def too_flat(i: int) -> bool:
            if most_repeats is None:
                return math.log(row[f"z{i}"]) - row[f"s{i}"] / row[f"z{i}"] > target_entropy
            return (row["least"] / row["most"]) ** (tried[i] - 1) > most_repeats

        first, last = 0, 2**LEVELS  # in steps from low
        while last - first > 1:
            middle = (first + last) // 2
            if too_flat(middle - 1):
                first = middle
            else:
                last = middle
        low, high = low + step * first, low + step * last
    return round((low + high) / 2, DIGITS)


def budgets(shares: DataFrame, a: float, total: int | None = None) -> DataFrame:
    """(source, n_tokens, weight, budget, epochs): the tokens to draw from each source, and the number of
    epochs this takes, the last of which may be partial."""
    some = F.col("n_tokens") > 0
    power = F.when(some, F.pow(F.col("share"), F.lit(a))).otherwise(0.0)
    z, most = shares.agg(F.sum(power), F.max("share")).first()
    wanted = power / F.lit(z) * F.lit(float(total)) if total is not None else F.col("n_tokens") * F.pow(F.col("share") / F.lit(most), F.lit(a - 1.0))
    budget = F.when(some, F.floor(wanted + 0.5)).otherwise(0).cast("long")
    return shares.select(
        "source", "n_tokens", F.when(some, power / F.lit(z)).otherwise(0.0).alias("weight"), budget.alias("budget"),
    ).withColumn("epochs", F.when(F.col("n_tokens") > 0, F.ceil(F.col("budget") / F.col("n_tokens"))).otherwise(1).cast("long"))


def _digest(*parts: Column | str) -> Column:
    return F.md5(F.concat_ws("/", *[F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("-")) for p in parts]))


def draw(
    docs: DataFrame, doc_id: str = "doc_id", source: str = "source", tokens: Column | None = None, target_entropy: float | None = None,
    most_repeats: float | None = None, total: int | None = None, seed: int = 1, block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """(doc_id, source, tokens, epoch, block, block_rank, place): the documents drawn, once per epoch.

    Reading a source by (epoch, block_rank, place) gives its permutations. ``tokens`` counts the
    tokens of a row (words of the column ``text`` unless given).
    """
    count = F.size(words(whole("text"))) if tokens is None else tokens
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.coalesce(count, F.lit(0)).cast("long").alias("tokens"))
    narrow = stage(narrow.withColumn("_row", F.monotonically_increasing_id()), "lengths")
    shares = stage(source_tokens(narrow), "shares")
    plan = stage(budgets(shares, exponent(shares, target_entropy, most_repeats), total), "budgets")

    # Few sources hold many rows: the plan of a source goes to them by a join that AQE may split or broadcast.
    null_safe = narrow["source"].eqNullSafe(plan["source"])
    blocks_of = F.greatest(F.lit(1), F.ceil(F.col("n_tokens") / F.lit(block_tokens))).cast("long")
    key = _digest(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("row"), F.col("_row"))))
    block = F.pmod(F.conv(F.substring(key, 1, 8), 16, 10).cast("long"), blocks_of)
    dealt = narrow.join(plan, null_safe).select("doc_id", narrow["source"], "tokens", "_row", key.alias("_key"), block.alias("block"), "n_tokens", "budget", "epochs")

    sizes = dealt.groupBy("source", "block").agg(F.sum("tokens").alias("n"), F.first("n_tokens").alias("n_tokens"), F.first("budget").alias("budget"), F.first("epochs").alias("epochs"))
    each = sizes.filter("epochs > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("epochs") - 1)))
    each = each.withColumn("_order", _digest(F.lit(seed), "epoch", "source", "block"))
    total_ = running(each, ["source", "epoch"], ["_order", "block"], {"block_rank": ("count", F.lit(1)), "_upto": ("sum", "n")})
    # What the epoch may still hold when the block begins; all of it before the last epoch.
    room = F.col("budget") - F.col("epoch") * F.col("n_tokens") - (F.col("_upto") - F.col("n"))
    turns = total_.select(F.col("source").alias("_s"), F.col("block").alias("_b"), "epoch", "block_rank", F.when(F.col("n_tokens") == 0, 0).otherwise(room).alias("room"), F.col("n").alias("_n"))
    turns = turns.filter((F.col("room") > 0) | ((F.col("room") == 0) & (F.col("_n") == 0)) )

    rows = dealt.select("doc_id", "source", "tokens", "_row", "_key", "block").join(turns, F.col("source").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_b")))
    order = Window.partitionBy("source", "block", "epoch").orderBy(_digest("epoch", "_key"), "_row")
    placed = rows.withColumns({"place": F.row_number().over(order), "_sum": F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, 0))})
    return placed.filter(F.col("_sum") <= F.col("room")).select("doc_id", "source", "tokens", "epoch", "block", "block_rank", F.col("place").cast("long").alias("place"))


def mixed(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs``, with all their columns, as often as ``draw`` takes them."""
    count = F.size(words(whole(text)))
    taken = draw(docs, doc_id, source, count, **how).groupBy("doc_id", "source", "tokens").agg(F.count(F.lit(1)).alias("__times"))
    taken = taken.select(F.col("doc_id").alias("__i"), F.col("source").alias("__s"), F.col("tokens").alias("__t"), "__times")
    keyed = docs.withColumns({"__id": F.col(doc_id), "__source": F.col(source), "__tokens": count.cast("long")})
    joined = keyed.join(taken, F.col("__id").eqNullSafe(F.col("__i")) & F.col("__source").eqNullSafe(F.col("__s")) & (F.col("__tokens") == F.col("__t")))
    # Rows that agree in all three share the draws evenly.
    alike = Window.partitionBy("__i", "__s", "__t")
    shared = joined.withColumns({"__n": F.count(F.lit(1)).over(alike), "__k": F.row_number().over(alike.orderBy("__i"))})
    copies = F.floor(F.col("__times") / F.col("__n")) + (F.col("__k") <= F.col("__times") % F.col("__n")).cast("long")
    return shared.withColumn("__copies", copies).filter("__copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))).select(*docs.columns)


MOST_REPEATS = 4.0
_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS tokens FROM documents),
s AS (SELECT source, sum(tokens)::BIGINT AS n_tokens, sum(tokens) / sum(sum(tokens)) OVER () AS share FROM d GROUP BY source),
e AS (SELECT max(share) AS most, min(share) FILTER (n_tokens > 0) AS least FROM s),
bisect AS (SELECT 0 AS k, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high UNION ALL
  SELECT k + 1, CASE WHEN pow(least / most, (low + high) / 2 - 1) > {MOST_REPEATS} THEN (low + high) / 2 ELSE low END,
         CASE WHEN pow(least / most, (low + high) / 2 - 1) > {MOST_REPEATS} THEN high ELSE (low + high) / 2 END FROM bisect, e WHERE k < {LEVELS * PASSES}),
a AS (SELECT round((low + high) / 2, {DIGITS}) AS a FROM bisect WHERE k = {LEVELS * PASSES}),
p AS (SELECT source, n_tokens, CASE WHEN n_tokens > 0 THEN floor(n_tokens * pow(share / most, a - 1) + 0.5)::BIGINT ELSE 0 END AS budget FROM s, a, e),
q AS (SELECT *, CASE WHEN n_tokens > 0 THEN ceil(budget / n_tokens)::BIGINT ELSE 1 END AS epochs, greatest(1, ceil(n_tokens / {BLOCK_TOKENS}))::BIGINT AS blocks FROM p),
b AS (SELECT d.*, md5('1/' || doc_id) AS key, ('0x' || substr(md5('1/' || doc_id), 1, 8))::BIGINT % blocks AS block, n_tokens, budget, epochs FROM d JOIN q USING (source)),
t AS (SELECT source, block, sum(tokens)::BIGINT AS n, any_value(n_tokens) AS n_tokens, any_value(budget) AS budget, any_value(epochs) AS epochs FROM b GROUP BY ALL),
u AS (SELECT *, unnest(generate_series(0, epochs - 1)) AS epoch FROM t WHERE epochs > 0),
r AS (SELECT *, row_number() OVER w AS block_rank, CASE WHEN n_tokens = 0 THEN 0 ELSE budget - epoch * n_tokens - (sum(n) OVER w - n) END AS room FROM u
  WINDOW w AS (PARTITION BY source, epoch ORDER BY md5('1/' || epoch || '/' || source || '/' || block), block ROWS UNBOUNDED PRECEDING)),
l AS (SELECT b.doc_id, b.source, b.tokens, r.epoch, b.block, r.block_rank, r.room, row_number() OVER w AS place, sum(b.tokens) OVER w AS upto
  FROM b JOIN r ON b.source = r.source AND b.block = r.block AND (r.room > 0 OR (r.room = 0 AND r.n = 0))
  WINDOW w AS (PARTITION BY b.source, b.block, r.epoch ORDER BY md5(r.epoch || '/' || key), b.doc_id ROWS UNBOUNDED PRECEDING))
SELECT doc_id, source, tokens, epoch, block, block_rank, place FROM l WHERE upto <= room"""


@query("op5_temperature_mixing", sql=_SQL)
def _(spark, folder):
    return draw(table(spark, folder, "documents"), most_repeats=MOST_REPEATS)
