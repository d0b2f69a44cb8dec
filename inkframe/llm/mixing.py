"""Mixing of sources to target weights, in DataFrame operations only.

A source with T tokens gets the weight T**a / sum(T**a). The exponent a in [0, 1] (1: as they come, 0: all
alike) is found by repeated section: entropy and repetition fall as a rises. The weights are realised by
blocks. Documents fall into blocks of about block_tokens tokens by a hash, each source's blocks are permuted
by another, and the source's quota of the budget is filled in that order: whole rounds first, then whole
blocks, then documents of one last block.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from .scratch import Scratch

SECTIONS, ROUNDS = 32, 5
#: A token is a run of characters other than these.
TOKEN = "[^ \\t\\n\\x0B\\f\\r]+"


def _hash(*parts: Column) -> Column:
    """48 bits of an md5 sum."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 12), 16, 10).cast("long")


def _name() -> Column:
    """What a row's places are drawn from: its doc_id and text, so that rows without an id or with one id spread like others."""
    return F.concat_ws("|", F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("null")), F.md5(F.coalesce(F.col("text").cast("string"), F.lit(""))))


def source_totals(docs: DataFrame) -> DataFrame:
    return docs.groupBy("key").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs"))


def find_exponent(totals: DataFrame, entropy: float | None, repeats: float | None, budget: float | None) -> float:
    """The largest a whose weights reach `entropy` (a fraction of that of equal weights), but not below the least a at
    which no source is repeated more than `repeats` times. budget None: just enough for every source to be used whole.
    """
    use = totals.where("tokens > 0")
    seen = use.agg(F.count("*"), F.max("tokens"), F.min("tokens")).first()
    if not seen[0] or seen[1] == seen[2]:
        return 1.0
    n, most, least = seen

    def search(holds) -> float:
        """The border in [0, 1] below which holds(S0, S1, a) is true."""
        low, high = 0.0, 1.0
        for _ in range(ROUNDS):
            grid = [low + (high - low) * i / SECTIONS for i in range(SECTIONS + 1)]
            ratio = F.col("tokens") / F.lit(float(most))
            sums = use.select(F.explode(F.array(*map(F.lit, grid))).alias("a"), ratio.alias("r")).groupBy("a").agg(F.sum(F.pow("r", F.col("a"))).alias("s0"), F.sum(F.pow("r", F.col("a")) * F.log("r")).alias("s1"))
            told = {r["a"]: holds(r["s0"], r["s1"], r["a"]) for r in sums.collect()}  # one row per grid point
            if told[grid[-1]]:
                return grid[-1]
            if not told[grid[0]]:
                return grid[0]
            i = max(k for k, a in enumerate(grid) if told[a])
            low, high = grid[i], grid[i + 1]
        return low

    a = 1.0
    if entropy is not None:
        a = search(lambda s0, s1, x: math.log(s0) - x * s1 / s0 >= entropy * math.log(n))
    if repeats is not None:
        def too_many(s0: float, s1: float, x: float) -> bool:
            tokens = s0 * most if budget is None else budget
            return tokens * (least / most) ** x / s0 / least > repeats

        floor = search(too_many)
        a = max(a, floor + SECTIONS**-ROUNDS if 0 < floor < 1 else floor)
    return round(min(1.0, a), 6)


def plan_mix(docs: DataFrame, entropy: float | None = None, repeats: float | None = None, budget_tokens: int | None = None, keep_all: bool = False, block_tokens: int = 1 << 18, seed: str = "mix") -> DataFrame:
    """Per row of docs (doc_id, text, source): doc_id, source, n_tokens, weight, block, block_rank, copies.

    copies says how often the row is used within the budget: budget_tokens, by default all tokens once; with
    keep_all just enough that every source is used whole at least once, so that no copies are 0. Documents with
    a null source make a source of their own. Null and empty texts have 0 tokens and share the fate of their block;
    a source without tokens has weight 0 and keeps its rows once. Repeated rows are planned each on its own.
    An empty table gives an empty result. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    key = F.when(F.col("source").isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.col("source").cast("string")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(TOKEN)), F.lit(0)).cast("long").alias("n_tokens"), _name().alias("name")).withColumn("key", key)
    rows = scratch.write(rows, "rows")
    totals = scratch.write(source_totals(rows), "totals")
    seen = totals.agg(F.coalesce(F.sum("tokens"), F.lit(0)), F.coalesce(F.max("tokens"), F.lit(0))).first()
    budget = None if keep_all else seen[0] if budget_tokens is None else budget_tokens
    a = find_exponent(totals, entropy, repeats, budget)
    power = F.when(F.col("tokens") > 0, F.pow(F.col("tokens") / F.lit(float(max(seen[1], 1))), F.lit(a))).otherwise(0.0)
    whole = totals.agg(F.sum(power)).first()[0] or 1.0
    if budget is None:
        budget = seen[1] * whole
    weight = F.round(power / F.lit(whole), 9)
    quota = F.greatest(F.floor(weight * F.lit(float(budget)) + 0.5), F.col("tokens")) if keep_all else F.floor(weight * F.lit(float(budget)) + 0.5)
    sources = totals.select("key", "tokens", weight.alias("weight"), quota.cast("long").alias("quota"), F.greatest(F.lit(1), F.ceil(F.col("tokens") / F.lit(block_tokens))).cast("long").alias("blocks"))
    placed = rows.join(sources.select("key", "weight", "blocks"), "key").withColumn("block", F.pmod(_hash(F.lit(seed), "name"), F.col("blocks"))).drop("blocks")
    placed = scratch.write(placed, "placed")
    blocks = placed.groupBy("key", "block").agg(F.sum("n_tokens").alias("block_tokens")).join(sources.drop("weight", "blocks"), "key")
    # the blocks of a source in the order of a hash: first by its leading digits, so that no task orders all of them
    blocks = blocks.withColumn("place", F.md5(F.concat_ws("|", F.lit(seed), "key", "block"))).withColumn("part", F.substring("place", 1, 3))
    parts, ahead = blocks.groupBy("key", "part").agg(F.sum("block_tokens").alias("t"), F.count("*").alias("n")), Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("key", "part", F.coalesce(F.sum("t").over(ahead), F.lit(0)).alias("tokens_ahead"), F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("blocks_ahead"))
    order = Window.partitionBy("key", "part").orderBy("place", "block")
    before = F.col("tokens_ahead") + F.coalesce(F.sum("block_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    blocks = blocks.join(parts, ["key", "part"])
    blocks = blocks.select("key", "block", (F.col("blocks_ahead") + F.row_number().over(order)).cast("int").alias("block_rank"), F.when(F.col("tokens") > 0, F.floor(F.col("quota") / F.col("tokens"))).otherwise(1).cast("long").alias("rounds"), F.when(F.col("tokens") > 0, F.col("quota") % F.greatest("tokens", F.lit(1))).otherwise(0).alias("rest"), before.alias("before"))
    inside = Window.partitionBy("key", "block").orderBy(_hash(F.lit(seed), F.lit("doc"), "name"), "name").rowsBetween(Window.unboundedPreceding, 0)
    out = placed.withColumn("upto", F.sum("n_tokens").over(inside)).join(blocks, ["key", "block"])
    copies = F.col("rounds") + F.when((F.col("rest") > 0) & (F.col("before") + F.col("upto") <= F.col("rest")), 1).otherwise(0)
    return out.select("doc_id", "source", "n_tokens", "weight", "block", "block_rank", copies.cast("long").alias("copies"))


def apply_mix(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """docs with each row repeated as the plan says, in docs' columns. Rows with one doc_id and source share a plan."""
    uses = plan.groupBy("doc_id", "source").agg(F.max("copies").alias("__copies"))
    both = docs.alias("d").join(uses.alias("p"), F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")) & F.col("d.source").eqNullSafe(F.col("p.source")))
    many = both.where("__copies > 0").select("d.*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))).alias("__copy"))
    return many.drop("__copy")
