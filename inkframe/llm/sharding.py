"""Shards of equal size that keep linked documents together, by balanced label propagation.

Documents with one link key (by default: equal texts) are linked. Each linked document starts in a random shard. In a round the documents of a key
see by a join how many of them each shard holds, and move to the shard with most of them. Quotas say how many may enter: what fits beside those who leave in
the same round. A small group moves as a whole or not at all. A large one, which may be more than a shard holds, moves document by document, from shards with fewer of it to the one with
most that is not full of large groups yet; small groups then leave where they are crowded. What a shard has beyond its capacity at the end,
and the documents without links (propagation ends when less than a thousandth of all rows would move), fill all shards to counts at most one apart. Places come from one global order, so no task sees a shard whole.

What leaves the executors are sums over shards. A key is one row in each round; a frequent key's row is broadcast (there are at most HOT of these),
so that its documents stay where they are dealt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .ranks import ranked
from .scratch import Scratch

#: Keys that hold more than this part of all rows are frequent; there are at most as many as the part says.
HOT = 1000
ROUNDS = 10


def _unit(*what: Column) -> Column:
    """A number in [0, 1) from a hash."""
    return F.pmod(F.xxhash64(*what), F.lit(1 << 30)) / F.lit(float(1 << 30))


def _by_key(rows: DataFrame, keys: DataFrame, total: int) -> DataFrame:
    """rows joined with keys (key, n, ...), which holds a key once; n is how many of `total` rows have it, so that at most HOT keys are frequent."""
    often = F.col("n") * HOT > total
    hot = keys.where(often)
    ids = F.broadcast(hot.select("key"))
    return rows.join(F.broadcast(hot), "key").unionByName(rows.join(ids, "key", "left_anti").join(keys.where(~often), "key"))


def _of(values: list[int], shard: Column) -> Column:
    return F.get(F.array(*[F.lit(int(v)).cast("long") for v in values]), shard.cast("int"))


def _shares(flow: list[list[int]], room: list[int]) -> list[float]:
    """What part of those bound for each shard may go there: as much as fits beside what leaves it. flow[s][t]: from s to t."""
    k = len(room)
    share = [1.0] * k
    for _ in range(200):
        into = [sum(flow[s][t] for s in range(k)) for t in range(k)]
        out = [sum(flow[t][u] * share[u] for u in range(k)) for t in range(k)]
        share = [min(share[t], max(0.0, (room[t] + out[t]) / into[t])) if into[t] else 0.0 for t in range(k)]
    return share


def _propagate(linked: DataFrame, capacity: list[int], total: int, rounds: int, scratch: Scratch) -> DataFrame:
    """linked (rid, key) -> (rid, key, shard, large). A group is large if it has more than an eighth of a shard."""
    k = len(capacity)
    all_, large = range(k), F.col("n") * 8 > max(capacity)
    state = scratch.write(linked.select("rid", "key", F.pmod(F.xxhash64("rid", F.lit("first")), F.lit(k)).cast("int").alias("shard")), "state-0")
    near = slack = max(capacity) // 50  # the last places of a shard are filled when nothing else moves
    for step in range(1, rounds + 1):
        groups = state.groupBy("key").agg(F.count("*").alias("n"), *[F.count_if(F.col("shard") == s).alias(f"c{s}") for s in all_])
        groups = scratch.write(groups.withColumn("large", large), f"groups-{step}")
        load = {r["large"]: r for r in groups.groupBy("large").agg(*[F.sum(f"c{s}").alias(f"c{s}") for s in all_]).collect()}  # two rows
        by_large, by_small = ([load[b][f"c{s}"] if b in load else 0 for s in all_] for b in (True, False))
        beside = [c - n for c, n in zip(capacity, by_large, strict=True)]
        room = [b - n for b, n in zip(beside, by_small, strict=True)]
        # a large group goes where it is most, and on when a shard is full of large groups
        tie = [F.xxhash64("key", F.lit(s)) for s in all_]
        open_ = [F.struct(F.col(f"c{s}").alias("c"), F.lit(True).alias("r"), tie[s].alias("h"), F.lit(s).alias("s")) for s in all_ if beside[s] > slack]
        # a small one also, whole; from a shard that large ones crowd, some small groups have to go where there is room
        crowded = [F.lit(-min(room[s], 0)) > _unit(F.col("key"), F.lit(s), F.lit(step)) * by_small[s] for s in all_]
        whole = [F.struct(F.when(crowded[s], -1).otherwise(F.col(f"c{s}")).alias("c"), F.lit(room[s] > 0).alias("r"), tie[s].alias("h"), F.lit(s).alias("s")) for s in all_]
        best = F.array_max(F.array(*whole))
        groups = groups.withColumn("best", F.when(F.col("large"), F.array_max(F.array(*open_))).otherwise(best) if open_ else F.when(~F.col("large"), best))
        # where a large group has all but filled a shard it stays, but for what chance brought beyond its places
        beyond = [min(1.0, -b / n) if b < 0 else 0.0 for b, n in zip(beside, by_large, strict=True)]
        goes = [F.lit(bool(beyond[s])) | (F.struct(F.col(f"c{s}"), tie[s]) < F.struct("best.c", "best.h")) & ~(F.lit(beside[s] <= near) & (F.col(f"c{s}") * 2 > capacity[s])) for s in all_]
        leaves = [(F.col("best.s") != s) & (~F.col("large") | goes[s]) for s in all_]
        groups = groups.withColumn("leaves", F.array(*[F.coalesce(x & (F.col(f"c{s}") > 0), F.lit(False)) for s, x in enumerate(leaves)])).where(F.exists("leaves", lambda x: x))
        bound = groups.groupBy("large", F.col("best.s").alias("to")).agg(*[F.sum(F.when(F.get("leaves", F.lit(s)), F.col(f"c{s}")).otherwise(0)).alias(f"c{s}") for s in all_]).collect()  # a row for each shard, twice
        part = [b or 1.0 for b in beyond]
        wish = sum(r[f"c{s}"] * (part[s] if r["large"] else 1) for r in bound for s in all_)
        if not wish or slack == 0 and wish * 1000 < total:
            break
        slack = slack if wish * 1000 >= total and step < rounds // 2 else 0
        flow = {b: [[0] * k for _ in all_] for b in (True, False)}
        for r in bound:
            for s in all_:
                flow[r["large"]][s][r["to"]] = r[f"c{s}"] * (part[s] if r["large"] else 1)
        shares = {True: [min(1.0, beside[t] / n) if (n := sum(flow[True][s][t] for s in all_)) else 0.0 for t in all_]}
        net = [sum(flow[True][s][t] * shares[True][t] - flow[True][t][s] * shares[True][s] for s in all_) for t in all_]
        shares[False] = _shares(flow[False], [r - n for r, n in zip(room, net, strict=True)])
        let_in = F.when(F.col("large"), F.get(F.array(*map(F.lit, shares[True])), F.col("best.s"))).otherwise(F.get(F.array(*map(F.lit, shares[False])), F.col("best.s")))
        # a large group is let in document by document, a small one as a whole
        luck = F.when(F.col("large"), _unit(F.col("rid"), F.lit(step)) / F.get(F.array(*map(F.lit, part)), F.col("shard"))).otherwise(_unit(F.col("key"), F.lit(step)))
        told = scratch.write(groups.select("key", "n", "leaves", F.col("best.s").alias("to"), "large", let_in.alias("let_in")), f"moves-{step}")
        moved = _by_key(state, told, total).select("rid", "key", F.when(F.get("leaves", F.col("shard")) & (luck < F.col("let_in")), F.col("to")).otherwise(F.col("shard")).alias("shard"))
        often = F.col("n") * HOT > total
        rest = state.join(F.broadcast(told.where(often).select("key")), "key", "left_anti").join(told.where(~often).select("key"), "key", "left_anti")
        state = scratch.write(moved.unionByName(rest), f"state-{step}")
        scratch.drop(f"state-{step - 1}", f"groups-{step}", f"moves-{step}")
    sizes = state.groupBy("key").agg(F.count("*").alias("n"))
    return _by_key(state, sizes, total).select("rid", "key", "shard", large.alias("large"))


def shard_documents(docs: DataFrame, shards: int = 8, link: Column | None = None, rounds: int = ROUNDS) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, size, text_crc32, law ("rows"), shard, slot, grown_shard (null), linked (rows with its key).

    Counts of shards differ by at most one; slots of a shard are 0, 1, 2 and so on. size is the bytes of the text and 1. Rows with equal values of
    `link` are linked; a null link is none. Null texts count as empty ones, also as links by default. Rows with null or repeated doc_ids are rows like
    others. An empty table gives an empty result; other columns are ignored unless link names them.
    """
    scratch = Scratch(docs.sparkSession, "shards")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.xxhash64(text) if link is None else F.when(link.isNotNull(), F.xxhash64(link))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + F.lit(1).cast("long")).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), key.alias("key"))
    rows = scratch.write(rows.withColumn("rid", F.monotonically_increasing_id()), "rows")
    total = rows.count()
    capacity = [total // shards + (s < total % shards) for s in range(shards)]
    groups = scratch.write(rows.where("key is not null").groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "groups")
    linked = _by_key(rows.where("key is not null").select("rid", "key"), groups, total)
    state = _propagate(linked, capacity, total, rounds, scratch)
    placed = rows.join(state.select("rid", F.col("shard").alias("own"), "large"), "rid", "left")
    placed = placed.withColumn("own", F.coalesce("own", F.lit(shards))).withColumn("small", ~F.coalesce("large", F.lit(False))).withColumn("tie", F.coalesce("key", F.xxhash64("rid")))
    order = ranked(placed, ["own", "small", "tie", "rid"], scratch, "order")
    load = {r["own"]: r["n"] for r in placed.groupBy("own").agg(F.count("*").alias("n")).collect()}
    load = [load.get(s, 0) for s in range(shards)]
    held = [min(a, c) for a, c in zip(load, capacity, strict=True)]
    over = [a - h for a, h in zip(load, held, strict=True)]
    need = [c - h for c, h in zip(capacity, held, strict=True)]
    ahead = lambda xs: [sum(xs[:i]) for i in range(len(xs))]
    inside = F.col("rank") - _of(ahead([*load, 0]), F.col("own"))  # the place among the rows of one shard, or among those of none
    stays = (F.col("own") < shards) & (inside < _of([*held, 0], F.col("own")))
    free = F.when(F.col("own") < shards, _of([*ahead(over), 0], F.col("own")) + inside - _of([*held, 0], F.col("own"))).otherwise(F.lit(sum(over)) + inside)
    filled = ahead(need)
    given = F.lit(0)
    for s in range(1, shards):
        given = F.when(F.col("free") >= filled[s], s).otherwise(given)
    order = order.withColumn("free", F.when(~stays, free)).withColumn("given", given)
    shard = F.when(F.col("free").isNull(), F.col("own")).otherwise(F.col("given"))
    slot = F.when(F.col("free").isNull(), inside).otherwise(_of(held, F.col("given")) + F.col("free") - _of(filled, F.col("given")))
    return order.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), shard.cast("int").alias("shard"), slot.cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
