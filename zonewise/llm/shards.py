"""Even shards that keep linked documents together, by balanced label propagation."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonewise.llm.order import numbered
from zonewise.session import checkpointed

SHARDS, ROUNDS = 16, 12
#: Hubs of more than a quota's share 1 / _LARGE move member by member, others as one.
_LARGE = 32
#: Rounds may fill a shard by 1 / _SLACK beyond its quota; what is too much leaves it in the end.
_SLACK = 8
#: Groups of at most a quota's share 1 / _SMALL are let go as a whole where rounds leave them apart or a quota cuts them.
_SMALL = 4
#: A key with more than this share of all rows is met by broadcast; there are fewer such keys than 1 / _HOT.
_HOT = 0.001


def _met(rows: DataFrame, table: DataFrame, keys: list[str], size: str, total: int) -> DataFrame:
    """`rows` joined with `table`, which has a row for each of the keys and in `size` how many rows have it. No task
    gets all rows of a frequent key."""
    large = F.col(size) > _HOT * total
    hot = table.filter(large)
    apart = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(table.filter(~large), keys)
    return rows.join(F.broadcast(hot), keys).unionByName(apart)


def quotas(rows: int, shards: int) -> list[int]:
    """Rows of each shard: at most one apart."""
    return [rows // shards + (k < rows % shards) for k in range(shards)]


def granted(wanted: list[list[int]], room: list[int]) -> list[list[float]]:
    """Of the moves `wanted` from shard to shard, the share that leaves every shard within its room.

    What comes in may use the room and what goes out. All moves are granted at first; where too much comes in, that is
    cut, which lets less out elsewhere, until nothing needs a cut.
    """
    n = len(room)
    share = [[1.0] * n for _ in range(n)]
    for _ in range(200):
        flow = [[wanted[i][j] * share[i][j] for j in range(n)] for i in range(n)]
        came, went, cut = [sum(flow[i][j] for i in range(n)) for j in range(n)], [sum(flow[i]) for i in range(n)], False
        for j in range(n):
            may = max(room[j] + went[j], 0)
            if came[j] > may + 0.5:
                cut = True
                for i in range(n):
                    share[i][j] *= may / came[j]
        if not cut:
            break
    return share


def _uniform(x: Column, turn: int) -> Column:
    """A number in [0, 1) that `x` and the round decide."""
    return F.pmod(F.xxhash64(x, F.lit(turn)), F.lit(1 << 30)) / float(1 << 30)


def propagated(links: DataFrame, quota: list[int], rounds: int = ROUNDS) -> DataFrame:
    """(hub, node, pick, shard) after at most `rounds` rounds, from links with these columns.

    A hub stands for documents that are linked to each other, so its links are as many as its members and not as
    their pairs; a link of two is a hub of two. Each round counts every hub's members by shard and tells them to the
    members; a member wants the shard of most members that it is linked to, itself included, among its own and those
    that aren't full, ties by a hash of the hub; from a full shard it goes where other members are. The moves between shards, a table of shards x shards, are granted
    within the quotas, and made by hubs as far as these are small. `pick` is a number of the node that decides
    which members of a large hub move. A hub may hold most of the links: its counts are made before the shuffle, and
    its members are told of them without one.
    """
    n, low = len(quota), min(quota)
    votes = [f"v{k}" for k in range(n)]
    links = checkpointed(links, "links")
    total = links.count()
    for turn in range(rounds):
        held = dict(links.select("node", "shard").distinct().groupBy("shard").count().collect())
        room = [quota[k] + quota[k] // _SLACK + 1 - held.get(k, 0) for k in range(n)]
        hubs = links.groupBy("hub").agg(F.count("*").alias("size"), *[F.sum((F.col("shard") == k).cast("bigint")).alias(v) for k, v in enumerate(votes)])
        told = _met(links, checkpointed(hubs, "hubs"), ["hub"], "size", total).groupBy("node", "pick", "shard").agg(F.min("hub").alias("first"), *[F.sum(v).alias(v) for v in votes])
        # a full shard is no aim, and small hubs leave it if they have members elsewhere
        large = sum((F.col(v) for v in votes[1:]), F.col(votes[0])) * _LARGE > low

        def aim(k: int, v: str) -> Column:
            open_ = F.lit(room[k] > 0)
            rank = F.when(F.col("shard") == k, F.when(open_ | large, 1).otherwise(0)).when(open_ & (F.col(v) > 0), 1).otherwise(-1)
            return F.struct(rank.alias("rank"), F.col(v).alias("votes"), F.xxhash64("first", F.lit(k)).alias("tie"), F.lit(k).alias("to"))

        told = told.withColumns({"aim": F.array_max(F.array(*[aim(k, v) for k, v in enumerate(votes)])), "large": large})
        told = checkpointed(told.filter("aim.to != shard").select("node", "pick", "first", "shard", F.col("aim.to").alias("to"), "large"), "aims")
        wanted = [[0] * n for _ in range(n)]
        for r in told.groupBy("shard", "to").count().collect():
            wanted[r["shard"]][r["to"]] = r["count"]
        share = granted(wanted, room)
        if not any(map(any, wanted)):
            break
        at = F.array(*[F.array(*[F.lit(x) for x in row]) for row in share])
        luck = F.when(F.col("large"), _uniform(F.col("pick"), turn)).otherwise(_uniform(F.col("first"), turn))
        moves = told.filter(luck < F.element_at(F.element_at(at, F.col("shard") + 1), F.col("to") + 1)).select("node", "to")
        links = checkpointed(links.join(moves, "node", "left").select(
            "hub", "node", "pick", F.coalesce("to", "shard").cast("int").alias("shard")), "links")
    return links


def packed(sizes: dict[int, int], room: list[int]) -> dict[int, int]:
    """A shard with room for all its rows for each of a few groups, largest first; groups that fit nowhere are left out."""
    room, homes = list(room), {}
    for hub, size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        fits = [k for k, free in enumerate(room) if free >= size]
        if fits:
            homes[hub] = min(fits, key=lambda k: (room[k], k))
            room[homes[hub]] -= size
    return homes


def _filled(loose: DataFrame, room: list[int]) -> DataFrame:
    """`loose` with its place, group by group and rows without links last, and as home the shard whose room that is."""
    full = F.array(*[F.lit(e).cast("bigint") for e in accumulate(room)])
    placed = numbered(loose, [F.col("hub").asc_nulls_last(), F.col("pick"), F.col("node")])
    return placed.withColumn("home", F.size(F.filter(full, lambda e: e <= F.col("place"))).cast("int"))


def _housed(homes: DataFrame, quota: list[int]) -> DataFrame:
    """`homes` without nulls in `home`. Linked rows fill up what is left of the quotas; of these groups those at the
    border of two shards, fewer than shards, go where they fit whole. What fits nowhere and rows without links fill
    the rest."""
    kept, loose = homes.filter("home IS NOT NULL"), homes.filter("home IS NULL")

    def room(housed: DataFrame) -> list[int]:
        held = dict(housed.groupBy("home").count().collect())
        return [q - held.get(k, 0) for k, q in enumerate(quota)]

    free = room(kept)
    linked = _filled(loose.filter("hub IS NOT NULL"), free)
    edges = [e for e in accumulate(free) if e > 0]
    at = dict(linked.filter(F.col("place").isin(edges + [e - 1 for e in edges])).select("place", "hub").collect())
    border = {at[e] for e in edges if e in at and at[e] == at[e - 1]}
    sizes = dict(linked.filter(F.col("hub").isin(list(border))).groupBy("hub").count().collect())
    done = kept.unionByName(linked.filter(~F.col("hub").isin(list(border))).drop("place"))
    home = F.lit(None).cast("int")
    for hub, k in packed(sizes, room(done)).items():
        home = F.when(F.col("hub") == hub, F.lit(k)).otherwise(home)
    loose = loose.filter(F.col("hub").isNull() | F.col("hub").isin(list(border))).withColumn("home", home)
    done = done.unionByName(loose.filter("home IS NOT NULL"))
    return done.unionByName(_filled(loose.filter("home IS NULL"), room(done)).drop("place"))


def sharded(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row of `docs`: shards whose rows are at most one apart and
    which split few groups of equal texts.

    size counts the text's UTF-8 bytes and one more; slot is the row's place in its shard by doc_id, from 0. Rows
    start in the shard of a hash. Rows of equal texts are linked through a hub, and `propagated` brings them together.
    Groups that are still apart are let go, large ones excepted, with what a shard holds beyond its quota, smallest
    groups last; they and all rows without links fill up the shards as `_housed` says, so that few groups are cut.
    Nulls are empty texts; rows without an id count like others and come last in their shard; repeated rows are rows
    of their own. Other columns are not read.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), body.alias("t")).select(
        "doc_id", (F.octet_length("t") + 1).cast("bigint").alias("size"), F.crc32(F.col("t").cast("binary")).alias("text_crc32"),
        F.xxhash64("t").alias("a"), F.xxhash64(F.lit("text"), "t").alias("b"))
    rows = checkpointed(rows.withColumns({
        "node": F.monotonically_increasing_id(), "pick": F.xxhash64("doc_id", "a"),
        "shard": F.pmod(F.xxhash64("doc_id", "b"), F.lit(shards)).cast("int")}), "rows")
    total = rows.count()
    quota = quotas(total, shards)
    groups = checkpointed(rows.groupBy("a", "b").agg(F.min("node").alias("hub"), F.count("*").alias("size_of")).filter("size_of > 1"), "groups")
    links = propagated(_met(rows, groups, ["a", "b"], "size_of", total).select("hub", "node", "pick", "shard"), quota, rounds)
    parts = checkpointed(links.groupBy("hub", "shard").agg(F.count("*").alias("together")), "parts")
    # a small group stays if it is whole in its shard and within the quota
    parts = parts.join(parts.groupBy("hub").agg(F.sum("together").alias("of")), "hub").withColumn("small", F.col("of") * _SMALL <= min(quota))
    stay = checkpointed(parts.filter("together = of OR NOT small"), "stay")
    kept = numbered(checkpointed(_met(links, stay, ["hub", "shard"], "together", total), "linked"),
                    [F.col("together").desc(), F.col("hub"), F.col("pick"), F.col("node")], by="shard")
    limit = F.element_at(F.array(*[F.lit(q).cast("bigint") for q in quota]), F.col("shard") + 1)
    cut = [r["hub"] for r in kept.filter((F.col("place") == limit) & F.col("small")).select("hub").collect()]
    kept = checkpointed(kept.filter((F.col("place") < limit) & ~F.col("hub").isin(cut)).select("node", F.col("shard").alias("home")), "kept")
    homes = rows.join(kept, "node", "left").join(links.select("node", "hub"), "node", "left") \
        .select("doc_id", "size", "text_crc32", "pick", "home", "hub", "node")
    homes = checkpointed(homes, "homes")
    placed = checkpointed(_housed(homes, quota).select(
        "doc_id", "size", "text_crc32", F.col("home").alias("shard"), "pick", "node"), "placed")
    slots = numbered(placed, [F.col("doc_id").asc_nulls_last(), F.col("pick"), F.col("node")], by="shard", name="slot")
    return slots.select("doc_id", "size", "text_crc32", "shard", "slot")
