"""Shards by balanced label propagation over groups of linked documents."""

from __future__ import annotations

import heapq
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from safetymart.llm.common import GROUP_ROWS, ranked, stored

# Groups above this part of a shard are settled in the order of their sizes, to a factor
# of two; smaller ones may come together, since they find room in the end.
SMALL = 64


def assign_shards(
    docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every document's shard and its place there; shard sizes differ by one row at most.

    Equal texts are linked; a null text is linked with nothing. Documents start in
    shards by a hash. In rounds of label propagation (``propagate``) groups of linked
    documents then move to the shard that most of their members are in, under quotas of
    rows, until no group moves any more. Unlinked documents fill up what is left.

    A group that is larger than a quota fills whole shards first, and its rest is placed
    like a smaller group. A group is split otherwise only where no shard has room
    for it at the end: fewer than ``shards`` groups at any input. Both kinds are few
    (less than ``shards`` each), and only they are looked at one by one (``plan_blocks``).
    Columns: id_col, size (bytes of the text plus 16), text_crc32, law (``rows``),
    shard, slot (gapless from 0), grown_shard (null). Repeated rows each have a
    place; an empty table gives none; ids may be null and of any type that has an order.
    """
    text = F.col(text_col)
    raw = F.encode(F.coalesce(text, F.lit("")), "UTF-8")
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(raw) + 16).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.md5(F.encode(text, "UTF-8")).alias("key"),
    )
    rows = stored(rows, "rows")
    total = rows.count()
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    start = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")
    blocks = rows.filter("key IS NOT NULL").groupBy("key", start.alias("shard")).agg(
        F.count(F.lit(1)).alias("n")
    )
    strongest = F.max(F.struct("n", F.xxhash64("key", "shard"), "shard"))["shard"]
    blocks = stored(blocks, "blocks")
    groups = blocks.groupBy("key").agg(F.sum("n").alias("members"), strongest.alias("label"))
    groups = stored(groups.filter("members > 1"), "groups")

    large = F.col("members") > max(quota)
    split, room = _divided(groups.filter(large), quota)
    settled, room = propagate(blocks, groups.filter(~large), room)
    left = groups.filter(~large).join(settled, "key", "left_anti")
    rest, room = _divided(left, room)
    split = stored(split.unionByName(rest), "split")

    few = [r["key"] for r in split.select("key").distinct().collect()]
    linked = rows.filter(F.col("key").isin(few))
    others = rows.filter(F.col("key").isNotNull() & ~F.col("key").isin(few))
    moved = others.join(settled, "key", "left").select(*rows.columns, "shard")
    moved = stored(moved.unionByName(_members(linked, split)), "moved")
    placed = moved.filter("shard IS NOT NULL")
    unlinked = rows.filter("key IS NULL").unionByName(moved.filter("shard IS NULL").drop("shard"))
    order = [F.col(c) for c in ("id", "size", "text_crc32")]
    filled = ranked(unlinked.withColumn("all", F.lit(0)), ["all"], order, "place")
    ends, end = [], 0
    for free in room:
        end += free
        ends.append(end)
    shard = F.size(F.filter(F.array(*map(F.lit, ends)), lambda e: e <= F.col("place")))
    filled = filled.withColumn("shard", shard).select(*placed.columns)
    whole = stored(placed.unionByName(filled), "sharded")
    return ranked(whole, ["shard"], order, "slot").select(
        F.col("id").alias(id_col),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def propagate(
    blocks: DataFrame, groups: DataFrame, room: list[int]
) -> tuple[DataFrame, list[int]]:
    """Groups that came together in one shard (key, shard), and the room left in shards.

    ``blocks`` (key, shard, n) has where the members of a group start. In each round every
    open group proposes the shard in which most of its members are, among those with
    room for all of them; it proposes any shard with room if its members are in none. A
    shard admits its proposals, larger groups first, as far as its room goes. Admitted
    groups are settled, and the others propose again under the room then left.

    A proposal fits its shard alone, so that the first one of a shard is always
    admitted: rounds go on until no open group fits any shard. What stays open is then
    larger than every room, and fewer groups than shards if all rows have room. The
    driver sees one row for each shard and round.
    """
    spark, room = groups.sparkSession, list(room)
    share = max(room, default=0) // SMALL
    done = [spark.createDataFrame([], "key string, shard int")]
    while True:
        settled = done[0]
        for part in done[1:]:
            settled = settled.unionByName(part)
        fitting = groups.filter(F.col("members") <= max(room)).join(settled, "key", "left_anti")
        largest = fitting.agg(F.max("members")).first()[0]
        if largest is None:
            return settled, room
        above = largest // 2 if largest > share else 0
        proposed = _proposals(blocks, fitting.filter(F.col("members") > above), room, len(done))
        admitted = stored(_admitted(stored(proposed, "proposed"), room), "settled")
        for shard, members in admitted.groupBy("shard").agg(F.sum("members")).collect():
            room[shard] -= members
        done.append(admitted.select("key", "shard"))


def _at(numbers: list[int], index: Column) -> Column:
    return F.array(*(F.lit(n).cast("long") for n in numbers))[index]


def _proposals(blocks: DataFrame, fitting: DataFrame, room: list[int], seed: int) -> DataFrame:
    """(key, members, there, shard): the shard each group proposes; ``there`` of it are in."""
    known = fitting.select("key", "members")
    votes = blocks.join(known, "key").filter(_at(room, F.col("shard")) >= F.col("members"))
    best = F.max(F.struct("n", F.xxhash64("key", "shard"), "shard"))
    votes = votes.groupBy("key").agg(best.alias("best"))
    fits = F.filter(
        F.sequence(F.lit(0), F.lit(len(room) - 1)), lambda s: _at(room, s) >= F.col("members")
    )
    anywhere = fits[F.pmod(F.xxhash64("key", F.lit(seed)), F.size(fits)).cast("int")]
    return known.join(votes, "key", "left").select(
        "key",
        "members",
        F.coalesce("best.n", F.lit(0)).alias("there"),
        F.coalesce("best.shard", anywhere).cast("int").alias("shard"),
    )


def _admitted(proposed: DataFrame, room: list[int]) -> DataFrame:
    """Proposals whose shard has room for them after those before them.

    Running sums are taken in buckets of about ``GROUP_ROWS`` groups, after the sums of
    all earlier buckets, so that a shard's proposals need not be in one task.
    """
    most = proposed.groupBy("shard").count().agg(F.max("count")).first()[0] or 0
    buckets = max(1, math.ceil(most / GROUP_ROWS))
    dealt = proposed.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    earlier = W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    sums = dealt.groupBy("shard", "bucket").agg(F.sum("members").alias("all"))
    sums = sums.withColumn("before", F.coalesce(F.sum("all").over(earlier), F.lit(0)))
    largest_first = (
        W.partitionBy("shard", "bucket")
        .orderBy(F.desc("members"), F.desc("there"), "key")
        .rowsBetween(W.unboundedPreceding, 0)
    )
    summed = dealt.withColumn("until", F.sum("members").over(largest_first))
    summed = summed.join(sums.drop("all"), ["shard", "bucket"])
    fits = F.col("before") + F.col("until") <= _at(room, F.col("shard"))
    return summed.filter(fits).select("key", "members", "shard")


def _divided(groups: DataFrame, room: list[int]) -> tuple[DataFrame, list[int]]:
    """Blocks (key, shard, n) of fewer groups than shards, split over them, and the room left."""
    classes = groups.groupBy("members", "label").count().collect()
    plan = plan_blocks({(r["members"], r["label"]): r["count"] for r in classes}, room)
    room = list(room)
    for _, _, first, end, shard, n in plan:
        room[shard] -= (end - first) * n
    return _planned(groups, plan), room


Block = tuple[int, int, int, int, int, int]


def plan_blocks(classes: dict[tuple[int, int], int], quota: list[int]) -> list[Block]:
    """Where groups go: (members, label, first, end, shard, n) for ranks of a class.

    ``classes`` counts groups by (members, label); a group is known by its rank in its
    class. Sizes are placed from the largest down: a group stays in its label's shard
    if that has room for all of it, and goes to the fullest shard that has otherwise.
    A group above the quotas takes empty shards whole first. Groups that no shard
    has room for are dealt out last, over the shards with most room. Each of these
    is larger than any room left, and all fit together, so they are fewer than the shards.
    """
    room = list(quota)
    plan: list[Block] = []
    # (-size left, members, label, first, end): groups of one class not placed yet.
    queue = [(-m, m, label, 0, n) for (m, label), n in classes.items()]
    heapq.heapify(queue)
    late = []
    while queue:
        size = -queue[0][0]
        same = []
        while queue and -queue[0][0] == size:
            same.append(heapq.heappop(queue)[1:])
        if size > max(quota):
            for members, label, first, end in same:
                for rank in range(first, end):
                    left = size
                    for s in sorted(range(len(room)), key=lambda s: (s != label, s)):
                        if 0 < room[s] == quota[s] <= left:
                            plan.append((members, label, rank, rank + 1, s, room[s]))
                            left, room[s] = left - room[s], 0
                    if left and left < size:
                        heapq.heappush(queue, (-left, members, label, rank, rank + 1))
                    elif left:
                        late.append((left, members, label, rank))
            continue
        moving = []
        for members, label, first, end in same:
            stay = min(end - first, room[label] // size)
            if stay:
                plan.append((members, label, first, first + stay, label, size))
                room[label] -= stay * size
            if first + stay < end:
                moving.append((members, label, first + stay, end))
        fullest = sorted((s for s in range(len(room)) if room[s] >= size), key=lambda s: room[s])
        for members, label, first, end in moving:
            while first < end and fullest:
                s = fullest[0]
                go = min(end - first, room[s] // size)
                if go:
                    plan.append((members, label, first, first + go, s, size))
                    room[s] -= go * size
                    first += go
                else:
                    fullest.pop(0)
            late.extend((size, members, label, rank) for rank in range(first, end))
    for left, members, label, rank in late:
        while left:
            s = max(range(len(room)), key=lambda s: (room[s], s == label))
            n = min(left, room[s])
            plan.append((members, label, rank, rank + 1, s, n))
            left, room[s] = left - n, room[s] - n
    return plan


def _planned(groups: DataFrame, plan: list[Block]) -> DataFrame:
    """Blocks (key, shard, n) of the groups, by their ranks among those of size and label."""
    columns = "of_members long, of_label int, first long, end long, shard int, n long"
    ranges = groups.sparkSession.createDataFrame(plan, columns)
    numbered = ranked(groups, ["members", "label"], [F.col("key")])
    same = (F.col("members") == F.col("of_members")) & (F.col("label") == F.col("of_label"))
    inside = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("end"))
    joined = numbered.join(F.broadcast(ranges), same & inside)
    # A group's rest may have come to a shard that holds a part of it.
    return joined.groupBy("key", "shard").agg(F.sum("n").alias("n"))


def _members(linked: DataFrame, blocks: DataFrame) -> DataFrame:
    """The members of each group dealt out to its blocks, in the order of their ids.

    Fewer than twice as many groups as shards are split, each over the shards at most,
    which bounds what is broadcast.
    """
    before = W.partitionBy("key").orderBy("shard")
    ends = blocks.withColumn("end", F.sum("n").over(before)).select(
        F.col("key").alias("of"), "shard", (F.col("end") - F.col("n")).alias("begin"), "end"
    )
    order = [F.col(c) for c in ("id", "size", "text_crc32")]
    numbered = ranked(linked, ["key"], order)
    inside = (F.col("rank") >= F.col("begin")) & (F.col("rank") < F.col("end"))
    joined = numbered.join(F.broadcast(ends), (F.col("key") == F.col("of")) & inside)
    return joined.select(*linked.columns, "shard")
