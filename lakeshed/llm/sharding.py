"""Balanced label propagation: linked documents move towards their neighbours' shards under quotas.

Documents with equal texts are linked.  A round counts each group's members by
shard (a join of the members with their group's fullest shard), lets members
move there, and takes from each shard as many moves in as its unlinked documents
can make room for; unlinked documents then move from shards with too many rows
to shards with too few.  Law ``rows``: counts are at most one apart, at the
start and after every round.

Defined results: a null text counts as the empty text; repeated rows are
documents of their own and linked; an empty table gives no rows; a group larger
than a shard stays in several.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeshed.llm.common import bucket_count, stored, table, totals_before

SHARDS = 8
ROUNDS = 4
#: Groups with more than 1/HOT_SHARE of all rows are joined by broadcast; there are fewer than HOT_SHARE of them.
HOT_SHARE = 500
#: A number that ``propagated`` takes for the row's, if there is such a column.
ROW = "row number for sharding"
_HASH_SPAN = 1 << 32



def _ranked(df: DataFrame, group: list[str], buckets: int, salt: int, name: str) -> DataFrame:
    """Adds a gapless rank from 0 within ``group`` in the order of a hash of the row's number."""
    spread = df.withColumn("_hash", F.shiftrightunsigned(F.xxhash64("_row", F.lit(salt)), 32))
    spread = spread.withColumn("_bucket", F.floor(F.col("_hash") / (_HASH_SPAN // min(buckets, _HASH_SPAN))))
    return totals_before(spread, group, "_bucket", [F.col("_hash"), F.col("_row")], F.lit(1), name).drop("_hash", "_bucket")


def _fullest(members: DataFrame) -> DataFrame:
    """For each group of several rows: its count, and the shard that holds most of it (ties: by hash of group and shard)."""
    held = members.groupBy("group", "shard").agg(F.count("*").alias("n"))
    best = F.max(F.struct("n", F.xxhash64("group", "shard").alias("tie"), "shard"))
    return held.groupBy("group").agg(F.sum("n").alias("links"), best.alias("best")).filter("links > 1").select(F.col("group").alias("_group"), "links", F.col("best.shard").alias("wanted"))


def propagated(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """_row, doc_id, size, text_crc32, group, shard for each row of ``docs``.

    A round's state is written to the shared folder, so that lost executors cost
    no more than the round.  Only counts by shard reach the driver.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    row = F.col(ROW) if ROW in docs.columns else F.monotonically_increasing_id()
    rows = docs.select("doc_id", (F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.md5(text).alias("group"), row.alias("_row"))
    rows = stored(rows, "shard-rows")
    count = rows.count()
    buckets = bucket_count(count)
    ranked = _ranked(rows, [], buckets, 0, "_rank")
    state = ranked.withColumn("shard", (F.col("_rank") % shards).cast("int")).drop("_rank")
    sizes = rows.groupBy("group").agg(F.count("*").alias("n")).filter("n > 1")
    hot = stored(sizes.filter(F.col("n") > count // HOT_SHARE).select(F.col("group").alias("_group")), "shard-hot")
    state = state.join(F.broadcast(hot), F.col("group") == F.col("_group"), "left").withColumn("hot", F.col("_group").isNotNull()).drop("_group")
    state = stored(state, "shard-state")
    for turn in range(rounds):
        best = stored(_fullest(state), "shard-best")
        hot_best = best.join(F.broadcast(hot), "_group", "left_semi")
        common = state.filter("hot").join(F.broadcast(hot_best), F.col("group") == F.col("_group"))
        others = state.filter("not hot").join(best, F.col("group") == F.col("_group"), "left")
        state_plus = common.unionByName(others).drop("_group")
        state_plus = stored(state_plus.withColumn("moves", F.col("links").isNotNull() & (F.col("wanted") != F.col("shard"))), "shard-wishes")
        facts = {r["shard"]: r for r in state_plus.groupBy("shard").agg(F.count("*").alias("rows"), F.count_if(F.col("links").isNull()).alias("free")).collect()}
        wishes = {(r["shard"], r["wanted"]): r["n"] for r in state_plus.filter("moves").groupBy("shard", "wanted").agg(F.count("*").alias("n")).collect()}
        quota = _quotas(shards, {s: facts[s]["free"] if s in facts else 0 for s in range(shards)}, wishes)
        if not sum(quota.values()):
            break
        state = stored(_moved(state_plus, shards, buckets, turn, {s: facts[s]["rows"] if s in facts else 0 for s in range(shards)}, quota), "shard-state")
    return state.drop("hot")


def _quotas(shards: int, free: dict[int, int], wishes: dict[tuple[int, int], int]) -> dict[tuple[int, int], int]:
    """Moves allowed from shard to shard: all that are met by moves the other way, and beyond them as many as unlinked rows can make room for."""
    quota = {(a, b): min(n, wishes.get((b, a), 0)) for (a, b), n in wishes.items()}
    room = {s: max(0, n - 1) for s, n in free.items()}
    for (a, b), n in sorted(wishes.items(), key=lambda x: (-x[1], x[0])):
        more = min(n - quota[a, b], room.get(b, 0))
        quota[a, b] += more
        room[b] = room.get(b, 0) - more
    return quota


def _moved(state: DataFrame, shards: int, buckets: int, turn: int, rows: dict[int, int], quota: dict[tuple[int, int], int]) -> DataFrame:
    """Members move within the quotas; unlinked rows then even out the counts that this leaves."""
    allowed = F.create_map(*[F.lit(x) for (a, b), n in sorted(quota.items()) for x in (a * shards + b, n)])
    movers = _ranked(state.filter("moves"), ["shard", "wanted"], buckets, turn * 2 + 1, "_rank")
    goes = F.col("_rank") < F.coalesce(F.try_element_at(allowed, F.col("shard") * shards + F.col("wanted")), F.lit(0))
    movers = movers.withColumn("shard", F.when(goes, F.col("wanted")).otherwise(F.col("shard"))).drop("_rank")
    after = {s: rows[s] + sum(n for (a, b), n in quota.items() if b == s) - sum(n for (a, b), n in quota.items() if a == s) for s in range(shards)}
    total = sum(rows.values())
    order = sorted(range(shards), key=lambda s: (-after[s], s))
    aim = {s: total // shards + (i < total % shards) for i, s in enumerate(order)}
    leave = {s: max(0, after[s] - aim[s]) for s in range(shards)}
    slots, filled = [], 0  # the leaving rows, in the order of shard and rank, fill the shards with room in turn
    for s in range(shards):
        if after[s] < aim[s]:
            slots.append((filled + aim[s] - after[s], s))
            filled += aim[s] - after[s]
    first = {s: sum(leave[x] for x in range(s)) for s in range(shards)}
    at = F.element_at(F.array(*[F.lit(first[s]) for s in range(shards)]), F.col("shard") + 1) + F.col("_rank")
    to = F.col("shard")
    for through, s in reversed(slots):
        to = F.when(at < through, F.lit(s)).otherwise(to)
    free = _ranked(state.filter(F.col("links").isNull()), ["shard"], buckets, turn * 2 + 2, "_rank")
    leaves = F.col("_rank") < F.element_at(F.array(*[F.lit(leave[s]) for s in range(shards)]), F.col("shard") + 1)
    free = free.withColumn("shard", F.when(leaves, to).otherwise(F.col("shard"))).drop("_rank")
    stay = state.filter("links is not null and not moves")
    return movers.unionByName(free).unionByName(stay).drop("links", "wanted", "moves")


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, and how many rows share the text."""
    state = propagated(docs, shards)
    slotted = _ranked(state, ["shard"], bucket_count(state.count(), least=1024), -1, "slot")
    return slotted.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def with_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """The rows of ``docs`` with the column ``shard`` (in place of one of that name).

    Rows are written with a number of their own first, so that repeated ones can differ in shard.
    """
    numbered = stored(docs.drop("shard").withColumn(ROW, F.monotonically_increasing_id()), "shard-docs")
    placed = propagated(numbered, shards).select(F.col("_row").alias("row"), F.col("shard").alias("placed"))
    joined = numbered.join(placed, numbered[ROW] == placed["row"])
    return joined.select(*[numbered[c] for c in numbered.columns if c != ROW], placed["placed"].alias("shard"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(table(spark, sf_dir, "documents").select("doc_id", "text"))
