"""Places: joins by radius and nearest neighbour on a grid of cells, spread within groups, clusters.

A cell is as high as the radius and, at the latitude's band, at least as wide, so
a match lies in one of nine cells.  Both sides join on cells; distances are
exact.  Clusters join cells, not pairs of places.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshed.functions.values import EARTH_M, metres, planar_km
from lakeshed.operators.choosing import first_rows, modes
from lakeshed.operators.storing import stored

_METRES_A_DEGREE = math.pi * EARTH_M / 180


#: Pairs of rows that one task of a join on cells compares.
PAIRS = 4_000_000
#: Levels of boxes in a search for the nearest, each half as wide as the one before.
LEVELS = 11


def met(a: DataFrame, b: DataFrame, keys: list[str], pairs: int = PAIRS) -> DataFrame:
    """``a`` joined with ``b`` on the keys in tasks of about ``pairs`` pairs each: pairs are counted first, as rows and bytes don't tell them.

    A key with more pairs is cut into parts of both sides, and each part meets each.
    Stored places take up few bytes, by which Spark would send a side of many rows whole through the driver.
    """
    count = lambda df, name: df.groupBy(*keys).agg(F.count("*").alias(name))
    work = stored(count(a, "_m").join(count(b, "_n").hint("merge"), keys).select(*keys, (F.col("_m") * F.col("_n")).alias("_w")), "pairs")
    total, most = work.agg(F.coalesce(F.sum("_w"), F.lit(0)), F.coalesce(F.max("_w"), F.lit(0))).first()
    if total <= pairs:
        return a.join(b.hint("merge"), keys)
    tasks, by = int(min(total // pairs + 8, 20_000)), list(keys)
    if most > pairs:
        heavy = F.broadcast(work.filter(F.col("_w") > pairs).select(*keys, F.ceil(F.sqrt(F.col("_w") / pairs)).alias("_cut")))  # at most total / pairs rows

        def cut(df: DataFrame, own: str, other: str) -> DataFrame:
            rows = df.withColumn("_h", F.xxhash64(*df.columns)).join(heavy, keys, "left").withColumn("_cut", F.coalesce("_cut", F.lit(1)))
            return rows.withColumns({own: F.pmod("_h", "_cut"), other: F.explode(F.sequence(F.lit(0).cast("long"), F.col("_cut") - 1))}).drop("_h", "_cut")

        a, b, by = cut(a, "_i", "_j"), cut(b, "_j", "_i"), [*keys, "_i", "_j"]
    return a.repartition(tasks, *by).join(b.repartition(tasks, *by).hint("merge"), by).drop("_i", "_j")


def _cells(lat: Column, lon: Column, radius: float | Column, around: bool) -> Column:
    """The cell of a place, or the nine cells around it.  Columns of cells are as wide as the radius at the band's far edge."""
    height = radius / _METRES_A_DEGREE
    y = F.floor(lat / height)

    def cell(row: Column, near: list[int]) -> Column:
        edge = F.least(F.greatest(F.abs(row), F.abs(row + 1)) * height, F.lit(89.9))
        x = F.floor(lon / (height / F.cos(F.radians(edge))))
        return F.array(*[F.struct(row.alias("y"), (x + k).alias("x")) for k in near])

    if not around:
        return cell(y, [0])
    return F.concat(*[cell(y + k, [-1, 0, 1]) for k in (-1, 0, 1)])


def within(left: DataFrame, right: DataFrame, lid: str, rid: str, radius: float, on: list[str] = (), lat: str = "lat", lon: str = "lon", own: list[str] = (), other: list[str] = ()) -> DataFrame:
    """Pairs of places at most ``radius`` metres apart: lid, rid, ``on``, distance, then the columns ``own`` of left and ``other`` of right.  Null coordinates match nothing."""
    a = left.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(F.col(lid).alias("_l"), *on, *own, F.col(lat).alias("_lat1"), F.col(lon).alias("_lon1"), F.explode(_cells(F.col(lat), F.col(lon), radius, True)).alias("_cell"))
    b = right.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(F.col(rid).alias("_r"), *on, *other, F.col(lat).alias("_lat2"), F.col(lon).alias("_lon2"), F.explode(_cells(F.col(lat), F.col(lon), radius, False)).alias("_cell"))
    level = F.abs(F.col("_lat1") - F.col("_lat2")) <= radius / _METRES_A_DEGREE * (1 + 1e-9)  # cheaper than the distance
    pairs = met(a, b, ["_cell", *on]).filter(level).withColumn("distance", metres(F.col("_lat1"), F.col("_lon1"), F.col("_lat2"), F.col("_lon2")))
    return pairs.filter(F.col("distance") <= radius).select(F.col("_l").alias(lid), F.col("_r").alias(rid), *on, "distance", *own, *other)


def _box(lat: Column, lon: Column, radius: float | Column) -> Column:
    """A cell of which no two places are ``radius`` metres apart."""
    side = radius / 1.5 / _METRES_A_DEGREE
    y = F.floor(lat / side)
    edge = F.least(F.least(F.abs(y), F.abs(y + 1)) * side, F.lit(89.9))  # the band's widest edge
    return F.struct(y.alias("y"), F.floor(lon / (side / F.cos(F.radians(edge)))).alias("x"))


def nearest_within(left: DataFrame, right: DataFrame, lid: str, rid: str, radius: float, k: int = 1, on: list[str] = ()) -> DataFrame:
    """Each place's k nearest within the radius, by distance, then id.

    A place looks no farther than it must: a box around it that holds k others of its
    group bounds the distance.  Boxes halve from level to level; others at one spot beyond
    the k smallest ids are out of question.
    """
    lat, lon = F.col("lat"), F.col("lon")
    placed = lambda df: df.filter("lat is not null and lon is not null")
    levels = [radius / 2**n for n in range(LEVELS)]
    sized = lambda df: df.withColumn("_r", F.explode(F.array(*map(F.lit, levels))))
    points = stored(sized(first_rows(placed(right).select(rid, *on, "lat", "lon"), [*on, "lat", "lon"], [F.asc(rid)], k)), "points")
    full = points.groupBy(*on, "_r", _box(lat, lon, F.col("_r")).alias("_cell")).agg(F.count("*").alias("_n")).filter(F.col("_n") >= k).drop("_n")
    asked = placed(left).select(F.col(lid).alias("_l"), *on, "lat", "lon")
    tight = sized(asked).withColumn("_cell", _box(lat, lon, F.col("_r"))).join(full.hint("merge"), [*on, "_r", "_cell"]).groupBy("_l", *on, "lat", "lon").agg(F.min("_r").alias("_r"))
    far = asked.join(tight.hint("merge"), ["_l", *on, "lat", "lon"], "left").withColumn("_r", F.coalesce("_r", F.lit(radius)))
    a = stored(far.withColumnsRenamed({"lat": "_lat1", "lon": "_lon1"}), "asked")
    a = a.withColumn("_cell", F.explode(_cells(F.col("_lat1"), F.col("_lon1"), F.col("_r"), True)))
    b = points.select(F.col(rid).alias("_id"), *on, "_r", lat.alias("_lat2"), lon.alias("_lon2"), F.explode(_cells(lat, lon, F.col("_r"), False)).alias("_cell"))
    pairs = met(a, b, [*on, "_r", "_cell"]).withColumn("distance", metres(F.col("_lat1"), F.col("_lon1"), F.col("_lat2"), F.col("_lon2")))
    pairs = pairs.filter((F.col("distance") <= radius) & (F.col("distance") <= F.col("_r") * (1 + 1e-9))).select(F.col("_l").alias(lid), F.col("_id").alias(rid), *on, "distance")
    return first_rows(pairs, [lid], [F.asc("distance"), F.asc(rid)], k)


def close_pairs(df: DataFrame, identity: str, radius: float, on: list[str]) -> DataFrame:
    """Pairs (a < b) of one group at most ``radius`` apart."""
    return within(df.withColumnRenamed(identity, "a"), df.withColumnRenamed(identity, "b"), "a", "b", radius, on).filter("a < b")


def planar_nearest(left: DataFrame, known: DataFrame, rid: str, carry: list[str], k: int, guard_km: float, levels: int = 10, pairs: int = PAIRS // 2) -> DataFrame:
    """(lat, lon, rid, carry, km): the k nearest known places of each spot of ``left`` by planar distance, within the guard, by distance, then id.

    A spot looks no farther than it must: the smallest cell around it that holds k
    known places bounds the distance by its diagonal.  Cells halve from level to
    level; places at one spot beyond the k smallest ids are out of question.
    """
    reach = guard_km / 111
    placed = lambda df: df.filter("lat is not null and lon is not null")
    spots = placed(left).select("lat", "lon").distinct()
    points = first_rows(placed(known), ["lat", "lon"], [F.asc(rid)], k).select(rid, *carry, F.col("lat").alias("_lat"), F.col("lon").alias("_lon"))
    halved = F.explode(F.array(*[F.struct(F.lit(n).alias("n"), F.lit(reach / 2**n * (1 + 1e-9)).alias("r")) for n in range(levels + 1)]))
    cell = lambda x, side: F.floor(x / side)
    diagonal = F.col("_l.r") / math.sqrt(2)
    full = points.select(halved.alias("_l"), "_lat", "_lon").groupBy("_l", cell(F.col("_lat"), diagonal).alias("_y"), cell(F.col("_lon"), diagonal).alias("_x")).agg(F.count("*").alias("_n")).filter(F.col("_n") >= k)
    own = spots.select("lat", "lon", halved.alias("_l")).withColumns({"_y": cell(F.col("lat"), diagonal), "_x": cell(F.col("lon"), diagonal)})
    tight = own.join(full.select("_l", "_y", "_x"), ["_l", "_y", "_x"]).groupBy("lat", "lon").agg(F.max("_l").alias("_l"))
    wide = F.struct(F.lit(0).alias("n"), F.lit(reach * (1 + 1e-9)).alias("r"))
    level = spots.join(tight, ["lat", "lon"], "left").withColumn("_l", F.coalesce("_l", wide))
    near = [(dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1)]
    around = F.explode(F.array(*[F.struct((cell(F.col("lat"), F.col("_l.r")) + dy).alias("y"), (cell(F.col("lon"), F.col("_l.r")) + dx).alias("x")) for dy, dx in near]))
    asked = level.select("lat", "lon", "_l", around.alias("_c"))
    dealt = points.withColumn("_l", halved).withColumn("_c", F.struct(cell(F.col("_lat"), F.col("_l.r")).alias("y"), cell(F.col("_lon"), F.col("_l.r")).alias("x")))
    pairs = met(asked, dealt, ["_l", "_c"], pairs).withColumn("km", planar_km(F.col("lat"), F.col("lon"), F.col("_lat"), F.col("_lon")))
    pairs = pairs.filter((F.col("km") <= guard_km) & (F.col("km") <= F.col("_l.r") * 111 * (1 + 1e-9)))
    return first_rows(pairs.select("lat", "lon", rid, *carry, "km"), ["lat", "lon"], [F.asc("km"), F.asc(rid)], k)


def vote(left: DataFrame, labelled: DataFrame, lid: str, rid: str, label: str, k: int, guard_km: float) -> DataFrame:
    """The label that most of a place's k nearest have (planar distance), none if the nearest lies beyond the guard."""
    best = modes(planar_nearest(left, labelled, rid, [label], k, guard_km), ["lat", "lon"], label)
    return left.select(lid, "lat", "lon").join(best, ["lat", "lon"]).select(lid, label, "n")


def spread(df: DataFrame, group: str, identity: str) -> DataFrame:
    """The largest distance between two places of a group, 0 for one place.

    Pairs are of the group's hull candidates alone: its extreme places along 16
    directions, which hold the farthest pair but for a share of a degree.
    """
    angles = [math.pi * k / 16 for k in range(16)]
    points = df.filter("lat is not null and lon is not null").select(group, "lat", "lon", F.xxhash64("lat", "lon").alias("_k"))
    along = [F.col("lat") * math.sin(a) + F.col("lon") * math.cos(a) * F.cos(F.radians("lat")) for a in angles]
    # ends go by a number: sums of rows by group are hashed only if they hold numbers, and sort all rows otherwise
    ends = points.groupBy(group).agg(F.array_distinct(F.array(*[f("_k", x) for x in along for f in (F.max_by, F.min_by)])).alias("_k"))
    hull = points.join(ends.select(group, F.explode("_k").alias("_k")), [group, "_k"]).groupBy(group).agg(F.collect_set(F.struct("lat", "lon")).alias("p"))
    far = F.array_max(F.flatten(F.transform("p", lambda a: F.transform("p", lambda b: metres(a["lat"], a["lon"], b["lat"], b["lon"])))))
    return hull.select(group, F.coalesce(far, F.lit(0.0)).alias("spread"))


def exact_spread(df: DataFrame, group: str, identity: str) -> DataFrame:
    """The largest distance of two places of a group, 0 for one.

    With a pair at distance D and all places within R of a centre, both ends of
    the farthest pair lie at least D - R from it.  Only such places are paired.
    """
    points = stored(df.filter("lat is not null and lon is not null").select(group, "lat", "lon").distinct(), "spots")  # places at one spot are one
    centre = points.groupBy(group).agg(((F.min("lat") + F.max("lat")) / 2).alias("_lat"), ((F.min("lon") + F.max("lon")) / 2).alias("_lon"))
    away = points.join(centre, group).withColumn("_r", metres(F.col("lat"), F.col("lon"), F.col("_lat"), F.col("_lon")))
    bound = spread(points, group, identity).join(away.groupBy(group).agg(F.max("_r").alias("_most")), group)
    outer = stored(away.join(bound, group).filter(F.col("_r") >= F.col("spread") * (1 - 1e-6) - F.col("_most") - 0.01).select(group, "lat", "lon"), "outer")  # read twice
    a = outer.select(group, F.col("lat").alias("_lat1"), F.col("lon").alias("_lon1"))
    b = outer.select(group, F.col("lat").alias("_lat2"), F.col("lon").alias("_lon2"))
    far = a.join(b, group).filter("_lat1 <= _lat2").groupBy(group).agg(F.max(metres(F.col("_lat1"), F.col("_lon1"), F.col("_lat2"), F.col("_lon2"))).alias("spread"))
    return far.select(group, F.coalesce("spread", F.lit(0.0)).alias("spread"))


def connected(edges: DataFrame, nodes: DataFrame, identity: str) -> DataFrame:
    """Each node's component, its smallest id: labels pass along edges to all that share them, and jump; raises if they don't settle.

    What one member of a group of one label learns its whole group takes, so long chains of groups need few rounds.
    """
    both = stored(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b"), F.col("a"))).distinct(), "edges")  # read every round
    labels = stored(nodes.select(F.col(identity).alias("u"), F.col(identity).alias("component")), "labels")
    for _ in range(100):
        least = both.join(labels.withColumnRenamed("u", "v"), "v").groupBy("u").agg(F.min("component").alias("near"))
        group = labels.join(least, "u").groupBy("component").agg(F.min("near").alias("near"))
        moved = labels.join(group, "component", "left").select("u", F.least("component", F.coalesce("near", "component")).alias("component"))
        jumped = moved.join(moved.select(F.col("u").alias("component"), F.col("component").alias("far")), "component", "left")
        now = stored(jumped.select("u", F.coalesce("far", "component").alias("component")))
        same = now.join(labels.withColumnRenamed("component", "was"), "u").filter("component <> was").isEmpty()
        labels = now
        if same:
            return labels.select(F.col("u").alias(identity), "component")
    raise RuntimeError("components did not settle")


def clustered(df: DataFrame, identity: str, radius: float) -> DataFrame:
    """(identity, component): places joined by steps of at most ``radius`` metres, under the smallest id; those without a place stand alone.

    Places in a cell whose diagonal is below the radius are one node, so no pairs are
    listed.  Nodes are linked by their first places; what this leaves apart is
    compared by those places of two nodes that lie within the radius of the other's box.
    """
    cell = _box(F.col("lat"), F.col("lon"), radius)
    placed = stored(df.filter("lat is not null and lon is not null").select(F.col(identity).alias("_id"), "lat", "lon", cell.alias("_cell")), "places")
    spots = placed.groupBy("_cell", "lat", "lon").agg(F.min("_id").alias("_id"))
    box = [f(x).alias(f"_{f.__name__}_{x}") for f in (F.min, F.max) for x in ("lat", "lon")]
    nodes = stored(spots.groupBy("_cell").agg(F.min(F.struct("_id", "lat", "lon")).alias("_p"), *box), "nodes").select("_cell", "_p.*", *[f"_{f}_{x}" for f in ("min", "max") for x in ("lat", "lon")])
    name = lambda df, k: df.withColumnRenamed("_id", k)
    near = stored(within(name(nodes, "a"), name(nodes, "b"), "a", "b", 3 * radius).filter("a < b"), "near")  # a place lies at most 2 / 1.5 * sqrt(1 / 2) radii from its node's first
    links = near.filter(F.col("distance") <= radius).select("a", "b")
    parts = connected(links, nodes, "_id")
    of = lambda k: parts.select(F.col("_id").alias(k), F.col("component").alias(f"_{k}"))
    apart = near.join(of("a"), "a").join(of("b"), "b").filter("_a <> _b").select("a", "b")
    reach = radius * (1 + 1e-9)
    members = spots.select("_cell", "lat", "lon").join(nodes.select("_cell", "_id"), "_cell").drop("_cell")
    boxes = nodes.select("_id", *[f"_{f}_{x}" for f in ("min", "max") for x in ("lat", "lon")])

    def facing(own: str, other: str) -> DataFrame:
        """Places of one node that may reach the other's box."""
        rows = apart.join(boxes.withColumnRenamed("_id", other), other).join(members.withColumnRenamed("_id", own), own)
        off = F.greatest(F.col("_min_lat") - F.col("lat"), F.col("lat") - F.col("_max_lat"), F.lit(0.0))
        aside = F.greatest(F.col("_min_lon") - F.col("lon"), F.col("lon") - F.col("_max_lon"), F.lit(0.0))
        far = F.greatest(F.abs("lat"), F.abs("_min_lat"), F.abs("_max_lat"))
        short = metres(F.lit(0.0), F.lit(0.0), F.lit(0.0), aside) * F.cos(F.radians(far)) * (1 - 1e-6)  # no more than the way there
        return rows.filter((off * _METRES_A_DEGREE <= reach) & ((aside > 15) | (short * 0.99 <= reach))).select("a", "b", F.col("lat").alias(f"_lat_{own}"), F.col("lon").alias(f"_lon_{own}"))

    pairs = facing("a", "b").join(facing("b", "a"), ["a", "b"])
    more = pairs.filter(metres(F.col("_lat_a"), F.col("_lon_a"), F.col("_lat_b"), F.col("_lon_b")) <= radius).select("a", "b").distinct()
    whole = connected(parts.filter("_id <> component").select(F.col("_id").alias("a"), F.col("component").alias("b")).union(more), nodes, "_id")
    found = placed.select("_cell", "_id").join(nodes.select("_cell", F.col("_id").alias("_n")), "_cell").join(whole.withColumnRenamed("_id", "_n"), "_n").select(F.col("_id").alias(identity), "component")
    return df.select(identity).join(found, identity, "left").select(identity, F.coalesce("component", identity).alias("component"))


def owners(links: DataFrame, child: str, parent: str) -> DataFrame:
    """Each child's last owner along the chain of parents, the smallest parent where a child has several; a cycle ends at its smallest name.

    Steps double each round, and with them the smallest name passed on the way.
    Chains of n links end after log2(n) rounds; what still moves then lies in a
    cycle or leads to one.
    """
    now = stored(links.groupBy(F.col(child).alias("c")).agg(F.min(parent).alias("p")).withColumn("least", F.col("p")))
    count, steps = now.count(), 1
    while steps <= count:
        ahead = now.select(F.col("c").alias("_c"), F.col("p").alias("_p"), F.col("least").alias("_least"))
        moved = now.join(ahead, F.col("p") == F.col("_c"), "left")
        then = stored(moved.select("c", F.coalesce("_p", "p").alias("p"), F.least("least", F.coalesce("_least", "least")).alias("least")))
        settled = then.join(now.select(F.col("c").alias("_c"), F.col("p").alias("_p")), (F.col("c") == F.col("_c")) & (F.col("p") != F.col("_p"))).isEmpty()
        now, steps = then, 2 * steps
        if settled:
            break
    goes_on = now.select(F.col("c").alias("_c"), F.col("least").alias("_least"))  # the smallest name ahead of a place in a cycle is the cycle's
    return now.join(goes_on, F.col("p") == F.col("_c"), "left").select(F.col("c").alias(child), F.coalesce("_least", "p").alias("owner"))


def with_survivors(clusters: DataFrame, identity: str, component: str, placed: Column) -> DataFrame:
    """Adds ``survivor``, the one of a cluster that stays, and ``kept``: those with a resolved area first, then the newest (largest) id."""
    best = clusters.groupBy(component).agg(F.max_by(identity, F.struct(F.coalesce(placed, F.lit(False)), F.col(identity))).alias("survivor"))
    return clusters.join(best, component).withColumn("kept", F.col(identity) == F.col("survivor"))
