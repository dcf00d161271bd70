"""Sets, upserts, snapshots and their differences."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeshed.functions.text import compared
from lakeshed.functions.values import differs, is_outlier, percent_change
from lakeshed.operators.choosing import first_rows
from lakeshed.operators.storing import stored


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def union_by_precedence(frames: list[DataFrame], keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key, from the earliest frame that has it."""
    tagged = [f.withColumn("_from", F.lit(k)) for k, f in enumerate(frames)]
    return first_rows(union_all(*tagged), keys, [F.asc("_from"), *order]).drop("_from")


def first_sources(frames: dict[str, DataFrame], key: str) -> DataFrame:
    """Each key with the first source that has it: what a source adds to those before it."""
    rows = union_all(*[f.select(key).distinct().withColumns({"_k": F.lit(k), "source": F.lit(name)}) for k, (name, f) in enumerate(frames.items())])
    return rows.groupBy(key).agg(F.min_by("source", "_k").alias("source"), F.count("*").alias("sources"))


def compared_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Each key and whether left, right or both hold it."""
    a, b = left.select(F.col(key).alias("_l")).distinct(), right.select(F.col(key).alias("_r")).distinct()
    side = F.when(F.col("_r").isNull(), "left").when(F.col("_l").isNull(), "right").otherwise("both")
    return a.join(b, F.col("_l") == F.col("_r"), "full_outer").select(F.coalesce("_l", "_r").alias(key), side.alias("side"))


def upserted(base: DataFrame, new: DataFrame, keys: list[str], keep: list[str] = ()) -> DataFrame:
    """New rows replace those with their keys; columns in ``keep`` keep the old value where the new one is null."""
    values = [c for c in base.columns if c not in keys]
    a = base.select(*[F.col(c).alias(f"_a_{c}") for c in base.columns], F.lit(True).alias("_in_a"))
    b = new.select(*[F.col(c).alias(f"_b_{c}") for c in base.columns], F.lit(True).alias("_in_b"))
    same = reduce(lambda x, y: x & y, [F.col(f"_a_{k}") == F.col(f"_b_{k}") for k in keys])
    pick = lambda c: F.coalesce(f"_b_{c}", f"_a_{c}") if c in keep else F.when(F.col("_in_b"), F.col(f"_b_{c}")).otherwise(F.col(f"_a_{c}"))
    columns = {k: F.coalesce(f"_a_{k}", f"_b_{k}") for k in keys} | {c: pick(c) for c in values}
    return a.join(b, same, "full_outer").select(*[columns[c].alias(c) for c in base.columns])


def inserted(base: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows whose keys the base lacks are added; others are left out."""
    return base.unionByName(new.join(base.select(*keys).distinct(), keys, "left_anti"))


def replaced(base: DataFrame, staged: DataFrame, key: str) -> DataFrame:
    """All base rows of a staged key give way to the staged ones."""
    return base.join(staged.select(key).distinct(), key, "left_anti").unionByName(staged)


def last_written(df: DataFrame, keys: list[str], sequence: str) -> DataFrame:
    return first_rows(df, keys, [F.desc(sequence)])


def multiset_hash(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """A checksum of a group's rows that no order changes: the sorted row hashes' hash."""
    row = F.sha2(F.to_json(F.struct(*columns)), 256)
    return df.groupBy(key).agg(F.sha2(F.concat_ws(",", F.array_sort(F.collect_list(row))), 256).alias("hash"), F.count("*").alias("rows"))


def changed_groups(before: DataFrame, after: DataFrame, group: str, columns: list[str]) -> DataFrame:
    """(group, status) of both snapshots' groups: no_change where their rows are the same, in whatever order and as often; else changed, added or removed.

    Rows are hashed to 128 bits and the halves summed by group, so that nothing is
    gathered; the gate before a diff of rows.
    """
    said = [x for c in columns for x in (F.col(c), F.col(c).isNull())]
    hashes = [F.xxhash64(F.lit(k), *said) for k in (1, 2)]
    parts = [p for h in hashes for p in (F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit(0xFFFFFFFF).cast("long")))]
    hashed = lambda df, n: df.groupBy(group).agg(F.struct(F.count("*"), *[F.sum(p) for p in parts]).alias(n))
    both = hashed(before, "_a").join(hashed(after, "_b"), group, "full_outer")
    status = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(F.col("_a") == F.col("_b"), "no_change").otherwise("changed")
    return both.select(group, status.alias("status"))


#: Changed groups that are sent to all tasks; more are joined.
SENT_GROUPS = 1_000_000


def gated(before: DataFrame, after: DataFrame, group: str, columns: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(before, after, gate): the rows of groups that aren't the same, by ``changed_groups``; those of the others go no further."""
    gate = stored(changed_groups(before, after, group, columns), "gate")
    moved = gate.filter("status <> 'no_change'").select(group)
    moved = F.broadcast(moved) if moved.count() <= SENT_GROUPS else moved
    return before.join(moved, group, "left_semi"), after.join(moved, group, "left_semi"), gate


def snapshot_changes(before: DataFrame, after: DataFrame, keys: list[str], measure: str, texts: list[str], sequence: str, group: str | None = None, cosmetic: bool = False) -> DataFrame:
    """Rows added, removed or changed between two snapshots.

    Of rows with the same keys the last by ``sequence`` counts.  A measure that
    turns null, or was, is a change without a percentage.  Texts are compared
    trimmed, a null one as empty; those that differ in emoji, white space or
    compatibility form alone (see ``compared``) are no change, and are told as COSMETIC ones
    with ``cosmetic``.  With ``group``, groups whose rows are all the same are left
    out before rows are compared.  Columns: the keys,
    change (ADDED, REMOVED, CHANGED), field, before, after (as text, at most 500
    characters), percent and outlier for the measure.
    """
    columns = [measure, *texts]
    if group:
        before, after, _ = gated(before, after, group, [*[k for k in keys if k != group], *columns, sequence])
    a = first_rows(before, keys, [F.desc(sequence)]).select(*keys, *[F.col(c).alias(f"_a_{c}") for c in columns], F.lit(True).alias("_in_a"))
    b = first_rows(after, keys, [F.desc(sequence)]).select(*keys, *[F.col(c).alias(f"_b_{c}") for c in columns], F.lit(True).alias("_in_b"))
    both = a.join(b, keys, "full_outer")
    number = lambda c: F.col(c).cast("string")
    text = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit("")))
    none = F.lit(None).cast("string")
    row = lambda change, field, x, y: F.struct(F.lit(change).alias("change"), F.lit(field).alias("field"), x.alias("before"), y.alias("after"))
    old, new = F.col(f"_a_{measure}"), F.col(f"_b_{measure}")
    moved = F.coalesce(differs(old, new), F.lit(False)) | (old.isNull() != new.isNull())
    changes = [F.when(moved, row("CHANGED", measure, number(f"_a_{measure}"), number(f"_b_{measure}")))]
    changes += [F.when(text(f"_a_{c}") != text(f"_b_{c}"), row("CHANGED", c, text(f"_a_{c}"), text(f"_b_{c}"))) for c in texts]
    rows = (
        F.when(F.col("_in_a").isNull(), F.array(row("ADDED", "row", none, number(f"_b_{measure}"))))
        .when(F.col("_in_b").isNull(), F.array(row("REMOVED", "row", number(f"_a_{measure}"), none)))
        .otherwise(F.filter(F.array(*changes), lambda c: c.isNotNull()))
    )
    percent = F.when((F.col("c.change") == "CHANGED") & (F.col("c.field") == measure), percent_change(old, new))
    out = both.withColumn("c", F.explode(rows)).withColumn("percent", percent)
    out = stored(out.select(*keys, "c.change", "c.field", "c.before", "c.after", "percent", is_outlier(F.col("percent")).alias("outlier")), "changes")
    # Only what differs comes here; of that, only texts beyond ASCII are brought to compatibility form, outside the JVM.
    told = F.col("field").isin(texts) & (F.col("change") == "CHANGED")
    wide = told & (F.col("before").rlike(r"[^\x00-\x7F]") | F.col("after").rlike(r"[^\x00-\x7F]"))
    plain = lambda c: F.trim(F.regexp_replace(c, r"\s+", " "))
    same = [(out.filter(~wide), told & (plain("before") == plain("after"))), (out.filter(wide), compared(F.col("before")) == compared(F.col("after")))]
    parts = [df.withColumn("change", F.when(x, "COSMETIC").otherwise(F.col("change"))) for df, x in same]
    found = parts[0].unionByName(parts[1])
    return (found if cosmetic else found.filter("change <> 'COSMETIC'")).withColumns({c: F.substring(c, 1, 500) for c in ("before", "after")})


def change_records(changes: DataFrame, group: str, item: str, measure: str, about: DataFrame, run_id: Column, detected: Column) -> DataFrame:
    """Changes as records that say over which window they were measured.

    ``about`` has one row a group: owner, baseline_run, baseline_at, cohort.  Columns:
    group, owner, run, baseline_run, cohort, days_since_baseline, detected_at,
    change_type, item, field_changed (new_item, removed_item or the field), old_value,
    new_value, old_price, new_price, price_change_pct, price_outlier.
    """
    known = about.select(F.col(group).alias("_g"), "owner", "baseline_run", "baseline_at", "cohort")
    rows = changes.join(known, F.col(group) == F.col("_g"), "left")
    field = F.when(F.col("change") == "ADDED", "new_item").when(F.col("change") == "REMOVED", "removed_item").otherwise(F.col("field"))
    priced = (F.col("field") == measure) | F.col("change").isin("ADDED", "REMOVED")
    days = F.round((F.unix_micros(detected) - F.unix_micros(F.col("baseline_at").cast("timestamp"))) / 86_400_000_000, 2)
    price = lambda c: F.when(priced, F.col(c).try_cast("double"))
    return rows.select(
        group, "owner", run_id.alias("run"), "baseline_run", "cohort", days.alias("days_since_baseline"), detected.alias("detected_at"), F.col("change").alias("change_type"), item, field.alias("field_changed"),
        F.when(~priced, F.col("before")).alias("old_value"), F.when(~priced, F.col("after")).alias("new_value"), price("before").alias("old_price"), price("after").alias("new_price"), F.col("percent").alias("price_change_pct"), F.col("outlier").alias("price_outlier"),
    )


def capture_status(before: DataFrame, after: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """ok, new, emptied (captured without rows) or not_captured for each key of either snapshot."""
    n = lambda df, name: df.groupBy(key).agg(F.count("*").alias(name))
    rows = n(before, "_a").join(n(after, "_b"), key, "full_outer").join(seen.select(key).distinct().withColumn("_seen", F.lit(True)), key, "left")
    status = F.when(F.col("_b").isNotNull(), F.when(F.col("_a").isNull(), "new").otherwise("ok")).when(F.col("_seen"), "emptied").otherwise("not_captured")
    return rows.select(key, status.alias("status"), F.coalesce("_a", F.lit(0)).alias("rows_before"), F.coalesce("_b", F.lit(0)).alias("rows_after"))


def audited(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, field, before, after) of every value that differs between rows with the same key."""
    a = before.select(key, *[F.col(c).cast("string").alias(f"_a_{c}") for c in columns])
    b = after.select(key, *[F.col(c).cast("string").alias(f"_b_{c}") for c in columns])
    fields = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"_a_{c}").alias("before"), F.col(f"_b_{c}").alias("after")) for c in columns])
    return a.join(b, key).withColumn("x", F.explode(fields)).select(key, "x.*").filter(~F.col("before").eqNullSafe(F.col("after")))


def patched(df: DataFrame, patches: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Values of ``column`` from a side table where it has one, the smallest if it has several; counts are left to ``audited``."""
    side = patches.groupBy(*keys).agg(F.min(column).alias("_new"))
    return df.join(side, keys, "left").withColumn(column, F.coalesce("_new", column)).drop("_new")


def narrowed(df: DataFrame, known: DataFrame, fields: list[str], value: str, identity: str) -> DataFrame:
    """The value of the known row that agrees in every field (null with null); ambiguous and unmatched are told apart."""
    k = known.groupBy(*[F.col(f).alias(f"_k_{f}") for f in fields]).agg(F.count(value).alias("_held"), F.min(value).alias("_value"))  # a row a group, not its pairs
    same = reduce(lambda x, y: x & y, [F.col(f).eqNullSafe(F.col(f"_k_{f}")) for f in fields])
    rows = df.join(k, same, "left").withColumn("_n", F.coalesce(F.sum("_held").over(Window.partitionBy(identity)), F.lit(0)))
    verdict = F.when(F.col("_n") == 0, "unmatched").when(F.col("_n") > 1, "ambiguous").otherwise("matched")
    rows = rows.withColumns({"verdict": verdict, value: F.when(F.col("_n") == 1, F.col("_value"))})
    rows = first_rows(rows, [identity], [F.asc_nulls_last("_value")])
    return rows.drop("_n", "_held", "_value", *[f"_k_{f}" for f in fields])


def patched_in_turn(df: DataFrame, patches: list[tuple[str, DataFrame, str, bool]], keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Sidecar patches (name, rows, column, only_empty) one after the other, and (patch, applied, same, unknown): what each did.

    A value is set where it is null or, unless ``only_empty``, differs; the smallest of several in a
    patch.  ``same`` is said already or kept, ``unknown`` are keys that no row has.
    """
    counts, flags = [], []
    for k, (name, rows, column, only_empty) in enumerate(patches):
        side = rows.filter(F.col(column).isNotNull()).groupBy(*keys).agg(F.min(column).alias("_new"))
        sets = F.col("_new").isNotNull() & (F.col(column).isNull() if only_empty else ~F.col(column).eqNullSafe(F.col("_new")))
        df = df.join(side, keys, "left").withColumns({f"_p{k}": F.when(F.col("_new").isNotNull(), sets), column: F.when(sets, F.col("_new")).otherwise(F.col(column))}).drop("_new")
        flags.append(f"_p{k}")
        missing = side.join(df.select(*keys), keys, "left_anti").agg(F.count("*").alias("unknown")).select(F.lit(name).alias("patch"), "unknown")
        counts.append(missing)
    done = df.agg(*[F.struct(F.count_if(F.col(f)).alias("applied"), F.count_if(~F.col(f)).alias("same")).alias(f) for f in flags])
    each = done.select(F.inline(F.array(*[F.struct(F.lit(p[0]).alias("patch"), F.col(f"{f}.applied").alias("applied"), F.col(f"{f}.same").alias("same")) for p, f in zip(patches, flags, strict=True)])))
    return df.drop(*flags), each.join(reduce(DataFrame.unionByName, counts), "patch")
