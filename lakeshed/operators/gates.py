"""Gates on outputs: each counts offending rows in one pass and says what it expects."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshed.functions.text import ARABIC, CJK, CONTROL, EMOJI, INVISIBLE


@dataclass(frozen=True)
class Gate:
    """Passes where at most ``most`` rows meet ``offends``."""

    name: str
    offends: Column
    most: int = 0


def checked(df: DataFrame, gates: Sequence[Gate]) -> DataFrame:
    """(gate, found, passed): all gates in one aggregation."""
    counts = df.agg(*[F.count_if(g.offends).alias(f"g{k}") for k, g in enumerate(gates)])
    rows = [F.struct(F.lit(g.name).alias("gate"), F.col(f"g{k}").alias("found"), (F.col(f"g{k}") <= g.most).alias("passed")) for k, g in enumerate(gates)]
    return counts.select(F.inline(F.array(*rows)))


def missing_columns(df: DataFrame, wanted: dict[str, str]) -> dict[str, str]:
    """What a schema lacks or has in another type: name -> ``missing`` or the type it has."""
    have = dict(df.dtypes)
    return {c: have.get(c, "missing") for c, t in wanted.items() if have.get(c) != t}


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def broken_dependencies(df: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with more than one value where there should be one."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.countDistinct(value).alias("values")).filter("values > 1")


HYGIENE = {"emoji": EMOJI, "arabic": ARABIC, "cjk": CJK, "control": CONTROL, "invisible": INVISIBLE, "mangled": "Ã[\\x{80}-\\x{BF}]|â€"}


def hygiene(df: DataFrame, fields: list[str]) -> DataFrame:
    """(field, kind, n): rows whose text holds characters of a kind, in one pass."""
    counts = df.agg(*[F.count_if(F.col(f).rlike(p)).alias(f"{f}|{k}") for f in fields for k, p in HYGIENE.items()])
    rows = [F.struct(F.lit(f).alias("field"), F.lit(k).alias("kind"), F.col(f"`{f}|{k}`").alias("n")) for f in fields for k in HYGIENE]
    return counts.select(F.inline(F.array(*rows)))


def changed_fields(before: DataFrame, after: DataFrame, key: str, frozen: list[str]) -> DataFrame:
    """(field, n): rows whose frozen fields differ from the input."""
    a = before.select(key, *[F.col(c).alias(f"_a_{c}") for c in frozen])
    both = a.join(after.select(key, *frozen), key)
    counts = both.agg(*[F.count_if(~F.col(c).eqNullSafe(F.col(f"_a_{c}"))).alias(c) for c in frozen])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("n")) for c in frozen])))


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    return child.join(parent.select(F.col(pk).alias(fk)).distinct(), fk, "left_anti")


def casing_twins(df: DataFrame, value: str) -> DataFrame:
    """Values that differ in case alone."""
    return df.groupBy(F.lower(value).alias("lower")).agg(F.countDistinct(value).alias("forms")).filter("forms > 1")


def alternative_groups(df: DataFrame, keys: dict[str, Column]) -> DataFrame:
    """(kind, key, n): rows that agree under each of several keys; null keys are left out."""
    both = F.array(*[F.struct(F.lit(k).alias("kind"), v.cast("string").alias("key")) for k, v in keys.items()])
    return df.select(F.explode(both).alias("x")).select("x.*").filter("key is not null").groupBy("kind", "key").agg(F.count("*").alias("n")).filter("n > 1")


def accounted(total: int, **parts: int) -> None:
    """Raises if the parts don't add up to the total."""
    if total != sum(parts.values()):
        raise ValueError(f"{total} rows, but {parts}")


def line_problems(lines: DataFrame, text: str, required: dict[str, str], key: str, menu: str) -> DataFrame:
    """(problem, field, n) of lines that should hold one JSON object each, in one pass but for repeated keys.

    ``required`` has the wanted fields and their types (string, number, boolean, array, object).
    Problems: unparseable, missing, null, type, extra (fields beyond), empty menu, repeated key.
    """
    body = F.try_parse_json(F.when(F.trim(text) != "", F.col(text)))
    rows = lines.filter(F.trim(F.coalesce(text, F.lit(""))) != "").select(F.col(text).alias("_t"), body.alias("_v"))
    typed = lambda f: F.schema_of_variant(F.try_variant_get("_v", f"$.{f}", "variant"))
    names = F.json_object_keys(F.when(F.col("_v").isNotNull(), F.col("_t")))
    rows = rows.select("_v", names.alias("_names"), *[typed(f).alias(f"_k_{i}") for i, f in enumerate(required)], F.try_variant_get("_v", f"$.{key}", "string").alias("_key"), F.size(F.try_variant_get("_v", f"$.{menu}", "array<variant>")).alias("_items"))
    object_ = F.col("_names").isNotNull()
    patterns = {"string": "^STRING$", "number": r"^(BIGINT|DOUBLE|DECIMAL.*)$", "boolean": "^BOOLEAN$", "array": "^ARRAY", "object": "^OBJECT"}
    found = [F.struct(F.lit("unparseable").alias("problem"), F.lit("").alias("field"), F.count_if(~object_).alias("n")), F.struct(F.lit("empty menu").alias("problem"), F.lit(menu).alias("field"), F.count_if(object_ & (F.coalesce("_items", F.lit(0)) <= 0)).alias("n"))]
    for i, (f, kind) in enumerate(required.items()):
        k, there = F.col(f"_k_{i}"), F.array_contains("_names", f)
        for problem, wrong in (("missing", ~there), ("null", there & F.coalesce(k == "VOID", F.lit(False))), ("type", there & (k != "VOID") & ~k.rlike(patterns[kind]))):
            found.append(F.struct(F.lit(problem).alias("problem"), F.lit(f).alias("field"), F.count_if(object_ & wrong).alias("n")))
    counted = rows.agg(F.array(*found).alias("x")).select(F.inline("x"))
    extra = rows.select(F.explode(F.array_except("_names", F.array(*map(F.lit, required)))).alias("field")).groupBy("field").agg(F.count("*").alias("n")).select(F.lit("extra").alias("problem"), "field", "n")
    again = rows.filter("_key is not null").groupBy("_key").agg(F.count("*").alias("c")).filter("c > 1").agg(F.count("*").alias("n")).select(F.lit("repeated key").alias("problem"), F.lit(key).alias("field"), "n")
    return counted.unionByName(extra).unionByName(again).filter("n > 0")


def load_gates(items: DataFrame, deltas: DataFrame, run: str, run_id: Column, branch: str, needed: tuple[list[str], list[str]], kind: str, kinds: Sequence[str], emptied: DataFrame, stated: DataFrame) -> DataFrame:
    """(gate, found, wanted, passed) of a load, before it is published.

    ``stated`` is one row: how many items and deltas the files and the report have.
    Gates: the run's items and deltas are as many; no branch has rows of two runs;
    each branch of ``emptied`` keeps its earlier rows and gets no new ones; no
    needed column of the run's items and deltas is null; kinds of change are listed ones.
    """
    of_run = lambda x: F.coalesce(x, F.lit(False)) & F.col(run).eqNullSafe(run_id)
    gone = emptied.select(branch).distinct().withColumn("_gone", F.lit(True))
    branches = items.groupBy(branch).agg(F.countDistinct(run).alias("_runs"), F.count_if(of_run(F.lit(True))).alias("_new")).join(gone, branch, "full_outer")
    by_branch = branches.agg(F.count_if(F.col("_runs") > 1).alias("several"), F.count_if(F.col("_gone") & F.col("_runs").isNotNull()).alias("keeps"), F.count_if("_gone").alias("gone"), F.coalesce(F.sum(F.when(F.col("_gone"), F.col("_new"))), F.lit(0)).alias("anew"))
    lacks = lambda df, which, more: df.agg(F.count_if(of_run(F.lit(True))).alias(which), *[F.count_if(of_run(F.col(c).isNull())).alias(f"{which}_{c}") for c in needed[which == "deltas"]], *more)
    one = by_branch.crossJoin(F.broadcast(lacks(items, "items", []))).crossJoin(F.broadcast(lacks(deltas, "deltas", [F.count_if(of_run(~F.col(kind).isin(*kinds))).alias("kinds")])))  # one row each
    one = one.crossJoin(F.broadcast(stated.select(F.col("items").alias("want_items"), F.col("deltas").alias("want_deltas")).limit(1)))
    gate = lambda name, found, wanted: F.struct(F.lit(name).alias("gate"), F.col(found).cast("long").alias("found"), wanted.cast("long").alias("wanted"), (F.col(found) == wanted).alias("passed"))
    none, rows = F.lit(0), [gate("items as stated", "items", F.col("want_items")), gate("deltas as stated", "deltas", F.col("want_deltas")), gate("branches of several runs", "several", F.lit(0)), gate("emptied branches keep rows", "keeps", F.col("gone")), gate("emptied branches get rows", "anew", F.lit(0)), gate("kinds of change beyond the list", "kinds", F.lit(0))]
    rows += [gate(f"{which} without {c}", f"{which}_{c}", none) for which, columns in zip(("items", "deltas"), needed, strict=True) for c in columns]
    return one.select(F.inline(F.array(*rows)))
