"""Dictionaries against texts: terms of several words in one pass, terms recovered from other forms, patterns by what they must hold.

All joins here are on words, runs of words or of characters; none compares
every text with every entry.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import ArrayType, LongType, StringType

from lakeshed.operators.storing import stored

#: Entries of a dictionary that are sent to all tasks; a larger one is joined.
SENT_TERMS = 200_000
_WORD = r"(?U)\w+"


def words_of(x: Column) -> Column:
    """Lower-case runs of letters, digits and underscores."""
    return F.regexp_extract_all(F.lower(x), F.lit(_WORD), F.lit(0))


def _keyed(vocabulary: DataFrame, term: str) -> DataFrame:
    """(_key, _term, _n): a term by its words, one spelling of each; terms without words are left out."""
    rows = vocabulary.select(F.col(term).alias("_term"), words_of(F.col(term)).alias("_w")).filter(F.size("_w") > 0)
    return rows.groupBy(F.array_join("_w", " ").alias("_key")).agg(F.min("_term").alias("_term"), F.max(F.size("_w")).alias("_n"))


def phrases_found(df: DataFrame, identity: str, text: str, vocabulary: DataFrame, term: str, sent: int = SENT_TERMS) -> DataFrame:
    """(identity, term, start): the terms that a text holds, from left to right, the longest at each place, none over another.

    Texts and terms are compared by their words in lower case; ``start`` is the number
    of the term's first word.  A vocabulary of up to ``sent`` terms, counted first, is made
    a tree of words and sent; a larger one is joined with the texts' runs of words.
    """
    known = stored(_keyed(vocabulary, term), "phrases")
    rows = df.select(identity, words_of(F.col(text)).alias("_w"))
    kind = f"{identity} {dict(df.dtypes)[identity]}"
    if known.count() <= sent:
        tree: dict = {}
        for key, spelt in known.select("_key", "_term").toLocalIterator():
            at = tree
            for word in key.split(" "):
                at = at.setdefault(word, {})
            at[""] = spelt
        shared = df.sparkSession.sparkContext.broadcast(tree)

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            root = shared.value
            for batch in batches:
                row, terms, starts = [], [], []
                for k, words in enumerate(batch.column(1).to_pylist()):
                    start, words = 0, words or ()
                    while start < len(words):
                        at, end, found = root, start, None
                        while end < len(words) and (at := at.get(words[end])) is not None:
                            end += 1
                            if "" in at:
                                found = at[""], end
                        if found:
                            row.append(k)
                            terms.append(found[0])
                            starts.append(start)
                        start = found[1] if found else start + 1
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row, pa.int32())), pa.array(terms, pa.string()), pa.array(starts, pa.int32())], [identity, term, "start"])

        return rows.mapInArrow(find, f"{kind}, `{term}` string, start int")
    sizes = [r["_n"] for r in known.select("_n").distinct().collect()]  # a few numbers

    def runs_of(n: int) -> Column:
        run = lambda k: F.struct(k.alias("start"), F.lit(n).alias("n"), F.array_join(F.slice("_w", k + 1, n), " ").alias("key"))
        return F.when(F.size("_w") >= n, F.transform(F.sequence(F.lit(0), F.size("_w") - n), run)).otherwise(F.array())

    runs = [runs_of(n) for n in sizes]
    hits = rows.select(identity, F.explode(F.concat(*runs)).alias("_r")).select(identity, "_r.*").join(known, F.col("key") == F.col("_key"))
    lists = hits.groupBy(identity).agg(F.array_sort(F.collect_list(F.struct("start", (-F.col("n")).alias("size"), F.col("_term").alias("term")))).alias("_h"))  # one text's hits
    zero = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<start:int,term:string>>").alias("kept"))
    step = lambda s, x: F.when(x["start"] >= s["end"], F.struct((x["start"] - x["size"]).alias("end"), F.concat(s["kept"], F.array(F.struct(x["start"].alias("start"), x["term"].alias("term")))).alias("kept"))).otherwise(s)
    return lists.select(identity, F.explode(F.aggregate("_h", zero, step)["kept"]).alias("_x")).select(identity, F.col("_x.term").alias(term), F.col("_x.start").alias("start"))


def recovery_forms(value: Column) -> Column:
    """What a value may be in a vocabulary, the likeliest first: itself, its singular, each part of a slash, ``&`` or comma and its singular, itself without what stands in parentheses."""
    low = F.lower(F.trim(value))
    singular = lambda x: F.array(x, F.when(F.endswith(x, F.lit("es")), F.regexp_replace(x, "es$", "")), F.when(F.endswith(x, F.lit("s")), F.regexp_replace(x, "s$", "")))
    parts = F.flatten(F.transform(F.split(low, "[/&,]"), lambda p: singular(F.trim(p))))
    forms = F.concat(singular(low), parts, F.array(F.trim(F.regexp_replace(low, r"\(.*?\)", ""))))
    return F.array_distinct(F.filter(forms, lambda x: x.isNotNull() & (x != "")))


def recovered(df: DataFrame, identity: str, values: str, vocabulary: DataFrame, term: str) -> DataFrame:
    """(identity, values, dropped): an array's values as terms of the vocabulary, in order, each once; ``dropped`` counts those that no form of is one."""
    known = vocabulary.groupBy(F.lower(F.trim(term)).alias("_low")).agg(F.min(term).alias("_term"))
    one = df.select(identity, F.posexplode_outer(values).alias("_at", "_value"))
    forms = one.select(identity, "_at", "_value", F.posexplode_outer(recovery_forms(F.col("_value"))).alias("_k", "_form"))
    best = forms.join(known, F.col("_form") == F.col("_low"), "left").groupBy(identity, "_at").agg(F.min_by("_term", F.when(F.col("_term").isNotNull(), F.col("_k"))).alias("_found"), F.max(F.col("_value").isNotNull()).alias("_there"))
    kept = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(F.col("_found").isNotNull(), F.struct("_at", "_found")))), lambda x: x["_found"]))
    return best.groupBy(identity).agg(kept.alias(values), F.count_if(F.col("_there") & F.col("_found").isNull()).alias("dropped"))


# Patterns --------------------------------------------------------------------


def _literals(parsed) -> Iterator[str]:
    """Runs of characters that every match of a parsed pattern holds."""
    run = ""
    for op, arg in parsed:
        name = str(op)
        if name == "LITERAL":
            run += chr(arg)
            continue
        if name == "SUBPATTERN" and not arg[1] and not arg[2]:
            inner = list(arg[3])
            if all(str(o) == "LITERAL" for o, _ in inner):
                run += "".join(chr(a) for _, a in inner)
                continue
        if run:
            yield run
        run = ""
        if name == "SUBPATTERN":
            yield from _literals(arg[3])
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and arg[0] >= 1:
            yield from _literals(arg[2])
    if run:
        yield run


def anchor_of(pattern: str | None) -> str | None:
    """The longest lower-case text that whatever a pattern matches must hold; null if there is none of three characters, or it isn't understood."""
    try:
        runs = list(_literals(re._parser.parse(pattern or "")))
    except (re.error, OverflowError, RecursionError):
        return None
    # other forms of a letter than A-Z and a-z may match in whatever case
    best = max((x for r in runs for x in re.findall(r"[\x20-\x7e]+", r)), key=len, default="").lower()
    return best if len(best) >= 3 and not re.search(r"\\[QE]|\(\?[a-z]*x", pattern) else None


@pandas_udf(StringType())
def _anchors(pattern: pd.Series) -> pd.Series:
    return pattern.map(anchor_of)


#: Characters of the runs that patterns are listed under: the longest that an anchor has, so that it holds half of it or more.
RUNS = (3, 6, 12, 24)


def _hashed_runs(text: str | None, sizes: Sequence[int]) -> np.ndarray:
    """Hashes of a text's distinct runs of so many characters."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    found, run = [], np.zeros(len(codes) + 1, np.uint64)
    for n in range(1, min(max(sizes, default=0), len(codes)) + 1):
        run = run[:-1] * np.uint64(0x9E3779B97F4A7C15) + codes[n - 1 :]
        if n in sizes:
            found.append((run ^ (run >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(n))
    return np.unique(np.concatenate(found)).view(np.int64) if found else np.zeros(0, np.int64)


def _runs(text: Column, sizes: Sequence[int]) -> Column:
    return pandas_udf(lambda x: x.map(lambda t: _hashed_runs(t, sizes)), ArrayType(LongType()))(text)


@pandas_udf(ArrayType(LongType()))
def _own_runs(anchor: pd.Series, size: pd.Series) -> pd.Series:
    """An anchor's runs of its own size."""
    return pd.Series([_hashed_runs(a, [n]) for a, n in zip(anchor, size, strict=True)], dtype=object)


#: Patterns without an anchor, which meet every text.
MOST_LOOSE = 100


def pattern_hits(df: DataFrame, identity: str, text: str, patterns: DataFrame, pattern: str, most_loose: int = MOST_LOOSE) -> DataFrame:
    """The rows of ``patterns`` that match each text, with its identity; a pattern's match is Java's, anywhere in the text.

    A pattern is listed under the rarest run of its anchor (the longest text that it must
    hold), texts under all of theirs of the lengths (``RUNS``) that anchors take: with runs of
    three characters alone, the pairs that meet would grow with texts times patterns.  The
    anchor, then the pattern itself, are tried on those that meet.  Patterns without an anchor are
    counted: up to ``most_loose`` are tried on every text, more are refused.
    """
    rows = df.filter(F.col(text).isNotNull()).select(F.col(identity).alias("_id"), F.col(text).alias("_text"), F.lower(text).alias("_low"))
    size = F.array_max(F.filter(F.array(*map(F.lit, RUNS)), lambda n: n <= F.length("_anchor")))
    known = stored(patterns.filter(F.col(pattern).isNotNull()).withColumn("_number", F.monotonically_increasing_id()).withColumn("_anchor", _anchors(pattern)).withColumn("_size", size), "patterns")
    loose = known.filter("_anchor is null").drop("_size")
    if loose.count() > most_loose:
        raise ValueError(f"more than {most_loose} patterns that hold no text of three characters")
    sizes = sorted(r["_size"] for r in known.filter("_anchor is not null").select("_size").distinct().collect())  # at most as many as RUNS
    parts = rows.select("_id", F.explode(_runs(F.col("_low"), sizes)).alias("_run"))
    held = parts.groupBy("_run").agg(F.count("*").alias("_df"))
    own = known.filter("_anchor is not null").select("_number", F.explode(_own_runs("_anchor", "_size")).alias("_run")).join(held, "_run", "left")
    rarest = own.groupBy("_number").agg(F.min_by("_run", F.struct(F.coalesce("_df", F.lit(0)), "_run")).alias("_run"), F.min(F.coalesce("_df", F.lit(0))).alias("_df")).filter("_df > 0")
    meet = parts.join(rarest.select("_number", "_run"), "_run").select("_id", "_number")
    tried = meet.join(known.drop("_size"), "_number").join(rows, "_id")
    hits = tried.filter(F.contains("_low", "_anchor") & F.expr(f"_text rlike `{pattern}`"))
    out = hits.select(F.col("_id").alias(identity), *patterns.columns)
    if loose.isEmpty():
        return out
    everywhere = rows.join(F.broadcast(loose), F.expr(f"_text rlike `{pattern}`"))  # at most ``most_loose`` rows
    return out.unionByName(everywhere.select(F.col("_id").alias(identity), *patterns.columns))
