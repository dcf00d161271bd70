"""Secret scans: three formats by pattern, and Shannon entropy over sliding windows of candidate strings.

Everything is a SQL expression on the row; there is no shuffle.  Spans count
code points, the end is exclusive, and a document's spans are in the order of
start, then kind.

Entropy: a candidate is a whole run of 20 or more of ``[A-Za-z0-9+/_=-]`` with a
letter and a digit.  A window of 20 characters moves over it; the count of the
character that enters goes up, that of the one that leaves goes down, and the
sum of c*log2(c) changes by those two alone.  The span runs from the first to the
last window whose entropy reaches the threshold of the candidate's character
class.  A candidate that an allow-list pattern matches is left out.

Defined results: a null text counts as the empty text and has no spans; repeated
rows give repeated results; an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshed.llm.common import table

#: The three formats.
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_VALUE, ACCESS_LENGTH, HEX_LENGTH = 8, 16, 32

KINDS = ("assign", "access", "hex", "entropy")
CANDIDATE = r"[A-Za-z0-9+/_=-]+"
WINDOW = 20
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
#: Bits a character by class; a window of 20 has at most 4.32.
HEX_BITS, OTHER_BITS = 3.0, 3.7
#: Not secrets: UUIDs, dates and times in names, alphabets and digits in order, placeholders.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    r"(19|20)[0-9][0-9]-[01][0-9]-[0-3][0-9]",
    r"[Aa][Bb][Cc][Dd][Ee][Ff][Gg][Hh]|01234567|12345678",
    r"EXAMPLE|[Ee]xample|[Pp]laceholder|XXXX|xxxx",
)

#: c*log2(c) in millionths, so that sums are exact.
_SCALE = 1_000_000
_LOGS = [0, *(round(c * math.log2(c) * _SCALE) for c in range(1, WINDOW + 1))]


def _most_sum(bits: float) -> int:
    """The largest sum of c*log2(c) at which a window has at least ``bits`` of entropy."""
    return math.floor((math.log2(WINDOW) - bits) * WINDOW * _SCALE)


def _sql(pattern: str) -> str:
    return "r'" + pattern.replace("'", r"\x27") + "'"


#: Pieces between matches are numbered in blocks of so many, so that lists grow by concatenation within a block only.
BLOCK = 256


def _matches(text: str, pattern: str, gate: str, group: int = 0) -> str:
    """An array of (start, end, value) of the pattern's leftmost matches, where ``gate`` holds; else an empty one.

    The text between matches gives their places: each starts after all pieces and
    matches before it.  Lengths are summed by block, then within each block.
    """
    p = _sql(pattern)
    none = "cast(array() AS array<struct<start:int,end:int,value:string>>)"
    size = "length(x.`0`) + coalesce(length(x.`1`), 0)"
    found = f"""flatten(transform(
        array(arrays_zip(split({text}, {p}, -1), regexp_extract_all({text}, {p}, 0), regexp_extract_all({text}, {p}, {group}))),
        all -> flatten(transform(
            array(transform(sequence(0, (size(all) - 1) div {BLOCK}), b -> slice(all, b * {BLOCK} + 1, {BLOCK}))),
            blocks -> flatten(zip_with(blocks,
                aggregate(transform(blocks, part -> aggregate(part, 0, (n, x) -> n + {size})), array(0), (n, s) -> concat(n, array(element_at(n, -1) + s))),
                (part, base) -> if(part IS NULL, {none}, aggregate(part, named_struct('at', base, 'found', {none}),
                    (a, x) -> named_struct('at', a.at + {size}, 'found',
                        if(x.`1` IS NULL, a.found, concat(a.found, array(named_struct('start', a.at + length(x.`0`), 'end', a.at + length(x.`0`) + length(x.`1`), 'value', x.`2`))))),
                    a -> a.found))))))))"""
    return f"if({gate}, {found}, {none})"


#: Counts of a window need five bits each; so many of them lie in one number.
_COUNTS = 12


def _windows(value: str) -> str:
    """(first, last): the starts of the first and last windows of ``value`` with enough entropy; -1 if none.

    The counts of the alphabet's characters lie in a few numbers; a step changes
    those of the character that enters and of the one that leaves.  A window is
    judged at the step after it, the last one at the end.
    """
    logs = "array(" + ",".join(f"{x}L" for x in _LOGS) + ")"
    most = f"if({value} RLIKE '^([0-9a-f]+|[0-9A-F]+)$', {_most_sum(HEX_BITS)}L, {_most_sum(OTHER_BITS)}L)"
    enters, leaves = "get(w.codes, i)", f"get(w.codes, i - {WINDOW})"
    held = lambda x: f"cast(shiftright(get(a.counts, {x} div {_COUNTS}), cast(5 * ({x} % {_COUNTS}) AS int)) & 31L AS int)"
    one = lambda x: f"if(j = {x} div {_COUNTS}, shiftleft(1L, cast(5 * ({x} % {_COUNTS}) AS int)), 0L)"
    up = f"get({logs}, {held(enters)} + 1) - get({logs}, {held(enters)})"
    down = f"get({logs}, {held(leaves)} - 1) - get({logs}, {held(leaves)})"
    good = f"i >= {WINDOW} AND a.sum <= w.most"
    return f"""element_at(transform(
        transform(array(cast({value} AS binary)), b -> named_struct('most', {most}, 'codes', transform(sequence(1, octet_length(b)), k -> instr('{ALPHABET}', cast(substring(b, k, 1) AS string)) - 1))),
        w -> aggregate(sequence(0, size(w.codes) - 1),
            named_struct('counts', array_repeat(0L, {-(-len(ALPHABET) // _COUNTS)}), 'sum', 0L, 'first', -1, 'last', -1),
            (a, i) -> named_struct(
                'counts', if(i >= {WINDOW} AND {enters} = {leaves}, a.counts, transform(a.counts, (x, j) -> x + {one(enters)} - if(i >= {WINDOW}, {one(leaves)}, 0L))),
                'sum', a.sum + if(i >= {WINDOW} AND {enters} = {leaves}, 0L, {up} + if(i >= {WINDOW}, {down}, 0L)),
                'first', if(a.first < 0 AND {good}, i - {WINDOW}, a.first),
                'last', if({good}, i - {WINDOW}, a.last)),
            a -> named_struct(
                'first', if(a.first < 0 AND a.sum <= w.most, size(w.codes) - {WINDOW}, a.first),
                'last', if(a.sum <= w.most, size(w.codes) - {WINDOW}, a.last)))), 1)"""


def with_spans(docs: DataFrame, text: str = "text", allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """Adds ``spans``: array of (start, end, rank, kind, value) by start, then kind."""
    t = "coalesce(`" + text.replace("`", "``") + "`, '')"
    has = {"assign": f"{t} RLIKE {_sql(ASSIGN)}", "access": f"contains({t}, 'AKIA')", "hex": f"{t} RLIKE '[0-9a-f]{{{HEX_LENGTH}}}'", "entropy": f"{t} RLIKE '[A-Za-z0-9+/_=-]{{{WINDOW}}}'"}
    # Runs shorter than the least length are left out by the pattern where this can't change other matches.
    found = {
        "assign": f"filter({_matches(t, ASSIGN, has['assign'], 2)}, x -> length(x.value) >= {ASSIGN_VALUE})",
        "access": f"filter({_matches(t, ACCESS, has['access'])}, x -> length(x.value) >= {ACCESS_LENGTH})",
        "hex": _matches(t, f"[0-9a-f]{{{HEX_LENGTH},}}", has["hex"]),
        "entropy": _matches(t, f"[A-Za-z0-9+/_=-]{{{WINDOW},}}", has["entropy"]),
    }
    suspects = " AND ".join(["x.value RLIKE '[0-9]'", "x.value RLIKE '[A-Za-z]'", *(f"NOT x.value RLIKE {_sql(p)}" for p in allowed)])
    scored = f"transform(filter({found['entropy']}, x -> {suspects}), x -> named_struct('x', x, 'w', {_windows('x.value')}))"
    found["entropy"] = f"transform(filter({scored}, y -> y.w.first >= 0), y -> named_struct('start', y.x.start + y.w.first, 'end', y.x.start + y.w.last + {WINDOW}, 'value', substr(y.x.value, y.w.first + 1, y.w.last - y.w.first + {WINDOW})))"
    parts = [f"transform({found[k]}, x -> named_struct('start', x.start, 'rank', {i}, 'end', x.end, 'kind', '{k}', 'value', x.value))" for i, k in enumerate(KINDS)]
    return docs.withColumn("spans", F.expr(f"array_sort(concat({', '.join(parts)}))"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def _kind_count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda x: x["kind"] != "entropy")
    return found.select(
        "doc_id",
        *[_kind_count(k).alias(f"n_{k}") for k in KINDS],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def _oracle() -> str:
    q = lambda p: "'" + p.replace("'", "''") + "'"
    kinds = ((0, "assign", ASSIGN, 2), (1, "access", ACCESS, 0), (2, "hex", HEX, 0), (3, "entropy", CANDIDATE, 0))
    zipped = " UNION ALL ".join(
        f"SELECT doc_id, {i} AS rank, '{k}' AS kind, string_split_regex(text, {q(p)}) AS pieces, regexp_extract_all(text, {q(p)}, 0) AS wholes, regexp_extract_all(text, {q(p)}, {g}) AS vals FROM d" for i, k, p, g in kinds
    )
    logs = "[" + ",".join(f"{x}::BIGINT" for x in _LOGS) + "]"
    allowed = " AND ".join(f"NOT regexp_matches(value, {q(p)})" for p in ALLOWED)
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
z AS ({zipped}),
m AS (SELECT doc_id, rank, kind, unnest(generate_series(1, len(wholes))) AS k, pieces, wholes, vals FROM z),
p AS (
  SELECT doc_id, rank, kind, len(wholes[k]) AS size, vals[k] AS value,
    sum(len(pieces[k])) OVER (PARTITION BY doc_id, rank ORDER BY k) + coalesce(sum(len(wholes[k])) OVER (PARTITION BY doc_id, rank ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM m),
base AS (
  SELECT doc_id, rank, kind, start::BIGINT AS start, (start + size)::BIGINT AS stop FROM p
  WHERE (rank = 0 AND len(value) >= {ASSIGN_VALUE}) OR (rank = 1 AND size >= {ACCESS_LENGTH}) OR (rank = 2 AND size >= {HEX_LENGTH})),
c AS (SELECT row_number() OVER () AS cand, doc_id, start, value FROM p WHERE rank = 3 AND size >= {WINDOW} AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') AND {allowed}),
w AS (SELECT cand, doc_id, start, value, unnest(generate_series(0, len(value) - {WINDOW})) AS pos FROM c),
ch AS (SELECT cand, doc_id, start, value, pos, unnest(string_split(substr(value, pos + 1, {WINDOW}), '')) AS c FROM w),
n AS (SELECT cand, doc_id, start, value, pos, c, count(*) AS n FROM ch GROUP BY ALL),
s AS (SELECT cand, doc_id, start, value, pos, sum({logs}[n + 1]) AS total FROM n GROUP BY ALL),
e AS (
  SELECT doc_id, 3 AS rank, 'entropy' AS kind, (start + min(pos))::BIGINT AS start, (start + max(pos) + {WINDOW})::BIGINT AS stop FROM s
  WHERE total <= CASE WHEN regexp_matches(value, '^([0-9a-f]+|[0-9A-F]+)$') THEN {_most_sum(HEX_BITS)} ELSE {_most_sum(OTHER_BITS)} END GROUP BY cand, doc_id, start),
spans AS (SELECT *, kind || ':' || start || ':' || stop AS said FROM base UNION ALL SELECT *, kind || ':' || start || ':' || stop FROM e),
g AS (
  SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex, count(*) FILTER (rank = 3) AS n_entropy,
    coalesce(string_agg(said, ',' ORDER BY start, rank) FILTER (rank < 3), '') AS base, string_agg(said, ',' ORDER BY start, rank) AS spans FROM spans GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex, coalesce(n_entropy, 0)::BIGINT AS n_entropy,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
"""


ORACLE = _oracle()
