"""Token counts: the exact histogram of encoded lengths, and sums over it for every context limit.

The tokenizer is a public byte-level vocabulary read from ``vocabulary`` on each
worker.  Its pattern backtracks over white space, so a long run of it is a piece
of its own here, cut where the pattern would cut it.  Defined results: a null or empty text has no tokens; repeated rows
count each time; an empty table gives an empty histogram.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshed.llm.common import stored, table, totals_before

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the vocabulary's own way to cut text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Runs of so many white space characters (as the pattern has them) are encoded by themselves.
LONG_RUN = 1000
_SPACE = r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


@lru_cache(maxsize=2)
def _encoding(vocabulary: str):
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("lengths", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})


def encoded_length(encoding, text: str, long_run: int = LONG_RUN) -> int:
    """How many tokens a text has.

    All of a run of white space but its last character is one piece (all of it at
    the text's end), whatever stands around it; the last one goes with what follows.
    """
    total = at = 0
    for run in re.finditer(f"{_SPACE}{{{max(2, long_run)},}}", text):
        end = run.end() - (run.end() < len(text))
        total += len(encoding.encode_ordinary(text[at : run.start()])) + len(encoding._encode_single_piece(text[run.start() : end]))
        at = end
    return total + len(encoding.encode_ordinary(text[at:] if at else text))


def with_token_counts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens: the encoded length of each row's whole text."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(vocabulary)
        for batch in batches:
            lengths = np.fromiter((encoded_length(encoding, x.as_py()) if x.is_valid else 0 for x in batch.column(1)), np.int64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths)], ["doc_id", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(count, f"doc_id {dict(docs.dtypes)['doc_id']}, n_tokens long")


def length_sums(lengths: DataFrame) -> DataFrame:
    """For each length that occurs, as a context limit: counts and totals of documents up to and from it.

    n_docs, docs_at_most, docs_at_least; tokens_at_most, tokens_at_least;
    truncated_total: all documents cut to the limit; quantile: the share of
    documents that fit.
    """
    histogram = stored(lengths.groupBy("n_tokens").agg(F.count("*").alias("n_docs")), "lengths")
    total = histogram.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum(F.col("n_docs") * F.col("n_tokens")), F.lit(0))).first()
    rows = histogram.withColumn("_range", F.floor(F.col("n_tokens") / 1024))
    tokens = F.col("n_docs") * F.col("n_tokens")
    for value, name in ((F.col("n_docs"), "docs_below"), (tokens, "tokens_below")):
        rows = totals_before(rows, [], "_range", [F.col("n_tokens")], value, name)
    longer = F.lit(total[0]) - F.col("docs_below")
    return rows.select(
        "n_tokens",
        "n_docs",
        (F.col("docs_below") + F.col("n_docs")).alias("docs_at_most"),
        longer.alias("docs_at_least"),
        (F.col("tokens_below") + tokens).alias("tokens_at_most"),
        (F.lit(total[1]) - F.col("tokens_below")).alias("tokens_at_least"),
        (F.col("tokens_below") + longer * F.col("n_tokens")).alias("truncated_total"),
        ((F.col("docs_below") + F.col("n_docs")) / F.lit(total[0])).alias("quantile"),
        F.lit(total[0]).alias("total_docs"),
        F.lit(total[1]).alias("total_tokens"),
    )


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_sums(with_token_counts(table(spark, sf_dir, "documents")))
