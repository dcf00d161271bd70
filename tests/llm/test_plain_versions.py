"""Sharding, quality features and the pipeline against plain versions of what they do; ties of sharding and language ID; sums of the word table."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F
from test_llm import SCHEMA, component_of, plain_grams

from lakeshed.llm import decontamination, language_id, mixing, ngram_join, quality, sharding
from lakeshed.llm.common import stored


def plain_propagation(rows, hashes, tie, shards, rounds):
    """(row: shard) by loops: ``rows`` is row: text, ``hashes(row, salt)`` orders rows, ``tie(text, shard)`` breaks ties."""
    ranked = lambda some, salt: {r: k for k, r in enumerate(sorted(some, key=lambda r: (hashes(r, salt), r)))}
    shard = {r: k % shards for r, k in ranked(rows, 0).items()}
    groups = defaultdict(list)
    for r, t in rows.items():
        groups[t].append(r)
    linked = {r: g for g in groups.values() if len(g) > 1 for r in g}
    for turn in range(rounds):
        wanted = {}
        for t, g in groups.items():
            if len(g) > 1:
                held = Counter(shard[r] for r in g)
                best = max(held, key=lambda s: (held[s], tie(t, s), s))
                wanted |= {r: best for r in g if shard[r] != best}
        free = Counter(shard[r] for r in rows if r not in linked)
        quota = sharding._quotas(shards, {s: free[s] for s in range(shards)}, Counter((shard[r], w) for r, w in wanted.items()))
        if not sum(quota.values()):
            break
        before = dict(shard)
        for pair, n in quota.items():
            mine = [r for r, w in wanted.items() if (before[r], w) == pair]
            for r, k in ranked(mine, turn * 2 + 1).items():
                if k < n:
                    shard[r] = pair[1]
        count = Counter(shard.values())
        order = sorted(range(shards), key=lambda s: (-count[s], s))
        aim = {s: len(rows) // shards + (k < len(rows) % shards) for k, s in enumerate(order)}
        leaving = []
        for s in range(shards):
            mine = ranked([r for r in rows if r not in linked and before[r] == s], turn * 2 + 2)
            leaving += [r for r, k in sorted(mine.items(), key=lambda x: x[1]) if k < count[s] - aim[s]]
        room = [s for s in range(shards) for _ in range(aim[s] - count[s])]
        for r, s in zip(leaving, room, strict=True):
            shard[r] = s
    return shard


@pytest.mark.parametrize("shards", [3, 8])
def test_sharding_against_plain_propagation(spark, shards):
    """Pairs, a hot text and repeated rows; equal counts of a group's shards are ties."""
    texts = [f"own {i}" if i % 4 == 0 else f"pair {i // 2}" if i % 4 < 3 else ("hot" if i % 3 else f"trio {i // 30}") for i in range(300)] + [None, "", "hot"]
    df = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], f"doc_id long, text string, `{sharding.ROW}` long").repartition(3)
    got = {r["_row"]: r["shard"] for r in sharding.propagated(df, shards).collect()}
    salts = range(2 * sharding.ROUNDS + 3)
    own = spark.range(len(texts)).select("id", *[F.shiftrightunsigned(F.xxhash64("id", F.lit(s)), 32).alias(f"h{s}") for s in salts]).collect()
    known = {(r["id"], s): r[f"h{s}"] for r in own for s in salts}
    names = sorted({t or "" for t in texts})
    ties = spark.createDataFrame([(t, s) for t in names for s in range(shards)], "t string, s int").select("t", "s", F.xxhash64(F.md5("t"), "s").alias("h")).collect()
    tie = {(r["t"], r["s"]): r["h"] for r in ties}
    want = plain_propagation({i: t or "" for i, t in enumerate(texts)}, lambda r, s: known[r, s], lambda t, s: tie[t, s], shards, sharding.ROUNDS)
    assert got == want
    cut = lambda where: sum(len({where[i] for i, x in enumerate(texts) if x == t}) - 1 for t in set(texts))
    assert cut(got) < cut({i: k % shards for k, i in enumerate(sorted(known_i for known_i in range(len(texts))))})


def plain_features(text):
    """The same measures, character by character and word by word."""
    data = (text or "").encode()
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    lines = [tuple(w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", x)) for x in data.split(b"\n")]
    lines = [x for x in lines if x]
    per = lambda n, d: n / max(d, 1)
    upper = lambda w: sum(65 <= c <= 90 for c in w)
    odd = [k for k in ("symbols", "exclamations")]
    out = {name: per(sum(bool(flag[c]) for c in data), len(data)) for name, flag in quality._SET.items()}
    low = [w.lower() for w in words]
    return out | {
        "bytes": math.log1p(len(data)), "words": math.log1p(len(words)), "mean_word": per(sum(map(len, words)), len(words)), "long_words": per(sum(len(w) >= 12 for w in words), len(words)), "short_words": per(sum(len(w) <= 3 for w in words), len(words)),
        "not_ascii": per(sum(c >= 128 for c in data), len(data)), "distinct_words": per(len(set(low)), len(words)), "top_word": per(max(Counter(low).values(), default=0), len(words)), "distinct_lines": per(len(set(lines)), len(lines)),
        "shouted_words": per(sum(upper(w) >= 2 and 2 * upper(w) > len(w) for w in words), len(words)), "odd_ends": per(sum(any(quality._SET[k][w[-1]] for k in odd) for w in words), len(words)), "longest_word": math.log1p(max(map(len, words), default=0)),
    }


def test_quality_features_and_scores_against_plain_ones(spark):
    texts = ["Plain words, and plain LINES.\nPlain words, and plain LINES.\n\nMore!!! ###", None, "", " \n ", "ONE", "é ü 12 www.x.y extraordinarily", "a\tb\x0bc\r\nA  b C", "x" * 500 + " y", "One\n one\nONE"] + [f"word{i} " * (i % 7) + "end? 3 | 4" for i in range(40)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["features"] for r in quality.with_features(rows).collect()}
    for i, t in enumerate(texts):
        want = plain_features(t)
        assert dict(zip(quality.FEATURES, got[i], strict=True)) == pytest.approx({k: want[k] for k in quality.FEATURES}), t
    x = np.array([got[i] for i in range(len(texts))])
    model = quality.fit(x, (np.arange(len(texts)) % 2).astype(float))
    for row, score in zip(x, model.score(x), strict=True):
        total = model.base + sum(values[sum(c <= v for c in cuts)] for v, cuts, values in zip(row, model.cuts, model.tables, strict=True))
        total += sum(values[sum(c <= row[f] for c in model.pair_cuts[f]), sum(c <= row[g] for c in model.pair_cuts[g])] for (f, g), values in zip(model.pairs, model.pair_tables, strict=True))
        assert score == pytest.approx(1 / (1 + math.exp(-total)))


def test_ties_of_languages(spark):
    """Languages that hold the same n-grams: the first by code point, whatever the order of rows."""
    rows = [(i, "lorem ipsum dolor", ("zz", "aa", "mm")[i % 3]) for i in range(30)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "doc_id long, text string, lang string")
        assert {r["lang_pred"] for r in language_id.identified(df, language_id.learned(df)).collect()} == {"aa"}


def test_word_table_of_many_tasks(spark, monkeypatch):
    """Sums by groups of tasks are those of all at once."""
    docs = spark.createDataFrame([(i, f"a b w{i % 7} " * (i % 5), None, None, None, 0, 0, "") for i in range(200)], SCHEMA)
    one = ngram_join.word_table(docs.coalesce(1))
    assert (one == ngram_join.word_table(docs.repartition(70))).all() and one.max() > 0


def exact_languages(docs):
    """doc_id: (language, score, n-grams) from exact sets of the four fifths that teach."""
    import zlib

    counts, teaching = defaultdict(Counter), Counter()
    for r in docs:
        if r["lang"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5:
            counts[r["lang"]].update(plain_grams(r["text"]))
            teaching[r["lang"]] += 1
    sets = {k: [{g for g, n in c.items() if n / sum(c.values()) >= share} for share in language_id.SHARES] for k, c in counts.items()}
    out = {}
    for r in docs:
        found = plain_grams(r["text"])
        scores = {k: sum(sum(g in s for g in found) for s in levels) / language_id.LEVELS / max(1, len(found)) for k, levels in sets.items()}
        out[r["doc_id"]] = (any(c.isalpha() for c in r["text"] or ""), max(scores.values(), default=0), len(found))
    return out


def leaking(docs, items):
    """The ids of documents with a passage that scores, and holds question and answer, by a loop over all passages and items."""
    said = lambda t: re.findall("[0-9a-z\x80-\U0010ffff]+", t.lower())
    known = [(said(t), *map(said, decontamination.question_and_answer(t))) for t in {t for _, t in items if t} if said(t)]
    mean, longest = sum(len(w) for w, *_ in known) / len(known), max(len(w) for w, *_ in known)
    df = Counter(w for words, *_ in known for w in set(words))
    gains = []
    for words, *_ in known:
        g = {w: math.log1p((len(known) - df[w] + 0.5) / (df[w] + 0.5)) * n * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(words) / mean)) for w, n in Counter(words).items()}
        gains.append({w: x / sum(g.values()) for w, x in g.items()})
    number = {w: k for k, w in enumerate(df)}
    coded = lambda words: np.array([number.get(w, -1) for w in words], np.int64)
    runs = lambda words, n: {tuple(words[k : k + n]) for k in range(len(words) - n + 1)}
    out, length = set(), max(64, 2 * longest)
    for d, text in docs:
        words = said(text or "")
        for at in range(0, max(1, len(words) - length // 2), length // 2):
            passage = words[at : at + length]
            held = set(passage)
            for g, (_, asked, answer) in zip(gains, known, strict=True):
                if sum(x for w, x in g.items() if w in held) >= 0.65 - 1e-9:
                    width = min(3, len(asked))
                    q = len(runs(asked, width) & runs(passage, width)) / len(runs(asked, width)) if asked else 1.0
                    if q >= 0.6 and (not answer or decontamination._in_order(coded(answer), coded(passage)) >= 0.6 * len(answer)):
                        out.add(d)
    return out


def test_pipeline_against_plain_stages(spark):
    """Each stage's rows are those of a plain version of it on the stage's own input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        ids = Counter(r["doc_id"] for r in before)
        docs = stored(stage(spark, docs, SF), "plain")
        after = Counter(r["doc_id"] for r in docs.collect())
        if name == "language ID":
            for i, (letters, score, n) in exact_languages(before).items():
                if abs(score - language_id.LEAST_SCORE) > 0.03:  # what chance hits may move
                    assert (i in after) == (letters and (score >= language_id.LEAST_SCORE or n < language_id.LEAST_GRAMS)), i
        elif name == "n-gram Jaccard join":
            groups = component_of([(r["doc_id"], r["text"]) for r in before])
            assert after == Counter(i for i in ids if groups[i][0] == 0 or groups[i][1] == i)
        elif name == "benchmark decontamination":
            leaks = leaking([(r["doc_id"], r["text"]) for r in before], items)
            assert after == Counter({i: n for i, n in ids.items() if i not in leaks})
        elif name == "mixing sources to target weights":
            con = duckdb.connect()
            con.register("documents", spark.createDataFrame(before, docs.schema).toPandas())
            taken = con.execute(f"SELECT doc_id, size, taken FROM ({mixing.ORACLE}) WHERE taken > 0").fetchall()
            assert after == Counter({i: -(-t // s) for i, s, t in taken})
        else:
            counts = Counter(r["shard"] for r in docs.collect())
            assert after == ids and max(counts.values()) - min(counts.values()) <= 1
