"""Ranked search, URL filters and the Merkle manifest against plain versions, and their defined results."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from conftest import SF, rows_of
from pyspark.sql import functions as F

from lakeshed.llm import merkle, queries, ranked_search, url_filters

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, score long, block long"


@pytest.mark.parametrize("name", ["op11_ranked_search", "op12_url_filters", "op13_merkle_manifest"])
def test_against_sql(spark, sql, name):
    got, want = queries.queries()[name](spark, SF).toPandas(), sql.execute(queries.oracle_sql()[name]).df()
    columns = sorted(want.columns)
    assert columns == sorted(got.columns)
    assert rows_of(got, columns) == rows_of(want, columns)


@pytest.fixture(scope="module")
def rows():
    """Copies, ties, a hot source, null and empty texts, a long one, repeated rows and a null id."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 5))) for _ in range(120)]
    prose = lambda n: "".join(rng.choice(words).title() + rng.choice([" ", "\n", ", ", "-"]) for _ in range(n))
    base = prose(40)
    texts = [prose(rng.randrange(1, 60)) for _ in range(150)] + [base] * 25 + [base + prose(3) for _ in range(15)] + [None, "", " \n ", "?!", prose(20_000)]
    out = [(i, t, ("en", None)[i % 2], ("hot", "hot", "b", None, "É", "")[i % 6], i * 7 if i % 5 else None, "clash", 1, 2) for i, t in enumerate(texts)]
    return [*out, out[4], out[170], (None, base, None, "hot", None, "x", 0, 0)]


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_ranks(docs, items, k=10):
    """(item, rank, doc, score) by scoring every document."""
    counts = [(r[0], Counter(terms(r[1]))) for r in docs]
    counts = [(i, c, sum(c.values())) for i, c in counts if c]
    docs_n, total = len(counts), sum(n for _, _, n in counts)
    df = Counter(t for _, c, _ in counts for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, n in counts:
            m = 10 + 90 * n * docs_n // total
            s = sum(math.floor(1000 * math.log((2 * docs_n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            if s > 0:
                scores.append((-s, i is not None, i))
        out += [(item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(map(repr, out))


def ranks_of(df):
    return sorted(repr((r["item_id"], r["rank"], r["doc_id"], r["score"])) for r in df.collect())


@pytest.mark.parametrize("size, piece, block", [(4_000_000, 1 << 20, 4096), (50, 16, 3)])
def test_ranked_search_against_plain_scores(spark, rows, monkeypatch, size, piece, block):
    """Small slices, pieces of the vocabulary and blocks of queries change nothing."""
    monkeypatch.setattr(ranked_search, "SLICE", size)
    monkeypatch.setattr(ranked_search, "PIECE", piece)
    monkeypatch.setattr(ranked_search, "BLOCK", block)
    rng = random.Random(9)
    items = [(i, " ".join(rng.choice(terms(rng.choice(rows)[1]) or ["zz"]) for _ in range(rng.randrange(1, 20)))) for i in range(12)]
    items += [(20, None), (21, ""), (22, "nothing known here zzz"), (23, rows[160][1]), (24, rows[160][1].upper()), (None, "abc a b c")]
    frame = spark.createDataFrame([*items, items[0]], "item_id long, text string")
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    assert ranks_of(ranked_search.ranked(docs, frame)) == plain_ranks(rows, items)
    few = ranked_search.ranked(docs.withColumn("doc_id", F.col("doc_id").cast("string")), frame, k=3)
    assert {r["count"] for r in few.groupBy("item_id").count().collect()} == {3}
    assert ranked_search.ranked(docs.limit(0), frame).count() == 0
    assert ranked_search.ranked(docs, frame.limit(0)).count() == 0


def test_accumulators_stop(monkeypatch):
    """Once no new document can reach the k-th partial score, common terms only add to those there are."""
    import numpy as np

    n = 1000
    words = np.full(n, 50)
    rare, common = np.arange(20), np.arange(n)
    first = np.concatenate([[0], np.cumsum(np.bincount(np.concatenate([rare, common]), minlength=n))])
    flat = np.concatenate([[0, 1] if d < 20 else [1] for d in range(n)])
    lists = ranked_search.Lists(words, first, flat, np.ones(len(flat), np.int64), n, int(words.sum()))
    made = []
    real = np.concatenate
    monkeypatch.setattr(ranked_search.np, "concatenate", lambda x, *a: made.append(len(x[-1])) or real(x, *a))
    docs, scores = lists.best(np.array([0, 1]), np.array([5000, 1]), 10, 0)
    assert len(docs) == 20 and len(set(scores.tolist())) == 1
    assert scores[0] == 5001 * lists.gains[0] and max(made) <= 20
    assert len(lists.best(np.array([1]), np.array([1]), 10, 10**12)[0]) == 0


def plain_host(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return host.translate(LOWER), re.match(r"[^?#]*", rest[len(host) :])[0]


def plain_rule(host, path):
    found = [(h + p, a) for a, h, p in url_filters.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(found, key=lambda x: len(x[0]), default=(None, None))


def plain_bounds(counts):
    """host: bound, by the formulas of the module."""
    named = {}
    for host in counts:
        name = re.sub(r"^[^@]*@|:[0-9]*$|\.+$", "", host)
        labels = name.split(".")
        if re.match(r"^[0-9.]*$|^\[|^[^.]*$", name):
            named[host] = ("", name)
        else:
            wide = 2 if ".".join(labels[-2:]) in url_filters.SUFFIXES else 1
            named[host] = (".".join(labels[-wide:]), ".".join(labels[-wide - 1 :]))

    def gather(children, key):
        out = defaultdict(list)
        for k, v in children.items():
            out[key(k)].append(v)
        return {k: (sum(n for n, _ in v), sum(b for _, b in v)) for k, v in out.items()}, out

    def strength(parents, members):
        over = under = 0
        for k, (n, bad) in parents.items():
            c = [x for x in members[k] if x[0]]
            if len(c) > 1 and 0 < bad < n:
                m = bad / n
                over += sum(a * (b / a - m) ** 2 for a, b in c) / (m * (1 - m)) - (len(c) - 1)
                under += n - sum(a * a for a, _ in c) / n - (len(c) - 1)
        rho = max(1e-4, min(0.9, over / under if under > 0 else 1e-4))
        return (1 - rho) / rho

    domains, of_domain = gather({h: counts[h] for h in counts}, lambda h: named[h])
    tops, of_top = gather(domains, lambda k: k[0])
    every, of_all = gather(tops, lambda k: 0)
    n, bad = every[0]
    s_host, s_domain, s_top = strength(domains, of_domain), strength(tops, of_top), strength(every, of_all)
    rate = (bad + 1) / (n + 2)
    out = {}
    for host, (n, bad) in counts.items():
        top = (rate * s_top + tops[named[host][0]][1]) / (s_top + tops[named[host][0]][0])
        mean = (top * s_domain + domains[named[host]][1]) / (s_domain + domains[named[host]][0])
        a, b = mean * s_host + bad, (1 - mean) * s_host + n - bad
        m = a / (a + b)
        out[host] = m - url_filters.Z * math.sqrt(m * (1 - m) / (a + b + 1))
    return out


def test_url_filters_against_plain_shrinkage(spark):
    rng = random.Random(2)
    hosts = ["bad.example.org", "good.example.org", "a.shop.co.uk", "b.shop.co.uk", "x.io", "y.io", "10.0.0.1", "localhost", "u@a.com:80", "hot.com"]
    urls = [None, "", "no scheme", "http://", "HTTP://Bad.Example.ORG/fr/1", "https://EN.example.net/en/", "https://example.net", "https://x.example.net/en", "http://anexample.net/a", "http://example.com/de/9?x#y", "http://example.com/?/de/", "a://b://c/d", "http://net/é/" + "x" * 9000, "http://q?org/fr/", "http://org/fr/5#"]
    labels = []
    for i in range(3000):
        host = rng.choice([*hosts, *["hot.com"] * 10])
        urls.append(f"https://{host}/{rng.choice(['en', 'fr', 'de'])}/{i}{rng.choice(['', '/', '.html', '?p=2'])}")
        if rng.random() < 0.5:
            labels.append((i, rng.random() < {"bad.example.org": 0.97, "x.io": 0.8, "hot.com": 0.02}.get(host, 0.2)))
    labels += [labels[0], (None, True), (7, None)]
    pages = spark.createDataFrame([(i, u, "clash", 1, True) for i, u in enumerate(urls)] + [(None, urls[40], "", 1, None), (3, urls[3], "", 2, None)], "page_id long, url string, host string, n long, bad boolean").repartition(4)
    outcomes = spark.createDataFrame(labels, "page long, bad boolean")
    got = url_filters.judged(pages, outcomes).collect()
    assert len(got) == len(urls) + 2
    known, counts = dict(labels[:-2]), Counter()
    sums = {}
    for u in [*urls, urls[40], urls[3]]:
        host, path = plain_host(u)
        m = re.search(r"/([0-9]{1,18})(?:/|\.[a-z]+)?$", path)
        n, bad = sums.get(host, (0, 0))
        at = known.get(int(m[1])) if m else None
        sums[host] = (n + (at is not None), bad + bool(at))
    bounds = plain_bounds(sums)
    for r in got:
        if r["page_id"] is not None:
            host, path = plain_host(urls[r["page_id"]])
            rule, action = plain_rule(host, path)
            assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
            assert (r["n_labelled"], r["n_bad"]) == sums[host]
            assert abs(r["bound"] - bounds[host]) < 2e-4
            assert r["verdict"] == (action or ("block" if bounds[host] > 0.5 else "allow"))
            counts[r["verdict"], rule] += 1
    assert counts["block", None] and counts["allow", None] and len(counts) >= 6
    none = url_filters.judged(pages, outcomes.limit(0)).collect()
    assert {r["verdict"] for r in none if r["rule"] is None} == {"allow"}
    assert url_filters.judged(pages.limit(0), outcomes).count() == 0


def test_url_filters_stay_in_the_jvm(spark):
    plan = queries.queries()["op12_url_filters"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


H = lambda *x: hashlib.sha256("".join(x).encode()).hexdigest()


def plain_tree(leaves):
    """(root, each leaf's list of (run's nodes left of it, right of it))."""
    level, ways, at = list(leaves), [[] for _ in leaves], list(range(len(leaves)))
    while len(level) > 1:
        for k, i in enumerate(at):
            start = i // 3 * 3
            ways[k].append((level[start:i], level[i + 1 : start + 3]))
        level = [H(*level[k : k + 3]) for k in range(0, len(level), 3)]
        at = [i // 3 for i in at]
    return level[0], ways


def said(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_manifest(rows):
    trees = defaultdict(list)
    for i, text, lang, source, n, *_ in rows:
        leaf, seen = (H(*map(said, (i, source, lang, n, t))) for t in (text, text if text is None or i is None or zlib.crc32(str(i).encode()) % 2 else text.replace("\n", "")))
        trees[source].append((i is not None, i or 0, leaf, seen, i))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        trees[s].sort(key=lambda x: x[:3])
    roots = {s: plain_tree([x[2] for x in trees[s]]) for s in names}
    root, ways = plain_tree([roots[s][0] for s in names])
    out = []
    for s, above in zip(names, ways, strict=True):
        for (_, _, leaf, seen, i), own in zip(trees[s], roots[s][1], strict=True):
            node = seen
            for left, right in own + above:
                node = H(*left, node, *right)
            out.append((i, leaf, roots[s][0], root, H(*(x for left, right in own + above for x in left + right)), node, node == root))
    return sorted(map(repr, out))


def manifest_of(spark, rows, levels, parts=4):
    docs = spark.createDataFrame(rows, DOCS).repartition(parts)
    leaves = merkle.leaves_of(docs, {"text": F.translate("text", "\n", "")}, F.crc32(F.col("doc_id").cast("string")) % 2 == 0)
    return merkle.manifest(leaves, ["doc_id"], levels=levels)


@pytest.mark.parametrize("levels", [0, 1, 2, 7])
def test_manifest_against_a_plain_tree(spark, rows, levels):
    """Blocks of one, three, nine leaves (several rounds of exchange, ragged last subtrees) and of a whole tree."""
    got = manifest_of(spark, rows, levels).collect()
    assert sorted(repr(tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"))) for r in got) == plain_manifest(rows)
    assert {r["verified"] for r in got} == {True, False}
    assert all(H(r["siblings"]) == r["proof_sha256"] for r in got)


@pytest.mark.parametrize("count", [1, 2, 3, 4, 10, 27, 28, 29, 82])
def test_manifest_of_ragged_trees(spark, count):
    rows = [(i, f"a\n{i}", "en", "s", 1, "", 0, 0) for i in range(count)]
    got = manifest_of(spark, rows, 1, 2).collect()
    assert sorted(repr(tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"))) for r in got) == plain_manifest(rows)


def test_manifest_of_nothing(spark, rows):
    docs = spark.createDataFrame(rows, DOCS).limit(0)
    assert merkle.manifest(merkle.leaves_of(docs), ["doc_id"]).count() == 0
