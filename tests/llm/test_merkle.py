"""The Merkle manifest against a plain recomputation."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tillsight.llm import merkle
from tillsight.llm.queries import op13_merkle_manifest

COLUMNS = "doc_id long, source string, lang string, n_chars long, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, low=False):
    values = [*row[:4], None if row[4] is None else re.sub("[A-Z]+", lambda m: m[0].lower(), row[4]) if low else row[4]]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def reduced(nodes):
    """The last node, and for each first node its (others left, others right) per level."""
    paths, owners = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(i, min(i + 16, len(nodes))) for i in range(0, len(nodes), 16)]
        for run in runs:
            for i in run:
                for x in owners[i]:
                    paths[x].append(("".join(nodes[run[0]:i]), "".join(nodes[i + 1:run[-1] + 1])))
        nodes, owners = [h(*nodes[r[0]:r[-1] + 1]) for r in runs], [[x for i in r for x in owners[i]] for r in runs]
    return nodes[0], paths


def brute(rows):
    trees, out = defaultdict(list), Counter()
    for r in rows:
        trees[r[1]].append(r)
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        trees[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    each = [reduced([leaf(r) for r in trees[s]]) for s in names]
    root, upper = reduced([d for d, _ in each])
    for s, (sub, paths), up in zip(names, each, upper, strict=True):
        for r, path in zip(trees[s], paths, strict=True):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            now = leaf(r, tampered)
            for left, right in path + up:
                now = h(left, now, right)
            out[r[0], leaf(r), sub, root, h(*[a + b for a, b in path + up]), now, now == root] += 1
    return out


def got(df):
    return Counter((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified) for r in df.collect())


def ran(spark, scratch, rows, extra=True):
    docs = spark.createDataFrame(rows, COLUMNS)
    if extra:  # names that the operator uses itself
        docs = docs.select("*", *[F.lit("x").alias(c) for c in ("leaf", "digest", "pos", "tree", "id", "at", "row", "nodes", "proof", "_low")])
    docs.write.parquet(f"{scratch}/documents.parquet")
    return op13_merkle_manifest(spark, scratch)


def test_all_kinds_of_rows(spark, scratch):
    rows = [(i, "hot", "en", None if i % 7 == 0 else i, None if i % 11 == 0 else "Text Ä " * (i % 4)) for i in range(700)]
    rows += [(i, f"s{i % 40}", None, i, "A" * (200_000 if i == 701 else 3)) for i in range(700, 900)]
    rows += [(None, None, None, None, None), (None, None, None, None, ""), (5, None, "x", 1, "Q"), (5, "hot", "en", 5, "other"), (5, "", "", 0, "")]
    rows += [(42, "same", "en", 1, "Copy")] * 300 + [(-3, "one", "en", 1, "ABC")]
    assert got(ran(spark, scratch, rows)) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 16, 17, 256, 257, 4097])
def test_sizes_around_runs(spark, scratch, n):
    rows = [(i, "s", "en", i, f"Text {i}") for i in range(n)]
    assert got(ran(spark, scratch, rows, extra=False)) == (brute(rows) if n else Counter())


def test_many_sources(spark, scratch):
    rows = [(i, f"s{i}", "en", i, "T") for i in range(300)]
    assert got(ran(spark, scratch, rows)) == brute(rows)


def test_only_every_second_level_is_stored(spark):
    docs = spark.createDataFrame([(i, "s", "en", i, "t") for i in range(4097)], COLUMNS)
    m = merkle.manifest(docs)
    stored = [sum(r.k for r in t.select(F.size("nodes").alias("k")).collect()) for t in m.tiers]
    assert stored == [4097, 17]  # levels 0 and 2; levels 1 (257 nodes) and 3 (2) are recomputed
