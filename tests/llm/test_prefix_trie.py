"""The conversation trie against a plain recomputation."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tillsight.llm import prefix_trie
from tillsight.llm.queries import op11_conversation_trie

COLUMNS = "conv_id long, turn long, role string, text string"
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuild(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            own[conv].append((turn is not None, turn or 0, key, (role, text)))
    own = {c: [x[3] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h, base = zlib.crc32(str(c).encode()) % 4, c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(convs):
    members, children = defaultdict(list), defaultdict(set)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[:d - 1])].add(tuple(turns[:d]))
    leaves, saved, out = Counter(), Counter(), Counter()
    for path, m in members.items():
        own = (len(m) - 1) * (len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0)
        for d in range(len(path) + 1):
            leaves[path[:d]] += not children[path]
            saved[path[:d]] += own
    for path, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(path))
        out[min(m), len(path), min(members[path[:-1]]) if path else None, len(m), len(children[path]), leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


def got(df):
    return Counter(tuple(r[c] for c in NAMES) for r in df.collect())


def some_rows(rng, convs=150, alphabet=3, most=9):
    texts = ["Two words", "one", "", " a\tb c d ", None, "x " * 5000]
    rows = []
    for c in range(convs):
        for t in range(rng.randrange(most)):
            rows.append((c, t if rng.random() < 0.9 else None, rng.choice(["user", "assistant", None][:alphabet]), texts[rng.randrange(alphabet)] if t < 4 else rng.choice(texts)))
    return rows


def awkward(rng):
    rows = some_rows(rng)
    rows += [(1000 + i, t, "user", f"copy {t}") for i in range(120) for t in range(7)]  # a third are equal
    rows += [(3000 + 20 * i, t, "system", "same start" if t == 0 else f"{i} {t}") for i in range(30) for t in range(3)]
    rows += [(2000, t, "user", f"long {t}") for t in range(60)] + [(2020, t, "user", f"long {t}") for t in range(45)] + [(2040, t, "user", f"long {t}") for t in range(60)]
    rows += [(-7, 0, "a", "neg"), (-7, 0, "a", "neg"), (-7, 0, "b", "tie"), (-40, 1, None, None), (None, 0, "user", "no conversation")]
    return rows


def ran(spark, scratch, rows):
    df = spark.createDataFrame(rows, COLUMNS).select("*", *[F.lit("x").alias(c) for c in ("digest", "words", "place", "path", "band", "base", "row", "h")])
    df.repartition(5).write.parquet(f"{scratch}/conversations.parquet")
    return op11_conversation_trie(spark, scratch)


def test_all_kinds_of_rows(spark, scratch):
    rows = awkward(random.Random(5))
    assert got(ran(spark, scratch, rows)) == brute(rebuild(rows))


def test_empty_table(spark, scratch):
    assert ran(spark, scratch, []).count() == 0


def test_one_turnless_conversation(spark, scratch):
    c = next(i for i in range(1, 100) if zlib.crc32(str(i).encode()) % 4 == 3 and i % 20)
    rows = [(c, 0, "user", "lost")]  # its base is absent and its only turn is within the first three
    assert got(ran(spark, scratch, rows)) == brute(rebuild(rows))
    assert len(brute(rebuild(rows))) == 1


@pytest.mark.parametrize("band", [1, 2, 5])
def test_bands_give_the_same(spark, scratch, band, monkeypatch):
    rows = awkward(random.Random(band))
    monkeypatch.setattr(prefix_trie, "BAND", band)
    monkeypatch.setattr(prefix_trie.trie, "__defaults__", (band,))
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    monkeypatch.setattr(prefix_trie, "SAMPLES", 2)
    assert got(ran(spark, scratch, rows)) == brute(rebuild(rows))


def test_copies_span_shards_and_their_nodes_are_in_the_skeleton(spark):
    rows = [(i, t, "user", f"copy {t}") for i in range(2000) for t in range(3)]
    turns = prefix_trie.rebuilt(spark.createDataFrame(rows, COLUMNS), F.col("conv_id"), F.lit(0))
    paths = prefix_trie.banded(turns, 256)
    cuts = prefix_trie.splitters(paths, 8)
    assert len(cuts) > 3 and len({p for p, _ in cuts}) == 1
    assert len(prefix_trie.skeleton_of(cuts)) == 4


def test_last_turns(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi"), (1, 1, None, "there"), (2, 0, "user", "Hi"), (2, 1, "bot", None)], COLUMNS)
    turns = prefix_trie.rebuilt(df, F.col("conv_id"), F.lit(0))
    rows = prefix_trie.last_turns(prefix_trie.trie(turns), turns, df).collect()
    assert sorted((r.depth, r.conv_id, r.role, r.text) for r in rows if r.depth) == [(1, 1, "user", "Hi"), (2, 1, "", "there"), (2, 2, "bot", "")]
