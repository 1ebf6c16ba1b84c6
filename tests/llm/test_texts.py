"""Token counts, packing, quality, licences and LM scoring against the libraries, brute force and held-out rows."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillsight.llm import licenses, lm_scoring, packing, quality_fm, token_counts, tokenizing

public_tokenizers = pytest.importorskip("public_tokenizers")


def test_token_counts_match_the_library(corpus, texts):
    import sentencepiece
    m = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = Counter((i, len((t or "").encode()), len(m.encode(t or "")), len(m.encode(t or "")) > 4096) for i, t in texts)
    assert Counter(map(tuple, token_counts.count_tokens(corpus).collect())) == want
    assert token_counts.count_tokens(corpus.limit(0)).count() == 0
    counter = token_counts.counter("piece_bpe_32k.model")
    assert counter.parted and len(counter.whole) > 10_000
    for text in ("", " ", "  ", "a ", " a", "a  b ", "▁▁the", "the\n the", "<s>x</s>", "\0", "  ▁ "):
        assert counter.count(text) == len(m.encode(text)), repr(text)


def test_byte_level_ids_match_the_library(texts):
    t = tokenizing.byte_level("byte_bpe_50k.json")
    assert t.fast is not None
    for text in [t or "" for _, t in texts] + [" ", "  a", "a \n b", "a\n \u00a0x", "x<|endoftext|>y", "it's 'll 12 ", "\x1c a"]:
        assert np.frombuffer(t.ids(text), "<u4").tolist() == t.whole.encode(text, add_special_tokens=False).ids


def test_byte_level_leaves_a_cache_that_does_not_pay(monkeypatch):
    monkeypatch.setattr(tokenizing, "TRIED_PARTS", 50)
    t, same = (tokenizing.ByteLevel("byte_bpe_50k.json") for _ in range(2))
    rng = np.random.default_rng(5)
    alphabet = ["a", "bc", "é", "12", "!", "'s", " ", "  ", "\n", "\t", "\u00a0", "\u3000", "\x1c", "字"]
    for i in range(400):
        text = "".join(rng.choice(alphabet, rng.integers(0, 30))) + f" new{i} word{i}"
        assert np.frombuffer(t.ids(text), "<u4").tolist() == t.whole.encode(text, add_special_tokens=False).ids, repr(text)
        same.ids("the same words " * 5)
    assert not t.pays and not t.cache and same.pays and same.cache


def test_packing_is_an_exact_round_trip(corpus, texts):
    t = tokenizing.byte_level("byte_bpe_50k.json").whole
    want = Counter((i, tuple(t.encode(x or "", add_special_tokens=False).ids) + (1,)) for i, x in texts)
    rows = packing.pack(corpus).collect()
    sequences, docs = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
        docs[r.doc_id, r.doc_tokens].append(r)
    padding = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length * 4 == len(r["ids"])
            at += r.length
        assert at <= 2048 and len({(r.tier, r.step_group) for r in pieces}) == 1
        padding += 0 if at & (at - 1) == 0 else 2048 - at
    assert padding <= 2048 * corpus.rdd.getNumPartitions()
    single = {k: n for k, n in want.items() if [i for i, _ in want].count(k[0]) == 1 and n == 1}
    for (i, ids), _ in single.items():
        pieces = sorted(docs[i, len(ids)], key=lambda r: r.start)
        assert b"".join(r["ids"] for r in pieces) == np.array(ids, "<u4").tobytes()
    assert sum(r.length for r in rows) == sum(len(ids) * n for (_, ids), n in want.items())
    assert packing.pack(corpus.limit(0)).count() == 0


def test_step_groups_dealt_together_are_balanced():
    dealer, rng = packing.Dealer(0), np.random.default_rng(1)
    windows = packing.GROUP * packing.DEAL
    for i in range(windows):
        cuts = np.sort(rng.integers(0, 2049, rng.integers(0, 12)))
        dealer.take(2048, [(i, 0, bytes(4 * int(n)), 1) for n in np.diff([0, *cuts, 2048]) if n])
    cost, held = Counter(), defaultdict(set)
    for _, _, length, _, _, seq, _, _, group in dealer.out:
        cost[group] += length ** 2
        held[group].add(seq)
    assert len(held) == packing.DEAL and all(len(s) == packing.GROUP for s in held.values())
    assert max(cost.values()) < 1.1 * min(cost.values())
    assert sorted(set().union(*held.values())) == list(range(windows))


def test_quality_learns_structure_and_takes_awkward_rows(spark, corpus):
    rng = np.random.default_rng(3)
    good = [" ".join(f"w{rng.integers(50)}" for _ in range(40)) + "." for _ in range(150)]
    bad = ["### " + " | ".join("spam%%%" for _ in range(30)) if i % 2 else "AGAIN!! " * 40 for i in range(150)]
    docs = spark.createDataFrame([(i, t, len(t), 1) for i, t in enumerate(good + bad)], "doc_id long, text string, n_chars long, idx int")
    labels = spark.createDataFrame([(i, int(i < 150)) for i in range(300)] + [(0, 0), (None, 1), (1, None)], "doc_id long, quality int")
    model = quality_fm.train(docs, labels, learn=F.col("doc_id") % 3 != 0)
    rows = docs.select("doc_id", quality_fm.score_column(docs, model).alias("s")).collect()
    assert np.mean([(r.s >= 0.7) == (r.doc_id < 150) for r in rows if r.doc_id % 3 == 0]) > 0.97
    scores = [r.s for r in corpus.drop("n_chars").select(quality_fm.score_column(corpus.drop("n_chars"), model).alias("s")).collect()]
    assert len(scores) == corpus.count() and all(0 <= s <= 1 for s in scores)
    nobody = quality_fm.train(docs.limit(0), labels.limit(0))
    assert nobody.probability(*quality_fm.features(None, None)) == pytest.approx(0.5)


def test_the_sum_of_squares_identity():
    rng = np.random.default_rng(5)
    m = quality_fm.FactorisationMachine(0.3, rng.normal(size=quality_fm.DIM), rng.normal(size=(quality_fm.DIM, 8)))
    idx, val = np.array([3, 50, 700, 4100]), rng.normal(size=4)
    pairs = sum(m.factors[idx[i]] @ m.factors[idx[j]] * val[i] * val[j] for i in range(4) for j in range(i))
    assert m.raw(idx, val) == pytest.approx(0.3 + m.linear[idx] @ val + pairs)


def test_licences_are_found_and_prose_is_left_alone(spark, corpus):
    lines = ["Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3.", "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0."]
    docs = spark.createDataFrame([(i, f"some prose here\n{x}\n\nthe end of the license story", "x") for i, x in enumerate(lines)]
                                 + [(9, "The license of the driver is under version 2.0 of the plan", "x"), (10, None, "x"), (11, "", "x")], "doc_id long, text string, family string")
    got = {r.doc_id: r for r in licenses.scan(docs).collect()}
    assert [got[i].licences[0].family for i in range(4)] == ["MIT", "GPL", "Apache-2.0", "CC-BY-NC"]
    span = got[0].licences[0]
    assert f"some prose here\n{lines[0]}"[span.start:span.end] == lines[0] and got[0].n_paragraphs == 3
    assert all(len(got[i].licences) == 1 for i in range(4)) and not any(got[i].licences for i in (9, 10, 11)) and got[10].n_paragraphs == 0
    assert not any(r.licences for r in licenses.scan(corpus).collect())
    assert licenses.scan(docs.limit(0)).count() == 0


def test_base_scores_match_brute_force_and_every_id_is_scored_once(corpus, texts, monkeypatch):
    monkeypatch.setattr(lm_scoring, "COMMON", 20)  # the others go through the join
    held = F.coalesce(F.col("doc_id") % 7 == 2, F.lit(False))
    rows = lm_scoring.score_documents(corpus, held).collect()
    out = lambda i: i is not None and i % 7 == 2
    words = lambda t: (t or "").encode().lower().split()
    c, ends = Counter(), 0
    for i, t in texts:
        if not out(i):
            c.update(words(t))
            ends += 1
    total, unit = sum(c.values()) + ends, sum(c.values()) + ends + len(c) + 2
    key = lambda r: tuple(map(str, r))
    want = sorted(((i, out(i), len(words(t)) + 1, sum(c[w] > 0 for w in words(t)) + 1, total,
                    round(sum(math.log10((c[w] + 1) / unit) for w in words(t)) + math.log10((ends + 1) / unit), 5)) for i, t in texts), key=key)
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in rows), key=key) == want
    assert all(r.score < 0 for r in rows)
    assert lm_scoring.score_documents(corpus.limit(0), held).count() == 0


def test_windows_score_each_id_with_its_context():
    rng = np.random.default_rng(0)
    ids = rng.integers(0, 300, 20_000)
    m = lm_scoring.AttentionModel.start(ids[:-1], ids[1:])
    m.ready()
    size, stride = lm_scoring.WINDOW, lm_scoring.STRIDE
    texts = [np.append(rng.integers(0, 300, n), lm_scoring.END_ID) for n in (0, 1, stride - 1, stride, size - 1, size, size + 1, 2 * size, 500)]
    every = np.arange(lm_scoring.IDS)
    for before in (7, 299, 40_000, lm_scoring.START):  # both factors are probabilities, for seen and unseen ids before
        inside = np.exp(m.log_inside(np.full(lm_scoring.IDS, before), every).astype(float))
        assert np.bincount(m.classes[:-1], inside) == pytest.approx(np.ones(lm_scoring.CLASSES), abs=1e-3)
        assert np.exp(m.first[before].astype(float)).sum() == pytest.approx(1, abs=1e-4)
    for ids, got in zip(texts, m.score(texts), strict=True):
        c, want = np.concatenate([[lm_scoring.START], ids]), 0.0
        inside = m.log_inside(c[:-1], c[1:])
        for t in range(len(ids)):
            at = 0 if t < size else ((t - size) // stride + 1) * stride
            z = m.forward(c[None, at:t + 1])[0][0, -1].astype(float)
            want += z[m.classes[c[t + 1]]] - np.log(np.exp(z).sum()) + inside[t]
        assert got == pytest.approx(want / math.log(10), abs=1e-3)


def test_lm_counts_cover_all_training_rows(spark, corpus, monkeypatch):
    held = F.coalesce(F.col("doc_id") % 7 == 2, F.lit(False))
    want = {(r.doc_id, r.n_tokens): r.score for r in lm_scoring.score_documents(corpus, held).collect()}
    encode = tokenizing.byte_level("byte_bpe_50k.json").ids
    pairs, n = Counter(), 0
    for r in corpus.where(~held).collect():
        ids = lm_scoring._ids(r.text, encode).tolist()
        pairs.update(a * lm_scoring.IDS + b for a, b in zip([lm_scoring.START, *ids], ids, strict=False))
        n += -(-len(ids) // lm_scoring.WINDOW)
    monkeypatch.setattr(lm_scoring, "SORT_IDS", 100)
    monkeypatch.setattr(lm_scoring, "HELD_PAIRS", 50)
    rows = lm_scoring.token_rows(corpus, held, "byte_bpe_50k.json").where("NOT held_out")
    counted = lm_scoring.pair_counts(rows)
    assert {r.key: r.n for r in counted.collect()} == pairs
    windows = lm_scoring.windows_of(rows, 1.0, 3).collect()  # more than 32 of the long text, and none lost
    assert sum(r.n for r in windows) == n > 40 and {r.group for r in windows} == {0, 1, 2}
    monkeypatch.setattr(lm_scoring, "COMMON_PAIRS", 10)  # the others go through the join
    got = {(r.doc_id, r.n_tokens): r.score for r in lm_scoring.score_documents(corpus, held).collect()}
    assert got == pytest.approx(want, rel=1e-4)
    model = lm_scoring.AttentionModel.start(np.array([5] * 3), np.array([6] * 3))
    monkeypatch.setattr(lm_scoring, "GROUP_WINDOWS", 100)  # several groups
    assert not np.allclose(lm_scoring.trained(model, rows, n).p["pair"], 0)


def test_lm_trains_on_every_window(spark, corpus, monkeypatch):
    asked, dealt = [], lm_scoring.windows_of
    monkeypatch.setattr(lm_scoring, "windows_of", lambda rows, share, groups: asked.append((share, groups)) or dealt(rows, share, groups))
    monkeypatch.setattr(lm_scoring, "GROUP_WINDOWS", 20)
    rows = lm_scoring.token_rows(corpus, F.lit(False), "byte_bpe_50k.json")
    n = rows.agg(F.sum(F.expr(f"(n + {lm_scoring.WINDOW - 1}) div {lm_scoring.WINDOW}"))).first()[0]
    lm_scoring.trained(lm_scoring.AttentionModel.start(np.array([5] * 3), np.array([6] * 3)), rows, n)
    assert asked == [(1.0, -(-n // 20))] and n > 40
    m, size = lm_scoring.AttentionModel.start(np.arange(100), np.arange(1, 101)), lm_scoring.STEPS * lm_scoring.BATCH + 1000
    forward, seen = m.forward, []
    m.forward = lambda x: seen.append(x[:, 0]) or forward(x)
    windows = np.full((size, lm_scoring.WINDOW + 1), -1)
    windows[:, 0], windows[:, 1] = np.arange(size), 7
    m.train(windows)
    assert np.array_equal(np.sort(np.concatenate(seen)), np.arange(size))


def test_lm_training_follows_the_gradient():
    rng = np.random.default_rng(1)
    ids = np.repeat(rng.integers(0, 60, 4000), 2)  # every id comes twice
    m = lm_scoring.AttentionModel.start(ids[:-1], ids[1:])
    windows = np.lib.stride_tricks.sliding_window_view(ids, lm_scoring.WINDOW + 1)[::lm_scoring.WINDOW]
    m.ready()
    before = m.log_class(windows).mean()
    m.train(windows, np.arange(1, len(windows) + 1))
    assert m.log_class(windows).mean() > before + 0.2


def _plain_loss(m, p, windows):
    """Mean cross entropy of the classes in double precision, from the four tables of the attention one by one."""
    x, y, on = np.maximum(windows[:, :-1], 0), m.classes[np.maximum(windows[:, 1:], 0)], windows[:, 1:] >= 0
    e = p["emb"][m.classes[x]] + p["pos"]
    a = (e @ p["q"]) @ (e @ p["k"]).transpose(0, 2, 1) / math.sqrt(lm_scoring.WIDTH)
    a = np.exp(a) * np.tri(lm_scoring.WINDOW)
    h = np.tanh(a / a.sum(-1, keepdims=True) @ (e @ p["v"]) @ p["o"] + e)
    z = h @ p["out"] + p["pair"][m.classes[x]] + m.first[x]
    got = np.take_along_axis(z, y[..., None], 2)[..., 0] - np.log(np.exp(z).sum(-1))
    return -got[on].mean()


@pytest.mark.parametrize("bound", [lm_scoring.BOUND, 0.01])  # 0.01: the shifted forms
def test_lm_steps_follow_the_slope_of_each_table(monkeypatch, bound):
    rng = np.random.default_rng(6)
    ids = rng.integers(0, 200, 4000)
    m = lm_scoring.AttentionModel.start(ids[:-1], ids[1:])
    windows = np.lib.stride_tricks.sliding_window_view(ids, lm_scoring.WINDOW + 1)[::lm_scoring.WINDOW][:40].copy()
    windows[:5, 20:] = -1
    for n in ("out", "pair", "emb", "pos"):
        m.p[n] = rng.normal(0, 0.5, m.p[n].shape)
    start = {n: x.astype(float) for n, x in m.p.items()}
    monkeypatch.setattr(lm_scoring, "STEPS", 1)
    monkeypatch.setattr(lm_scoring, "BOUND", bound)
    m.fit(windows)
    for n, before in start.items():  # Adam's first step: 0.02 against the sign of each slope
        for at in rng.integers(0, before.size, 12):
            ends = []
            for move in (-1e-4, 1e-4):
                moved = before.copy()
                moved.flat[at] += move
                ends.append(_plain_loss(m, {**start, n: moved}, windows))
            if abs(slope := (ends[1] - ends[0]) / 2e-4) > 1e-5:
                assert m.p[n].flat[at] - before.flat[at] == pytest.approx(-0.02 * np.sign(slope), rel=0.01), (n, at)


def test_lm_training_weighs_classes_without_single_exponentials(monkeypatch):
    rng = np.random.default_rng(7)
    ids = rng.integers(0, 300, 20_000)
    m = lm_scoring.AttentionModel.start(ids[:-1], ids[1:])
    made, each = [], lm_scoring.powers
    monkeypatch.setattr(lm_scoring, "powers", lambda t, *a: made.append(len(t) * (t.ndim == 2)) or each(t, *a))
    windows = np.lib.stride_tricks.sliding_window_view(ids, lm_scoring.WINDOW + 1)[::lm_scoring.WINDOW]
    monkeypatch.setattr(lm_scoring, "STEPS", 1)
    m.train(windows)
    assert sum(made) == windows[:, 1:].size  # rows of classes: one an id


def test_lm_model_size_and_context():
    assert (lm_scoring.CLASSES, lm_scoring.SINGLE) == (128, 112)
    m = lm_scoring.AttentionModel.start(np.array([1, 2, 3]), np.array([2, 3, 1]))
    m.ready()
    seen = []
    m.log_class = lambda w: seen.append(w) or np.zeros((len(w), lm_scoring.WINDOW))
    m.score([np.append(np.arange(200), lm_scoring.END_ID)])
    w = np.concatenate(seen)
    overlap = [len(np.intersect1d(a[:-1], b[:-1])) for a, b in zip(w, w[1:], strict=False)]
    assert min(overlap[:-1]) == 8  # the first id that a later window scores has 8 ids before the one it follows


def test_lm_scores_no_position_twice(monkeypatch):
    rng = np.random.default_rng(2)
    ids = rng.integers(0, 300, 20_000)
    m = lm_scoring.AttentionModel.start(ids[:-1], ids[1:])
    m.p["out"] = rng.normal(0, 0.5, m.p["out"].shape)
    m.ready()
    made, each = [], lm_scoring.powers
    monkeypatch.setattr(lm_scoring, "powers", lambda t, *a: made.append(len(t) * (t.ndim == 2)) or each(t, *a))
    texts = [rng.integers(0, 300, lm_scoring.WINDOW + k * lm_scoring.STRIDE) for k in (0, 1, 7, 40)]  # no pads
    got = m.score(texts)
    assert sum(made) == sum(map(len, texts))  # rows of classes: one an id
    m.bound = lm_scoring.BOUND + 1  # the shifted form
    assert m.score(texts) == pytest.approx(got, rel=1e-5)


def test_lm_groups_train_side_by_side(spark, corpus):
    rows = lm_scoring.token_rows(corpus.union(corpus), F.lit(False), "byte_bpe_50k.json")
    dealt = lm_scoring.windows_of(rows, 1.0, 40)
    got = dealt.groupBy(F.spark_partition_id().alias("part")).agg(F.count_distinct("group").alias("groups"), F.sum("n").alias("n")).collect()
    assert len(got) > 20 and all(r.groups == 1 for r in got)  # no task has two while another has none
    found = dealt.toPandas()
    ids = np.frombuffer(b"".join(found["ids"]), f"S{2 * (lm_scoring.WINDOW + 1)}")
    key, one, n = lm_scoring.distinct_windows(found["key"].to_numpy(), ids, found["n"].to_numpy())
    want = Counter(zip(found["key"], map(bytes, found["ids"]), strict=True))
    raw = one.tobytes()
    assert {(k, raw[66 * i:66 * i + 66]): c for i, (k, c) in enumerate(zip(key.tolist(), n.tolist(), strict=True))} == want and set(n % 2) == {0}
    assert np.array_equal(key, np.sort(key))


def test_lm_powers_are_exponentials():
    for most in (0.01, 1, 7, 60):
        halvings = max(0, math.ceil(math.log2(8 * most)))
        z = np.linspace(-most, most, 10_001).astype(np.float32)
        got = lm_scoring.powers(z / np.float32(2 ** halvings), halvings, np.empty_like(z))
        assert got == pytest.approx(np.exp(z.astype(float)), rel=3e-7 * 2 ** halvings + 1e-6)


def test_lm_words_of_a_batch_are_hashed_as_single_words(monkeypatch):
    rng = np.random.default_rng(8)
    alphabet = ["A", "a", "b" * 9, "é", "É", "Z", " ", "\n", "\t", "\x0b", "\x1c", "\u00a0", "\0"]
    texts = [None if rng.random() < 0.1 else "".join(rng.choice(alphabet, rng.integers(0, 25))) for _ in range(2000)]
    words = [(t or "").encode().lower().split() for t in texts]
    known = {}
    for size in (4, 16, 1 << 15):  # words longer than what is hashed at once, too
        monkeypatch.setattr(lm_scoring, "HASH_BYTES", size)
        for low in range(0, len(texts), 100):
            some = pa.array(["x y", *texts[low:low + 100]], pa.string())[1:]
            hashes, first = lm_scoring.word_hashes(some)
            assert np.diff(first).tolist() == [len(w) for w in words[low:low + 100]]
            for word, h in zip((w for row in words[low:low + 100] for w in row), hashes.tolist(), strict=True):
                assert known.setdefault(word, h) == h
    assert len(set(known.values())) == len(known) > 1000
    for none in ([], [None], ["", None, " \n"]):
        assert [x.tolist() for x in lm_scoring.word_hashes(pa.array(none, pa.string()))] == [[], [0] * (len(none) + 1)]


def test_lm_pairs_are_looked_up_in_any_order():
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 50, 3000)
    m = lm_scoring.AttentionModel.start(ids[:-1], ids[1:])
    want = Counter((ids[:-1] * lm_scoring.IDS + ids[1:]).tolist())
    last = lm_scoring.START * lm_scoring.IDS + lm_scoring.END_ID  # the largest key, unseen
    key = np.concatenate([rng.permutation(np.repeat(np.array(list(want)), 2)), [last, 0, 60, last]])
    times, hit = m.held(key)
    assert times.tolist() == [want[k] for k in key.tolist()] and hit.tolist() == [k in want for k in key.tolist()]


def test_licence_notices_wrapped_over_lines_are_found():
    model, templates = licenses.fit(["some ordinary prose of the version", "the terms of the work"]), licenses.Templates(licenses.TEMPLATES)
    gpl = ("# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General Public License as published by\n"
           "# the Free Software Foundation, either version 3 of the License, or\n# (at your option) any later version.")
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:"
    count, found = licenses.scan_text(f"some prose\n\n{gpl}\n\n{bsd}\nthe end", model, templates)
    assert count == 8 and [f[2] for f in found] == ["GPL", "BSD"]
    text = f"some prose\n\n{gpl}\n\n{bsd}\nthe end"
    assert text[found[0][0]:found[0][1]] == gpl.split(", either")[0] + ", either version 3 of the License, or" and text[found[1][0]:found[1][1]] == bsd
    words = bsd.split()
    assert [f[2] for f in licenses.scan_text("\n".join(words), model, templates)[1]] == ["BSD"]  # a word a line
    assert not licenses.scan_text("\n\n".join(words), model, templates)[1]
    pair = "Released under the MIT License.\nLicensed under CC BY 4.0."  # neighbours stay two notices
    assert [pair[f[0]:f[1]] for f in licenses.scan_text(pair, model, templates)[1]] == pair.split("\n")


def test_quality_sample_takes_one_row_of_a_repeated_id(spark, monkeypatch):
    docs = spark.createDataFrame([(1, f"text {i}", i) for i in range(300)] + [(2, "other", 5), (3, None, None)], "doc_id long, text string, n_chars long")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, quality int")
    collected = []
    monkeypatch.setattr(type(docs), "toPandas", lambda self, f=type(docs).toPandas: collected.append(f(self)) or collected[-1])
    monkeypatch.setattr(quality_fm, "fit", lambda rows, y, **_: (rows, y.tolist()))
    rows, y = quality_fm.train(docs, labels)
    assert y == [1, 0, 0] and len(rows) == 3 and [len(c) for c in collected] == [3]


#: Texts worded apart from the training lines, and the families that they state.
STATED = [
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.","AGPL"),
    ("This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.","LGPL"),
    ("Licensed under the Apache License, Version 1.1","Apache-1.1"),
    ("He studied at MIT and released under the sea a balloon; the MIT license plate",""),
    ("This is not released under the MIT License",""),
    ("SPDX-License-Identifier: GPL-2.0-or-later","GPL"),
    ("// SPDX-License-Identifier: (MIT OR Apache-2.0) AND ISC","Apache-2.0,ISC,MIT"),
    ("SPDX-License-Identifier: AGPL-3.0-only","AGPL"),
    ("SPDX-License-Identifier: EPL-2.0","EPL"),
    ("SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0","GPL"),
    ("This work is licensed under CC BY-NC-SA 4.0.","CC-BY-NC-SA"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.","CC-BY-NC-SA"),
    ('Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the "Software"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:',"MIT"),
    ("Redistributions of source code must retain the above copyright notice, this\nlist of conditions and the following disclaimer.","BSD"),
    ("This is free and unencumbered software released into the public domain.","Unlicense"),
    ("Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.","ISC"),
    ("   Licensed under the Apache License, Version 2.0 (the \"License\");\n   you may not use this file except in compliance with the License.\n   You may obtain a copy of the License at\n\n       http://www.apache.org/licenses/LICENSE-2.0\n\n   Unless required by applicable law or agreed to in writing, software\n   distributed under the License is distributed on an \"AS IS\" BASIS,\n   WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.","Apache-2.0"),
    ("This program is free software; you can redistribute it and/or\nmodify it under the terms of the GNU General Public License\nas published by the Free Software Foundation; either version 2\nof the License, or (at your option) any later version.","GPL"),
    ("Released under the MIT License.","MIT"),
    ("Licensed under the Apache License, Version 2.0.","Apache-2.0"),
    ("Licensed under CC BY-NC 4.0.","CC-BY-NC"),
    ("This work is licensed under the GNU General Public License, version 3.","GPL"),
    ("The committee discussed the MIT license and the GPL for hours.",""),
    ("It was never licensed under the Apache License, Version 2.0.",""),
    ("Licensed under the Apache License, Version 3.0.",""),
    ("Licensed under the Artistic License, version 2.0",""),
    ("the car was released under the new rules of the license office version 2.0",""),
    ("old words here and there "*10+" Released under the MIT License. "+"more words of prose "*20,"MIT"),
    ("This project is dual licensed under the MIT license and the Apache License, Version 2.0.","Apache-2.0,MIT"),
    ("This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/.","MPL-2.0"),
    ("Licensed under the BSD 2-Clause License.","BSD"),
    ("Licensed under the ISC license.","ISC"),
    ("Licensed under CC BY 4.0.","CC-BY"),
    ("Licensed under CC BY-SA 4.0.","CC-BY-SA"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.","CC-BY"),
    ("Licensed under the Eclipse Public License, version 1.0.","EPL"),
]


def test_licences_of_held_out_texts_and_hard_negatives():
    """Headers, bodies, versions, SPDX expressions, prose about licences and denied notices."""
    model, templates = licenses.fit(["some ordinary prose of the version", "the terms of the work"]), licenses.Templates(licenses.TEMPLATES)
    wrong = []
    for text, stated in STATED:
        found = {f[2] for f in licenses.scan_text(text, model, templates)[1]}
        if ",".join(sorted(found)) != stated:
            wrong.append((text, stated, found))
    assert not wrong
    version = lambda text: [(f[2], f[5]) for f in licenses.scan_text(text, model, templates)[1]]
    assert version(STATED[1][0]) == [("LGPL", "2.1+")] and version("Released under the MIT License.\nLicensed under CC BY 4.0.") == [("MIT", None), ("CC-BY", "4.0")]
    assert version("SPDX-License-Identifier: GPL-2.0-or-later") == [("GPL", "2.0+")]
    # denied or merely named, every family's notices are nothing
    for family, notices in licenses.NOTICES.items():
        for notice in notices:
            assert not licenses.scan_text(f"Here the text says: this is not {notice[0].lower()}{notice[1:]}", model, templates)[1], (family, notice)


def test_verbatim_notices_match_a_plain_template_scan():
    """In random prose, the finds are those of a search for the templates' own texts."""
    rng = random.Random(3)
    prose = "the of and version work terms may not use this software person copy under public source program free".split()
    model, templates = licenses.fit(["some ordinary prose of the version", "the terms of the work"]), licenses.Templates(licenses.TEMPLATES)
    every = [(f, t) for f, ts in licenses.TEMPLATES.items() for t in ts] + [(f, f"SPDX-License-Identifier: {x}") for f, xs in licenses.SPDX.items() for x in xs]
    for _ in range(150):
        parts = [" ".join(rng.choice(prose) for _ in range(rng.randrange(1, 40))) for _ in range(rng.randrange(1, 6))]
        for _ in range(rng.randrange(3)):
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(every)[1])
        text = "\n\n".join(parts)
        lines = text.split("\n")
        plain = {(line, f) for line in lines for f, t in every if line == t}
        found = {(text[x[0]:x[1]], x[2]) for x in licenses.scan_text(text, model, templates)[1]}
        assert found == plain, (found ^ plain, text)
