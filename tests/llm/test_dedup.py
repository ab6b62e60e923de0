"""The n-gram join, repeated windows and line dedup against brute force."""

from __future__ import annotations

import collections
import hashlib
import random
import time
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickspark.llm import common, line_dedup, ngram_join, queries, window_dedup

SCHEMA = "doc_id long, text string, lang string, n long, bucket int, spans string"


def table_of(spark, texts: dict):
    return spark.createDataFrame([(d, t, None, 1, 2, "x") for d, t in texts.items()], SCHEMA)


def documents(spark, sf_dir) -> dict:
    return {r["doc_id"]: r["text"] for r in queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()}


def small_corpus(seed: int = 1) -> dict:
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdé") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    base, passage = say(120), say(60)
    out = {0: base, 1: base, 2: base.upper(), 3: "", 4: None, 5: "one two", 6: "ONE  two\t", 7: passage + " " + say(200), 8: say(150) + " " + passage, 9: "aaaa" * 400, 10: "aaaa" * 90, 11: " \n\t "}
    for k in range(20, 80):  # near copies, some linked only through others
        w = base.split(" ")
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(len(w))] = rng.choice(words)
        out[k] = " ".join(w)
    for k in range(100, 140):
        out[k] = say(rng.randint(1, 90)) + "\n" + (passage if k % 3 == 0 else "") + "\n" + say(5)
    return out


def brute_components(texts: dict) -> dict:
    sets = {}
    for d, t in texts.items():
        w = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m.group().lower(), (t or "").encode()))
        sets[d] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    up = {d: d for d in texts}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(texts)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                up[y] = x
    return {d: (len(sets[d]), top(d)) for d in texts}


def brute_windows(texts: dict, size: int = 50) -> dict:
    first, out = {}, {}
    for d in sorted(texts):
        b = (texts[d] or "").encode()
        cover = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if first.setdefault(b[i : i + size], d) != d:
                cover[i : i + size] = b"\1" * size
        kept = bytes(x for x, c in zip(b, cover) if not c)
        out[d] = (len(b), len(b) - len(kept), len(re.findall(b"\1+", bytes(cover))), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("part, grams", [(3, 1 << 20), (256, 40), (256, 1 << 20)])
def test_components(spark, monkeypatch, part, grams):
    monkeypatch.setattr(ngram_join, "PART", part)
    monkeypatch.setattr(ngram_join, "PART_GRAMS", grams)
    monkeypatch.setattr(ngram_join, "SLICE", 64)
    texts = small_corpus()
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.ngram_components(table_of(spark, texts)).collect()}
    assert got == brute_components(texts)


def test_chained_blocks(spark, monkeypatch):
    """A chain of columns is taken apart into its columns; whoever shares one and may link still meets."""
    monkeypatch.setattr(ngram_join, "PART", 3)
    held = [(d, h) for h in range(40) for d in (h, h + 1)] + [(d, 500) for d in range(7)] + [(d, 501) for d in range(7)]
    held += [(d, h) for h in (900, 901) for d in (200, 201)]
    size = {d: 20 + 3 * (d % 9) for d in range(41)} | {200: 5, 201: 5}
    ahead = spark.createDataFrame(held, "doc_id long, h long")
    sets = spark.createDataFrame([(d, list(range(n))) for d, n in size.items()], "doc_id long, grams array<long>")
    block = spark.createDataFrame([(d, 0 if d < 100 else 200) for d in size], "node long, component long")
    member, met = ngram_join.blocks_to_multiply(block, ahead, sets, 80)
    member, met = member.collect(), {(m["block"], m["k"], m["k2"]) for m in met.collect()}
    blocks = collections.defaultdict(dict)
    for m in member:
        blocks[m["block"]][m["doc_id"]] = m["k"]
    assert blocks[200] == {200: 0, 201: 0} and len(blocks) == 42  # the columns 500 and 501 are one
    met_docs = {(a, b) for g, of in blocks.items() for a, x in of.items() for b, y in of.items() if (g, x, y) in met}
    for h in {h for _, h in held}:
        own = [d for d, g in held if g == h]
        assert all((a, b) in met_docs for a in own for b in own if 5 * min(size[a], size[b]) >= 4 * max(size[a], size[b]))


def test_components_on_documents(spark, sf_dir):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in queries.op9_ngram_join(spark, sf_dir).collect()}
    assert got == brute_components(documents(spark, sf_dir))


@pytest.mark.parametrize("heavy", [2, 30, 10_000])
def test_windows(spark, monkeypatch, heavy):
    monkeypatch.setattr(window_dedup, "HEAVY_RUNS", heavy)
    texts = small_corpus(2)
    phrase = "a phrase of many documents"
    texts |= {1000 + k: f"{k * 7919 % 1000:x} {k} {phrase} {k} own words {k * 31}" for k in range(150)}
    out = window_dedup.remove_repeats(table_of(spark, texts)).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_bytes"] - len(r["kept"]), len(r["spans"]), hashlib.sha256(r["kept"]).hexdigest()) for r in out}
    assert got == brute_windows(texts)


def test_windows_on_documents(spark, sf_dir):
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in queries.op10_window_dedup(spark, sf_dir).collect()}
    assert got == brute_windows(documents(spark, sf_dir))


def test_windows_that_agree_in_their_first_digit(spark, monkeypatch):
    """With digits that often collide, bytes decide."""
    real = window_dedup.rolling
    monkeypatch.setattr(window_dedup, "rolling", lambda raw, width, *a, **k: real(raw, width, *a, **k) & np.uint64(15))
    texts = [(texts or "").encode() for _, texts in sorted(small_corpus(3).items())]
    ids = np.arange(len(texts))
    n = np.array([len(t) for t in texts])
    keep = n >= 50
    payload = int(keep.sum()).to_bytes(8, "little") + common.pack([ids[keep], (n - 49)[keep]]) + b"".join(t for t in texts if len(t) >= 50)
    out = window_dedup._repeated(50)(pa.table({"kind": [0], "payload": pa.array([payload], pa.binary())}))
    cover = {d: bytearray(len(t)) for d, t in enumerate(texts)}
    for d, span in zip(out.column("doc_id").to_pylist(), out.column("span").to_pylist()):
        cover[d][span >> 32 : (span >> 32) + (span & 0xFFFFFFFF)] = b"\1" * (span & 0xFFFFFFFF)
    assert {d: sum(c) for d, c in cover.items()} == {d: v[1] for d, v in brute_windows(dict(enumerate(t.decode() for t in texts))).items()}


@pytest.mark.parametrize("size", [1, 3, 8, 9, 16, 50])
def test_radix_passes_equal_sets_of_windows(size):
    rng = random.Random(size)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randint(size, size + 90))).encode() for _ in range(12)]
    texts += [texts[0][: size + 5], b"a" * (size + 40), b"b" + b"a" * (size + 20)]
    raw = np.frombuffer(b"".join(texts), np.uint8)
    at, owner, base = [], [], 0
    for d, t in enumerate(texts):
        at += range(base, base + len(t) - size + 1)
        owner += [3 * d] * (len(t) - size + 1)
        base += len(t)
    first: dict[bytes, int] = {}
    want = [first.setdefault(raw[a : a + size].tobytes(), d) != d for a, d in zip(at, owner)]
    assert window_dedup.repeats(raw, np.array(at), np.array(owner), size).tolist() == want
    assert window_dedup.repeats(raw, np.zeros(0, np.int64), np.zeros(0, np.int64), size).tolist() == []


def test_one_long_run_of_equal_windows(spark):
    texts = {1: "a" * 100_000, 2: "b" * 30 + "a" * 70_000 + "c", 3: "a" * 49, 4: "a" * 50}
    got = {r["doc_id"]: r["kept"].decode() for r in window_dedup.remove_repeats(table_of(spark, texts)).collect()}
    assert got == {1: texts[1], 2: "b" * 30 + "c", 3: texts[3], 4: ""}


def test_rolling_in_pieces():
    raw = np.frombuffer(random.Random(3).randbytes(5000), np.uint8)
    assert (window_dedup.rolling(raw, 16, 700) == window_dedup.rolling(raw, 16)).all()


@pytest.mark.parametrize("operator", [ngram_join.ngram_components, window_dedup.remove_repeats, line_dedup.dedup_lines])
def test_edge_rows(spark, operator):
    assert operator(table_of(spark, {1: "x"}).limit(0)).count() == 0
    rows = [(None, "a", None, 1, 2, "x"), (1, "same line of some length here", None, 1, 2, "x"), (1, "same line of some length here", None, 1, 2, "x"), (1, "zz", None, 1, 2, "x"), (2, None, None, None, None, None)]
    assert sorted(r["doc_id"] for r in operator(spark.createDataFrame(rows, SCHEMA)).collect()) == [1, 2]


def test_large_group_of_copies(spark):
    text = " ".join(f"w{k}" for k in range(100))
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(text).alias("text"))
    assert ngram_join.ngram_components(df).filter("component_id <> 0").count() == 0
    assert window_dedup.remove_repeats(df).filter("octet_length(kept) > 0").count() == 1
    assert line_dedup.dedup_lines(df).filter("not emptied").count() == 1


@pytest.mark.parametrize("most", [0, 1_000_000])
def test_connected_components(spark, monkeypatch, most):
    monkeypatch.setattr(common, "MOST_JUMPS", most)
    edges = [(k, k + 1) for k in range(0, 40)] + [(100, 101), (103, 102), (102, 100), (200, 200)]
    edges += [(1000, k) for k in range(1001, 1300)] + [(999, 1299)]  # a centre of many, and one below it
    rng = random.Random(5)
    rng.shuffle(edges)
    table = spark.createDataFrame(edges, "a long, b long").repartition(16)
    got = [(r["node"], r["component"]) for r in common.components(table).collect()]
    want = {k: 0 for k in range(41)} | {k: 100 for k in range(100, 104)} | {k: 999 for k in range(999, 1300)}
    assert sorted(got) == sorted(want.items())
    assert common.components(table.filter("a < 0")).isEmpty()


def longest_increasing(v):
    best = [1] * len(v)
    for i in range(len(v)):
        best[i] = 1 + max([best[j] for j in range(i) if v[j] < v[i]], default=0)
    return max(best, default=0)


def test_patience():
    rng = random.Random(5)
    for _ in range(200):
        v = [rng.randrange(30) for _ in range(rng.randrange(20))]
        got = [v[k] for k in line_dedup.increasing(v)]
        assert got == sorted(set(got)) and len(got) == longest_increasing(v)


def test_lines_on_documents(spark, sf_dir):
    out = line_dedup.dedup_lines(queries.table(spark, sf_dir, "documents")).collect()
    assert {r["doc_id"]: r["kept"] for r in out} == brute_pairs(documents(spark, sf_dir))


def test_line_blocks(spark):
    a = "first line of the early text\n\nsecond line of the early text\nok\nthird line of the early text"
    texts = {1: a, 2: "mine alone here, quite long\n" + a + "\nok\nok", 3: "third line of the early text\nfirst line of the early text", 4: "ok\nno", 5: a}
    out = {r["doc_id"]: r for r in line_dedup.dedup_lines(table_of(spark, texts)).collect()}
    assert out[1]["kept"] == a and out[4]["kept"] == "ok\nno"
    assert out[2]["kept"] == "mine alone here, quite long\nok\nok"  # short lines alone are no block
    assert out[3]["n_removed"] == 1  # lines in another order aren't aligned
    assert out[5]["emptied"] and out[5]["kept"] == ""


def brute_pairs(texts: dict, least: int = 20) -> dict:
    """What is left after every document was aligned with each earlier one by itself.

    That is done twice: with all common runs, and with those that no document before the earlier one has.
    """
    ids, lines, keys = sorted(texts), {}, {}
    for d in ids:
        seen = collections.Counter()
        lines[d] = (texts[d] or "").split("\n")
        keys[d] = []
        for p, x in enumerate(lines[d]):
            if x.strip():
                keys[d].append((p, (x, seen[x])))
                seen[x] += 1
    out = {}
    for n, d in enumerate(ids):
        gone = set()
        size = [len("".join(lines[d][p].split())) for p, _ in keys[d]]
        seen_runs: set[tuple[int, int]] = set()
        for e in ids[:n]:
            place = {key: q for q, (_, key) in enumerate(keys[e])}
            there = [place.get(key) for _, key in keys[d]]
            spans = set()  # shortest runs of enough letters, by either end
            for a in range(len(size)):
                for b in range(a, len(size)):
                    if there[b] is None or there[b] - there[a] != b - a:
                        break
                    shortest = sum(size[a:b]) < least or sum(size[a + 1 : b + 1]) < least
                    if sum(size[a : b + 1]) >= least and (shortest or a == b):
                        spans.add((a, b))
                    if not shortest and a != b:
                        break
            for chosen in (spans, spans - seen_runs):
                own = sorted({q for a, b in chosen for q in range(a, b + 1)})
                chain = [own[k] for k in line_dedup.increasing([there[q] for q in own])]
                for k, q in enumerate(chain):
                    joined = k and chain[k - 1] == q - 1 and there[q - 1] == there[q] - 1
                    gone.update(range(keys[d][q - 1][0] if joined else keys[d][q][0], keys[d][q][0] + 1))
            seen_runs |= spans
        out[d] = "\n".join(x for k, x in enumerate(lines[d]) if k not in gone)
    return out


def test_copy_of_a_document_of_known_lines(spark):
    texts = {1: "alpha beta gamma", 2: "delta epsilon zeta", 3: "alpha beta gamma\ndelta epsilon zeta", 4: "alpha beta gamma\ndelta epsilon zeta"}
    out = {r["doc_id"]: r for r in line_dedup.dedup_lines(table_of(spark, texts)).collect()}
    assert out[4]["n_removed"] == 2 and out[4]["emptied"] and not any(out[k]["n_removed"] for k in (1, 2, 3))


def test_lines_with_every_earlier_document(spark):
    rng = random.Random(8)
    long = [f"long line number {k} of the pool" for k in range(12)]
    short = [f"verse {k}" for k in range(15)]
    reverse = "\n".join(long[::-1])
    texts = {1: "\n".join(long), 2: reverse, 3: reverse + "\n", 4: "own words only, but enough\n" + reverse}
    texts |= {10 + k: x + f"\nalone {k}" for k, x in enumerate(short)} | {30: "\n".join(short), 31: "first\n" + "\n".join(short) + "\nlast"}
    for k in range(40, 110):
        at, n = rng.randrange(12), rng.randrange(12)
        parts = [long[at : at + 3], short[n : n + rng.randint(1, 4)], ["", f"own {k}"], rng.sample(long, 2), rng.sample(short, 2)]
        rng.shuffle(parts)
        texts[k] = "\n".join(x for p in parts for x in p)
    got = {r["doc_id"]: r["kept"] for r in line_dedup.dedup_lines(table_of(spark, texts)).collect()}
    assert got == brute_pairs(texts)
    assert got[3].strip() == "" and got[4] == "own words only, but enough" and got[31] == "first\nlast"


def test_many_lines_known_from_as_many_documents(spark):
    """A text whose lines each stand first in another document costs what it shares, not the square of its lines."""

    def seconds(n: int) -> float:
        rows = spark.range(n).select("id", F.format_string("a line of enough letters, number %d", F.col("id")).alias("text"))
        whole = spark.createDataFrame([(n, "\n".join(f"a line of enough letters, number {k}" for k in range(n)))], "id long, text string")
        d = rows.union(whole).withColumnRenamed("id", "doc_id")
        start = time.perf_counter()
        out = line_dedup.dedup_lines(d).filter("n_removed > 0").collect()
        assert [(r["doc_id"], r["n_removed"], r["emptied"]) for r in out] == [(n, n, True)]
        return time.perf_counter() - start

    seconds(50)
    assert seconds(4_000) < 5 * seconds(1_000)
