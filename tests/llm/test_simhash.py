"""SimHash groups against every pair of fingerprints."""

import random
import re

import numpy as np
import pytest
import xxhash

from hausprep.llm import queries, simhash

SF = "/root/testdata/sf0.01"


def simhash_of(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", text)
    grams = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def components(prints, ids):
    """Least id reachable, by every pair of distinct fingerprints."""
    distinct = sorted(set(prints))
    values = np.array(distinct, np.uint64)
    parent = list(range(len(distinct)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(distinct)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1:] ^ values[i]) <= 2) + i + 1:
            parent[find(int(j))] = find(i)
    root = {p: find(i) for i, p in enumerate(distinct)}
    least = {}
    for p, i in zip(prints, ids):
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    return [least.get(root[p]) for p in prints]


def test_fingerprints_of_long_and_odd_texts(monkeypatch):
    rnd = random.Random(5)
    monkeypatch.setattr(simhash, "TEXT_BYTES", 40)
    for text in ["", "  \n", "One", "one TWO", "a b c", "é\x1c x\x0by\x85z ÀB", "w" * 500]:
        assert simhash.fingerprint(text) % (1 << 64) == simhash_of(text), text
    for n in (5, 37, 400):
        text = rnd.choice(" \n\t").join(rnd.choice(["Ab", "c", "déf", "long-word" * 4]) + rnd.choice(["", "  "]) for _ in range(n))
        assert simhash.fingerprint(text) % (1 << 64) == simhash_of(text)


def test_linked_fingerprints_share_a_key(spark):
    rnd = random.Random(2)
    rows = []
    for i in range(300):
        x = rnd.getrandbits(64)
        y = x ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64))
        rows.append((i, x - (1 << 64) if x >> 63 else x, y - (1 << 64) if y >> 63 else y))
    df = spark.createDataFrame(rows, "i int, x long, y long")
    out = df.select(simhash.meeting_keys(df.x).alias("a"), simhash.meeting_keys(df.y).alias("b")).collect()
    assert all(set(r.a) & set(r.b) and len(r.a) == 6 for r in out)


@pytest.mark.parametrize("block", [1024, 5])
def test_groups_of_planted_fingerprints(spark, block, monkeypatch):
    """Chains, stars and a dense cluster of fingerprints against every pair."""
    rnd = random.Random(block)
    prints = [rnd.getrandbits(64) for _ in range(100)]
    for x in prints[:30]:
        for _ in range(6):                                   # chains of two bits each
            x ^= (1 << rnd.randrange(64)) | (1 << rnd.randrange(64))
            prints.append(x)
    prints += [prints[0] ^ (1 << i) ^ (1 << j) for i in range(12) for j in range(i)] + [0, 0, 1, (1 << 64) - 1]
    prints += prints[:40]
    rnd.shuffle(prints)
    ids = [None if i % 11 == 0 else i * 7 % 1000 for i in range(len(prints))]
    rows = spark.createDataFrame([(i, p - (1 << 64) if p >> 63 else p) for i, p in zip(ids, prints)], "doc_id long, bits long")
    monkeypatch.setattr(simhash, "fingerprints", lambda docs: docs)
    out = simhash.simhash_groups(rows, block).collect()
    want = sorted(zip(ids, (f"{p:016x}" for p in prints), components(prints, ids)), key=str)
    assert sorted((tuple(r) for r in out), key=str) == want


def test_query_against_brute_force(spark):
    import duckdb

    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    prints = [simhash_of(t) for _, t in docs]
    want = list(zip((i for i, _ in docs), (f"{p:016x}" for p in prints), components(prints, [i for i, _ in docs])))
    got = sorted(tuple(r) for r in queries.op12_simhash(spark, SF).select("doc_id", "fingerprint", "component_id").collect())
    assert got == sorted(want) and len({r[2] for r in got}) < len(got)


def test_awkward_rows(spark):
    docs = spark.createDataFrame([(None, None, 1), (None, "", 2), (7, " ", 3), (7, "x y z", 4), (7, "x y z", 4), (3, "X y\nZ", 5)],
                                 "doc_id long, text string, bits int")
    got = sorted((tuple(r) for r in simhash.simhash_groups(docs).select("doc_id", "component_id").collect()), key=str)
    assert got == sorted([(None, 7), (None, 7), (7, 7), (7, 3), (7, 3), (3, 3)], key=str)
    assert simhash.simhash_groups(docs.limit(0)).collect() == []
