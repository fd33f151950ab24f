"""Spelling variants against brute force and their SQL."""

import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from hausprep.llm import queries, spelling

SF = "/root/testdata/sf0.01"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(docs, min_length=5, min_count=3, drop_every=97, factor=2):
    """Rows of ``spelling_groups`` for ``(doc_id, text)`` pairs, every word against every word."""
    import re

    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            if doc_id is not None and drop_every and h % drop_every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= min_length and c >= min_count}
    near = {w: [v for v in n if v != w and one_edit(w, v)] for w in n}
    best = {w: min(v, key=lambda x: (-n[x], x)) for w, v in near.items() if v}
    form = {w: b for w, b in best.items() if n[b] >= factor * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w
    return sorted((w, n[w], len(near[w]), form.get(w), n[form[w]] if w in form else None, root(w)) for w in n)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect())


@pytest.mark.parametrize("alphabet,longest", [("ab", 7), ("abcé", 6), ("abcdefghij", 5)])
def test_sorted_list_against_every_pair(alphabet, longest):
    rnd = random.Random(longest)
    for _ in range(40):
        units = []
        for u in range(rnd.randint(1, 4)):
            words = {"".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, longest))) for _ in range(rnd.randint(1, 40))}
            units += [(u, w) for w in sorted(words)]
        names = [w for _, w in units]
        found = sorted((int(i), int(j)) for x, y in spelling.near_pairs(names, np.array([u for u, _ in units])) for i, j in zip(x, y))
        assert found == [(i, j) for i in range(len(units)) for j in range(i + 1, len(units))
                         if units[i][0] == units[j][0] and one_edit(names[i], names[j])]


def test_small_fronts_give_the_same(monkeypatch):
    rnd = random.Random(1)
    words = sorted({"".join(rnd.choice("abc") for _ in range(rnd.randint(3, 7))) for _ in range(300)})
    pairs = lambda: sorted((int(i), int(j)) for x, y in spelling.near_pairs(words, np.zeros(len(words))) for i, j in zip(x, y))
    whole = pairs()
    monkeypatch.setattr(spelling, "FRONT", 50)
    assert whole == pairs() and whole


@pytest.mark.parametrize("block,least", [(2048, 5), (3, 5), (7, 2)])
def test_groups_against_brute_force(spark, block, least):
    rnd = random.Random(block)
    words = ["".join(rnd.choice("abAÉé") for _ in range(rnd.randint(2, 9))) for _ in range(400)]
    docs = [(i if i % 9 else None, " ".join(rnd.choice(words) for _ in range(60)) + "-Ab×") for i in range(80)] + [(1, None), (2, ""), (3, "12 !")]
    docs += docs[:5]
    out = spelling.spelling_groups(spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, word string"),
                                   least, 3, drop_every=5, block=block)
    assert rows_of(out) == brute(docs, least, 3, 5)


def test_long_words_and_chains(spark):
    long = "x" * 300 + "y" * 300
    texts = [f"{long} " * 3, f"{long}z " * 9, f"{long[1:]} " * 4, "abcdef " * 40, "abcdeg " * 20, "abcdgg " * 10, "abdggg " * 3, "abcdg " * 5]
    docs = list(enumerate(texts))
    out = rows_of(spelling.spelling_groups(spark.createDataFrame(docs, "doc_id long, text string")))
    assert out == brute(docs, drop_every=None)
    assert {r[0]: r[5] for r in out}["abcdgg"] == "abcdef"


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = sorted(con.execute(f"SELECT word, n, n_near, form, form_n, root FROM ({spelling.ORACLE_SQL})").fetchall())
    got = rows_of(queries.op11_spelling(spark, SF))
    assert got == want and sum(r[3] is not None for r in got) > 1000
