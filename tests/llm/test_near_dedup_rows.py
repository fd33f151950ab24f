"""Which rows ``dedup`` keeps, when ids repeat."""

from hausprep.llm import near_dedup


def test_unlike_texts_of_one_id_all_stay(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    texts = [" ".join(f"{w}{i}" for w in words) for i in range(6)]
    rows = list(zip([1, 1, 2, 3, 3, 3], texts))
    out = near_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, out)) == sorted(rows)


def test_repeated_rows_and_copies_go(spark):
    text = "one two three four five six seven eight"
    rows = [(1, text, "a"), (1, text, "b"), (2, text.upper(), "c"), (3, "other words altogether", "d"), (None, text, "e"), (None, text, "e"), (4, None, "f"),
            (4, None, "g"), (5, "", "h"), (6, "", "i")]
    out = near_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string, near_id__ string")).collect()
    kept = sorted(((r["doc_id"], r["text"]) for r in out), key=str)
    assert kept == sorted([(1, text), (3, "other words altogether"), (None, text), (None, text), (4, None), (5, ""), (6, "")], key=str)
