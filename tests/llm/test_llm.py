"""The training-data operators against brute force, libraries and held-out labels, and on awkward tables."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from conftest import SF_SMALL
from hausprep.llm import (
    decontamination,
    language_id,
    line_chunks,
    near_dedup,
    packing,
    quality_rules,
    queries,
    token_counts,
    toxicity,
)
from hausprep.llm.common import table, words_of
from hausprep.llm.components import connected_components

SF = "/root/testdata/sf0.01"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, hit string, lang_pred string, score string, "
          "kept string, gone__ string, removed string, key__ string, text_hash string, unit string")


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, repeated rows, clashing names."""
    long = "\n".join(f"Line {i} of the very long text." for i in range(4000))
    rows = [(1, None), (2, ""), (3, "   \n\n"), (4, long), (5, long), (5, long), (None, "A row without id."), (None, None),
            (6, "a"), (7, "1234 !!"), (8, "x " * 300), (9, "same words here as there\nand more\nof them"),
            (10, "Same words, here as there!\nAnd more\nof them"), (10, "other text of one id, six words")]
    return spark.createDataFrame([(i, t, None if i in (1, None) else "en", *[None] * 11) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def texts():
    import duckdb

    return dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())


def test_all_queries_on_odd_and_empty_tables(spark, odd, tmp_path):
    for name, docs in (("odd", odd), ("none", odd.limit(0))):
        d = f"file://{tmp_path}/{name}"
        docs.write.parquet(f"{d}/documents.parquet")
        bench = spark.createDataFrame([(1, "same words here"), (None, None), (2, "")], "item_id long, text string")
        (bench if name == "odd" else bench.limit(0)).write.parquet(f"{d}/benchmark.parquet")
        spark.createDataFrame([(9, 1, 0), (4, 0, 1), (None, 1, 1), (8, None, None)], "doc_id long, quality int, toxic int") \
            .write.parquet(f"{d}/labels.parquet")
        vectors = spark.createDataFrame([(0, [0.5, None], 1), (None, [0.5], 1), (50, None, 1), (100, [0.5], None)], "vec_id long, embedding array<float>, label int")
        (vectors if name == "odd" else vectors.limit(0)).write.parquet(f"{d}/embeddings.parquet")
        for q, f in queries.queries().items():
            rows = f(spark, d).collect()
            if q.startswith("op") and q.split("_")[0] not in ("op9", "op11", "op13"):
                assert len(rows) == (docs.count()), q


def test_stages_keep_the_columns(spark, odd):
    docs = odd
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF_SMALL).collect(), docs.schema)
        assert docs.columns == odd.columns, name


def test_automaton_against_brute_force():
    rnd = random.Random(3)
    for _ in range(300):
        window = rnd.choice([2, 3, 5])
        items = [(str(k), [rnd.choice([b"a", b"b", b"c"]) for _ in range(rnd.randint(0, 8))]) for k in range(rnd.randint(0, 5))]
        automaton = decontamination.SuffixAutomaton(items, window)
        words = [rnd.choice([b"a", b"b", b"c", b"d"]) for _ in range(rnd.randint(0, 25))]
        hit, names = set(), set()
        for name, item in items:
            m = min(window, len(item))
            parts = {tuple(item[k:k + m]) for k in range(len(item) - m + 1)} if m else set()
            for k in range(len(words) - m + 1):
                if m and tuple(words[k:k + m]) in parts:
                    names.add(name)
                    hit |= set(range(k, k + m))
        spans, found = automaton.spans(words)
        assert {i for a, b in spans for i in range(a, b)} == hit and found == names


def test_decontamination_query_against_brute_force(spark, texts):
    items = [(str(r["item_id"]), words_of(r["text"])) for r in table(spark, SF, "benchmark").collect()]
    where = defaultdict(set)
    for name, w in items:
        m = min(10, len(w))
        for k in range(len(w) - m + 1):
            where[tuple(w[k:k + m])].add(name)
    sizes = {len(k) for k in where}
    rows = {r["doc_id"]: r for r in queries.op1_decontamination(spark, SF).collect()}
    for i, t in texts.items():
        w, hit, names = words_of(t), set(), set()
        for m in sizes:
            for k in range(len(w) - m + 1):
                if found := where.get(tuple(w[k:k + m])):
                    names |= found
                    hit |= set(range(k, k + m))
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        r = rows[i]
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) \
            == (len(w), len(hit), len(names), digest, bool(hit))


def test_several_blocks_give_the_same(spark):
    docs, bench = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "benchmark")
    one = decontamination.find_passages(docs, bench).collect()
    many = decontamination.find_passages(docs, bench, block_bytes=1000).collect()
    assert sorted(map(str, one)) == sorted(map(str, many))


def test_decontaminate_cuts_or_drops(spark):
    passage = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, "w " * 90 + passage + ", end"), (2, passage), (3, "clean words"), (4, None)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    out = {r["doc_id"]: r["text"] for r in decontamination.decontaminate(docs, bench).collect()}
    assert out == {1: "w " * 90 + ", end", 3: "clean words", 4: None}


def test_quality_rules_base_counts(spark, texts):
    rows = {r["doc_id"]: r for r in queries.op3_quality_rules(spark, SF).collect()}
    for i, t in texts.items():
        w = t.encode().split()
        tri = [tuple(w[k:k + 3]) for k in range(len(w) - 2)]
        counts = Counter(tri)
        repeat = len({j for k, x in enumerate(tri) if counts[x] > 1 for j in (k, k + 1, k + 2)})
        lines = [x for x in t.split("\n") if x.encode().split()]
        r = rows[i]
        assert (r["n_words"], r["n_dup_lines"], r["n_repeat_words"], r["word_chars"]) \
            == (len(w), len(lines) - len(set(lines)), repeat, sum(len(x.decode()) for x in w))
        assert r["n_symbols"] == sum(c in "#*$%&|<>" for c in t)
        assert r["base_failed"] == (len(w) < 50 or 100 * repeat > 50 * len(w)) and not (r["base_failed"] and r["kept"])


def held_out_scores(spark, query, label):
    labels = {r["doc_id"]: r[label] for r in table(spark, SF, "labels").collect()}
    rows = [r for r in query(spark, SF).collect() if r["held_out"] and r["doc_id"] in labels]
    assert all(0 <= r["score"] <= 1 for r in rows)
    s, y = np.array([r["score"] for r in rows]), np.array([labels[r["doc_id"]] for r in rows])
    return (s[y == 1][:, None] > s[y == 0]).mean()


def test_classifiers_on_held_out_labels(spark):
    assert held_out_scores(spark, queries.op6_quality_classifier, "quality") > 0.95
    assert held_out_scores(spark, queries.op4_toxicity, "toxic") > 0.6      # some thirty toxic documents to learn from


def test_positive_unlabelled_training_on_planted_words():
    rnd = random.Random(5)
    def doc(bad):
        return " ".join([f"w{rnd.randint(0, 300)}" for _ in range(60)] + ["awful", "nasty"] * bad)
    rows = [(int(k % 8 == 0), *toxicity.features(doc(k % 8 == 0))) for k in range(1600)]
    score = toxicity.scorer(toxicity.train(rows, 1 / 8))
    assert score([doc(1)])[0] > 0.5 > score([doc(0)])[0]


def test_language_id_on_held_out(spark):
    truth = {r["doc_id"]: r["lang"] for r in table(spark, SF, "documents").collect()}
    rows = [r for r in queries.op5_language_id(spark, SF).collect() if r["held_out"]]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in rows)
    assert np.mean([truth[r["doc_id"]] == r["lang_pred"] for r in rows]) > 0.98


def test_trigrams_have_gaps_at_word_ends():
    enc = language_id.encoder(64, 1)
    a, b = enc.trigrams(["ab  1c", ""])
    code = lambda s: sum((0 if c == " " else ord(c)) << (11 * (2 - k)) for k, c in enumerate(s))
    assert a.tolist() == [code(" ab"), code("ab "), code("b c"), code(" c ")] and b.tolist() == []


def test_near_classes_against_brute_force(spark, texts):
    got = {r["doc_id"]: r["class_id"] for r in queries.op7_near_dedup(spark, SF).collect()}
    idf = near_dedup.idf_table(table(spark, SF, "documents"))
    features, where = {}, defaultdict(set)
    for i, t in texts.items():
        h, c = near_dedup.shingles(words_of(t))
        features[i] = dict(zip(h.tolist(), (c * idf[near_dedup.bucket(h)]).tolist()))
        where[b" ".join(words_of(t))].add(i)
    root = {i: i for i in texts}
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    pairs = {(min(v), x) for k, v in where.items() if k for x in v}
    shared = defaultdict(list)
    for i, f in features.items():
        for x in f:
            shared[x].append(i)
    pairs |= {(a, b) for v in shared.values() for a in v for b in v if a < b}
    for a, b in pairs:
        fa, fb = features[a], features[b]
        common = sum(min(w, fb[x]) for x, w in fa.items() if x in fb)
        if not fa or common / (sum(fa.values()) + sum(fb.values()) - common) >= 0.8 - 1e-9:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    assert got == {i: find(i) for i in texts}


def test_blocks_give_the_same_classes(spark):
    docs = table(spark, SF_SMALL, "documents")
    assert sorted(near_dedup.classes(docs).collect()) == sorted(near_dedup.classes(docs, block=2).collect())


def test_components(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (102, 101), (7, 7)]
    got = dict(connected_components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100, 102: 100}


def test_weighted_sampling_agrees_with_similarity():
    rng = np.random.default_rng(1)
    h = np.unique(rng.integers(0, 1 << 63, 400, np.uint64))
    a, b = h[:350], h[50:]
    wa, wb = rng.uniform(1, 3, len(a)), rng.uniform(1, 3, len(b))
    drawn = near_dedup.Sampler(2000)(np.concatenate([a, b]), np.concatenate([wa, wb]), np.array([0, len(a)]))
    exact = near_dedup.weighted_jaccard([(a, wa), (b, wb)])(0, np.array([1]))[0]
    assert abs((drawn[0] == drawn[1]).mean() - exact) < 0.05


def test_token_counts_equal_the_library(spark, texts):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("byte_bpe_50k.json")
    rnd = random.Random(2)
    alphabet = " \n\t'srtvemldSL019.,!éß漢字  　²½ a\x1c\x85́🙂<|>"
    samples = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(3000)]
    samples += ["a<|endoftext|>b<|endoftext|>", "I'll we've 'LL 'll'll ''s 're're  's", "   ", "x" * 5000, "'r", "'l"]
    samples += list(texts.values())[:200]
    want = [len(e.ids) for e in Tokenizer.from_file(path).encode_batch(samples, add_special_tokens=False)]
    assert token_counts.TokenCounter(path).count(samples).tolist() == want


def test_chunk_maps_compose():
    rng = np.random.default_rng(4)
    maps = rng.integers(0, 12, (37, 12)).astype(np.uint8)
    out = near = np.arange(12)
    for m, got in zip(maps, token_counts.compose_prefixes(maps)):
        near = m[near]
        assert (got == near).all()


def test_packing_round_trip(spark, texts):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(queries.tokenizer_path("word_bpe_49k.json"))
    ids = {i: np.array(tk.encode(t, add_special_tokens=False).ids + [1], "<u4") for i, t in texts.items()}
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in queries.op9_packing(spark, SF).collect():
        assert zlib.crc32(ids[r["doc_id"]][r["start"]:r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
        assert r["doc_tokens"] == len(ids[r["doc_id"]])
        pieces[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, p in pieces.items():
        assert sum(n for _, n in p) == len(ids[i]) and all(a + n == b for (a, n), (b, _) in zip(sorted(p), sorted(p)[1:]))
    totals = []
    for s in sequences.values():
        s.sort()
        assert s[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(s, s[1:]))
        totals.append(sum(n for _, n in s))
    assert len(pieces) == len(ids) and all(t & (t - 1) == 0 and t <= 2048 for t in totals)


def test_step_groups_are_full():
    """All groups of a tier hold the same tokens but the last, over many flushes; attention cost differs little between them."""
    rnd = random.Random(7)
    packer = packing.Packer(0, step_tokens=16 * 2048)
    for i in range(3000):
        packer.add(i, b"\0\0\0\0" * int(rnd.paretovariate(1.1) * 60))
    packer.finish()
    tokens, cost = defaultdict(int), defaultdict(int)
    for _, _, length, _, _, _, _, tier, group in packer.rows:
        tokens[tier, group] += length
        cost[tier, group] += length * length
    for tier in packing.TIERS:
        groups = sorted(g for t, g in tokens if t == tier)
        assert len(groups) > 1 or tier > 256
        assert all(tokens[tier, g] == 16 * 2048 for g in groups[:-1])
    full = [cost[k] for k in cost if k[0] == 2048 and tokens[k] == 16 * 2048]
    assert max(full) < 1.5 * min(full)


def test_word_ids_equal_the_library(texts):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("word_bpe_49k.json")
    rnd = random.Random(1)
    samples = [t or "" for t in texts.values()]
    for alphabet in (" \n\t'srtvemldSLREVM019.,!_-é ßŒȺǅǲİı漢 \x1c\x85 ́🙂<|>½²\x0b\x0c~@#", "abcXYZ'stl S.,;é_0\nÀÖØȺɏ"):
        samples += ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60))) for _ in range(5000)]
    want = [b"".join(i.to_bytes(4, "little") for i in e.ids) for e in Tokenizer.from_file(path).encode_batch(samples, add_special_tokens=False)]
    assert packing.encoder(path).encode(samples) == want


def test_known_ids_forget_what_came_once():
    made = []
    known = packing._Known(lambda k: made.append(k) or k.encode(), 3)
    for k in "abcabdaeafagah":
        assert known[k] == k.encode() and len(known) <= 3 and len(known.old) <= 3
    assert made.count("a") == 1 and made.count("h") == 1


def test_line_chunks_equal_their_sql(spark):
    import duckdb

    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = sorted(duckdb.sql(line_chunks.ORACLE_SQL).fetchall())
    assert sorted(map(tuple, queries.op10_line_chunks(spark, SF).collect())) == want


def test_line_chunks_find_shifted_passages(spark):
    rnd = random.Random(9)
    line = lambda: " ".join(str(rnd.random()) for _ in range(4))
    passage = [line() for _ in range(30)]
    docs = [(k, "\n".join([line() for _ in range(k + 3)] + passage + [line() for _ in range(5)])) for k in range(4)]
    out = {r["doc_id"]: r["text"] for r in line_chunks.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert out[0] == docs[0][1]
    for k, text in docs[1:]:
        assert sum(p in out[k] for p in passage) < 12
        assert set(text.split("\n")) - set(passage) <= set(out[k].split("\n"))


def long_runs(text):
    """All runs of whole lines, non-blank at both ends, of 50 words or more, the shortest from each line on."""
    lines = text.split("\n")
    for a in range(len(lines)):
        for b in range(a + 1, len(lines) + 1):
            if len("\n".join(lines[a:b]).split()) >= 50:
                if lines[a].split():
                    yield a, b, "\n".join(lines[a:b])
                break


@pytest.mark.parametrize("n_lines", [2, 3, 4, 5, 6])
def test_passages_of_few_lines_go(spark, n_lines):
    rnd = random.Random(n_lines)
    line = lambda n: " ".join(str(rnd.random()) for _ in range(n))
    passages = [[line(n) for n in [51 // n_lines + 1] * (n_lines - 1) + [51 - 51 // n_lines]] for _ in range(20)]
    passages[0][1] += "\t\t é"
    docs, own = [], {}
    for k in range(60):
        own[k] = [[line(rnd.randint(3, 9)) for _ in range(rnd.randint(0, 5))] for _ in range(2)]
        docs.append((k, "\n".join(own[k][0] + passages[k % 20] + own[k][1])))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in line_chunks.dedup_lines(df, passages=True).collect()}
    for k, text in docs:
        assert out[k] == (text if k < 20 else "\n".join(own[k][0] + own[k][1])), k


def test_passages_keep_their_first_occurrence(spark):
    a = "one two three four five six seven eight nine ten"
    docs = [(1, "\n".join([a] * 23)), (2, "\n".join(["before"] + [a] * 5 + ["", "after"])), (2, "\n".join([a] * 5 + ["other"])),
            (3, "\n".join([a] * 4 + ["short"])), (None, "\n".join([a] * 6))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    out = sorted(((r["doc_id"], r["text"]) for r in line_chunks.dedup_lines(df, passages=True).collect()), key=str)
    assert out == sorted([(1, "\n".join([a] * 5)), (2, "before\n\nafter"), (2, "other"), docs[3], docs[4]], key=str)


def test_line_dedup_stage_leaves_no_passage_twice(spark, texts):
    docs = table(spark, SF, "documents")
    seen, lines = {}, set()
    for r in corpus_pipeline.repeated_lines(spark, docs, SF).orderBy("doc_id").collect():
        lines.update(r["text"].split("\n"))
        assert not set(r["text"].split("\n")) - set(texts[r["doc_id"]].split("\n"))
        for a, b, run in long_runs(r["text"]):
            if run in texts[r["doc_id"]]:      # not one that a cut has put together
                other = seen.setdefault(run, (r["doc_id"], b))
                assert other[0] == r["doc_id"] and a < other[1], (other, r["doc_id"])
    assert {x for t in texts.values() if t for x in t.split("\n") if x.strip()} <= lines


def test_language_stage_rejects_short_unknown_texts(spark):
    rnd = random.Random(4)
    russian = "в начале было слово и слово было у бога и слово было бог оно было в начале у бога все через него начало быть " * 2
    turkish = "bütün insanlar hür haysiyet ve haklar bakımından eşit doğarlar akıl ve vicdana sahiptirler ve birbirlerine karşı " * 2
    letters = lambda n: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz    ") for _ in range(n))
    bad = [russian[k:k + 40 + 2 * k] for k in range(60)] + [turkish[k:k + 150] for k in range(30)] + [letters(100 + k) for k in range(90)]
    docs = table(spark, SF, "documents").select("doc_id", "text", "lang").where("text is not null")
    given = spark.createDataFrame([(-1 - k, t, None) for k, t in enumerate(bad)], docs.schema)
    stay = corpus_pipeline.known_language(spark, docs.unionByName(given), SF).select("doc_id", "text").collect()
    assert all(len(t) < 200 for t in bad)
    assert sum(r["doc_id"] < 0 for r in stay) <= 0.05 * len(bad)
    short = {r["doc_id"] for r in docs.collect() if len(r["text"]) < 200 and any(c.isalpha() for c in r["text"])}
    assert len(short & {r["doc_id"] for r in stay}) >= 0.98 * len(short) > 0


def test_quality_rules_on_short_labelled_documents(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["quality"] for r in table(spark, sf, "labels").where("quality is not null").collect()}
    rows = [r for r in queries.op3_quality_rules(spark, sf).collect() if r["doc_id"] in labels and not r["base_failed"]]
    for least, most in ((50, 150), (150, 1 << 40)):
        good, bad = ([r["kept"] for r in rows if labels[r["doc_id"]] == y and least <= r["n_words"] < most] for y in (1, 0))
        assert len(good) > 200 and np.mean(good) >= 0.99
        assert len(bad) > 50 and np.mean(bad) <= 0.02


def test_common_words_of_short_words(spark):
    good = "it is of no use to me to go on so as he is in or by it we do "
    docs = [(k, good * 20, "en") for k in range(30)] + [(101, " ".join("zq%d" % k for k in range(55)), "en")]
    rows = {r["doc_id"]: r for r in quality_rules.quality_rules(spark.createDataFrame(docs, "doc_id long, text string, lang string")).collect()}
    assert len(docs[-1][1]) < quality_rules.MIN_CHARS and not rows[101]["base_failed"]
    assert rows[101]["word_distance"] > 0.5 and rows[101]["char_distance"] is None and not rows[101]["kept"]
