"""Token functions against a plain-Python statement of the original rules."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from hausprep import vocabularies as V
from hausprep.functions import tokens as T


def py_clean(s):
    return s.replace("[", "").replace("]", "").replace('"', "").replace("'", "")


def py_match_tokens(s):
    return [f.strip().lower() for f in py_clean(s).replace(";", ",").split(",")]


def py_vocab_tokens(s):
    return [f.strip() for f in py_clean(s).split(",")]


def py_flag(s, terms):
    if not isinstance(s, str):
        return "No"
    return "Yes" if set(py_match_tokens(s)) & set(terms) else "No"


def py_classify(s, vocabulary):
    if not isinstance(s, str):
        return None
    toks = set(py_match_tokens(s))
    for label, terms in vocabulary:
        if toks & set(terms):
            return label
    return None


ALPHABET = st.sampled_from(list("abAB ;,[]'\"\t\n 　\x1c ") + ["roof", "Tile", "Metal "])
TEXT = st.lists(ALPHABET, max_size=12).map("".join)


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), TEXT), min_size=1, max_size=25))
def test_tokens_match_python_rules(spark, cells):
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], "i int, s string")
    got = {r.i: (r.m, r.v, r.p) for r in df.select(
        "i", T.tokens_match("s").alias("m"), T.tokens_vocab("s").alias("v"), T.py_strip("s").alias("p")
    ).collect()}
    for i, c in enumerate(cells):
        m, v, p = got[i]
        if c is None:
            assert m is None and v is None and p is None
        else:
            assert m == py_match_tokens(c)
            assert v == py_vocab_tokens(c)
            assert p == c.strip()


CASES = [
    '["Asphalt Shingle"]', "Tar &amp; Gravel", "Steel", '["Membrane", "Tile"]', None, "",
    "['Metal', 'Tile']", " TILE ; wood", "Mixed,Other", "unknown", "[]",
]


def test_classify_and_flag_truth_table(spark):
    df = spark.createDataFrame([(c,) for c in CASES], "s string")
    rows = df.select("s", T.classify_first("s", V.ROOF).alias("roof"),
                     T.keyword_flag("s", ["tile", "steel"]).alias("flag")).collect()
    for r in rows:
        assert r.roof == py_classify(r.s, V.ROOF), r
        assert r.flag == py_flag(r.s, ["tile", "steel"]), r


def test_label_precedence_and_unreachable_terms(spark):
    df = spark.createDataFrame([('["Partial", "Walkout"]',), ('["Baseboard", "Forced Air"]',),
                                ('["Carport; Single"]',), ("Tar &amp; Gravel",)], "s string")
    r = df.select(T.classify_first("s", V.BASEMENT).alias("b"), T.classify_first("s", V.HEATING).alias("h"),
                  T.keyword_flag("s", V.PARKING_TERMS).alias("p"), T.classify_first("s", V.ROOF).alias("r")
                  ).collect()
    assert r[0].b == "Finished"          # Finished outranks Partial
    assert r[1].h == "forced air"        # forced air outranks radiant
    assert r[2].p == "Yes"               # 'carport' hit; 'carport; single' can never match
    assert r[3].r is None                # 'tar &amp; gravel' splits on ';' -> unreachable


def test_first_match_term_is_vocabulary_order(spark):
    df = spark.createDataFrame([("lake view, river view",), ("view city",), ("nothing",)], "s string")
    got = [r[0] for r in df.select(T.first_match_term("s", V.VIEW_TERMS)).collect()]
    assert got == ["river view", "view city", None]


def test_contains_any_and_concat(spark):
    df = spark.createDataFrame([("Carpet", None, "x"), ("no", "b", None)], "a string, b string, c string")
    r = df.select(T.contains_any("a", V.GARAGE_KEYWORDS).alias("k"),
                  T.concat_columns(["a", "b", "c"]).alias("j")).collect()
    assert [x.k for x in r] == [True, False]          # 'car' is a substring of 'carpet'
    assert [x.j for x in r] == ["Carpet,x", "no,b"]   # missing cells skipped


def test_no_python_in_token_plans(spark):
    df = spark.createDataFrame([("a,b",)], "s string")
    plan = df.select(T.classify_first("s", V.ROOF), T.tokens_vocab("s"))._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
