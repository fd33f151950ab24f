"""Truth-table and property tests of the table operators."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from hausprep import vocabularies as V
from hausprep.functions import imputation as I
from hausprep.functions import tokens as T
from hausprep.operators import filters as FL
from hausprep.operators import profile as P
from hausprep.operators import quantiles
from hausprep.operators import schema as SC
from hausprep.operators import setops as S
from hausprep.operators.quantiles import quantile_frame
from hausprep.operators.vocab import flag_membership, garage_vocab


def test_na_tokens_exact_case_sensitive(spark):
    df = spark.createDataFrame([("None",), ("none",), (" NA",), ("NA",), ("",), ("x",)], "s string")
    got = [r.s for r in SC.na_tokens(df).collect()]
    assert got == [None, "none", " NA", None, None, "x"]


def test_dedupe_column_names():
    assert SC.dedupe_column_names(["a", "b", "a"]) == ["a", "b", "a_1"]
    assert SC.dedupe_column_names(["k", "k", "k_1"]) == ["k", "k_2", "k_1"]


def test_distinct_rows_idempotent_and_null_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x"), (2, "x"), (2, "y")], "a int, b string")
    once = S.distinct_rows(df)
    assert once.count() == 3
    assert S.distinct_rows(once).count() == 3


def test_distinct_columns_rules(spark):
    rows = [(i, float(i), str(i), i if i != 3 else 99, None, None, f"s{i}") for i in range(10)]
    df = spark.createDataFrame(rows, "a int, b double, c string, d int, e string, f string, g string")
    # b equals a numerically, c is text (never equal to a number),
    # d differs on one row, f duplicates e (both missing everywhere)
    assert S.duplicate_columns(df) == ["b", "f"]
    out = S.distinct_columns(df)
    assert out.columns == ["a", "c", "d", "e", "g"]
    assert S.distinct_columns(out).columns == out.columns            # idempotent
    assert S.duplicate_columns(df, protect=["b"]) == ["a", "f"]       # protected copy kept instead


def test_drop_columns_strict(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(KeyError):
        FL.drop_columns(df, ["a", "zz"])
    assert FL.drop_columns(df, ["a", "zz"], strict=False).columns == ["b"]


def test_cast_numeric_strict_and_null(spark):
    df = spark.createDataFrame([("1,200",), ("7",), (None,)], "s string")
    assert [r.s for r in FL.cast_numeric(df, ["s"], strip_commas=["s"]).collect()] == [1200.0, 7.0, None]
    bad = spark.createDataFrame([("1,200",)], "s string")
    with pytest.raises(Exception):
        FL.cast_numeric(bad, ["s"]).collect()
    assert FL.cast_numeric(bad, ["s"], mode="null").first().s is None
    assert FL.quarantine_rows(bad, ["s"]).count() == 1


def test_imputations(spark):
    df = spark.createDataFrame([("803", "0", None), ("803.0", "0.0", "Yes"), ("2", '["0"]', None), (None, None, "x")],
                               "baths string, fp string, wf string")
    r = df.select(I.correct_value("baths", 803, "1").alias("b"), I.presence_flag("fp", V.FIREPLACE_ABSENT).alias("f"),
                  I.fill_constant("wf", "No").alias("w")).collect()
    assert [x.b for x in r] == ["1", "1", "2", None]
    assert [x.f for x in r] == ["No", "Yes", "No", "No"]   # '0' absent, '0.0' present
    assert [x.w for x in r] == ["No", "Yes", "No", "x"]


def test_garage_fill_consults_the_right_column(spark):
    df = spark.createDataFrame([
        (None, '["Attached Garage"]', '["Stall"]'),
        ("No", '["Attached Garage"]', '["Stall"]'),
        ("No", "[]", '["Attached Garage"]'),
        ("Yes", None, None),
        (None, '[" No Garage "]', None),
    ], "garage string, features string, parking string")
    terms = garage_vocab(df, ["features", "parking"], V.GARAGE_KEYWORDS, V.GARAGE_EXCLUDED_TERM)
    assert sorted(r.term for r in terms.collect()) == ["attached garage"]
    flagged = flag_membership(df, {"hf": T.tokens_match("features"), "hp": T.tokens_match("parking")}, terms)
    got = [r.g for r in flagged.select(I.garage_fill("garage", "features", "parking", F.col("hf"), F.col("hp"))
                                       .alias("g")).collect()]
    assert got == ["Yes", "No", "Yes", "Yes", "No"]


@pytest.mark.parametrize("strategy", ["literal", "broadcast", "shuffle"])
def test_flag_membership_strategies_agree(spark, strategy):
    rnd = random.Random(7)
    words = [f"w{i}" for i in range(50)]
    rows = [(",".join(rnd.sample(words, rnd.randint(0, 4))) if i % 9 else None,) for i in range(400)]
    # a hot value: a third of all rows carry the same cell
    rows += [("w1,w2",)] * 200
    df = spark.createDataFrame(rows, "s string").withColumn("i", F.monotonically_increasing_id())
    terms = spark.createDataFrame([(w,) for w in words[::3]], "term string")
    expected = {r.i: r.h for r in flag_membership(df, {"h": T.tokens_match("s")}, terms, strategy="literal").collect()}
    got = {r.i: r.h for r in flag_membership(df, {"h": T.tokens_match("s")}, terms, strategy=strategy).collect()}
    assert got == expected and len(got) == 600


def test_exact_quantiles_match_numpy_with_hot_value(spark):
    rnd = np.random.default_rng(3)
    vals = np.concatenate([rnd.normal(100, 30, 3000).round(2), np.full(1500, 42.0), [np.nan] * 10])
    df = spark.createDataFrame([(float(v),) for v in vals] + [(None,)], "v double")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = quantile_frame(df, ["v"], probs).first()
    clean = vals[~np.isnan(vals)]
    for i, p in enumerate(probs):
        assert got[f"q{int(round(p * 100))}"] == pytest.approx(float(np.percentile(clean, p * 100)), abs=1e-9)


@pytest.mark.parametrize("most", [1, 7, 300])
def test_quantiles_by_bracket(spark, most, monkeypatch):
    """Brackets sketched again and again, on ties, hot values, steps and infinities, several columns at once."""
    monkeypatch.setattr(quantiles, "MOST", most)
    rnd = np.random.default_rng(most)
    columns = [rnd.normal(0, 1, 3000), rnd.integers(0, 5, 3000).astype(float), np.r_[np.full(1500, 7.0), rnd.exponential(1e9, 1500)],
               np.r_[np.full(1000, -np.inf), np.zeros(1000), np.full(1000, np.inf)], np.r_[[np.nan] * 2990, np.arange(10) - 5.0]]
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*columns)] + [(None,) * 5], "a double, b double, c double, d double, e double")
    probs = [0.0, 0.001, 0.25, 0.333, 0.5, 0.9, 0.999, 1.0]
    for values, got in zip(columns, quantiles.quantile_values(df, list("abcde"), probs)):
        clean = np.sort(values[~np.isnan(values)])
        for p, q in zip(probs, got):
            h = (len(clean) - 1) * p
            low, high = clean[int(np.floor(h))], clean[int(np.ceil(h))]
            assert q == pytest.approx(low if low == high else low + (h - np.floor(h)) * (high - low), abs=1e-12), p


def test_quantiles_of_a_bad_sketch(spark, monkeypatch):
    """A sketch far off gives brackets that miss; they are widened until they hold the ranks."""
    monkeypatch.setattr(quantiles, "MOST", 10)
    monkeypatch.setattr(quantiles.F, "percentile_approx", lambda v, p, a: F.array(F.max(v), F.max(v)))
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    assert quantiles.quantile_values(df, ["v"], [0.25, 0.5]) == [[249.75, 499.5]]


def test_quantiles_of_empty_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "v double")
    row = P.quantiles(df, "v", [0.5], names=["m"]).first()
    assert row.m is None


def test_value_counts_sum_to_non_null(spark):
    df = spark.createDataFrame([(x,) for x in ["a", "b", "a", None, "c", "a"]], "s string")
    vc = P.value_counts(df, "s").collect()
    assert [(r.s, r["count"]) for r in vc] == [("a", 3), ("b", 1), ("c", 1)]
    assert sum(r["count"] for r in vc) == 5


def test_n_distinct_counts_missing_once(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",), (None,), ("b",)], "s string")
    assert P.n_distinct(df, ["s"]).first().n_distinct == 3
    assert P.n_distinct(df, ["s"], approx=True).first().n_distinct == 3


def test_iqr_outliers(spark):
    vals = [float(x) for x in range(1, 21)] + [1000.0]
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    row = P.iqr_outliers(df, "v").first()
    q1, q3 = np.percentile(vals, 25), np.percentile(vals, 75)
    assert row.q1 == pytest.approx(q1) and row.q3 == pytest.approx(q3)
    assert row.outliers == sum(1 for v in vals if v < q1 - 1.5 * (q3 - q1) or v > q3 + 1.5 * (q3 - q1))


def test_infer_types_rules(spark):
    rows = [("1", "1.5", "true", "2024-01-02", "x", None, "7"),
            ("2", "2", "False", "2024-02-03", "y", None, None)]
    df = spark.createDataFrame(rows, "i string, d string, b string, sold_date string, update_note string, "
                                     "empty string, gappy string")
    got = SC.inferred_schema(df)
    assert got == {"i": "bigint", "d": "double", "b": "boolean", "sold_date": "date",
                   "update_note": "string", "empty": "double", "gappy": "double"}
    typed = SC.apply_types(df, got)
    assert dict(typed.dtypes)["sold_date"] == "date" and typed.first().b is True


def test_dates_in_one_format(spark):
    columns = {"us_date": ["1/2/2024", "12/31/2023"], "euro_date": ["1/2/2024", "31/12/2023"], "long_date": ["March 3, 2024", "May 12, 2023"],
               "mixed_date": ["2024-01-02", "1/2/2024"], "iso_date": ["2024-01-02", "2024-01-02 10:00:00"], "bad_date": ["13/13/2024", "1/2/2024"],
               "day": ["1/2/2024", "1/3/2024"], "time_date": ["1/2/2024 9:30", "10/20/2024 23:59"], "may_date": ["May 3, 2024", "May 4, 2024"]}
    df = spark.createDataFrame([*zip(*columns.values()), (None,) * len(columns)], ", ".join(f"{c} string" for c in columns))
    types = SC.inferred_schema(df)
    assert types == {"us_date": "date[M/d/yyyy]", "euro_date": "date[d/M/yyyy]", "long_date": "date[MMMM d, yyyy]", "mixed_date": "string",
                     "iso_date": "date", "bad_date": "string", "day": "string", "time_date": "date[M/d/yyyy H:mm]", "may_date": "date[MMMM d, yyyy]"}
    row = SC.apply_types(df, types).first()
    assert [str(row[c]) for c in ("us_date", "euro_date", "long_date", "iso_date", "time_date")] == [
        "2024-01-02", "2024-02-01", "2024-03-03", "2024-01-02", "2024-01-02"]


def test_strict_cast_whatever_is_selected(spark):
    df = spark.createDataFrame([("a", "1", "1,5"), ("b", "oops", "2"), ("c", None, None)], "city string, latitude string, size string")
    strict = FL.cast_numeric(df, ["latitude", "size"], strip_commas=["size"])
    for read in (lambda: strict.select("city").collect(), lambda: strict.count(), lambda: strict.where("city = 'b'").select("city").collect()):
        with pytest.raises(Exception, match="cannot cast latitude to double: oops"):
            read()
    good = FL.cast_numeric(df.where("city <> 'b'"), ["latitude", "size"], strip_commas=["size"])
    assert sorted(map(tuple, good.collect())) == [("a", 1.0, 15.0), ("c", None, None)]


def test_listing_cast_modes(spark):
    from hausprep.plans.listings import clean_listings
    from hausprep.registry.fixtures import VIEW_COLUMNS, VIEW_OUTPUT, listing_view
    from conftest import SF_SMALL
    v = listing_view(spark, SF_SMALL)
    bad = v.withColumn("beds", F.when(F.col("listing_id") == F.lit(1), F.lit("three")).otherwise(F.col("beds")))
    with pytest.raises(Exception):
        clean_listings(bad, VIEW_COLUMNS, VIEW_OUTPUT).count()
    lenient = clean_listings(bad, VIEW_COLUMNS, VIEW_OUTPUT, cast_mode="null")
    strict_ok = clean_listings(v, VIEW_COLUMNS, VIEW_OUTPUT)
    bad_rows = bad.where(F.col("listing_id") == 1).count()
    assert lenient.count() <= strict_ok.count() and lenient.where("listing_id = 1").count() == 0
    assert bad_rows >= 1
    assert FL.quarantine_rows(bad, ["beds"]).count() == bad_rows


def test_distinct_rows_numeric_spelling(spark):
    rows = [("3", "a", "1"), ("3.0", "a", "1"), ("x", "a", None), ("x", "a", None), (".5", "b", "2"), ("0.5", "b", "02"), ("1e3", "c", "0"),
            ("1000", "c", "-0"), (None, "d", "1"), (None, "d", "1"), ("9007199254740993", "e", "1"), ("9007199254740992", "e", "1")]
    df = spark.createDataFrame(rows, "n string, `s.t` string, m string")
    assert S.distinct_rows(df).count() == 10
    out = S.distinct_rows(df, canonical_numeric=["n", "m"])
    assert out.columns == df.columns
    # a row's own text, and no row put together from two
    assert sorted(map(tuple, out.collect()), key=str) == sorted([
        ("3", "a", "1"), ("x", "a", None), (".5", "b", "2"), ("1000", "c", "-0"), (None, "d", "1"),
        ("9007199254740993", "e", "1"), ("9007199254740992", "e", "1")], key=str)


def test_canonical_numbers_are_exact(spark):
    texts = ["3", "3.0", "+3", "03.", "100", "-0.50", "-0", "0.0", "9007199254740992", "9007199254740993",
             "12345678", "1e5", "", " 3", "3.0.0", None, ".", "-", "e5", "1e", "+.5", "5E-1", "nan", "1e400", "Infinity", "0x1"]
    df = spark.createDataFrame([(t,) for t in texts], "n string")
    assert [r[0] for r in S.canonical_numbers(df, ["n"]).collect()] == [
        "3", "3", "3", "3", "100", "-0.5", "0", "0", "9007199254740992", "9007199254740993",
        "12345678", "100000", "", " 3", "3.0.0", None, ".", "-", "e5", "1e", "0.5", "0.5", "nan", "1e400", "Infinity", "0x1"]


def test_numeric_keys_are_equal_for_equal_numbers(spark):
    from decimal import Context, Decimal

    rnd = random.Random(8)
    texts = ["1" + "0" * 100, "1e100", "0." + "0" * 60 + "1", "1e-61", "1" * 41 + "." + "2" * 41, "1" * 45, "12" + "0" * 60, "12e60", "0.0e7"]
    for _ in range(1500):
        digits = "".join(rnd.choice("000123") for _ in range(rnd.choice([1, 2, 3, 45])))
        at = rnd.randint(0, len(digits))
        texts.append(rnd.choice(["", "", "+", "-"]) + digits[:at] + rnd.choice([".", ""]) + digits[at:] + rnd.choice(["", "", "e3", "E-2", "e+12", "e-50"]))
    keys = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "n string").select(S.numeric_key(F.col("n"))).collect()]
    exact = Context(prec=400)
    by_value = {}
    for t, k in zip(texts, keys):
        assert Decimal(k) == Decimal(t)
        v = Decimal(t).normalize(exact)
        by_value.setdefault(v if v else 0, set()).add(k)
    assert all(len(k) == 1 for k in by_value.values()) and len(by_value) > 100


def test_fingerprints_observed_during_write_equal_aggregate(spark):
    from hausprep.session import materialize_observed
    rows = [(i % 5, float(i % 5), f"s{i % 3}", None) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b double, c string, d string").repartition(7)
    back, observed = materialize_observed(df, S.fingerprint_exprs(df), "fp_test")
    direct = df.agg(*S.fingerprint_exprs(df)).first()
    assert dict(observed) == direct.asDict()
    assert S.duplicate_columns(back, fingerprints=observed) == ["b"]
