from __future__ import annotations

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from recordloom.functions import constants as C
from recordloom.functions import similarity as SIM
from recordloom.functions import text as T
from recordloom.functions.address import components


def values(spark, texts, *columns):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, v string")
    return [tuple(r)[1:] for r in df.select("i", *columns).orderBy("i").collect()]


def test_names(spark):
    cases = {
        "Acme Private Limited": ("acme pvt ltd", "acme"), "The Ltd": ("the ltd", "the ltd"), "O'Neil & Söhne GmbH": ("oneil and sohne gmbh", "oneil sohne"),
        "Straße+Łódź  Co.": ("strasse and lodz co", "strasse lodz"), " NaN ": ("", ""), "": ("", ""), None: ("", ""), "a_b-c²": ("a_b c2", "a_b c2"), "शर्मा & Co": None,
        "ＦＵＬＬ　Width INC": ("full width inc", "full width"), "Trustee Corporation": ("trust corp", "trust corp"),
    }
    got = values(spark, list(cases), T.normalize_name(F.col("v")), T.normalize_name(F.col("v"), core=True))
    for (text, want), found in zip(cases.items(), got, strict=True):
        if want:
            assert found == want, text


def test_addresses(spark):
    cases = {
        "12, Main  Street ,, Springfield, ": "12 , main st , springfield", "#4 First Road": "# 4 1st rd", ",,": "", None: "", "null": "", "A,B": "a , b",
        "Groß Straße 5/7": "groß straße 5 7", "x , , , y": "x , y",
    }
    assert [r[0] for r in values(spark, list(cases), T.normalize_address(F.col("v")))] == list(cases.values())


def test_components(spark):
    cases = {
        "9462 Temple Street, Midvale, Ohio 44444": ("44444", "9462", "midvale", "ohio"), "Flat 10/99, Lake View, Pune, in": ("", "10", "pune", ""),
        "Main Road TX 75001": ("75001", "", "", ""), "some free 12 345 678 text": ("12345678", "", "", ""), "": ("", "", "", ""), "near temple, Goa, 403001": ("403001", "", "temple", ""),
        "No 7, City, City": ("", "7", "", "city"),
    }
    got = values(spark, list(cases), F.to_json(components(T.normalize_address(F.col("v")))), components(T.normalize_address(F.col("v"))))
    for (text, want), (_, found) in zip(cases.items(), got, strict=True):
        assert tuple(found) == want, text


def test_countries_and_tokens(spark):
    got = values(spark, ["U.S.A.", "N/A", " unknown", None, "México"], T.normalize_country(F.col("v")), T.normalize_country(F.col("v"), {"u s a": "us"}))
    assert got == [("u s a", "us"), ("n a", "n a"), ("", ""), ("", ""), ("mexico", "mexico")]
    got = values(spark, ["near 12 rd x 7a7", "", "abc"], T.blocking_tokens(F.col("v"), True), T.digit_runs(F.col("v")), T.char_ngrams(F.col("v")))
    assert got[0][0] == ["12", "rd", "7a7"] and got[0][1] == ["12", "7"] and got[1] == ([], [], []) and got[2][2] == ["abc"]


def test_word_ngrams_follow_the_stop_rule(spark):
    def slow(text, least, most):
        out = []
        for w in text.split():
            w = f" {w} "
            for n in range(least, most + 1):
                out += [w[i : i + n] for i in range(max(len(w) - n + 1, 1))]
                if len(w) <= n:
                    break
        return out

    texts = ["a", "ab cde", "", "abcdefgh ij k"]
    got = values(spark, texts, T.word_ngrams(F.col("v"), 2, 5), T.word_ngrams(F.col("v"), 2, 4), T.word_ngrams(F.col("v"), 4, 5))
    for text, found in zip(texts, got, strict=True):
        assert [sorted(x) for x in found] == [sorted(slow(text, *n)) for n in ((2, 5), (2, 4), (4, 5))]


def test_accents_agree_with_the_exact_form(spark):
    texts = ["Crème Brûlée ñ Ünïcødé", "plain", None, "ﬁ ½ 각", "ÅåÇç ｱ"]
    got = values(spark, texts, T.strip_accents(F.col("v")), T.strip_accents_exact(F.col("v")))
    for t, (native, exact) in zip(texts, got, strict=True):
        want = t and "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
        assert exact == want
        if t and not re.search("[ﬁ½각]", t):
            assert native == want


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def test_similarities(spark):
    rng = random.Random(1)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc ") for _ in range(rng.randint(0, 12))) for _ in range(2))
        assert SIM.common_subsequence(a, b) == lcs(a, b)
    assert SIM.indel("", "") == 0 and SIM.indel("abc", "abc") == 1 and abs(SIM.indel("abcd", "acbd") - 0.75) < 1e-12
    assert SIM.token_sort("b a", "a b") == 1 and SIM.token_set("a b c", "c a") == 1 and SIM.token_set("", "a") == 0
    assert abs(SIM.token_set("x a", "y a") - max(SIM.indel("a x", "a y"), SIM.indel("a", "a x"))) < 1e-12
    assert abs(SIM.jaro_winkler("martha", "marhta") - 0.9611111) < 1e-6 and abs(SIM.jaro_winkler("dwayne", "duane") - 0.84) < 1e-6 and SIM.jaro_winkler("", "a") == 0
    df = spark.createDataFrame([("kitten", "sitting"), ("", "a"), ("ab", "ab"), (None, "x")], "a string, b string")
    rows = df.select(SIM.indel_ratio("a", "b").alias("x"), SIM.indel_native(F.coalesce("a", F.lit("")), F.col("b")).alias("y")).collect()
    assert [round(r.x, 9) for r in rows] == [round(r.y, 9) for r in rows] == [round(8 / 13, 9), 0, 1, 0]


@pytest.mark.parametrize("words", [C.GENERIC_ADDRESS, C.NAME_STOP, C.ADDRESS_STOP, C.CORE_STOP, C.ADDRESS_NOISE])
def test_lists_have_no_repeats(words):
    assert len(set(words)) == len(words)
