"""Micro-cases of the scalar text rules, worked out by hand."""

import pytest
from pyspark.sql import functions as F

from reportlens.functions import lexicons as lx, text as tx


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "t string").select(expr(F.col("t"))).first()[0]


@pytest.mark.parametrize("text,n", [(None, 0), ("", 0), (" \n\t", 0), ("a  b\nc", 3), (" x y", 2)])
def test_word_count(spark, text, n):
    assert one(spark, text, tx.word_count) == n


@pytest.mark.parametrize("text,en,fr", [("a. b! c?", 2, 3), ("...", 0, 0), ("3.5 cm", 2, 2), (None, 0, 0)])
def test_sentence_count(spark, text, en, fr):
    assert one(spark, text, tx.sentence_count) == en
    assert one(spark, text, lambda c: tx.sentence_count(c, "fr")) == fr


@pytest.mark.parametrize("fn,text,want", [
    (tx.normalize_en, " <b>X-xxxx</b>  of XXXX, xxxx ", "x-ray of [REDACTED], xxxx"),
    (tx.normalize_en_strict, ", The X-XXXX.. <i>was</i> XXXX; XXXXL :", "the x-ray. was [REDACTED]; xxxxl"),
    (tx.normalize_fr, " L’Œdème../Stable`  ", "l'œdème.. stable'"),
    (tx.normalize_fr_lines, " A  b./ c\n\n\n ..d\t e ;", "A b.\nc\n.d e"),
    (tx.none_to_empty, " NONE ", ""),
    (tx.none_to_empty, None, ""),
    (tx.none_to_empty, " prior ", "prior"),
    (tx.squeeze, "\ta \n b ", "a b"),
])
def test_normalisers(spark, fn, text, want):
    assert one(spark, text, fn) == want


@pytest.mark.parametrize("text,any_, leading,bounded", [
    ("057Y", 57.0, 57.0, 57.0), ("age 40", 40.0, None, None), (" 130", 130.0, 130.0, None), (None, None, None, None), ("x", None, None, None)])
def test_parse_age(spark, text, any_, leading, bounded):
    got = [one(spark, text, lambda c, m=m: tx.parse_age(c, m)) for m in ("any", "leading", "bounded")]
    assert got == [any_, leading, bounded]


@pytest.mark.parametrize("text,initial,exact", [("male", "M", None), (" F ", None, "F"), ("O", None, "O"), ("74", None, None), (None, None, None)])
def test_gender(spark, text, initial, exact):
    assert one(spark, text, tx.normalize_gender) == initial
    assert one(spark, text, lambda c: tx.normalize_gender(c, "exact")) == exact


def test_tokens(spark):
    assert one(spark, "The Lungs, are CLEAR-ish of it", lambda c: tx.tokens(c, "en")) == ["lungs", "clear", "ish"]
    assert one(spark, "Œdème du poumon très élargi", lambda c: tx.tokens(c, "fr")) == ["dème", "poumon", "élargi"]
    assert one(spark, "A  b", lambda c: tx.tokens(c, "raw")) == ["a", "b"]


def test_sentences(spark):
    assert one(spark, "A b. c .. d", tx.sentences) == ["A b", "c", "d"]
    assert one(spark, "A b. 3.5 cm! End", lambda c: tx.sentences(c, "punct")) == ["A b.", "3.5 cm!", "End"]


def test_lexicon_matching_is_by_substring(spark):
    d = spark.createDataFrame([("massive mass; no nodule, nodule",)], "low string")
    got = d.select(tx.term_hits("low", ["mass", "nodule", "rib"]).alias("h"), tx.term_occurrences("low", ["mass", "nodule"]).alias("o"),
                   tx.term_weight_max("low", {"mass": 2, "nodule": 3, "rib": 9}).alias("m"), tx.term_weight_sum("low", {"mass": 2, "nodule": 3}).alias("s"),
                   tx.has_any("low", ["rib", "no "]).alias("a")).first()
    assert tuple(got) == (2, 4, 3, 5, True)


def test_categories_first_match_wins(spark):
    d = spark.createDataFrame([("abnormal opacity and edema",), ("nothing",)], "low string")
    got = [tuple(r) for r in d.select(tx.first_category("low", lx.EN_CATEGORIES), tx.category_count("low", lx.EN_CATEGORIES),
                                      tx.join_labels(tx.all_categories("low", lx.EN_CATEGORIES))).collect()]
    assert got == [("Normal", 3, "Normal|Opacity/Mass|Edema"), ("Other", 0, "Other")]


def test_is_normal(spark):
    assert [one(spark, t, tx.is_normal) for t in ("normal", "normal|x", "Opacity", None)] == [True, False, False, False]


def test_quotes_and_backslashes_in_terms(spark):
    d = spark.createDataFrame([("pas d'air \\ x",)], "low string")
    assert d.select(tx.term_hits("low", ["pas d'", "\\"])).first()[0] == 2
