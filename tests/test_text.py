"""Cleaning, tokens and signals on hand-made texts."""

import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from textlab.functions import signals as G, text as X, tokens as K
from textlab.functions.words import NEGATORS
from textlab.operators import cleaning
from textlab.operators.cleaning import clean_text, lemmatize
from textlab.plans.configurations import baseline_configuration


def one(spark, text, function):
    return spark.createDataFrame([(text,)], "text string").select(function(F.col("text")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    "text, want",
    [
        ("Hi @Bob_1 see HTTP://X.y and https://a.b/@c?d", "hi user see url and url"),
        ("@josé_1!", "user!"),
        (" a\x1cb\xa0\tc ", "a b c"),
        ("www.x.org", "url"),
        ("", ""),
    ],
)
def test_baseline_cleaning(spark, text, want):
    assert one(spark, text, lambda c: X.clean_text_b0(c)) == want


def test_url_modes(spark):
    text = "see www.a.b now"
    assert one(spark, text, lambda c: X.replace_urls(c, "drop")) == "see  now"
    assert one(spark, text, lambda c: X.replace_urls(c, "token:$1\\")) == "see $1\\ now"
    assert one(spark, text, lambda c: X.replace_urls(c, "anything")) == text


@pytest.mark.parametrize(
    "text, want",
    [("soooo", "soo"), ("1111", "11"), ("a   b", "a  b"), ("\n\n\n\n", "\n\n\n\n"), ("aabb", "aabb"), ("😀😀😀", "😀😀")],
)
def test_elongation(spark, text, want):
    assert one(spark, text, lambda c: X.squeeze_elongation(c)) == want


def test_emoji_names(spark):
    assert one(spark, "ok😀❤️!", lambda c: X.emoji_to_text(c)) == "ok :grinning_face:  :heavy_black_heart: !"
    assert one(spark, "😀", lambda c: X.emoji_to_text(c, {})) == "😀"
    assert one(spark, "😀", lambda c: X.emoji_to_text(c, {"😀": "smile"})) == " :smile: "


@pytest.mark.parametrize(
    "text,want",
    [
        ("⭐⌚", " :white_medium_star:  :watch: "),
        ("🇫🇷🇩🇪 🇫", " :flag_fr:  :flag_de:  🇫"),
        ("👍🏽!", " :thumbs_up_sign_emoji_modifier_fitzpatrick_type-4: !"),
        ("a👩‍💻b", "a :woman_personal_computer: b"),
        ("🏳️‍🌈", " :waving_white_flag_rainbow: "),
        ("5️⃣ 5 #", " :keycap_5:  5 #"),
        ("✁ x\u200dy", "✁ x\u200dy"),
        ("", ""),
    ],
)
def test_emoji_sequences_are_one_emoji(spark, text, want):
    assert one(spark, text, X.emoji_to_text) == want


def test_emoji_table_of_the_caller(spark):
    table = {"⭐": "star", "👩‍💻": "coder", "👩": "woman", "❤️": "heart", "🏳️‍🌈": "pride", "[x]": "box"}
    named = lambda c: X.emoji_to_text(c, table)
    assert one(spark, "⭐👩‍💻👩❤❤️🏳️‍🌈🏳‍🌈😀[x", named) == " :star:  :coder:  :woman:  :heart:  :heart:  :pride:  :pride: 😀[x"
    assert one(spark, "[x]a", named) == " :box: a"
    assert one(spark, None, named) is None


def test_word_tokens(spark):
    assert one(spark, "I don't, it's DON'T", lambda c: K.tokenize_words(c)) == ["I", "do", "n't", ",", "it", "'s", "DO", "N'T"]


def test_stop_words(spark):
    assert one(spark, "I do n't like The cat", lambda c: K.remove_stopwords(K.tokenize_words(c))) == ["like", "cat"]
    assert one(spark, "I do n't like The cat", lambda c: K.remove_stopwords(K.tokenize_words(c), negators=NEGATORS)) == ["n't", "like", "cat"]


def test_grams(spark):
    assert one(spark, "A bc de fg", lambda c: K.ngrams(K.vector_tokens(c), 1, 2)) == ["bc", "de", "fg", "bc de", "de fg"]
    assert one(spark, "bc", lambda c: K.ngrams(K.vector_tokens(c), 2, 3)) == []
    with pytest.raises(ValueError):
        K.ngrams(None, 2, 1)


@pytest.mark.parametrize(
    "text, want",
    [
        ("not bad, actually pretty good #great", "mixed"),
        ("soooo tired of this 😀", "mixed"),
        ("yeah right, best service ever", "mixed"),
        ("this is a normal review text", "informal"),
        ("don't like", "other"),
        ("do n't like", "negation"),
        ("great...so", "mixed"),
        ("a   b", "elongation"),
        ("", "other"),
        ("\n\n\n\n", "other"),
        ("A b c d", "other"),
        ("OMG", "informal"),
        ("héno no", "negation"),
    ],
)
def test_categories(spark, text, want):
    assert one(spark, text, lambda c: G.error_category(G.error_signals(c))) == want


def test_sarcasm_needs_a_word_after_the_dots(spark):
    assert one(spark, "great...so", lambda c: G.error_signals(c)) == ["elongation", "sarcasm", "intensification"]
    assert one(spark, "great... so", lambda c: G.error_signals(c)) == ["elongation", "intensification"]


PYTHON = {
    "negation": re.compile(rf"\b({G.NEGATION_WORDS})\b", re.I),
    "contrast": re.compile(rf"\b({G.CONTRAST_WORDS})\b", re.I),
    "intensification": re.compile(rf"\b({G.INTENSIFIER_WORDS})\b", re.I),
}


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="noswvery n't.but_é\n", max_size=12), min_size=30, max_size=30))
def test_signals_follow_unicode_word_boundaries(spark, texts):
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    for row in rows.select("text", G.error_signals(F.col("text")).alias("s")).collect():
        for name, pattern in PYTHON.items():
            assert (name in row["s"]) == bool(pattern.search(row["text"])), (name, row["text"])


def test_lemmas_keep_order_and_empty_rows(spark):
    rows = spark.createDataFrame([(1, ["cats", "see", "cats"]), (2, []), (3, None)], "index bigint, tokens array<string>")
    table = spark.createDataFrame([("cats", "cat")], "form string, lemma string")
    got = {r["index"]: r["tokens"] for r in lemmatize(rows, table).collect()}
    assert got == {1: ["cat", "see", "cat"], 2: [], 3: []}


def test_lemmas_take_no_row_per_token_and_equal_the_join(spark):
    texts = [(i, ["Cats", "cats", "see", "s"] * (i % 3) + ["cats"]) for i in range(9)] + [(20, None), (21, []), (None, ["cats"]), (30, ["cats", "a"]), (30, ["b", "cats", "c"])]
    rows = spark.createDataFrame(texts, "index bigint, tokens array<string>")
    table = spark.createDataFrame([("cats", "cat"), ("s", ""), (None, "x")], "form string, lemma string")
    found = lemmatize(rows, table)
    in_order = lambda df: sorted(df.collect(), key=str)
    assert in_order(found) == in_order(cleaning._lemmatize_by_join(rows, table, "index", "tokens"))
    alone = lemmatize(rows.filter("index < 9"), table)
    plan = alone._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Exchange" not in plan
    twice = table.union(table)
    assert in_order(lemmatize(rows, twice)) == in_order(cleaning._lemmatize_by_join(rows, twice, "index", "tokens"))


def test_clean_text_follows_the_configuration(spark):
    rows = spark.createDataFrame([(1, "I do NOT like the CATSSSS 😀 www.x.y @me")], "index bigint, text string")
    pre = baseline_configuration("1")["preprocessing"]
    table = spark.createDataFrame([("catss", "cat")], "form string, lemma string")
    full = pre | {"stopwords": "remove_preserve_negation", "negators": NEGATORS, "lemmatize": True, "elongation": "normalize", "emoji": "text"}
    assert clean_text(rows, full, lemma_table=table).first()["clean"] == "not like cat : grinning_face : url user"
    assert clean_text(rows, None).first()["clean"] == rows.first()["text"]
    assert clean_text(rows, pre).first()["clean"] == "i do not like the catssss 😀 url user"
    with pytest.raises(ValueError):
        clean_text(rows, full)
