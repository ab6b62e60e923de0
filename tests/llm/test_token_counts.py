"""Prefix counts against the tokenizers library, encoding every prefix."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickspark.llm import queries, token_counts

PATH = queries.vocabulary("word_bpe_49k.json")


@pytest.fixture(scope="module")
def count():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(PATH)
    library.no_truncation()
    library.no_padding()
    return lambda text: len(library.encode(text, add_special_tokens=False).ids)


def own(text: str) -> list[int]:
    return next(token_counts.counter(PATH).counts([text])).tolist()


TEXTS = [
    "", " ", "hello world", "I've don't they'll 'Re 'LL 'tis !!'s x'sa 'v 've", "  lead\ttrail \n", "café naïve ÀÉ", "éx ậ 한", "aaaaaaaaaaaa" * 9,
    "<|endoftext|>", "ab!!<|endoftext|> c<|startoftext|><|end", "<|endoftext|<|endoftext|>", "İstanbul ſ ʼn ŉ 'ſ", "漢字かな 가각 हिन्दी ไทย", "\xa0x\u0085y　z", "12345 ½ ² ٣", "a\x00b\x1cc", "ΑΣ ς", "🎉👍🏽 a🎉b", "Å ``", "́ ́x",
]


@pytest.mark.parametrize("text", TEXTS)
def test_every_prefix_equals_the_library(count, text):
    assert own(text) == [count(text[:k]) for k in range(len(text) + 1)]


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(["a", "b", "th", "e", "é", "É", "̣", "'s", "'RE", "<|endoftext|>", "<|", "12", "!", " ", "\n", "İ", "中", "ᅡ", "ᄒ"]).flatmap(lambda s: st.sampled_from(list(s))), max_size=30) | st.lists(st.sampled_from(["a", "the", "é", "é", "̣", "'s", "'RE", "<|endoftext|>", "<|", "12", "!", " ", "\n", "İ", "中"]), max_size=12).map("".join))
def test_any_text(count, text):
    assert own(text) == [count(text[:k]) for k in range(len(text) + 1)]


def test_words_out_of_the_vocabulary_and_forgotten_ones(count):
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(1, 90))) for _ in range(40)) for _ in range(20)]
    small = token_counts.PrefixCounter(PATH, cache_entries=50)
    for text, counts in zip(texts, small.counts(texts)):
        assert counts[-1] == count(text)
        assert all(counts[k] == count(text[:k]) for k in range(0, len(text), 37))


def test_query(spark, sf_dir, count):
    rows = queries.op13_token_counts(spark, sf_dir).collect()
    docs = {r["doc_id"]: r["text"] or "" for r in queries.table(spark, sf_dir, "documents").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        text = docs[r["doc_id"]]
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), count(text), count(text) > 2048)
        assert count(text[: r["fit_chars"]]) <= 2048 and (r["fit_chars"] == len(text) or count(text[: r["fit_chars"] + 1]) > 2048)


def test_stored_counts_answer_budgets(spark, count):
    text = "Them thereabouts, the whole of it: don't <|endoftext|> stoṕ now"
    d = spark.createDataFrame([(1, text, 9), (1, text, 9), (None, None, 9), (2, "", 9)], "doc_id long, text string, counts int")
    stored = token_counts.prefix_counts(d, PATH)
    assert stored.columns == ["doc_id", "counts"]
    asked = stored.select("doc_id", token_counts.count_of().alias("n"), token_counts.tokens_upto(11).alias("upto"), token_counts.tokens_upto(10_000).alias("all"), token_counts.longest_within(5).alias("fit"), token_counts.longest_within(0).alias("none"))
    want = max(k for k in range(len(text) + 1) if count(text[:k]) <= 5)
    one = (1, count(text), count(text[:11]), count(text), want, 0)
    assert sorted(map(tuple, asked.collect()), key=str) == sorted([one, one, (None, 0, 0, 0, 0, 0), (2, 0, 0, 0, 0, 0)], key=str)
    direct = token_counts.count_tokens(d, PATH, (5, 0)).filter("doc_id = 1").first()
    assert (direct["n_tokens"], direct["fits"], direct["n_bytes"]) == (count(text), [want, 0], len(text.encode()))


def test_no_rows_other_ids_and_wrong_files(spark):
    assert token_counts.count_tokens(spark.createDataFrame([], "doc_id string, text string"), PATH).collect() == []
    named = token_counts.count_tokens(spark.createDataFrame([("a", "b c")], "name string, text string"), PATH, key="name").first()
    assert (named["name"], named["n_tokens"]) == ("a", 2)
    with pytest.raises(ValueError):
        token_counts.count_tokens(spark.createDataFrame([], "doc_id long, text string"), PATH, (-1,))
    with pytest.raises(ValueError):
        token_counts.PrefixCounter(queries.vocabulary())


def test_a_long_text_of_one_word(count):
    word = "".join(random.Random(1).choice("abcdefgh") for _ in range(20_000))
    assert own(word)[-1] == count(word)
