import pytest
from pyspark.sql import functions as F

from recensio.functions import emoji, features as fx, text as fn


@pytest.mark.parametrize(
    "raw, clean",
    [
        (None, ""),
        ("  Nooooo  ok ", "Noo ok"),
        ("see http://a.it/x now", "see <URL> now"),
        ("ciao @Perché!!!", "ciao <USER>!!"),
        ("a@b.com", "a<USER>.com"),
        ("👍", ":thumbs_up:"),
        ("bene👎👎", "bene :thumbs_down: :thumbs_down:"),
        ("a  b\n\n\nc", "a b c"),
    ],
)
def test_clean_main(one, raw, clean):
    assert one(fn.clean_text, raw) == clean


def test_profiles_differ_in_url_mask_and_emoji_place(one):
    assert one(lambda c: fn.clean_text(c, "legacy"), "x http://a 👍") == "x <URL>  👍"
    assert one(lambda c: fn.clean_text(c, "emoji_last"), "ok👍") == "ok :thumbs_up: "
    with pytest.raises(ValueError):
        fn.clean_text(F.lit("a"), "other")


def test_squeeze_runs_leaves_newlines(one):
    assert one(fn.squeeze_runs, "a\n\n\n\nbbbb") == "a\n\n\n\nbb"


def test_cleaning_twice_changes_nothing_more_in_spaces(one):
    once = one(fn.clean_text, "  a \t b   c  ")
    assert one(fn.clean_text, once) == once == "a b c"


def test_aliases(one):
    assert one(emoji.emoji_to_alias, "a👍🏽b") == "a :thumbs_up_medium_skin_tone: b"
    assert one(emoji.emoji_to_alias, "🇮🇹") == " :Italy: "
    assert one(emoji.emoji_to_alias, "🇺🇸") == " :United_States: "
    assert one(emoji.emoji_to_alias, "no 1 # emoji *") == "no 1 # emoji *"
    assert one(emoji.emoji_list, "x👍y❤️1️⃣") == ["👍", "❤️", "1️⃣"]
    assert one(emoji.emoji_count, "👨‍👩‍👧 e 🚀") == 2


@pytest.mark.parametrize(
    "text, name",
    [
        ("\U0001f3f4" + "".join(chr(0xE0000 + ord(c)) for c in "gbeng") + "\U000e007f", "England"),
        ("\U0001f3f4" + "".join(chr(0xE0000 + ord(c)) for c in "ustx") + "\U000e007f", "flag_ustx"),
        ("👨\u200d👩\u200d👧", "family_man_woman_girl"),
        ("👩\u200d👦\u200d👦", "family_woman_boy_boy"),
        ("👩\u200d❤\ufe0f\u200d👨", "couple_with_heart_woman_man"),
        ("👩\u200d❤\u200d💋\u200d👩", "kiss_woman_woman"),
        ("👩🏽\u200d💻", "woman_technologist_medium_skin_tone"),
        ("🧑\u200d🚒", "firefighter"),
        ("🤷🏿\u200d♀\ufe0f", "woman_shrugging_dark_skin_tone"),
        ("🧑🏻\u200d🤝\u200d🧑🏿", "people_holding_hands_light_skin_tone_dark_skin_tone"),
        ("❤\ufe0f\u200d🔥", "heart_on_fire"),
        ("🏳\ufe0f\u200d🌈", "rainbow_flag"),
        ("🔥\u200d🚀", "fire_rocket"),
        ("🏴", "waving_black_flag"),
    ],
)
def test_sequences_have_one_name(one, text, name):
    assert one(emoji.emoji_to_alias, f"a{text}b") == f"a :{name}: b"
    assert one(emoji.emoji_count, f"a{text}b{text}") == 2


def test_entropy_and_uppercase_words(one):
    assert one(fx.token_entropy, "a a a a") == 0.0
    assert one(fx.token_entropy, "a b c d") == 2.0
    assert one(fx.token_entropy, "") == 0.0
    assert one(fx.mostly_uppercase_words, "CIAO mondo") is False
    assert one(fx.mostly_uppercase_words, "CIAO MONDO") is True
    assert one(fx.mostly_uppercase_words, "") is False
    assert one(fx.mostly_uppercase_words, None) is False


def test_missing_text_counts_as_the_word_nan(one):
    assert one(fx.review_length, None) == 3
    assert one(fx.word_count, None) == 1
    assert one(fx.uppercase_ratio, "") == 0.0
    assert one(fx.punctuation_count, None) is None


def test_term_counts(one):
    got = one(lambda c: fx.term_counts(fx.words(c)), "b a b c b")
    assert [(r["term"], r["tf"]) for r in got] == [("a", 1), ("b", 3), ("c", 1)]
    assert one(lambda c: fx.term_counts(fx.words(c)), "") == []


def test_row_functions_work_on_a_stream(spark, tmp_path):
    from recensio.operators import filters

    source, sink = str(tmp_path / "in"), str(tmp_path / "out")
    rows = [(1, "Negative", "Nooooo http://a"), (2, "positive", "ok"), (3, " negative", "ok")]
    spark.createDataFrame(rows, "review_id long, sentiment string, review string").write.parquet(source)
    stream = spark.readStream.schema("review_id long, sentiment string, review string").parquet(source)
    clean = fx.add_features(fn.basic_cleaning(stream))
    kept = filters.remove_junk(filters.keep_negative(clean)).filter(~filters.is_noisy({"hashtag_count": 0}))
    query = (
        kept.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c"))
        .trigger(availableNow=True).start(sink)
    )
    query.awaitTermination()
    got = spark.read.parquet(sink).select("review_id", "clean_text").collect()
    assert [tuple(r) for r in got] == [(1, "Noo <URL>")]
