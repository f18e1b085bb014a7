"""These must equal the published behaviour for right results."""

# Junk words of the current, the earlier and the exploratory profile.
JUNK_WORDS = ["ok", "pessima", "bella", "sconsigliata", "bene", "boh", "bleah", "male", "top"]
JUNK_WORDS_LEGACY = ["ok", "pessima", "bella", "sconsigliata", "bene", "boh", "bleah", "male"]
MEANINGLESS_WORDS = [
    "ok", "okay", "si", "no", "mah", "boh",
    "ciao", "hello", "hi", "hey",
    "bene", "male", "bravo", "nice", "good", "bad", "pessima", "scadente",
]

# Words left out of topics besides the Italian stop words. The name of the
# reviewed product belongs here too; callers pass it as ``brand_words``.
TOPIC_NOISE_WORDS = ["app", "applicazione", "solo", "sempre", "fatto", "fare", "avere", "essere", "paga"]

SENTIMENT_VALUE = {"negative": -1, "neutral": 0, "positive": 1}

LANGUAGE_NAME = {
    "it": "Italian",
    "en": "English",
    "pt": "Portuguese",
    "es": "Spanish",
    "fr": "French",
    "de": "German",
    "nan": "Unknown",
}

TRANSLATOR_CODE = {
    "en": "eng_Latn",
    "es": "spa_Latn",
    "fr": "fra_Latn",
    "de": "deu_Latn",
    "it": "ita_Latn",
    "pt": "por_Latn",
    "ro": "ron_Latn",
    "nl": "nld_Latn",
    "pl": "pol_Latn",
    "ru": "rus_Cyrl",
    "ar": "arb_Arab",
    "zh": "zho_Hans",
}
TRANSLATOR_CODE_DEFAULT = "eng_Latn"

# A review is noisy when a feature exceeds its limit.
NOISE_LIMITS = {
    "emoji_count": 2,
    "url_count": 0,
    "hashtag_count": 0,
    "repeated_chars": 2,
    "uppercase_ratio": 0.5,
}
# Rule outliers: above / below.
OUTLIER_ABOVE = {
    **NOISE_LIMITS,
    "review_length": 600,
    "special_char_count": 15,
    "digit_ratio": 0.3,
    "rare_token_ratio": 0.4,
}
OUTLIER_BELOW = {"review_length": 15, "review_word_count": 3, "token_entropy": 1.2}
