"""Language subsets and TF-IDF features as DataFrame arithmetic."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import strip_accents
from .grams import gram_weights, text_blocks
from .ordered import col, settle


def language_subset(df: DataFrame, language: str, column: str = "lang") -> DataFrame:
    return df.filter(F.upper(col(column)) == language.upper())


def default_stop_words(language: str) -> list[str]:
    """The stop words shipped with Spark; a list of one's own can be read with ``read_list``."""
    names = {"en": "english", "fr": "french", "de": "german", "es": "spanish", "it": "italian", "pt": "portuguese"}
    return StopWordsRemover.loadDefaultStopWords(names[language.lower()])


def word_tokens(text):
    """Lower-cased, accent-free words of one or more letters, digits or underscores."""
    return F.regexp_extract_all(strip_accents(F.lower(text)), F.lit(r"(?U)\b\w+\b"), F.lit(0))


def _grams(words: Column, n: int) -> Column:
    """Runs of n neighbouring words."""
    starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - n + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))


def _kept_words(text: str, stop_words: list[str]) -> Column:
    return F.filter(word_tokens(col(text)), lambda w: ~w.isin(stop_words)) if stop_words else word_tokens(col(text))


def terms(df: DataFrame, key: str, text: str, stop_words: list[str], longest: int = 3) -> DataFrame:
    """(key, term): n-grams up to ``longest`` words over each text's words after stop-word removal."""
    tokens = df.select(col(key), _kept_words(text, stop_words).alias("w"))
    grams = [F.col("w")] + [_grams(F.col("w"), n) for n in range(2, longest + 1)]
    return tokens.select(key, F.explode(F.concat(*grams)).alias("term"))


def document_frequencies(term_counts: DataFrame, min_df: int) -> DataFrame:
    return term_counts.groupBy("term").agg(F.count(F.lit(1)).alias("df")).filter(col("df") >= min_df)


def tf_idf(df: DataFrame, key: str, text: str, stop_words: list[str] = (), min_df: int = 20, longest: int = 3) -> DataFrame:
    """(key, term, weight): (1 + ln tf) * (ln((1 + n) / (1 + df)) + 1), scaled to unit length per text.

    The same as ``terms`` joined to ``document_frequencies``, but terms are counted and weighed in blocks of texts: a row per term and text, shuffled and
    stored, takes many times the disk of the texts.
    """
    n = df.count()
    words = F.array_join(_kept_words(text, list(stop_words)), " ")
    blocks = settle(text_blocks(df.select(col(key), words.alias("_text")), key, "_text", n), "blocks")  # texts are cut into words once
    return gram_weights(blocks, key, n, min_df, max(1, longest))


def vocabulary(features: DataFrame) -> DataFrame:
    return features.select("term").distinct()


def shape(features: DataFrame, key: str) -> DataFrame:
    """Number of texts with a feature, distinct terms and non-zero weights."""
    both = (F.count_distinct(col(key)).alias("n_texts"), F.count_distinct("term").alias("n_terms"))
    return features.agg(*both, F.sum(F.lit(1)).alias("n_weights"))  # one pass over the features
