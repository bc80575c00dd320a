"""Language of texts: function-word vote, and character n-grams as a join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagevane.functions.language import NON_LETTERS, STOP_WORDS, UNDETERMINED, detect_lang
from pagevane.operators.extract import compute_once
from pagevane.session import scratch_dir

LANGUAGES = tuple(STOP_WORDS)
GRAM = 3
# N-grams of a profile that each task holds while it reads texts, some 20 MB; the alphabets of a few languages have fewer.
FREQUENT = 1 << 17
# Weights are log-probabilities in millionths, as integers: their sums do not
# depend on the order of addition, so the result is the same for any partitioning.
WEIGHT_SCALE = 1_000_000
FLOOR_PROBABILITY = 1e-7


def with_language(df: DataFrame, text: str = "text", name: str = "detected") -> DataFrame:
    return compute_once(df, **{name: detect_lang(text)})


def language_filter(df: DataFrame, lang: str = "fr", text: str = "text") -> DataFrame:
    """Rows whose detected language is ``lang``, with the ``detected`` column."""
    return with_language(df, text).filter(F.col("detected") == lang)


def _words(text: str) -> Column:
    return F.explode(F.split(F.lower(F.col(text)), NON_LETTERS))


def _grams(word: Column, n: int) -> Column:
    """Character n-grams of a word padded with one space per side.

    Cut word by word: a substring far into a long text has to be searched for from
    its start, within a word the distance is short.
    """
    return F.explode(F.sequence(F.lit(1), F.greatest(F.length(word) + (3 - n), F.lit(1))))


def _cut(word: str, at: str, n: int) -> Column:
    padded = F.concat(F.lit(" "), F.col(word), F.lit(" "))
    return F.substr(padded, F.col(at), F.lit(n))


def _floor() -> Column:
    return F.round(F.log(F.lit(FLOOR_PROBABILITY)) * WEIGHT_SCALE).cast("bigint")


def train_ngram_profiles(
    labelled: DataFrame,
    text: str = "text",
    label: str = "lang",
    languages: tuple[str, ...] = LANGUAGES,
    n: int = GRAM,
) -> DataFrame:
    """One row per n-gram with a weight column per language: all n-grams of the texts.

    A profile can be stored as a table and read again for ``classify_ngrams``.
    """
    # Words are counted first; there are far fewer of them to cut into n-grams.
    words = (
        labelled.filter(F.col(label).isin(*languages))
        .select(F.col(label).alias("label"), _words(text).alias("word"))
        .filter("word <> ''")
        .groupBy("label", "word")
        .agg(F.count("*").alias("n"))
    )
    counts = (
        words.select("label", "n", "word", _grams(F.col("word"), n).alias("at"))
        .groupBy("label", _cut("word", "at", n).alias("gram"))
        .agg(F.sum("n").alias("n"))
    )
    # One row per language.
    totals = counts.groupBy("label").agg(F.sum("n").alias("total"))
    share = F.col("n") / F.col("total")
    weight = F.round(F.log(share) * WEIGHT_SCALE).cast("bigint")
    weighted = counts.join(F.broadcast(totals), "label").withColumn("weight", F.greatest(weight, _floor()))
    return (
        weighted.groupBy("gram")
        .pivot("label", list(languages))
        .agg(F.first("weight"))
        .select("gram", *[F.coalesce(F.col(c), _floor()).alias(f"w_{c}") for c in languages])
    )


def classify_ngrams(
    df: DataFrame,
    profiles: DataFrame,
    key: str,
    text: str = "text",
    languages: tuple[str, ...] = LANGUAGES,
    n: int = GRAM,
    frequent: int = FREQUENT,
) -> DataFrame:
    """Naive Bayes language of each row: ``(key, detected, n_matched)``.

    The ``frequent`` n-grams of most weight meet a text where it is read, and its sums alone are
    shuffled. Of larger profiles (written aside first, to know) the rest is joined with the n-grams
    of a text that are not among the frequent ones, so that no n-gram is lost.
    """
    spark = df.sparkSession
    path = scratch_dir(spark)
    profiles.select("gram", *[f"w_{c}" for c in languages]).write.parquet(path)
    stored = spark.read.schema(_profile_schema(languages)).parquet(path)
    has_rest = stored.count() > frequent
    # The empty word stays in, so that a row without any letter keeps its place.
    words = df.select(key, _words(text).alias("word"))
    grams = words.select(key, "word", _grams(F.col("word"), n).alias("at")).select(key, _cut("word", "at", n).alias("gram"))
    if has_rest:
        weight = F.greatest(*[f"w_{c}" for c in languages])
        near = stored.orderBy(weight.desc(), "gram").limit(frequent)
        met = grams.join(F.broadcast(near), "gram", "left")
        # Without a rare n-gram a name that no n-gram has, another for each key: they don't meet in one task.
        rare = F.when(_known(languages).isNull(), F.col("gram"))
        met = met.withColumn("rare", F.coalesce(rare, F.concat(F.lit(" " * (n + 1)), F.col(key).cast("string"))))
        counted = met.groupBy(key, "rare").agg(F.count("*").alias("n"), *_sums(languages))
        late = stored.select(F.col("gram").alias("rare"), *[F.col(f"w_{c}").alias(f"r_{c}") for c in languages])
        counted = counted.join(late, "rare", "left")
        is_late = F.col(f"r_{languages[0]}").isNotNull()
        sums = counted.select(
            key,
            F.when(is_late, F.col("n")).otherwise(F.col("n_matched")).alias("n_matched"),
            *[F.coalesce(F.col(f"r_{c}") * F.col("n"), F.col(f"s_{c}")).alias(f"s_{c}") for c in languages],
        )
        scored = sums.groupBy(key).agg(*[F.sum(c).alias(c) for c in ("n_matched", *(f"s_{c}" for c in languages))])
    else:
        scored = grams.join(F.broadcast(stored), "gram", "left").groupBy(key).agg(*_sums(languages))
    best = F.greatest(*[F.col(f"s_{c}") for c in languages])
    detected = F.lit(UNDETERMINED)
    for code in reversed(languages):
        detected = F.when(F.col(f"s_{code}") == best, F.lit(code)).otherwise(detected)
    detected = F.when(F.col("n_matched") == 0, F.lit(UNDETERMINED)).otherwise(detected)
    return scored.select(key, detected.alias("detected"), "n_matched")


def _known(languages: tuple[str, ...]) -> Column:
    return F.col(f"w_{languages[0]}")


def _sums(languages: tuple[str, ...]) -> list[Column]:
    """Known n-grams, and the sum of their weights for each language, of n-grams that met their profiles."""
    weights = [F.coalesce(F.sum(f"w_{c}"), F.lit(0)).alias(f"s_{c}") for c in languages]
    return [F.count(_known(languages)).alias("n_matched"), *weights]


def _profile_schema(languages: tuple[str, ...]) -> str:
    return ", ".join(["gram string", *[f"w_{c} bigint" for c in languages]])


def corpus_profile(df: DataFrame, segments: str = "n_segments", lang: str = "fr") -> DataFrame:
    """Rows and segments per detected language, kept or dropped, with a total line."""
    return (
        df.rollup("detected")
        .agg(
            F.count("*").alias("n_docs"),
            F.count_if(F.col("detected") == lang).alias("n_kept"),
            F.sum(segments).alias("n_segments"),
        )
        .select(
            F.coalesce("detected", F.lit("total")).alias("detected"),
            "n_docs",
            "n_kept",
            (F.col("n_docs") - F.col("n_kept")).alias("n_dropped"),
            F.col("n_segments").cast("bigint").alias("n_segments"),
        )
    )
