"""Topics as four tables: assignments, words, overview, vectors."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml.feature import PCA, StopWordsRemover
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recensio.functions.features import let, terms
from recensio.functions.wordlists import TOPIC_NOISE_WORDS
from recensio.operators.blocks import with_blocks
from recensio.operators.density import NOISE, density_cluster
from recensio.operators.encode import encode_documents
from recensio.operators.scale import lookup_join, number_in_order
from recensio.operators.vectors import cosine, dot
from recensio.operators.spectral import reduce_by_neighbours
from recensio.session import materialize

#: Topics of a row whose probabilities are told one by one.
BEST_TOPICS = 10
#: Fewer texts than this are not modelled.
MIN_DOCUMENTS = 11


def stop_words(brand_words: Sequence[str] = ()) -> list[str]:
    """Italian stop words, the noise words, and the reviewed product's names."""
    return [*StopWordsRemover.loadDefaultStopWords("italian"), *TOPIC_NOISE_WORDS, *brand_words]


def enough_documents(df: DataFrame, least: int = MIN_DOCUMENTS) -> bool:
    return df.limit(least).count() >= least


def number_topics(clusters: DataFrame, key: str) -> DataFrame:
    """``(key, topic)``: clusters renumbered 0, 1, ... by falling size, noise -1."""
    sizes = clusters.filter(F.col("cluster") != NOISE).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    ranked = number_in_order(sizes, [F.desc("n"), F.asc("cluster")], "topic")
    ranked = ranked.select("cluster", F.col("topic").cast("int").alias("topic"))
    return lookup_join(clusters, ranked, ["cluster"]).select(
        key, F.coalesce("topic", F.lit(NOISE)).alias("topic")
    )


def topic_term_counts(
    df: DataFrame, text: str, topic: str = "topic", stop: Sequence[str] = (), min_df: int = 2
) -> DataFrame:
    """``(topic, term, tf)`` of terms that occur in at least ``min_df`` topics."""
    tokens = df.select(F.col(topic).alias("topic"), F.explode(terms(F.col(text))).alias("term"))
    if stop:
        tokens = tokens.filter(~F.col("term").isin(list(stop)))
    counted = materialize(tokens.groupBy("topic", "term").agg(F.count(F.lit(1)).alias("tf")))
    spread = counted.groupBy("term").agg(F.count(F.lit(1)).alias("topics")).filter(F.col("topics") >= min_df)
    return lookup_join(counted, spread, ["term"], "inner", seen="topics").select("topic", "term", "tf")


def class_tfidf(counts: DataFrame) -> DataFrame:
    """``(topic, term, weight)``: share of the term in its topic x ln(1 + A / f).

    f is the term's count over all topics, A the mean number of words per topic
    as an integer (Grootendorst 2022).
    """
    counts = materialize(counts)
    lengths = counts.groupBy("topic").agg(F.sum("tf").alias("length"))
    mean = lengths.agg(F.floor(F.avg("length")).alias("a")).first()["a"] or 0
    totals = counts.groupBy("term").agg(F.sum("tf").alias("f"), F.count(F.lit(1)).alias("topics"))
    joined = lookup_join(lookup_join(counts, lengths, ["topic"], "inner"), totals, ["term"], "inner", seen="topics")
    weight = F.col("tf") / F.col("length") * F.log(1.0 + F.lit(float(mean)) / F.col("f"))
    return joined.select("topic", "term", weight.alias("weight"))


def top_words(weights: DataFrame, k: int = 10) -> DataFrame:
    """``(topic, rank, term, weight)``: the k heaviest words of each topic."""
    order = Window.partitionBy("topic").orderBy(F.desc("weight"), "term")
    return (
        weights.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("topic", "rank", "term", "weight")
    )


def topic_info(doc_topics: DataFrame, words: DataFrame, in_name: int = 4) -> DataFrame:
    """``(topic, count, name, words)``, e.g. ``0_login_codice_accesso_conto``."""
    counts = doc_topics.groupBy("topic").agg(F.count(F.lit(1)).alias("count"))
    ordered = F.array_sort(F.collect_list(F.struct("rank", "term")))["term"]
    named = words.groupBy("topic").agg(ordered.alias("words"))
    name = F.concat_ws("_", F.col("topic").cast("string"), F.slice(F.coalesce("words", F.array().cast("array<string>")), 1, in_name))
    return counts.join(named, "topic", "left").select("topic", "count", name.alias("name"), "words")


def topic_vectors(doc_topics: DataFrame, vectors: DataFrame, key: str, vector: str = "vector") -> DataFrame:
    """``(topic, vector)``: mean vector of the topic's texts, noise left out."""
    size = vectors.select(F.size(vector).alias("n")).first()
    dims = size["n"] if size else 0
    means = (
        doc_topics.filter(F.col("topic") != NOISE)
        .join(vectors.select(key, F.col(vector).alias("_v")), key)
        .groupBy("topic")
        .agg(*[F.avg(F.col("_v")[i].cast("double")).alias(f"_m{i}") for i in range(dims)])
    )
    return means.select("topic", F.array(*[F.col(f"_m{i}") for i in range(dims)]).alias("vector"))


def _distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.greatest(F.lit(0.0), dot(a, a) + dot(b, b) - 2 * dot(a, b)))


def topic_probabilities(vectors: DataFrame, centres: DataFrame, key: str, vector: str = "vector") -> DataFrame:
    """``(key, probs)``: softmax of minus the distance to each topic's vector."""
    rows = vectors.select(key, F.col(vector).cast("array<double>").alias("_v"))
    near = with_blocks(rows, centres.select("topic", "vector")).select(
        key,
        F.transform(
            "items",
            lambda t: F.struct(t["topic"].alias("topic"), (-_distance(F.col("_v"), t["vector"])).alias("score")),
        ).alias("part"),
    )
    scored = near.groupBy(key).agg(F.array_sort(F.flatten(F.collect_list("part"))).alias("scores"))

    def softmax(scores: Column) -> Column:
        top = F.array_max(F.transform(scores, lambda s: s["score"]))
        powers = let(top, lambda m: F.transform(scores, lambda s: F.exp(s["score"] - m)))
        return let(
            powers,
            lambda p: let(F.aggregate(p, F.lit(0.0), lambda acc, x: acc + x), lambda n: F.transform(p, lambda x: x / n)),
        )

    return scored.select(key, let(F.col("scores"), softmax).alias("probs"))


def top_probabilities(vectors: DataFrame, centres: DataFrame, key: str, vector: str = "vector", k: int = BEST_TOPICS) -> DataFrame:
    """``(key, best, rest)``: the ``k`` most probable topics as ``(topic, prob)``, and the probability of all others.

    The softmax of ``topic_probabilities`` without an array of all topics: of every block of topics a row keeps its
    ``k`` best and the sum of the block's powers, so a row's state does not grow with a block.
    Ties go to the smaller topic; ``rest`` is 0 where there are no others.
    """
    rows = vectors.select(key, F.col(vector).cast("array<double>").alias("_v"))
    scored = with_blocks(rows, centres.select("topic", "vector")).select(
        key,
        F.transform(
            "items", lambda t: F.struct((-_distance(F.col("_v"), t["vector"])).alias("score"), (-t["topic"]).alias("minus"))
        ).alias("part"),
    )
    top = F.array_max(F.transform("part", lambda s: s["score"]))
    powers = let(top, lambda m: F.aggregate(F.transform("part", lambda s: F.exp(s["score"] - m)), F.lit(0.0), lambda a, x: a + x))
    best = F.slice(F.sort_array("part", asc=False), 1, k)
    parts = scored.select(key, top.alias("top"), powers.alias("powers"), best.alias("best"))
    merged = parts.groupBy(key).agg(
        F.max("top").alias("top"),
        F.collect_list(F.struct("top", "powers")).alias("sums"),
        F.slice(F.sort_array(F.flatten(F.collect_list("best")), asc=False), 1, k).alias("best"),
    )
    total = F.aggregate("sums", F.lit(0.0), lambda a, s: a + s["powers"] * F.exp(s["top"] - F.col("top")))
    merged = merged.withColumn("total", total)
    named = F.transform("best", lambda s: F.struct((-s["minus"]).alias("topic"), (F.exp(s["score"] - F.col("top")) / F.col("total")).alias("prob")))
    named = merged.select(key, named.alias("best"))
    held = F.aggregate("best", F.lit(0.0), lambda a, t: a + t["prob"])
    return named.select(key, "best", F.greatest(F.lit(0.0), 1 - held).alias("rest"))


def topic_metrics(doc_topics: DataFrame) -> DataFrame:
    """``(n_topics, n_docs, n_outliers, outlier_percentage)``; noise is no topic."""
    sizes = doc_topics.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
    noise = F.coalesce(F.sum(F.when(F.col("topic") == NOISE, F.col("n"))), F.lit(0))
    return sizes.agg(
        F.count(F.when(F.col("topic") != NOISE, True)).alias("n_topics"),
        F.sum("n").alias("n_docs"),
        noise.alias("n_outliers"),
        (noise / F.sum("n") * 100).alias("outlier_percentage"),
    )


def topic_map(centres: DataFrame) -> DataFrame:
    """``(topic, x, y)``: topic vectors on their two leading principal directions."""
    dense = centres.select("topic", array_to_vector("vector").alias("_v"))
    model = PCA(k=2, inputCol="_v", outputCol="_p").fit(dense)
    flat = model.transform(dense).select("topic", vector_to_array("_p").alias("p"))
    return flat.select("topic", F.col("p")[0].alias("x"), F.col("p")[1].alias("y"))


def word_scores(info: DataFrame, words: DataFrame, top_topics: int = 10, per_topic: int = 5) -> DataFrame:
    """Words of the largest topics; noise is left out."""
    largest = info.filter(F.col("topic") != NOISE).orderBy(F.desc("count"), "topic").limit(top_topics)
    return words.filter(F.col("rank") <= per_topic).join(largest.select("topic"), "topic", "left_semi")


def topic_similarity(centres: DataFrame) -> DataFrame:
    """``(topic, other, similarity)``: the whole cosine matrix."""
    rows = centres.select("topic", "vector")
    met = with_blocks(rows, centres.select(F.col("topic").alias("other"), F.col("vector").alias("_w")))
    cells = F.transform(
        "items", lambda t: F.struct(t["other"].alias("other"), cosine(F.col("vector"), t["_w"]).alias("similarity"))
    )
    return met.select("topic", F.inline(cells))


def attach_topics(df: DataFrame, key: str, doc_topics: DataFrame) -> DataFrame:
    return df.join(doc_topics.select(key, "topic"), key, "left")


def fit_topics(
    df: DataFrame,
    key: str,
    text: str,
    vectors: DataFrame | None = None,
    min_topic_size: int = 15,
    brand_words: Sequence[str] = (),
    stop: Sequence[str] | None = None,
    probabilities: bool = False,
    dims: int = 5,
    reduce: Callable[..., DataFrame] = reduce_by_neighbours,
) -> dict[str, DataFrame]:
    """Encode, reduce, cluster, and describe; the four tables of a topic model.

    ``reduce`` keeps neighbours together; ``reduce_vectors`` (principal directions) is the quicker way for
    vectors that lie in plain heaps.

    Texts without a vector are noise. ``probabilities`` adds each row's most
    probable topics and the share of all others (see ``top_probabilities``).
    """
    docs = df.select(key, text)
    vectors = materialize(vectors if vectors is not None else encode_documents(docs, key, text))
    reduced = reduce(vectors, key, dims=dims)
    clustered = density_cluster(reduced, key, "reduced", min_topic_size)
    clusters = docs.select(key).join(clustered, key, "left").withColumn(
        "cluster", F.coalesce("cluster", F.lit(NOISE))
    )
    doc_topics = materialize(number_topics(clusters, key))
    centres = materialize(topic_vectors(doc_topics, vectors, key))
    if probabilities:
        doc_topics = doc_topics.join(top_probabilities(vectors, centres, key), key, "left")
    stop = stop_words(brand_words) if stop is None else stop
    counts = topic_term_counts(docs.join(doc_topics.select(key, "topic"), key), text, stop=stop)
    words = materialize(top_words(class_tfidf(counts)))
    return {
        "doc_topics": doc_topics,
        "topic_words": words,
        "topic_info": topic_info(doc_topics, words),
        "topic_vectors": centres,
    }
