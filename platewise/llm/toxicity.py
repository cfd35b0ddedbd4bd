"""Operator 2: toxicity by a chain of linear classifiers.

The categories have an order. Each has a logistic model over the presence of words and stems and the
probabilities of all earlier categories. What a later model learns from are out-of-fold
probabilities: the training rows are dealt into folds by a hash of their id, and a row's probability
comes from a model that has not seen it. Scoring runs the chain over whole texts, without a shuffle.

The classifier is fitted on a bounded sample: ``sample_rows`` labelled rows in the order of a hash of
their ids. Its vocabulary has the words and stems of that sample whose presence and some category depend on
each other (chi-squared of LEAST_CHI2 or more), the MOST_WORDS strongest at most. Long texts then
gather no noise from words that tell nothing.

Null and empty texts have no words and get the models' base rates. Rows without a label for every
category are not learned from. Where a category has one class only, its share is every row's
probability (0 if there are no rows). Repeated rows are scored one by one, and extra columns not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platewise.llm.common import with_value
from platewise.session import stage, staged_path

SAMPLE_ROWS = 12_000
LEAST_DOCUMENTS = 5
LEAST_CHI2 = 10.0
MOST_WORDS = 4096
STEMS = (4, 5)  # letters
FOLDS = 5
PARTS = 4  # of the sample: a round of a fit is then one stage
THRESHOLD = 0.5


def tokens(text: Column) -> Column:
    """Distinct lower-case runs of letters and digits, and their first letters as stems (``idio-``)."""
    found = F.array_remove(F.array_distinct(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+")), "")

    def stems(own: Column, letters: int) -> Column:
        long = F.filter(own, lambda word: F.length(word) > letters)
        return F.transform(long, lambda word: F.concat(F.substring(word, 1, letters), F.lit("-")))

    def with_stems(own: Column) -> Column:
        return F.concat(own, *(F.array_distinct(stems(own, letters)) for letters in STEMS))

    return with_value(found, with_stems)


@dataclass
class Chain:
    """Fitted models in the order of their categories; a number stands for a constant probability."""

    names: list[str]
    vocabulary: CountVectorizerModel | None
    models: list[LogisticRegressionModel | float]

    def vectors(self, texts: DataFrame) -> DataFrame:
        """Adds the column ``present`` from ``tokens``."""
        return texts if self.vocabulary is None else self.vocabulary.transform(texts)

    def score(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """(key, p_<category> ...)"""
        scored = self.vectors(docs.select(F.col(key).alias("key"), tokens(F.col(text)).alias("tokens")))
        for number, model in enumerate(self.models):
            scored = _with_probability(scored, model, self.names[:number], self.names[number])
        return scored.select(F.col("key").alias(key), *(f"p_{name}" for name in self.names))


def _with_probability(vectors: DataFrame, model: LogisticRegressionModel | float, earlier: list[str], name: str) -> DataFrame:
    if isinstance(model, float):
        return vectors.withColumn(f"p_{name}", F.lit(model))
    seen = VectorAssembler(inputCols=["present", *(f"p_{x}" for x in earlier)], outputCol="features").transform(vectors)
    scored = model.transform(seen).withColumn(f"p_{name}", vector_to_array("probability")[1])
    return scored.drop("features", "rawPrediction", "probability", "prediction")


def _fit_one(vectors: DataFrame, earlier: list[str], name: str) -> LogisticRegressionModel | float:
    share = vectors.agg(F.avg(name)).first()[0]
    if share is None or share in (0.0, 1.0):
        return float(share or 0.0)
    seen = VectorAssembler(inputCols=["present", *(f"p_{x}" for x in earlier)], outputCol="features").transform(vectors)
    learner = LogisticRegression(labelCol=name, regParam=1e-4, maxIter=30)
    # a fitted model carries its training summary, and with it the session, to every task, which fails once the
    # session has observed a frame; saved and loaded it is the coefficients alone
    path = staged_path(vectors.sparkSession, f"model-{name}")
    learner.fit(seen).save(path)
    return LogisticRegressionModel.load(path)


def sample(labels: DataFrame, names: list[str], key: str = "doc_id", rows: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``rows`` labelled ids in the order of a hash, with their 0/1 labels as doubles."""
    complete = labels.select(key, *(F.col(name).cast("double").alias(name) for name in names)).dropna()
    return complete.orderBy(F.xxhash64(key), key, *names).limit(rows)


def vocabulary(train: DataFrame, names: list[str]) -> list[str]:
    """The words of the sample that tell most about a category, by the chi-squared of a 2 x 2 table."""
    sums = [F.sum(name).alias(name) for name in names]
    total = train.agg(F.count("*").cast("double").alias("n"), *sums).first()
    seen = train.select(F.explode("tokens").alias("word"), *names).groupBy("word")
    counts = seen.agg(F.count("*").cast("double").alias("n"), *sums).where(F.col("n") >= LEAST_DOCUMENTS)
    scores = []
    for name in names:
        n, ones = total["n"], total[name] or 0.0
        top = F.pow(F.col(name) * n - F.col("n") * ones, 2) * n
        under = F.col("n") * (n - F.col("n")) * ones * (n - ones)
        scores.append(F.coalesce(top / F.nullif(under, F.lit(0.0)), F.lit(0.0)))
    best = counts.withColumn("chi2", F.greatest(F.lit(0.0), *scores)).where(F.col("chi2") >= LEAST_CHI2)
    return sorted(row["word"] for row in best.orderBy(F.desc("chi2"), "word").limit(MOST_WORDS).collect())


def fit(
    docs: DataFrame,
    labels: DataFrame,
    names: list[str],
    key: str = "doc_id",
    text: str = "text",
    sample_rows: int = SAMPLE_ROWS,
    folds: int = FOLDS,
) -> Chain:
    """Fit the chain. ``labels`` has a 0/1 column for every category in ``names``."""
    chosen = stage(sample(labels, names, key, sample_rows), "labelled")
    # at most sample_rows rows of an id and a few numbers: safe to broadcast
    rows = docs.select(key, text).join(F.broadcast(chosen), key)
    fold = F.pmod(F.xxhash64(key), F.lit(folds)).alias("fold")
    train = stage(rows.select(fold, tokens(F.col(text)).alias("tokens"), *names), "training")
    found = vocabulary(train, names)
    if not found:
        return Chain(list(names), None, [float(train.agg(F.avg(name)).first()[0] or 0.0) for name in names])
    counter = CountVectorizerModel.from_vocabulary(found, inputCol="tokens", outputCol="present")
    counter.setBinary(True)
    chain = Chain(list(names), counter, [])
    vectors = chain.vectors(train).drop("tokens")
    for number, name in enumerate(names):
        vectors = stage(vectors.coalesce(PARTS), f"vectors-{number}")
        chain.models.append(_fit_one(vectors, chain.names[:number], name))
        if number + 1 < len(names):
            held_out = None
            for one in range(folds):
                model = _fit_one(vectors.where(F.col("fold") != one), chain.names[:number], name)
                part = _with_probability(vectors.where(F.col("fold") == one), model, chain.names[:number], name)
                held_out = part if held_out is None else held_out.unionByName(part)
            vectors = held_out
    return chain
