"""A relevance model trained on decided articles.

Words of title and text become hashed term frequencies, weighted by how rare they are,
and a logistic regression learns the decisions. The fitted pipeline is written to the
shared folder and read back as an inference ``Model``, so a run applies what was stored
and a replay gives the same answers. Nothing but the coefficients, whose number is
``SLOTS``, passes through the driver.

Articles without a decision are not learned from. An empty article has no words and gets
the answer of the intercept. Decisions of one kind only give a model that always repeats
it; without any decision there is nothing to learn, which is an error.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.operators.inference import Model

SLOTS = 1 << 16
ITERATIONS, PENALTY = 30, 0.01
#: An article in this many is held out of training when a model is judged.
FOLDS = 5


def stages() -> Pipeline:
    # Learning stops after a fixed number of steps, so equal tables give equal models.
    words = RegexTokenizer(inputCol="learned_text", outputCol="learned_words", pattern=r"[\p{L}\p{N}]+", gaps=False)
    counts = HashingTF(inputCol="learned_words", outputCol="learned_counts", numFeatures=SLOTS)
    weighted = IDF(inputCol="learned_counts", outputCol="learned_weights", minDocFreq=2)
    decide = LogisticRegression(
        featuresCol="learned_weights", labelCol="learned_label", rawPredictionCol="learned_raw",
        probabilityCol="learned_share", predictionCol="learned_answer", maxIter=ITERATIONS, regParam=PENALTY)
    return Pipeline(stages=[words, counts, weighted, decide])


def fit_relevance(articles: DataFrame, path: str) -> str:
    """Learns ``is_ai_relevant`` from title and text, writes the model to ``path`` and returns it."""
    decided = articles.filter("is_ai_relevant IS NOT NULL").select(
        F.concat_ws(" ", "title", "original_summary").alias("learned_text"),
        F.col("is_ai_relevant").cast("double").alias("learned_label"))
    if decided.isEmpty():
        raise ValueError("no article has a decision to learn from")
    stages().fit(decided).write().overwrite().save(path)
    return path


def trained_model(path: str, least: float = 0.5) -> Model:
    """The model at ``path``: "Yes." when the share it gives an article is at least ``least``."""

    def run(requests: DataFrame) -> DataFrame:
        fitted = PipelineModel.load(path)
        texts = requests.withColumn("learned_text", F.concat_ws(" ", "title", "text"))
        share = F.element_at(vector_to_array("learned_share"), 2)
        judged = fitted.transform(texts).withColumn("content", F.when(share >= least, "Yes.").otherwise("no"))
        return judged.withColumn("error", F.lit(None).cast("string")).select(*requests.columns, "content", "error")

    return run


def held_out(link: str = "link", folds: int = FOLDS):
    """Whether an article, by the hash of its link, stays out of training."""
    return F.pmod(F.crc32(F.encode(F.col(link), "UTF-8")), F.lit(folds)) == 0


def quality(decided: DataFrame) -> DataFrame:
    """(articles, right, relevant, named, both): how decisions ``answer`` meet the known ``is_ai_relevant``."""
    known, answer = F.col("is_ai_relevant"), F.col("answer")
    return decided.filter(known.isNotNull()).agg(
        F.count(F.lit(1)).alias("articles"), F.count_if(known == answer).alias("right"), F.count_if(known).alias("relevant"),
        F.count_if(answer).alias("named"), F.count_if(known & answer).alias("both"))
