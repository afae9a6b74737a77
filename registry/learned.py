"""Registered queries of trained models; what they learn has no SQL form."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from newsloom.operators import inference, trained
from newsloom.session import shared_folder
from registry import inputs


def decisions(spark, sf_dir):
    """Every article judged by a model that learned from four fifths of the decided ones."""
    articles = inputs.articles(spark, sf_dir)
    path = f"{shared_folder(spark)}/relevance-{uuid.uuid4().hex}"
    trained.fit_relevance(articles.filter(~trained.held_out()), path)
    answers = inference.classify(articles, trained.trained_model(path), model_name="trained")
    return answers.select("link", trained.held_out().alias("held_out"), F.col("is_ai_relevant").alias("answer"))


LEARNED = {"A39_trained": decisions}
