"""The operators as stages of the corpus pipeline: (spark, docs, sf_dir) -> docs."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import functions as F

from keepwell.llm import line_dedup, minhash_groups, subword_quality, suffix_matches
from keepwell.llm.queries import QUALITY_THRESHOLD, bound_batches, encoding_digests, load, quality_model


def _bounded(stage):
    @wraps(stage)
    def run(spark, docs, sf_dir):
        bound_batches(spark)
        return stage(spark, docs, sf_dir)
    return run


@_bounded
def quality(spark, docs, sf_dir):
    """Documents the classifier rejects go. It learns from the labelled rows
    that are not held out, out of ``docs`` itself."""
    model = quality_model(docs, load(spark, sf_dir, "labels"))
    return subword_quality.keep_above(docs, model, QUALITY_THRESHOLD)


@_bounded
def lines(spark, docs, sf_dir):
    """Later lines go out of the texts, and ``n_chars`` follows. A document of
    which nothing is left, a copy, goes as a whole; so lines of one word count too."""
    cleaned = line_dedup.dedup_lines(docs, least_words=1, any_space=True, drop_emptied=True)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


@_bounded
def near_duplicates(spark, docs, sf_dir):
    """One document of each near-duplicate group stays: five-word shingles at a
    similarity of 0.8 or more."""
    return minhash_groups.keep_one(docs, size=5, percent=80, bands=40, rows=5)


@_bounded
def decontamination(spark, docs, sf_dir):
    """Documents that hold any benchmark window go."""
    return suffix_matches.decontaminate(docs, load(spark, sf_dir, "benchmark"))


@_bounded
def encoding(spark, docs, sf_dir):
    """Token counts and digests of ids and decoded texts; nothing is dropped."""
    return encoding_digests(docs)
