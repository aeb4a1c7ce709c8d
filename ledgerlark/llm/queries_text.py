"""Queries of the operators that read texts in Python workers."""

from __future__ import annotations

from ledgerlark.llm import context_tree, line_dedup, main_text, quality_classifier, quality_rules
from ledgerlark.llm.near_duplicates import report
from ledgerlark.llm.registry import query, read


@query("op4_quality_classifier")
def quality_classes(spark, folder):
    """A quality score for every document."""
    docs = read(spark, folder, "documents")
    return quality_classifier.classify(docs, quality_classifier.train(docs, read(spark, folder, "labels")))


@query("op6_context_tree")
def context_tree_scores(spark, folder):
    """Model and unigram score of every document."""
    return context_tree.score(read(spark, folder, "documents"))


@query("op7_main_text")
def main_texts(spark, folder):
    """The main text of every page."""
    pages = read(spark, folder, "pages")
    return main_text.extract(pages, main_text.train(pages))


@query("op8_line_dedup")
def line_duplicates(spark, folder):
    """The lines of every document that repeat, exactly or nearly, an earlier line of the corpus."""
    return line_dedup.report(read(spark, folder, "documents"))


@query("op9_quality_rules")
def rules(spark, folder):
    """Base counts and the verdict of the likelihood ratio for every document."""
    docs = read(spark, folder, "documents")
    return quality_rules.judge(docs, *quality_rules.train(docs, read(spark, folder, "labels")))


@query("op10_near_duplicates")
def near_duplicates(spark, folder):
    """The class of near-duplicates of every document."""
    return report(read(spark, folder, "documents"))
