"""The three end-to-end jobs, each callable or runnable with spark-submit.

    python -m pageloom.plans.jobs statements <dumps> <output>
    python -m pageloom.plans.jobs entities <lines> <output>
    python -m pageloom.plans.jobs concepts <dumps> <output> --stop-words <file> --concepts 100 --terms 50000
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from pageloom.operators import entities as ent
from pageloom.operators.lsa import Lsa, lsa, relevance_table
from pageloom.operators.pages import PAGE_REASONS, counted, filter_articles, parse_pages, split_rejects
from pageloom.operators.quads import marked_lines, quads_of_lines
from pageloom.functions.text import singular_english, tokenize
from pageloom.operators.terms import drop_stop_words, keep_documents, normalize_terms
from pageloom.sources.dumps import category_names, list_languages, read_pages
from pageloom.sources.entities import read_entities
from pageloom.sources.tables import Layout, write_tables
from pageloom.sources.words import read_words
from pageloom.staging import drop_staged, stage


def extract_statements(
    spark: SparkSession,
    dumps: str | list[str],
    output: str,
    namespaces: dict[str, str] | None = None,
    mode: str = "errorifexists",
    by_language: bool = False,
) -> dict[str, int]:
    """Page dumps to ``output/quads`` and ``output/rejects``; how many pages are good, and how many are rejected for each reason.

    Dumps are parsed once, and the pages are counted on the way; only headings and category lines are staged. Before that the category
    names are looked up in the dumps' headers, unless a dictionary gives them. ``by_language`` writes both tables in
    partitions of a language, the quads of each in ranges of their subjects; mode ``replace`` then replaces the languages of these dumps and leaves others alone.
    """
    if list_languages(spark, dumps).isEmpty():
        raise ValueError(f"no dump with a language in its name under {dumps}")
    columns = ["lang", "title", "ns", "revision_id", "revision_text", "reason", "head"]
    names = stage(category_names(spark, dumps), "names") if namespaces is None else None
    marked = None
    try:
        pages = parse_pages(read_pages(spark, dumps)).select(columns)
        found = Observation()
        marked = stage(marked_lines(counted(pages, found, PAGE_REASONS), namespaces if names is None else names), "lines")
        good, rejects = split_rejects(marked, "pages")
        layouts = {"quads": Layout(("language",), ("subject", "value")), "rejects": Layout(("language",))} if by_language else {}
        if by_language:
            rejects = marked.where("reason IS NOT NULL").select(F.col("lang").alias("language"), F.lit("pages").alias("source"), "reason", "head")
        write_tables({"quads": quads_of_lines(good), "rejects": rejects}, output, mode, layouts)
        return found.get
    finally:
        for table in (names, marked):
            if table is not None:
                drop_staged(table)


def entity_tables(parsed: DataFrame, strict: bool = False) -> dict[str, DataFrame]:
    good, rejects = ent.split_rejects(parsed, "entities")
    return {
        "labels": ent.entity_labels(good, strict),
        "sitelinks": ent.entity_sitelinks(good, strict),
        "claims": ent.entity_claims(good, strict),
        "rejects": rejects.unionByName(ent.label_rejects(good)).unionByName(ent.sitelink_rejects(good))
        .unionByName(ent.claim_rejects(good)).unionByName(ent.member_rejects(good)),
    }


def extract_entities(
    spark: SparkSession, lines: str | list[str], output: str, strict: bool = False, mode: str = "errorifexists"
) -> dict[str, int]:
    """Entity lines to ``labels``, ``sitelinks``, ``claims`` and ``rejects`` under ``output``; how many lines are good, and how many are rejected for each reason.

    The parsed lines are staged as columns, and counted on the way: the input is read and parsed once, and
    each table then reads only the columns it needs.
    """
    found = Observation()
    parsed = stage(counted(ent.parse_entities(read_entities(spark, lines)), found, ent.ENTITY_REASONS), "entities")
    try:
        write_tables(entity_tables(parsed, strict), output, mode)
        return found.get
    finally:
        drop_staged(parsed)


def article_tokens(spark: SparkSession, dumps: str | list[str], lang: str | None = None, token_mode: str = "ascii") -> DataFrame:
    """Pages of one language as ``doc_id, title, lang, terms, reason, head``: the tokens of articles, and why a record is rejected."""
    languages = [r["lang"] for r in list_languages(spark, dumps).limit(2).collect()] if lang is None else [lang]
    if len(languages) != 1:
        raise ValueError(f"exactly one language is expected, pass lang= to pick one; found {languages}")
    pages = parse_pages(read_pages(spark, dumps, languages[0])).select(F.col("page_id").alias("doc_id"), "title", "lang", "text", "reason", "head")
    rejected = pages.where("reason IS NOT NULL").withColumn("text", F.lit(None).cast("string"))
    both = filter_articles(pages.where("reason IS NULL")).unionByName(rejected)
    return both.withColumn("terms", tokenize("text", token_mode)).drop("text")


def article_terms(
    tokens: DataFrame,
    stop_words: list[str] | DataFrame | None = None,
    lemmas: DataFrame | None = None,
    lemma_rows: int | None = None,
    singular: bool = False,
    stop_first: bool = False,
) -> DataFrame:
    """Articles as ``doc_id, title, terms`` from the good rows of :func:`article_tokens`."""
    docs = tokens.where("reason IS NULL").drop("reason", "head")
    listed = isinstance(stop_words, DataFrame) or bool(stop_words)
    if listed and stop_first:
        docs = drop_stop_words(docs, stop_words)
    if lemmas is not None:
        docs = normalize_terms(docs, lemmas, lemma_rows)
    if singular:
        docs = docs.withColumn("terms", singular_english("terms"))
    if listed and not stop_first:
        docs = drop_stop_words(docs, stop_words)
    return keep_documents(docs.drop("lang"))


def analyse_concepts(
    spark: SparkSession,
    dumps: str | list[str],
    output: str,
    stop_words: str | list[str] | DataFrame | None = None,
    n_concepts: int = 100,
    n_terms: int = 50_000,
    neighbors: int | None = 20,
    lang: str | None = None,
    mode: str = "errorifexists",
    token_mode: str = "ascii",
    digits: int | None = None,
    **options,
) -> Lsa:
    """Page dumps of one language to one relevance table at ``output``, and rejected records at ``<output>_rejects``.

    ``stop_words`` is a file, a table ``term`` or a list, each of any size but a list. Articles are staged as tokens, so dumps are
    parsed once for the vocabulary, the matrix and the rejects. ``digits`` rounds scores before they are ranked; else whole scores are.
    """
    if isinstance(stop_words, str):
        stop_words = read_words(spark, stop_words)
    tokens = stage(article_tokens(spark, dumps, lang, token_mode), "tokens")
    docs = None
    try:
        write_tables({"": split_rejects(tokens, "pages")[1]}, f"{output.rstrip('/')}_rejects", mode)
        docs = stage(article_terms(tokens, stop_words, **options), "terms")
        model = lsa(docs, n_concepts, n_terms, keep=("title",))
        write_tables({"": relevance_table(model, neighbors, doc_key="title", digits=digits)}, output, mode)
        return model
    finally:
        for table in (tokens, docs):
            if table is not None:
                drop_staged(table)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="pageloom")
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("statements", "entities", "concepts"):
        job = jobs.add_parser(name)
        job.add_argument("input")
        job.add_argument("output")
        job.add_argument("--mode", default="errorifexists", help="also replace, for statements by language")
        if name == "statements":
            job.add_argument("--by-language", action="store_true", help="partitions of a language")
        if name == "entities":
            job.add_argument("--strict", action="store_true")
        if name == "concepts":
            job.add_argument("--stop-words")
            job.add_argument("--concepts", type=int, default=100)
            job.add_argument("--terms", type=int, default=50_000)
            job.add_argument("--neighbors", type=int, default=20, help="per term; 0 for all pairs")
            job.add_argument("--lang")
            job.add_argument("--token-mode", choices=("ascii", "unicode"), default="ascii")
            job.add_argument("--singular", action="store_true", help="the light English plural rule")
            job.add_argument("--stop-first", action="store_true", help="drop stop words before terms are normalised")
            job.add_argument("--lemmas", help="tab-separated file of language, term and lemma")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"pageloom {args.job}").getOrCreate()
    if args.job == "statements":
        print(extract_statements(spark, args.input, args.output, mode=args.mode, by_language=args.by_language))
    elif args.job == "entities":
        print(extract_entities(spark, args.input, args.output, args.strict, args.mode))
    else:
        lemmas = spark.read.csv(args.lemmas, sep="\t", schema="lang string, term string, lemma string") if args.lemmas else None
        analyse_concepts(
            spark, args.input, args.output, args.stop_words, args.concepts, args.terms, args.neighbors or None, args.lang, args.mode,
            args.token_mode, lemmas=lemmas, singular=args.singular, stop_first=args.stop_first,
        )


if __name__ == "__main__":
    main()
