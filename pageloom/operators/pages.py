"""Page records to page rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from pageloom.functions.binding import bind
from pageloom.functions.text import non_word_to_space

# Why a record is rejected.
PAGE_REASONS = ("cut page", "malformed page", "page without revision", "page without id")
PAGE_SCHEMA = "title string, ns int, id long, revision array<struct<id: long, text: string>>, damaged string"
REJECT_HEAD = 100


def parse_pages(pages: DataFrame, words_only: bool = False) -> DataFrame:
    """Parse ``page_xml``; the other columns stay.

    Adds ``page_id, title, ns, text, revision_id, revision_text, reason, head``.
    ``text`` joins the texts of all revisions, ``revision_*`` are those of the
    first. ``reason`` tells why a record is unusable and is null for good ones;
    use :func:`split_rejects`. ``words_only`` replaces non-word characters of
    ``text`` by spaces.
    """
    options = {"ignoreSurroundingSpaces": "false", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "damaged"}
    parsed = bind(pages.where("page_xml IS NOT NULL"), "page", F.from_xml("page_xml", PAGE_SCHEMA, options))
    texts = F.transform("page.revision", lambda r: F.coalesce(r["text"], F.lit("")))
    text = F.array_join(texts, "")
    reason = (
        F.when(F.startswith("page_xml", F.lit("<page>")) & ~F.endswith("page_xml", F.lit("</page>")), "cut page")
        .when(F.col("page").isNull() | F.col("page.damaged").isNotNull(), "malformed page")
        .when(F.col("page.revision").isNull(), "page without revision")
        .when(F.col("page.id").isNull(), "page without id")
    )
    rest = [c for c in pages.columns if c != "page_xml"]
    return parsed.select(
        *rest,
        F.col("page.id").alias("page_id"),
        F.coalesce("page.title", F.lit("")).alias("title"),
        F.col("page.ns").alias("ns"),
        (non_word_to_space(text) if words_only else text).alias("text"),
        F.get("page.revision", F.lit(0))["id"].alias("revision_id"),
        F.coalesce(F.get("page.revision", F.lit(0))["text"], F.lit("")).alias("revision_text"),
        reason.alias("reason"),
        F.when(reason.isNotNull(), F.left("page_xml", F.lit(REJECT_HEAD))).alias("head"),
    )


def split_rejects(parsed: DataFrame, source: str) -> tuple[DataFrame, DataFrame]:
    """Good rows, and rejects as ``source, reason, head``.

    Both read ``parsed``; stage it first when the parse should run once.
    """
    good = parsed.where("reason IS NULL").drop("reason", "head")
    rejects = parsed.where("reason IS NOT NULL").select(F.lit(source).alias("source"), "reason", "head")
    return good, rejects


def counted(parsed: DataFrame, observation: Observation, reasons: tuple[str, ...]) -> DataFrame:
    """``parsed`` as it is, counting on its way good records and rejected ones by reason: one pass gives rows and figures.

    ``observation.get`` has them once an action has run: ``good``, one figure by reason, and ``other`` for reasons that aren't listed.
    """
    number = lambda c: F.coalesce(F.count_if(c), F.lit(0))
    figures = [number(F.col("reason").isNull()).alias("good"), *[number(F.col("reason") == r).alias(r) for r in reasons]]
    return parsed.observe(observation, *figures, number(~F.col("reason").isin(*reasons)).alias("other"))


def filter_articles(pages: DataFrame) -> DataFrame:
    """Pages with text whose title is neither a disambiguation nor namespaced."""
    return pages.where(
        (F.col("text") != "") & ~F.contains("title", F.lit("disambiguation")) & ~F.contains("title", F.lit(":"))
    )
