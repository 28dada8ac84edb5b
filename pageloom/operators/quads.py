"""Pages to category statements."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pageloom.functions.iri import SUBJECT_PREDICATE, page_iri, page_name, resource_iri, underscored

QUAD_COLUMNS = ["language", "dataset", "subject", "predicate", "value", "context", "datatype"]
DATASET = "article_categories"
HEADING = r"^(={1,6})\s*(.+?)\s*\1\s*$"

# The category namespace of each language edition. Every edition
# also accepts the English name, and editions not listed here use it.
CATEGORY_NAMESPACES = {
    "da": "Kategori",
    "de": "Kategorie",
    "en": "Category",
    "es": "Categoría",
    "fi": "Luokka",
    "fr": "Catégorie",
    "hu": "Kategória",
    "it": "Categoria",
    "nl": "Categorie",
    "no": "Kategori",
    "pt": "Categoria",
    "ro": "Categorie",
    "ru": "Категория",
    "sv": "Kategori",
    "tr": "Kategori",
    "war": "Kaarangay",
}


def marked_lines(pages: DataFrame, namespaces: dict[str, str] | DataFrame | None = None) -> DataFrame:
    """Heading and category lines of each page's first revision, in place of its text.

    Needs ``lang, revision_text``. Lines are numbered from 1 and told apart inside
    the row, so a page never leaves its task; the only join is against the namespace table of a
    row per language. What is left of a page is small enough to stage. ``namespaces`` may be a table ``lang,
    namespace`` from the dumps' headers, which goes before the built-in names, or a dictionary, which takes their place.
    """
    named = isinstance(namespaces, DataFrame)
    listed = CATEGORY_NAMESPACES if named or namespaces is None else namespaces
    table = pages.sparkSession.createDataFrame(list(listed.items()), "lang string, namespace string")
    if named:
        found = namespaces.select("lang", "namespace")
        table = found.unionByName(table.join(found, "lang", "left_anti"))
    namespace = F.coalesce("namespace", F.lit("Category")) if named or namespaces is None else F.col("namespace")
    pattern = F.concat(F.lit(r"(?iu)\[\[\s*(?:Category|\Q"), namespace, F.lit(r"\E)\s*:\s*([^\]\[|#]+)"))
    numbered = F.transform(F.split("revision_text", "\n"), lambda line, i: F.struct((i + 1).alias("n"), line.alias("line")))
    rest = [c for c in pages.columns if c != "revision_text"]
    lines = pages.join(F.broadcast(table), "lang", "left").select(
        *rest, namespace.alias("namespace"), pattern.alias("link"), numbered.alias("lines")
    )
    return lines.select(
        *rest, "namespace", "link",
        F.filter("lines", lambda x: x["line"].startswith("=") & x["line"].rlike(HEADING)).alias("headings"),
        F.filter("lines", lambda x: x["line"].contains("[[") & F.regexp_like(x["line"], F.col("link"))).alias("links"),
    )


def category_quads(pages: DataFrame, namespaces: dict[str, str] | DataFrame | None = None) -> DataFrame:
    """One row per category link of an article's first revision.

    Needs ``lang, title, ns, revision_id, revision_text``. With a dictionary ``namespaces``,
    pages of other languages are skipped. The context counts lines from 1, overall
    and from the last heading. Links with a leading colon only mention a category.
    The plan has no shuffle.
    """
    needed = pages.select("lang", "title", "ns", "revision_id", "revision_text")
    return quads_of_lines(marked_lines(needed, namespaces))


def quads_of_lines(marked: DataFrame) -> DataFrame:
    """The rows of :func:`category_quads` from those of :func:`marked_lines`."""
    at = F.explode_outer("links").alias("at")
    marked = marked.where("coalesce(ns, 0) = 0 AND namespace IS NOT NULL").select(
        "lang", "title", "revision_id", "namespace", "link", "headings", at
    ).where("at IS NOT NULL")
    linked = marked.select(
        "lang", "title", "revision_id", "namespace", "at",
        F.try_element_at(F.filter("headings", lambda h: h["n"] <= F.col("at.n")), F.lit(-1)).alias("heading"),
        F.explode(F.regexp_extract_all(F.col("at.line"), F.col("link"), F.lit(1))).alias("category"),
    ).where(F.trim("category") != "")

    lang, name = F.col("lang"), page_name("title")
    section = underscored(F.regexp_extract("heading.line", HEADING, 2))
    place = F.when(
        F.col("heading").isNotNull(),
        F.format_string(
            "#section=%s&relative-line=%d&absolute-line=%d", section, F.col("at.n") - F.col("heading.n"), F.col("at.n")
        ),
    ).otherwise(F.format_string("#absolute-line=%d", F.col("at.n")))
    return linked.select(
        lang.alias("language"),
        F.lit(DATASET).alias("dataset"),
        resource_iri(lang, name).alias("subject"),
        F.lit(SUBJECT_PREDICATE).alias("predicate"),
        resource_iri(lang, F.concat("namespace", F.lit(":"), page_name("category"))).alias("value"),
        F.concat(page_iri(lang, name), F.format_string("?oldid=%d", F.col("revision_id")), place).alias("context"),
        F.lit(None).cast("string").alias("datatype"),
    )


def sort_quads(quads: DataFrame) -> DataFrame:
    """Total order over all seven columns, so one dominant language still splits into ranges.

    The range sort reads its input twice, first for a sample: stage it if it is costly.
    """
    return quads.orderBy(*[F.col(c).asc_nulls_first() for c in QUAD_COLUMNS])
