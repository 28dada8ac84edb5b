
from __future__ import annotations

import importlib
import importlib.util
from collections.abc import Callable
from types import ModuleType

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pageloom.operators import entities as ent
from pageloom.operators import factors, pages as pg, terms as tm
from pageloom.operators.lsa import Lsa, concept_strength, lsa, relevance_table, term_neighbors, top_docs, top_terms
from pageloom.operators.quads import category_quads, sort_quads
from pageloom.operators.sampling import poisson_steps, resample_by_key
from pageloom.plans import jobs
from pageloom.sources.dumps import list_languages, read_pages
from pageloom.sources.entities import entity_lines
from pageloom.sources.tables import Layout, read_table, write_table
from pageloom.sources.words import read_words
from pageloom.functions.text import tokenize
from pageloom.staging import stage, stage_path

Query = Callable[[SparkSession, str], DataFrame]

STOP_WORDS = ["the", "and", "that", "der", "die", "und", "que", "los", "les", "des"]
VOCABULARY = 500
SMALL_VOCABULARY = 40
CONCEPTS = 5
RESAMPLE_MEAN, RESAMPLE_SEED = 4.0, 7
# Scores are compared with those of SQL to so many digits; the library ranks and gives them whole.
DIGITS = 6


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf}/{name}.parquet")


def _terms(spark: SparkSession, sf: str, **options) -> DataFrame:
    return tm.tokenize_documents(_table(spark, sf, "documents").select("doc_id", "lang", "text"), **options)


def _joined(terms: Column | str = "terms") -> Column:
    return F.array_join(terms, " ").alias("terms")


def _long(*columns: str) -> list[Column]:
    return [F.col(c).cast("long").alias(c) for c in columns]


# --- terms and frequencies -------------------------------------------------


def tokens(spark, sf):
    return _table(spark, sf, "documents").select("doc_id", _joined(tokenize("text")))


def tokens_unicode(spark, sf):
    return _table(spark, sf, "documents").select("doc_id", _joined(tokenize("text", "unicode")))


def tokens_singular(spark, sf):
    return _terms(spark, sf, singular=True).select("doc_id", _joined())


def term_counts(spark, sf):
    return tm.term_counts(_terms(spark, sf)).select("doc_id", *_long("n_terms"), "term", *_long("tf"))


def document_lengths(spark, sf):
    return tm.document_lengths(_terms(spark, sf)).select("doc_id", *_long("n_terms"))


def corpus_size(spark, sf):
    return tm.corpus_size(_terms(spark, sf))


def document_frequency(spark, sf):
    return tm.document_frequency(_terms(spark, sf))


def rarest_terms(spark, sf):
    return tm.document_frequency(_terms(spark, sf), VOCABULARY, order="rarest")


def vocabulary(spark, sf):
    return tm.vocabulary(_terms(spark, sf), VOCABULARY).select("term", *_long("idx"), "df", F.round("idf", 9).alias("idf"))


def tfidf(spark, sf):
    docs = _terms(spark, sf)
    return tm.tfidf(docs, tm.vocabulary(docs, None)).select("doc_id", *_long("idx"), F.round("w", 9).alias("w"))


def tfidf_capped(spark, sf):
    docs = _terms(spark, sf)
    vocab = tm.vocabulary(docs, VOCABULARY)
    return tm.tfidf(docs, vocab, VOCABULARY).select("doc_id", *_long("idx"), F.round("w", 9).alias("w"))


def document_vectors(spark, sf):
    docs = _terms(spark, sf)
    vocab = tm.vocabulary(docs, VOCABULARY).orderBy("idx").toPandas()
    vectors = tm.document_vectors(docs, vocab["term"].tolist(), vocab["idf"].tolist())
    from pyspark.ml.functions import vector_to_array

    entries = vectors.select("doc_id", F.posexplode(vector_to_array("w")).alias("idx", "w")).where("w <> 0")
    return entries.select("doc_id", *_long("idx"), F.round("w", 9).alias("w"))


def stop_words(spark, sf):
    return _terms(spark, sf, stop_words=STOP_WORDS).select("doc_id", _joined())


def stop_words_before_rule(spark, sf):
    return _terms(spark, sf, stop_words=STOP_WORDS, singular=True, stop_first=True).select("doc_id", _joined())


def stop_word_table(spark, sf):
    listed = _table(spark, sf, "benchmark").select(F.explode(tokenize("text")).alias("term"))
    return tm.drop_stop_terms(tm.term_counts(_terms(spark, sf)), listed).select("doc_id", "term", *_long("tf"))


def stop_words_shuffled(spark, sf):
    """Documents without the words of the benchmark, by the way that a table of any size takes."""
    listed = _table(spark, sf, "benchmark").select(F.explode(tokenize("text")).alias("term"))
    return tm.drop_stop_words(_terms(spark, sf), listed, tm.BROADCAST_ROWS + 1).select("doc_id", _joined())


def normalized_terms(spark, sf, lemma_rows=None):
    docs = _terms(spark, sf)
    long = docs.select("lang", F.explode("terms").alias("term")).where(F.length("term") > 7).distinct()
    lemmas = stage(long.withColumn("lemma", F.left("term", F.lit(4))), "lemmas")
    mapped = tm.normalize_terms(docs, lemmas, lemma_rows)
    return tm.term_counts(mapped).select("doc_id", *_long("n_terms"), "term", *_long("tf"))


def normalized_terms_shuffled(spark, sf):
    """The same by the way that a lemma table of any size takes."""
    return normalized_terms(spark, sf, tm.BROADCAST_ROWS + 1)


def union_all(spark, sf):
    docs = _table(spark, sf, "documents").select(F.lit("documents").alias("origin"), F.col("doc_id").alias("id"), "text")
    turns = _table(spark, sf, "conversations").select(F.lit("conversations").alias("origin"), F.col("conv_id").alias("id"), "text")
    both = docs.unionByName(turns)
    return both.select("origin", "id", F.size(tokenize("text")).cast("long").alias("n_terms"))


# --- pages and statements --------------------------------------------------


def _wikitext() -> Column:
    return F.concat(
        F.lit("= "), "lang", F.lit(" =\n"), "text",
        F.lit("\n== Source "), "source", F.lit(" ==\nSee [[Category:Source "), "source",
        F.lit("]] and [[Category:length_"), (F.col("n_chars") % 13).cast("string"), F.lit("|k]]\n[[:Category:skip]]\n[[category: "),
        "lang", F.lit("]]"),
    )


def _escaped(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def _page_records(spark: SparkSession, sf: str, text: Column | str = "text", second: Column | None = None) -> DataFrame:
    """``<page>`` records of the documents: ``lang, page_xml``."""
    revisions = [F.format_string("<revision><id>%d</id><text xml:space=\"preserve\">%s</text></revision>", F.col("doc_id") + 1000, _escaped(F.col(text) if isinstance(text, str) else text))]
    if second is not None:
        revisions.append(F.format_string("<revision><id>%d</id><text>%s</text></revision>", F.col("doc_id") + 2000, _escaped(second)))
    page = F.concat(
        F.format_string("  <page>\n    <title>Doc %d (%s)</title>\n    <ns>0</ns>\n    <id>%d</id>\n    ", "doc_id", "source", "doc_id"),
        *revisions, F.lit("\n  </page>"),
    )
    return _table(spark, sf, "documents").select("lang", page.alias("page_xml"))


def _written_dumps(spark: SparkSession, sf: str, text: Column | str = "text") -> str:
    """The documents as page dumps in the shared folder, one folder per language; the path."""
    path = stage_path(spark, "dumps")
    records = _page_records(spark, sf, text).select(F.concat("lang", F.lit("wiki")).alias("wiki"), "page_xml")
    records.write.partitionBy("wiki").text(path)
    return path


def _good_pages(pages: DataFrame, **options) -> DataFrame:
    return pg.split_rejects(pg.parse_pages(pages, **options), "pages")[0]


def page_round_trip(spark, sf):
    return _good_pages(read_pages(spark, _written_dumps(spark, sf))).select("page_id", "lang", "title", "text")


def dump_languages(spark, sf):
    return list_languages(spark, _written_dumps(spark, sf))


def page_words(spark, sf):
    records = _page_records(spark, sf, second=F.col("source"))
    return _good_pages(records, words_only=True).select("page_id", "title", "text")


def filter_articles(spark, sf):
    title = F.regexp_extract("html", "(?s)<title>(.*?)</title>", 1)
    marked = (
        F.when(F.col("page_id") % 5 == 0, F.concat(title, F.lit(" (disambiguation)")))
        .when(F.col("page_id") % 7 == 0, F.concat(F.lit("Talk:"), title))
        .otherwise(title)
    )
    text = F.when(F.col("page_id") % 11 == 0, "").otherwise(F.col("html"))
    return pg.filter_articles(_table(spark, sf, "pages").select("page_id", marked.alias("title"), text.alias("text")))


def statements(spark, sf):
    quads = category_quads(_good_pages(_page_records(spark, sf, _wikitext())))
    return sort_quads(stage(quads, "quads"))


def statements_job(spark, sf):
    output = stage_path(spark, "statements")
    jobs.extract_statements(spark, _written_dumps(spark, sf, _wikitext()), output)
    return spark.read.parquet(f"{output}/quads")


NAMES = ["pl Kategoria", "uk Категорія", "cs Kategorie", "ja カテゴリ", "el Κατηγορία", "eu Kategoria", "ca Categoria"]


def statements_namespaces(spark, sf):
    """Dumps of seven further languages, whose category names stand only in their headers."""
    dumps, output = stage_path(spark, "dumps"), stage_path(spark, "statements")
    listed = F.array(*[F.lit(n) for n in NAMES])
    named = F.split(F.get(listed, (F.col("doc_id") % len(NAMES)).cast("int")), " ")
    docs = _table(spark, sf, "documents").withColumn("name", named)
    lang, name = F.get("name", F.lit(0)), F.get("name", F.lit(1))
    page = F.format_string("<page><title>Doc %d</title><ns>0</ns><id>%d</id><revision><id>%d</id><text>[[%s:Source %s]]</text></revision></page>", "doc_id", "doc_id", "doc_id", name, "source")
    head = F.format_string('<mediawiki><siteinfo><namespaces><namespace key="0"/><namespace key="14" case="first-letter">%s</namespace></namespaces></siteinfo>', name)
    wiki = F.concat(lang, F.lit("wiki")).alias("wiki")
    docs.select(wiki, page).write.partitionBy("wiki").text(dumps)
    docs.select(wiki, head).distinct().write.mode("append").partitionBy("wiki").text(dumps)  # a row per language
    jobs.extract_statements(spark, dumps, output)
    return spark.read.parquet(f"{output}/quads").select("language", "subject", "value")


def statements_one_language_again(spark, sf):
    """The statements job by language, run again for the German dumps alone, whose pages have another category then."""
    output, again = stage_path(spark, "statements"), stage_path(spark, "again")
    jobs.extract_statements(spark, _written_dumps(spark, sf, _wikitext()), output, by_language=True)
    text = F.concat(F.lit("[[Kategorie:Neu "), "source", F.lit("]]"))
    records = _page_records(spark, sf, text).where("lang = 'de'").select(F.lit("dewiki").alias("wiki"), "page_xml")
    records.write.partitionBy("wiki").text(again)
    jobs.extract_statements(spark, again, output, mode="replace", by_language=True)
    return spark.read.parquet(f"{output}/quads").select("language", "subject", "value")


def job_counts(spark, sf):
    """What the jobs report of good and rejected records, counted in the pass that writes their tables."""
    dumps, lines = stage_path(spark, "dumps"), stage_path(spark, "lines")
    records = _page_records(spark, sf)
    number = F.regexp_extract("page_xml", r"<id>(\d+)</id>", 1).cast("long") % 4
    bare = F.concat(F.regexp_extract("page_xml", r"(?s)^(.*?)<revision>", 1), F.lit("</page>"))
    cut = F.concat(F.expr("left(page_xml, length(page_xml) - 30)"), F.lit("</page>"))
    damaged = records.select(F.concat("lang", F.lit("wiki")).alias("wiki"), F.when(number == 1, cut).when(number == 2, bare).otherwise(F.col("page_xml")))
    damaged.write.partitionBy("wiki").text(dumps)
    _damaged_entities(spark, sf).write.text(lines)
    pages = jobs.extract_statements(spark, dumps, stage_path(spark, "statements"))
    entities = jobs.extract_entities(spark, lines, stage_path(spark, "entities"))
    rows = [(job, name, n) for job, figures in (("statements", pages), ("entities", entities)) for name, n in figures.items() if n]
    return spark.createDataFrame(rows, "job string, name string, records long")


def cut_dump_rejects(spark, sf):
    """A dump for each source in bz2, in several files, cut off after the first revision of its last page."""
    dumps = stage_path(spark, "dumps")
    page = F.format_string("<page><title>Doc %d</title><ns>0</ns><id>%d</id><revision><id>1</id><text>x</text></revision>", "doc_id", "doc_id")
    docs = _table(spark, sf, "documents").select("doc_id", page.alias("page"), F.concat("source", F.lit("-enwiki")).alias("wiki"))
    last = docs.groupBy("wiki").agg(F.max_by("page", "doc_id").alias("page"), F.max("doc_id").alias("doc_id"))
    whole = docs.join(last, "doc_id", "left_anti").select(F.concat("page", F.lit("</page>")), "wiki")
    cut = last.select(F.concat("page", F.lit("<revision><id>2</id>")), "wiki")
    whole.write.partitionBy("wiki").option("compression", "bzip2").text(dumps)
    cut.write.mode("append").partitionBy("wiki").option("compression", "bzip2").text(dumps)  # a row per source, in a file of its own
    parsed = pg.parse_pages(read_pages(spark, dumps))
    good, rejects = pg.split_rejects(parsed, "pages")
    return good.agg(F.count("*").alias("good")).crossJoin(rejects.groupBy("reason").agg(F.count("*").alias("rejected")))


def page_rejects(spark, sf):
    """Every record with doc_id 1 mod 4 is cut, 2 mod 4 has lost its revision."""
    records = _page_records(spark, sf)
    cut = F.concat(F.expr("left(page_xml, length(page_xml) - 30)"), F.lit("</page>"))
    bare = F.concat(F.regexp_extract("page_xml", r"(?s)^(.*?)<revision>", 1), F.lit("</page>"))
    number = F.regexp_extract("page_xml", r"<id>(\d+)</id>", 1).cast("long") % 4
    damaged = records.select("lang", F.when(number == 1, cut).when(number == 2, bare).otherwise(F.col("page_xml")).alias("page_xml"))
    return pg.split_rejects(pg.parse_pages(damaged), "pages")[1]


# --- entities --------------------------------------------------------------


def _document_entities(spark: SparkSession, sf: str) -> DataFrame:
    text_of = lambda lang, value: F.struct(lang.alias("language"), value.alias("value"))
    lang, title = F.col("lang"), F.format_string("Doc %d", "doc_id")
    site = F.concat(lang, F.lit("wiki"))
    entity = F.struct(
        F.format_string("Q%d", "doc_id").alias("id"),
        F.lit("item").alias("type"),
        F.create_map(lang, text_of(lang, title), F.lit("mul"), text_of(F.lit("mul"), F.col("source"))).alias("labels"),
        F.when(F.col("doc_id") % 3 != 0, F.create_map(lang, text_of(lang, F.col("text")), F.lit("zz"), text_of(F.lit("zz"), title))).alias("descriptions"),
        F.create_map(
            site,
            F.struct(site.alias("site"), title.alias("title"), F.format_string("https://%s.example.org/wiki/Doc_%d", lang, "doc_id").alias("url")),
        ).alias("sitelinks"),
    )
    return _table(spark, sf, "documents").select(F.concat(F.to_json(entity), F.lit(",")).alias("value"))


def _event_entities(spark: SparkSession, sf: str) -> DataFrame:
    snak = '{"mainsnak":{"snaktype":"value","property":"%s","datatype":"%s","datavalue":{"type":"%s","value":%s}}}'
    kind = F.col("event_type")
    value = lambda data, kind_of, body: F.format_string(snak, kind, F.lit(data), F.lit(kind_of), body)
    snaks = F.concat_ws(
        ",",
        value("string", "string", F.format_string('"%s"', kind)),
        value("wikibase-item", "wikibase-entityid", F.format_string('{"entity-type":"item","id":"U%d"}', "user_id")),
        value("other", "other", F.col("props")),
        F.when(F.col("event_id") % 3 == 0, F.format_string('{"mainsnak":{"snaktype":"novalue","property":"%s","datatype":"string"}}', kind)),
    )
    line = F.format_string('{"id":"E%d","type":"item","labels":[],"claims":{"%s":[%s]}}', "event_id", kind, snaks)
    return _table(spark, sf, "events").select(line.alias("value"))


def _parsed(lines: DataFrame) -> DataFrame:
    return pg.split_rejects(ent.parse_entities(entity_lines(lines)), "entities")[0]


def entity_labels(spark, sf):
    return ent.entity_labels(_parsed(_document_entities(spark, sf)))


def entity_labels_strict(spark, sf):
    return ent.entity_labels(_parsed(_document_entities(spark, sf)), strict=True)


def entity_sitelinks(spark, sf):
    return ent.entity_sitelinks(_parsed(_document_entities(spark, sf)))


def entity_claims(spark, sf):
    return ent.entity_claims(_parsed(_event_entities(spark, sf)))


def entity_claims_strict(spark, sf):
    return ent.entity_claims(_parsed(_event_entities(spark, sf)), strict=True)


def claim_rejects(spark, sf):
    return ent.claim_rejects(_parsed(_event_entities(spark, sf)))


def _damaged_entities(spark: SparkSession, sf: str) -> DataFrame:
    line = F.format_string('{"id":"Q%d","type":"item","labels":{"%s":{"language":"%s","value":"%s"}}}', "doc_id", "lang", "lang", "source")
    number = F.col("doc_id") % 10
    damaged = (
        F.when(number == 3, F.expr("left(line, length(line) - 5)"))
        .when(number == 4, F.concat(F.lit("junk "), "text"))
        .when(number == 5, "[")
        .when(number == 6, F.replace("line", F.lit('"type":"item",'), F.lit("")))
        .when(number == 7, F.replace("line", F.lit('"id":'), F.lit('"no":')))
        .otherwise(F.col("line"))
    )
    return _table(spark, sf, "documents").withColumn("line", line).select(damaged.alias("value"))


def entity_rejects(spark, sf):
    return pg.split_rejects(ent.parse_entities(entity_lines(_damaged_entities(spark, sf))), "entities")[1]


def _mixed_entities(spark: SparkSession, sf: str) -> DataFrame:
    """Good, null and mistyped members side by side, and a value that holds an empty array."""
    good = '{"mainsnak":{"snaktype":"value","property":"P1","datatype":"other","datavalue":{"type":"other","value":{"labels":[],"n":%d}}}}'
    line = F.format_string(
        '{"id":"Q%d","type":"item","labels":{"en":{"language":"en","value":"%s"},"fr":"bad","de":null,"es":{"language":"es"}},'
        '"sitelinks":{"enwiki":{"site":"enwiki","title":"T %d","url":"u"},"frwiki":{"site":"frwiki"},"dewiki":7},'
        f'"claims":{{"P1":[{good},5],"P2":null,"P3":"junk"}}}}',
        "doc_id", "source", "doc_id", "doc_id",
    )
    return _table(spark, sf, "documents").select(line.alias("value"))


def entity_mixed_members(spark, sf):
    """Claims and labels that stay beside mistyped ones."""
    parsed = _parsed(_mixed_entities(spark, sf))
    claims = ent.entity_claims(parsed).select("entity_id", F.col("property_id").alias("name"), "value")
    return claims.unionByName(ent.entity_labels(parsed).select("entity_id", F.col("language").alias("name"), F.col("label").alias("value")))


def label_rejects(spark, sf):
    parsed = _parsed(_mixed_entities(spark, sf))
    return ent.label_rejects(parsed).unionByName(ent.member_rejects(parsed).where("source = 'labels'"))


def sitelink_rejects(spark, sf):
    parsed = _parsed(_mixed_entities(spark, sf))
    return ent.sitelink_rejects(parsed).unionByName(ent.member_rejects(parsed).where("source = 'sitelinks'"))


def member_rejects(spark, sf):
    return ent.member_rejects(_parsed(_mixed_entities(spark, sf))).where("source = 'claims'")


def entities_job(spark, sf):
    """The job's claim table, from written lines."""
    lines, output = stage_path(spark, "lines"), stage_path(spark, "entities")
    _event_entities(spark, sf).write.text(lines)
    jobs.extract_entities(spark, lines, output)
    return spark.read.parquet(f"{output}/claims")


# --- row matrices and concepts ---------------------------------------------


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    return _table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"))


def _entries(rows: DataFrame) -> DataFrame:
    return factors.entries(rows).select("id", *_long("concept"), F.round("score", 6).alias("score"))


def scale_rows(spark, sf):
    return _entries(factors.scale_rows(_vectors(spark, sf), [float(i) for i in range(1, 65)]))


def normalize_rows(spark, sf):
    return _entries(factors.normalize_rows(_vectors(spark, sf)))


def matrix_row(spark, sf):
    return _entries(factors.row_of(_vectors(spark, sf), 42))


def top_entries(spark, sf):
    best = factors.top_entries(_vectors(spark, sf), 10, digits=6)
    return best.select(*_long("concept", "rank"), "id", "score")


def _staged_terms(spark: SparkSession, sf: str) -> DataFrame:
    return stage(_terms(spark, sf).drop("lang"), "terms")


def _full_rank(spark: SparkSession, sf: str, **options) -> Lsa:
    """As many concepts as terms, so that the factors give back the matrix."""
    return lsa(_staged_terms(spark, sf), SMALL_VOCABULARY, SMALL_VOCABULARY, **options)


def _energy(rows: DataFrame, sigma: list[float]) -> DataFrame:
    scaled = factors.scale_rows(rows, sigma)
    return scaled.select("id", F.round(factors.squared_length("vec"), 9).alias("energy"))


def lsa_doc_energy(spark, sf):
    model = _full_rank(spark, sf)
    return _energy(model.docs, model.sigma)


def lsa_term_energy(spark, sf):
    model = _full_rank(spark, sf)
    return _energy(model.terms, model.sigma)


def lsa_doc_energy_iterative(spark, sf):
    model = _full_rank(spark, sf)
    return _energy(model.docs, model.sigma)


def lsa_term_neighbors(spark, sf):
    return term_neighbors(_full_rank(spark, sf), 10, DIGITS).select("id", "other", F.round("score", 6).alias("score"))


def lsa_term_neighbors_all(spark, sf):
    """Neighbours over the whole vocabulary, without a cap."""
    model = lsa(_staged_terms(spark, sf), CONCEPTS, None)
    return term_neighbors(model, 10, DIGITS).select("id", "other", F.round("score", 6).alias("score"))


def lsa_term_pairs(spark, sf):
    return term_neighbors(_full_rank(spark, sf), None, DIGITS).select("id", "other", F.round("score", 6).alias("score"))


def _concepts(spark: SparkSession, sf: str) -> Lsa:
    return lsa(_staged_terms(spark, sf), CONCEPTS, VOCABULARY)


def lsa_concept_strength(spark, sf):
    return concept_strength(_concepts(spark, sf)).select("concept", F.round("sigma", 6).alias("sigma"))


def lsa_top_terms(spark, sf):
    return top_terms(_concepts(spark, sf), 10, digits=DIGITS)


def lsa_top_docs(spark, sf):
    return top_docs(_concepts(spark, sf), 10, digits=DIGITS)


def lsa_relevances(spark, sf):
    return relevance_table(_concepts(spark, sf), digits=DIGITS, block_rows=200)


def lsa_invariants(spark, sf):
    """2,000 terms, 10 concepts: whether A'A v = sigma² v and v'v = 1 hold for each."""
    docs = _staged_terms(spark, sf)
    model = lsa(docs, 10, 2000)
    projected = factors.scale_rows(model.docs.select("id", "vec"), model.sigma).withColumnRenamed("id", "doc_id")
    weights = tm.tfidf(docs, tm.vocabulary(docs, 2000)).join(projected, "doc_id")
    back = weights.select("idx", F.posexplode("vec").alias("concept", "x"), "w").groupBy("idx", "concept").agg(F.sum(F.col("w") * F.col("x")).alias("got"))
    squared = F.element_at(F.array(*[F.lit(s * s) for s in model.sigma]), F.col("concept") + 1)
    own = model.terms.select("idx", F.posexplode("vec").alias("concept", "v"))
    error = F.sqrt(F.sum(F.pow(F.coalesce("got", F.lit(0.0)) - squared * F.col("v"), 2)))
    checked = own.join(back, ["idx", "concept"], "left").groupBy("concept").agg((error <= 1e-6 * F.max(squared)).alias("solved"), (F.abs(F.sum(F.col("v") * F.col("v")) - 1) < 1e-9).alias("unit"))
    return checked.select(*_long("concept"), "solved", "unit")


def concepts_job_rejects(spark, sf):
    """Records that the job's tables leave out: every page of this dump has lost its id or its end."""
    dumps, output = stage_path(spark, "dumps"), stage_path(spark, "relevances")
    page = F.format_string("<page><title>Doc %d</title><id>%d</id><revision><id>1</id><text>%s music song guitar</text></revision>", "doc_id", "doc_id", "source")
    broken = F.when(F.col("doc_id") % 2 == 0, F.replace(page, F.concat(F.lit("<id>"), F.col("doc_id").cast("string"), F.lit("</id><rev")), F.lit("<rev"))).otherwise(page)
    line = F.when(F.col("doc_id") % 2 == 0, F.concat(broken, F.lit("</page>"))).otherwise(broken)
    _table(spark, sf, "documents").select(line.alias("xml")).union(_table(spark, sf, "documents").select(F.concat(page, F.lit("</page>")))).write.text(f"{dumps}/enwiki")
    jobs.analyse_concepts(spark, dumps, output, n_concepts=2, n_terms=50, lang="en")
    return spark.read.parquet(f"{output}_rejects").groupBy("reason").agg(F.count("*").alias("rejected"))


def stop_word_file(spark, sf):
    """Stop words from a written file."""
    path = stage_path(spark, "words")
    spark.createDataFrame([(w,) for w in STOP_WORDS], "value string").write.text(path)
    docs = tm.drop_stop_words(_terms(spark, sf, min_terms=0), read_words(spark, path))
    return tm.keep_documents(docs).select("doc_id", _joined())


def null_pages(spark, sf):
    """Records that are null are left out."""
    records = _page_records(spark, sf)
    number = F.regexp_extract("page_xml", r"<id>(\d+)</id>", 1).cast("long")
    some = records.select("lang", F.when(number % 3 != 0, F.col("page_xml")).alias("page_xml"))
    return pg.parse_pages(some).select("page_id", "title", "reason")


def concepts_job(spark, sf):
    """The job's relevance table for the English documents, from written dumps."""
    output = stage_path(spark, "relevances")
    jobs.analyse_concepts(
        spark, _written_dumps(spark, sf), output, STOP_WORDS, n_concepts=CONCEPTS, n_terms=VOCABULARY, lang="en", digits=DIGITS
    )
    return spark.read.parquet(output)


def resampled(spark, sf):
    """A resample of mean multiplicity 4: how often each key has been drawn."""
    drawn = resample_by_key(_table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", RESAMPLE_MEAN, RESAMPLE_SEED)
    return drawn.groupBy("o_orderkey").agg(F.count("*").alias("multiplicity"))


def replaced_language(spark, sf):
    """Documents in partitions of a language, written twice: the second run has German rows only, with other lengths."""
    path, layout = stage_path(spark, "documents"), Layout(partition=("lang",), cluster=("doc_id",))
    docs = _table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    write_table(docs, path, layout=layout)
    write_table(docs.where("lang = 'de'").withColumn("n_chars", F.col("n_chars") + 1), path, mode="replace", layout=layout)
    return read_table(spark, path).select("doc_id", "lang", "n_chars")


def replaced_language_only(spark, sf):
    """What the second run has written, from its folder alone: the filter prunes all others."""
    return replaced_language(spark, sf).where("lang = 'de'")


def matrix_row_sorted(spark, sf):
    """A row by its id on sorted rows with Bloom filters, whose statistics leave one row group to be read."""
    path = stage_path(spark, "rows")
    write_table(_vectors(spark, sf), path, layout=Layout(cluster=("id",), lookup=("id",), row_group_bytes=1 << 20))
    return _entries(factors.row_of(read_table(spark, path), 42))


def entry(spark: SparkSession) -> DataFrame:
    """Top terms of the strongest concepts of the documents."""
    return lsa_top_terms(spark, "/root/testdata/sf0.001")


def _optional() -> list[ModuleType]:
    """The operators for training data and their pipeline, where they are installed."""
    found = []
    for part, name in (("pageloom.llm", "pageloom.llm.registry"), ("corpus_pipeline", "corpus_pipeline")):
        if importlib.util.find_spec(part) is not None:  # an error inside of them is not swallowed
            found.append(importlib.import_module(name))
    return found


def queries() -> dict[str, Query]:
    own = {
        f.__name__: f
        for f in (
            tokens, tokens_unicode, tokens_singular, term_counts, document_lengths, corpus_size,
            document_frequency, rarest_terms, vocabulary, tfidf, tfidf_capped, document_vectors,
            stop_words, stop_words_before_rule, stop_word_table, stop_words_shuffled, normalized_terms, normalized_terms_shuffled, union_all,
            page_round_trip, dump_languages, page_words, filter_articles, statements, statements_job, statements_namespaces, statements_one_language_again, job_counts, cut_dump_rejects, page_rejects,
            entity_labels, entity_labels_strict, entity_sitelinks, entity_claims, entity_claims_strict,
            claim_rejects, entity_rejects, entity_mixed_members, label_rejects, sitelink_rejects, member_rejects, entities_job,
            scale_rows, normalize_rows, matrix_row, top_entries,
            lsa_doc_energy, lsa_term_energy, lsa_doc_energy_iterative, lsa_term_neighbors, lsa_term_neighbors_all, lsa_term_pairs,
            lsa_concept_strength, lsa_top_terms, lsa_top_docs, lsa_relevances, lsa_invariants, concepts_job, concepts_job_rejects, stop_word_file, null_pages, resampled,
            replaced_language, replaced_language_only, matrix_row_sorted,
        )
    }
    for module in _optional():
        own |= module.QUERIES
    return own


# --- SQL counterparts ------------------------------------------------------


def _tok(text: str = "text") -> str:
    return (
        f"list_filter(list_transform(regexp_split_to_array({text}, '[^\\w-]'), lambda x: lower(x)),"
        " lambda x: regexp_full_match(x, '[a-z]{3,}'))"
    )


def _docs_sql(terms: str | None = None) -> str:
    return f"""WITH t AS (SELECT doc_id, lang, {terms or _tok()} AS terms FROM documents),
d AS (SELECT * FROM t WHERE len(terms) > 1)"""


def _counts_sql(terms: str | None = None) -> str:
    return f"""{_docs_sql(terms)},
e AS (SELECT doc_id, len(terms) AS n_terms, unnest(terms) AS term FROM d),
c AS (SELECT doc_id, n_terms, term, count(*) AS tf FROM e GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM c GROUP BY term)"""


def _weights_sql(n: int) -> str:
    return f"""{_counts_sql()},
v AS (SELECT term, df, row_number() OVER (ORDER BY df DESC, term) - 1 AS idx,
             ln((SELECT count(*) FROM d)::DOUBLE / df) AS idf FROM f QUALIFY idx < {n}),
w AS (SELECT doc_id, term, idx, idf * tf / n_terms AS w FROM c JOIN v USING (term))"""


_STOP = ", ".join(f"'{w}'" for w in STOP_WORDS)
_WITHOUT_STOP = f"list_filter({_tok()}, lambda x: x NOT IN ({_STOP}))"
_RULE = (
    "list_transform({0}, lambda x: regexp_replace(regexp_replace(regexp_replace(x,"
    " '([^ea])ies$', '\\1y'), '([^aeo])es$', '\\1e'), '([^us])s$', '\\1'))"
)
_TITLE = "'Doc ' || doc_id || ' (' || source || ')'"

_STATEMENTS = """WITH p AS (
  SELECT *, length(text) - length(replace(text, chr(10), '')) + 1 AS n,
         'Doc_' || doc_id || '_(' || source || ')' AS name,
         CASE lang WHEN 'de' THEN 'Kategorie' WHEN 'fr' THEN 'Catégorie' WHEN 'es' THEN 'Categoría' ELSE 'Category' END AS ns
  FROM documents),
l AS (
  SELECT *, 'Source_' || source AS category, 1 AS r FROM p
  UNION ALL SELECT *, 'Length_' || (n_chars % 13), 1 FROM p
  UNION ALL SELECT *, upper(left(lang, 1)) || substr(lang, 2), 3 FROM p)
SELECT lang AS language, 'article_categories' AS dataset,
       'http://' || lang || '.dbpedia.org/resource/' || name AS subject,
       'http://purl.org/dc/terms/subject' AS predicate,
       'http://' || lang || '.dbpedia.org/resource/' || ns || ':' || category AS value,
       'http://' || lang || '.wikipedia.org/wiki/' || name || '?oldid=' || (doc_id + 1000) || '#section=Source_' || source
         || '&relative-line=' || r || '&absolute-line=' || (n + 2 + r) AS context,
       CAST(NULL AS VARCHAR) AS datatype
FROM l"""

_CLAIMS = """SELECT 'E' || event_id AS entity_id, event_type AS property_id, 'string' AS data_type,
       'string' AS value_type, event_type AS value FROM events {0}
UNION ALL SELECT 'E' || event_id, event_type, 'wikibase-item', 'wikibase-entityid', 'U' || user_id FROM events {0}
UNION ALL SELECT 'E' || event_id, event_type, 'other', 'other', replace(props, ' ', '') FROM events {0}"""

_LINE = """'{"id":"Q' || doc_id || '","type":"item","labels":{"' || lang || '":{"language":"' || lang || '","value":"' || source || '"}}}'"""

_VECTOR = "SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(64)) AS concept FROM embeddings"

_REPLACED = "SELECT doc_id, lang, CASE lang WHEN 'de' THEN n_chars + 1 ELSE n_chars END AS n_chars FROM documents"

_COSINE = f"""{_weights_sql(SMALL_VOCABULARY)},
n AS (SELECT term, sqrt(sum(w * w)) AS length FROM w GROUP BY term HAVING sum(w * w) > 0),
u AS (SELECT doc_id, term, w / length AS x FROM w JOIN n USING (term)),
s AS (SELECT a.term AS id, b.term AS other, sum(a.x * b.x) AS score FROM u a JOIN u b USING (doc_id) GROUP BY ALL),
p AS (SELECT a.term AS id, b.term AS other FROM n a, n b),
q AS (SELECT id, other, round(coalesce(score, 0), 6) + 0 AS score FROM p LEFT JOIN s USING (id, other))
SELECT id, other, score FROM q"""


def _eigen_sql(n_terms: int, concepts: int, steps: int = 1500) -> str:
    """Strongest concepts by power iteration on the Gram matrix, each followed by deflation.

    Ends with ``sigma (concept, sigma)``, ``v (concept, term, v)`` and ``u (concept, doc_id, u)``.
    """
    ctes = [_weights_sql(n_terms).replace("WITH ", "WITH RECURSIVE ", 1)]
    ctes.append("""g AS (SELECT a.idx AS i, b.idx AS j, sum(a.w * b.w) AS g FROM w a JOIN w b USING (doc_id) GROUP BY ALL),
gr AS (SELECT a.idx AS i, list(coalesce(g, 0.0) ORDER BY b.idx) AS r FROM v a CROSS JOIN v b LEFT JOIN g ON i = a.idx AND j = b.idx GROUP BY a.idx),
m0 AS MATERIALIZED (SELECT list(r ORDER BY i) AS m FROM gr)""")
    for c in range(concepts):
        ctes.append(f"""p{c} AS (
  SELECT 0 AS step, list_transform(range(len(m)), lambda x: 1.0 + x / 1000.0) AS x FROM m0
  UNION ALL
  SELECT step + 1, list_transform(y, lambda a: a / l) FROM (
    SELECT step, y, sqrt(list_inner_product(y, y)) AS l FROM (
      SELECT step, list_transform(m, lambda r: list_inner_product(r, x)) AS y FROM p{c}, m{c} WHERE step < {steps}))),
e{c} AS MATERIALIZED (
  SELECT x, m, list_inner_product(x, list_transform(m, lambda r: list_inner_product(r, x))) AS l FROM p{c}, m{c} WHERE step = {steps}),
m{c + 1} AS MATERIALIZED (SELECT list_transform(m, lambda r, i: list_transform(r, lambda a, j: a - l * x[i] * x[j])) AS m FROM e{c})""")
    parts = " UNION ALL ".join(f"SELECT {c} AS concept, l, unnest(x) AS x, unnest(range(len(x))) AS idx FROM e{c}" for c in range(concepts))
    ctes.append(f"""ev AS ({parts}),
sg AS (SELECT concept, sign(arg_max(x, abs(x))) AS s FROM ev GROUP BY concept),
vf AS (SELECT concept, sqrt(l) AS sigma, term, idx, x * s AS v FROM ev JOIN sg USING (concept) JOIN v USING (idx)),
sf AS (SELECT DISTINCT concept, sigma FROM vf),
uf AS (SELECT concept, d.doc_id, coalesce(u, 0) AS u FROM d CROSS JOIN sf LEFT JOIN (
  SELECT concept, doc_id, sum(w.w * vf.v / sigma) AS u FROM w JOIN vf USING (idx) GROUP BY ALL) USING (concept, doc_id))""")
    return ",\n".join(ctes)


def _top_sql(factor: str, key: str, value: str) -> str:
    return f"""{_eigen_sql(VOCABULARY, CONCEPTS)}
SELECT concept, row_number() OVER (PARTITION BY concept ORDER BY score DESC, {key})::INTEGER AS rank, {key}, score
FROM (SELECT concept, {key}, round({value}, 6) + 0.0 AS score FROM {factor}) QUALIFY rank <= 10"""


_RELEVANCES = f"""{_eigen_sql(VOCABULARY, CONCEPTS)},
vs AS (SELECT concept, term, v * sigma AS x FROM vf),
un AS (SELECT concept, term, x / sqrt(sum(x * x) OVER (PARTITION BY term)) AS x FROM vs),
tt AS (SELECT a.term AS id, b.term AS other, round(sum(a.x * b.x), 6) + 0.0 AS score FROM un a JOIN un b USING (concept) GROUP BY ALL),
tn AS (SELECT * FROM tt QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, other) <= 20)
SELECT 'concept_strength' AS data_type, concept::VARCHAR AS ref, NULL AS key, round(sigma, 6) AS score FROM sf
UNION ALL SELECT 'term_to_concept', concept::VARCHAR, term, round(v, 6) + 0.0 FROM vf
UNION ALL SELECT 'doc_to_concept', concept::VARCHAR, doc_id::VARCHAR, round(u, 6) + 0.0 FROM uf
UNION ALL SELECT 'term_to_term', id, other, score FROM tn"""


def oracle_sql() -> dict[str, str]:
    energy = "SELECT {0} AS id, round(coalesce(sum(w * w), 0), 9) AS energy FROM {1} GROUP BY {0}"
    small = _weights_sql(SMALL_VOCABULARY)
    normalized = _counts_sql(
        f"list_transform({_tok()}, lambda x: CASE WHEN length(x) > 7 THEN left(x, 4) ELSE x END)"
    ) + " SELECT doc_id, n_terms, term, tf FROM c"
    doc_energy = f"{small} " + energy.format("doc_id", "d LEFT JOIN w USING (doc_id)")
    own = {
        "tokens": f"SELECT doc_id, array_to_string({_tok()}, ' ') AS terms FROM documents",
        "tokens_unicode": """SELECT doc_id, array_to_string(list_filter(list_transform(
            regexp_split_to_array(text, '[^\\pL-]'), lambda x: lower(x)), lambda x: regexp_full_match(x, '\\pL{3,}')), ' ') AS terms
            FROM documents""",
        "tokens_singular": f"{_docs_sql()} SELECT doc_id, array_to_string({_RULE.format('terms')}, ' ') AS terms FROM d",
        "term_counts": f"{_counts_sql()} SELECT doc_id, n_terms, term, tf FROM c",
        "document_lengths": f"{_docs_sql()} SELECT doc_id, len(terms) AS n_terms FROM d",
        "corpus_size": f"{_docs_sql()} SELECT count(*) AS n_docs FROM d",
        "document_frequency": f"{_counts_sql()} SELECT term, df FROM f",
        "rarest_terms": f"{_counts_sql()} SELECT term, df FROM f ORDER BY df, term LIMIT {VOCABULARY}",
        "vocabulary": f"{_weights_sql(VOCABULARY)} SELECT term, idx, df, round(idf, 9) AS idf FROM v",
        "tfidf": f"{_weights_sql(1 << 62)} SELECT doc_id, idx, round(w, 9) AS w FROM w",
        "tfidf_capped": f"{_weights_sql(VOCABULARY)} SELECT doc_id, idx, round(w, 9) AS w FROM w",
        "document_vectors": f"{_weights_sql(VOCABULARY)} SELECT doc_id, idx, round(w, 9) AS w FROM w WHERE w <> 0",
        "stop_words": f"""{_docs_sql(_WITHOUT_STOP)}
            SELECT doc_id, array_to_string(terms, ' ') AS terms FROM d""",
        "stop_words_before_rule": f"""{_docs_sql(_WITHOUT_STOP)}
            SELECT doc_id, array_to_string({_RULE.format('terms')}, ' ') AS terms FROM d""",
        "stop_word_table": f"""{_counts_sql()} SELECT doc_id, term, tf FROM c
            WHERE term NOT IN (SELECT unnest({_tok()}) FROM benchmark)""",
        "stop_words_shuffled": f"""{_docs_sql()}, each AS (SELECT doc_id, unnest(terms) AS term, generate_subscripts(terms, 1) AS pos FROM d),
            s AS (SELECT doc_id, string_agg(term, ' ' ORDER BY pos) AS left_over FROM each
                WHERE term NOT IN (SELECT unnest({_tok()}) FROM benchmark) GROUP BY doc_id)
            SELECT doc_id, coalesce(left_over, '') AS terms FROM d LEFT JOIN s USING (doc_id)""",
        "normalized_terms": normalized,
        "normalized_terms_shuffled": normalized,
        "union_all": f"""SELECT 'documents' AS origin, doc_id AS id, len({_tok()}) AS n_terms FROM documents
            UNION ALL SELECT 'conversations', conv_id, len({_tok()}) FROM conversations""",
        "page_round_trip": f"SELECT doc_id AS page_id, lang, {_TITLE} AS title, text FROM documents",
        "dump_languages": "SELECT DISTINCT lang FROM documents",
        "page_words": f"""SELECT doc_id AS page_id, {_TITLE} AS title,
            regexp_replace(text || source, '\\W', ' ', 'g') AS text FROM documents""",
        "filter_articles": """WITH p AS (SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS t, html FROM pages),
            q AS (SELECT page_id,
              CASE WHEN page_id % 5 = 0 THEN t || ' (disambiguation)' WHEN page_id % 7 = 0 THEN 'Talk:' || t ELSE t END AS title,
              CASE WHEN page_id % 11 = 0 THEN '' ELSE html END AS text FROM p)
            SELECT * FROM q WHERE text <> '' AND NOT contains(title, 'disambiguation') AND NOT contains(title, ':')""",
        "statements": _STATEMENTS,
        "statements_job": _STATEMENTS,
        "statements_one_language_again": f"""SELECT language, subject, value FROM ({_STATEMENTS}) WHERE language <> 'de'
            UNION ALL SELECT 'de', 'http://de.dbpedia.org/resource/Doc_' || doc_id || '_(' || source || ')',
              'http://de.dbpedia.org/resource/Kategorie:Neu_' || source FROM documents WHERE lang = 'de'""",
        "job_counts": """WITH p AS (SELECT CASE doc_id % 4 WHEN 1 THEN 'malformed page' WHEN 2 THEN 'page without revision' ELSE 'good' END AS name FROM documents),
            e AS (SELECT CASE WHEN k IN (3, 4) THEN 'malformed line' WHEN k = 6 THEN 'entity without type' WHEN k = 7 THEN 'entity without id' ELSE 'good' END AS name
              FROM (SELECT doc_id % 10 AS k, unnest(CASE WHEN doc_id % 10 = 4 THEN list_filter(string_split(text, chr(10)), lambda x, i: i = 1 OR trim(x, ' ,' || chr(9) || chr(13)) NOT IN ('', '[', ']')) ELSE ['x'] END) FROM documents)
              WHERE k <> 5)
            SELECT 'statements' AS job, name, count(*) AS records FROM p GROUP BY name UNION ALL SELECT 'entities', name, count(*) FROM e GROUP BY name""",
        "page_rejects": """WITH h AS (SELECT doc_id, '  <page>' || chr(10) || '    <title>Doc ' || doc_id || ' (' || source || ')</title>' || chr(10)
              || '    <ns>0</ns>' || chr(10) || '    <id>' || doc_id || '</id>' || chr(10) || '    ' AS open,
              '<revision><id>' || (doc_id + 1000) || '</id><text xml:space="preserve">'
              || replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</text></revision>' || chr(10) || '  </page>' AS body
              FROM documents)
            SELECT 'pages' AS source, CASE doc_id % 4 WHEN 1 THEN 'malformed page' ELSE 'page without revision' END AS reason,
              left(CASE doc_id % 4 WHEN 1 THEN left(open || body, length(open || body) - 30) ELSE open END || '</page>', 100) AS head
            FROM h WHERE doc_id % 4 IN (1, 2)""",
        "entity_labels": """SELECT 'Q' || doc_id AS entity_id, 'item' AS entity_type, lang AS language, 'Doc ' || doc_id AS label,
              CASE WHEN doc_id % 3 <> 0 THEN text ELSE '' END AS description FROM documents
            UNION ALL SELECT 'Q' || doc_id, 'item', 'mul', source, '' FROM documents""",
        "entity_labels_strict": """SELECT 'Q' || doc_id AS entity_id, 'item' AS entity_type, lang AS language, 'Doc ' || doc_id AS label,
              text AS description FROM documents WHERE doc_id % 3 <> 0
            UNION ALL SELECT 'Q' || doc_id, 'item', 'mul', source, '' FROM documents WHERE doc_id % 3 <> 0""",
        "entity_sitelinks": """SELECT 'Q' || doc_id AS entity_id, 'item' AS entity_type, lang || 'wiki' AS site, 'Doc ' || doc_id AS title,
              'https://' || lang || '.example.org/wiki/Doc_' || doc_id AS url FROM documents""",
        "entity_claims": _CLAIMS.format(""),
        "entity_claims_strict": _CLAIMS.format("WHERE event_id % 3 <> 0"),
        "claim_rejects": """SELECT 'claims' AS source, 'novalue' AS reason, 'E' || event_id || ' ' || event_type AS head
            FROM events WHERE event_id % 3 = 0""",
        "entity_rejects": f"""WITH l AS (SELECT doc_id % 10 AS k, text, {_LINE} AS line FROM documents)
            SELECT 'entities' AS source,
              CASE k WHEN 6 THEN 'entity without type' WHEN 7 THEN 'entity without id' ELSE 'malformed line' END AS reason,
              left(CASE k WHEN 3 THEN left(line, length(line) - 5) WHEN 4 THEN 'junk ' || text
                WHEN 6 THEN replace(line, '"type":"item",', '') ELSE replace(line, '"id":', '"no":') END, 100) AS head
            FROM l WHERE k IN (3, 4, 6, 7)""",
        "entities_job": _CLAIMS.format(""),
        "scale_rows": f"SELECT vec_id AS id, concept, round(x * (concept + 1), 6) + 0.0 AS score FROM ({_VECTOR})",
        "normalize_rows": f"""SELECT vec_id AS id, concept, round(x / sqrt(sum(x * x) OVER (PARTITION BY vec_id)), 6) + 0.0 AS score
            FROM ({_VECTOR})""",
        "matrix_row": f"SELECT vec_id AS id, concept, round(x, 6) + 0.0 AS score FROM ({_VECTOR}) WHERE vec_id = 42",
        "top_entries": f"""SELECT concept, row_number() OVER (PARTITION BY concept ORDER BY score DESC, id) AS rank, id, score
            FROM (SELECT vec_id AS id, concept, round(x, 6) + 0.0 AS score FROM ({_VECTOR})) QUALIFY rank <= 10""",
        "lsa_doc_energy": doc_energy,
        "lsa_doc_energy_iterative": doc_energy,
        "lsa_term_energy": f"{small} " + energy.format("term", "w"),
        "lsa_concept_strength": f"{_eigen_sql(VOCABULARY, CONCEPTS)} SELECT concept, round(sigma, 6) AS sigma FROM sf",
        "entity_mixed_members": """SELECT 'Q' || doc_id AS entity_id, 'P1' AS name, '{"labels":[],"n":' || doc_id || '}' AS value FROM documents
            UNION ALL SELECT 'Q' || doc_id, 'en', source FROM documents""",
        "label_rejects": """SELECT 'labels' AS source, r AS reason, 'Q' || doc_id || ' ' || l AS head FROM documents,
            (VALUES ('label without value', 'es'), ('mistyped member of labels', 'fr'), ('mistyped member of labels', 'de')) x(r, l)""",
        "sitelink_rejects": """SELECT 'sitelinks' AS source, r AS reason, 'Q' || doc_id || ' ' || l AS head FROM documents,
            (VALUES ('site link without title', 'frwiki'), ('mistyped member of sitelinks', 'dewiki')) x(r, l)""",
        "member_rejects": """SELECT 'claims' AS source, r AS reason, 'Q' || doc_id || ' ' || l AS head FROM documents,
            (VALUES ('mistyped statement', 'P1'), ('mistyped member of claims', 'P2'), ('mistyped member of claims', 'P3')) x(r, l)""",
        "statements_namespaces": f"""WITH n AS (SELECT *, string_split({NAMES!r}[1 + doc_id % {len(NAMES)}], ' ') AS x FROM documents)
            SELECT x[1] AS language, 'http://' || x[1] || '.dbpedia.org/resource/Doc_' || doc_id AS subject,
                   'http://' || x[1] || '.dbpedia.org/resource/' || x[2] || ':Source_' || source AS value FROM n""",
        "cut_dump_rejects": """SELECT count(*) - count(DISTINCT source) AS good, 'cut page' AS reason, count(DISTINCT source) AS rejected FROM documents""",
        "lsa_invariants": "SELECT unnest(range(10)) AS concept, true AS solved, true AS unit",
        "concepts_job_rejects": """SELECT r AS reason, count(*) AS rejected FROM (
            SELECT CASE doc_id % 2 WHEN 0 THEN 'page without id' ELSE 'cut page' END AS r FROM documents) GROUP BY r""",
        "stop_word_file": f"{_docs_sql(_WITHOUT_STOP)} SELECT doc_id, array_to_string(terms, ' ') AS terms FROM d",
        "null_pages": f"SELECT doc_id AS page_id, {_TITLE} AS title, NULL::VARCHAR AS reason FROM documents WHERE doc_id % 3 <> 0",
        "resampled": f"""WITH d AS (SELECT o_orderkey, ('0x' || md5('{RESAMPLE_SEED}:' || o_orderkey)[1:13])::BIGINT / {1 << 52}::DOUBLE AS draw FROM orders),
            m AS (SELECT o_orderkey, len(list_filter([{", ".join(f"{x!r}::DOUBLE" for x in poisson_steps(RESAMPLE_MEAN))}], lambda x: x <= draw)) AS multiplicity FROM d)
            SELECT o_orderkey, multiplicity FROM m WHERE multiplicity > 0""",
        "replaced_language": _REPLACED,
        "replaced_language_only": f"SELECT * FROM ({_REPLACED}) WHERE lang = 'de'",
        "matrix_row_sorted": f"SELECT vec_id AS id, concept, round(x, 6) + 0.0 AS score FROM ({_VECTOR}) WHERE vec_id = 42",
        "lsa_top_terms": _top_sql("vf", "term", "v"),
        "lsa_top_docs": _top_sql("uf", "doc_id", "u"),
        "lsa_relevances": _RELEVANCES,
        "concepts_job": _RELEVANCES.replace(_docs_sql()[5:], _docs_sql(_WITHOUT_STOP)[5:].replace("documents)", "documents WHERE lang = 'en')")).replace(
            "doc_id::VARCHAR", "'Doc ' || doc_id || ' (' || (SELECT source FROM documents s WHERE s.doc_id = uf.doc_id) || ')'"
        ),
        "lsa_term_pairs": _COSINE,
        "lsa_term_neighbors": f"""{_COSINE} QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, other) <= 10""",
    }
    for module in _optional():
        own |= module.ORACLES
    return own
