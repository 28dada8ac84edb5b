"""Documents to terms, frequencies and TF-IDF weights.

A document is a row ``doc_id, terms`` (any further columns stay). All counting
inside a document happens inside its row, so the only shuffles are those that
count a term over the corpus, and they carry partial sums.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Interaction, StopWordsRemover, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window, functions as F

from pageloom.functions.binding import bind
from pageloom.functions.text import singular_english, tokenize
from pageloom.operators.ranking import first_rows
from pageloom.staging import drop_staged, stage

# Tables up to this size are broadcast; a row is a term or two and a few numbers, so
# the broadcast stays within tens of MB. Larger ones go through a shuffle join.
BROADCAST_ROWS = 200_000
BROADCAST_CHARS = 20_000_000
# A key with more rows than this is spread over tasks, unless there are so many such keys that the bound is raised.
HOT_ROWS = 1_000_000
HOT_KEYS = 10_000
# Documents whose distinct terms are looked up together have about so many terms.
CHUNK_TERMS = 1 << 19


def is_small(table: DataFrame, rows: int | None = None) -> bool:
    """Whether a table may be broadcast, by measuring.

    A caller's bound on its rows spares the measure only where it says that the table is large. Measuring
    stops after ``BROADCAST_ROWS`` rows and also counts the text they hold.
    """
    if rows is not None and rows > BROADCAST_ROWS:
        return False
    texts = [F.coalesce(F.length(c), F.lit(0)) for c, kind in table.dtypes if kind == "string"]
    size = F.sum(sum(texts, F.lit(0)).cast("long"))
    found = table.limit(BROADCAST_ROWS + 1).agg(F.count("*").alias("rows"), F.coalesce(size, F.lit(0)).alias("chars")).first()
    return found["rows"] <= BROADCAST_ROWS and found["chars"] <= BROADCAST_CHARS


def hot_keys(sizes: DataFrame, keys: list[str]) -> DataFrame | None:
    """The keys that are too frequent for one task, as ``_hash`` and the number of parts to spread each over; None if there are none.

    ``sizes`` has a row ``keys, rows`` for each key. A key is hot from ``HOT_ROWS`` rows on, or from a ``HOT_KEYS``-th
    of all rows if that is more, so at most ``HOT_KEYS`` of them come to the driver, two numbers each.
    """
    written = stage(sizes.select(F.xxhash64(*keys).alias("_hash"), "rows"), "sizes")
    total = written.agg(F.sum("rows").alias("rows")).first()["rows"] or 0
    limit = max(HOT_ROWS, -(-total // HOT_KEYS))
    parts = F.ceil(F.col("rows") / limit).cast("int")
    hot = written.where(F.col("rows") >= limit).groupBy("_hash").agg(F.sum(parts).cast("int").alias("_parts")).collect()
    drop_staged(written)
    return sizes.sparkSession.createDataFrame(hot, "_hash long, _parts int") if hot else None


def lookup(
    rows: DataFrame,
    table: DataFrame,
    keys: list[str],
    how: str,
    table_rows: int | None,
    salt_by: tuple[str, ...] = ("doc_id",),
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Join corpus rows to a table with one row per key.

    A small table is broadcast. Otherwise both are shuffled by key. One key may hold a large part of all rows: a hot one
    is spread by ``salt_by`` over as many parts as its rows need, and its row of the table is repeated that often.
    All other rows are neither salted nor repeated. ``sizes``, ``keys, rows``, spares the count of the rows by key.
    """
    if is_small(table, table_rows):
        return rows.join(F.broadcast(table), keys, how)
    hot = hot_keys(rows.groupBy(*keys).agg(F.count("*").alias("rows")) if sizes is None else sizes, keys)
    if hot is None:
        return rows.join(table, keys, how)

    def parted(df: DataFrame) -> DataFrame:
        return df.withColumn("_hash", F.xxhash64(*keys)).join(F.broadcast(hot), "_hash", "left").withColumn("_parts", F.coalesce("_parts", F.lit(1))).drop("_hash")

    salted = parted(rows).withColumn("_salt", F.pmod(F.xxhash64(*salt_by), F.col("_parts")).cast("int")).drop("_parts")
    repeated = parted(table).withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))).drop("_parts")
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")


def tokenize_documents(
    docs: DataFrame,
    stop_words: list[str] | None = None,
    mode: str = "ascii",
    singular: bool = False,
    stop_first: bool = False,
    min_terms: int = 2,
) -> DataFrame:
    """Replace ``text`` by ``terms`` and keep documents with at least ``min_terms`` of them.

    ``singular`` applies the light English rule. Stop words go after it, unless
    ``stop_first``. Nothing here shuffles.
    """
    plain = not stop_words
    steps = [lambda d: d]
    if singular:
        steps = [lambda d: d.withColumn("terms", singular_english("terms"))]
    if stop_words:
        steps.insert(0 if stop_first else len(steps), lambda d: drop_stop_words(d, stop_words))
    terms = tokenize("text", mode)
    if plain and singular:
        terms, steps = singular_english(terms), []
    long_enough = (lambda t: F.size(t) >= min_terms) if plain else None
    out = bind(docs, "terms", terms, long_enough).drop("text")
    for step in steps:
        out = step(out)
    return out if plain else keep_documents(out, min_terms)


def keep_documents(docs: DataFrame, min_terms: int = 2) -> DataFrame:
    """Documents with at least ``min_terms`` terms left."""
    bound = bind(docs.withColumnRenamed("terms", "_terms"), "terms", F.col("_terms"), lambda t: F.size(t) >= min_terms)
    return bound.select(*docs.columns)


def drop_stop_words(docs: DataFrame, stop_words: list[str] | DataFrame, stop_rows: int | None = None) -> DataFrame:
    """Remove listed words from ``terms``; repeated other terms stay, and so does the order. Null ``terms`` become none.

    The words are a list or a table ``term``. A small table is sent to every task. With a large one chunks of documents ask for their
    distinct terms; documents are dealt by ``doc_id``, which must then be unique.
    """
    if isinstance(stop_words, DataFrame):
        table = stop_words.select("term").where("term IS NOT NULL").distinct()
        if not is_small(table, stop_rows):
            return _changed(docs, table, ["term"])
        stop_words = [r["term"] for r in table.collect()]  # as is_small has measured
    remover = StopWordsRemover(stopWords=stop_words, caseSensitive=True, inputCol="_terms", outputCol="terms")
    given = docs.withColumn("_terms", F.coalesce("terms", F.array().cast("array<string>"))).drop("terms")
    return remover.transform(given).select(*docs.columns)


def drop_stop_terms(rows: DataFrame, stop_table: DataFrame, stop_rows: int | None = None) -> DataFrame:
    """Remove rows whose ``term`` is in a stop-word table of any size."""
    return lookup(rows, stop_table.select("term").distinct(), ["term"], "left_anti", stop_rows)


def normalize_terms(docs: DataFrame, lemmas: DataFrame, lemma_rows: int | None = None) -> DataFrame:
    """Map ``terms`` through a table ``lang, term, lemma``; unlisted terms stay, and so does the order of all.

    Needs ``lang, terms``; further columns stay. Of several lemmas of a term the lowest counts. A small table is sent to
    every task, which maps the terms of a whole batch at once, so nothing of a document is shuffled. With a large one chunks of
    documents ask for their distinct terms; documents are dealt by ``doc_id``, which must then be unique.
    """
    table = lemmas.where("lemma IS NOT NULL").groupBy("lang", "term").agg(F.min("lemma").alias("lemma"))
    rest = [c for c in docs.columns if c != "terms"]
    if is_small(table, lemma_rows):
        return _map_terms(docs.select(*rest, "terms"), table)
    return _changed(docs, table, ["lang", "term"])


def _changed(docs: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """``docs`` with the terms that a table of any size lists by ``keys`` as its ``lemma``, or without them if it has none.

    Documents are dealt by ``doc_id`` into chunks of about ``CHUNK_TERMS`` terms. A chunk sends its distinct terms, however often it
    has them, to the table and gets back those that are listed, so documents are shuffled whole and once for either way.
    Null ``terms`` become none. Terms of rows with one id are put together by place, as a document has but one row.
    """
    total = docs.agg(F.coalesce(F.sum(F.size(F.coalesce("terms", F.array().cast("array<string>"))).cast("long")), F.lit(0))).first()[0]
    dealt = docs.withColumn("_chunk", F.pmod(F.xxhash64("doc_id"), F.lit(1 + total // CHUNK_TERMS))).repartition("_chunk")
    # Rows of a chunk are together already, so nothing is shuffled for the distinct ones.
    asked = dealt.select("_chunk", *keys[:-1], F.explode("terms").alias("term")).distinct()
    found = asked.join(table, keys).select(F.col("_chunk").alias("_of"), *[F.col(c).alias(f"_{c}") for c in table.columns])
    mapped = "lemma" in table.columns

    def change(own: pa.Table, listed: pa.Table) -> pa.Table:
        own, listed = own.combine_chunks(), listed.combine_chunks()
        lists = own.column("terms").combine_chunks()
        sizes = np.array(pc.fill_null(pc.list_value_length(lists), 0), np.int64)
        flat, row = lists.flatten(), np.repeat(np.arange(own.num_rows), sizes)
        place = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        if mapped:
            langs = own.column("lang").combine_chunks().take(pa.array(row))
            for lang in pc.unique(listed.column("_lang")).to_pylist():
                some = listed.filter(pc.equal(listed.column("_lang"), lang)).combine_chunks()
                at = pc.index_in(flat, value_set=some.column("_term").combine_chunks())
                hit = pc.and_(pc.is_valid(at), pc.fill_null(pc.equal(langs, lang), False))
                flat = pc.if_else(hit, some.column("_lemma").combine_chunks().take(at), flat)
        elif listed.num_rows:
            stays = pc.invert(pc.is_in(flat, value_set=listed.column("_term").combine_chunks()))
            chosen = stays.to_numpy(zero_copy_only=False)
            flat, row, place = flat.filter(stays), row[chosen], place[chosen]
        ids = own.column("doc_id").combine_chunks().dictionary_encode(null_encoding="encode")
        if len(ids.dictionary) == own.num_rows:
            offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=own.num_rows))]).astype(np.int32)
            terms = pa.ListArray.from_arrays(offsets, flat)
        else:
            doc = ids.indices.to_numpy()
            together: list[list[tuple]] = [[] for _ in ids.dictionary]
            for d, at, term in zip(doc[row].tolist(), place.tolist(), flat.to_pylist(), strict=True):
                together[d].append((at, term is not None, term or ""))
            every = [[term if some else None for _, some, term in sorted(found)] for found in together]
            terms = pa.array([every[d] for d in doc.tolist()], lists.type)
        return own.drop_columns(["_chunk", "terms"]).append_column("terms", terms).select(docs_columns)

    docs_columns = docs.columns
    return dealt.groupBy("_chunk").cogroup(found.groupBy("_of")).applyInArrow(change, docs.schema)


def _map_terms(docs: DataFrame, table: DataFrame) -> DataFrame:
    by_lang: dict[str, tuple[list[str], list[str]]] = {}
    for r in table.toArrow().to_pylist():  # at most BROADCAST_ROWS, as is_small has measured
        terms, mapped = by_lang.setdefault(r["lang"], ([], []))
        terms.append(r["term"])
        mapped.append(r["lemma"])
    shared = docs.sparkSession.sparkContext.broadcast(by_lang)
    lang_at, terms_at = docs.columns.index("lang"), docs.columns.index("terms")

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {lang: (pa.array(a, pa.string()), pa.array(b, pa.string())) for lang, (a, b) in shared.value.items()}
        for batch in batches:
            lists = batch.column(terms_at)
            sizes = np.array(pc.fill_null(pc.list_value_length(lists), 0))
            flat = lists.flatten()
            langs = batch.column(lang_at).take(pa.array(np.repeat(np.arange(batch.num_rows), sizes)))
            for lang in set(batch.column(lang_at).to_pylist()) & set(known):
                terms, mapped = known[lang]
                at = pc.index_in(flat, value_set=terms)
                hit = pc.and_(pc.is_valid(at), pc.fill_null(pc.equal(langs, lang), False))
                flat = pc.if_else(hit, mapped.take(at), flat)
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            columns = batch.columns
            columns[terms_at] = pa.ListArray.from_arrays(offsets, flat, mask=pc.is_null(lists))
            yield pa.RecordBatch.from_arrays(columns, docs_columns)

    docs_columns = docs.columns
    return docs.mapInArrow(change, docs.schema)


def _run_starts(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``s``, the sorted terms of each row, and ``b``, the positions where a new term starts in it."""
    ordered = docs.select(*keep, F.sort_array("terms").alias("s"))
    starts = F.transform("s", lambda x, i: F.when(~x.eqNullSafe(F.get("s", i - 1)), i))
    return ordered.select(*keep, "s", F.filter(starts, lambda i: i.isNotNull()).alias("b"))


def _runs() -> Column:
    """The distinct terms of a row with their counts, from :func:`_run_starts`.

    Goes into a generator as it is: a generator over a plain column makes Spark
    infer a filter that computes the column a second time.
    """
    end = lambda j: F.coalesce(F.get("b", j + 1), F.size("s"))
    return F.transform("b", lambda i, j: F.struct(F.get("s", i).alias("term"), (end(j) - i).alias("tf")))


def term_counts(docs: DataFrame) -> DataFrame:
    """``doc_id, n_terms, term, tf``: how often each term occurs in each document."""
    return _run_starts(docs, ["doc_id"]).select("doc_id", F.size("s").alias("n_terms"), F.inline(_runs()).alias("term", "tf"))


def document_lengths(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.size("terms").alias("n_terms"))


def corpus_size(docs: DataFrame) -> DataFrame:
    """One row ``n_docs``; use ``.scalar()`` to refer to it in an expression."""
    return docs.agg(F.count("*").alias("n_docs"))


def document_frequency(docs: DataFrame, keep: int | None = None, order: str = "most_frequent") -> DataFrame:
    """``term, df``: in how many documents each term occurs.

    ``keep`` leaves that many terms, the most frequent or with ``order='rarest'``
    the rarest ones; ties go to the lower term. Very many terms may tie at the last place, so they are ranked in rounds.
    """
    df = docs.select(F.explode(F.array_distinct("terms")).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    if keep is None:
        return df
    if order == "rarest":
        return first_rows(_rare_enough(df, keep), [F.asc("df"), F.asc("term")], keep)
    return first_rows(_frequent_enough(df, keep), [F.desc("df"), F.asc("term")], keep)


def _frequent_enough(counted: DataFrame, n: int) -> DataFrame:
    """The terms that can be among the ``n`` most frequent: those at or above the n-th frequency.

    Without this, the task that ranks them would receive ``n`` terms from every
    partition of the count. The frequency comes from how many terms share each
    frequency, a far smaller table, computed from the same shuffled counts.
    """
    shared = counted.groupBy("df").agg(F.count("*").alias("n_terms"))
    reached = F.sum("n_terms").over(Window.orderBy(F.desc("df")))
    nth = shared.withColumn("reached", reached).where(F.col("reached") >= n).agg(F.max("df"))
    return counted.where(F.col("df") >= F.coalesce(nth.scalar(), F.lit(0)))


def _rare_enough(counted: DataFrame, n: int) -> DataFrame:
    """The terms that can be among the ``n`` rarest: those at or below the n-th frequency from the rarest."""
    shared = counted.groupBy("df").agg(F.count("*").alias("n_terms"))
    reached = F.sum("n_terms").over(Window.orderBy("df"))
    nth = shared.withColumn("reached", reached).where(F.col("reached") >= n).agg(F.min("df"))
    return counted.where(F.col("df") <= F.coalesce(nth.scalar(), F.lit((1 << 63) - 1)))


def idf(n_docs: Column, df: Column | str) -> Column:
    """Unsmoothed inverse document frequency, ln(N / df)."""
    return F.log(n_docs / F.col(df) if isinstance(df, str) else n_docs / df)


def vocabulary(docs: DataFrame, n_terms: int | None = 50_000) -> DataFrame:
    """The most frequent terms: ``term, idx, df, idf``, with idx from 0 by falling df, then term.

    One pass: every document also counts for a null term, whose frequency is the
    corpus size and which therefore comes first. The index is drawn over the
    ``n_terms`` rows that are left. ``n_terms=None`` keeps all terms: they are sorted over
    all tasks and written, and each task's rows are moved up by those of the tasks before it.
    """
    seen = F.array_append(F.array_distinct("terms"), F.lit(None).cast("string"))
    counted = docs.select(F.explode(seen).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    order = [F.desc("df"), F.asc_nulls_first("term")]
    by_rank = Window.orderBy(*order)
    if n_terms is None:
        return _numbered(counted, order)
    ranked = _frequent_enough(counted, n_terms + 1).orderBy(*order).limit(n_terms + 1).select(
        "term", (F.row_number().over(by_rank) - 2).alias("idx"), "df", idf(F.first("df").over(by_rank), "df").alias("idf")
    )
    return ranked.where("term IS NOT NULL")


def _numbered(counted: DataFrame, order: list[Column]) -> DataFrame:
    """All terms as ``term, idx, df, idf``; the null term, which holds the corpus size, comes first."""
    placed = stage(counted.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()), "vocabulary", release=True)
    task, place = F.shiftright("_place", 33), F.col("_place").bitwiseAND((1 << 33) - 1)
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    tasks = placed.groupBy(task.alias("_task")).agg(F.count("*").alias("n")).select("_task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    n_docs = placed.where("term IS NULL").agg(F.max("df")).scalar()
    joined = placed.withColumn("_task", task).join(F.broadcast(tasks), "_task")  # a row per task of the sort
    return joined.where("term IS NOT NULL").select("term", (F.col("_before") + place - 1).alias("idx"), "df", idf(n_docs, "df").alias("idf"))


def tfidf(docs: DataFrame, vocab: DataFrame, n_terms: int | None = None) -> DataFrame:
    """``doc_id, idx, w`` with w = idf · tf / terms of the document; other terms are dropped.

    ``vocab`` is measured before it is broadcast; ``n_terms``, a bound on its rows, may spare that. It holds the most
    frequent terms; its ``df`` says how many rows each has in the join, so they are not counted again.
    """
    sizes = vocab.select("term", F.col("df").alias("rows"))
    joined = lookup(term_counts(docs), vocab.select("term", "idx", "idf"), ["term"], "inner", n_terms, sizes=sizes)
    return joined.select("doc_id", "idx", (F.col("idf") * F.col("tf") / F.col("n_terms")).alias("w"))


def document_vectors(docs: DataFrame, terms: list[str], idfs: list[float]) -> DataFrame:
    """TF-IDF rows as sparse vectors ``w``, in place of ``terms``; the other columns stay.

    ``terms`` and ``idfs`` are the vocabulary in index order. Rows are assembled in
    place: no shuffle brings the weights of a document together.
    """
    share = docs.withColumn("_share", F.lit(1.0) / F.size("terms"))
    counted = CountVectorizerModel.from_vocabulary(terms, inputCol="terms", outputCol="_tf").transform(share)
    scaled = ElementwiseProduct(scalingVec=Vectors.dense(idfs), inputCol="_tf", outputCol="_tfidf").transform(counted)
    named = VectorAssembler(inputCols=["_tfidf"], outputCol="_named").transform(scaled)
    weighted = Interaction(inputCols=["_share", "_named"], outputCol="_w").transform(named)
    rest = [c for c in docs.columns if c != "terms"]
    return weighted.select(*rest, F.col("_w").alias("w", metadata={}))
