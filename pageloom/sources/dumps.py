"""Page dumps: plain or compressed XML files of ``<page>`` records."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Fixed value: a dump is named after its language, e.g. ``enwiki-…``.
LANGUAGE_PATTERN = r"([a-z]{2,})wiki"
# How a dump begins, and key 14, the category namespace, in its header.
HEAD_PATTERN = r"^\s*(<\?xml|<mediawiki|<siteinfo)"
CATEGORY_PATTERN = r'<namespace\b[^>]*\bkey="14"[^>]*>([^<]+)</namespace>'
HEADER_ENDS = (b"</siteinfo>", b"<page>")
HEADER_BYTES, HEADER_STEP, HEADER_THREADS = 1 << 20, 1 << 14, 16


def language_of_path(path: Column | str) -> Column:
    """Language code from the file name, else from its folder; null if neither has one."""
    parts = F.split(path, "/")
    found = [F.nullif(F.regexp_extract(F.get(F.reverse(parts), F.lit(i)), LANGUAGE_PATTERN, 1), F.lit("")) for i in (0, 1)]
    return F.coalesce(*found)


def list_dumps(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Dump files under ``path``, at any depth: ``lang, path, length``.

    Only file metadata is read; the content column is pruned from the scan.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(language_of_path("path").alias("lang"), "path", "length").where("lang IS NOT NULL")


def list_languages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return list_dumps(spark, path).select("lang").distinct()


def _chunks(spark: SparkSession, path: str | list[str], lang: str | None) -> DataFrame:
    """``lang, path, value``: what stands between two ``<page>``, and the head of each file before the first.

    The text source splits plain and bz2 files at any byte and hands out each chunk once.
    """
    chunks = spark.read.option("recursiveFileLookup", "true").option("lineSep", "<page>").text(path)
    chunks = chunks.select(language_of_path("_metadata.file_path").alias("lang"), F.col("_metadata.file_path").alias("path"), "value")
    chunks = chunks.where("lang IS NOT NULL")
    return chunks if lang is None else chunks.where(F.col("lang") == lang)


def read_pages(spark: SparkSession, path: str | list[str], lang: str | None = None) -> DataFrame:
    """All page records under ``path``: ``lang, path, page_xml``.

    Files without a language, and with ``lang`` those of other languages, are left out when the scan is
    planned and never opened. ``spark.sql.files.maxPartitionBytes`` sets the split size. A record that its file
    cuts off has no end tag and is left for :func:`pageloom.operators.pages.parse_pages` to reject.
    """
    end = F.locate("</page>", F.col("value"))
    head = F.trim("value").isin("", "\n") | F.rlike("value", F.lit(HEAD_PATTERN))
    record = F.concat(F.lit("<page>"), F.when(end > 0, F.substr("value", F.lit(1), end + 6)).otherwise(F.col("value")))
    return _chunks(spark, path, lang).where((end > 0) | ~head).select("lang", "path", record.alias("page_xml"))


def category_names(spark: SparkSession, path: str | list[str], lang: str | None = None) -> DataFrame:
    """``lang, namespace``: the category namespace that a dump's header names, one for a language.

    Only the first bytes of a file are read, through its codec, up to the end of the header: ``HEADER_BYTES`` at most, however large the
    dumps are. Of a language's files, in the order of their paths, the first that names the namespace counts, so that one or
    two files of each language are opened. Spark's own file systems open them, whatever store they are in.
    """
    dumps = list_dumps(spark, path)
    listed = (dumps if lang is None else dumps.where(F.col("lang") == lang)).groupBy("lang").agg(F.array_sort(F.collect_list("path")).alias("paths"))
    files = {r["lang"]: r["paths"] for r in listed.collect()}  # the paths, which Spark's file index holds on the driver too
    with ThreadPoolExecutor(HEADER_THREADS) as pool:
        names = list(pool.map(lambda paths: next(filter(None, (header_namespace(spark, p) for p in paths)), None), files.values()))
    found = [(code, name) for code, name in zip(files, names, strict=True) if name]
    return spark.createDataFrame(found, "lang string, namespace string")


def header_namespace(spark: SparkSession, path: str) -> str | None:
    """The category namespace in the header of one file; None if there is no header, or no such name in it."""
    found = re.search(CATEGORY_PATTERN, read_header(spark, path))
    return found and found.group(1)


def read_header(spark: SparkSession, path: str) -> str:
    """What a dump has before its first page, ``HEADER_BYTES`` at most; a file that its codec can't read has none."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(target)
    data, stream = b"", target.getFileSystem(conf).open(target)
    try:
        if codec is not None:
            stream = codec.createInputStream(stream)
        while len(data) < HEADER_BYTES and not any(end in data for end in HEADER_ENDS):
            part = stream.readNBytes(HEADER_STEP)
            if not part:
                break
            data += part
    except Py4JJavaError:
        pass  # the records of such a file are read, and rejected, elsewhere
    finally:
        stream.close()
    ends = [at + len(end) for end in HEADER_ENDS if (at := data.find(end)) >= 0]
    return data[: min(ends, default=HEADER_BYTES)].decode("utf-8", "replace")
