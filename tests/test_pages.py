import bz2
import gzip

import pytest

from pageloom.operators.pages import filter_articles, parse_pages, split_rejects
from pageloom.sources.dumps import category_names, language_of_path, list_dumps, list_languages, read_pages

PAGE = (
    "  <page>\n    <title>{title}</title>\n    <ns>0</ns>\n    <id>{id}</id>\n    <revision>\n      <id>{rev}</id>\n"
    "      <contributor><username>u</username><id>99</id></contributor>\n"
    '      <text bytes="3" xml:space="preserve">{text}</text>\n    </revision>\n  </page>\n'
)
HEADER = "<mediawiki>\n  <siteinfo><sitename>x</sitename></siteinfo>\n"


def dump(n, first=0, words=60):
    body = "".join(
        PAGE.format(title=f"T{i}", id=i, rev=i + 1000, text=f" page {i}: é &lt;/page&gt; &amp; " + "word " * (i % words) + "\n")
        for i in range(first, first + n)
    )
    return (HEADER + body + "</mediawiki>\n").encode()


@pytest.mark.parametrize("split", ["4k", "64k", "128m"])
def test_each_page_once_for_any_split_and_codec(spark, tmp_path, split):
    (tmp_path / "enwiki-1.xml").write_bytes(dump(700))
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "enwiki-2.xml.bz2").write_bytes(bz2.compress(dump(300, 700)))
    (tmp_path / "deep" / "frwiki-3.xml.gz").write_bytes(gzip.compress(dump(100, 1000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        pages = read_pages(spark, str(tmp_path))
        good, rejects = split_rejects(parse_pages(pages), "pages")
        rows = good.select("page_id", "lang", "title", "text", "revision_id").collect()
        assert rejects.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(r["page_id"] for r in rows) == list(range(1100))
    for r in rows:
        i = r["page_id"]
        assert r["title"] == f"T{i}" and r["revision_id"] == i + 1000
        assert r["text"] == f" page {i}: é </page> & " + "word " * (i % 60) + "\n"
        assert r["lang"] == ("fr" if i >= 1000 else "en")


def test_two_pages_plain_and_bz2(spark, tmp_path):
    text = dump(2)
    for name, data in {"enwiki.xml": text, "enwiki.xml.bz2": bz2.compress(text)}.items():
        folder = tmp_path / name
        folder.mkdir()
        (folder / name).write_bytes(data)
        titles = [r["title"] for r in parse_pages(read_pages(spark, str(folder / name))).collect()]
        assert sorted(titles) == ["T0", "T1"]


def test_page_cut_off_at_the_end_is_rejected(spark, tmp_path):
    whole = dump(3)
    (tmp_path / "enwiki.xml").write_bytes(whole[: whole.rindex(b"</text>") - 5])
    good, rejects = split_rejects(parse_pages(read_pages(spark, str(tmp_path))), "pages")
    assert sorted(r["title"] for r in good.collect()) == ["T0", "T1"]
    (row,) = rejects.collect()
    assert row["reason"] == "cut page" and row["head"].startswith("<page>") and len(row["head"]) == 100


def test_a_page_cut_after_its_first_revision_is_no_good_page(spark, tmp_path):
    page = "<page><title>T</title><id>1</id><revision><id>1</id><text>x</text></revision>"
    (tmp_path / "enwiki.xml").write_text(f"<mediawiki>{page}</page>{page.replace('<id>1</id><rev', '<rev')}</page>{page}")
    good, rejects = split_rejects(parse_pages(read_pages(spark, str(tmp_path))), "pages")
    assert good.count() == 1
    assert sorted(r["reason"] for r in rejects.collect()) == ["cut page", "page without id"]


def test_category_names_come_from_the_headers(spark, tmp_path):
    for lang, name in (("pl", "Kategoria"), ("uk", "Категорія")):
        head = f'<mediawiki><siteinfo><namespaces><namespace key="1">Talk</namespace><namespace key="14" case="x">{name}</namespace></namespaces></siteinfo>'
        (tmp_path / f"{lang}wiki.xml").write_text(f"{head}\n<page><title>T</title></page></mediawiki>", encoding="utf-8")
    assert {(r["lang"], r["namespace"]) for r in category_names(spark, str(tmp_path)).collect()} == {("pl", "Kategoria"), ("uk", "Категорія")}
    assert read_pages(spark, str(tmp_path)).count() == 2


def test_malformed_pages_do_not_stop_the_others(spark):
    xml = [
        "<page><title>a<title></page>",
        "<page><title>b</title></page>",
        "not xml",
        "<page><title>c</title><id>1</id><revision><id>5</id><text>x</text></revision><revision><id>6</id><text>y</text></revision></page>",
        "<page><title>d</title><id>2</id><revision><id>7</id><text /></revision></page>",
        None,
    ]
    parsed = parse_pages(spark.createDataFrame([(x,) for x in xml], "page_xml string"))
    good, rejects = split_rejects(parsed, "pages")
    assert {(r["title"], r["text"], r["revision_id"], r["revision_text"]) for r in good.collect()} == {
        ("c", "xy", 5, "x"), ("d", "", 7, ""),
    }
    assert sorted(r["reason"] for r in rejects.collect()) == ["malformed page", "malformed page", "page without revision"]


def test_words_only(spark):
    df = spark.createDataFrame([("<page><title>t</title><id>1</id><revision><id>1</id><text>a-b é_c</text></revision></page>",)], "page_xml string")
    assert parse_pages(df, words_only=True).first()["text"] == "a b  _c"


def test_articles(spark):
    rows = [("A", "x"), ("A:b", "x"), ("A disambiguation", "x"), ("A Disambiguation", "x"), ("B", "")]
    kept = filter_articles(spark.createDataFrame(rows, "title string, text string"))
    assert sorted(r["title"] for r in kept.collect()) == ["A", "A Disambiguation"]


def test_language_of_path(spark):
    cases = {
        "file:/d/enwiki-2016.xml.bz2": "en",
        "/mywiki/frwiki.xml": "fr",
        "/data/warwiki/part-000": "war",
        "/a/frwiktionary.xml": None,
        "/enwiki/x/y.xml": None,
        "/a/enwikitravel.xml": "en",
    }
    df = spark.createDataFrame([(p,) for p in cases], "path string")
    found = {r["path"]: r["lang"] for r in df.select("path", language_of_path("path").alias("lang")).collect()}
    assert found == cases


def test_languages_and_dumps(spark, tmp_path):
    for name in ("enwiki-1.xml", "enwiki-2.xml", "warwiki.xml", "readme.txt"):
        (tmp_path / name).write_bytes(dump(1))
    assert sorted(r["lang"] for r in list_languages(spark, str(tmp_path)).collect()) == ["en", "war"]
    dumps = list_dumps(spark, str(tmp_path))
    assert dumps.count() == 3
    assert list_dumps(spark, str(tmp_path / "enwiki-1.xml")).count() == 1
    assert read_pages(spark, str(tmp_path)).count() == 3
    assert read_pages(spark, str(tmp_path), lang="war").count() == 1
