import bz2
import json

import pytest
from pyspark.sql import functions as F

from pageloom.plans import jobs

PAGE = "<page><title>{t}</title><ns>0</ns><id>{i}</id><revision><id>{r}</id><text>{x}</text></revision></page>\n"
WORDS = ["music band song concert", "football goal team match", "music song guitar", "team match stadium player"]


def dump(n, first=0):
    text = "\n".join(["{words}", "== Links ==", "[[Category:Group {g}]]"])
    pages = [
        PAGE.format(t=f"Page {i}" if i % 10 else f"Talk:{i}", i=i, r=i + 1, x=text.format(words=f"{WORDS[i % 4]} " * (1 + i % 3), g=i % 4))
        for i in range(first, first + n)
    ]
    return ("<mediawiki>\n" + "".join(pages) + "<page><title>broken</page>\n</mediawiki>").encode()


@pytest.fixture(scope="module")
def dumps(tmp_path_factory):
    path = tmp_path_factory.mktemp("dumps")
    (path / "enwiki-1.xml").write_bytes(dump(40))
    (path / "enwiki-2.xml.bz2").write_bytes(bz2.compress(dump(20, 40)))
    return str(path)


def test_statements(spark, dumps, tmp_path):
    jobs.extract_statements(spark, dumps, str(tmp_path / "out"))
    quads = spark.read.parquet(str(tmp_path / "out" / "quads"))
    assert quads.count() == 60 and len(quads.columns) == 7
    assert spark.read.parquet(str(tmp_path / "out" / "rejects")).count() == 2
    with pytest.raises(ValueError):
        (tmp_path / "none").mkdir()
        (tmp_path / "none" / "x.xml").write_text("<page></page>")
        jobs.extract_statements(spark, str(tmp_path / "none"), str(tmp_path / "out2"))


def test_entities(spark, tmp_path):
    lines = [json.dumps({"id": f"Q{i}", "type": "item", "labels": {"en": {"language": "en", "value": str(i)}}, "sitelinks": {}, "claims": {}}) for i in range(50)]
    (tmp_path / "in.json").write_text("[\n" + ",\n".join(lines) + "\nbad\n]\n")
    jobs.main(["entities", str(tmp_path / "in.json"), str(tmp_path / "out")])
    counts = {t: spark.read.parquet(str(tmp_path / "out" / t)).count() for t in ("labels", "sitelinks", "claims", "rejects")}
    assert counts == {"labels": 50, "sitelinks": 0, "claims": 0, "rejects": 1}


def test_concepts(spark, dumps, tmp_path):
    (tmp_path / "stop.txt").write_text("goal\n")
    model = jobs.analyse_concepts(spark, dumps, str(tmp_path / "out"), str(tmp_path / "stop.txt"), n_concepts=3, n_terms=100, neighbors=4)
    table = spark.read.parquet(str(tmp_path / "out"))
    counts = {r["data_type"]: r["count"] for r in table.groupBy("data_type").count().collect()}
    k = len(model.sigma)
    assert spark.read.parquet(str(tmp_path / "out_rejects")).count() == 2
    assert counts["concept_strength"] == k == 3
    assert counts["doc_to_concept"] == 54 * k, "six pages are in another namespace"
    terms = {r["key"] for r in table.where("data_type = 'term_to_concept'").select("key").distinct().collect()}
    assert "goal" not in terms and {"music", "football"} <= terms
    near = table.where("data_type = 'term_to_term' AND ref = 'guitar'").orderBy(F.desc("score")).collect()
    assert len(near) == 4 and near[0]["score"] == pytest.approx(1.0)


def test_concepts_with_lemmas(spark, dumps):
    lemmas = spark.createDataFrame([("en", "song", "music")], "lang string, term string, lemma string")
    docs = jobs.article_terms(jobs.article_tokens(spark, dumps), ["goal"], lemmas=lemmas)
    assert docs.count() == 54
    terms = {r["term"] for r in docs.select(F.explode("terms").alias("term")).distinct().collect()}
    assert "music" in terms and "song" not in terms and "goal" not in terms


def test_one_language_is_needed(spark, dumps, tmp_path):
    (tmp_path / "enwiki.xml").write_bytes(dump(5))
    (tmp_path / "frwiki.xml").write_bytes(dump(5))
    with pytest.raises(ValueError, match="one language"):
        jobs.article_tokens(spark, str(tmp_path))
    assert jobs.article_terms(jobs.article_tokens(spark, str(tmp_path), lang="fr")).count() == 4
