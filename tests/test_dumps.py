import bz2
import gzip

import pytest

from pageloom.sources import dumps as d

HEAD = '<mediawiki><siteinfo><namespaces><namespace key="0"/><namespace key="14" case="first-letter">{}</namespace></namespaces></siteinfo>\n'
PAGES = "<page><title>x</title><text>" + "<namespace key=\"14\">Wrong</namespace> filler " * 50 + "</text></page>\n"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path = tmp_path_factory.mktemp("many dumps ü")
    (path / "plwiki-1.xml").write_text("<page>no header</page>")
    (path / "plwiki-2.xml").write_text(HEAD.format("Kategoria") + PAGES * 3000)
    (path / "csraw").mkdir()
    (path / "cswiki-1.xml.bz2").write_bytes(bz2.compress((HEAD.format("Kategorie") + PAGES * 100).encode()))
    (path / "elwiki").mkdir()
    (path / "elwiki" / "part 0%20.xml.gz").write_bytes(gzip.compress((HEAD.format("Κατηγορία") + PAGES * 100).encode()))
    (path / "huwiki.xml").write_text(PAGES)
    (path / "frwiki.xml").write_text("")
    (path / "itwiki.xml.gz").write_bytes(gzip.compress(HEAD.format("Categoria").encode())[:40])
    (path / "readme.txt").write_text(HEAD.format("None"))
    return str(path)


def test_names_of_all_languages(spark, folder):
    got = {r["lang"]: r["namespace"] for r in d.category_names(spark, folder).collect()}
    assert got == {"pl": "Kategoria", "cs": "Kategorie", "el": "Κατηγορία"}
    assert [tuple(r) for r in d.category_names(spark, folder, "el").collect()] == [("el", "Κατηγορία")]
    assert d.category_names(spark, folder, "xx").count() == 0


def test_only_the_first_bytes_are_read(spark, folder, monkeypatch):
    """However large a dump is, no more of it is read than its header's end, a page or the limit allows."""
    text = d.read_header(spark, f"{folder}/plwiki-2.xml")
    assert text.endswith("</siteinfo>") and len(text) < 300
    read = []
    monkeypatch.setattr(d, "HEADER_ENDS", (b"nowhere",))
    monkeypatch.setattr(d, "HEADER_BYTES", 50_000)
    read.append(d.read_header(spark, f"{folder}/plwiki-2.xml"))
    assert 40_000 < len(read[0]) <= 50_000
