from pageloom.operators.quads import QUAD_COLUMNS, category_quads, sort_quads

PAGES = "lang string, title string, ns int, revision_id long, revision_text string"


def page(title, rev, heading_line, first, names, lang="en"):
    lines = ["filler"] * (heading_line - 1) + ["== External link =="] + [""] * (first - heading_line - 1)
    lines += [f"[[Category:{n}]]" for n in names]
    return (lang, title, 0, rev, "\n".join(lines))


def test_golden_shape(spark):
    df = spark.createDataFrame([page("Apache Spark", 720956015, 175, 186, ["Apache Software Foundation", "University of California, Berkeley"])], PAGES)
    got = [tuple(r) for r in sort_quads(category_quads(df)).collect()]
    base = "http://en.wikipedia.org/wiki/Apache_Spark?oldid=720956015#section=External_link"
    assert got == [
        ("en", "article_categories", "http://en.dbpedia.org/resource/Apache_Spark", "http://purl.org/dc/terms/subject",
         "http://en.dbpedia.org/resource/Category:Apache_Software_Foundation", f"{base}&relative-line=11&absolute-line=186", None),
        ("en", "article_categories", "http://en.dbpedia.org/resource/Apache_Spark", "http://purl.org/dc/terms/subject",
         "http://en.dbpedia.org/resource/Category:University_of_California,_Berkeley", f"{base}&relative-line=12&absolute-line=187", None),
    ]
    assert category_quads(df).columns == QUAD_COLUMNS


def test_nine_links_on_each_of_two_pages(spark):
    names = [f"name {i} (x)" for i in range(9)]
    df = spark.createDataFrame([page("Apache Spark", 1, 175, 186, names), page("Apache Hadoop", 2, 609, 620, names)], PAGES)
    assert category_quads(df).count() == 18


def test_links(spark):
    text = "[[category: foo_bar |k]] and [[Category:Second#x]] [[:Category:Mention]]\n===Deep===\n[[ Category :a?b]][[Category: ]]"
    df = spark.createDataFrame([("en", "t", 0, 1, text), ("en", "Talk:t", 1, 2, text), ("en", "empty", None, 3, "")], PAGES)
    got = {(r["value"].rsplit("Category:")[1], r["context"].split("?oldid=")[1]) for r in category_quads(df).collect()}
    assert got == {
        ("Foo_bar", "1#absolute-line=1"), ("Second", "1#absolute-line=1"),
        ("A%3Fb", "1#section=Deep&relative-line=1&absolute-line=3"),
    }


def test_namespaces_of_languages(spark):
    rows = [("de", "t", 0, 1, "[[Kategorie:x]] [[Category:y]]"), ("xx", "t", 0, 2, "[[Category:z]]"), ("fr", "t", 0, 3, "[[catégorie:w]]")]
    df = spark.createDataFrame(rows, PAGES)
    values = {r["value"].split("/resource/")[1] for r in category_quads(df).collect()}
    assert values == {"Kategorie:X", "Kategorie:Y", "Category:Z", "Catégorie:W"}
    assert category_quads(df, {"de": "Kategorie"}).count() == 2


def test_no_shuffle(spark):
    df = spark.createDataFrame([page("a", 1, 2, 3, ["x"])], PAGES)
    plan = category_quads(df)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "SinglePartition" not in plan


def test_order(spark):
    base = ("en", "d", "s", "p", "v", "c")
    df = spark.createDataFrame([("fr", *base[1:], None), (*base, "t"), (*base, None)], ", ".join(f"{c} string" for c in QUAD_COLUMNS))
    assert [tuple(r) for r in sort_quads(df).collect()] == [(*base, None), (*base, "t"), ("fr", *base[1:], None)]
