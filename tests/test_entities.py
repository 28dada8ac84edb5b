import json
import random

import pytest
from pyspark.sql import functions as F

from pageloom.operators import entities as ent
from pageloom.operators.pages import split_rejects
from pageloom.sources.entities import entity_lines, read_entities


def snak(prop, data_type, kind, value):
    return {"mainsnak": {"snaktype": "value", "property": prop, "datatype": data_type, "datavalue": {"type": kind, "value": value}}}


PARIS = {
    "id": "Q90",
    "type": "item",
    "labels": {
        "en": {"language": "en", "value": "Paris"},
        "fr": {"language": "fr", "value": "Paris"},
        "ru": {"language": "ru", "value": "Париж"},
    },
    "descriptions": {
        "en": {"language": "en", "value": "capital city of France"},
        "de": {"language": "de", "value": "nur Beschreibung"},
    },
    "sitelinks": {"enwiki": {"site": "enwiki", "title": "Paris", "badges": [], "url": "https://en.wikipedia.org/wiki/Paris"}},
    "claims": {
        "P17": [snak("P17", "wikibase-item", "wikibase-entityid", {"entity-type": "item", "numeric-id": 142, "id": "Q142"})],
        "P18": [snak("P18", "commonsMedia", "string", 'a "b".jpg'), snak("P18", "commonsMedia", "string", "")],
        "P571": [snak("P571", "time", "time", {"time": "+0300", "precision": 7, "a": 1.5})],
    },
}
MIXED = {
    "id": "Q1", "type": "item", "labels": [], "descriptions": [], "sitelinks": {},
    "claims": {"P1": [
        snak("P1", "string", "string", "kept"),
        {"mainsnak": {"snaktype": "novalue", "property": "P1", "datatype": "string"}},
        snak("P1", "wikibase-item", "wikibase-entityid", {"entity-type": "item"}),
    ]},
}
ONE = {"id": "Q2", "type": "property", "labels": {"en": {"language": "en", "value": "one"}}, "claims": {"P2": [snak("P2", "string", "string", "only")]}}
NONE = {"id": "Q3", "type": "item", "labels": {"en": {"language": "en", "value": "none"}}, "descriptions": {}, "sitelinks": "odd", "claims": []}
PLAIN = '{"mainsnak":{"snaktype":"value","property":"%s","datatype":"string","datavalue":{"type":"string","value":"plain"}}}'
BAD = [
    json.dumps(PARIS)[:-7],
    "junk line " * 30,
    '{"type":"item","labels":{}}',
    '{"id":"Q9","labels":{}}',
]


@pytest.fixture(scope="module")
def parsed(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("entities") / "all.json"
    good = [json.dumps(e, ensure_ascii=False, separators=(",", ":")) for e in (PARIS, MIXED, ONE, NONE)]
    path.write_text("[\n" + ",\n".join(good + BAD) + "\n]\n\n", encoding="utf-8")
    return ent.parse_entities(read_entities(spark, str(path))).cache()


@pytest.fixture(scope="module")
def good(parsed):
    return split_rejects(parsed, "entities")[0]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_labels(good):
    assert rows(ent.entity_labels(good)) == sorted([
        ("Q90", "item", "en", "Paris", "capital city of France"),
        ("Q90", "item", "fr", "Paris", ""),
        ("Q90", "item", "ru", "Париж", ""),
        ("Q2", "property", "en", "one", ""),
        ("Q3", "item", "en", "none", ""),
    ], key=repr)


def test_labels_strict_needs_descriptions(good):
    assert {r["entity_id"] for r in ent.entity_labels(good, strict=True).collect()} == {"Q90", "Q3"}


def test_sitelinks(good):
    expected = [("Q90", "item", "enwiki", "Paris", "https://en.wikipedia.org/wiki/Paris")]
    assert rows(ent.entity_sitelinks(good)) == expected
    assert rows(ent.entity_sitelinks(good, strict=True)) == expected


def test_claims(good):
    assert rows(ent.entity_claims(good)) == sorted([
        ("Q90", "P17", "wikibase-item", "wikibase-entityid", "Q142"),
        ("Q90", "P18", "commonsMedia", "string", 'a "b".jpg'),
        ("Q90", "P18", "commonsMedia", "string", ""),
        ("Q90", "P571", "time", "time", '{"time":"+0300","precision":7,"a":1.5}'),
        ("Q1", "P1", "string", "string", "kept"),
        ("Q2", "P2", "string", "string", "only"),
    ], key=repr)


def test_claims_strict_gives_up_the_entity(good):
    assert {r["entity_id"] for r in ent.entity_claims(good, strict=True).collect()} == {"Q90", "Q2"}


def test_claim_rejects(good):
    assert rows(ent.claim_rejects(good)) == [("claims", "incomplete value", "Q1 P1"), ("claims", "novalue", "Q1 P1")]


def test_line_rejects(parsed):
    got = split_rejects(parsed, "entities")[1].collect()
    assert sorted(r["reason"] for r in got) == ["entity without id", "entity without type", "malformed line", "malformed line"]
    assert all(len(r["head"]) <= 100 for r in got)
    assert any(r["head"] == ("junk line " * 30)[:100] for r in got)


def test_brackets_commas_and_blanks(spark):
    df = spark.createDataFrame([("[",), (" ] ",), ("",), ('{"id":"Q1"}, ',), ("x",)], "value string")
    assert {r["value"] for r in entity_lines(df).collect()} == {"x", '{"id":"Q1"}'}


def test_many_labels(spark):
    entity = {"id": "Q5", "type": "item", "labels": {f"l{i}": {"language": f"l{i}", "value": str(i)} for i in range(249)}, "descriptions": {}}
    df = spark.createDataFrame([(json.dumps(entity),)], "value string")
    assert ent.entity_labels(ent.parse_entities(df)).count() == 249


def test_a_bad_member_costs_itself_only(spark):
    good = '{"mainsnak":{"snaktype":"value","property":"P1","datatype":"other","datavalue":{"type":"other","value":{"labels":[]}}}}'
    line = f'{{"id":"Q1","type":"item","labels":{{"en":{{"language":"en","value":"a"}},"fr":"bad","de":null,"es":{{"language":"es"}}}},"sitelinks":3,"claims":{{"P1":[{good},"x"],"P2":null,"P3":"junk"}}}}'
    parsed = ent.parse_entities(spark.createDataFrame([(line,)], "value string"))
    assert [r["value"] for r in ent.entity_claims(parsed).collect()] == ['{"labels":[]}']
    assert [r["label"] for r in ent.entity_labels(parsed).collect()] == ["a"]
    assert ent.entity_labels(parsed, strict=True).isEmpty() and ent.entity_claims(parsed, strict=True).isEmpty()
    assert [r["head"] for r in ent.label_rejects(parsed).collect()] == ["Q1 es"]
    faults = sorted((r["source"], r["reason"], r["head"].strip()) for r in ent.member_rejects(parsed).collect())
    assert faults == [
        ("claims", "mistyped member of claims", "Q1 P2"), ("claims", "mistyped member of claims", "Q1 P3"), ("claims", "mistyped statement", "Q1 P1"),
        ("labels", "mistyped member of labels", "Q1 de"), ("labels", "mistyped member of labels", "Q1 fr"), ("sitelinks", "sitelinks is no object", "Q1"),
    ]


def test_both_ways_of_parsing_agree(spark, monkeypatch):
    """Lines of all sorts give the same tables whether or not a well-formed one may take the short way."""
    rng = random.Random(8)
    text = lambda lang: rng.choice([f'{{"language":"{lang}","value":"v \\\\u00e9 {lang}"}}', f'{{"value":1.50,"language":"{lang}","x":[]}}', '"bad"', "null", "7", "[]", "{}"])
    value = lambda: rng.choice(['"s"', '{"b":1.0,"a":[2, 3],"labels":[]}', '{"id":"Q5","labels" : [ ]}', "12e1", "null", '" [] "', "true"])
    kind = lambda: rng.choice(["string", "wikibase-entityid", "other"])
    snak = lambda p: rng.choice([
        f'{{"mainsnak":{{"snaktype":"value","property":"{p}","datatype":"d","datavalue":{{"type":"{kind()}","value":{value()}}}}},"rank":"normal"}}',
        f'{{"mainsnak":{{"snaktype":"novalue","property":"{p}","datatype":"d"}}}}', "5", "null", '{"mainsnak":3}', "{}", '"x"',
    ])
    good = 6  # the first of the choices most of the time, so that many lines are well formed
    often = lambda make, *args: make(*args) if rng.random() < 0.25 else None

    def field(name, members):
        shape = rng.randrange(12)
        if shape < good:
            return f'"{name}":{{{members}}}'
        return {6: f'"{name}":[]', 7: f'"{name}" : [ ]', 8: None, 9: f'"{name}":null', 10: f'"{name}":{{}}', 11: f'"{name}":"odd"'}[shape]

    def line(i):
        labels = ",".join(f'"{x}":' + (often(text, x) or f'{{"language":"{x}","value":"plain"}}') for x in ("en", "de")[: rng.randrange(3)])
        links = ",".join(f'"{x}":' + rng.choice([f'{{"site":"{x}","title":"T","url":"u","badges":[]}}'] * 4 + [f'{{"site":"{x}"}}', "7", "null"]) for x in ("enwiki", "dewiki")[: rng.randrange(3)])
        claims = ",".join(
            f'"{p}":' + rng.choice([f"[{','.join(often(snak, p) or PLAIN % p for _ in range(rng.randrange(3)))}]"] * 5 + ["null", '"junk"', "{}"]) for p in ("P1", "P2")[: rng.randrange(3)]
        )
        parts = [f'"id":"Q{i}"' if i % 17 else None, '"type":"item"' if i % 19 else None, field("labels", labels), field("descriptions", labels), field("sitelinks", links), field("claims", claims), '"other":[1,{"labels":[]}]']
        rng.shuffle(parts)
        whole = "{" + ",".join(p for p in parts if p) + "}"
        return whole[: rng.randrange(len(whole))] if i % 23 == 0 else whole

    lines = spark.createDataFrame([(line(i),) for i in range(700)], "value string")
    tables = (ent.entity_labels, ent.entity_sitelinks, ent.entity_claims, ent.claim_rejects, ent.label_rejects, ent.sitelink_rejects, ent.member_rejects)

    def results():
        parsed = ent.parse_entities(lines).cache()
        kept, rejects = split_rejects(parsed, "entities")
        return [rows(t(kept)) for t in tables] + [rows(t(kept, strict=True)) for t in tables[:3]] + [rows(rejects)]

    short = results()
    assert all(short[k] for k in range(len(tables)))
    monkeypatch.setattr(ent, "_no_null_member", lambda: F.lit(False))
    long = results()
    assert [k for k in range(len(short)) if short[k] != long[k]] == [], [sorted(set(a) ^ set(b), key=repr)[:6] for a, b in zip(short, long) if a != b]


def test_well_formed_lines_take_the_short_way(spark):
    """Fields that are ``[]`` count as well formed; a value that holds such a field stays as it is."""
    line = '{"type":"item","id":"Q1","labels":[],"claims":{"P1":[%s]},"sitelinks":[ ]}' % (PLAIN % "P1").replace('"plain"', '{"labels":[],"b":1.0,"a":[2, 3]}')
    df = spark.createDataFrame([(line,)], "value string")
    assert ent._fields(df).select(ent._with_objects().alias("v")).first()["v"].count("[]") == 1
    whole = ent.bind(ent._fields(df), "t", F.from_json(ent._with_objects(), ent.TYPED_SCHEMA, ent.OPTIONS))
    assert whole.select((F.col("t.damaged").isNull() & ent._no_null_member()).alias("w")).first()["w"]
    assert [r["value"] for r in ent.entity_claims(ent.parse_entities(df)).collect()] == ['{"labels":[],"b":1.0,"a":[2,3]}']
