"""Entity lines to label, site link and claim rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pageloom.functions.binding import bind
from pageloom.operators.pages import REJECT_HEAD, counted, split_rejects  # noqa: F401

# Why a line is rejected.
ENTITY_REASONS = ("malformed line", "entity without id", "entity without type")
TEXT = "struct<language: string, value: string>"
LINK = "struct<site: string, title: string, url: string>"
STATEMENT = "struct<mainsnak: struct<snaktype: string, property: string, datatype: string, datavalue: struct<type: string, value: string>>>"
NAMES = ("labels", "descriptions", "sitelinks", "claims")
# A well-formed line is parsed as it is.
TYPED_SCHEMA = f"id string, type string, labels map<string, {TEXT}>, descriptions map<string, {TEXT}>, sitelinks map<string, {LINK}>, claims map<string, array<{STATEMENT}>>, damaged string"
# Any other is taken apart step by step, so that a member of the wrong type costs itself and nothing beside it.
ENTITY_SCHEMA = "id string, type string, labels string, descriptions string, sitelinks string, claims string, damaged string"
EMPTY_FIELD = r'"(?:labels|descriptions|sitelinks|claims)"\s*:\s*\[\s*\]'
OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "damaged"}
FAULT = "array<struct<source: string, reason: string, head: string>>"


def parse_entities(lines: DataFrame) -> DataFrame:
    """``id, type, labels, descriptions, sitelinks, claims, faults, reason, head`` per line of ``value``.

    A field that is missing, null or ``[]`` is empty. A field, member or statement of another type than it should have
    is left out and named in ``faults``; all others stay, with the text of their values as it is. A line that isn't JSON
    at all is rejected. A line whose members are all of the right type is parsed once (twice with a field that is ``[]``), and only others are
    taken apart member by member.
    """
    typed = bind(_fields(lines), "t", F.from_json(_with_objects(), TYPED_SCHEMA, OPTIONS))
    whole = typed.select("value", "t", F.coalesce(F.col("t").isNotNull() & F.col("t.damaged").isNull() & _no_null_member(), F.lit(False)).alias("whole"))
    parsed = bind(whole, "e", F.when(~F.col("whole"), F.from_json("value", ENTITY_SCHEMA, OPTIONS)))
    broken = F.col("e").isNull() | (F.col("e.damaged").isNotNull() & F.try_parse_json("value").isNull())
    own = lambda n: F.when(F.col("whole"), F.col(f"t.{n}")).otherwise(F.col(f"e.{n}"))
    reason = (
        F.when(~F.col("whole") & broken, "malformed line")
        .when(own("id").isNull(), "entity without id")
        .when(own("type").isNull(), "entity without type")
    )
    members = {n: F.from_json(F.when(F.startswith(f"e.{n}", F.lit("{")), F.col(f"e.{n}")), "map<string, string>") for n in NAMES}
    head = F.when(reason.isNotNull(), F.left("value", F.lit(REJECT_HEAD))).alias("head")
    apart = F.when(~F.col("whole"), F.struct(*[members[n].alias(n) for n in NAMES]))
    first = bind(parsed.select("t", "e", "whole", own("id").alias("id"), own("type").alias("type"), reason.alias("reason"), head), "m", apart)
    kinds = {"labels": TEXT, "descriptions": TEXT, "sitelinks": LINK}
    good = {n: _parsed_members(f"m.{n}", kind) for n, kind in kinds.items()}
    good["claims"] = F.transform_values("m.claims", lambda _, v: _statements(v))
    faults = F.when(F.col("reason").isNull(), F.when(F.col("whole"), F.array().cast(FAULT)).otherwise(_faults(NAMES)))
    return first.select(
        "id", "type", *[F.when(F.col("whole"), F.col(f"t.{n}")).otherwise(good[n]).alias(n) for n in NAMES], faults.alias("faults"), "reason", "head"
    )


def _fields(lines: DataFrame) -> DataFrame:
    """``value`` with the fields ``f`` of lines that seem to have one which is ``[]``; null for all others."""
    return bind(lines.select("value"), "f", F.when(F.rlike("value", F.lit(EMPTY_FIELD)), F.from_json("value", ENTITY_SCHEMA, OPTIONS)))


def _with_objects() -> Column:
    """A line with nothing in place of its fields that are ``[]``; lines without such a field, most of them, stay as they are.

    Text that only looks like such a field may stand inside of a value, so the fields are told apart by parsing, and what they hold stays as it is.
    """
    names = F.to_json(F.struct("f.id", "f.type"))
    parts = [F.nullif(F.substring(names, F.lit(2), F.length(names) - 2), F.lit(""))]
    for n in NAMES:
        parts.append(F.when(~F.rlike(f"f.{n}", F.lit(r"^\[\s*\]$")), F.concat(F.lit(f'"{n}":'), F.col(f"f.{n}"))))
    rebuilt = F.when(F.col("f.damaged").isNull(), F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")))
    return F.when(F.col("f").isNotNull(), rebuilt).otherwise(F.col("value"))


def _no_null_member() -> Column:
    """Whether every member and statement has come out of the typed parse; a field without members has none to lose."""
    present = [F.coalesce(F.forall(F.map_values(f"t.{n}"), lambda v: v.isNotNull()), F.lit(True)) for n in NAMES[:3]]
    listed = F.forall(F.map_values("t.claims"), lambda v: F.coalesce(F.forall(v, lambda x: x.isNotNull()), F.lit(False)))
    return present[0] & present[1] & present[2] & F.coalesce(listed, F.lit(True))


def _parsed_members(field: str, kind: str) -> Column:
    return F.transform_values(F.map_filter(field, lambda _, v: _is_object(v)), lambda _, v: F.from_json(v, kind))


def _is_object(value: Column) -> Column:
    return F.coalesce(value.startswith("{"), F.lit(False))


def _listed(value: Column) -> Column:
    return F.coalesce(F.from_json(F.when(value.startswith("["), value), "array<string>"), F.array().cast("array<string>"))


def _statements(value: Column) -> Column:
    return F.transform(F.filter(_listed(value), _is_object), lambda x: F.from_json(x, STATEMENT))


def _faults(names: tuple[str, ...]) -> Column:
    """What has another type than it should have, by table."""

    def fault(source: str, reason: str, what: Column) -> Column:
        return F.struct(F.lit(source).alias("source"), F.lit(reason).alias("reason"), F.left(F.concat_ws(" ", F.col("e.id"), what), F.lit(REJECT_HEAD)).alias("head"))

    def wrong(name: str) -> Column:
        source, raw = ("labels" if name == "descriptions" else name), F.col(f"e.{name}")
        field = F.when(raw.isNotNull() & ~_is_object(raw) & ~F.rlike(raw, F.lit(r"^\[\s*\]$")), F.array(fault(source, f"{name} is no object", F.lit(""))))
        if name != "claims":
            bad = F.map_keys(F.map_filter(f"m.{name}", lambda _, v: ~_is_object(v)))
            inner = F.transform(bad, lambda k: fault(source, f"mistyped member of {name}", k))
        else:
            whole = F.map_keys(F.map_filter("m.claims", lambda _, v: ~F.coalesce(v.startswith("["), F.lit(False))))
            part = F.map_keys(F.map_filter("m.claims", lambda _, v: F.exists(_listed(v), lambda x: ~_is_object(x))))
            inner = F.concat(F.transform(whole, lambda k: fault(source, "mistyped member of claims", k)), F.transform(part, lambda k: fault(source, "mistyped statement", k)))
        none = F.array().cast(FAULT)
        return F.concat(F.coalesce(field, none), F.coalesce(inner, none))

    return F.concat(*[wrong(n) for n in names])


def _without_faults(entities: DataFrame, source: str) -> DataFrame:
    return entities.where(~F.exists("faults", lambda f: f["source"] == source)) if "faults" in entities.columns else entities


def member_rejects(entities: DataFrame) -> DataFrame:
    """Mistyped fields, members and statements: ``source, reason, head``."""
    return entities.select(F.inline("faults"))


def label_rejects(entities: DataFrame) -> DataFrame:
    """Labels without a value: ``source, reason, head``."""
    rows = entities.select("id", F.explode("labels").alias("language", "label")).where("label.value IS NULL")
    return _rejected(rows, "labels", "label without value", "language")


def sitelink_rejects(entities: DataFrame) -> DataFrame:
    """Site links without a title: ``source, reason, head``."""
    rows = entities.select("id", F.explode("sitelinks").alias("site", "link")).where("link.title IS NULL")
    return _rejected(rows, "sitelinks", "site link without title", "site")


def _rejected(rows: DataFrame, source: str, reason: str, what: str) -> DataFrame:
    head = F.left(F.concat_ws(" ", "id", what), F.lit(REJECT_HEAD))
    return rows.select(F.lit(source).alias("source"), F.lit(reason).alias("reason"), head.alias("head"))


def entity_labels(entities: DataFrame, strict: bool = False) -> DataFrame:
    """One row per label language, with the description of that language or ''.

    ``strict`` gives up all labels of an entity that has no description object or
    any label or description without language or value.
    """
    if strict:
        entities = _without_faults(entities, "labels")
        incomplete = lambda _, text: text["language"].isNull() | text["value"].isNull()
        faulty = [F.size(F.map_filter(c, incomplete)) > 0 for c in ("labels", "descriptions")]
        entities = entities.where(F.col("labels").isNotNull() & F.col("descriptions").isNotNull() & ~(faulty[0] | faulty[1]))
    rows = entities.select("id", "type", "descriptions", F.explode_outer("labels").alias("language", "label"))
    return rows.where("label.value IS NOT NULL").select(
        F.col("id").alias("entity_id"),
        F.col("type").alias("entity_type"),
        "language",
        F.col("label.value").alias("label"),
        F.coalesce(F.try_element_at("descriptions", F.col("language"))["value"], F.lit("")).alias("description"),
    )


def entity_sitelinks(entities: DataFrame, strict: bool = False) -> DataFrame:
    """One row per site link. ``strict`` gives up all links of an entity with an incomplete one."""
    if strict:
        entities = _without_faults(entities, "sitelinks")
        incomplete = lambda _, link: link["site"].isNull() | link["title"].isNull() | link["url"].isNull()
        entities = entities.where(F.size(F.map_filter("sitelinks", incomplete)) == 0)
    rows = entities.select("id", "type", F.explode_outer("sitelinks").alias("site", "link"))
    return rows.where("link.title IS NOT NULL").select(
        F.col("id").alias("entity_id"), F.col("type").alias("entity_type"), "site", "link.title", "link.url"
    )


def _snaks(entities: DataFrame) -> DataFrame:
    snak = F.explode(F.transform(F.flatten(F.map_values("claims")), lambda c: c["mainsnak"]))
    rows = entities.select(F.col("id").alias("entity_id"), snak.alias("snak"))
    kind, raw = F.col("snak.datavalue.type"), F.col("snak.datavalue.value")
    value = F.when(kind == "wikibase-entityid", F.get_json_object(raw, "$.id")).otherwise(raw)
    return rows.select(
        "entity_id",
        F.col("snak.property").alias("property_id"),
        F.col("snak.datatype").alias("data_type"),
        kind.alias("value_type"),
        value.alias("value"),
        F.coalesce("snak.snaktype", F.lit("missing snak")).alias("snaktype"),
    )


_COMPLETE = "property_id IS NOT NULL AND data_type IS NOT NULL AND value_type IS NOT NULL AND value IS NOT NULL"


def entity_claims(entities: DataFrame, strict: bool = False) -> DataFrame:
    """One row per main value: text as is, an entity's id, anything else as compact JSON.

    Claims without a value go to :func:`claim_rejects`. ``strict`` gives up all
    claims of an entity that has such a claim.
    """
    if strict:
        entities = _without_faults(entities, "claims")
        incomplete = lambda c: (
            c["mainsnak"]["property"].isNull()
            | c["mainsnak"]["datatype"].isNull()
            | c["mainsnak"]["datavalue"]["type"].isNull()
            | c["mainsnak"]["datavalue"]["value"].isNull()
            | (
                (c["mainsnak"]["datavalue"]["type"] == "wikibase-entityid")
                & F.get_json_object(c["mainsnak"]["datavalue"]["value"], "$.id").isNull()
            )
        )
        entities = entities.where(~F.exists(F.flatten(F.map_values("claims")), lambda c: F.coalesce(incomplete(c), F.lit(True))))
    return _snaks(entities).where(_COMPLETE).drop("snaktype")


def claim_rejects(entities: DataFrame) -> DataFrame:
    """Claims without a usable value: ``source, reason, head``."""
    bad = _snaks(entities).where(f"NOT ({_COMPLETE})")
    return bad.select(
        F.lit("claims").alias("source"),
        F.when(F.col("snaktype") == "value", "incomplete value").otherwise(F.col("snaktype")).alias("reason"),
        F.left(F.concat_ws(" ", "entity_id", "property_id"), F.lit(REJECT_HEAD)).alias("head"),
    )
