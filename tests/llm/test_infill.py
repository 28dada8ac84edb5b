"""Forms of infilling against a plain version of one text at a time."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from pageloom.llm import infill
from pageloom.llm.infill import fill_in_middle, gather_texts, restore, scatter_forms

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plainly(doc_id, text, rate=50, spm=80):
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    low, high = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return text, "plain", len(units), None, None
    if h4 % 100 < spm:
        return f"<S>{s}<P>{p}<M>{m}", "spm", len(units), len(p), len(m)
    return f"<P>{p}<S>{s}<M>{m}", "psm", len(units), len(p), len(m)


def check(docs, **options):
    made = fill_in_middle(docs, **options)
    rows = restore(made).collect()
    assert made.columns == [*docs.columns, *infill.NAMES]
    for r in rows:
        assert tuple(r[n] for n in infill.NAMES) == plainly(r["doc_id"], r["text"], *options.values())
        assert r["restored"] == (r["text"] or "")
    return rows


def test_table(sample):
    rows = check(sample[1])
    assert len(rows) == len(sample[0]) and {r["fim_form"] for r in rows} == {"plain", "spm", "psm"}


def test_odd_rows(odd_docs, no_docs, make_docs):
    assert len(check(odd_docs, rate=100, spm_share=50)) == odd_docs.count()
    assert check(no_docs) == []
    texts = ["<P>", "a <S> b", "<P", "M>", "<<P", " <P x>", "<M", ">", "\x85 \x1c\xa0x", "é ü  \U0001f600\t\n", " ", "\x0b\x0c", "a" * 5000, " a", "a ", "<P\n>"]
    check(make_docs([(i, t, None, None) for i, t in enumerate(texts * 5)]), rate=100, spm_share=50)


def test_windows_and_slices(make_docs, monkeypatch):
    rng = random.Random(3)
    texts = ["".join(rng.choices("ab é\n\t<P>SM", k=rng.randrange(60))) for _ in range(400)]
    monkeypatch.setattr(infill, "WINDOW", 7)
    data = [t.encode() for t in texts]
    draws = np.array([[rng.getrandbits(32) for _ in range(4)] for _ in texts])
    outputs, forms, *_ = scatter_forms(data, draws, 100, 50)
    assert gather_texts(outputs, forms) == data and len(set(forms)) == 3
    assert gather_texts([], []) == [] and scatter_forms([], np.zeros((0, 4), int), 50, 80)[0] == []


def test_clashing_names_and_broken_outputs(spark):
    docs = spark.createDataFrame([(1, "a b c", "x", 5, "old")], "doc_id long, text string, fim_form string, draw_0 int, row string")
    out = fill_in_middle(docs, rate=100)
    assert sorted(out.columns) == sorted([*docs.columns, *[n for n in infill.NAMES if n != "fim_form"]])
    r = out.first()
    assert (r["draw_0"], r["row"]) == (5, "old") and r["fim_form"] in ("psm", "spm")
    broken = spark.createDataFrame([("<P>a", "psm"), (None, "spm"), ("b", None), ("<P><S><M><M>", "psm"), ("x<P>a<S>b<M>c", "psm")], "fim_text string, fim_form string")
    assert [r["restored"] for r in restore(broken).collect()] == ["<P>a", "", "b", "<P><S><M><M>", "x<P>a<S>b<M>c"]


@pytest.mark.parametrize("copies", [1, 3])
def test_rows_of_one_id(make_docs, copies):
    docs = make_docs([(7, "one two three four", "en", "a")] * copies)
    assert fill_in_middle(docs, rate=100).select("fim_text").distinct().count() == 1
    assert fill_in_middle(docs).select(F.count("*")).first()[0] == copies
