from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from aeroflow.llm import language_id, queries
from aeroflow.llm.common import table
from aeroflow.llm.language_id import (
    DECLARED_STRENGTH,
    HOST_STRENGTH,
    SUFFIX_STRENGTH,
    TextModel,
    declared_language,
    host_of,
    suffix_of,
    visible_text,
)

PAGES = "page_id bigint, url string, html string"
CLASHING = PAGES + ", host string, logs string, id int, language string, declared int, soft int"


def plain_posteriors(pages: list[tuple], model: TextModel) -> list[tuple]:
    """The same for a list of ``(url, html)`` in plain Python, as a reference for small tables."""
    n = len(model.languages)
    rows = []
    for url, html in pages:
        host = host_of(url or "")
        logs = model.likelihoods(visible_text(html or ""))
        soft = np.exp(logs) / np.exp(logs).sum()
        rows.append((host, suffix_of(host), declared_language(html or ""), logs, soft))
    sums = {kind: Counter() for kind in ("suffix", "host", "declared")}
    for host, suffix, declared, _, soft in rows:
        for kind, key in (("suffix", suffix), ("host", host), ("declared", declared)):
            sums[kind][key] = sums[kind][key] + soft if key in sums[kind] else soft.copy()
    everything = np.sum([r[4] for r in rows], axis=0)
    overall = (everything + 1) / (everything.sum() + n)
    out = []
    for host, suffix, declared, logs, soft in rows:
        s = sums["suffix"][suffix]
        near = (s + SUFFIX_STRENGTH * overall) / (s.sum() + SUFFIX_STRENGTH)
        h = np.maximum(sums["host"][host] - soft, 0)
        prior = (h + HOST_STRENGTH * near) / (h.sum() + HOST_STRENGTH)
        d = sums["declared"][declared]
        said = (d + DECLARED_STRENGTH * d.sum() / everything.sum()) / (everything + DECLARED_STRENGTH)
        together = logs + np.log(said) + np.log(prior)
        share = np.exp(together - together.max())
        out.append((host, suffix, declared, model.languages[int(logs.argmax())], model.languages[int(together.argmax())], float(share.max() / share.sum())))
    return out


@pytest.fixture(scope="module")
def model(spark, sf_dir):
    return language_id.train(table(spark, sf_dir, "documents"))


def page(lang, text):
    return f'<!DOCTYPE html><html{lang}><head><title>t</title></head><body><script>var the = "der";</script><p>{text}</p></body></html>'


def awkward_pages(spark, sf_dir):
    texts = {r["lang"]: r["text"] for r in table(spark, sf_dir, "documents").where("length(text) between 300 and 900").collect()}
    rows = [(i, f"https://{'abc'[i % 3]}.example.de/x/{i}", page(' lang="de"', texts["de"])) for i in range(12)]
    rows += [
        (20, None, None), (21, "", ""), (None, None, page("", texts["en"])), (22, "no address", page(' lang="fr"', texts["fr"])),
        (23, "http://u:p@host.fr:80/", page(" lang=FR-ca", "")), (24, "https://a.example.de/", page("", "")),
        (24, "https://a.example.de/", page("", "")), (25, "http://x.com", page(' lang="en"', texts["es"] * 300)),
        (26, "http://x.com", "<<<>>> & <script>never closed"), (27, "http://only.host", page("", "ab")),
    ]
    return rows


def plain(df):
    names = ["host", "suffix", "declared", "text_language", "language"]
    return sorted((str(r["page_id"]), *(str(r[n]) for n in names), round(r["confidence"], 6)) for r in df.collect())


def expected(rows, model):
    found = plain_posteriors([(r[1], r[2]) for r in rows], model)
    return sorted((str(r[0]), *map(str, f[:5]), round(f[5], 6)) for r, f in zip(rows, found, strict=True))


def test_query_against_plain_python(spark, small_dir):
    pages = [tuple(r) for r in table(spark, small_dir, "pages").select("page_id", "url", "html").collect()]
    own = language_id.train(table(spark, small_dir, "documents"))
    assert plain(queries.op5_language_id(spark, small_dir)) == expected(pages, own)


def test_accuracy(spark, sf_dir):
    found = queries.op5_language_id(spark, sf_dir)
    wrong = found.where("language <> declared").count()
    assert wrong <= 0.01 * found.count()
    # The text alone is nearly as good: the declaration is not simply copied.
    assert found.where("text_language <> declared").count() <= 0.1 * found.count()


def test_awkward_rows(spark, sf_dir, model):
    rows = awkward_pages(spark, sf_dir)
    assert plain(language_id.languages_of(spark.createDataFrame(rows, PAGES), model)) == expected(rows, model)
    wide = spark.createDataFrame([(*r, "h", "l", 1, "x", 2, 3) for r in rows], CLASHING)
    assert plain(language_id.languages_of(wide, model)) == expected(rows, model)


def test_evidence_beats_a_wrong_declaration(spark, sf_dir, model):
    found = {r["page_id"]: r for r in language_id.languages_of(spark.createDataFrame(awkward_pages(spark, sf_dir), PAGES), model).collect()}
    assert found[25]["text_language"] == found[25]["language"] == "es"
    assert found[24]["language"] == "de"  # no text: the host decides
    assert found[23]["declared"] == "fr"


def test_empty_tables(spark, small_dir, model):
    empty = spark.createDataFrame([], PAGES)
    assert language_id.languages_of(empty, model).collect() == []
    nothing = language_id.train(table(spark, small_dir, "documents").limit(0))
    pages = spark.createDataFrame([(1, "http://a.b", "<p>x</p>")], PAGES)
    assert [r["language"] for r in language_id.languages_of(pages, nothing).collect()] == [None]
    unlabelled = table(spark, small_dir, "documents").withColumn("lang", F.lit(None).cast("string"))
    assert language_id.train(unlabelled).languages == []


def test_sample_is_bounded(spark, small_dir):
    few = language_id.train(table(spark, small_dir, "documents"), most=30)
    assert set(few.languages) <= {"de", "en", "es", "fr"}


def test_parts_of_a_page():
    assert host_of("HTTPS://User@WWW.Example.ORG:8080/a?b#c") == "www.example.org"
    assert host_of("mailto:x") is None
    assert suffix_of("a.b.fr") == "fr"
    assert declared_language("<html class='x' LANG=de-AT>") == "de"
    assert declared_language("<div lang=de>") is None
    assert visible_text("<style>p</style>a<!-- b -->c<b>d</b>").split() == ["a", "c", "d"]
