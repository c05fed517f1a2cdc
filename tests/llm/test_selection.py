"""Resampling, filter audit and license scan on hard rows and on nothing, against plain versions of what they compute."""

import hashlib
import math
import re
import zlib
from collections import Counter
from itertools import permutations

import pytest

from tabloom.llm import filter_audit, importance, licenses

from .conftest import key

SOLID = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII_LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return SOLID.findall((text or "").translate(ASCII_LOWER))


# ---- importance resampling ------------------------------------------------------------


def plain_resampling(rows, target, buckets=10_000, share=25, least=20):
    def grams(text):
        w = words(text)
        return w + [f"{a} {b}" for a, b in zip(w, w[1:])]

    def bucket(gram):
        return zlib.crc32(gram.encode()) % buckets

    ours = Counter(bucket(g) for _, t in rows for g in grams(t))
    theirs = Counter(bucket(g) for t in target for g in grams(t))
    s, t = sum(ours.values()) + buckets, sum(theirs.values()) + buckets
    out = []
    for doc, text in rows:
        gains = [math.floor(1000 * math.log((theirs[b] + 1) * s / ((ours[b] + 1) * t))) for b in map(bucket, grams(text))]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"7:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(gains), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, len(words(text))])
    fit = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for i, r in enumerate(fit[:share * len(fit) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in out), key=key)


def found_resampling(spark, docs, target, **settings):
    out = importance.resample_to_target(docs, target, **settings)
    return sorted((tuple(r) for r in out.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=key)


@pytest.mark.parametrize("share, least", [(25, 20), (60, 1), (100, 0), (0, 20)])
def test_resampling_is_the_plain_one(spark, hard_documents, share, least):
    texts = ["the cat sat on the mat", None, "", "w1 w2 w3 w3 w3", "é日本 É", "a\x00b-c_d"]
    target = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "item_id long, text string")
    rows = [(r.doc_id, r.text) for r in hard_documents.collect()]
    assert found_resampling(spark, hard_documents, target, share=share, least_words=least) == plain_resampling(rows, texts, share=share, least=least)


def test_equal_scores_go_to_the_smaller_id(spark):
    # 400 ids over 20 texts of one word each: no weight differs, so that scores tie wherever the noise does.
    docs = spark.createDataFrame([(i, "same words") for i in range(4000)], "doc_id long, text string").repartition(7)
    target = spark.createDataFrame([(1, "same words")], "item_id long, text string")
    found = found_resampling(spark, docs, target, least_words=2)
    assert found == plain_resampling([(i, "same words") for i in range(4000)], ["same words"], least=2)
    assert len({r[3] for r in found}) < 4000


def test_resampling_of_nothing(spark, hard_documents):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert found_resampling(spark, none, none) == []
    rows = [(r.doc_id, r.text) for r in hard_documents.collect()]
    assert found_resampling(spark, hard_documents, none.withColumnRenamed("doc_id", "item_id")) == plain_resampling(rows, [])


def test_spans_overlap_and_stay_between_boundaries():
    line = importance.collapsed("--A b\t\tC\x00É-d\n")
    assert line.decode() == "a b c É d"
    spans = [[m[0].decode() for m in importance.span_pattern(n).finditer(line, overlapped=True)] for n in (1, 2, 3, 5, 6)]
    assert spans == [["a", "b", "c", "É", "d"], ["a b", "b c", "c É", "É d"], ["a b c", "b c É", "c É d"], ["a b c É d"], []]


def test_many_buckets_need_wider_numbers(spark):
    rows = [(1, "a b c d e f g h"), (2, "h g f e d c b a")]
    docs, target = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert found_resampling(spark, docs, target, buckets=100_000, least_words=1, share=50) == plain_resampling(rows, ["a b c"], 100_000, 50, 1)
    with pytest.raises(ValueError):
        importance.scan_features(docs, buckets=0)


# ---- filter audit ---------------------------------------------------------------------


def plain_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, t in labels if t == 1}
    least = {}
    for doc, _, text in rows:
        if doc is not None:
            least[text or ""] = min(doc, least.get(text or "", doc))
    judged = []
    for doc, source, text in rows:
        text = text or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", text)
        upper = len(re.findall("[A-Z]", text))
        fails = {"A": len(ws) < 50, "B": 100 * len(set(ws)) < 65 * len(ws), "C": 100 * upper > 5 * len(text),
                 "D": re.search("[#$%&*|]", text) is not None, "E": doc is not None and least[text] < doc}
        judged.append((source or "", doc, {k for k, v in fails.items() if v}))
    out = {}
    for order in map("".join, permutations("ABCDE")):
        for step, k in enumerate(order, 1):
            before = set(order[:step - 1])
            for part in {p for p, _, _ in judged}:
                mine = [(d, f) for p, d, f in judged if p == part]
                removed = [d for d, f in mine if k in f and not f & before]
                out[part, order, step] = [
                    sum(not f & (before | {k}) for _, f in mine), len(removed), sum(k in f and bool(f & before) for _, f in mine),
                    sum(f == {k} for _, f in mine), sum(d in good for d in removed), sum(d in toxic for d in removed), k]
    shapley = Counter()
    for (part, _, _), r in out.items():
        shapley[part, r[6]] += r[1]
    return {k: (*r[:6], shapley[k[0], r[6]]) for k, r in out.items()}


def found_audit(docs, labels):
    rows = filter_audit.audit_filters(docs, labels).collect()
    found = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in rows}
    assert len(found) == len(rows)
    return found


def test_audit_is_the_plain_one(spark, hard_documents):
    marks = [(1, 1, 0), (4, 0, 1), (5, 1, 1), (5, 0, 0), (9, None, None), (None, 1, 1), (77, 1, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int").selectExpr("*", "toxic AS bits", "quality AS source")
    rows = [(r.doc_id, r.source, r.text) for r in hard_documents.collect()]
    clashing = hard_documents.selectExpr("*", "n_chars AS bits", "source AS part", "n_chars AS h", "n_chars AS n", "n_chars AS lots", "n_chars AS quality")
    assert found_audit(clashing, labels) == plain_audit(rows, marks)


@pytest.mark.parametrize("lots", [1, 2, 256])
def test_audit_of_copies_and_hot_texts(spark, monkeypatch, shuffled, lots):
    monkeypatch.setattr(filter_audit, "COPIES_A_TASK", lots)
    texts = ["same text", " ".join(f"w{i}" for i in range(60)), "UPPER CASE", "a|b", "", None, "x " * 70, "w " * 49, "w " * 50]
    rows = [(i % 150, f"s{i % 3}" if i % 5 else None, texts[i * i % len(texts)]) for i in range(300)]
    marks = [(i, i % 2, (i // 2) % 2) for i in range(0, 150, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    assert found_audit(docs, spark.createDataFrame(marks, "doc_id long, quality int, toxic int")) == plain_audit(rows, marks)


def test_audit_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, source string, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert found_audit(none, labels) == {}
    one = spark.createDataFrame([(1, None, None)], none.schema)
    assert found_audit(one, labels) == plain_audit([(1, None, None)], [])


# ---- license scan ---------------------------------------------------------------------


def plain_licenses(rows, templates=licenses.TEMPLATES, threshold=licenses.THRESHOLD):
    out = []
    for doc, text in rows:
        w = words(text)
        places, base = [], set()
        for phrase, label in licenses.PHRASES.items():
            p = phrase.split()
            at = [i for i in range(len(w)) if w[i:i + len(p)] == p]
            places += at
            base |= {label} if at else set()
        met, best, lo = set(), 0.0, 0
        while True:
            block = set(w[lo:lo + licenses.WIDTH])
            for label, template in templates:
                t = set(words(template))
                if 100 * len(block & t) >= threshold[0] * len(t):
                    met.add(label)
                    best = max(best, len(block & t) / len(t))
            if lo + licenses.WIDTH >= len(w):
                break
            lo += licenses.STRIDE
        out.append((doc, len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
                    ",".join(sorted(base | met)), 1.0 if places else best))
    return sorted(out, key=key)


def found_licenses(docs, **settings):
    return sorted((tuple(r) for r in licenses.scan_licenses(docs, **settings).drop("matches").collect()), key=key)


def license_rows():
    filler = [f"f{i}" for i in range(400)]
    rows = []
    for n, (_, text) in enumerate(licenses.TEMPLATES):
        near = text.replace("/", " ").split()
        for i, place in enumerate((0, 23, 24, 31, 300)):
            changed = near if i % 2 else near[1:] if len(near) > 6 else near[::-1]
            rows.append((100 * n + i, " ".join(filler[:place] + changed + filler[place:])))
        rows.append((100 * n + 50, text.upper() + "\n" + text))
        rows.append((100 * n + 51, " ".join(near[:len(near) // 2])))
    return rows


def test_license_scan_is_the_plain_one(spark, hard_documents):
    rows = license_rows() + [(r.doc_id, r.text) for r in hard_documents.collect()]
    rows += [(5, "mit license mit license"), (6, "mit"), (7, "the general public\tlicense MIT-License"), (8, "general public"), (None, "apache license")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "doc_id AS row", "text AS found", "doc_id AS block", "text AS labels", "doc_id AS n_words").repartition(5)
    want = plain_licenses(rows)
    assert found_licenses(docs) == want
    assert {label for r in want for label in r[6].split(",")} >= {label for label, _ in licenses.TEMPLATES}


@pytest.mark.parametrize("percent", [30, 60, 100])
def test_license_scan_at_other_thresholds(spark, percent):
    templates = [("x", "a b c d e"), ("y", "c d e f g h i"), ("x", "b a"), ("z", "e e e")]
    rows = [(i, " ".join("abcdefghij"[(i * j * j + j) % 10] for j in range(i % 70))) for i in range(140)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found_licenses(docs, templates=templates, threshold=(percent, 100)) == plain_licenses(rows, templates, (percent, 100))


def test_license_scan_of_nothing_and_bad_templates(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert found_licenses(none) == []
    with pytest.raises(ValueError):
        licenses.compile_templates([("x", "...")])
    with pytest.raises(ValueError):
        licenses.compile_templates([("x", "w " * 30)])


def test_matches_name_the_block(spark):
    text = " ".join(f"f{i}" for i in range(100)) + " released under the MIT license"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = licenses.scan_licenses(docs).first().matches
    assert [(m.block, m.label, m.held) for m in found] == [(3, "mit", 1.0)]
