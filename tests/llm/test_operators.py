"""Every operator on hard rows and on nothing, against plain versions of what it computes."""

import hashlib
import math
import random
import re
import subprocess
import sys
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabloom.llm import attention, jaccard, language, neighbours, packing, piecewise, sentences, toxicity, warc, wavelet
from tabloom.llm.common import components, id_bucket
from tabloom.llm.tokens import TextEncoder

from .conftest import key

WORDS, BYTES, PIECES = (public_tokenizers.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
TRICKY = ["", " ", "  a  b\n\n c\t\nd ", "It's DON'T we'll ’s", "a\x00b c", "é ﬁ ΑΣ İ", "x\x1cy z\xa0 w", "\n\nfoo\n bar", "<|endoftext|> x", "日本語 テスト 123",
          "foo,bar!! ...", "a\rb\r\nc", "ǅ ß ẞ", "\nA b\nC. d", "µ ª º x_y ``` $5 -- 'tis x's", "\x00\nabc"]


def plain(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda t: tokenizer.encode(t or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, dtype="<u4").tobytes())


# ---- shared parts ---------------------------------------------------------------------


@pytest.mark.parametrize("path, word_ends", [(WORDS, True), (BYTES, False)])
def test_looked_up_ids_are_the_tokenizers(path, word_ends):
    encoder, encode = TextEncoder(path, word_ends, held=8), plain(path)
    for lo in range(0, len(TRICKY), 3):
        ids, lengths = encoder.encode(TRICKY[lo:lo + 3])
        assert [p.tolist() for p in np.split(ids, np.cumsum(lengths)[:-1])] == [encode(t) for t in TRICKY[lo:lo + 3]]


@pytest.mark.parametrize("path, word_ends", [(WORDS, True), (BYTES, False)])
@pytest.mark.parametrize("letters", ["abZéÿß\n .,!'t", "ab Zé ÿß\n\t\x00\x01\x1c\x1f\x85\xa0\u2003\u3000  \r.,!'sµªºÀ9中\u0301İΣ_~[]\\ x"])
def test_ids_of_odd_texts_are_the_tokenizers(path, word_ends, letters):
    draw, encode = random.Random(5), plain(path)
    texts = ["".join(draw.choices(letters, k=draw.randrange(25))) for _ in range(3000)]
    encoder = TextEncoder(path, word_ends, held=200)
    for lo in range(0, len(texts), 150):
        ids, lengths = encoder.encode(texts[lo:lo + 150])
        assert [p.tolist() for p in np.split(ids, np.cumsum(lengths)[:-1])] == [encode(t) for t in texts[lo:lo + 150]]
    assert [x.tolist() for x in encoder.encode([])] == [[], []]


def test_components_of_paths_stars_and_nothing(spark):
    links = [(i, i + 1) for i in range(300, 340)] + [(7, i) for i in range(8, 30)] + [(29, 300), (1, 1), (3, 2)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 7 for i in range(7, 30)}, **{i: 7 for i in range(300, 341)}, 2: 2, 3: 2}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- embeddings -----------------------------------------------------------------------


def test_near_links_are_those_of_brute_force(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 40)
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(6, 16))
    x = np.concatenate([centre[0] + 0.03 * rng.normal(size=(90, 16)), centre[1] + 0.2 * rng.normal(size=(60, 16)), rng.normal(size=(150, 16)), centre[2:4], centre[2:4], 3 * centre[2:3]])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(900, None), (901, [0.0] * 16), (902, [float("nan")] + [1.0] * 15), (903, [None] + [1.0] * 15), (904, []), (None, x[0].tolist())]
    found = neighbours.near_links(spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("node", F.lit(1)))
    unit = np.concatenate([x, x[:1]])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    part = np.arange(len(unit))
    while True:
        new = np.array([min(part[i], part[near[i]].min(initial=part[i])) for i in range(len(unit))])
        if (new == part).all():
            break
        part = new
    want = [(i if i < len(x) else None, int(near[i].sum()), int(part[i]), i == part[i]) for i in range(len(unit))] + [(k, 0, k, True) for k in range(900, 905)]
    assert sorted(map(tuple, found.collect()), key=key) == sorted(want, key=key)


def test_the_audit_leaves_out_the_pair_of_a_vector_with_itself(spark):
    at = lambda i, angle: [math.cos(angle) if k == i else math.sin(angle) if k == i + 100 else 0.0 for k in range(200)]
    # A hundred queries; the first two have a partner each, of which one is in the same group.
    rows = [(50 * i, at(i, 0.0)) for i in range(100)] + [(50 * i + 1, at(i, 0.1)) for i in range(2)]
    units = neighbours.unit_vectors(spark.createDataFrame(rows, "key long, vector array<double>"), "key", "vector").checkpoint()
    node = {r["key"]: r["node"] for r in units.collect()}
    groups = spark.createDataFrame([(node[k], node[0]) for k in (0, 1)], "node long, component long")
    assert tuple(neighbours._audit(units, neighbours._packed(units), groups, 200, 0.95)) == (1, 1, 0.5)


def test_cells_are_met_often_enough_whatever_their_number():
    for bits in range(0, 25):
        missed = (1 - (1 - math.acos(0.95) / math.pi) ** bits) ** neighbours._trees(bits, 0.95)
        assert missed <= 1 - neighbours.RECALL + 1e-12
    assert neighbours._trees(9, 0.95) == 10


def test_the_search_goes_on_below_the_recall_and_fails_where_it_finds_no_more(spark, monkeypatch):
    vectors = spark.createDataFrame([(i, [1.0, i / 10]) for i in range(4)], "vec_id long, embedding array<double>")
    graph = spark.createDataFrame([], "node long, size int, list array<struct<far: double, other: long>>")
    seen = []

    def audit(*_):
        seen.append(1)
        return misses[len(seen) - 1]

    monkeypatch.setattr(neighbours, "_best", lambda edges, size: graph)
    monkeypatch.setattr(neighbours, "_descend", lambda graph, *_: graph)
    monkeypatch.setattr(neighbours, "_audit", audit)
    monkeypatch.setattr(neighbours, "TREES", 1 << 20)
    monkeypatch.setattr(neighbours, "_by_group", lambda *_: spark.createDataFrame([], "node long, other long, sim double"))
    monkeypatch.setattr(neighbours, "_trees", lambda *_: 1)
    misses = [(50, 50 - i, 0.5) for i in range(5)] + [(99, 1, 0.99)]
    found = neighbours.near_links(vectors)
    assert len(seen) == 6
    assert found.schema["n_links"].metadata == {"audit_found": 99, "audit_missed": 1, "audit_recall": 0.99}
    seen, misses = [], [(50, 50, 0.5)] * 9
    with pytest.raises(RuntimeError, match="recall 0.5000"):
        neighbours.near_links(vectors)
    assert len(seen) == 3


def test_near_links_of_nothing(spark):
    assert neighbours.near_links(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


# ---- token shards ---------------------------------------------------------------------


def test_wavelet_matrix_access_count_and_find():
    values = np.random.default_rng(0).integers(0, 70_000, 3000).astype(np.uint32)
    values[::7] = 5
    matrix = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(values).to_bytes())
    assert (matrix.values() == values).all() and [matrix.access(i) for i in range(0, 3000, 97)] == values[::97].tolist()
    for v in (5, int(values[1]), 131_071, 1 << 20):
        places = np.flatnonzero(values == v)
        assert matrix.count(v) == len(places) and matrix.count(v, 1500) == (places < 1500).sum()
        assert [matrix.find(v, k) for k in range(0, len(places), 50)] == places[::50].tolist()
    with pytest.raises(IndexError):
        matrix.find(5, 10_000)
    assert wavelet.WaveletMatrix.build(np.zeros(0)).values().tolist() == []


def test_token_shards_hold_all_documents_in_order(spark, hard_documents, tmp_path):
    shards = wavelet.write_tokens(hard_documents, str(tmp_path), WORDS, shard_tokens=50)
    assert shards.count() > 3
    found = sorted(((r.start, r.doc_id, r.n_tokens, zlib.crc32(bytes(r.ids))) for r in wavelet.read_tokens(shards).collect()))
    encode, start, want = plain(WORDS), 0, []
    rows = sorted(((r.doc_id, r.text or "") for r in hard_documents.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    for doc_id, text in rows:
        ids = encode(text) + [1]
        want.append((start, doc_id, len(ids), crc(ids)))
        start += len(ids)
    assert found == want
    assert wavelet.token_round_trip(hard_documents.limit(0), WORDS).count() == 0


# ---- segmentation ---------------------------------------------------------------------


def test_n_best_segmentations_are_those_of_brute_force():
    encoder = sentences.SentenceEncoder(PIECES)
    lattice = encoder.lattice

    def brute(text):
        out = []

        def extend(i, score, n):
            if i == len(text):
                out.append(score)
            for k in range(1, min(lattice.longest, len(text) - i) + 1):
                piece = lattice.ids.get(text[i:i + k], -1)
                if piece >= 0 or k == 1:
                    extend(i + k, score + (float(lattice.scores[piece]) if piece >= 0 else lattice.unknown), n + 1)

        extend(0, 0.0, 0)
        return sorted(out, reverse=True)

    rng = random.Random(1)
    for _ in range(80):
        text = "".join(rng.choice("the an é\nq日") for _ in range(rng.randint(0, 9)))
        found = encoder.encode([text], 4)[0]
        assert [s for s, _ in found] == pytest.approx(brute(lattice.normal(text))[:4])
        assert len({ids for _, ids in found}) == len(found) and {lattice.decode(ids) for _, ids in found} == {text}


def test_segmentations_decode_to_the_text(spark, hard_documents):
    rows = sentences.segment_documents(hard_documents, PIECES, 3).collect()
    texts = Counter((r.doc_id, r.text or "") for r in hard_documents.collect())
    assert Counter((r.doc_id, r.text) for r in rows if r["rank"] == 0) == texts
    assert all(r.text in {t for _, t in texts} for r in rows)
    assert sentences.segment_documents(hard_documents.limit(0), PIECES).count() == 0


# ---- archives -------------------------------------------------------------------------


def test_archives_hold_every_page_and_name_its_first_copy(spark, tmp_path):
    rows = [(1, "http://a/1", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "http://a/ b\r\nc", None), (4, "http://a/4", ""), (4, "http://a/4", ""), (None, "u", ""), (5, "u", "x" * 400_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    bundles = warc.write_warc(pages, str(tmp_path), frame_bytes=300)
    found = warc.read_warc(bundles)
    first = {}
    for page_id, _, html in rows:
        first[html or ""] = max(first.get(html or "", page_id or -1), page_id or -1)
    want = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        leads = page_id == first[html or ""]
        want.append((page_id, len(data), warc.digest_of(data), "response" if leads else "revisit", None if leads else first[html or ""]))
    got = found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    for r in bundles.collect():
        with open(r.bundle, "rb") as source:
            reader = warc.BundleReader(source)
            assert len(reader.index) == r.n_records
            assert all(reader.record(i).startswith(b"WARC/1.1") for i, *_ in reader.index)
    assert warc.warc_round_trip(pages.limit(0)).count() == 0
    assert {r.record_type for r in warc.warc_round_trip(pages.filter("page_id < 5"), min_bytes=100).collect()} == {"response"}


# ---- packing --------------------------------------------------------------------------


def test_bin_completion_needs_no_more_than_brute_force():
    def brute(items, capacity):
        best = len(items)

        def place(i, rooms):
            nonlocal best
            if len(rooms) >= best:
                return
            if i == len(items):
                best = len(rooms)
                return
            for b in {r: k for k, r in enumerate(rooms) if r >= items[i]}.values():
                place(i + 1, [r - items[i] * (k == b) for k, r in enumerate(rooms)])
            place(i + 1, [*rooms, capacity - items[i]])

        place(0, [])
        return best

    rng = random.Random(3)
    for _ in range(120):
        items = sorted((rng.randint(5, 60) for _ in range(rng.randint(1, 9))), reverse=True)
        plan = packing.bin_completion(Counter(items), 100)
        assert Counter(n for f, c in plan for n in f * c) == Counter(items) and all(sum(f) <= 100 for f, _ in plan)
        want = brute(items, 100)
        assert sum(c for _, c in plan) == want >= packing.lower_bound(Counter(items), 100)
    assert packing.bin_completion({}, 100) == []


def test_packed_sequences_are_gapless_and_hold_every_id(spark, hard_documents):
    packed = packing.pack_documents(hard_documents, BYTES, 64)
    rows = packed.collect()
    encode = plain(BYTES)
    want = Counter()
    for r in hard_documents.collect():
        ids = encode(r.text) + [0]
        first = len(ids) % 64 or 64
        cuts = [0, *range(first, len(ids), 64), len(ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[r.doc_id, k, a, b - a, crc(ids[a:b])] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, zlib.crc32(bytes(r.ids))) for r in rows) == want
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by_sequence.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))] and sum(n for _, n in parts) <= 64
    assert len(by_sequence) == packing.lower_bound(Counter(r.length for r in rows), 64)
    assert {r.length for r in packing.sequences(packed).collect()} <= set(range(1, 65))
    assert packing.pack_documents(hard_documents.limit(0), BYTES).count() == 0


# ---- fingerprints ---------------------------------------------------------------------


def test_common_symbols_is_the_longest_common_subsequence():
    def plain_length(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            row = _next(row, x, b)
        return row[-1]

    def _next(row, x, b):
        out = [0]
        for j, y in enumerate(b):
            out.append(row[j] + 1 if x == y else max(row[j + 1], out[j]))
        return out

    rng = random.Random(1)
    pairs = [("".join(rng.choices("abcd", k=rng.randint(0, 64))), "".join(rng.choices("abcd", k=rng.randint(0, 64)))) for _ in range(60)]
    assert piecewise.common_symbols(*map(list, zip(*pairs))).tolist() == [plain_length(a, b) for a, b in pairs]


def test_fingerprints_follow_the_order_of_documents(spark, hard_documents):
    found = piecewise.fingerprint_documents(hard_documents.repartition(5)).collect()
    rows = sorted(((r.doc_id, r.text or "") for r in hard_documents.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]), reverse=True)
    want = []
    for (doc_id, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        changed = piecewise.edited(text, after)
        a, b, c = map(piecewise.fingerprint, (text, changed, after))
        want.append((doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), a, b, *piecewise.likeness([a, a], [b, c]).tolist()))
    assert sorted(map(tuple, found), key=key) == sorted(want, key=key)
    assert piecewise.fingerprint_documents(hard_documents.limit(0)).count() == 0
    one = piecewise.fingerprint_documents(hard_documents.filter("doc_id = 1")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0


def test_fingerprints_of_zero_bytes_come_to_an_end():
    script = "from tabloom.llm import piecewise as p; print(p.fingerprint(chr(0) * 1000), p.fingerprint('some text ' + chr(0) * 1000 + ' and more'))"
    out = subprocess.run([sys.executable, "-c", script], capture_output=True, text=True, timeout=60, check=True).stdout.split()
    assert [len(x) for x in out[0].split(":")] == [1, 1, 1] and out[0].startswith("3:") and out[1] != out[0]


def test_fingerprint_of_an_edit_stays_near_and_of_another_text_does_not():
    rng = random.Random(2)
    a, b = (" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(500)) for _ in range(2))
    near, far = piecewise.likeness([piecewise.fingerprint(a)] * 2, [piecewise.fingerprint(piecewise.edited(a, b)), piecewise.fingerprint(b)])
    assert near > 0.5 > 0.35 > far


# ---- n-gram join ----------------------------------------------------------------------


def _components(rows, k=5):
    sets = []
    for _, text in rows:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
        sets.append({tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else {tuple(words)} if words else set())
    part = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and b and 100 * len(a & b) >= 75 * len(a | b):
                    part[i] = part[j] = min(part[i], part[j])
    least = {}
    for (d, _), p in zip(rows, part):
        least[p] = d if least.get(p) is None else least[p] if d is None else min(least[p], d)
    return [(d, len(s), least[p]) for (d, _), s, p in zip(rows, sets, part)]


def test_components_are_those_of_brute_force(spark, hard_documents, monkeypatch):
    monkeypatch.setattr(jaccard, "TREE_TOKENS", 300)
    monkeypatch.setattr(jaccard, "BLOCK_TOKENS", 500)
    monkeypatch.setattr(jaccard, "BUCKET_TOKENS", 400)
    rng = random.Random(5)
    base = [[f"v{rng.randrange(10**6)}" for _ in range(rng.choice([8, 40, 120]))] for _ in range(6)]
    rows = [(r.doc_id, r.text) for r in hard_documents.collect()]
    for i in range(60):
        words = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = f"n{rng.randrange(10**6)}"
        rows.append((100 + i, " ".join(words + ["shared passage of words that many documents hold"] * (i % 2))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("class", F.lit("x"))
    assert sorted(map(tuple, jaccard.ngram_components(docs).collect()), key=key) == sorted(_components(rows), key=key)
    assert jaccard.ngram_components(docs.limit(0)).count() == 0


# ---- classifiers and language model ---------------------------------------------------


def test_toxicity_gradients_are_those_of_differences():
    net, rng = toxicity.ToxicityNet.new(1), np.random.default_rng(0)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    vectors, words = rng.normal(size=(9, toxicity.WIDTH)), rng.integers(0, 9, (5, 4))
    mask, target = np.ones((5, 4), bool), np.array([1, 0, 1, 0.0])
    mask[3:, 1] = False

    def loss():
        table = net.inputs(vectors)
        logit = net.logits({way: table[way][words] for way in "fb"}, mask)
        return np.mean(np.log1p(np.exp(-logit * (2 * target - 1))))

    found, _ = net.gradients(vectors, words, mask, target, np.ones(4))
    for name in ("rec_f", "rec_b", "in_f", "gate_b", "attend", "out"):
        at = tuple(rng.integers(0, s) for s in net.p[name].shape)
        kept, sides = net.p[name][at], []
        for step in (1e-3, -1e-3):
            net.p[name][at] = kept + step
            sides.append(loss())
        net.p[name][at] = kept
        assert (sides[0] - sides[1]) / 2e-3 == pytest.approx(found[name][at], rel=0.02, abs=1e-5)


def test_toxicity_is_learned_from_words_and_scored_in_every_window(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["house", "tree", "river", "stone", "cloud"]) for _ in range(rng.randint(5, 90))) for _ in range(120)]
    marks = [i % 3 == 0 for i in range(120)]
    texts = [t + " vileword " + t if m else t for t, m in zip(texts, marks)]
    net = toxicity.fit_toxicity(texts, [int(m) for m in marks], steps=300)
    scorer = toxicity.ToxicityScorer(net)
    clean = " ".join(["river stone"] * 2000)
    scores = scorer.scores([clean, clean + " vileword " + clean, "", "   "])
    assert scores[0] < 0.3 <= scores[1] and scores[2] == scores[3] < 0.3


def test_toxicity_of_hard_rows(spark, hard_documents, labels):
    texts, marks = toxicity.labelled_sample(hard_documents, labels, F.lit(True), chars=1000)
    assert len(texts) == len(marks) and set(marks) <= {0, 1}
    rows = toxicity.score_toxicity(hard_documents, toxicity.fit_toxicity(texts, marks, epochs=2, steps=2)).collect()
    assert len(rows) == 12 and all(0 <= r[-2] <= 1 and r[-1] == int(r[-2] >= 0.3) for r in rows)
    assert toxicity.score_toxicity(hard_documents.limit(0), toxicity.fit_toxicity([], [])).count() == 0


@pytest.mark.parametrize("n", [0, 1, wavelet.STEP - 1, wavelet.STEP, wavelet.STEP + 1, 2 * wavelet.STEP + 3])
def test_wavelet_planes_are_parted_in_steps(n):
    for top in (2, 300, 70_000):
        values = np.random.default_rng(n).integers(0, top, n).astype(np.uint32)
        matrix = wavelet.WaveletMatrix.from_bytes(wavelet.WaveletMatrix.build(values).to_bytes())
        assert (matrix.values() == values).all()
        for level, (plane, zero) in enumerate(zip(matrix.planes, matrix.zeros)):
            bits = (values >> (len(matrix.planes) - 1 - level)) & 1
            assert zero == (bits == 0).sum()
            assert (np.unpackbits(plane, count=n, bitorder="little") == bits).all()
            values = values[np.argsort(bits, kind="stable")] if level < len(matrix.planes) - 1 else values
        if n:
            assert matrix.access(n - 1) == matrix.values()[n - 1]


def test_attention_scores_each_id_once_and_sums_to_one():
    net, rng = attention.AttentionLM.new(50, 1), np.random.default_rng(0)
    net.experts = (net.experts / net.experts.sum(axis=0)).astype(np.float32)
    ids = rng.integers(0, 50, (2, 9))
    assert (net.gates(ids) @ net.experts.T).sum(axis=2) == pytest.approx(1, abs=1e-4)
    later = ids.copy()
    later[:, 5:] = 1
    assert net.gates(ids)[:, :5] == pytest.approx(net.gates(later)[:, :5], abs=1e-5)
    for n in (1, 47, 48, 49, 87, 88, 89, 500):
        given, target, scored, = attention.windows(np.arange(n))[:3]
        assert target[scored].tolist() == list(range(n))


def test_attention_base_scores_are_those_of_counts(spark, hard_documents):
    found = attention.score_documents(hard_documents, WORDS).collect()
    tokens = [(r.doc_id, [*re.findall(rb"[^\x20\x09-\x0D]+", (r.text or "").encode().lower()), b""]) for r in hard_documents.collect()]
    out = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 1
    counts = Counter(w for d, ws in tokens if not out(d) for w in ws)
    n, v = sum(counts.values()), len(counts)
    want = [(d, out(d), len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 4)) for d, ws in tokens]
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in found]
    assert sorted(got, key=key) == sorted(want, key=key) and all(r.score < 0 and math.isfinite(r.score) for r in found)
    assert attention.score_documents(hard_documents.limit(0), WORDS).count() == 0


def test_attention_windows_overlap_by_sixteen_ids():
    given, target, scored = attention.windows(np.arange(1000))[:3]
    first = scored.argmax(axis=1)[1:]
    assert given.shape[1] == 64 and (first >= 16).all()


def test_attention_learns_contexts_from_texts_outside_the_sample(spark, monkeypatch):
    monkeypatch.setattr(attention, "training_sample", lambda *_: ["red green blue red green blue"])
    words, rng = ["red", "green", "blue"] * 200, random.Random(1)
    mixed = rng.sample(words, len(words))
    held, first, second = [next(i for i in range(99) if (zlib.crc32(str(i).encode()) % 5 == 1) == out and i > after) for out, after in ((True, 0), (False, 0), (False, 20))]
    score = {}
    for name, text in (("same", words), ("mixed", mixed)):
        rows = [(held, "red green blue"), (first, "red green blue"), (second, " ".join(text))]
        found = attention.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), WORDS).collect()
        score[name] = {r["doc_id"]: (r["base_score"], r["score"]) for r in found}[held]
    assert score["same"][0] == score["mixed"][0]
    assert abs(score["same"][1] - score["mixed"][1]) > 1e-4


def test_attention_weights_are_learned_from_all_training_texts(spark, monkeypatch):
    fitted = attention.fit_attention

    def contextless(sequences, overall, *args, **kwargs):
        net = fitted(sequences, overall, *args, **kwargs)
        net.p["embed"][:] = 0
        return net

    monkeypatch.setattr(attention, "fit_attention", contextless)  # the first weights see no context, so any that do come from the pass
    out = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5 == 1][:2]
    rows = [(i, " ".join(["red", "green", "blue"] * 60)) for i in range(200) if zlib.crc32(str(i).encode()) % 5 != 1]
    rows += [(out[0], " ".join(["red", "green", "blue"] * 20)), (out[1], " ".join(["red"] * 20 + ["green"] * 20 + ["blue"] * 20))]
    found = attention.score_documents(spark.createDataFrame(rows, "doc_id long, text string").coalesce(2), WORDS)
    score = {r["doc_id"]: r["score"] for r in found.collect()}
    assert score[out[0]] > score[out[1]] + 0.05


def test_attention_gradients_are_those_of_the_loss():
    net, rng = attention.AttentionLM.new(40, 3), np.random.default_rng(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    given, target, scored, _ = attention.windows_of_all(rng.integers(0, 40, 150), np.array([1, 89, 60]))
    given = np.where(given == attention.START, 0, given)
    for chosen, first in attention.batches_of(scored, 9):
        on = scored[chosen].astype(np.float64)
        loss = lambda: -(net.log_probability(given[chosen], target[chosen], first) * on[:, first:]).sum() / on[:, first:].sum()
        found, _, at_first = net.gradients(given[chosen], target[chosen], on, first)
        assert at_first == pytest.approx(loss(), rel=1e-4)
        for name, place in (("query", (3, 4)), ("key", (5, 6)), ("value", (1, 2)), ("seen", (2, 3)), ("own", (7, 8)), ("near", 3), ("gates", (2, 5)), ("bias", 4)):
            held, step = net.p[name][place], 1e-3
            net.p[name][place] = held + step
            above = loss()
            net.p[name][place] = held - step
            slope = (above - loss()) / (2 * step)
            net.p[name][place] = held
            assert found[name][place] == pytest.approx(slope, rel=0.05, abs=2e-5), name


def test_attention_sums_rows_of_equal_ids():
    rng = np.random.default_rng(2)
    for ids in (np.zeros(0, np.int64), np.array([7]), np.full(37, 5), rng.integers(0, 9, 400), rng.permutation(50)):
        values, same = rng.normal(size=(len(ids), 3)), attention.Same(ids)
        want = np.zeros((60, 3))
        np.add.at(want, ids, values)
        assert same.ids.tolist() == sorted(set(ids.tolist())) and (same.ids[same.of] == ids).all()
        assert same.sums(values.copy()) == pytest.approx(want[same.ids])


def test_attention_projects_each_id_once(monkeypatch):
    net, rng = attention.AttentionLM.new(50, 1), np.random.default_rng(0)
    net.p["query"] *= 40  # products beyond the bound of the exponent
    lengths = np.array([1, 700, 49])
    ids = rng.integers(0, 30, lengths.sum())
    monkeypatch.setattr(attention, "START", 49)
    given, target, scored, at = attention.windows_of_all(ids, lengths)
    want = np.zeros(len(ids))
    for g, t, on, places in zip(given, target, scored, at):
        want[places[on]] = net.log_probability(g[None], t[None])[0][on]
    projected, rows = attention.AttentionLM.projected, []
    monkeypatch.setattr(attention.AttentionLM, "projected", lambda self, ids: (rows.append(len(ids)), projected(self, ids))[1])
    assert attention.log_probabilities(net, ids, lengths, 4) == pytest.approx(want, abs=1e-4)
    assert rows == [len(np.unique(given))]


def test_the_attention_sample_stands_in_the_order_of_its_hash(spark):
    docs = spark.range(200).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text"))
    hashed = [r["text"] for r in docs.orderBy(F.xxhash64("doc_id")).limit(50).collect()]
    assert attention.training_sample(docs, F.lit(True), 50) == hashed


def test_language_of_hard_rows(spark, hard_documents):
    model = language.fit_languages(hard_documents)
    assert model.languages == ("de", "en", "fr")
    rows = language.predict_language(hard_documents, model, ["doc_id", "score"]).collect()
    by_id = {r.doc_id: r for r in rows}
    assert all(by_id[d].lang_pred == "und" and by_id[d][3] == 0 for d in (2, 3, 7, 8))
    assert by_id[9].lang_pred == "fr" and by_id[4].lang_pred == "en"
    nothing = language.fit_languages(hard_documents.limit(0))
    assert {r.lang_pred for r in language.predict_language(hard_documents, nothing, ["doc_id"]).collect()} == {"und"}


def test_language_is_that_of_plain_counting(spark):
    rng = random.Random(0)
    rows = [(i, " ".join("".join(rng.choices(s, k=5)) for _ in range(20)), name) for i, (s, name) in enumerate([("abcde", "x"), ("defgh", "y")] * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language.predict_language(docs, language.fit_languages(docs, id_bucket("doc_id", 4) != 2), ["doc_id", "lang"]).collect()
    assert all(r.lang == r.lang_pred for r in found)


def test_unit_vectors_of_any_width_and_broken_ones(spark):
    rng = np.random.default_rng(5)
    good = [rng.normal(size=n).tolist() for n in (1, 3, 256, 256, 1024)] + [[1e300, -1e300], [5e-324, 0.0]]
    broken = [None, [], [0.0, 0.0], [1.0, None], [1.0, float("nan")], [float("inf"), 1.0]]
    rows = [(i, v) for i, v in enumerate(good + broken + good[:1])]
    found = {r.key: r for r in neighbours.unit_vectors(spark.createDataFrame(rows, "id int, v array<double>"), "id", "v").collect()}
    assert len(found) == len(rows)
    for i, v in enumerate(good):
        x = np.array(v) / np.abs(v).max()
        assert np.allclose(found[i].unit, x / np.linalg.norm(x), rtol=1e-12, atol=0)
    assert all(found[len(good) + i].unit is None and found[len(good) + i].node is None for i in range(len(broken)))
    assert found[len(rows) - 1].node == found[0].node
    assert neighbours.unit_vectors(spark.createDataFrame([], "id int, v array<float>"), "id", "v").count() == 0
