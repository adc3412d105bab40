"""Fingerprints, joins, line dedup and the classifiers against plain versions."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from churnscope.llm import links, op2_minhash, op3_quality, op5_chosen_path, op7_language, op9_line_dedup
from churnscope.llm.queries import queries
from tests.llm.helpers import classes, documents, jaccard, near_copies, shingles

SMALL = "/root/testdata/sf0.001"


# -- fingerprints ------------------------------------------------------------------------


def test_fingerprints_follow_the_order_of_ids(spark, tmp_path):
    rng = random.Random(1)
    ids = rng.sample(range(-500, 10_000), 300)
    texts = {i: " ".join(f"t{rng.randrange(60)}" for _ in range(rng.randrange(80))) for i in ids}
    documents(spark, tmp_path, list(texts.items()))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    ordered = sorted(ids)
    for rows_a_range in (7, 64, 1000):
        got = {r.doc_id: r for r in op2_minhash.fingerprints(docs, rows_a_range).collect()}
        assert len(got) == 300
        for k, i in enumerate(ordered):
            following = texts[ordered[(k + 1) % 300]]
            half = len(texts[i]) // 2
            edited = texts[i][: len(texts[i]) - half] + following[:half]
            assert got[i].edited == edited and got[i].n_chars == len(texts[i])
            a, b, c = (op2_minhash.fingerprint(t) for t in (texts[i], edited, following))
            assert bytes(got[i].fingerprint) == a.tobytes() and bytes(got[i].edited_fingerprint) == b.tobytes()
            assert got[i].near_edited == (a == b).mean() and got[i].near_next == (a == c).mean()


def test_likeness_estimates_jaccard():
    rng, errors = random.Random(2), []
    for _ in range(60):
        a, b = near_copies(rng, 2, 400, 40)
        errors.append(op2_minhash.likeness(op2_minhash.fingerprint(a), op2_minhash.fingerprint(b)) - jaccard(shingles(a), shingles(b)))
    assert abs(np.mean(errors)) < 0.02 and np.abs(errors).max() < 0.2
    assert op2_minhash.likeness(op2_minhash.fingerprint("a b c d e f"), op2_minhash.fingerprint("g h i j k l")) < 0.1


def _mixed_corpus(seed: int) -> list[str]:
    rng = random.Random(seed)
    out = []
    for size in (2, 3, 5, 30):
        out += near_copies(rng, size, rng.randrange(30, 120), 5)
    passage = " ".join(f"p{k}" for k in range(60))
    out += [passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 200))) for _ in range(40)]
    out += ["same text of a few words here"] * 20 + ["short one", "Short, one!", "", "one two three four five", "one two three four five six"]
    out += [" ".join(f"r{rng.randrange(10**6)}" for _ in range(50)) for _ in range(60)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("small, block", [(128, 1024), (4, 8)])
def test_chosen_path_finds_every_link(spark, tmp_path, monkeypatch, small, block):
    monkeypatch.setattr(links, "BLOCK", block)
    monkeypatch.setattr(op5_chosen_path, "SMALL_BUCKET", small)
    monkeypatch.setattr(op5_chosen_path.bucket_entries, "__defaults__", (small,))
    texts = _mixed_corpus(5)
    got = queries()["op5_chosen_path"](spark, documents(spark, tmp_path, texts)).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == classes(dict(enumerate(texts)))


def test_large_sets_are_compared_in_smaller_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(links, "BLOCK", 32)
    monkeypatch.setattr(links, "TOKENS", 64)
    rng = random.Random(9)
    texts = near_copies(rng, 24, 1500, 5) + near_copies(rng, 24, 40, 1) + [" ".join(f"r{rng.randrange(10**6)}" for _ in range(9000)) for _ in range(3)]
    held, by_group = [], links.by_group

    def seen(df, keys, *rest):
        if "tokens" in df.columns:
            sums = df.groupBy(*keys, "side").agg({"tokens": "count"}), df.selectExpr(*keys, "side", "length(tokens) DIV 8 AS n").groupBy(*keys, "side").sum("n")
            held.append([part.toPandas().iloc[:, -1].max() for part in sums])
        return by_group(df, keys, *rest)

    monkeypatch.setattr(links, "by_group", seen)
    got = queries()["op5_chosen_path"](spark, documents(spark, tmp_path, texts)).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == classes(dict(enumerate(texts)))
    [[sets, tokens]] = held
    assert 1 < sets <= 32 and tokens < 24 * 1400 / 4  # one block by the number of sets, at least a dozen by their tokens


def test_bands_find_every_link(spark, tmp_path):
    texts = _mixed_corpus(6)
    documents(spark, tmp_path, texts)
    got = op2_minhash.near_duplicates(spark.read.parquet(f"{tmp_path}/documents.parquet")).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == classes(dict(enumerate(texts)))


def test_given_documents(spark):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    got = queries()["op5_chosen_path"](spark, SMALL).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == classes({r.doc_id: r.text for r in rows})


def test_runs_reach_the_recall():
    assert op5_chosen_path.runs_for(0.999, 1) < op5_chosen_path.runs_for(0.999, 2) < op5_chosen_path.runs_for(0.999, 3)
    rng, met = np.random.default_rng(0), 0
    paths = op5_chosen_path.path_maker(0.8, op5_chosen_path.runs_for(0.999))
    for _ in range(200):
        common, a, b = rng.integers(0, 1 << 63, 160, np.uint64), rng.integers(0, 1 << 63, 20, np.uint64), rng.integers(0, 1 << 63, 20, np.uint64)
        x, y = (paths(np.unique(np.concatenate([common, own]))) for own in (a, b))
        met += bool({n for p in x for n in p["next"]} & {n for p in y for n in p["next"]})
    assert met >= 198


def test_deeper_levels_go_on_from_the_first_two():
    rng, maker, met = np.random.default_rng(1), op5_chosen_path.path_maker(0.8, op5_chosen_path.runs_for(0.999, 4)), 0
    unsigned = lambda x: np.array(x, np.int64).view(np.uint64)

    def fourth(tokens: np.ndarray) -> set[int]:
        paths = maker(tokens)
        first, second = unsigned([p["path"] for p in paths]), unsigned([n for p in paths for n in p["next"]])
        assert set(maker.below(tokens, first[:0], first).tolist()) == set(second.tolist())
        third = maker.below(tokens, second, second)
        return set(maker.below(tokens, np.concatenate([second, third]), third).tolist())

    for _ in range(100):
        common, a, b = rng.integers(0, 1 << 63, 160, np.uint64), rng.integers(0, 1 << 63, 20, np.uint64), rng.integers(0, 1 << 63, 20, np.uint64)
        x, y = (fourth(np.unique(np.concatenate([common, own]))) for own in (a, b))
        met += bool(x & y)
    assert met >= 98
    word = maker.below(np.array([7], np.uint64), np.zeros(0, np.uint64), unsigned([p["path"] for p in maker(np.array([7], np.uint64))]))
    assert not len(word)  # a path doesn't use a token twice


def test_large_buckets_of_unlike_sets_are_split_until_small(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(links, "BLOCK", 24)
    monkeypatch.setattr(op5_chosen_path.bucket_entries, "__defaults__", (8,))
    rng = random.Random(8)
    passage = " ".join(f"p{k}" for k in range(90))
    texts = [passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(rng.randrange(90, 110))) for _ in range(250)]
    texts += near_copies(rng, 40, 200, 3)
    folder = documents(spark, tmp_path, texts)
    most, split_large = {}, op5_chosen_path.split_large

    def seen(docs, sets, entries, threshold, recall):
        out = split_large(docs, sets, entries, threshold, recall)
        for name, e in (("before", entries), ("after", out)):
            unlike = op5_chosen_path.unlike_buckets(e, sets, threshold)
            most[name] = e.join(unlike, "bucket", "left_semi").agg({"members": "max"}).first()[0]
        most["alike"] = out.agg({"members": "max"}).first()[0]
        return out

    monkeypatch.setattr(op5_chosen_path, "split_large", seen)
    got = queries()["op5_chosen_path"](spark, folder).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == classes(dict(enumerate(texts)))
    assert most["before"] > 100 and (most["after"] or 0) < most["before"] / 2 and most["alike"] >= 24


def test_sketches_never_rule_out_links():
    rng = random.Random(3)
    texts = near_copies(rng, 60, 300, 8)
    tokens = [links.shingle_set(t) for t in texts]
    sketches = np.array([np.frombuffer(links.sketch(t), np.uint8) for t in tokens])
    ruled = links._unlike(sketches, 0.8)
    for a in range(60):
        for b in range(a):
            if jaccard(set(tokens[a].tolist()), set(tokens[b].tolist())) >= 0.8:
                assert not ruled[a, b]


def test_components_of_long_chains(spark):
    rng = random.Random(4)
    chain = list(range(100, 160))
    rng.shuffle(chain)
    edges = list(zip(chain, chain[1:])) + [(1, 2), (2, 3), (7, 7)]
    got = {r.node: r.root for r in links.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {k: 100 for k in range(101, 160)} | {2: 1, 3: 1}


# -- lines -------------------------------------------------------------------------------


def _drop_lines(texts: dict[int, str | None], least: int) -> dict[int, tuple[int, int, str]]:
    strip = " \t\n\x0b\x0c\r"
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    key = lambda line: line.strip(strip).translate(lower)
    split = {i: (t or "").split("\n") for i, t in texts.items()}
    found = Counter(k for lines in split.values() for k in {key(line) for line in lines} if k)
    out = {}
    for i, lines in split.items():
        kept = [line for line in lines if found[key(line)] < least]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


@pytest.mark.parametrize("batches", [1, 3, 7])
def test_line_runs(spark, tmp_path, batches):
    rng = random.Random(batches)
    lines = [f"Line {k}" for k in range(40)] + ["", "  ", "É X", "é x", " line 3\t", "LINE 4"]
    texts = {i: "\n".join(rng.choice(lines) for _ in range(rng.randrange(6))) for i in range(150)}
    texts[150] = None
    documents(spark, tmp_path, list(texts.items()))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    got = op9_line_dedup.drop_frequent_lines(docs, ["doc_id"], 10, batches).collect()
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept) for r in got} == _drop_lines(texts, 10)


def test_line_query_digests(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    plain = _drop_lines(texts, 10)
    for r in queries()["op9_line_dedup"](spark, SMALL).collect():
        lines, dropped, kept = plain[r.doc_id]
        assert (r.n_lines, r.n_dropped, r.kept_sha256) == (lines, dropped, hashlib.sha256(kept.encode()).hexdigest())


def test_a_rows_frequent_lines_are_bounded_by_its_text(spark, tmp_path, monkeypatch):
    joined, stage = [], op9_line_dedup.arrow_stage
    monkeypatch.setattr(op9_line_dedup, "arrow_stage", lambda df, fn, schema: (joined.append(df), stage(df, fn, schema))[1])
    common = [f"common line {k}" for k in range(60)]
    texts = [(i, "\n".join(common[k] for k in range(60) if (k + i) % 3)) for i in range(40)]
    own = [f"own {k}\n{common[k % 60]}\n{common[(k + 7) % 60].upper()}" for k in range(300)]
    shared = [(None, t) for t in own[:150]] + [(7000, t) for t in own[150:]] + [(None, own[0])] * 20
    folder = documents(spark, tmp_path, texts + shared)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = op9_line_dedup.drop_frequent_lines(docs, ["doc_id"]).collect()
    assert sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept) for r in got) == sorted(
        [(str(i), t.count("\n") + 1, t.count("\n") + 1, "") for i, t in texts] + [(str(i), 3, 2, t.split("\n")[0]) for i, t in shared])
    with_arrays = [df for df in joined if "frequent" in df.columns]
    assert len(with_arrays) == 1
    sizes = with_arrays[0].selectExpr("size(frequent) AS n", "size(split(text, '\n')) AS lines").where("n > lines")
    assert sizes.count() == 0


# -- classifiers ---------------------------------------------------------------------------


def test_network_gradients():
    rng = np.random.default_rng(0)
    net = op7_language.Network(rng.normal(size=(2, 256, 3, 3)), rng.normal(size=(2, 3, 3, 3)), rng.normal(size=(6, 2)), rng.normal(size=2), ["a", "b"])
    ids = rng.integers(97, 101, (4, 6))
    known = np.arange(6) < np.array([6, 3, 6, 1])[:, None]
    label = np.array([0, 1, 1, 0])
    loss, grads = op7_language.gradients(net, ids, known, label)
    for weights, grad in zip((net.table, net.inner, net.out, net.bias), grads):
        for at in rng.permutation(np.argwhere(grad != 0))[:6]:
            at, step = tuple(at), 1e-5
            weights[at] += step
            up, _ = op7_language.gradients(net, ids, known, label)
            weights[at] -= 2 * step
            down, _ = op7_language.gradients(net, ids, known, label)
            weights[at] += step
            assert abs((up - down) / (2 * step) - grad[at]) < 1e-5
    assert loss > 0


def test_every_byte_is_pooled():
    net = op7_language.train([("aaaa bbbb", "x"), ("cccc dddd", "y")], epochs=2)
    raws = [b"a" * 200, b"cd", b"abcd" * 16]
    for raw, row in zip(raws, op7_language.pooled(net, raws)):
        p = op7_language.probabilities(net, op7_language.windows(raw)).transpose(1, 0, 2).reshape(-1, 2)[: len(raw)]
        assert np.allclose(row, p.mean(axis=0), atol=1e-5)


def test_language_accuracy(spark):
    docs = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    rows = queries()["op7_language"](spark, "/root/testdata/sf0.01").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(docs) and np.mean([docs[r.doc_id].lang == r.lang_pred for r in held]) > 0.95


def test_quality_accuracy(spark):
    marks = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    rows = queries()["op3_quality"](spark, "/root/testdata/sf0.01").collect()
    held = [r for r in rows if r.held_out and marks.get(r.doc_id) is not None]
    assert len(held) > 50 and np.mean([r.predicted == marks[r.doc_id] for r in held]) > 0.95
    assert all(r.predicted == (r.score >= 0.7) and 0 <= r.score <= 1 for r in rows)


def test_labels_of_held_out_documents_are_not_learned(spark, tmp_path):
    from tests.llm.helpers import put

    folder = documents(spark, tmp_path, [f"text number {k}" for k in range(40)])
    held = [k for k in range(40) if zlib.crc32(str(k).encode()) % 4 == 2]
    put(spark, tmp_path, "labels", [(k, 1, 0) for k in held])
    assert {r.score for r in queries()["op3_quality"](spark, folder).collect()} == {0.5}


def test_labels_of_absent_documents_take_no_places(spark, tmp_path):
    from tests.llm.helpers import put

    folder = documents(spark, tmp_path, [f"text number {k}" for k in range(400)] + [(None, "without an id"), (3, "an id again")])
    put(spark, tmp_path, "labels", [(k, k % 2, 0) for k in range(20_000)] + [(None, 1, 0)])
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    got = op3_quality.sample(docs, labels, 100)
    assert Counter(label for _, label in got) == {0: 50, 1: 50}
    usable = {f"text number {k}" for k in range(400) if zlib.crc32(str(k).encode()) % 4 != 2} | {"an id again"}
    assert {text for text, _ in got} <= usable
    assert len(op3_quality.sample(docs, labels, 5000)) == len(usable)


def test_scores_are_sparse_dot_products():
    weights = op3_quality.train([("good text here and there", 1), ("bad *** stuff", 0)] * 5)
    slots, values = op3_quality.features("good stuff *** here")
    assert op3_quality.score(weights, "good stuff *** here") == pytest.approx(1 / (1 + np.exp(-(weights[slots] * values).sum())))
    assert op3_quality.score(weights, "good text here") > 0.5 > op3_quality.score(weights, "bad *** stuff")


@pytest.mark.parametrize("languages, stays", [(1, True), (2, False), (3, False), (4, False), (20, False)])
def test_guessed_languages_go_whatever_their_number(spark, tmp_path, monkeypatch, languages, stays):
    import corpus_pipeline

    guess = op7_language.Network(np.zeros((2, 256, 3, 2), np.float32), np.zeros((2, 3, 2, 2), np.float32), np.zeros((4, languages), np.float32),
                                 np.zeros(languages, np.float32), [f"l{k}" for k in range(languages)])
    monkeypatch.setattr(op7_language, "train", lambda samples: guess)
    docs = spark.read.parquet(f"{documents(spark, tmp_path, ['some text', '12', None])}/documents.parquet")
    assert [r.text for r in corpus_pipeline.language(spark, docs, str(tmp_path)).collect()] == ["some text"] * stays
    assert corpus_pipeline.least_probability(4) == pytest.approx(0.3)
