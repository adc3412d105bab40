"""The corpus pipeline, stage by stage and as a whole, against plain Python on planted documents."""

import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from churnscope.llm import op2_minhash, op3_quality, op7_language, op8_packing
from churnscope.llm.common import shingle_hashes, word_hashes
from churnscope.llm.links import first_of_each_class
from tests.llm.helpers import DOCUMENTS, classes, jaccard, put, shingles

SYLLABLES = {"en": ["the", "and", "ing", "tion", "of", "wh", "th"], "fr": ["eau", "ou", "que", "é", "les", "oi", "ç"]}


def prose(rng, lang, count):
    """Sentences of invented words, on lines."""
    out = []
    for k in range(count):
        word = "".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4)))
        out.append(word + rng.choice([" ", " ", " ", ", ", ".\n"]) if k < count - 1 else word)
    return "".join(out)


def planted():
    """(doc_id, text, lang): prose of two languages, junk, copies, near copies, shared lines, rows without id or text."""
    rng = random.Random(12)
    rows = [(k, prose(rng, lang, rng.randrange(60, 120)), lang) for k, lang in enumerate(["en", "fr"] * 40)]
    shared = "A line that many documents have, in the same words.\n"
    rows = [(i, shared + t if i % 5 == 0 else t, lang) for i, t, lang in rows]
    rows += [(100 + k, " ".join(rng.choice(["BUY!!", "$$$", "###", "%%%", "NOW!!"]) for _ in range(60)), "en") for k in range(30)]
    rows += [(200, rows[3][1], "fr"), (201, rows[3][1], "fr"), (3, rows[3][1], "fr"), (None, rows[3][1], "fr")]  # copies, of one id, of none
    words = rows[4][1].split(" ")
    rows += [(210 + k, " ".join(["changed" if j == 30 + 7 * k else w for j, w in enumerate(words)]), "en") for k in range(2)]
    rows += [(300, None, "en"), (301, "", "en"), (302, " \n ", None), (303, "12 34 !!", "en"), (None, None, None), (None, prose(rng, "en", 80), "en"), (7, prose(rng, "fr", 80), "fr")]
    return rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    out = tmp_path_factory.mktemp("planted")
    rows = planted()
    put(spark, out, "documents", [(i, t, lang, "s", None if t is None else len(t)) for i, t, lang in rows], {"root": 1, "times": 2, "score": 3.0})
    put(spark, out, "labels", [(k, 1, 0) for k in range(0, 70)] + [(100 + k, 0, 0) for k in range(25)] + [(999, 0, 0)])
    return str(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", None if t is None else len(t)) for i, t, lang in rows], DOCUMENTS)


def kept(df):
    return sorted(((r.doc_id, r.text, r.lang) for r in df.collect()), key=repr)


def plain_language(spark, rows):
    net = op7_language.train(op7_language.sample(frame(spark, rows)))
    least = corpus_pipeline.least_probability(len(net.labels))
    told = [(i, t, lang) for i, t, lang in rows if t and any(c.isalpha() for c in t)]
    return [r for r in told if op7_language.pooled(net, [r[1].encode()])[0].max() >= least]


def plain_quality(spark, rows, folder):
    weights = op3_quality.train(op3_quality.sample(frame(spark, rows), spark.read.parquet(f"{folder}/labels.parquet")))
    return [r for r in rows if op3_quality.score(weights, r[1] or "") >= 0.7]


def plain_line_dedup(rows):
    key = lambda line: re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line).encode().lower()
    docs: dict[bytes, set] = {}
    for i, t, _ in rows:
        for line in (t or "").split("\n"):
            docs.setdefault(key(line), set()).add(i)
    often = {k for k, ids in docs.items() if k and len(ids) >= 10}
    return [(i, "\n".join(x for x in (t or "").split("\n") if key(x) not in often), lang) for i, t, lang in rows]


def plain_near_duplicates(rows):
    numbered = dict(enumerate(t for _, t, _ in rows))
    class_of = classes(numbered)
    stay: dict = {}
    for k, (i, t, _) in enumerate(rows):
        group = class_of[k][0] if shingles(t) else ("alone", i, t)
        best = stay.get(group)
        if best is None or (i is None, i) < (rows[best][0] is None, rows[best][0]):
            stay[group] = k
    return [rows[k] for k in stay.values()]


def test_each_stage(spark, folder):
    """A stage's rows are those of the plain version on the same rows."""
    rows = planted()
    stages = dict(corpus_pipeline.STAGES)
    for name, plain in (("language", lambda r: plain_language(spark, r)), ("quality", lambda r: plain_quality(spark, r, folder)),
                        ("line_dedup", plain_line_dedup), ("near_duplicates", plain_near_duplicates)):
        want = plain(rows)
        got = stages[name](spark, frame(spark, rows), folder)
        assert got.columns == corpus_pipeline.COLUMNS
        assert kept(got) == sorted(want, key=repr), name
        assert all(r.n_chars == len(r.text) for r in got.where("text IS NOT NULL").collect())
        rows = want
    assert 20 < len(rows) < len(planted())
    ids = {i for i, _, _ in rows}
    assert not ids & {200, 201, 210, 211, 300, 301, 303} and {3, 4} <= ids


def test_run_is_the_stages_in_order(spark, folder):
    rows = plain_near_duplicates(plain_line_dedup(plain_quality(spark, plain_language(spark, planted()), folder)))
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.encode_special_tokens = True
    want = sorted(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t, _ in rows)
    got = corpus_pipeline.run(spark, folder).collect()
    assert sorted(r.doc_tokens for r in got if r.start == 0) == want
    assert sum(r.length for r in got) == sum(want)
    assert sorted((r.doc_id for r in got if r.start == 0), key=repr) == sorted((i for i, _, _ in rows), key=repr)
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES] == ["language", "quality", "line_dedup", "near_duplicates", "packing"]


def test_first_of_each_class(spark):
    """Ties, repeated rows and rows without an id: one row of each class, wordless rows by themselves."""
    rows = [(5, "a"), (3, "b"), (None, "c"), (3, "b"), (3, "d"), (None, ""), (None, ""), (9, ""), (9, ""), (8, None), (8, None), (None, "e"), (None, "e")]
    roots = {"a": 1, "b": 1, "c": 1, "d": 1, "e": 2}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    named = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").rdd.map(lambda r: (r.doc_id, r.text_hash, roots.get(r.text))).collect()
    named = spark.createDataFrame(named, "doc_id long, text_hash long, root long")
    got = sorted(((r.doc_id, r.text) for r in first_of_each_class(docs, named).collect()), key=repr)
    least = min(("b", "d"), key=lambda t: spark.range(1).select(F.xxhash64(F.lit(t))).first()[0])
    assert got == sorted([(3, least), (None, "e"), (None, ""), (9, ""), (8, None)], key=repr)


# -- training and fingerprints against plain versions ----------------------------------------


def plain_ftrl(rows, epochs, seed=3):
    """Proximal follow-the-regularised-leader, one weight at a time."""
    alpha, beta, l1, l2 = op3_quality.ALPHA, op3_quality.BETA, op3_quality.L1, op3_quality.L2
    z, n = {}, {}

    def weight(k):
        if abs(z.get(k, 0.0)) <= l1:
            return 0.0
        return -(z[k] - (l1 if z[k] > 0 else -l1)) / ((beta + n[k] ** 0.5) / alpha + l2)

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for at in rng.permutation(len(rows)):
            slots, values, label = rows[at]
            w = {k: weight(k) for k in slots}
            p = 1 / (1 + np.exp(-sum(w[k] * v for k, v in zip(slots, values))))
            for k, v in zip(slots, values):
                g = (p - label) * v
                sigma = ((n.get(k, 0.0) + g * g) ** 0.5 - n.get(k, 0.0) ** 0.5) / alpha
                z[k] = z.get(k, 0.0) + g - sigma * w[k]
                n[k] = n.get(k, 0.0) + g * g
    return {k: weight(k) for k in z}


def test_ftrl_against_a_plain_version():
    rng = random.Random(2)
    samples = [(" ".join(rng.choice(["good", "bad", "word", "!!", "a a"]) for _ in range(rng.randrange(12))), rng.randrange(2)) for _ in range(60)]
    got = op3_quality.train(samples, epochs=2)
    rows = [(s.tolist(), v.tolist(), y) for t, y in samples for s, v in [op3_quality.features(t)]]
    want = plain_ftrl(rows, 2)
    assert set(np.flatnonzero(got)) <= set(want)
    assert [got[k] for k in want] == pytest.approx(list(want.values()), abs=1e-5)


def plain_fingerprint(text):
    """The least value of each hash, one shingle at a time, in Python's whole numbers."""
    shingle = [int(h) for h in shingle_hashes(word_hashes(text))]
    out = []
    for factor, offset in zip(op2_minhash._FACTOR[:, 0].tolist(), op2_minhash._OFFSET[:, 0].tolist()):
        x = min(((factor * h + offset) % 2**64 for h in shingle), default=2**64 - 1)
        x = ((x ^ (x >> 31)) * 0x9E3779B97F4A7C15) % 2**64
        x = ((x ^ (x >> 29)) * 0xD6E8FEB86659FD93) % 2**64
        out.append((x ^ (x >> 32)) >> 48)
    return out


def test_fingerprints_against_a_plain_version():
    rng = random.Random(5)
    texts = [prose(rng, "en", n) for n in (0 + 1, 3, 5, 60, 900)] + ["", "!!", "One, two; three four five six"]
    assert [op2_minhash.fingerprint(t).tolist() for t in texts] == [plain_fingerprint(t) for t in texts]
    a = prose(rng, "en", 400)
    b = a.replace(" the", " xx", 5)
    estimate = op2_minhash.likeness(op2_minhash.fingerprint(a), op2_minhash.fingerprint(b))
    assert abs(estimate - jaccard(shingles(a), shingles(b))) < 0.15


def test_packing_of_repeated_rows(spark):
    """Very many copies, of one id and of none: each row is packed by itself."""
    rows = [(1, "the same words", "en")] * 700 + [(None, "", None)] * 700
    got = op8_packing.packed_digest(spark, frame(spark, rows)).collect()
    starts = [r for r in got if r.start == 0]
    assert len(starts) == 1400 and sum(r.length for r in got) == sum(r.doc_tokens for r in starts) == 700 * 4 + 700
