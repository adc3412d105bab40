"""Collocations, ranked search and quality rules against plain versions."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from churnscope.llm import op11_setm, op12_bpa, op13_rules
from churnscope.llm.bytewords import Words, utf8
from churnscope.llm.queries import queries
from tests.llm.helpers import documents, put

SMALL = "/root/testdata/sf0.001"
ODD = ["", None, "  ", "A b.c", "\x00\x01 a\x7fb", "ünï ÇØDÉ Ça 😀x", "a\xa0b　c", "x" * 5000, "1 2 3", ".,;", "tail ", "\tlead\n\nA a A a"]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# -- words ---------------------------------------------------------------------------------


@pytest.mark.parametrize("member, pattern", [(op12_bpa._TERM, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), (op11_setm._WORD, r"[^.,;:!?\x0A-\x0D\x20\x09]+"),
                                             (~op13_rules._BLANK, r"[^\x20\x09-\x0D]+")])
def test_words_of_columns(member, pattern):
    words = Words(*utf8(pa.array(["skipped", *ODD], pa.string())[1:]), member, lower=True)
    found = [[] for _ in ODD]
    for doc, word in zip(words.doc, words.array.to_pylist()):
        found[doc].append(word.decode())
    assert found == [re.findall(pattern, lower(t)) for t in ODD]
    code, spelling = words.codes()
    assert spelling.take(pa.array(code)).to_pylist() == words.array.to_pylist()


# -- collocations --------------------------------------------------------------------------


def plain_collocations(rows, least, reported=2000):
    counts, totals = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            counts.update((lang, tuple(w[i : i + k])) for k in range(1, 5) for i in range(len(w) - k + 1))
    found = {key: c for key, c in counts.items() if c >= least and len(key[1]) > 1}
    out = {}
    for (lang, p), a in found.items():
        longer = [c for (other, q), c in found.items() if other == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
        if any(100 * c >= 80 * a for c in longer):
            continue
        cuts = [(2_000_000 * a // (counts[lang, p[:k]] + counts[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
    return sorted((lang, rank, p.decode(), -a, l, r, totals[lang], -s) for lang, found in out.items()
                  for rank, (s, a, p, l, r) in enumerate(sorted(found)[:reported], 1))


def mined(spark, folder, least, **settings):
    rows = op11_setm.collocations(spark.read.parquet(f"{folder}/documents.parquet"), least, **settings).collect()
    return sorted((r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in rows)


def some_texts(count, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(12)] + ["Ünd", "und", "A", "a"]
    return [("".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", " \t", ". ", "\n", "  "]) for _ in range(rng.randrange(60))), rng.choice(["en", "de", None]))
            for _ in range(count)] + [(None, "en"), ("", None), ("...", "xx"), ("w1 w2 " * 3000, "en"), ("same words here", "fr"), ("same words here", "fr")]


@pytest.mark.parametrize("settings", [{}, {"block_bytes": 2000, "block": 500}, {"reported": 3}])
def test_collocations(spark, tmp_path, settings):
    rows = some_texts(150, 5)
    folder = documents(spark, tmp_path, [t for t, _ in rows], extra={"block": 1, "code": 2, "word": "x", "n": 3}, langs=[lang for _, lang in rows])
    assert mined(spark, folder, 6, **settings) == plain_collocations(rows, 6, settings.get("reported", 2000))


def test_collocations_sql(spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    assert mined(spark, SMALL, 30) == sorted(db.execute(op11_setm.OP11_SQL).fetchall())


def test_collocations_without_any(spark, tmp_path):
    folder = documents(spark, tmp_path, [None, "", "only one text"])
    assert mined(spark, folder, 30) == [] == queries()["op11_setm"](spark, folder).collect()


def test_levels_join_without_a_shuffle(spark, tmp_path):
    folder = documents(spark, tmp_path, ["a b c d"] * 40)
    tables = op11_setm.Relations(spark)
    blocks = tables.write(op11_setm.word_relation(spark.read.parquet(f"{folder}/documents.parquet"), 8), dealt=False)
    counted = tables.write(op11_setm.counted_phrases(blocks, True, 5), dealt=True)
    plan = op11_setm.next_relation(blocks, counted, 8, True)._jdf.queryExecution().executedPlan().toString()
    tables.close()
    assert "Exchange" not in plan and "FlatMapCoGroupsInArrow" in plan


# -- ranked search -------------------------------------------------------------------------


def plain_search(docs, items, top=10):
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    terms = [(i, Counter(re.findall(pattern, lower(t)))) for i, t in docs]
    n_docs, length = sum(bool(c) for _, c in terms), sum(c.total() for _, c in terms)
    df = Counter(t for _, c in terms for t in c)
    out = []
    for item, text in items:
        asked, scores = Counter(re.findall(pattern, lower(text))), []
        for doc_id, c in terms:
            score = 0
            for t in asked:
                if c[t]:
                    m = 100 - 75 + (75 * c.total() * n_docs) // length
                    score += asked[t] * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        out += [(item, rank, None if null else i, -s) for rank, (s, null, i) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=repr)


def searched(spark, docs, items, tmp_path, **settings):
    folder = documents(spark, tmp_path, docs, extra={"n": 1, "query": 2, "score": 3, "terms": "t"})
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    read = lambda name: spark.read.parquet(f"{folder}/{name}.parquet")
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in op12_bpa.search(read("documents"), read("benchmark"), **settings).collect()), key=repr)


@pytest.mark.parametrize("settings", [{}, {"block_chars": 40, "most": 150}, {"top": 2, "most": 60}])
def test_search(spark, tmp_path, settings):
    rng = random.Random(8)
    vocabulary = [f"t{int(rng.paretovariate(0.7)) % 90}" for _ in range(4000)] + ["ÉTÉ", "été", "Zz", "zZ"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    docs = [(k, text(rng.randrange(1, 80))) for k in range(200)] + [(300, None), (301, ""), (302, "!!"), (None, "t1 t2"), (None, "t1 t2"), (7, "t1 t2"), (7, "t1 t2"), (400, text(5000))]
    items = [(k, text(rng.randrange(1, 15))) for k in range(12)] + [(50, None), (51, ""), (52, "unseenterm"), (53, "t1 T1 t1"), (53, "t1 T1 t1"), (None, "t2")]
    assert searched(spark, docs, items, tmp_path, **settings) == plain_search(docs, items, settings.get("top", 10))


def test_search_sql(spark):
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    rows = [(r.item_id, r["rank"], r.doc_id, r.score) for r in queries()["op12_bpa"](spark, SMALL).collect()]
    assert sorted(rows) == sorted(db.execute(op12_bpa.OP12_SQL).fetchall())


def test_best_positions_stop_early():
    rng = np.random.default_rng(1)
    count, terms = 20_000, 3
    doc = np.repeat(np.arange(count), terms)
    impact = np.floor(1000 * rng.pareto(1.0, count * terms)).astype(np.int64) + 1
    shard = op12_bpa.Shard(np.full(count, terms), doc, np.tile(np.arange(terms), count), impact, terms)
    docs, scores, read = shard.best({0: 1, 1: 2, 2: 1}, np.arange(count), np.zeros(terms, np.int64))
    total = (impact.reshape(count, terms) * [1, 2, 1]).sum(axis=1)
    best = np.lexsort((np.arange(count), -total))[:10]
    assert docs.tolist() == best.tolist() and scores.tolist() == total[best].tolist()
    assert read < count * terms / 10


def test_equal_scores_read_on():
    """Many documents of one score: the least ids win, wherever they lie in the lists."""
    count = 5000
    ids = np.random.default_rng(2).permutation(count)
    shard = op12_bpa.Shard(np.ones(count, np.int64), np.arange(count), np.zeros(count, np.int64), np.full(count, 7), 1)
    docs, scores, _ = shard.best({0: 1}, ids, np.zeros(1, np.int64))
    assert ids[docs].tolist() == list(range(10)) and set(scores.tolist()) == {7}


# -- quality rules -------------------------------------------------------------------------


def plain_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
    covered = {k + j for k in range(len(w) - 7) if windows[tuple(w[k : k + 8])] > 1 for j in range(8)}
    lines, again = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            again += line in lines
            lines.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def repeating_texts():
    rng = random.Random(4)
    words = [f"v{k}" for k in range(30)] + ["é#", "|", "<>", "😀"]
    out = [*ODD, "a " * 50, "a\n" * 9, " a\na \na\n a", "x y z\r\nx y z\r\n", "1 2 3 4 5 6 7 8 " * 2, "1 2 3 4 5 6 7 8 9", "\n\n \n"]
    for _ in range(60):
        base = [rng.choice(words) for _ in range(rng.randrange(5, 40))]
        out.append(rng.choice([" ", "\n"]).join(base * rng.randrange(1, 4) + [rng.choice(words) for _ in range(20)]))
    return out


def test_base_counts(spark, tmp_path):
    texts = repeating_texts()
    folder = documents(spark, tmp_path, [*texts, (None, "no id")], extra={"kept": 1, "probability": 2.0, "n_words": 5, "quality": 1})
    rows = op13_rules.judge(spark.read.parquet(f"{folder}/documents.parquet"), None).collect()
    got = {r.doc_id: tuple(r[c] for c in COUNTS) for r in rows}
    assert got == {k: plain_counts(t) for k, t in [*enumerate(texts), (None, "no id")]}
    for r in rows:  # without a model the base rules decide
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and r.kept == (not r.base_failed)


def test_given_base_counts(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = queries()["op13_rules"](spark, SMALL).collect()
    assert {r.doc_id: tuple(r[c] for c in COUNTS) for r in rows} == {k: plain_counts(t) for k, t in texts.items()}
    assert all(r.kept == (not r.base_failed and r.probability >= op13_rules.KEEP) for r in rows)


def test_windows_that_share_a_hash(monkeypatch):
    monkeypatch.setattr(op13_rules, "mixed", lambda x: x % np.uint64(3))  # nearly all windows collide
    rng = random.Random(6)
    words = [rng.choice("abc") for _ in range(300)]
    texts = op13_rules.Texts(pa.array([" ".join(words), " ".join(words[:50])], pa.string()))
    assert op13_rules.base_counts(texts)["n_repeat_words"].tolist() == [plain_counts(" ".join(w))[4] for w in (words, words[:50])]


def plain_logit(text, weights, bias):
    def slot(h):
        h = ((h ^ (h >> 15)) * 0x9E3779B1) % 2**32
        return h >> (32 - op13_rules.BITS)

    import xxhash

    raw, out = (text or "").encode(), bias
    for group, n in enumerate(op13_rules.CHAR_GRAMS):
        grams = []
        for k in range(len(raw) - n + 1):
            h = n
            for b in raw[k : k + n]:
                h = (h * 0x01000193 + b) % 2**32
            grams.append(float(weights[group][slot(h)]))
        out += sum(grams) / max(1, len(grams))
    w = [(t, xxhash.xxh32_intdigest(t.encode())) for t in re.findall(r"[^\x20\x09-\x0D]+", text or "")]
    out += sum(float(weights[3][slot(h)]) for _, h in w) / max(1, len(w))
    pairs = [1 if a == b else (ha * 0x01000193 + hb * 3) % 2**32 for (a, ha), (b, hb) in zip(w, w[1:])]
    return out + sum(float(weights[4][slot(h)]) for h in pairs) / max(1, len(pairs))


def test_logits(monkeypatch):
    monkeypatch.setattr(op13_rules, "CHUNK", 37)  # n-grams across chunks
    weights = np.random.default_rng(0).normal(size=(5, 1 << op13_rules.BITS)).astype(np.float32)
    texts = repeating_texts()
    got = op13_rules.logits(op13_rules.Texts(pa.array(texts, pa.string())), weights, 0.25)
    assert np.allclose(got, [plain_logit(t, weights, 0.25) for t in texts], atol=1e-9)
    shares = [float(weights.reshape(-1)[s] @ v) + 0.25 for s, v in op13_rules.sparse_rows(op13_rules.Texts(pa.array(texts, pa.string())))]
    assert np.allclose(got, shares, atol=1e-4)


def test_calibration():
    rng = np.random.default_rng(3)
    z = rng.normal(size=4000) * 3
    labels = (rng.random(4000) < 1 / (1 + np.exp(-(0.5 * z - 1)))).astype(int)
    slope, shift = op13_rules.fit_calibration(z, labels)
    assert abs(slope - 0.5) < 0.06 and abs(shift + 1) < 0.15
    p = 1 / (1 + np.exp(-(slope * z + shift)))
    target = np.where(labels == 1, (labels.sum() + 1) / (labels.sum() + 2), 1 / ((labels == 0).sum() + 2))
    assert abs(((p - target) * z).sum()) < 1e-6 and abs((p - target).sum()) < 1e-6


def test_held_out_verdicts(spark):
    folder = "/root/testdata/sf0.01"
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    from churnscope.llm.common import held_out

    rows = [r for r in queries()["op13_rules"](spark, folder).where(held_out()).collect() if r.doc_id in marks and not r.base_failed]
    right = sum(r.kept == (marks[r.doc_id] == 1) for r in rows)
    assert len(rows) > 50 and right >= 0.95 * len(rows)


def test_one_label_only(spark, tmp_path):
    folder = documents(spark, tmp_path, [f"a text of more than twenty words number {k} " * 4 for k in range(30)])
    put(spark, folder, "labels", [(k, 1, 0) for k in range(20)] + [(None, 0, 0), (99, 0, 0), (3, None, 0)])
    assert all(0 <= r.probability <= 1 for r in queries()["op13_rules"](spark, folder).collect())
