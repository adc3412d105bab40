"""Pages, vectors, records, packing and encoding against plain versions and the public libraries."""

import base64
import hashlib
import html
import random
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from churnscope.llm import merges, op1_html, op4_onebit, op6_fixity, op8_packing, op10_bpe, pieces
from churnscope.llm.queries import queries
from tests.llm.helpers import documents, put

SMALL = "/root/testdata/sf0.001"
ODD = ["", " ", "a" * 700, "é" * 300 + "ñ", "ab" * 150, "don't I'LL we've 'S", "\x00\x01 \x7f", "a　 b\xa0 c \x1c d", "x\x1cy <|endoftext|> z",
       " a  b ", "x \ny\n z\t", "ΑΣ İ ǅ", "á ́b", "😀 𝒳 é​f﻿g", "1234 ½ ² Ⅷ", "a\r\n\r\n  b", "   "]


# -- pages -------------------------------------------------------------------------------


def test_given_pages(spark):
    pages = {r.page_id: r for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    rows = queries()["op1_html"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*)</article>", pages[r.page_id].html, re.S)[1]
        parts = (" ".join(html.unescape(x).split()) for x in re.split(r"</?(?:h1|p|b|br)>", article))
        assert r.text == "\n".join(x for x in parts if x) and r.n_chars == len(r.text)


ARTICLE = "<h1>A title</h1><p>First paragraph, with commas, and enough words to count.</p><p>Second one, as long as the first, more or less.</p>"
PLAIN = "A title\nFirst paragraph, with commas, and enough words to count.\nSecond one, as long as the first, more or less."
NOISE = "<p>Noise, in a block, with commas, and as many words as any paragraph, or more of them, so that it scores.</p>"


@pytest.mark.parametrize("around", [
    "<header><h2>Site</h2>{n}</header><main>{a}</main>", "<div class='site-header'>{n}</div><div id='content'>{a}</div>",
    "<div id=sidebar>{n}</div><article>{a}</article>", "<article>{a}<aside>{n}</aside></article>", "<div class='post'>{a}</div><div class='commentList'>{n}</div>",
    "<div><section id='comments'>{n}</section><div>{a}</div></div>", "<div class='cookie-notice'>{n}</div><section>{a}</section>",
    "<form>{n}</form><div>{a}</div>", "<div role='navigation'>{n}</div><div>{a}</div>", "<div hidden>{n}</div><div>{a}</div>",
    "<div style='display: none'>{n}</div><div>{a}</div>", "<!-- {n} --><div>{a}</div>", "<script>var x = '{n}'</script><div>{a}</div>",
    "<noscript>{n}</noscript><div>{a}</div>", "<div>{a}<div class='share'>{n}</div></div>", "<div>{a}</div><div class='related-posts'>{n}</div>",
    "<table><tr><td><ul><li><a href=x>one</a><li><a href=y>two</a></ul><td>{a}</table>", "<div class=ad>{n}</div><article>{a}</article><footer>{n}</footer>",
    "<template>{n}</template><DIV ID=Main><ARTICLE>{a}</ARTICLE></DIV>", "<dialog>{n}</dialog><div>{a}</div>", "{a}"])
def test_clutter_goes(around):
    page = "<html><head><title>t</title><style>p {}</style></head><body>" + around.format(a=ARTICLE, n=NOISE) + "</body></html>"
    assert op1_html.main_text(page) == PLAIN


@pytest.mark.parametrize("page, text", [
    ("", ""), ("plain &amp; simple", "plain & simple"), ("<p>a&nbsp;b\n\t c</p>", "a b c"), ("<p>one<p>two", "one\ntwo"), ("<p>x<br>y<br><br>z</p>", "x y\nz"),
    ("<ul><li>one<li>two <b>bold</b></ul>", "one\ntwo bold"), ("<p>a < b</p>", "a < b"), ("<p>cut off &am", "cut off &am"), ("<p title='a>b'>x</p>", "x"),
    ("<p>in <a href=x>a link</a>.</p>", "in a link."), ("<p>open <b>bold <i>both</p><p>next</p>", "open bold both\nnext"), ("<script>x", ""),
    ("<div>" * 3000 + "deep", "deep"), ("<p>&#233;&eacute;&#x1F600;</p>", "éé😀")])
def test_markup(page, text):
    assert op1_html.main_text(page) == text


@pytest.mark.parametrize("around", [
    "<div id='content' class='has-sidebar'>{a}</div>", "<div class='post no-comments'>{a}</div>", "<div class='layout withSidebar'>{a}</div>",
    "<div class='sidebar-layout'>{a}</div>", "<div class='sidebar-layout'><div>{a}</div><div class='sidebar'>{n}</div></div>", "<div class='comment'>{a}</div>",
    "<div class='overflow-hidden'>{a}</div><div class='promo'>{n}</div>", "<article><header class='header'><h1>A title</h1></header>{b}</article>",
    "<article><h1 class='banner'>A title</h1>{b}</article>"])
def test_names_dont_drop_the_content(around):
    page = "<html><body>" + around.format(a=ARTICLE, n=NOISE, b=ARTICLE.split("</h1>")[1]) + "</body></html>"
    assert op1_html.main_text(page) == PLAIN


@pytest.mark.parametrize("part, text", [
    ("<section id='discussion'><h2>Discussion</h2><p>What it means, in short.</p></section>", "Discussion\nWhat it means, in short."),
    ("<h2 id='related-work'>Related work</h2><p>Of others.</p>", "Related work\nOf others."), ("<h2 id='legal-history'>Law</h2><p>Old.</p>", "Law\nOld."),
    ("<div class='section' id='search'><h2>Search</h2><p>By trees.</p></div>", "Search\nBy trees."), ("<p class='notice'>Mind this.</p>", "Mind this."),
    ("<p>A <span class='alert'>red</span> word.</p>", "A red word.")])
@pytest.mark.parametrize("around", ["<article>{}</article>", "<div>{}</div>"])
def test_names_dont_drop_parts_of_an_article(around, part, text):
    assert op1_html.main_text("<body>" + around.format(ARTICLE + part) + "</body>") == PLAIN + "\n" + text


LONG_NOISE = NOISE * 20


@pytest.mark.parametrize("around", [
    "<div class=post>{a}</div><div id=comments>{n}</div>", "<article>{a}<div class='comments'>{n}</div></article>", "<article>{a}</article><section class='comments'>{n}</section>",
    "<div class=post>{a}</div><div class='sidebar'>{n}</div>", "<div>{a}</div><div class='comments'><h2>Readers</h2>{n}</div>", "<div class='advert'>{n}</div><div>{a}</div>",
    "<div>{a}<p class='advert'>Buy, now, at once, and all of it.</p></div>", "<div>{a}<p class='ad'>Buy.</p></div>", "<div>{a}<p class='comment'>Me, too.</p></div>",
    "<article>{a}<div id='discussion'><div><b>Ann</b><p>I, too, think so, and more.</p></div><div><b>Bo</b><p>Not I, not at all, never.</p></div></div></article>"])
def test_long_clutter_goes(around):
    assert op1_html.main_text("<html><body>" + around.format(a=ARTICLE, n=LONG_NOISE) + "</body></html>") == PLAIN


@pytest.mark.parametrize("page, text", [
    ("<body><div>{a}</div><div><p>Ok</p></div></body>", PLAIN + "\nOk"), ("<body><h3>Kicker</h3><div>{a}</div></body>", "Kicker\n" + PLAIN),
    ("<body><div>{a}</div><div>&copy; 2020 Someone</div></body>", PLAIN), ("<body><div>{a}</div><h3>More</h3><ul><li><a href=x>one</a></ul></body>", PLAIN),
    ("<body><div>{a}<p>A <span class='advert'>bought</span> word.</p></div></body>", PLAIN + "\nA word."),
    ("<body><div>{a}<pre>x <span class='comment'># code</span></pre></div></body>", PLAIN + "\nx # code")])
def test_short_parts_stay(page, text):
    assert op1_html.main_text(page.format(a=ARTICLE)) == text


def test_names_dont_count_if_nothing_is_left():
    assert op1_html.main_text("<div class='sidebar'><span>all</span> <a href=x>there is</a></div>") == "all there is"
    assert op1_html.main_text("<div class='promo'><a href=x>one</a></div><div class='menu'><a href=y>two</a></div>") != ""


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<div>", "</div>", "<b>", "</b>", "<br>", "<ul>", "<li>", "</ul>", "<table>", "<tr>", "<td>", "</table>", "<a href='x'>", "</a>",
                                 "<!--", "-->", "<", ">", "&", "&lt;", "word", " ", "<script>", "</script>", "<article>", "</article>", "<h1>", "</h1>", "\""])).map("".join))
def test_any_markup_is_read(page):
    text = op1_html.main_text(page)
    assert text == "\n".join(" ".join(line.split()) for line in text.split("\n")) and "\n\n" not in text


# -- vectors -----------------------------------------------------------------------------


def _nearest(ids, vectors, query, k):
    at = ids.index(query)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    score = unit @ unit[at]
    order = sorted((j for j in range(len(ids)) if ids[j] != query), key=lambda j: (-round(score[j], 10), ids[j]))
    return [ids[j] for j in order[:k]]


@pytest.mark.parametrize("blocks", [(8192, 16384, 1024), (50, 3, 1024), (200, 16384, 4)])
def test_nearest_against_brute_force(spark, tmp_path, monkeypatch, blocks):
    monkeypatch.setattr(op4_onebit, "CODE_BLOCK", blocks[0])
    monkeypatch.setattr(op4_onebit, "QUERY_BLOCK", blocks[1])
    monkeypatch.setattr(op4_onebit, "SLICE", blocks[2])
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 32))
    vectors = (centres[rng.integers(0, 12, 900)] + 0.4 * rng.normal(size=(900, 32))).astype(np.float32)
    vectors[300:500] = vectors[300]  # copies
    vectors[600:610] = 2 * vectors[600]
    ids = list(range(900))
    put(spark, tmp_path, "embeddings", [(i, v.tolist(), 0) for i, v in zip(ids, vectors)])
    rows = queries()["op4_onebit"](spark, str(tmp_path)).collect()
    got = {q: [r.vec_id for r in sorted(rows, key=lambda r: r.rank) if r.query_id == q] for q in range(0, 900, 50)}
    expected = {q: _nearest(ids, vectors.astype(np.float64), q, 5) for q in range(0, 900, 50)}
    found = sum(len(set(got[q]) & set(expected[q])) for q in got)
    assert found >= 0.97 * 5 * len(got) and got[300] == expected[300] == [301, 302, 303, 304, 305] and got[350] == expected[350]
    for r in rows:
        a, b = vectors[r.query_id].astype(np.float64), vectors[r.vec_id].astype(np.float64)
        assert r.score == pytest.approx(a @ b / np.linalg.norm(a) / np.linalg.norm(b), abs=1e-12)


def test_recall_on_given_vectors(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    ids, vectors = [r.vec_id for r in rows], np.array([r.embedding for r in rows])
    got = queries()["op4_onebit"](spark, "/root/testdata/sf0.1").collect()
    wanted = {(q, i) for q in ids if q % 50 == 0 for i in _nearest(ids, vectors, q, 5)}
    assert len(wanted & {(r.query_id, r.vec_id) for r in got}) >= 0.9 * len(wanted)


def test_bounds_hold():
    rng = np.random.default_rng(1)
    unit = rng.normal(size=(500, 64))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    rotated_by = op4_onebit.rotation(64)
    assert np.allclose(rotated_by @ rotated_by.T, np.eye(64))
    bits, correction = op4_onebit.encode(unit, rotated_by)
    estimate, error = op4_onebit.bounds(unit[:50] @ rotated_by, bits, correction)
    assert (np.abs(estimate - unit[:50] @ unit.T) <= error).mean() > 0.999


# -- records -----------------------------------------------------------------------------


def test_audit_finds_what_changed(spark):
    rows = [(k, f"http://x/{k}", "page " * (k % 40)) for k in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    records = op6_fixity.page_records(pages, file_ids=64).cache()
    digest = F.when(F.col("record_id").isin(5, 130), F.lit("0" * 64)).otherwise(F.col("digest"))
    other = records.withColumn("digest", digest).where("record_id <> 77")
    got = {r.record_id: r for r in op6_fixity.audit(records, other, range_bytes=512, fanout=3).collect()}
    assert set(got) == {5, 130, 77} and got[77].digest_b is None and got[5].digest_b == "0" * 64 and got[130].length_a == got[130].length_b
    assert op6_fixity.audit(records, records, 512, 3).count() == 0


def test_roots_are_merkle_roots(spark):
    pages = spark.createDataFrame([(k, "u", "x" * 400) for k in range(20)], "page_id long, url string, html string")
    records = op6_fixity.page_records(pages, 512)
    levels = op6_fixity.tree(records, 1024, 2)
    sha = lambda parts: hashlib.sha256("\n".join(parts).encode()).hexdigest()
    nodes: dict[int, list[str]] = {}
    for r in sorted(records.collect(), key=lambda r: r.offset):
        nodes.setdefault(r.offset // 1024, []).append(f"{r.offset} {r.length} {r.digest}")
    level = {k: sha(v) for k, v in nodes.items()}
    while max(level) > 0:
        parents: dict[int, list[str]] = {}
        for k in sorted(level):
            parents.setdefault(k // 2, []).append(f"{k} {level[k]}")
        level = {k: sha(v) for k, v in parents.items()}
    assert [(r.node, r.hash) for r in levels[-1].collect()] == [(0, level[0])]


def test_records_lie_end_to_end(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    rows = sorted(op6_fixity.page_records(pages, 16).collect(), key=lambda r: (r.file, r.offset))
    for a, b in zip(rows, rows[1:]):
        assert b.offset == (a.offset + a.length if a.file == b.file else 0) and (a.file, a.record_id) < (b.file, b.record_id)


# -- packing -----------------------------------------------------------------------------


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 70), max_size=60))
def test_packing_holds_every_token_once(lengths):
    bins = op8_packing.pack(lengths, 16)
    seen = [np.zeros(n, int) for n in lengths]
    for b in bins:
        total = sum(p[2] for p in b)
        assert total == 16 or 0 < total < 16 and total & (total - 1) == 0
        for item, start, length in b:
            seen[item][start : start + length] += 1
    assert all((s == 1).all() for s in seen)


def test_first_fit_decreasing_is_first_fit():
    rng = random.Random(8)
    rests = [(k, 0, rng.randrange(1, 100)) for k in range(300)]
    plain: list[list] = []
    for piece in sorted(rests, key=lambda p: (-p[2], p[0])):
        at = next((b for b in plain if sum(p[2] for p in b) + piece[2] <= 100), None)
        if at is None:
            plain.append(at := [])
        at.append(piece)
    assert op8_packing.first_fit_decreasing(rests, 100) == plain


def test_packed_pieces_are_the_documents(spark, tmp_path, monkeypatch):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()] + [(10_000 + k, t) for k, t in enumerate(ODD)]
    folder = documents(spark, tmp_path, rows)
    monkeypatch.setattr(op8_packing, "GROUP_TOKENS", 30_000)
    got = queries()["op8_packing"](spark, folder).collect()
    ids = {i: library.encode(t, add_special_tokens=False).ids + [2] for i, t in rows}
    covered = {i: [] for i in ids}
    sequences: dict[int, list] = {}
    for r in got:
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own) and r.ids_crc32 == zlib.crc32(np.array(own[r.start : r.start + r.length], "<u4").tobytes())
        covered[r.doc_id] += range(r.start, r.start + r.length)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert all(sorted(c) == list(range(len(ids[i]))) for i, c in covered.items())
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 4096 and (end == 4096 or end & (end - 1) == 0)


def test_records_without_ids_and_copies_as_in_sql(spark, tmp_path):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    odd = pages.limit(9).withColumn("page_id", F.lit(None).cast("long")).unionByName(pages.limit(6)).unionByName(pages.limit(6))
    odd = odd.unionByName(pages.limit(3).withColumn("html", F.lit(None).cast("string")))
    pages.unionByName(odd).coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    got = queries()["op6_fixity"](spark, str(tmp_path))
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, db.execute(op6_fixity.OP6_SQL).fetchall()))



# -- encoding ----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def bpe():
    ranks = op10_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    plain = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    return op10_bpe.ByteBPE(ranks, public_tokenizers.PATTERN), tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=plain, special_tokens={})


@pytest.fixture(scope="module")
def word_bpe():
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.encode_special_tokens = True
    return op8_packing.WordBPE(path), library


def test_odd_texts(bpe, word_bpe):
    own, library = bpe
    assert own.encode(ODD)[0].tolist() == [i for t in ODD for i in library.encode_ordinary(t)]
    own, library = word_bpe
    assert own.encode(ODD)[0].tolist() == [i for t in ODD for i in library.encode(t, add_special_tokens=False).ids]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\tabcdeABÉéüßñ'stdre1290.,*|😀　\xa0Σς́")), max_size=4))
def test_any_texts(bpe, word_bpe, texts):
    for (own, library), plain in ((bpe, lambda lib, t: lib.encode_ordinary(t)), (word_bpe, lambda lib, t: lib.encode(t, add_special_tokens=False).ids)):
        ids, ends = own.encode(texts)
        starts = [0, *ends.tolist()]
        assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == [plain(library, t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from("''''stdmrevlaABÉé!.1 \n×œŸ")), max_size=4))
def test_pieces_of_usual_texts(texts):
    pattern = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|[^\s\w]+")
    found, marked, ends = pieces.pieces_of(texts)
    assert not marked[[k for k, p in enumerate(found.to_pylist()) if "×" not in p.decode()]].any()
    usual = [t for t in texts if "×" not in t]
    array, _, ends = pieces.pieces_of(usual)
    got, places = array.to_pylist(), [0, *ends.tolist()]
    assert [[p.decode() for p in got[a:b]] for a, b in zip(places, places[1:])] == [pattern.findall(t.lower()) for t in usual]


def test_two_generations_of_pieces(word_bpe, monkeypatch):
    monkeypatch.setattr(op8_packing, "CACHED", 7)
    own, library = op8_packing.WordBPE(public_tokenizers.path("word_bpe_49k.json")), word_bpe[1]
    rng = random.Random(3)
    for _ in range(40):
        text = " ".join(rng.choice(["the", "of", "Ünïcode", "x1y", "αβγ", f"word{rng.randrange(30)}"]) for _ in range(12))
        assert own.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(own.newer) <= 7 + 30


def test_copies_share_no_group(spark, tmp_path):
    """Empty texts without an id are dealt evenly, and a group is packed in parts of bounded rows."""
    folder = documents(spark, tmp_path, [(None, None)] * 6000 + [(5, "the same text")] * 3000)
    dealt = spark.read.parquet(f"{folder}/documents.parquet").repartition(6)
    rows = op8_packing.pack_documents(dealt, public_tokenizers.path("word_bpe_49k.json"), 2, group_docs=500)
    sizes = sorted(r["count"] for r in rows.groupBy(F.expr("sequence_id >> 32")).count().collect())
    assert len(sizes) == 18 and sizes[-1] <= 2 * sizes[len(sizes) // 2] and sum(sizes) >= 9000


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=2, max_size=300))
def test_long_and_short_trees_agree(bpe, piece):
    trees = bpe[0].trees
    assert trees.long(piece) == trees.short([piece], 1 << (len(piece) - 1).bit_length())[0]


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(merges, "_CODES", np.zeros(256, np.uint64))
    texts = ["aa bb cc aa", "dd aa", ""]
    chunks, places, ends = merges.distinct_chunks(texts)
    assert b"".join(chunks[k] for k in places).decode() == "".join(texts) and ends.tolist() == [4, 6, 6]


def test_encoded_documents(spark, bpe):
    library = bpe[1]
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in queries()["op10_bpe"](spark, SMALL).collect():
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
