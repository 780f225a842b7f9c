"""Neighbours, page text, tokens and the pipeline."""

import math
import random

import numpy as np
import pytest

import corpus_pipeline
from tallygate.llm import bpe, html_text, posting_lists
from tallygate.llm.queries import QUERIES, tokenizer_path

SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------------------- neighbours


def _nearest(rows, step=20, k=20):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], np.float32).astype(float)
    out = {}
    for q in sorted({i for i in ids.tolist() if i % step == 0}):
        score = x @ x[np.flatnonzero(ids == q)[0]]
        best = {}
        for i, s in zip(ids.tolist(), score.tolist(), strict=True):
            if i != q:
                best[i] = max(s, best.get(i, -math.inf))
        out[q] = sorted(best.items(), key=lambda p: (-p[1], p[0]))[:k]
    return out


def _search(spark, rows, how=posting_lists.Index()):
    frame = spark.createDataFrame([(*r, 1) for r in rows],
                                  "vec_id long, embedding array<float>, score int")
    out = {}
    for r in posting_lists.search(frame, how).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_recall_on_unequal_norms(spark):
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(30, 16))
    rows = [(i, (centers[i % 30] + 0.4 * rng.normal(size=16)).tolist()) for i in range(3000)]
    expected, found = _nearest(rows), _search(spark, rows)
    assert found.keys() == expected.keys()
    hits = [len({i for i, _ in found[q]} & {i for i, _ in expected[q]}) / 20 for q in expected]
    assert np.mean(hits) >= 0.9
    scores = dict(expected[0])
    assert all(s == pytest.approx(scores[i], abs=1e-12) for i, s in found[0] if i in scores)


def test_copies_ties_and_odd_vectors(spark):
    rng = random.Random(2)
    same = [1.0, 2.0, 0.0]
    rows = [(i, same) for i in range(400)]
    rows += [(1000 + i, [rng.choice([-1.0, 0.0, 1.0]) or 0.5, 1.0, -0.0]) for i in range(30)]
    odd = [(None, same), (2000, None), (2020, [0.0, 0.0, 0.0]), (2040, [1.0, None, 2.0]),
           (2060, [float("nan"), 1.0, 1.0]), (2080, [float("inf"), 1.0, 1.0]), (2100, [1.0]), (0, same)]
    expected, found = _nearest(rows), _search(spark, rows + odd)
    assert found == {q: [(i, pytest.approx(s)) for i, s in v] for q, v in expected.items()}
    assert [i for i, _ in found[0]] == list(range(1, 21))


def test_few_and_no_candidates(spark):
    assert _search(spark, [(0, [1.0, 0.0])]) == {}
    assert _search(spark, [(0, [1.0, 0.0]), (7, [0.5, 1.0])]) == {0: [(7, 0.5)]}
    assert _search(spark, []) == {}


# ----------------------------------------------------------------------------- page text


PAGE = """<!DOCTYPE html><html><head><title>t</title><script>var a="</p>";</script></head><body>
<div class="site-header">Top</div><nav><ul><li>a</ul></nav><article id="x">
<h1>Tea &amp;&nbsp;milk</h1><p>One<br>two<p>Three <b>bold</p><div class="comments"><p>rude</div>
<ul><li>a<li>b</ul><form>ask</form>tail &copy; &#233; &am</article><aside>s</aside><footer>f"""


def test_page_text():
    assert html_text.text_of(html_text.main_parts(html_text.parse(PAGE))) == (
        "Tea & milk\nOne two\nThree bold\na\nb\ntail © é &am")


STORY = "<p>One long story of many words.</p>"


@pytest.mark.parametrize("page, text", [
    (f'<body class="no-sidebar"><article class="post no-comments">{STORY}</article></body>', None),
    (f'<body class="sidebar widget">{STORY}</body>', None),
    (f'<div class="header-fixed"><article>{STORY}</article></div>', None),
    (f'<div id="ad-free-content">{STORY}</div>', None),
    (f'<div class="widget"><div class="related"><article>{STORY}</article></div></div><p>x</p>', None),
    (f'<article class="post related">{STORY}</article><div class="ad">buy</div>', None),
    (f'{STORY}<div class="comments"><article class="comment">I say so</article></div>', None),
    ('<div class="menu">home</div><nav><article>news of the day</article></nav>', ""),
    (f'<div hidden><article>{STORY}</article></div>', ""),
    ("<p>AT&<b>amp;</b>T &lt;b&gt;</p>", "AT&amp;T <b>"),
])
def test_marks_spare_the_article(page, text):
    found = html_text.text_of(html_text.main_parts(html_text.parse(page)))
    assert found == ("One long story of many words." if text is None else text)


def test_pages_on_table(spark):
    import html
    import re

    pages = spark.read.parquet(f"{SF}/pages.parquet")
    found = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    for r in pages.collect():
        inner = r.html.split("<article>")[1].split("</article>")[0]
        blocks = [" ".join(html.unescape(re.sub("<[^>]+>", "", b)).split())
                  for b in re.split("</?(?:p|h1)>", inner)]
        assert found[r.page_id] == "\n".join(b for b in blocks if b)


def test_templates_are_removed_and_copies_are_not(spark):
    def page(i, body):
        return (i, f"http://h.example/{i}", f"<body><article><p>{body}</p><div>Join our list</div>"
                f"<p>end {i % 3}</p></article></body>", "extra")

    rows = [page(i, f"story {i}") for i in range(12)]
    rows += [(100 + i, "http://copies.example/x", "<article><p>same</p><p>text</p></article>", "e")
             for i in range(50)]
    rows += [(200, None, rows[0][2], "e"), (201, "no host", None, "e"), (202, "http://x.example", "", "e"),
             (None, "http://y.example", "<p>a</p>" * 20_000, "e"), (203, "u", "<p>x<<p a='>y</p>", "e")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    found = {r.page_id: r.text for r in html_text.extract(frame).collect()}
    assert all(found[i] == f"story {i}\nend {i % 3}" for i in range(12))
    assert all(found[100 + i] == "same\ntext" for i in range(50))
    assert found[200] == "story 0\nJoin our list\nend 0" and found[201] == found[202] == ""
    assert found[None].count("\n") == 19_999
    assert html_text.extract(frame.where("page_id < 0")).count() == 0


# -------------------------------------------------------------------------------- tokens


ODD_TEXTS = ["Hello <|endoftext|> WORLD it's ΣΑΣ İ x\x85y ½ K ſ don't 'S <|startoftext|>x <| a|>",
             "日本語 テスト 𝒜 👨‍👩‍👧 １２ \x1c", "'LL'lll ''s a'b'", "", None, "ǅ ŉ ß ẞ ﬁ", "word " * 50_000]


def _reference(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer_path())
    out = []
    for text in texts:
        ids = t.encode(text or "", add_special_tokens=False).ids
        out.append((ids, t.decode(ids, skip_special_tokens=False)))
    return out


def test_tokens_match_the_library(make_docs, monkeypatch):
    found = {r.doc_id: (list(r.ids), r.decoded)
             for r in bpe.encode_documents(make_docs(ODD_TEXTS), tokenizer_path()).collect()}
    assert [found[i] for i in range(len(ODD_TEXTS))] == _reference(ODD_TEXTS)


def test_tokens_of_repeated_rows(make_docs):
    rows = [(1, "a b"), (1, "a b"), (None, "c"), (None, "c"), (2, "a b")]
    found = bpe.encode_documents(make_docs(rows), tokenizer_path()).collect()
    assert sorted((r.doc_id or 0, r.decoded) for r in found) == [
        (0, "c</w>"), (0, "c</w>"), (1, "a</w> b</w>"), (1, "a</w> b</w>"), (2, "a</w> b</w>")]
    assert bpe.encode_documents(make_docs([]), tokenizer_path()).count() == 0


def test_tokens_on_table(sf_docs):
    rows = sf_docs.collect()
    found = {r.doc_id: (list(r.ids), r.decoded)
             for r in bpe.encode_documents(sf_docs, tokenizer_path()).collect()}
    assert [found[r.doc_id] for r in rows] == _reference([r.text for r in rows])


# ------------------------------------------------------------------------------ pipeline


def test_pipeline_stages(spark, sf_docs, sf_labels):
    docs, seen = sf_docs, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.written(stage(spark, docs, SF), name)
        seen[name] = docs.collect()
        if name != "bpe":
            assert tuple(docs.columns) == corpus_pipeline.COLUMNS
    labels = sf_labels.toPandas().groupby("doc_id").agg({"quality": "min", "toxic": "max"})
    clean = set(labels[(labels.quality == 1) & (labels.toxic == 0)].index)
    ids = {name: {r.doc_id for r in rows} for name, rows in seen.items()}
    assert len(clean - ids["quality_classifier"]) <= 0.02 * len(clean)
    assert ids["line_dedup"] <= ids["quality_classifier"]
    kept = {r.text for r in seen["quality_classifier"] if r.doc_id in ids["line_dedup"]}
    gone = [r for r in seen["quality_classifier"] if r.doc_id not in ids["line_dedup"]]
    left = {line for t in kept for line in t.split("\n")}
    assert all(set(r.text.split("\n")) - {""} <= left for r in gone)
    before = {r.doc_id for r in seen["jaccard_join"]}
    assert clean & before <= ids["mixing"]
    assert not {i for i in ids["mixing"] if i in labels.index and labels.toxic[i]
                and not labels.quality[i]}
    texts = {r.doc_id: r.text for r in seen["mixing"]}
    reference = dict(zip(texts, _reference(texts.values()), strict=True))
    assert all(list(r.ids) == reference[r.doc_id][0] for r in seen["bpe"])


def test_pipeline_stage_of_near_copies(spark, make_docs):
    words = [f"w{i}" for i in range(100)]
    near = [*words[:50], "other", *words[50:]]
    rows = [(4, " ".join(words)), (2, " ".join(near)), (None, " ".join(words)), (7, "alone is this one"),
            (7, "alone is this one"), (8, ""), (8, ""), (9, None)]
    kept = corpus_pipeline.jaccard_join_stage(spark, make_docs(rows), SF).collect()
    assert sorted((r.doc_id, r.text or "") for r in kept) == sorted(
        [(2, " ".join(near)), (7, "alone is this one"), (8, ""), (8, ""), (9, "")])


def test_stages_take_empty_tables(spark, make_docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, make_docs([]), SF).count() == 0


def test_every_operator_is_registered():
    assert [int(k[2:].split("_")[0]) for k in QUERIES] == list(range(1, 14))
