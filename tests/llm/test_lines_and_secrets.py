"""Native operators against brute force and their reference SQL."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from tallygate.llm import secret_scan
from tallygate.llm.line_dedup import Window, dedup_lines
from tallygate.llm.oracle import ORACLE_SQL

from brute import deleted_lines, linked_spans


def _cleaned(rows, how=Window(ends=False)):
    gone = deleted_lines(rows, how.lines, how.words)
    out = []
    for (i, t), g in zip(rows, gone, strict=True):
        lines = (t or "").split("\n")
        out.append((i, "\n".join(x for k, x in enumerate(lines) if k not in g), len(lines), len(g)))
    return out


def _found(docs, how=Window()):
    rows = dedup_lines(docs, how).collect()
    for r in rows:
        inside = [k for first, last in r.runs for k in range(first, last + 1)]
        assert len(inside) == r.n_deleted
    return sorted((tuple(r)[:4] for r in rows), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_line_runs_match_brute_force(make_docs, seed):
    rng = random.Random(seed)
    lines = [f"l{i}" for i in range(6)] + ["", "  ", "one two three four five six seven eight nine ten"]
    texts = ["\n".join(rng.choice(lines) for _ in range(rng.randint(0, 14))) for _ in range(60)]
    rows, how = list(enumerate(texts)), Window(ends=False)
    assert _found(make_docs(rows), how) == sorted(_cleaned(rows, how), key=repr)


def _stretches(rows, how):
    """By definition: lines in a stretch of equal lines, from any earlier place, that holds a window."""
    texts = [[(i, x) for i, x in enumerate((t or "").split("\n")) if x.replace(" ", "")]
             for _, t in rows]
    places = [(d, k) for d, e in enumerate(texts) for k in range(len(e))]
    gone = [set() for _ in rows]
    for n, (d, k) in enumerate(places):
        for c, m in places[:n]:
            size = words = 0
            while (k + size < len(texts[d]) and m + size < len(texts[c])
                   and texts[d][k + size][1] == texts[c][m + size][1]):
                words += texts[d][k + size][1].count(" ") + 1
                size += 1
            if size >= how.lines or words >= how.words:
                gone[d].update(i for i, _ in texts[d][k : k + size])
    return gone


@pytest.mark.parametrize("seed", range(3))
def test_repeated_stretches_go_to_their_last_line(make_docs, seed):
    rng = random.Random(seed)
    ten = "one two three four five six seven eight nine ten"
    lines = [f"l{i}" for i in range(6)] + ["", "  ", ten, "a b c d e f", "g h i j k"]
    texts = ["\n".join(rng.choice(lines) for _ in range(rng.randint(0, 12))) for _ in range(40)]
    texts += [f"{ten}\nend\nof it", f"x\n{ten}\nend\n\nof it", f"{ten}\nend\nof that"]
    rows, how = list(enumerate(texts)), Window()
    expected = []
    for (i, t), g in zip(rows, _stretches(rows, how), strict=True):
        parts = t.split("\n")
        expected.append((i, "\n".join(x for k, x in enumerate(parts) if k not in g), len(parts), len(g)))
    assert expected[-2][1] == "x\n" and expected[-1][1] == "of that"
    assert _found(make_docs(rows), how) == sorted(expected, key=repr)


def test_later_copies_keep_no_line(sf_docs):
    import corpus_pipeline

    left = corpus_pipeline.line_dedup_stage(sf_docs.sparkSession, sf_docs, "").select(
        "doc_id", F.col("text").alias("rest"))
    rows = sf_docs.join(left, "doc_id", "left").select("doc_id", "text", "rest").toPandas()
    rows = rows[rows.text.str.count("\n") >= 2].sort_values("doc_id")
    later = rows.text.duplicated()
    assert later.any() and rows.rest[later].isna().all()
    assert rows.rest[~later].notna().mean() > 0.9


def test_line_runs_of_odd_rows(make_docs):
    long = "\n".join(f"line {i % 7}" for i in range(20_000))
    run = "a\nb\nc"
    rows = [(5, run), (None, run), (6, None), (7, ""), (8, long), (9, f"x\n\n{run}\n\ny")]
    found = {r.doc_id: r.text for r in dedup_lines(make_docs(rows)).collect()}
    assert found[None] == run and found[5] == ""  # rows without id come first
    assert found[6] == found[7] == ""
    assert found[8].count("\n") < 12
    assert found[9] == "x\n\n\ny"
    assert dedup_lines(make_docs([])).count() == 0
    twice = dedup_lines(make_docs([(1, run), (1, run)]), carry=("source",)).collect()
    assert [(r.text, r.source) for r in twice] == [(run, "s")] * 2


def _compare(docs, query, found):
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text").toPandas())
    expected = con.execute(ORACLE_SQL[query]).df()
    found = found.toPandas()[list(expected.columns)]
    key = "doc_id"
    a = found.sort_values(key).astype(str).values.tolist()
    assert a == expected.sort_values(key).astype(str).values.tolist()


def test_line_dedup_matches_sql(sf_docs):
    runs = F.transform("runs", lambda r: F.concat_ws("-", r["first"].cast("string"),
                                                     r["last"].cast("string")))
    found = dedup_lines(sf_docs).withColumn("runs", F.array_join(runs, ","))
    _compare(sf_docs, "op7_line_dedup", found)


TEXTS = [
    # complementary parts exactly a scope apart, the first ending at a bucket's edge; one more
    " " * 247 + "user: bob" + " " * 256 + "pass = s3cr",
    " " * 247 + "user: bob" + " " * 257 + "pass = s3cr",
    "password = hunter22 and token: 'abc' ", "PassWord=\"abcdef\"", "secret: token=abcdefgh",
    "secret=token =abcdefgh", "api_key:123456 apikey = zzzzzzz", "AKIA" + "Z" * 16, "AKIAAKIA1234",
    "AKIA" + "B2" * 9 + " pwd: q!w2", "0123456789abcdef01234567", "é" * 30 + "deadbeef" * 3 + "G",
    "user: bob\n" + "x" * 200 + " pass = s3cr", "user: bob\n" + "x" * 300 + " pass = s3cr",
    "user=amy host=db.example pass=open", "https://example.org/a?b=c only", "login: eve",
    "see https://a.example user: u1 token = 0a1b2c3d", "", None, "secret", "token=", "ſecret=abcdefg",
]


def test_secret_spans_match_brute_force(make_docs):
    found = {r.doc_id: [tuple(s) for s in r.spans] for r in secret_scan.scan(make_docs(TEXTS)).collect()}
    for i, t in enumerate(TEXTS):
        assert found[i] == linked_spans(t or "", 256), t


def test_secret_spans_of_odd_rows(make_docs):
    many = " ".join(f"user: u{i:04d} token = k{i:06d}" for i in range(3000))
    rows = [(1, many), (None, "token = abcdefg"), (2, "token = abcdefg"), (2, "token = abcdefg")]
    found = secret_scan.digests(secret_scan.scan(make_docs(rows))).collect()
    assert sorted((r.n_assign for r in found)) == [1, 1, 1, 3000]
    spans = {r.doc_id: r.spans for r in found}
    assert spans[None] == spans[2] == "assign:0:15"
    assert spans[1].count("ident:") == 3000
    assert secret_scan.scan(make_docs([])).count() == 0


def test_secret_scan_matches_sql(sf_docs, make_docs):
    for docs in (sf_docs, make_docs([t for t in TEXTS if t is not None])):
        _compare(docs, "op2_secret_scan", secret_scan.digests(secret_scan.scan(docs)))
