import random
from collections import defaultdict

from tidemark.llm import line_chunks as L


def brute(rows):
    """Texts after removal, with chunks told apart by their own bytes."""
    where = defaultdict(set)
    for i, t in rows:
        for a, b, n in L.line_chunks(t or ""):
            if n > 1:
                where[t[a:b]].add((i is None, i or 0, a, t))
    out = []
    for i, t in rows:
        cuts = [(a, b) for a, b, n in L.line_chunks(t or "") if n > 1 and min(where[t[a:b]])[:3] != (i is None, i or 0, a)]
        text, last = t, 0
        if cuts:
            text = ""
            for a, b in cuts:
                text, last = text + t[last:a], b
            text += t[last:]
        out.append((i, text, cuts))
    return out


def got(df, id="doc_id"):
    return sorted((str(r[id]), str(r["text"]), [tuple(s) for s in r["removed"] or []]) for r in df.collect())


def test_chunks_cover_the_text_and_shift():
    rng = random.Random(1)
    line = lambda: "".join(rng.choice("abc é") for _ in range(rng.randrange(12)))
    for _ in range(200):
        text = "\n".join(line() for _ in range(rng.randrange(12)))
        spans = list(L.line_chunks(text))
        assert [s[0] for s in spans[1:]] == [s[1] for s in spans[:-1]] and (not spans or spans[-1][1] == len(text))
        assert sum(s[2] for s in spans) == text.count("\n") + 1
    passage = [f"line {i}" for i in range(60)]
    cut = lambda lines: {"\n".join(lines)[a:b] for a, b, _ in L.line_chunks("\n".join(lines))}
    assert len(cut(passage) & cut(["new", "lines", "here", *passage])) >= len(cut(passage)) - 2


def test_removal(spark):
    rng = random.Random(2)
    shared = [[f"passage {k} line {i} é" for i in range(rng.randrange(4, 12))] for k in range(6)]
    rows = []
    for i in range(40):
        lines = []
        for _ in range(4):
            lines += rng.choice(shared) if rng.random() < 0.5 else [f"own {i} {rng.random()}"]
        rows.append((i, "\n".join(lines)))
    rows += [(100, None), (101, ""), (102, "\n\n\n"), (103, "\n\n\n"), (None, "\n".join(shared[0])), (104, rows[0][1]), (3, rows[3][1])]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, removed string, h string")
    out = L.without_repeated_chunks(docs)
    assert got(out) == sorted((str(i), str(t), c) for i, t, c in brute(rows))
    assert any(r["removed"] for r in out.collect())
    assert L.dedup_documents(docs).columns == docs.columns
    assert L.without_repeated_chunks(docs.limit(0)).count() == 0


def test_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = sorted((i, len(c), ",".join(f"{a}:{b}" for a, b in c), t) for i, t, c in brute(rows))
    assert sorted(map(tuple, L.op4_line_chunks(spark, sf).select("doc_id", "n_removed", "removed", "text").collect())) == want


def common_lines(rows):
    """Places (row, line) of every line that stands in two neighbouring lines an earlier place has."""
    seen, gone = {}, set()
    for n, (_, t) in enumerate(rows):
        lines = t.split("\n")
        for k in range(len(lines) - 1):
            m, j = seen.setdefault((lines[k], lines[k + 1]), (n, k))
            if m != n or k > j + 1:
                gone |= {(n, k), (n, k + 1)}
    return gone


def test_chunks_have_two_lines_at_least():
    rng = random.Random(5)
    for n in range(2, 60):
        assert min(c for _, _, c in L.line_chunks("\n".join(str(rng.random()) for _ in range(n)))) >= 2


def test_planted_passages_of_two_to_ten_lines_go_whole(spark):
    rng = random.Random(6)
    own = lambda n: [f"own {rng.random()} é" for _ in range(n)]
    rows = []
    for size in [*range(2, 11)] * 4:
        passage = own(size)
        rows += [(len(rows) + k, "\n".join(own(rng.randrange(5)) + passage + own(rng.choice([0, 1, 4])))) for k in range(2)]
    rows += [(500, rows[3][1]), (501, "x\nx\nx"), (502, "y\ny\ny\ny"), (503, "single\n" + own(1)[0]), (504, "single\n" + own(1)[0])]
    gone = common_lines(rows)
    want = {}
    for n, (i, t) in enumerate(rows):
        left = [x for k, x in enumerate(t.split("\n")) if (n, k) not in gone]
        if left:
            want[i] = left
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = {r.doc_id: r.text.removesuffix("\n").split("\n") for r in L.dedup_documents(docs).collect()}
    assert left == want and 500 not in left and left[501] == ["x"] * 3 and left[502] == ["y"] * 2


def test_blank_lines_are_no_lines_of_a_passage(spark):
    rows = [(1, "a\n\nb\n\nc\n"), (2, "d\n\nb\n\n"), (3, "a\n\nb"), (4, "\n\n\n"), (5, "\n\n\n"), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.text for r in L.dedup_documents(docs).collect()} == {i: t for i, t in rows if i != 3}


def test_columns_with_the_names_of_helpers(spark):
    rows = [(1, "a\nb\nc", 1, 2, "x", 3, 5), (2, "a\nb\nd", 4, 5, "y", 6, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __id int, __H int, __cuts string, __removed int, n_chars int")
    assert [tuple(r) for r in L.dedup_documents(docs).orderBy("doc_id").collect()] == [rows[0], (2, "d", 4, 5, "y", 6, 1)]
    assert L.without_repeated_chunks(docs).drop("removed").count() == 2


def test_dedup_documents_removes_chunks_cut_by_a_rolling_hash_and_extends_them(spark, monkeypatch):
    rng = random.Random(7)
    own = lambda n: [f"own {rng.random()} é" for _ in range(n)]
    passage = own(40)
    rows = [(n, "\n".join(own(n) + passage[:20] + ["", " "] + passage[20:] + own(1))) for n in range(3)]
    cut = lambda t: [t[a:b].removesuffix("\n") for a, b, n in L.line_chunks(t, window=L.WINDOW, blank=False) if n > 1]
    seen = set(cut(rows[0][1]))
    shared = [sum(c.count("\n") + 1 for c in cut(t) if c in seen) for _, t in rows]
    assert L.WINDOW > 1 and min(shared) > 30
    # The place of a cut hangs on all lines of the window.
    ends = lambda w: {tuple("\n".join(x)[:b].split("\n")[-2:]) for x in [own(1) + passage] for _, b, _ in L.line_chunks("\n".join(x), window=w)}
    assert ends(1) != ends(2)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = {r.doc_id: r.text for r in L.dedup_documents(docs).collect()}
    with monkeypatch.context() as m:  # chunks alone
        m.setattr(L, "line_pairs", lambda text: iter(()))
        chunks = {r.doc_id: r.text for r in L.dedup_documents(docs).collect()}
    assert whole[0] == chunks[0] == rows[0][1]
    for n, t in rows[1:]:
        kept = [x for x in chunks[n].split("\n") if x.strip()]
        assert sum(x.strip() != "" for x in t.split("\n")) - len(kept) >= 30 and not any(c in chunks[n] for c in cut(t) if c in seen)
        assert [x for x in whole[n].split("\n") if x.strip()] == [x for x in t.split("\n") if x.startswith("own") and x not in passage]
