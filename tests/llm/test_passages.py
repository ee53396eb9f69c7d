import random
from collections import defaultdict

from tidemark.llm import passages as P


def brute(rows, min_words=P.MIN_WORDS):
    first = defaultdict(list)
    for id, t in rows:
        for a, b, unit in P.units(t or ""):
            first[unit].append((P.NO_ID if id is None else id, a))
    out = set()
    for id, t in rows:
        key = P.NO_ID if id is None else id
        run, seen = [], set()
        for a, b, unit in [*P.units(t or ""), (None, None, None)]:
            keep = min(first[unit])[0] if unit is not None else None
            if unit is not None and (keep < key or unit in seen):
                run.append((a, b, len(unit.split()), keep))
            else:
                if sum(r[2] for r in run) >= min_words:
                    out.add((key, run[0][0], run[-1][1], sum(r[2] for r in run), min(r[3] for r in run)))
                run = []
            seen.add(unit)
    return sorted(out)


def got(df):
    return sorted({(r["id"], r["start"], r["end"], r["words"], r["first"]) for r in df.collect()})


def test_units_cover_the_words():
    text = 'One two. Three "four." Five!\n\n  \nSix e.g.7 é? '
    found = list(P.units(text))
    assert [u for _, _, u in found] == ['one two. three "four."', "five!", "six e.g.7 é?"]
    assert " ".join(text[a:b] for a, b, _ in found).split() == text.split()


def test_passages(spark):
    rng = random.Random(12)
    sentence = lambda n: " ".join("".join(rng.choice("abcdefg") for _ in range(5)) for _ in range(n)).capitalize() + "."
    passage = " ".join(sentence(9) for _ in range(7))
    rows = [(i, " ".join(sentence(8) for _ in range(6))) for i in range(20)]
    rows += [(20 + i, sentence(7) + " " + passage + "\n" + sentence(9)) for i in range(4)]
    rows += [(30, passage.upper() + " tail"), (31, "All rights reserved. " + sentence(8)), (32, "All rights reserved. " + sentence(8))]
    rows += [(40, None), (41, ""), (None, passage), (42, passage + "\n" + passage), (20, rows[20][1])]
    docs = spark.createDataFrame([(i, t, 1, "n") for i, t in rows], "doc_id long, text string, no int, h string")
    want = brute(rows)
    assert got(P.repeated_passages(docs)) == want
    assert {w[0] for w in want} == {21, 22, 23, 30, 42, P.NO_ID}
    left = {r.doc_id: r.text for r in P.without_passages(docs).collect()}
    assert left[21].count(".") == 2 and left[20] == rows[20][1] and left[40] is None and left[31] == rows[25][1]
    assert P.repeated_passages(docs.limit(0)).count() == 0


def test_query(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, P.op2_passages(spark, sf).collect())) == brute(rows)


def test_passages_of_fifty_words_are_caught(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    where = defaultdict(set)
    for id, t in rows:
        w = (t or "").lower().split()
        for k in range(len(w) - 50):
            where[tuple(w[k : k + 51])].add(id)
    later = {d for ids in where.values() for d in ids if d > min(ids)}
    caught = {r[0] for r in brute(rows)}
    assert later and len(later & caught) >= 0.97 * len(later)


def test_long_sentences_without_marks_are_cut_alike(spark):
    rng = random.Random(14)
    words = lambda n: " ".join("".join(rng.choice("abcdefg") for _ in range(6)) for _ in range(n))
    rows = []
    for i in range(20):
        passage = words(80)
        rows += [(2 * i, f"{words(40)} {passage} {words(35)}"), (2 * i + 1, f"{words(33)} {passage} {words(51)}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    gone = got(P.repeated_passages(docs))
    assert {g[0] for g in gone} == {2 * i + 1 for i in range(20)}
    assert all(51 <= sum(g[3] for g in gone if g[0] == 2 * i + 1) <= 80 for i in range(20))


def test_scripts_without_spaces(spark):
    rng = random.Random(15)
    sentence = lambda n: "".join(chr(rng.randrange(0x4E00, 0x9000)) for _ in range(n)) + "。"
    passage = "".join(sentence(20) for _ in range(5))
    thai = "".join(chr(rng.randrange(0x0E01, 0x0E2F)) for _ in range(300))
    rows = [(1, sentence(30) + passage), (2, sentence(15) + passage + sentence(12)), (3, "ก\n" + thai), (4, "ข\n" + thai + "\nค")]
    left = {r.doc_id: r.text for r in P.without_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert left == {1: rows[0][1], 2: rows[1][1].replace(passage, ""), 3: rows[2][1], 4: "ข\nค"}


def test_columns_with_the_names_of_helpers(spark):
    text = " ".join(f"word{i}" for i in range(30)) + "."
    docs = spark.createDataFrame([(1, text, 1, 2, "x"), (2, text + " Own.", 4, 5, "y")], "doc_id long, text string, __id int, __H int, __cuts string")
    got = P.without_passages(docs)
    assert got.columns == docs.columns and [tuple(r) for r in got.orderBy("doc_id").collect()][0] == (1, text, 1, 2, "x")
    assert {(r["__id"], r["__H"], r["__cuts"]) for r in got.collect()} == {(1, 2, "x"), (4, 5, "y")}
