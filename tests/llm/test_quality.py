import re

from pyspark.sql import functions as F

from tidemark.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0d]+")


def base(text):
    """The contract's measures, window by window."""
    words, windows = WORD.findall(text or ""), {}
    for i in range(len(words) - 7):
        windows.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {j for at in windows.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), again, len(covered)


TEXTS = [
    None, "", " \n\t ", "one", "a b c d e f g h " * 3, "x " * 40, "a b c d e f g h i a b c d e f g h", "line\nline\n\nline \n", "é🙂 ü\x0bv\x0cw\rz　y #$%",
    "the same eight words stand here two times, the same eight words stand here two times", "w " * 20_000, "same\n" * 5000,
]


def test_measures(spark):
    docs = spark.createDataFrame([(i, t, 1, "q") for i, t in enumerate(TEXTS)] + [(0, None, 2, "r")], "doc_id long, text string, n_words int, quality string")
    rows = Q.measured(docs, "text").collect()
    assert len(rows) == len(TEXTS) + 1
    for r in rows:
        q = r["quality"]
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == base(TEXTS[r.doc_id])
    assert Q.keep_good(docs).columns == docs.columns
    assert Q.keep_good(docs.limit(0)).count() == 0


def test_maximisation_follows_the_formulas(spark):
    """One round by hand over the same votes."""
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS * 3)], "doc_id long, text string")
    rows = Q.measured(docs, "text").select("quality").persist()
    votes = [r.asDict() for r in rows.select(*(v.alias(n) for n, v in Q.rules(F.col("quality")).items())).collect()]

    def posterior(w, vote):
        odds = w.prior / (1 - w.prior)
        for n, v in vote.items():
            good, poor = w.on_good[n], w.on_poor[n]
            odds *= good / (1 - poor) if v > 0 else (1 - good) / poor if v < 0 else 1
        return odds / (1 + odds)

    p = [posterior(Q.BELIEF, v) for v in votes]
    got = Q.fitted(rows, rounds=1)
    k = Q.BELIEF_TEXTS
    for n in Q.RULES:
        right = sum(x for x, v in zip(p, votes) if v[n] > 0)
        total = sum(x for x, v in zip(p, votes) if v[n])
        assert abs(got.on_good[n] - min(0.999, max(0.5, (right + k * Q.BELIEF.on_good[n]) / (total + k)))) < 1e-5
    assert abs(got.prior - (sum(p) + k * 0.8) / (len(p) + k)) < 1e-5
    again = Q.fitted(rows, rounds=4)
    shown = Q.judged(Q.measured(docs, "text"), again).select("quality.posterior", *(v.alias(n) for n, v in Q.rules(F.col("quality")).items())).collect()
    for r in shown:
        assert abs(r.posterior - posterior(again, {n: r[n] for n in Q.RULES})) < 1e-6


def test_no_python_in_the_plan(spark, sf):
    text = Q.op8_quality_rules(spark, sf)._jdf.queryExecution().toString()
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    text += Q.measured(docs, "text")._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", text)


def test_query_and_labels(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    rows = {r.doc_id: r for r in Q.op8_quality_rules(spark, sf).collect()}
    assert rows.keys() == texts.keys()
    for id, r in rows.items():
        n, *rest = base(texts[id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, *rest)
        assert r.base_failed == (n < 20 or 100 * rest[3] > 30 * n) and not (r.base_failed and r.kept)
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    poor = [rows[x.doc_id].kept for x in labels if x.quality == 0]
    good = [rows[x.doc_id].kept for x in labels if x.quality == 1 and not rows[x.doc_id].base_failed]
    assert sum(good) >= 0.98 * len(good) and sum(poor) <= 0.1 * len(poor)
