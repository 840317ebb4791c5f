import hashlib
import re

from llm_texts import prose

from stellate.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return WORD.findall((text or "").translate(LOWER))


def brute_force(text, items):
    w = split(text)
    hit, found = set(), set()
    for item_id, item in items:
        x = split(item)
        n = min(13, len(x))
        for i in range(len(x) - n + 1) if n else ():
            for j in range(len(w) - n + 1):
                if w[j : j + n] == x[i : i + n]:
                    hit.update(range(j, j + n))
                    found.add(str(item_id))
    return len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w)


def cases():
    long_item, other = prose(1, 40), prose(2, 25)
    items = [
        (1, long_item), (2, other), (3, "three word item"), (4, "É solo"), (5, None), (6, ""), (7, "-- !!"),
        (8, long_item), (9, " ".join(["the"] * 20)), (10, "three WORD, item"), (11, "a1b2"),
    ]
    w = long_item.split()
    texts = [
        None, "", "no words in common at all", prose(3, 50) + " " + " ".join(w[5:18]) + " " + prose(4, 50),
        prose(3, 50) + " " + " ".join(w[5:17]) + " " + prose(4, 50), long_item.upper().replace(" ", ", "),
        prose(5, 2000) + " " + other, "a Three-word item, and é SOLO", "É solo", "the " * 300, "the " * 12,
        " ".join(w[:13]) + " " + " ".join(w[7:30]), prose(6, 20000) + " a1b2 " + long_item, "x" * 100000,
    ]
    return texts, items


def test_matches_brute_force(spark, docs):
    texts, items = cases()
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id bigint, text string, key int")
    got = {r.doc_id: r for r in decontam.judge(docs([(i, t, "s") for i, t in enumerate(texts)]), bench).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.n_hit, r["items"], r.contaminated) == brute_force(t, items), i


def test_clean_documents_stay(spark, docs):
    texts, items = cases()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(None, texts[5], None), (None, None, "s"), (2, texts[2], "s")]
    kept = decontam.keep_clean(docs(rows), bench)
    want = sorted(str((i, t)) for i, t, _ in rows if not brute_force(t, items)[3])
    assert kept.columns == docs([]).columns
    assert sorted(str((r.doc_id, r.text)) for r in kept.collect()) == want


def test_empty_tables(spark, docs):
    items = spark.createDataFrame([], "item_id bigint, text string")
    out = decontam.judge(docs([(1, "some words", "s")]), items).collect()
    assert [(r.n_words, r.n_hit, r["items"], r.contaminated) for r in out] == [(2, 0, [], False)]
    full = spark.createDataFrame([(1, prose(1, 20))], "item_id bigint, text string")
    assert decontam.judge(docs([]), full).count() == 0


def test_no_python_in_the_plan(spark, docs):
    import contextlib
    import io

    bench = spark.createDataFrame([(1, prose(1, 20))], "item_id bigint, text string")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        decontam.judge(docs([(1, prose(1, 30), "s")]), bench).explain()
    assert "Python" not in buf.getvalue() and "Arrow" not in buf.getvalue() and "Cartesian" not in buf.getvalue()


def test_query_against_its_sql(spark):
    import duckdb

    from stellate.llm.catalog import ORACLE, QUERIES

    root = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{root}/{t}.parquet'")
    for name in ("op6_decontaminate", "op7_warc_round_trip"):
        got = QUERIES[name](spark, root)
        res = con.execute(ORACLE[name])
        cols = [d[0] for d in res.description]
        assert sorted(got.columns) == sorted(cols)
        assert sorted(map(str, (tuple(r) for r in got.select(*cols).collect()))) == sorted(map(str, res.fetchall()))
    assert hashlib.sha256(b"").hexdigest() in {r.items_sha256 for r in QUERIES["op6_decontaminate"](spark, root).collect()}
