import random
import re

from stellate.llm import secrets
from llm_texts import prose

ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
HEX40 = "0123456789abcdef0123456789abcdef01234567"


def rule_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda x: (x[1], secrets.KINDS.index(x[0])))


def test_rules_match_brute_force(docs):
    texts = [
        None, "", "nothing here", "Password = 'abc123'", "token=abc token=token:abcdef TOKEN: \"x+/=_-.9\"",
        "é日 secret: " + HEX40, "AKIA" + "A" * 15, "AKIA" + "A" * 16, "AKIAAKIA" + "B1" * 10, "a" * 23, "a" * 24,
        "api_key=1234567 apikey:1234567 api-key=1234567", "x" * 5000 + " passwd=secret99", "token==abcdef",
        " ".join(f"password=q{i:06d}" for i in range(700)),  # more matches than one block
        "Password = 'abc123'",
    ]
    frame = docs([(i, t, "s") for i, t in enumerate(texts)])
    table = [0.0] * (secrets.CODES**2)
    for r in secrets.find(frame, table).collect():
        got = [(secrets.KINDS[x.kind], x.s, x.e) for x in r.base]
        assert got == rule_spans(texts[r.doc_id] or ""), texts[r.doc_id]
        assert [(secrets.KINDS[x.kind], x.s, x.e) for x in r.spans] == got


def corpus(n: int = 60) -> list[str]:
    rng = random.Random(3)
    known = ["".join(rng.choice("0123456789abcdef") for _ in range(40)) for _ in range(n)]
    return [prose(i, 60) + " " + "kadalruvimosentipor " * 3 + f"token = {k}" for i, k in enumerate(known)]


def test_models_find_random_strings_and_leave_identifiers(docs):
    rng = random.Random(5)
    loose = ["".join(rng.choice(secrets.ALPHABET[:62]) for _ in range(32)) for _ in range(20)]
    words = ["kadalruvimosentipor", "KADALRUVIMOSENTIPOR", "sentipor_kadalruvi_mo", "dalruvi-mosentipor", "1234567890123456789"]
    texts = corpus() + [f"see {x} there" for x in loose] + [f"see {x} there" for x in words]
    frame = docs([(i, t, "s") for i, t in enumerate(texts)])
    found = {r.doc_id: [x for x in r.spans if x.kind == 3] for r in secrets.find(frame, secrets.train(frame)).collect()}
    n = len(corpus())
    assert sum(bool(found[n + i]) for i in range(20)) >= 19
    assert not any(found[n + 20 + i] for i in range(len(words)))
    for i in range(20):
        for x in found[n + i]:
            assert texts[n + i][x.s : x.e] == x.v


def test_without_samples_nothing_is_added(docs):
    frame = docs([(1, "x8Kq2LmZ0pQ7rT5vW9yB", "s"), (2, None, None)])
    assert all(not r.spans for r in secrets.find(frame, secrets.train(frame)).collect())


def test_redaction_replaces_spans_and_keeps_rows_and_columns(docs):
    text = "é before password=abcdef123 after AKIA" + "Z" * 16 + "!"
    frame = docs([(1, text, "s"), (2, None, None), (3, "", "s"), (None, "clean text", "s"), (1, text, "s")])
    out = secrets.redact(frame)
    assert out.columns == frame.columns
    rows = out.collect()
    assert len(rows) == 5
    want = "é before [SECRET] after [SECRET]!"
    assert [r.text for r in rows if r.doc_id == 1] == [want, want]
    assert {r.n_chars for r in rows if r.doc_id == 1} == {len(want)}
    assert [r.text for r in rows if r.doc_id == 2] == [None]
    assert [r.text for r in rows if r.doc_id is None] == ["clean text"]


def test_empty_table(docs):
    frame = docs([])
    assert secrets.find(frame, secrets.train(frame)).count() == 0
    assert secrets.redact(frame).count() == 0


def overlapping_corpus():
    """Tokens beside, inside and around spans of the rules, also over the edges of blocks."""
    rng = random.Random(17)
    parts = []
    for _ in range(1500):
        word = "".join(rng.choice(secrets.ALPHABET) for _ in range(rng.randint(14, 40)))
        parts.append(rng.choice([
            word, f"password={word}", f"x{word}AKIA{'Q' * 20}", HEX40, f"{word}.token:{word}", "é日", f"secret='{word}'", "a b",
        ]))
    return rng.choice([" ", "\n"]).join(parts)


def test_spans_and_redaction_equal_the_plain_definition(docs):
    text = overlapping_corpus()
    frame = docs([(1, text, "s"), (2, text[: len(text) // 3], "s")])
    table = [0.02] * (secrets.CODES**2)  # every token is a secret unless it touches a span of the rules
    for r in secrets.find(frame, table, scan=secrets.Scan(threshold=0.1)).collect():
        base = rule_spans(r.text)
        free = [("markov", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9+/_=-]{16,}", r.text)]
        free = [t for t in free if not any(b[1] < t[2] and t[1] < b[2] for b in base)]
        want = sorted(base + free, key=lambda x: (x[1], secrets.KINDS.index(x[0])))
        assert [(secrets.KINDS[x.kind], x.s, x.e) for x in r.spans] == want
        assert len(free) > 50 and len(base) > 300
    (out,) = secrets.redact(docs([(1, text, "s")])).collect()
    (found,) = secrets.find(docs([(1, text, "s")]), secrets.train(docs([(1, text, "s")]))).collect()
    plain, at = [], 0
    for x in found.spans:
        if x.s >= at:
            plain += [text[at : x.s], "[SECRET]"]
        at = max(at, x.e)
    assert out.text == "".join(plain) + text[at:]


def test_a_text_of_many_spans_takes_little_time(docs):
    import time

    text = " ".join(f"password=q{i:06d} Tokenlike{i:012d}" for i in range(20_000)) + " é"
    frame = docs([(1, text, "s")])
    table = [0.0] * (secrets.CODES**2)
    start = time.time()
    (r,) = secrets.find(frame, table).selectExpr("size(base) n").collect()
    (out,) = secrets.redact(frame).collect()
    assert r.n == 20_000 and out.text.count("[SECRET]") >= 20_000 and out.text.endswith(" é")
    assert time.time() - start < 60  # it took minutes when each token looked at each span


def test_registered_query_on_the_whole_small_table(spark, small_docs):
    import hashlib

    from stellate.llm.catalog import QUERIES

    texts = {r.doc_id: r.text or "" for r in small_docs.collect()}
    rows = QUERIES["op2_secret_scan"](spark, "/root/testdata/sf0.001").collect()
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        base = rule_spans(texts[r.doc_id])
        kinds = [k for k, _, _ in base]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(kinds.count(k) for k in ("assign", "access", "hex"))
        listed = [f"{k}:{s}:{e}" for k, s, e in base]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(r.spans.split(",")) | {""} and (listed or r.spans == "" or "markov" in r.spans)
