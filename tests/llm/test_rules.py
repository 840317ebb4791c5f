import re
from collections import Counter

from llm_texts import prose

from stellate.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    t = text or ""
    w = WORD.findall(t)
    win = Counter(tuple(w[j : j + 5]) for j in range(len(w) - 4))
    again = {k for j in range(len(w) - 4) if win[tuple(w[j : j + 5])] > 1 for k in range(j, j + 5)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", t))
    return len(w), sum(map(len, w)), symbols, dup, len(again), len(w) < 10 or 100 * len(again) > 20 * len(w)


TEXTS = [
    None, "", " \n\t\n ", "few words only", prose(1, 10), prose(2, 300), "a b c d e " * 30, "é日 | x # <tag> &\x0b\x0c " * 3,
    "line one is here\nline one is here\nline one is here \n\n\nlast", prose(3, 20000), prose(4, 60) + " " + prose(4, 60),
    prose(5, 40) + " " + "word word", "w " * 9, "x" * 200000,
]


def test_counts_match_brute_force(docs):
    frame = docs([(i, t, "s" if i % 2 else None) for i, t in enumerate(TEXTS)])
    for r in rules.judge(frame).collect():
        got = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
        assert got == counts(TEXTS[r.doc_id]), r.doc_id


MENU = "home about contact imprint privacy cookies terms of use and of this site"


def test_shared_lines_go_and_depleted_documents_are_rejected(docs):
    limits = rules.Limits(max_docs=5)
    good = [(i, f"{prose(10 + i, 60)}\n{MENU} {i % 10}\n{prose(50 + i, 40)}", "h") for i in range(12)]
    husks = [(100 + i, f"{prose(900 + i, 3)}\n{MENU} {i}", "h") for i in range(12)]
    elsewhere = [(200 + i, f"{prose(300 + i, 3)}\n{MENU} {i}", f"host{i}") for i in range(12)]
    copies = [(300 + i, prose(7, 30) + "\n" + prose(8, 30), "h") for i in range(40)]
    rows = good + husks + elsewhere + copies + [(None, None, None), (1, good[1][1], "h")]
    got = {}
    for r in rules.judge(docs(rows), limits=limits).collect():
        got.setdefault(r.doc_id, []).append((r.kept, r.words_left, r.n_words))
    menu_words = len(MENU.split()) + 1
    assert all(got[i][0] == (True, 100, 100 + menu_words) for i in range(12))
    assert not any(got[100 + i][0][0] for i in range(12))  # little is left
    assert all(got[200 + i][0][0] for i in range(12))  # a host of its own each: nothing shared
    assert all(got[300 + i][0][0] for i in range(40))  # copies are one document, not boilerplate
    assert got[1][0] == got[1][1]


def test_hosts_of_mostly_template_pages(docs):
    """At the default limits: pages of 80 to 95% template are told apart by the few words that are their own."""
    rows = []
    for body, shared in ((5, 60), (10, 60), (20, 90), (30, 130)):
        lines = prose(5000 + shared + body, shared).split()
        menu = "\n".join(" ".join(lines[i : i + 10]) for i in range(0, shared, 10))
        rows += [(len(rows) + i, f"{menu}\n{prose(6000 + 1000 * body + i, body)}", f"h{body}") for i in range(60)]
    for r in rules.judge(docs(rows)).collect():
        body = (5, 10, 20, 30)[r.doc_id // 60]
        assert (r.words_left, r.kept) == (body, False), r.doc_id


def test_copies_of_one_page_do_not_save_a_shared_line(docs):
    pages = [(i, f"{prose(7000 + i, 40)}\n{MENU}", "h") for i in range(30)]
    husks = [(100 + i, f"{prose(7100 + i, 2)}\n{MENU}", "h") for i in range(5)]
    copies = [(1000 + i, f"{prose(7200, 40)}\n{MENU}", "h") for i in range(200)]
    got = {r.doc_id: (r.words_left, r.kept) for r in rules.judge(docs(pages + husks + copies)).collect()}
    assert all(got[i] == (40, True) for i in (*range(30), *range(1000, 1200)))
    assert all(got[100 + i] == (2, False) for i in range(5))


def test_keep_good_keeps_columns_and_rows(docs):
    frame = docs([(1, prose(1, 50), "s"), (1, prose(1, 50), "s"), (2, "short", "s"), (None, prose(2, 50), None), (3, None, "s")])
    kept = rules.keep_good(frame)
    assert kept.columns == frame.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "None"]


def test_empty_table(docs):
    assert rules.judge(docs([])).count() == 0
    assert rules.keep_good(docs([])).count() == 0
