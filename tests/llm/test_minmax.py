import random
from collections import Counter

import numpy as np
from llm_texts import prose

from stellate.llm import minmax


def sets_of(texts, size=4):
    out = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        out[i] = frozenset(tuple(w[j : j + size]) for j in range(max(1, len(w) - size + 1))) if w else frozenset()
    return out


def brute_force(texts):
    sets = sets_of(texts)
    parent = {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = [i for i in texts if sets[i]]
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in texts}


def edited(text: str, edits: int, seed: int) -> str:
    rng = random.Random(seed)
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


def corpus() -> dict[int, str | None]:
    rng = random.Random(9)
    texts: list[str | None] = [None, "", " \t\n", "one", "one", "one two", "One  TWO", "one two three four"]
    for k in range(12):
        base = prose(100 + k, rng.randint(30, 200))
        texts += [base, base, base.upper()]
        texts += [edited(base, e, 7 * k + e) for e in range(1, 9)]
    hot = prose(500, 120)
    texts += [edited(hot, rng.randint(0, 7), 1000 + i) for i in range(150)]
    texts += [hot] * 40
    drift = prose(600, 150)  # a chain: each version near the last, the ends far apart
    for i in range(12):
        drift = edited(drift, 3, 2000 + i)
        texts.append(drift)
    texts.append(prose(700, 20000))
    return dict(enumerate(texts))


def test_components_match_brute_force(docs):
    texts = corpus()
    rows = list(texts.items())
    random.Random(3).shuffle(rows)
    frame = docs([(i, t, "s") for i, t in rows])
    small_blocks = minmax.Settings(block_docs=32, block_shingles=5000)
    want = brute_force(texts)
    for settings in (minmax.Settings(), small_blocks):
        got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in minmax.near_duplicates(frame, settings=settings).collect()}
        assert got == want


def test_the_threshold_itself_links(docs):
    """Exactly 80 of 100: 8 shared shingles of 10."""
    a = "a b c d e f g h i j k l"  # 9 shingles
    b = "a b c d e f g h i j k z"  # 8 shared, 10 in all
    c = "a b c d e f g h i j y z"  # 7 of 11 with a, 7 of 11 with b... below
    got = {r.doc_id: r.component_id for r in minmax.near_duplicates(docs([(1, a, "s"), (2, b, "s"), (3, c, "s")])).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_repeated_rows_null_ids_and_the_one_that_stays(docs):
    t = prose(1, 50)
    frame = docs([(5, t, "s"), (5, t, "s"), (3, t, None), (None, t, "s"), (None, None, None), (7, prose(2, 50), "s")])
    got = Counter((r.doc_id, r.component_id, r.kept) for r in minmax.near_duplicates(frame).collect())
    assert got == Counter({(5, 3, False): 2, (3, 3, True): 1, (None, 3, False): 1, (None, None, True): 1, (7, 7, True): 1})
    stay = minmax.one_of_each(frame)
    assert stay.columns == frame.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in stay.collect()) == [(False, 3), (False, 7), (True, 0)]


def test_two_texts_under_one_id_go_their_own_ways(docs):
    a, b, c = prose(11, 60), prose(12, 60), prose(13, 60)
    frame = docs([(1, a, "s"), (1, b, "s"), (2, c, "s"), (2, edited(b, 1, 5), "s"), (0, c, "s"), (9, "", "s"), (9, "", "s")])
    stay = Counter((r.doc_id, r.text) for r in minmax.one_of_each(frame).collect())
    assert stay == Counter({(1, a): 1, (1, b): 1, (0, c): 1, (9, ""): 2})
    got = Counter((r.doc_id, r.component_id, r.kept) for r in minmax.near_duplicates(frame).collect())
    assert got == Counter({(1, 1, True): 2, (2, 0, False): 1, (2, 1, False): 1, (0, 0, True): 1, (9, 9, True): 2})


def test_copies_with_null_ids_are_thinned_out(docs):
    a, b = prose(21, 60), prose(22, 60)
    frame = docs([(None, a, "s"), (None, a, "t"), (None, edited(a, 1, 3), "s"), (None, b, "s"), (4, b, "s")])
    assert sorted(((r.doc_id, r.text == b) for r in minmax.one_of_each(frame).collect()), key=repr) == [(4, True), (None, False)]


def test_registered_query_on_the_whole_small_table(spark, small_docs):
    from stellate.llm.catalog import QUERIES

    want = brute_force({r.doc_id: r.text for r in small_docs.collect()})
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in QUERIES["op5_minmax_near_dedup"](spark, "/root/testdata/sf0.001").collect()}
    assert got == want


def test_empty_table(docs):
    assert minmax.near_duplicates(docs([])).count() == 0
    assert minmax.one_of_each(docs([])).count() == 0


def test_both_ends_of_a_permutation_estimate_similarity():
    """The share of equal entries among minima and maxima estimates the Jaccard similarity."""
    rng = np.random.default_rng(4)
    common, extra = rng.integers(0, 1 << 63, 800, dtype=np.uint64), rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    s = minmax.Settings(bands=400, rows=2)  # one permutation a band: both ends agree with about J squared
    a = minmax.band_keys(np.unique(np.concatenate((common, extra[:100]))), s)
    b = minmax.band_keys(np.unique(np.concatenate((common, extra[100:]))), s)
    assert abs((a == b).mean() - 0.64) < 0.1
