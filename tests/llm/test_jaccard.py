import random
import re

import numpy as np
import pytest
from conftest_llm import words

from tierline.llm import jaccard as J

_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sets_of(rows, k):
    out = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(_LOWER))
        s = {tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
        out.append((i, frozenset(s)))
    return out


def brute(rows, k, percent):
    sets = [(i, s) for i, s in sets_of(rows, k)]
    up = list(range(len(sets)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in range(len(sets)):
        for b in range(a):
            s, t = sets[a][1], sets[b][1]
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    low = {}
    for a, (i, _) in enumerate(sets):
        low[find(a)] = min(low.get(find(a), i), i)
    return sorted((i, len(s), low[find(a)]) for a, (i, s) in enumerate(sets))


def near_copies(n_groups, seed):
    rng = random.Random(seed)
    rows = []
    for g in range(n_groups):
        base = words(rng, rng.randrange(3, 400)).split()
        for _ in range(rng.randrange(1, 6)):
            w = list(base)
            for _ in range(rng.randrange(0, 1 + len(w) // 40)):
                w[rng.randrange(len(w))] = f"z{rng.randrange(9)}"
            if rng.random() < 0.2:
                w += words(rng, rng.randrange(1, 12)).split()
            rows.append(" ".join(w).upper() if rng.random() < 0.1 else " ".join(w))
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80), (2, 60)])
def test_against_brute_force(spark, docs_of, k, percent):
    rows = near_copies(70, k) + [(9000, None), (9001, ""), (9002, " \t"), (9003, "One"), (9004, "oNE"),
                                 (9005, "one two"), (9006, "A\x0bb c d"), (9007, "a b c d")]
    out = J.op4_jaccard_join(spark, docs_of(rows, clash=["n_shingles", "set_id", "keys"]), k, percent)
    assert sorted(map(tuple, out.collect())) == brute(rows, k, percent)


def test_large_groups_are_joined_across_blocks(spark, docs_of, monkeypatch):
    monkeypatch.setattr(J, "BLOCK_TOKENS", 400)
    rng = random.Random(5)
    base = words(rng, 100).split()
    rows = []
    for i in range(60):
        w = list(base)
        w[rng.randrange(100)] = f"q{i}"
        rows.append((i, " ".join(w)))
    # A chain whose ends do not link, to be found across blocks.
    for i in range(12):
        rows.append((100 + i, " ".join(base[4 * i:] + [f"c{j}" for j in range(4 * i)])))
    # Another family of the same group, twice as long, in several blocks.
    for i in range(40):
        rows.append((200 + i, " ".join(base + [f"d{j}" for j in range(30 + i)] + [f"e{i}{j}" for j in range(i % 7)])))
    monkeypatch.setattr(J, "_routing_keys", lambda doc, tok, n, p, hot: (
        np.arange(n)[np.bincount(doc, minlength=n) > 0],
        np.zeros((np.bincount(doc, minlength=n) > 0).sum(), np.uint64)))  # one group of everything
    out = J.op4_jaccard_join(spark, docs_of(rows), 3, 85)
    assert sorted(map(tuple, out.collect())) == brute(rows, 3, 85)


def test_repeated_rows_and_null_ids(spark, docs_of):
    t = "the quick brown fox jumps over it all"
    out = J.op4_jaccard_join(spark, docs_of([(7, t), (7, t), (3, t), (None, t), (8, "other words are here")]))
    got = sorted(out.collect(), key=str)
    assert [(r.doc_id, r.component_id) for r in got if r.doc_id == 7] == [(7, 3), (7, 3)]
    assert [r.component_id for r in got if r.doc_id is None] == [None]
    assert J.op4_jaccard_join(spark, docs_of([(1, t)]).limit(0)).count() == 0


def test_tree_prunes_pairs():
    import numpy as np
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 1 << 60, 100, dtype=np.uint64)) for _ in range(400)]
    sets += [np.unique(np.append(s[3:], rng.integers(0, 1 << 60, 2, dtype=np.uint64))) for s in sets[:50]]
    tree = J.SignatureTree(sets)
    links = {tuple(sorted(x)) for x in tree.join()}
    assert links == {(i, 400 + i) for i in range(50)}
    assert tree.verified < 1000  # of 101,025 pairs


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_linked_sets_always_share_a_routing_key(percent):
    import numpy as np
    rng = np.random.default_rng(percent)
    linked = 0
    for _ in range(1500):
        n = int(rng.integers(1, 80))
        a = np.unique(rng.integers(0, 1 << 60, n, dtype=np.uint64))
        d = int(rng.integers(0, 1 + len(a) * (100 - percent) // percent))
        drop = int(rng.integers(0, d + 1))
        b = np.unique(np.append(rng.permutation(a)[drop:], rng.integers(0, 1 << 60, d - drop, dtype=np.uint64)))
        if not len(b) or 100 * len(np.intersect1d(a, b)) < percent * len(np.union1d(a, b)):
            continue
        linked += 1
        both = np.union1d(a, b)
        hot = np.sort(rng.permutation(both)[:int(rng.integers(0, len(both) + 1))])
        doc = np.repeat([0, 1], [len(a), len(b)])
        d, k = J._routing_keys(doc, np.concatenate([a, b]), 2, percent, hot)
        assert np.intersect1d(k[d == 0], k[d == 1]).size
    assert linked > 500


def test_a_common_passage_connects_nobody(spark, docs_of):
    rng = random.Random(8)
    passage = words(rng, 60)
    rows = [(i, words(rng, 200, 90_000) + " " + passage + " " + words(rng, 200, 90_000)) for i in range(60)]
    docs = docs_of(rows)
    sig = J.set_ids(docs, 5)
    n, total = 60, sum(r.n_shingles for r in sig.collect())
    hot = J.common_shingles(docs, n, total, 5)
    assert 50 <= len(hot) <= 60
    assert J.shared_keys(docs, hot, 5, 80).count() == 0


@pytest.mark.parametrize("block", [60, 400])
def test_size_bands_lose_no_link(spark, docs_of, monkeypatch, block):
    """A chain of texts of slowly rising sizes that all share some shingles:
    one candidate group, cut by size bands, some of which do not fit."""
    monkeypatch.setattr(J, "BLOCK_TOKENS", block)
    rows, n = [], 0
    for size in range(12, 120, 3):
        for copy in range(3 if size % 2 else 1):
            words = [f"w{i}" for i in range(size)]
            words[size // 2] = f"x{copy}" if copy else words[size // 2]
            rows.append((n, " ".join(words)))
            n += 1
    rows += [(500 + i, "a b c d e " + " ".join(f"r{i}_{k}" for k in range(20 + i))) for i in range(20)]
    df = docs_of(rows)
    for words, percent in ((3, 90), (5, 80)):
        got = {tuple(r) for r in J.op4_jaccard_join(spark, df, words, percent).collect()}
        assert got == set(brute(rows, words, percent))


def test_sets_that_meet_in_chance_shingles_reach_no_tree(monkeypatch):
    """A group of unlike sets chained by single shingles, of like sizes: only
    the few that share the most of their shingles are compared."""
    rng = np.random.default_rng(4)
    sets = [rng.integers(0, 1 << 60, 100, dtype=np.uint64) for _ in range(300)]
    for i in range(1, 300):
        sets[i][0] = sets[i - 1][1]  # neighbours share one
    sets += [np.append(s[5:], rng.integers(0, 1 << 60, 5, dtype=np.uint64)) for s in sets[:20]]
    sets = [np.unique(s) for s in sets]
    compared, tree = [], J.SignatureTree
    monkeypatch.setattr(J, "SignatureTree", lambda some, *a: compared.append(len(some)) or tree(some, *a))
    assert {tuple(sorted(x)) for x in J._solve(sets, None, 80)} == {(i, 300 + i) for i in range(20)}
    assert sum(compared) < 60 and max(compared) < 6
    # sets known to be connected need no link
    assert len(J._solve(sets, [i % 300 if i % 300 < 10 else None for i in range(320)], 80)) == 10
    assert J._solve([], None, 80) == J._solve([sets[0]], None, 80) == []


@pytest.mark.parametrize("run", [1, 4000, 8 << 20])
def test_shared_shingles_are_counted_across_runs(spark, docs_of, monkeypatch, run):
    """Whatever texts a task sees together; copies of one text share nothing."""
    monkeypatch.setattr(J, "RUN_BYTES", run)
    monkeypatch.setattr(J, "COUNTS", min(run, 50))
    rng = random.Random(2)
    rows = near_copies(25, 9) + [(700 + i, "one text alone in three rows here") for i in range(3)]
    rows += [(800 + i, "a very common passage of words " + words(rng, 40, 90_000)) for i in range(60)]
    docs = docs_of(rows + [(None, rows[0][1]), (900, None), (901, "")])
    sets = {s for _, s in sets_of(rows, 3) if s}
    times = {}
    for s in sets:
        for x in s:
            times[x] = times.get(x, 0) + 1
    of_id = {r.doc_id: r.set_id for r in J.set_ids(docs, 3).collect()}
    want = {of_id[i]: (len(s), sum(times[x] > 1 for x in s)) for i, s in sets_of(rows, 3) if s}
    got = {r.set_id: r.n_shared for r in J.shared_counts(docs, 3).collect()}
    assert set(got) <= set(want)
    once = {s for s in want if list(of_id.values()).count(s) == 1}
    for s, (_, shared) in want.items():
        assert got.get(s, 0) == shared if s in once else got.get(s, 0) >= shared
    assert got.get(of_id[700], 0) == 0


def test_only_sets_that_may_link_are_routed(spark, docs_of, monkeypatch):
    rng = random.Random(6)
    rows = [(i, words(rng, 60, 90_000) + " they all share this line of seven words") for i in range(40)]
    rows += [(100 + i, rows[i][1] + " end") for i in range(5)]
    routed, routing = [], J.shared_keys
    monkeypatch.setattr(J, "shared_keys", lambda docs, *a: routed.append(docs.count()) or routing(docs, *a))
    out = J.op4_jaccard_join(spark, docs_of(rows), 5, 80)
    assert sorted(map(tuple, out.collect())) == brute(rows, 5, 80)
    assert routed == [10]
