"""Filter interaction audit against orders run one after the other."""

from itertools import permutations
from math import factorial

import helpers as H
from patrolspark.llm import filter_audit as A


def failing(rows):
    """Mask of each (doc_id, text, lang) row."""
    out = []
    for i, t, _ in rows:
        t = t or ""
        w = H.WORDS.findall(t)
        fails = [len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t),
                 any(c in "#$%&*|" for c in t), i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in rows)]
        out.append(sum(f << k for k, f in enumerate(fails)))
    return out


def brute(rows, labels):
    masks = failing(rows)
    good = {i for i, q, _ in labels if q == 1}
    toxic = {i for i, _, x in labels if x == 1}
    out = set()
    for part in {p or "" for _, _, p in rows}:
        own = [(i, m) for (i, _, p), m in zip(rows, masks, strict=True) if (p or "") == part]
        runs, total = [], [0] * 5
        for order in permutations(range(5)):
            left = list(own)
            for step, f in enumerate(order, 1):
                gone = [(i, m) for i, m in left if m >> f & 1]
                left = [(i, m) for i, m in left if not m >> f & 1]
                fail = [m for _, m in own if m >> f & 1]
                total[f] += len(gone)
                runs.append((part, "".join("ABCDE"[x] for x in order), step, len(left), len(gone), len(fail) - len(gone),
                             sum(m == 1 << f for m in fail), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)))
        out |= {(*r, total["ABCDE".index(r[1][r[2] - 1])]) for r in runs}
    return out


def table():
    prose = " ".join(f"w{k}" for k in range(250))
    rows = [(1, prose, "en"), (2, prose, "en"), (3, prose, None), (4, None, "de"), (5, "", "de"), (6, "A|B", "en"), (6, "A|B", "en"),
            (7, "aa " * 300, "en"), (8, "AA " * 300, "fr"), (None, prose, "en"), (9, prose + " $", ""), (10, "a b " * 210, "fr"),
            (11, "x" * 200_000, "en")]
    labels = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (3, None, 1), (4, 0, None), (7, 1, 1), (8, 1, 0), (99, 1, 1), (None, 1, 1)]
    return rows, labels


def frames(spark, rows, labels):
    return (spark.createDataFrame(rows, "doc_id long, text string, lang string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_equals_brute_force(spark):
    rows, labels = table()
    docs, marks = frames(spark, rows, labels)
    got = A.audit(A.counted(A.masked(H.with_clashes(docs)), H.with_clashes(marks))).collect()
    assert len(got) == 4 * 120 * 5 and set(map(tuple, got)) == brute(rows, labels)


def test_masks(spark):
    rows, labels = table()
    got = A.masked(frames(spark, rows, labels)[0]).collect()
    want = [(i, p or "", m) for (i, _, p), m in zip(rows, failing(rows), strict=True)]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_potential_is_the_mean_over_orders(spark):
    """For any game n! times the Shapley value is the marginal worth summed over all orders."""
    worth = [0, 3, 5, 8, 2, 5, 6, 9]
    q = spark.range(1).select(A.potentials(A.F.array(*map(A.F.lit, worth)), 3).alias("q")).first().q
    for i in range(3):
        total = sum(worth[sum(1 << k for k in o[:o.index(i) + 1])] - worth[sum(1 << k for k in o[:o.index(i)])]
                    for o in permutations(range(3)))
        assert q[7] - 3 * q[7 - (1 << i)] == total
    assert q[7] == factorial(2) * worth[7] + q[3] + q[5] + q[6]


def test_empty(spark):
    assert A.audit(A.counted(A.masked(frames(spark, [], [])[0]), frames(spark, [], [])[1])).collect() == []


def test_other_numbers_of_filters(spark):
    counts = spark.createDataFrame([("p", 1, 3, 1, 0), ("p", 3, 2, 0, 1), ("p", 0, 4, 0, 0)], "part string, mask int, n long, good long, toxic long")
    got = {(r.filter_order, r.step): tuple(r)[3:] for r in A.audit(counts, 2).collect()}
    assert got == {("AB", 1): (4, 5, 0, 3, 1, 1, 8), ("AB", 2): (4, 0, 2, 0, 0, 0, 2),
                   ("BA", 1): (7, 2, 0, 0, 0, 1, 2), ("BA", 2): (4, 3, 2, 3, 1, 0, 8)}
