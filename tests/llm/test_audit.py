"""The filter audit against every order applied to every document."""

import random
import re
from itertools import permutations

import pytest

from tenura.llm.audit import audit_orders, filter_audit, intervals, order_totals

LABELS = "doc_id long, quality int, toxic int"


def failed(rows):
    least = {}
    for key, text, _ in rows:
        if key is not None:
            least[text or ""] = min(key, least.get(text or "", key))
    out = []
    for key, text, _ in rows:
        text = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", text)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
            "D": any(c in "#$%&*|" for c in text), "E": key is not None and least[text] < key,
        }
        out.append({c for c, f in fails.items() if f})
    return out


def expected(rows, labels):
    good = {k for k, q, _ in labels if q == 1}
    toxic = {k for k, _, t in labels if t == 1}
    found, out = failed(rows), {}
    for order in map("".join, permutations("ABCDE")):
        for (key, _, source), fails in zip(rows, found):
            gone = False
            for step, c in enumerate(order, 1):
                cell = out.setdefault((source or "", order, step), [0] * 6)
                here = c in fails
                cell[0] += not gone and not here
                cell[1] += here and not gone
                cell[2] += here and gone
                cell[3] += fails == {c}
                cell[4] += here and not gone and key in good
                cell[5] += here and not gone and key in toxic
                gone = gone or here
    shapley = {}
    for (part, order, step), cell in out.items():
        at = (part, order[step - 1])
        shapley[at] = shapley.get(at, 0) + cell[1]
    return sorted((*at, *cell, shapley[at[0], at[1][at[2] - 1]]) for at, cell in out.items())


def told(df):
    return sorted(map(tuple, df.collect()))


@pytest.fixture
def cases():
    rng = random.Random(9)
    words = ["tale", "Tale", "tales", "river", "the", "AND", "of", "5%", "a|b"] + [f"w{i}" for i in range(300)]
    texts = ["", None, " ", "x", "x"] + [" ".join(rng.choices(words[: rng.choice([3, 20, 309])], k=rng.choice([5, 199, 200, 260]))) for _ in range(60)]
    texts += texts[10:25] + [texts[12]] * 20
    rows = [(i, t, rng.choice(["web", "book", None, ""])) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 100, 2)]
    return rows, labels


def test_against_every_order(spark, documents, clashing, cases):
    rows, labels = cases
    df = filter_audit(clashing(documents(rows, partitions=4)), spark.createDataFrame(labels, LABELS))
    assert told(df) == expected(rows, labels)


def test_repeated_ids_rows_and_labels(spark, documents, cases):
    rows, labels = cases
    rows = rows + rows[:9] + [(None, "x", "web"), (None, "x", None), (0, "x", "book"), (5, "y", "new")]
    df = filter_audit(documents(rows), spark.createDataFrame(labels + [(4, 0, 1), (4, 1, 0), (None, 1, 1)], LABELS))
    assert told(df) == expected(rows, labels + [(4, 1, 1)])


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], LABELS)
    assert filter_audit(documents([(1, "a", "s")]).filter("doc_id < 0"), none).collect() == []
    df = filter_audit(documents([(1, "a b", "s")]), none)
    rows = df.collect()
    assert len(rows) == 600 and {r.shapley for r in rows} == {0, 120}  # too short, nothing else


def test_intervals_are_lexicographic_ranks():
    orders = list(permutations(range(4)))
    for before, i, begin, end in intervals(4):
        step = before.bit_count()
        inside = [r for r, o in enumerate(orders) if set(o[:step]) == {j for j in range(4) if before >> j & 1} and o[step] == i]
        assert set(range(begin, end)) <= set(inside)
    assert len(intervals(5)) == 325


def test_counts_beyond_doubles():
    n = 2**55 + 1
    totals = order_totals({1: (n, 0, 0), 0: (1, 0, 0)}, 2)
    assert totals[0, 0].tolist() == [1, n, 0, n, 0, 0, 2 * n]


def test_other_numbers_of_filters(spark):
    masks = spark.createDataFrame([("p", 1, 5, 2, 1), ("p", 3, 4, 0, 0)], "part string, mask int, n long, good long, toxic long")
    rows = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.shapley) for r in audit_orders(masks, "AB").collect()}
    assert rows == {("AB", 1): (0, 9, 0, 14), ("AB", 2): (0, 0, 4, 4), ("BA", 1): (5, 4, 0, 4), ("BA", 2): (0, 5, 4, 14)}
    with pytest.raises(ValueError):
        audit_orders(masks, "ABCDEFGH")
