import random
from collections import defaultdict

import numpy as np
import pytest

from sieveworks.llm import lines


def brute(rows):
    n, docs, at = defaultdict(int), defaultdict(set), defaultdict(list)
    for i, c, text in rows:
        if c and c.strip():
            n[c] += 1
            for k, line in enumerate((text or "").split("\n") if text is not None else [], 1):
                key = "".join(filter(str.isalpha, line)).lower()
                if key:
                    docs[c, key].add(i)
                    at[c, key].append((i, k))
    return sorted({p for k, v in docs.items() if len(v) >= 8 and len(v) >= 0.1 * n[k[0]] for p in at[k]})


@pytest.mark.parametrize("chunk", [7, 8_000])
def test_matches_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(lines, "CHUNK_ROWS", chunk)
    rnd = random.Random(3)
    rows = []
    for i in range(220):
        c = rnd.choice(["hot"] * 6 + ["a", "b", None, "  "])
        body = [f"line {rnd.choice('abcdefghij')} {rnd.choice('klmnopqrst')}" for _ in range(rnd.randint(0, 6))]
        if rnd.random() < 0.5:
            body += ["Notice %d!" % i, "", "Second NOTICE", "123"]
        rows.append((i, c, None if rnd.random() < 0.05 else "\n".join(body)))
    df = spark.createDataFrame(rows, "row_id long, company_name string, description string")
    got = sorted((r.row_id, r.line_no) for r in lines.repeated_lines(df, "row_id", "description", "company_name").collect())
    assert got == brute(rows) and got


def test_suffix_array_and_prefixes():
    ids = np.array([3, 1, 3, 1, -1, 3, 1, -2])
    order, lcp = lines.suffix_array(ids)
    want = sorted(range(len(ids)), key=lambda i: list(ids[i:]))
    assert [list(ids[i:]) for i in order] == [list(ids[i:]) for i in want]
    assert list(lcp[1:]) == [next((k for k, (x, y) in enumerate(zip(ids[a:], ids[b:])) if x != y), min(len(ids[a:]), len(ids[b:]))) for a, b in zip(order, order[1:])]


def closed_by_hand(docs, need):
    places = defaultdict(list)
    for d, x in enumerate(docs):
        for i in range(len(x)):
            for j in range(i + 1, len(x) + 1):
                places[tuple(x[i:j])].append((d, i))
    out = set()
    for k, p in places.items():
        more = [len(q) for e, q in places.items() if len(e) == len(k) + 1 and k in (e[:-1], e[1:])]
        if len({d for d, _ in p}) >= need and len(p) not in more:
            out.add(k)
    return out


def test_closed_blocks_equal_brute_force():
    rnd = random.Random(4)
    for _ in range(60):
        docs = [[rnd.randint(0, 3) for _ in range(rnd.randint(1, 7))] for _ in range(rnd.randint(1, 9))]
        ids = np.array([v for d, x in enumerate(docs) for v in [*x, -1 - d]])
        doc = np.array([d for d, x in enumerate(docs) for _ in [*x, 0]])
        need = rnd.randint(2, 3)
        got = [tuple(ids[a : a + n].tolist()) for a, n in lines.closed_blocks(ids, doc, np.full(len(ids), need))]
        assert len(got) == len(set(got)) and set(got) == closed_by_hand(docs, need)


def test_blocks_of_several_lines(spark):
    """Two notices that always stand together are one block; a line that also stands alone is another."""
    rows = [(i, "acme", f"text {chr(97 + i)}\nNotice one\n\nNotice two\nend {chr(107 + i)}") for i in range(10)] + [(20 + i, "acme", f"Share this\nNotice two {i}!\nbody {chr(97 + i)}") for i in range(9)]
    df = spark.createDataFrame(rows, "row_id long, company_name string, description string")
    got = sorted((r.n_lines, r.docs, r.occurrences, r.first_row, r.first_line) for r in lines.find_blocks(df, "row_id", "description", "company_name")[1].collect())
    assert got == [(1, 19, 19, 0, 4), (2, 9, 9, 20, 1), (2, 10, 10, 0, 2)]


def test_removal_and_empty(spark):
    df = spark.createDataFrame([(1, "a\nb\n\nc"), (2, None), (3, "")], "row_id long, text string")
    found = spark.createDataFrame([(1, 2)], "row_id long, line_no long")
    assert {r.row_id: r.text for r in lines.without_lines(df, "row_id", "text", found).collect()} == {1: "a\n\nc", 2: None, 3: ""}
    jobs = spark.createDataFrame([], "row_id long, company_name string, description string")
    assert lines.repeated_lines(jobs, "row_id", "description", "company_name").collect() == []
