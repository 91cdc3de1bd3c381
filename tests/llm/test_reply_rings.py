"""Reply trees and rings of replies against a plain walk."""

import random

import pytest

from wattframe.llm import chat

KINDS = "conv_id long, message long, parent long, role string, text string, score double"


def plain(rows, best):
    """(conv, branch) -> messages from the root, for the best branches by mean score and then by leaf."""
    found = {}
    for conv in {r[0] for r in rows}:
        parent = {m: p for c, m, p, *_ in rows if c == conv}
        score = {r[1]: r[5] for r in rows if r[0] == conv}
        parent = {m: p if p in parent else None for m, p in parent.items()}
        for m in sorted(parent):  # open each ring at its smallest message
            seen, at = [], m
            while at is not None and at not in seen:
                seen.append(at)
                at = parent[at]
            if at == m == min(seen):
                parent[m] = None
        given = {p for c, m, p, *_ in rows if c == conv and p in score and parent[m] is not None}
        paths = []
        for leaf in set(parent) - given:
            path, at = [], leaf
            while at is not None:
                path.append(at)
                at = parent[at]
            paths.append((-sum(score[m] for m in path) / len(path), leaf, path[::-1]))
        for rank, (_, _, path) in enumerate(sorted(paths)[:best], 1):
            found[conv, rank] = path
    return found


def walked(spark, rows, best):
    made = {}
    table = spark.createDataFrame(rows, KINDS)
    for r in sorted(chat.branches(table, best).collect(), key=lambda r: (r.conv_id, r.branch, r.position)):
        made.setdefault((r.conv_id, r.branch), []).append(int(r.text))
    return made


def message(conv, m, parent, score=1.0):
    return conv, m, parent, "user", str(m), float(score)


def test_rings(spark):
    rows = [message(1, 1, 2), message(1, 2, 1), message(2, 5, 5), message(3, 3, 4), message(3, 4, 7), message(3, 7, 3),
            message(3, 1, 4), message(3, 2, 1), message(4, 1, None), message(4, 2, 1), message(5, 9, 77)]
    assert walked(spark, rows, 9) == plain(rows, 9)
    assert walked(spark, rows[:2], 1) == {(1, 1): [1, 2]}
    lone = [message(None, 1, 2), message(None, 2, 1), message(None, 3, 3)]
    assert walked(spark, lone, 2) == {(None, 1): [1, 2], (None, 2): [3]}


@pytest.mark.parametrize("rings", [False, True])
def test_random_trees(spark, rings):
    chance, rows = random.Random(4), []
    for conv in range(30):
        ids = chance.sample(range(100), chance.randint(1, 12))
        for at, m in enumerate(ids):
            parent = chance.choice(ids if rings else ids[:at] + [None]) if at or rings else None
            rows.append(message(conv, m, parent, chance.randint(0, 64)))
    assert walked(spark, rows, 3) == plain(rows, 3)
