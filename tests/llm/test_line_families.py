"""Large families of similar lines: all links are found, without a comparison of all pairs."""

import random

import brute

from wattframe.llm import linededup


def _family(n, size):
    """Lines with two or three letters of one base replaced, some also cut, extended or of four bytes a character."""
    dice = random.Random(3)
    base = [dice.choice("bfgjkqvw") for _ in range(size)]  # letters that are not counted
    lines = []
    for i in range(n):
        line = list(base)
        for at in dice.sample(range(size), 2 + i % 2):
            line[at] = dice.choice("xyz🙂")
        lines.append("".join(line))
    for line in lines[:30]:
        at, to = sorted(dice.sample(range(size), 2))
        lines += [line[:at] + line[at + 1:], line[:at] + "y" + line[at:],
                  line[:at] + line[at + 1:to] + "z" + line[to:], line[:at] + line[at + 1:to] + line[to + 1:],
                  line[:at] + "🙂" + line[at:to] + "x" + line[to:]]
    lines += ["".join([*base[:size // 2], c, *base[size // 2:]]) for c in "0123456789"]  # all linked with each other
    return sorted(set(lines), key=lines.index)


def test_family_links_are_found_without_all_pairs(spark, monkeypatch):
    seen, staged = {}, linededup.staged

    def counted(df, name):
        made = staged(df, name)
        seen[name] = max(seen.get(name, 0), made.count())
        return made

    monkeypatch.setattr(linededup, "staged", counted)
    monkeypatch.setattr(linededup, "MOST", 4, raising=False)
    lines = _family(250, 90)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    found = {(r.a, r.b) for r in linededup.line_links(docs)[1].selectExpr("a.doc_id a", "b.doc_id b").collect()}
    assert found == {(a, b) for b in range(len(lines)) for a in range(b)
                     if brute.edit_distance(lines[a], lines[b], 2) <= 2}
    assert len(found) > 200 and seen["met"] < len(found) + 10 * len(lines)
