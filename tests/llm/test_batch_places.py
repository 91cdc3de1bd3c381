"""Fingerprints and the place of a text in its batch."""

from prose import prose

from wattframe.llm import parsing


def test_signatures_do_not_depend_on_the_place_in_a_batch():
    for seed in range(40):
        a, b = prose(5 + seed, seed), prose(7 + seed, 100 + seed)
        both = parsing.signatures([a, b])
        assert (both == parsing.signatures([b, a])[::-1]).all()
        assert (both[0] == parsing.signatures([a])[0]).all()
        assert (both[0] == parsing.signatures([a, "", ""])[0]).all()
