"""Rules that differ on few rows."""

import numpy as np

from wattframe.llm import classifier


def test_rules_for_rare_rows_are_kept_apart():
    values, labels = np.zeros((6000, len(classifier.FEATURES))), np.ones(6000)
    for feature, start in ((0, 3000), (1, 4000), (2, 5000)):  # each kind of junk after the first 2,000 rows
        values[start:start + 400, feature], labels[start:start + 400] = 1.0, 0.0
    model = classifier.fit(values, labels)
    met = [sum(w for rule, w in model.rules if all((row[f] <= v) == low for f, low, v in rule)) + model.bias
           for row in values]
    assert np.mean((np.array(met) > 0) == (labels > 0)) == 1


def test_equal_rules_are_merged_at_every_size():
    matrix = np.zeros((100, 4), np.float32)
    matrix[90:, 1:3], matrix[99, 3] = 1, 1
    assert classifier._unlike(matrix) == [0, 1, 3]
