"""Rounded widths of ranges near the least number."""

from churnframe.operators.profile import _multiple, rounded_width


def test_least_numbers():
    for hi in (5e-324, 1.1125369292536007e-308, 3e-307):
        m, k = rounded_width(0.0, hi, 2)
        assert _multiple(hi, m, k) - _multiple(0.0, m, k) < 2
