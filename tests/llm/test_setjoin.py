"""Choice of the boundary between small and large sets."""

from slantwise.llm import pairs


def test_sizes_without_sets_never_raise_the_boundary():
    for percent in (80, 90):
        for histogram in ({}, {46: 1}, {44: 3, 48: 2}, {5: 100, 46: 1}):
            small = pairs.boundary(histogram, percent)
            rows = sum(pairs.comb(n, k) for n in histogram if n <= pairs.largest_partner(small, percent) for k in pairs.subset_sizes(n, small, percent))
            assert small < 20 and rows < 1000
    assert pairs.boundary({5: 100, 46: 1}, 80) >= 5
