"""Where the 400 bytes of the substring removal begin to count."""

import pytest

from slantwise.llm.substrings import remove_repeats


def passage(size):
    """Over 50 different words of ``size`` bytes in all."""
    words = [f"w{k}" for k in range(51)]
    text = " ".join(words)
    return text + "x" * (size - len(text))


@pytest.mark.parametrize("size,removed", [(200, 0), (380, 0), (398, 0), (399, 400), (400, 401), (700, 701)])
def test_a_shared_passage_counts_by_its_bytes(spark, size, removed):
    """Passages of over 50 words repeat in 381 bytes and less on the check tables; such stay."""
    shared = passage(size)
    assert len(shared) == size and len(shared.split()) == 51
    own = [" ".join(f"{name}{k}" for k in range(90)) for name in "ab"]
    texts = [f"{own[0]}1 {shared}", f"{own[1]}2 {shared}2", "alone " * 10, shared + "3"]
    # The blank before the passage repeats in two of them, nothing else around it does.
    rows = remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in rows}
    whole = removed if size + 1 >= 400 else 0
    assert got[0] == got[1] == (whole, int(whole > 0))
    assert got[2] == (0, 0) and got[3] == ((size, 1) if size >= 400 else (0, 0))
