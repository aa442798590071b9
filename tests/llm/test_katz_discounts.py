import zlib
from collections import Counter

import numpy as np
import pytest

from daybook.llm import katz as K

SF = "/root/testdata/sf0.01"
R = np.arange(1, 6)


def share(counts_of_counts):
    """d(r) for r from 1 to 5."""
    return K.discounted(np.array([0, 0, *counts_of_counts], np.int64))[1:] / R


def own(n):
    a = 6 * n[5] / n[0]
    return [((r + 1) * n[r] / (r * n[r - 1]) - a) / (1 - a) for r in R]


def test_good_turing_is_in_force_on_the_table(spark):
    """Groups of copies make n(5) large, so that d(4) is above 1 for words and pairs; all other counts keep Good-Turing's own."""
    one, two = Counter(), Counter()
    for d in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect():
        if zlib.crc32(str(d.doc_id).encode()) % 10:
            w = [*K.words_of(d.text), K.END]
            one.update(w)
            two.update(zip([K.START, *w], w))
    for counts in (one, two):
        by = Counter(counts.values())
        n = [by[r] for r in range(1, 7)]
        want, got = own(n), share(n)
        assert want[3] > 1 and all(0 < x < 1 for x in got)
        assert [got[i] for i in (0, 1, 2, 4)] == pytest.approx([want[i] for i in (0, 1, 2, 4)])
        slope = np.polyfit(np.log(range(1, 7)), np.log(n), 1)[0] + 1
        assert got[3] == pytest.approx(((5 / 4) ** slope - 6**slope) / (1 - 6**slope))


def test_one_count_does_not_change_the_others():
    below, above = [10000, 3000, 1500, 900, 700, 450], [10000, 3000, 1500, 900, 740, 450]
    assert own(below)[3] < 1 < own(above)[3]
    assert share(below)[:3] == pytest.approx(share(above)[:3])
    assert share(below) == pytest.approx(own(below))


def test_no_fit():
    plain = (R - 0.5) / R
    assert share([10, 4, 0, 2, 1, 1]) == pytest.approx(plain)
    assert share([1, 2, 3, 4, 5, 6]) == pytest.approx(plain)
