"""Property-based checks (hypothesis) of the per-row helpers."""

import re
from itertools import combinations

from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.functions.edit_distance import dl_distance
from tessera.functions.naming import slugify

SLUG_SHAPE = re.compile(r"^([a-z0-9]+(_[a-z0-9]+)*)?$")
short = st.text(alphabet="ABCD", max_size=8)


@given(st.text(max_size=40))
def test_slug_shape_and_idempotence(name):
    s = slugify(name)
    assert SLUG_SHAPE.match(s)
    assert slugify(s) == s


@given(short, short)
def test_distance_is_symmetric_and_bounded(a, b):
    d = dl_distance(a, b)
    assert d == dl_distance(b, a)
    assert abs(len(a) - len(b)) <= d <= max(len(a), len(b))
    assert (d == 0) == (a == b)


@given(short, short, short)
@settings(max_examples=300)
def test_triangle_inequality(a, b, c):
    # the unrestricted form is a metric (the restricted OSA form is not)
    assert dl_distance(a, c) <= dl_distance(a, b) + dl_distance(b, c)


@given(short)
def test_single_edits_cost_one(a):
    for i in range(len(a)):
        assert dl_distance(a, a[:i] + a[i + 1:]) == 1
    for i in range(len(a) - 1):
        if a[i] != a[i + 1]:
            assert dl_distance(a, a[:i] + a[i + 1] + a[i] + a[i + 2:]) == 1


def _variants(s, k):
    out = {s}
    for m in range(1, k + 1):
        for idx in combinations(range(len(s)), m):
            out.add("".join(ch for j, ch in enumerate(s) if j not in idx))
    return out


def test_deletion_variants_match_enumeration(spark):
    from tessera.operators.similarity import deletion_variants

    words = ["", "A", "AB", "AAB", "ABCA", "GILGFVFTL", "ABCDEFGHIJ"]
    df = spark.createDataFrame([(w,) for w in words], "s string")
    for k in (0, 1, 2, 3):
        got = {r.s: set(r.v) for r in df.select("s", deletion_variants("s", k).alias("v")).collect()}
        assert got == {w: _variants(w, k) for w in words}, k
