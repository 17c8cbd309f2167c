"""Model plug-in points: token budget, second model, loading once."""

import pytest

from quireflow.operators import backends as B
from quireflow.plans.registry import ModelError


def test_pair_ids_keep_the_seam():
    assert B.pair_ids([1, 2], [3]) == [101, 1, 2, 102, 3, 102]
    a, b = list(range(1000, 1300)), list(range(2000, 2300))
    got = B.pair_ids(a, b)
    assert got == [101, *a[-126:], 102, *b[:126], 102] and len(got) <= 256
    assert B.pair_ids([7], b) == [101, 7, 102, *b[:126], 102]
    assert len(B.pair_ids(a[:127], b[:126])) == 256


def fail(items):
    raise ValueError("no")


@pytest.mark.parametrize(
    ("first", "second", "expected"),
    [
        (lambda x: [None, "b", "c"], lambda x: ["z"], [(None, 1), ("b", 1), ("c", 1)]),
        (lambda x: ["a"], lambda x: [x[0].decode()], [("a", 1), ("2", 2), ("3", 2)]),
        (fail, lambda x: [x[0].decode()], [("1", 2), ("2", 2), ("3", 2)]),
        (lambda x: [], fail, [(None, 2)] * 3),
        (lambda x: ["a", "b", "c", "d"], None, [("a", 1), ("b", 1), ("c", 1)]),
    ],
)
def test_second_model_takes_what_the_first_left(first, second, expected):
    assert B.recognise([b"1", b"2", b"3"], first, second) == expected


def test_loaded_once_and_errors_named():
    seen = []
    assert B.loaded("m", lambda: seen.append(1) or "model") == B.loaded("m", lambda: seen.append(2)) == "model" and seen == [1]
    with pytest.raises(ModelError):
        B.loaded("broken", lambda: fail(None))


def test_crops_without_pixels_are_left_out(spark):
    crops = spark.createDataFrame([(1, b"x"), (2, None), (3, b"y")], "crop long, data binary")
    rows = B.recognise_crops(crops, "crop", "data", lambda: (lambda items: [i.decode() * 2 for i in items])).orderBy("crop").collect()
    assert [tuple(r) for r in rows] == [(1, "xx", 1), (3, "yy", 1)]
    assert B.recognise_crops(crops.limit(0), "crop", "data", lambda: fail).collect() == []
