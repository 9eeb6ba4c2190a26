import pytest
from conftest import rows

from cropledger.operators import lookup


@pytest.fixture
def fact(make):
    return make("k string, j int, v double", [("a", 1, 1.0), ("a", 2, 2.0), ("b", 1, 3.0)])


def test_strict_lookup(fact, make):
    dim = make("key string, code string", [("a", "A"), ("b", "B"), ("c", "C")])
    got = lookup.strict_lookup(fact, dim, {"k": "key"}, {"region": "code"})
    assert rows(got, "k", "v", "region") == [("a", 1.0, "A"), ("a", 2.0, "A"), ("b", 3.0, "B")]


@pytest.mark.parametrize(
    "dim, message",
    [
        ([("a", "A")], "no match in lookup table"),
        ([("a", "A"), ("b", None)], "no match in lookup table"),
        ([("a", "A"), ("b", "B"), ("b", "B")], "repeated key"),
    ],
)
def test_strict_lookup_fails_even_if_the_attribute_is_not_used(fact, make, dim, message):
    got = lookup.strict_lookup(fact, make("k string, code string", dim), "k", ["code"])
    with pytest.raises(Exception, match=message):
        got.count()


def test_strict_lookup_rejects_a_null_key(make):
    dim = make("k string, code string", [("a", "A")])
    with pytest.raises(Exception, match="no match"):
        lookup.strict_lookup(make("k string", [(None,)]), dim, "k", ["code"]).count()


def test_unmatched_keys(fact, make):
    assert rows(lookup.unmatched_keys(fact, make("k string", [("a",)]), "k")) == [("b",)]


def test_strict_natural_lookup(fact, make):
    other = make("k string, j int, p double", [("a", 1, 5.0), ("a", 2, 6.0), ("b", 1, 7.0)])
    assert rows(lookup.strict_natural_lookup(fact, other), "v", "p") == [(1.0, 5.0), (2.0, 6.0), (3.0, 7.0)]
    with pytest.raises(ValueError):
        lookup.strict_natural_lookup(fact, make("z string", [("a",)]))


def test_lookup_default_and_matched(fact, make):
    dim = make("k string, f double", [("a", 2.0), ("z", 9.0)])
    assert rows(lookup.lookup_default(fact, dim, "k", {"f": 1.0}), "v", "f") == [(1.0, 2.0), (2.0, 2.0), (3.0, 1.0)]
    blank = make("k string, f string", [("a", None), ("b", "B")])
    assert rows(lookup.lookup_matched(fact, blank, "k", ["f"]), "v", "f") == [(3.0, "B")]


def test_restrict_lookup(fact, make):
    assert rows(lookup.restrict_lookup(fact, make("k string, n string", [("b", "B")]), "k", ["n"]), "v", "n") == [(3.0, "B")]


def test_join_null_safe(make):
    left, right = make("k string, v int", [(None, 1), ("a", 2)]), make("k string, w int", [(None, 5)])
    assert rows(lookup.join_null_safe(left, right, ["k"]), "v", "w") == [(1, 5), (2, None)]


def test_replicate_over(fact, make):
    assert lookup.replicate_over(fact, "s", ["x", "y"]).count() == 6
    seen = make("m string", [("x",), ("y",), ("x",)])
    assert rows(lookup.replicate_over_observed(fact.where("k = 'b'"), "s", seen, "m"), "k", "s") == [("b", "x"), ("b", "y")]
